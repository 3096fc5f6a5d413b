"""Pixel statistics and a small default encoder, in Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Integer luma weights for red, green, blue over 2^16.
LUMA_R, LUMA_G, LUMA_B = 19595, 38470, 7471
GRID = 8


def grey(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    """Grey levels of an image stored as rows of B, G, R (, A) bytes."""
    pixels = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels).astype(np.uint32)
    if channels == 1:
        return pixels[:, :, 0].astype(np.float32)
    b, g, r = pixels[:, :, 0], pixels[:, :, 1], pixels[:, :, 2]
    return ((r * LUMA_R + g * LUMA_G + b * LUMA_B + 0x8000) >> 16).astype(np.float32)


@F.pandas_udf(T.StructType([T.StructField("mean", T.DoubleType()), T.StructField("std", T.DoubleType())]))
def brightness(height: pd.Series, width: pd.Series, channels: pd.Series, data: pd.Series) -> pd.DataFrame:
    stats = []
    for h, w, c, d in zip(height, width, channels, data):
        levels = grey(h, w, c, d) if h and h > 0 else np.zeros(1, np.float32)
        stats.append((float(levels.mean(dtype=np.float64)), float(levels.std(dtype=np.float64))))
    return pd.DataFrame(stats, columns=["mean", "std"])


def grey_grid(height: int, width: int, channels: int, data: bytes, grid: int = GRID) -> np.ndarray:
    """Mean grey level of each cell of a grid, scaled to [0, 1]."""
    levels = grey(height, width, channels, data) / 255.0
    rows = np.linspace(0, height, grid + 1).astype(int)
    columns = np.linspace(0, width, grid + 1).astype(int)
    cells = [
        levels[r : max(r2, r + 1), c : max(c2, c + 1)].mean() if r < height and c < width else 0.0
        for r, r2 in zip(rows[:-1], rows[1:])
        for c, c2 in zip(columns[:-1], columns[1:])
    ]
    return np.asarray(cells, dtype=np.float32)
