"""Row and column selections on the product table."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def train_pool(df: DataFrame, batches: Sequence[int], exclude_gold: bool = True) -> DataFrame:
    rows = df.where(F.col("batch_id").isin(list(batches)))
    return rows.where(~F.coalesce(F.col("is_gold"), F.lit(False))) if exclude_gold else rows


def val_superset(df: DataFrame, version: int) -> DataFrame:
    """Rows offered to validation version ``version``."""
    return df.where((F.col("batch_id") <= version) & ~F.col("is_gold"))


def gold_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_gold"))


def shadow_batch(df: DataFrame, batch: int, train_batches: Sequence[int]) -> DataFrame:
    """A batch never trained on, gold excluded."""
    if batch in train_batches:
        raise ValueError(f"batch {batch} is a training batch, it cannot serve as shadow")
    return df.where((F.col("batch_id") == batch) & ~F.col("is_gold"))


def missing_field(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def products_with_image(df: DataFrame, image_ids: DataFrame, key: str = "productid") -> DataFrame:
    return df.join(image_ids.select(key), key, "left_semi")


def min_support(df: DataFrame, label: str, n: int) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("support")).where(F.col("support") >= n)


def columns_by_pattern(df: DataFrame, prefix: str | None = None) -> DataFrame:
    """Feature columns by prefix, or by the ``name_feat_<int>`` pattern, in numeric order."""
    if prefix is not None:
        names = [c for c in df.columns if c.startswith(prefix)]
    else:
        numbered = [(m.group(1), int(m.group(2)), c) for c in df.columns if (m := re.fullmatch(r"(.+)_feat_(\d+)", c))]
        names = [c for _, _, c in sorted(numbered)]
    if not names:
        raise ValueError(f"no feature column matches {prefix or '<name>_feat_<int>'} in {df.columns}")
    return df.select(*names)
