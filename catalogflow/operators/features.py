"""Feature tables: tabular statistics, embeddings and the incremental cache."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow.functions.images import GRID, brightness, grey_grid
from catalogflow.functions.text import (
    clean_description,
    full_text_strip,
    image_path,
    null_defaults,
    text_tabular,
    tokenize,
)
from catalogflow.operators.joins import new_keys

# Called once per Python worker; the returned function maps a batch to one vector per row.
TextEncoder = Callable[[], Callable[[pd.Series], np.ndarray]]
ImageEncoder = Callable[[], Callable[[pd.DataFrame], np.ndarray]]


def image_tabular(products: DataFrame, images: DataFrame, key: str = "productid") -> DataFrame:
    """Size, aspect ratio and brightness of each product's image, defaults when there is none."""
    stats = brightness("height", "width", "channels", "data")
    measured = images.where(F.col("status") == "ok").select(
        key, "width", "height", stats.alias("b")
    )
    joined = products.select(key).join(measured, key, "left")
    return joined.select(
        key,
        F.coalesce("width", F.lit(0)).alias("tab_image_width"),
        F.coalesce("height", F.lit(0)).alias("tab_image_height"),
        F.coalesce(F.col("width") / F.col("height"), F.lit(1.0)).alias("tab_image_aspect_ratio"),
        F.coalesce("b.mean", F.lit(0.0)).alias("tab_image_brightness_mean"),
        F.coalesce("b.std", F.lit(0.0)).alias("tab_image_brightness_std"),
    )


def fit_text_encoder(train: DataFrame, text: str, width: int = 256) -> PipelineModel:
    """Default text encoder: hashed token counts weighted by inverse document frequency."""
    tokens = train.select(tokenize(F.col(text)).alias("_tokens"))
    hashing = HashingTF(numFeatures=width, inputCol="_tokens", outputCol="_tf")
    idf = IDF(inputCol="_tf", outputCol="_tfidf").fit(hashing.transform(tokens))
    return PipelineModel([hashing, idf, Normalizer(inputCol="_tfidf", outputCol="_unit")])


def text_embeddings(df: DataFrame, text: str, encoder: PipelineModel | TextEncoder, output: str = "text_vector") -> DataFrame:
    """Adds one float vector per text.

    A Spark model runs in the JVM. Any other encoder is built once per Python worker and
    gets Arrow batches.
    """
    if isinstance(encoder, PipelineModel):
        encoded = encoder.transform(df.withColumn("_tokens", tokenize(F.col(text))))
        return encoded.withColumn(output, vector_to_array("_unit", "float32")).drop("_tokens", "_tf", "_tfidf", "_unit")

    schema = T.StructType([*df.schema.fields, T.StructField(output, T.ArrayType(T.FloatType()))])

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = encoder()
        for batch in batches:
            yield batch.assign(**{output: list(np.asarray(model(batch[text]), dtype=np.float32))})

    return df.mapInPandas(encode, schema)


def grey_grid_encoder() -> Callable[[pd.DataFrame], np.ndarray]:
    def encode(batch: pd.DataFrame) -> np.ndarray:
        return np.stack([
            grey_grid(h, w, c, d) for h, w, c, d in zip(batch.height, batch.width, batch.channels, batch.data)
        ])

    return encode


def image_embeddings(images: DataFrame, encoder: ImageEncoder = grey_grid_encoder, width: int = GRID * GRID,
                     key: str = "productid", output: str = "image_vector") -> DataFrame:
    """One float vector per image; an unreadable image gives NaNs of the same width."""
    schema = T.StructType([images.schema[key], T.StructField(output, T.ArrayType(T.FloatType()))])

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = encoder()
        for batch in batches:
            vectors = np.full((len(batch), width), np.nan, dtype=np.float32)
            ok = (batch["status"] == "ok").to_numpy()
            if ok.any():
                vectors[ok] = model(batch[ok])
            yield pd.DataFrame({key: batch[key], output: list(vectors)})

    return images.select(key, "status", "height", "width", "channels", "data").mapInPandas(encode, schema)


def build_features_incremental(products: DataFrame, cached: DataFrame | None,
                               encode: Callable[[DataFrame], DataFrame], key: str = "productid") -> DataFrame:
    """Rows to append to the cache: ``encode`` sees only products not cached yet."""
    todo = products if cached is None else new_keys(products, cached, key)
    return encode(todo)


def text_feature_rows(products: DataFrame) -> DataFrame:
    """Identifiers with the seven text statistics."""
    return products.select("productid", "imageid", *text_tabular(F.col("designation"), F.col("description")))


def prepare_scoring_rows(raw: DataFrame, clean=clean_description, image_folder: str = "") -> DataFrame:
    """Raw products to model input: defaults, full text, tabular features and image path.

    Training and scoring both go through here, so they cannot drift apart.
    """
    rows = null_defaults(raw)
    designation, description = F.col("designation"), F.col("description")
    return rows.select(
        "productid", "imageid", "designation",
        clean(full_text_strip(designation, description)).alias("text"),
        image_path(F.col("imageid"), F.col("productid"), image_folder).alias("image_path"),
        *text_tabular(designation, description),
    )
