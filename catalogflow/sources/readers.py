"""Scans of raw files, product tables and caches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

IMAGE_NAME = r"image_(\d+)_product_(\d+)\.[A-Za-z]+$"


def read_indexed_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """CSV whose first, unnamed column is the row index.

    Quoted texts may hold line breaks, which makes a file one task; pass
    ``multi_line=False`` for files known to have one record per line, and they split.
    """
    return (
        spark.read.schema(schema)
        .option("header", True).option("quote", '"').option("escape", '"')
        .option("multiLine", multi_line).option("mode", "FAILFAST")
        .csv(path)
    )


def scan_products(source: DataFrame, batches: Sequence[int] | None = None,
                  columns: Sequence[str] | None = None) -> DataFrame:
    """Filtered, projected scan; the batch filter prunes partitions or row groups."""
    rows = source if batches is None else source.where(F.col("batch_id").isin(list(batches)))
    return rows if columns is None else rows.select(*columns)


def scan_cache(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    cache = spark.read.parquet(path)
    return cache if columns is None else cache.select(*columns)


def scan_limited(df: DataFrame, n: int, key: str = "productid") -> DataFrame:
    """Development limit with an explicit order: the first ``n`` keys."""
    return df.orderBy(key).limit(n)


def scan_images(spark: SparkSession, folder: str) -> DataFrame:
    """Decoded images with their ids; files that cannot be decoded are kept and marked."""
    rows = spark.read.format("image").option("dropInvalid", False).load(folder)
    name = F.col("image.origin")
    return rows.select(
        F.regexp_extract(name, IMAGE_NAME, 1).try_cast("long").alias("imageid"),
        F.regexp_extract(name, IMAGE_NAME, 2).try_cast("long").alias("productid"),
        F.when(F.col("image.height") > 0, "ok").otherwise("unreadable").alias("status"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("channels"),
        F.col("image.data").alias("data"),
    )


def available_image_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Product ids with an image file; lists names, reads no content."""
    paths = spark.read.format("binaryFile").load(folder).select("path")
    ids = paths.select(F.regexp_extract("path", IMAGE_NAME, 2).try_cast("long").alias("productid"))
    return ids.where(F.col("productid").isNotNull()).distinct()


def distinct_keys(df: DataFrame, keys: Sequence[str] = ("productid",)) -> DataFrame:
    return df.select(*keys).distinct()
