"""Sinks: tables, snapshots and exports."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogflow.functions.text import model_tag
from catalogflow.functions.vectors import unpack_columns
from catalogflow.operators.joins import new_keys


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ("batch_id",), rebalance: bool = False) -> None:
    """Overwrite a table. ``rebalance`` evens out file sizes first, splitting hot partitions."""
    rows = df.hint("rebalance", *partition_by) if rebalance else df
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def drop_tables(spark: SparkSession, names: Sequence[str]) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def completed(spark: SparkSession, root: str, name: str) -> list[int]:
    """Numbers of the finished ``{name}=<n>`` folders below ``root``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    numbers = []
    for status in fs.listStatus(path):
        match = re.fullmatch(rf"{name}=(\d+)", status.getPath().getName())
        if match and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            numbers.append(int(match.group(1)))
    return sorted(numbers)


def write_snapshot(df: DataFrame, root: str) -> int:
    """Write a new version next to the old ones; readers switch when it is complete.

    Parquet files cannot be updated, and the frame may still be reading the last version.
    """
    version = max(completed(df.sparkSession, root, "snapshot"), default=0) + 1
    df.write.mode("overwrite").parquet(f"{root}/snapshot={version}")
    return version


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    if version is None:
        done = completed(spark, root, "snapshot")
        if not done:
            raise FileNotFoundError(f"no complete snapshot below {root}")
        version = done[-1]
    return spark.read.parquet(f"{root}/snapshot={version}")


def append_cache(existing: DataFrame, new: DataFrame, key: str = "productid") -> DataFrame:
    """Existing rows plus those of ``new`` whose key is not cached yet."""
    return existing.unionByName(new_keys(new, existing, key))


def extend_cache(new: DataFrame, path: str, key: str = "productid") -> None:
    """Append only unseen keys to a cache on disk; nothing already there is rewritten."""
    spark = new.sparkSession
    new_keys(new, spark.read.parquet(path).select(key), key).write.mode("append").parquet(path)


def prediction_rows(df: DataFrame, date_pred: Column, name: Column, version: Column, family: Column) -> DataFrame:
    """Scored rows in the layout of the prediction table."""
    return df.select(
        "productid", "designation", "imageid",
        F.col("prdtypecode").cast("int").alias("prediction"),
        F.array_max("p").alias("confidence"),
        date_pred.alias("date_pred"),
        model_tag(name, version).alias("model"),
        family.alias("model_family"),
    )


def export_probabilities(df: DataFrame, n_classes: int, key: str = "productid", label: str = "label") -> DataFrame:
    """Probability vector as one column per class."""
    return df.select(key, label, *unpack_columns(F.col("p"), [f"p_{i}" for i in range(n_classes)]))


def export_batches(x: DataFrame, y: DataFrame, path: str) -> None:
    """One CSV folder per batch, products and labels apart."""
    x.write.mode("overwrite").option("header", True).partitionBy("batch_id").csv(f"{path}/x")
    y.write.mode("overwrite").option("header", True).partitionBy("batch_id").csv(f"{path}/y")


def write_audit_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Audit report as CSV; ``single_file`` is for per-class summaries, a few rows."""
    rows = df.coalesce(1) if single_file else df
    rows.write.mode("overwrite").option("header", True).csv(path)


def training_rows(df: DataFrame, text: str, image: str, label: str) -> DataFrame:
    """(text vector, image vector, label) as float32 rows for trainers."""
    return df.select(
        F.col(text).cast("array<float>").alias("text"),
        F.col(image).cast("array<float>").alias("image"),
        F.col(label).cast("long").alias("label"),
    )
