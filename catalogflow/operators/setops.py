"""Unions, differences and intersections of keys and classes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def concat_rows(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def invalid_classes(labels: DataFrame, valid: Sequence[int], code: str = "prdtypecode") -> DataFrame:
    """Observed codes outside the valid list, which is short and sits in the filter."""
    return labels.select(code).where(~F.col(code).isin(list(valid))).distinct()


def shadow_batches(df: DataFrame, train_batches: Sequence[int], batch: str = "batch_id") -> DataFrame:
    return df.select(batch).where(~F.col(batch).isin(list(train_batches))).distinct()


def gold_val_overlap(df: DataFrame, version: int, key: str = "productid") -> DataFrame:
    """Keys that are gold and selected for validation; must be empty."""
    gold = df.where(F.col("is_gold")).select(key)
    selected = df.where(F.col(f"is_val_selection_v{version}")).select(key)
    return gold.intersect(selected)
