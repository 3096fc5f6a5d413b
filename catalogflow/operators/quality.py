"""Guards: each returns the violating rows or the figures to judge, never a side effect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogflow.functions.vectors import vsum


class GuardError(ValueError):
    """A guard found violating rows."""


def require_empty(violations: DataFrame, message: str, shown: int = 5) -> None:
    """Fail with the first few violations; looks at no more rows than it shows."""
    rows = violations.limit(shown).collect()
    if rows:
        raise GuardError(f"{message}: {[tuple(r) for r in rows]}")


def unlabelled_products(x: DataFrame, y: DataFrame, key: str = "productid") -> DataFrame:
    return x.select(key).join(y.select(key), key, "left_anti")


def duplicate_keys(df: DataFrame, key: str = "productid") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def empty_batch(df: DataFrame, batch: int) -> DataFrame:
    """One row when the batch holds no product."""
    n = df.where(F.col("batch_id") == batch).agg(F.count("*").alias("n"))
    return n.where(F.col("n") == 0).select(F.lit(batch).alias("batch_id"), "n")


def gold_share(df: DataFrame, expected: float = 0.10, tolerance: float = 0.01) -> DataFrame:
    share = df.agg(F.count("*").alias("n"), F.count_if("is_gold").alias("n_gold"),
                   F.avg(F.col("is_gold").cast("double")).alias("share"))
    return share.withColumn("passed", F.abs(F.col("share") - expected) <= tolerance)


def flag_count_matches(df: DataFrame, column: str, expected: int) -> DataFrame:
    n = df.agg(F.count_if(F.col(column)).alias("n"))
    return n.select("n", F.lit(expected).cast("long").alias("expected"), (F.col("n") == expected).alias("passed"))


def cache_single_source(cache: DataFrame) -> DataFrame:
    """Number of model names and versions a cache was built from; both must be 1."""
    sources = cache.select("source_model_name", "source_model_version").distinct()
    return sources.agg(
        F.count_distinct("source_model_name").alias("n_names"),
        F.count_distinct("source_model_version").alias("n_versions"),
    ).withColumn("passed", (F.col("n_names") == 1) & (F.col("n_versions") == 1))


def cache_in_sync(caches: DataFrame, aliases: DataFrame, alias: str) -> DataFrame:
    """Caches whose source version is not the one the alias points at."""
    holder = aliases.where(F.col("alias") == alias).select(
        F.col("name").alias("source_model_name"), F.col("version").alias("alias_version")
    )
    built = caches.select("source_model_name", "source_model_version").distinct()
    return (
        built.join(holder, "source_model_name", "left")
        .where(~F.col("source_model_version").eqNullSafe(F.col("alias_version")))
    )


def required_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise GuardError(f"columns missing: {missing}")


def bad_probabilities(df: DataFrame, p: str = "p", tolerance: float = 1e-5) -> DataFrame:
    """Rows whose vector is not finite or does not add up to one."""
    total = vsum(F.col(p))
    finite = ~F.exists(p, lambda x: F.isnan(x) | x.isNull() | (F.abs(x) == float("inf")))
    return df.where(~finite | (F.abs(total - 1.0) > tolerance) | total.isNull())
