"""Keyed joins between products, labels, caches and model outputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zip_by_position(x: DataFrame, y: DataFrame, position: str = "row_id") -> DataFrame:
    """Align two files by their row index; an index that is not once on either side is an error."""
    sides = x.select(position, F.lit(1).alias("x"), F.lit(0).alias("y")).unionByName(
        y.select(position, F.lit(0).alias("x"), F.lit(1).alias("y")))
    uneven = sides.groupBy(position).agg(F.sum("x").alias("x"), F.sum("y").alias("y")).where(
        (F.col("x") != 1) | (F.col("y") != 1) | F.col(position).isNull())
    wrong = uneven.limit(3).collect()
    if wrong:
        raise ValueError("files differ: " + ", ".join(
            f"row {r[position]} is {r['x']} and {r['y']} times in them" for r in wrong))
    return x.join(y, position)


def join_labels(x: DataFrame, y: DataFrame, key: str = "productid") -> DataFrame:
    return x.join(y, key)


def join_modalities(text: DataFrame, image: DataFrame, target: DataFrame,
                    keys: Sequence[str] = ("imageid", "productid")) -> DataFrame:
    return text.join(image, list(keys)).join(target, list(keys))


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "_feat" in c]


def join_extra_caches(base: DataFrame, caches: Mapping[str, DataFrame], key: str = "productid") -> DataFrame:
    """Inner-join every cache, keeping only its key and feature columns.

    All sides shuffle on the same key, so the chain reuses one partitioning of the base.
    """
    return reduce(lambda left, right: left.join(right.select(key, *feature_columns(right)), key),
                  caches.values(), base)


def cache_coverage(base: DataFrame, caches: Mapping[str, DataFrame], key: str = "productid") -> DataFrame:
    """Rows of the base each cache drops when the caches are joined in turn.

    One chain of joins on the key, all with the same partitioning, and one aggregation.
    """
    marked, present = base.select(key), F.lit(True)
    counts = []
    for i, (name, cache) in enumerate(caches.items()):
        here = F.col(f"_in{i}").isNotNull()
        marked = marked.join(cache.select(key).distinct().withColumn(f"_in{i}", F.lit(True)), key, "left")
        counts.append(F.struct(F.lit(name).alias("cache"), F.count_if(present & ~here).alias("n_dropped")))
        present = present & here
    return marked.agg(F.array(*counts).alias("c")).select(F.explode("c").alias("c")).select("c.*")


def lookup_default(df: DataFrame, dim: DataFrame, key: str, defaults: Mapping[str, object]) -> DataFrame:
    """Left lookup with a stand-in for missing entries."""
    looked_up = df.join(dim.select(key, *defaults), key, "left")
    return looked_up.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def new_keys(all_rows: DataFrame, cached: DataFrame, key: str | Sequence[str] = "productid") -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return all_rows.join(cached.select(*keys), keys, "left_anti")


def requested_split(requested: DataFrame, queue: DataFrame, key: str = "productid") -> DataFrame:
    """Every requested key once, with whether the queue holds it."""
    wanted = requested.select(key).distinct()
    present = queue.select(key).distinct().withColumn("present", F.lit(True))
    return wanted.join(present, key, "left").withColumn("present", F.coalesce("present", F.lit(False)))


def rare_full_outer(p: DataFrame, q: DataFrame, key: str) -> DataFrame:
    """Full outer join on the class; a share missing on one side is 0."""
    joined = p.join(q, key, "full")
    return joined.na.fill(0.0, [c for c in joined.columns if c != key])


def restore_order(df: DataFrame, ids: DataFrame, key: str = "productid", order: str = "_order") -> DataFrame:
    return df.join(ids.select(key, order), key).orderBy(order).drop(order)


def join_model_probabilities(a: DataFrame, b: DataFrame, key: str = "productid") -> DataFrame:
    """Probabilities of two models side by side, whatever the row order of either."""
    right = b.select(key, F.col("p").alias("p_b"))
    return a.select(key, "y", F.col("p").alias("p_a")).join(right, key)


def migrate_columns(cache: DataFrame, source: DataFrame, defaults: Mapping[str, object],
                    key: str = "productid") -> DataFrame:
    """Fill in the columns an older cache lacks from the product table."""
    missing = {c: v for c, v in defaults.items() if c not in cache.columns}
    if not missing:
        return cache
    filled = cache.join(source.select(key, *missing), key, "left")
    return filled.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v)) for c, v in missing.items() if v is not None}
    )


def class_dimension(labels: DataFrame, code: str = "prdtypecode") -> DataFrame:
    """Sorted codes with dense index 0 .. K-1; one row per class."""
    from pyspark.sql import Window

    codes = labels.where(F.col(code).isNotNull()).select(code).distinct()
    return codes.withColumn("label", (F.row_number().over(Window.orderBy(code)) - 1).cast("int"))


def encode_label(df: DataFrame, dimension: DataFrame, code: str = "prdtypecode") -> DataFrame:
    """Add the index of each code; a code without an index is an error, not a lost row."""
    known = F.when(F.col("label").isNull() & F.col(code).isNotNull(), F.raise_error(
        F.concat(F.lit("class without index: "), F.col(code).cast("string"))).cast("int")).otherwise(F.col("label"))
    return df.where(F.col(code).isNotNull()).join(dimension, code, "left").withColumn("label", known)


def decode_label(df: DataFrame, dimension: DataFrame, label: str = "label", code: str = "prdtypecode") -> DataFrame:
    lookup = dimension.select(F.col("label").alias(label), code)
    known = F.when(F.col(code).isNull() & F.col(label).isNotNull(), F.raise_error(
        F.concat(F.lit("index without class: "), F.col(label).cast("string"))).cast(
        dimension.schema[code].dataType)).otherwise(F.col(code))
    return df.where(F.col(label).isNotNull()).join(lookup, label, "left").withColumn(code, known)


def upsert_columns(base: DataFrame, delta: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Set ``columns`` from ``delta`` where it has the key; other rows keep theirs."""
    changes = delta.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = base.join(changes, key, "left")

    def value(c: str) -> Column:
        old = F.col(c) if c in base.columns else F.lit(None)
        return F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(old)

    return joined.withColumns({c: value(c) for c in columns}).drop("_hit", *[f"_new_{c}" for c in columns])


def delete_by_keys(table: DataFrame, keys: DataFrame, key: str = "productid") -> DataFrame:
    """Rows that were not in the snapshot of keys; late arrivals stay."""
    return table.join(keys.select(key), key, "left_anti")


def reset_flag(df: DataFrame, column: str, version: int, batch: str = "batch_id") -> DataFrame:
    old = F.col(column) if column in df.columns else F.lit(None).cast("boolean")
    return df.withColumn(column, F.when(F.col(batch) <= version, F.lit(False)).otherwise(old))
