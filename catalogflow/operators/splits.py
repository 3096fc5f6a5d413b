"""Stratified splits without sorting a class in one task.

Every split orders a class by ``md5(seed:id)`` and cuts that order at quotas. The position
of a cut is found from a histogram of hash prefixes, then only the rows that share the
cut's prefix are ranked. The result is one small table of cut keys per class; assigning
rows to segments is then a comparison, so the data itself is never shuffled and a class
holding a third of all rows costs no more than the others.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogflow.functions.hashing import split_hash
from catalogflow.session import materialize

# 4,096 hash prefixes per class: few enough for map-side counts to shrink the histogram's
# shuffle, enough for the rows that share a cut's prefix to be a small part of a hot class.
PREFIX_CHARS = 3


def _ratio(fraction: float | Fraction) -> Fraction:
    return fraction if isinstance(fraction, Fraction) else Fraction(str(fraction)).limit_denominator(10**6)


def class_histogram(df: DataFrame, label: str, key: str, seed: int) -> DataFrame:
    """Rows per (class, hash prefix) with the running count inside the class."""
    cells = (
        df.where(F.col(label).isNotNull())
        .select(
            F.col(label).alias("class"),
            F.substring(split_hash(F.col(key), seed), 1, PREFIX_CHARS).alias("prefix"),
        )
        .groupBy("class", "prefix")
        .agg(F.count("*").alias("n"))
    )
    running = Window.partitionBy("class").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
    return cells.withColumn("upto", F.sum("n").over(running))


def class_sizes(histogram: DataFrame) -> DataFrame:
    return histogram.groupBy("class").agg(F.sum("n").alias("n"))


def largest_remainder(sizes: DataFrame, fraction: float | Fraction, rounding: str = "ceil") -> DataFrame:
    """Adds ``quota`` per class so that the quotas sum to ceil (or round) of n * fraction.

    Integer arithmetic throughout; remainders are given out largest first, ties by class.
    One row per class, so the global order is over the class dictionary only.
    """
    ratio = _ratio(fraction)
    num, den = ratio.numerator, ratio.denominator
    everything = Window.partitionBy()
    order = Window.orderBy(F.desc("_remainder"), F.asc("class"))
    extra = F.lit(den - 1) if rounding == "ceil" else F.lit(den // 2)
    scaled = F.col("n") * num

    def whole(c: Column) -> Column:
        return F.call_function("div", c, F.lit(den))

    target = whole(F.sum(scaled).over(everything) + extra)
    return (
        sizes.withColumns({"_base": whole(scaled), "_remainder": scaled % den, "_target": target})
        .withColumn("_spare", F.col("_target") - F.sum("_base").over(everything))
        .withColumn("_more", (F.row_number().over(order) <= F.col("_spare")).cast("long"))
        .withColumn("quota", F.least(F.col("n"), F.col("_base") + F.col("_more")))
        .drop("_base", "_remainder", "_target", "_spare", "_more")
    )


def cut_keys(df: DataFrame, label: str, key: str, seed: int, histogram: DataFrame, cuts: DataFrame) -> DataFrame:
    """Per class, the (hash, key) of the last row before each cut, as ``_last0``, ``_last1``, ...

    ``cuts`` is (class, positions): cut positions in rows of the class. A cut at position 0
    has no row before it and stays null.
    """
    first, last = F.col("upto") - F.col("n"), F.col("upto")
    inside = F.filter(
        F.transform("positions", lambda p, i: F.struct((p - first).alias("need"), i.alias("cut_no"))),
        lambda c: (c["need"] > 0) & (c["need"] <= F.col("n")),
    )
    # A row per cut at most; written, so that the planner knows its size.
    cells = materialize(
        histogram.join(cuts, "class").select("class", "prefix", inside.alias("cuts")).where(F.size("cuts") > 0),
        "split-cells")
    hashed = df.where(F.col(label).isNotNull()).select(
        F.col(label).alias("class"), F.col(key).alias("id"), split_hash(F.col(key), seed).alias("hash")
    )
    # Copies of one key are counted, not ranked, so they cannot pile up in one window.
    cell = (
        Window.partitionBy("class", "prefix").orderBy("hash", "id")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        hashed.withColumn("prefix", F.substring("hash", 1, PREFIX_CHARS))
        .join(cells, ["class", "prefix"])
        .groupBy("class", "prefix", "hash", "id")
        .agg(F.count("*").alias("n"), F.first("cuts").alias("cuts"))
        .withColumn("upto", F.sum("n").over(cell))
        .select("class", "id", "hash", "n", "upto", F.explode("cuts").alias("cut"))
        .where((F.col("cut.need") > F.col("upto") - F.col("n")) & (F.col("cut.need") <= F.col("upto")))
        .select("class", "cut.cut_no", F.struct("hash", "id").alias("last"))
    )


def segment(df: DataFrame, label: str, key: str, seed: int, histogram: DataFrame, cuts: DataFrame,
            n_cuts: int, name: str = "segment") -> DataFrame:
    """Number of cuts each row lies behind, 0 .. n_cuts; null for rows without a class."""
    lasts = cut_keys(df, label, key, seed, histogram, cuts).groupBy(F.col("class").alias("_class")).agg(
        *[F.max(F.when(F.col("cut_no") == i, F.col("last"))).alias(f"_last{i}") for i in range(n_cuts)]
    )
    here = F.struct(split_hash(F.col(key), seed).alias("hash"), F.col(key).alias("id"))
    behind = [F.coalesce(F.col("_here") > F.col(f"_last{i}"), F.lit(True)).cast("int") for i in range(n_cuts)]
    passed: Column = behind[0]
    for b in behind[1:]:
        passed = passed + b
    keys = materialize(lasts, "split-keys")
    histogram.unpersist()
    return (
        df.withColumn("_here", here).join(keys, F.col(label) == F.col("_class"), "left")
        .withColumn(name, F.when(F.col(label).isNotNull(), passed))
        .drop("_class", "_here", *[f"_last{i}" for i in range(n_cuts)])
    )


def stratified_flag(df: DataFrame, label: str, key: str, fraction: float, seed: int,
                    name: str, rule: str = "ceil") -> DataFrame:
    """True for the first quota of each class in hash order, false for the others.

    ``rule``: "ceil" gives largest-remainder quotas that add up to ceil(n * fraction);
    "floor" gives floor(n_class * fraction) rows per class, possibly none.
    """
    histogram = small_histogram(df, label, key, seed)
    sizes = class_sizes(histogram)
    if rule == "floor":
        ratio = _ratio(fraction)
        quota = F.call_function("div", F.col("n") * ratio.numerator, F.lit(ratio.denominator))
        quotas = sizes.withColumn("quota", quota)
    else:
        quotas = largest_remainder(sizes, fraction)
    cuts = quotas.select("class", F.array("quota").alias("positions"))
    out = segment(df, label, key, seed, histogram, cuts, 1, name)
    return out.withColumn(name, F.coalesce(F.col(name) == 0, F.lit(False)))


def small_histogram(df: DataFrame, label: str, key: str, seed: int) -> DataFrame:
    """The histogram is read several times; it has at most classes x prefixes rows."""
    return class_histogram(df, label, key, seed).persist()


def assign_batches(df: DataFrame, label: str, key: str, fractions: Sequence[float] = (0.5, 0.25, 0.25),
                   seed: int = 42, name: str = "batch_id") -> DataFrame:
    """Stratified batch numbers from 1; each batch takes its share of what is left."""
    shares = [_ratio(f) for f in fractions]
    if sum(shares) != 1:
        raise ValueError(f"fractions must add up to 1, got {float(sum(shares))}")
    if len(shares) == 1:
        return df.withColumn(name, F.when(F.col(label).isNotNull(), F.lit(1)))
    histogram = small_histogram(df, label, key, seed)
    left = class_sizes(histogram).withColumns({"taken": F.lit(0).cast("long"), "positions": F.array().cast("array<bigint>")})
    rest = Fraction(1)
    for share in shares[:-1]:
        left = largest_remainder(left, share / rest, "round").withColumns({
            "n": F.col("n") - F.col("quota"), "taken": F.col("taken") + F.col("quota"),
            "positions": F.array_append("positions", F.col("taken") + F.col("quota")),
        }).drop("quota")
        rest -= share
    cuts = left.select("class", "positions")
    out = segment(df, label, key, seed, histogram, cuts, len(shares) - 1, name)
    return out.withColumn(name, F.col(name) + 1)


def equal_parts(df: DataFrame, label: str, key: str, k: int, seed: int, name: str) -> DataFrame:
    """Part 0 .. k-1 of each class; part sizes inside a class differ by at most one."""
    histogram = small_histogram(df, label, key, seed)
    parts = F.sequence(F.lit(1), F.lit(k - 1))
    position = F.transform(parts, lambda i: F.call_function("div", F.col("n") * i + (k - 1), F.lit(k)))
    cuts = class_sizes(histogram).select("class", position.alias("positions"))
    return segment(df, label, key, seed, histogram, cuts, k - 1, name)


def assign_equal_batches(df: DataFrame, label: str, key: str, k: int = 4, seed: int = 42) -> DataFrame:
    out = equal_parts(df, label, key, k, seed, "batch_id")
    return out.withColumn("batch_id", F.col("batch_id") + 1)


def stratified_kfold(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    return equal_parts(df, label, key, k, seed, "fold")


def val_selection(df: DataFrame, version: int, label: str, key: str, fraction: float = 0.10,
                  seed: int = 42, batch: str = "batch_id", gold: str = "is_gold") -> DataFrame:
    """Adds ``is_val_selection_v{version}``: a stratified share of batches 1..version, gold excluded.

    Flags of older versions are separate columns and are not touched. Rows of later batches
    stay null, as they were never offered to this version.
    """
    column = f"is_val_selection_v{version}"
    offered = (F.col(batch) <= version) & ~F.col(gold)
    pool = df.withColumn("_stratum", F.when(offered, F.col(label)))
    flagged = stratified_flag(pool, "_stratum", key, fraction, seed, column)
    return flagged.withColumn(column, F.when(F.col(batch) <= version, F.col(column))).drop("_stratum")


def train_val_split(df: DataFrame, label: str, key: str, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``split`` = 'val' for a stratified share, 'train' for the rest."""
    flagged = stratified_flag(df.where(F.col(label).isNotNull()), label, key, fraction, seed, "_val")
    return flagged.withColumn("split", F.when(F.col("_val"), "val").otherwise("train")).drop("_val")


def train_test_split(df: DataFrame, label: str, key: str, fraction: float = 0.15, seed: int = 42) -> dict[str, DataFrame]:
    """Stratified holdout as four tables: X and y of train and test."""
    flagged = stratified_flag(df.where(F.col(label).isNotNull()), label, key, fraction, seed, "_test")
    parts = {}
    for part, wanted in (("train", ~F.col("_test")), ("test", F.col("_test"))):
        rows = flagged.where(wanted).drop("_test")
        parts[f"x_{part}"] = rows.drop(label)
        parts[f"y_{part}"] = rows.select(key, label)
    return parts


def stratified_sample(df: DataFrame, label: str, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """floor(n_class * fraction) rows of each class; a rare class may give none."""
    if fraction >= 1.0:
        return df
    flagged = stratified_flag(df, label, key, fraction, seed, "_kept", rule="floor")
    return flagged.where("_kept").drop("_kept")


def replay_mix(df: DataFrame, batches: Sequence[int], label: str, key: str, fraction: float,
               seed: int = 42, batch: str = "batch_id") -> DataFrame:
    """Newest batch whole plus a stratified sample of the older ones."""
    newest = max(batches)
    older = [b for b in batches if b < newest]
    pool = df.where(F.col(batch).isin(list(batches)))
    if not older:
        return pool
    if fraction >= 1.0:
        return pool
    stratum = pool.withColumn("_stratum", F.when(F.col(batch) < newest, F.col(label)))
    flagged = stratified_flag(stratum, "_stratum", key, fraction, seed, "_kept", rule="floor")
    return flagged.where((F.col(batch) == newest) | F.col("_kept")).drop("_stratum", "_kept")


def effective_pool(df: DataFrame, batches: Sequence[int], version: int, batch: str = "batch_id",
                   gold: str = "is_gold") -> DataFrame:
    """Training pool without the rows of validation version ``version``; a gold flag never set counts as not gold."""
    flag = F.coalesce(F.col(f"is_val_selection_v{version}"), F.lit(False))
    return df.where(F.col(batch).isin(list(batches)) & ~F.coalesce(F.col(gold), F.lit(False)) & ~flag)
