"""Profiles, distributions and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogflow.functions.text import feature_group, tokenize
from catalogflow.functions.vectors import has_nan


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("nb_occurrences")).orderBy(F.desc("nb_occurrences"), label)


def batch_profile(df: DataFrame, label: str, batch: str = "batch_id") -> DataFrame:
    """Rows, share of the total and distinct classes per batch.

    Counting per (batch, class) first keeps the distinct count out of the shuffle.
    """
    cells = df.groupBy(batch, label).agg(F.count("*").alias("n"))
    profile = cells.groupBy(batch).agg(F.sum("n").alias("n_samples"), F.count(label).alias("n_classes"))
    everything = Window.partitionBy()
    return profile.withColumn("share", F.col("n_samples") / F.sum("n_samples").over(everything))


def batch_summary(df: DataFrame, batch: int, label: str) -> DataFrame:
    return df.where(F.col("batch_id") == batch).agg(
        F.lit(batch).alias("batch_id"),
        F.count("*").alias("n_samples"),
        F.count_if("is_gold").alias("n_gold"),
        F.count_distinct(label).alias("n_classes"),
    )


def split_summary(df: DataFrame, train_batches: Sequence[int], version: int) -> DataFrame:
    """Sizes of every split in one pass."""
    in_batches = F.col("batch_id").isin(list(train_batches))
    gold = F.coalesce(F.col("is_gold"), F.lit(False))
    selected = F.coalesce(F.col(f"is_val_selection_v{version}"), F.lit(False))
    pool = in_batches & ~gold
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(pool).alias("train_pool"),
        F.count_if(pool & ~selected).alias("train_pool_effective"),
        F.count_if(pool & selected).alias("val_selection"),
        F.count_if(gold).alias("gold"),
        F.count_if(~in_batches & ~gold).alias("shadow"),
    )


def class_drift(df: DataFrame, label: str, version: int, limit: float = 0.01) -> DataFrame:
    """Per class |p_val - p_train| inside the superset, with the maximum and the verdict.

    Both shares come from one count per class, so a class missing on one side has share 0. When a whole
    side has no rows there is nothing to compare: drift is null and the verdict false.
    """
    flag = F.col(f"is_val_selection_v{version}")
    offered = df.where((F.col("batch_id") <= version) & ~F.col("is_gold") & flag.isNotNull())
    counts = offered.groupBy(label).agg(F.count_if(flag).alias("n_val"), F.count_if(~flag).alias("n_train"))
    everything = Window.partitionBy()

    def share(part: str) -> Column:
        total = F.sum(f"n_{part}").over(everything)
        return F.when(total > 0, F.col(f"n_{part}") / total).otherwise(0.0).alias(f"p_{part}")

    both = (F.sum("n_val").over(everything) > 0) & (F.sum("n_train").over(everything) > 0)
    drift = counts.select(label, share("val"), share("train"), both.alias("_both")).withColumn(
        "drift_abs", F.when(F.col("_both"), F.abs(F.col("p_val") - F.col("p_train")))).drop("_both")
    return drift.withColumn("max_drift", F.max("drift_abs").over(everything)).withColumn(
        "passed", F.coalesce(F.col("max_drift") < limit, F.lit(False))
    )


def length_distribution(df: DataFrame, length, cuts: Sequence[int] = (96, 128, 160)) -> DataFrame:
    """Exact quartiles, tail percentiles, moments and share above each cut.

    Rows are first counted per length, so the percentile state grows with the number of
    distinct lengths, not with the rows.
    """
    lengths = df.select(length.alias("len")).where(F.col("len").isNotNull())
    freq = lengths.groupBy("len").agg(F.count("*").alias("n"))
    total = F.sum("n")
    mean = F.sum(F.col("len") * F.col("n")) / total
    square = F.sum(F.col("len").cast("double") * F.col("len") * F.col("n")) / total
    percentiles = {"q25": 0.25, "median": 0.5, "q75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}
    return freq.agg(
        total.alias("n"),
        F.min("len").alias("min"),
        *[F.percentile("len", F.lit(q), F.col("n")).alias(name) for name, q in percentiles.items()],
        F.max("len").alias("max"),
        mean.alias("mean"),
        F.sqrt(square - mean * mean).alias("std"),
        *[(F.sum(F.when(F.col("len") > c, F.col("n")).otherwise(0)) / total).alias(f"share_above_{c}") for c in cuts],
    )


def token_counts(df: DataFrame, text: str) -> DataFrame:
    tokens = df.select(F.explode(tokenize(F.col(text))).alias("token"))
    return tokens.groupBy("token").agg(F.count("*").alias("n"))


def vocabulary(train: DataFrame, text: str, k: int = 50_000) -> DataFrame:
    """Most frequent tokens of the training rows with ids from 2 (0 pads, 1 is unknown).

    Top-k is the feature: the ordered window runs over at most ``k - 2`` rows, and the count
    that makes the cut is found on the far fewer distinct counts.
    """
    counts = token_counts(train, text)
    # Rows this frequent or more suffice, so only they are sorted. Counted from the same
    # shuffle, which both plans read.
    falling = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
    by_count = counts.groupBy("n").agg(F.count("*").alias("tokens")).withColumn("upto", F.sum("tokens").over(falling))
    enough = by_count.agg(F.max(F.when(F.col("upto") >= k - 2, F.col("n")))).scalar()
    top = counts.where(F.col("n") >= F.coalesce(enough, F.lit(0))).orderBy(F.desc("n"), F.asc("token")).limit(k - 2)
    order = Window.orderBy(F.desc("n"), F.asc("token"))
    return top.withColumn("id", F.row_number().over(order) + 1)


def encode_tokens(df: DataFrame, vocab: DataFrame, key: str, text: str, max_len: int) -> DataFrame:
    """Token ids cut and padded to ``max_len``; unknown tokens get 1, padding 0.

    The vocabulary holds at most its top-k rows. A text gives at most ``max_len`` rows and
    those are gathered per key, which a partial aggregation starts before the shuffle.
    """
    tokens = F.slice(tokenize(F.col(text)), 1, max_len)
    # Rows are told apart by a number of their own: two may have one key.
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    rows = numbered.select("_row", key, F.posexplode_outer(tokens).alias("_pos", "_token"))
    known = vocab.select(F.col("token").alias("_token"), F.col("id").alias("_code"))
    pair = F.struct("_pos", F.coalesce("_code", F.lit(1)).cast("int").alias("_code"))
    gathered = rows.join(known, "_token", "left").groupBy("_row", key).agg(
        F.array_sort(F.collect_list(F.when(F.col("_token").isNotNull(), pair))).alias("_pairs")
    )
    codes = F.transform("_pairs", lambda t: t["_code"])
    padding = F.array_repeat(F.lit(0), F.lit(max_len) - F.size("_pairs"))
    return gathered.select(key, F.concat(codes, padding).alias("ids"))


def image_quality(products: DataFrame, status: DataFrame, key: str = "productid") -> DataFrame:
    """Each product with ok / absent / unreadable; products without a file are absent."""
    return products.join(status.select(key, "status"), key, "left").withColumn(
        "status", F.coalesce("status", F.lit("absent"))
    )


def image_quality_summary(audited: DataFrame) -> DataFrame:
    counts = [F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("ok", "absent", "unreadable")]
    bad = F.count_if(F.col("status") != "ok")
    return audited.agg(F.count("*").alias("n"), *counts, (bad / F.count("*")).alias("corruption_rate"))


def corrupted_by_class(audited: DataFrame, label: str, k: int = 5) -> DataFrame:
    """Classes with the most unusable images."""
    bad = F.count_if(F.col("status") != "ok")
    per_class = audited.where(F.col(label).isNotNull()).groupBy(label).agg(
        F.count("*").alias("n"), bad.alias("n_corrupted"), (bad / F.count("*")).alias("rate")
    )
    return per_class.orderBy(F.desc("rate"), F.desc("n_corrupted"), label).limit(k)


def chi2_independence(df: DataFrame, a: str, b: str) -> DataFrame:
    """Chi-square and degrees of freedom of the (a, b) contingency table.

    chi2 = n * (sum of n_ab^2 / (n_a n_b) - 1), so empty cells need no rows of their own.
    """
    cells = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count("*").alias("n_ab"))
    rows = cells.groupBy(a).agg(F.sum("n_ab").alias("n_a"))
    columns = cells.groupBy(b).agg(F.sum("n_ab").alias("n_b"))
    margins = cells.join(rows, a).join(columns, b)
    term = F.col("n_ab").cast("double") * F.col("n_ab") / (F.col("n_a").cast("double") * F.col("n_b"))
    return margins.agg(
        (F.sum("n_ab") * (F.sum(term) - 1.0)).alias("chi2"),
        ((F.count_distinct(a) - 1) * (F.count_distinct(b) - 1)).alias("dof"),
    )


def chi2_p_value(df: DataFrame, a: str, b: str) -> DataFrame:
    """Statistic, degrees of freedom and p-value; both columns must be category numbers."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import ChiSquareTest

    kept = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    rows = VectorAssembler(inputCols=[a], outputCol="_v").transform(kept.select(a, F.col(b).cast("double")))
    tested = ChiSquareTest.test(rows, "_v", b, True)
    return tested.select(
        F.col("statistic").alias("chi2"), F.col("degreesOfFreedom").alias("dof"), F.col("pValue").alias("p_value")
    )


def importance_by_group(df: DataFrame, group=None) -> DataFrame:
    """Gain and split importance per feature family; ``df`` is (feature, gain, split)."""
    family = group if group is not None else feature_group(F.col("feature"))
    agg = df.groupBy(family.alias("group")).agg(
        F.sum("gain").alias("gain_sum"), F.avg("gain").alias("gain_mean"),
        F.sum("split").alias("split_sum"), F.avg("split").alias("split_mean"),
        F.count("*").alias("n_features"),
    )
    everything = Window.partitionBy()
    return agg.withColumns(
        {
            f"{m}_share": F.col(f"{m}_sum") / F.greatest(F.sum(f"{m}_sum").over(everything), F.lit(1e-12))
            for m in ("gain", "split")
        }
    )


def trial_summary(df: DataFrame, penalty: float = 0.25, trial: str = "trial") -> DataFrame:
    """Fold scores of each trial: mean, population std, penalized objective, iterations."""
    mean, std = F.avg("score"), F.stddev_pop("score")
    return df.groupBy(trial).agg(
        mean.alias("mean_score"), std.alias("std_score"), (mean - penalty * std).alias("objective"),
        F.avg("best_iter").alias("best_iters_mean"), F.max("best_iter").alias("best_iters_max"),
    )


def trial_stability(df: DataFrame, objective: str = "objective") -> DataFrame:
    low, high = F.min(objective), F.max(objective)
    return df.agg(
        F.stddev_pop(objective).alias("cv_score_std"), low.alias("cv_score_min"),
        high.alias("cv_score_max"), (high - low).alias("cv_score_range"),
    )


def nan_rows(df: DataFrame, vector: str) -> DataFrame:
    return df.where(has_nan(F.col(vector)))


def dataset_fingerprint(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Content hash that ignores row order: exact sum of 32-bit md5 prefixes, and the count."""
    content = F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0002")) for c in columns])
    prefix = F.conv(F.substring(F.md5(content), 1, 8), 16, 10).cast("decimal(20,0)")
    return df.agg(F.count("*").alias("n"), F.sum(prefix).cast("string").alias("fingerprint"))


def learning_curve(runs: DataFrame) -> DataFrame:
    return runs.select("run_id", "train_pool_size", "f1_gold").orderBy("train_pool_size", "run_id")


def request_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("method", "endpoint").agg(F.count("*").alias("n_requests"))
