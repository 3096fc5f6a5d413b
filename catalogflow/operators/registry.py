"""Model registry as tables: runs, metrics, versions and aliases; decisions are queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """Best row per key as a max over a struct: partial per task, so a hot key stays cheap."""
    best = F.max(F.struct(*order, *[F.col(c) for c in columns if c not in keys])).alias("_best")
    grouped = df.groupBy(*keys).agg(best)
    return grouped.select(*keys, *[F.col(f"_best.{c}") for c in columns if c not in keys])


def active_learners(aliases: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Versions carrying at least one wanted alias, with the sorted alias list."""
    return (
        aliases.where(F.col("alias").isin(list(wanted)))
        .groupBy("name", "version")
        .agg(F.sort_array(F.collect_set("alias")).alias("aliases"))
    )


def best_by_modality(versions: DataFrame, aliases: DataFrame, strategy: str) -> DataFrame:
    """Best scored version per modality among those aliased active_{strategy}; ties by name, version."""
    if strategy not in ("stateless", "stateful"):
        raise ValueError(f"unknown strategy {strategy!r}")
    holders = aliases.where(F.col("alias") == f"active_{strategy}").select("name", "version")
    candidates = versions.where(F.col("metric").isNotNull()).join(holders, ["name", "version"])
    top = Window.partitionBy("modality").orderBy(F.desc("metric"), "name", "version")
    return (
        candidates.withColumn("_rank", F.row_number().over(top)).where(F.col("_rank") == 1)
        .select("modality", "name", "version", "metric")
    )


def alias_holders(versions: DataFrame, aliases: DataFrame, alias: str) -> DataFrame:
    """The version and metric behind an alias, per model."""
    return (
        aliases.where(F.col("alias") == alias).select("name", "version")
        .join(versions.select("name", "version", "metric"), ["name", "version"], "left")
        .select("name", F.col("version").alias("holder_version"), F.col("metric").alias("holder_metric"),
                F.lit(True).alias("holder_exists"))
    )


def promotion_decision(challengers: DataFrame, versions: DataFrame, aliases: DataFrame, alias: str,
                       epsilon: float = 0.005) -> DataFrame:
    """Promote when there is no holder, no comparable metric, or a gain above epsilon."""
    joined = challengers.join(alias_holders(versions, aliases, alias), "name", "left")
    gain = F.col("metric") - F.col("holder_metric")
    return joined.withColumn("gain", gain).select(
        "name", "version", "metric", "holder_version", "holder_metric", "gain",
        F.when(F.col("holder_exists").isNull(), True)
        .when(F.col("holder_metric").isNull(), True)
        .otherwise(F.col("gain") > epsilon).alias("promoted"),
    )


def promotion_gain_geq(challengers: DataFrame, versions: DataFrame, aliases: DataFrame, alias: str,
                       epsilon: float = 0.005) -> DataFrame:
    """Same comparison with gain >= epsilon and a code for what decided it."""
    joined = challengers.join(alias_holders(versions, aliases, alias), "name", "left")
    first = F.col("holder_metric").isNull()
    wide = joined.withColumn("gain", F.col("metric") - F.col("holder_metric"))
    enough = F.col("gain") >= epsilon
    return wide.select(
        "name", "version", "metric", "holder_version", "holder_metric", "gain",
        F.when(first, True).otherwise(enough).alias("promoted"),
        F.when(first, "no_holder").when(enough, "gain_reached").otherwise("gain_too_small").alias("decided_by"),
        F.lit(epsilon).alias("epsilon"),
    )


def latest_run(runs: DataFrame) -> DataFrame:
    """Newest run of every name with its metric; ties by run id."""
    newest = _first_by(runs, ["run_name"], [F.col("start_time").alias("_t"), F.col("run_id").alias("_r")],
                       ["run_name", "run_id", "start_time", "metric"])
    return newest


def compare_and_promote(runs: DataFrame, aliases: DataFrame, alias: str, epsilon: float = 0.005) -> DataFrame:
    """Best challenger of each model against the champion re-scored on the same gold set.

    ``runs`` is (name, role, run_name, run_id, version, start_time, metric). Runs with the
    same name count once, the newest. A champion without a re-score gives no decision.
    """
    newest = _first_by(runs, ["name", "role", "run_name"],
                       [F.col("start_time").alias("_t"), F.col("run_id").alias("_r")],
                       ["name", "role", "run_name", "run_id", "version", "metric"])
    valid = newest.where((F.col("role") == "challenger") & F.col("metric").isNotNull())
    best = valid.groupBy("name").agg(
        F.max(F.struct("metric", F.col("run_name"), F.col("version"))).alias("b")
    ).select("name", F.col("b.run_name").alias("best_challenger"), F.col("b.version").alias("best_version"),
             F.col("b.metric").alias("best_metric"))
    rescored = newest.where(F.col("role") == "champion").groupBy("name").agg(F.max("metric").alias("champion_metric"))
    holder = aliases.where(F.col("alias") == alias).select("name", F.col("version").alias("champion_version"))
    joined = best.join(holder, "name", "left").join(rescored, "name", "left").withColumn(
        "gain", F.when(F.col("champion_version").isNotNull(), F.col("best_metric") - F.col("champion_metric"))
    )
    return joined.select(
        "name", "best_challenger", "best_version", "best_metric", "champion_version", "champion_metric", "gain",
        F.when(F.col("champion_version").isNull(), "promote_first")
        .when(F.col("champion_metric").isNull(), "no_decision")
        .when(F.col("gain") >= epsilon, "promote").otherwise("keep").alias("decision"),
    )


def tournament(versions: DataFrame, aliases: DataFrame, champion_aliases: Sequence[str]) -> DataFrame:
    """Best champion over all models and lineages; one row, ties by name and version."""
    holders = aliases.where(F.col("alias").isin(list(champion_aliases)))
    scored = holders.join(versions.select("name", "version", "metric"), ["name", "version"])
    return (
        scored.where(F.col("metric").isNotNull())
        .select("name", "version", "alias", "metric")
        .orderBy(F.desc("metric"), "name", "version", "alias").limit(1)
    )


def move_alias(aliases: DataFrame, moves: DataFrame) -> DataFrame:
    """Aliases after (name, alias, version) reassignments; an alias stays unique per model."""
    changed = moves.select("name", "alias", F.col("version").alias("_new"))
    return aliases.join(changed, ["name", "alias"], "full").select(
        "name", "alias", F.coalesce("_new", "version").alias("version")
    )


def latest_versions(versions: DataFrame, n: int = 2) -> DataFrame:
    """The ``n`` newest versions per model; the rank filter is pushed below the shuffle."""
    newest = Window.partitionBy("name").orderBy(F.desc("version"))
    ranked = versions.withColumn("_rank", F.row_number().over(newest))
    return ranked.where(F.col("_rank") <= n).drop("_rank")


def best_version(versions: DataFrame, n: int = 2) -> DataFrame:
    """Best of the newest versions per model, and whether it is the best overall."""
    recent = latest_versions(versions, n).where(F.col("metric").isNotNull())
    per_model = recent.groupBy("name").agg(
        F.max(F.struct("metric", (-F.col("version")).alias("older"))).alias("b")
    ).select("name", (-F.col("b.older")).alias("version"), F.col("b.metric").alias("metric"))
    top = per_model.orderBy(F.desc("metric"), "name").limit(1).select("name", F.lit(True).alias("is_best"))
    return per_model.join(top, "name", "left").na.fill(False, ["is_best"])


def alias_fallback(models: DataFrame, aliases: DataFrame, preferred: str, fallback: str) -> DataFrame:
    """Version behind the preferred alias, else behind the fallback."""

    def holder(alias: str, column: str) -> DataFrame:
        return aliases.where(F.col("alias") == alias).select("name", F.col("version").alias(column))

    joined = models.select("name").distinct().join(holder(preferred, "_p"), "name", "left").join(
        holder(fallback, "_f"), "name", "left")
    return joined.select(
        "name", F.coalesce("_p", "_f").alias("version"),
        F.when(F.col("_p").isNotNull(), preferred).when(F.col("_f").isNotNull(), fallback).alias("alias_used"),
    )


def improvements(trials: DataFrame, study: str = "study", order: str = "trial", value: str = "value",
                 block: int = 10_000) -> DataFrame:
    """Trials that beat the running best of their study, with the gain in percent.

    The running maximum is taken inside blocks of trials and carried over from the block
    maxima, so one long study is not one task.
    """
    blocked = trials.withColumn("_block", F.floor(F.col(order) / block))
    earlier_blocks = Window.partitionBy(study).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocked.groupBy(study, "_block").agg(F.max(value).alias("_m")).select(
        study, "_block", F.max("_m").over(earlier_blocks).alias("_carried"))
    inside = Window.partitionBy(study, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    best = blocked.join(carried, [study, "_block"]).withColumn(
        "previous_best", F.greatest(F.max(value).over(inside), F.col("_carried")))
    better = best.where(F.col("previous_best").isNull() | (F.col(value) > F.col("previous_best")))
    gain = F.abs(F.col("previous_best") - F.col(value)) / F.col(value) * 100.0
    return better.select(study, order, value, "previous_best", gain.alias("improvement_pct"))


def long_metrics(df: DataFrame, run: str, names: Sequence[str]) -> DataFrame:
    """Metrics in long form: (run, key, value)."""
    cast = df.select(run, *[F.col(n).cast("double").alias(n) for n in names])
    return cast.unpivot([run], list(names), "key", "value")


def with_lineage(df: DataFrame, name: str, version: int) -> DataFrame:
    return df.withColumns({"source_model_name": F.lit(name), "source_model_version": F.lit(version)})
