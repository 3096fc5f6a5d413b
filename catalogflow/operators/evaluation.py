"""Evaluation of classifiers from (y, p) rows: label and probability vector.

``scored`` derives the per-row figures once; every metric is then one aggregation with
map-side partials. Class-level steps work on the confusion counts, K x K rows at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogflow.functions import vectors as V


def scored(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Adds prediction, confidence, margin and correctness."""
    rows = df.withColumns(
        {"pred": V.argmax(F.col(p)), "conf": V.confidence(F.col(p)), "margin": V.margin(F.col(p))}
    )
    return rows.withColumn("correct", F.col("pred") == F.col(y))


def confusion_matrix(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, "y", "pred").agg(F.count("*").alias("n"))


def class_marginals(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Support, predicted and true-positive counts per class seen in y or pred."""
    sides = confusion.select(
        *by,
        F.explode(
            F.array(
                F.struct(F.col("y").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                         F.when(F.col("y") == F.col("pred"), F.col("n")).otherwise(0).alias("tp")),
                F.struct(F.col("pred").alias("class"), F.lit(0).cast("long").alias("support"),
                         F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp")),
            )
        ).alias("s"),
    )
    return sides.groupBy(*by, F.col("s.class").alias("class")).agg(
        F.sum("s.support").alias("support"), F.sum("s.predicted").alias("predicted"), F.sum("s.tp").alias("tp")
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _with_scores(marginals: DataFrame) -> DataFrame:
    """F1 as 2 tp / (support + predicted): equal to the harmonic mean, 0 where undefined."""
    return marginals.withColumns(
        {
            "precision": _ratio(F.col("tp"), F.col("predicted")),
            "recall": _ratio(F.col("tp"), F.col("support")),
            "f1": _ratio(2.0 * F.col("tp"), F.col("support") + F.col("predicted")),
        }
    )


def per_class_metrics(df: DataFrame, n_classes: int) -> DataFrame:
    """Precision, recall, F1 and support for classes 0 .. K-1, 0 where undefined."""
    classes = df.sparkSession.range(n_classes).select(F.col("id").cast("int").alias("class"))
    marginals = class_marginals(confusion_matrix(df))
    padded = classes.join(marginals, "class", "left").na.fill(0, ["support", "predicted", "tp"])
    return _with_scores(padded).select("class", "precision", "recall", "f1", "support")


def f1_scores(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, F1 weighted by true support, and F1 macro over labels seen in y or pred."""
    classes = _with_scores(class_marginals(confusion_matrix(df, by), by))
    n = F.sum("support")
    return classes.groupBy(*by).agg(
        n.alias("n"),
        (F.sum("tp") / n).alias("accuracy"),
        (F.sum(F.col("f1") * F.col("support")) / n).alias("f1_weighted"),
        F.avg("f1").alias("f1_macro"),
    )


def classification_report(df: DataFrame) -> DataFrame:
    """One row per class, then accuracy, macro average and weighted average."""
    classes = _with_scores(class_marginals(confusion_matrix(df)))
    rows = classes.select(F.col("class").cast("string").alias("row"), "precision", "recall", "f1", "support")
    n = F.sum("support")
    scores = ("precision", "recall", "f1")
    summary = classes.agg(
        n.alias("n"), (F.sum("tp") / n).alias("accuracy"),
        *[F.avg(c).alias(f"macro_{c}") for c in scores],
        *[(F.sum(F.col(c) * F.col("support")) / n).alias(f"weighted_{c}") for c in scores],
    )
    totals = summary.select(
        F.explode(
            F.array(
                F.struct(F.lit("accuracy").alias("row"), *[F.col("accuracy").alias(c) for c in scores]),
                F.struct(F.lit("macro avg").alias("row"), *[F.col(f"macro_{c}").alias(c) for c in scores]),
                F.struct(F.lit("weighted avg").alias("row"), *[F.col(f"weighted_{c}").alias(c) for c in scores]),
            )
        ).alias("t"),
        "n",
    ).select("t.*", F.col("n").alias("support"))
    return rows.unionByName(totals)


def log_loss(df: DataFrame) -> DataFrame:
    return df.agg(F.avg(V.nll(F.col("p"), F.col("y"))).alias("log_loss"))


def brier_multiclass(df: DataFrame) -> DataFrame:
    return df.agg(F.avg(V.brier(F.col("p"), F.col("y"))).alias("brier"))


def calibration_bin(conf: Column, n_bins: int, closed: str) -> Column:
    """Bin id: "right" bins are (lo, hi], confidence 0 gets -1; "left" bins are [lo, hi), last closed."""
    if closed == "right":
        return F.least(F.ceil(conf * n_bins) - 1, F.lit(n_bins - 1)).cast("int")
    return F.least(F.floor(conf * n_bins), F.lit(n_bins - 1)).cast("int")


def _bins(df: DataFrame, n_bins: int, closed: str, by: Sequence[str] = ()) -> DataFrame:
    return (
        df.select(*by, "conf", "correct", calibration_bin(F.col("conf"), n_bins, closed).alias("bin"))
        .groupBy(*by, "bin")
        .agg(F.count("*").alias("size"), F.avg(F.col("correct").cast("double")).alias("accuracy"),
             F.avg("conf").alias("confidence"))
    )


def ece(df: DataFrame, n_bins: int = 10, closed: str = "right", by: Sequence[str] = ()) -> DataFrame:
    """Expected calibration error; rows in no bin still count in the denominator."""
    gap = F.when(F.col("bin") >= 0, F.col("size") * F.abs(F.col("accuracy") - F.col("confidence"))).otherwise(0.0)
    return _bins(df, n_bins, closed, by).groupBy(*by).agg((F.sum(gap) / F.sum("size")).alias("ece"))


def ece_right_closed(df: DataFrame, n_bins: int = 10) -> DataFrame:
    return ece(df, n_bins, "right")


def ece_left_closed(df: DataFrame, n_bins: int = 10) -> DataFrame:
    return ece(df, n_bins, "left")


def reliability_bins(df: DataFrame, n_bins: int = 10, closed: str = "right") -> DataFrame:
    """Centre, accuracy, confidence and size of every bin; empty bins are kept as 0."""
    bins = df.sparkSession.range(n_bins).select(F.col("id").cast("int").alias("bin"))
    filled = bins.join(_bins(df, n_bins, closed), "bin", "left").na.fill(0, ["size", "accuracy", "confidence"])
    return filled.select("bin", ((F.col("bin") + 0.5) / n_bins).alias("center"), "accuracy", "confidence", "size")


def _histogram(df: DataFrame, value: str, groups: Sequence[str], n_bins: int) -> DataFrame:
    """Counts and densities per group over equal bins of [0, 1]; empty bins are kept.

    Bins are counted first; totals and padding then touch only the counts.
    """
    cells = df.select(*groups, F.col(value).alias("v"), calibration_bin(F.col(value), n_bins, "left").alias("bin"))
    counts = cells.groupBy(*groups, "bin").agg(F.count("*").alias("n"), F.sum("v").alias("s"))
    group = counts.groupBy(*groups).agg(
        F.sum("n").alias("group_n"), (F.sum("s") / F.sum("n")).alias("group_mean"),
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("by_bin"),
    )
    padded = group.select(
        *groups, "group_n", "group_mean", "by_bin",
        F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))).alias("bin"),
    )
    n = F.coalesce(F.try_element_at("by_bin", F.col("bin")), F.lit(0))
    return padded.select(
        *groups, "bin", n.alias("n"), (n * float(n_bins) / F.col("group_n")).alias("density"), "group_n", "group_mean"
    )


def confidence_histogram(df: DataFrame, n_bins: int = 30) -> DataFrame:
    return _histogram(df, "conf", ["correct"], n_bins).drop("group_mean")


def margin_histogram(df: DataFrame, n_bins: int = 30) -> DataFrame:
    return _histogram(df, "margin", ["correct"], n_bins)


def one_vs_rest_histogram(df: DataFrame, classes: DataFrame | Sequence[int], n_bins: int = 30) -> DataFrame:
    """Density of p[c] for rows of class c and for the others, with the F1 of c.

    ``classes`` are the few classes to inspect, as numbers or as the rows of hard_classes.
    """
    if isinstance(classes, DataFrame):
        wanted = classes.agg(F.collect_list("class")).scalar()
    else:
        wanted = F.array(*[F.lit(int(c)) for c in classes])
    per_class = F.transform(F.col("_wanted"), lambda c: F.struct(c.alias("class"), V.p_of(F.col("p"), c).alias("p_c")))
    exploded = df.select("y", "p", wanted.alias("_wanted")).select("y", F.explode(per_class).alias("s")).select(
        F.col("s.class").alias("class"), (F.col("y") == F.col("s.class")).alias("positive"), F.col("s.p_c").alias("p_c")
    )
    scores = _with_scores(class_marginals(confusion_matrix(df))).select("class", "f1")
    hist = _histogram(exploded, "p_c", ["class", "positive"], n_bins).drop("group_mean")
    return hist.join(scores, "class", "left").na.fill(0.0, ["f1"])


def _by_class_and(cells: DataFrame, other: Column, measures: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Sums per class and, of the ``measures``, per ``other`` number, from the same cells.

    Each cell (y, pred, n) counts for its true class, its predicted class (kind "class")
    and its other number (kind "other"). One grouping serves both, so the rows below are
    read once whatever is asked of the result.
    """
    zero = F.lit(0).cast("long")
    nothing = [F.lit(0).cast("double").alias(m) for m in measures]
    hit = F.when(F.col("y") == F.col("pred"), F.col("n")).otherwise(zero)

    def record(kind: str, number: Column, support: Column, predicted: Column, tp: Column, extra: Sequence[Column]) -> Column:
        return F.struct(F.lit(kind).alias("kind"), number.cast("int").alias("id"), support.alias("support"),
                        predicted.alias("predicted"), tp.alias("tp"), *extra)

    records = cells.select(*by, F.explode(F.array(
        record("class", F.col("y"), F.col("n"), zero, hit, nothing),
        record("class", F.col("pred"), zero, F.col("n"), zero, nothing),
        record("other", other, zero, zero, zero, [c.cast("double").alias(m) for m, c in measures.items()]),
    )).alias("r")).select(*by, "r.*")
    return _with_scores(records.groupBy(*by, "kind", "id").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "tp", *measures)]))


def _f1_columns() -> tuple[Column, Column, Column, Column]:
    """n, accuracy, weighted F1 and macro F1 over the class records."""
    n = F.sum("support")
    macro = F.avg(F.when(F.col("kind") == "class", F.col("f1")))
    return n, F.sum("tp") / n, F.sum(F.col("f1") * F.col("support")) / n, macro


def stacking_analysis(df: DataFrame) -> DataFrame:
    """What fusion adds over the two modalities; ``df`` has y, p_text, p_image, pred_meta."""
    text, image = V.argmax(F.col("p_text")), V.argmax(F.col("p_image"))
    picked = F.when((F.col("t") != F.col("y")) & (F.col("i") == F.col("y")), F.col("i")).otherwise(F.col("t"))
    outcomes = (
        df.select("y", "pred_meta", text.alias("t"), image.alias("i"))
        .select(
            "y",
            (F.col("t") == F.col("y")).alias("t_ok"),
            (F.col("i") == F.col("y")).alias("i_ok"),
            (F.col("pred_meta") == F.col("y")).alias("m_ok"),
            (F.col("t") == F.col("i")).alias("agree"),
            picked.alias("pred"),
        )
        .groupBy("y", "t_ok", "i_ok", "m_ok", "agree", "pred")
        .agg(F.count("*").alias("n"))
    )
    t, i, m = F.col("t_ok"), F.col("i_ok"), F.col("m_ok")
    conditions = {
        "text_only_correct": t & ~i,
        "image_only_correct": ~t & i,
        "both_correct": t & i,
        "both_wrong": ~t & ~i,
        "meta_saves_when_both_wrong": m & ~t & ~i,
        "meta_loses_when_one_correct": ~m & (t | i),
    }
    measures = {name: F.when(c, F.col("n")).otherwise(0) for name, c in {"agreeing": F.col("agree"), **conditions}.items()}
    n, _accuracy, weighted, macro = _f1_columns()
    return _by_class_and(outcomes, F.lit(0), measures).agg(
        (F.sum("agreeing") / n).alias("agreement_text_image"),
        *[F.sum(c).cast("long").alias(c) for c in conditions],
        macro.alias("oracle_f1_macro"), weighted.alias("oracle_f1_weighted"),
    )


def drift_metrics(df: DataFrame) -> DataFrame:
    """Mean and population std of predictive entropy and of the margin."""
    rows = df.select(V.entropy(F.col("p"), eps=1e-12, normalized=False).alias("h"), V.margin(F.col("p")).alias("m"))
    return rows.agg(
        F.avg("h").alias("entropy_mean"), F.stddev_pop("h").alias("entropy_std"),
        F.avg("m").alias("margin_mean"), F.stddev_pop("m").alias("margin_std"),
    )


def psi(target: DataFrame, reference: DataFrame, n_classes: int, eps: float = 1e-6) -> DataFrame:
    """Population stability index of the predicted-class shares, every class present."""

    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.col("pred").alias("class")).agg(F.count("*").alias(name))

    classes = target.sparkSession.range(n_classes).select(F.col("id").cast("int").alias("class"))
    joined = (
        classes.join(counts(target, "n_t"), "class", "left").join(counts(reference, "n_r"), "class", "left")
        .na.fill(0, ["n_t", "n_r"])
    )
    everything = Window.partitionBy()

    def share(name: str) -> Column:
        return (F.col(name) + eps) / F.sum(F.col(name) + eps).over(everything)

    shares = joined.select(share("n_t").alias("a"), share("n_r").alias("b"))
    return shares.agg(F.sum((F.col("a") - F.col("b")) * F.ln(F.col("a") / F.col("b"))).alias("psi"))


def modality_oof_metrics(df: DataFrame) -> DataFrame:
    """f1_scores of each modality's out-of-fold probabilities."""
    rows = df.select(
        "y",
        F.explode(
            F.array(
                F.struct(F.lit("text").alias("modality"), V.argmax(F.col("p_text")).alias("pred")),
                F.struct(F.lit("image").alias("modality"), V.argmax(F.col("p_image")).alias("pred")),
            )
        ).alias("m"),
    ).select("y", "m.*")
    return f1_scores(rows, ["modality"])


def evaluation_summary(df: DataFrame, n_bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, F1s, log loss, Brier and ECE of (y, p) rows, per group of ``by``.

    One grouping on (y, pred, bin) holds everything the metrics need, so a wide prediction
    table is read and shuffled once.
    """
    rows = scored(df).select(
        *by, "y", "pred", "conf", "correct",
        calibration_bin(F.col("conf"), n_bins, "right").alias("bin"),
        V.nll(F.col("p"), F.col("y")).alias("nll"), V.brier(F.col("p"), F.col("y")).alias("brier"),
    )
    cells = rows.groupBy(*by, "y", "pred", "bin").agg(
        F.count("*").alias("n"), F.sum("conf").alias("s_conf"),
        F.count_if("correct").alias("n_correct"),
        F.sum("nll").alias("s_nll"), F.sum("brier").alias("s_brier"),
    )
    sums = ("s_conf", "n_correct", "s_nll", "s_brier")
    both = _by_class_and(cells, F.col("bin"), {c: F.col(c) for c in sums}, by)
    n, accuracy, weighted, macro = _f1_columns()
    gap = F.when((F.col("kind") == "other") & (F.col("id") >= 0), F.abs(F.col("n_correct") - F.col("s_conf"))).otherwise(0.0)
    return both.groupBy(*by).agg(
        n.alias("n"), accuracy.alias("accuracy"), weighted.alias("f1_weighted"), macro.alias("f1_macro"),
        (F.sum("s_nll") / n).alias("log_loss"), (F.sum("s_brier") / n).alias("brier"), (F.sum(gap) / n).alias("ece"),
    )


def top_confusions(df: DataFrame, k: int = 10) -> DataFrame:
    pairs = confusion_matrix(df).where(F.col("y") != F.col("pred"))
    return pairs.orderBy(F.desc("n"), "y", "pred").limit(k)


def hard_classes(df: DataFrame, k: int = 6, min_support: int = 10) -> DataFrame:
    """Classes of lowest F1 among those with enough rows."""
    classes = _with_scores(class_marginals(confusion_matrix(df)))
    return classes.where(F.col("support") >= min_support).select("class", "f1", "support").orderBy("f1", "class").limit(k)


def top_features(df: DataFrame, n: int) -> DataFrame:
    return df.orderBy(F.desc("gain"), "feature").limit(n)
