"""Stacked classifier on Spark ML: base models, calibration, meta model and search."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from catalogflow.functions import vectors as V
from catalogflow.operators.aggregates import trial_summary
from catalogflow.operators.evaluation import f1_scores
from catalogflow.operators.splits import stratified_kfold
from catalogflow.session import materialize

GRID_POINTS = 24
MODALITIES = ("text", "image")
PARALLEL_FITS = 4


def in_parallel(spark: SparkSession, tasks: Sequence[Callable[[], object]], parallelism: int = PARALLEL_FITS) -> list:
    """Independent fits as concurrent Spark jobs, results in the order of the tasks."""
    inherit = inheritable_thread_target(spark)
    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        return pool.map(lambda task: task(), [inherit(t) for t in tasks])


def base_classifier(train: DataFrame, vector: str, label: str, c: float, max_iter: int = 100,
                    n: int | None = None) -> PipelineModel:
    """Standardize, then multinomial logistic regression with L2 strength 1 / (C n)."""
    rows = train.select(array_to_vector(F.col(vector).cast("array<double>")).alias("_x"), F.col(label).cast("double").alias("_y"))
    n = n or rows.count()
    scale = StandardScaler(inputCol="_x", outputCol="_scaled", withMean=True, withStd=True)
    logistic = LogisticRegression(
        featuresCol="_scaled", labelCol="_y", family="multinomial", regParam=1.0 / (c * n),
        elasticNetParam=0.0, standardization=False, maxIter=max_iter,
        probabilityCol="_p", rawPredictionCol="_raw", predictionCol="_pred",
    )
    return Pipeline(stages=[scale, logistic]).fit(rows)


def class_probabilities(model: PipelineModel, df: DataFrame, vector: str, n_classes: int, output: str) -> DataFrame:
    """Adds the model's probabilities as an array of ``n_classes`` entries.

    A model that never saw the last classes has a shorter vector; the missing ones get 0.
    """
    known = model.stages[-1].numClasses
    rows = df.withColumn("_x", array_to_vector(F.col(vector).cast("array<double>")))
    scored = model.transform(rows).withColumn("_pa", vector_to_array("_p"))
    p = V.align_classes(F.col("_pa"), range(known), n_classes)
    return scored.withColumn(output, p).drop("_x", "_scaled", "_raw", "_p", "_pred", "_pa")


def oof_probabilities(df: DataFrame, key: str, label: str, n_classes: int, c: Mapping[str, float],
                      k: int = 5, seed: int = 42, max_iter: int = 100) -> DataFrame:
    """Out-of-fold ``p_text`` and ``p_image``: each row is scored by models that never saw it.

    ``df`` has ``text_vector`` and ``image_vector``. The folds are written once, a folder each,
    so a held-out scan reads one of them; so is the result, since calibration, features, search and refit all read it.
    """
    folded = materialize(stratified_kfold(df, label, key, k, seed), "folds", ["fold"])
    sizes = {r["fold"]: r["count"] for r in folded.groupBy("fold").count().collect()}
    total = sum(sizes.values())

    def fit(fold: int, m: str) -> PipelineModel:
        train = folded.where(F.col("fold") != fold)
        return base_classifier(train, f"{m}_vector", label, c[m], max_iter, total - sizes.get(fold, 0))

    jobs = [(fold, m) for fold in range(k) for m in MODALITIES]
    models = dict(zip(jobs, in_parallel(df.sparkSession, [lambda j=j: fit(*j) for j in jobs])))
    parts = []
    for fold in range(k):
        held_out = folded.where(F.col("fold") == fold)
        for m in MODALITIES:
            held_out = class_probabilities(models[fold, m], held_out, f"{m}_vector", n_classes, f"p_{m}")
        parts.append(held_out)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return materialize(result, "oof")


def vector_size(df: DataFrame, p: str) -> int:
    row = df.select(F.size(p)).first()
    return row[0] if row else 0


def temperature_nll(df: DataFrame, temperatures: Sequence[float], y: str = "y", p: str = "p",
                    n_classes: int | None = None, eps: float = V.PROB_EPS) -> DataFrame:
    """Mean of -ln(softmax(ln p / T)[y] + eps) at each temperature, all in one pass.

    The log-probabilities, shifted by their maximum, become one column per class, so the
    sums over classes are plain arithmetic and compile; loops over arrays would not.
    """
    k = n_classes or vector_size(df, p)
    logs = df.select(F.col(y).alias("_y"), V.log_clipped(F.col(p)).alias("_l")).select(
        "_l", (F.get("_l", F.col("_y")) - F.array_max("_l")).alias("_ly"), F.array_max("_l").alias("_m"))
    wide = logs.select("_ly", *[(F.get("_l", F.lit(i)) - F.col("_m")).alias(f"_l{i}") for i in range(k)])

    def nll(t: float) -> str:
        total = " + ".join(f"exp(_l{i} / {t!r}D)" for i in range(k))
        return f"avg(-ln(exp(_ly / {t!r}D) / ({total}) + {eps!r}D))"

    means = wide.selectExpr(*[f"{nll(float(t))} AS t{i}" for i, t in enumerate(temperatures)])
    pairs = [F.struct(F.lit(float(t)).alias("temperature"), F.col(f"t{i}").alias("nll")) for i, t in enumerate(temperatures)]
    return means.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")


def fit_temperature(df: DataFrame, y: str = "y", p: str = "p", n_classes: int | None = None, rounds: int = 3) -> float:
    """Temperature in [0.1, 10] of least NLL, 1 unless it beats the uncalibrated NLL.

    The NLL is convex in 1 / T, so a coarse grid and two finer ones around its best point
    close in on the minimum; each round is one aggregation.
    """
    grid = [0.1 * 100.0 ** (i / GRID_POINTS) for i in range(GRID_POINTS + 1)]
    n_classes = n_classes or vector_size(df, p)
    baseline, best_t, best = None, 1.0, math.inf
    for _ in range(rounds):
        tried = [*grid, 1.0]
        losses = [r["nll"] for r in temperature_nll(df, tried, y, p, n_classes).collect()]
        baseline = losses[-1]
        i = min(range(len(grid)), key=losses.__getitem__)
        best_t, best = grid[i], losses[i]
        low, high = grid[max(i - 1, 0)], grid[min(i + 1, GRID_POINTS)]
        grid = [low + (high - low) * j / GRID_POINTS for j in range(GRID_POINTS + 1)]
    return best_t if best < baseline else 1.0


def meta_rows(df: DataFrame, t_text: float, t_image: float, tabular: str = "tabular") -> DataFrame:
    """Calibrated probabilities, derived features and the meta vector, in the fixed order."""
    calibrated = df.withColumns({
        "p_text_cal": V.apply_temperature(F.col("p_text"), t_text),
        "p_image_cal": V.apply_temperature(F.col("p_image"), t_image),
    })
    derived = F.array(*V.derived_features(F.col("p_text_cal"), F.col("p_image_cal")))
    meta = V.meta_vector(F.col("p_text_cal"), F.col("p_image_cal"), F.col(tabular).cast("array<double>"), derived)
    return calibrated.withColumn("meta", meta)


def meta_classifier(train: DataFrame, label: str, params: Mapping[str, float] | None = None,
                    vector: str = "meta") -> PipelineModel:
    """Random forest on the meta vector, the native multi-class trees of Spark ML."""
    params = dict(params or {})
    seed = int(params.pop("seed", 42))
    rows = train.select(array_to_vector(vector).alias("_x"), F.col(label).cast("double").alias("_y"))
    trees = RandomForestClassifier(featuresCol="_x", labelCol="_y", seed=seed, probabilityCol="_p",
                                   rawPredictionCol="_raw", predictionCol="_pred", **params)
    return Pipeline(stages=[trees]).fit(rows)


def boosted_meta_classifier(train: DataFrame, label: str, n_classes: int, params: Mapping[str, float] | None = None,
                            vector: str = "meta") -> PipelineModel:
    """Gradient-boosted trees, binary in Spark ML, fitted one class against the rest."""
    params = dict(params or {})
    seed = int(params.pop("seed", 42))
    rows = train.select(array_to_vector(vector).alias("_x"), F.col(label).alias("_label"))

    def fit(c: int) -> GBTClassificationModel:
        trees = GBTClassifier(featuresCol="_x", labelCol="_y", seed=seed, predictionCol=f"_pred{c}", **params)
        trees.setProbabilityCol(f"_p{c}").setRawPredictionCol(f"_raw{c}")
        return trees.fit(rows.withColumn("_y", (F.col("_label") == c).cast("double")))

    models = in_parallel(train.sparkSession, [lambda c=c: fit(c) for c in range(n_classes)])
    return PipelineModel(models)


def meta_predict(model: PipelineModel, rows: DataFrame, n_classes: int, vector: str = "meta") -> DataFrame:
    """Adds ``p`` and ``pred``; one-against-rest probabilities are normalized to add up to one."""
    scored = model.transform(rows.withColumn("_x", array_to_vector(vector)))
    if isinstance(model.stages[-1], GBTClassificationModel):
        parts = range(len(model.stages))
        raw = F.array(*[F.get(vector_to_array(f"_p{c}"), F.lit(1)) for c in parts])
        p = V.let(raw, lambda r: V.let(V.vsum(r), lambda total: F.transform(r, lambda x: x / total)))
        used = [f"{c}{i}" for c in ("_p", "_raw", "_pred") for i in parts]
    else:
        scored = scored.withColumn("_pa", vector_to_array("_p"))
        p = V.align_classes(F.col("_pa"), range(model.stages[-1].numClasses), n_classes)
        used = ["_p", "_raw", "_pred", "_pa"]
    return scored.withColumn("p", p).withColumn("pred", V.argmax(F.col("p"))).drop("_x", *used)


def sample_space(space: Mapping[str, tuple], n_trials: int, seed: int) -> list[dict]:
    """Seeded settings: ("int", lo, hi), ("float", lo, hi) or ("log", lo, hi) per parameter."""
    rng = random.Random(seed)

    def draw(kind: str, low: float, high: float):
        if kind == "int":
            return rng.randint(low, high)
        if kind == "log":
            return math.exp(rng.uniform(math.log(low), math.log(high)))
        return rng.uniform(low, high)

    return [{name: draw(*bounds) for name, bounds in space.items()} for _ in range(n_trials)]


def param_search(rows: DataFrame, label: str, space: Mapping[str, tuple], n_classes: int, n_trials: int = 4,
                 k: int = 5, penalty: float = 0.25, seed: int = 42, parallelism: int = PARALLEL_FITS,
                 fold: str = "fold") -> tuple[dict, DataFrame]:
    """k-fold weighted F1 of each setting; returns the best setting and the trial table.

    Settings and folds are independent Spark jobs, submitted a few at a time.
    """
    settings = sample_space(space, n_trials, seed)

    def score(trial: int, held: int) -> tuple[int, int, float, int]:
        model = meta_classifier(rows.where(F.col(fold) != held), label, settings[trial])
        scored = meta_predict(model, rows.where(F.col(fold) == held), n_classes)
        f1 = f1_scores(scored.select(F.col(label).alias("y"), "pred")).first()["f1_weighted"]
        return trial, held, float(f1), int(settings[trial].get("numTrees", 20))

    jobs = [(t, f) for t in range(n_trials) for f in range(k)]
    scores = in_parallel(rows.sparkSession, [lambda j=j: score(*j) for j in jobs], parallelism)
    table = rows.sparkSession.createDataFrame(scores, "trial int, fold int, score double, best_iter int")
    summary = trial_summary(table, penalty)
    best = summary.orderBy(F.desc("objective"), "trial").first()["trial"]
    return settings[best], summary


@dataclass
class StackedModel:
    """The fitted parts; ``transform`` applies them to rows with the two vectors and tabular."""

    text: PipelineModel
    image: PipelineModel
    t_text: float
    t_image: float
    meta: PipelineModel
    n_classes: int
    params: dict
    trials: DataFrame | None

    def transform(self, df: DataFrame) -> DataFrame:
        rows = class_probabilities(self.text, df, "text_vector", self.n_classes, "p_text")
        rows = class_probabilities(self.image, rows, "image_vector", self.n_classes, "p_image")
        return meta_predict(self.meta, meta_rows(rows, self.t_text, self.t_image), self.n_classes)


# Settings tried by default; a single value is used as it is.
DEFAULT_SPACE = {"numTrees": ("int", 10, 30), "maxDepth": ("int", 4, 8), "minInstancesPerNode": ("int", 1, 10)}


def stacking_fit(df: DataFrame, key: str, label: str, n_classes: int, c: Mapping[str, float] | None = None,
                 k: int = 5, seed: int = 42, space: Mapping[str, tuple] | None = DEFAULT_SPACE,
                 n_trials: int = 4, params: dict | None = None, max_iter: int = 100,
                 boosted: bool = False) -> tuple[StackedModel, DataFrame]:
    """Out-of-fold base models, temperatures, derived features, search, then a refit on all rows.

    The search is over forest settings; ``boosted`` needs ``params``. Returns the model and
    the out-of-fold table it was calibrated on.
    """
    c = c or {"text": 0.01, "image": 0.1}
    oof = oof_probabilities(df, key, label, n_classes, c, k, seed, max_iter)
    t = {m: fit_temperature(oof, label, f"p_{m}", n_classes) for m in MODALITIES}
    rows = materialize(meta_rows(oof, t["text"], t["image"]).select(key, label, "fold", "meta"), "meta", ["fold"])
    trials = None
    if params is None:
        params, trials = param_search(rows, label, space, n_classes, n_trials, k, seed=seed)
    n = rows.count()

    def final_meta() -> PipelineModel:
        if boosted:
            return boosted_meta_classifier(rows, label, n_classes, params)
        return meta_classifier(rows, label, params)

    base = [lambda m=m: base_classifier(df, f"{m}_vector", label, c[m], max_iter, n) for m in MODALITIES]
    text, image, meta = in_parallel(df.sparkSession, [*base, final_meta])
    return StackedModel(text, image, t["text"], t["image"], meta, n_classes, params, trials), oof


def stacking_predict(model: StackedModel, df: DataFrame) -> DataFrame:
    return model.transform(df)


def pca_baseline(train: DataFrame, label: str, components: Mapping[str, int], params: dict | None = None) -> PipelineModel:
    """Scale and reduce each modality, concatenate, then trees."""
    rows = train.select(
        *[array_to_vector(F.col(f"{m}_vector").cast("array<double>")).alias(f"_{m}") for m in MODALITIES],
        F.col(label).cast("double").alias("_y"),
    )
    stages = []
    for m in MODALITIES:
        stages.append(StandardScaler(inputCol=f"_{m}", outputCol=f"_{m}_scaled", withMean=True, withStd=True))
        stages.append(PCA(k=components[m], inputCol=f"_{m}_scaled", outputCol=f"_{m}_pca"))
    stages.append(VectorAssembler(inputCols=[f"_{m}_pca" for m in MODALITIES], outputCol="_x"))
    stages.append(RandomForestClassifier(featuresCol="_x", labelCol="_y", predictionCol="_pred", probabilityCol="_p",
                                         rawPredictionCol="_raw", seed=42, **(params or {})))
    return Pipeline(stages=stages).fit(rows)


def pca_predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    rows = df
    for m in MODALITIES:
        rows = rows.withColumn(f"_{m}", array_to_vector(F.col(f"{m}_vector").cast("array<double>")))
    scored = model.transform(rows).withColumn("p", vector_to_array("_p")).withColumn("pred", F.col("_pred").cast("int"))
    return scored.drop(*[c for c in scored.columns if c.startswith("_")])


def coef_importance(model: PipelineModel, names: Sequence[str] | None = None) -> DataFrame:
    """Mean |coefficient| over classes per input feature; one row per feature."""
    import numpy as np

    matrix = np.abs(model.stages[-1].coefficientMatrix.toArray()).mean(axis=0)
    names = names or [f"feat_{i}" for i in range(len(matrix))]
    return _spark().createDataFrame([(n, float(g)) for n, g in zip(names, matrix)], "feature string, gain double")


def tree_importance(model: PipelineModel, names: Sequence[str] | None = None) -> DataFrame:
    """Impurity gain per meta feature, and how many splits of the forest use it."""
    import re

    forest = model.stages[-1]
    gains = forest.featureImportances.toArray()
    splits = [0] * len(gains)
    for feature in re.findall(r"If \(feature (\d+)", forest.toDebugString):
        splits[int(feature)] += 1
    names = names or [f"feat_{i}" for i in range(len(gains))]
    rows = [(n, float(g), s) for n, g, s in zip(names, gains, splits)]
    return _spark().createDataFrame(rows, "feature string, gain double, split long")


def meta_feature_names(n_classes: int, tabular: Sequence[str], derived: Sequence[str]) -> list[str]:
    return (
        [f"p_text_class_{i}" for i in range(n_classes)]
        + [f"p_image_class_{i}" for i in range(n_classes)]
        + [f"tab__{t}" for t in tabular]
        + [f"derived__{d}" for d in derived]
    )


def _spark():
    return SparkSession.active()
