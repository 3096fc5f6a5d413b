import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalogflow.functions import vectors as V
from catalogflow.operators import learning as ln
from catalogflow.operators import quality as ql
from catalogflow.plans import standins as st
from catalogflow.schemas import DERIVED

FOLDER = "/root/testdata/sf0.001"
K = 27


@pytest.fixture(scope="module")
def dirichlet(spark):
    rng = np.random.default_rng(42)
    p = rng.dirichlet([0.1] * K, 100)
    data = [(int(y), [float(v) for v in row]) for y, row in zip(rng.integers(0, K, 100), p)]
    return data, spark.createDataFrame(data, "y int, p array<double>").repartition(4)


def nll(data, t):
    total = 0.0
    for y, p in data:
        z = np.log(np.clip(p, 1e-7, 1.0)) / t
        e = np.exp(z - z.max())
        total -= math.log(e[y] / e.sum() + 1e-7)
    return total / len(data)


def test_temperature_minimizes_the_loss(dirichlet):
    data, df = dirichlet
    t = ln.fit_temperature(df)
    assert 0.1 <= t <= 10.0
    grid = np.exp(np.linspace(math.log(0.1), math.log(10.0), 4000))
    best = min(nll(data, g) for g in grid)
    assert nll(data, t) <= best + 1e-6
    assert nll(data, t) <= nll(data, 1.0)


def test_temperature_losses_match_numpy(dirichlet):
    data, df = dirichlet
    for r in ln.temperature_nll(df, [0.3, 1.0, 5.0]).collect():
        assert r["nll"] == pytest.approx(nll(data, r["temperature"]), rel=1e-9)


def test_calibrated_vectors_and_derived_features(dirichlet):
    _, df = dirichlet
    calibrated = df.withColumn("q", V.apply_temperature(F.col("p"), 1.8))
    assert ql.bad_probabilities(calibrated, "q").count() == 0
    features = calibrated.select(*V.derived_features(F.col("p"), F.col("q")))
    assert features.columns == DERIVED
    finite = [F.col(c).isNotNull() & ~F.isnan(c) for c in DERIVED]
    condition = finite[0]
    for f in finite[1:]:
        condition = condition & f
    assert features.where(condition).count() == 100


@pytest.fixture(scope="module")
def stacked(spark):
    rows = st.vectors(spark, FOLDER)
    model, oof = ln.stacking_fit(rows, "productid", "label", st.N_CLASSES, {"text": 0.1, "image": 0.1}, k=2,
                                 max_iter=10, n_trials=2, space={"numTrees": ("int", 3, 5), "maxDepth": ("int", 3, 4)})
    return rows, model, oof


def test_out_of_fold_covers_every_row_once(stacked):
    rows, _, oof = stacked
    assert oof.count() == rows.count() == oof.select("productid").distinct().count()
    for p in ("p_text", "p_image"):
        assert ql.bad_probabilities(oof, p).count() == 0


def test_stacked_model_gives_distributions_and_beats_chance(stacked):
    rows, model, _ = stacked
    scored = ln.stacking_predict(model, rows)
    assert ql.bad_probabilities(scored).count() == 0
    assert scored.agg(F.avg((F.col("pred") == F.col("label")).cast("double"))).first()[0] > 1.5 / st.N_CLASSES
    assert model.trials.count() == 2 and set(model.params) == {"numTrees", "maxDepth"}


def test_importances_follow_the_meta_layout(stacked):
    _, model, _ = stacked
    names = ln.meta_feature_names(st.N_CLASSES, [f"t{i}" for i in range(12)], DERIVED)
    table = ln.tree_importance(model.meta, names)
    assert table.count() == len(names) == 2 * st.N_CLASSES + 12 + 8
    assert table.agg(F.sum("gain")).first()[0] == pytest.approx(1.0)
    assert ln.coef_importance(model.text).count() == 32


def test_class_unseen_in_training_gets_zero(spark):
    df = spark.createDataFrame([(i, i % 2, [float(i % 2), 1.0 - i % 2 + 0.01 * i]) for i in range(20)], "id int, y int, v array<double>")
    model = ln.base_classifier(df, "v", "y", 1.0, 5)
    p = ln.class_probabilities(model, df, "v", 4, "p").first()["p"]
    assert len(p) == 4 and p[2] == p[3] == 0.0 and sum(p) == pytest.approx(1.0)


def test_boosted_probabilities_add_up(spark):
    df = spark.createDataFrame([(i, i % 3, [float(i % 3), float(i)]) for i in range(30)], "id int, y int, meta array<double>")
    model = ln.boosted_meta_classifier(df, "y", 3, {"maxIter": 1, "maxDepth": 2})
    scored = ln.meta_predict(model, df, 3)
    assert ql.bad_probabilities(scored).count() == 0
    assert scored.where("pred = y").count() == 30


def test_search_space_is_seeded():
    space = {"a": ("int", 1, 9), "b": ("log", 0.01, 1.0), "c": ("float", 0.0, 1.0)}
    assert ln.sample_space(space, 3, 1) == ln.sample_space(space, 3, 1)
    assert ln.sample_space(space, 3, 1) != ln.sample_space(space, 3, 2)
