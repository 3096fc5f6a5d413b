import math

import pytest
from pyspark.sql import functions as F

from catalogflow.functions import vectors as V
from catalogflow.operators import evaluation as ev
from catalogflow.operators import quality as ql


def frame(spark, data):
    floats = [(y, [float(x) for x in p]) for y, p in data]
    return ev.scored(spark.createDataFrame(floats, "y int, p array<double>"))


def test_first_maximum_wins_a_tie(spark):
    r = frame(spark, [(0, [0.5, 0.5])]).first()
    assert (r["pred"], r["conf"], r["margin"]) == (0, 0.5, 0.0)


def test_bins_on_edges_and_empty_bins(spark):
    df = frame(spark, [(0, [0.5, 0.5]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (0, [0.75, 0.25])])
    right = {r["bin"]: r for r in ev.reliability_bins(df, 4, "right").collect()}
    left = {r["bin"]: r for r in ev.reliability_bins(df, 4, "left").collect()}
    assert [right[i]["size"] for i in range(4)] == [0, 1, 1, 2]
    assert [left[i]["size"] for i in range(4)] == [0, 0, 1, 3]
    assert right[0]["accuracy"] == 0.0 and right[3]["accuracy"] == 0.5
    assert ev.ece_right_closed(df, 4).first()["ece"] == pytest.approx((0.5 + 0.25 + 1.0) / 4)


def test_zero_confidence_is_in_no_right_closed_bin(spark):
    df = frame(spark, [(0, [0.0, 0.0]), (0, [1.0, 0.0])])
    assert sum(r["size"] for r in ev.reliability_bins(df, 10).collect()) == 1
    assert ev.ece_right_closed(df).first()["ece"] == 0.0


def test_absent_classes(spark):
    # Class 2 is never predicted, class 1 never true, class 3 neither.
    df = frame(spark, [(0, [1.0, 0, 0, 0]), (2, [0, 1.0, 0, 0]), (0, [0.9, 0.1, 0, 0])])
    per = {r["class"]: r for r in ev.per_class_metrics(df, 4).collect()}
    assert (per[0]["f1"], per[1]["f1"], per[2]["f1"], per[3]["f1"]) == (1.0, 0.0, 0.0, 0.0)
    assert [per[c]["support"] for c in range(4)] == [2, 0, 1, 0]
    s = ev.f1_scores(df).first()
    assert s["accuracy"] == pytest.approx(2 / 3)
    assert s["f1_macro"] == pytest.approx(1 / 3)  # over the labels 0, 1 and 2
    assert s["f1_weighted"] == pytest.approx(2 / 3)


def test_losses_by_hand(spark):
    df = frame(spark, [(0, [0.8, 0.2]), (1, [0.6, 0.4])])
    assert ev.log_loss(df).first()[0] == pytest.approx(-(math.log(0.8) + math.log(0.4)) / 2)
    assert ev.brier_multiclass(df).first()[0] == pytest.approx((0.08 + 0.72) / 2)
    assert ev.log_loss(frame(spark, [(1, [1.0, 0.0])])).first()[0] == pytest.approx(-math.log(math.ulp(1.0)))


def test_all_correct_histogram_has_one_group(spark):
    h = ev.confidence_histogram(frame(spark, [(0, [1.0, 0.0]), (1, [0.2, 0.8])])).collect()
    assert {r["correct"] for r in h} == {True} and len(h) == 30
    assert sum(r["density"] for r in h) / 30 == pytest.approx(1.0)


def test_report_rows(spark):
    report = {r["row"]: r for r in ev.classification_report(frame(spark, [(0, [1.0, 0]), (1, [1.0, 0])])).collect()}
    assert set(report) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert report["accuracy"]["f1"] == 0.5 and report["macro avg"]["precision"] == 0.25
    assert report["0"]["recall"] == 1.0 and report["weighted avg"]["support"] == 2


def test_stacking_counts(spark):
    t, i = [1.0, 0.0], [0.0, 1.0]
    df = spark.createDataFrame([(0, t, i, 0), (1, t, i, 0), (0, t, t, 0), (1, t, t, 1)],
                               "y int, p_text array<double>, p_image array<double>, pred_meta int")
    r = ev.stacking_analysis(df).first()
    assert r["agreement_text_image"] == 0.5
    assert (r["text_only_correct"], r["image_only_correct"], r["both_correct"], r["both_wrong"]) == (1, 1, 1, 1)
    assert (r["meta_saves_when_both_wrong"], r["meta_loses_when_one_correct"]) == (1, 1)


def test_summary_equals_the_single_metrics(spark):
    data = [(i % 3, [0.1 + 0.2 * (i % 4), 0.3, 0.6 - 0.2 * (i % 4)]) for i in range(40)]
    df = frame(spark, data)
    r = ev.evaluation_summary(df.select("y", "p")).first()
    f = ev.f1_scores(df).first()
    assert r["f1_weighted"] == pytest.approx(f["f1_weighted"]) and r["f1_macro"] == pytest.approx(f["f1_macro"])
    assert r["ece"] == pytest.approx(ev.ece_right_closed(df).first()[0])
    assert r["log_loss"] == pytest.approx(ev.log_loss(df).first()[0])
    assert r["brier"] == pytest.approx(ev.brier_multiclass(df).first()[0])


def test_psi_of_equal_and_missing_classes(spark):
    a = spark.createDataFrame([(0,), (1,)], "pred int")
    assert ev.psi(a, a, 3).first()[0] == pytest.approx(0.0)
    assert ev.psi(a, a.where("pred = 0"), 3).first()[0] > 1.0


def test_vector_extremes(spark):
    df = spark.createDataFrame([([0.25] * 4,), ([1.0, 0.0, 0.0, 0.0],)], "p array<double>")
    got = [r[0] for r in df.select(V.entropy(F.col("p"))).collect()]
    assert got[0] == pytest.approx(1.0, abs=1e-6) and got[1] == pytest.approx(0.0, abs=1e-6)
    kl = df.select(V.kl(F.col("p"), F.col("p"))).collect()
    assert all(abs(r[0]) < 1e-9 for r in kl)
    assert [r[0] for r in df.select(V.apply_temperature(F.col("p"), 1.0)).collect()] == [[0.25] * 4, [1.0, 0.0, 0.0, 0.0]]


def test_bad_probabilities(spark):
    df = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.4]), (3, [float("nan"), 1.0]), (4, [1.0, None])], "id int, p array<double>")
    assert sorted(r["id"] for r in ql.bad_probabilities(df).collect()) == [2, 3, 4]
