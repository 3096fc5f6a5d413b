"""Queries on the stacked classifier and on streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogflow.functions.vectors import argmax
from catalogflow.operators import aggregates as ag
from catalogflow.operators import learning as ln
from catalogflow.operators import splits as sp
from catalogflow.plans import standins as st
from catalogflow.plans.registry import query, r6, s6
from catalogflow.schemas import DERIVED
from catalogflow.session import fresh_path
from catalogflow.streaming import monitoring as mo
from catalogflow.streaming import queue as qu

K = st.N_CLASSES
C = {"text": 0.1, "image": 0.1}
FOREST = {"numTrees": 10, "maxDepth": 5}

# Calibration

NLL = """-ln(exp((lp[y + 1] - m) / t) / list_sum(list_transform(lp, lambda x: exp((x - m) / t))) + 1e-7::DOUBLE)"""
LOGS = """lp0 AS (SELECT y, list_transform(p_text, lambda x: ln(least(greatest(x, 1e-7::DOUBLE), 1.0::DOUBLE))) AS lp FROM pair),
    lp AS (SELECT y, lp, list_max(lp) AS m FROM lp0)"""


@query("temperature_nll", f"""WITH {LOGS}, t AS (SELECT unnest([0.25::DOUBLE, 0.5::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE, 4.0::DOUBLE]) AS t)
    SELECT t AS temperature, {s6(f'avg({NLL})', 'nll')} FROM lp CROSS JOIN t GROUP BY t""", ("pair",))
def _(spark, folder):
    return ln.temperature_nll(st.text_model(spark, folder), [0.25, 0.5, 1.0, 2.0, 4.0]).withColumn("nll", r6("nll"))


def _round(n: int, grid: str) -> str:
    """One search round: losses over ``grid`` (i, t) and the neighbours of the best point."""
    return f"""g{n} AS ({grid}), n{n} AS (SELECT i, any_value(t) AS t, avg({NLL}) AS nll FROM lp CROSS JOIN g{n} GROUP BY i),
    b{n} AS (SELECT i, t, nll FROM n{n} ORDER BY nll, i LIMIT 1),
    s{n} AS (SELECT (SELECT t FROM n{n} WHERE i = greatest(b.i - 1, 0)) AS low, (SELECT t FROM n{n} WHERE i = least(b.i + 1, 24)) AS high FROM b{n} b)"""


@query("fit_temperature", f"""WITH {LOGS}, {_round(1, 'SELECT i, 0.1::DOUBLE * power(100.0::DOUBLE, i / 24.0::DOUBLE) AS t FROM (SELECT unnest(range(25)) AS i)')},
    {_round(2, 'SELECT i, low + (high - low) * i / 24 AS t FROM s1, (SELECT unnest(range(25)) AS i)')},
    {_round(3, 'SELECT i, low + (high - low) * i / 24 AS t FROM s2, (SELECT unnest(range(25)) AS i)')},
    one AS (SELECT avg({NLL}) AS nll FROM lp, (SELECT 1.0::DOUBLE AS t))
    SELECT {s6('CASE WHEN b3.nll < one.nll THEN b3.t ELSE 1 END', 'temperature')} FROM b3, one""", ("pair",))
def _(spark, folder):
    rows = st.text_model(spark, folder)
    fitted = ln.fit_temperature(rows)
    return rows.agg(F.lit(fitted).alias("temperature"), F.count("*")).select(r6("temperature"))


# Models


def _folded(spark, folder, k=3):
    return sp.stratified_kfold(st.vectors(spark, folder), "label", "productid", k)


def _with_probabilities(spark, folder):
    """Meta rows made of the stand-in probabilities, in folds."""
    rows = st.scored(spark, folder).withColumnRenamed("y", "label").join(
        _folded(spark, folder).select("productid", "fold", "tabular"), "productid")
    return ln.meta_rows(rows, 1.2, 0.9)


def _scores(df):
    return df.select("productid", "label", "pred", F.round(F.array_max("p"), 4).alias("confidence"))


@query("base_classifier")
def _(spark, folder):
    rows = st.vectors(spark, folder)
    model = ln.base_classifier(rows, "text_vector", "label", C["text"], 50)
    return _scores(ln.class_probabilities(model, rows, "text_vector", K, "p").withColumn("pred", argmax(F.col("p"))))


@query("oof_probabilities")
def _(spark, folder):
    oof = ln.oof_probabilities(st.vectors(spark, folder), "productid", "label", K, C, k=3, max_iter=30)
    return oof.select("productid", "label", "fold", argmax(F.col("p_text")).alias("pred_text"), argmax(F.col("p_image")).alias("pred_image"))


@query("meta_classifier")
def _(spark, folder):
    rows = _with_probabilities(spark, folder)
    return _scores(ln.meta_predict(ln.meta_classifier(rows, "label", FOREST), rows, K))


@query("meta_classifier_boosted")
def _(spark, folder):
    rows = _with_probabilities(spark, folder)
    model = ln.boosted_meta_classifier(rows, "label", K, {"maxIter": 2, "maxDepth": 3})
    return _scores(ln.meta_predict(model, rows, K))


@query("stacking_fit")
def _(spark, folder):
    rows = st.vectors(spark, folder)
    model, oof = ln.stacking_fit(rows, "productid", "label", K, C, k=3, max_iter=30, params=FOREST)
    return oof.agg(F.count("*").alias("n_rows")).select(
        "n_rows", F.lit(model.t_text).alias("t_text"), F.lit(model.t_image).alias("t_image"))


@query("stacking_predict")
def _(spark, folder):
    rows = st.vectors(spark, folder)
    gold = F.col("productid") % 10 == 0
    model, _oof = ln.stacking_fit(rows.where(~gold), "productid", "label", K, C, k=3, max_iter=30, params=FOREST)
    return _scores(ln.stacking_predict(model, rows.where(gold)))


@query("param_search")
def _(spark, folder):
    space = {"numTrees": ("int", 5, 10), "maxDepth": ("int", 3, 5)}
    _best, trials = ln.param_search(_with_probabilities(spark, folder), "label", space, K, n_trials=2, k=3)
    return trials


@query("pca_baseline")
def _(spark, folder):
    rows = st.vectors(spark, folder)
    model = ln.pca_baseline(rows, "label", {"text": 8, "image": 8}, FOREST)
    return _scores(ln.pca_predict(model, rows))


@query("coef_importance")
def _(spark, folder):
    model = ln.base_classifier(st.vectors(spark, folder), "image_vector", "label", C["image"], 50)
    return ln.coef_importance(model, [f"image_feat_{i}" for i in range(32)])


@query("tree_importance")
def _(spark, folder):
    model = ln.meta_classifier(_with_probabilities(spark, folder), "label", FOREST)
    names = ln.meta_feature_names(K, [f"t{i}" for i in range(12)], DERIVED)
    return ag.importance_by_group(ln.tree_importance(model, names))


# Streams


@query("score_queue", "SELECT productid, pred, 0 AS trigger FROM queue JOIN rows_text USING (productid)", ("queue", "rows_text"))
def _(spark, folder):
    schema = st.table(spark, folder, "events").schema
    stream = qu.queue_stream(spark, folder, schema, "events.parquet").select(F.col("event_id").alias("productid"), "value")
    model = st.text_model(spark, folder).select("productid", argmax(F.col("p")).alias("pred"))
    scorer = qu.QueueScorer(spark, fresh_path(spark, "queue"), lambda rows: rows.join(model, "productid"), threshold=50)
    scorer.start(stream, every=None).awaitTermination()
    return scorer.results().select("productid", "pred", "trigger")


@query("windowed_rate_stream", f"""SELECT w AS window_start, {s6('sum(value) / 3600', 'rate')}, count(*) AS n
    FROM (SELECT time_bucket(INTERVAL '1 hour', ts) AS w, value FROM events)
    WHERE w + INTERVAL '1 hour' <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes' GROUP BY w""")
def _(spark, folder):
    schema = st.table(spark, folder, "events").schema
    stream = qu.queue_stream(spark, folder, schema, "events.parquet")
    rate = mo.windowed_rate(stream, "ts", "value", "1 hour", watermark="10 minutes")
    root = fresh_path(spark, "rate")
    (rate.writeStream.format("parquet").option("path", f"{root}/rate").option("checkpointLocation", f"{root}/checkpoint")
        .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{root}/rate").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), r6("rate"), "n")
