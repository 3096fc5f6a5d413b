"""Queries on vectors and evaluation metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogflow.functions import vectors as V
from catalogflow.operators import evaluation as ev
from catalogflow.plans import jobs
from catalogflow.plans import standins as st
from catalogflow.plans.registry import query, r6, s6, s_spread, spread
from catalogflow.schemas import DERIVED

K = st.N_CLASSES

# Vector functions


def _both(spark, folder):
    return st.scored(spark, folder)


def _p(name="p_text"):
    return F.col(name)


@query("argmax", "SELECT productid, pred FROM rows_text", ("rows_text",))
def _(spark, folder):
    return _both(spark, folder).select("productid", V.argmax(_p()).alias("pred"))


@query("margin", f"SELECT productid, {s6('margin')} FROM rows_text", ("rows_text",))
def _(spark, folder):
    return _both(spark, folder).select("productid", r6(V.margin(_p()), "margin"))


def s_entropy(p: str, eps: str = "1e-7", normalized: bool = True) -> str:
    raw = f"(-list_sum(list_transform({p}, lambda x: x * ln(x + {eps}::DOUBLE))))"
    return f"({raw} / ln({K}.0::DOUBLE))" if normalized else raw


S_KL = "list_sum(list_transform(list_zip(p_text, p_image), lambda t: t[1] * ln((t[1] + 1e-7::DOUBLE) / (t[2] + 1e-7::DOUBLE))))"


@query("entropy", f"SELECT productid, {s6(s_entropy('p_text'), 'entropy')}, {s6(s_entropy('p_text', '1e-12', False), 'raw_entropy')} FROM pair", ("pair",))
def _(spark, folder):
    return _both(spark, folder).select("productid", r6(V.entropy(_p()), "entropy"), r6(V.entropy(_p(), 1e-12, False), "raw_entropy"))


@query("kl", f"SELECT productid, {s6(S_KL, 'kl')} FROM pair", ("pair",))
def _(spark, folder):
    return _both(spark, folder).select("productid", r6(V.kl(_p(), _p("p_image")), "kl"))


@query("softmax", f"SELECT productid, {s_spread('p_text', K, 'p')} FROM pair", ("pair",))
def _(spark, folder):
    return _both(spark, folder).select("productid", *spread(_p(), K, "p"))


def tempered(p: str, t: float, source: str = "pair") -> str:
    """Rows of ``source`` with ``{p}_cal``, as CTEs l_{p}, e_{p}."""
    return f"""l_{p} AS (SELECT *, list_transform({p}, lambda x: ln(least(greatest(x, 1e-7::DOUBLE), 1.0::DOUBLE)) / {t}::DOUBLE) AS l_{p} FROM {source}),
    e_{p} AS (SELECT *, list_max(l_{p}) AS m_{p} FROM l_{p}),
    x_{p} AS (SELECT *, list_transform(l_{p}, lambda x: exp(x - m_{p})) AS x_{p} FROM e_{p}),
    z_{p} AS (SELECT *, list_sum(x_{p}) AS z_{p} FROM x_{p}),
    c_{p} AS (SELECT *, list_transform(x_{p}, lambda x: x / z_{p}) AS {p}_cal FROM z_{p})"""


@query("apply_temperature", f"WITH {tempered('p_text', 1.7)} SELECT productid, {s_spread('p_text_cal', K, 'p')} FROM c_p_text", ("pair",))
def _(spark, folder):
    return _both(spark, folder).select("productid", *spread(V.apply_temperature(_p(), 1.7), K, "p"))


S_DERIVED = f"""{s6('CASE WHEN list_position(p_text, list_max(p_text)) = list_position(p_image, list_max(p_image)) THEN 1 ELSE 0 END', 'agreement')},
    {s6('list_reverse_sort(p_text)[1] - list_reverse_sort(p_text)[2]', 'margin_text')}, {s6('list_reverse_sort(p_image)[1] - list_reverse_sort(p_image)[2]', 'margin_image')},
    {s6('list_max(p_text)', 'max_text')}, {s6('list_max(p_image)', 'max_image')}, {s6(s_entropy('p_text'), 'entropy_text')},
    {s6(s_entropy('p_image'), 'entropy_image')}, {s6(S_KL, 'kl_text_img')}"""


@query("derived_features", f"SELECT productid, {S_DERIVED} FROM pair", ("pair",))
def _(spark, folder):
    features = _both(spark, folder).select("productid", *V.derived_features(_p(), _p("p_image")))
    return features.select("productid", *[r6(c) for c in DERIVED])


@query("meta_vector", f"""WITH d AS (SELECT productid, {S_DERIVED} FROM pair), m AS (SELECT productid, list_concat(list_concat(p_text, p_image), list_concat(tabular,
    [{', '.join(DERIVED)}])) AS meta FROM pair JOIN vectors USING (productid) JOIN d USING (productid))
    SELECT productid, CAST(len(meta) AS INTEGER) AS width, {s_spread('meta', 40, 'm')} FROM m""", ("pair", "vectors"))
def _(spark, folder):
    rows = _both(spark, folder).join(st.vectors(spark, folder).select("productid", "tabular"), "productid")
    meta = V.meta_vector(_p(), _p("p_image"), F.col("tabular"), F.array(*V.derived_features(_p(), _p("p_image"))))
    return rows.select("productid", F.size(meta).alias("width"), *spread(meta, 2 * K + 12 + 8, "m"))


@query("one_hot_probabilities", f"SELECT productid, {', '.join(f'CAST(pred = {i} AS INTEGER) + 0.0::DOUBLE AS p_{i}' for i in range(K))} FROM rows_text", ("rows_text",))
def _(spark, folder):
    return _both(spark, folder).select("productid", *spread(V.one_hot(V.argmax(_p()), K), K, "p"))


@query("align_classes", f"SELECT productid, {', '.join(s6(f'p_text[{[7, 2, 5].index(i) + 1}]' if i in (2, 5, 7) else '0', f'p_{i}') for i in range(K))} FROM pair", ("pair",))
def _(spark, folder):
    return _both(spark, folder).select("productid", *spread(V.align_classes(_p(), [7, 2, 5], K), K, "p"))


@query("pack_columns", f"SELECT p_partkey, {s6('p_size + p_retailprice + p_partkey', 'total')}, {s6('p_retailprice', 'second')} FROM part")
def _(spark, folder):
    packed = st.table(spark, folder, "part").select("p_partkey", V.pack_columns(["p_size", "p_retailprice", "p_partkey"]).alias("v"))
    return packed.select("p_partkey", r6(V.vsum(F.col("v")), "total"), *V.unpack_columns(F.col("v"), ["first", "second"])[1:]).withColumn("second", r6("second"))


@query("unpack_columns", "SELECT productid, text_vector[1] AS first, text_vector[2] AS second FROM vectors", ("vectors",))
def _(spark, folder):
    return st.vectors(spark, folder).select("productid", *V.unpack_columns(F.col("text_vector"), ["first", "second"]))


# Evaluation

CLASSES = """cls AS (SELECT class, sum(support) AS support, sum(predicted) AS predicted, sum(tp) AS tp FROM (
        SELECT y AS class, 1 AS support, 0 AS predicted, CAST(y = pred AS INTEGER) AS tp FROM {rows} UNION ALL SELECT pred, 0, 1, 0 FROM {rows}) GROUP BY class),
    sc AS (SELECT class, support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision, CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall,
        CASE WHEN support + predicted > 0 THEN 2.0::DOUBLE * tp / (support + predicted) ELSE 0 END AS f1, tp FROM cls)"""
TEXT_CLASSES = CLASSES.format(rows="rows_text")
OVERALL = f"""sum(support)::BIGINT AS n, {s6('sum(tp) / sum(support)', 'accuracy')}, {s6('sum(f1 * support) / sum(support)', 'f1_weighted')}, {s6('avg(f1)', 'f1_macro')}"""


def _text(spark, folder):
    return ev.scored(st.text_model(spark, folder))


def _rounded(df, *columns):
    return df.withColumns({c: r6(c) for c in columns})


@query("confusion_matrix", "SELECT y, pred, count(*) AS n FROM rows_text GROUP BY y, pred", ("rows_text",))
def _(spark, folder):
    return ev.confusion_matrix(_text(spark, folder))


@query("per_class_metrics", f"""WITH {TEXT_CLASSES} SELECT CAST(r.k AS INTEGER) AS class, {s6('coalesce(precision, 0)', 'precision')}, {s6('coalesce(recall, 0)', 'recall')},
    {s6('coalesce(f1, 0)', 'f1')}, coalesce(support, 0)::BIGINT AS support FROM (SELECT unnest(range(12)) AS k) r LEFT JOIN sc ON class = k""", ("rows_text",))
def _(spark, folder):
    return _rounded(ev.per_class_metrics(_text(spark, folder), 12), "precision", "recall", "f1")


@query("f1_scores", f"WITH {TEXT_CLASSES} SELECT {OVERALL} FROM sc", ("rows_text",))
def _(spark, folder):
    return _rounded(ev.f1_scores(_text(spark, folder)), "accuracy", "f1_weighted", "f1_macro")


S_NLL = "-ln(least(greatest(p[y + 1], 2.220446049250313e-16::DOUBLE), 1.0::DOUBLE - 2.220446049250313e-16::DOUBLE))"
S_BRIER = "list_sum(list_transform(p, lambda v, i: power(v - CASE WHEN i = y + 1 THEN 1 ELSE 0 END, 2)))"


@query("log_loss", f"SELECT {s6(f'avg({S_NLL})', 'log_loss')} FROM rows_text", ("rows_text",))
def _(spark, folder):
    return _rounded(ev.log_loss(_text(spark, folder)), "log_loss")


@query("brier_multiclass", f"SELECT {s6(f'avg({S_BRIER})', 'brier')} FROM rows_text", ("rows_text",))
def _(spark, folder):
    return _rounded(ev.brier_multiclass(_text(spark, folder)), "brier")


RIGHT = "CAST(least(ceil({v} * {n}) - 1, {n} - 1) AS INTEGER)"
LEFT = "CAST(least(floor({v} * {n}), {n} - 1) AS INTEGER)"


def s_bins(rule: str, rows: str = "rows_text") -> str:
    return (f"b AS (SELECT {rule.format(v='conf', n=10)} AS bin, count(*) AS size, avg(CAST(correct AS INTEGER)) AS accuracy, avg(conf) AS confidence"
            f" FROM {rows} GROUP BY 1)")


S_ECE = s6("sum(CASE WHEN bin >= 0 THEN size * abs(accuracy - confidence) ELSE 0 END) / sum(size)", "ece")


@query("ece_right_closed", f"WITH {s_bins(RIGHT)} SELECT {S_ECE} FROM b", ("rows_text",))
def _(spark, folder):
    return _rounded(ev.ece_right_closed(_text(spark, folder)), "ece")


@query("ece_left_closed", f"WITH {s_bins(LEFT)} SELECT {S_ECE} FROM b", ("rows_text",))
def _(spark, folder):
    return _rounded(ev.ece_left_closed(_text(spark, folder)), "ece")


def s_reliability(rule: str) -> str:
    return f"""WITH {s_bins(rule)} SELECT CAST(k AS INTEGER) AS bin, {s6('(k + 0.5::DOUBLE) / 10', 'center')}, {s6('coalesce(accuracy, 0)', 'accuracy')},
    {s6('coalesce(confidence, 0)', 'confidence')}, coalesce(size, 0) AS size FROM (SELECT unnest(range(10)) AS k) LEFT JOIN b ON bin = k"""


@query("reliability_bins", s_reliability(RIGHT), ("rows_text",))
def _(spark, folder):
    return _rounded(ev.reliability_bins(_text(spark, folder)), "center", "accuracy", "confidence")


@query("reliability_bins_left_closed", s_reliability(LEFT), ("rows_text",))
def _(spark, folder):
    return _rounded(ev.reliability_bins(_text(spark, folder), closed="left"), "center", "accuracy", "confidence")


def s_histogram(value: str, rows: str, keys: str, extra: str = "") -> str:
    """Histogram over 30 bins of [0, 1] with empty bins, per group of ``keys``."""
    return f"""h AS (SELECT {keys}, {LEFT.format(v=value, n=30)} AS bin, count(*) AS n FROM {rows} GROUP BY ALL),
    g AS (SELECT {keys}, count(*) AS group_n, avg({value}) AS group_mean FROM {rows} GROUP BY ALL),
    full_h AS (SELECT {', '.join('g.' + k.strip() for k in keys.split(','))}, CAST(k AS INTEGER) AS bin, coalesce(n, 0) AS n,
        {s6('coalesce(n, 0) * 30 / group_n', 'density')}, group_n, {s6('group_mean')} FROM (SELECT *, unnest(range(30)) AS k FROM g) g
        LEFT JOIN h ON h.bin = k AND {' AND '.join(f'h.{k.strip()} = g.{k.strip()}' for k in keys.split(','))})"""


@query("confidence_histogram", f"WITH {s_histogram('conf', 'rows_text', 'correct')} SELECT correct, bin, n, density, group_n FROM full_h", ("rows_text",))
def _(spark, folder):
    return _rounded(ev.confidence_histogram(_text(spark, folder)), "density")


@query("margin_histogram", f"WITH {s_histogram('margin', 'rows_text', 'correct')} SELECT * FROM full_h", ("rows_text",))
def _(spark, folder):
    return _rounded(ev.margin_histogram(_text(spark, folder)), "density", "group_mean")


HARD = "hard AS (SELECT class, f1, support FROM sc WHERE support >= 10 ORDER BY f1, class LIMIT 6)"


@query("one_vs_rest_histogram", f"""WITH {TEXT_CLASSES}, {HARD}, e AS (SELECT class, y = class AS positive, p[class + 1] AS p_c FROM rows_text CROSS JOIN hard),
    {s_histogram('p_c', 'e', 'class, positive')} SELECT full_h.class, positive, bin, n, density, group_n, {s6('f1')} FROM full_h JOIN sc USING (class)""", ("rows_text",))
def _(spark, folder):
    rows = _text(spark, folder)
    return _rounded(ev.one_vs_rest_histogram(rows, ev.hard_classes(rows)), "density", "f1")


_ORACLE = """o AS (SELECT y, pred_meta, t = y AS t, i = y AS i, pred_meta = y AS m, t = i AS same, CASE WHEN t <> y AND i = y THEN i ELSE t END AS pred FROM
    (SELECT y, pred_meta, CAST(list_position(p_text, list_max(p_text)) - 1 AS INTEGER) AS t, CAST(list_position(p_image, list_max(p_image)) - 1 AS INTEGER) AS i FROM scored))"""


@query("stacking_analysis", f"""WITH {_ORACLE}, {CLASSES.format(rows='o')} SELECT {s6('avg(CAST(same AS INTEGER))', 'agreement_text_image')},
    count(*) FILTER (t AND NOT i) AS text_only_correct, count(*) FILTER (NOT t AND i) AS image_only_correct, count(*) FILTER (t AND i) AS both_correct,
    count(*) FILTER (NOT t AND NOT i) AS both_wrong, count(*) FILTER (m AND NOT t AND NOT i) AS meta_saves_when_both_wrong,
    count(*) FILTER (NOT m AND (t OR i)) AS meta_loses_when_one_correct, (SELECT round(avg(f1), 6) FROM sc) AS oracle_f1_macro,
    (SELECT round(sum(f1 * support) / sum(support), 6) FROM sc) AS oracle_f1_weighted FROM o""", ("scored",))
def _(spark, folder):
    return _rounded(ev.stacking_analysis(st.scored(spark, folder)), "agreement_text_image", "oracle_f1_macro", "oracle_f1_weighted")


@query("drift_metrics", f"""WITH d AS (SELECT {s_entropy('p', '1e-12', False)} AS h, margin FROM rows_text) SELECT {s6('avg(h)', 'entropy_mean')},
    {s6('stddev_pop(h)', 'entropy_std')}, {s6('avg(margin)', 'margin_mean')}, {s6('stddev_pop(margin)', 'margin_std')} FROM d""", ("rows_text",))
def _(spark, folder):
    return _rounded(ev.drift_metrics(_text(spark, folder)), "entropy_mean", "entropy_std", "margin_mean", "margin_std")


@query("psi", f"""WITH c AS (SELECT k, (SELECT count(*) FROM rows_text WHERE pred = k) + 1e-6::DOUBLE AS t, (SELECT count(*) FROM rows_image WHERE pred = k) + 1e-6::DOUBLE AS r
    FROM (SELECT unnest(range({K})) AS k)), s AS (SELECT t / sum(t) OVER () AS a, r / sum(r) OVER () AS b FROM c) SELECT {s6('sum((a - b) * ln(a / b))', 'psi')} FROM s""",
       ("rows_text", "rows_image"))
def _(spark, folder):
    return _rounded(ev.psi(_text(spark, folder), ev.scored(st.image_model(spark, folder)), K), "psi")


@query("classification_report", f"""WITH {TEXT_CLASSES}, r AS (SELECT CAST(class AS VARCHAR) AS "row", precision, recall, f1, support FROM sc
    UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM sc
    UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM sc
    UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM sc)
    SELECT "row", {s6('precision')}, {s6('recall')}, {s6('f1')}, support::BIGINT AS support FROM r""", ("rows_text",))
def _(spark, folder):
    return _rounded(ev.classification_report(_text(spark, folder)), "precision", "recall", "f1")


_MODALITIES = """m AS (SELECT 'text' AS modality, y, pred FROM rows_text UNION ALL SELECT 'image', y, pred FROM rows_image)"""
GROUPED = """gc AS (SELECT {by}, class, sum(support) AS support, sum(predicted) AS predicted, sum(tp) AS tp FROM (
        SELECT {by}, y AS class, 1 AS support, 0 AS predicted, CAST(y = pred AS INTEGER) AS tp FROM m UNION ALL SELECT {by}, pred, 0, 1, 0 FROM m) GROUP BY ALL),
    gs AS (SELECT {by}, sum(support)::BIGINT AS n, sum(tp) / sum(support) AS accuracy, sum(2.0::DOUBLE * tp / (support + predicted) * support) / sum(support) AS f1_weighted,
        avg(2.0::DOUBLE * tp / (support + predicted)) AS f1_macro FROM gc GROUP BY ALL)"""


@query("modality_oof_metrics", f"WITH {_MODALITIES}, {GROUPED.format(by='modality')} SELECT modality, n, {s6('accuracy')}, {s6('f1_weighted')}, {s6('f1_macro')} FROM gs",
       ("rows_text", "rows_image"))
def _(spark, folder):
    return _rounded(ev.modality_oof_metrics(st.scored(spark, folder)), "accuracy", "f1_weighted", "f1_macro")


@query("evaluation_summary", f"""WITH {TEXT_CLASSES}, {s_bins(RIGHT)} SELECT {OVERALL}, (SELECT round(avg({S_NLL}), 6) FROM rows_text) AS log_loss,
    (SELECT round(avg({S_BRIER}), 6) FROM rows_text) AS brier,
    (SELECT round(sum(CASE WHEN bin >= 0 THEN size * abs(accuracy - confidence) ELSE 0 END) / sum(size), 6) FROM b) AS ece FROM sc""", ("rows_text",))
def _(spark, folder):
    out = ev.evaluation_summary(st.text_model(spark, folder))
    return _rounded(out, *[c for c in out.columns if c != "n"])


def _version_predictions(spark, folder):
    pair = st.scored(spark, folder)
    parts = [("m-text", 1, "p_text"), ("m-image", 2, "p_image"), ("m-image", 3, "p_text")]
    frames = [pair.select(F.lit(n).alias("name"), F.lit(v).alias("version"), "productid", F.col(p).alias("p")) for n, v, p in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("evaluate_versions", f"""WITH m0 AS (SELECT 'm-text' AS name, 1 AS version, productid, y, pred, p, conf, correct FROM rows_text
        UNION ALL SELECT 'm-image', 2, productid, y, pred, p, conf, correct FROM rows_image),
    m AS (SELECT * FROM m0 WHERE productid IN (SELECT productid FROM classes WHERE is_gold)), {GROUPED.format(by='name, version')},
    l AS (SELECT name, version, avg({S_NLL}) AS log_loss, avg({S_BRIER}) AS brier FROM m GROUP BY ALL),
    vb AS (SELECT name, version, {RIGHT.format(v='conf', n=10)} AS bin, count(*) AS size, avg(CAST(correct AS INTEGER)) AS accuracy, avg(conf) AS confidence FROM m GROUP BY ALL),
    ve AS (SELECT name, version, sum(CASE WHEN bin >= 0 THEN size * abs(accuracy - confidence) ELSE 0 END) / sum(size) AS ece FROM vb GROUP BY ALL)
    SELECT name, version, n, {s6('accuracy')}, {s6('f1_weighted')}, {s6('f1_macro')}, {s6('log_loss')}, {s6('brier')}, {s6('ece')}
    FROM gs JOIN l USING (name, version) JOIN ve USING (name, version)""", ("rows_text", "rows_image", "classes"))
def _(spark, folder):
    # m-image v3 carries no alias; m-text v1 carries two and counts once.
    predictions = _version_predictions(spark, folder)
    named = F.explode(F.array(
        F.struct(F.lit("m-text").alias("name"), F.lit("active_stateless").alias("alias"), F.lit(1).alias("version")),
        F.struct(F.lit("m-text").alias("name"), F.lit("active_stateful").alias("alias"), F.lit(1).alias("version")),
        F.struct(F.lit("m-image").alias("name"), F.lit("active_stateful").alias("alias"), F.lit(2).alias("version"))))
    aliases = predictions.select(named.alias("a")).select("a.*").distinct()
    gold = st.classes_of_all(spark, folder).where("is_gold")
    labels = st.scored(spark, folder).select("productid", "y")
    out = jobs.evaluate_versions(predictions, aliases, ["active_stateless", "active_stateful"], gold, labels)
    return _rounded(out, "accuracy", "f1_weighted", "f1_macro", "log_loss", "brier", "ece")


@query("top_confusions", "SELECT y, pred, count(*) AS n FROM rows_text WHERE y <> pred GROUP BY y, pred ORDER BY n DESC, y, pred LIMIT 10", ("rows_text",))
def _(spark, folder):
    return ev.top_confusions(_text(spark, folder))


@query("hard_classes", f"WITH {TEXT_CLASSES}, {HARD} SELECT class, {s6('f1')}, support::BIGINT AS support FROM hard", ("rows_text",))
def _(spark, folder):
    return _rounded(ev.hard_classes(_text(spark, folder)), "f1")
