"""Queries on filters, joins, profiles, guards, the registry and monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogflow.functions import vectors as V
from catalogflow.operators import aggregates as ag
from catalogflow.operators import filters as fl
from catalogflow.operators import joins as jn
from catalogflow.operators import quality as ql
from catalogflow.operators import registry as rg
from catalogflow.operators import setops as so
from catalogflow.plans import jobs
from catalogflow.plans import standins as st
from catalogflow.plans.registry import query, r6, s6, s_spread, spread
from catalogflow.schemas import CLASS_CODES
from catalogflow.streaming import monitoring as mo

# Filters

_KEYS = ("productid", "prdtypecode", "batch_id")


@query("train_pool", "SELECT productid, prdtypecode, batch_id FROM split_table WHERE batch_id IN (1, 2) AND NOT is_gold", ("split_table",))
def _(spark, folder):
    return fl.train_pool(st.split_table(spark, folder), [1, 2]).select(*_KEYS)


@query("val_superset", "SELECT productid, prdtypecode, batch_id FROM split_table WHERE batch_id <= 2 AND NOT is_gold", ("split_table",))
def _(spark, folder):
    return fl.val_superset(st.split_table(spark, folder), 2).select(*_KEYS)


@query("gold_rows", "SELECT productid, prdtypecode, batch_id FROM split_table WHERE is_gold", ("split_table",))
def _(spark, folder):
    return fl.gold_rows(st.split_table(spark, folder)).select(*_KEYS)


@query("shadow_batch", "SELECT productid, prdtypecode, batch_id FROM split_table WHERE batch_id = 3 AND NOT is_gold", ("split_table",))
def _(spark, folder):
    return fl.shadow_batch(st.split_table(spark, folder), 3, [1, 2]).select(*_KEYS)


@query("missing_field", "SELECT productid FROM flagged WHERE is_gold IS NULL", ("flagged",))
def _(spark, folder):
    return fl.missing_field(st.flagged(spark, folder), "is_gold").select("productid")


@query("products_with_image", "SELECT productid, imageid FROM catalog WHERE productid IN (SELECT vec_id FROM embeddings)", ("catalog",))
def _(spark, folder):
    ids = st.table(spark, folder, "embeddings").select(F.col("vec_id").alias("productid"))
    return fl.products_with_image(st.catalog(spark, folder).select("productid", "imageid"), ids)


@query("min_support", "SELECT brand, count(*) AS support FROM parts GROUP BY brand HAVING count(*) >= 80", ("parts",))
def _(spark, folder):
    return fl.min_support(st.parts(spark, folder), "brand", 80)


# Joins

@query("zip_by_position", "SELECT o_orderkey AS row_id, o_custkey AS productid, o_orderstatus AS status FROM orders")
def _(spark, folder):
    orders = st.table(spark, folder, "orders").withColumnRenamed("o_orderkey", "row_id")
    return jn.zip_by_position(orders.select("row_id", F.col("o_custkey").alias("productid")),
                              orders.select("row_id", F.col("o_orderstatus").alias("status")))


@query("join_labels", "SELECT productid, batch_id, prdtypecode FROM catalog JOIN catalog_labels USING (productid)", ("catalog", "catalog_labels"))
def _(spark, folder):
    return jn.join_labels(st.catalog(spark, folder).select("productid", "batch_id"), st.catalog_labels(spark, folder))


@query("join_modalities", f"""SELECT imageid, productid, {s6('text_vector[1]', 'text_feat_0')}, {s6('image_vector[1]', 'image_feat_0')}, prdtypecode
    FROM vectors JOIN catalog USING (productid) JOIN catalog_labels USING (productid)""", ("vectors", "catalog", "catalog_labels"))
def _(spark, folder):
    keyed = st.vectors(spark, folder).withColumn("imageid", F.col("productid") * 7 + 1)
    text = keyed.select("imageid", "productid", F.get("text_vector", F.lit(0)).alias("text_feat_0"))
    image = keyed.select("imageid", "productid", F.get("image_vector", F.lit(0)).alias("image_feat_0"))
    target = st.catalog(spark, folder).select("imageid", "productid").join(st.catalog_labels(spark, folder), "productid")
    joined = jn.join_modalities(text, image, target)
    return joined.withColumns({c: r6(c) for c in ("text_feat_0", "image_feat_0")})


def _caches(spark, folder):
    v = st.vectors(spark, folder)
    return {
        "text": v.where(F.col("productid") % 10 != 1).select("productid", "label", F.get("text_vector", F.lit(0)).alias("text_feat_0")),
        "image": v.where(F.col("productid") % 10 != 2).select("productid", "label", F.get("image_vector", F.lit(0)).alias("image_feat_0")),
    }


@query("join_extra_caches", """SELECT productid, batch_id, text_vector[1] AS text_feat_0, image_vector[1] AS image_feat_0
    FROM catalog JOIN vectors USING (productid) WHERE productid % 10 NOT IN (1, 2)""", ("catalog", "vectors"))
def _(spark, folder):
    return jn.join_extra_caches(st.catalog(spark, folder).select("productid", "batch_id"), _caches(spark, folder))


@query("cache_coverage", """SELECT 'text' AS cache, count(*) AS n_dropped FROM catalog WHERE productid NOT IN
    (SELECT productid FROM vectors WHERE productid % 10 <> 1)
    UNION ALL SELECT 'image', count(*) FROM catalog WHERE productid IN (SELECT productid FROM vectors WHERE productid % 10 = 2)""",
       ("catalog", "vectors"))
def _(spark, folder):
    return jn.cache_coverage(st.catalog(spark, folder), _caches(spark, folder))


@query("lookup_default", """SELECT productid, coalesce(prdtypecode, -1) AS prdtypecode FROM catalog LEFT JOIN catalog_labels USING (productid)""",
       ("catalog", "catalog_labels"))
def _(spark, folder):
    return jn.lookup_default(st.catalog(spark, folder).select("productid"), st.catalog_labels(spark, folder), "productid", {"prdtypecode": -1})


@query("new_keys", "SELECT productid FROM catalog WHERE productid NOT IN (SELECT productid FROM vectors)", ("catalog", "vectors"))
def _(spark, folder):
    return jn.new_keys(st.catalog(spark, folder).select("productid"), st.vectors(spark, folder))


@query("requested_split", """SELECT productid, productid IN (SELECT productid FROM queue) AS present FROM
    (SELECT DISTINCT l_orderkey AS productid FROM lineitem)""", ("queue",))
def _(spark, folder):
    requested = st.table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("productid"))
    return jn.requested_split(requested, st.queue(spark, folder))


@query("rare_full_outer", f"""WITH a AS (SELECT lang, count(*) AS n FROM documents WHERE doc_id % 2 = 0 AND lang <> 'en' GROUP BY lang),
    b AS (SELECT lang, count(*) AS n FROM documents WHERE doc_id % 2 = 1 AND lang <> 'fr' GROUP BY lang)
    SELECT lang, {s6('coalesce(a.n, 0)', 'p')}, {s6('coalesce(b.n, 0)', 'q')} FROM a FULL JOIN b USING (lang)""")
def _(spark, folder):
    docs = st.table(spark, folder, "documents")

    def side(parity, without, name):
        rows = docs.where((F.col("doc_id") % 2 == parity) & (F.col("lang") != without))
        return rows.groupBy("lang").agg(F.count("*").cast("double").alias(name))

    return jn.rare_full_outer(side(0, "en", "p"), side(1, "fr", "q"), "lang")


@query("restore_order", "SELECT productid, batch_id FROM catalog WHERE productid IN (SELECT productid FROM vectors)", ("catalog", "vectors"))
def _(spark, folder):
    ids = st.vectors(spark, folder).select("productid", (-F.col("productid")).alias("_order"))
    return jn.restore_order(st.catalog(spark, folder).select("productid", "batch_id"), ids)


@query("join_model_probabilities", f"""SELECT a.productid, a.y, {s6('a.p[1]', 'a_0')}, {s6('b.p[1]', 'b_0')} FROM rows_text a
    JOIN rows_image b USING (productid)""", ("rows_text", "rows_image"))
def _(spark, folder):
    joined = jn.join_model_probabilities(st.text_model(spark, folder), st.image_model(spark, folder))
    return joined.select("productid", "y", *spread(F.col("p_a"), 1, "a"), *spread(F.col("p_b"), 1, "b"))


@query("migrate_columns", """SELECT v.productid, v.label, coalesce(is_gold, false) AS is_gold, batch_id FROM vectors v LEFT JOIN
    (SELECT productid, is_gold, batch_id FROM flagged) USING (productid)""", ("vectors", "flagged"))
def _(spark, folder):
    cache = st.vectors(spark, folder).select("productid", "label")
    return jn.migrate_columns(cache, st.flagged(spark, folder), {"is_gold": False, "batch_id": None, "label": -1})


# Profiles

@query("class_counts", "SELECT prdtypecode, count(*) AS nb_occurrences FROM classes GROUP BY prdtypecode", ("classes",))
def _(spark, folder):
    return ag.class_counts(st.classes_of_all(spark, folder), "prdtypecode")


@query("batch_profile", f"""SELECT batch_id, count(*) AS n_samples, count(DISTINCT prdtypecode) AS n_classes,
    {s6('count(*) / (SELECT count(*) FROM classes)', 'share')} FROM classes GROUP BY batch_id""", ("classes",))
def _(spark, folder):
    return ag.batch_profile(st.classes_of_all(spark, folder), "prdtypecode").withColumn("share", r6("share"))


@query("batch_summary", """SELECT 2 AS batch_id, count(*) AS n_samples, count(*) FILTER (is_gold) AS n_gold,
    count(DISTINCT prdtypecode) AS n_classes FROM classes WHERE batch_id = 2""", ("classes",))
def _(spark, folder):
    return ag.batch_summary(st.classes_of_all(spark, folder), 2, "prdtypecode")


@query("split_summary", """SELECT count(*) AS total, count(*) FILTER (batch_id IN (1, 2) AND NOT is_gold) AS train_pool,
    count(*) FILTER (batch_id IN (1, 2) AND NOT is_gold AND NOT is_val_selection_v2) AS train_pool_effective,
    count(*) FILTER (batch_id IN (1, 2) AND NOT is_gold AND is_val_selection_v2) AS val_selection,
    count(*) FILTER (is_gold) AS gold, count(*) FILTER (batch_id = 3 AND NOT is_gold) AS shadow FROM split_table""", ("split_table",))
def _(spark, folder):
    return ag.split_summary(st.split_table(spark, folder), [1, 2], 2)


@query("class_drift", f"""WITH s AS (SELECT * FROM split_table WHERE batch_id <= 2 AND NOT is_gold),
    v AS (SELECT prdtypecode, count(*) / (SELECT count(*) FROM s WHERE is_val_selection_v2) AS p_val FROM s WHERE is_val_selection_v2 GROUP BY prdtypecode),
    t AS (SELECT prdtypecode, count(*) / (SELECT count(*) FROM s WHERE NOT is_val_selection_v2) AS p_train FROM s WHERE NOT is_val_selection_v2 GROUP BY prdtypecode),
    d AS (SELECT prdtypecode, coalesce(p_val, 0) AS p_val, coalesce(p_train, 0) AS p_train, abs(coalesce(p_val, 0) - coalesce(p_train, 0)) AS drift_abs
        FROM v FULL JOIN t USING (prdtypecode))
    SELECT prdtypecode, {s6('p_val')}, {s6('p_train')}, {s6('drift_abs')}, {s6('max(drift_abs) OVER ()', 'max_drift')},
    max(drift_abs) OVER () < 0.01::DOUBLE AS passed FROM d""", ("split_table",))
def _(spark, folder):
    drift = ag.class_drift(st.split_table(spark, folder), "prdtypecode", 2)
    return drift.withColumns({c: r6(c) for c in ("p_val", "p_train", "drift_abs", "max_drift")})


@query("length_distribution", f"""WITH l AS (SELECT CAST(length(text) AS INTEGER) AS len FROM documents)
    SELECT count(*) AS n, min(len) AS min, {", ".join(s6(f"quantile_cont(len, {q})", n) for n, q in
    (("q25", 0.25), ("median", 0.5), ("q75", 0.75), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99)))}, max(len) AS max, {s6('avg(len)', 'mean')},
    round(stddev_pop(len), 3) AS std, {", ".join(s6(f"avg(CASE WHEN len > {c} THEN 1.0 ELSE 0.0 END)", f"share_above_{c}") for c in (96, 128, 160))} FROM l""")
def _(spark, folder):
    out = ag.length_distribution(st.table(spark, folder, "documents"), F.length("text"))
    exact = [c for c in out.columns if c not in ("n", "min", "max", "std")]
    return out.withColumns({c: r6(c) for c in exact}).withColumn("std", F.round("std", 3))


_STATUS = """audited AS (SELECT productid, prdtypecode, CASE WHEN productid % 9 = 4 THEN 'absent' WHEN productid % 7 = 2 THEN 'unreadable'
    ELSE 'ok' END AS status FROM classes)"""


def _audited(spark, folder):
    rows = st.classes_of_all(spark, folder)
    status = rows.where(F.col("productid") % 9 != 4).select(
        "productid", F.when(F.col("productid") % 7 == 2, "unreadable").otherwise("ok").alias("status"))
    return ag.image_quality(rows.select("productid", "prdtypecode"), status)


@query("image_quality", f"""WITH {_STATUS} SELECT count(*) AS n, count(*) FILTER (status = 'ok') AS n_ok, count(*) FILTER (status = 'absent') AS n_absent,
    count(*) FILTER (status = 'unreadable') AS n_unreadable, {s6("avg(CASE WHEN status <> 'ok' THEN 1.0 ELSE 0.0 END)", 'corruption_rate')}
    FROM audited""", ("classes",))
def _(spark, folder):
    return ag.image_quality_summary(_audited(spark, folder)).withColumn("corruption_rate", r6("corruption_rate"))


@query("corrupted_by_class", f"""WITH {_STATUS} SELECT prdtypecode, count(*) AS n, count(*) FILTER (status <> 'ok') AS n_corrupted,
    {s6("count(*) FILTER (status <> 'ok') / count(*)", 'rate')} FROM audited GROUP BY prdtypecode
    ORDER BY count(*) FILTER (status <> 'ok') / count(*) DESC, n_corrupted DESC, prdtypecode LIMIT 5""", ("classes",))
def _(spark, folder):
    return ag.corrupted_by_class(_audited(spark, folder), "prdtypecode").withColumn("rate", r6("rate"))


_CELLS = """c AS (SELECT {a} AS a, {b} AS b, count(*) AS n FROM {t} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2),
    ra AS (SELECT a, sum(n) AS n FROM c GROUP BY a), rb AS (SELECT b, sum(n) AS n FROM c GROUP BY b)"""
_CHI2 = """(SELECT sum(power(coalesce(c.n, 0) - ra.n * rb.n / (SELECT sum(n) FROM c), 2) / (ra.n * rb.n / (SELECT sum(n) FROM c)))
    FROM ra CROSS JOIN rb LEFT JOIN c ON c.a = ra.a AND c.b = rb.b)"""


@query("chi2_independence", f"""WITH {_CELLS.format(a='p_type', b='p_size', t='part')} SELECT {s6(_CHI2, 'chi2')},
    (SELECT count(*) - 1 FROM ra) * (SELECT count(*) - 1 FROM rb) AS dof""")
def _(spark, folder):
    return ag.chi2_independence(st.table(spark, folder, "part"), "p_type", "p_size").withColumn("chi2", r6("chi2"))


@query("chi2_p_value", f"""WITH {_CELLS.format(a="quality", b='toxic', t='labels')} SELECT {s6(_CHI2, 'chi2')},
    CAST((SELECT count(*) - 1 FROM ra) * (SELECT count(*) - 1 FROM rb) AS INTEGER) AS dof""")
def _(spark, folder):
    tested = ag.chi2_p_value(st.table(spark, folder, "labels"), "quality", "toxic")
    return tested.select(r6("chi2"), F.col("dof").cast("int").alias("dof"))


@query("importance_by_group", f"""WITH g AS (SELECT CASE WHEN feature LIKE 'p_text_%' THEN 'text' WHEN feature LIKE 'p_image_%' THEN 'image'
    WHEN feature LIKE 'derived__%' THEN 'derived' ELSE 'tabular' END AS "group", gain, split FROM importances)
    SELECT "group", {s6('sum(gain)', 'gain_sum')}, {s6('avg(gain)', 'gain_mean')}, CAST(sum(split) AS BIGINT) AS split_sum, {s6('avg(split)', 'split_mean')},
    count(*) AS n_features, {s6('sum(gain) / (SELECT sum(gain) FROM g)', 'gain_share')}, {s6('sum(split) / (SELECT sum(split) FROM g)', 'split_share')}
    FROM g GROUP BY "group" """, ("importances",))
def _(spark, folder):
    out = ag.importance_by_group(st.importances(spark, folder))
    return out.withColumns({c: r6(c) for c in ("gain_sum", "gain_mean", "split_mean", "gain_share", "split_share")})


# Scores have seven decimals, so figures of few folds tie at six; eleven tell them apart.
@query("trial_summary", f"""SELECT trial, {s6('avg(score)', 'mean_score', 11)}, {s6('stddev_pop(score)', 'std_score', 11)},
    {s6('avg(score) - 0.25::DOUBLE * stddev_pop(score)', 'objective', 11)}, {s6('avg(best_iter)', 'best_iters_mean', 11)}, max(best_iter) AS best_iters_max
    FROM trials GROUP BY trial""", ("trials",))
def _(spark, folder):
    out = ag.trial_summary(st.trials(spark, folder))
    return out.withColumns({c: r6(c, digits=11) for c in ("mean_score", "std_score", "objective", "best_iters_mean")})


@query("trial_stability", f"""WITH o AS (SELECT avg(score) - 0.25::DOUBLE * stddev_pop(score) AS objective FROM trials GROUP BY trial)
    SELECT {s6('stddev_pop(objective)', 'cv_score_std')}, {s6('min(objective)', 'cv_score_min')}, {s6('max(objective)', 'cv_score_max')},
    {s6('max(objective) - min(objective)', 'cv_score_range')} FROM o""", ("trials",))
def _(spark, folder):
    out = ag.trial_stability(ag.trial_summary(st.trials(spark, folder)))
    return out.select(*[r6(c) for c in out.columns])


@query("nan_rows", "SELECT productid FROM vectors WHERE productid % 6 = 1", ("vectors",))
def _(spark, folder):
    hole = F.when((F.col("productid") % 6 == 1), F.lit(float("nan"))).otherwise(F.get("text_vector", F.lit(0)))
    rows = st.vectors(spark, folder).withColumn("v", F.concat(F.slice("text_vector", 2, 31), F.array(hole)))
    return ag.nan_rows(rows, "v").select("productid")


@query("dataset_fingerprint", """SELECT count(*) AS n, CAST(sum(CAST(concat('0x', substr(md5(coalesce(CAST(productid AS VARCHAR), chr(2)) || chr(1) ||
    coalesce(designation, chr(2)) || chr(1) || coalesce(description, chr(2))), 1, 8)) AS BIGINT)) AS VARCHAR) AS fingerprint FROM catalog""", ("catalog",))
def _(spark, folder):
    return ag.dataset_fingerprint(st.catalog(spark, folder), ["productid", "designation", "description"])


# Sets of keys and classes

@query("concat_rows", "SELECT productid FROM catalog UNION ALL SELECT productid FROM vectors UNION ALL SELECT productid FROM parts",
       ("catalog", "vectors", "parts"))
def _(spark, folder):
    return so.concat_rows([v(spark, folder).select("productid") for v in (st.catalog, st.vectors, st.parts)])


@query("invalid_classes", f"SELECT DISTINCT prdtypecode FROM catalog_labels WHERE prdtypecode NOT IN ({', '.join(map(str, CLASS_CODES))})",
       ("catalog_labels",))
def _(spark, folder):
    return so.invalid_classes(st.catalog_labels(spark, folder), CLASS_CODES)


@query("shadow_batches", "SELECT DISTINCT batch_id FROM classes WHERE batch_id NOT IN (1, 2)", ("classes",))
def _(spark, folder):
    return so.shadow_batches(st.classes_of_all(spark, folder), [1, 2])


@query("gold_val_overlap", """SELECT productid FROM classes WHERE is_gold AND productid % 10 IN (1, 2, 3)""", ("classes",))
def _(spark, folder):
    # A selection that ignores the gold flag, so that the guard has something to find.
    rows = st.classes_of_all(spark, folder).withColumn("is_val_selection_v9", F.col("productid") % 10 < 4)
    return so.gold_val_overlap(rows.where(F.col("productid") % 10 != 0), 9)


# Guards

@query("unlabelled_products", "SELECT productid FROM catalog WHERE productid NOT IN (SELECT productid FROM catalog_labels)", ("catalog", "catalog_labels"))
def _(spark, folder):
    return ql.unlabelled_products(st.catalog(spark, folder), st.catalog_labels(spark, folder))


@query("duplicate_keys", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def _(spark, folder):
    return ql.duplicate_keys(st.table(spark, folder, "lineitem"), "l_orderkey")


@query("empty_batch", "SELECT 9 AS batch_id, count(*) AS n FROM catalog WHERE batch_id = 9 HAVING count(*) = 0", ("catalog",))
def _(spark, folder):
    return ql.empty_batch(st.catalog(spark, folder), 9)


@query("gold_share", f"""SELECT count(*) AS n, count(*) FILTER (is_gold) AS n_gold, {s6('avg(CAST(is_gold AS INTEGER))', 'share')},
    abs(avg(CAST(is_gold AS INTEGER)) - 0.1::DOUBLE) <= 0.01::DOUBLE AS passed FROM classes""", ("classes",))
def _(spark, folder):
    return ql.gold_share(st.classes_of_all(spark, folder)).withColumn("share", r6("share"))


@query("flag_count_matches", """SELECT count(*) FILTER (is_val_selection_v2) AS n, CAST(50 AS BIGINT) AS expected,
    count(*) FILTER (is_val_selection_v2) = 50 AS passed FROM split_table""", ("split_table",))
def _(spark, folder):
    return ql.flag_count_matches(st.split_table(spark, folder), "is_val_selection_v2", 50)


def _learner_cache(spark, folder):
    """Every row names the model it came from: the version's supplier and nation."""
    return st.versions(spark, folder).select(F.col("name").alias("source_model_name"), F.col("version").alias("source_model_version"))


@query("cache_single_source", """SELECT count(DISTINCT name) AS n_names, count(DISTINCT version) AS n_versions,
    count(DISTINCT name) = 1 AND count(DISTINCT version) = 1 AS passed FROM versions""", ("versions",))
def _(spark, folder):
    return ql.cache_single_source(_learner_cache(spark, folder))


@query("cache_in_sync", """SELECT v.name AS source_model_name, v.version AS source_model_version, a.version AS alias_version FROM versions v
    LEFT JOIN (SELECT * FROM aliases WHERE alias = 'champion') a ON a.name = v.name WHERE v.version IS DISTINCT FROM a.version""", ("aliases",))
def _(spark, folder):
    return ql.cache_in_sync(_learner_cache(spark, folder), st.aliases(spark, folder), "champion")


@query("probabilities_sum_to_one", """SELECT productid FROM pair WHERE productid % 8 = 3""", ("pair",))
def _(spark, folder):
    halved = F.when(F.col("productid") % 8 == 3, F.transform("p", lambda x: x / 2.0)).otherwise(F.col("p"))
    return ql.bad_probabilities(st.text_model(spark, folder).withColumn("p", halved)).select("productid")


# Ordering

@query("sort_products", "SELECT imageid, productid, designation FROM catalog", ("catalog",))
def _(spark, folder):
    return st.catalog(spark, folder).select("imageid", "productid", "designation").orderBy("imageid", "productid")


@query("top_features", "SELECT feature, gain, split FROM importances ORDER BY gain DESC, feature LIMIT 15", ("importances",))
def _(spark, folder):
    from catalogflow.operators.evaluation import top_features

    return top_features(st.importances(spark, folder), 15)


@query("latest_versions", "SELECT name, version, modality, metric FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY version DESC) AS rn FROM versions) WHERE rn <= 2",
       ("versions",))
def _(spark, folder):
    return rg.latest_versions(st.versions(spark, folder))


# Registry

@query("active_learners", """SELECT name, version, array_to_string(list_sort(list(DISTINCT alias)), ',') AS aliases FROM aliases
    WHERE alias IN ('active_stateless', 'active_stateful') GROUP BY name, version""", ("aliases",))
def _(spark, folder):
    active = rg.active_learners(st.aliases(spark, folder), ["active_stateless", "active_stateful"])
    return active.withColumn("aliases", F.concat_ws(",", "aliases"))


@query("best_by_modality", """SELECT modality, name, version, metric FROM (SELECT v.*, row_number() OVER (PARTITION BY modality ORDER BY metric DESC, v.name, v.version) AS rn
    FROM versions v JOIN aliases a ON a.name = v.name AND a.version = v.version AND alias = 'active_stateless' WHERE metric IS NOT NULL) WHERE rn = 1""", ("aliases",))
def _(spark, folder):
    return rg.best_by_modality(st.versions(spark, folder), st.aliases(spark, folder), "stateless")


_HOLDER = """h AS (SELECT a.name, a.version AS holder_version, v.metric AS holder_metric FROM aliases a LEFT JOIN versions v
    ON v.name = a.name AND v.version = a.version WHERE alias = 'champion'),
    ch AS (SELECT v.name, v.version, v.metric FROM versions v JOIN aliases a ON a.name = v.name AND a.version = v.version
    AND alias = 'active_stateless' WHERE v.metric IS NOT NULL)"""


def _challengers(spark, folder):
    held = st.aliases(spark, folder).where(F.col("alias") == "active_stateless").select("name", "version")
    return st.versions(spark, folder).where(F.col("metric").isNotNull()).join(held, ["name", "version"]).select("name", "version", "metric")


@query("promotion_decision", f"""WITH {_HOLDER} SELECT ch.name, version, metric, holder_version, holder_metric, {s6('metric - holder_metric', 'gain')},
    holder_version IS NULL OR holder_metric IS NULL OR metric - holder_metric > 0.005::DOUBLE AS promoted FROM ch LEFT JOIN h USING (name)""", ("aliases",))
def _(spark, folder):
    decided = rg.promotion_decision(_challengers(spark, folder), st.versions(spark, folder), st.aliases(spark, folder), "champion")
    return decided.withColumn("gain", r6("gain"))


@query("promotion_gain_geq", f"""WITH {_HOLDER} SELECT ch.name, version, metric, holder_version, holder_metric, {s6('metric - holder_metric', 'gain')},
    holder_metric IS NULL OR metric - holder_metric >= 0.005::DOUBLE AS promoted,
    CASE WHEN holder_metric IS NULL THEN 'no_holder' WHEN metric - holder_metric >= 0.005::DOUBLE THEN 'gain_reached'
    ELSE 'gain_too_small' END AS decided_by, 0.005::DOUBLE AS epsilon
    FROM ch LEFT JOIN h USING (name)""", ("aliases",))
def _(spark, folder):
    decided = rg.promotion_gain_geq(_challengers(spark, folder), st.versions(spark, folder), st.aliases(spark, folder), "champion")
    return decided.withColumn("gain", r6("gain"))


def _contest(spark, folder):
    """Runs per nation: customers are challengers, every fourth is the champion's re-score."""
    nation = st.table(spark, folder, "nation")
    return st.table(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("name"), F.when(F.col("c_custkey") % 4 == 0, "champion").otherwise("challenger").alias("role"),
        F.when(F.col("c_custkey") % 4 == 0, F.lit("regold")).otherwise(F.concat(F.lit("run_"), (F.col("c_custkey") % 3).cast("string"))).alias("run_name"),
        F.col("c_custkey").alias("run_id"), F.col("c_custkey").alias("version"), F.col("c_custkey").alias("start_time"),
        F.when(F.col("c_custkey") % 17 != 0, F.col("c_acctbal") / 10000.0).alias("metric"))


@query("compare_and_promote", f"""WITH contest AS (SELECT n_name AS name, c_custkey % 4 = 0 AS champion,
    CASE WHEN c_custkey % 4 = 0 THEN 'regold' ELSE 'run_' || CAST(c_custkey % 3 AS VARCHAR) END AS run_name, c_custkey AS run_id,
    CASE WHEN c_custkey % 17 <> 0 THEN c_acctbal / 10000.0::DOUBLE END AS metric FROM customer JOIN nation ON c_nationkey = n_nationkey),
    newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name, champion, run_name ORDER BY run_id DESC) AS rn FROM contest) WHERE rn = 1),
    best AS (SELECT * FROM (SELECT name, run_name AS best_challenger, run_id AS best_version, metric AS best_metric,
        row_number() OVER (PARTITION BY name ORDER BY metric DESC, run_name DESC) AS r FROM newest WHERE NOT champion AND metric IS NOT NULL) WHERE r = 1),
    j AS (SELECT best.name, best_challenger, best_version, best_metric, a.version AS champion_version, c.metric AS champion_metric
        FROM best LEFT JOIN (SELECT * FROM aliases WHERE alias = 'champion') a ON a.name = best.name LEFT JOIN (SELECT * FROM newest WHERE champion) c ON c.name = best.name)
    SELECT name, best_challenger, best_version, best_metric, champion_version, champion_metric,
    {s6('CASE WHEN champion_version IS NOT NULL THEN best_metric - champion_metric END', 'gain')},
    CASE WHEN champion_version IS NULL THEN 'promote_first' WHEN champion_metric IS NULL THEN 'no_decision'
    WHEN best_metric - champion_metric >= 0.005::DOUBLE THEN 'promote' ELSE 'keep' END AS decision FROM j""", ("aliases",))
def _(spark, folder):
    decided = rg.compare_and_promote(_contest(spark, folder), st.aliases(spark, folder), "champion")
    return decided.withColumn("gain", r6("gain"))


@query("tournament", """SELECT v.name, v.version, alias, metric FROM aliases a JOIN versions v ON v.name = a.name AND v.version = a.version
    WHERE metric IS NOT NULL AND alias IN ('champion', 'active_stateful') ORDER BY metric DESC, v.name, v.version, alias LIMIT 1""", ("aliases",))
def _(spark, folder):
    return rg.tournament(st.versions(spark, folder), st.aliases(spark, folder), ["champion", "active_stateful"])


@query("move_alias", """WITH moves AS (SELECT name, 'champion' AS alias, version FROM aliases WHERE alias = 'active_stateless')
    SELECT name, alias, version FROM aliases WHERE alias <> 'champion' OR name NOT IN (SELECT name FROM moves) UNION ALL SELECT * FROM moves""", ("aliases",))
def _(spark, folder):
    aliases = st.aliases(spark, folder)
    moves = aliases.where(F.col("alias") == "active_stateless").withColumn("alias", F.lit("champion"))
    return rg.move_alias(aliases, moves)


@query("best_version", """WITH recent AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY version DESC) AS rn FROM versions) WHERE rn <= 2 AND metric IS NOT NULL),
    best AS (SELECT * FROM (SELECT name, version, metric, row_number() OVER (PARTITION BY name ORDER BY metric DESC, version) AS r FROM recent) WHERE r = 1)
    SELECT name, version, metric, row_number() OVER (ORDER BY metric DESC, name) = 1 AS is_best FROM best""", ("versions",))
def _(spark, folder):
    return rg.best_version(st.versions(spark, folder))


@query("alias_fallback", """SELECT m.name, coalesce(p.version, f.version) AS version,
    CASE WHEN p.version IS NOT NULL THEN 'active_stateful' WHEN f.version IS NOT NULL THEN 'active_stateless' END AS alias_used
    FROM (SELECT DISTINCT n_name AS name FROM nation) m LEFT JOIN (SELECT * FROM aliases WHERE alias = 'active_stateful') p ON p.name = m.name
    LEFT JOIN (SELECT * FROM aliases WHERE alias = 'active_stateless') f ON f.name = m.name""", ("aliases",))
def _(spark, folder):
    models = st.table(spark, folder, "nation").select(F.col("n_name").alias("name"))
    return rg.alias_fallback(models, st.aliases(spark, folder), "active_stateful", "active_stateless")


@query("learning_curve", "SELECT o_orderkey AS run_id, o_custkey AS train_pool_size, o_totalprice AS f1_gold FROM orders")
def _(spark, folder):
    runs = st.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("train_pool_size"), F.col("o_totalprice").alias("f1_gold"))
    return ag.learning_curve(runs)


@query("request_counts", "SELECT method, endpoint, count(*) AS n_requests FROM queue GROUP BY method, endpoint", ("queue",))
def _(spark, folder):
    return ag.request_counts(st.queue(spark, folder))


# Monitoring

@query("windowed_rate", f"""SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start, {s6('sum(value) / 60', 'rate')}, count(*) AS n FROM events GROUP BY 1""")
def _(spark, folder):
    rate = mo.windowed_rate(st.table(spark, folder, "events"), "ts", "value")
    return rate.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), r6("rate"), "n")


@query("windowed_rate_5m", f"""SELECT w AS window_start, event_type, {s6('sum(value) / 300', 'rate')}, count(*) AS n FROM
    (SELECT event_type, value, unnest([time_bucket(INTERVAL '1 minute', ts) - INTERVAL '1 minute' * k FOR k IN range(5)]) AS w FROM events) GROUP BY 1, 2""")
def _(spark, folder):
    rate = mo.windowed_rate(st.table(spark, folder, "events"), "ts", "value", "5 minutes", "1 minute", ("event_type",))
    return rate.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", r6("rate"), "n")


@query("latest_gauge", """SELECT user_id, ts AS at, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def _(spark, folder):
    return mo.latest_gauge(st.table(spark, folder, "events"), "user_id", "ts", "value", "event_id")


# Batch scoring on request

def _with_text_model(spark, folder):
    """A scorer that looks up the text model's probabilities."""
    model = st.text_model(spark, folder).select("productid", "p")
    return lambda rows: rows.join(model, "productid").withColumn("pred", V.argmax(F.col("p")))


@query("score_requested", """SELECT productid, imageid, pred FROM catalog JOIN rows_text USING (productid)
    WHERE productid IN (SELECT o_custkey FROM orders)""", ("catalog", "rows_text"))
def _(spark, folder):
    requested = st.table(spark, folder, "orders").select(F.col("o_custkey").alias("productid"))
    pool = st.catalog(spark, folder).select("productid", "imageid")
    return jobs.score_requested(requested, pool, _with_text_model(spark, folder)).select("productid", "imageid", "pred")


@query("rescore_all", """SELECT productid, imageid, pred FROM catalog JOIN rows_text USING (productid)
    WHERE productid IN (SELECT event_id FROM events)""", ("catalog", "rows_text"))
def _(spark, folder):
    predicted = st.queue(spark, folder).select("productid")
    pool = st.catalog(spark, folder).select("productid", "imageid")
    return jobs.rescore_all(predicted, pool, _with_text_model(spark, folder)).select("productid", "imageid", "pred")
