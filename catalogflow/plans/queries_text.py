"""Queries on texts, identifiers, scans and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogflow.functions import text as tx
from catalogflow.operators import aggregates as ag
from catalogflow.operators import features as ft
from catalogflow.operators import filters as fl
from catalogflow.operators import joins as jn
from catalogflow.operators import registry as rg
from catalogflow.plans import jobs
from catalogflow.plans import standins as st
from catalogflow.plans.registry import query, r6, s6, s_spread, spread
from catalogflow.sources import readers as rd
from catalogflow.sources import writers as wr

D, E = "designation", "description"

STRIP = """CASE WHEN regexp_matches(coalesce(description, ''), '\\S') THEN coalesce(designation, '') || '. ' || description
    ELSE coalesce(designation, '') END"""
TRUTHY = """CASE WHEN coalesce(description, '') <> '' THEN coalesce(designation, '') || '. ' || description
    ELSE coalesce(designation, '') END"""


def noise(text: str) -> str:
    return (
        f"regexp_replace(regexp_replace(regexp_replace(replace({text}, chr(10), '. '), '&#[0-9]+;', '', 'g'),"
        " '¿{2,}', ' ', 'g'), '[^\\x00-\\x7F]+', '', 'g')"
    )


def cleaned(text: str) -> str:
    """The cleaning of descriptions in SQL, without a parser."""
    cut = (
        f"regexp_replace({text}, '(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<!--.*?-->|<[!/?]?[a-z][^>]*>',"
        " chr(1), 'g')"
    )
    for name, sign in (("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&apos;", "''"), ("&nbsp;?", "\u00a0"), ("&amp;?", None)):
        cut = f"regexp_replace({cut}, '{name}', {'chr(2)' if sign is None else chr(39) + sign + chr(39)}, 'g')"
    cut = f"replace(regexp_replace({cut}, '&[a-zA-Z][a-zA-Z0-9]*;', chr(65533), 'g'), chr(2), '&')"
    pieces = f"list_transform(string_split({cut}, chr(1)), lambda x: regexp_replace(x, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g'))"
    return noise(f"array_to_string(list_filter({pieces}, lambda x: x <> ''), chr(10))")


def tokens(text: str) -> str:
    marks = r"""[\.,;:!?\(\)\[\]\{\}"''`~/\\\-_<>\|=\+\*&%\$#@]"""
    return (
        f"list_filter(regexp_split_to_array(regexp_replace(lower({text}), '{marks}', ' ', 'g'), '\\s+'),"
        " lambda t: t <> '')"
    )


TABULAR = f"""texts AS (SELECT productid, imageid, designation, description, {TRUTHY} AS t FROM catalog),
tab AS (SELECT productid, imageid, CAST(length(t) AS INTEGER) AS tab_text_length,
    CAST(len(list_filter(regexp_split_to_array(t, '\\s+'), lambda w: w <> '')) AS INTEGER) AS tab_word_count,
    CAST(length(coalesce(designation, '')) AS INTEGER) AS tab_designation_length,
    CAST(regexp_matches(coalesce(description, ''), '\\S') AS INTEGER) AS tab_description_present,
    {s6("CASE WHEN length(t) > 0 THEN (length(t) - length(regexp_replace(t, '\\p{Lu}', '', 'g'))) / length(t) ELSE 0 END", "tab_uppercase_ratio")},
    {s6("CASE WHEN length(t) > 0 THEN (length(t) - length(regexp_replace(t, '\\p{Nd}', '', 'g'))) / length(t) ELSE 0 END", "tab_digit_ratio")},
    {s6("CASE WHEN length(t) > 0 THEN (length(t) - length(regexp_replace(t, '[.,;:!?\\-]', '', 'g'))) / length(t) ELSE 0 END", "tab_punct_density")}
    FROM texts)"""
_TAB = ["tab_text_length", "tab_word_count", "tab_designation_length", "tab_description_present"]
_RATIOS = ["tab_uppercase_ratio", "tab_digit_ratio", "tab_punct_density"]


def rounded_tabular(df, *keys):
    return df.select(*keys, *_TAB, *[r6(c) for c in _RATIOS])


# Scans

@query("scan_products", "SELECT productid, designation FROM catalog WHERE batch_id IN (1, 2)", ("catalog",))
def _(spark, folder):
    return rd.scan_products(st.catalog(spark, folder), [1, 2], ["productid", "designation"])


@query("scan_cache", "SELECT vec_id, label FROM embeddings")
def _(spark, folder):
    return rd.scan_cache(spark, f"{folder}/embeddings.parquet", ["vec_id", "label"])


@query("scan_limited", "SELECT productid, designation FROM catalog ORDER BY productid LIMIT 100", ("catalog",))
def _(spark, folder):
    return rd.scan_limited(st.catalog(spark, folder).select("productid", "designation"), 100)


@query("distinct_keys", "SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem")
def _(spark, folder):
    return rd.distinct_keys(st.table(spark, folder, "lineitem"), ["l_orderkey", "l_suppkey"])


# Sinks

@query("upsert_columns", f"""SELECT productid, batch_id, coalesce(is_gold, {st.GOLD.format(key='productid')}) AS is_gold
    FROM flagged""", ("flagged",))
def _(spark, folder):
    base = st.flagged(spark, folder).select("productid", "batch_id", "is_gold")
    delta = fl.missing_field(base, "is_gold").select("productid", tx_gold(F.col("productid")).alias("is_gold"))
    return jn.upsert_columns(base, delta, "productid", ["is_gold"])


def tx_gold(key):
    from catalogflow.functions.hashing import is_gold

    return is_gold(key)


@query("reset_flag", """SELECT productid, batch_id, CASE WHEN batch_id <= 1 THEN false ELSE is_val_selection_v2 END
    AS is_val_selection_v2 FROM split_table""", ("split_table",))
def _(spark, folder):
    rows = st.split_table(spark, folder).select("productid", "batch_id", "is_val_selection_v2")
    return jn.reset_flag(rows, "is_val_selection_v2", 1)


@query("delete_by_keys", """SELECT productid, method FROM queue WHERE productid NOT IN
    (SELECT productid FROM queue WHERE arrived_at < TIMESTAMP '2024-01-15')""", ("queue",))
def _(spark, folder):
    queue = st.queue(spark, folder)
    snapshot = queue.where(F.col("arrived_at") < F.lit("2024-01-15").cast("timestamp_ntz"))
    return jn.delete_by_keys(queue.select("productid", "method"), snapshot)


@query("append_cache", """SELECT productid, CASE WHEN productid % 4 <> 0 THEN 'cached' ELSE 'new' END AS origin FROM catalog""",
       ("catalog",))
def _(spark, folder):
    keys = st.catalog(spark, folder).select("productid")
    cached = keys.where(F.col("productid") % 4 != 0).withColumn("origin", F.lit("cached"))
    return wr.append_cache(cached, keys.withColumn("origin", F.lit("new")))


@query("write_lineage_cache", """SELECT productid, text_vector[1] AS text_feat_0, text_vector[2] AS text_feat_1, batch_id, is_gold,
    is_val_selection_v2, 'base-text' AS source_model_name, 7 AS source_model_version
    FROM vectors JOIN split_table USING (productid)""", ("vectors", "split_table"))
def _(spark, folder):
    features = st.vectors(spark, folder).select(
        "productid", F.get("text_vector", F.lit(0)).alias("text_feat_0"), F.get("text_vector", F.lit(1)).alias("text_feat_1"))
    return jobs.write_learner_cache(features, st.split_table(spark, folder), "base-text", 7, ["is_val_selection_v2"])


_DIMENSION = """dim AS (SELECT prdtypecode, CAST(row_number() OVER (ORDER BY prdtypecode) - 1 AS INTEGER) AS label
    FROM (SELECT DISTINCT prdtypecode FROM catalog_labels))"""


@query("write_prediction_rows", f"""WITH {_DIMENSION}
    SELECT r.productid, designation, imageid, d.prdtypecode AS prediction, {s6("conf", "confidence")},
    '2024-01-31T00:00:00' AS date_pred, 'best-stack@v3' AS model, 'stacking' AS model_family
    FROM rows_text r JOIN catalog c USING (productid) JOIN dim d ON d.label = r.pred""", ("rows_text", "catalog", "catalog_labels"))
def _(spark, folder):
    from catalogflow.functions.vectors import argmax

    scored = st.text_model(spark, folder).join(st.catalog(spark, folder), "productid").withColumn("label", argmax(F.col("p")))
    named = jn.decode_label(scored, jn.class_dimension(st.catalog_labels(spark, folder)))
    rows = wr.prediction_rows(named, F.lit("2024-01-31T00:00:00"), F.lit("best-stack"), F.lit(3), F.lit("stacking"))
    return rows.withColumn("confidence", r6("confidence"))


@query("export_probabilities", f"SELECT productid, y AS label, {s_spread('p_text', 10, 'p')} FROM pair", ("pair",))
def _(spark, folder):
    rows = st.text_model(spark, folder).withColumnRenamed("y", "label")
    wide = wr.export_probabilities(rows, st.N_CLASSES)
    return wide.select("productid", "label", *[r6(f"p_{i}") for i in range(st.N_CLASSES)])


@query("log_metrics", """SELECT run_id, 'f1' AS key, metric AS value FROM runs
    UNION ALL SELECT run_id, 'started_year', CAST(year(start_time) AS DOUBLE) FROM runs""", ("runs",))
def _(spark, folder):
    rows = st.runs(spark, folder).select("run_id", F.col("metric").alias("f1"), F.year("start_time").alias("started_year"))
    return rg.long_metrics(rows, "run_id", ["f1", "started_year"])


@query("export_training_rows", f"""SELECT CAST(label AS BIGINT) AS label, CAST(len(text_vector) AS INTEGER) AS text_width, CAST(len(image_vector) AS INTEGER) AS image_width,
    {s6("list_sum(text_vector)", "text_sum")}, {s6("list_sum(image_vector)", "image_sum")} FROM vectors""", ("vectors",))
def _(spark, folder):
    from catalogflow.functions.vectors import doubles, vsum

    rows = wr.training_rows(st.vectors(spark, folder), "text_vector", "image_vector", "label")
    return rows.select("label", F.size("text").alias("text_width"), F.size("image").alias("image_width"),
                       r6(vsum(doubles(F.col("text"))), "text_sum"), r6(vsum(doubles(F.col("image"))), "image_sum"))


def _written(spark, name):
    from catalogflow.session import fresh_path

    return fresh_path(spark, name)


@query("replace_table", "SELECT productid, designation, batch_id FROM catalog WHERE batch_id = 2", ("catalog",))
def _(spark, folder):
    path = _written(spark, "products")
    wr.replace_table(st.catalog(spark, folder), path)
    return rd.scan_products(spark.read.parquet(path), [2], ["productid", "designation", "batch_id"])


@query("append_table", "SELECT productid, batch_id FROM catalog", ("catalog",))
def _(spark, folder):
    path, keys = _written(spark, "products"), st.catalog(spark, folder).select("productid", "batch_id")
    for batch in (1, 2, 3):
        wr.append_table(rd.scan_products(keys, [batch]), path)
    return spark.read.parquet(path)


@query("write_snapshot", "SELECT productid, batch_id FROM catalog WHERE batch_id <> 2", ("catalog",))
def _(spark, folder):
    root, keys = _written(spark, "snapshots"), st.catalog(spark, folder).select("productid", "batch_id")
    wr.write_snapshot(keys, root)
    wr.write_snapshot(jn.delete_by_keys(wr.read_snapshot(spark, root), rd.scan_products(keys, [2])), root)
    return wr.read_snapshot(spark, root)


@query("export_batches", "SELECT productid, prdtypecode, batch_id FROM classes", ("classes",))
def _(spark, folder):
    path, rows = _written(spark, "batches"), st.classes_of_all(spark, folder)
    wr.export_batches(rows.select("productid", "batch_id"), rows.select("productid", "prdtypecode", "batch_id"), path)
    return spark.read.schema("productid long, prdtypecode int, batch_id int").option("header", True).csv(f"{path}/y")


@query("read_indexed_csv", """SELECT productid * 3 AS row_id, designation, nullif(description, '') AS description, productid, imageid FROM catalog""", ("catalog",))
def _(spark, folder):
    from catalogflow.schemas import RAW_PRODUCTS

    path = _written(spark, "raw")
    raw = st.catalog(spark, folder).select((F.col("productid") * 3).alias("row_id"), "designation", "description", "productid", "imageid")
    raw.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).option("emptyValue", "").csv(path)
    return rd.read_indexed_csv(spark, path, RAW_PRODUCTS)


# Texts

@query("full_text_strip", f"SELECT productid, {STRIP} AS full_text FROM catalog", ("catalog",))
def _(spark, folder):
    return st.catalog(spark, folder).select("productid", tx.full_text_strip(D, E).alias("full_text"))


@query("full_text_truthy", f"SELECT productid, {TRUTHY} AS full_text FROM catalog", ("catalog",))
def _(spark, folder):
    return st.catalog(spark, folder).select("productid", tx.full_text_truthy(D, E).alias("full_text"))


@query("full_text_ignore_nulls", "SELECT productid, concat_ws('. ', designation, description) AS full_text FROM catalog", ("catalog",))
def _(spark, folder):
    return st.catalog(spark, folder).select("productid", tx.full_text_ignore_nulls(D, E).alias("full_text"))


@query("full_text_spaced", f"""SELECT productid, regexp_replace(coalesce(designation, '') || ' ' ||
    {cleaned("coalesce(description, '')")}, '^\\s+|\\s+$', '', 'g') AS full_text FROM catalog""", ("catalog",))
def _(spark, folder):
    return st.wide_catalog(spark, folder).select("productid", tx.full_text_spaced(D, E).alias("full_text"))


@query("clean_description", f"SELECT page_id, {cleaned('html')} AS text FROM pages")
def _(spark, folder):
    return st.texts(spark, folder, "pages").select("page_id", tx.clean_description(F.col("html")).alias("text"))


@query("clean_description_native", f"SELECT page_id, {cleaned('html')} AS text FROM pages")
def _(spark, folder):
    return st.texts(spark, folder, "pages").select("page_id", tx.clean_description_native(F.col("html")).alias("text"))


@query("text_or_recompute", f"""SELECT productid, CASE WHEN productid % 3 = 2 THEN 'stored ' || productid ELSE {cleaned('full_text')} END AS text
    FROM (SELECT productid, {STRIP} AS full_text FROM catalog)""", ("catalog",))
def _(spark, folder):
    key = F.col("productid")
    stored = F.when(key % 3 == 1, "").when(key % 3 == 2, F.concat(F.lit("stored "), key.cast("string")))
    return st.wide_catalog(spark, folder).select("productid", tx.text_or_recompute(stored, D, E).alias("text"))


@query("text_tabular", f"WITH {TABULAR} SELECT * EXCLUDE (imageid) FROM tab", ("catalog",))
def _(spark, folder):
    return rounded_tabular(st.wide_catalog(spark, folder).select("productid", *tx.text_tabular(D, E)), "productid")


@query("image_path", """SELECT productid, 'images/image_' || CAST(imageid AS VARCHAR) || '_product_' || CAST(productid AS VARCHAR)
    || '.jpg' AS image_path FROM catalog""", ("catalog",))
def _(spark, folder):
    path = tx.image_path(F.col("imageid"), F.col("productid"), "images/")
    return st.catalog(spark, folder).select("productid", path.alias("image_path"))


@query("encode_label", f"WITH {_DIMENSION} SELECT productid, prdtypecode, label FROM catalog_labels JOIN dim USING (prdtypecode)",
       ("catalog_labels",))
def _(spark, folder):
    labels = st.catalog_labels(spark, folder)
    return jn.encode_label(labels, jn.class_dimension(labels)).select("productid", "prdtypecode", "label")


@query("decode_label", f"WITH {_DIMENSION} SELECT vectors.productid, label, prdtypecode FROM vectors JOIN dim USING (label)",
       ("catalog_labels", "vectors"))
def _(spark, folder):
    dimension = jn.class_dimension(st.catalog_labels(spark, folder))
    return jn.decode_label(st.vectors(spark, folder).select("productid", "label"), dimension).select(
        "productid", "label", "prdtypecode")


@query("model_tag", "SELECT name, version, name || '@v' || CAST(version AS VARCHAR) AS tag, name || '_' || CAST(version AS VARCHAR) AS plain FROM versions",
       ("versions",))
def _(spark, folder):
    n, v = F.col("name"), F.col("version")
    return st.versions(spark, folder).select("name", "version", tx.model_tag(n, v).alias("tag"), tx.model_tag(n, v, "_").alias("plain"))


@query("tokenize", f"""SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS tokens
    FROM (SELECT doc_id, {tokens('text')} AS t FROM documents)""")
def _(spark, folder):
    rows = st.texts(spark, folder).select("doc_id", tx.tokenize(F.col("text")).alias("t"))
    return rows.select("doc_id", F.size("t").alias("n_tokens"), F.concat_ws(" ", "t").alias("tokens"))


_TRAIN_TEXT = f"""train AS (SELECT d.doc_id, d.text FROM documents d JOIN classes c ON d.doc_id = c.productid
    WHERE batch_id IN (1, 2) AND NOT is_gold),
counted AS (SELECT token, count(*) AS n FROM (SELECT unnest({tokens('text')}) AS token FROM train) GROUP BY token),
vocab AS (SELECT token, n, id FROM (SELECT token, n, row_number() OVER (ORDER BY n DESC, token) + 1 AS id FROM counted)
    WHERE id <= TOP_K - 1)"""


def _training_text(spark, folder):
    keys = fl.train_pool(st.classes_of_all(spark, folder), [1, 2]).select(F.col("productid").alias("doc_id"))
    return st.texts(spark, folder).select("doc_id", "text").join(keys, "doc_id", "left_semi")


@query("vocabulary", f"WITH {_TRAIN_TEXT.replace('TOP_K', '1000')} SELECT token, n, CAST(id AS INTEGER) AS id FROM vocab", ("classes",))
def _(spark, folder):
    return ag.vocabulary(_training_text(spark, folder), "text", 1000)


@query("encode_tokens", f"""WITH {_TRAIN_TEXT.replace('TOP_K', '5000')},
    cut AS (SELECT doc_id, list_slice({tokens('text')}, 1, 128) AS t FROM documents),
    placed AS (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) AS pos FROM cut WHERE len(t) > 0),
    ids AS (SELECT doc_id, list(coalesce(id, 1) ORDER BY pos) AS l FROM placed LEFT JOIN vocab USING (token) GROUP BY doc_id)
    SELECT doc_id, rtrim(array_to_string(coalesce(l, []), ',') || repeat(',0', 128 - len(coalesce(l, []))), '') AS ids
    FROM documents LEFT JOIN ids USING (doc_id)""", ("classes",))
def _(spark, folder):
    vocab = ag.vocabulary(_training_text(spark, folder), "text", 5000)
    coded = ag.encode_tokens(st.texts(spark, folder), vocab, "doc_id", "text", 128)
    return coded.select("doc_id", F.concat_ws(",", F.transform("ids", lambda x: x.cast("string"))).alias("ids"))


@query("feature_group", """SELECT feature, CASE WHEN feature LIKE 'p_text_%' THEN 'text' WHEN feature LIKE 'p_image_%' THEN 'image'
    WHEN feature LIKE 'derived__%' THEN 'derived' ELSE 'tabular' END AS family FROM importances""", ("importances",))
def _(spark, folder):
    return st.importances(spark, folder).select("feature", tx.feature_group(F.col("feature")).alias("family"))


@query("composite_key", "SELECT CAST(imageid AS VARCHAR) || '_' || CAST(productid AS VARCHAR) AS key FROM catalog", ("catalog",))
def _(spark, folder):
    return st.catalog(spark, folder).select(tx.composite_key(F.col("imageid"), F.col("productid")).alias("key"))


@query("null_defaults", """SELECT productid, coalesce(designation, '') AS designation, coalesce(description, '') AS description,
    coalesce(is_gold, false) AS is_gold, coalesce(prdtypecode, -1) AS label, imageid
    FROM flagged LEFT JOIN catalog_labels USING (productid)""", ("flagged", "catalog_labels"))
def _(spark, folder):
    labels = st.catalog_labels(spark, folder).withColumnRenamed("prdtypecode", "label")
    rows = st.flagged(spark, folder).join(labels, "productid", "left").drop("batch_id")
    return tx.null_defaults(rows)


# Feature jobs

def _grey_images(spark, folder):
    """An 8 x 8 grey image per embedding; every seventh is unreadable, every fifth product has none."""
    level = F.transform("embedding", lambda x: F.floor((F.least(F.greatest(x.cast("double"), F.lit(-1.0)), F.lit(1.0)) + 1.0) * 127.0).cast("int"))
    data = F.unhex(F.concat_ws("", F.transform(level, lambda v: F.lpad(F.hex(v), 2, "0"))))
    broken = F.col("vec_id") % 7 == 0
    size = F.when(broken, -1).otherwise(8)
    return st.table(spark, folder, "embeddings").where(F.col("vec_id") % 5 != 0).select(
        F.col("vec_id").alias("productid"), F.when(broken, "unreadable").otherwise("ok").alias("status"),
        size.alias("height"), size.alias("width"), F.lit(1).alias("channels"), data.alias("data"))


_PIXELS = """pixels AS (SELECT vec_id AS productid, vec_id % 5 <> 0 AND vec_id % 7 <> 0 AS ok, list_transform(embedding,
    lambda x: floor((least(greatest(CAST(x AS DOUBLE), -1.0::DOUBLE), 1.0::DOUBLE) + 1.0::DOUBLE) * 127.0::DOUBLE)) AS px FROM embeddings)"""


@query("image_tabular", f"""WITH {_PIXELS} SELECT productid, CASE WHEN ok THEN 8 ELSE 0 END AS tab_image_width,
    CASE WHEN ok THEN 8 ELSE 0 END AS tab_image_height, 1.0::DOUBLE AS tab_image_aspect_ratio,
    {s6("CASE WHEN ok THEN list_avg(px) ELSE 0 END", "tab_image_brightness_mean")},
    {s6("CASE WHEN ok THEN list_stddev_pop(px) ELSE 0 END", "tab_image_brightness_std")} FROM pixels""")
def _(spark, folder):
    products = st.table(spark, folder, "embeddings").select(F.col("vec_id").alias("productid"))
    rows = ft.image_tabular(products, _grey_images(spark, folder))
    return rows.withColumns({c: r6(c) for c in rows.columns if "brightness" in c})


@query("image_embeddings", f"""WITH {_PIXELS} SELECT productid, 64 AS width, productid % 7 = 0 AS is_nan,
    CASE WHEN productid % 7 <> 0 THEN round(list_sum(px) / 255.0::DOUBLE, 3) + 0.0::DOUBLE END AS total
    FROM pixels WHERE productid % 5 <> 0""")
def _(spark, folder):
    from catalogflow.functions.vectors import doubles, has_nan, vsum

    v = F.col("image_vector")
    return ft.image_embeddings(_grey_images(spark, folder)).select(
        "productid", F.size(v).alias("width"), has_nan(v).alias("is_nan"),
        F.when(~has_nan(v), F.round(vsum(doubles(v)), 3) + F.lit(0.0)).alias("total"))


@query("text_embeddings")
def _(spark, folder):
    rows = st.texts(spark, folder).select("doc_id", "text")
    encoder = ft.fit_text_encoder(_training_text(spark, folder), "text")
    return ft.text_embeddings(rows, "text", encoder).select("doc_id", F.size("text_vector").alias("width"), "text_vector")


@query("build_features_incremental", f"WITH {TABULAR} SELECT * FROM tab WHERE productid % 4 = 0", ("catalog",))
def _(spark, folder):
    products = st.wide_catalog(spark, folder)
    cached = products.where(F.col("productid") % 4 != 0).select("productid")
    return rounded_tabular(ft.build_features_incremental(products, cached, ft.text_feature_rows), "productid", "imageid")


@query("prepare_scoring_rows", f"""WITH {TABULAR} SELECT tab.*, designation, {cleaned('full_text')} AS text,
    'image_' || CAST(tab.imageid AS VARCHAR) || '_product_' || CAST(tab.productid AS VARCHAR) || '.jpg' AS image_path
    FROM tab JOIN (SELECT productid, coalesce(designation, '') AS designation, {STRIP} AS full_text FROM catalog) USING (productid)""",
       ("catalog",))
def _(spark, folder):
    rows = ft.prepare_scoring_rows(st.wide_catalog(spark, folder))
    return rounded_tabular(rows, "productid", "imageid", "designation", "text", "image_path")


@query("ingest_batch_job", f"""SELECT productid, {st.GOLD.format(key='productid')} AS is_gold, {cleaned('full_text')} AS text
    FROM (SELECT productid, {STRIP} AS full_text FROM catalog JOIN catalog_labels USING (productid) WHERE batch_id = 1)""",
       ("catalog", "catalog_labels"))
def _(spark, folder):
    labels = st.catalog_labels(spark, folder)
    products = st.wide_catalog(spark, folder).join(labels.select("productid"), "productid", "left_semi")
    ready, _summary = jobs.ingest_batch(products, labels, 1, valid=range(0, 1000, 10))
    return ready.where(F.col("batch_id") == 1).select("productid", "is_gold", "text")
