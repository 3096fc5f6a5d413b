"""The driver's tables seen as the engine's inputs: Spark frames and the same views in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogflow.functions import vectors as V
from catalogflow.functions.hashing import is_gold

N_CLASSES = 10  # classes of the embeddings table


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    return table(spark, folder, name)


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    return _as_catalog(table(spark, folder, "documents"))


def wide_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """The catalog for work on its texts."""
    return _as_catalog(texts(spark, folder))


def _as_catalog(documents: DataFrame) -> DataFrame:
    """Title and description together hold the whole text; where there is no description the title holds it all."""
    text = F.col("text")
    return documents.select(
        F.col("doc_id").alias("productid"),
        (F.col("doc_id") * 7 + 1).alias("imageid"),
        F.when((F.col("doc_id") % 5 == 0) | (F.col("doc_id") % 7 == 0), text).otherwise(
            F.substring(text, 1, 60)).alias("designation"),
        F.when(F.col("doc_id") % 5 == 0, None).when(F.col("doc_id") % 7 == 0, "   ")
        .otherwise(text.substr(F.lit(61), F.length(text))).alias("description"),
        (F.col("doc_id") % 3 + 1).cast("int").alias("batch_id"),
    )


def catalog_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled products; their class comes from the source number."""
    labelled = table(spark, folder, "labels").select("doc_id").distinct()
    return table(spark, folder, "documents").join(labelled, "doc_id", "left_semi").select(
        F.col("doc_id").alias("productid"),
        (F.substring("source", 4, 10).cast("int") * 10).alias("prdtypecode"),
    )


def classes_of_all(spark: SparkSession, folder: str) -> DataFrame:
    """Every product with a class: key, class, batch and gold flag."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("productid"),
        (F.substring("source", 4, 10).cast("int") * 10).alias("prdtypecode"),
        (F.col("doc_id") % 3 + 1).cast("int").alias("batch_id"),
        is_gold(F.col("doc_id")).alias("is_gold"),
    )


def flagged(spark: SparkSession, folder: str) -> DataFrame:
    """Products with gold flag; never set (null) on every eleventh product."""
    return catalog(spark, folder).withColumn(
        "is_gold", F.when(F.col("productid") % 11 != 3, is_gold(F.col("productid")))
    )


def split_table(spark: SparkSession, folder: str) -> DataFrame:
    """Every product with class, batch, gold flag and a hash-made validation flag (v2)."""
    from catalogflow.functions.hashing import gold_bucket

    marked = (gold_bucket(F.concat(F.lit("v2:"), F.col("productid").cast("string"))) == 0)
    return classes_of_all(spark, folder).withColumn(
        "is_val_selection_v2", F.when(F.col("batch_id") <= 2, marked & ~F.col("is_gold"))
    )


def parts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("productid"), F.col("p_type").alias("type"), F.col("p_brand").alias("brand"),
        F.col("p_size").alias("size"),
    )


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Two modality caches in one frame, 32 dimensions each."""
    e = V.doubles(F.col("embedding"))
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("productid"), F.col("label").cast("int").alias("label"),
        F.slice(e, 1, 32).alias("text_vector"), F.slice(e, 33, 32).alias("image_vector"),
        F.slice(e, 21, 12).alias("tabular"),
    )


def _logits(first: int):
    return F.transform(F.slice("embedding", first, N_CLASSES), lambda x: x.cast("double") * 4.0)


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Label and the probabilities of two models, with a fused prediction."""
    rows = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("productid"), F.col("label").cast("int").alias("y"),
        V.softmax(_logits(1)).alias("p_text"), V.softmax(_logits(11)).alias("p_image"),
    )
    return rows.withColumn("pred_meta", V.argmax(F.zip_with("p_text", "p_image", lambda a, b: a + b)))


def text_model(spark: SparkSession, folder: str) -> DataFrame:
    return scored(spark, folder).select("productid", "y", F.col("p_text").alias("p"))


def image_model(spark: SparkSession, folder: str) -> DataFrame:
    return scored(spark, folder).select("productid", "y", F.col("p_image").alias("p"))


def versions(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    return table(spark, folder, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("name"), F.col("s_suppkey").alias("version"),
        F.when(F.col("n_regionkey") % 2 == 0, "text").otherwise("image").alias("modality"),
        F.when(F.col("s_suppkey") % 13 != 5, F.col("s_acctbal") / 10000.0).alias("metric"),
    )


def aliases(spark: SparkSession, folder: str) -> DataFrame:
    """Highest version stateless, lowest stateful (if it differs), champion on even versions' minimum."""
    per_model = versions(spark, folder).groupBy("name").agg(
        F.max("version").alias("hi"), F.min("version").alias("lo"),
        F.min(F.when(F.col("version") % 2 == 0, F.col("version"))).alias("champion"),
    )
    entries = F.array(
        F.struct(F.lit("active_stateless").alias("alias"), F.col("hi").alias("version")),
        F.struct(F.lit("active_stateful").alias("alias"), F.when(F.col("lo") < F.col("hi"), F.col("lo")).alias("version")),
        F.struct(F.lit("champion").alias("alias"), F.col("champion").alias("version")),
    )
    return per_model.select("name", F.explode(entries).alias("e")).where(F.col("e.version").isNotNull()).select(
        "name", "e.alias", "e.version")


def runs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("run_id"),
        F.concat(F.lit("run_"), F.col("o_custkey").cast("string")).alias("run_name"),
        F.col("o_orderdate").alias("start_time"),
        (F.col("o_totalprice") / 600000.0).alias("metric"),
    )


def trials(spark: SparkSession, folder: str) -> DataFrame:
    """Fold scores: order = trial, line = fold."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("trial"), F.col("l_linenumber").alias("fold"),
        (F.col("l_extendedprice") / 100000.0).alias("score"), F.col("l_quantity").cast("int").alias("best_iter"),
    )


def importances(spark: SparkSession, folder: str) -> DataFrame:
    """Feature names of every family with gain and split counts."""
    kind = F.element_at(F.array(*[F.lit(k) for k in ("p_text_class_", "p_image_class_", "tab__", "derived__")]),
                        (F.col("p_partkey") % 4 + 1).cast("int"))
    return table(spark, folder, "part").select(
        F.concat(kind, F.col("p_partkey").cast("string")).alias("feature"),
        F.col("p_retailprice").alias("gain"), F.col("p_size").cast("long").alias("split"),
    )


def queue(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_id").alias("productid"), F.col("ts").alias("arrived_at"),
        F.col("event_type").alias("method"), (F.col("user_id") % 5).alias("endpoint"), F.col("value").alias("duration"),
    )


# The same views for the oracle, each with the views it is built on.


def _probability(first: int) -> str:
    z = f"list_transform(embedding[{first}:{first + N_CLASSES - 1}], lambda v: CAST(v AS DOUBLE) * 4.0::DOUBLE)"
    return z


GOLD = "(concat('0x', substr(md5(CAST({key} AS VARCHAR)), 1, 16))::UBIGINT % 10 = 0)"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "catalog": ((), """SELECT doc_id AS productid, doc_id * 7 + 1 AS imageid,
        CASE WHEN doc_id % 5 = 0 OR doc_id % 7 = 0 THEN text ELSE substring(text, 1, 60) END AS designation,
        CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN '   ' ELSE substring(text, 61) END AS description,
        CAST(doc_id % 3 + 1 AS INTEGER) AS batch_id FROM documents"""),
    "catalog_labels": ((), """SELECT doc_id AS productid, CAST(substring(source, 4) AS INTEGER) * 10 AS prdtypecode
        FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)"""),
    "classes": ((), f"""SELECT doc_id AS productid, CAST(substring(source, 4) AS INTEGER) * 10 AS prdtypecode,
        CAST(doc_id % 3 + 1 AS INTEGER) AS batch_id, {GOLD.format(key='doc_id')} AS is_gold FROM documents"""),
    "flagged": (("catalog",), f"""SELECT *, CASE WHEN productid % 11 <> 3 THEN {GOLD.format(key='productid')} END AS is_gold
        FROM catalog"""),
    "split_table": (("classes",), """SELECT *, CASE WHEN batch_id <= 2 THEN
        (concat('0x', substr(md5('v2:' || CAST(productid AS VARCHAR)), 1, 16))::UBIGINT % 10 = 0) AND NOT is_gold END
        AS is_val_selection_v2 FROM classes"""),
    "parts": ((), """SELECT p_partkey AS productid, p_type AS type, p_brand AS brand, p_size AS size FROM part"""),
    "vectors": ((), """SELECT vec_id AS productid, CAST(label AS INTEGER) AS label,
        list_transform(embedding[1:32], lambda v: CAST(v AS DOUBLE)) AS text_vector,
        list_transform(embedding[33:64], lambda v: CAST(v AS DOUBLE)) AS image_vector,
        list_transform(embedding[21:32], lambda v: CAST(v AS DOUBLE)) AS tabular FROM embeddings"""),
    "logits": ((), f"""SELECT vec_id AS productid, CAST(label AS INTEGER) AS y, {_probability(1)} AS z1,
        {_probability(11)} AS z2 FROM embeddings"""),
    "maxima": (("logits",), "SELECT *, list_max(z1) AS m1, list_max(z2) AS m2 FROM logits"),
    "exps": (("maxima",), """SELECT productid, y, list_transform(z1, lambda v: exp(v - m1)) AS e1,
        list_transform(z2, lambda v: exp(v - m2)) AS e2 FROM maxima"""),
    "sums": (("exps",), "SELECT *, list_sum(e1) AS s1, list_sum(e2) AS s2 FROM exps"),
    "pair": (("sums",), """SELECT productid, y, list_transform(e1, lambda v: v / s1) AS p_text,
        list_transform(e2, lambda v: v / s2) AS p_image FROM sums"""),
    "fused": (("pair",), """SELECT *, list_transform(list_zip(p_text, p_image), lambda t: t[1] + t[2]) AS p_sum FROM pair"""),
    "scored": (("fused",), """SELECT productid, y, p_text, p_image,
        CAST(list_position(p_sum, list_max(p_sum)) - 1 AS INTEGER) AS pred_meta FROM fused"""),
    "rows_text": (("pair",), """SELECT productid, y, p_text AS p, CAST(list_position(p_text, list_max(p_text)) - 1 AS INTEGER) AS pred,
        list_max(p_text) AS conf, list_reverse_sort(p_text)[1] - list_reverse_sort(p_text)[2] AS margin,
        (list_position(p_text, list_max(p_text)) - 1 = y) AS correct FROM pair"""),
    "rows_image": (("pair",), """SELECT productid, y, p_image AS p, CAST(list_position(p_image, list_max(p_image)) - 1 AS INTEGER) AS pred,
        list_max(p_image) AS conf, (list_position(p_image, list_max(p_image)) - 1 = y) AS correct FROM pair"""),
    "versions": ((), """SELECT n_name AS name, s_suppkey AS version,
        CASE WHEN n_regionkey % 2 = 0 THEN 'text' ELSE 'image' END AS modality,
        CASE WHEN s_suppkey % 13 <> 5 THEN s_acctbal / 10000.0::DOUBLE END AS metric
        FROM supplier JOIN nation ON s_nationkey = n_nationkey"""),
    "per_model": (("versions",), """SELECT name, max(version) AS hi, min(version) AS lo,
        min(CASE WHEN version % 2 = 0 THEN version END) AS champion FROM versions GROUP BY name"""),
    "aliases": (("per_model",), """SELECT name, 'active_stateless' AS alias, hi AS version FROM per_model
        UNION ALL SELECT name, 'active_stateful', lo FROM per_model WHERE lo < hi
        UNION ALL SELECT name, 'champion', champion FROM per_model WHERE champion IS NOT NULL"""),
    "runs": ((), """SELECT o_orderkey AS run_id, 'run_' || CAST(o_custkey AS VARCHAR) AS run_name, o_orderdate AS start_time,
        o_totalprice / 600000.0::DOUBLE AS metric FROM orders"""),
    "trials": ((), """SELECT l_orderkey AS trial, l_linenumber AS fold, l_extendedprice / 100000.0::DOUBLE AS score,
        CAST(l_quantity AS INTEGER) AS best_iter FROM lineitem"""),
    "importances": ((), """SELECT (['p_text_class_', 'p_image_class_', 'tab__', 'derived__'])[p_partkey % 4 + 1]
        || CAST(p_partkey AS VARCHAR) AS feature, p_retailprice AS gain, CAST(p_size AS BIGINT) AS split FROM part"""),
    "queue": ((), """SELECT event_id AS productid, ts AS arrived_at, event_type AS method, user_id % 5 AS endpoint,
        value AS duration FROM events"""),
}


def with_views(body: str, *names: str) -> str:
    """``body`` preceded by the views it names and those they rest on."""
    needed: list[str] = []

    def add(name: str) -> None:
        for parent in VIEWS[name][0]:
            add(parent)
        if name not in needed:
            needed.append(name)

    for name in names:
        add(name)
    views = ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in needed)
    body = body.strip()
    if not views:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"
