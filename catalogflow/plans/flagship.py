"""The first end-to-end query: text, gold flag, labels, stratified split, class overview."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalogflow.functions.hashing import is_gold
from catalogflow.functions.text import clean_description, full_text_strip
from catalogflow.operators.joins import join_labels
from catalogflow.operators.splits import val_selection
from catalogflow.plans import standins as st
from catalogflow.plans.queries_text import STRIP, cleaned
from catalogflow.plans.registry import query, r6, s6


def ingestion_overview(spark: SparkSession, folder: str) -> DataFrame:
    """Per class and split: products, mean cleaned length and share of the class."""
    products = st.wide_catalog(spark, folder)
    labels = st.catalog_labels(spark, folder)
    text = clean_description(full_text_strip(F.col("designation"), F.col("description")))
    prepared = products.select(
        "productid", "batch_id", is_gold(F.col("productid")).alias("is_gold"), F.length(text).alias("text_length"))
    selected = val_selection(
        join_labels(prepared, labels), 3, "prdtypecode", "productid")
    split = F.when(F.col("is_gold"), "gold").when(F.col("is_val_selection_v3"), "val").otherwise("train")
    counts = selected.groupBy("prdtypecode", split.alias("split")).agg(
        F.count("*").alias("n_products"), F.avg("text_length").alias("mean_length"))
    # At most three rows per class by now.
    of_class = F.sum("n_products").over(Window.partitionBy("prdtypecode"))
    return counts.select(
        "prdtypecode", "split", "n_products", r6("mean_length"),
        r6(F.col("n_products") / of_class, "share_of_class"))


query("ingestion_overview", f"""WITH prepared AS (
    SELECT productid, batch_id, {st.GOLD.format(key='productid')} AS is_gold, length({cleaned('full_text')}) AS text_length, prdtypecode
    FROM (SELECT *, {STRIP} AS full_text FROM catalog) JOIN catalog_labels USING (productid)),
    sizes AS (SELECT prdtypecode, count(*) AS n FROM prepared WHERE NOT is_gold GROUP BY prdtypecode),
    parts AS (SELECT prdtypecode, n // 10 AS base, n % 10 AS remainder,
        (CAST(sum(n) OVER () AS BIGINT) + 9) // 10 - CAST(sum(n // 10) OVER () AS BIGINT) AS spare FROM sizes),
    quotas AS (SELECT prdtypecode, base + CAST(row_number() OVER (ORDER BY remainder DESC, prdtypecode) <= spare AS INTEGER) AS quota FROM parts),
    ranked AS (SELECT productid, row_number() OVER (PARTITION BY prdtypecode ORDER BY md5('42:' || CAST(productid AS VARCHAR)), productid) AS rn
        FROM prepared WHERE NOT is_gold),
    split AS (SELECT p.prdtypecode, text_length, CASE WHEN is_gold THEN 'gold' WHEN rn <= quota THEN 'val' ELSE 'train' END AS split
        FROM prepared p LEFT JOIN ranked USING (productid) JOIN quotas USING (prdtypecode))
    SELECT prdtypecode, split, count(*) AS n_products, {s6('avg(text_length)', 'mean_length')},
    round(count(*) / sum(count(*)) OVER (PARTITION BY prdtypecode), 6) AS share_of_class FROM split GROUP BY prdtypecode, split""",
      ("catalog", "catalog_labels"))(ingestion_overview)
