"""Queries on splits, sampling and ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogflow.functions.hashing import gold_bucket, is_gold
from catalogflow.operators import registry as rg
from catalogflow.operators import splits as sp
from catalogflow.plans import standins as st
from catalogflow.plans.registry import query, r6, s6


def ranked(source: str, seed: int, label: str = "prdtypecode") -> str:
    return (f"(SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY md5('{seed}:' || CAST(productid AS VARCHAR)), productid) AS rn,"
            f" count(*) OVER (PARTITION BY {label}) AS n_class FROM {source})")


def quota(name: str, sizes: str, num: int, den: int, rounding: str = "ceil") -> str:
    """Largest-remainder quotas over a relation (class, n), as CTEs."""
    extra = den - 1 if rounding == "ceil" else den // 2
    return f"""{name}_base AS (SELECT class, n, n * {num} // {den} AS base, n * {num} % {den} AS remainder,
        (CAST(sum(n) OVER () AS BIGINT) * {num} + {extra}) // {den} - CAST(sum(n * {num} // {den}) OVER () AS BIGINT) AS spare FROM {sizes}),
    {name} AS (SELECT class, n, least(n, base + CAST(row_number() OVER (ORDER BY remainder DESC, class) <= spare AS BIGINT)) AS quota
        FROM {name}_base)"""


SIZES = "sizes AS (SELECT prdtypecode AS class, count(*) AS n FROM {source} GROUP BY prdtypecode)"


@query("is_gold", f"SELECT doc_id, {st.GOLD.format(key='doc_id')} AS is_gold FROM documents")
def _(spark, folder):
    return st.table(spark, folder, "documents").select("doc_id", is_gold(F.col("doc_id")).alias("is_gold"))


@query("gold_bucket", """SELECT o_orderkey, CAST(concat('0x', substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 16))::UBIGINT % 10 AS BIGINT)
    AS bucket FROM orders""")
def _(spark, folder):
    return st.table(spark, folder, "orders").select("o_orderkey", gold_bucket(F.col("o_orderkey")).alias("bucket"))


@query("quota_rule", f"WITH {SIZES.format(source='classes')}, {quota('q', 'sizes', 1, 10)} SELECT class, n, quota FROM q", ("classes",))
def _(spark, folder):
    rows = st.classes_of_all(spark, folder)
    sizes = rows.groupBy(F.col("prdtypecode").alias("class")).agg(F.count("*").alias("n"))
    return sp.largest_remainder(sizes, 0.10).select("class", "n", "quota")


@query("assign_batches", f"""WITH {SIZES.format(source='classes')}, {quota('q1', 'sizes', 1, 2, 'round')},
    rest AS (SELECT class, n - quota AS n FROM q1), {quota('q2', 'rest', 1, 2, 'round')}
    SELECT productid, prdtypecode, CASE WHEN rn <= q1.quota THEN 1 WHEN rn <= q1.quota + q2.quota THEN 2 ELSE 3 END AS batch_id
    FROM {ranked('classes', 42)} r JOIN q1 ON q1.class = prdtypecode JOIN q2 ON q2.class = prdtypecode""", ("classes",))
def _(spark, folder):
    rows = st.classes_of_all(spark, folder).select("productid", "prdtypecode")
    return sp.assign_batches(rows, "prdtypecode", "productid")


@query("assign_batches_parts", f"""WITH sizes AS (SELECT type AS class, count(*) AS n FROM parts GROUP BY type), {quota('q1', 'sizes', 1, 2, 'round')},
    rest AS (SELECT class, n - quota AS n FROM q1), {quota('q2', 'rest', 1, 2, 'round')}
    SELECT productid, type, CASE WHEN rn <= q1.quota THEN 1 WHEN rn <= q1.quota + q2.quota THEN 2 ELSE 3 END AS batch_id
    FROM {ranked('parts', 42, 'type')} r JOIN q1 ON q1.class = type JOIN q2 ON q2.class = type""", ("parts",))
def _(spark, folder):
    rows = st.parts(spark, folder).select("productid", "type")
    return sp.assign_batches(rows, "type", "productid")


@query("assign_equal_batches", f"""SELECT productid, prdtypecode, CAST((rn - 1) * 4 // n_class + 1 AS INTEGER) AS batch_id
    FROM {ranked('classes', 42)}""", ("classes",))
def _(spark, folder):
    return sp.assign_equal_batches(st.classes_of_all(spark, folder).select("productid", "prdtypecode"), "prdtypecode", "productid", 4)


@query("val_selection", f"""WITH pool AS (SELECT productid, prdtypecode FROM classes WHERE batch_id <= 2 AND NOT is_gold),
    {SIZES.format(source='pool')}, {quota('q', 'sizes', 1, 10)},
    picked AS (SELECT productid FROM {ranked('pool', 42)} JOIN q ON q.class = prdtypecode WHERE rn <= quota)
    SELECT productid, batch_id, is_gold, prdtypecode, CASE WHEN batch_id <= 2 THEN productid IN (SELECT productid FROM picked) END
    AS is_val_selection_v2 FROM classes""", ("classes",))
def _(spark, folder):
    rows = st.classes_of_all(spark, folder)
    return sp.val_selection(rows, 2, "prdtypecode", "productid").select(
        "productid", "batch_id", "is_gold", "prdtypecode", "is_val_selection_v2")


_POOL = "pool AS (SELECT productid, prdtypecode FROM split_table WHERE batch_id IN (1, 2) AND NOT is_gold AND NOT coalesce(is_val_selection_v2, false))"


@query("effective_pool", f"WITH {_POOL} SELECT * FROM pool", ("split_table",))
def _(spark, folder):
    return sp.effective_pool(st.split_table(spark, folder), [1, 2], 2).select("productid", "prdtypecode")


@query("train_val_split", f"""WITH {_POOL}, {SIZES.format(source='pool')}, {quota('q', 'sizes', 1, 5)}
    SELECT productid, prdtypecode, CASE WHEN rn <= quota THEN 'val' ELSE 'train' END AS split
    FROM {ranked('pool', 7)} JOIN q ON q.class = prdtypecode""", ("split_table",))
def _(spark, folder):
    pool = sp.effective_pool(st.split_table(spark, folder), [1, 2], 2).select("productid", "prdtypecode")
    return sp.train_val_split(pool, "prdtypecode", "productid", 0.2, 7)


@query("train_test_split", f"""WITH pool AS (SELECT productid, prdtypecode FROM classes WHERE batch_id = 1), {SIZES.format(source='pool')},
    {quota('q', 'sizes', 3, 20)}
    SELECT CASE WHEN rn <= quota THEN 'y_test' ELSE 'y_train' END AS name, productid, prdtypecode
    FROM {ranked('pool', 42)} JOIN q ON q.class = prdtypecode""", ("classes",))
def _(spark, folder):
    rows = st.classes_of_all(spark, folder).where(F.col("batch_id") == 1).select("productid", "prdtypecode")
    tables = sp.train_test_split(rows, "prdtypecode", "productid", 0.15)
    named = [tables[n].select(F.lit(n).alias("name"), "productid", "prdtypecode") for n in ("y_train", "y_test")]
    return named[0].unionByName(named[1])


@query("stratified_sample", f"""SELECT productid, prdtypecode FROM {ranked('classes', 42)} WHERE rn <= n_class * 3 // 10""", ("classes",))
def _(spark, folder):
    return sp.stratified_sample(st.classes_of_all(spark, folder).select("productid", "prdtypecode"), "prdtypecode", "productid", 0.3)


@query("replay_mix", f"""WITH old AS (SELECT productid, prdtypecode, batch_id FROM classes WHERE batch_id IN (1, 2))
    SELECT productid, prdtypecode, batch_id FROM classes WHERE batch_id = 3
    UNION ALL SELECT productid, prdtypecode, batch_id FROM {ranked('old', 42)} WHERE rn <= n_class * 3 // 10""", ("classes",))
def _(spark, folder):
    rows = st.classes_of_all(spark, folder).select("productid", "prdtypecode", "batch_id")
    return sp.replay_mix(rows, [1, 2, 3], "prdtypecode", "productid", 0.3)


@query("stratified_kfold", f"""SELECT productid, type, CAST((rn - 1) * 5 // n_class AS INTEGER) AS fold FROM {ranked('parts', 42, 'type')}""",
       ("parts",))
def _(spark, folder):
    return sp.stratified_kfold(st.parts(spark, folder).select("productid", "type"), "type", "productid", 5)


@query("latest_run", """SELECT run_name, run_id, start_time, metric FROM
    (SELECT *, row_number() OVER (PARTITION BY run_name ORDER BY start_time DESC, run_id DESC) AS rn FROM runs) WHERE rn = 1""", ("runs",))
def _(spark, folder):
    return rg.latest_run(st.runs(spark, folder))


@query("improvements", f"""WITH t AS (SELECT o_orderpriority AS study, o_orderkey AS trial, o_totalprice AS value FROM orders),
    b AS (SELECT *, max(value) OVER (PARTITION BY study ORDER BY trial ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_best FROM t)
    SELECT study, trial, value, previous_best, {s6('abs(previous_best - value) / value * 100', 'improvement_pct')}
    FROM b WHERE previous_best IS NULL OR value > previous_best""")
def _(spark, folder):
    trials = st.table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("study"), F.col("o_orderkey").alias("trial"), F.col("o_totalprice").alias("value"))
    return rg.improvements(trials, block=1000).withColumn("improvement_pct", r6("improvement_pct"))
