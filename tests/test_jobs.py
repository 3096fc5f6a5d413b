import pytest
from pyspark.sql import functions as F

from catalogflow.functions import vectors as V
from catalogflow.operators import joins as jn
from catalogflow.operators import quality as ql
from catalogflow.operators import registry as rg
from catalogflow.plans import jobs
from conftest import rows


@pytest.fixture
def catalog(spark):
    products = spark.createDataFrame(
        [(i, i + 1, f"<b>title {i}</b>", None if i % 2 else "text &amp; more", i % 2 + 1) for i in range(60)],
        "productid long, imageid long, designation string, description string, batch_id int")
    labels = products.select("productid", F.when(F.col("productid") % 3 == 0, 10).otherwise(40).alias("prdtypecode"))
    return products, labels


def test_ingest_batch_is_repeatable(spark, catalog):
    products, labels = catalog
    once, summary = jobs.ingest_batch(products, labels, 1)
    twice, again = jobs.ingest_batch(once, labels, 1)
    assert rows(once.select("productid", "text")) != [] and rows(once.na.fill("").na.fill(False)) == rows(twice.na.fill("").na.fill(False))
    assert tuple(summary.first()) == tuple(again.first())
    assert summary.first()["n_samples"] == 30 and summary.first()["n_classes"] == 2
    assert once.where("batch_id = 2 and (text is not null or is_gold is not null)").count() == 0
    assert once.where("productid = 2").first()["text"] == "title 2. . text & more"


@pytest.mark.parametrize("problem", ["empty", "unlabelled", "invalid", "duplicate"])
def test_ingest_guards(spark, catalog, problem):
    products, labels = catalog
    batch = 1
    if problem == "empty":
        batch = 9
    elif problem == "unlabelled":
        labels = labels.where("productid <> 0")
    elif problem == "invalid":
        labels = labels.withColumn("prdtypecode", F.when(F.col("productid") == 0, 11).otherwise(F.col("prdtypecode")))
    else:
        products = products.unionByName(products.where("productid = 0"))
    with pytest.raises(ql.GuardError):
        jobs.check_batch(products, labels, batch)


def test_val_selection_needs_gold_flags(spark, catalog):
    products, labels = catalog
    first, _ = jobs.ingest_batch(products, labels, 1)
    v1 = jobs.rebase_val_selection(first, labels, 1)
    n = first.where("batch_id = 1 and not is_gold").count()
    assert v1.where("is_val_selection_v1").count() == -(-n // 10)
    assert v1.count() == 60
    with pytest.raises(ql.GuardError):
        jobs.rebase_val_selection(v1, labels, 2)
    both, _ = jobs.ingest_batch(v1, labels, 2)
    v2 = jobs.rebase_val_selection(both, labels, 2)
    assert rows(v2.where("is_val_selection_v1").select("productid")) == rows(v1.where("is_val_selection_v1").select("productid"))
    assert v2.where("is_val_selection_v2 and is_gold").count() == 0


def test_score_table_layout(spark, catalog):
    products, labels = catalog
    dimension = jn.class_dimension(labels)
    score = lambda df: df.withColumn("p", F.array(F.lit(0.25), F.lit(0.75)))
    out = jobs.score_table(products.limit(3), score, dimension, F.lit("2024-01-01T00:00:00"), "best", 4, "stacking")
    r = out.first()
    assert (r["prediction"], r["confidence"], r["model"], r["model_family"]) == (40, 0.75, "best@v4", "stacking")
    from catalogflow.schemas import PREDICTIONS

    assert [(f.name, f.dataType) for f in out.schema.fields] == [(f.name, f.dataType) for f in PREDICTIONS.fields]


def test_requested_and_rescored_products(spark, catalog):
    products, _ = catalog
    requested = spark.createDataFrame([(1,), (1,), (2,), (999,)], "productid long")
    assert rows(jn.requested_split(requested, products)) == [(1, True), (2, True), (999, False)]
    assert rows(jobs.score_requested(requested, products, lambda d: d.select("productid"))) == [(1,), (2,)]
    assert jobs.rescore_all(requested, products, lambda d: d).count() == 2


def test_upsert_sets_nulls_too(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    delta = spark.createDataFrame([(2, None)], "k int, v string")
    assert jn.upsert_columns(base, delta, "k", ["v"]).where("k = 2").first()["v"] is None
    assert jn.upsert_columns(base, delta.withColumn("w", F.lit(7)), "k", ["w"]).where("k = 2").first()["w"] == 7


def test_promotion_margins(spark):
    versions = spark.createDataFrame(
        [("m", 1, 0.5), ("m", 2, 0.505), ("n", 1, None), ("n", 2, 0.1), ("o", 1, 0.2)], "name string, version long, metric double")
    aliases = spark.createDataFrame([("m", "champion", 1), ("n", "champion", 1)], "name string, alias string, version long")
    challengers = versions.where("metric is not null and (version = 2 or name = 'o')")
    strict = {r["name"]: r["promoted"] for r in rg.promotion_decision(challengers, versions, aliases, "champion", 0.005).collect()}
    loose = {r["name"]: r["promoted"] for r in rg.promotion_gain_geq(challengers, versions, aliases, "champion", 0.005).collect()}
    assert strict == {"m": 0.505 - 0.5 > 0.005, "n": True, "o": True}
    assert loose == {"m": 0.505 - 0.5 >= 0.005, "n": True, "o": True}


def test_compare_and_promote_decisions(spark):
    runs = [
        ("m", "challenger", "a", 1, 1, 1, 0.90), ("m", "challenger", "a", 2, 2, 2, 0.60),  # a newer run replaces the better one
        ("m", "challenger", "b", 3, 3, 1, 0.70), ("m", "champion", "c", 4, 0, 1, 0.68),
        ("n", "challenger", "a", 5, 1, 1, 0.70), ("o", "challenger", "a", 6, 1, 1, 0.70),
        ("p", "challenger", "a", 7, 1, 1, 0.700), ("p", "champion", "c", 8, 0, 1, 0.699),
    ]
    df = spark.createDataFrame(runs, "name string, role string, run_name string, run_id long, version long, start_time long, metric double")
    aliases = spark.createDataFrame([(n, "champion", 0) for n in "mnp"], "name string, alias string, version long")
    got = {r["name"]: (r["best_challenger"], r["decision"]) for r in rg.compare_and_promote(df, aliases, "champion").collect()}
    assert got == {"m": ("b", "promote"), "n": ("a", "no_decision"), "o": ("a", "promote_first"), "p": ("a", "keep")}


def test_alias_moves_and_fallback(spark):
    aliases = spark.createDataFrame([("m", "x", 1), ("m", "y", 1), ("n", "y", 3)], "name string, alias string, version long")
    moves = spark.createDataFrame([("m", "x", 2), ("o", "x", 9)], "name string, alias string, version long")
    moved = rg.move_alias(aliases, moves)
    assert rows(moved) == [("m", "x", 2), ("m", "y", 1), ("n", "y", 3), ("o", "x", 9)]
    models = spark.createDataFrame([("m",), ("n",), ("q",)], "name string")
    got = {r["name"]: (r["version"], r["alias_used"]) for r in rg.alias_fallback(models, moved, "x", "y").collect()}
    assert got == {"m": (2, "x"), "n": (3, "y"), "q": (None, None)}


def test_versions_with_two_aliases_are_evaluated_once(spark):
    p = spark.createDataFrame([("m", 1, i, [0.9, 0.1]) for i in range(4)], "name string, version long, productid long, p array<double>")
    aliases = spark.createDataFrame([("m", "active", 1), ("m", "active_stateful", 1)], "name string, alias string, version long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(4)], "productid long, y int")
    out = jobs.evaluate_versions(p, aliases, ["active", "active_stateful"], labels, labels).collect()
    assert len(out) == 1 and out[0]["n"] == 4 and out[0]["accuracy"] == 0.5


def test_vectors_align(spark):
    df = spark.createDataFrame([([0.2, 0.8],)], "p array<double>")
    assert df.select(V.align_classes(F.col("p"), [3, 1], 4)).first()[0] == [0.0, 0.8, 0.0, 0.2]
