import pytest
from pyspark.sql import functions as F

from catalogflow.streaming import monitoring as mo
from catalogflow.streaming.queue import QueueScorer, queue_stream
from conftest import rows

SCHEMA = "productid long, designation string"


def arrive(spark, folder, first, n):
    spark.createDataFrame([(i, f"t{i}") for i in range(first, first + n)], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def scorer(spark, root, threshold=50):
    return QueueScorer(spark, root, lambda df: df.withColumn("pred", F.lit(1)), threshold)


def run(spark, s, folder, per_trigger=None):
    schema = spark.createDataFrame([], SCHEMA).schema
    s.start(queue_stream(spark, folder, schema, files_per_trigger=per_trigger), every=None).awaitTermination()


def test_threshold_gate_and_retirement(spark, tmp_path):
    inbox, s = str(tmp_path / "in"), scorer(spark, str(tmp_path / "q"))
    arrive(spark, inbox, 0, 49)
    run(spark, s, inbox)
    assert s.results() is None and s.pending().count() == 49
    arrive(spark, inbox, 49, 1)
    run(spark, s, inbox)
    assert s.results().count() == 50 and s.pending() is None
    arrive(spark, inbox, 50, 10)
    run(spark, s, inbox)
    assert s.results().count() == 50 and s.pending().count() == 10


@pytest.mark.parametrize("files", [1, 4])
def test_same_rows_from_one_file_or_many(spark, tmp_path, files):
    inbox, s = str(tmp_path / "in"), scorer(spark, str(tmp_path / "q"), 5)
    for k in range(files):
        arrive(spark, inbox, k * 40 // files, 40 // files)
    run(spark, s, inbox, per_trigger=1)
    assert rows(s.results().select("productid")) == [(i,) for i in range(40)]


def test_restart_and_replayed_batch_do_not_duplicate(spark, tmp_path):
    inbox, root = str(tmp_path / "in"), str(tmp_path / "q")
    arrive(spark, inbox, 0, 20)
    run(spark, scorer(spark, root, 5), inbox)
    run(spark, scorer(spark, root, 5), inbox)
    s = scorer(spark, root, 5)
    s.process(spark.read.schema(SCHEMA).parquet(inbox), 0)
    assert s.results().count() == 20


def test_rate_of_a_table_equals_hand_count(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:10", 30.0), ("2024-01-01 00:00:50", 30.0), ("2024-01-01 00:02:00", 6.0)], "ts string, v double")
    got = mo.windowed_rate(df.withColumn("ts", F.col("ts").cast("timestamp_ntz")), "ts", "v").orderBy("window_start").collect()
    assert [(r["rate"], r["n"]) for r in got] == [(1.0, 2), (0.1, 1)]
    sliding = mo.windowed_rate(df, "ts", "v", "5 minutes", "1 minute")
    assert sliding.agg(F.sum("n")).first()[0] == 15


def test_latest_gauge_breaks_ties(spark):
    df = spark.createDataFrame([("a", 1, 0.5, 1), ("a", 2, 0.6, 2), ("a", 2, 0.7, 3)], "s string, t int, v double, id int")
    assert rows(mo.latest_gauge(df, "s", "t", "v", "id")) == [("a", 2, 0.7)]
