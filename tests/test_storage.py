import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalogflow import schemas, session
from catalogflow.operators import features as ft
from catalogflow.operators import filters as fl
from catalogflow.operators import joins as jn
from catalogflow.operators import quality as ql
from catalogflow.operators.aggregates import image_quality, image_quality_summary
from catalogflow.sources import readers as rd
from catalogflow.sources import writers as wr
from conftest import rows


def png(pixels):
    """Bytes of an RGB image, rows of (r, g, b)."""
    h, w = len(pixels), len(pixels[0])
    raw = b"".join(b"\0" + bytes(v for px in line for v in px) for line in pixels)

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(
        b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


PIXELS = [[(255, 0, 0), (0, 255, 0), (0, 0, 255)], [(10, 20, 30), (0, 0, 0), (255, 255, 255)]]


@pytest.fixture
def images(tmp_path):
    (tmp_path / "image_71_product_1.png").write_bytes(png(PIXELS))
    (tmp_path / "image_72_product_2.png").write_bytes(png(PIXELS)[:40])
    (tmp_path / "notes.png").write_bytes(png(PIXELS))
    return str(tmp_path)


def test_csv_with_row_index_and_line_breaks(spark, tmp_path):
    (tmp_path / "x.csv").write_text(',designation,description,productid,imageid\n0,"a ""q""","line 1\nline 2",5,6\n1,b,,7,8\n')
    (tmp_path / "y.csv").write_text(",prdtypecode\n0,10\n1,40\n")
    x = rd.read_indexed_csv(spark, str(tmp_path / "x.csv"), schemas.RAW_PRODUCTS)
    y = rd.read_indexed_csv(spark, str(tmp_path / "y.csv"), schemas.RAW_LABELS)
    joined = jn.zip_by_position(x, y)
    assert rows(joined.select("productid", "designation", "description", "prdtypecode")) == [
        (5, 'a "q"', "line 1\nline 2", 10), (7, "b", None, 40)]
    with pytest.raises(ValueError):
        jn.zip_by_position(x, y.limit(1))


def test_image_scan_keeps_bad_files(spark, images):
    scanned = rd.scan_images(spark, images).where(F.col("productid").isNotNull())
    got = {r["productid"]: r["status"] for r in scanned.collect()}
    assert got == {1: "ok", 2: "unreadable"}
    assert rows(rd.available_image_ids(spark, images)) == [(1,), (2,)]


def test_available_ids_read_no_content(spark, images):
    plan = rd.available_image_ids(spark, images)._jdf.queryExecution().optimizedPlan().toString()
    assert "content" not in plan.split("Relation")[0]


def test_image_features_and_defaults(spark, images):
    scanned = rd.scan_images(spark, images).where(F.col("productid").isNotNull())
    products = spark.createDataFrame([(1, 71), (2, 72), (3, 73)], "productid long, imageid long")
    got = {r["productid"]: r for r in ft.image_tabular(products, scanned).collect()}
    rgb = np.array(PIXELS, dtype=np.int64)
    grey = (rgb[..., 0] * 19595 + rgb[..., 1] * 38470 + rgb[..., 2] * 7471 + 0x8000) >> 16
    assert (got[1]["tab_image_width"], got[1]["tab_image_height"]) == (3, 2)
    assert got[1]["tab_image_aspect_ratio"] == 1.5
    assert got[1]["tab_image_brightness_mean"] == pytest.approx(grey.mean())
    assert got[1]["tab_image_brightness_std"] == pytest.approx(grey.std())
    for missing in (2, 3):
        assert tuple(got[missing])[1:] == (0, 0, 1.0, 0.0, 0.0)
    vectors = {r["productid"]: r["image_vector"] for r in ft.image_embeddings(scanned).collect()}
    assert len(vectors[1]) == len(vectors[2]) == 64
    assert not np.isnan(vectors[1]).any() and np.isnan(vectors[2]).all()
    audit = image_quality(products, scanned)
    assert tuple(image_quality_summary(audit).first())[:4] == (3, 1, 1, 1)
    assert rows(fl.products_with_image(products, rd.available_image_ids(spark, images)).select("productid")) == [(1,), (2,)]


def test_custom_text_encoder_is_built_per_worker(spark):
    def encoder():
        return lambda texts: np.stack([[len(t), t.count("a")] for t in texts])

    df = spark.createDataFrame([(1, "aab"), (2, "")], "id int, text string")
    assert rows(ft.text_embeddings(df, "text", encoder).select("id", "text_vector")) == [(1, [3.0, 2.0]), (2, [0.0, 0.0])]


def test_incremental_features_see_only_new_products(spark):
    products = spark.createDataFrame([(i, i, "t", None) for i in range(6)], "productid long, imageid long, designation string, description string")
    cached = products.where("productid < 4").select("productid")
    assert rows(ft.build_features_incremental(products, cached, ft.text_feature_rows).select("productid")) == [(4,), (5,)]
    assert ft.build_features_incremental(products, products, ft.text_feature_rows).count() == 0
    assert ft.build_features_incremental(products, None, ft.text_feature_rows).count() == 6


def test_tables_snapshots_and_exports(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([(i, i % 2 + 1) for i in range(10)], "productid long, batch_id int")
    wr.replace_table(df, f"{root}/t", rebalance=True)
    wr.replace_table(df.where("productid < 5"), f"{root}/t")
    assert spark.read.parquet(f"{root}/t").count() == 5
    wr.append_table(df.where("productid >= 5").select("productid"), f"{root}/a")
    wr.append_table(df.where("productid >= 8").select("productid"), f"{root}/a")
    assert spark.read.parquet(f"{root}/a").count() == 7
    wr.extend_cache(df.select("productid"), f"{root}/a")
    assert spark.read.parquet(f"{root}/a").distinct().count() == 10

    assert wr.write_snapshot(df, f"{root}/s") == 1
    kept = jn.delete_by_keys(wr.read_snapshot(spark, f"{root}/s"), df.where("batch_id = 1"))
    assert wr.write_snapshot(kept, f"{root}/s") == 2
    assert wr.read_snapshot(spark, f"{root}/s").count() == 5
    assert wr.read_snapshot(spark, f"{root}/s", 1).count() == 10
    with pytest.raises(FileNotFoundError):
        wr.read_snapshot(spark, f"{root}/none")

    wr.export_batches(df, df.withColumn("prdtypecode", F.lit(10)), f"{root}/csv")
    assert spark.read.option("header", True).csv(f"{root}/csv/x/batch_id=1").count() == 5
    wr.write_audit_csv(df.groupBy("batch_id").count(), f"{root}/audit", single_file=True)
    assert spark.read.option("header", True).csv(f"{root}/audit").count() == 2

    df.createOrReplaceTempView("source_rows")
    spark.sql(f"CREATE TABLE dropped_table USING parquet LOCATION '{root}/d' AS SELECT * FROM source_rows")
    wr.drop_tables(spark, ["dropped_table", "never_there"])
    assert not spark.catalog.tableExists("dropped_table")


def test_columns_by_pattern_and_required(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, 4.0)], "productid long, a_feat_10 double, a_feat_2 double, tab_x double")
    assert fl.columns_by_pattern(df).columns == ["a_feat_2", "a_feat_10"]
    assert fl.columns_by_pattern(df, "tab_").columns == ["tab_x"]
    with pytest.raises(ValueError):
        fl.columns_by_pattern(df, "image_feat_")
    ql.required_columns(df, ["productid"])
    with pytest.raises(ql.GuardError):
        ql.required_columns(df, ["productid", "label"])


def test_joins_name_what_does_not_match(spark):
    from pyspark.errors import PySparkException

    from catalogflow.operators import aggregates as ag
    from catalogflow.operators import joins as jn

    ids = lambda *n: spark.createDataFrame([(i,) for i in n], "row_id long")
    assert jn.zip_by_position(ids(1, 2, 3), ids(3, 2, 1)).count() == 3
    for other in ((1, 2, 4), (1, 2, 2), (1, 2)):
        with pytest.raises(ValueError):
            jn.zip_by_position(ids(1, 2, 3), ids(*other))
    classes = spark.createDataFrame([(10, 0), (40, 1)], "prdtypecode int, label int")
    seen = spark.createDataFrame([(10,), (99,)], "prdtypecode int")
    with pytest.raises(PySparkException):
        jn.encode_label(seen, classes).collect()
    assert rows(jn.encode_label(seen.where("prdtypecode = 10"), classes)) == [(10, 0)]
    flags = spark.createDataFrame([(1, False, False, 5)] * 9, "batch_id int, is_gold boolean, is_val_selection_v1 boolean, c int")
    drift = ag.class_drift(flags, "c", 1).first()
    assert drift["passed"] is False and drift["drift_abs"] is None
    vocab = spark.createDataFrame([("a", 2), ("b", 3)], "token string, id int")
    twice = spark.createDataFrame([(1, "a b"), (1, "b b")], "productid long, text string")
    codes = ag.encode_tokens(twice, vocab, "productid", "text", 2)
    assert sorted(list(next(v for v in r if isinstance(v, list))) for r in codes.collect()) == [[2, 3], [3, 3]]


def test_materialize_cuts_lineage(spark):
    df = session.materialize(spark.range(5).withColumn("x", F.col("id") * 2), "t")
    assert rows(df) == [(i, 2 * i) for i in range(5)]
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
