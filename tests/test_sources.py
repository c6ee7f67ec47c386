import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockrisk.operators.kpis import filter_report
from stockrisk.operators.layers import dedup_bronze
from stockrisk.sources.fixture import load_product_master, load_raw, product_number
from stockrisk.sources.readers import read_layer, read_product_master, read_raw
from stockrisk.sources.sinks import Scratch, create_view, ensure_database, owned_pins, pin, write_layer
from stockrisk.session import shared_path


def test_raw_csv_is_typed_and_dedup_orders_numerically(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text("product_id,warehouse_id,qty_on_hand,load_dt\nA,W1,9,1/1/2025\nA,W1,10,1/1/2025\nB,W2,,1/2/2025\n")
    raw = read_raw(spark, path=str(p))
    assert dict(raw.dtypes)["qty_on_hand"] == "bigint"
    got = {r.product_id: r.qty_on_hand for r in dedup_bronze(raw).collect()}
    assert got == {"A": 10, "B": None}  # 10 > 9 as numbers, not as text


def test_write_layer_overwrites_and_counts(spark):
    root = shared_path(spark, "lake")
    ensure_database(spark, "t_layer_db", f"{root}/t_layer_db.db")
    df = spark.createDataFrame([("A", 1), ("B", 2)], "k string, v bigint")
    res = write_layer(df, "t_layer_db", "t", f"{root}/t")
    assert res.rows == 2
    res = write_layer(df.limit(1), "t_layer_db", "t", f"{root}/t")
    assert res.rows == 1 and read_layer(spark, "t_layer_db.t").count() == 1
    assert read_layer(spark, f"{root}/t", "parquet").count() == 1


def test_view_pin_and_scratch(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    root = shared_path(spark, "lake")
    write_layer(df, "default", "t_base", f"{root}/t_base")
    assert create_view(spark, "default", "t_view", "SELECT x + 1 AS y FROM t_base").agg({"y": "sum"}).first()[0] == 5
    assert [r.x for r in pin(df.where("x > 1"), "t_pin").collect()] == [2]
    with Scratch(spark) as pin_here:
        held = pin_here(df)
        assert held.count() == 2
        [path] = held.inputFiles()[:1]
    with pytest.raises(Exception, match="FAILED_READ_FILE|does not exist|PATH_NOT_FOUND"):
        spark.read.parquet(path).count()


def test_raw_table_is_typed_like_the_csv(spark):
    df = spark.createDataFrame([("x", "A", "W1", "9", "1/1/2025"), ("y", "A", "W1", "10", "1/1/2025")], "extra string, product_id string, warehouse_id string, qty_on_hand string, load_dt string")
    write_layer(df, "default", "t_raw_text", f"{shared_path(spark, 'lake')}/t_raw_text")
    raw = read_raw(spark, table="t_raw_text")
    assert raw.dtypes == [("product_id", "string"), ("warehouse_id", "string"), ("qty_on_hand", "bigint"), ("load_dt", "string")]
    assert [r.qty_on_hand for r in dedup_bronze(raw).collect()] == [10]
    write_layer(df.withColumn("qty_on_hand", F.lit("many")), "default", "t_raw_text", f"{shared_path(spark, 'lake')}/t_raw_text2")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_raw(spark, table="t_raw_text").collect()


def test_csv_with_other_columns_fails(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text("warehouse_id,product_id,qty_on_hand,load_dt\nW1,A,9,1/1/2025\n")
    with pytest.raises(Exception, match="header|CSV"):
        read_raw(spark, path=str(p)).collect()
    p.write_text("product_name,product_id,category\nApple,A,food\n")
    with pytest.raises(Exception, match="header|CSV"):
        read_product_master(spark, str(p)).collect()


def test_names_and_places_are_quoted(spark):
    ensure_database(spark, "select", f"{shared_path(spark, 'it')}'s")
    assert spark.catalog.getDatabase("select").locationUri.endswith("'s")
    spark.sql("DROP DATABASE `select`")


def test_no_checkpoint_folder_is_made_up(spark, monkeypatch):
    import stockrisk.session as session

    class Bare:
        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Bare)


def test_adapter_keeps_every_row(spark):
    sf = "/root/testdata/sf0.001"
    line, part = spark.read.parquet(f"{sf}/lineitem.parquet"), spark.read.parquet(f"{sf}/part.parquet")
    assert load_raw(spark, sf).count() == line.count()
    seed = load_product_master(spark, sf)
    assert seed.count() == seed.select("product_id").distinct().count() == part.selectExpr("p_partkey div 10").distinct().count()
    assert seed.where("product_name IS NULL OR category IS NULL").count() == 0


def test_large_keys_keep_their_digits(spark):
    [r] = spark.createDataFrame([(90071992547409919,)], "k bigint").select(product_number(F.col("k"))).collect()
    assert r[0] == 9007199254740991


def test_filter_report_applies_all_filters(spark):
    rows = [
        ("W1", "food", dt.date(2025, 1, 1)),
        ("W1", "toys", dt.date(2025, 1, 2)),
        ("W2", "food", dt.date(2025, 1, 3)),
        ("W1", None, dt.date(2025, 1, 4)),
        ("W1", "food", dt.date(2025, 2, 1)),
    ]
    rpt = spark.createDataFrame(rows, "warehouse_id string, category string, snapshot_date date")
    out = filter_report(rpt, ["W1"], ["food"], "2025-01-01", dt.date(2025, 1, 31)).collect()
    assert [(r.warehouse_id, r.category, r.snapshot_date) for r in out] == [("W1", "food", dt.date(2025, 1, 1))]
    assert filter_report(rpt).count() == 5
    assert filter_report(rpt, date_from="2025-01-03").where(F.col("snapshot_date") < "2025-01-03").count() == 0


def test_write_layer_takes_other_formats(spark):
    root = shared_path(spark, "lake")
    ensure_database(spark, "t_orc_db", f"{root}/t_orc_db.db")
    df = spark.createDataFrame([("A", 1)], "k string, v bigint")
    res = write_layer(df, "t_orc_db", "t", f"{root}/t_orc", fmt="orc")
    assert res.rows == 1
    assert read_layer(spark, f"{root}/t_orc", "orc").collect()[0].k == "A"


def test_owned_pins_go_with_their_run(spark, tmp_path):
    df = spark.range(5)
    with owned_pins(spark) as keep:
        lost = pin(df, "lost")
        with owned_pins(spark) as keep_inner:
            inner = pin(lost, "inner")
            middle = keep_inner(inner.where("id > 0"), "middle")
        assert middle.count() == 4 and lost.count() == 5
        kept = keep(middle.where("id > 1"), "kept")
    assert sorted(r.id for r in kept.collect()) == [2, 3, 4]
    for gone in (lost, inner, middle):
        with pytest.raises(Exception):
            gone.count()
    assert pin(df, "after").count() == 5
    with pytest.raises(ValueError), owned_pins(spark):
        failed = pin(df, "failed")
        raise ValueError
    with pytest.raises(Exception):
        failed.count()
