import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stockrisk.operators.dims import dim_date, dim_product, dim_warehouse
from stockrisk.operators.ranking import range_sorted, ranks
from stockrisk.operators.reporting import latest_order, priority_order, report, report_base
from stockrisk.operators.risk import fact
from stockrisk.schemas import FACT, REPORT_COLUMNS, STG
from stockrisk.sources.sinks import pin

D0 = dt.date(2025, 3, 1)
DAY = dt.timedelta(days=1)


def report_of(fct, product, warehouse, date):
    base = report_base(fct, product, warehouse, date)
    return report(base, pin(latest_order(base), "order"))


def build(spark, rows, seed_rows=(), dates=None):
    stg = spark.createDataFrame(rows, STG)
    seed = spark.createDataFrame(list(seed_rows), "product_id string, product_name string, category string")
    date = dim_date(stg if dates is None else spark.createDataFrame([("", "", d, 0) for d in dates], STG))
    return report_of(fact(stg), dim_product(seed), dim_warehouse(stg), date)


def test_rank_ties_fall_to_product_then_warehouse(spark):
    d1 = D0 + DAY
    rows = []
    # identical stock paths -> equal score, days and quantity
    for p in ["B", "A"]:
        for w in ["W2", "W1"]:
            rows += [(p, w, D0, 20), (p, w, d1, 10)]
    rows += [("Z", "W1", D0, 5), ("Z", "W1", d1, 0)]  # zero stock ranks first
    rpt = build(spark, rows, [("A", "Apple", "food")])
    assert rpt.columns == REPORT_COLUMNS
    latest = {(r.product_id, r.warehouse_id): r for r in rpt.where("is_latest_snapshot").collect()}
    overall = sorted(latest, key=lambda k: latest[k].latest_rank_overall)
    assert overall == [("Z", "W1"), ("A", "W1"), ("A", "W2"), ("B", "W1"), ("B", "W2")]
    assert [latest[k].latest_rank_in_warehouse for k in overall] == [1, 2, 1, 3, 2]
    history = rpt.where(~F.col("is_latest_snapshot")).collect()
    assert all(r.latest_rank_overall is None and r.latest_rank_in_warehouse is None for r in history)
    assert latest[("A", "W1")].product_name == "Apple" and latest[("B", "W1")].product_name is None


def test_latest_flag_uses_global_max(spark):
    rows = [("A", "W1", D0, 5), ("B", "W1", D0 + 3 * DAY, 5)]
    flags = {r.product_id: r.is_latest_snapshot for r in build(spark, rows).collect()}
    assert flags == {"A": False, "B": True}


@pytest.mark.parametrize("dates", [[D0, D0 + DAY, D0 + 400 * DAY], [D0], []], ids=["future", "stale", "empty"])
def test_latest_date_is_the_fact_s_whatever_the_date_dimension_holds(spark, dates):
    rows = [("A", "W1", D0, 5), ("A", "W1", D0 + DAY, 4), ("B", "W1", D0 + DAY, 3)]
    got = build(spark, rows, dates=dates).collect()
    assert len(got) == 3
    ranked = {(r.product_id, r.snapshot_date): r.latest_rank_overall for r in got if r.is_latest_snapshot}
    assert set(ranked) == {("A", D0 + DAY), ("B", D0 + DAY)} and sorted(ranked.values()) == [1, 2]
    assert all(r.is_latest_snapshot is not None for r in got)


def test_rows_without_a_date_and_doubled_grain_are_kept(spark):
    fct = fact(spark.createDataFrame([("A", "W1", D0, 5), ("A", "W1", D0, 5), ("A", "W1", D0, 0), ("B", None, None, 1), (None, "W1", D0, 1)], STG))
    empty = spark.createDataFrame([], STG)
    got = report_of(fct, dim_product(spark.createDataFrame([], "product_id string, product_name string, category string")),
                    dim_warehouse(empty), dim_date(empty)).collect()
    assert len(got) == 5
    assert sorted(r.latest_rank_overall for r in got if r.is_latest_snapshot) == [1, 2, 3, 4]
    none = spark.createDataFrame([], FACT)
    assert report_of(none, dim_product(spark.createDataFrame([], "product_id string, product_name string, category string")), dim_warehouse(empty), dim_date(empty)).count() == 0


def test_report_key(spark):
    [r] = build(spark, [("A", "W1", D0, 5)]).collect()
    assert r.warehouse_product_snapshot_key == "2025-03-01|A|W1"


def test_ranks_equal_row_number_with_hot_group(spark):
    rnd = random.Random(7)
    # one group holds about a third of all rows, with many ties in the sort keys
    data = [("hot" if rnd.random() < 0.34 else rnd.choice([None, "x", "y", f"g{rnd.randrange(20)}"]), rnd.randrange(5), rnd.randrange(50), i) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, a int, b int, id int").repartition(6)
    order = [F.col("a").desc(), F.col("b").asc(), F.col("id").asc()]
    got = ranks(pin(range_sorted(df, order), "sorted"), "rn", "g", "rn_g")
    want = df.withColumns(
        {"rn": F.row_number().over(Window.orderBy(*order)).cast("bigint"), "rn_g": F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("bigint")}
    )
    assert got.columns == want.columns and got.count() == 3000
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    alone = ranks(pin(range_sorted(df, order), "sorted"), "rn")
    assert alone.exceptAll(want.drop("rn_g")).count() == 0


def test_building_a_report_runs_nothing(spark):
    fct = fact(spark.createDataFrame([("A", "W1", D0, 5)], STG))
    stg = spark.createDataFrame([("A", "W1", D0, 5)], STG)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "no action inside the operators")
    base = report_base(fct, dim_product(spark.createDataFrame([], "product_id string, product_name string, category string")), dim_warehouse(stg), dim_date(stg))
    report(base, latest_order(base))
    assert list(tracker.getJobIdsForGroup("building")) == []
    spark.sparkContext.setJobGroup("tests", "")


def test_priority_order_columns():
    assert len(priority_order()) == 5
