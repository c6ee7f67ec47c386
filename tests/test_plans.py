"""Plan-shape tests: the physical plans the operators are meant to get, over the whole plan text."""

import re

from pyspark.sql import functions as F

from stockrisk.operators.layers import dedup_bronze
from stockrisk.operators.ranking import range_sorted, ranks
from stockrisk.operators.reporting import latest_date
from stockrisk.operators.risk import fact
from stockrisk.plans.catalog import QUERIES, _stg
from stockrisk.sources.fixture import load_raw

SF = "/root/testdata/sf0.001"


def plan(df):
    """All lines of the physical plan, subqueries included."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_adapter_reads_every_row_and_five_columns(spark):
    raw = load_raw(spark, SF)
    p = plan(raw)
    assert "PushedFilters: []" in p and "Filter" not in p.replace("PushedFilters", "").replace("PartitionFilters", "").replace("DataFilters", "")
    scanned = re.search(r"FileScan parquet \[([^\]]*)\]", p).group(1).split(",")
    assert sorted(c.split("#")[0] for c in scanned) == ["l_orderkey", "l_partkey", "l_quantity", "l_shipdate", "l_suppkey"]
    assert raw.count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()


def test_dedup_aggregates_before_the_shuffle(spark):
    p = plan(dedup_bronze(load_raw(spark, SF)))
    assert "partial_max" in p
    assert "Window" not in p


def test_lag_and_rolling_mean_share_one_exchange(spark):
    p = plan(fact(_stg(spark, SF)))
    series_exchanges = re.findall(r"Exchange hashpartitioning\(product_id#\d+, warehouse_id#\d+, \d+\)", p)
    assert len(series_exchanges) == 1, p
    assert len(re.findall(r"\bSort \[", p)) == 1, p


def test_latest_date_is_a_scalar_subquery_not_a_global_window(spark):
    f = fact(_stg(spark, SF))
    p = plan(f.withColumn("is_latest", F.col("snapshot_date") == latest_date(f)))
    assert "Subquery" in p
    assert_single_partitions_hold_aggregates(p)


def test_latest_only_readers_push_the_date_to_the_fact_scan(spark):
    p = plan(QUERIES["kpi_latest"](spark, SF))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(snapshot_date,ScalarSubquery", p), p


def test_figures_expand_nothing_and_join_no_dimension(spark):
    for name in ("kpi_latest", "risk_trend", "warehouse_distribution", "warehouse_risk_history"):
        p = plan(QUERIES[name](spark, SF))
        assert "Expand" not in p and "Join" not in p, name


def test_quality_report_expands_nothing_and_scans_no_raw_table(spark):
    p = plan(QUERIES["dq_report"](spark, SF))
    assert "Expand" not in p and "lineitem" not in p
    assert "Window" not in p  # the fact and the report are stored


def test_dashboard_filter_prunes_the_published_report(spark):
    p = plan(QUERIES["dashboard_filtered"](spark, SF))
    assert re.search(r"PartitionFilters: \[isnotnull\(snapshot_date#\d+\), \(snapshot_date#\d+ >= ", p), p
    assert "Join" not in p and "Exchange" not in p


def assert_single_partitions_hold_aggregates(p):
    """Every SinglePartition exchange sits on a scalar aggregate or on the counts of the range partitions."""
    lines = p.splitlines()
    below = [lines[i + 1].strip() for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert below
    for child in below:
        assert re.search(r"HashAggregate\(keys=\[(_part#\d+)?\]", child), child


def test_single_partition_exchanges_only_move_aggregates(spark):
    df = spark.range(2000).withColumn("k", F.col("id") % 7)
    for name in ("rpt_dashboard", "kpi_latest", "rank_overall"):
        assert_single_partitions_hold_aggregates(plan(QUERIES[name](spark, SF)))
    assert_single_partitions_hold_aggregates(plan(ranks(range_sorted(df, [F.col("k"), F.col("id")]), "rn", "k", "rn_k")))


def test_no_row_number_over_the_whole_report(spark):
    """Window groups of the ranked report: range partitions, or one product in one warehouse; never a date or a warehouse."""
    p = plan(QUERIES["rpt_dashboard"](spark, SF))
    groups = re.findall(r"Window \[row_number\(\) windowspecdefinition\(([^()]*?)(?:CASE|coalesce|risk_priority|_pos)", p)
    assert groups
    for g in groups:
        names = {c.split("#")[0].strip() for c in g.split(",") if "#" in c}
        assert "_part" in names or {"product_id", "warehouse_id"} <= names, g
