"""Every catalogued query against its DuckDB SQL on the sf0.001 tables."""

import os

import duckdb
import pytest

from stockrisk.plans.catalog import QUERIES
from stockrisk.plans.oracle import oracle_sql
from tools.compare import digest, type_diffs

SF = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["lineitem", "part"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return c


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(SQL[name])
    o_cols, o_types = rel.columns, rel.types
    o_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert type_diffs(df.dtypes, o_cols, o_types) == []
    assert len(s_rows) == len(o_rows)
    assert digest(df.columns, s_rows) == digest(o_cols, o_rows)


@pytest.mark.parametrize("name", ["rank_overall", "rank_in_warehouse", "rpt_dashboard", "dq_report"])
def test_results_do_not_depend_on_runtime_settings(spark, con, name):
    """Same results without AQE, without automatic broadcasts, with another partition count and zone."""
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "7",
        "spark.sql.session.timeZone": "America/New_York",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = QUERIES[name](spark, SF)
        s_rows = [tuple(r) for r in df.collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    rel = con.sql(SQL[name])
    o_rows = rel.fetchall()
    assert len(s_rows) == len(o_rows)
    assert digest(df.columns, s_rows) == digest(rel.columns, o_rows)
