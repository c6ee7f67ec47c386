import datetime as dt
from collections import Counter

from stockrisk.operators.layers import stage, to_silver
from stockrisk.operators.quality import (
    SUITE,
    accepted_values,
    grain,
    non_negative,
    not_null,
    relationships,
    unique,
)
from stockrisk.operators.risk import fact
from stockrisk.schemas import RAW, STG


def test_suite_shape():
    assert len(SUITE) == 58
    assert Counter(c.check for c in SUITE) == {
        "not_null": 44,
        "unique": 5,
        "relationships": 3,
        "accepted_values": 4,
        "grain": 1,
        "non_negative": 1,
    }


def test_collision_after_trim_is_a_grain_failure(spark):
    raw = spark.createDataFrame([("A", "W1", 1, "1/1/2025"), ("A ", "W1", 2, "1/1/2025")], RAW)
    stg = stage(to_silver(raw))
    [r] = grain(stg, ["snapshot_date", "product_id", "warehouse_id"]).collect()
    assert (r.product_id, r.row_count) == ("A", 2)


def test_not_null_counts_every_column(spark):
    raw = spark.createDataFrame([("A", None, None, "1/1/2025"), (None, None, 3, None)], RAW)
    got = {r.column_name: r.failures for r in not_null(raw, RAW.fieldNames()).collect()}
    assert got == {"product_id": 1, "warehouse_id": 2, "qty_on_hand": 1, "load_dt": 1}


def test_unique_accepted_relationships(spark):
    df = spark.createDataFrame([("a", "X"), ("a", "Y"), ("b", None), (None, "Z"), (None, "Z")], "k string, s string")
    assert [tuple(r) for r in unique(df, "k").collect()] == [("a", 2)]
    assert sorted(tuple(r) for r in accepted_values(df, "s", ["X"]).collect()) == [("Y", 1), ("Z", 2)]
    parent = spark.createDataFrame([("a",)], "id string")
    assert [tuple(r) for r in relationships(df, "k", parent, "id").collect()] == [("b", 1)]


def test_non_negative_catches_shifted_quantities(spark):
    stg = spark.createDataFrame([("P", "W", dt.date(2025, 1, 1), 5), ("P", "W", dt.date(2025, 1, 2), 1)], STG)
    assert non_negative(fact(stg)).count() == 0
    shifted = stg.selectExpr("product_id", "warehouse_id", "snapshot_date", "qty_on_hand - 3 as qty_on_hand")
    assert non_negative(fact(shifted)).count() == 1


def test_fused_report_equals_single_checks(spark):
    from stockrisk.operators.quality import quality_report
    from stockrisk.plans.catalog import _silver
    from stockrisk.plans.pipeline import build_models, build_report
    from stockrisk.sources.fixture import load_product_master, load_raw

    sf = "/root/testdata/sf0.001"
    m = build_models(_silver(spark, sf), load_product_master(spark, sf))
    models = m.as_dict()
    models["rpt_inventory_risk_dashboard"] = build_report(m)
    # a silver stand-in that fails: raw rows keep NULL dates and duplicates
    models["inventory_silver"] = load_raw(spark, sf)
    got = {(r.check_name, r.model, r.column_name): r.failures for r in quality_report(models).collect()}
    assert len(got) == 58
    for c in SUITE:
        df = models[c.model]
        if c.check == "not_null":
            want = df.where(df[c.column].isNull()).count()
        elif c.check == "unique":
            want = unique(df, c.column).count()
        elif c.check == "accepted_values":
            want = accepted_values(df, c.column, list(c.values)).count()
        elif c.check == "relationships":
            want = relationships(df, c.column, models[c.parent], c.parent_column).groupBy().sum("n_records").first()[0] or 0
        elif c.check == "grain":
            want = grain(df).count()
        else:
            want = non_negative(df).count()
        assert got[(c.check, c.model, c.column)] == want, c
    assert got[("not_null", "inventory_silver", "load_dt")] > 0
    assert got[("relationships", "fct_inventory_risk", "product_id")] > 0
