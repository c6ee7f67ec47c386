import datetime as dt

from stockrisk.operators.dims import dim_date, dim_product, dim_warehouse
from stockrisk.schemas import DIM_DATE_COLUMNS, STG


def test_calendar_edges(spark):
    days = [dt.date(2024, 12, 30), dt.date(2025, 1, 5), dt.date(2024, 2, 29), dt.date(2025, 1, 5)]
    stg = spark.createDataFrame([("P", "W", d, 1) for d in days] + [("P", "W", None, 1)], STG)
    out = {r.date_day: r for r in dim_date(stg).collect()}
    assert dim_date(stg).columns == DIM_DATE_COLUMNS
    assert len(out) == 3
    r = out[dt.date(2024, 12, 30)]
    assert (r.year_num, r.quarter_num, r.month_num, r.month_name, r.week_num, r.day_of_week_num) == (
        2024,
        4,
        12,
        "December",
        1,
        1,
    )
    assert out[dt.date(2025, 1, 5)].day_of_week_num == 7  # Sunday
    leap = out[dt.date(2024, 2, 29)]
    assert (leap.day_of_month, leap.month_name, leap.week_num) == (29, "February", 9)
    assert dict(dim_date(stg).dtypes)["year_num"] == "bigint"


def test_warehouse_dimension_is_distinct_non_null(spark):
    stg = spark.createDataFrame(
        [("P", "W1", dt.date(2025, 1, 1), 1), ("Q", "W1", dt.date(2025, 1, 1), 1), ("P", None, dt.date(2025, 1, 1), 1)],
        STG,
    )
    assert [tuple(r) for r in dim_warehouse(stg).collect()] == [("W1", "W1")]


def test_product_dimension_types(spark):
    seed = spark.createDataFrame([("SKU1", "Serum", "beauty")], "product_id string, product_name string, category string")
    assert dim_product(seed).dtypes == [("product_id", "string"), ("product_name", "string"), ("category", "string")]
