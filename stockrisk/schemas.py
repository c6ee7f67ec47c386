"""Explicit schemas and column orders of every layer (nothing is inferred).

FIXED VALUES: names, types and orders must equal the published models.
"""

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

SERIES_KEYS = ["product_id", "warehouse_id"]
RAW_GRAIN = ["product_id", "warehouse_id", "load_dt"]
FACT_GRAIN = ["snapshot_date", "product_id", "warehouse_id"]

RAW = StructType(
    [
        StructField("product_id", StringType()),
        StructField("warehouse_id", StringType()),
        StructField("qty_on_hand", LongType()),
        StructField("load_dt", StringType()),
    ]
)
RAW_COLUMNS = RAW.fieldNames()

SILVER_COLUMNS = ["product_id", "warehouse_id", "load_dt", "qty_on_hand"]

PRODUCT = StructType(
    [
        StructField("product_id", StringType()),
        StructField("product_name", StringType()),
        StructField("category", StringType()),
    ]
)

STG = StructType(
    [
        StructField("product_id", StringType()),
        StructField("warehouse_id", StringType()),
        StructField("snapshot_date", DateType()),
        StructField("qty_on_hand", LongType()),
    ]
)

FACT = StructType(
    [
        StructField("snapshot_date", DateType()),
        StructField("product_id", StringType()),
        StructField("warehouse_id", StringType()),
        StructField("qty_on_hand", LongType()),
        StructField("prev_qty_on_hand", LongType()),
        StructField("inventory_delta", LongType()),
        StructField("daily_units_sold_proxy", LongType()),
        StructField("received_units", LongType()),
        StructField("avg_daily_usage_7d", DoubleType()),
        StructField("days_until_stockout", DoubleType()),
        StructField("reorder_flag", BooleanType()),
        StructField("stock_status", StringType()),
    ]
)
FACT_COLUMNS = FACT.fieldNames()

DIM_DATE_COLUMNS = [
    "date_day",
    "year_num",
    "quarter_num",
    "month_num",
    "month_name",
    "week_num",
    "day_of_month",
    "day_of_week_num",
]

REPORT_COLUMNS = [
    "warehouse_product_snapshot_key",
    "snapshot_date",
    "year_num",
    "quarter_num",
    "month_num",
    "month_name",
    "week_num",
    "day_of_month",
    "day_of_week_num",
    "product_id",
    "product_name",
    "category",
    "warehouse_id",
    "warehouse_name",
    "qty_on_hand",
    "prev_qty_on_hand",
    "inventory_delta",
    "daily_units_sold_proxy",
    "received_units",
    "avg_daily_usage_7d",
    "days_until_stockout",
    "reorder_flag",
    "stock_status",
    "stock_status_sort_order",
    "is_latest_snapshot",
    "at_risk_flag",
    "zero_inventory_flag",
    "stockout_event_flag",
    "replenishment_event_flag",
    "stockout_horizon_bucket",
    "risk_priority_score",
    "risk_priority_band",
    "latest_rank_overall",
    "latest_rank_in_warehouse",
]
