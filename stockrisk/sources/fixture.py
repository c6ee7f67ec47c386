"""Inventory snapshots derived from the driver's order-line and part tables.

The models consume raw daily stock snapshots per (product, warehouse). The
test and bench inputs are the driver's TPC-H-like tables, so this adapter
derives a snapshot relation from them with Spark column expressions: one raw
snapshot for every order line, one product for every group of parts. The
relation is dirty on purpose: duplicate snapshots, padded keys, NULL
quantities, NULL and blank dates, gaps, and codes absent from the master.

Every rule for a snapshot is a narrow projection of one order line, so it adds
no shuffle; the master is one aggregate over the parts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockrisk.schemas import PRODUCT, RAW

# FIXED VALUES of the adapter (shared with the SQL oracle).
PERIOD_ORIGIN = dt.date(1995, 1, 1)
PERIOD_DAYS = 30
PARTS_PER_PRODUCT = 10
LEADING_PAD_EVERY = 7  # product numbers divisible by 7 get two leading blanks
TRAILING_PAD_EVERY = 11  # ... divisible by 11 get one trailing blank
WAREHOUSES = 4
NULL_QTY_EVERY = 97  # order keys divisible by 97 lose their quantity
BLANK_DATE_EVERY = 89  # ... by 89 get a blank date
NULL_DATE_EVERY = 83  # ... by 83 get a NULL date
QTY_FLOOR = 10
QTY_STEP_PER_CLASS = 40
QTY_CLASSES = 6
CODE_PREFIX = "SKU"
NEW_CODE_EVERY = 103  # order keys divisible by 103 carry a code the master doesn't know yet
NEW_CODE_PREFIX = "NEW"


def product_number(partkey: Column) -> Column:
    """Integer division: a double would lose the low digits of a large key."""
    return F.call_function("div", partkey.cast("bigint"), F.lit(PARTS_PER_PRODUCT).cast("bigint"))


def _zero_pad(num: Column, width: int) -> Column:
    """Decimal text of a non-negative number, left-padded with zeros to ``width`` (never cut)."""
    text = num.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def product_code(num: Column) -> Column:
    return F.concat(F.lit(CODE_PREFIX), _zero_pad(num, 6))


def _month_day_year(d: Column) -> Column:
    """``M/d/yyyy`` text of a date from its integer parts (no formatter per row)."""
    return F.concat_ws("/", F.month(d).cast("string"), F.dayofmonth(d).cast("string"), F.year(d).cast("string"))


def raw_snapshots(lineitem: DataFrame) -> DataFrame:
    """Raw snapshot relation with the :data:`RAW` schema."""
    k = product_number(F.col("l_partkey"))
    code = F.concat(
        F.when(k % LEADING_PAD_EVERY == 0, F.lit("  ")).otherwise(F.lit("")),
        F.when(F.col("l_orderkey") % NEW_CODE_EVERY == 0, F.lit(NEW_CODE_PREFIX)).otherwise(F.lit(CODE_PREFIX)),
        _zero_pad(k, 6),
        F.when(k % TRAILING_PAD_EVERY == 0, F.lit(" ")).otherwise(F.lit("")),
    )
    warehouse = F.concat(F.lit("WH"), _zero_pad(F.col("l_suppkey") % WAREHOUSES + 1, 2))
    qty = F.when(F.col("l_orderkey") % NULL_QTY_EVERY == 0, F.lit(None).cast("bigint")).otherwise(
        (F.greatest(F.lit(0.0), F.col("l_quantity") - QTY_FLOOR) + (k % QTY_CLASSES) * QTY_STEP_PER_CLASS).cast(
            "bigint"
        )
    )
    origin = F.lit(PERIOD_ORIGIN)
    ship_day = F.to_date(F.col("l_shipdate"))
    day = F.datediff(ship_day, origin)
    period_start = F.date_add(origin, day - F.pmod(day, F.lit(PERIOD_DAYS)))
    load_dt = (
        F.when(F.col("l_orderkey") % BLANK_DATE_EVERY == 0, F.lit(" "))
        .when(F.col("l_orderkey") % NULL_DATE_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(_month_day_year(period_start))
    )
    return lineitem.select(
        code.alias("product_id"),
        warehouse.alias("warehouse_id"),
        qty.alias("qty_on_hand"),
        load_dt.alias("load_dt"),
    )


def product_master(part: DataFrame) -> DataFrame:
    """Product master with the :data:`PRODUCT` schema: one row per product number over all parts.

    Name and category are those of the number's first part.
    """
    first = part.groupBy(product_number(F.col("p_partkey")).alias("k")).agg(
        F.min_by("p_name", "p_partkey").alias("name"), F.min_by("p_type", "p_partkey").alias("type")
    )
    return first.select(
        product_code(F.col("k")).alias("product_id"),
        F.col("name").cast("string").alias("product_name"),
        F.col("type").cast("string").alias("category"),
    )


def load_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_snapshots(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def load_product_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_master(spark.read.parquet(f"{sf_dir}/part.parquet"))


assert RAW.fieldNames() == ["product_id", "warehouse_id", "qty_on_hand", "load_dt"]
assert PRODUCT.fieldNames() == ["product_id", "product_name", "category"]
