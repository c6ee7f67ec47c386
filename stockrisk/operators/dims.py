"""Product, warehouse and date dimensions.

Warehouse and date dimensions are the distinct values of the snapshots; the
distinct runs as a partial aggregate before the shuffle, so only one row per
value and map task crosses the network.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockrisk.functions.calendar import calendar_parts


def dim_product(seed: DataFrame) -> DataFrame:
    return seed.select(
        F.col("product_id").cast("string").alias("product_id"),
        F.col("product_name").cast("string").alias("product_name"),
        F.col("category").cast("string").alias("category"),
    )


def dim_warehouse(snapshots: DataFrame) -> DataFrame:
    """One row per non-NULL warehouse; the display name is the id."""
    wid = F.col("warehouse_id").cast("string")
    return (
        snapshots.where(F.col("warehouse_id").isNotNull())
        .select(wid.alias("warehouse_id"), wid.alias("warehouse_name"))
        .distinct()
    )


def dim_date(snapshots: DataFrame) -> DataFrame:
    """One row per non-NULL snapshot date with its calendar attributes."""
    days = snapshots.where(F.col("snapshot_date").isNotNull()).select(
        F.col("snapshot_date").cast("date").alias("date_day")
    ).distinct()
    d = F.col("date_day")
    return days.select(d, *calendar_parts(d))
