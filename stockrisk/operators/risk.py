"""Stock movements, rolling usage and risk status per product x warehouse series.

All three steps share one window specification, so the plan has a single
exchange (hash on product, warehouse) and a single sort for the lag and the
rolling mean. A series holds at most one row per snapshot date after the
dedup, so the largest window partition is bounded by the calendar (a decade
of daily snapshots is ~3,650 rows), not by the data volume; volume grows with
the number of series, which hash partitioning spreads evenly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockrisk import constants as K
from stockrisk.functions.risk import days_until_stockout, reorder_flag, stock_status
from stockrisk.schemas import FACT, SERIES_KEYS


def series_window() -> Window:
    return Window.partitionBy(*SERIES_KEYS).orderBy("snapshot_date")


def with_deltas(stg: DataFrame) -> DataFrame:
    """Previous quantity, change, units sold (decrease) and received (increase).

    The first snapshot of a series has a NULL change but zero sold/received.
    """
    prev = F.col("prev_qty_on_hand")
    delta = F.col("qty_on_hand") - prev
    zero = F.lit(0).cast("bigint")
    return stg.withColumn("prev_qty_on_hand", F.lag("qty_on_hand").over(series_window())).withColumns(
        {
            "inventory_delta": delta,
            "daily_units_sold_proxy": F.when(prev.isNull(), zero).when(delta < 0, F.abs(delta)).otherwise(zero),
            "received_units": F.when(prev.isNull(), zero).when(delta > 0, delta).otherwise(zero),
        }
    )


def with_usage(deltas: DataFrame, rows: int = K.USAGE_WINDOW_ROWS) -> DataFrame:
    """Mean units sold over the current and ``rows - 1`` preceding snapshots.

    A frame of rows, not of days: gaps are not filled, and a short history
    averages over what exists.
    """
    frame = series_window().rowsBetween(-(rows - 1), Window.currentRow)
    return deltas.withColumn("avg_daily_usage_7d", F.avg("daily_units_sold_proxy").over(frame))


def with_risk(usage: DataFrame) -> DataFrame:
    """Days until stockout, reorder flag and stock status."""
    u = F.col("avg_daily_usage_7d")
    days = F.col("days_until_stockout")
    return usage.withColumn("days_until_stockout", days_until_stockout(F.col("qty_on_hand"), u)).withColumns(
        {"reorder_flag": reorder_flag(u, days), "stock_status": stock_status(u, days)}
    )


def fact(stg: DataFrame) -> DataFrame:
    """The typed 12-column risk fact at (snapshot_date, product, warehouse) grain."""
    risk = with_risk(with_usage(with_deltas(stg)))
    return risk.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACT.fields])
