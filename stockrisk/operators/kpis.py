"""Dashboard filters and key figures over the report.

All figures are grouped aggregates: partial aggregation runs in every map
task before the shuffle. Products are counted over rows of one product each,
not by distinct counts, which would expand every row several times.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockrisk import constants as K
from stockrisk.operators.reporting import with_flags, with_latest


def filter_report(
    rpt: DataFrame,
    warehouses: Iterable[str] | None = None,
    categories: Iterable[str] | None = None,
    date_from: dt.date | str | None = None,
    date_to: dt.date | str | None = None,
) -> DataFrame:
    """Dashboard filters, applied to the finished report (ranks are not recomputed)."""
    out = rpt
    if warehouses is not None:
        out = out.where(F.col("warehouse_id").isin(list(warehouses)))
    if categories is not None:
        out = out.where(F.col("category").isin(list(categories)))
    if date_from is not None:
        out = out.where(F.col("snapshot_date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        out = out.where(F.col("snapshot_date") <= F.lit(date_to).cast("date"))
    return out


def flagged(fct: DataFrame) -> DataFrame:
    """What the figures need of the report, from the fact alone: no dimension is joined."""
    return with_flags(with_latest(fct))


def _by_product(rpt: DataFrame) -> DataFrame:
    """One row per date and product: the shortest horizon and the positions by status.

    Products are then counted as rows, so no figure needs a distinct count.
    """
    days, status = F.col("days_until_stockout"), F.col("stock_status")
    return rpt.groupBy("snapshot_date", "product_id").agg(
        F.min(days).alias("days"),
        F.sum(days).alias("days_sum"),
        F.count(days).alias("days_n"),
        F.count(F.when(status == K.STATUS_CRITICAL, 1)).alias("critical"),
        F.count(F.when(status == K.STATUS_LOW, 1)).alias("low"),
        F.count(F.when(F.col("at_risk_flag"), 1)).alias("at_risk"),
    )


def _risk_measures() -> list[Column]:
    """Figures over rows of :func:`_by_product`. A NULL product is no product."""
    known = F.col("product_id").isNotNull()
    return [
        F.count(F.when(known & (F.col("days") <= K.CRITICAL_MAX_DAYS), 1)).alias("critical_skus"),
        F.count(F.when(known & (F.col("days") <= K.LOW_MAX_DAYS), 1)).alias("low_stock_skus"),
        F.coalesce(F.sum("critical"), F.lit(0)).alias("critical_positions"),
        F.coalesce(F.sum("low"), F.lit(0)).alias("low_positions"),
        F.coalesce(F.sum("at_risk"), F.lit(0)).alias("at_risk_positions"),
    ]


def kpi_latest(rpt: DataFrame) -> DataFrame:
    """One row of headline figures for the latest snapshot.

    "Critical SKUs" and "low stock SKUs" count distinct products with at most
    7 and at most 14 days left (the low figure includes critical ones);
    ``*_positions`` count product x warehouse rows by status.
    """
    latest = rpt.where(F.col("is_latest_snapshot"))
    critical = latest.where((F.col("stock_status") == K.STATUS_CRITICAL) & F.col("warehouse_id").isNotNull())
    warehouses = critical.select("warehouse_id").distinct().agg(F.count("warehouse_id")).scalar()
    return (
        _by_product(latest)
        .agg(
            F.max("snapshot_date").alias("snapshot_date"),
            *_risk_measures(),
            F.round(F.sum("days_sum") / F.sum("days_n"), 4).alias("avg_days_until_stockout"),
        )
        .withColumn("warehouses_at_risk", warehouses)
    )


def risk_trend(rpt: DataFrame) -> DataFrame:
    """Critical and low-stock counts per snapshot date."""
    return _by_product(rpt).groupBy("snapshot_date").agg(*_risk_measures())


def warehouse_distribution(rpt: DataFrame) -> DataFrame:
    """Latest positions per warehouse and status, with the share of the warehouse."""
    counts = (
        rpt.where(F.col("is_latest_snapshot"))
        .groupBy("warehouse_id", "stock_status", "stock_status_sort_order")
        .agg(F.count(F.lit(1)).alias("positions"))
    )
    per_warehouse = Window.partitionBy("warehouse_id")
    return counts.withColumn(
        "share_of_warehouse", F.round(F.col("positions") / F.sum("positions").over(per_warehouse), 6)
    )


def top_products_at_risk(
    rpt: DataFrame, n: int = K.DEFAULT_TOP_N, per_product: bool = False, product: DataFrame | None = None
) -> DataFrame:
    """The ``n`` latest positions closest to stockout (a distributed top-k).

    With ``per_product`` a product counts once, by its most urgent position.
    Names come from ``rpt`` or, if that has none, from the ``product``
    dimension, joined to the ``n`` rows alone.
    """
    latest = rpt.where(F.col("is_latest_snapshot") & F.col("days_until_stockout").isNotNull())
    order = ["days_until_stockout", "product_id", "warehouse_id"]
    figures = ["qty_on_hand", "avg_daily_usage_7d", "stock_status"]
    named = [c for c in ("product_name", "category") if product is None]
    if per_product:
        first = F.min(F.struct("days_until_stockout", "warehouse_id", *figures, *named)).alias("_first")
        latest = latest.groupBy("product_id").agg(first).select("product_id", "_first.*")
    top = latest.orderBy(*order).limit(n)
    if product is not None:
        top = top.select(*order, *figures).join(product, "product_id", "left")
    return top.select(
        "product_id",
        "product_name",
        "category",
        "warehouse_id",
        "qty_on_hand",
        "avg_daily_usage_7d",
        "days_until_stockout",
        "stock_status",
    )


def warehouse_risk_history(rpt: DataFrame) -> DataFrame:
    """Per warehouse over all dates: mean daily share of at-risk positions."""
    daily = rpt.groupBy("warehouse_id", "snapshot_date").agg(
        F.count(F.lit(1)).alias("positions"),
        F.count(F.when(F.col("at_risk_flag"), 1)).alias("at_risk_positions"),
    )
    return daily.groupBy("warehouse_id").agg(
        F.count(F.lit(1)).alias("snapshot_days"),
        F.sum("positions").alias("positions"),
        F.sum("at_risk_positions").alias("at_risk_positions"),
        F.round(F.avg(F.col("at_risk_positions") / F.col("positions")), 6).alias("avg_daily_at_risk_share"),
    )
