"""Denormalised dashboard report: fact + dimensions, flags, scores and ranks."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockrisk import constants as K
from stockrisk.functions.risk import (
    horizon_bucket,
    priority_band,
    priority_score,
    status_sort_order,
)
from stockrisk.operators.ranking import range_sorted, ranks
from stockrisk.schemas import REPORT_COLUMNS


def _flag(cond: Column) -> Column:
    """CASE WHEN cond THEN true ELSE false: NULL conditions give false."""
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def enrich(fct: DataFrame, product: DataFrame, warehouse: DataFrame, date: DataFrame) -> DataFrame:
    """Left-join the fact to its dimensions; unmatched attributes stay NULL.

    No broadcast is forced: dimensions read from stored tables carry their
    real size, so the planner broadcasts them while they are under the
    broadcast threshold and falls back to a sort-merge join beyond it.
    """
    f = fct.alias("f")
    out = (
        f.join(product.alias("p"), F.col("f.product_id") == F.col("p.product_id"), "left")
        .join(warehouse.alias("w"), F.col("f.warehouse_id") == F.col("w.warehouse_id"), "left")
        .join(date.alias("d"), F.col("f.snapshot_date") == F.col("d.date_day"), "left")
    )
    return out.select(
        "f.*",
        "p.product_name",
        "p.category",
        "w.warehouse_name",
        "d.year_num",
        "d.quarter_num",
        "d.month_num",
        "d.month_name",
        "d.week_num",
        "d.day_of_month",
        "d.day_of_week_num",
    )


# FIXED VALUE: a date no snapshot has; stands for "no latest date" in an empty fact.
NO_DATE = "0001-01-01"


def latest_date(df: DataFrame) -> Column:
    """The newest snapshot date of the fact as a scalar subquery, never NULL.

    ``max(..) over ()`` would move every row into one partition; a scalar
    aggregate shuffles one partial row per task and is broadcast as a value.
    """
    return df.agg(F.coalesce(F.max("snapshot_date"), F.lit(NO_DATE).cast("date"))).scalar()


def with_latest(df: DataFrame, latest: Column | None = None) -> DataFrame:
    """``is_latest_snapshot``: the row's date equals the newest date (false for a NULL date).

    Written as ``date = latest AND date IS NOT NULL``, which is never NULL
    because the latest date never is, and which reaches the parquet scan as a
    pushed filter, so latest-only readers skip the history's row groups.
    """
    latest = latest_date(df) if latest is None else latest
    d = F.col("snapshot_date")
    return df.withColumn("is_latest_snapshot", (d == latest) & d.isNotNull())


def with_flags(df: DataFrame) -> DataFrame:
    key = F.concat(
        F.col("snapshot_date").cast("string"),
        F.lit(K.REPORT_KEY_SEPARATOR),
        F.col("product_id"),
        F.lit(K.REPORT_KEY_SEPARATOR),
        F.col("warehouse_id"),
    )
    qty = F.col("qty_on_hand")
    return df.withColumns(
        {
            "warehouse_product_snapshot_key": key,
            "at_risk_flag": _flag(F.col("stock_status").isin(*K.AT_RISK_STATUSES)),
            "zero_inventory_flag": _flag(qty == 0),
            "stockout_event_flag": _flag((F.coalesce(F.col("prev_qty_on_hand"), F.lit(0)) > 0) & (qty == 0)),
            "replenishment_event_flag": _flag(F.coalesce(F.col("received_units"), F.lit(0)) > 0),
            "stockout_horizon_bucket": horizon_bucket(F.col("days_until_stockout")),
            "stock_status_sort_order": status_sort_order(F.col("stock_status")),
        }
    )


def with_scores(df: DataFrame) -> DataFrame:
    score = priority_score(F.col("qty_on_hand"), F.col("days_until_stockout"))
    return df.withColumn("risk_priority_score", score).withColumn(
        "risk_priority_band", priority_band(F.col("risk_priority_score"))
    )


# The priority order of the ranks, most urgent first. Within one warehouse the last key decides nothing.
RANK_KEYS = ["risk_priority_score", "days_until_stockout", "qty_on_hand", "product_id", "warehouse_id"]


def priority_order() -> list[Column]:
    """Score desc, days asc (missing days last), quantity, product, warehouse."""
    return [
        F.col("risk_priority_score").desc(),
        F.coalesce(F.col("days_until_stockout"), F.lit(float(K.RANK_MISSING_DAYS))).asc(),
        F.col("qty_on_hand").asc(),
        F.col("product_id").asc(),
        F.col("warehouse_id").asc(),
    ]


def _numbered(df: DataFrame) -> DataFrame:
    """Rows of one product and warehouse numbered: more than one only where the grain is violated."""
    own = Window.partitionBy("product_id", "warehouse_id").orderBy(*priority_order())
    return df.withColumn("_copy", F.row_number().over(own))


def latest_order(base: DataFrame) -> DataFrame:
    """The latest rows' order keys, globally sorted. Store this before :func:`report` ranks it."""
    latest = base.where(F.col("is_latest_snapshot")).select(*RANK_KEYS)
    return range_sorted(_numbered(latest), priority_order())


def report_base(fct: DataFrame, product: DataFrame, warehouse: DataFrame, date: DataFrame) -> DataFrame:
    """Every report column except the two ranks.

    The latest date is the fact's: a date dimension may reach further, or lag.
    """
    return with_scores(with_flags(with_latest(enrich(fct, product, warehouse, date), latest_date(fct))))


def ranked_latest(base: DataFrame, stored_order: DataFrame) -> DataFrame:
    """The latest rows of ``base`` with both ranks; ``stored_order`` is its :func:`latest_order`, stored."""
    ranked = ranks(stored_order, "latest_rank_overall", "warehouse_id", "latest_rank_in_warehouse").select(
        F.col("product_id").alias("_product"),
        F.col("warehouse_id").alias("_warehouse"),
        F.col("_copy").alias("_nth"),
        "latest_rank_overall",
        "latest_rank_in_warehouse",
    )
    same = (
        F.col("product_id").eqNullSafe(F.col("_product"))
        & F.col("warehouse_id").eqNullSafe(F.col("_warehouse"))
        & (F.col("_copy") == F.col("_nth"))
    )
    latest = _numbered(base.where(F.col("is_latest_snapshot")))
    return latest.join(ranked, same, "left").drop("_copy", "_product", "_warehouse", "_nth")


def report(base: DataFrame, stored_order: DataFrame) -> DataFrame:
    """The 34-column report, in published column order: ``base`` with the ranks of its latest rows.

    Only latest rows are ranked and joined; history, the exact complement,
    passes through with NULL ranks.
    """
    no_rank = F.lit(None).cast("bigint")
    history = base.where(~F.col("is_latest_snapshot")).withColumns(
        {"latest_rank_overall": no_rank, "latest_rank_in_warehouse": no_rank}
    )
    return history.select(*REPORT_COLUMNS).unionByName(ranked_latest(base, stored_order).select(*REPORT_COLUMNS))
