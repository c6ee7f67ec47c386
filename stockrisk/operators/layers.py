"""Bronze, silver and staging layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockrisk.functions.text import load_date_sql, trim_sql, trim_ws
from stockrisk.schemas import RAW_GRAIN, SILVER_COLUMNS


def dedup_bronze(raw: DataFrame, keys: list[str] = RAW_GRAIN, order_col: str = "qty_on_hand") -> DataFrame:
    """Keep one row per raw key: the one with the highest quantity (NULL loses).

    Keys are compared as stored (untrimmed). Written as a hash aggregate, not a
    ranked window: the partial aggregate collapses duplicate copies inside each
    map task before the shuffle, so even a key holding a large share of all
    rows moves one row per task. Extra columns ride along in a struct led by
    the quantity, whose maximum is the winning row (a NULL quantity sorts
    lowest).
    """
    others = [c for c in raw.columns if c not in keys and c != order_col]
    if not others:
        out = raw.groupBy(*keys).agg(F.max(order_col).alias(order_col))
    else:
        best = F.max(F.struct(F.col(order_col), *[F.col(c) for c in others])).alias("_best")
        out = raw.groupBy(*keys).agg(best).select(*keys, "_best.*")
    return out.select(*raw.columns)


def to_silver(bronze: DataFrame) -> DataFrame:
    """The four snapshot columns, in silver order."""
    return bronze.select(*SILVER_COLUMNS)


# Staging as SQL text, so the stored silver table can carry it as a view.
STAGE_FILTER = (
    "product_id IS NOT NULL AND warehouse_id IS NOT NULL AND load_dt IS NOT NULL "
    f"AND {trim_sql('load_dt')} <> '' AND qty_on_hand IS NOT NULL"
)
STAGE_COLUMNS = {
    "product_id": f"CAST({trim_sql('product_id')} AS STRING)",
    "warehouse_id": f"CAST({trim_sql('warehouse_id')} AS STRING)",
    "snapshot_date": load_date_sql(trim_sql("load_dt")),
    "qty_on_hand": "CAST(qty_on_hand AS BIGINT)",
}


def stage_select(source: str) -> str:
    """The staging model over a stored table, as the text of a view."""
    columns = ", ".join(f"{e} AS {c}" for c, e in STAGE_COLUMNS.items())
    return f"SELECT {columns} FROM {source} WHERE {STAGE_FILTER}"


def stage(silver: DataFrame) -> DataFrame:
    """Clean and type the snapshots: trimmed keys, parsed date, bigint quantity.

    Only a blank date is rejected as text; blank keys pass (as defined).
    """
    return silver.where(STAGE_FILTER).selectExpr(*[f"{e} AS {c}" for c, e in STAGE_COLUMNS.items()])


def stage_rejects(silver: DataFrame) -> DataFrame:
    """Rows :func:`stage` drops, with the first failed condition as the reason."""
    reason = (
        F.when(F.col("product_id").isNull(), F.lit("product_id is null"))
        .when(F.col("warehouse_id").isNull(), F.lit("warehouse_id is null"))
        .when(F.col("load_dt").isNull(), F.lit("load_dt is null"))
        .when(trim_ws("load_dt") == "", F.lit("load_dt is blank"))
        .when(F.col("qty_on_hand").isNull(), F.lit("qty_on_hand is null"))
    )
    return silver.where(f"NOT ({STAGE_FILTER})").select(*SILVER_COLUMNS, reason.alias("reject_reason"))
