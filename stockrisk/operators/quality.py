"""Data-quality checks. A check passes when its result is empty (or zero).

Generic checks skip NULLs where their published meaning does (unique,
accepted values, relationships). ``quality_report`` runs the full suite with
one fused aggregate per model for the NULL counts instead of a scan per
column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockrisk import constants as K
from stockrisk.schemas import FACT_GRAIN

NON_NEGATIVE_COLUMNS = [
    "qty_on_hand",
    "daily_units_sold_proxy",
    "received_units",
    "avg_daily_usage_7d",
    "days_until_stockout",
]


def not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, failures): NULL rows per column, all columns in one pass."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(f"_n{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(cols))
    return counts.selectExpr(f"stack({len(cols)}, {pairs}) as (column_name, failures)")


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values occurring more than once, with their count."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def accepted_values(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    """Values outside ``values`` (NULL is not judged), with their count."""
    return (
        df.where(F.col(col).isNotNull() & ~F.col(col).isin(values))
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child values without a parent, with the number of child rows carrying each.

    The child side is aggregated to one row per value before the anti join,
    so the join moves (distinct values), not (child rows).
    """
    values = child.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))
    keys = parent.select(F.col(parent_col).alias("_parent_key")).where(F.col("_parent_key").isNotNull())
    return values.join(keys, values[col] == keys["_parent_key"], "left_anti")


def grain(df: DataFrame, keys: list[str] = FACT_GRAIN) -> DataFrame:
    """Key combinations with more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def _negative() -> F.Column:
    cond = F.col("qty_on_hand") < 0
    for c in NON_NEGATIVE_COLUMNS[1:]:
        cond = cond | (F.coalesce(F.col(c), F.lit(0)) < 0)
    return cond


def non_negative(df: DataFrame) -> DataFrame:
    """Fact rows with a negative quantity or metric (NULL metrics count as 0)."""
    return df.where(_negative())


# --- The published suite: 44 not_null, 5 unique, 3 relationships, ----------
# --- 4 accepted_values and 2 custom checks over eight models. ---------------


@dataclass(frozen=True)
class Check:
    check: str
    model: str
    column: str
    values: tuple = ()
    parent: str = ""
    parent_column: str = ""


def _nn(model: str, *cols: str) -> list[Check]:
    return [Check("not_null", model, c) for c in cols]


# FIXED VALUES: models, columns and kinds of the published checks.
SUITE: list[Check] = [
    *_nn("inventory_silver", "product_id", "warehouse_id", "load_dt"),
    *_nn("stg_inventory_silver", "product_id", "warehouse_id", "snapshot_date", "qty_on_hand"),
    *_nn("product_master", "product_id", "product_name", "category"),
    Check("unique", "product_master", "product_id"),
    *_nn("dim_product", "product_id", "product_name", "category"),
    Check("unique", "dim_product", "product_id"),
    *_nn("dim_warehouse", "warehouse_id", "warehouse_name"),
    Check("unique", "dim_warehouse", "warehouse_id"),
    *_nn(
        "dim_date",
        "date_day",
        "year_num",
        "quarter_num",
        "month_num",
        "month_name",
        "week_num",
        "day_of_month",
        "day_of_week_num",
    ),
    Check("unique", "dim_date", "date_day"),
    *_nn("fct_inventory_risk", "snapshot_date", "product_id", "warehouse_id", "qty_on_hand"),
    *_nn("fct_inventory_risk", "reorder_flag", "stock_status"),
    Check("relationships", "fct_inventory_risk", "snapshot_date", parent="dim_date", parent_column="date_day"),
    Check("relationships", "fct_inventory_risk", "product_id", parent="dim_product", parent_column="product_id"),
    Check(
        "relationships", "fct_inventory_risk", "warehouse_id", parent="dim_warehouse", parent_column="warehouse_id"
    ),
    Check("accepted_values", "fct_inventory_risk", "stock_status", values=tuple(K.STOCK_STATUSES)),
    *_nn(
        "rpt_inventory_risk_dashboard",
        "warehouse_product_snapshot_key",
        "snapshot_date",
        "product_id",
        "warehouse_id",
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
    ),
    Check("unique", "rpt_inventory_risk_dashboard", "warehouse_product_snapshot_key"),
    Check("accepted_values", "rpt_inventory_risk_dashboard", "stock_status", values=tuple(K.STOCK_STATUSES)),
    Check(
        "accepted_values",
        "rpt_inventory_risk_dashboard",
        "stockout_horizon_bucket",
        values=tuple(K.HORIZON_LABELS),
    ),
    Check(
        "accepted_values",
        "rpt_inventory_risk_dashboard",
        "risk_priority_band",
        values=tuple(K.PRIORITY_BAND_LABELS),
    ),
    Check("grain", "fct_inventory_risk", ", ".join(FACT_GRAIN)),
    Check("non_negative", "fct_inventory_risk", ", ".join(NON_NEGATIVE_COLUMNS)),
]


_FUSED = ("not_null", "accepted_values", "non_negative")


def _fused(model: str, df: DataFrame, checks: list[Check]) -> DataFrame:
    """All aggregate-shaped checks of one model in a single pass over it.

    The rows are counted by the columns with accepted values: few
    combinations, formed in the map tasks. NULL and sign counts are summed
    over them, and unaccepted values (one failure per distinct value, NULL not
    judged) are looked for among them alone.
    """
    counted = [c for c in checks if c.check != "accepted_values"]
    judged = [c for c in checks if c.check == "accepted_values"]
    fails = [F.col(c.column).isNull() if c.check == "not_null" else _negative() for c in counted]
    counts = [F.count(F.when(f, 1)).alias(f"_f{i}") for i, f in enumerate(fails)]
    small = df.groupBy(*[F.col(c.column).alias(f"_v{i}") for i, c in enumerate(judged)]).agg(*counts)
    total = small.agg(*[F.coalesce(F.sum(f"_f{i}"), F.lit(0)).cast("bigint").alias(f"_f{i}") for i in range(len(counted))])
    rows = ", ".join(f"'{c.check}', '{c.column}', _f{i}" for i, c in enumerate(counted))
    out = total.selectExpr(f"stack({len(counted)}, {rows}) as (check_name, column_name, failures)").select(
        "check_name", F.lit(model).alias("model"), "column_name", "failures"
    )
    for i, c in enumerate(judged):
        value = F.col(f"_v{i}")
        strange = small.where(value.isNotNull() & ~value.isin(list(c.values))).select(value).distinct()
        out = out.unionByName(_count_rows(strange, c))
    return out


def _count_rows(df: DataFrame, check: Check) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
        F.lit(check.check).alias("check_name"),
        F.lit(check.model).alias("model"),
        F.lit(check.column).alias("column_name"),
        "failures",
    )


def quality_report(models: dict[str, DataFrame], suite: list[Check] = SUITE) -> DataFrame:
    """(check_name, model, column_name, failures) for every check in ``suite``.

    ``failures`` is the number of rows the check's query returns: NULL rows,
    duplicated values, unaccepted values, orphan child rows, duplicated grain
    keys, negative rows. NULL counts, accepted values and sign checks of a
    model are fused into one aggregate over it; uniqueness, grain and
    relationships group by their own keys.
    """
    parts: list[DataFrame] = []
    fused: dict[str, list[Check]] = {}
    for c in suite:
        if c.check in _FUSED:
            fused.setdefault(c.model, []).append(c)
    for model, checks in fused.items():
        parts.append(_fused(model, models[model], checks))
    for c in suite:
        df = models.get(c.model)
        if c.check == "unique":
            parts.append(_count_rows(unique(df, c.column), c))
        elif c.check == "relationships":
            orphans = relationships(df, c.column, models[c.parent], c.parent_column)
            parts.append(
                orphans.agg(F.coalesce(F.sum("n_records"), F.lit(0)).cast("bigint").alias("failures")).select(
                    F.lit(c.check).alias("check_name"),
                    F.lit(c.model).alias("model"),
                    F.lit(c.column).alias("column_name"),
                    "failures",
                )
            )
        elif c.check == "grain":
            parts.append(_count_rows(grain(df), c))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
