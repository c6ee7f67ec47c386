"""The query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query starts from the driver's tables (order lines and parts) through
the snapshot adapter, so its work grows with the input.
"""

from __future__ import annotations

import datetime as dt
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockrisk import constants as K
from stockrisk.functions.risk import status_sort_order
from stockrisk.operators import dims, kpis, layers, quality, risk
from stockrisk.operators.reporting import enrich, latest_order, ranked_latest, with_scores
from stockrisk.plans import pipeline as P
from stockrisk.plans.pipeline import Lake, Models, build_models, build_report, run_pipeline
from stockrisk.schemas import FACT_GRAIN, PRODUCT, RAW_COLUMNS, RAW_GRAIN, SILVER_COLUMNS
from stockrisk.session import checkpoint_root
from stockrisk.sources.fixture import load_product_master, load_raw
from stockrisk.sources.readers import read_layer, read_product_master, read_raw
from stockrisk.sources.sinks import ensure_database, pin, quoted, write_layer

Query = Callable[[SparkSession, str], DataFrame]

# Dashboard filter used by ``dashboard_filtered`` (a typical saved view).
DASHBOARD_WAREHOUSES = ["WH01", "WH03"]
DASHBOARD_CATEGORIES = ["ECONOMY", "PROMO", "STANDARD"]
DASHBOARD_FROM = dt.date(2000, 1, 1)
DASHBOARD_TO = dt.date(2000, 12, 31)
# Accepted list that leaves one real status out, so the check has failures.
STATUSES_WITHOUT_MEDIUM = [K.STATUS_CRITICAL, K.STATUS_LOW, K.STATUS_HEALTHY]
NEGATIVE_SHIFT = 100

KEYS = ["snapshot_date", "product_id", "warehouse_id"]


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.to_silver(layers.dedup_bronze(load_raw(spark, sf_dir)))


def _stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.stage(_silver(spark, sf_dir))


def _models(spark: SparkSession, sf_dir: str) -> Models:
    return build_models(_silver(spark, sf_dir), load_product_master(spark, sf_dir))


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored fact with the report's flags and scores; no dimension is read."""
    return with_scores(kpis.flagged(P.pinned_fact(_silver(spark, sf_dir))))


def _tag(sf_dir: str) -> str:
    return f"{zlib.crc32(sf_dir.encode()):08x}"


def _lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Where these queries publish: one place per input, so a rerun replaces what is there."""
    tag = _tag(sf_dir)
    root = f"{checkpoint_root(spark).rstrip('/')}/lake-{tag}"
    return Lake(root, f"inventory_bronze_{tag}", f"inventory_silver_{tag}", f"inventory_marts_{tag}")


# --- sources and layers ---------------------------------------------------


def q_raw_scan(spark, sf_dir):
    return load_raw(spark, sf_dir)


def q_read_raw_table(spark, sf_dir):
    """The raw table with its quantity stored as text, read back typed."""
    lake = _lake(spark, sf_dir)
    text = load_raw(spark, sf_dir).withColumn("qty_on_hand", F.col("qty_on_hand").cast("string"))
    ensure_database(spark, lake.bronze_db)
    stored = write_layer(text, lake.bronze_db, "raw_snapshots", lake.path(lake.bronze_db, "raw_snapshots"))
    return read_raw(spark, table=stored.table)


def q_read_raw_csv(spark, sf_dir):
    path = f"{_lake(spark, sf_dir).root}/raw_csv"
    # Padding is data here; a blank date would be read as NULL if it weren't quoted.
    keep = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    load_raw(spark, sf_dir).write.mode("overwrite").options(**keep).csv(path)
    return read_raw(spark, path=path)


def q_read_product_master(spark, sf_dir):
    path = f"{_lake(spark, sf_dir).root}/seed_csv"
    load_product_master(spark, sf_dir).write.mode("overwrite").option("header", True).csv(path)
    return read_product_master(spark, path).select(*PRODUCT.fieldNames())


def q_bronze_dedup(spark, sf_dir):
    return layers.dedup_bronze(load_raw(spark, sf_dir))


def q_silver_snapshot(spark, sf_dir):
    return _silver(spark, sf_dir)


def q_stg_inventory(spark, sf_dir):
    return _stg(spark, sf_dir)


def q_stg_rejects(spark, sf_dir):
    return layers.stage_rejects(_silver(spark, sf_dir))


# --- risk model -------------------------------------------------------------


def q_inventory_deltas(spark, sf_dir):
    return risk.with_deltas(_stg(spark, sf_dir))


def q_rolling_usage(spark, sf_dir):
    return risk.with_usage(risk.with_deltas(_stg(spark, sf_dir)))


def q_days_until_stockout(spark, sf_dir):
    return risk.with_risk(risk.with_usage(risk.with_deltas(_stg(spark, sf_dir)))).select(
        "product_id", "warehouse_id", "snapshot_date", "qty_on_hand", "avg_daily_usage_7d", "days_until_stockout"
    )


def q_stock_status(spark, sf_dir):
    r = risk.with_risk(risk.with_usage(risk.with_deltas(_stg(spark, sf_dir))))
    return r.select(
        "product_id",
        "warehouse_id",
        "snapshot_date",
        "days_until_stockout",
        "reorder_flag",
        "stock_status",
        status_sort_order(F.col("stock_status")).alias("stock_status_sort_order"),
    )


def q_fct_inventory_risk(spark, sf_dir):
    return risk.fact(_stg(spark, sf_dir))


# --- dimensions -------------------------------------------------------------


def q_dim_product(spark, sf_dir):
    return dims.dim_product(load_product_master(spark, sf_dir))


def q_dim_warehouse(spark, sf_dir):
    return dims.dim_warehouse(_stg(spark, sf_dir))


def q_dim_date(spark, sf_dir):
    return dims.dim_date(_stg(spark, sf_dir))


# --- report -----------------------------------------------------------------


def q_fact_enriched(spark, sf_dir):
    m = _models(spark, sf_dir)
    return enrich(m.fct, m.dim_product, m.dim_warehouse, m.dim_date)


def q_latest_snapshot_flag(spark, sf_dir):
    return _flagged(spark, sf_dir).select(*KEYS, "is_latest_snapshot")


def q_report_flags(spark, sf_dir):
    return _flagged(spark, sf_dir).select(
        "warehouse_product_snapshot_key",
        *KEYS,
        "at_risk_flag",
        "zero_inventory_flag",
        "stockout_event_flag",
        "replenishment_event_flag",
    )


def q_horizon_buckets(spark, sf_dir):
    return _flagged(spark, sf_dir).select(*KEYS, "days_until_stockout", "stockout_horizon_bucket")


def q_risk_scores(spark, sf_dir):
    return _flagged(spark, sf_dir).select(
        *KEYS, "qty_on_hand", "days_until_stockout", "risk_priority_score", "risk_priority_band"
    )


def _latest_ranked(spark, sf_dir):
    base = _flagged(spark, sf_dir)
    return ranked_latest(base, pin(latest_order(base), "latest_order"))


def q_rank_overall(spark, sf_dir):
    return _latest_ranked(spark, sf_dir).select(
        *KEYS, "risk_priority_score", "days_until_stockout", "qty_on_hand", "latest_rank_overall"
    )


def q_rank_in_warehouse(spark, sf_dir):
    return _latest_ranked(spark, sf_dir).select(*KEYS, "risk_priority_score", "latest_rank_in_warehouse")


def q_rpt_dashboard(spark, sf_dir):
    return build_report(_models(spark, sf_dir))


def q_dashboard_filtered(spark, sf_dir):
    return kpis.filter_report(
        _published_report(spark, sf_dir),
        warehouses=DASHBOARD_WAREHOUSES,
        categories=DASHBOARD_CATEGORIES,
        date_from=DASHBOARD_FROM,
        date_to=DASHBOARD_TO,
    )


# --- key figures --------------------------------------------------------------


def q_kpi_latest(spark, sf_dir):
    return kpis.kpi_latest(_flagged(spark, sf_dir))


def q_risk_trend(spark, sf_dir):
    return kpis.risk_trend(_flagged(spark, sf_dir))


def q_warehouse_distribution(spark, sf_dir):
    return kpis.warehouse_distribution(_flagged(spark, sf_dir))


def q_top_products_at_risk(spark, sf_dir):
    product = dims.dim_product(load_product_master(spark, sf_dir))
    return kpis.top_products_at_risk(_flagged(spark, sf_dir), K.DEFAULT_TOP_N, product=product)


def q_top_distinct_products_at_risk(spark, sf_dir):
    product = dims.dim_product(load_product_master(spark, sf_dir))
    return kpis.top_products_at_risk(_flagged(spark, sf_dir), K.DEFAULT_TOP_N, per_product=True, product=product)


def q_warehouse_risk_history(spark, sf_dir):
    return kpis.warehouse_risk_history(_flagged(spark, sf_dir))


# --- data quality -------------------------------------------------------------


def q_dq_not_null(spark, sf_dir):
    return quality.not_null(load_raw(spark, sf_dir), RAW_COLUMNS)


def q_dq_unique(spark, sf_dir):
    raw = load_raw(spark, sf_dir)
    key = F.concat(F.col("load_dt"), F.lit(K.REPORT_KEY_SEPARATOR), F.col("product_id"), F.lit(K.REPORT_KEY_SEPARATOR), F.col("warehouse_id"))
    return quality.unique(raw.select(key.alias("raw_snapshot_key")), "raw_snapshot_key")


def q_dq_relationships(spark, sf_dir):
    m = _models(spark, sf_dir)
    return quality.relationships(m.fct, "product_id", m.dim_product, "product_id")


def q_dq_accepted_values(spark, sf_dir):
    return quality.accepted_values(risk.fact(_stg(spark, sf_dir)), "stock_status", STATUSES_WITHOUT_MEDIUM)


def q_dq_grain(spark, sf_dir):
    return quality.grain(load_raw(spark, sf_dir), RAW_GRAIN)


def q_dq_non_negative(spark, sf_dir):
    shifted = _stg(spark, sf_dir).withColumn("qty_on_hand", F.col("qty_on_hand") - NEGATIVE_SHIFT)
    return quality.non_negative(risk.fact(shifted))


def q_dq_report(spark, sf_dir):
    m = build_models(pin(_silver(spark, sf_dir), "silver"), load_product_master(spark, sf_dir))
    models = m.as_dict()
    models[P.REPORT] = pin(build_report(m), P.REPORT)
    return quality.quality_report(models)


# --- sinks and published relations ----------------------------------------------


def _run_pipeline(spark, sf_dir):
    return run_pipeline(spark, load_raw(spark, sf_dir), _lake(spark, sf_dir))


def q_roundtrip_bronze(spark, sf_dir):
    _run_pipeline(spark, sf_dir)
    lake = _lake(spark, sf_dir)
    return read_layer(spark, f"{quoted(lake.bronze_db)}.{P.BRONZE}").select(*RAW_COLUMNS)


def q_roundtrip_silver(spark, sf_dir):
    _run_pipeline(spark, sf_dir)
    lake = _lake(spark, sf_dir)
    return read_layer(spark, f"{quoted(lake.silver_db)}.{P.SILVER}").select(*SILVER_COLUMNS)


def q_published_staging(spark, sf_dir):
    """Staging through its catalog view over the stored silver table."""
    _run_pipeline(spark, sf_dir)
    lake = _lake(spark, sf_dir)
    P.publish_staging(spark, lake)
    return lake.table(spark, lake.marts_db, P.STAGING)


def _publish_fact(spark, sf_dir):
    lake = _lake(spark, sf_dir)
    done = _run_pipeline(spark, sf_dir)
    fct, counts = P.publish_fact(P.publish_staging(spark, lake), lake)
    return lake, fct, done.counts | counts


def q_published_fact(spark, sf_dir):
    lake, _, _ = _publish_fact(spark, sf_dir)
    return lake.table(spark, lake.marts_db, P.FACT)


def _publish_dimensions(spark, sf_dir):
    lake, fct, _ = _publish_fact(spark, sf_dir)
    return lake, fct, P.publish_dimensions(fct, load_product_master(spark, sf_dir), lake)


def _published_dimension(name: str) -> Query:
    def query(spark, sf_dir):
        lake, _, _ = _publish_dimensions(spark, sf_dir)
        return lake.table(spark, lake.marts_db, name)

    return query


def _published_report(spark, sf_dir):
    lake, fct, published = _publish_dimensions(spark, sf_dir)
    P.publish_report(fct, published, lake)
    return lake.table(spark, lake.marts_db, P.REPORT)


def q_published_report(spark, sf_dir):
    return _published_report(spark, sf_dir)


def q_layer_row_counts(spark, sf_dir):
    """Rows of every layer, counted by the writes themselves: the raw table is scanned once."""
    return P.layer_counts(spark, _publish_fact(spark, sf_dir)[2])


QUERIES: dict[str, Query] = {
    "raw_scan": q_raw_scan,
    "read_raw_table": q_read_raw_table,
    "read_raw_csv": q_read_raw_csv,
    "read_product_master": q_read_product_master,
    "bronze_dedup": q_bronze_dedup,
    "silver_snapshot": q_silver_snapshot,
    "stg_inventory": q_stg_inventory,
    "stg_rejects": q_stg_rejects,
    "inventory_deltas": q_inventory_deltas,
    "rolling_usage": q_rolling_usage,
    "days_until_stockout": q_days_until_stockout,
    "stock_status": q_stock_status,
    "fct_inventory_risk": q_fct_inventory_risk,
    "dim_product": q_dim_product,
    "dim_warehouse": q_dim_warehouse,
    "dim_date": q_dim_date,
    "fact_enriched": q_fact_enriched,
    "latest_snapshot_flag": q_latest_snapshot_flag,
    "report_flags": q_report_flags,
    "horizon_buckets": q_horizon_buckets,
    "risk_scores": q_risk_scores,
    "rank_overall": q_rank_overall,
    "rank_in_warehouse": q_rank_in_warehouse,
    "rpt_dashboard": q_rpt_dashboard,
    "dashboard_filtered": q_dashboard_filtered,
    "kpi_latest": q_kpi_latest,
    "risk_trend": q_risk_trend,
    "warehouse_distribution": q_warehouse_distribution,
    "top_products_at_risk": q_top_products_at_risk,
    "top_distinct_products_at_risk": q_top_distinct_products_at_risk,
    "warehouse_risk_history": q_warehouse_risk_history,
    "dq_not_null": q_dq_not_null,
    "dq_unique": q_dq_unique,
    "dq_relationships": q_dq_relationships,
    "dq_accepted_values": q_dq_accepted_values,
    "dq_grain": q_dq_grain,
    "dq_non_negative": q_dq_non_negative,
    "dq_report": q_dq_report,
    "roundtrip_bronze": q_roundtrip_bronze,
    "roundtrip_silver": q_roundtrip_silver,
    "published_staging": q_published_staging,
    "published_fact": q_published_fact,
    "published_dim_product": _published_dimension("dim_product"),
    "published_dim_warehouse": _published_dimension("dim_warehouse"),
    "published_dim_date": _published_dimension("dim_date"),
    "published_report": q_published_report,
    "layer_row_counts": q_layer_row_counts,
}

assert FACT_GRAIN == KEYS
