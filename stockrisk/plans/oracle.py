"""Independent SQL (DuckDB dialect) for every catalogued query.

Written from the rules of the models, not from the Spark code or any model's
SQL. Thresholds, labels and scores stand in two small tables that rows are
joined to by range; movements are differences floored at zero; the latest
date is a scalar subquery; ranks are taken over the latest rows alone and
joined back by key. The driver's tables ``lineitem`` and ``part`` are views.

Dialect notes: ``||`` propagates NULL like Spark's ``concat`` (DuckDB's
``concat`` skips NULLs); ``sum`` of bigint is HUGEINT in DuckDB, so sums are
cast back; ``isodow`` is Monday=1.
"""

from __future__ import annotations

from stockrisk.functions.text import EDGE_WHITESPACE
from stockrisk.operators.quality import SUITE, Check
from stockrisk.plans import catalog as C
from stockrisk.sources import fixture as X

_WHITE = " || ".join(f"chr({ord(c)})" for c in EDGE_WHITESPACE)


def _trim(c: str) -> str:
    return f"trim({c}, {_WHITE})"


CTES: dict[str, str] = {}

CTES["raw"] = f"""
SELECT
  if(k % {X.LEADING_PAD_EVERY} = 0, '  ', '')
    || if(l_orderkey % {X.NEW_CODE_EVERY} = 0, '{X.NEW_CODE_PREFIX}', '{X.CODE_PREFIX}') || printf('%06d', k)
    || if(k % {X.TRAILING_PAD_EVERY} = 0, ' ', '') AS product_id,
  printf('WH%02d', l_suppkey % {X.WAREHOUSES} + 1) AS warehouse_id,
  if(l_orderkey % {X.NULL_QTY_EVERY} = 0, NULL,
     CAST(greatest(0, l_quantity - {X.QTY_FLOOR}) + (k % {X.QTY_CLASSES}) * {X.QTY_STEP_PER_CLASS} AS BIGINT)) AS qty_on_hand,
  CASE WHEN l_orderkey % {X.BLANK_DATE_EVERY} = 0 THEN ' '
       WHEN l_orderkey % {X.NULL_DATE_EVERY} = 0 THEN NULL
       ELSE strftime(start + CAST(floor((CAST(l_shipdate AS DATE) - start) / {X.PERIOD_DAYS}.0) * {X.PERIOD_DAYS} AS INTEGER),
                     '%-m/%-d/%Y') END AS load_dt
FROM (SELECT *, l_partkey // {X.PARTS_PER_PRODUCT} AS k, DATE '{X.PERIOD_ORIGIN.isoformat()}' AS start FROM lineitem) AS l
"""

CTES["seed"] = f"""
SELECT printf('{X.CODE_PREFIX}%06d', p_partkey // {X.PARTS_PER_PRODUCT}) AS product_id,
       arg_min(p_name, p_partkey) AS product_name,
       arg_min(p_type, p_partkey) AS category
FROM part GROUP BY 1
"""

CTES["bronze"] = """
SELECT product_id, warehouse_id, max(qty_on_hand) AS qty_on_hand, load_dt
FROM raw GROUP BY product_id, warehouse_id, load_dt
"""

CTES["silver"] = "SELECT product_id, warehouse_id, load_dt, qty_on_hand FROM bronze"

CTES["complete"] = f"""
SELECT product_id, warehouse_id, {_trim('load_dt')} AS day_text, qty_on_hand FROM silver
WHERE (product_id || warehouse_id || load_dt) IS NOT NULL AND qty_on_hand IS NOT NULL
"""

CTES["stg"] = f"""
SELECT {_trim('product_id')} AS product_id, {_trim('warehouse_id')} AS warehouse_id,
       CAST(strptime(day_text, '%m/%d/%Y') AS DATE) AS snapshot_date, qty_on_hand
FROM complete WHERE length(day_text) > 0
"""

CTES["moves"] = """
SELECT *, qty_on_hand - before AS inventory_delta,
       if(before IS NULL, 0, greatest(before - qty_on_hand, 0)) AS daily_units_sold_proxy,
       if(before IS NULL, 0, greatest(qty_on_hand - before, 0)) AS received_units
FROM (SELECT *, lag(qty_on_hand) OVER (PARTITION BY warehouse_id, product_id ORDER BY snapshot_date) AS before FROM stg) AS s
"""

CTES["pace"] = """
SELECT snapshot_date, product_id, warehouse_id, qty_on_hand, before AS prev_qty_on_hand, inventory_delta,
       CAST(daily_units_sold_proxy AS BIGINT) AS daily_units_sold_proxy, CAST(received_units AS BIGINT) AS received_units,
       avg(daily_units_sold_proxy) OVER recent AS avg_daily_usage_7d,
       qty_on_hand / nullif(avg(daily_units_sold_proxy) OVER recent, 0) AS days_until_stockout
FROM moves
WINDOW recent AS (PARTITION BY warehouse_id, product_id ORDER BY snapshot_date ROWS 6 PRECEDING)
"""

# FIXED VALUES: what a horizon of days means, and what a score is called.
CTES["horizons"] = """
SELECT * FROM (VALUES
  (-1e300, 3.0, '0-3 days', 95, 'CRITICAL', 1),
  (3.0, 7.0, '4-7 days', 85, 'CRITICAL', 1),
  (7.0, 14.0, '8-14 days', 70, 'LOW', 2),
  (14.0, 30.0, '15-30 days', 40, 'MEDIUM', 3),
  (30.0, 1e300, '31+ days', 15, 'HEALTHY', 4)) AS v(over_days, upto_days, bucket, score, status, urgency)
"""
CTES["bands"] = """
SELECT * FROM (VALUES
  (90, 101, 'P1 - Immediate'), (70, 90, 'P2 - Urgent'), (40, 70, 'P3 - Watch'), (0, 40, 'P4 - Healthy')
) AS v(from_score, below_score, band)
"""

CTES["judged"] = """
SELECT p.*, coalesce(p.days_until_stockout <= 14, false) AS reorder_flag, coalesce(h.status, 'HEALTHY') AS stock_status,
       coalesce(h.urgency, 4) AS stock_status_sort_order, coalesce(h.bucket, 'No usage signal') AS stockout_horizon_bucket,
       if(p.qty_on_hand = 0, 100, coalesce(h.score, 5)) AS risk_priority_score
FROM pace AS p
LEFT JOIN horizons AS h ON p.days_until_stockout > h.over_days AND p.days_until_stockout <= h.upto_days
"""

CTES["fct"] = """
SELECT snapshot_date, product_id, warehouse_id, qty_on_hand, prev_qty_on_hand, inventory_delta, daily_units_sold_proxy,
       received_units, avg_daily_usage_7d, days_until_stockout, reorder_flag, stock_status
FROM judged
"""

CTES["dim_product"] = "SELECT product_id, product_name, category FROM seed"

CTES["dim_warehouse"] = "SELECT warehouse_id, warehouse_id AS warehouse_name FROM stg GROUP BY ALL"

CTES["dim_date"] = """
SELECT snapshot_date AS date_day, year(snapshot_date) AS year_num, quarter(snapshot_date) AS quarter_num,
       month(snapshot_date) AS month_num, monthname(snapshot_date) AS month_name, week(snapshot_date) AS week_num,
       day(snapshot_date) AS day_of_month, isodow(snapshot_date) AS day_of_week_num
FROM stg GROUP BY snapshot_date
"""

CTES["places"] = """
SELECT snapshot_date, product_id, warehouse_id, row_number() OVER urgency AS latest_rank_overall,
       row_number() OVER (PARTITION BY warehouse_id ORDER BY risk_priority_score DESC, coalesce(days_until_stockout, 999999),
                          qty_on_hand, product_id) AS latest_rank_in_warehouse
FROM judged
WHERE snapshot_date = (SELECT max(snapshot_date) FROM judged)
WINDOW urgency AS (ORDER BY risk_priority_score DESC, coalesce(days_until_stockout, 999999), qty_on_hand, product_id, warehouse_id)
"""

CTES["rpt"] = """
SELECT j.snapshot_date || '|' || product_id || '|' || warehouse_id AS warehouse_product_snapshot_key,
       j.* EXCLUDE (product_id, warehouse_id), j.product_id, j.warehouse_id,
       d.* EXCLUDE (date_day), product_name, category, warehouse_name,
       j.snapshot_date = (SELECT max(snapshot_date) FROM judged) AS is_latest_snapshot,
       coalesce(stock_status_sort_order < 3, false) AS at_risk_flag,
       coalesce(qty_on_hand = 0, false) AS zero_inventory_flag,
       coalesce(qty_on_hand = 0 AND prev_qty_on_hand > 0, false) AS stockout_event_flag,
       coalesce(received_units > 0, false) AS replenishment_event_flag,
       band AS risk_priority_band, latest_rank_overall, latest_rank_in_warehouse
FROM judged AS j
JOIN bands ON risk_priority_score >= from_score AND risk_priority_score < below_score
LEFT JOIN places USING (snapshot_date, product_id, warehouse_id)
LEFT JOIN dim_product USING (product_id)
LEFT JOIN dim_warehouse USING (warehouse_id)
LEFT JOIN dim_date AS d ON j.snapshot_date = d.date_day
"""

# Dependencies, in definition order.
_ORDER = list(CTES)
_DEPS = {
    "raw": [],
    "seed": [],
    "bronze": ["raw"],
    "silver": ["bronze"],
    "complete": ["silver"],
    "stg": ["complete"],
    "moves": ["stg"],
    "pace": ["moves"],
    "horizons": [],
    "bands": [],
    "judged": ["pace", "horizons"],
    "fct": ["judged"],
    "dim_product": ["seed"],
    "dim_warehouse": ["stg"],
    "dim_date": ["stg"],
    "places": ["judged"],
    "rpt": ["judged", "bands", "places", "dim_product", "dim_warehouse", "dim_date"],
}


def _closure(names: list[str]) -> list[str]:
    need: set[str] = set()
    stack = list(names)
    while stack:
        n = stack.pop()
        if n not in need:
            need.add(n)
            stack.extend(_DEPS[n])
    return [n for n in _ORDER if n in need]


def with_models(names: list[str], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    ctes = [(n, CTES[n]) for n in _closure(names)] + list(extra or [])
    head = ",\n".join(f"{n} AS ({sql.strip()})" for n, sql in ctes)
    return f"WITH {head}\n{body.strip()}"


_KEYS = "snapshot_date, product_id, warehouse_id"
_RISK_MEASURES = """
  count(DISTINCT CASE WHEN days_until_stockout <= 7 THEN product_id END) AS critical_skus,
  count(DISTINCT CASE WHEN days_until_stockout <= 14 THEN product_id END) AS low_stock_skus,
  count(CASE WHEN stock_status = 'CRITICAL' THEN 1 END) AS critical_positions,
  count(CASE WHEN stock_status = 'LOW' THEN 1 END) AS low_positions,
  count(CASE WHEN at_risk_flag THEN 1 END) AS at_risk_positions
"""


def _in_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _quality_sql() -> str:
    model_cte = {
        "inventory_silver": "silver",
        "stg_inventory_silver": "stg",
        "product_master": "seed",
        "dim_product": "dim_product",
        "dim_warehouse": "dim_warehouse",
        "dim_date": "dim_date",
        "fct_inventory_risk": "fct",
        "rpt_inventory_risk_dashboard": "rpt",
    }

    def head(c: Check) -> str:
        return f"SELECT '{c.check}' AS check_name, '{c.model}' AS model, '{c.column}' AS column_name, "

    parts = []
    for c in SUITE:
        t = model_cte[c.model]
        if c.check == "not_null":
            body = f"CAST(count(*) AS BIGINT) AS failures FROM {t} WHERE {c.column} IS NULL"
        elif c.check == "unique":
            body = (
                f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {c.column} FROM {t} "
                f"WHERE {c.column} IS NOT NULL GROUP BY {c.column} HAVING count(*) > 1) AS x"
            )
        elif c.check == "accepted_values":
            body = (
                f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {c.column} AS v, count(*) AS n FROM {t} "
                f"GROUP BY {c.column}) AS x WHERE v NOT IN ({_in_list(c.values)})"
            )
        elif c.check == "relationships":
            parent = model_cte[c.parent]
            body = (
                f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {c.column} AS from_field FROM {t} "
                f"WHERE {c.column} IS NOT NULL) AS child LEFT JOIN (SELECT {c.parent_column} AS to_field "
                f"FROM {parent}) AS par ON child.from_field = par.to_field WHERE par.to_field IS NULL"
            )
        elif c.check == "grain":
            body = (
                f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {_KEYS}, count(*) AS row_count FROM {t} "
                f"GROUP BY 1, 2, 3 HAVING count(*) > 1) AS x"
            )
        elif c.check == "non_negative":
            body = (
                f"CAST(count(*) AS BIGINT) AS failures FROM {t} WHERE qty_on_hand < 0 "
                "OR coalesce(daily_units_sold_proxy, 0) < 0 OR coalesce(received_units, 0) < 0 "
                "OR coalesce(avg_daily_usage_7d, 0) < 0 OR coalesce(days_until_stockout, 0) < 0"
            )
        else:
            raise ValueError(c.check)
        parts.append(head(c) + body)
    return with_models(["rpt", "fct", "seed", "silver"], "\nUNION ALL\n".join(parts))


def oracle_sql() -> dict[str, str]:
    fact_cols = (
        "product_id, warehouse_id, snapshot_date, qty_on_hand, prev_qty_on_hand, inventory_delta, "
        "daily_units_sold_proxy, received_units"
    )
    rpt_base = "SELECT * FROM rpt"
    sql = {
        "raw_scan": with_models(["raw"], "SELECT * FROM raw"),
        "read_raw_table": with_models(["raw"], "SELECT * FROM raw"),
        "read_raw_csv": with_models(["raw"], "SELECT * FROM raw"),
        "read_product_master": with_models(["seed"], "SELECT * FROM seed"),
        "bronze_dedup": with_models(["bronze"], "SELECT * FROM bronze"),
        "silver_snapshot": with_models(["silver"], "SELECT * FROM silver"),
        "stg_inventory": with_models(["stg"], "SELECT * FROM stg"),
        "stg_rejects": with_models(
            ["silver"],
            f"""
            SELECT product_id, warehouse_id, load_dt, qty_on_hand,
              CASE WHEN product_id IS NULL THEN 'product_id is null'
                   WHEN warehouse_id IS NULL THEN 'warehouse_id is null'
                   WHEN load_dt IS NULL THEN 'load_dt is null'
                   WHEN {_trim('load_dt')} = '' THEN 'load_dt is blank'
                   WHEN qty_on_hand IS NULL THEN 'qty_on_hand is null' END AS reject_reason
            FROM silver
            WHERE NOT (product_id IS NOT NULL AND warehouse_id IS NOT NULL AND load_dt IS NOT NULL
                       AND {_trim('load_dt')} <> '' AND qty_on_hand IS NOT NULL)
            """,
        ),
        "inventory_deltas": with_models(["pace"], f"SELECT {fact_cols} FROM pace"),
        "rolling_usage": with_models(["pace"], f"SELECT {fact_cols}, avg_daily_usage_7d FROM pace"),
        "days_until_stockout": with_models(
            ["pace"],
            "SELECT product_id, warehouse_id, snapshot_date, qty_on_hand, avg_daily_usage_7d, "
            "days_until_stockout FROM pace",
        ),
        "stock_status": with_models(
            ["judged"],
            "SELECT product_id, warehouse_id, snapshot_date, days_until_stockout, reorder_flag, stock_status, "
            "stock_status_sort_order FROM judged",
        ),
        "fct_inventory_risk": with_models(["fct"], "SELECT * FROM fct"),
        "dim_product": with_models(["dim_product"], "SELECT * FROM dim_product"),
        "dim_warehouse": with_models(["dim_warehouse"], "SELECT * FROM dim_warehouse"),
        "dim_date": with_models(["dim_date"], "SELECT * FROM dim_date"),
        "fact_enriched": with_models(
            ["fct", "dim_product", "dim_warehouse", "dim_date"],
            """
            SELECT f.*, p.product_name, p.category, w.warehouse_name, d.year_num, d.quarter_num, d.month_num,
                   d.month_name, d.week_num, d.day_of_month, d.day_of_week_num
            FROM fct f
            LEFT JOIN dim_product p ON f.product_id = p.product_id
            LEFT JOIN dim_warehouse w ON f.warehouse_id = w.warehouse_id
            LEFT JOIN dim_date d ON f.snapshot_date = d.date_day
            """,
        ),
        "latest_snapshot_flag": with_models(["rpt"], f"SELECT {_KEYS}, is_latest_snapshot FROM rpt"),
        "report_flags": with_models(
            ["rpt"],
            f"SELECT warehouse_product_snapshot_key, {_KEYS}, at_risk_flag, zero_inventory_flag, "
            "stockout_event_flag, replenishment_event_flag FROM rpt",
        ),
        "horizon_buckets": with_models(
            ["rpt"], f"SELECT {_KEYS}, days_until_stockout, stockout_horizon_bucket FROM rpt"
        ),
        "risk_scores": with_models(
            ["rpt"],
            f"SELECT {_KEYS}, qty_on_hand, days_until_stockout, risk_priority_score, risk_priority_band FROM rpt",
        ),
        "rank_overall": with_models(
            ["rpt"],
            f"SELECT {_KEYS}, risk_priority_score, days_until_stockout, qty_on_hand, latest_rank_overall "
            "FROM rpt WHERE is_latest_snapshot",
        ),
        "rank_in_warehouse": with_models(
            ["rpt"],
            f"SELECT {_KEYS}, risk_priority_score, latest_rank_in_warehouse FROM rpt WHERE is_latest_snapshot",
        ),
        "rpt_dashboard": with_models(["rpt"], rpt_base),
        "dashboard_filtered": with_models(
            ["rpt"],
            f"""
            SELECT * FROM rpt
            WHERE warehouse_id IN ({_in_list(C.DASHBOARD_WAREHOUSES)})
              AND category IN ({_in_list(C.DASHBOARD_CATEGORIES)})
              AND snapshot_date >= DATE '{C.DASHBOARD_FROM.isoformat()}'
              AND snapshot_date <= DATE '{C.DASHBOARD_TO.isoformat()}'
            """,
        ),
        "kpi_latest": with_models(
            ["rpt"],
            f"""
            SELECT max(snapshot_date) AS snapshot_date, {_RISK_MEASURES},
              count(DISTINCT CASE WHEN stock_status = 'CRITICAL' THEN warehouse_id END) AS warehouses_at_risk,
              round(avg(days_until_stockout), 4) AS avg_days_until_stockout
            FROM rpt WHERE is_latest_snapshot
            """,
        ),
        "risk_trend": with_models(
            ["rpt"], f"SELECT snapshot_date, {_RISK_MEASURES} FROM rpt GROUP BY snapshot_date"
        ),
        "warehouse_distribution": with_models(
            ["rpt"],
            """
            SELECT warehouse_id, stock_status, stock_status_sort_order, positions,
                   round(positions / sum(positions) OVER (PARTITION BY warehouse_id), 6) AS share_of_warehouse
            FROM (SELECT warehouse_id, stock_status, stock_status_sort_order, count(*) AS positions
                  FROM rpt WHERE is_latest_snapshot GROUP BY 1, 2, 3) AS c
            """,
        ),
        "top_products_at_risk": with_models(
            ["rpt"],
            f"""
            SELECT product_id, product_name, category, warehouse_id, qty_on_hand, avg_daily_usage_7d,
                   days_until_stockout, stock_status
            FROM rpt WHERE is_latest_snapshot AND days_until_stockout IS NOT NULL
            ORDER BY days_until_stockout, product_id, warehouse_id
            LIMIT {C.K.DEFAULT_TOP_N}
            """,
        ),
        "top_distinct_products_at_risk": with_models(
            ["rpt"],
            f"""
            SELECT product_id, product_name, category, warehouse_id, qty_on_hand, avg_daily_usage_7d,
                   days_until_stockout, stock_status
            FROM rpt WHERE is_latest_snapshot AND days_until_stockout IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY days_until_stockout, warehouse_id) = 1
            ORDER BY days_until_stockout, product_id
            LIMIT {C.K.DEFAULT_TOP_N}
            """,
        ),
        "warehouse_risk_history": with_models(
            ["rpt"],
            """
            SELECT warehouse_id, count(*) AS snapshot_days, CAST(sum(positions) AS BIGINT) AS positions,
                   CAST(sum(at_risk_positions) AS BIGINT) AS at_risk_positions,
                   round(avg(at_risk_positions / positions), 6) AS avg_daily_at_risk_share
            FROM (SELECT warehouse_id, snapshot_date, count(*) AS positions,
                         count(CASE WHEN at_risk_flag THEN 1 END) AS at_risk_positions
                  FROM rpt GROUP BY 1, 2) AS d
            GROUP BY warehouse_id
            """,
        ),
        "dq_not_null": with_models(
            ["raw"],
            """
            SELECT 'product_id' AS column_name, count(*) FILTER (WHERE product_id IS NULL) AS failures FROM raw
            UNION ALL SELECT 'warehouse_id', count(*) FILTER (WHERE warehouse_id IS NULL) FROM raw
            UNION ALL SELECT 'qty_on_hand', count(*) FILTER (WHERE qty_on_hand IS NULL) FROM raw
            UNION ALL SELECT 'load_dt', count(*) FILTER (WHERE load_dt IS NULL) FROM raw
            """,
        ),
        "dq_unique": with_models(
            ["raw"],
            """
            SELECT raw_snapshot_key, count(*) AS n_records
            FROM (SELECT load_dt || '|' || product_id || '|' || warehouse_id AS raw_snapshot_key FROM raw) AS k
            WHERE raw_snapshot_key IS NOT NULL
            GROUP BY raw_snapshot_key HAVING count(*) > 1
            """,
        ),
        "dq_relationships": with_models(
            ["fct", "dim_product"],
            """
            SELECT f.product_id, count(*) AS n_records
            FROM fct f LEFT JOIN dim_product p ON f.product_id = p.product_id
            WHERE f.product_id IS NOT NULL AND p.product_id IS NULL
            GROUP BY f.product_id
            """,
        ),
        "dq_accepted_values": with_models(
            ["fct"],
            f"""
            SELECT stock_status, count(*) AS n_records FROM fct
            WHERE stock_status IS NOT NULL AND stock_status NOT IN ({_in_list(C.STATUSES_WITHOUT_MEDIUM)})
            GROUP BY stock_status
            """,
        ),
        "dq_grain": with_models(
            ["raw"],
            """
            SELECT product_id, warehouse_id, load_dt, count(*) AS row_count FROM raw
            GROUP BY product_id, warehouse_id, load_dt HAVING count(*) > 1
            """,
        ),
        "dq_non_negative": with_models(
            ["stg"],
            """
            SELECT * FROM fct WHERE qty_on_hand < 0 OR coalesce(daily_units_sold_proxy, 0) < 0
              OR coalesce(received_units, 0) < 0 OR coalesce(avg_daily_usage_7d, 0) < 0
              OR coalesce(days_until_stockout, 0) < 0
            """,
            extra=[
                ("shifted", f"SELECT * REPLACE (qty_on_hand - {C.NEGATIVE_SHIFT} AS qty_on_hand) FROM stg"),
                ("horizons", CTES["horizons"]),
                ("moves", CTES["moves"].replace("FROM stg", "FROM shifted")),
                ("pace", CTES["pace"]),
                ("judged", CTES["judged"]),
                ("fct", CTES["fct"]),
            ],
        ),
        "dq_report": _quality_sql(),
        "roundtrip_bronze": with_models(["bronze"], "SELECT * FROM bronze"),
        "roundtrip_silver": with_models(["silver"], "SELECT * FROM silver"),
        "published_staging": with_models(["stg"], "SELECT * FROM stg"),
        "published_fact": with_models(["fct"], "SELECT * FROM fct"),
        "published_dim_product": with_models(["dim_product"], "SELECT * FROM dim_product"),
        "published_dim_warehouse": with_models(["dim_warehouse"], "SELECT * FROM dim_warehouse"),
        "published_dim_date": with_models(["dim_date"], "SELECT * FROM dim_date"),
        "published_report": with_models(["rpt"], rpt_base),
        "layer_row_counts": with_models(
            ["fct"],
            """
            SELECT 'raw' AS layer, count(*) AS row_count FROM raw
            UNION ALL SELECT 'bronze', count(*) FROM bronze
            UNION ALL SELECT 'silver', count(*) FROM silver
            UNION ALL SELECT 'stg', count(*) FROM stg
            UNION ALL SELECT 'fct', count(*) FROM fct
            """,
        ),
    }
    missing = set(C.QUERIES) - set(sql)
    assert not missing, missing
    return sql
