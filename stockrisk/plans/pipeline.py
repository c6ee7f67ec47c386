"""Composition of the layers into the published jobs and models.

* :func:`run_pipeline` -- raw -> bronze (dedup) -> silver, both written as
  full-refresh tables, with layer row counts observed during the writes.
* :func:`publish_staging`, :func:`publish_fact`, :func:`publish_dimensions`,
  :func:`publish_report` -- the staging view over the stored silver table and
  the marts as tables; each step reads what the one before it published.
* :func:`run_all` -- all of it, then the quality checks on the stored tables.

Published tables are managed by the catalog, or lie under ``root``, a stable
folder of the caller's; a rerun replaces them. Only the sorted order keys of
the ranks are scratch, and go when the run ends.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stockrisk.operators.dims import dim_date, dim_product, dim_warehouse
from stockrisk.operators.layers import dedup_bronze, stage, stage_select, to_silver
from stockrisk.operators.quality import quality_report
from stockrisk.operators.reporting import latest_order, report, report_base
from stockrisk.operators.risk import fact
from stockrisk.sources.sinks import Scratch, create_view, ensure_database, pin, quoted, write_layer

# FIXED VALUES: published names.
BRONZE_DB, SILVER_DB, MARTS_DB = "inventory_bronze_db", "inventory_silver_db", "inventory_marts_db"
BRONZE, SILVER, STAGING, FACT = "inventory_bronze", "inventory_silver", "stg_inventory_silver", "fct_inventory_risk"
REPORT = "rpt_inventory_risk_dashboard"


@dataclass(frozen=True)
class Lake:
    """Where the tables are published: database names, root folder (None: managed by the catalog), format."""

    root: str | None = None
    bronze_db: str = BRONZE_DB
    silver_db: str = SILVER_DB
    marts_db: str = MARTS_DB
    fmt: str = "parquet"

    def path(self, db: str, table: str) -> str | None:
        return f"{self.root.rstrip('/')}/{db}/{table}" if self.root else None

    def write(self, df: DataFrame, db: str, table: str, partition_by: list[str] | None = None) -> tuple[DataFrame, int]:
        """Publish a table; the stored table and its row count."""
        ensure_database(df.sparkSession, db)
        done = write_layer(df, db, table, self.path(db, table), self.fmt, partition_by=partition_by)
        return df.sparkSession.table(done.table), done.rows

    def table(self, spark: SparkSession, db: str, name: str) -> DataFrame:
        return spark.table(f"{quoted(db)}.{quoted(name)}")


@dataclass
class PipelineResult:
    bronze: DataFrame
    silver: DataFrame
    counts: dict = field(default_factory=dict)


def run_pipeline(spark: SparkSession, raw: DataFrame, lake: Lake = Lake()) -> PipelineResult:
    """Bronze and silver jobs: dedup, project, overwrite; counts without extra scans."""
    raw_obs = Observation("raw_rows")
    counted_raw = raw.observe(raw_obs, F.count(F.lit(1)).alias("rows"))
    bronze, bronze_rows = lake.write(dedup_bronze(counted_raw), lake.bronze_db, BRONZE)
    silver, silver_rows = lake.write(to_silver(bronze), lake.silver_db, SILVER)
    return PipelineResult(bronze, silver, {"raw": int(raw_obs.get["rows"]), "bronze": bronze_rows, "silver": silver_rows})


def publish_staging(spark: SparkSession, lake: Lake = Lake()) -> DataFrame:
    """Staging as a view over the stored silver table."""
    ensure_database(spark, lake.marts_db)
    return create_view(spark, lake.marts_db, STAGING, stage_select(f"{quoted(lake.silver_db)}.{quoted(SILVER)}"))


def publish_fact(stg: DataFrame, lake: Lake = Lake()) -> tuple[DataFrame, dict]:
    """The fact table, and the rows of staging and fact counted by its write.

    Sorted by date inside each file, so date predicates (latest snapshot,
    dashboard ranges) skip row groups by their statistics.
    """
    stg_obs = Observation("stg_rows")
    observed = stg.observe(stg_obs, F.count(F.lit(1)).alias("rows"))
    fct, rows = lake.write(fact(observed).sortWithinPartitions("snapshot_date"), lake.marts_db, FACT)
    return fct, {"stg": int(stg_obs.get["rows"]), "fct": rows}


def publish_dimensions(fct: DataFrame, seed: DataFrame, lake: Lake = Lake()) -> dict[str, DataFrame]:
    """The product master and the three dimensions as tables.

    Warehouses and dates are the distinct values of the stored fact, which
    has exactly the staging rows: two columns of a table are read.
    """
    master, _ = lake.write(seed, lake.marts_db, "product_master")
    models = {"dim_product": dim_product(master), "dim_warehouse": dim_warehouse(fct), "dim_date": dim_date(fct)}
    return {"product_master": master} | {name: lake.write(df, lake.marts_db, name)[0] for name, df in models.items()}


def publish_report(fct: DataFrame, dims: dict[str, DataFrame], lake: Lake = Lake()) -> DataFrame:
    """The dashboard report as a table, one folder per snapshot date."""
    base = report_base(fct, dims["dim_product"], dims["dim_warehouse"], dims["dim_date"])
    with Scratch(fct.sparkSession) as pin_here:
        rpt = report(base, pin_here(latest_order(base), "latest_order"))
        return lake.write(rpt, lake.marts_db, REPORT, partition_by=["snapshot_date"])[0]


def layer_counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Observed row counts as a (layer, row_count) table."""
    return spark.createDataFrame([(layer, int(n)) for layer, n in counts.items()], "layer string, row_count bigint")


@dataclass
class Models:
    """The models of one silver relation, stored as pins: what single queries work on."""

    silver: DataFrame
    stg: DataFrame
    fct: DataFrame
    product_master: DataFrame
    dim_product: DataFrame
    dim_warehouse: DataFrame
    dim_date: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {
            SILVER: self.silver,
            STAGING: self.stg,
            FACT: self.fct,
            "product_master": self.product_master,
            "dim_product": self.dim_product,
            "dim_warehouse": self.dim_warehouse,
            "dim_date": self.dim_date,
        }


def pinned_fact(silver: DataFrame) -> DataFrame:
    return pin(fact(stage(silver)).sortWithinPartitions("snapshot_date"), FACT)


def build_models(silver: DataFrame, seed: DataFrame) -> Models:
    """Staging and the star schema of one silver relation, fact and dimensions pinned."""
    fct = pinned_fact(silver)
    product = pin(dim_product(seed), "dim_product")
    warehouse, date = pin(dim_warehouse(fct), "dim_warehouse"), pin(dim_date(fct), "dim_date")
    return Models(silver, stage(silver), fct, seed, product, warehouse, date)


def build_report_base(m: Models) -> DataFrame:
    return report_base(m.fct, m.dim_product, m.dim_warehouse, m.dim_date)


def build_report(m: Models) -> DataFrame:
    base = build_report_base(m)
    return report(base, pin(latest_order(base), "latest_order"))


@dataclass
class RunResult:
    pipeline: PipelineResult
    models: dict[str, DataFrame]
    report: DataFrame
    quality: DataFrame


def run_all(spark: SparkSession, raw: DataFrame, seed: DataFrame, lake: Lake = Lake()) -> RunResult:
    """Everything in order: bronze and silver jobs, the models, the report, the checks.

    Every step reads the tables the step before it published; the quality
    report is returned lazily and reads them too.
    """
    done = run_pipeline(spark, raw, lake)
    stg = publish_staging(spark, lake)
    fct, counts = publish_fact(stg, lake)
    dims = publish_dimensions(fct, seed, lake)
    models = {SILVER: done.silver, STAGING: stg, FACT: fct, **dims, REPORT: publish_report(fct, dims, lake)}
    done.counts.update(counts)
    return RunResult(done, models, models[REPORT], quality_report(models))
