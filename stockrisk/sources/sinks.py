"""Sinks: databases, full-refresh tables, views, pins.

Every write is a full refresh (overwrite), so a retried job converges to the
same table. Published tables lie where the catalog or the caller says; only
tables written for lineage cuts go to the shared checkpoint folder. Neither is
a machine-local path, so losing an executor loses nothing but the tasks it was
running.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stockrisk.session import remove_path, shared_path


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    sql = f"CREATE DATABASE IF NOT EXISTS {quoted(name)}"
    if location:
        escaped = location.replace("\\", "\\\\").replace("'", "\\'")
        sql += f" LOCATION '{escaped}'"
    spark.sql(sql)


@dataclass
class WriteResult:
    table: str
    rows: int
    metrics: dict = field(default_factory=dict)


def write_layer(
    df: DataFrame,
    db: str,
    table: str,
    path: str | None = None,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> WriteResult:
    """Overwrite ``db.table`` and count the rows written.

    The table lies at ``path``, a stable place of the caller's, or is managed
    by the catalog; a rerun replaces it. With ``partition_by`` there is one
    folder per value: rows are first rebalanced on those columns, so each
    value is written by few tasks, while adaptive execution still splits a
    value with an outsized share of the rows over several writers.

    The row count is an :class:`Observation` collected by the write job
    itself, so counting costs no second pass over the input.
    """
    obs = Observation(f"rows_{db}_{table}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    name = f"{quoted(db)}.{quoted(table)}"
    writer = (observed.hint("rebalance", *partition_by) if partition_by else observed).write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    metrics = obs.get
    return WriteResult(name, int(metrics["rows"]), metrics)


# The folder of the run that owns the pins, where one does.
_OWNER: ContextVar[str | None] = ContextVar("owner", default=None)


def _write_in(df: DataFrame, folder: str | None, name: str, fmt: str) -> DataFrame:
    spark = df.sparkSession
    path = f"{folder}/{name}-{uuid.uuid4().hex}" if folder else shared_path(spark, name)
    df.write.format(fmt).mode("overwrite").save(path)
    # The schema is known: reading it back needs no footer inference.
    return spark.read.format(fmt).schema(df.schema).load(path)


def pin(df: DataFrame, name: str = "pinned", fmt: str = "parquet") -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage: later plans scan a columnar table (with column pruning
    and pushed filters) instead of recomputing windows and shuffles.
    """
    return _write_in(df, _OWNER.get(), name, fmt)


@contextmanager
def owned_pins(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """Pins written inside are removed at the end, by failure too.

    Gives a pin that writes where pins went before, for what must outlive
    them: ``with owned_pins(spark) as keep: result = keep(work(), "result")``.
    """
    outer, own = _OWNER.get(), shared_path(spark, "run")
    token = _OWNER.set(own)
    try:
        yield lambda df, name="kept", fmt="parquet": _write_in(df, outer, name, fmt)
    finally:
        _OWNER.reset(token)
        remove_path(spark, own)


def create_view(spark: SparkSession, db: str, view: str, select: str) -> DataFrame:
    """Publish a model as a catalog view over stored tables."""
    name = f"{quoted(db)}.{quoted(view)}"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select}")
    return spark.table(name)


class Scratch:
    """Pins that live as long as a run: ``with Scratch(spark) as pin_here: ...``"""

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, shared_path(spark, "run")

    def __enter__(self):
        return self.pin

    def __exit__(self, *exc) -> None:
        remove_path(self.spark, self.root)

    def pin(self, df: DataFrame, name: str = "pinned") -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
