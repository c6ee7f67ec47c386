"""Readers for the raw snapshot table, the product seed and stored layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from stockrisk.schemas import PRODUCT, RAW


def read_raw(spark: SparkSession, table: str | None = None, path: str | None = None) -> DataFrame:
    """Raw snapshots from a catalog table or from header CSV files, with the :data:`RAW` schema.

    Either way the quantity is a bigint, so the dedup orders it numerically: a
    table's columns are cast (text that is no number fails the query), CSV is
    read with the schema, no inference pass over the data.
    """
    if table is not None:
        stored = spark.table(table)
        return stored.select(*[stored[f.name].cast(f.dataType).alias(f.name) for f in RAW.fields])
    if path is None:
        raise ValueError("give a table name or a path")
    return _read_csv(spark, path, RAW)


def _read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Header CSV whose header must name the schema's columns, in order."""
    options = {"header": True, "mode": "FAILFAST", "enforceSchema": False}
    return spark.read.schema(schema).options(**options).csv(path)


def read_product_master(spark: SparkSession, path: str) -> DataFrame:
    """Product seed CSV. Line ends may be CRLF; with ``lineSep`` unset the CR is dropped."""
    return _read_csv(spark, path, PRODUCT)


def read_layer(spark: SparkSession, name: str, fmt: str | None = None) -> DataFrame:
    """A stored layer, by catalog name or (with ``fmt``) by path."""
    if fmt is None:
        return spark.table(name)
    return spark.read.format(fmt).load(name)
