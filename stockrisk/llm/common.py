"""Helpers shared by the corpus operators: tables, pinned results, split rule, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockrisk.sources.sinks import pin

# FIXED VALUES of the query contracts.
WORD = r"[^\x20\x09-\x0D]+"
FOLDS = 4
HELD_OUT_FOLD = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the rows no model may learn from; a null id hashes as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == HELD_OUT_FOLD


def free_name(df: DataFrame, wish: str) -> str:
    """A column name like ``wish`` that ``df`` doesn't have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def own_columns(df: DataFrame) -> list[Column]:
    """All columns of ``df`` by name, whatever characters it has."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def expand(df: DataFrame, many: str, nth: str, most: int = 1 << 16) -> DataFrame:
    """Each row of ``df`` as often as its ``many`` says, numbered from 0 in ``nth``.

    A row of more than ``most`` copies is dealt to other tasks in parts of that
    many before it is multiplied.
    """
    large = df.where(F.col(many) > most)
    parts = large.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(many) - 1) / most))))
    parts = parts.repartition(*[F.xxhash64("_part", many), F.col("_part")])
    first, last = F.col("_part") * most, F.least((F.col("_part") + 1) * most, F.col(many)) - 1
    numbered = parts.withColumn(nth, F.explode(F.sequence(first, last))).drop("_part")
    small = df.where((F.col(many) <= most) & (F.col(many) > 0))
    return small.withColumn(nth, F.explode(F.sequence(F.lit(0).cast("long"), F.col(many).cast("long") - 1))).unionByName(numbered)


def checksum(df: DataFrame) -> tuple[int, int]:
    row = df.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    ).first()
    return int(row[0]), int(row[1])


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Smallest reachable node of every node of an undirected edge list: (node, component).

    Alternating large-star and small-star rounds: every round links the
    neighbours of a node to their smallest member, first the larger ones, then
    the smaller ones, until each node points straight at the smallest node of
    its component. Each round is two grouped minima (map-side combined) and
    two joins on the node, whose hot keys adaptive execution can split; the
    edges of a round are written to the shared folder, so lineage stays short.
    Nodes without an edge to another node are not returned.
    """
    e = pin(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    seen = checksum(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        e = pin(
            large.join(low, "u")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .union(low.select("u", "m"))
            .where("u <> v")
            .distinct(),
            "edges",
        )
        now = checksum(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
