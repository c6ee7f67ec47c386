"""Row numbers over a total order without a single-task window.

``row_number() over (partition by g order by k)`` plans one task per group,
and with no partition at all, one task for everything. Here the rows are
range-partitioned on k by Spark's distributed sort, and each row's rank is

    rows in earlier partitions + position in its own partition + 1

The same sort ranks the rows within groups, since the order inside a group is
the overall order restricted to it: the position is then counted within
(partition, group), which one range partition bounds, and the offset is the
group's rows in earlier partitions. A hot group is spread over many range
partitions.

Two steps, neither an action. The caller stores what :func:`range_sorted`
gives before :func:`ranks` reads it, because the range bounds come from
sampling and a recomputation could cut the partitions elsewhere. The offset
tables have one row per range partition, and per range partition and group;
whether they are broadcast is left to their size at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART, POSITION = "_part", "_pos"


def range_sorted(df: DataFrame, order_by: list[Column]) -> DataFrame:
    """``df`` in global order, with the range partition of each row and its place in the order of all rows."""
    return (
        df.orderBy(*order_by)
        .withColumn(PART, F.spark_partition_id())
        .withColumn(POSITION, F.monotonically_increasing_id())
    )


def ranks(stored: DataFrame, name: str, group: str | None = None, name_in_group: str | None = None) -> DataFrame:
    """Add the 1-based row number ``name``, and ``name_in_group`` within ``group``, to stored sorted rows."""
    cols = [c for c in stored.columns if c not in (PART, POSITION)]
    runs = stored.groupBy(PART).agg(F.count(F.lit(1)).alias("_n"), F.min(POSITION).alias("_first"))
    # No partition key: this window runs in one task -- over one row per range partition.
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(F.col(PART).alias("_o_part"), "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    out = stored.join(offsets, F.col(PART) == F.col("_o_part")).withColumn(
        name, (F.col("_offset") + F.col(POSITION) - F.col("_first") + 1).cast("bigint")
    )
    if not group:
        return out.select(*cols, name)
    earlier = Window.partitionBy("_g").orderBy("_g_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        stored.groupBy(F.col(PART).alias("_g_part"), F.col(group).alias("_g"))
        .agg(F.count(F.lit(1)).alias("_g_n"))
        .select("_g_part", "_g", F.coalesce(F.sum("_g_n").over(earlier), F.lit(0)).alias("_g_offset"))
    )
    in_run = F.row_number().over(Window.partitionBy(PART, group).orderBy(POSITION))
    return (
        out.withColumn("_g_pos", in_run)
        .join(counts, (F.col(PART) == F.col("_g_part")) & F.col(group).eqNullSafe(F.col("_g")))
        .select(*cols, name, (F.col("_g_offset") + F.col("_g_pos")).cast("bigint").alias(name_in_group))
    )
