"""Shards of near-equal bytes by sampled splitters. DataFrame functions only.

Rows are ordered by a hash of their text, so equal texts lie together. A
sample, drawn with a chance in proportion to size, gives quantile boundaries;
rows are range-partitioned on them, ranges that turn out overfull are
subdivided, by bytes or by rows (a range's other texts by a second hash, one
very common text by the hash of its ids), and exact byte and row sums of the ranges place every
row on one line of bytes, cut into equal shards. Equal texts share a shard
unless together they are over an eighth of one; those are spread by row.

The sample, the boundaries and the table of ranges are bounded by
``ranges``, which grows with the rows so that a range stays a task's work.

Rows equal in id and text are one row with a count until their shards and
slots are worked out from it; only then do they become rows again.

Defined cases: a NULL text has size 8 and counts as the empty text; repeated
rows each get a slot; texts of any length are hashed and measured whole, and
one longer than a shard fills it alone; with fewer rows than shards some
shards stay empty; an empty table gives no rows; other columns are not read,
so their names can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockrisk.llm.common import expand
from stockrisk.sources.sinks import pin

SHARDS = 24
ROW_BYTES = 8  # FIXED VALUE: added to the bytes of a text
RANGES_PER_SHARD = 32
ROWS_PER_RANGE = 1 << 20
SAMPLES_PER_RANGE = 32
PREFIX_BITS = 12
OVERFULL = 1.25  # times the mean range
WHOLE_SHARE = 1 / 8  # of a shard: equal texts up to this size are kept together


def _unit(hashed: Column) -> Column:
    """A hash as a number in [0, 1), in the order of its upper bits."""
    return F.shiftrightunsigned(hashed, 11) / F.lit(float(2**53))


def _prefix() -> Column:
    return F.shiftright("h", 64 - PREFIX_BITS).cast("int")


def boundaries(keyed: DataFrame, ranges: int, total: int) -> DataFrame:
    """Quantile boundaries of h by size, from a size-weighted sample: distinct values ``bound``.

    The sample is summed by h, then by prefix of h; running sums are taken
    over the prefixes (a fixed number of rows) and inside each of them.
    """
    whole = F.col("size") * F.col("n")  # the bytes of equal rows, drawn as one
    expected = whole * F.lit(ranges * SAMPLES_PER_RANGE / max(total, 1))
    drawn = keyed.where(_unit(F.xxhash64("dh", "h", F.lit(1))) < expected)
    weight = F.greatest(expected, F.lit(1.0))  # what is surely drawn stands for its own size
    values = pin(drawn.groupBy("h", _prefix().alias("prefix")).agg(F.sum(weight).alias("w")), "sample")
    sums = values.groupBy("prefix").agg(F.sum("w").alias("sum"))
    cells = sums.select(
        F.col("prefix").alias("_p"), (F.sum("sum").over(Window.orderBy("prefix")) - F.col("sum")).alias("below"), F.sum("sum").over(Window.partitionBy()).alias("all")
    )
    inside = Window.partitionBy("prefix").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("below") + F.sum("w").over(inside)
    placed = values.join(cells, F.col("prefix") == F.col("_p")).select(F.col("h").alias("bound"), "w", upto.alias("upto"), (ranges / F.col("all")).alias("scale"))
    # A value is a boundary where a quantile falls into its share of the line: a very common one always is.
    return placed.where(F.floor((F.col("upto") - F.col("w")) * F.col("scale")) < F.floor(F.col("upto") * F.col("scale"))).select("bound")


def _lookup(bounds: DataFrame) -> DataFrame:
    """One row for each prefix of h: how many boundaries lie in lower prefixes, and those inside it."""
    half = 1 << (PREFIX_BITS - 1)
    prefixes = bounds.sparkSession.range(-half, half).select(F.col("id").cast("int").alias("prefix"))
    inside = bounds.groupBy(F.shiftright("bound", 64 - PREFIX_BITS).cast("int").alias("_p")).agg(
        F.sort_array(F.collect_list("bound")).alias("bounds")
    )
    lower = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    some = F.coalesce("bounds", F.array().cast("array<bigint>"))
    return prefixes.join(inside, F.col("prefix") == F.col("_p"), "left").select(
        "prefix", some.alias("bounds"), F.coalesce(F.sum(F.size(some)).over(lower), F.lit(0)).alias("base")
    )


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, ranges: int | None = None, most_rows: int = ROWS_PER_RANGE) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (0, 1, ... within the shard) of every row of ``docs``."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
        F.xxhash64("doc_id", F.lit(2)).alias("dh"),
    )
    # Rows equal in id and text are one row with a count from here to the end.
    keyed = pin(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")), "keyed")
    count, total = keyed.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("size") * F.col("n")), F.lit(0))).first()
    ranges = ranges or max(shards * RANGES_PER_SHARD, -(-count // most_rows))
    # A text of many rows is a boundary, however few bytes it has: at most rows / most_rows of them.
    many = keyed.groupBy(F.col("h").alias("bound")).agg(F.count(F.lit(1)).alias("ids")).where(F.col("ids") > most_rows).select("bound")
    lookup = pin(_lookup(boundaries(keyed, ranges, total).union(many).distinct()), "splitters")
    # 2**PREFIX_BITS rows that hold at most ``ranges + rows / most_rows`` boundaries between them; the planner knows their size.
    found = keyed.withColumn("prefix", _prefix()).join(lookup, "prefix")
    ranged = found.select(
        *keyed.columns,
        (F.col("base") + F.size(F.filter("bounds", lambda b: b < F.col("h")))).alias("range"),
        F.array_contains("bounds", F.col("h")).alias("at_bound"),
    )
    mean = max(total, 1) / ranges
    # Copies of one text at a boundary are parted only where they are too much for one shard.
    most = F.when(F.col("at_bound"), max(total, 1) / shards * WHOLE_SHARE).otherwise(OVERFULL * mean)
    over = F.col("bytes") > most
    pieces = F.greatest(F.when(over, F.least(F.ceil(F.col("bytes") / mean), F.col("rows"))).otherwise(1), F.ceil(F.col("rows") / most_rows))
    bytes_ = F.sum(F.col("size") * F.col("n")).alias("bytes")
    parts = pin(
        ranged.groupBy("range", "at_bound").agg(bytes_, F.count(F.lit(1)).alias("rows")).select(
            F.col("range").alias("_r"), F.col("at_bound").alias("_a"), pieces.cast("int").alias("pieces"), over.alias("over")
        ),
        "ranges",
    )
    # Rows at a boundary value are copies of one text: only their ids can part them.
    spread = _unit(F.when(F.col("at_bound"), F.col("dh")).otherwise(F.xxhash64("h")))
    celled = ranged.join(parts, (F.col("range") == F.col("_r")) & (F.col("at_bound") == F.col("_a"))).select(
        *ranged.columns,
        F.floor(spread * F.col("pieces")).cast("int").alias("piece"),
        (F.col("at_bound") & F.col("over")).alias("split"),
    )
    cell = ["range", "at_bound", "piece"]
    line = Window.orderBy(*cell).rowsBetween(Window.unboundedPreceding, -1)  # one row a cell, a fixed number to each range
    cells = pin(
        celled.groupBy(*cell)
        .agg(bytes_, F.sum("n").alias("rows"))
        .select(
            *[F.col(c).alias(f"_{c}") for c in cell],
            F.coalesce(F.sum("bytes").over(line), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(line), F.lit(0)).alias("rows_before"),
            F.sum("bytes").over(Window.partitionBy("range", "at_bound")).alias("group_bytes"),
        ).withColumn("group_before", F.min("bytes_before").over(Window.partitionBy("_range", "_at_bound"))),
        "cells",
    )
    inside = Window.partitionBy(*cell).orderBy("h", "dh", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    copies = Window.partitionBy(*cell, "h")  # never more distinct rows than ``most_rows``
    whole = F.col("size") * F.col("n")
    ordered = (
        celled.join(cells, (F.col("range") == F.col("_range")) & (F.col("at_bound") == F.col("_at_bound")) & (F.col("piece") == F.col("_piece")))
        .withColumn("begin", F.sum(whole).over(inside) - whole + F.col("bytes_before"))
        .withColumn("pos", F.sum("n").over(inside) - F.col("n") + F.col("rows_before"))
    )
    group = (F.min("begin").over(copies) + F.max(F.col("begin") + whole).over(copies)) / 2
    # Rows at a boundary are one text: its middle needs only the sums of its cells.
    text_middle = F.col("group_before") + F.col("group_bytes") / 2
    middle = F.when(F.col("at_bound"), text_middle).otherwise(group)
    placed = pin(ordered.select("doc_id", "size", "text_crc32", "n", "begin", "pos", "split", middle.alias("middle")), "placed")

    def shard_at(place: Column) -> Column:
        return F.least(F.lit(shards - 1), F.floor(place * shards / max(total, 1))).cast("int")

    each = expand(placed, "n", "nth")
    own = F.col("begin") + (F.col("nth") + 0.5) * F.col("size")
    spaced = each.select(
        "doc_id", "size", "text_crc32", shard_at(F.when(F.col("split"), own).otherwise(F.col("middle"))).alias("shard"), (F.col("pos") + F.col("nth")).alias("pos")
    )
    starts = spaced.groupBy(F.col("shard").alias("_shard")).agg(F.min("pos").alias("first"))
    # One row per shard.
    return spaced.join(F.broadcast(starts), F.col("shard") == F.col("_shard")).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("pos") - F.col("first")).cast("long").alias("slot")
    )


def shard_report(docs: DataFrame) -> DataFrame:
    """The query's digest: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    return shard_by_bytes(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
