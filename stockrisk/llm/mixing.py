"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document's key is an exponential variate, drawn from a hash of the row, at
the rate of its quality weight: documents with the smallest keys are a
weighted sample without replacement. A source's target is met by as many
complete epochs as fit into it, then by the documents with the smallest keys
whose prefix sum of sizes comes nearest to the rest.

The prefix sum is not a sort of a whole source in one task. Keys are mapped
to 48-bit ranks; sizes are summed in 4,096 cells of a source, the cell the
budget ends in is cut into 4,096 again, and only the documents of that last
cell (one in 16 million of the source's ranks) are sorted. All cells below the
budget's are taken whole. Rows equal in id and text are one step of the prefix
sum with a count; of the step the budget ends in, as many rows are taken as
come nearest to it. So a source misses its target by at most half a document.

What decides is one row a source: where its budget ends. Documents are
compared with it where they are read; their texts are not exchanged.

Defined cases: NULL texts have size 0; a NULL source is a source of its own,
the last; rows equal in id and text have one key, and which of them are taken
tells no rows apart; a source whose documents are all empty has target 0; very
long texts are counted whole; an empty table gives an empty mix; columns of
any name stay as they are where documents are returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockrisk.llm.common import WORD, own_columns
from stockrisk.sources.sinks import pin

WEIGHTS = (5.0, 2.0, 1.0)  # of the sources in order, repeating
MOST_EPOCHS = 3.0
CELL_BITS = 12
RANK_BITS = 48
LEAST_QUALITY = 0.05


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def default_quality(text: Column, size: Column) -> Column:
    """Weight in [0.05, 1]: how near the mean length of a word, with its space, is to that of ordinary prose."""
    mean = F.length(text) / F.greatest(size, F.lit(1))
    return F.greatest(F.lit(LEAST_QUALITY), F.coalesce(F.exp(-F.abs(mean - 6.0) / 6.0), F.lit(LEAST_QUALITY)))


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_EPOCHS
) -> DataFrame:
    """Targets of the sources of (source, size): source, source_size, target.

    The total of all sizes is shared by weight; a source whose share exceeds
    ``most`` times its size gets that, and the excess is shared again among
    the others until none is above. Works on one row per source; the window
    that numbers the sources runs over those rows alone.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    nth = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth + 1).cast("int"))
    held = pin(totals.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("cap")), "sources")
    total = held.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, capped = None, F.lit(False)
    while True:
        left, shared = held.agg(
            F.lit(float(total)) - F.coalesce(F.sum(F.when(capped, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)),
        ).first()
        now = left / shared if shared else float("inf")
        if level is not None and now <= level:
            break
        level = now
        capped = F.col("weight") * level > F.col("cap")
    share = F.when(capped, F.col("cap")).otherwise(F.col("weight") * level)
    return held.select("source", "source_size", share.alias("target"))


def _cut(cells: DataFrame, cell: str, before: str) -> DataFrame:
    """The cell each source's budget ends in: source, its number, the sizes below it."""
    upto = Window.partitionBy("source").orderBy(cell)
    return (
        cells.withColumn("_end", F.sum("_size").over(upto) + F.col(before))
        .withColumn("_begin", F.col("_end") - F.col("_size"))
        .where((F.col("_begin") <= F.col("budget")) & (F.col("budget") < F.col("_end")))
        .select("source", cell, F.col("_begin").alias("_below"), "budget")
    )


def _keys(quality: Column | None, seed: int) -> list[Column]:
    """size, row_hash and rank of a row."""
    size = word_count(F.col("text"))
    row_hash = F.xxhash64("doc_id", "text", F.lit(seed))
    given = default_quality(F.col("text"), size) if quality is None else quality
    rate = F.greatest(F.coalesce(given.cast("double"), F.lit(LEAST_QUALITY)), F.lit(1e-9))
    uniform = (F.shiftrightunsigned(row_hash, 11) + 1) / F.lit(float(2**53))
    key = -F.log(uniform) / rate
    rank = F.floor(key / (key + 1) * F.lit(float(2**RANK_BITS - 1))).cast("long")
    return [size.alias("size"), row_hash.alias("row_hash"), rank.alias("rank")]


def _cells(k: int) -> Column:
    return F.shiftright("rank", RANK_BITS - k * CELL_BITS)


def find_bounds(keyed: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_EPOCHS) -> DataFrame:
    """Where each source's budget ends: _source, source_size, target, epochs, _c2 (cell), _edge (last step), _taken and _rows of that step.

    ``keyed`` is a stored table of size, row_hash, rank and source.
    """
    targets = source_targets(keyed.select("source", "size"), weights, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = pin(
        targets.withColumn("epochs", epochs).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")), "plan"
    )

    def same(a: DataFrame, b: DataFrame) -> Column:
        return a["source"].eqNullSafe(b["source"])

    sums = keyed.groupBy("source", _cells(1).alias("_c1")).agg(F.sum("size").alias("_size"))
    budgets = plan.where("budget > 0").select("source", "budget")
    one = pin(
        _cut(sums.join(budgets, same(sums, budgets)).select(sums["*"], "budget", F.lit(0).alias("_zero")), "_c1", "_zero"), "cut"
    )
    inside = keyed.join(one, same(keyed, one) & (_cells(1) == one["_c1"])).select(keyed["*"], "_below", "budget")
    sums = inside.groupBy("source", _cells(2).alias("_c2"), "_below", "budget").agg(F.sum("size").alias("_size"))
    two = pin(_cut(sums, "_c2", "_below"), "cut")
    last = keyed.join(two, same(keyed, two) & (_cells(2) == two["_c2"])).select(keyed["*"], "_below", "budget")
    steps = last.groupBy("source", "rank", "row_hash", "_below", "budget").agg(F.max("size").alias("_each"), F.count(F.lit(1)).alias("_rows"))
    begin = F.sum(F.col("_each") * F.col("_rows")).over(Window.partitionBy("source").orderBy("rank", "row_hash")) - F.col("_each") * F.col("_rows")
    room = F.col("budget") - F.col("_below") - F.col("_begin")
    fit = F.when(F.col("_each") > 0, F.floor(room / F.col("_each") + 0.5)).when(room >= 0, F.col("_rows")).otherwise(0)
    taken = steps.withColumn("_begin", begin).withColumn("_taken", F.least(fit.cast("long"), F.col("_rows"))).where("_taken > 0")
    end = taken.groupBy("source").agg(F.max(F.struct("rank", "row_hash", "_taken", "_rows")).alias("_end"))
    return pin(
        plan.join(two.select(F.col("source").alias("_s2"), "_c2"), F.col("source").eqNullSafe(F.col("_s2")), "left")
        .join(end.select(F.col("source").alias("_s3"), "_end"), F.col("source").eqNullSafe(F.col("_s3")), "left")
        .select(
            F.col("source").alias("_source"), "source_size", "target", "epochs", "_c2",
            F.struct("_end.rank", "_end.row_hash").alias("_edge"), "_end._taken", "_end._rows",
        ),
        "bounds",
    )


def _with_copies(keyed: DataFrame, bounds: DataFrame) -> DataFrame:
    """``keyed`` (with size, row_hash, rank, source) and its source's bounds, with ``copies``: how often the mix takes the row."""
    placed = keyed.join(bounds, F.col("source").eqNullSafe(F.col("_source")))
    step = F.struct("rank", "row_hash")
    in_cell = F.col("_c2").isNotNull() & (_cells(2) == F.col("_c2"))
    at_edge = F.coalesce(in_cell & (step == F.col("_edge")) & (F.col("_taken") < F.col("_rows")), F.lit(False))
    part = F.coalesce((_cells(2) < F.col("_c2")) | (in_cell & (step <= F.col("_edge"))), F.lit(False))
    whole = placed.where(~at_edge).withColumn("copies", (F.col("epochs") + part.cast("int")).cast("int"))
    if not bounds.where("_taken < _rows").limit(1).count():
        return whole
    # Equal rows of which some are taken, one step of a source: numbered by the tasks that read them, and the tasks by their counts.
    edge = pin(placed.where(at_edge).withColumn("_pos", F.monotonically_increasing_id()), "edge")
    task = F.shiftright("_pos", 33)
    counts = edge.groupBy(F.col("_source").alias("_s"), task.alias("_task")).agg(F.count(F.lit(1)).alias("_many"))
    before = F.sum("_many").over(Window.partitionBy("_s").orderBy("_task")) - F.col("_many")
    counts = counts.select("_s", "_task", before.alias("_before"))
    nth = F.row_number().over(Window.partitionBy("_source", task).orderBy("_pos")) + F.col("_before")
    numbered = edge.join(counts, F.col("_source").eqNullSafe(F.col("_s")) & (task == F.col("_task"))).withColumn("_nth", nth)
    some = numbered.withColumn("copies", (F.col("epochs") + (F.col("_nth") <= F.col("_taken")).cast("int")).cast("int"))
    return whole.unionByName(some.select(whole.columns))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    most: float = MOST_EPOCHS,
    quality: Column | None = None,
    seed: int = 0,
) -> DataFrame:
    """One row per document: doc_id, row_hash, size, source, source_size, target, copies.

    ``copies`` says how often the mix takes the document. ``quality`` is a
    positive weight per row (NULL counts as the least); by default a figure of
    the text alone. The same rows, weights and seed give the same mix.
    """
    keyed = pin(docs.select("doc_id", "source", *_keys(quality, seed)), "keyed")
    return _with_copies(keyed, find_bounds(keyed, weights, most)).select(
        "doc_id", "row_hash", "size", "source", "source_size", "target", "copies"
    )


def mixed_documents(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    most: float = MOST_EPOCHS,
    quality: Column | None = None,
    seed: int = 0,
) -> DataFrame:
    """The mix itself: the rows of ``docs`` that are taken, each as often as it is taken."""
    keyed = pin(docs.select("source", *_keys(quality, seed)), "keyed")
    bounds = find_bounds(keyed, weights, most)
    rows = docs.select(F.struct(*own_columns(docs)).alias("row"), "source", *_keys(quality, seed))
    taken = _with_copies(rows, bounds).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def mix_report(docs: DataFrame) -> DataFrame:
    """The query's digest: doc_id, size, source_size, target, taken."""
    return mix(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken")
    )
