"""SimHash near-duplicates: fingerprints of word shingles, linked by a bit-sliced Hamming search.

Fingerprints are taken over whole texts (NULL counts as empty; a text with no
word has fingerprint zero and is linked like any other; a text with fewer
words than a shingle is one shingle). Equal fingerprints are collapsed before
the search, so a group of copies of any size costs one row. Two fingerprints
that differ in at most ``radius`` bits agree on at least ``blocks - radius``
of ``blocks`` bit blocks, so each is filed under every choice of that many
blocks and only rows of one bucket are compared; this loses no pair. The more
fingerprints there are, the more blocks, so the chosen bits grow and even
buckets stay far below a tile (``blocks_for``). A bucket
above ``tile`` rows is cut into tiles, every pair of tiles compared in a task
of its own. Buckets emit links to the smallest fingerprint of a locally
connected group, never all pairs.

Defined cases, beside those: texts of any length are hashed in pieces of
bounded size; an empty table gives no rows; columns of any name stay as they
are where rows are kept, and are not read where fingerprints are reported.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from stockrisk.llm.bitslice import near_pairs
from stockrisk.llm.common import connected_components, own_columns
from stockrisk.llm.unionfind import local_roots
from stockrisk.sources.sinks import pin

SHINGLE = 4
RADIUS = 4
SEED = 42  # FIXED VALUE of the fingerprint hash (XXH64)
MOST_BLOCKS = 9  # 126 choices of 5 blocks, 35 bits
TILE = 4096
CHUNK = 65536  # shingles hashed at once, and rows compared at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the ASCII-lower-cased words of a text; 0 for a text with no word."""
    # bytes.split() cuts at exactly \x20 and \x09-\x0D, bytes.lower() folds exactly A-Z.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    if len(words) > shingle:
        start, end = start[: 1 - shingle], end[shingle - 1 :]
    else:
        start, end = start[:1], end[-1:]
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for low in range(0, len(start), CHUNK):
        spans = zip(start[low : low + CHUNK].tolist(), end[low : low + CHUNK].tolist(), strict=True)
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(start)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    @pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return simhash(text)


def _edges(blocks: int) -> list[int]:
    return [round(i * 64 / blocks) for i in range(blocks + 1)]


def blocks_for(rows: int, radius: int = RADIUS, tile: int = TILE) -> int:
    """Fewest blocks whose narrowest choice puts ``rows`` evenly spread fingerprints in buckets of a quarter of a tile at most."""
    for blocks in range(radius + 2, MOST_BLOCKS):
        edges = _edges(blocks)
        bits = sum(sorted(b - a for a, b in zip(edges, edges[1:]))[: blocks - radius])
        if rows >> bits <= tile // 4:
            return blocks
    return max(MOST_BLOCKS, radius + 2)


def _bucket_keys(fp: Column, radius: int, blocks: int) -> Column:
    """One long for each choice of ``blocks - radius`` blocks: number of the choice, then the chosen bits."""
    edges = _edges(blocks)
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        key = F.lit(number).cast("long")
        for i in chosen:
            width = edges[i + 1] - edges[i]
            part = F.shiftrightunsigned(fp, edges[i]).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
            key = F.shiftleft(key, width).bitwiseOR(part)
        keys.append(key)
    return F.array(*keys)


def _links(frames: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Links of rows sorted by (key, tile pair); a bucket is held together, batches are cut between buckets."""

    def compare(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        run = rows.groupby(["key", "a", "b"], sort=False).ngroup().to_numpy()
        signed = rows["fp"].to_numpy(np.int64)
        left, right = [np.zeros(0, int)], [np.zeros(0, int)]
        held = 0
        for i, j in near_pairs(signed.view(np.uint64), run, radius):
            left.append(i)
            right.append(j)
            held += len(i)
            if held > CHUNK * 16:  # a dense bucket: keep one link for each row
                root = local_roots(len(signed), np.concatenate(left), np.concatenate(right))
                own = np.flatnonzero(root != np.arange(len(root)))
                left, right, held = [own], [root[own]], len(own)
        root = local_roots(len(signed), np.concatenate(left), np.concatenate(right))
        own = np.flatnonzero(root != np.arange(len(root)))
        if len(own):
            yield pd.DataFrame({"fp": signed[own], "near": signed[root[own]]})

    rest, held = [], 0
    for frame in frames:
        rest.append(frame)
        held += len(frame)
        if held < CHUNK:
            continue
        rows = pd.concat(rest, ignore_index=True)
        last = rows.iloc[-1]
        open_ = (rows["key"] == last["key"]) & (rows["a"] == last["a"]) & (rows["b"] == last["b"])
        yield from compare(rows[~open_].reset_index(drop=True))
        rest = [rows[open_].reset_index(drop=True)]
        held = len(rest[0])
    if rest:
        yield from compare(pd.concat(rest, ignore_index=True))


def link_fingerprints(fps: DataFrame, radius: int = RADIUS, blocks: int | None = None, tile: int = TILE) -> DataFrame:
    """Component of every fingerprint that has another within ``radius`` bits: (node, component).

    ``fps`` has one distinct long ``fp`` per row; ``blocks`` goes by their number if not given.
    """
    blocks = blocks or blocks_for(fps.count(), radius, tile)
    if blocks <= radius:
        raise ValueError("blocks must exceed the radius")
    filed = fps.select("fp", F.explode(_bucket_keys(F.col("fp"), radius, blocks)).alias("key"))
    sizes = filed.groupBy("key").count()
    tiled = pin(
        sizes.where(F.col("count") > tile).select("key", F.ceil(F.col("count") / tile).cast("int").alias("tiles")), "buckets"
    )
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.coalesce("tiles", F.lit(1)) - 1))
    dealt = (
        filed.join(tiled, "key", "left")
        .select("fp", "key", F.coalesce(own, F.lit(0)).alias("t"), other.alias("o"))
        .select("fp", "key", F.least("t", "o").alias("a"), F.greatest("t", "o").alias("b"))
        .repartition("key", "a", "b")
        .sortWithinPartitions("key", "a", "b", "fp")
    )
    links = dealt.mapInPandas(lambda frames: _links(frames, radius), "fp long, near long")
    return connected_components(links, "fp", "near")


def row_key() -> list[Column]:
    """128 bits of hash that name a row by its id and text."""
    return [F.xxhash64("doc_id", "text").alias("ka"), F.xxhash64("text", "doc_id", F.lit(1)).alias("kb")]


def simhash_components(
    docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, blocks: int | None = None, tile: int = TILE
) -> DataFrame:
    """Fingerprint and component of every row of ``docs`` (doc_id, text).

    Returns doc_id, ka and kb (the row's key), fp (long), group (the
    component's smallest fingerprint) and component_id (smallest doc_id
    reachable over links of at most ``radius`` bits). Repeated rows stay; a
    NULL doc_id is a component's id only if the component has no other.
    """
    fingerprints = fingerprint_column(F.col("text"), shingle).alias("fp")
    marked = pin(docs.select("doc_id", *row_key(), fingerprints), "simhash")
    fps = pin(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    near = link_fingerprints(fps.select("fp"), radius, blocks, tile)
    classed = fps.join(near, fps.fp == near.node, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("group")
    )
    smallest = classed.groupBy("group").agg(F.min("first").alias("component_id"))
    of_fp = classed.join(smallest, "group").select("fp", "group", "component_id")
    return marked.join(of_fp, "fp").select("doc_id", "ka", "kb", "fp", "group", "component_id")


def keep_one_per_component(
    docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, blocks: int | None = None, tile: int = TILE
) -> DataFrame:
    """One row of ``docs`` for each component: that with the smallest doc_id, NULL last.

    Rows equal in id and text are one document, of which one row stays; among
    texts that share the smallest id, the one with the smallest hash. All
    columns stay as they are.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "ka", "kb")
    first = simhash_components(docs, radius, shingle, blocks, tile).groupBy("group").agg(F.min(order).alias("kept"))
    chosen = first.select("kept.ka", "kept.kb")
    # Equal rows become one before they are exchanged, however many there are; then the same keys serve the join.
    one = docs.select(*row_key(), F.struct(*own_columns(docs)).alias("row")).groupBy("ka", "kb").agg(F.first("row").alias("row"))
    return one.join(chosen, ["ka", "kb"]).select("row.*")


def near_dedup(docs: DataFrame) -> DataFrame:
    """The query's digest: doc_id, fingerprint (16 hex digits), component_id."""
    found = simhash_components(docs)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
