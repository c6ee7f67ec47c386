"""Order MinHash fingerprints: MinHash that also sees the order of what it selects.

The k-mers of a text are its runs of ``k`` words, or of ``k`` code points where
it has few words (see ``_units``), numbered by occurrence, so a repeated run is
as many elements. Each of ``slots`` hash functions selects
the ``picks`` smallest elements, puts them back into text order, and hashes
the tuple into one slot: two texts share a slot only if they share elements in
the same order, and the share of equal slots bounds their edit distance.

Defined cases: NULL counts as the empty text; a text with fewer words than a
k-mer is one element, a text with no word has the fingerprint of no element;
a text with fewer elements than ``picks`` selects all of them; repeated rows
are compared once and get as many rows, all but one followed by themselves;
very long texts are hashed whole, their ranks in pieces of bounded size; an
empty table gives no rows; other columns are not read, so their names can't
clash.

Neighbours (the next document by descending id) come from one range-sorted
pass over the texts: documents are compared where they lie, and only the
documents at the edges of the sorted partitions are joined once more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockrisk.llm.common import expand
from stockrisk.sources.sinks import pin

K = 2
FEW_WORDS = 16
LONG_UNITS = 24
LEAST_POINTS = 32
SLOTS = 64
PICKS = 2
HELD_KEYS = 200_000  # distinct rows a task remembers
NO_ID = "\x00"  # stands for a NULL id on the way through pandas
_RANKS = 1 << 17  # ranks worked out at once

_rng = np.random.default_rng(20240)
_MULTIPLY = _rng.integers(0, 2**63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, 1024, dtype=np.uint64)
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64)
_PLACE = _rng.integers(0, 2**63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = np.isin(np.arange(256), list(b" \t\n\v\f\r"))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: bytes) -> np.ndarray:
    """A hash of each word (run of bytes that are no ASCII white space), in order."""
    codes = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(codes) + 2, dtype=bool)
    inside[1:-1] = ~_BLANK[codes]
    turns = np.flatnonzero(inside[1:] != inside[:-1])  # where words begin and end, by turns
    if not len(turns):
        return np.zeros(0, dtype=np.uint64)
    codes = codes[inside[1:-1]]
    size = turns[1::2] - turns[::2]
    first = np.cumsum(size) - size
    place = np.arange(len(codes)) - np.repeat(first, size)
    summed = np.add.reduceat(_BYTE[codes] * _PLACE[place & (len(_PLACE) - 1)], first)
    return _mix(summed + size.astype(np.uint64))


def _units(text: str) -> np.ndarray:
    """Hashes of what a text's k-mers are made of: its words, or its code points where it has few words.

    A rule on the text alone: words of more than ``LONG_UNITS`` code points on
    average are no words as blanks part them (scripts without blanks, one long
    token), and a text of fewer than ``FEW_WORDS`` words has too few elements.
    Texts of fewer than ``LEAST_POINTS`` code points are words in any case.
    """
    words = _word_hashes(text.encode("utf-8", "surrogatepass"))
    if not len(words) or len(text) < LEAST_POINTS or (len(words) >= FEW_WORDS and len(text) <= LONG_UNITS * len(words)):
        return words
    points = np.frombuffer(" ".join(text.split()).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return _mix(points + np.uint64(0x51ED270B))


def elements(text: str, k: int = K) -> np.ndarray:
    """Hashes of a text's occurrence-numbered k-mers, in text order."""
    hashed = _units(text)
    if not len(hashed):
        return hashed
    n = max(1, len(hashed) - k + 1)
    kmers = np.zeros(n, dtype=np.uint64)
    for i in range(min(k, len(hashed))):
        kmers = _mix(kmers * np.uint64(3) + hashed[i : i + n])
    order = np.argsort(kmers, kind="stable")
    ranked = kmers[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    number = np.arange(n) - np.repeat(first, np.diff(np.r_[first, n]))
    occurrence = np.empty(n, dtype=np.uint64)
    occurrence[order] = number
    return _mix(kmers + occurrence * np.uint64(0x9E3779B97F4A7C15))


def fingerprint(text: str | None, k: int = K, slots: int = SLOTS, picks: int = PICKS) -> np.ndarray:
    """One 16-bit value per slot."""
    own = elements(text or "", k)
    out = np.zeros(slots, dtype=np.uint64)
    if not len(own):
        return out.astype(np.uint16)
    take = min(picks, len(own))
    chosen = np.empty((slots, take), dtype=np.int64)
    together = max(1, _RANKS // len(own))  # slots whose ranks are worked out in one go
    for low in range(0, slots, together):
        multiply = _MULTIPLY[low : min(low + together, slots), None]
        rank = own[None, :] * multiply
        rank += _ADD[low : low + len(multiply), None]
        rank ^= rank >> np.uint64(32)  # the low bits of a product are weak, its order must not lean on them
        rank *= multiply
        each = np.arange(len(multiply))
        for p in range(take):
            at = rank.argmin(axis=1)
            chosen[low : low + len(multiply), p] = at
            rank[each, at] = np.uint64(2**64 - 1)
    chosen.sort(axis=1)
    for p in range(take):
        out = _mix(out * np.uint64(5) + own[chosen[:, p]] + np.uint64(p + 1))
    return (out >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal slots."""
    return float(np.mean(a == b))


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the first as many code points of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows a task reads (doc_id, ka, kb, text), equal ones once: ``many`` is 1, and what more there are is told by rows without text."""
    more: dict[tuple, int] = {}

    def told(schema: pa.Schema) -> pa.RecordBatch:
        rest = [(k, n) for k, n in more.items() if n]
        columns = [pa.array([k[i] for k, _ in rest], schema.field(i).type) for i in range(3)]
        return pa.RecordBatch.from_arrays([*columns, pa.nulls(len(rest), pa.string()), pa.array([n for _, n in rest], pa.int64())], _COLLAPSED)

    schema = None
    for batch in batches:
        schema = batch.schema
        fresh = []
        for key in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            fresh.append(key not in more)
            more[key] = more[key] + 1 if key in more else 0
        kept = batch.filter(pa.array(fresh, pa.bool_()))
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(np.ones(kept.num_rows, np.int64))], _COLLAPSED)
        if len(more) > HELD_KEYS:
            yield told(schema)
            more.clear()
    if schema is not None:
        yield told(schema)


_COLLAPSED = ["doc_id", "ka", "kb", "text", "many"]

# place: 0 complete (``many`` rows of them), 1 the last of its partition (still to be compared), 2 only a copy of the first
_RUN = (
    "place int, doc_id string, many long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double, text string"
)
_COLUMNS = [c.strip().split(" ")[0] for c in _RUN.split(",")]


def _row(doc_id, many: int, text: str, own: np.ndarray, following: str, next_own: np.ndarray) -> tuple:
    changed = edited(text, following)
    other = own if changed == text else fingerprint(changed)
    return (
        0, doc_id, many, len(text), _sha(changed), own.tobytes(), other.tobytes(), likeness(own, other), likeness(own, next_own), None,
    )


def _compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of one sorted partition: each compared with the one after it, equal rows at once; the edges carry their texts on."""
    held, key, out = None, None, []  # the last distinct row: doc_id, text, fingerprint; how many of it
    many = 0

    def repeats() -> list[tuple]:
        # All but the last of equal rows are followed by themselves.
        return [_row(held[0], many - 1, held[1], held[2], held[1], held[2])] if many > 1 else []

    for frame in frames:
        for doc_id, ka, kb, text, n in zip(*(frame[c] for c in _COLLAPSED), strict=True):
            if (doc_id, ka, kb) == key:
                many += int(n)
                continue
            text = text or ""
            own = fingerprint(text)
            if held is None:
                out.append((2, doc_id, 1, *[None] * 6, text))
            else:
                out += repeats()
                out.append(_row(held[0], 1, held[1], held[2], text, own))
            held, key, many = (doc_id, text, own), (doc_id, ka, kb), int(n)
            if len(out) >= 256:
                yield pd.DataFrame(out, columns=_COLUMNS)
                out = []
    if held is not None:
        yield pd.DataFrame([*out, *repeats(), (1, held[0], 1, *[None] * 6, held[1])], columns=_COLUMNS)


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` against its edited text and the next document, ids descending.

    Rows of one id follow each other in the order of their text's hash; a
    NULL id comes last; after the last comes the first. Returns doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint (binary, 16 bits a
    slot), near_edited, near_next.
    """
    kind = docs.schema["doc_id"].dataType
    read = docs.select("doc_id", F.xxhash64("text").alias("ka"), F.xxhash64("text", F.lit(1)).alias("kb"), F.coalesce("text", F.lit("")).alias("text"))
    once = read.mapInArrow(_collapse, f"doc_id {kind.simpleString()}, ka long, kb long, text string, many long")
    order = [F.col("doc_id").desc_nulls_last(), F.col("ka"), F.col("kb")]
    run = pin(
        once.repartitionByRange(*order)
        .sortWithinPartitions(*order, F.col("text").isNull())
        # As text: pandas has no long column with NULLs.
        .select(F.coalesce(F.col("doc_id").cast("string"), F.lit(NO_ID)).alias("doc_id"), "ka", "kb", "text", "many")
        .mapInPandas(_compare, _RUN)
        .withColumn("partition", F.spark_partition_id()),
        "order_minhash",
    )
    # The edges: two rows for each sorted partition, whose order is that of the ids.
    heads = run.where("place = 2").select(F.col("partition").alias("head"), F.col("text").alias("next_text"))
    tails = run.where("place = 1").select("partition", "doc_id", "text")
    following = F.coalesce(F.lead("partition").over(Window.orderBy("partition")), F.min("partition").over(Window.partitionBy()))
    linked = run.where("place = 2").select("partition", following.alias("head"))
    open_ = tails.join(linked, "partition").join(heads, "head").select("doc_id", "text", "next_text")

    def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc_id, text, following in zip(frame["doc_id"], frame["text"], frame["next_text"], strict=True):
                out.append(_row(doc_id, 1, text, fingerprint(text), following, fingerprint(following)))
            yield pd.DataFrame(out, columns=_COLUMNS)

    done = run.where("place = 0").drop("partition").unionByName(open_.mapInPandas(finish, _RUN)).drop("place", "text")
    named = F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).cast(kind)
    return expand(done.withColumn("doc_id", named), "many", "nth").drop("many", "nth")


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """The query's digest: fingerprints as hex text."""
    found = compare_neighbours(docs)
    hexed = {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    return found.withColumns(hexed).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )
