"""Cross-tokenizer alignment: the byte ranges of two tokenizers' tokens, merged in lockstep.

Tokenizer A is a byte-level BPE (``tokenizers``), B a SentencePiece model that
puts a space before the text. Both read the same bytes: a space and the text.
One state vector holds a pair of pointers for each lane of a batch, an A token
and a B token that overlap. Every step emits one link a lane, and a cut where
both tokens end together; the pointer whose token ends first moves on, both
after a cut. Lanes that have reached their end are compacted away. A document
is one lane, or several where it is long: it is parted after every ``LANE``
A tokens where a B token ends too, so a batch takes as many steps as its
longest lane has links, not as its longest document.

An id pair's count is the number of documents that hold it linked. Counts are
grouped sums over all documents' distinct pairs, joined back to them by pair;
pairs that many documents hold are split by the skew join.

Both libraries segment each distinct chunk (see ``ChunkIds``) once per task;
ids are joined by position.

Defined cases: a text that is NULL or empty, or that one of the tokenizers
doesn't give back byte by byte, has no tokens: zeros, and an empty
``groups_sha256``; repeated rows each get a row and each count as a document;
a NULL id is kept; very long texts are batches of their own, worked out in
lanes; an empty table gives no rows; other columns of ``docs`` are not read,
so their names can't clash.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stockrisk.llm.sentencepieces import MARK
from stockrisk.sources.sinks import pin

LANE = 512  # A tokens after which a document is parted at the next candidate
TABLE_CHUNKS = 400_000  # distinct chunks a task's table holds
BATCH_CHARS = 1 << 20  # code points aligned at once; a longer text is a batch of its own
_CUT = re.compile(r"(?<=\S) (?=\S)")

_OUT = pa.schema(
    [
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("n_links", pa.int64()),
        ("groups_sha256", pa.string()),
        ("groups", pa.string()),
        ("pairs", pa.list_(pa.int64())),
        ("times", pa.list_(pa.int32())),
    ]
)


def byte_level_bytes(tokenizer: Tokenizer) -> list[bytes]:
    """Bytes of every id: byte-level entries write printable bytes as themselves, the others as 256, 257, ..."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    byte_of = {chr(b): b for b in shown}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocabulary.values()) + 1)
    for entry, number in vocabulary.items():
        out[number] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
    return out


def piece_bytes(processor: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """Bytes of every id: a marker is a space, a byte piece its byte."""
    out = []
    for i in range(processor.vocab_size()):
        piece = processor.id_to_piece(i)
        byte = re.fullmatch(r"<0x([0-9A-Fa-f]{2})>", piece) if processor.is_byte(i) else None
        out.append(bytes([int(byte[1], 16)]) if byte else piece.replace(MARK, " ").encode())
    return out


def merge_lanes(a_end: np.ndarray, b_end: np.ndarray, a: np.ndarray, b: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (A token, B token) of all lanes in their order, and which of them are cuts.

    ``a_end`` and ``b_end`` hold the byte offset each token ends at, on one
    line; lane i begins with the tokens a[i] and b[i], which start at one
    offset, and ends before A token stop[i], where a B token begins too.
    """
    lane = np.arange(len(a))
    lanes, links_a, links_b, cuts = [], [], [], []
    while len(lane):
        ends_a, ends_b = a_end[a], b_end[b]
        lanes.append(lane)
        links_a.append(a)
        links_b.append(b)
        cuts.append(ends_a == ends_b)
        a = a + (ends_a <= ends_b)
        b = b + (ends_b <= ends_a)
        open_ = a < stop
        if not open_.all():
            lane, a, b, stop = lane[open_], a[open_], b[open_], stop[open_]
    if not lanes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    step = np.repeat(np.arange(len(lanes)), [len(x) for x in lanes])
    every = np.concatenate(lanes)
    steps = np.bincount(every)
    place = (np.cumsum(steps) - steps)[every] + step
    out_a, out_b, out_cut = np.empty(len(place), np.int64), np.empty(len(place), np.int64), np.empty(len(place), bool)
    out_a[place], out_b[place], out_cut[place] = np.concatenate(links_a), np.concatenate(links_b), np.concatenate(cuts)
    return out_a, out_b, out_cut


def lane_starts(a_end: np.ndarray, b_end: np.ndarray, a_first: np.ndarray, b_first: np.ndarray, lane: int) -> tuple[np.ndarray, np.ndarray]:
    """A and B tokens the lanes begin with: every document's first, and places both have in common about every ``lane`` A tokens."""
    sizes = np.diff(np.append(a_first, len(a_end)))
    more = np.maximum(sizes - 1, 0) // lane
    nth = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
    tried = np.repeat(a_first, more) + nth * lane
    after = np.searchsorted(b_end, a_end[tried - 1])
    common = b_end[np.minimum(after, len(b_end) - 1)] == a_end[tried - 1] if len(tried) else np.zeros(0, bool)
    a, b = np.concatenate([a_first, tried[common]]), np.concatenate([b_first, after[common] + 1])
    order = np.argsort(a)
    return a[order], b[order]


class ChunkIds:
    """Ids of chunks by both tokenizers, each chunk segmented once.

    A chunk ends where one space stands between two characters that are no
    white space: both tokenizers begin a token with that space, and neither
    looks beyond it. The space is left out of the key; both put it before
    whatever they read.
    """

    def __init__(self, tokenizer: Tokenizer, processor: sentencepiece.SentencePieceProcessor, chunks: int):
        crossing = re.compile(f"[^{MARK}]{MARK}")
        if any(crossing.search(processor.id_to_piece(i)) for i in range(processor.vocab_size())):
            raise ValueError("a piece of this model crosses a space: its chunks can't be encoded one by one")
        self.tokenizer, self.processor, self.most = tokenizer, processor, chunks
        self.a_bytes, self.b_bytes = byte_level_bytes(tokenizer), piece_bytes(processor)
        self.lengths = [np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes)]
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.whole = np.zeros(0, bool)  # whether both tokenizers give the chunk back byte by byte
        self.pools = [np.zeros(0, np.int64), np.zeros(0, np.int64)]  # ids of all chunks by A and by B
        self.starts = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.sizes = [np.zeros(0, np.int64), np.zeros(0, np.int64)]

    def _learn(self, new: list[str]) -> None:
        ids = [[e.ids for e in self.tokenizer.encode_batch_fast([" " + c for c in new], add_special_tokens=False)]]
        ids.append(self.processor.encode(new, num_threads=1))
        whole = np.ones(len(new), bool)
        for table, sizes, found in zip((self.a_bytes, self.b_bytes), self.lengths, ids, strict=True):
            whole &= self._given_back(new, table, sizes, found)
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
        self.whole = np.append(self.whole, whole)
        for side, found in enumerate(ids):
            size = np.fromiter(map(len, found), np.int64, len(found))
            self.starts[side] = np.append(self.starts[side], len(self.pools[side]) + np.cumsum(size) - size)
            self.sizes[side] = np.append(self.sizes[side], size)
            self.pools[side] = np.append(self.pools[side], np.fromiter(chain.from_iterable(found), np.int64))

    @staticmethod
    def _given_back(new: list[str], table: list[bytes], sizes: np.ndarray, found: list[list[int]]) -> np.ndarray:
        """Whether the bytes of a chunk's ids are the chunk's, for each chunk."""
        data = [b" " + c.encode() for c in new]
        flat = list(chain.from_iterable(found))
        many = np.fromiter(map(len, found), np.int64, len(found))
        upto = np.concatenate([[0], np.cumsum(sizes[flat])])
        end = np.cumsum(many)
        if np.array_equal(upto[end] - upto[end - many], np.fromiter(map(len, data), np.int64, len(data))):
            if b"".join(map(table.__getitem__, flat)) == b"".join(data):  # chunks of the right lengths, all of them right
                return np.ones(len(new), bool)
        return np.array([b"".join(map(table.__getitem__, x)) == d for x, d in zip(found, data, strict=True)], bool)

    def rows(self, keys: list[str]) -> np.ndarray:
        """Row of every key in the table, which learns those it lacks."""
        row = np.fromiter(map(self.place.get, keys, repeat(-1)), np.int64, len(keys))
        lacking = np.flatnonzero(row < 0)
        new = list(dict.fromkeys(keys[i] for i in lacking))
        if len(self.place) + len(new) > self.most and self.place:
            self._clear()
            return self.rows(keys)
        if new:
            self._learn(new)
            row[lacking] = [self.place[keys[i]] for i in lacking]
        return row

    def encode(self, texts: list[str]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Which texts both give back whole, and their tokens: ids and offsets by A and by B. Other texts have none."""
        keys = [_CUT.split(t) if t else [] for t in texts]
        many = np.fromiter(map(len, keys), np.int64, len(keys))
        row = self.rows(list(chain.from_iterable(keys)))
        lost = np.concatenate([[0], np.cumsum(~self.whole[row])])
        end = np.cumsum(many)
        whole = (many > 0) & (lost[end] == lost[end - many])
        row = row[np.repeat(whole, many)]
        end = np.cumsum(many * whole)
        sides = []
        for pool, start, sizes in zip(self.pools, self.starts, self.sizes, strict=True):
            size = sizes[row]
            upto = np.cumsum(size)
            at = np.arange(upto[-1] if len(upto) else 0) + np.repeat(start[row] - (upto - size), size)
            sides.append((pool[at], np.concatenate([[0], upto])[np.concatenate([[0], end])]))
        return whole, sides


class Aligner:
    """Both tokenizers' table, and the alignment of a batch of texts."""

    def __init__(self, byte_model: bytes, piece_model: bytes, chunks: int = TABLE_CHUNKS):
        tokenizer = Tokenizer.from_buffer(byte_model)
        tokenizer.encode_special_tokens = True
        self.table = ChunkIds(tokenizer, sentencepiece.SentencePieceProcessor(model_proto=piece_model), chunks)
        self.a_bytes, self.b_bytes = self.table.a_bytes, self.table.b_bytes
        self.a_size, self.b_size = self.table.lengths
        # An id as it is written before a comma, a bar, a semicolon and the end.
        most = max(len(self.a_bytes), len(self.b_bytes))
        self.written = [f"{i}{mark}".encode() for i in range(most) for mark in (",", "|", ";", "")]

    def align(self, texts: list[str], lane: int = LANE, groups: bool = False) -> pa.RecordBatch:
        """One row per text; columns as ``_OUT`` (``groups`` only if asked for)."""
        whole, ((a, a_off), (b, b_off)) = self.table.encode(texts)
        a_many, b_many = np.diff(a_off), np.diff(b_off)
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        start_a, start_b = lane_starts(a_end, b_end, a_off[:-1][whole], b_off[:-1][whole], lane)
        link_a, link_b, cut = merge_lanes(a_end, b_end, start_a, start_b, np.append(start_a[1:], len(a)))
        doc = np.searchsorted(a_off, link_a, side="right") - 1
        cut_a, cut_b = link_a[cut], link_b[cut]
        n_groups = np.bincount(doc[cut], minlength=len(texts))
        n_links = np.bincount(doc, minlength=len(texts))
        shas, written = self._write(a, a_off, b, b_off, cut_a, cut_b, groups)

        span = len(self.a_bytes) * len(self.b_bytes)
        held, times = np.unique(doc * span + a[link_a] * len(self.b_bytes) + b[link_b], return_counts=True)
        offsets = np.searchsorted(held, np.arange(len(texts) + 1) * span).astype(np.int32)
        columns = [
            pa.array(a_many), pa.array(b_many), pa.array(n_groups), pa.array(n_links), pa.array(shas, pa.string()), pa.array(written, pa.string()),
            pa.ListArray.from_arrays(offsets, pa.array(held % span)), pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=_OUT)

    def _write(self, a, a_off, b, b_off, cut_a, cut_b, keep: bool) -> tuple[list[str], list[str | None]]:
        """The groups' text of every document, hashed, and itself if asked for."""
        codes = np.empty(len(a) + len(b), np.int64)
        at_a, at_b = np.arange(len(a)), np.arange(len(b))
        group_a, group_b = np.searchsorted(cut_a, at_a), np.searchsorted(cut_b, at_b)
        # In a group come its A tokens, then its B tokens.
        codes[at_a + np.concatenate([[0], cut_b + 1])[group_a]] = a * 4
        codes[at_b + (cut_a + 1)[group_b]] = b * 4
        codes[cut_a + np.concatenate([[0], cut_b + 1])[:-1]] += 1
        codes[cut_b + cut_a + 1] += 2
        both = a_off + b_off
        filled = both[1:] > both[:-1]
        codes[both[1:][filled] - 1] += 1  # nothing after the last id
        shas, written = [], []
        for low, high in zip(both[:-1].tolist(), both[1:].tolist(), strict=True):
            text = b"".join(map(self.written.__getitem__, codes[low:high].tolist()))
            shas.append(hashlib.sha256(text).hexdigest() if text else "")
            written.append(text.decode() if keep else None)
        return shas, written


@lru_cache(maxsize=2)
def _aligner(byte_model: bytes, piece_model: bytes, chunks: int) -> Aligner:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is the library's only one
    return Aligner(byte_model, piece_model, chunks)


def _slices(texts: list[str], chars: int) -> Iterator[tuple[int, int]]:
    low, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > chars:
            yield low, i
            low, held = i, 0
        held += len(text)
    if low < len(texts):
        yield low, len(texts)


def align(
    docs: DataFrame,
    byte_path: str,
    piece_path: str,
    groups: bool = False,
    lane: int = LANE,
    batch_chars: int = BATCH_CHARS,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, groups, pairs and times of every row of ``docs`` (doc_id, text).

    ``groups`` is the alignment as text (ids of A, a bar, ids of B, groups
    parted by semicolons; NULL unless asked for); ``pairs`` are the distinct
    linked id pairs as A id * size of B's vocabulary + B id, ``times`` how
    often each is linked. The models, files of fixed size, are read by the
    driver and sent to the executors.
    """
    sc = docs.sparkSession.sparkContext
    models = sc.broadcast((Path(byte_path).read_bytes(), Path(piece_path).read_bytes()))
    kind = docs.schema["doc_id"].dataType
    text = ", ".join(f"{f.name} {'array<long>' if f.name == 'pairs' else 'array<int>' if f.name == 'times' else 'string' if f.type == pa.string() else 'long'}" for f in _OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*models.value, TABLE_CHUNKS)
        for whole in batches:
            texts = [t or "" for t in whole.column(1).to_pylist()]
            for low, high in _slices(texts, batch_chars):
                found = aligner.align(texts[low:high], lane, groups)
                yield pa.RecordBatch.from_arrays([whole.column(0).slice(low, high - low), *found.columns], ["doc_id", *found.schema.names])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind.simpleString()}, {text}")


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """pair, documents (that hold it linked), best (whether no pair of its A id is in more)."""
    counted = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("documents"))
    counted = pin(counted, "pair_counts")
    a = F.floor(F.col("pair") / b_size)
    highest = counted.groupBy(a.alias("a")).agg(F.max("documents").alias("highest"))
    return pin(
        counted.join(highest, a == F.col("a")).select("pair", "documents", (F.col("documents") == F.col("highest")).alias("best")), "pair_best"
    )


def alignment_report(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """The query's digest: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    aligned = pin(align(docs, byte_path, piece_path).drop("groups").withColumn("row", F.monotonically_increasing_id()), "aligned")
    b_size = sentencepiece.SentencePieceProcessor(model_file=piece_path).vocab_size()
    counts = pair_counts(aligned, b_size)
    # By pair at every size: the counts grow with the corpus, up to the product of the vocabularies.
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    sums = (
        links.join(counts.hint("merge"), "pair")
        .groupBy("row")
        .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("documents")).alias("count_sum"))
    )
    return aligned.join(sums, "row", "left").select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"), F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256",
    )
