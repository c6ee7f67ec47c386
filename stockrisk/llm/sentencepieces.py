"""SentencePiece ids by a distinct-chunk table.

No piece of the model has a whitespace marker behind another character, so
no merge crosses the place where a marked word begins: the ids of a text are
the ids of its marked words, one after the other. Each task keeps a table of
the distinct marked words it has met, has the library segment each of them
once, and joins the ids back by position. The table is bounded: when it is
full it is emptied, and words met again are segmented again.

Why the table is per task and not one joined table: joined by position, the
words of a corpus are as many rows as it has words, each far wider than the
word (figures in the README); a task's table needs no shuffle.

Defined cases: NULL and empty texts give no ids and the empty text; repeated
rows get the same ids; columns named ids and decoded are replaced; long texts
need memory for their own ids only; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

MARK = "▁"  # FIXED VALUE: the library's whitespace marker
TABLE_WORDS = 400_000  # distinct words a task's table holds
BATCH_ROWS = 512  # rows returned to Spark at once
_MARKED = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class ChunkTable:
    """Ids and decoded texts of marked words, each worked out once.

    A word's key is the marked word without its first marker: the library
    puts that marker before any text it encodes.
    """

    def __init__(self, processor: sentencepiece.SentencePieceProcessor, words: int = TABLE_WORDS):
        crossing = re.compile(f"[^{MARK}]{MARK}")
        if any(crossing.search(processor.id_to_piece(i)) for i in range(processor.vocab_size())):
            raise ValueError("a piece of this model crosses whitespace: its words can't be encoded one by one")
        if processor.encode("a") != processor.encode(" a")[1:] and not processor.encode("a", out_type=str)[0].startswith(MARK):
            raise ValueError("this model puts no whitespace marker before a text")
        self.processor, self.words = processor, words
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}  # word -> its row in start and size
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)  # the ids of all words, one after the other

    def _learn(self, new: list[str]) -> None:
        ids = self.processor.encode(new, num_threads=1)
        if "" in new:  # the library gives no ids for an empty text, but the lone marker is a word
            ids[new.index("")] = [self.processor.piece_to_id(MARK)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        first = len(self.place)
        self.place.update(zip(new, range(first, first + len(new)), strict=True))
        self.start = np.concatenate([self.start, len(self.pool) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.pool = np.concatenate([self.pool, np.fromiter(chain.from_iterable(ids), np.int32)])

    def keys(self, text: str) -> list[str]:
        if not text:
            return []
        if MARK in text:
            text = text.replace(MARK, " ")
        if text[0] != " " and text[-1] != " " and "  " not in text:
            return text.split(" ")
        return [w[1:] for w in _MARKED.findall(MARK + text.replace(" ", MARK))]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the offsets at which each text begins (and the last ends)."""
        keys = [self.keys(t) for t in texts]
        distinct = dict.fromkeys(chain.from_iterable(keys))
        new = [k for k in distinct if k not in self.place]
        if len(self.place) + len(new) > self.words:
            self._clear()
            new = list(distinct)
        if new:
            self._learn(new)
        count = np.fromiter(map(len, keys), np.int64, len(keys))
        row = np.fromiter(map(self.place.__getitem__, chain.from_iterable(keys)), np.int64, int(count.sum()))
        size = self.size[row]
        end = np.cumsum(size)
        # position in the pool: the word's start plus the distance from the word's first id
        at = np.arange(end[-1] if len(end) else 0) + np.repeat(self.start[row] - (end - size), size)
        offsets = np.concatenate([[0], end])[np.concatenate([[0], np.cumsum(count)])]
        return self.pool[at], offsets.astype(np.int32)


@lru_cache(maxsize=2)
def _table(model: bytes, words: int) -> ChunkTable:
    return ChunkTable(sentencepiece.SentencePieceProcessor(model_proto=model), words)


def encode_decode(docs: DataFrame, model_path: str, text: str = "text", words: int = TABLE_WORDS) -> DataFrame:
    """``docs`` with ``ids`` (array<int>, no begin or end ids) and ``decoded`` (the ids' text).

    Columns of ``docs`` with these names are replaced. The model file is read
    by the driver and sent to the executors as bytes (its size is fixed).
    """
    kept = docs.drop("ids", "decoded")
    at = kept.columns.index(text)
    model = docs.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())
    added = [StructField("ids", ArrayType(IntegerType(), False)), StructField("decoded", StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = _table(model.value, words)
        for whole in batches:
            for low in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(low, BATCH_ROWS)
                ids, offsets = chunks.encode([t or "" for t in batch.column(at).to_pylist()])
                listed = pa.ListArray.from_arrays(offsets, ids)
                each = np.split(ids, offsets[1:-1])
                decoded = pa.array([chunks.processor.decode(i.tolist()) for i in each], pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, listed, decoded], [*batch.schema.names, "ids", "decoded"])

    return kept.mapInArrow(run, StructType([*kept.schema.fields, *added]))


def token_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """The query's digest: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encode_decode(docs.select("doc_id", "text"), model_path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
