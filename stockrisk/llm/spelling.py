"""Spelling variants: words one edit apart, found over a reduced alphabet.

Letters are hashed to a few symbols, so a word becomes a reduced word, and two
words one edit apart have reduced words that are equal or one edit apart. The
full one-edit neighbourhood of every distinct reduced word (all deletions,
replacements and insertions of a symbol) is generated and joined with the
reduced vocabulary; of two reduced words that are neighbours, the one with the
greater code asks. The words behind a found pair are verified on their
original letters. No pair within one edit is missed: reducing never adds an
edit.

The number of symbols follows the vocabulary: the fewest of ``SYMBOLS`` with
which a word shares its reduced word with at most ``SHARED`` words on average;
the last of them keeps every letter apart. Words of one reduced word are
dealt over units of about ``UNIT`` words, and units, not reduced words, are
joined, so a crowded reduced word is many rows and tasks.

Most neighbours are the reduced word of nothing. A bitmap of ``2**BITMAP_BITS``
bits, a fixed size, tells the tasks which codes are surely not there before
they are shuffled; the join decides about the rest, which grow to all of them
as a vocabulary outgrows the bitmap.

Only vocabulary is shuffled: tasks count the words of their texts in tables of
bounded size before the first exchange.

Defined cases: NULL and empty texts hold no words; a NULL doc_id is written as
the empty text in the hash; repeated rows count again, as any other document;
ties between forms go to the smallest word in code-point order; words of any
length are reduced whole (their neighbourhood is as long as the word times the
symbols); an empty table, or one without a word that occurs twice, gives no
rows; other columns are not read, so their names can't clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockrisk.sources.sinks import pin

# FIXED VALUES of the query contract.
LEAST_LETTERS = 7
LEAST_COUNT = 2
DAMAGED = 31
FORM_RATIO = 10
LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]

SYMBOLS = (4, 8, 16, 32, len(LETTERS))
SHARED = 8.0  # words of a reduced word, as a word meets them
UNIT = 256  # words compared as one
TABLE_WORDS = 300_000  # distinct words a task counts before it hands them on
BITMAP_BITS = 27
SYMBOLS_AT_ONCE = 1 << 17  # length of the reduced words worked on at once
_RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LETTERS},}}")
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def count_words(docs: DataFrame) -> DataFrame:
    """word, n: the words of all texts, after the contract's damage to one run in ``DAMAGED``; at least ``LEAST_LETTERS`` long.

    Shorter runs are never a word: damage only takes letters away.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                salt = zlib.crc32(f"{name}:".encode())
                # bytes.lower() folds A-Z alone.
                for word, many in Counter(_RUN.findall(data.lower().decode("utf-8", "replace"))).items():
                    h = zlib.crc32(word.encode(), salt)
                    if not h % DAMAGED:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < LEAST_LETTERS:
                            continue
                    held[word] = held.get(word, 0) + many
                if len(held) >= TABLE_WORDS:
                    yield told()
                    held = {}
        if held:
            yield told()

    read = docs.where(F.col("text").isNotNull()).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.col("text").cast("binary"))
    return read.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))).view(np.int64)


def _symbol_table(symbols: int) -> np.ndarray:
    """Symbol (1, 2, ...) of each code point up to U+00FF."""
    table = np.zeros(256, np.uint64)
    if symbols >= len(LETTERS):
        table[LETTERS] = np.arange(len(LETTERS)) + 1
    else:
        table[LETTERS] = [zlib.crc32(b"%d" % c) % symbols + 1 for c in LETTERS]
    return table


class Reduced:
    """Words as rows of symbols, one after the other, with the sums that give any edit's code at once.

    A word's code is the sum of symbol * base**place, mixed; sums of prefixes
    are enough to take a symbol out, put one in or exchange one.
    """

    def __init__(self, words: list[str], symbols: int):
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        self.symbols = symbols
        self.value = _symbol_table(symbols)[letters]
        self.first = np.cumsum(self.size) - self.size
        self.row = np.repeat(np.arange(len(words)), self.size)
        self.place = np.arange(len(letters)) - self.first[self.row]
        longest = int(self.size.max(initial=0))
        self.power = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(longest + 1, _BASE, np.uint64), dtype=np.uint64)])
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.value * self.power[self.place], dtype=np.uint64)])
        self.before = upto[:-1] - upto[self.first][self.row]  # sum of the word's symbols before this one
        self.total = upto[self.first + self.size] - upto[self.first]

    def codes(self) -> np.ndarray:
        return _mixed(self.total)

    def neighbours(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, codes) of all one-edit neighbours, each distinct reduced word of a row once."""
        up, total = self.power[self.place], self.total[self.row]
        previous = np.concatenate([np.zeros(1, np.uint64), self.value[:-1]])
        previous[self.place == 0] = 0
        # Of a run of one symbol, only the first is taken out.
        out = self.value != previous
        after = total - self.before - self.value * up
        yield self.row[out], _mixed((self.before + after * np.uint64(_INVERSE))[out])
        for symbol in map(np.uint64, range(1, self.symbols + 1)):
            other = self.value != symbol
            yield self.row[other], _mixed((total + (symbol - self.value) * up)[other])
            # A symbol put in behind its like is the same as in front of it.
            new = previous != symbol
            yield self.row[new], _mixed((self.before + symbol * up + (total - self.before) * np.uint64(_BASE))[new])
            last = self.value[self.first + self.size - 1] != symbol
            yield np.flatnonzero(last), _mixed((self.total + symbol * self.power[self.size])[last])


def _chunks(words: list[str]) -> Iterator[tuple[int, int]]:
    low, held = 0, 0
    for i, word in enumerate(words):
        if held and held + len(word) > SYMBOLS_AT_ONCE:
            yield low, i
            low, held = i, 0
        held += len(word)
    if low < len(words):
        yield low, len(words)


def reduce_words(words: DataFrame, symbols: int) -> DataFrame:
    """``words`` with the ``code`` of each reduced word."""

    @F.pandas_udf("long")
    def code(column: pd.Series) -> pd.Series:
        listed = column.tolist()
        parts = [Reduced(listed[low:high], symbols).codes() for low, high in _chunks(listed)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0, np.int64))

    return words.withColumn("code", code("word"))


def choose_symbols(words: DataFrame, shared: float = SHARED) -> int:
    """The fewest symbols that tell the vocabulary apart well enough, by counts over all of it."""
    for symbols in SYMBOLS[:-1]:
        crowd = reduce_words(words, symbols).groupBy("code").count()
        squares, many = crowd.agg(F.sum(F.col("count").cast("double") * F.col("count")), F.sum("count")).first()
        if not many or squares <= shared * many:
            return symbols
    return SYMBOLS[-1]


def code_bitmap(codes: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """Bytes of a bitmap of the codes' upper ``bits`` bits: bit k of byte j for the value 8 j + k."""
    place = F.shiftrightunsigned("code", 64 - bits) + 1  # the functions' buckets are numbered from 1
    filled = codes.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap"))
    out = np.zeros(max(1 << (bits - 3), 4096), np.uint8)
    for row in filled.toLocalIterator():
        out[(row["bucket"] - 1) * 4096 : row["bucket"] * 4096] = np.frombuffer(bytes(row["bitmap"]), np.uint8)
    return out


def near_words(words: DataFrame, symbols: int, unit: int = UNIT) -> DataFrame:
    """All pairs of words exactly one edit apart, once each: a, n_a, b, n_b."""
    coded = reduce_words(words, symbols)
    crowd = coded.groupBy("code").agg(F.count(F.lit(1)).alias("many"), F.min("word").alias("one"))
    units = pin(crowd.select("code", "one", F.ceil(F.col("many") / unit).cast("int").alias("units")), "reduced")

    def name(code: Column, nth: Column) -> Column:
        # The unit of the usual single one is its code.
        return F.when(nth == 0, code).otherwise(F.xxhash64(code, nth))

    nth = F.pmod(F.xxhash64("word"), F.col("units")).cast("int")
    crowded = units.where("units > 1").select(F.col("code").alias("_code"), "units")
    dealt = coded.join(crowded, F.col("code") == F.col("_code"), "left").withColumn("units", F.coalesce("units", F.lit(1)))
    dealt = pin(dealt.select("word", "n", name(F.col("code"), nth).alias("unit")), "dealt")

    bitmap = words.sparkSession.sparkContext.broadcast(code_bitmap(units))

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        there, drop = bitmap.value, np.uint64(64 - BITMAP_BITS)
        for frame in frames:
            listed = frame["one"].tolist()
            codes, names = frame["code"].to_numpy(np.int64), frame["unit"].to_numpy(np.int64)
            for low, high in _chunks(listed):
                for row, code in Reduced(listed[low:high], symbols).neighbours():
                    row = row + low
                    place = (code.view(np.uint64) >> drop).astype(np.int64)
                    asked = (code < codes[row]) & (there[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
                    yield pd.DataFrame({"code": code[asked], "asker": names[row[asked]]})

    each = units.select("code", "one", "units", F.explode(F.sequence(F.lit(0), F.col("units") - 1)).alias("i"))
    named = each.select("code", "one", name(F.col("code"), F.col("i")).alias("unit"))
    # One plan at every size: the reduced vocabulary grows with the corpus.
    asked = named.select("code", F.col("unit").alias("asked")).hint("merge")
    # Questions are much work on few bytes: as many tasks as any exchange.
    spread = named.repartition(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), "code")
    apart = spread.mapInPandas(ask, "code long, asker long").join(asked, "code").select("asker", "asked")
    alike = each.select("code", "i", F.explode(F.sequence("i", F.col("units") - 1)).alias("j")).select(
        name(F.col("code"), F.col("i")).alias("asker"), name(F.col("code"), F.col("j")).alias("asked")
    )
    left = dealt.select(F.col("unit").alias("asker"), F.col("word").alias("a"), F.col("n").alias("n_a")).hint("merge")
    right = dealt.select(F.col("unit").alias("asked"), F.col("word").alias("b"), F.col("n").alias("n_b")).hint("merge")
    met = apart.unionByName(alike).join(left, "asker").join(right, "asked").where((F.col("asker") != F.col("asked")) | (F.col("a") < F.col("b")))
    return met.where(F.abs(F.length("a") - F.length("b")) <= 1).where(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b")


def follow_forms(forms: DataFrame) -> DataFrame:
    """word, root: from every word of (word, form), forms followed to the last, the distance doubled each time.

    A form is at least ``FORM_RATIO`` times as frequent as its word, so there
    are no circles and chains are as long as a count has digits.
    """
    linked = pin(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = linked.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if not linked.join(onward, "root").limit(1).count():
            return linked
        linked = pin(linked.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")


def group_variants(words: DataFrame, symbols: int | None = None, unit: int = UNIT, ratio: int = FORM_RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of a stored vocabulary (word, n)."""
    near = near_words(words, symbols or choose_symbols(words), unit)
    sides = [F.struct(F.col(x).alias("_word"), F.col(y).alias("other"), F.col(f"n_{y}").alias("other_n")) for x, y in ("ab", "ba")]
    found = near.select(F.inline(F.array(*sides))).groupBy("_word").agg(
        F.count(F.lit(1)).alias("near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best")
    )
    most = -F.col("best.less")
    formed = words.join(found, F.col("word") == F.col("_word"), "left").select(
        "word", "n", F.coalesce("near", F.lit(0)).cast("long").alias("n_near"),
        F.when(most >= ratio * F.col("n"), F.col("best.form")).alias("form"), F.when(most >= ratio * F.col("n"), most).alias("form_n"),
    )
    formed = pin(formed, "formed")
    roots = follow_forms(formed.where(F.col("form").isNotNull())).withColumnRenamed("word", "_word")
    return formed.join(roots, F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_report(docs: DataFrame) -> DataFrame:
    """The query's rows: word, form, root, n, n_near, form_n of the vocabulary of ``docs``."""
    return group_variants(pin(count_words(docs).where(F.col("n") >= LEAST_COUNT), "words"))
