"""Quality rules with n-gram perplexity: modified Kneser-Ney models of the whole corpus, bands of perplexity by language.

Two models judge. ``word_model`` predicts whole words from the words before
them, with all n-grams of the corpus; a text above its language's band of
that surprise is rejected (below it stands what other texts hold too, which
is no fault of a text). The other model, of spelling, is this module's. It predicts the symbols of a text's words from the ``ORDER - 1``
symbols before them. Symbols are ``SYMBOLS`` classes of UTF-8 bytes: blank,
the letters a-z whatever their case, digit, ordinary punctuation, other ASCII,
lead byte and continuation byte; blanks between words count as one. So an
n-gram packs into ``ORDER * SYMBOL_BITS`` bits without loss, and the model has
at most 2**20 n-grams however large the corpus: a proven bound for what is
gathered and sent to the tasks. Spark counts the n-grams of all texts (tasks
sum theirs first); discounts and probabilities follow from the counts and are
kept in arrays sorted by packed n-gram, searched by bisection, with back-off
to shorter contexts for n-grams the model lacks. Tasks get the result for each
n-gram there can be, so they only look up.

A document's surprise is the mean -log p of its symbols. For each language
the band is ``REACH`` interquartile ranges wide on either side of the middle
half of its distinct texts that pass the base rules (quartiles of counts over
``GRID`` steps, so they are the same whatever the partitions), and at least
``LEAST_REACH``. Documents outside their language's band, on either side, are
rejected: below stands text that repeats itself, above what isn't the
language's prose.

Defined cases: a NULL or empty text has no words, fails the base rules and has
no surprise; a NULL lang is a language of its own; repeated rows count in the
model and each get a row; copies count once for the bands; a language none of
whose texts passes the base rules has no band, and rejects by the base rules
alone; very long texts are read in pieces of bounded size; an empty table
gives no rows; other columns are not read, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockrisk.llm.word_model import BLANKS, Keys, discounts_of, pieces, word_keys, word_surprises
from stockrisk.sources.sinks import pin

ORDER = 4
SYMBOL_BITS = 5
SYMBOLS = 1 << SYMBOL_BITS
REACH = 5.0  # interquartile ranges a band reaches beyond the quartiles
LEAST_REACH = 0.05  # nats a symbol, at least
GRID = 1000  # steps of a nat that quartiles are counted on
PIECE = 1 << 20  # symbols worked on at once

# FIXED VALUES of the query contract.
LEAST_WORDS = 50
REPEATED_SHARE = 50  # per cent of the words
CONTRACT_SYMBOLS = b"#*$%&|<>"

_CLASS = np.full(256, 29, np.uint8)
_CLASS[list(b".,;:'\"()-!?")] = 28
_CLASS[list(b"0123456789")] = 27
for _c in range(26):
    _CLASS[[ord("a") + _c, ord("A") + _c]] = 1 + _c
_CLASS[0x80:0xC0] = 31
_CLASS[0xC0:] = 30
_CLASS[list(BLANKS)] = 0


# What counts in a text: characters that aren't blank, and from bit 32 on the contract's symbols.
_COUNTED = np.ones(256, np.int64)
_COUNTED[0x80:0xC0] = 0
_COUNTED[list(BLANKS)] = 0
_COUNTED[list(CONTRACT_SYMBOLS)] += 1 << 32
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)


def symbol_codes(data: bytes) -> Iterator[np.ndarray]:
    """Packed n-grams that end in each symbol of a text, in order: words between single blanks, ``ORDER - 1`` blanks before the first."""
    before = np.zeros(ORDER - 1, np.uint8)
    for low in range(0, len(data), PIECE):
        part = _CLASS[np.frombuffer(data[low : low + PIECE], np.uint8)]
        part = part[(part != 0) | (np.concatenate([before[-1:], part[:-1]]) != 0)]
        yield _packed(before, part)
        before = np.concatenate([before, part])[-(ORDER - 1) :]
    if before[-1]:
        yield _packed(before, np.zeros(1, np.uint8))


def symbol_lines(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for the texts between ``cuts`` of ``data``, one after another, and how many each has."""
    symbols = _CLASS[data]
    held = symbols != 0
    after = held[:-1].copy()
    after[cuts[(cuts > 0) & (cuts < len(data))] - 1] = False
    held[1:] |= after
    upto = np.zeros(len(data) + 1, np.int64)
    np.cumsum(held, out=upto[1:])
    many = np.diff(upto[cuts])
    symbols = symbols[held]
    ends = np.cumsum(many)
    # A text that ends in a word gets a blank after it.
    more = np.zeros(len(many), np.int64)
    more[many > 0] = symbols[ends[many > 0] - 1] != 0
    sizes = np.where(many > 0, many + more + ORDER - 1, 0)
    low = np.cumsum(sizes) - sizes
    line = np.zeros(int(sizes.sum()), np.int32)
    line[np.arange(len(symbols)) + np.repeat(low + ORDER - 1 - (ends - many), many)] = symbols
    out = line.copy()
    for back in range(1, ORDER):
        out[back:] |= line[:-back] << (back * SYMBOL_BITS)
    inside = np.ones(len(line), bool)
    for i in range(ORDER - 1):
        inside[low[many > 0] + i] = False
    return out[inside], many + more


def _packed(before: np.ndarray, part: np.ndarray) -> np.ndarray:
    line = np.concatenate([before, part]).astype(np.int32)
    out = np.zeros(len(part), np.int32)
    for i in range(ORDER):
        out = (out << SYMBOL_BITS) | line[i : i + len(part)]
    return out


def count_grams(docs: DataFrame) -> DataFrame:
    """gram, n: the packed n-grams of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << (ORDER * SYMBOL_BITS), np.int64)
        held, size = [], 0
        for batch in batches:
            for _, _, data, cuts in pieces(batch.column(0)):
                for codes in [symbol_lines(data, cuts)[0]] if len(data) <= PIECE else symbol_codes(data.tobytes()):
                    held.append(codes)
                    size += len(codes)
                    if size > PIECE:
                        total += np.bincount(np.concatenate(held), minlength=len(total))
                        held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["gram", "n"])

    texts = docs.where(F.col("text").isNotNull()).select(F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(counts: np.ndarray) -> np.ndarray:
    """What is taken off counts of 1, 2 and more; fixed values where the counts of counts don't tell."""
    return discounts_of([int((counts == k).sum()) for k in (1, 2, 3, 4)])


@dataclass
class Model:
    """For each order 1, 2, ...: sorted packed n-grams and their log p, sorted contexts and the log weight of backing off from them."""

    grams: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    back: list[np.ndarray]

    @classmethod
    def fit(cls, grams: np.ndarray, counts: np.ndarray) -> Model:
        """Interpolated modified Kneser-Ney; ``grams`` sorted and of the full order."""
        tables = [(grams.astype(np.int64), counts.astype(np.float64))]
        for order in range(ORDER - 1, 0, -1):
            # Continuation counts: the distinct symbols seen before the n-gram.
            shorter, kinds = np.unique(tables[0][0] & ((1 << (order * SYMBOL_BITS)) - 1), return_counts=True)
            tables.insert(0, (shorter, kinds.astype(np.float64)))
        out_grams, out_logs, out_contexts, out_back = [], [], [], []
        lower = None
        for order, (own, n) in enumerate(tables, 1):
            off = discounts(n)[np.minimum(n, 3).astype(int) - 1]
            context = own >> SYMBOL_BITS
            contexts, of = np.unique(context, return_inverse=True)
            whole = np.bincount(of, n, len(contexts))
            left = np.bincount(of, np.minimum(off, n), len(contexts)) / whole
            if lower is None:
                below = np.full(len(own), 1 / SYMBOLS)
            else:
                below = lower[np.searchsorted(out_grams[-1], own & ((1 << ((order - 1) * SYMBOL_BITS)) - 1))]
            lower = np.maximum((n - off) / whole[of], 0) + left[of] * below
            out_grams.append(own)
            out_logs.append(np.log(np.maximum(lower, 1e-12)))
            out_contexts.append(contexts)
            out_back.append(np.log(np.maximum(left, 1e-12)))
        return cls(out_grams, out_logs, out_contexts, out_back)

    def log_p(self, codes: np.ndarray) -> np.ndarray:
        out, weight = np.zeros(len(codes)), np.zeros(len(codes))
        open_ = np.arange(len(codes))
        for order in range(ORDER, 0, -1):
            own = codes[open_] & ((1 << (order * SYMBOL_BITS)) - 1)
            at, found = _find(self.grams[order - 1], own)
            out[open_[found]] = self.logs[order - 1][at[found]] + weight[open_[found]]
            open_ = open_[~found]
            if not len(open_):
                return out
            at, known = _find(self.contexts[order - 1], own[~found] >> SYMBOL_BITS)
            weight[open_[known]] += self.back[order - 1][at[known]]
        out[open_] = weight[open_] - np.log(SYMBOLS)
        return out

    def all_log_p(self) -> np.ndarray:
        """log p of every packed n-gram there can be, in their order."""
        every = np.arange(1 << (ORDER * SYMBOL_BITS), dtype=np.int64)
        return np.concatenate([self.log_p(every[low : low + PIECE // 8]) for low in range(0, len(every), PIECE // 8)])


def _find(held: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of values in a sorted array, and whether they are there."""
    if not len(held):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(held, wanted), len(held) - 1)
    return at, held[at] == wanted


def fit(docs: DataFrame) -> Model:
    """Model of all texts of ``docs``: at most 2**(ORDER * SYMBOL_BITS) counts reach the driver."""
    counted = count_grams(docs).toArrow()
    grams, counts = counted.column("gram").to_numpy(), counted.column("n").to_numpy()
    order = np.argsort(grams)
    return Model.fit(grams[order], counts[order])


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of three that the text holds twice or more."""
    many = len(words)
    if many < 3:
        return 0
    first: dict[bytes, int] = {}
    ids = np.fromiter(map(first.setdefault, words, count()), np.int64, many)
    _, pairs = np.unique(ids[:-1] * many + ids[1:], return_inverse=True)
    _, windows, times = np.unique(pairs[:-1] * many + ids[2:], return_inverse=True, return_counts=True)
    twice = times[windows] > 1
    held = np.zeros(many, bool)
    for i in range(3):
        held[i : i + many - 2] |= twice
    return int(held.sum())


def figures(data: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text in UTF-8."""
    kinds = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    chars = len(data) - int(kinds[0x80:0xC0].sum()) - int(kinds[list(BLANKS)].sum())
    words = data.split()  # at exactly \x20 and \x09-\x0D
    lines = [line for line in data.split(b"\n") if line.strip()]
    return len(words), chars, int(kinds[list(CONTRACT_SYMBOLS)].sum()), len(lines) - len(set(lines)), repeated_words(words)


def many_figures(data: np.ndarray, cuts: np.ndarray, long_keys: Keys) -> list[np.ndarray]:
    """``figures`` of the texts between ``cuts`` of ``data``; keys of words and of windows stand for them within a text."""
    keys, starts = word_keys(data, cuts, long_keys)
    words = np.searchsorted(starts, cuts)
    many = np.diff(words)
    upto = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_COUNTED[data], out=upto[1:])
    counted = upto[cuts]
    chars, symbols = np.diff(counted & 0xFFFFFFFF), np.diff(counted >> 32)
    text = np.repeat(np.arange(len(many), dtype=np.uint64), many)
    first = np.flatnonzero(text[:-2] == text[2:]) if len(keys) > 2 else np.zeros(0, np.int64)
    codes = text[first] * np.uint64(_ODD[3])
    for i in range(3):
        codes += keys[first + i] * np.uint64(_ODD[i])
    at = np.argsort(codes)
    same = codes[at[1:]] == codes[at[:-1]]
    twice = first[np.concatenate([at[1:][same], at[:-1][same]])]
    held = np.zeros(len(keys) + 1, np.int64)
    for i in range(3):
        held[twice + i + 1] = 1
    repeated = np.diff(np.cumsum(held)[words])
    lines = np.zeros(len(many), np.int64)
    own = data.tobytes()
    for i, (low, high) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
        listed = [line for line in own[low:high].split(b"\n") if line.strip()]
        lines[i] = len(listed) - len(set(listed))
    return [many, chars, symbols, lines, repeated]


def measure(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang, text_key, the five figures and the surprise (NULL without words) of every row."""
    held = docs.sparkSession.sparkContext.broadcast(model.all_log_p())
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, long_keys = held.value, Keys()
        for whole in batches:
            for low, high, data, cuts in pieces(whole.column(3)):
                if len(data) <= PIECE:
                    listed = many_figures(data, cuts, long_keys)
                    codes, many = symbol_lines(data, cuts)
                    lost = np.zeros(len(many))
                    if len(codes):
                        lost[many > 0] = -np.add.reduceat(own[codes], (np.cumsum(many) - many)[many > 0])
                else:  # one long text
                    text = data.tobytes()
                    listed, many, lost = [np.array([x]) for x in figures(text)], np.zeros(1, np.int64), np.zeros(1)
                    for codes in symbol_codes(text):
                        many += len(codes)
                        lost -= own[codes].sum()
                surprise = pa.array(lost / np.maximum(many, 1), pa.float64(), mask=many == 0)
                columns = [c.slice(low, high - low) for c in whole.columns[:3]]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(x, pa.int64()) for x in listed], surprise], ["doc_id", "lang", "text_key", *names, "surprise"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    read = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("text_key"), F.col("text").cast("binary"))
    return read.mapInArrow(run, f"doc_id {kind}, lang string, text_key long, {', '.join(f'{n} long' for n in names)}, surprise double")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_SHARE * F.col("n_words"))


def bands(measured: DataFrame, reach: float = REACH, least: float = LEAST_REACH, figure: str = "surprise") -> DataFrame:
    """lang, low, high: the band of surprise of every language, from its distinct texts that pass the base rules."""
    passed = measured.where(~base_failed() & F.col(figure).isNotNull())
    step = F.floor(F.col(figure) * GRID).alias("step")
    # Copies of one text have one surprise. The grid has a bounded number of steps, -log p being bounded.
    counted = passed.groupBy("lang", "text_key").agg(F.first(figure).alias(figure)).groupBy("lang", step).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("lang").orderBy("step")
    placed = counted.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(Window.partitionBy("lang")))

    def quartile(share: float) -> Column:
        return F.min(F.when(F.col("upto") >= share * F.col("all"), F.col("step"))) / F.lit(float(GRID))

    sides = placed.groupBy("lang").agg(quartile(0.25).alias("first"), quartile(0.75).alias("third"))
    wide = F.greatest(reach * (F.col("third") - F.col("first")), F.lit(least))
    return sides.select("lang", (F.col("first") - wide).alias("low"), (F.col("third") + wide).alias("high"))


def judge(docs: DataFrame, reach: float = REACH, least: float = LEAST_REACH, word_order: int = 0) -> DataFrame:
    """doc_id, lang, the figures, surprise, base_failed, low, high and kept of every row of ``docs`` (doc_id, text, lang).

    With a ``word_order`` word_surprise and word_high too, and texts above that are not kept.
    """
    measured = pin(measure(docs, fit(docs)), "measured")
    inside = F.coalesce((F.col("surprise") >= F.col("low")) & (F.col("surprise") <= F.col("high")), F.lit(True))
    if word_order:
        measured = pin(measured.join(word_surprises(docs, word_order), "text_key", "left"), "measured")
        inside &= F.coalesce(F.col("word_surprise") <= F.col("word_high"), F.lit(True))
    held = bands(measured, reach, least).withColumnRenamed("lang", "_lang")
    if word_order:
        words = bands(measured, reach, least, "word_surprise").select(F.col("lang").alias("_words_lang"), F.col("high").alias("word_high"))
        held = held.join(words, F.col("_lang").eqNullSafe(F.col("_words_lang")), "left").drop("_words_lang")
    return (
        measured.join(held, F.col("lang").eqNullSafe(F.col("_lang")), "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & inside)
        .drop("_lang", "text_key")
    )


def rules_report(docs: DataFrame, word_order: int = 0) -> DataFrame:
    """The query's digest: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    judged = judge(docs, word_order=word_order)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
