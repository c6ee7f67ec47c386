"""Word n-gram model of the whole corpus: interpolated modified Kneser-Ney, counted, fitted and applied by joins.

Every word of every text counts, and an end after the last; ``order - 1``
begins stand before the first. Words are kept as 64-bit keys, otherwise
nothing is folded, pruned or capped: the n-grams grow with the corpus, so
they stay with the tasks. Only each order's counts of counts (four numbers a
half) and sums reach the driver.

``word_grams``, ``count_tables`` and ``probabilities`` are the model as rows;
``word_surprises`` works on the same n-grams in packed blocks, which take a
small part of the disk. A bucket has all n-grams whose last word but one is in
its range of keys, so counts, contexts and shorter n-grams down to pairs are
its own; what single words count in all buckets is summed by ranges of words
and goes back in the order of each bucket's words. A word that fills buckets
alone has some of its own, by the word before it, and its pairs are summed the
same way; which words do is judged by a sample of the texts, which moves work
but no result; so do the ``COMMON`` words of the sample, that blocks name in
fewer bytes. Buckets are exchanged in ``shares``, one after another, and the
texts are read anew for each.

Texts fall in two halves by their hash, and each is scored by the model of the other
half, as a model that has read a text predicts its rarest words best. Copies
of a text lie in one half, so none predicts another; repeated rows count as
often as they come. A table holds the n-grams of both halves with a count for
each, so whatever a text asks is there, be it with count 0, and
backs off to the shorter n-gram by the usual weights. Words that
the other half lacks share the uniform part of order 1.

Sums are of whole numbers, so they are the same whatever the partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from hashlib import blake2b, shake_256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockrisk.sources.sinks import owned_pins, pin

WORD_ORDER = 3
HALVES = (0, 1)
BEGIN, END = b"", b" "  # no word is either
KEYS_HELD = 400_000  # long words whose keys a task remembers
ROWS = 1 << 17  # rows a task gives at once
PIECE = 1 << 20  # bytes whose words are keyed at once
CHUNK = 1 << 22  # words whose n-grams are packed together
BUCKET = 3_000_000  # n-grams of a bucket, about
BYTES_A_WORD = 6  # about; only the number of buckets follows from it
SAMPLE = 16
COMMON = 1 << 18  # words that blocks name by a number all tasks know
SCALE = 1 << 20  # steps of a nat that are summed
LEAST_OFF = 0.1  # discount at least: a text asks the model of the half it isn't in, so every context must leave something for other words

BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
KEYED = 48  # bytes of a word that have random numbers; longer words are hashed one by one
_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS)] = True
# A word's key is the sum of the numbers of its bytes at their places; blanks have 0.
_NUMBERS = np.frombuffer(shake_256(b"words").digest(KEYED * 256 * 8), "<u8").reshape(KEYED, 256).copy()
_NUMBERS[:, _BLANK] = 0
_NUMBERS = _NUMBERS.ravel()
_ZSTD = pa.Codec("zstd", compression_level=1)


class Keys(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEYS_HELD:
            self.clear()
        key = self[word] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return key


def word_keys(data: np.ndarray, cuts: np.ndarray, long_keys: Keys) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the words of UTF-8 ``data`` and the places where they begin; no word goes across a cut."""
    solid = ~_BLANK[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    cuts = cuts[cuts < len(data)]
    begins[cuts] = solid[cuts]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    low = starts[0]
    at = np.arange(low, len(data), dtype=np.int32) - np.repeat(starts.astype(np.int32), np.diff(starts, append=len(data)))
    far = at >= KEYED
    keys = np.add.reduceat(_NUMBERS[(np.minimum(at, KEYED - 1) << 8) | data[low:]], starts - low)
    if (far & solid[low:]).any():
        ends = np.append(starts[1:], len(data))
        for i in np.unique(np.searchsorted(starts, low + np.flatnonzero(far & solid[low:]), "right") - 1):
            keys[i] = long_keys[data[starts[i] : ends[i]].tobytes().split()[0]]
    return keys, starts


def pieces(column: pa.BinaryArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """low, high, bytes, cuts: rows of a column, about ``PIECE`` bytes at once or one longer text, and where each begins and the last ends."""
    wide = pa.types.is_large_binary(column.type)
    places = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole, low = np.frombuffer(column.buffers()[2] or b"", np.uint8), 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(places, places[low] + PIECE, "right")) - 1)
        yield low, high, whole[places[low] : places[high]], places[low : high + 1] - places[low]
        low = high


def _text_keys_and_words(batch: pa.RecordBatch, long_keys: Keys) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """text_keys, how many words each has, and the keys of all their words, in order, some texts at once."""
    text_keys = batch.column(0).to_numpy()
    for low, high, data, cuts in pieces(batch.column(1)):
        if len(data) <= PIECE:
            keys, starts = word_keys(data, cuts, long_keys)
            yield text_keys[low:high], np.diff(np.searchsorted(starts, cuts)), keys
        else:  # one long text
            parts, first = [], 0
            while first < len(data):
                end = min(first + PIECE, len(data))
                while end < len(data) and not _BLANK[data[end]]:
                    ahead = np.flatnonzero(_BLANK[data[end : end + PIECE]])
                    end = end + int(ahead[0]) if len(ahead) else min(end + PIECE, len(data))
                parts.append(word_keys(data[first:end], np.zeros(1, np.int64), long_keys)[0])
                first = end
            keys = np.concatenate(parts)
            yield text_keys[low:high], np.array([len(keys)]), keys


def lines(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """text_keys, sizes and the lines of texts that have words, one after another: ``order - 1`` begins, the words, the end.

    A long text is given in parts that overlap by a context.
    """
    begin, end = (np.uint64(int.from_bytes(blake2b(w, digest_size=8).digest(), "little")) for w in (BEGIN, END))
    long_keys = Keys()
    for batch in batches:
        for text_keys, many, keys in _text_keys_and_words(batch, long_keys):
            text_keys, many = text_keys[many > 0], many[many > 0]
            if not len(many):
                continue
            sizes = many + order
            ends = np.cumsum(sizes)
            line = np.full(ends[-1], begin, np.uint64)
            line[np.arange(len(keys)) + np.repeat(ends - 1 - np.cumsum(many), many)] = keys
            line[ends - 1] = end
            if len(many) == 1 and len(line) > CHUNK:
                for low in range(0, len(line) - order + 1, CHUNK - order + 1):
                    part = line[low : low + CHUNK]
                    yield text_keys, np.array([len(part)]), part
            else:
                yield text_keys, sizes, line


def gram_starts(sizes: np.ndarray, order: int) -> np.ndarray:
    """Where the n-grams of lines of these sizes begin."""
    inside = np.ones(int(sizes.sum()), bool)
    ends = np.cumsum(sizes)
    for back in range(1, order):
        inside[ends - back] = False
    return np.flatnonzero(inside)


def names(order: int) -> list[str]:
    return [f"w{i}" for i in range(1, order + 1)]


def word_grams(docs: DataFrame, order: int = WORD_ORDER) -> DataFrame:
    """text_key, w1, ...: the n-gram that ends in each word of every text of ``docs`` (text), and in its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text_keys, sizes, line in lines(batches, order):
            starts, own, signed = gram_starts(sizes, order), np.repeat(text_keys, sizes), line.view(np.int64)
            for low in range(0, len(starts), ROWS):
                at = starts[low : low + ROWS]
                columns = [own[at], *[signed[at + i] for i in range(order)]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["text_key", *names(order)])

    return texts_of(docs).mapInArrow(run, ", ".join(f"{c} long" for c in ["text_key", *names(order)]))


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("text").isNotNull()).select(F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("text"))


def half_of(text_key: str) -> Column:
    return F.pmod(F.col(text_key), F.lit(2))


def count_tables(grams: DataFrame, order: int) -> list[DataFrame]:
    """For each order 1, 2, ...: the n-grams of the corpus, n0 and n1: occurrences in a half for the greatest, kinds of words before them for the others."""
    words = names(order)
    whole = grams.groupBy(*words).agg(*[F.count_if(half_of("text_key") == h).alias(f"n{h}") for h in HALVES])
    tables = [pin(whole, "grams")]
    for low in range(1, order):
        shorter = tables[0].groupBy(*words[low:]).agg(*[F.count_if(F.col(f"n{h}") > 0).alias(f"n{h}") for h in HALVES])
        tables.insert(0, pin(shorter, "grams"))
    return tables


def discounts_of(n: list[int]) -> np.ndarray:
    """What is taken off counts of 1, 2 and more, from how many counts are 1, 2, 3 and 4; fixed values where these don't tell."""
    if not all(n):
        return np.array([0.5, 1.0, 1.5])
    y = n[0] / (n[0] + 2 * n[1])
    return np.clip([k + 1 - (k + 2) * y * n[k + 1] / n[k] for k in range(3)], 0.0, [1.0, 2.0, 3.0])


def probabilities(tables: list[DataFrame]) -> DataFrame:
    """w1, ..., p0, p1: the probability of every n-gram's last word after the others, by the model of each half."""
    order = len(tables)
    below = {h: F.lit(1.0 / (tables[0].count() + 1)) for h in HALVES}
    lower = None
    for at, table in enumerate(tables):
        gram = names(order)[order - 1 - at :]
        counted = table.agg(*[F.count_if(F.col(f"n{h}") == k).alias(f"{h}_{k}") for h in HALVES for k in (1, 2, 3, 4)]).first()
        off = {h: [max(float(x), LEAST_OFF) for x in discounts_of([counted[f"{h}_{k}"] for k in (1, 2, 3, 4)])] for h in HALVES}
        sums = {}
        for h in HALVES:
            n = F.col(f"n{h}")
            sums |= {f"all{h}": F.sum(n)} | {f"{h}_{k}": F.count_if(n >= 3 if k == 3 else n == k) for k in (1, 2, 3)}
        if at:
            # One row an n-gram, however often it occurs: a context has as many as words follow it.
            context = Window.partitionBy(*gram[:-1])
            joined = table.select("*", *[x.over(context).alias(c) for c, x in sums.items()])
        else:
            joined = table.crossJoin(table.agg(*[x.alias(c) for c, x in sums.items()]))
        left = {h: sum((F.col(f"{h}_{k}") * F.lit(off[h][k - 1]) for k in (1, 2, 3)), F.lit(0.0)) for h in HALVES}
        joined = joined.select(*gram, *[c for h in HALVES for c in (f"n{h}", f"all{h}", left[h].alias(f"left{h}"))])
        if lower is not None:
            joined = joined.join(lower, gram[1:])
            below = {h: F.col(f"p{h}") for h in HALVES}
        own = []
        for h in HALVES:
            n, whole = F.col(f"n{h}"), F.col(f"all{h}")
            taken = F.when(n >= 3, off[h][2]).when(n == 2, off[h][1]).otherwise(off[h][0])
            p = (F.greatest(n - taken, F.lit(0.0)) + F.col(f"left{h}") * below[h]) / whole
            own.append(F.when(whole > 0, p).otherwise(below[h]).alias(f"p{h}"))
        lower = joined.select(*gram, *own)
    return lower


def squeezed(*lists: np.ndarray) -> bytes:
    """Lists of whole numbers from 0, each by the planes of its bytes, compressed."""
    out = []
    for values in lists:
        values = np.ascontiguousarray(values, np.uint64)
        width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
        data = _ZSTD.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes(), asbytes=True) if width else b""
        out += [np.array([len(values), width, len(data)], "<i8").tobytes(), data]
    return b"".join(out)


def unsqueezed(data: bytes) -> list[np.ndarray]:
    """The lists, unsigned, each as narrow as its numbers."""
    out, at = [], 0
    while at < len(data):
        many, width, size = np.frombuffer(data, "<i8", 3, at).tolist()
        at += 24
        wide = next(w for w in (1, 2, 4, 8) if w >= width)
        values = np.zeros((many, wide), np.uint8)
        if width:
            planes = _ZSTD.decompress(data[at : at + size], many * width, asbytes=True)
            values[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, many).T
        out.append(values.reshape(-1).view(f"<u{wide}"))
        at += size
    return out


def _range_of(keys: np.ndarray, many: int) -> np.ndarray:
    """Which of ``many`` equal ranges of all keys; rises with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(many) >> np.uint64(32)).astype(np.int64)


def _packed(columns: list[np.ndarray], kinds: list[int]) -> np.ndarray:
    """One number for each row, that sorts as the rows do; ``kinds``: each column's numbers are less."""
    code, wide = columns[0].astype(np.uint64), (kinds[0] - 1).bit_length()
    for column, kind in zip(columns[1:], kinds[1:]):
        bits = (kind - 1).bit_length()
        if wide + bits > 64:
            held, code = np.unique(code, return_inverse=True)
            code, wide = code.astype(np.uint64), (len(held) - 1).bit_length()
        code, wide = (code << np.uint64(bits)) | column.astype(np.uint64), wide + bits
    return code


def _starts(columns: list[np.ndarray]) -> np.ndarray:
    """Where sorted rows are others than before."""
    change = np.ones(len(columns[0]), bool)
    change[1:] = False
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def _distinct(columns: list[np.ndarray], kinds: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows, sorted, and how often each comes."""
    bits = [(k - 1).bit_length() for k in kinds]
    if sum(bits) > 64:
        at = np.lexsort(columns[::-1])
        columns = [c[at] for c in columns]
        first = _starts(columns)
        return [c[first] for c in columns], np.diff(first, append=len(at))
    code = _packed(columns, kinds)
    code.sort()
    first = _starts([code])
    n, code, out = np.diff(first, append=len(code)), code[first], []
    for wide in bits[::-1]:
        out.append((code & np.uint64((1 << wide) - 1)).astype(np.int32))
        code >>= np.uint64(min(wide, 63))
    return out[::-1], n


def _numbered(columns: list[np.ndarray], kinds: list[int]) -> np.ndarray:
    """Each row's number among the distinct rows."""
    many = len(columns[0])
    if sum((k - 1).bit_length() for k in [*kinds, many]) > 64:
        return np.unique(_packed(columns, kinds), return_inverse=True)[1]
    code = _packed([*columns, np.arange(many)], [*kinds, many])
    code.sort()
    low = np.uint64((many - 1).bit_length())
    number, own = np.zeros(many, np.int64), code >> low
    number[(code & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)] = np.cumsum(np.concatenate([[False], own[1:] != own[:-1]]))
    return number


@dataclass
class Deal:
    """Which bucket an n-gram is in: ``base`` ranges of its last word but one, and ``splits`` buckets for each of the ``hot`` such words (sorted), by the word before.

    ``common`` (sorted): words that are written by their number there.
    """

    base: int
    hot: np.ndarray
    splits: np.ndarray
    common: np.ndarray

    def __post_init__(self) -> None:
        self.ends = self.base + np.cumsum(self.splits)
        self.buckets = int(self.base + self.splits.sum())

    def buckets_of(self, line: np.ndarray, starts: np.ndarray, order: int) -> np.ndarray:
        word = line[starts + max(order - 2, 0)]
        out = _range_of(word, self.base)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, word), len(self.hot) - 1)
            held = np.flatnonzero(self.hot[at] == word)
            at = at[held]
            own = (line[starts[held] + order - 3] >> np.uint64(32)) * self.splits[at].astype(np.uint64) >> np.uint64(32)
            out[held] = (self.ends - self.splits)[at] + own.astype(np.int64)
        return out

    def written(self, words: np.ndarray) -> list[np.ndarray]:
        """Sorted words as steps of whole numbers: the common ones' numbers, the others."""
        at = np.searchsorted(self.common, words)
        known = np.zeros(len(words), bool)
        known[at < len(self.common)] = self.common[at[at < len(self.common)]] == words[at < len(self.common)]
        return [np.diff(at[known], prepend=0), np.diff(words[~known], prepend=np.uint64(0))]

    def read(self, known: np.ndarray, others: np.ndarray) -> np.ndarray:
        return np.sort(np.concatenate([self.common[np.cumsum(known, dtype=np.int64)], np.cumsum(others, dtype=np.uint64)]))

    def hot_of(self, bucket: int) -> int:
        """Number of the hot word whose bucket it is, or -1."""
        return -1 if bucket < self.base else int(np.searchsorted(self.ends, bucket, "right"))


def deal_for(docs: DataFrame, order: int) -> Deal:
    """As many buckets as the bytes of the texts ask for. Frequent words are looked for in one of ``SAMPLE`` texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, held = 0, [np.zeros(0, np.uint64)]

        def sizes() -> Iterator[pa.RecordBatch]:
            nonlocal size
            for batch in batches:
                size += pc.sum(batch.column(2)).as_py() or 0
                yield batch.filter(pc.is_valid(batch.column(1)))

        for _, long, line in lines(sizes(), 2):
            held.append(line[gram_starts(long, 2)])
        words, n = np.unique(np.concatenate(held), return_counts=True)
        # The last row is no word's, it has the bytes.
        columns = np.append(words.view(np.int64), 0), np.append(n, 0), np.append(np.zeros(len(n), np.int64), size)
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["word", "n", "bytes"])

    texts = texts_of(docs)
    read = texts.select("text_key", F.when(F.pmod("text_key", F.lit(SAMPLE)) == 0, F.col("text")).alias("text"), F.octet_length("text").cast("long").alias("bytes"))
    with owned_pins(docs.sparkSession):
        found = pin(read.mapInArrow(run, "word long, n long, bytes long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")), "sample")
        size, many = found.agg(F.sum("bytes"), F.sum("n")).first()
        grams, many, least, room = (size or 0) // BYTES_A_WORD, many or 0, 1 << 62, COMMON
        for n, words in sorted(map(tuple, found.where("n > 0").groupBy("n").count().collect()), reverse=True):
            room -= words
            least = n if room >= 0 else least
        often = found.where(F.col("n") >= least).select("word", "n").toArrow()
    words, n = often.column("word").to_numpy().astype(np.int64).view(np.uint64), often.column("n").to_numpy().astype(np.int64)
    at = np.argsort(words)
    words, likely = words[at], (n[at] * (grams / max(many, 1))).astype(np.int64)
    hot = 2 * likely > BUCKET if order > 2 else np.zeros(len(words), bool)
    return Deal(1 + max(0, grams - int(likely[hot].sum())) // BUCKET, words[hot], 1 + likely[hot] // BUCKET, words)


def _sorting(order: int) -> list[int]:
    """Places of an n-gram's words as blocks are sorted: the bucket's word first."""
    return [max(order - 2, 0), *([order - 1] if order > 1 else []), *range(order - 3, -1, -1)]


def packed(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]], order: int, deal: Deal, share: int, shares: int, by_text: bool) -> Iterator[tuple[int, bytes]]:
    """The blocks of some lines, with their buckets: see ``gram_blocks``."""
    sizes, line = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
    text_keys, text = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
    kinds = len(text_keys) if by_text else 2
    tag = np.repeat(text.astype(np.int32) if by_text else (text_keys & 1)[text].astype(np.int32), sizes)
    starts = gram_starts(sizes, order)
    bucket_of = deal.buckets_of(line, starts, order)
    chosen = np.flatnonzero(bucket_of % shares == share)
    bucket_of = bucket_of[chosen]
    at = np.argsort(bucket_of.astype(np.uint16 if deal.buckets < 1 << 16 else np.uint32), kind="stable")
    starts, ends = starts[chosen[at]], np.cumsum(np.bincount(bucket_of, minlength=deal.buckets))
    keys = text_keys.view(np.uint64) if by_text else np.zeros(0, np.uint64)
    for bucket in np.unique(bucket_of):
        rows = starts[ends[bucket - 1] if bucket else 0 : ends[bucket]]
        words, ids = np.unique(np.concatenate([line[rows + i] for i in _sorting(order)]), return_inverse=True)
        (first, *others), n = _distinct([*ids.reshape(order, -1), tag[rows]], [len(words)] * order + [kinds])
        yield int(bucket), squeezed(*deal.written(words), keys, np.diff(first, prepend=0), *others, n - 1)


def gram_blocks(docs: DataFrame, order: int, dealt: Broadcast[Deal], share: int, shares: int, by_text: bool) -> DataFrame:
    """bucket, block: the n-grams of some texts that are in a bucket of this share, sorted and packed.

    A block has the keys of its words, texts' keys, and for each n-gram its words' numbers, the text's number and how
    often it is there; without ``by_text`` a half's number and how often the n-gram is in that half's texts.
    """

    def given(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for bucket, block in packed(held, order, dealt.value, share, shares, by_text):
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([block], pa.binary())], ["bucket", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for line in lines(batches, order):
            if held and size + len(line[2]) > CHUNK:
                yield from given(held)
                held, size = [], 0
            held.append(line)
            size += len(line[2])
        if held:
            yield from given(held)

    return texts_of(docs).mapInArrow(run, "bucket int, block binary")


@dataclass
class Grams:
    """A bucket's distinct n-grams. ``counts`` by order in each half, ``shorter``: the number of each without the first
    word, ``words``: keys of the last words. By text also ``context``, the number of all words but the last, the keys
    of the ``texts``, and ``rows``: a text's number, an n-gram's and how often it is there."""

    counts: dict[int, list[np.ndarray]]
    context: dict[int, np.ndarray]
    shorter: dict[int, np.ndarray]
    words: np.ndarray
    texts: np.ndarray
    rows: tuple[np.ndarray, np.ndarray, np.ndarray]

    @classmethod
    def read(cls, blocks: list[bytes], order: int, deal: Deal, by_text: bool) -> Grams:
        parts = [[deal.read(known, others), *more] for known, others, *more in map(unsqueezed, blocks)]
        words, number = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        texts, text = np.unique(np.concatenate([p[1].astype(np.uint64).view(np.int64) for p in parts]), return_inverse=True)
        columns, tags, low, from_text = [[] for _ in range(order)], [], 0, 0
        for part in parts:
            own = number[low : low + len(part[0])].astype(np.int32)
            part[2] = np.cumsum(part[2])
            for i, c in enumerate(_sorting(order)):
                columns[c].append(own[part[2 + i]])
            tags.append(text[from_text : from_text + len(part[1])].astype(np.int32)[part[-2]] if by_text else part[-2].astype(np.int32))
            low, from_text = low + len(part[0]), from_text + len(part[1])
        # From the last word to the first, as shorter n-grams then stand together.
        columns, tag = [np.concatenate(c) for c in columns[::-1]], np.concatenate(tags)
        n = np.concatenate([p[-1] for p in parts]).astype(np.int64) + 1
        del parts, tags, number, text
        kinds, rows = [len(words)] * order, None
        if by_text:
            code = _packed(columns, kinds)
            at = np.argsort(code)
            first = _starts([code[at]])
            del code
            tag, n = tag[at], n[at]
            rows = tag, np.repeat(np.arange(len(first), dtype=np.int32), np.diff(first, append=len(at))), n
            columns = [c[at[first]] for c in columns]
            half = texts[tag] & 1
        else:
            if (n > 1).any():
                columns, tag = [np.repeat(c, n) for c in columns], np.repeat(tag, n)
            (*columns, half), n = _distinct([*columns, tag], [*kinds, 2])
            first = _starts(columns)
            columns = [c[first] for c in columns]
        counts, context, shorter = {order: [np.add.reduceat(np.where(half == h, n, 0), first) for h in HALVES]}, {}, {}
        for m in range(order, 1, -1):
            if by_text:
                context[m] = _numbered(columns[1:m], kinds[1:m])
            start = _starts(columns[: m - 1])
            shorter[m] = np.repeat(np.arange(len(start)), np.diff(start, append=len(columns[0])))
            counts[m - 1] = [np.add.reduceat((counts[m][h] > 0).astype(np.int64), start) for h in HALVES]
            columns = [c[start] for c in columns]
        return cls(counts, context, shorter, words[columns[0]], texts, rows)


def tally(counts: list[np.ndarray]) -> list[int]:
    """How many counts are 1, 2, 3 and 4, for each half."""
    return [int((counts[h] == k).sum()) for h in HALVES for k in (1, 2, 3, 4)]


def _rows(blobs: list[bytes], **columns: list) -> pa.Table:
    return pa.table({k: pa.array(v, pa.int32()) for k, v in columns.items()} | {"data": pa.array(blobs, pa.binary())})


def counted(blocks: DataFrame, order: int, held: Broadcast[Deal], ranges: int) -> DataFrame:
    """bucket, range, data: for each range of words the bucket's last words and their counts in it; with range -1 how often counts come, by order from 2 on.

    Pairs with a hot word are in several buckets. Their counts are given in further ranges, ``ranges`` for each hot word, and the single words with none.
    """

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        own, hot = Grams.read(table.column("block").to_pylist(), order, held.value, False), held.value.hot_of(bucket)
        tallies = [np.zeros(8) if m == 2 and hot >= 0 else np.array(tally(own.counts[m])) for m in range(2, order + 1)]
        out, where = [squeezed(*tallies)], [-1]
        within = np.searchsorted(_range_of(own.words, ranges), np.arange(ranges + 1))
        for to, (low, high) in enumerate(zip(within[:-1], within[1:])):
            keys = np.diff(own.words[low:high], prepend=np.uint64(0))
            if hot >= 0:
                out.append(squeezed(keys, *[own.counts[2][h][low:high] for h in HALVES]))
                where.append((1 + hot) * ranges + to)
            out.append(squeezed(keys, *[own.counts[1][h][low:high] * (hot < 0) for h in HALVES]))
            where.append(to)
        return _rows(out, bucket=[bucket] * len(out), range=where)

    return blocks.groupBy("bucket").applyInArrow(run, "bucket int, range int, data binary")


def summed(words: DataFrame, ranges: int) -> DataFrame:
    """bucket, range, data: the counts in all buckets of a bucket's words, in its order; with bucket -1 how many words, how often counts come, sums and kinds.

    For ranges of pairs also, with bucket -2 and the range of their last words, the pairs these words add to.
    """

    def run(table: pa.Table) -> pa.Table:
        parts = [unsqueezed(b) for b in table.column("data").to_pylist()]
        at = table.column("range")[0].as_py()
        keys = [np.cumsum(p[0], dtype=np.uint64) for p in parts]
        whole, number = np.unique(np.concatenate(keys), return_inverse=True)
        totals = [np.bincount(number, np.concatenate([p[1 + h] for p in parts]), len(whole)).astype(np.int64) for h in HALVES]
        ends = np.cumsum([len(k) for k in keys])
        out = [squeezed(*[totals[h][number[end - len(k) : end]] for h in HALVES]) for k, end in zip(keys, ends)]
        more = [x for h in HALVES for x in (totals[h].sum(), *[((totals[h] >= 3) if k == 3 else (totals[h] == k)).sum() for k in (1, 2, 3)])]
        out.append(squeezed(np.array([len(whole), *tally(totals), *more])))
        buckets, where = [*table.column("bucket").to_pylist(), -1], [at] * len(out)
        if at >= ranges:
            out.append(squeezed(np.diff(whole, prepend=np.uint64(0)), *[totals[h] > 0 for h in HALVES]))
            buckets, where = [*buckets, -2], [*where, at % ranges]
        return _rows(out, bucket=buckets, range=where)

    return words.groupBy("range").applyInArrow(run, "bucket int, range int, data binary")


def gram_probability(n: np.ndarray, whole: np.ndarray, left: np.ndarray, below: np.ndarray, off: list[float]) -> np.ndarray:
    """Interpolated modified Kneser-Ney; what the half has never seen as a context is left to the shorter n-gram."""
    taken = np.where(n >= 3, off[2], np.where(n == 2, off[1], off[0]))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(whole > 0, (np.maximum(n - taken, 0.0) + left * below) / whole, below)


def scored(
    blocks: DataFrame, totals: DataFrame, order: int, held: Broadcast[Deal], ranges: int, off: dict[int, list[list[float]]], kinds: int, sums: dict[int, list[list[int]]]
) -> DataFrame:
    """range, data: what the n-grams of these blocks add to the texts of a range of keys, in steps of a nat, and how many they are.

    ``sums`` of single words (at -1) and of each hot word's pairs: all counts of a half, and how many are 1, 2 and more.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _rows([], range=[])
        own, hot = Grams.read(left.column("block").to_pylist(), order, held.value, True), held.value.hot_of(left.column("bucket")[0].as_py())
        given = sorted(zip(right.column("range").to_pylist(), right.column("data").to_pylist()))
        for m in (1, 2) if hot >= 0 else (1,):
            lists = [unsqueezed(data) for at, data in given if (at >= ranges) == (m == 2)]
            own.counts[m] = [np.concatenate(c).astype(np.int64) for c in zip(*lists)]
        lost = []
        for h in HALVES:
            p = 1.0 / (kinds + 1)
            for m in range(1, order + 1):
                n = own.counts[m][h]
                if m == 1 or (m == 2 and hot >= 0):
                    whole, *often = sums[-1 if m == 1 else hot][h]
                else:
                    at = own.context[m]
                    whole = np.bincount(at, n)[at]
                    often = [np.bincount(at, n >= 3 if k == 3 else n == k)[at] for k in (1, 2, 3)]
                rest = 0.0 + often[0] * off[m][h][0] + often[1] * off[m][h][1] + often[2] * off[m][h][2]
                p = gram_probability(n, whole, rest, p if m == 1 else p[own.shorter[m]], off[m][h])
            lost.append(np.rint(-np.log(p) * SCALE).astype(np.int64))
        text, gram, n = own.rows
        # Sums stay below 2**53: whole in double.
        steps = np.bincount(text, np.where(own.texts[text] & 1 == 0, lost[1][gram], lost[0][gram]) * n, len(own.texts))
        many = np.bincount(text, n, len(own.texts)).astype(np.int64)
        there = np.flatnonzero(many)
        there = there[np.argsort(own.texts[there].view(np.uint64))]
        texts = own.texts[there].view(np.uint64)
        ends = np.searchsorted(_range_of(texts, ranges), np.arange(ranges + 1))
        parts = [slice(low, high) for low, high in zip(ends[:-1], ends[1:])]
        out = [squeezed(np.diff(texts[part], prepend=np.uint64(0)), steps[there[part]], many[there[part]]) for part in parts]
        return _rows(out, range=list(range(ranges)))

    pairs = blocks.groupBy("bucket").cogroup(totals.groupBy("bucket"))
    return pairs.applyInArrow(run, "range int, data binary")


def text_sums(parts: DataFrame) -> DataFrame:
    """text_key, lost, many: sums over what buckets add to the texts of a range."""

    def run(table: pa.Table) -> pa.Table:
        lists = [unsqueezed(data) for data in table.column("data").to_pylist()]
        texts, number = np.unique(np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in lists]), return_inverse=True)
        sums = [np.bincount(number, np.concatenate([x[i] for x in lists]), len(texts)).astype(np.int64) for i in (1, 2)]
        return pa.table({c: pa.array(x) for c, x in zip(("text_key", "lost", "many"), (texts.view(np.int64), *sums))})

    return parts.groupBy("range").applyInArrow(run, "text_key long, lost long, many long")


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, what an action has exchanged is removed when the action ends."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def fitted(docs: DataFrame, order: int, held: Broadcast[Deal], ranges: int) -> tuple[DataFrame, dict[int, list[list[float]]], int, dict[int, list[list[int]]]]:
    """The counts of single words and of hot words' pairs for every bucket, the discounts by order, how many words there are, and the sums for ``scored``."""
    deal, words = held.value, None
    with owned_pins(docs.sparkSession) as keep:
        # The more buckets, the more bytes an n-gram, as blocks share fewer words.
        shares = min(max(2, deal.buckets.bit_length() // 4), deal.buckets)
        for share in range(shares):
            part = pin(counted(gram_blocks(docs, order, held, share, shares, False), order, held, ranges), "words")
            words = part if words is None else words.unionByName(part)
        totals, single = None, words.where(F.col("range").between(0, ranges - 1))
        if len(deal.hot):
            totals = keep(summed(words.where(F.col("range") >= ranges), ranges), "totals")
            single = single.unionByName(totals.where("bucket = -2"))
        part = keep(summed(single, ranges), "totals")
        totals = part if totals is None else totals.where("bucket > -2").unionByName(part)
        tallies = np.zeros((order + 1, 8), np.int64)
        for row in words.where("range < 0").collect():
            for m, n in enumerate(unsqueezed(row.data), 2):
                tallies[m] += n.astype(np.int64)
    whole = {at: np.zeros(17, np.int64) for at in range(-1, len(deal.hot))}
    for row in totals.where("bucket = -1").collect():
        whole[row.range // ranges - 1] += unsqueezed(row.data)[0].astype(np.int64)
    tallies[1] = whole[-1][1:9]
    if order > 1:
        tallies[2] += sum((x[1:9] for at, x in whole.items() if at >= 0), np.zeros(8, np.int64))
    off = {m: [[max(float(x), LEAST_OFF) for x in discounts_of(tallies[m][4 * h :][:4].tolist())] for h in HALVES] for m in range(1, order + 1)}
    return totals, off, int(whole[-1][0]), {at: [x[9 + 4 * h :][:4].tolist() for h in HALVES] for at, x in whole.items()}


def word_surprises(docs: DataFrame, order: int = WORD_ORDER) -> DataFrame:
    """text_key, word_surprise: the mean -log p of the words and the end of every distinct text that has words, by the other half's model."""
    spark = docs.sparkSession
    with owned_pins(spark) as keep, _shuffles_removed(spark):
        deal = deal_for(docs, order)
        held, ranges = spark.sparkContext.broadcast(deal), 1 + deal.buckets // 4
        totals, off, kinds, sums = fitted(docs, order, held, ranges)
        shares, found = min(max(2, deal.buckets.bit_length() // 3), deal.buckets), None
        for share in range(shares):
            asked = totals.where((F.col("bucket") >= 0) & (F.col("bucket") % shares == share))
            part = scored(gram_blocks(docs, order, held, share, shares, True), asked, order, held, ranges, off, kinds, sums)
            part = pin(text_sums(part), "scored")
            found = part if found is None else found.unionByName(part)
        surprise = (F.sum("lost") / F.sum("many") / SCALE).alias("word_surprise")
        return keep(found.groupBy("text_key").agg(surprise), "word_surprise")
