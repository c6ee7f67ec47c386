"""Language identification in two steps: family, then the language within it.

Texts are profiles of hashed byte bigrams and trigrams of their letters.
Languages are grouped into families by the likeness of their mean profiles
(average linkage); one machine per family tells it from the others, and
within a family one-versus-one machines vote. All are linear support vector
machines fitted on about ``SAMPLE`` distinct documents of every language there
is, profiled by Spark, never from the held-out fold. A sample of up to
``DRIVER_ROWS`` rows is fitted by the driver. A larger one, of more languages,
stays in the shared folder: its mean profiles are gathered per language, the
families' machines descend by gradients that Spark sums in a tree, and each task
fits the machines inside one family.

Defined cases: a text that is NULL or has no letter is ``und`` with score 0;
with no labelled documents so is every text; with one language every other
text is that language, with score 1.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from stockrisk.llm.common import held_out
from stockrisk.llm.linear import descend, fit_svms
from stockrisk.sources.sinks import pin

BUCKETS = 4096
SAMPLE = 400  # documents of each language, about
DRIVER_ROWS = 6000  # larger samples are fitted by tasks
UNKNOWN = "und"  # FIXED VALUE
_LETTER = re.compile(r"[^\W\d_]")
_FOLD = np.full(256, 32, dtype=np.uint32)  # anything but a letter is a blank
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_CHUNK = 1 << 18  # bytes counted at once


def profile(text: str) -> np.ndarray:
    """Unit vector of the square roots of a text's hashed bigram and trigram counts."""
    data = np.frombuffer(b" %b " % text.lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for low in range(0, len(data), _CHUNK):
        code = _FOLD[data[low : low + _CHUNK + 2]]
        code = code[(code != 32) | np.r_[True, code[:-1] != 32]]  # runs of blanks count once
        two = code[:-1] << 8 | code[1:]
        three = two[:-1] << 8 | code[2:]
        for grams, salt in ((two, np.uint32(0x9E3779B1)), (three, np.uint32(0x85EBCA77))):
            counts += np.bincount(grams * salt >> np.uint32(20), minlength=BUCKETS)
    weights = np.sqrt(counts)
    return weights / max(np.linalg.norm(weights), 1e-12)


@dataclass
class Model:
    families: list[list[str]]
    family_weights: np.ndarray
    pairs: list[tuple[int, int, int]]  # family, and the two languages' places in it, in order
    pair_weights: np.ndarray

    def predict(self, rows: np.ndarray) -> tuple[list[str], np.ndarray]:
        x = np.concatenate([rows, np.ones((len(rows), 1))], axis=1)
        margins = x @ self.family_weights
        family = margins.argmax(1)
        sure = 1 / (1 + np.exp(-4 * np.take_along_axis(margins, family[:, None], 1)[:, 0])) if len(self.families) > 1 else np.ones(len(x))
        wide = max(map(len, self.families))
        votes, weakest = np.zeros((len(x), wide)), np.full((len(x), wide), np.inf)
        firsts = np.searchsorted([f for f, _, _ in self.pairs], np.arange(len(self.families) + 1))
        for f in np.unique(family):
            own = family == f
            duel = x[own] @ self.pair_weights[:, firsts[f] : firsts[f + 1]]
            for k, (_, a, b) in enumerate(self.pairs[firsts[f] : firsts[f + 1]]):
                for place, margin in ((a, duel[:, k]), (b, -duel[:, k])):
                    votes[own, place] += (margin > 0) + 1e-3 * np.tanh(margin)  # votes, then margins
                    weakest[own, place] = np.minimum(weakest[own, place], margin)
        votes[np.arange(wide)[None, :] >= np.array([len(f) for f in self.families])[family][:, None]] = -np.inf
        best = votes.argmax(1)
        low = np.take_along_axis(weakest, best[:, None], 1)[:, 0]
        score = sure * 1 / (1 + np.exp(-4 * np.clip(low, -20, 20)))
        score = np.where(np.isinf(low), sure, score)
        return [self.families[f][p] for f, p in zip(family, best, strict=True)], score


def group_families(means: np.ndarray) -> list[list[int]]:
    """Average-linkage clusters of mean profiles: about the square root of their number, none above twice that size."""
    groups = [[i] for i in range(len(means))]
    root = len(means) ** 0.5
    sums = (means @ means.T).astype(np.float64)  # of likeness between groups
    while len(groups) > max(1, round(root)):
        sizes = np.array([len(g) for g in groups])
        like = sums / np.outer(sizes, sizes)
        like[(sizes[:, None] + sizes[None, :] > max(2 * root, 2)) | np.tri(len(groups), dtype=bool)] = -np.inf
        a, b = np.unravel_index(like.argmax(), like.shape)
        if np.isinf(like[a, b]):
            break
        groups[a] += groups.pop(b)
        sums[a] += sums[b]
        sums[:, a] += sums[:, b]
        sums = np.delete(np.delete(sums, b, 0), b, 1)
    return groups


def name_families(names: list[str], means: np.ndarray) -> list[list[str]]:
    groups = group_families(means / np.linalg.norm(means, axis=1, keepdims=True).clip(1e-12))
    return [[names[i] for i in sorted(g)] for g in groups]


def fit_model(rows: np.ndarray, langs: np.ndarray) -> Model | None:
    names = sorted(set(langs))
    if not names:
        return None
    means = np.array([rows[langs == n].mean(0) for n in names])
    families = name_families(names, means)
    of = {n: k for k, f in enumerate(families) for n in f}
    family = np.array([of[n] for n in langs])
    targets = np.where(family[:, None] == np.arange(len(families))[None, :], 1.0, -1.0)
    pairs = [(f, a, b) for f, langs_ in enumerate(families) for a, b in combinations(range(len(langs_)), 2)]
    duels = np.zeros((len(langs), len(pairs)))
    for k, (f, a, b) in enumerate(pairs):
        duels[langs == families[f][a], k] = 1
        duels[langs == families[f][b], k] = -1
    return Model(families, fit_svms(rows, targets), pairs, fit_svms(rows, duels))


def unpack(profiles: pd.Series) -> np.ndarray:
    return np.array([np.frombuffer(bytes(p), dtype=np.float16) for p in profiles]).reshape(len(profiles), BUCKETS).astype(np.float32)


def training_profiles(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """lang, key, profile of about ``sample`` distinct documents of every language, written to the shared folder."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select(
        "lang", F.xxhash64("doc_id", "text").alias("key"), "text"
    )
    counts = known.groupBy(F.col("lang").alias("_lang")).agg(F.countDistinct("key").alias("_count"))
    unit = F.shiftrightunsigned(F.xxhash64("key", F.lit(9)), 11) / F.lit(float(2**53))
    rated = known.join(pin(counts, "languages"), F.col("lang") == F.col("_lang"))
    drawn = rated.where(unit * F.col("_count") < sample).groupBy("lang", "key").agg(F.first("text").alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            read = frame[[_LETTER.search(t) is not None for t in frame["text"]]]
            packed = [profile(t).astype(np.float16).tobytes() for t in read["text"]]
            yield pd.DataFrame({"lang": read["lang"], "key": read["key"], "profile": packed})

    return pin(drawn.mapInPandas(run, "lang string, key long, profile binary"), "language_sample")


def train(docs: DataFrame, sample: int = SAMPLE, driver_rows: int = DRIVER_ROWS) -> Model | None:
    """The model of all languages; at most ``driver_rows`` profiles reach the driver."""
    profiles = training_profiles(docs, sample)
    counts = {r["lang"]: r["count"] for r in profiles.groupBy("lang").count().collect()}
    if max(sum(counts.values()), len(counts) ** 2) > driver_rows:  # machines grow with the languages
        return fit_spread(profiles, counts)
    rows = profiles.toPandas().sort_values(["lang", "key"])
    return fit_model(unpack(rows["profile"]), rows["lang"].to_numpy(dtype=object))


def fit_spread(profiles: DataFrame, counts: dict[str, int]) -> Model:
    """``fit_model`` on rows that stay with Spark: lang, profile; ``counts`` of each language."""

    def mean(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": frame["lang"].iloc[:1], "mean": [unpack(frame["profile"]).mean(0).tobytes()]})

    means = profiles.groupBy("lang").applyInPandas(mean, "lang string, mean binary").toPandas().sort_values("lang")
    names = means["lang"].tolist()
    families = name_families(names, np.array([np.frombuffer(bytes(m), dtype=np.float32) for m in means["mean"]]))
    of = {n: k for k, f in enumerate(families) for n in f}
    positive = np.array([sum(counts[n] for n in f) for f in families], dtype=np.float32)
    negative = np.maximum(sum(counts.values()) - positive, 1)
    sc = profiles.sparkSession.sparkContext
    middle = max(1, round(sc.defaultParallelism**0.5))

    def slope(w: np.ndarray) -> np.ndarray:
        held = sc.broadcast(w)

        def part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros_like(held.value)
            for whole in frames:
                for low in range(0, len(whole), 1024):
                    frame = whole.iloc[low : low + 1024]
                    x = np.concatenate([unpack(frame["profile"]), np.ones((len(frame), 1), np.float32)], axis=1)
                    own = np.array([of[n] for n in frame["lang"]])[:, None] == np.arange(len(families))[None, :]
                    sign = np.where(own, 1, -1).astype(np.float32)
                    weight = np.where(own, 0.5 / positive, 0.5 / negative).astype(np.float32)
                    total -= 2 * x.T @ (weight * sign * np.maximum(1 - sign * (x @ held.value), 0))
            yield pd.DataFrame({"slope": [total.tobytes()]})

        def total(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            first, summed = 0, np.zeros(w.size, np.float32)
            for frame in frames:
                first = int(frame["at"].iloc[0])
                for s in frame["slope"]:
                    summed = summed + np.frombuffer(bytes(s), dtype=np.float32)
            yield pd.DataFrame({"at": [first], "slope": [summed.tobytes()]})

        # A tree of sums, in one order always: the partitions, some, one. So one matrix a step reaches the driver.
        parts = profiles.mapInPandas(part, "slope binary").withColumn("at", F.spark_partition_id())
        some = parts.repartition(middle, F.col("at") % middle).sortWithinPartitions("at").mapInPandas(total, "at int, slope binary")
        summed = some.repartition(1).sortWithinPartitions("at").mapInPandas(total, "at int, slope binary").first()["slope"]
        held.destroy()
        return np.frombuffer(bytes(summed), dtype=np.float32).reshape(w.shape)

    # Profiles are unit vectors, and one more for the bias.
    family_weights = descend(slope, np.zeros((BUCKETS + 1, len(families)), np.float32), 4.0)

    def duels(key: tuple[int], frame: pd.DataFrame) -> pd.DataFrame:
        rows = {n: own for n, own in frame.groupby("lang")["profile"]}
        out = []
        for a, b in combinations(range(len(families[key[0]])), 2):
            one, other = unpack(rows[families[key[0]][a]]), unpack(rows[families[key[0]][b]])
            target = np.r_[np.ones(len(one)), -np.ones(len(other))][:, None]
            out.append((key[0], a, b, fit_svms(np.concatenate([one, other]), target)[:, 0].astype(np.float32).tobytes()))
        return pd.DataFrame(out, columns=["family", "a", "b", "weights"])

    family = F.broadcast(profiles.sparkSession.createDataFrame(list(of.items()), "lang string, family int"))
    fitted = profiles.join(family, "lang").groupBy("family").applyInPandas(duels, "family int, a int, b int, weights binary")
    pairs = {(r["family"], r["a"], r["b"]): r["weights"] for r in fitted.collect()}
    pair_weights = np.array([np.frombuffer(bytes(pairs[p]), dtype=np.float32) for p in sorted(pairs)]).reshape(len(pairs), BUCKETS + 1)
    return Model(families, family_weights, sorted(pairs), pair_weights.T)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1)."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("lang_pred string, score double")
    def found(texts: pd.Series) -> pd.DataFrame:
        lang, score = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
        at = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
        for low in range(0, len(at) if held.value else 0, 1024):
            own = at[low : low + 1024]
            lang[own], score[own] = held.value.predict(np.array([profile(texts.iloc[i]) for i in own]))
        return pd.DataFrame({"lang_pred": lang, "score": score})

    named = docs.drop("lang_pred", "score").withColumn("_found", found("text"))
    return named.select("*", "_found.*").drop("_found")


def language_report(docs: DataFrame) -> DataFrame:
    """The query's digest: doc_id, held_out, lang_pred, score."""
    model = train(docs)
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )
