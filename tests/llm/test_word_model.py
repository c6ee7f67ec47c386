"""Word n-grams against plain Python: probabilities by their recursive definition, halves, verdicts of op12."""

import math
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockrisk.llm import word_model
from stockrisk.llm.perplexity import judge, rules_report
from stockrisk.llm.queries import op12_ngram_rules
from stockrisk.llm.word_model import count_tables, probabilities, word_grams, word_surprises


def plain_words(text):
    return re.findall("[^\x20\t\n\x0b\x0c\r]+", text or "")


class PlainWords:
    def __init__(self, texts, order, kinds):
        self.order, self.kinds = order, kinds
        self.counts = {order: Counter(g for t in texts for g in self.grams(t))}
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.off, self.after = {}, {}
        for k, counts in self.counts.items():
            n = [sum(c == j for c in counts.values()) for j in (1, 2, 3, 4)]
            y = n[0] / (n[0] + 2 * n[1]) if all(n) else None
            self.off[k] = [min(max(j - (j + 1) * y * n[j] / n[j - 1], 0.1), j) for j in (1, 2, 3)] if all(n) else [0.5, 1.0, 1.5]
            self.after[k] = defaultdict(list)
            for g, c in counts.items():
                self.after[k][g[:-1]].append(c)

    def grams(self, text):
        words = plain_words(text)
        line = ["<"] * (self.order - 1) + words + [">"]
        return [tuple(line[i : i + self.order]) for i in range(len(words) + 1)] if words else []

    def p(self, gram):
        if not gram:
            return 1 / (self.kinds + 1)
        k, own = len(gram), self.counts[len(gram)][gram]
        held = self.after[k].get(gram[:-1])
        if not held:
            return self.p(gram[1:])
        left = sum(self.off[k][min(c, 3) - 1] for c in held)
        return ((max(own - self.off[k][min(own, 3) - 1], 0) if own else 0) + left * self.p(gram[1:])) / sum(held)


def plain_surprises(texts, half, order):
    """text -> mean -log p by the other half's model; ``half`` of each text, texts with repeats."""
    kinds = len({w for t in texts for w in plain_words(t)} | {">"})
    models = [PlainWords([t for t in texts if half[t] == h], order, kinds) for h in (0, 1)]
    out = {}
    for t in set(texts):
        asked = models[0].grams(t)
        if asked:
            out[t] = -sum(math.log(models[1 - half[t]].p(g)) for g in asked) / len(asked)
    return out


def halves(docs):
    found = docs.select("text", F.xxhash64("text").alias("key")).distinct().collect()
    return {r.text: r.key % 2 for r in found}, {r.key: r.text for r in found if r.text is not None}


def sentences(seed, many=12):
    """Prose of few turns: each word has five that may follow. All begin and end alike, so where words meet tells spelling nothing."""
    rng, follow = random.Random(seed), random.Random(5)
    words = ["ka" + "".join(follow.choices("bdgklmnprst" if i % 2 else "aeiou", k=1)[0] for i in range(follow.randint(2, 5))) + "to" for _ in range(60)]
    after = {w: follow.sample(words, 5) for w in words}
    word, out = rng.choice(words), []
    for _ in range(many * 8):
        out.append(word)
        word = rng.choice(after[word])
    return out


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_surprises(spark, order):
    texts = [" ".join(sentences(i, 2)) for i in range(20)] + [" ".join(sentences(0, 2))] * 3
    texts += [None, "", " \n", "one", "new words  only\nnew words", "日本 été \x1c a b", "z " * 300]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    half, by_key = halves(docs)
    got = {by_key[r.text_key]: r.word_surprise for r in word_surprises(docs, order).collect()}
    assert got == pytest.approx(plain_surprises(texts, half, order), abs=1e-6)


def test_probabilities_add_up(spark):
    docs = spark.createDataFrame([(" ".join(sentences(i, 3)),) for i in range(12)], "text string")
    alone = probabilities(count_tables(word_grams(docs, 1), 1)).agg(F.sum("p0"), F.sum("p1")).first()
    assert all(0.95 < p < 1 for p in alone)  # what lacks is the share of a word never seen
    after = probabilities(count_tables(word_grams(docs, 2), 2)).groupBy("w1").agg(F.sum("p0"), F.sum("p1")).collect()
    assert after and all(0 < p < 1 for r in after for p in r[1:])


def test_ngrams_are_not_bounded_by_the_model(spark):
    # The classes of bytes have one n-gram of order 4 for all of these.
    docs = spark.createDataFrame([("".join(map(chr, (0x4E00 + i, 0x4E00 + j, 0x4E00 + i))),) for i in range(60) for j in range(60)], "text string")
    tables = count_tables(word_grams(docs), 3)
    assert tables[0].count() == 3601 and tables[2].agg(F.sum(F.col("n0") + F.col("n1"))).first()[0] == 7200


def test_long_texts_and_full_tables(spark, monkeypatch):
    docs = spark.createDataFrame([(" ".join(sentences(1, 40)),), ("a b",), ("c",)], "text string")
    order = ["text_key", "w1", "w2", "w3"]
    whole = sorted(map(tuple, word_grams(docs).select(order).collect()))
    run = word_grams(docs)
    monkeypatch.setattr(word_model, "ROWS", 7)
    monkeypatch.setattr(word_model, "KEYS_HELD", 3)
    assert len(whole) == 321 + 3 + 2 and sorted(map(tuple, word_grams(docs).select(order).collect())) == whole
    assert sorted(map(tuple, run.select(order).collect())) == whole


def test_words_out_of_order_are_rejected(spark, tmp_path):
    good = [sentences(i) for i in range(120)]
    salad = list(good[3])
    random.Random(1).shuffle(salad)
    rows = [(i, "en", " ".join(words)) for i, words in enumerate([*good, salad, good[0], good[0]])] + [(200, "en", None), (None, None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").selectExpr("*", "1 AS word_high", "2 AS text_key", "3 AS w1")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spelling = {r.doc_id: r.kept for r in rules_report(docs).collect()}
    got = op12_ngram_rules(spark, str(tmp_path)).collect()
    kept = {r.doc_id: r.kept for r in got}
    assert len(got) == len(rows) and spelling[120]  # its words are spelled as any
    assert not kept[120] and all(kept[i] for i in [*range(120), 121, 122] if spelling[i]) and sum(spelling.values()) > 115
    assert kept[200] is False and kept[None] is False
    assert judge(docs.limit(0), word_order=3).count() == 0


@pytest.mark.parametrize("order", [2, 3, 4])
def test_small_buckets_and_frequent_words(spark, monkeypatch, order):
    rng = random.Random(order)
    texts = [" ".join(w if rng.random() < 0.6 else "the" for w in sentences(i, 3)) for i in range(25)] + ["the " * 90, "the end", "", None] * 2
    texts += ["x" * 60 + " " + "x" * 59 + "y the", "a b the " + "é" * 40]  # longer than bytes have numbers
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    half, by_key = halves(docs)
    monkeypatch.setattr(word_model, "BUCKET", 40)
    monkeypatch.setattr(word_model, "SAMPLE", 1)
    deal = word_model.deal_for(docs, order)
    assert deal.base > 3 and (len(deal.hot) > 0 and deal.splits.max() > 3 if order > 2 else not len(deal.hot))
    got = {by_key[r.text_key]: r.word_surprise for r in word_surprises(docs, order).collect()}
    assert got == pytest.approx(plain_surprises(texts, half, order), abs=1e-6)


def test_blocks_hold_the_ngrams_of_the_tables(spark):
    docs = spark.createDataFrame([(" ".join(sentences(i, 2)),) for i in range(9)] + [("z z z z z",)] * 2, "text string").repartition(2)
    common = np.unique(np.array([r.w1 for r in word_grams(docs, 1).limit(40).collect()], np.int64).view(np.uint64))
    deal = word_model.Deal(2, common[:0], np.array([], np.int64), common)
    held = spark.sparkContext.broadcast(deal)
    for by_text in (False, True):
        found = Counter()
        for share in (0, 1):
            for row in word_model.gram_blocks(docs, 3, held, share, 2, by_text).collect():
                assert row.bucket % 2 == share
                known, others, texts, middle, last, first, tag, n = word_model.unsqueezed(row.block)
                own, texts, middle = (deal.read(known, others).view(np.int64), texts.astype(np.uint64).view(np.int64), np.cumsum(middle))
                for a, b, c, t, k in zip(own[first], own[middle], own[last], texts[tag] if by_text else tag, n):
                    found[int(t) % 2 if by_text else int(t), int(a), int(b), int(c)] += int(k) + 1
        rows = word_grams(docs).collect()
        assert found == Counter((r.text_key % 2, r.w1, r.w2, r.w3) for r in rows)


def test_what_is_stored_stays_near_the_texts(spark, monkeypatch):
    rng, most = random.Random(3), [0]
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)]
    docs = spark.createDataFrame([(" ".join(rng.choices(words, k=200)),) for _ in range(400)], "text string").repartition(2)
    root, kept = spark.conf.get("spark.checkpoint.dir").removeprefix("file:"), word_model.pin

    def stored():
        return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(root) for f in files)

    def watched(df, *args):
        out = kept(df, *args)
        most[0] = max(most[0], stored())
        return out

    monkeypatch.setattr(word_model, "pin", watched)
    before = stored()
    assert word_surprises(docs).count() == 400
    assert 0 < most[0] - before < 400 * 200 * 7  # bytes of the texts
