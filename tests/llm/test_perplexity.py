"""Quality rules against plain Python: figures by string rules, the model by its recursive definition, bands by sorted lists."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from stockrisk.llm.perplexity import GRID, LEAST_REACH, ORDER, REACH, SYMBOLS, Model, count_grams, figures, fit, judge, many_figures, rules_report, symbol_codes, symbol_lines
from stockrisk.llm.word_model import Keys

SF = "/root/testdata/sf0.001"
BLANK = "\x20\t\n\x0b\x0c\r"


def plain_figures(text):
    words = re.findall(f"[^{BLANK}]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    held = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(f"[^{BLANK}]", x)]
    repeats = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), repeats, len(held)


def symbol(byte):
    c = chr(byte)
    if byte >= 0xC0 or byte >= 0x80:
        return "L" if byte >= 0xC0 else "C"
    if c in BLANK:
        return " "
    return c.lower() if c.isalpha() else "0" if c.isdigit() else "." if c in ".,;:'\"()-!?" else "#"


def plain_symbols(text):
    line = " ".join(re.findall(f"[^{BLANK}]+", text))
    return "".join(symbol(b) for b in line.encode()) + " " if line else ""


class PlainModel:
    """p(symbol | context) by the recursive definition, contexts as strings."""

    def __init__(self, texts):
        grams = Counter()
        for text in texts:
            line = " " * (ORDER - 1) + text
            grams.update(line[i : i + ORDER] for i in range(len(line) - ORDER + 1)) if text else None
        self.counts = {ORDER: grams}
        for order in range(ORDER - 1, 0, -1):
            self.counts[order] = Counter(g[1:] for g in self.counts[order + 1])
        self.off = {}
        for order, counts in self.counts.items():
            n = [sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)]
            y = n[0] / (n[0] + 2 * n[1]) if all(n) else None
            self.off[order] = [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0), k) for k in (1, 2, 3)] if all(n) else [0.5, 1.0, 1.5]
        self.followers = {o: defaultdict(list) for o in self.counts}
        for o, counts in self.counts.items():
            for g, c in counts.items():
                self.followers[o][g[:-1]].append(c)

    def p(self, gram):
        if not gram:
            return 1 / SYMBOLS
        order = len(gram)
        held = self.followers[order][gram[:-1]]
        if not held:
            return self.p(gram[1:])
        off = self.off[order]
        left = sum(min(off[min(c, 3) - 1], c) for c in held) / sum(held)
        own = self.counts[order][gram]
        return (max(own - off[min(own, 3) - 1], 0) / sum(held) if own else 0) + left * self.p(gram[1:])

    def surprise(self, text):
        line = " " * (ORDER - 1) + text
        return -sum(math.log(self.p(line[i : i + ORDER])) for i in range(len(line) - ORDER + 1)) / len(text) if text else None


def plain_judgement(rows):
    """doc_id -> figures, base_failed, kept, surprise; rows of (doc_id, lang, text)."""
    model = PlainModel([plain_symbols(t or "") for _, _, t in rows])
    seen = {t: model.surprise(plain_symbols(t or "")) for _, _, t in rows}
    out, passed = [], defaultdict(set)
    for doc_id, lang, text in rows:
        found = plain_figures(text or "")
        failed = found[0] < 50 or 100 * found[4] > 50 * found[0]
        out.append((doc_id, lang, found, failed, seen[text]))
        if not failed:
            passed[lang].add(text)
    sides = {}
    for lang, texts in passed.items():
        steps = sorted(math.floor(seen[t] * GRID + 1e-9) for t in texts)
        first, third = (steps[math.ceil(q * len(steps)) - 1] / GRID for q in (0.25, 0.75))
        wide = max(REACH * (third - first), LEAST_REACH)
        sides[lang] = first - wide, third + wide
    return [(d, *f, bad, not bad and sides[lang][0] <= s <= sides[lang][1]) for d, lang, f, bad, s in out]


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.lang, r.text) for r in docs.orderBy("doc_id").collect()]
    got = [tuple(r) for r in rules_report(docs).orderBy("doc_id").collect()]
    assert got == plain_judgement(rows)


@pytest.mark.parametrize("text", ["", " ", "a", "a b c a b c", "x x x x", "a\n\na\nb \nb\n\n", "\u00e9\u00df \u65e5\u672c\u8a9e #$|", "a\u00a0b \x1c c", "\tq\r\nq\x0b"])
def test_figures(text):
    assert figures(text.encode()) == plain_figures(text)
    codes = np.concatenate([np.zeros(0, np.int32), *symbol_codes(text.encode())])
    assert len(codes) == len(plain_symbols(text))


def test_probabilities_add_up_and_back_off():
    rng = np.random.default_rng(3)
    grams, counts = np.unique(rng.integers(0, SYMBOLS, (900, ORDER)) ** 2 // SYMBOLS @ (SYMBOLS ** np.arange(ORDER)), return_counts=True)
    model = Model.fit(grams, counts)
    for context in [int(g) >> 5 for g in grams[::90]] + [1, 12345, 32767]:
        assert np.exp(model.log_p((context << 5) + np.arange(SYMBOLS))).sum() == pytest.approx(1.0, abs=1e-6)


def test_long_texts_are_read_whole(monkeypatch):
    text = ("One  two\nthree, " * 50).encode()
    whole = np.concatenate(list(symbol_codes(text)))
    for piece in (1, 7, 64):
        monkeypatch.setattr("stockrisk.llm.perplexity.PIECE", piece)
        assert np.array_equal(np.concatenate(list(symbol_codes(text))), whole)


def test_counts_are_of_all_texts(spark):
    docs = spark.createDataFrame([(1, "ab ab"), (2, None), (3, ""), (4, "ab")], "doc_id long, text string")
    assert sum(r.n for r in count_grams(docs).collect()) == 6 + 3


def test_defined_cases(spark):
    prose = [" ".join(f"{w}{(i * j) % 17}" for j, w in enumerate(["some", "plain", "words", "of", "prose"] * 12)) for i in range(1, 30)]
    rows = [(i, "en", t) for i, t in enumerate(prose)] + [(100, "en", prose[0])] * 40
    rows += [(200, None, None), (201, "en", ""), (None, None, prose[1]), (202, "xx", "short"), (203, "en", "|#$ " * 10 + " ".join(f"#%{i}$" for i in range(90))), (204, "en", "z" * 40000)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").selectExpr("*", "1 AS low", "2 AS surprise", "3 AS gram", "4 AS text_key")
    key = lambda r: (r[0] is None, r[0] or 0)
    got = sorted((tuple(r) for r in rules_report(docs).collect()), key=key)
    assert got == sorted(plain_judgement(rows), key=key)
    kept = {r[0]: r[-1] for r in got}
    assert kept[0] and kept[100] and kept[None] and not kept[203] and not kept[202]
    assert rules_report(docs.limit(0)).count() == 0
    assert {r.surprise for r in judge(docs.where("text is null")).collect()} == {None}
    assert len(fit(docs.limit(0)).grams[-1]) == 0


def test_many_texts_at_once():
    rng = random.Random(4)
    pieces = ["a", "b c", "\n", "\n\n", "  ", "é", "日本", "#*", "x" * 50, "the the the the", " a b c a b c", "\t", "\x1c", "A1"]
    texts = [None, "", " ", "\n"] + ["".join(p + " " * rng.randint(0, 1) for p in rng.choices(pieces, k=rng.randint(0, 40))) for _ in range(400)]
    data = [(t or "").encode() for t in texts]
    whole, cuts = np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])
    assert list(zip(*[f.tolist() for f in many_figures(whole, cuts, Keys())])) == [figures(d) for d in data]
    codes, many = symbol_lines(whole, cuts)
    plain = [np.concatenate([np.zeros(0, int), *symbol_codes(d)]).tolist() for d in data]
    assert many.tolist() == list(map(len, plain)) and codes.tolist() == [c for codes in plain for c in codes]
