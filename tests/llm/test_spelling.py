"""Spelling variants against plain Python: counts, every pair of words, forms followed one by one."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from stockrisk.llm.spelling import SYMBOLS, Reduced, _symbol_table, choose_symbols, code_bitmap, count_words, follow_forms, group_variants, near_words, spelling_report

SF = "/root/testdata/sf0.001"


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain_groups(words):
    near = {w: [] for w in words}
    holes = {}
    for w in words:  # words one apart are equal once one letter is taken out of one of them, or of both
        for key in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            holes.setdefault(key, []).append(w)
    for group in holes.values():
        for w in group:
            near[w] += [x for x in group if one_apart(w, x)]
    form = {}
    for w, others in near.items():
        best = min(set(others), key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(set(near[w])), words[form[w]] if form[w] else None))
    return out


def rows_of(df):
    got = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    words = plain_words([(r.doc_id, r.text) for r in docs.collect()])
    want = plain_groups(words)
    assert rows_of(spelling_report(docs)) == want
    assert sum(r[1] is not None for r in want) >= 10


@pytest.mark.parametrize("symbols", [2, 4, SYMBOLS[-1]])
@pytest.mark.parametrize("unit", [3, 256])
def test_every_alphabet_and_unit_finds_the_same(spark, symbols, unit):
    rng = random.Random(symbols)
    words = {}
    for _ in range(60):
        word = "".join(rng.choice("abe\u00e9\u00ff") for _ in range(rng.randint(7, 9)))
        for _ in range(12):
            words[word] = 2 * 10 ** rng.randint(0, 4)
            at = rng.randrange(len(word))
            word += "b" * (len(word) < 4)
            word = rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice("abe") + word[at:], word[:at] + rng.choice("abe\u00df") + word[at + 1 :]])
    words |= {"a" * k: k for k in range(7, 12)}
    stored = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows_of(group_variants(stored, symbols, unit)) == plain_groups(words)


def test_neighbourhood_is_full_and_distinct():
    word, symbols = "aabbceda", 3
    reduced = Reduced(["zzz", word, "q"], symbols)
    value = reduced.value[3:11].tolist()
    want = {tuple(value[:i] + value[i + 1 :]) for i in range(8)}
    want |= {tuple(value[:i] + [s] + value[i + 1 :]) for i in range(8) for s in (1, 2, 3)}
    want |= {tuple(value[:i] + [s] + value[i:]) for i in range(9) for s in (1, 2, 3)}
    want.discard(tuple(value))
    got = [int(c) for rows, codes in reduced.neighbours() for r, c in zip(rows, codes) if r == 1]
    assert len(got) == len(set(got)) == len(want)


def test_forms_are_followed_to_the_last(spark):
    chain = [(f"w{i:02}", f"w{i + 1:02}") for i in range(13)] + [("x", "w03"), ("y", "z")]
    got = {r.word: r.root for r in follow_forms(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {w: "z" if w == "y" else "w13" for w, _ in chain}


def test_alphabet_follows_the_vocabulary(spark):
    few = spark.createDataFrame([("abcdefgh", 2), ("hgfedcba", 2)], "word string, n long")
    alike = [c for c in "abcdefghijklmnopqrstuvwxyz" if _symbol_table(SYMBOLS[0])[ord(c)] == 1][:2]
    many = spark.range(4000).selectExpr(f"translate(lpad(conv(id, 10, 2), 12, '0'), '01', '{''.join(alike)}') word", "2L n")
    assert choose_symbols(few) == SYMBOLS[0]
    assert choose_symbols(many) > SYMBOLS[0]
    assert near_words(few, 4).count() == 0


def test_bitmap_holds_the_codes(spark):
    codes = [0, 1, -1, 2**62, -(2**63), 123456789 << 30]
    bitmap = code_bitmap(spark.createDataFrame([(c,) for c in codes], "code long"), 20)
    bits = {int(i) for i in np.flatnonzero(np.unpackbits(bitmap, bitorder="little"))}
    assert bits == {(c % 2**64) >> 44 for c in codes}


def test_defined_cases(spark):
    rows = [(None, "L\u00c9gendes L\u00c9gendes l\u00c9gendes"), (1, None), (2, ""), (3, "x" * 50000 + " " + "x" * 50000), (4, "same words here " * 3)]
    rows += [(5, "variant variant variantt variantt")] * 10 + [(6, "\u00d7\u00f7\u00d7\u00f7\u00d7\u00f7\u00d7 1 \u00d7\u00f7\u00d7\u00f7\u00d7\u00f7\u00d7")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "text AS word", "1 AS n", "2 AS code", "3 AS unit")
    assert rows_of(spelling_report(docs)) == plain_groups(plain_words(rows))
    assert spelling_report(docs.limit(0)).count() == 0
    assert count_words(docs.where("doc_id = 1")).count() == 0
