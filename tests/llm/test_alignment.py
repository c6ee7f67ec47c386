"""Alignment against a plain pairwise overlap of byte ranges, on whole small tables."""

import hashlib
from bisect import bisect_left
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from stockrisk.llm.alignment import ChunkIds, align, alignment_report, byte_level_bytes, piece_bytes

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain(libraries, texts):
    """Rows of the report, by comparing every token with every other that may overlap it."""
    a_lib, b_lib = libraries
    a_bytes, b_bytes = byte_level_bytes(a_lib), piece_bytes(b_lib)
    found = []
    for text in texts:
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        data = (" " + text).encode() if text else b""
        if not text or b"".join(a_bytes[i] for i in a) != data or b"".join(b_bytes[i] for i in b) != data:
            found.append(([], [], [], ""))
            continue

        def ranges(ids, table):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(table[i])))
                at += len(table[i])
            return out

        ra, rb = ranges(a, a_bytes), ranges(b, b_bytes)
        owner = {}
        for j, (s, e) in enumerate(rb):
            owner |= dict.fromkeys(range(s, e), j)
        links = [(a[i], b[j]) for i, (s, e) in enumerate(ra) for j in sorted({owner[x] for x in range(s, e)})]
        cuts = sorted({e for _, e in ra} & {e for _, e in rb})
        groups = [([], []) for _ in cuts]
        for side, (ids, r) in enumerate(((a, ra), (b, rb))):
            for i, (_, e) in zip(ids, r):
                groups[bisect_left(cuts, e)][side].append(str(i))
        groups = [",".join(x) + "|" + ",".join(y) for x, y in groups]
        found.append((a, b, links, ";".join(groups)))
    counts = Counter(p for _, _, links, _ in found for p in set(links))
    highest = defaultdict(int)
    for (i, _), n in counts.items():
        highest[i] = max(highest[i], n)
    return [
        (
            len(a), len(b), groups.count(";") + 1 if groups else 0, len(links), sum(counts[p] == highest[p[0]] for p in links),
            sum(counts[p] for p in links), hashlib.sha256(groups.encode()).hexdigest() if groups else "",
        )
        for a, b, links, groups in found
    ]


CASES = [
    "", "a", " ", "  two  blanks ", "\n\nlines\r\n\tx", "l'été s'achève à Orléans", "日本語の文章です。", "👩‍👩‍👧 emoji 🇫🇷", "<|endoftext|> <s> </s> <unk>",
    "▁marker▁", "a" * 3000, "don't we'll I'd '' ''s", "x́ é", "١٢٣ ½ Ⅷ", " nbsp　wide", "tail\n", "\x00\x01 control", "zero​width",
]


def collected(df):
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.orderBy("doc_id").collect()]


def test_cases_against_plain_overlap(spark, libraries):
    docs = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    assert collected(alignment_report(docs, A, B)) == plain(libraries, CASES)


def test_whole_table_against_plain_overlap(spark, libraries):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [r.text or "" for r in docs.orderBy("doc_id").collect()]
    assert collected(alignment_report(docs, A, B)) == plain(libraries, texts)


def test_lanes_change_nothing(spark):
    docs = spark.createDataFrame([(1, "the cat sat on the mat, " * 400 + "日本" * 50), (2, "x"), (3, "y" * 5000)], "doc_id long, text string")
    want = None
    for lane, chars in ((1, 1 << 20), (7, 100), (10**9, 1 << 20)):
        got = sorted(align(docs, A, B, groups=True, lane=lane, batch_chars=chars).collect(), key=lambda r: r.doc_id)
        assert want is None or got == want
        want = got
    assert want[1].groups.count("|") == want[1].n_groups == 1


def test_defined_cases(spark, libraries):
    rows = [(1, None, "z"), (None, "same text", "z"), (2, "same text", "z"), (2, "same text", "z"), (3, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pairs string").withColumnRenamed("pairs", "row")
    got = {(r.doc_id, r.n_links, r.count_sum, r.groups_sha256 != "") for r in alignment_report(docs, A, B).collect()}
    links = next(r[3] for r in plain(libraries, ["same text"]))
    assert got == {(1, 0, 0, False), (3, 0, 0, False), (None, links, 3 * links, True), (2, links, 3 * links, True)}
    assert alignment_report(docs, A, B).count() == 5
    assert alignment_report(docs.limit(0), A, B).count() == 0


def test_chunks_are_encoded_as_the_whole_text(libraries):
    """Every code point, beside a letter, a digit, blanks and itself."""
    table = ChunkIds(*libraries, 10**7)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c) != "▁"]
    texts = ["".join(f"a{c}1{c} {c} b  {c}{c}  a" for c in points[low : low + 2048]) for low in range(0, 0x30000, 2048)]
    for text in texts:
        whole, ((a, _), (b, _)) = table.encode([text])
        assert a.tolist() == (libraries[0].encode(" " + text, add_special_tokens=False).ids if whole[0] else [])
        assert b.tolist() == (libraries[1].encode(text) if whole[0] else [])


def test_a_full_table_is_emptied(libraries):
    small, large = ChunkIds(*libraries, 3), ChunkIds(*libraries, 10**6)
    texts = [f"w{i} and x{i}\n y{i % 3}" for i in range(40)] + ["", "one"]
    for low in range(0, len(texts), 5):
        got, want = small.encode(texts[low : low + 5]), large.encode(texts[low : low + 5])
        assert got[0].tolist() == want[0].tolist()
        assert [x.tolist() for side in got[1] for x in side] == [x.tolist() for side in want[1] for x in side]
