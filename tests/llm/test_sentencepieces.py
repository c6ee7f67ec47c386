"""The distinct-chunk encoder against the library on whole texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from stockrisk.llm.sentencepieces import ChunkTable, encode_decode, token_digests

MODEL = public_tokenizers.path("piece_bpe_32k.model")
EDGES = ["", "a", " ", "  ", "   a", " a ", "a  b   ", "▁", "▁ ▁x", "a▁b", "\n", "a\n b\tc", "é ½  z", "<s> </s> <0x0A>",
         "日本語 テキスト", "😀 a😀", "\x00a b\x00", "  \n  ", "x" * 30000, "a b " * 20000, "﻿hi"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.mark.parametrize("words", [50, 100_000])
def test_ids_equal_whole_text_ids(library, words):
    rng = random.Random(3)
    texts = EDGES + ["".join(rng.choice(" ▁ab\n\té😀.<0x>") for _ in range(rng.randrange(40))) for _ in range(2000)]
    chunks = ChunkTable(library, words)
    for low in range(0, len(texts), 100):
        part = texts[low : low + 100]
        ids, offsets = chunks.encode(part)
        assert [i.tolist() for i in np.split(ids, offsets[1:-1])] == [library.encode(t) for t in part]


def test_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = set()
    for r in docs.collect():
        ids = library.encode(r.text)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        want.add((r.doc_id, len(ids), *sha))
    assert {tuple(r) for r in token_digests(docs, MODEL).collect()} == want


def test_edge_rows(spark, library):
    rows = [(i, t) for i, t in enumerate(EDGES)] + [(None, None), (7, "a b"), (7, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = encode_decode(docs, MODEL).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.ids == library.encode(r.text or "")
        assert r.decoded == library.decode(r.ids)
    assert encode_decode(docs.limit(0), MODEL).count() == 0
