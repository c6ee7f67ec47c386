"""Corpus pipeline: quality, near-dedup, personal data, mix, tokens.

Each stage takes (spark, docs, sf_dir) and works on every row its predecessor
kept. All but the last return the columns of ``documents``. ``run`` writes
each stage's rows as Parquet under the shared checkpoint folder and rereads
them as the next stage's input, so a lost executor costs one stage's tasks.
What a stage stored on its way is removed when its rows are written, the rows
of all but the last stage at the end of the run.

Defined cases are those of the operators: NULL and empty texts are scored,
deduplicated and mixed like any other; rows equal in id and text are one
document after near_dedup; very long texts are read whole; an empty table
stays empty; other columns, whatever their names, stay as they are up to the
mix.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockrisk.llm.common import free_name, table
from stockrisk.llm.mixing import mixed_documents
from stockrisk.llm.pii import redact
from stockrisk.llm.quality import fit, keep_good, score
from stockrisk.llm.sentencepieces import encode_decode
from stockrisk.llm.simhash import keep_one_per_component
from stockrisk.sources.sinks import owned_pins, pin


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier scores at 0.7 or more."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: shingles of 4 words, at most 4 bits."""
    return keep_one_per_component(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its personal data replaced by the kind."""
    return redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, each as often as it is taken; their weights are the quality classifier's scores."""
    model = fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    name = free_name(docs, "quality")
    scored = pin(score(docs, model, name), "scored")
    return mixed_documents(scored, quality=F.col(name)).drop(name)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids and decoded text of every document."""
    encoded = encode_decode(docs.select("doc_id", "source", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select("doc_id", "source", "ids", "decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("mix", mix),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with owned_pins(spark) as keep_result:
        for name, stage in STAGES:
            with owned_pins(spark) as keep_rows:
                keep = keep_result if name == STAGES[-1][0] else keep_rows
                docs = keep(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs


# Features, fingerprints, spans and ids are no SQL: tests/llm/test_corpus_pipeline.py checks the stages by brute force.
ORACLE_SQL = None
