"""Quality classifier: features of a whole text, scored by a generalised additive model.

The model is fitted by the driver on the features of a bounded sample of
labelled rows (``sample`` rows of each label, smallest id hashes first, rows
of the held-out fold never), computed by Spark; every row is then scored from
its whole text. Labels, language, source and id are no features.

Defined cases: NULL and empty texts have the features of an empty text; a
document labelled more than once counts with its mean label, 0.5 and above as
1; with no labels of both kinds the score is the smoothed share of label 1;
repeated rows of an id train as one, its least text, and each get a score;
very long texts are read whole; an empty table gives no rows; columns of any
name stay as they are where rows are kept.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from stockrisk.llm import gam
from stockrisk.llm.common import free_name, held_out

SAMPLE = 8000  # labelled rows of each label, at most
THRESHOLD = 0.7
FEATURES = (
    "log_bytes", "letters", "upper", "digits", "symbols", "shouts", "stops", "spaces", "word_length",
    "distinct_words", "top_word", "echoes", "distinct_triples", "distinct_lines", "words_per_line", "marked_words",
)

_CLASS = np.zeros(256, dtype=np.int64)  # of a byte: 1 lower case or beyond ASCII, 2 upper, 3 digit, 4 space, 5 .,;: 6 !? 7 other
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = (
        1 if _b > 127 or "a" <= _c <= "z" else 2 if "A" <= _c <= "Z" else 3 if "0" <= _c <= "9"
        else 4 if _c in " \t\n\v\f\r" else 5 if _c in ".,;:'\"()-" else 6 if _c in "!?" else 7
    )


def features(text: str | None) -> np.ndarray:
    data = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(_CLASS[np.frombuffer(data, dtype=np.uint8)], minlength=8)
    n = max(len(data), 1)
    words = data.split()
    many = max(len(words), 1)
    spread = Counter(words)
    triples = len(set(zip(words, words[1:], words[2:])))
    lines = [x for x in data.split(b"\n") if x]
    cased = max(int(counts[1] + counts[2]), 1)
    return np.array(
        [
            np.log1p(len(data)),
            cased / n,
            counts[2] / cased,
            counts[3] / n,
            counts[7] / n,
            counts[6] / n,
            counts[5] / n,
            counts[4] / n,
            sum(map(len, words)) / many,
            len(spread) / many,
            max(spread.values(), default=0) / many,
            sum(map(bytes.__eq__, words, words[1:])) / many,
            triples / max(len(words) - 2, 1),
            len(set(lines)) / max(len(lines), 1),
            np.log1p(many / max(len(lines), 1)),
            (counts[6] + counts[7]) / many,
        ]
    )


def training_rows(docs: DataFrame, labels: DataFrame, label: str, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the sample: at most ``2 * sample`` rows reach the driver."""
    marked = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    )
    order = F.xxhash64("doc_id")
    picked = [marked.where(F.col("label") == k).orderBy(order, "doc_id").limit(sample) for k in (0, 1)]
    # At most 2 * sample ids.
    chosen = F.broadcast(picked[0].unionByName(picked[1]).withColumnRenamed("doc_id", "_id"))
    texts = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "label")
    # One text of an id, the least, whatever the number of its rows.
    texts = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [features(t).tolist() for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "label": frame["label"], "features": found})

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = texts.mapInPandas(run, f"doc_id {kind}, label int, features array<double>").toPandas().sort_values("doc_id")
    return np.array(rows["features"].tolist()).reshape(len(rows), len(FEATURES)), rows["label"].to_numpy(float)


def score(docs: DataFrame, model: gam.Model, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``: probability that the text is good."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        rows = np.array([features(t) for t in texts]).reshape(len(texts), len(FEATURES))
        return pd.Series(held.value.score(rows))

    return docs.withColumn(name, scored("text"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> gam.Model:
    return gam.fit(*training_rows(docs, labels, label, sample))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` whose score reaches the threshold, columns unchanged."""
    name = free_name(docs, "quality_score")
    return score(docs, fit(docs, labels), name).where(F.col(name) >= threshold).drop(name)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's digest: doc_id, held_out, score, predicted."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
