"""Quality classifier: a byte-level convolutional network over whole texts.

The network (``byteconv``) is trained on the driver from a bounded sample of labelled
rows: at most ``SAMPLE`` of each label, taken in the order of a hash of their ids, and of
each at most ``SAMPLE_HALVES`` pieces of 128 bytes, spread evenly over the text. These
are bounds on the training data alone. Every text is scored as a whole, by every byte.
Labels are the target of training and nothing else; language, source and id are no
inputs of a score.

Rows whose id hashes to ``HELD_OUT`` modulo 4 are never used for training. Null and empty
texts are scored like any other. Labels that contradict each other or are neither 0 nor 1
are not used. Where labels of one value only are known, that value is every score; where
there are none, the score is 1, so that a filter drops nothing without evidence. Repeated
rows are scored each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docvec.llm import byteconv
from docvec.llm.common import table

SAMPLE = 2000  # labelled rows of each label
SAMPLE_HALVES = 48  # pieces of each of them
STEPS = 400
HELD_OUT = 2
LIMIT = 0.7


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == HELD_OUT


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts texts to their training pieces on the executors."""
    for batch in batches:
        kept = []
        for text in batch.column(1):
            parts = byteconv.halves(text.as_py() or b"")
            if len(parts) > SAMPLE_HALVES:
                parts = parts[np.linspace(0, len(parts) - 1, SAMPLE_HALVES).astype(int)]
            kept.append(np.ascontiguousarray(parts).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(kept, pa.binary())], ["quality", "pieces"]
        )


def fit(docs: DataFrame, labels: DataFrame) -> byteconv.Params | float:
    """The trained network, or the one score that fits labels of one value or none."""
    known = (
        labels.filter("quality in (0, 1) and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .filter("quality = other")
        .filter(~held_out(F.col("doc_id")))
        .select("doc_id", "quality")
    )
    counts = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}  # two rows
    if len(counts) < 2:
        return float(next(iter(counts), 1))
    order = F.xxhash64("doc_id", F.lit("sample"))
    picked = [
        known.filter(F.col("quality") == q).orderBy(order, "doc_id").limit(SAMPLE) for q in (0, 1)
    ]
    ids = F.broadcast(picked[0].union(picked[1]))  # 2 * SAMPLE ids at most
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(ids, "doc_id")
    rows = texts.select("quality", "text").mapInArrow(_pieces, "quality int, pieces binary").collect()
    # Rows come in any order; training takes them in a fixed one.
    rows = sorted(rows, key=lambda r: (r.quality, bytes(r.pieces)))
    label = np.array([r.quality for r in rows], float)
    if len(set(label)) < 2:
        return float(label[0]) if len(label) else 1.0
    width = byteconv.HALF + byteconv.TAPS - 1
    pieces = [np.frombuffer(r.pieces, np.int16).reshape(-1, width) for r in rows]
    weight = np.where(label == 1, counts[1] / max(label.sum(), 1), counts[0] / max((1 - label).sum(), 1))
    return byteconv.train(pieces, label, weight, STEPS)


def with_scores(docs: DataFrame, model: byteconv.Params | float, name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in a column of that name."""
    if isinstance(model, float):
        return docs.withColumn(name, F.lit(model))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = byteconv.Scorer(model)
        for texts in batches:
            yield pd.Series(scorer.scores([t or b"" for t in texts]))

    return docs.withColumn(name, score(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that the classifier does not reject, with all their columns."""
    scored = with_scores(docs, fit(docs, labels), "__score")
    return scored.filter(F.col("__score") >= LIMIT).select(*docs.columns)


def op2_quality(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = with_scores(docs, fit(docs, table(spark, sf, "labels")))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= LIMIT, 1).otherwise(0).alias("predicted"),
    )
