from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from docvec.llm import byteconv as B
from docvec.llm import quality as Q
from tests.llm.conftest import words


def numeric(p, parts, first, label, weight):
    pooled = B.responses(B.tap_tables(p), parts)
    prob = B.combine(p, pooled, first)
    loss = -(label * np.log(prob) + (1 - label) * np.log(1 - prob))
    return float((loss * weight).sum() / weight.sum())


def test_gradients_match_differences():
    p = B.Params(*[a.astype(float) for a in B.start(3).arrays()])
    p.bias += 0.1 + 0.01 * np.arange(len(p.bias))  # away from the kinks at zero
    p.dense_bias += 0.05 + 0.01 * np.arange(len(p.dense_bias))
    texts = [b"Hello world " * 30, b"zz", b"aaa bbb !!! " * 5, "é".encode() * 100]
    halves = [B.halves(t) for t in texts]
    first = np.r_[0, np.cumsum([len(h) for h in halves])[:-1]]
    parts, label, weight = np.concatenate(halves), np.array([1.0, 0, 0, 1]), np.array([1.0, 2, 1, 1])
    grads = B._gradients(p, parts, first, label, weight)
    rng = np.random.default_rng(1)
    for a, g in zip(p.arrays(), grads):
        for _ in range(20):
            at = tuple(rng.integers(0, n) for n in a.shape)
            held = a[at]
            a[at] = held + 1e-6
            up = numeric(p, parts, first, label, weight)
            a[at] = held - 1e-6
            down = numeric(p, parts, first, label, weight)
            a[at] = held
            assert g[at] == pytest.approx((up - down) / 2e-6, abs=1e-5)
    before = numeric(p, parts, first, label, weight)
    for a, g in zip(p.arrays(), grads):
        a -= 0.01 * g
    assert numeric(p, parts, first, label, weight) < before


def test_score_covers_the_whole_text_and_not_its_neighbours():
    scorer = B.Scorer(B.start(5))
    texts = [b"", b"x", b"word " * 10, b"word " * 200_000, bytes(range(256)) * 3, "ü".encode() * 1000]
    together = scorer.scores(texts)
    assert together == pytest.approx([scorer.scores([t])[0] for t in texts])
    long = bytearray(b"word " * 200_000)
    long[-40:] = b"#$%&" * 10
    assert scorer.scores([bytes(long)])[0] != together[3]
    # Chunks overlap: a filter sees what lies across the border of two halves.
    a, b = bytearray(b"a" * 400), bytearray(b"a" * 400)
    b[B.HALF - 3 : B.HALF + 3] = b"#$%&*!"
    assert scorer.scores([bytes(a)])[0] != scorer.scores([bytes(b)])[0]


@pytest.fixture(scope="module")
def labelled(spark, docs_of):
    texts = [words(30, i) if i % 3 else words(30, i).upper().replace(" ", "!! ") for i in range(240)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(240)], "doc_id long, quality int, toxic int")
    return docs_of(texts), labels


def test_learns_and_never_sees_held_out_labels(spark, labelled):
    docs, labels = labelled
    out = Q.held_out(F.col("doc_id"))
    model = Q.fit(docs, labels)
    rows = Q.with_scores(docs, model).withColumn("out", out).collect()
    assert {r.out for r in rows} == {True, False}
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([(r.score >= 0.7) == (r.doc_id % 3 > 0) for r in rows if r.out]) > 0.95
    flipped = labels.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = Q.fit(docs, flipped)
    assert all((a == b).all() for a, b in zip(model.arrays(), again.arrays()))


def test_edge_rows_and_few_labels(spark, labelled, edge_docs):
    docs, labels = labelled
    scored = Q.with_scores(edge_docs, Q.fit(docs, labels))
    assert scored.columns == [*edge_docs.columns, "score"]
    scores = {r.doc_id: r.score for r in scored.collect()}
    assert scores[0] == scores[1] and all(0 <= s <= 1 for s in scores.values())
    one = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (3, None, 0), (4, 1, 0), (4, 0, 0)], labels.schema)
    assert Q.fit(edge_docs, one) == 1.0 and Q.fit(edge_docs, one.filter("false")) == 1.0
    kept = Q.keep_good(edge_docs, one)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()
    assert Q.keep_good(edge_docs.filter("false"), labels).count() == 0


def test_held_out_accuracy_of_the_query(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in Q.op2_quality(spark, sf).collect() if r.held_out and r.doc_id in labels]
    good = [r.score for r in rows if labels[r.doc_id] == 1]
    bad = [r.score for r in rows if labels[r.doc_id] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([s >= 0.7 for s in good]) > 0.9
