from __future__ import annotations

import numpy as np
import pytest

from docvec.llm import neighbors as N


def exact(vectors, query_id, k):
    q = np.asarray(vectors[query_id], float)
    scores = []
    for i, v in vectors.items():
        v = np.asarray(v, float)
        if i != query_id and len(v) == len(q):
            scores.append((-float(v @ q / (np.linalg.norm(v) * np.linalg.norm(q))), i))
    return [(i, -s) for s, i in sorted(scores)[:k]]


def test_estimates_lie_within_their_bounds():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 64))
    codes = N.Codes(x)
    inside = 0
    for q in rng.normal(size=(20, 64)):
        true = codes.exact(q, np.arange(len(x)))
        inside += (np.abs(codes.estimates(q) - true) <= codes.error).mean() / 20
    assert inside > 0.99


@pytest.mark.parametrize("dims", [3, 8, 64, 100])
def test_search_in_a_group_finds_the_nearest(dims):
    rng = np.random.default_rng(dims)
    x = rng.normal(size=(3000, dims)) * rng.uniform(1e-3, 1e3, size=(3000, 1))
    codes = N.Codes(x)
    hit = 0
    for q in x[:40]:
        rows, scores = codes.search(q, 5)
        true = set(np.argsort(-codes.exact(q, np.arange(len(x))), kind="stable")[:5])
        hit += len(set(rows[np.argsort(-scores)[:5]]) & true)
    assert hit >= 0.99 * 200


def test_edges_ties_and_copies(spark):
    rng = np.random.default_rng(3)
    one = rng.normal(size=8).round(3).tolist()
    vectors = {i: rng.normal(size=8).round(3).tolist() for i in range(100, 160)}
    vectors |= {i: one for i in range(0, 40)}  # copies: ties to the smaller id
    vectors |= {-50: (np.array(one) * 2).tolist(), 300: [1.0, 2.0], 301: [2.0, 1.0], 302: [5.0]}
    rows = [(i, v, "x") for i, v in vectors.items()]
    bad = [(400, None), (450, [0.0] * 8), (500, [1.0] * 7 + [None]), (550, [float("nan")] * 8), (600, [float("inf")] * 8), (None, one)]
    rows += [(i, v, "x") for i, v in bad] + [rows[3]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    queries = frame.filter("vec_id % 50 = 0 or vec_id in (7, 301, 302)")
    got: dict = {}
    for r in N.nearest(frame, queries, "vec_id", "embedding").collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(got) == {0, 7, -50, 100, 150, 300, 301}
    for q, found in got.items():
        expect = exact(vectors, q, 5)
        assert [s for _, s in found.values()] == pytest.approx([s for _, s in expect])
        assert sorted(found) == list(range(1, len(expect) + 1))
    assert [found[0] for found in got[7].values()][:4] in ([0, 1, 2, 3], [-50, 0, 1, 2])
    assert N.nearest(frame.filter("false"), queries, "vec_id", "embedding").count() == 0


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.001"
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    got: dict = {}
    for r in N.op5_neighbors(spark, sf).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(got) == {i for i in vectors if i % 50 == 0}
    recall = np.mean([len(got[q] & {i for i, _ in exact(vectors, q, 5)}) / 5 for q in got])
    assert recall >= 0.95
