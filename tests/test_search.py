import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Observation

from docvec.operators import cells, lexical, search
from docvec.operators.index import lookup, offset_range


def vectors(spark, table, ids=None):
    ids = ids or [f"c{i:04d}" for i in range(len(table))]
    rows = [(i, [float(x) for x in v]) for i, v in zip(ids, table)]
    return spark.createDataFrame(rows, "chunk_id string, vector array<float>")


def questions(spark, table):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(table)]
    return spark.createDataFrame(rows, "query_id long, vector array<double>")


def brute(table, ids, queries, k, similarity):
    out = []
    for q, v in enumerate(queries):
        scored = []
        for i, w in zip(ids, table):
            dot = sum(a * b for a, b in zip(v, w))
            if similarity == "DOT_PRODUCT":
                s = (1 + dot) / 2
            elif similarity == "EUCLIDEAN":
                s = 1 / (1 + sum((a - b) ** 2 for a, b in zip(v, w)))
            else:
                s = (1 + dot / math.sqrt(sum(a * a for a in v) * sum(b * b for b in w))) / 2
            scored.append((-round(s, 9), i))
        out += [(q, i, r + 1) for r, (_, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def got(df):
    return sorted((r.query_id, r.chunk_id, r["rank"]) for r in df.collect())


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    table = rng.normal(size=(600, 8)).astype(np.float32)
    # A third of all rows are copies of one vector, another tenth points the same way.
    table[::3] = table[1]
    table[4::10] = table[1] * 2
    return table.astype(float).tolist(), rng.normal(size=(7, 8)).tolist() + [table[1].tolist()]


@pytest.mark.parametrize("similarity", ["COSINE", "EUCLIDEAN", "DOT_PRODUCT"])
@pytest.mark.parametrize("k", [1, 10, 250, 1000])
def test_knn_is_exact(spark, data, similarity, k):
    table, queries = data
    df = vectors(spark, table).repartition(5)
    ids = [f"c{i:04d}" for i in range(len(table))]
    found = got(search.knn(df, questions(spark, queries), k, similarity))
    assert found == brute(table, ids, queries, k, similarity)


def test_tiles_of_any_size_give_the_same(spark, data, monkeypatch):
    table, queries = data
    df, qs = vectors(spark, table), questions(spark, queries * 5)
    whole = got(search.knn(df, qs, 5))
    monkeypatch.setattr(search, "TILE_NUMBERS", 8 * 3)
    assert got(search.knn(df, qs, 5)) == whole
    monkeypatch.setattr(search, "TILE_VECTORS", 50)
    monkeypatch.setattr(search, "MOST_TASKS", 7)
    assert got(search.knn(df, qs, 5)) == whole
    monkeypatch.setattr(search, "TILE_HITS", 11)
    assert got(search.knn(df, qs, 5)) == whole


def test_one_query_and_ten_thousand_give_the_same(spark, data):
    table, _ = data
    rng = np.random.default_rng(8)
    many = rng.normal(size=(10_000, 8)).tolist()
    df = vectors(spark, table)
    found = search.knn(df, questions(spark, many), 3)
    of_one = {r for r in got(found) if r[0] == 4321}
    alone = questions(spark, many).filter("query_id = 4321")
    assert of_one == set(got(search.knn(df, alone, 3)))
    assert found.count() == 30_000


def test_nothing_but_counts_passes_the_driver(spark, data, monkeypatch):
    table, queries = data
    df, qs = vectors(spark, table), questions(spark, queries)
    collected, whole = [], type(df).collect

    def collect(self):
        collected.append(self.dtypes)
        return whole(self)

    monkeypatch.setattr(type(df), "collect", collect)
    found = search.knn(df, qs, 4)
    assert not any("array" in t for of in collected for _, t in of)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "CartesianProduct" not in plan


def test_own_k_and_carried_columns(spark, data):
    table, queries = data
    df = vectors(spark, table).selectExpr("*", "concat('d', chunk_id) AS doc_id", "length(chunk_id) AS n")
    qs = questions(spark, queries).selectExpr("*", "CASE WHEN query_id % 2 = 0 THEN int(query_id + 1) END AS top_k")
    rows = search.knn(df, qs, 4, carry=["doc_id", "n"]).collect()
    assert Counter(r.query_id for r in rows) == {q: q + 1 if q % 2 == 0 else 4 for q in range(len(queries))}
    assert all(r.doc_id == "d" + r.chunk_id and r.n == 5 for r in rows)
    ids = [f"c{i:04d}" for i in range(len(table))]
    want = {(q, i, p) for q, i, p in brute(table, ids, queries, 9, "COSINE") if p <= (q + 1 if q % 2 == 0 else 4)}
    assert {(r.query_id, r.chunk_id, r["rank"]) for r in rows} == want


def test_small_blocks_give_the_same(spark, data, monkeypatch):
    from docvec.operators.search import _Best

    table, queries = np.array(data[0]), np.array(data[1])
    ids = np.array([f"c{i:04d}" for i in range(len(table))])
    best = _Best(np.full(len(queries), 7))
    for start in range(0, len(table), 13):
        for first in range(0, len(queries), 3):
            part = search._scores(queries[first : first + 3], table[start : start + 13], "COSINE")
            best.add(first, part, ids[start : start + 13], start)
    rows = list(zip(best.query.tolist(), best.id.tolist()))
    expected = [(q, i) for q, i, _ in brute(table.tolist(), ids.tolist(), queries.tolist(), 7, "COSINE")]
    assert sorted(rows) == sorted(expected)
    assert (ids[best.row] == best.id).all()


def test_bad_rows_are_passed_over_and_counted(spark):
    table = [[1, 0], [0, 1], [0, 0], [math.nan, 1], [1, 2, 3], []]
    df = vectors(spark, table)
    found = got(search.knn(df, questions(spark, [[1, 0]]), 10))
    assert found == [(0, "c0000", 1), (0, "c0001", 2)]
    counts = {r.problem: r.n for r in search.unusable_vectors(df, 2).collect()}
    assert counts == {"dimension": 2, "no direction": 2}
    seen = Observation("passed over")
    search.knn(df, questions(spark, [[1, 0]]), 10, passed_over=seen).collect()
    assert seen.get == {"dimension": 2, "no_direction": 2}


def test_edges(spark):
    df = vectors(spark, [[1, 0]])
    with pytest.raises(ValueError):
        search.knn(df, questions(spark, [[1, 0]]), 0)
    with pytest.raises(ValueError):
        search.knn(df, questions(spark, [[1, 0], [1, 0, 0]]), 1)
    assert got(search.knn(df, questions(spark, [[0, 0]]), 3)) == []
    assert got(search.knn(df, questions(spark, []), 3)) == []
    assert got(search.knn(df.limit(0), questions(spark, [[1, 0]]), 3)) == []
    assert got(search.knn(df, questions(spark, [[1, 0]]), 3, "UNKNOWN")) == [(0, "c0000", 1)]


def index_of(spark, texts):
    from docvec.operators.embed import embed_texts

    rows = [(f"d{i}", f"c{i}", f"h{i}", i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(
        rows, "doc_id string, chunk_id string, chunk_hash string, offset long, text string"
    )
    return df.join(embed_texts(df, text_col="text", keep=["chunk_id"]), "chunk_id")


def test_batch_search_and_own_top_k(spark):
    index = index_of(spark, ["red apple", "green apple", "blue sky", "red sky"])
    asked = spark.createDataFrame(
        [(1, "red apple", None), (2, "sky", 1), (3, "sky", 3)], "query_id int, text string, top_k int"
    )
    rows = search.batch_search(asked, index, 2).collect()
    assert Counter(r.query_id for r in rows) == {1: 2, 2: 1, 3: 3}
    best = next(r for r in rows if r.query_id == 1 and r["rank"] == 1)
    assert (best.docId, best.chunkId, best.text, best.offset) == ("d0", "c0", "red apple", 0)
    assert best.score == pytest.approx(1.0)
    with pytest.raises(ValueError):
        search.batch_search(asked.replace(3, 0, ["top_k"]), index, 2)


def test_defaults(spark):
    df = spark.createDataFrame([(1, 7), (2, None)], "query_id int, top_k int")
    rows = search.with_defaults(df, "m", "c").orderBy("query_id").collect()
    assert [(r.top_k, r.embed_model, r.chat_model) for r in rows] == [(7, "m", "c"), (5, "m", "c")]


def test_lookup_and_offsets(spark):
    index = index_of(spark, ["a", "b", "c"])
    assert [r.text for r in lookup(index, "chunk_id", "c1").collect()] == ["b"]
    assert sorted(r.text for r in offset_range(index, 1, 2).collect()) == ["b", "c"]
    with pytest.raises(ValueError):
        lookup(index, "text", "a")


def test_cells(spark):
    rng = np.random.default_rng(9)
    middles = rng.normal(size=(10, 16)) * 3
    table = np.concatenate([m + rng.normal(size=(80, 16)) for m in middles]).astype(np.float32)
    df, qs = vectors(spark, table.tolist()).repartition(4), questions(spark, (middles + 0.1).tolist())
    centres = cells.train_cells(df, 10)
    assigned = cells.assign_cells(df, centres)
    exact = search.knn(df, qs, 10)
    every = cells.knn_cells(assigned, qs, centres, len(centres), 10)
    assert got(every) == got(exact)
    some = cells.knn_cells(assigned, qs, centres, 3, 10)
    recalls = [r.recall for r in cells.recall(some, exact).collect()]
    assert len(recalls) == 10 and sum(recalls) / 10 >= 0.9
    with pytest.raises(ValueError):
        cells.knn_cells(assigned, qs, centres, 0)


def test_bm25(spark):
    texts = ["the cat sat", "the dog sat down", "The cat, the CAT!", "", "sky"]
    rows = spark.createDataFrame([(f"c{i}", t) for i, t in enumerate(texts)], "chunk_id string, text string")
    asked = spark.createDataFrame([(1, "cat the the"), (2, "nothing"), (3, "sat")], "query_id int, text string")
    words = {f"c{i}": "".join(ch if ch.isalnum() else " " for ch in t.lower()).split() for i, t in enumerate(texts)}
    docs = {i: w for i, w in words.items() if w}
    mean = sum(map(len, docs.values())) / len(docs)

    def score(terms, i):
        total = 0.0
        for t in set(terms):
            df = sum(t in w for w in docs.values())
            tf = docs[i].count(t)
            if tf:
                idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
                total += idf * tf / (tf + 1.2 * (0.25 + 0.75 * len(docs[i]) / mean))
        return round(total, 9)

    expected = []
    for q, terms in [(1, ["cat", "the"]), (3, ["sat"])]:
        ranked = sorted((-score(terms, i), i) for i in docs if score(terms, i) > 0)[:2]
        expected += [(q, i, r + 1, -s) for r, (s, i) in enumerate(ranked)]
    found = lexical.bm25(asked, lexical.term_index(rows), 2).collect()
    assert sorted((r.query_id, r.chunk_id, r["rank"]) for r in found) == sorted(e[:3] for e in expected)
    assert {(r.query_id, r["rank"]): r.score for r in found} == pytest.approx(
        {(e[0], e[2]): e[3] for e in expected}
    )
