"""BM25 over counted rows: the hits of the flat term table, without pairs of query and row."""

import random

from docvec.operators import lexical


def test_the_hits_are_those_of_the_term_table(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_QUERIES", 2)
    monkeypatch.setattr(lexical, "GROUP_ROWS", 70)
    rng = random.Random(5)
    words = ["the", "cat", "é", "Sat", "x1", *(f"w{i}" for i in range(60))]
    texts = [" ".join(rng.choices(words, weights=[30, *[2] * 64], k=rng.randint(1, 40))) for _ in range(300)]
    listed = [(f"c{i:03d}", t) for i, t in enumerate(texts)] + [("empty", ""), ("null", None), ("c007", "the cat w1 w2")]
    rows = spark.createDataFrame(listed, "chunk_id string, text string").repartition(5)
    asked = [(1, "the cat"), (2, "nothing here"), (3, "sat w5 w6 the"), (4, None), (5, "w1 W2 é"), (5, "w9"), (None, "x1")]
    queries = spark.createDataFrame(asked, "query_id int, text string")
    flat = lexical.bm25(queries, lexical.term_index(rows), 7)
    found = lexical.bm25_rows(queries, lexical.counted_rows(rows), 7)
    keyed = lambda df: {(r.query_id, r["rank"]): (r.chunk_id, round(r.score, 6)) for r in df.collect()}
    assert keyed(found) == keyed(flat) and found.count() > 20
    none = rows.filter("chunk_id = 'empty'")
    assert lexical.bm25_rows(queries, lexical.counted_rows(none), 7).count() == 0


def test_only_the_best_of_a_task_are_sent(spark):
    rows = spark.range(2000).selectExpr("cast(id as string) chunk_id", "concat('the w', id % 7) text")
    queries = spark.range(30).selectExpr("cast(id as int) query_id", "'the w1' text")
    found = lexical.bm25_rows(queries, lexical.counted_rows(rows), 3)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # The pairs never leave the Python worker: nothing is summed by query and row.
    assert "sum(" not in plan and found.count() == 90
