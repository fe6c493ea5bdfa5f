from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from docvec.operators import lexical
from docvec.operators.postings import Part, PartRows, Postings
from docvec.sources.storage import work_folder


def plain_bm25(rows, queries, k):
    """rows: id to text. Scores of all rows by their words, the k best of each query."""
    words = {i: lexical.term_counts(t) for i, t in rows.items()}
    words = {i: c for i, c in words.items() if c}
    mean = sum(c.total() for c in words.values()) / len(words)
    df = Counter(t for c in words.values() for t in c)
    out = []
    for q, text in queries:
        scored = []
        for i, c in words.items():
            s = sum(
                math.log(1 + (len(words) - df[t] + 0.5) / (df[t] + 0.5)) * c[t]
                / (c[t] + 1.2 * (0.25 + 0.75 * c.total() / mean))
                for t in lexical.term_counts(text) if c[t]
            )
            if s > 0:
                scored.append((-round(s, 9), i))
        out += [(q, i, r) for r, (_, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def got(df):
    return sorted((r.query_id, r.chunk_id, r["rank"]) for r in df.collect())


def made(n, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    return {f"c{i:05d}": " ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 40))) for i in range(n)}


def frame(spark, rows):
    return spark.createDataFrame(list(rows.items()), "chunk_id string, text string")


def asked(spark, queries):
    return spark.createDataFrame(queries, "query_id long, text string")


QUERIES = [(1, "w0 w1 w2"), (2, "w299 w0"), (3, "nothing"), (4, ""), (5, " ".join(f"w{i}" for i in range(60))), (6, "W7 w7, w7!")]


@pytest.fixture(scope="module")
def rows():
    return made(3000) | {"d1": "", "d2": None, "d3": "w0 " * 5000, "d4": "w5 w5", "d5": "w5 w5"}


def test_search_against_plain_scores(spark, rows):
    store = Postings(spark, work_folder(spark, "terms"), buckets=3, part_rows=400)
    store.build(frame(spark, rows))
    for k in (1, 7, 200):
        assert got(store.search(asked(spark, QUERIES), k)) == plain_bm25(rows, QUERIES, k)
    assert got(store.search(asked(spark, []), 3)) == []
    with pytest.raises(ValueError):
        store.search(asked(spark, QUERIES), 0)


def test_more_terms_than_are_listed_give_the_same(spark, rows, monkeypatch):
    from docvec.operators import postings

    monkeypatch.setattr(postings, "LISTED_TERMS", 10)
    store = Postings(spark, work_folder(spark, "terms"), part_rows=1000)
    store.build(frame(spark, rows))
    assert got(store.search(asked(spark, QUERIES), 5)) == plain_bm25(rows, QUERIES, 5)


def test_updates_give_what_a_new_build_gives(spark, rows):
    store = Postings(spark, work_folder(spark, "terms"), part_rows=300)
    now = dict(rows)
    store.build(frame(spark, now))
    rng = random.Random(8)
    for turn in range(3):
        gone = rng.sample(sorted(now), 40)
        fresh = {f"n{turn}-{i}": t for i, t in enumerate(made(30, turn).values())}
        edited = {i: "w1 edited w2" for i in rng.sample(sorted(set(now) - set(gone)), 20)}
        back = {gone[0]: "w0 back again"}
        new = fresh | edited | back
        before = store.table._state(store.table.version())
        store.update(frame(spark, new), spark.createDataFrame([(g,) for g in gone], "chunk_id string"))
        now = {i: t for i, t in now.items() if i not in gone} | new
        assert got(store.search(asked(spark, QUERIES), 9)) == plain_bm25(now, QUERIES, 9)
    # One row rewrites one part.
    parts = store.table.read("part").distinct().count()
    before = store.table._state(store.table.version())
    store.update(frame(spark, {"n0-1": "w3"}), spark.createDataFrame([], "chunk_id string"))
    written = {b: [w for w in ws if w >= before.free] for b, ws in store.table._state(store.table.version()).held.items()}
    assert store.table._files_of(written).select("part").distinct().count() == 1 < parts


def test_most_blocks_are_not_scored():
    rng = np.random.default_rng(1)
    gathered = PartRows()
    for i in range(8000):
        counts = {"common": int(rng.integers(1, 3)), f"x{i % 50}": 1}
        if i % 400 == 7:
            counts["rare"] = 9
        gathered.add(f"{i:06d}", counts)
    part = Part(3.0)
    for r in gathered.blocks(0).to_pylist():
        part.add(r["term"], r["rows"], r["times"], r["most"], r["shortest"], r["ids"])
    part.ready()
    total = sum(map(len, part.blocks.values()))
    rows, scores = part.best([("common", 0.1), ("rare", 6.0)], 10, 0.0)
    assert len(rows) == 10 and all(r % 400 == 7 for r in rows)
    assert part.scored < 0.4 * (len(part.blocks["common"]) + len(part.blocks["rare"])) < total
    # A part that cannot reach the floor is not scored at all.
    before = part.scored
    assert len(part.best([("common", 0.1), ("x1", 0.5)], 10, 5.0)[0]) == 0 and part.scored == before


def test_empty_table(spark):
    store = Postings(spark, work_folder(spark, "terms"))
    store.build(frame(spark, {"a": None}))
    assert got(store.search(asked(spark, QUERIES), 3)) == []
    store.update(frame(spark, {"b": "w1"}), spark.createDataFrame([("a",)], "chunk_id string"))
    assert got(store.search(asked(spark, QUERIES), 3)) == [(1, "b", 1), (5, "b", 1)]


def test_stored_blocks_come_back_whole_and_rows_are_added_after_them():
    old, new = made(400, 1), {f"n{i}": t for i, t in enumerate(made(300, 2).values())}

    def part(rows):
        gathered = PartRows()
        for row_id, text in rows.items():
            gathered.add(row_id, lexical.term_counts(text))
        return gathered

    first = part(old).blocks(0)
    held = PartRows(ids=first["ids"][0].as_py())
    rest = first.slice(1)
    held.add_blocks(*(rest[c].to_pylist() for c in ("term", "n", "rows", "times")))
    held.add_rows(part(new))
    assert sorted(map(str, held.blocks(0).to_pylist())) == sorted(map(str, part(old | new).blocks(0).to_pylist()))


def test_parts_are_sorted_by_one_number(spark):
    """With two, Spark compares rows pair by pair: all of a part have the first in common."""
    store = Postings(spark, work_folder(spark, "terms"), part_rows=100)
    rows = spark.createDataFrame([("a", "w0 w1")], "id string, text string")
    plan = store._gathered(4, rows, None, None)._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [" in line]
    assert len(sorts) == 1 and sorts[0].count(" ASC ") == 1
