from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docvec.llm import mixing
from docvec.llm.common import hash_unit, stored
from tests.llm.conftest import words


def plain_targets(sizes: dict, weights=(5, 2, 1), share=1.5, most=2.0) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, full = {}, set()
    while True:
        rest = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        open_ = [s for s in order if s not in full]
        target = {s: most * sizes[s] for s in full} | {
            s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_
        }
        over = {s for s in open_ if target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1, "b": 1000, "c": 10, None: 5, "é": 77, "z": 0},
        {"one": 9},
        {"a": 0, "b": 0},
    ],
)
def test_targets_match_resharing(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_mix_comes_near_its_targets_and_is_the_same_again(docs_of):
    n = 600
    texts = [words(1 + (i * 37) % 90 + (2000 if i % 97 == 0 else 0), i) for i in range(n)]
    docs = docs_of(texts, [["a", "b", "c", None][i % 4 if i % 3 else 0] for i in range(n)])
    got = mixing.mix(docs)
    sums = got.groupBy("source").agg(
        F.sum(F.col("mix_size") * F.col("mix_copies")).alias("taken"), F.first("mix_target").alias("target")
    )
    for row in sums.collect():
        assert abs(row.taken - row.target) <= 0.03 * row.target
    assert {r.mix_copies for r in got.collect()} <= {0, 1, 2}
    again = mixing.mix(docs.repartition(7))
    key = lambda df: sorted((r.doc_id, r.mix_copies) for r in df.collect())
    assert key(got) == key(again)


def plain_best(sizes, target):
    """Words nearest to the target that copies of 0 to 2 of some documents give."""
    copies = int(target // sum(sizes))
    sums = {copies * sum(sizes)}
    for n in sizes:
        sums |= {s + n for s in sums}
    return min(abs(s - target) for s in sums)


def taken(got):
    return {
        r.source: (r.taken, r.target)
        for r in got.groupBy("source").agg(
            F.sum(F.col("mix_size") * F.col("mix_copies")).alias("taken"), F.first("mix_target").alias("target")
        ).collect()
    }


def test_small_sources_with_long_documents_come_near_too(docs_of):
    sizes = {"a": [500, 400], "b": [60, 20, 20], "c": [900, 30, 20, 10, 5, 5, 3, 2, 1], "d": [1000] + [7] * 40, "e": [1, 2, 3]}
    texts = [(s, words(n, 100 + i)) for s, of in sizes.items() for i, n in enumerate(of)]
    got = mixing.mix(docs_of([t for _, t in texts], [s for s, _ in texts]))
    for source, (words_, target) in taken(got).items():
        # Of what can be reached at all, within the smallest document or a twentieth.
        assert abs(words_ - target) <= plain_best(sizes[source], target) + max(min(sizes[source]), 0.1 * target), (source, words_, target)
    assert {r.mix_copies for r in got.collect()} <= {0, 1, 2}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sources_of_the_given_tables_end_within_a_small_document(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    got = mixing.mix(docs).select("source", "mix_size", "mix_target", "mix_copies")
    left = dict(got.groupBy("source").agg(F.max("mix_size")).collect())
    off = {s: (abs(n - target), target) for s, (n, target) in taken(got).items()}
    far = {s: o for s, o in off.items() if o[0] > 0.05 * o[1]}
    # Sources of ten documents, of which one is longer than all that is missing.
    assert all(o <= 0.6 * left[s] for s, (o, _) in far.items()), far
    assert len(far) <= (0.25 if sf == "sf0.001" else 0) * len(off), far


def test_inclusion_frequencies_are_the_chances(spark):
    """Over many seeds a document comes as often as its chance says, which falls with its size.
    Each seed is a source of its own here, so that one plan serves all."""
    lengths, seeds = [5, 9, 20, 40, 90, 200, 450], 120
    rows = [(f"s{s:03d}", lengths[i % 7], i) for s in range(seeds) for i in range(700)]
    rows = spark.createDataFrame(rows, "source string, size long, doc int")
    rows = stored(rows.withColumn("u", hash_unit("source", "doc")), "rows")
    plan = mixing.mix_plan(rows, weights=(1.0,), share=0.6)
    p = plan.first()
    assert p.copies == 0 and sum(100 * n * min(1.0, p.level / n.bit_length()) for n in lengths) == pytest.approx(p.gap_1)
    found = mixing._with_plan(rows, plan).groupBy("size").agg(F.avg(mixing._extra()).alias("c"))
    shares = {r.size: r.c for r in found.collect()}
    for n, share in shares.items():
        assert share == pytest.approx(min(1.0, p.level / n.bit_length()), abs=0.02), shares
    assert shares[5] > shares[40] + 0.1 > shares[450] + 0.2
    # The sample has a fixed size in words.
    sums = mixing._with_plan(rows, plan).groupBy("source").agg(F.sum(F.col("size") * mixing._extra()).alias("n"))
    assert all(abs(r.n - p.target) <= 0.01 * p.target for r in sums.collect())


def test_clashing_columns(docs_of):
    names = ["mix_copies", "mix_size", "rank", "copies", "size", "u", "level", "last", "s"]
    docs = docs_of([words(9, i) for i in range(30)], **{n: ["x"] * 30 for n in names})
    got = mixing.mix(docs)
    assert sorted(got.columns) == sorted({*docs.columns, *mixing.MIXED})
    assert all(r["rank"] == r.u == "x" and r.mix_copies in (0, 1, 2) for r in got.collect())
    kept = mixing.take(docs)
    assert kept.columns == docs.columns and all(r.mix_copies == "x" for r in kept.collect())


def test_edge_rows(edge_docs):
    got = mixing.mix(edge_docs)
    assert got.columns == [*edge_docs.columns, "mix_size", "mix_source_size", "mix_target", "mix_copies"]
    rows = got.collect()
    assert len(rows) == edge_docs.count()
    assert {r.mix_size for r in rows if r.doc_id in (0, 1, 2)} == {0}
    assert mixing.take(edge_docs).columns == edge_docs.columns
    assert mixing.take(edge_docs.filter("false")).count() == 0
    assert mixing.mix(edge_docs.filter("false")).count() == 0
