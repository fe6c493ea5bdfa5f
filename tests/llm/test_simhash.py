from __future__ import annotations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from docvec.llm import graph, simhash
from tests.llm.conftest import words


def plain_fingerprint(text):
    parts = [w for w in (text or "").encode().lower().split()]
    if not parts:
        return 0
    grams = [b" ".join(parts[i : i + 3]) for i in range(max(1, len(parts) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: dict[int, int]) -> dict[int, int]:
    ids = sorted(prints)
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if bin(prints[a] ^ prints[b]).count("1") <= 3 and label[b] > label[a]:
                    label[b], changed = label[a], True
    return label


def test_fingerprint_matches_brute_force_and_spark_hash(spark):
    for text in (None, "", "  ", "One", "One two", words(50, 1), words(50, 1).upper(), "é É a b", "a " * 500):
        assert simhash.text_fingerprint(text.encode() if text else None) == plain_fingerprint(text)
    row = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()
    assert row[0] & (2**64 - 1) == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("differing", [1, 2, 3])
def test_variants_meet_at_every_distance_up_to_three(differing):
    rng = np.random.default_rng(differing)
    masks = simhash.variants()
    for _ in range(300):
        a = int(rng.integers(-(2**63), 2**63 - 1))
        b = a
        for bit in rng.choice(64, differing, replace=False):
            b ^= simhash._signed(1 << int(bit))
        assert {(a & k) ^ f for k, f in masks} & {(b & k) ^ f for k, f in masks}


def test_links_connect_what_brute_force_connects(spark):
    rng = np.random.default_rng(5)
    prints = {0, -1}
    for _ in range(12):
        base = int(rng.integers(-(2**63), 2**63 - 1))
        for _ in range(12):
            flips = rng.choice(64, int(rng.integers(0, 6)), replace=False)
            v = base
            for bit in flips:
                v ^= simhash._signed(1 << int(bit))
            prints.add(v)
    frame = spark.createDataFrame([(v,) for v in prints], "f long")
    found = {r.node: r.root for r in graph.components(simhash.links(frame)).collect()}
    unsigned = {v: v & (2**64 - 1) for v in prints}
    expect = plain_components(unsigned)
    assert {v: found.get(v, v) for v in prints} == expect
    pairs = simhash.links(frame).collect()
    assert pairs and all(bin(unsigned[p.a] ^ unsigned[p.b]).count("1") <= 3 for p in pairs)


def test_components_of_a_chain_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    found = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    label = {r.node: r.root for r in found}
    assert len(found) == len(label) == 41 + 40 + 2
    assert {label[i] for i in range(41)} == {0}
    assert {label[i] for i in range(100, 140)} == {100}
    assert label[201] == 200


def test_edge_rows(edge_docs):
    rows = simhash.near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    of = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert of[0].fingerprint == of[1].fingerprint == of[2].fingerprint == 0
    assert {of[i].component_id for i in (0, 1, 2)} == {0}
    assert of[5].component_id == of[6].component_id == 5
    kept = simhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [0, 3, 4, 5] and ids.count(None) == 2


def test_more_looks_link_more_near_copies_and_nothing_else(docs_of):
    import random

    texts = []
    for i in range(40):
        text = words(300, i)
        parts = text.split()
        parts[random.Random(i).randrange(300)] = "altered"
        texts += [text, " ".join(parts), words(300, 5000 + i)]
    docs = docs_of(texts)

    def linked(looks):
        rows = simhash.near_duplicates(docs, looks=looks).collect()
        of = {r.doc_id: r.component_id for r in rows}
        for i in range(0, len(texts), 3):
            assert of[i] == i and of[i + 2] == i + 2 and of[i + 1] in (i, i + 1)
        return sum(of[i + 1] == i for i in range(0, len(texts), 3))

    one, three = linked(1), linked(3)
    plain = 0
    for i in range(0, len(texts), 3):
        near = [
            bin(simhash.text_fingerprint(texts[i].encode(), look=k) ^ simhash.text_fingerprint(texts[i + 1].encode(), look=k)).count("1") <= 3
            for k in range(3)
        ]
        plain += any(near)
    assert one <= three == plain and three >= 30


def test_empty_table(edge_docs):
    none = edge_docs.filter("false")
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one(none).count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in simhash.op9_simhash(spark, sf).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r.component_id for i, r in got.items()} == plain_components(prints)
