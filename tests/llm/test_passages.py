from __future__ import annotations

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from docvec.llm import passages as P
from tests.llm.conftest import words


def plain(docs):
    """(kept words, removed) of each document by comparing all windows."""
    first, out = {}, {}
    for i in sorted(docs):
        parts = (docs[i] or "").encode().split()
        gone = [False] * len(parts)
        for j in range(len(parts) - P.WINDOW + 1):
            if first.setdefault(tuple(parts[j : j + P.WINDOW]), i) < i:
                gone[j : j + P.WINDOW] = [True] * P.WINDOW
        out[i] = (b" ".join(w for w, g in zip(parts, gone) if not g).decode(), sum(gone))
    return out


def test_gram_hashes_depend_on_their_words_alone():
    a, b = words(90, 1).encode().split(), words(200, 2).encode().split()
    b[70:130] = a[10:70]
    for size in (P.PHRASE, P.WINDOW):
        x, y = (P.gram_hashes(P.word_hashes(t), size) for t in (a, b))
        assert (x[10 : 71 - size] == y[70 : 131 - size]).all() and len(np.unique(x)) == len(x)
        assert len(P.gram_hashes(P.word_hashes(a[: size - 1]), size)) == 0


def mixed_texts():
    rng = random.Random(8)
    shared = [words(n, 500 + n) for n in (30, 49, 50, 51, 60, 75, 76, 120, 400)]
    out = []
    for i in range(60):
        pieces = [words(rng.randrange(0, 60), i)]
        for _ in range(rng.randrange(0, 4)):
            part = rng.choice(shared).split()
            if rng.random() < 0.4:
                cut = rng.randrange(len(part))
                part = part[cut:] if rng.random() < 0.5 else part[: cut + 50]
            if rng.random() < 0.2:
                part[rng.randrange(len(part))] = "altered"
            pieces += [" ".join(part), words(rng.randrange(0, 30), 1000 + i)]
        out.append(rng.choice([" ", "\n", " \t "]).join(pieces))
    return out + [out[3], out[3], "same word " * 300, "same word " * 200, words(49, 3), words(49, 3), "", None]


def test_against_all_windows(docs_of):
    texts = mixed_texts()
    got = {r.doc: r for r in P.repeats(docs_of(texts)).collect()}
    want = plain(dict(enumerate(texts)))
    assert set(got) == {i for i, (_, n) in want.items() if n} and len(got) > 20
    for i, r in got.items():
        assert (r.kept, r.n_removed) == want[i]
        assert sum(s.end - s.start for s in r.spans) == r.n_removed


def test_many_shards_give_the_same(docs_of, monkeypatch):
    monkeypatch.setattr(P, "SHARD_WORDS", 700)
    texts = mixed_texts()
    want = plain(dict(enumerate(texts)))
    got = {r.doc: r.kept for r in P.repeats(docs_of(texts)).collect()}
    assert got == {i: kept for i, (kept, n) in want.items() if n}


def test_edge_rows(edge_docs):
    rows = {r.doc: r for r in P.repeats(edge_docs).collect()}
    assert set(rows) == {6} and rows[6].kept == "" and rows[6].n_removed == 80
    assert P.repeats(edge_docs.filter("false")).count() == 0
    unicode_blank = edge_docs.filter("doc_id = 5").withColumn("text", F.lit("a b c \x1c d"))
    assert P.repeats(unicode_blank).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = plain(texts)
    rows = P.op7_passages(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        kept, removed = want[r.doc_id]
        assert (r.n_words, r.n_removed) == (len(texts[r.doc_id].encode().split()), removed)
        assert r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_gram_hashes_do_not_depend_on_what_came_before():
    words = [b"w%d" % (i % 97) for i in range(6000)]
    hashes = P.word_hashes(words)
    short = P.gram_hashes(hashes[:60], 50)
    P._POWERS.clear()
    long = P.gram_hashes(hashes, 50)
    assert (long[:11] == short).all() and (long[97:108] == short).all()
    # A longer text has its powers worked out once, not those of every text anew.
    held = P._powers(10)
    assert P._powers(6000) is held and len(held[0]) == 6000
