from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from docvec.llm import phrases as P

A_Z = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_counts(rows):
    """rows: (lang, text). Counts of phrases of up to three words, and words of each language."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(A_Z)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                f.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
    return f, n


def plain_collocations(rows, top=2000):
    f, n = plain_counts(rows)
    found = {}
    often = {p: a for p, a in f.items() if len(p) > 2 and a >= 10}
    covered = Counter()
    for p, a in often.items():
        if len(p) == 4:
            for part in (p[:3], (p[0], *p[2:])):
                covered[part] = max(covered[part], a)
    for (lang, *words), a in often.items():
        if 100 * covered[lang, *words] >= 50 * a:
            continue
        cuts = [(f[lang, *words[:k]], f[lang, *words[k:]]) for k in range(1, len(words))]
        score, _, l, r = min((10**6 * a * a // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, n[lang], -s)
        for lang, of in found.items() for rank, (s, a, p, l, r) in enumerate(sorted(of)[:top], 1)
    )


def made_rows():
    rng = random.Random(11)
    words = ["the", "The", "of", "a", "Über", "ÜBER", "naïve", "x-y", "|", "new", "york", "city", "per", "se"]
    def text(n):
        out = []
        while len(out) < n:
            out += ["new", "york", "city"] if rng.random() < 0.1 else ["per", "se"] if rng.random() < 0.1 else [rng.choice(words)]
        return "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", "\n", " ,", "\r\n"] if rng.random() < 0.3 else [" "]) for w in out)
    rows = [(rng.choice(["en", "de", None, ""]), text(rng.randint(0, 120))) for _ in range(300)]
    return rows + [("en", None), ("xx", ""), ("xx", " .\t\n"), (None, text(20_000)), ("yy", "rare words here " * 9),
                   ("hot", "so it goes " * 20_000), ("hot", "so it goes"), ("tie", "a b c d. " * 12)]


@pytest.fixture(scope="module")
def made(spark):
    rows = made_rows()
    return rows, spark.createDataFrame([(*r, "x", 3) for r in rows], "lang string, text string, phrase string, n int")


def test_collocations_against_plain_counts(made):
    rows, docs = made
    got = P.collocations(docs.repartition(5))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(rows)
    assert sorted(tuple(r) for r in P.collocations(docs, top=3).collect()) == plain_collocations(rows, 3)


def test_counts_with_small_blocks_and_buckets(made):
    rows, docs = made
    f, n = plain_counts(rows)
    totals, levels = P.phrases(docs.repartition(3), block_words=700, bucket_bytes=20_000)
    assert {r.lang: r.n for r in totals.collect() if r.n} == {k: v for k, v in n.items() if v}
    for depth, level in enumerate(levels, 1):
        want = {(p[0], " ".join(p[1:])): a for p, a in f.items() if len(p) == depth + 1 and a >= 10}
        assert {(r.lang, r.phrase): r.n for r in level.collect()} == want


def test_stretches_give_all_words(monkeypatch):
    monkeypatch.setattr(P, "STRETCH_BYTES", 40)
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice("ab é.\n\t  ") for _ in range(rng.randint(0, 400))).encode() + b"w" * rng.choice((0, 90))
        got = [w for s in P.tokens_of(text) for w in s]
        assert got == [w for w in text.translate(P._MARKS).replace(b".", b" . ").replace(b"\t", b" ").split(b" ") if w]


@pytest.mark.parametrize("small", [0, 7, 256, 10_000])
def test_quicksort_counts_equal_suffixes(monkeypatch, small):
    monkeypatch.setattr(P, "SMALL", small)
    rng = np.random.default_rng(4)
    columns = [rng.integers(0, 12, 4000).astype(np.int32) for _ in range(3)]
    weight = rng.integers(1, 5, 4000)
    want = Counter()
    for a, b, c, w in zip(*columns, weight):
        want[a, b, c] += int(w)
    got = {tuple(c[p] for c in columns): n for p, n in P.quicksort(columns, weight, 10)}
    assert got == {k: v for k, v in want.items() if v >= 10}
    assert not list(P.quicksort([np.empty(0, np.int32)], np.empty(0, np.int64), 1))


def test_sql_gives_the_same(spark, made, tmp_path):
    made[1].write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(P.OP11_SQL)
    names = [c[0] for c in want.description]
    assert sorted(tuple(r) for r in P.op11_phrases(spark, str(tmp_path)).select(*names).collect()) == sorted(want.fetchall())


def test_scores_beyond_64_bits(spark, monkeypatch):
    level = lambda *rows: spark.createDataFrame(rows, "lang string, phrase string, n long")
    big = 4_000_000_000_000
    levels = [level(("en", "a", big), ("en", "b", big + 1)), level(("en", "a b", big - 7)), level(("en", "x y z", 10))]
    totals = spark.createDataFrame([("en", big * 9)], "lang string, n long")
    monkeypatch.setattr(P, "phrases", lambda *_: (totals, levels))
    rows = P.collocations(spark.range(1).select(F.lit("en").alias("lang"), F.lit("").alias("text"))).collect()
    assert [(r.phrase, r.score) for r in rows] == [("a b", 10**6 * (big - 7) ** 2 // (big * (big + 1)))]


def test_empty_tables(made):
    _, docs = made
    for some in (docs.filter("false"), docs.filter("text is null"), docs.filter("lang = 'xx'")):
        assert P.collocations(some).count() == 0
