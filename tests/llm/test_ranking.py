from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from docvec.llm import ranking as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
A_Z = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_terms(text):
    return TERM.findall((text or "").translate(A_Z))


def plain_search(docs, items, k=10):
    """docs, items: lists of (id, text)."""
    counts = [(d, Counter(plain_terms(t))) for d, t in docs]
    n_docs = sum(1 for _, c in counts if c)
    length = sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    merged = {}
    for i, t in items:
        merged.setdefault(i, set()).update(plain_terms(t))
    out = []
    for item, terms in merged.items():
        found = []
        for d, c in counts:
            if not c:
                continue
            m = 100 - 90 + (90 * c.total() * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms if c[t]
            )
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1)]
    return out


def key(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (str(r[0]), r[1]))


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["Über", "ÉCOLE", "naïve", "x1"]
    text = lambda n: " ,\n-".join(rng.choice(words[: rng.choice((8, 64))]) for _ in range(n))
    docs = [(i, text(rng.randint(0, 60))) for i in range(400)]
    docs += [(3, docs[3][1]), (None, docs[5][1]), (None, None), (900, None), (901, ""), (902, text(30_000)), (903, "W1 w1 w1")]
    common = [text(12) for _ in range(4)]
    items = [(i, " ".join(rng.sample(common, rng.randint(1, 3))) + " " + text(rng.randint(0, 9))) for i in range(70)]
    return docs, items + [(70, None), (71, "--"), (72, "absent"), (None, "w3 w4"), (5, "w7 W7"), (73, "w1 " * 5000)]


def frames(spark, docs, items):
    extra = [(*d, "x", 1) for d in docs]
    return (
        spark.createDataFrame(extra, "doc_id long, text string, item string, score int"),
        spark.createDataFrame([(*i, 7) for i in items], "item_id long, text string, rank int"),
    )


def test_search_against_plain_scores(spark, tables):
    docs, items = frames(spark, *tables)
    want = key(plain_search(*tables))
    assert key(R.search(docs.repartition(7), items).collect()) == want
    assert key(R.search(docs, items, block_terms=200).collect()) == want


def test_sql_gives_the_same(spark, tables, tmp_path):
    con = duckdb.connect()
    for name, frame in zip(("documents", "benchmark"), frames(spark, *tables)):
        frame.write.parquet(str(tmp_path / f"{name}.parquet"))
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    want = con.execute(R.OP12_SQL)
    names = [c[0] for c in want.description]
    assert key(R.op12_search(spark, str(tmp_path)).select(*names).collect()) == key(want.fetchall())


def test_shared_sets_add_up_to_items_with_fewer_additions():
    rng = random.Random(1)
    pools = [rng.sample(range(200), 15) for _ in range(6)]
    items = [sorted({*rng.choice(pools), *rng.choice(pools), *rng.sample(range(200), 3)}) for _ in range(80)]
    terms = sorted({t for i in items for t in i})
    items = [[terms.index(t) for t in i] for i in items]
    sharing = R.share(items, len(terms))
    parts = {a: Counter(np.flatnonzero(sharing.atom == a).tolist()) for a in range(sharing.atom.max() + 1)}
    for n, (a, b) in enumerate(zip(sharing.left, sharing.right), len(parts)):
        parts[n] = parts[a] + parts[b]
    ends = [*sharing.starts[1:], len(sharing.members)]
    for item, first, last in zip(items, sharing.starts, ends):
        assert sum((parts[m] for m in sharing.members[first:last]), Counter()) == Counter(item)
    # Additions with the graph against one for each term of each item.
    assert len(sharing.left) + len(sharing.members) + len(terms) < 0.5 * sum(map(len, items))


def test_edges(spark, tables):
    docs, items = frames(spark, *tables)
    for some, of in ((docs.filter("false"), items), (docs, items.filter("false")), (docs.filter("text is null"), items)):
        found = R.search(some, of)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0
    with pytest.raises(ValueError):
        R.search(docs, items, k=0)
    one = R.search(docs, items, k=1).collect()
    assert {(r.item_id, r.rank, r.doc_id, r.score) for r in one} == {r for r in plain_search(*tables) if r[1] == 1}
