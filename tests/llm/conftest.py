from __future__ import annotations

import random

import pytest

WORDS = "the of and to in is that river stone light green house quick brown under over seven winter".split()
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(texts, sources=None, ids=None, **extra):
        rows = []
        for i, text in enumerate(texts):
            source = sources[i] if sources else "a"
            doc_id = ids[i] if ids else i
            rows.append((doc_id, text, "en", source, len(text or "")) + tuple(v[i] for v in extra.values()))
        kinds = "".join(f", {name} string" for name in extra)
        return spark.createDataFrame(rows, COLUMNS + kinds)

    return make


@pytest.fixture(scope="session")
def edge_docs(docs_of):
    """Nulls in every column, empty and long texts, repeated rows, clashing names."""
    texts = [None, "", "   ", "one", words(30_000, 1), words(80, 2), words(80, 2), words(80, 3), words(80, 4)]
    ids = [0, 1, 2, 3, 4, 5, 6, None, None]
    docs = docs_of(texts, ["a", None, "a", "b", "b", None, "a", "b", "a"], ids, shard=["x"] * 9, size=["y"] * 9)
    return docs.union(docs.filter("doc_id = 5"))
