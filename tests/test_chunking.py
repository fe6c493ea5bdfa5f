import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docvec.functions.chunking import split_clean, walk
from docvec.operators.chunks import chunk_documents, chunk_stats, split_documents
from docvec.operators.normalize import normalize_documents


def by_rule(text, max_chars=1200, overlap=200):
    """The rule read literally, one step at a time."""
    out, pos = [], 0
    while pos < len(text):
        part = text[pos : pos + max_chars]
        cut = max((i for i, ch in enumerate(part) if ch in ".\n"), default=-1)
        piece = part[: cut + 1] if cut >= int(max_chars * 0.6) else part
        out.append(piece)
        pos += max(len(piece) - overlap, 1)
    return out


@settings(max_examples=300, deadline=None)
@given(
    st.text(alphabet="ab. é", max_size=400),
    st.integers(1, 60),
    st.integers(0, 59),
)
def test_walk_follows_the_rule(text, max_chars, overlap):
    if overlap >= max_chars:
        overlap = max_chars - 1
    expected = by_rule(text, max_chars, overlap)
    assert walk(text, max_chars, overlap, False) == expected
    compact = walk(text, max_chars, overlap, True)
    assert compact == expected[: len(compact)]
    assert all(text.endswith(p) and compact[-1].endswith(p) for p in expected[len(compact) :])


def test_fixtures():
    assert walk("AB", 1200, 200, False) == ["AB", "B"]
    assert len(walk("x" * 2500, 1200, 200, False)) == 203
    sentences = "This is sentence one. This is sentence two. This is sentence three."
    assert walk(sentences, 40, 5, False) == [
        "This is sentence one. This is sentence t", "nce two. This is sentence three.",
        "hree.", "ree.", "ee.", "e.", ".",
    ]


@pytest.mark.parametrize("bad", [(100, 100), (100, 200), (100, -1)])
def test_overlap_must_be_below_the_size(bad):
    with pytest.raises(ValueError):
        split_clean(F.col("t"), *bad)
    with pytest.raises(ValueError):
        split_clean(F.col("t"), 10, 2, "other")


def test_rows_on_spark(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices("ab. \né", k=n)) for n in (0, 1, 150, 1199, 1200, 5000, 9000)]
    df = spark.createDataFrame(list(enumerate(texts)) + [(99, None)], "id int, text string")
    for args in [(1200, 200), (50, 10), (40, 39)]:
        got = {}
        for r in split_documents(df, *args).orderBy("id", "offset").collect():
            got.setdefault(r.id, []).append(r.chunk)
        for i, t in enumerate(texts):
            clean = " ".join(t.replace("\n", " ").split(" ")).strip()
            clean = " ".join(clean.split())
            assert got.get(i, []) == by_rule(clean, *args)
        assert 99 not in got


def test_messy_input_leaves_no_breaks(spark):
    df = spark.createDataFrame([("one\n\ntwo  three " * 30,)], "text string")
    pieces = [r.chunk for r in split_documents(df, 50, 10).collect()]
    assert pieces and not any("\n" in p or "  " in p for p in pieces)


def test_text_is_split_once(spark):
    """A filter inferred from the explode must not run the splitter a second time."""
    raw = spark.range(4).select(F.col("id").cast("string").alias("uri"), F.lit("a. b").alias("text"))
    docs = normalize_documents(raw.repartition(2))
    plan = chunk_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_stats(spark):
    docs = normalize_documents(spark.createDataFrame([("u", "x" * 2500)], "uri string, text string"))
    row = chunk_stats(docs).first()
    assert (row.chars, row.pieces, row.avg_chars) == (2500, 203, 12)
