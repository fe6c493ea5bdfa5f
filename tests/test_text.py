import hashlib

import pytest
from pyspark.sql import functions as F

from docvec.functions import text as T
from docvec.operators.normalize import normalize_documents


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("This   is   a   test   string.  ", "This is a test string."),
        ("Hello\tworld\nthis is\na test", "Hello world this is a test"),
        ("   \n\t   ", ""),
        ("\x01 edge \x1f", "edge"),
        ("a\x0bb\fc\rd", "a b c d"),
        (" kept ", " kept "),
    ],
)
def test_whitespace(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "t string")
    row = df.select(T.normalize_whitespace("t"), T.has_visible("t")).first()
    assert row[0] == clean
    assert row[1] == (clean != "")


def test_ids(spark):
    df = spark.createDataFrame([("u", 3)], "u string, o int")
    doc = hashlib.sha256(b"u").hexdigest()
    chunk = hashlib.sha256(f"{doc}:3".encode()).hexdigest()
    row = df.select(T.doc_id("u"), T.chunk_id(T.doc_id("u"), "o")).first()
    assert (row[0], row[1]) == (doc, chunk)


def test_title_stops_at_80_and_at_a_line_end(spark):
    df = spark.createDataFrame([("x" * 100,), ("ab\ncd",), ("",)], "t string")
    assert [r[0] for r in df.select(T.title_of("t")).collect()] == ["x" * 80, "ab", ""]


def test_html(spark):
    page = (
        "<!DOCTYPE html><html><head><style>p{}</style><SCRIPT>var a='<p>';</SCRIPT></head>"
        "<body><!-- no --><p>A&amp;lt;B</p>\n<p>C&nbsp;&quot;D&quot;</p></body></html>"
    )
    df = spark.createDataFrame([(page,), (None,)], "h string")
    got = [r[0] for r in df.select(T.html_to_text("h")).collect()]
    assert got == ['A&lt;B C "D"', ""]


def test_shards_need_one(spark):
    with pytest.raises(ValueError):
        T.shard_of("docId", 0)


def test_empty_documents_are_dropped(spark):
    raw = spark.createDataFrame(
        [("a", " x  y "), ("b", " \n"), ("c", None), ("d", "")], "uri string, text string"
    )
    rows = normalize_documents(raw).collect()
    assert [(r.uri, r.text, r.language, r.title) for r in rows] == [("a", "x y", "en", "x y")]
    own = normalize_documents(raw.withColumn("l", F.lit("de")), F.col("l")).first()
    assert own.language == "de"
