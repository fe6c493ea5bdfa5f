"""What keeps the chunk queries within memory and disk, on rows of their own."""

import hashlib

import pyarrow as pa
import pyarrow.parquet
import pytest
from pyspark.sql import functions as F

from checks import queries
from docvec.functions.chunking import SLICE_BYTES, slices, split_clean
from docvec.operators import changes
from docvec.operators.chunks import chunk_documents, chunk_keys, chunk_stats, chunks_to_embed, fold_documents, split_documents, unfold
from tests.test_chunking import by_rule

TEXTS = ["é", "ab", "x" * 199, "x" * 200, "y" * 201, "a. " * 400, "b" * 1200, "c" * 1201, "d. é" * 700 + "."]


@pytest.fixture
def folder(spark, tmp_path):
    """Documents of three languages: unchanged, changed at the end, and not taken in yet."""
    texts = [("en", "One. " * 300), ("de", "Zwei. " * 300), ("fr", "Trois. " * 300), ("en", "Short."), ("de", "x" * 150)]
    rows = [(i, t, lang, "src", len(t)) for i, (lang, t) in enumerate(texts)]
    # A document that comes twice, and two without a language.
    rows += [rows[1], (7, "None. " * 90, None, "src", 540), (8, "", None, "src", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_slices_are_bounded_in_bytes_and_rows():
    batch = pa.array(["x" * 2000] * 5000)
    parts = list(slices(batch, step=32))
    assert [t for p in parts for t in p] == batch.to_pylist()
    assert all(sum(map(len, p)) <= SLICE_BYTES for p in parts)
    assert all(len(p) % 32 == 0 for p in parts[:-1])
    assert max(map(len, slices(pa.array([""] * 5000)))) == 1024
    assert list(slices(pa.array(["x" * SLICE_BYTES] * 2))) == [["x" * SLICE_BYTES]] * 2


def test_a_batch_of_many_slices_keeps_its_rows(spark):
    df = spark.range(0, 3000, 1, 1).select("id", F.concat(F.col("id").cast("string"), F.lit(". x")).alias("t"))
    found = df.select("id", split_clean(F.col("t"), tail="compact").alias("p")).collect()
    assert all(r.p == [f"{r.id}. x"] for r in found) and len(found) == 3000


def test_folded_pieces_leave_the_tail_out_and_give_it_back(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    folded = fold_documents(docs, clean=True)
    assert folded.count() == split_documents(docs, tail="compact", clean=True).count()
    got = {}
    for r in unfold(folded).orderBy("id", "offset").collect():
        got.setdefault(r.id, []).append((r.offset, r.chunk))
    assert got == {i: list(enumerate(by_rule(t))) for i, t in enumerate(TEXTS)}
    named = docs.select(F.col("id").cast("string").alias("docId"), "text")
    counts = {r.docId: r.pieces for r in chunk_stats(named).collect()}
    assert counts == {str(i): len(by_rule(t)) for i, t in enumerate(TEXTS)}
    with pytest.raises(ValueError):
        fold_documents(docs, 50, 40)


def test_the_keyed_index_stores_no_suffixes(spark, folder):
    index = queries._keyed_index(spark, folder)
    stored = sum(pa.parquet.read_table(f.removeprefix("file:")).num_rows for f in set(index.inputFiles()))
    docs = queries.documents(spark, folder)
    assert stored == split_documents(docs.select("docId", "text"), tail="compact", clean=True).count()
    pieces = chunk_documents(docs).select("chunkId", "docId", "chunkHash", F.col("offset").cast("long"), "chunk")
    got = index.select("chunk_id", "doc_id", "chunk_hash", "offset", "text")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, pieces.collect()))
    value = hashlib.sha256(b".").hexdigest()
    found = queries.registry()["lookup_chunk"](spark, folder).collect()
    assert len(found) == sum(hashlib.sha256(r.chunk.encode()).hexdigest() == value for r in pieces.collect())


def test_unchanged_documents_are_not_split_to_compare_chunks(spark, folder):
    now = chunk_documents(queries.documents(spark, folder)).collect()
    had = chunk_documents(queries.earlier(spark, folder)).collect()
    pairs, ids = {(r.chunkId, r.chunkHash) for r in had}, {r.chunkId for r in had}
    fresh = [r for r in now if (r.chunkId, r.chunkHash) not in pairs]
    run = queries.registry()
    found = run["needs_indexing"](spark, folder)
    assert sorted(map(tuple, found.collect())) == sorted((r.chunkId, r.chunkHash) for r in fresh)
    told = run["classify_index_changes"](spark, folder)
    assert sorted(map(tuple, told.collect())) == sorted((r.chunkId, r.docId, r.chunkId in ids) for r in fresh)
    total = next(r for r in run["shard_ops"](spark, folder).collect() if r.shard is None)
    assert (total.added, total.updated) == (len(fresh), sum(r.chunkId in ids for r in fresh))
    # No chunk of a named document meets another in a join: they are split above it.
    for df in (found, told):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "collect_set(text" in plan and plan.index("compared(") < plan.index("collect_set(text")


def test_chunks_to_embed_are_found_by_one_worker_and_without_a_shuffle_of_chunks(spark, folder):
    had = queries.earlier(spark, folder)
    had = had.withColumns({"embedder": F.lit("m"), "embedder_ver": F.when(F.col("title").startswith("Zwei"), "1").otherwise("2")})
    docs = queries.documents(spark, folder)
    # Rows without an id, on both sides, and an id that comes with two earlier texts.
    none = F.lit(None).cast("string").alias("docId")
    short = F.col("title") == "Short."
    docs = docs.unionByName(docs.filter(short).select(*[none if c == "docId" else c for c in docs.columns]))
    had = had.unionByName(had.filter(short).select(*[none if c == "docId" else c for c in had.columns]))
    more = had.filter(F.col("title").startswith("One")).withColumn("text", F.concat("text", F.lit(" More.")))
    had = had.unionByName(more.withColumn("contentHash", F.sha2("text", 256)))
    now = chunk_documents(docs)
    made = had.filter(F.col("docId").isNotNull()).select("docId", F.col("contentHash").alias("docHash"), "embedder", "embedder_ver")
    stored = chunk_documents(had).join(made.distinct(), ["docId", "docHash"])
    want = changes.chunks_to_embed(now, stored, "m", "2").select("chunkId", "chunkHash", "offset")
    found = chunks_to_embed(docs, had, "m", "2").select("chunkId", "chunkHash", "offset")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    assert 0 < found.count() < now.count() == chunks_to_embed(docs, had, "other", "2").count()
    for name in ("needs_embedding", "needs_indexing", "changed_chunks", "classify_index_changes"):
        tree = queries.registry()[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        # Every text of a document is compared once; classify_index_changes reads its two parts.
        parts = 2 if name == "classify_index_changes" else 1
        assert tree.count("ArrowEvalPython [compared(") == parts
    plan = queries.needs_embedding(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("compared(") < plan.index("collect_set(text")


def test_keys_of_chunks_are_found_without_a_worker(spark, folder):
    rows = [("a", "h1", "one. two"), ("b", "h2", ""), ("c", "h3", None), (None, "h4", "x"), ("a", "h5", "y" * 3000), ("a", "h1", "one. two")]
    docs = spark.createDataFrame([(*r, "en", "t") for r in rows], "docId string, contentHash string, text string, language string, title string")
    plain = set(map(tuple, chunk_documents(docs).select("docId", "docHash").distinct().collect()))
    found = chunk_keys(docs)
    assert set(map(tuple, found.collect())) == plain == {("a", "h1"), (None, "h4"), ("a", "h5")}
    for name in ("existing_keys", "docs_needing_chunks"):
        plan = getattr(queries, name)(spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan
