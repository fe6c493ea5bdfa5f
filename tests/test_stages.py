"""The incremental scenario: first run, additions, edits, no change, reverts."""

import hashlib

import pytest

from docvec.functions.text import shard_of
from docvec.operators.changes import compare
from docvec.operators.chunks import chunk_documents
from docvec.operators.embed import hashed_embed
from docvec.operators.index import lookup
from docvec.operators.normalize import normalize_documents
from docvec.options import Options
from docvec.plans import stages
from docvec.sources.storage import work_folder

LONG = " ".join(f"Sentence number {i} of the text." for i in range(120))
OPTIONS = Options(tail="compact", num_shards=3, table_buckets=4)


@pytest.fixture(autouse=True)
def narrow(monkeypatch, request):
    """Little tables: whatever changes is a large share. The scenario runs both ways."""
    monkeypatch.setattr(stages, "NARROW", getattr(request, "param", 1.0))


def docs(spark, texts):
    return spark.createDataFrame(sorted(texts.items()), "uri string, text string")


def seven():
    return {f"doc://{i}": f"Document {i}. {LONG}" for i in range(7)}


class Runner:
    def __init__(self, spark, options=OPTIONS):
        self.spark, self.options, self.path = spark, options, work_folder(spark, "store")

    def run(self, texts, embed=hashed_embed, options=None, **kw):
        df = texts if not isinstance(texts, dict) else docs(self.spark, texts)
        self.store, audit = stages.run_stages(
            self.spark, self.path, stages.from_table(df), options or self.options, embed, **kw
        )
        return {(e[1], e[3]): e[4] for e in audit.events if e[3]}

    def versions(self):
        s = self.store
        return [t.version() for t in (s.documents, s.chunks, s.embeddings, s.indexed, s.index)]

    def check(self, texts, options=None):
        """All tables hold exactly what a fresh run over these texts would give."""
        o = options or self.options
        want_docs = normalize_documents(docs(self.spark, texts))
        pieces = chunk_documents(want_docs, o.max_chars, o.overlap, o.tail)
        rows = lambda df, *c: sorted(tuple(r) for r in df.select(*c).collect())
        s = self.store
        assert rows(s.documents.read(), "docId", "contentHash") == rows(want_docs, "docId", "contentHash")
        keys = ["chunkId", "docId", "docHash", "offset", "chunkHash"]
        assert rows(s.chunks.read(), *keys) == rows(pieces, *keys)
        pair = rows(pieces, "chunkId", "chunkHash")
        mine = s.embeddings.read().filter(f"embedder_ver = '{o.embed_ver}'")
        assert rows(mine, "chunkId", "chunkHash") == pair
        assert rows(s.indexed.read(), "chunkId", "chunkHash") == pair
        placed = pieces.withColumn("shard", shard_of("docId", o.num_shards))
        assert rows(s.index.read(), "chunk_id", "doc_id", "shard") == rows(placed, "chunkId", "docId", "shard")


@pytest.mark.parametrize("narrow", [1.0, 0.1], indirect=True)
def test_scenario(spark):
    r, texts = Runner(spark), seven()
    seen = r.run(texts)
    assert seen["normalize", "new"] == 7 and seen["index", "indexed"] == seen["chunk", "chunks"]
    r.check(texts)

    texts |= {"doc://7": LONG, "doc://8": "short"}
    seen = r.run(texts)
    assert (seen["normalize", "new"], seen["normalize", "changed"]) == (2, 0)
    assert seen["chunk", "documents"] == 2 and seen["embed", "embedded"] == seen["chunk", "chunks"]
    r.check(texts)

    before = dict(texts)
    texts["doc://3"] = "E" + texts["doc://3"][1:]
    seen = r.run(texts)
    assert (seen["normalize", "new"], seen["normalize", "changed"]) == (0, 1)
    assert seen["chunk", "chunks"] > 1 and seen["chunk", "chunks_changed"] == 1
    assert seen["embed", "embedded"] == seen["index", "indexed"] == 1
    r.check(texts)

    held = r.versions()
    seen = r.run(texts)
    assert set(seen.values()) == {0} and r.versions() == held

    # Back to the earlier text.
    seen = r.run(before)
    assert seen["chunk", "chunks_changed"] == seen["index", "indexed"] == 1
    r.check(before)

    # A shortened document leaves nothing behind.
    before["doc://5"] = "Now short."
    seen = r.run(before)
    assert seen["embed", "removed"] == seen["index", "removed"] > 0
    r.check(before)
    index, doc = r.store.index.read(), hashlib.sha256(b"doc://6").hexdigest()
    found = lookup(index, "doc_id", doc, OPTIONS.num_shards)
    assert found.count() == lookup(index, "doc_id", doc).count() > 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan
    events = spark.read.parquet(r.store.folder("audit_events"))
    assert events.select("run_id").distinct().count() == 6


def test_missing_documents_go_only_when_pruned(spark):
    r, texts = Runner(spark), seven()
    r.run(texts)
    some = {u: t for u, t in texts.items() if u != "doc://4"}
    r.run(some)
    r.check(texts)
    seen = r.run(some, options=Options(tail="compact", num_shards=3, table_buckets=4, prune=True))
    assert seen["normalize", "pruned"] == 1
    r.check(some)


def test_listed_twice_is_one_document(spark):
    r = Runner(spark)
    twice = docs(spark, {"a": "One text."}).unionAll(docs(spark, {"a": "One text."}))
    assert r.run(twice)["normalize", "new"] == 1
    assert set(r.run(twice).values()) == {0}
    r.check({"a": "One text."})


def test_failed_texts_are_tried_again(spark):
    r, texts = Runner(spark), {"a": "good one.", "b": "bad one."}

    def flaky(batch):
        return [[] if "bad" in t else [1.0, 2.0] for t in batch]

    seen = r.run(texts, flaky)
    assert (seen["embed", "embedded"], seen["embed", "failed"]) == (1, 1)
    assert r.store.index.read().count() == 1
    seen = r.run(texts, lambda batch: [[1.0, 2.0]] * len(batch))
    assert (seen["embed", "embedded"], seen["index", "indexed"]) == (1, 1)
    r.check(texts)


def test_a_dead_model_stops_the_run_and_stores_nothing(spark):
    def dead(batch):
        raise RuntimeError("down")

    r, texts = Runner(spark), {"a": "text."}
    with pytest.raises(stages.NoEmbeddings):
        r.run(texts, dead)
    store = stages.open_store(spark, r.path, OPTIONS)
    assert store.chunks.exists() and not store.embeddings.exists()
    events = spark.read.parquet(store.folder("audit_events"))
    assert events.filter("channel = 'error'").count() == 1
    r.run(texts)
    r.check(texts)


def test_two_model_versions(spark):
    r, texts = Runner(spark), seven()
    r.run(texts)
    newer = Options(tail="compact", num_shards=3, table_buckets=4, embed_ver="2")
    seen = r.run(texts, options=newer)
    total = r.store.chunks.read().count()
    assert seen["embed", "embedded"] == total
    assert r.store.embeddings.read().count() == 2 * total
    assert r.store.index.read().count() == total
    assert set(r.run(texts, options=newer).values()) == {0}


def test_skip_and_single_stages(spark):
    r, texts = Runner(spark), {"a": "text."}
    r.run(texts, options=Options(tail="compact", num_shards=3, table_buckets=4, skip_embedding=True))
    assert not r.store.embeddings.exists() and not r.store.index.exists()
    stages.run_stages(spark, r.path, None, OPTIONS, stages=["embed", "index"])
    r.check(texts)
    with pytest.raises(ValueError):
        stages.run_stages(spark, r.path, None, OPTIONS, stages=["normalize"])
    with pytest.raises(ValueError):
        stages.run_stages(spark, r.path, None, OPTIONS, stages=["other"])


def test_compat_tail_and_uri_source(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.txt").write_text(f"Text {i}. {LONG}")
    from docvec.sources.documents import extract_uris

    uris = spark.createDataFrame([((tmp_path / f"{i}.txt").as_uri(),) for i in (0, 1, 2, 2)], "uri string")
    source = stages.from_uris(uris, extract_uris)
    path, options = work_folder(spark, "store"), Options(num_shards=2, table_buckets=2)
    stages.run_stages(spark, path, source, options)
    (tmp_path / "1.txt").write_text("Other text.")
    store, audit = stages.run_stages(spark, path, source, options)
    seen = {(e[1], e[3]): e[4] for e in audit.events if e[3]}
    assert (seen["normalize", "new"], seen["normalize", "changed"]) == (0, 1)
    assert store.documents.read().count() == 3
    assert store.index.read().count() == store.chunks.read().count()


def test_failed_extraction_removes_nothing(spark):
    options = Options(tail="compact", num_shards=3, table_buckets=4, prune=True)
    r, texts = Runner(spark, options), seven()
    r.run(texts)
    seen = r.run(texts | {"doc://1": "", "doc://2": "   "})
    assert (seen["normalize", "failed"], seen["normalize", "pruned"]) == (2, 0)
    r.check(texts)
    fewer = {k: v for k, v in texts.items() if k != "doc://4"}
    seen = r.run(fewer | {"doc://1": ""})
    assert (seen["normalize", "failed"], seen["normalize", "pruned"]) == (1, 1)
    r.check(fewer)
    with pytest.raises(stages.NoTexts):
        r.run({k: "" for k in texts})
    r.check(fewer)


def test_changed_split_settings_are_applied(spark):
    r, texts = Runner(spark), seven()
    r.run(texts)
    smaller = Options(tail="compact", num_shards=3, table_buckets=4, max_chars=300, overlap=20)
    r.run(texts, options=smaller)
    r.check(texts, smaller)
    versions = r.versions()
    r.run(texts, options=smaller)
    assert r.versions() == versions


def test_another_number_of_shards_is_refused_and_lookup_knows_the_stored_one(spark):
    from docvec.operators.index import lookup_stored

    r, texts = Runner(spark), seven()
    r.run(texts)
    other = Options(tail="compact", num_shards=5, table_buckets=4)
    with pytest.raises(ValueError, match="compact"):
        r.run(texts | {"doc://9": LONG}, options=other)
    index = stages.open_store(spark, r.path, other).index
    ids = [d.doc_id for d in index.read("doc_id").distinct().collect()]
    assert all(lookup_stored(index, "doc_id", d).count() for d in ids)


def test_an_edit_writes_in_proportion_to_itself(spark):
    r, texts = Runner(spark), seven()
    r.run(texts)
    s = r.store
    tables = (s.documents, s.chunks, s.embeddings, s.indexed, s.index)
    total = [t.read().count() for t in tables]
    before = [t._state(t.version()) for t in tables]
    texts["doc://3"] = "E" + texts["doc://3"][1:]
    seen = r.run(texts)
    for table, old, n in zip(tables, before, total):
        now = table._state(table.version())
        assert all(now.held[b][: len(w)] == w for b, w in old.held.items())
        fresh = {b: [w for w in ws if w >= old.free] for b, ws in now.held.items()}
        assert table._files_of(fresh).count() <= max(1, seen["chunk", "chunks"]) < n or n == 7
    r.check(texts)


def test_files_that_did_not_change_are_not_read(spark, tmp_path):
    from docvec.sources.documents import Files

    reads = spark.sparkContext.accumulator(0)

    def extract(content):
        reads.add(1)
        if b"broken" in content:
            raise ValueError("broken")
        return content.decode()

    for i in range(5):
        (tmp_path / f"{i}.txt").write_text(f"Text {i}. {LONG}")
    (tmp_path / "bad.txt").write_text("broken")
    (tmp_path / "left.csv").write_text("not a text")
    path, options = work_folder(spark, "store"), Options(tail="compact", num_shards=2, table_buckets=2, prune=True)
    source = Files(spark, str(tmp_path), extract, "*.txt")

    def run():
        before = reads.value
        store, audit = stages.run_stages(spark, path, source, options)
        seen = {(e[1], e[3]): e[4] for e in audit.events if e[3]}
        return store, reads.value - before, [seen["normalize", m] for m in ("new", "changed", "failed")]

    store, n, counts = run()
    assert (n, counts) == (6, [5, 0, 1]) and store.documents.read().count() == 5
    # The failed one alone is tried again, and again.
    versions = store.documents.version(), store.sources.version()
    assert run()[1:] == (1, [0, 0, 1]) == run()[1:]
    assert versions == (store.documents.version(), store.sources.version())
    (tmp_path / "bad.txt").write_text("mended")
    assert run()[1:] == (1, [1, 0, 0])
    versions = store.documents.version(), store.chunks.version(), store.index.version()
    assert run()[1:] == (0, [0, 0, 0])
    assert versions == (store.documents.version(), store.chunks.version(), store.index.version())
    # Touched but with the same text, edited, and gone.
    import os

    os.utime(tmp_path / "0.txt", (1, 1))
    (tmp_path / "1.txt").write_text("Other text.")
    assert run()[1:] == (2, [0, 1, 0])
    os.unlink(tmp_path / "2.txt")
    store, n, counts = run()
    assert (n, counts) == (0, [0, 0, 0]) and store.documents.read().count() == 5
    assert store.index.read().count() == store.chunks.read().count()
    assert store.index.read().filter("text like 'Text 2.%'").count() == 0


def test_an_unchanged_run_reads_no_rows(spark, monkeypatch):
    from docvec.sources.tables import ManagedTable

    r, texts = Runner(spark), seven()
    r.run(texts)
    read, whole = [], ManagedTable._files_of

    def files_of(self, held):
        read.append((self.path.rsplit("/", 1)[1], len(held)))
        return whole(self, held)

    monkeypatch.setattr(ManagedTable, "_files_of", files_of)
    opened = []
    monkeypatch.setattr(stages, "compare", lambda *a, **k: opened.append(a) or compare(*a, **k))
    r.run(texts)
    assert len(opened) == 1  # the documents that were listed against those stored
    assert r.store.index.read().count()


def test_one_edit_reads_the_buckets_of_its_document(spark):
    """The whole run with one edit, over tables of many buckets."""
    options = Options(tail="compact", num_shards=3, table_buckets=64)
    r, texts = Runner(spark, options), {f"doc://{i}": f"Document {i}. {LONG}" for i in range(40)}
    r.run(texts)
    total = r.store.chunks.read().count()
    touched = []
    plain = stages._touched_chunks

    def spy(*args):
        docs, ids = plain(*args)
        touched.append((docs.count(), ids.count()))
        return docs, ids

    stages._touched_chunks = spy
    try:
        texts["doc://3"] = "E" + texts["doc://3"][1:]
        r.run(texts)
    finally:
        stages._touched_chunks = plain
    assert touched == [(1, total // 40)] * 2
    r.check(texts)


def test_stages_far_behind_or_with_expired_versions_catch_up(spark):
    r, texts = Runner(spark), seven()
    r.run(texts)
    for n in range(3):
        texts[f"doc://{n}"] = f"Changed {n}. {LONG}"
        r.run(texts, stages=["normalize"])
    texts["doc://9"] = "new"
    r.run(texts, stages=["normalize", "chunk"])
    r.store.documents.expire()
    del_embed = texts["doc://0"]
    texts["doc://0"] = "short now"
    r.run(texts)
    r.check(texts)
    texts["doc://0"] = del_embed
    r.run(texts, stages=["normalize", "chunk"])
    for table in (r.store.documents, r.store.chunks, r.store.embeddings):
        table.compact(1)
        table.expire()
    r.run(texts)
    r.check(texts)


def test_a_run_lost_between_index_and_its_entries_is_made_good(spark, monkeypatch):
    from docvec.sources.tables import ManagedTable

    r, texts = Runner(spark), seven()
    r.run(texts)
    texts |= {"doc://1": "Changed. " + LONG, "doc://8": "new " + LONG}
    show = ManagedTable.show

    def dies(self, *args, **kw):
        if self.path.endswith("indexed_chunks"):
            raise RuntimeError("lost")
        return show(self, *args, **kw)

    monkeypatch.setattr(ManagedTable, "show", dies)
    with pytest.raises(RuntimeError):
        r.run(texts)
    monkeypatch.undo()
    r.run(texts)
    r.check(texts)
    versions = r.versions()
    r.run(texts)
    assert r.versions() == versions


def test_terms_are_kept_with_the_index(spark):
    from tests.test_postings import got, plain_bm25

    options = Options(tail="compact", num_shards=3, table_buckets=4, term_index=True)
    r, texts = Runner(spark, options), seven()
    queries = [(1, "sentence number 7"), (2, "document 3"), (3, "absent"), (4, "changed new text")]
    asked = spark.createDataFrame(queries, "query_id long, text string")

    def check():
        rows = {x.chunk_id: x.text for x in r.store.index.read("chunk_id", "text").collect()}
        assert got(r.store.terms.search(asked, 4)) == plain_bm25(rows, queries, 4)

    r.run(texts)
    check()
    version = r.store.terms.table.version()
    r.run(texts)
    assert r.store.terms.table.version() == version
    texts |= {"doc://1": "Changed. " + LONG, "doc://8": "new text"}
    texts["doc://5"] = "Now short."
    r.run(texts)
    check()
    texts["doc://9"] = "changed again"
    r.run(texts, options=OPTIONS)
    r.run(texts)
    check()
