"""The chunk stage stores no suffixes; readers and counts have them all."""

import random

import pyarrow as pa
import pyarrow.parquet
import pytest
from pyspark.sql import functions as F

from checks import queries
from docvec.operators.chunks import changed_in, chunk_documents, split_documents, unfold_chunks
from docvec.operators.normalize import normalize_documents
from docvec.options import Options
from docvec.plans import stages
from docvec.sources import tables
from docvec.sources.chunk_table import ChunkTable
from docvec.sources.storage import work_folder
from tests.test_chunk_scale import TEXTS

COLUMNS = ["chunkId", "docId", "docHash", "offset", "chunk", "chunkHash", "language", "title"]


def normalized(spark, texts):
    rows = [(u, t, "en") for u, t in texts]
    return normalize_documents(spark.createDataFrame(rows, "uri string, text string, language string"), F.col("language"))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def stored_rows(df):
    files = {f.removeprefix("file:") for f in df.inputFiles() if "/chunks/data/" in f}
    return sum(pa.parquet.read_table(f).num_rows for f in files)


def test_the_chunk_stage_stores_no_suffixes(spark, tmp_path):
    texts = [("en", "One. " * 300), ("de", "Zwei. " * 300), ("fr", "Trois. " * 300), ("en", "Short."), ("de", "x" * 150)]
    docs = [(i, t, lang, f"src{i}", len(t)) for i, (lang, t) in enumerate(texts)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    now, had = queries.documents(spark, str(tmp_path)), queries.earlier(spark, str(tmp_path))
    found = queries.stage_chunk(spark, str(tmp_path))
    columns = ["chunkId", "docId", "docHash", "offset", "chunkHash"]
    assert rows(found, *columns) == rows(queries.chunks(spark, str(tmp_path)), *columns)
    # Both runs: all earlier documents, then the new and the changed ones.
    fresh = now.join(had, ["docId", "contentHash"], "left_anti")
    count = lambda df: split_documents(df.select("docId", "text"), tail="compact", clean=True).count()
    assert stored_rows(found) == count(had) + count(fresh) < found.count() / 50


@pytest.mark.parametrize("args", [(1200, 200, "compat"), (50, 30, "compat"), (40, 39, "compat"), (1200, 200, "compact"), (10, 0, "compat")])
def test_folded_chunks_unfold_to_the_same_rows(spark, args):
    docs = normalized(spark, [(str(i), t) for i, t in enumerate(TEXTS + [""])])
    folded = chunk_documents(docs, *args, folded=True)
    assert rows(unfold_chunks(folded), *COLUMNS) == rows(chunk_documents(docs, *args), *COLUMNS)


@pytest.mark.parametrize("args", [(1200, 200, "compat"), (50, 30, "compat"), (40, 39, "compat"), (60, 20, "compact")])
def test_changed_chunks_are_counted_without_their_suffixes(spark, args):
    rng = random.Random(7)
    pick = lambda n: "".join(rng.choices("ab. ", k=n))
    old, new = [], []
    for i in range(120):
        text = pick(rng.choice([1, 2, 20, 30, 31, 45, 70, 200, 1300, 2600]))
        at = rng.randrange(len(text))
        other = rng.choice([text, "c" + text[1:], text[:at] + "c" + text[at + 1 :], text + pick(2), pick(40) + text, text[at:], pick(30)])
        old.append((str(i), text + "x"))
        new.append((str(i), other + "x"))
    old += [("0", "Also this."), ("3", pick(90) + "x")]
    new += [("0", "Also that."), ("new", "New one."), (None, "Without a name."), new[5]]
    docs, had = normalized(spark, new), normalized(spark, old)
    fresh, before = chunk_documents(docs, *args), chunk_documents(had.filter("uri is not null"), *args)
    want = fresh.join(before, ["chunkId", "chunkHash"], "left_anti").count()
    folded = chunk_documents(docs, *args, folded=True)
    kept = chunk_documents(had, *args, folded=True)
    one_by_one = before.withColumn("tails", F.lit(0))
    for df in (kept, one_by_one):
        assert changed_in(folded, df, args[1]).agg(F.sum("changed")).first()[0] == want
    assert 0 < want < fresh.count()


def test_the_table_keeps_its_rows_through_folding_merging_and_compacting(spark):
    table = ChunkTable(spark, work_folder(spark, "chunks"), 2)
    texts = {str(i): t for i, t in enumerate(TEXTS)}

    def put(some, tail="compat", folded=True):
        made = chunk_documents(normalized(spark, some), tail=tail, folded=folded)
        return table.put(made.withColumn("version_ts", F.current_timestamp()))

    # Rows that were stored one by one stay readable.
    table.show(put(list(texts.items()), folded=False))
    for n in range(10):
        some = [(u, f"{t} {n}.") for u, t in texts.items() if int(u) % 5 == n % 5]
        texts |= dict(some)
        write = put(some)
        old = normalized(spark, some).select("docId")
        assert rows(table.written(write), "chunkId") == rows(chunk_documents(normalized(spark, some)), "chunkId")
        table.show(write, delete=old)
        assert rows(table.read(), *COLUMNS) == rows(chunk_documents(normalized(spark, texts.items())), *COLUMNS)
    last = table.version()
    feed = table.changes(last - 1, last)
    assert rows(feed.written(*COLUMNS), *COLUMNS) == rows(chunk_documents(normalized(spark, some)), *COLUMNS)
    assert {r.docId for r in feed.touched("docId").collect()} == {r.docId for r in old.collect()}
    assert "tails" not in table.read().columns
    table.compact(2, buckets=3)
    assert rows(table.read(), *COLUMNS) == rows(chunk_documents(normalized(spark, texts.items())), *COLUMNS)
    docs = old.withColumn("chunkId", F.lit("x"))
    for keys, delete in ((["chunkId"], None), (None, docs)):
        with pytest.raises(ValueError):
            table.show(None, keys, delete)


@pytest.mark.parametrize("few", [True, False])
def test_runs_report_every_chunk_and_every_change(spark, monkeypatch, few):
    if not few:
        for module in (stages, tables):
            monkeypatch.setattr(module, "BROADCAST_BYTES", -1)
    path = work_folder(spark, "store")

    def run(texts, **rule):
        options = Options(table_buckets=2, **rule)
        source = stages.from_table(spark.createDataFrame(texts, "uri string, text string"))
        store, audit = stages.run_stages(spark, path, source, options, stages=["normalize", "chunk"])
        return store, {e[3]: e[4] for e in audit.events if e[1] == "chunk" and e[3]}

    first = [("a", "A. " * 700), ("b", "B" * 300), ("c", "short")]
    second = [("a", "A. " * 700), ("b", "B" * 299 + "C"), ("c", "snort"), ("d", "D" * 250)]
    had = chunk_documents(normalized(spark, first))
    _, seen = run(first)
    assert (seen["chunks"], seen["documents"]) == (had.count(), 3)
    changed = chunk_documents(normalized(spark, second)).join(had, ["chunkId", "chunkHash"], "left_anti")
    store, seen = run(second)
    assert seen["chunks_changed"] == changed.count() == 201 + 2 + 201
    assert (seen["chunks"], seen["net_change"], seen["documents"]) == (201 + 5 + 201, 201, 3)
    now = chunk_documents(normalized(spark, second))
    # Where few keys were replaced, the texts stay where they are to be read.
    assert ("strategy=broadcast" in store.documents.read()._jdf.queryExecution().optimizedPlan().toString()) == few
    assert rows(store.chunks.read(), *COLUMNS[:-2]) == rows(now, *COLUMNS[:-2])
    # Another rule: every document is split anew, and compared chunk by chunk.
    store, seen = run(second, max_chars=600, overlap=100)
    again = chunk_documents(normalized(spark, second), 600, 100)
    assert seen["chunks_changed"] == again.join(now, ["chunkId", "chunkHash"], "left_anti").count()
    assert seen["net_change"] == again.count() - now.count()
    assert rows(store.chunks.read(), *COLUMNS[:-2]) == rows(again, *COLUMNS[:-2])


def test_keys_of_a_write_are_told_by_their_bytes(spark):
    schema = tables.SCHEMAS["sources"]
    table = tables.ManagedTable(spark, work_folder(spark, "sources"), schema, "uri", 2)
    make = lambda *uris: spark.createDataFrame([(u, 1, None) for u in uris], schema)
    table.merge(make("a", "bc", None), ["uri"])
    table.merge(make("bc", "é", None), ["uri"])
    (own,) = table._state(table.version()).deletes
    assert own.own and own.bytes == 4
    # Versions of before did not say.
    assert tables._from_json([{"ver": 2, "columns": ["uri"], "own": True}])[0].bytes is None
    assert not table._small([tables.Deletes(2, ("uri",), True)]) and table._small([own])
