import pytest
from pyspark.sql import types as T

from docvec.sources.storage import work_folder
from docvec.sources.tables import ManagedTable

SCHEMA = T.StructType(
    [T.StructField("k", T.StringType()), T.StructField("m", T.StringType()), T.StructField("v", T.IntegerType())]
)


def make(spark, buckets=4):
    return ManagedTable(spark, work_folder(spark, "t"), SCHEMA, "k", buckets)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(table, **kw):
    return sorted(tuple(r) for r in table.read(**kw).collect())


def held(table):
    return table._state(table.version()).held


def test_first_run(spark):
    table = make(spark)
    assert not table.exists() and rows(table) == []
    assert table.read().schema == SCHEMA
    table.merge(frame(spark, [("a", "x", 1)]), ["k"])
    assert table.exists() and rows(table) == [("a", "x", 1)]


def test_upsert_and_versions(spark):
    table = make(spark)
    table.overwrite(frame(spark, [("a", "x", 1), ("b", "x", 2)]))
    table.merge(frame(spark, [("b", "y", 3), ("c", "y", 4)]), ["k"])
    assert rows(table) == [("a", "x", 1), ("b", "y", 3), ("c", "y", 4)]
    assert rows(table, version=1) == [("a", "x", 1), ("b", "x", 2)]


def test_composite_key_keeps_both(spark):
    table = make(spark)
    table.overwrite(frame(spark, [("a", "1", 1)]))
    table.merge(frame(spark, [("a", "2", 2), ("a", "1", 5)]), ["k", "m"])
    assert rows(table) == [("a", "1", 5), ("a", "2", 2)]


def test_inserts_rewrite_nothing(spark):
    table = make(spark, buckets=2)
    table.overwrite(frame(spark, [(str(i), "x", i) for i in range(50)]))
    before = held(table)
    table.merge(frame(spark, [(f"n{i}", "x", i) for i in range(50)]), ["k"])
    after = held(table)
    assert all(after[b][: len(w)] == w for b, w in before.items())
    assert table.read().count() == 100


def test_update_writes_what_changed(spark):
    table = make(spark, buckets=8)
    table.overwrite(frame(spark, [(str(i), "x", i) for i in range(100)]))
    before = held(table)
    table.merge(frame(spark, [("7", "y", -1)]), ["k"])
    after = held(table)
    assert all(after[b][: len(w)] == w for b, w in before.items())
    new = {w for ws in after.values() for w in ws} - {w for ws in before.values() for w in ws}
    assert len(new) == 1 and table._files_of({b: [w for w in ws if w in new] for b, ws in after.items()}).count() == 1
    assert table.read().count() == 100
    assert table.read().filter("k = '7'").first().v == -1


def test_many_updates_and_deletes_read_the_same_when_folded(spark, monkeypatch):
    from docvec.sources import tables

    expect = {str(i): i for i in range(20)}
    monkeypatch.setattr(tables, "FOLD_AFTER", 3)
    table = make(spark, buckets=3)
    table.overwrite(frame(spark, [(k, "x", v) for k, v in expect.items()]))
    most = 0
    for turn in range(6):
        change = {str(turn): 100 + turn, str(turn + 1): 200 + turn, f"n{turn}": turn}
        gone = [str(10 + turn), f"n{turn - 1}"]
        table.merge(
            frame(spark, [(k, "x", v) for k, v in change.items()]), ["k"],
            delete=spark.createDataFrame([(g,) for g in gone], "k string"),
        )
        expect = {k: v for k, v in expect.items() if k not in gone} | change
        assert {r.k: r.v for r in table.read().collect()} == expect
        most = max(most, len(table._state(table.version()).deletes))
    assert 0 < most <= 3
    assert {r.k: r.v for r in table.read(version=1).collect()} == {str(i): i for i in range(20)}


def test_expire_keeps_what_is_read(spark):
    table = make(spark)
    table.overwrite(frame(spark, [("a", "x", 1), ("b", "x", 2)]))
    table.merge(frame(spark, [("a", "y", 3)]), ["k"])
    table.compact(1)
    assert table.expire(keep=2) == []
    assert rows(table, version=2) == rows(table) == [("a", "y", 3), ("b", "x", 2)]
    assert table.expire() == [1, 2]
    assert rows(table) == [("a", "y", 3), ("b", "x", 2)]
    table.merge(frame(spark, [("c", "x", 4)]), ["k"])
    assert len(rows(table)) == 3


def test_another_number_of_buckets_is_refused_until_compacted(spark):
    table = make(spark, buckets=2)
    table.overwrite(frame(spark, [("a", "x", 1), ("b", "x", 2)]))
    other = ManagedTable(spark, table.path, SCHEMA, "k", 5)
    assert other.stored_buckets() == 2 and len(rows(other)) == 2
    with pytest.raises(ValueError, match="compact"):
        other.merge(frame(spark, [("c", "x", 1)]), ["k"])
    other.compact(2, buckets=5)
    other.merge(frame(spark, [("c", "x", 1)]), ["k"])
    assert other.stored_buckets() == 5 and len(rows(other)) == 3


def test_two_writes_before_they_are_shown(spark):
    table = make(spark)
    first = table.put(frame(spark, [("a", "x", 1)]))
    second = table.put(frame(spark, [("b", "x", 2)]))
    table.show(first)
    table.show(second)
    assert rows(table) == [("a", "x", 1), ("b", "x", 2)]
    with pytest.raises(ValueError, match="before"):
        table.show(first)


def test_delete(spark):
    table = make(spark)
    table.overwrite(frame(spark, [(str(i), "x", i) for i in range(20)]))
    gone = spark.createDataFrame([("3",), ("4",), ("none",)], "k string")
    table.merge(frame(spark, [("5", "y", 0), ("new", "y", 0)]), ["k"], delete=gone)
    found = {r.k: r.m for r in table.read().collect()}
    assert len(found) == 19 and "3" not in found and found["5"] == "y"
    everything = table.read("k")
    table.show(None, delete=everything)
    assert rows(table) == []


def test_put_is_not_visible_until_shown(spark):
    table = make(spark)
    table.overwrite(frame(spark, [("a", "x", 1)]))
    write = table.put(frame(spark, [("b", "x", 1), ("c", "x", 2)]))
    assert table.written(write).count() == 2 and rows(table) == [("a", "x", 1)]
    table.discard(write)
    assert rows(table) == [("a", "x", 1)]


def test_compact(spark):
    table = make(spark, buckets=2)
    table.overwrite(frame(spark, [("a", "x", 1)]))
    for i in range(2):
        table.merge(frame(spark, [(f"b{i}", "x", i), (f"c{i}", "x", i), (f"d{i}", "x", i)]), ["k"])
    before = rows(table)
    files = len(table.read().inputFiles())
    table.compact(1)
    assert rows(table) == before
    assert len(table.read().inputFiles()) <= 2 < files


def test_hot_bucket_is_written(spark):
    """All rows in one bucket: nothing is lost, whatever the split."""
    table = make(spark, buckets=1)
    df = spark.range(200_000).selectExpr("cast(id as string) k", "'x' m", "cast(id as int) v")
    table.overwrite(df)
    assert table.read().selectExpr("count(distinct k)").first()[0] == 200_000


def test_many_small_inserts_leave_few_writes(spark):
    from docvec.sources.tables import FAN

    table = make(spark, buckets=2)
    expect, most = {}, 0
    for turn in range(22):
        change = {f"{turn}-{i}": turn for i in range(3)} | ({f"{turn - 1}-0": -turn} if turn % 5 == 1 else {})
        table.merge(frame(spark, [(k, "x", v) for k, v in change.items()]), ["k"] if turn % 5 == 1 else None)
        expect |= change
        most = max(most, *(len(w) for w in held(table).values()))
    assert most <= 3 * FAN
    assert {r.k: r.v for r in table.read().collect()} == expect
    assert table.read().count() == len(expect)
    assert {r.k for r in table.read(version=7).collect()} == {f"{t}-{i}" for t in range(7) for i in range(3)}
    deletes = spark.createDataFrame([(k,) for k in sorted(expect)[:50]], "k string")
    table.show(None, delete=deletes)
    assert table.read().count() == len(expect) - 50


def changed(table, since):
    feed = table.changes(since)
    written = sorted(tuple(r) for r in feed.written("k", "m", "v").collect())
    return written, sorted(r.k for r in feed.touched("k").collect())


def test_changes_between_versions(spark):
    table = make(spark)
    assert table.changes(0) is None
    table.overwrite(frame(spark, [(str(i), "x", i) for i in range(10)]))
    first = table.version()
    assert table.changes(first).empty and changed(table, first) == ([], [])
    table.merge(frame(spark, [("1", "y", 1), ("new", "y", 2)]), ["k"])
    second = table.version()
    table.show(None, delete=spark.createDataFrame([("5",), ("new",)], "k string"))
    table.merge(frame(spark, [("new", "z", 3)]), ["k"])
    assert changed(table, first) == ([("1", "y", 1), ("new", "z", 3)], ["1", "5", "new"])
    assert changed(table, second) == ([("new", "z", 3)], ["5", "new"])
    # A write that is not shown, a note and a compaction change nothing.
    last = table.version()
    table.put(frame(spark, [("lost", "x", 0)]))
    table.remember("a note")
    table.compact(1)
    assert table.changes(last).empty and table.note() == "a note"
    assert changed(table, first) == ([("1", "y", 1), ("new", "z", 3)], ["1", "5", "new"])
    assert table.changes(first, second).until == second
    # Old versions that are gone, and a table written anew, cannot be told apart.
    table.expire(keep=2)
    assert table.changes(first) is None and table.changes(last + 1).empty
    at = table.version()
    table.overwrite(frame(spark, [("a", "x", 1)]))
    assert table.changes(at) is None


def test_changes_survive_folding_and_merging(spark, monkeypatch):
    from docvec.sources import tables

    monkeypatch.setattr(tables, "FOLD_AFTER", 2)
    table = make(spark, buckets=2)
    table.overwrite(frame(spark, [(str(i), "x", i) for i in range(20)]))
    since = table.version()
    for turn in range(6):
        table.merge(frame(spark, [(str(turn), "y", 100 + turn), (f"n{turn}", "y", turn)]), ["k"])
    written, touched = changed(table, since)
    assert written == sorted([(str(t), "y", 100 + t) for t in range(6)] + [(f"n{t}", "y", t) for t in range(6)])
    assert touched == sorted([str(t) for t in range(6)] + [f"n{t}" for t in range(6)])
    table.expire(keep=10)
    assert changed(table, since) == (written, touched)


def test_reading_within_keys_reads_their_buckets(spark):
    table = make(spark, buckets=16)
    table.overwrite(frame(spark, [(str(i), "x", i) for i in range(400)]))
    keys = spark.createDataFrame([("7",), ("8",), ("none",)], "k string")
    some = table.read("k", within=keys)
    assert {"7", "8"} <= {r.k for r in some.collect()}
    assert len(some.inputFiles()) <= 3 < len(table.read().inputFiles())
    table.compact(4, buckets=5)
    assert {"7", "8"} <= {r.k for r in table.read("k", within=keys).collect()}
    assert {"7", "8"} <= {r.k for r in table.read("k", version=1, within=keys).collect()}


def test_few_deleted_keys_go_to_the_rows(spark, tmp_path, monkeypatch):
    """Reading a table with deletes must not shuffle its rows."""
    from docvec.sources import tables as W

    schema = W._schema(k=W._STR, v=W._STR)
    table = W.ManagedTable(spark, f"{tmp_path}/t", schema, "k", 2)
    rows = spark.range(20).selectExpr("cast(id as string) k", "'a' v")
    table.overwrite(rows)
    table.merge(rows.filter("k < 3"), delete=spark.range(5).selectExpr("cast(id as string) k"))
    expected = sorted(str(i) for i in range(20) if i not in (3, 4))

    def plan():
        return table.read()._jdf.queryExecution().optimizedPlan().toString()

    assert sorted(r.k for r in table.read().collect()) == expected
    assert "broadcast" in plan()
    monkeypatch.setattr(W, "BROADCAST_BYTES", 0)
    assert "broadcast" not in plan()
    assert sorted(r.k for r in table.read().collect()) == expected
