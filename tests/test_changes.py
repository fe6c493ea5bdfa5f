from docvec.operators import changes

OLD = [("a", "1"), ("b", "1"), ("c", "1"), ("c", "2"), ("z", "1")]
NEW = [("a", "1"), ("b", "2"), ("c", "1"), ("d", "1")]


def frames(spark):
    schema = "id string, hash string"
    return spark.createDataFrame(NEW, schema), spark.createDataFrame(OLD, schema)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_anti_and_semi(spark):
    new, old = frames(spark)
    assert rows(changes.not_in(new, old, ["id", "hash"])) == [("b", "2"), ("d", "1")]
    assert rows(changes.not_in(new, old, ["id"])) == [("d", "1")]
    assert rows(changes.already_in(new, old, ["id"])) == [("a", "1"), ("b", "2"), ("c", "1")]
    other = old.withColumnsRenamed({"id": "key", "hash": "digest"})
    named = changes.not_in(new, other, {"id": "key", "hash": "digest"})
    assert rows(named) == [("b", "2"), ("d", "1")]
    assert changes.existing_keys(old, ["id"]).count() == 4


def test_classify_both_ways(spark):
    new, old = frames(spark)
    expected = [("b", "2", True), ("d", "1", False)]
    for way in (changes.classify, changes.updates_then_inserts):
        found = way(new, old, "id", "hash").select("id", "hash", "is_update")
        assert rows(found) == expected


def test_compare(spark):
    new, old = frames(spark)
    found = changes.compare(new, old, "id", "hash").select("id", "action")
    # "c" is stored with two hashes, so it counts as changed.
    assert rows(found) == [("b", "changed"), ("c", "changed"), ("d", "new"), ("z", "gone")]


def test_compare_rows_that_are_not_ready(spark):
    want = spark.createDataFrame([("a", None), ("b", "1")], "id string, hash string")
    have = spark.createDataFrame([("a", "1"), ("b", None)], "id string, hash string")
    assert rows(changes.compare(want, have, "id", "hash")) == [("b", "1", "changed")]


def test_documents_to_chunk_after_a_revert(spark):
    docs = spark.createDataFrame([("d", "A"), ("e", "A")], "docId string, contentHash string")
    held = [("d", "A"), ("d", "B"), ("e", "A"), ("e", "A")]
    chunks = spark.createDataFrame(held, "docId string, docHash string")
    assert rows(changes.documents_to_chunk(docs, chunks)) == [("d", "A")]


def test_one_per_key(spark):
    df = spark.createDataFrame([("k", "b", 1), ("k", "c", 2), ("m", "a", 3)], "k string, t string, n int")
    assert rows(changes.one_per_key(df, "k", "t")) == [("k", "c", 2), ("m", "a", 3)]
