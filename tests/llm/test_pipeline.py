from __future__ import annotations

import corpus_pipeline
from docvec.llm import queries
from docvec.llm.simhash import near_duplicates

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registry_names_each_operator_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.registry())
    assert numbers == list(range(1, 14))
    assert set(queries.oracles()) <= set(queries.registry())


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF)
        assert made.columns == COLUMNS + ["shard"] * (name == "sharding")
        before = {r.doc_id: r.text for r in docs.collect()}
        rows = made.collect()
        assert rows and all(before[r.doc_id] == r.text for r in rows)
        ids = [r.doc_id for r in rows]
        if name == "simhash near-dedup":
            group = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
            assert len({group[i] for i in ids}) == len(ids) == len(set(ids))
        if name == "source mixing":
            assert max(ids.count(i) for i in ids) == 2
        elif name != "sharding":
            assert len(set(ids)) == len(ids)
        else:
            assert sorted(ids) == sorted(r.doc_id for r in docs.collect())
        docs = spark.createDataFrame(rows, made.schema)


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
