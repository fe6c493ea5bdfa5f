from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import types as T

from checks import queries
from docvec.operators import cells
from docvec.operators.search import knn
from docvec.sources.storage import work_folder


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_trained_cells_reach_nine_of_ten(spark, sf):
    found, exact = queries._ivf(spark, f"/root/testdata/{sf}", 12)
    recalls = [r.recall for r in cells.recall(found, exact, "vec_id").collect()]
    print(sf, len(recalls), min(recalls), sum(recalls) / len(recalls))
    assert recalls and min(recalls) >= 0.9


def test_probes_of_a_direction_do_not_depend_on_length():
    rng = np.random.default_rng(3)
    centres, q = rng.normal(size=(8, 4)), rng.normal(size=(5, 4))
    chosen = cells.nearest_cells(centres, 3, unit=True)
    assert (chosen(q) == chosen(q * 0.01)).all() and (chosen(q) == chosen(q * 50)).all()
    assert chosen(np.zeros((1, 4))).shape == (1, 3)


ID, GROUP = T.StructField("id", T.LongType()), T.StructField("kind", T.StringType())


def rows_of(spark, table, first=0):
    listed = [(first + i, [float(x) for x in v], f"k{i % 3}") for i, v in enumerate(table)]
    return spark.createDataFrame(listed, "id long, vector array<float>, kind string")


def questions(spark, table):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(table)], "query_id long, vector array<double>")


def hits(df):
    return sorted((r.query_id, r.id, r["rank"], r.kind) for r in df.collect())


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(21)
    middles = rng.normal(size=(40, 16))
    table = np.concatenate([m + 0.35 * rng.normal(size=(60, 16)) for m in middles]).astype(np.float32)
    table[::3] = table[0]  # a third of all rows in one cell
    return middles, table


@pytest.fixture(scope="module")
def store(spark, clustered):
    store = cells.CellStore(spark, work_folder(spark, "cells"), ID, [GROUP], cells=40)
    store.build(rows_of(spark, clustered[1]))
    return store


def test_store_reads_a_quarter_at_most_and_finds_nine_of_ten(spark, store, clustered):
    rng = np.random.default_rng(4)
    probes = store.tune(questions(spark, clustered[0] + 0.3 * rng.normal(size=(40, 16))), 0.95, 10)
    asked = questions(spark, clustered[0] + 0.3 * rng.normal(size=(40, 16)))
    exact = knn(store.read(), asked, 10, id_col="id", carry=["kind"])
    found = store.search(asked, 10)
    reached = cells.recall(found, exact, "id").selectExpr("avg(recall)").first()[0]
    assert 1 <= probes <= 10 and reached >= 0.9
    assert store.share_read(asked) <= 0.25
    assert hits(store.search(asked, 10, nprobe=40)) == hits(exact)


def test_search_lists_the_folders_of_probed_cells_alone(spark, store, clustered):
    asked = questions(spark, clustered[0][:1])
    _, sizes = store._plan(asked.selectExpr("*", "1 AS _k"), 2)
    assert 1 <= len(sizes) <= 2
    files = store.table.read_buckets(list(sizes), "id").inputFiles()
    assert files and {int(f.split("cell=")[1].split("/")[0]) for f in files} == set(sizes)
    assert len(files) < len(store.read().inputFiles()) / 4


def test_upserts_deletes_and_new_centres_keep_searches_exact(spark, clustered):
    rng = np.random.default_rng(9)
    table, asked = clustered[1].copy(), questions(spark, clustered[0][:6])
    store = cells.CellStore(spark, work_folder(spark, "cells"), ID, [GROUP], cells=12)
    store.build(rows_of(spark, table[:2000]))
    moved = rng.normal(size=(300, 16)).astype(np.float32)
    table[100:400] = moved
    store.upsert(rows_of(spark, table[100:400], 100))
    store.upsert(rows_of(spark, table[2000:], 2000))
    bad = spark.createDataFrame([(9000, [0.0] * 16, "z"), (9001, [1.0], "z"), (9002, None, "z")], "id long, vector array<float>, kind string")
    store.upsert(bad)
    store.delete(spark.range(50).selectExpr("id"))
    plain = rows_of(spark, table).selectExpr("id", "vector", "CASE WHEN id BETWEEN 100 AND 399 THEN concat('k', (id - 100) % 3) "
        "WHEN id >= 2000 THEN concat('k', (id - 2000) % 3) ELSE kind END AS kind").filter("id >= 50")
    want = hits(knn(plain, asked, 7, id_col="id", carry=["kind"]))
    assert store.read().count() == len(table) - 50
    assert hits(store.search(asked, 7, nprobe=12)) == want
    store.recentre()
    assert store.read().count() == len(table) - 50
    assert hits(store.search(asked, 7, nprobe=12)) == want
    with pytest.raises(ValueError, match="tune"):
        store.search(asked, 7)


def test_empty_queries_and_cells(spark, store):
    none = spark.createDataFrame([], "query_id long, vector array<double>")
    assert store.search(none, 3, nprobe=2).columns == ["query_id", "id", "kind", "score", "rank"]
    assert store.search(none, 3, nprobe=2).count() == 0
    with pytest.raises(ValueError):
        store.search(questions(spark, np.ones((1, 16))), 3, nprobe=-1)
