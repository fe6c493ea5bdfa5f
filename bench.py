"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

Query results go to Spark's ``noop`` sink, so every row is computed. The ``run_*``
run, a run without changes, and a run in which a part of the documents is new or
edited. The embedder is the built-in one, so there are no model calls in them.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from checks import queries as q
from docvec.options import Options
from docvec.plans import stages
from docvec.sources.storage import work_folder

HEADLINES = [
    "normalize_docs", "ingest_pages", "chunk_split", "chunk_docs", "changed_chunks",
    "needs_embedding", "embed_chunks", "index_build", "shard_distribution", "knn_cosine",
    "knn_cells", "batch_search", "term_index", "bm25_search", "batch_answer", "run_report",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("docvec-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(fn) -> float:
    started = time.perf_counter()
    fn()
    return round(time.perf_counter() - started, 3)


def incremental_runs(spark: SparkSession, sf: str) -> dict[str, float]:
    path = work_folder(spark, "bench")
    options = Options()
    first = stages.from_table(q.earlier_raw(spark, sf), unique=True)
    second = stages.from_table(q.raw_documents(spark, sf), unique=True)

    def run(source):
        return lambda: stages.run_stages(spark, path, source, options)

    return {
        "run_first": timed(run(first)),
        "run_unchanged": timed(run(first)),
        "run_changed": timed(run(second)),
    }


def main(names: list[str]) -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    registry = q.registry()
    warm = registry["chunk_statistics"](spark, sf)
    warm.write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names or HEADLINES:
        if name == "runs":
            continue
        times[name] = timed(
            lambda: registry[name](spark, sf).write.format("noop").mode("overwrite").save()
        )
    if not names or "runs" in names:
        times.update(incremental_runs(spark, sf))
    spark.stop()
    line = {
        "metric": "total_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main(sys.argv[1:])
