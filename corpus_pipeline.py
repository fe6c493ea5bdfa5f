"""From raw documents to shards of training text, one stage after the other.

Every stage takes the whole output of the one before and gives the columns of
``documents``; the last adds ``shard``. Stages are written as Parquet in the shared work
folder and read again, so a lost executor costs a stage's tasks and not the run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docvec.llm import decontaminate, mixing, quality, sharding, simhash
from docvec.llm.common import stored, table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays whose fingerprints of three-word shingles link at
    three or fewer differing bits, as in ``op9_simhash``."""
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix of sources takes them: not, once or twice."""
    return mixing.take(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality classifier", classify),
    ("simhash near-dedup", deduplicate),
    ("benchmark decontamination", decontaminated),
    ("source mixing", mixed),
    ("sharding", sharded),
]

# The classifier is trained and the shards are propagated: neither has SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
