"""Counts reported by the stages. Every aggregate is combined map-side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def success_counts(df: DataFrame, ok) -> DataFrame:
    """Total, successful and failed rows for a boolean column ``ok``."""
    good = F.coalesce(F.sum(F.when(ok, 1)), F.lit(0)).cast("bigint")
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total"), good.alias("successful"), (total - good).alias("failed")
    )


def batch_count(rows, batch_size: int):
    """Batches needed for a number of rows."""
    return F.ceil(rows / F.lit(batch_size)).cast("bigint")


def change_counts(changes: DataFrame) -> DataFrame:
    """Rows per ``is_update`` value, named new and changed."""
    kind = F.when(F.col("is_update"), "changed").otherwise("new")
    return changes.groupBy(kind.alias("change_type")).agg(F.count(F.lit(1)).alias("n"))


def shard_distribution(index: DataFrame) -> DataFrame:
    """Chunks and documents per shard, ordered by shard.

    Counted per document first: the second step sees one row per document, so a
    shard or a document with a third of all chunks is no hot key.
    """
    per_doc = index.groupBy("shard", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_doc.groupBy("shard")
        .agg(F.sum("n").alias("chunks"), F.count(F.lit(1)).alias("documents"))
        .orderBy("shard")
    )


def shard_operations(added: DataFrame, updated: DataFrame | None = None) -> DataFrame:
    """Added and updated rows per shard, and a total row with a null shard.

    An update counts as both added and updated. It is told by ``is_update``, or by a
    table of its own with a row per update and its shard.
    """
    rows = added.select("shard", F.lit(1).alias("a"), F.col("is_update").cast("bigint").alias("u"))
    if updated is not None:
        rows = rows.unionByName(updated.select("shard", F.lit(0).alias("a"), F.lit(1).cast("bigint").alias("u")))
    per_shard = rows.groupBy("shard").agg(F.sum("a").alias("added"), F.sum("u").alias("updated"))
    return per_shard.rollup("shard").agg(
        F.sum("added").alias("added"), F.sum("updated").alias("updated")
    )


def index_health(index: DataFrame, path: str) -> DataFrame:
    """One row: status, path, shards and documents of an index."""
    per_shard = index.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    shards = F.count(F.lit(1))
    return per_shard.agg(
        F.when(shards > 0, "healthy").otherwise("no_index").alias("status"),
        F.lit(path).alias("index_path"),
        shards.alias("shards"),
        F.when(shards > 0, F.sum("n")).alias("total_documents"),
    )


def changed_sample(changes: DataFrame, column: str = "uri", n: int = 10) -> DataFrame:
    """The first ``n`` changed rows in order, for the log of a run."""
    return changes.filter("is_update").select(column).orderBy(column).limit(n)


def net_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Table size before and after an upsert."""
    sides = before.select(F.lit(0).alias("a")).unionAll(after.select(F.lit(1).alias("a")))
    n_after = F.coalesce(F.sum("a"), F.lit(0)).cast("bigint")
    n_before = (F.count(F.lit(1)) - n_after).cast("bigint")
    return sides.agg(
        n_before.alias("rows_before"),
        n_after.alias("rows_after"),
        (n_after - n_before).alias("net_change"),
    )
