"""Rows of the sharded index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvec.functions.text import shard_of
from docvec.functions.vectors import is_valid
from docvec.sources.tables import ManagedTable


def index_candidates(
    chunks: DataFrame, embeddings: DataFrame, model: str, version: str
) -> DataFrame:
    """Chunks with a valid vector of this model for their current text.

    Joining on the hash as well keeps a vector of an earlier text out.
    """
    vectors = embeddings.filter(
        (F.col("embedder") == model)
        & (F.col("embedder_ver") == version)
        & is_valid("vector")
    ).select("chunkId", "chunkHash", "vector")
    columns = ["chunkId", "chunkHash", "docId", "offset", "chunk"]
    return chunks.select(*columns).join(vectors, ["chunkId", "chunkHash"])


def index_rows(candidates: DataFrame, num_shards: int) -> DataFrame:
    """Index columns, with the offset widened and the shard of the document."""
    return candidates.select(
        F.col("docId").alias("doc_id"),
        F.col("chunkId").alias("chunk_id"),
        F.col("chunkHash").alias("chunk_hash"),
        F.coalesce(F.col("offset").cast("bigint"), F.lit(0).cast("bigint")).alias("offset"),
        F.col("chunk").alias("text"),
        "vector",
        shard_of("docId", num_shards).alias("shard"),
        *[c for c in ["is_update"] if c in candidates.columns],
    )


def lookup(
    index: DataFrame, column: str, value: str, num_shards: int | None = None
) -> DataFrame:
    """Exact-term lookup by ``doc_id``, ``chunk_id`` or ``chunk_hash``.

    With the number of shards given, a document is read from its own shard alone;
    within a shard, files are sorted by document.
    """
    if column not in ("doc_id", "chunk_id", "chunk_hash"):
        raise ValueError(f"{column} is not an exact-term column")
    found = index.filter(F.col(column) == value)
    if column == "doc_id" and num_shards is not None:
        found = found.filter(F.col("shard") == shard_of(F.lit(value), num_shards))
    return found


def lookup_stored(table: ManagedTable, column: str, value: str) -> DataFrame:
    """The same on a stored index, which knows its number of shards."""
    return lookup(table.read(), column, value, table.stored_buckets())


def offset_range(index: DataFrame, first: int, last: int) -> DataFrame:
    """Chunks whose ordinal lies in ``first``..``last``, both included."""
    return index.filter(F.col("offset").between(first, last))
