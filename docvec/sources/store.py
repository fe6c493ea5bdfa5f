"""The tables of one document collection."""

from __future__ import annotations

from pyspark.sql import SparkSession

from docvec.operators.postings import Postings
from docvec.sources.chunk_table import ChunkTable
from docvec.sources.storage import Storage
from docvec.sources.tables import SCHEMAS, ManagedTable


class Store:
    """The four tables, the index and its terms under one folder."""

    def __init__(self, spark: SparkSession, path: str, num_shards: int, buckets: int):
        self.spark, self.path = spark, path.rstrip("/")
        self.num_shards = num_shards
        self.scratch: list[str] = []

        def table(name: str, key: str) -> ManagedTable:
            return ManagedTable(spark, f"{self.path}/{name}", SCHEMAS[name], key, buckets)

        self.documents = table("doc_normalized", "docId")
        self.sources = table("sources", "uri")
        self.chunks = ChunkTable(spark, f"{self.path}/chunks", buckets)
        self.embeddings = table("embeddings", "chunkId")
        self.indexed = table("indexed_chunks", "chunkId")
        self.index = ManagedTable(
            spark, f"{self.path}/index", SCHEMAS["index"], "doc_id", num_shards,
            bucket_name="shard", sort_by=["doc_id", "offset"],
        )
        self.terms = Postings(spark, f"{self.path}/terms", buckets)

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def drop_scratch(self) -> None:
        """Delete the key lists that runs left in the shared work folder."""
        files = Storage(self.spark)
        while self.scratch:
            files.delete(self.scratch.pop())
