"""Settings shared by the stages and by search."""

from __future__ import annotations

from dataclasses import dataclass

# The defaults of the data model (chunk size, overlap, batch
# size, shard count, similarity, hits per query).
MAX_CHARS = 1200
OVERLAP = 200
BATCH_SIZE = 32
NUM_SHARDS = 4
SIMILARITY = "COSINE"
TOP_K = 5


@dataclass(frozen=True)
class Options:
    max_chars: int = MAX_CHARS
    overlap: int = OVERLAP
    tail: str = "compat"
    num_shards: int = NUM_SHARDS
    batch_size: int = BATCH_SIZE
    embed_model: str = "hashed-tokens-64"
    embed_ver: str = "1"
    chat_model: str = "extractive"
    similarity: str = SIMILARITY
    top_k: int = TOP_K
    language: str = "en"
    # Hash buckets of the stored tables: an upsert rewrites only the buckets it
    # touches. A few thousand for a large cluster, a handful for a laptop.
    table_buckets: int = 8
    # Leave embeddings as they are and go on to the index.
    skip_embedding: bool = False
    # Keep a term table beside the index, for full-text search.
    term_index: bool = False
    # Stop a run when not one of its texts could be embedded.
    stop_when_all_fail: bool = True
    # Drop documents that are no longer in the input.
    prune: bool = False
