"""Chunks to vectors through a pluggable function."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docvec.functions.chunking import slices
from docvec.options import BATCH_SIZE

Vectors = Sequence[Sequence[float]] | np.ndarray
EmbedFn = Callable[[list[str]], Vectors]

HASHED_DIM = 64
# Frequent words; the memory of a worker must not follow the vocabulary of the input.
MAX_CACHED_WORDS = 50_000
_WORD = re.compile(r"[^\W_]+")


class _WordCodes(dict):
    """Word to twice its cell, plus one for a negative sign."""

    def __missing__(self, word: str) -> int:
        digest = hashlib.sha256(word.encode()).hexdigest()
        code = int(digest[:8], 16) % HASHED_DIM * 2 + int(digest[8], 16) % 2
        if len(self) >= MAX_CACHED_WORDS:
            self.clear()
        self[word] = code
        return code


_CODES = _WordCodes()


def hashed_embed(texts: list[str]) -> np.ndarray:
    """Built-in embedder: signed hashing of lower-case words into 64 cells.

    The first 8 hex digits of a word's SHA-256 choose the cell, the next one the
    sign. A text whose words are missing or cancel out counts as one word; an empty
    one has no vector. It stands in for a model and needs no other process.
    """
    lowered = [t.lower() for t in texts]
    words = [_WORD.findall(t) for t in lowered]
    codes = np.array([_CODES[w] for ws in words for w in ws], dtype=np.int64)
    rows = np.repeat(np.arange(len(texts)), [len(ws) for ws in words])
    cells = 2 * HASHED_DIM
    counts = np.bincount(rows * cells + codes, minlength=len(texts) * cells)
    counts = counts.reshape(len(texts), HASHED_DIM, 2)
    out = (counts[:, :, 0] - counts[:, :, 1]).astype(np.float64)
    for row in np.flatnonzero(~out.any(axis=1)):
        if lowered[row]:
            cell, negative = divmod(_CODES[lowered[row]], 2)
            out[row, cell] = -1.0 if negative else 1.0
    return out


def _units(vectors: Vectors, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Flat unit vectors and their lengths; an unusable vector has length 0."""
    if len(vectors) != count:
        raise ValueError("one vector per text is needed")
    lengths = np.array([len(v) for v in vectors], dtype=np.int64)
    if lengths.size and (lengths == lengths[0]).all():
        table = np.asarray(vectors, dtype=np.float64).reshape(count, -1)
        sizes = np.sqrt(np.einsum("ij,ij->i", table, table))
        usable = np.isfinite(sizes) & (sizes > 0)
        unit = table[usable] / sizes[usable, None]
        return unit.astype(np.float32).ravel(), np.where(usable, lengths, 0)
    parts = [_units([v], 1) for v in vectors]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _call(embed: EmbedFn, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """One batch; a batch that fails, or answers short, gives empty vectors."""
    try:
        return _units(embed(texts), len(texts))
    except Exception:
        return np.empty(0, dtype=np.float32), np.zeros(len(texts), dtype=np.int64)


def embed_texts(
    df: DataFrame,
    embed: EmbedFn = hashed_embed,
    text_col: str = "chunk",
    keep: Sequence[str] = ("chunkId", "chunkHash"),
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """``keep`` columns and ``vector``; an empty vector means failure.

    The function is called on the executors with at most ``batch_size`` texts. Only
    texts go to the Python workers and only vectors come back; the other columns wait
    in the JVM.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for texts in slices(batch, step=batch_size):
                parts = [
                    _call(embed, texts[start : start + batch_size])
                    for start in range(0, len(texts), batch_size)
                ]
                flat = np.concatenate([np.empty(0, dtype=np.float32), *[p[0] for p in parts]])
                ends = np.cumsum(np.concatenate([[0], *[p[1] for p in parts]]))
                yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.float32()))

    # Declared nondeterministic, so that a later filter on the vector is not pushed down
    # as a second call of the model.
    call = vectors.asNondeterministic()
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(*keep, call(text).alias("vector"))


def embedding_rows(
    embedded: DataFrame, model: str, version: str, failures: bool = False
) -> DataFrame:
    """Rows of the ``embeddings`` table (without the timestamp).

    Failed rows are left out, so that they stay eligible on the next run.
    """
    rows = embedded.select(
        "chunkId",
        "chunkHash",
        F.lit(model).alias("embedder"),
        "vector",
        F.lit(version).alias("embedder_ver"),
    )
    return rows if failures else rows.filter(F.size("vector") > 0)
