"""Approximate nearest neighbours by randomly rotated one-bit codes.

Every vector is made a unit vector, turned by one random rotation, and kept as the signs
of its coordinates: packed bits, with the correction scalar <code, vector>. The inner
product with a turned query is estimated as <code, query> / <code, vector>; the error is
about sqrt((1 - c^2) / c^2 / (d - 1)) for a correction scalar c, so a few times that bound
it. The query is quantized to four bits, and <code, query> comes from the packed bits by
AND and bit counts, one per bit plane.

A candidate is reranked with the exact cosine, in double precision on the original
vectors, when its upper bound reaches the k-th best exact value so far.

Candidates are spread over groups of a bounded number of rows by hash; queries go to
every group in blocks. A task holds the codes of one group and streams queries past
them, and what leaves it is k rows per query. Equal vectors are one candidate, with the
k + 1 smallest ids kept beside it, so a vector that fills a third of the table is one row.
The rotation and the rest need no training; every row is indexed.

Nulls, zero vectors and vectors with null or non-finite components take no part, nor do
rows with a null id; a repeated id with one vector counts once. Vectors of different
lengths have no inner product, so a search is made among vectors of the query's length.
No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docvec.llm.common import stored, table, width

K = 5
EVERY = 50  # queries: ids divisible by this
GROUP_ROWS = 32_768
BITS = 4  # of a query coordinate
SPREAD = 3.0  # error bounds in standard deviations
SEED = 11


def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of rows that can be searched."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists(v, lambda x: x != 0)
    return vectors.filter(F.col(id_col).isNotNull() & v.isNotNull() & ~bad & ~zero).select(
        F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v")
    )


class Codes:
    """The one-bit codes of a set of vectors, and the search among them."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        n, self.dims = vectors.shape
        # Scaling first keeps huge and tiny vectors finite.
        unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        self.turn = rotation(self.dims)
        turned = unit @ self.turn
        signs = turned >= 0
        packed = np.packbits(signs, axis=1)
        padded = np.zeros((n, -(-packed.shape[1] // 8) * 8), np.uint8)
        padded[:, : packed.shape[1]] = packed
        self.bits = np.ascontiguousarray(padded.view(np.uint64).T)  # (words, n)
        self.ones = signs.sum(axis=1)
        self.fit = np.abs(turned).sum(axis=1) / np.sqrt(self.dims)  # <code, vector>
        spread = np.sqrt(np.maximum(1 - self.fit**2, 0) / max(self.dims - 1, 1)) / self.fit
        self.error = SPREAD * spread

    def estimates(self, query: np.ndarray) -> np.ndarray:
        """Estimated cosines of all vectors with a query, from packed bits."""
        unit = query / np.abs(query).max()
        turned = (unit / np.linalg.norm(unit)) @ self.turn
        low, step = turned.min(), max(np.ptp(turned), 1e-12) / (2**BITS - 1)
        levels = np.rint((turned - low) / step).astype(np.uint8)
        dot = np.zeros(len(self.ones), np.int64)  # sum of the levels at set bits
        for plane in range(BITS):
            packed = np.zeros(len(self.bits) * 8, np.uint8)
            row = np.packbits(levels >> plane & 1)
            packed[: len(row)] = row
            for word, mask in zip(self.bits, packed.view(np.uint64)):
                dot += np.bitwise_count(word & mask).astype(np.int64) << plane
        # Signs are 2 * bit - 1, coordinates low + step * level.
        code = 2 * (low * self.ones + step * dot) - (low * self.dims + step * int(levels.sum()))
        return code / np.sqrt(self.dims) / self.fit

    def search(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and exact cosines of all vectors that may be among the k nearest."""
        about = self.estimates(query)
        n = len(about)
        best = np.argpartition(-about, min(k, n - 1))[:k]
        reach = np.sort(self.exact(query, best))[0] if n > k else -np.inf
        rows = np.flatnonzero(about + self.error >= reach)
        rows = np.union1d(rows, best)
        return rows, self.exact(query, rows)

    def exact(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        norm = np.sqrt(np.dot(query, query))
        return np.einsum("ij,j->i", self.vectors[rows], query) / (self.norms[rows] * norm)


def _search_group(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a task come by group, candidates before queries."""
        group, codes, held, ids = None, None, [], []
        for batch in batches:
            frame = batch.to_pandas()
            out: list[tuple[int, int, float]] = []
            for g, part in frame.groupby("group", sort=False):
                if g != group:
                    group, codes, held, ids = g, None, [], []
                mine = part[part.late == 0]
                held += [np.asarray(v, float) for v in mine.v]
                ids += [np.asarray(x, np.int64) for x in mine.ids]
                asked = part[part.late == 1]
                if len(asked) and held:
                    codes = codes or Codes(np.stack(held))
                    for row in asked.itertuples():
                        out += _nearest(codes, ids, int(row.asker), np.asarray(row.v, float), k)
            q, v, s = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())],
                ["query_id", "vec_id", "score"],
            )

    return run


def _nearest(codes: Codes, ids: list[np.ndarray], query: int, v: np.ndarray, k: int):
    """The k nearest of a group, with copies written out. The query's own row takes a
    place among its copies, so one more is looked for."""
    rows, scores = codes.search(v, k + 1)
    order = np.argsort(-scores, kind="stable")
    floor = scores[order[min(k, len(order) - 1)]]
    found = [
        (-s, int(i)) for s, r in zip(scores, rows) if s >= floor for i in ids[r] if i != query
    ]
    return [(query, i, float(-s)) for s, i in sorted(found)[:k]]


def nearest(
    vectors: DataFrame, queries: DataFrame, id_col: str, vector_col: str, k: int = K
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest cosines for each row of ``queries``
    among all other rows of ``vectors``, ties to the smaller id."""
    spark = vectors.sparkSession
    copies = W.partitionBy("v").orderBy("id")
    firsts = (
        usable(vectors, id_col, vector_col)
        .distinct()
        .withColumn("n", F.row_number().over(copies))
        .filter(F.col("n") <= k + 1)
        .groupBy("v")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))  # k + 1 at most
    )
    candidates = stored(firsts, "candidates")
    asked = stored(usable(queries, id_col, vector_col).distinct(), "queries")
    sizes = candidates.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n")).collect()
    found = []
    for row in sizes:  # one row for each length of vectors
        groups = max(-(-row.n // GROUP_ROWS), min(width(spark), -(-row.n // 1024)))
        of = F.pmod(F.xxhash64("v"), F.lit(groups)).cast("int")
        mine = candidates.filter(F.size("v") == row.dims).select(
            of.alias("group"), F.lit(-1).cast("long").alias("asker"), "ids", "v"
        )
        sent = asked.filter(F.size("v") == row.dims).select(
            F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
            F.col("id").alias("asker"),
            F.lit(None).cast("array<long>").alias("ids"),
            "v",
        )
        rows = mine.withColumn("late", F.lit(0)).union(sent.withColumn("late", F.lit(1)))
        placed = rows.repartition(groups, "group").sortWithinPartitions("group", "late")
        found.append(placed.mapInArrow(_search_group(k), "query_id long, vec_id long, score double"))
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    hits = found[0]
    for more in found[1:]:
        hits = hits.union(more)
    ranked = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op5_neighbors(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return nearest(vectors, vectors.filter(F.col("vec_id") % EVERY == 0), "vec_id", "embedding")
