"""Top-k vector search over tables of queries.

Vectors and queries meet in tiles. Vectors are dealt to groups by a hash of their id, so
groups are of one size whatever the ids; queries are dealt to blocks of bounded size, and
each block goes to every group. A task holds one block of queries at a time, streams the
group's vectors past it and keeps the k best of each query; the short lists are merged by
ranked windows. Nothing passes through the driver but counts. Text is fetched for the hits
alone, from the buckets that hold their documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from docvec.functions.vectors import is_valid, similarity_name
from docvec.operators.embed import EmbedFn, embed_texts, hashed_embed
from docvec.options import TOP_K
from docvec.sources.storage import work_folder
from docvec.sources.tables import ManagedTable

# Bounds of a tile: numbers in its query matrix, hits it keeps, and vectors of its group.
TILE_NUMBERS = 8_000_000
TILE_HITS = 1_000_000
TILE_VECTORS = 250_000
# Tasks that tiles are dealt to; beyond it a task has several, one after the other.
MOST_TASKS = 20_000
# Scores are ranked after rounding, so that equal vectors tie whatever the order
# in which their products were summed.
SCORE_DIGITS = 9
_SLACK = 10.0**-SCORE_DIGITS
_BLOCK_ROWS = 4096
_BLOCK_QUERIES = 512
_PARTIAL_GROUPS = 64


def check_k(k: int) -> None:
    if k < 1:
        raise ValueError("k must be at least 1")


def _scores(queries: np.ndarray, vectors: np.ndarray, similarity: str) -> np.ndarray:
    dots = queries @ vectors.T
    if similarity == "DOT_PRODUCT":
        return (1.0 + dots) / 2.0
    squares_q = np.einsum("ij,ij->i", queries, queries)[:, None]
    squares_v = np.einsum("ij,ij->i", vectors, vectors)[None, :]
    if similarity == "EUCLIDEAN":
        return 1.0 / (1.0 + np.maximum(squares_q + squares_v - 2.0 * dots, 0.0))
    return (1.0 + dots / np.sqrt(squares_q * squares_v)) / 2.0


class _Best:
    """The best (score, id) of a set of queries, ties by ascending id: ``k[q]`` of query q.

    ``row`` says which of the rows offered so far a hit is.
    """

    def __init__(self, k: np.ndarray):
        self.k = k
        self.most = int(k.max(initial=1))
        self.floor = np.full(len(k), -np.inf)
        self.query = np.empty(0, dtype=np.int64)
        self.score = np.empty(0)
        self.row = np.empty(0, dtype=np.int64)
        self.id: np.ndarray | None = None

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray, row: int = 0) -> None:
        """Scores of queries ``first``.. against rows ``row``.. with these ids."""
        span = slice(first, first + scores.shape[0])
        floor = self.floor[span]
        if scores.shape[1] > self.most and np.isneginf(floor).any():
            kth = np.partition(scores, -self.most, axis=1)[:, -self.most]
            floor = np.maximum(floor, kth)
        rows, cols = np.nonzero(scores >= (floor - 2 * _SLACK)[:, None])
        if not rows.size:
            return
        found = np.isfinite(scores[rows, cols])
        rows, cols = rows[found], cols[found]
        query = np.concatenate([self.query, rows + first])
        score = np.concatenate([self.score, np.round(scores[rows, cols], SCORE_DIGITS)])
        place = np.concatenate([self.row, cols + row])
        new = ids[cols]
        both = new if self.id is None else np.concatenate([self.id, new])
        order = np.lexsort((both, -score, query))
        query, score, both, place = query[order], score[order], both[order], place[order]
        starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if query.size else []
        nth = np.arange(query.size) - np.repeat(starts, np.diff(np.r_[starts, query.size]))
        keep = nth < self.k[query]
        last = nth == self.k[query] - 1
        self.floor[query[last]] = score[last]
        self.query, self.score, self.id, self.row = query[keep], score[keep], both[keep], place[keep]


class _Tile:
    """One block of queries, and their best of the vectors that have passed."""

    def __init__(self, similarity: str):
        self.similarity = similarity
        self.ids: list = []
        self.k: list[int] = []
        self.parts: list[np.ndarray] = []
        self.best: _Best | None = None
        self.matrix = np.empty((0, 0))
        self.offered = 0
        self.carried: dict[int, tuple] = {}

    def ask(self, rows: pa.RecordBatch) -> None:
        self.ids += rows.column("query_id").to_pylist()
        self.k += rows.column("_k").to_pylist()
        flat = rows.column("_query").flatten().to_numpy(zero_copy_only=False)
        self.parts.append(flat.reshape(rows.num_rows, -1))

    def offer(self, rows: pa.RecordBatch, carry: Sequence[str]) -> None:
        if not self.ids:
            return
        if self.best is None:
            self.matrix = np.concatenate(self.parts)
            self.best = _Best(np.array(self.k))
        flat = rows.column("_vec").flatten().to_numpy(zero_copy_only=False)
        vectors = flat.astype(np.float64).reshape(rows.num_rows, self.matrix.shape[1])
        ids = np.array(rows.column("_id").to_pylist())
        sizes = np.einsum("ij,ij->i", vectors, vectors)
        usable = np.flatnonzero(np.isfinite(sizes) & (sizes > 0))
        if not usable.size:
            return
        kept = vectors[usable]
        for first in range(0, len(self.matrix), _BLOCK_QUERIES):
            scores = _scores(self.matrix[first : first + _BLOCK_QUERIES], kept, self.similarity)
            self.best.add(first, scores, ids[usable], self.offered)
        if carry:
            now = self.best.row[self.best.row >= self.offered]
            picked = rows.select(list(carry)).take(pa.array(usable[now - self.offered]))
            self.carried.update(zip(now.tolist(), zip(*(c.to_pylist() for c in picked.columns))))
            if len(self.carried) > 4 * self.best.row.size + _BLOCK_ROWS:
                held = set(self.best.row.tolist())
                self.carried = {r: c for r, c in self.carried.items() if r in held}
        self.offered += usable.size

    def found(self, names: list[str], types: list[pa.DataType]) -> pa.RecordBatch | None:
        best = self.best
        if best is None or best.id is None or not best.id.size:
            return None
        carried = zip(*(self.carried[r] for r in best.row.tolist())) if self.carried else []
        columns = [
            [self.ids[q] for q in best.query],
            [self.k[q] for q in best.query],
            best.id.tolist(),
            *carried,
            best.score,
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _tiles(carry: Sequence[str], similarity: str, names: list[str], types: list[pa.DataType]):
    """Function for mapInArrow: rows by place, queries before vectors, to the best of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, tile = None, _Tile(similarity)
        for batch in batches:
            keys = 2 * batch.column("_place").to_numpy() + batch.column("_turn").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for start, end in zip(edges, edges[1:]):
                if start == end:
                    continue
                now, turn = divmod(int(keys[start]), 2)
                if now != place:
                    if (out := tile.found(names, types)) is not None:
                        yield out
                    place, tile = now, _Tile(similarity)
                if not turn:
                    tile.ask(batch.slice(start, end - start))
                    continue
                for first in range(start, end, _BLOCK_ROWS):
                    tile.offer(batch.slice(first, min(_BLOCK_ROWS, end - first)), carry)
        if (out := tile.found(names, types)) is not None:
            yield out

    return run


def ranked(hits: DataFrame, k: int, keys: Sequence[str], id_col: str) -> DataFrame:
    """The k best rows per key by score, ties by id, with their ``rank``.

    Done in two steps, so that the list one task sorts for a key is a fraction of
    what all tasks found for it.
    """
    order = [F.col("score").desc(), F.col(id_col)]
    part = F.pmod(F.xxhash64(id_col), F.lit(_PARTIAL_GROUPS))
    partial = (
        hits.withColumn("_part", part)
        .withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order)))
        .filter(F.col("_r") <= k)
        .drop("_part", "_r")
    )
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return partial.withColumn("rank", place).filter(F.col("rank") <= k)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared work folder and read back."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def usable_queries(queries: DataFrame, k: int) -> tuple[DataFrame, Row]:
    """``query_id``, ``vector`` and ``_k`` of queries with a direction, stored, and their
    number ``n``, dimension ``dim``, hits asked for ``hits`` and most for one ``most``."""
    check_k(k)
    own = F.col("top_k").cast("int") if "top_k" in queries.columns else F.lit(None).cast("int")
    asked = stored(
        queries.select(
            "query_id",
            F.col("vector").cast("array<double>").alias("vector"),
            F.coalesce(own, F.lit(k)).alias("_k"),
            is_valid("vector").alias("_usable"),
        ),
        "queries",
    )
    usable = asked.filter("_usable").drop("_usable")
    if usable.groupBy("query_id").count().filter("count > 1").limit(1).count():
        raise ValueError("query_id must be unique")
    good = F.col("_usable")
    size = F.when(good, F.size("vector"))
    facts = asked.agg(
        F.count_if(good).alias("n"),
        F.min(size).alias("dim"),
        F.max(size).alias("high"),
        F.sum(F.when(good, F.col("_k"))).alias("hits"),
        F.max("_k").alias("most"),
        F.min("_k").alias("least"),
    ).first()
    if facts.least is not None:
        check_k(facts.least)
    if facts.dim != facts.high:
        raise ValueError("query vectors must have one dimension")
    return usable, facts


def best_in_places(
    vectors: DataFrame,
    asked: DataFrame,
    places: int,
    facts: Row,
    similarity: str | None,
    id_col: str,
    vector_col: str,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``query_id``, ``id_col``, ``carry``, ``score``, ``rank`` of the best vectors per query.

    Both sides have ``_place``, below ``places``; a query meets the vectors of the places
    that it has rows for. ``facts.n`` bounds the queries of one place.
    """
    blocks = max(-(-facts.n * facts.dim // TILE_NUMBERS), -(-facts.hits // TILE_HITS), 1)
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))) if blocks > 1 else F.lit(0)
    id_type, vector_type = (vectors.schema[c].dataType for c in (id_col, vector_col))
    fields = [T.StructField(c, vectors.schema[c].dataType) for c in carry]
    query_type = asked.schema["query_id"].dataType

    def none(of: T.DataType):
        return F.lit(None).cast(of)

    left = asked.select(
        (F.col("_place") * blocks + block).alias("_place"), F.lit(0).alias("_turn"), "query_id", "_k",
        F.col("vector").alias("_query"), none(id_type).alias("_id"), none(vector_type).alias("_vec"),
        *[none(f.dataType).alias(f.name) for f in fields],
    )
    right = vectors.filter(F.size(vector_col) == facts.dim).select(
        (F.col("_place") * blocks).alias("_p"), every.alias("_b"), F.col(id_col).alias("_id"),
        F.col(vector_col).alias("_vec"), *[c for c in carry if c != id_col],
    )
    right = right.select(
        (F.col("_p") + F.col("_b")).alias("_place"), F.lit(1).alias("_turn"), none(query_type).alias("query_id"),
        none(T.IntegerType()).alias("_k"), none(T.ArrayType(T.DoubleType())).alias("_query"), "_id", "_vec", *carry,
    )
    tasks = min(places * blocks, MOST_TASKS)
    met = left.unionByName(right).withColumn("_place", F.col("_place").cast("int"))
    dealt = met.repartitionById(tasks, F.pmod("_place", F.lit(tasks))).sortWithinPartitions("_place", "_turn")
    schema = T.StructType(
        [
            T.StructField("query_id", query_type),
            T.StructField("_k", T.IntegerType()),
            T.StructField("_id", id_type),
            *fields,
            T.StructField("score", T.DoubleType()),
        ]
    )
    types = [to_arrow_type(f.dataType) for f in schema.fields]
    found = dealt.mapInArrow(_tiles(carry, similarity_name(similarity), schema.names, types), schema)
    best = ranked(found, facts.most, ["query_id"], "_id").filter(F.col("rank") <= F.col("_k"))
    return best.select("query_id", F.col("_id").alias(id_col), *carry, "score", "rank")


def no_hits(spark: SparkSession, vectors: DataFrame, queries: DataFrame, id_col: str, carry: Sequence[str]) -> DataFrame:
    columns = [queries.schema["query_id"], vectors.schema[id_col], *(vectors.schema[c] for c in carry)]
    rest = [T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType())]
    return spark.createDataFrame([], T.StructType([T.StructField(c.name, c.dataType) for c in columns] + rest))


def knn(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = TOP_K,
    similarity: str | None = "COSINE",
    id_col: str = "chunk_id",
    vector_col: str = "vector",
    carry: Sequence[str] = (),
    passed_over: Observation | None = None,
) -> DataFrame:
    """``query_id``, ``id_col``, ``carry``, ``score``, ``rank``: the k best vectors per query.

    ``queries`` holds ``query_id`` (unique) and ``vector``, and may hold a ``top_k`` of their
    own. Exact. Vectors of another dimension, or without a direction, are passed over;
    ``passed_over`` counts both in the same pass.
    """
    spark = vectors.sparkSession
    asked, facts = usable_queries(queries, k)
    if not facts.n:
        return no_hits(spark, vectors, queries, id_col, carry)
    groups = max(-(-vectors.count() // TILE_VECTORS), spark.sparkContext.defaultParallelism)
    if passed_over is not None:
        vectors = vectors.observe(passed_over, *_problems(vector_col, facts.dim))
    group = F.pmod(F.xxhash64(id_col), F.lit(groups))
    return best_in_places(
        vectors.withColumn("_place", group),
        asked.withColumn("_place", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))),
        groups, facts, similarity, id_col, vector_col, carry,
    )


def _problems(vector_col: str, dim: int) -> list:
    other = F.coalesce(F.size(vector_col), F.lit(-1)) != dim
    return [
        F.count_if(other).alias("dimension"),
        F.count_if(~other & ~is_valid(vector_col)).alias("no_direction"),
    ]


def unusable_vectors(vectors: DataFrame, dim: int, vector_col: str = "vector") -> DataFrame:
    """Rows a search passes over: another dimension, or no direction."""
    size = F.coalesce(F.size(vector_col), F.lit(-1))
    problem = F.when(size != dim, "dimension").when(~is_valid(vector_col), "no direction")
    counted = vectors.select(problem.alias("problem")).filter(F.col("problem").isNotNull())
    return counted.groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


def with_rows(hits: DataFrame, index: DataFrame | ManagedTable) -> DataFrame:
    """Search results: stored hits with document, text and offset from the index.

    Of a stored index, only the shards are read that hold a document of some hit.
    """
    columns = ["doc_id", "chunk_id", "text", "offset"]
    if isinstance(index, ManagedTable):
        rows = index.read(*columns, within=hits.select("doc_id"))
    else:
        rows = index.select(*columns)
    return rows.join(hits, ["doc_id", "chunk_id"]).select(
        "query_id", "rank", F.col("doc_id").alias("docId"), F.col("chunk_id").alias("chunkId"),
        "text", "score", "offset",
    )


def with_defaults(queries: DataFrame, model: str, chat_model: str, k: int = TOP_K) -> DataFrame:
    """Request fields that are absent or null get their defaults."""
    values = {"top_k": k, "embed_model": model, "chat_model": chat_model}
    out = queries
    for name, value in values.items():
        given = F.col(name) if name in queries.columns else F.lit(None)
        out = out.withColumn(name, F.coalesce(given, F.lit(value)))
    return out


def embed_queries(queries: DataFrame, embed: EmbedFn = hashed_embed) -> DataFrame:
    """``query_id`` and ``vector`` (and ``top_k``) of a table of query texts."""
    keep = [c for c in ("query_id", "top_k") if c in queries.columns]
    return embed_texts(queries, embed, text_col="text", keep=keep)


def search_vectors(
    queries: DataFrame,
    index: DataFrame | ManagedTable,
    k: int = TOP_K,
    similarity: str | None = "COSINE",
    passed_over: Observation | None = None,
) -> DataFrame:
    """Ranked index rows for a table of ``query_id`` and ``vector``, and ``top_k`` if a
    query has its own. The hits are stored before their texts are read."""
    rows = index.read() if isinstance(index, ManagedTable) else index
    hits = knn(rows, queries, k, similarity, carry=["doc_id"], passed_over=passed_over)
    return with_rows(stored(hits, "hits"), index)


def batch_search(
    queries: DataFrame,
    index: DataFrame | ManagedTable,
    k: int = TOP_K,
    similarity: str | None = "COSINE",
    embed: EmbedFn = hashed_embed,
    passed_over: Observation | None = None,
) -> DataFrame:
    """Ranked index rows for a table of ``query_id`` and ``text``.

    Each text is embedded once. For ``top_k`` see :func:`search_vectors`.
    """
    check_k(k)
    vectors = stored(embed_queries(queries, embed), "vectors")
    return search_vectors(vectors, index, k, similarity, passed_over)
