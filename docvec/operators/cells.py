"""Approximate search: vectors grouped in cells, queries probe the nearest ones."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docvec.functions.vectors import is_valid, l2_normalize
from docvec.operators.search import TILE_VECTORS, best_in_places, knn, no_hits, stored, usable_queries
from docvec.options import TOP_K
from docvec.sources.tables import ManagedTable

CELLS = 256


def train_cells(
    vectors: DataFrame, cells: int, vector_col: str = "vector", seed: int = 17, share: float = 1.0,
    unit: bool = False,
) -> np.ndarray:
    """Cell centres by k-means on all rows, or on a share of them if one is given. The
    share decides how good the cells are, not which rows are found. ``unit`` takes the
    directions alone, as cosine does; give it in assignment and search too."""
    usable = vectors.filter(is_valid(vector_col)).select(vector_col)
    if unit:
        usable = usable.select(l2_normalize(vector_col).alias(vector_col))
    total = usable.count()
    if total == 0:
        raise ValueError("no vectors to train on")
    sample = usable if share >= 1.0 else usable.sample(False, share, seed)
    features = sample.select(array_to_vector(vector_col).alias("features"))
    model = KMeans(k=min(cells, total), seed=seed, maxIter=10).fit(features)
    return np.array(model.clusterCenters())


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = np.einsum("ij,ij->i", points, points)[:, None]
    return squares + np.einsum("ij,ij->i", centres, centres)[None, :] - 2 * points @ centres.T


def _unit(points: np.ndarray) -> np.ndarray:
    """Rows of length one; zero rows stay."""
    size = np.sqrt(np.einsum("ij,ij->i", points, points))[:, None]
    return np.divide(points, size, out=np.array(points, np.float64), where=size > 0)


def assign_cells(
    vectors: DataFrame, centres: np.ndarray, vector_col: str = "vector", unit: bool = False
) -> DataFrame:
    """Rows with ``cell``, the nearest centre; other dimensions are left out."""
    shared = vectors.sparkSession.sparkContext.broadcast(centres)
    dim = centres.shape[1]

    @F.arrow_udf("int")
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            flat = batch.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            points = flat.reshape(-1, dim)
            away = np.round(_distances(_unit(points) if unit else points, shared.value), 9)
            yield pa.array(np.argmin(away, axis=1), pa.int32())

    sized = vectors.filter(F.size(vector_col) == dim)
    return sized.withColumn("cell", nearest(F.col(vector_col)))


def nearest_cells(centres: np.ndarray, nprobe: int, unit: bool = False):
    """The ``nprobe`` nearest cells of each query, or of its direction, nearest first. A short
    query is about equally far from all centres of unit vectors; its direction is not."""
    n = min(nprobe, len(centres))

    def chosen(queries: np.ndarray) -> np.ndarray:
        away = np.round(_distances(_unit(queries) if unit else queries, centres), 9)
        return np.argsort(away, axis=1, kind="stable")[:, :n]

    return chosen


def _probed(asked: DataFrame, centres: np.ndarray, nprobe: int, unit: bool) -> DataFrame:
    """The queries once for each cell they probe, with ``cell``."""
    if nprobe < 1:
        raise ValueError("nprobe must be at least 1")
    chosen, dim = nearest_cells(centres, nprobe, unit), centres.shape[1]

    @F.arrow_udf("array<int>")
    def cells(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            points = batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            yield pa.array(list(chosen(points).astype(np.int32)), pa.list_(pa.int32()))

    # The outer form, as a filter inferred from an explode would run the function twice.
    return asked.withColumn("cell", F.explode_outer(cells(F.col("vector"))))


def _search_cells(
    vectors: DataFrame,
    probed: DataFrame,
    facts: Row,
    sizes: dict[int, int],
    similarity: str | None,
    id_col: str,
    vector_col: str,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Search in the rows of the probed cells; ``sizes`` has their numbers of rows. A large
    cell is cut into several places, so a cell with a third of all rows is no hot key."""
    spark = vectors.sparkSession
    most = max(min(TILE_VECTORS, -(-sum(sizes.values()) // spark.sparkContext.defaultParallelism)), 1)
    parts = {cell: -(-n // most) for cell, n in sizes.items()}
    firsts = dict(zip(parts, np.cumsum([0, *parts.values()]).tolist()))
    listed = [(int(c), firsts[c], n) for c, n in parts.items()]
    places = F.broadcast(spark.createDataFrame(listed, "cell int, _first int, _parts int"))  # a row for each cell
    part = F.pmod(F.xxhash64(id_col), F.col("_parts")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    return best_in_places(
        vectors.join(places, "cell").withColumn("_place", F.col("_first") + part),
        probed.join(places, "cell").select("*", every.alias("_nth")).withColumn("_place", F.col("_first") + F.col("_nth")),
        sum(parts.values()), facts, similarity, id_col, vector_col, carry,
    )


def knn_cells(
    vectors: DataFrame,
    queries: DataFrame,
    centres: np.ndarray,
    nprobe: int,
    k: int = TOP_K,
    similarity: str | None = "COSINE",
    id_col: str = "chunk_id",
    vector_col: str = "vector",
    unit: bool = False,
) -> DataFrame:
    """Like ``knn`` over the probed cells only, for the output of :func:`assign_cells`.

    With all cells probed the result is exact. :class:`CellStore` keeps the cells, so that
    those that no query probes are not read.
    """
    asked, facts = usable_queries(queries, k)
    probed = stored(_probed(asked, centres, nprobe, unit), "probed")
    used = [r.cell for r in probed.select("cell").distinct().collect()] if facts.n else []
    source = vectors.filter(F.col("cell").isin(used))
    sizes = dict(source.groupBy("cell").count().collect()) if used else {}
    if not sizes:
        return no_hits(vectors.sparkSession, vectors, queries, id_col, ())
    return _search_cells(source, probed, facts, sizes, similarity, id_col, vector_col)


def recall(found: DataFrame, exact: DataFrame, id_col: str = "chunk_id") -> DataFrame:
    """Share of the exact hits that were found, per query."""
    hit = found.select("query_id", id_col, F.lit(1).alias("_hit"))
    both = exact.join(hit, ["query_id", id_col], "left")
    return both.groupBy("query_id").agg(
        (F.count("_hit") / F.count(F.lit(1))).alias("recall")
    )


class _CellTable(ManagedTable):
    """A managed table whose bucket is the cell that comes with a row."""

    def _bucket(self, buckets: int | None = None) -> Column:
        return F.col("cell").cast("long")


class CellStore:
    """Vectors stored by cell: a managed table with a bucket for each cell, and the centres
    beside it. A search reads the folders of the cells that its queries probe and no others.

    ``carry`` names columns kept with the vectors. Rows are unique on the id; an update
    may move one to another cell. Vectors of another dimension than the centres', and those
    without a direction, are not stored.
    """

    def __init__(
        self, spark: SparkSession, path: str, id_field: T.StructField, carry: Sequence[T.StructField] = (),
        cells: int = CELLS, unit: bool = True,
    ):
        self.spark, self.id_col, self.carry = spark, id_field.name, [f.name for f in carry]
        self.cells, self.unit = cells, unit
        vector = T.StructField("vector", T.ArrayType(T.FloatType(), True))
        schema = T.StructType([id_field, vector, *carry])
        self.table = _CellTable(spark, path, schema, id_field.name, cells, bucket_name="cell")

    # -- writing -----------------------------------------------------------

    def _noted(self) -> dict:
        return json.loads(self.table.note() or "{}")

    def centres(self) -> np.ndarray:
        """Kept with the version: as many rows as there are cells."""
        path = self.table.side("centres", self._noted()["centres"])
        rows = self.spark.read.schema("cell int, centre array<double>").parquet(path).collect()
        return np.array([r.centre for r in sorted(rows)])

    def _placed(self, rows: DataFrame, centres: np.ndarray) -> DataFrame:
        good = rows.filter(is_valid("vector") & (F.size("vector") == centres.shape[1]))
        return assign_cells(good.select(*self.table.schema.names), centres, unit=self.unit)

    def build(self, rows: DataFrame, share: float = 1.0, seed: int = 17) -> None:
        """Train centres on a share of the rows and store all of them by cell."""
        centres = train_cells(rows, self.cells, "vector", seed, share, self.unit)
        write = self.table.put(self._placed(rows, centres))
        listed = [(i, c.tolist()) for i, c in enumerate(centres)]
        made = self.spark.createDataFrame(listed, "cell int, centre array<double>").coalesce(1)
        made.write.mode("overwrite").parquet(self.table.side("centres", write.number))
        self.table.replace(write, json.dumps({"centres": write.number, "unit": self.unit}))

    def recentre(self, share: float = 1.0, seed: int = 17) -> None:
        """Train anew on what is stored now and place all rows by the new centres. The
        number of probes is to be tuned again."""
        self.build(self.table.read(), share, seed)

    def upsert(self, rows: DataFrame) -> None:
        """Add rows and replace those with the same id, in whatever cell they are."""
        self.table.merge(self._placed(rows, self.centres()), [self.id_col])

    def delete(self, ids: DataFrame) -> None:
        self.table.show(None, delete=ids.select(self.id_col))

    # -- searching ---------------------------------------------------------

    def read(self) -> DataFrame:
        return self.table.read()

    def search(
        self, queries: DataFrame, k: int = TOP_K, nprobe: int | None = None, similarity: str | None = "COSINE"
    ) -> DataFrame:
        """``query_id``, id, carried columns, ``score`` and ``rank`` from the probed cells;
        ``nprobe`` is the tuned number unless given."""
        asked, facts = usable_queries(queries, k)
        probed, sizes = self._plan(asked, nprobe) if facts.n else (None, {})
        if not sizes:
            return no_hits(self.spark, self.table.read(), queries, self.id_col, self.carry)
        rows = self.table.read_buckets(list(sizes), *self.table.schema.names, "cell")
        rows = rows.withColumn("cell", F.col("cell").cast("int"))
        return _search_cells(rows, probed, facts, sizes, similarity, self.id_col, "vector", self.carry)

    def _plan(self, asked: DataFrame, nprobe: int | None) -> tuple[DataFrame, dict[int, int]]:
        """Queries by probed cell, and the number of rows of those cells."""
        probes = nprobe or self._noted().get("probes")
        if probes is None:
            raise ValueError("give nprobe, or tune the store first")
        probed = stored(_probed(asked, self.centres(), probes, self.unit), "probed")
        used = [r.cell for r in probed.select("cell").distinct().collect()]  # cells at most
        held = self.table.read_buckets(used, "cell").groupBy("cell").count().collect()
        return probed, {int(c): n for c, n in held}

    def share_read(self, queries: DataFrame, nprobe: int | None = None) -> float:
        """Share of the stored rows that a search reads for an average query."""
        asked, facts = usable_queries(queries, 1)
        probed, sizes = self._plan(asked, nprobe)
        counts = {r.cell: r["count"] for r in probed.groupBy("cell").count().collect()}
        read = sum(n * sizes.get(c, 0) for c, n in counts.items())
        return read / (facts.n * self.table.read("cell").count())

    def tune(self, queries: DataFrame, target: float = 0.9, k: int = TOP_K, similarity: str | None = "COSINE") -> int:
        """The smallest number of probes that gives a mean recall of ``target`` on a table of
        sample queries, against an exact search; kept for later searches."""
        rows = self.table.read(*self.table.schema.names, "cell")
        exact = knn(rows, queries, k, similarity, self.id_col, "vector", carry=["cell"])
        asked, _ = usable_queries(queries, k)
        centres = self.centres()
        # Which probe it is that reaches the cell of each exact hit.
        nearest = nearest_cells(centres, len(centres), self.unit)
        dim = centres.shape[1]

        @F.arrow_udf("int")
        def probe(vectors: pa.Array, cells: pa.Array) -> pa.Array:
            points = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            found = nearest(points) == cells.to_numpy()[:, None]
            return pa.array(found.argmax(axis=1) + 1, pa.int32())

        hits = exact.join(asked.select("query_id", "vector"), "query_id")
        counts = dict(hits.select(probe("vector", "cell").alias("p")).groupBy("p").count().collect())  # cells at most
        total, reached, probes = sum(counts.values()), 0, 0
        while reached < target * total:
            probes += 1
            reached += counts.get(probes, 0)
        self.table.remember(json.dumps({**self._noted(), "probes": max(probes, 1)}))
        return max(probes, 1)
