"""Full-text search: a term table, and BM25 ranking over it.

Words are runs of letters and digits, in lower case.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from docvec.functions.chunking import slices
from docvec.operators.search import MOST_TASKS, _Best, check_k, ranked, stored
from docvec.options import TOP_K

# The usual BM25 parameters.
K1 = 1.2
B = 0.75
_WORD = re.compile(r"[^\W_]+")
# Queries of a block, rows of a group, and rows that are scored at a time.
BLOCK_QUERIES = 256
GROUP_ROWS = 25_000
_SCORED_ROWS = 64


def term_counts(text: str | None) -> Counter[str]:
    """How often each word of a text is in it."""
    return Counter(_WORD.findall((text or "").lower()))


def term_index(rows: DataFrame, id_col: str = "chunk_id", text_col: str = "text") -> DataFrame:
    """``term``, ``id_col``, ``tf``, ``length`` (words of the row) and ``nth``.

    ``nth`` numbers the distinct words of a row from 0, so that rows can be counted
    without a shuffle. The words of a row are counted where the row is: a shuffled
    count would move the whole term table. ``id_col`` is unique.
    """
    entry = pa.struct([("term", pa.string()), ("tf", pa.int64()), ("length", pa.int64())])

    @F.arrow_udf("array<struct<term: string, tf: bigint, length: bigint>>")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for texts in slices(batch):
                out = []
                for text in texts:
                    words = term_counts(text)
                    length = words.total()
                    out.append([(t, n, length) for t, n in words.items()])
                yield pa.array(out, pa.list_(entry))

    terms = rows.select(id_col, counted(F.col(text_col)).alias("_t"))
    # As in chunking, the outer form keeps the words from being counted twice.
    listed = terms.select(id_col, F.posexplode_outer("_t").alias("nth", "_e"))
    return listed.filter(F.col("_e").isNotNull()).select(
        F.col("_e.term").alias("term"),
        id_col,
        F.col("_e.tf").alias("tf"),
        F.col("_e.length").alias("length"),
        "nth",
    )


def bm25(
    queries: DataFrame,
    terms: DataFrame,
    k: int = TOP_K,
    id_col: str = "chunk_id",
) -> DataFrame:
    """``query_id``, ``id_col``, ``score``, ``rank`` for ``query_id`` and ``text``.

    ``terms`` is a term table, best stored: it is read for the sizes and for the
    scores. Only rows with a word of some query are joined, and a frequent word's
    rows spread again on (query, row) for the sums.
    """
    check_k(k)
    asked = term_index(queries, "query_id").select("query_id", "term")
    wanted = terms.join(asked.select("term").distinct(), "term", "left_semi")
    frequency = wanted.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    rows = F.sum((F.col("nth") == 0).cast("bigint"))
    sizes = terms.agg(
        F.struct(rows.alias("rows"), (F.sum("tf") / rows).alias("mean")).alias("s")
    )
    words = asked.join(frequency, "term").withColumn("_s", sizes.scalar())
    idf = F.log(1 + (F.col("_s.rows") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = words.select("query_id", "term", idf.alias("idf"), F.col("_s.mean").alias("mean"))
    damp = F.lit(K1) * (1 - B + B * F.col("length") / F.col("mean"))
    part = F.col("idf") * F.col("tf") / (F.col("tf") + damp)
    scores = (
        wanted.join(weights, "term")
        .groupBy("query_id", id_col)
        .agg(F.round(F.sum(part), 9).alias("score"))
    )
    return ranked(scores, k, ["query_id"], id_col).select("query_id", id_col, "score", "rank")


def counted_rows(rows: DataFrame, id_col: str = "chunk_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``length``, ``terms`` (words joined by blanks) and ``tf``: a term table with
    one row per row, for :func:`bm25_rows`. Rows without words are left out."""
    kind = pa.struct([("length", pa.int64()), ("terms", pa.string()), ("tf", pa.list_(pa.int32()))])

    @F.arrow_udf("struct<length: bigint, terms: string, tf: array<int>>")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for texts in slices(batch):
                found = [term_counts(t) for t in texts]
                made = [{"length": c.total(), "terms": " ".join(c), "tf": list(c.values())} for c in found]
                yield pa.array(made, kind)

    # Declared nondeterministic, so that the filter does not count the words once more.
    made = rows.select(id_col, counted.asNondeterministic()(F.col(text_col)).alias("_c"))
    return made.filter(F.col("_c.length") > 0).select(id_col, "_c.length", "_c.terms", "_c.tf")


class _Scored:
    """One block of queries, and their best of the counted rows that have passed."""

    def __init__(self, k: int, mean: float):
        self.k, self.mean = k, mean
        self.numbers: dict = {}
        self.asked: list[tuple[int, str, float]] = []
        self.best: _Best | None = None
        self.last: tuple | None = None

    def ask(self, query_id, terms: list[dict]) -> None:
        number = self.numbers.setdefault(query_id, len(self.numbers))
        self.asked += [(number, t["term"], t["idf"]) for t in terms]

    def offer(self, rows: pa.RecordBatch) -> None:
        if self.best is None:
            self.best = _Best(np.full(len(self.numbers), self.k))
            self.places = {t: i for i, t in enumerate(dict.fromkeys(t for _, t, _ in self.asked))}
            self.weights = np.zeros((len(self.places), len(self.numbers)))
            for number, term, idf in self.asked:
                self.weights[self.places[term], number] += idf
        if not self.numbers:
            return
        lists = [t.split(" ") for t in rows.column("terms").to_pylist()]
        row = np.repeat(np.arange(len(lists)), [len(ts) for ts in lists])
        place = np.array([self.places.get(t, -1) for ts in lists for t in ts])
        tf = rows.column("tf").flatten().to_numpy().astype(np.float64)
        known = place >= 0
        row, place, tf = row[known], place[known], tf[known]
        share = tf / (tf + K1 * (1 - B + B * rows.column("length").to_numpy()[row] / self.mean))
        scores = np.zeros((len(lists), len(self.numbers)))
        if row.size:
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            scores[row[starts]] = np.add.reduceat(self.weights[place] * share[:, None], starts)
        self._add(rows.column("id").to_pylist(), scores)

    def _add(self, ids: list, scores: np.ndarray) -> None:
        """Rows with one id come one after the other and count as one; the last id waits."""
        if self.last is not None:
            ids, scores = [self.last[0], *ids], np.concatenate([self.last[1][None], scores])
        starts = [i for i in range(len(ids)) if not i or ids[i] != ids[i - 1]]
        sums = np.add.reduceat(scores, starts)
        names = [ids[i] for i in starts]
        self.last = (names[-1], sums[-1])
        self._keep(names[:-1], sums[:-1])

    def _keep(self, ids: list, scores: np.ndarray) -> None:
        if ids:
            # A row without a word of a query is no hit of it.
            self.best.add(0, np.where(scores > 0, scores, -np.inf).T, np.array(ids))

    def found(self, types: list[pa.DataType]) -> pa.RecordBatch | None:
        if self.last is not None:
            self._keep([self.last[0]], self.last[1][None])
        best = self.best
        if best is None or best.id is None or not best.id.size:
            return None
        ids = list(self.numbers)
        columns = [[ids[q] for q in best.query], best.id.tolist(), best.score]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["query_id", "id", "score"])


def _scored(k: int, mean: float, types: list[pa.DataType]):
    """Function for mapInArrow: rows by place, queries before counted rows, these by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block = None, _Scored(k, mean)
        for batch in batches:
            keys = 2 * batch.column("place").to_numpy() + batch.column("turn").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for start, end in zip(edges, edges[1:]):
                if start == end:
                    continue
                place, turn = divmod(int(keys[start]), 2)
                if place != now:
                    if (out := block.found(types)) is not None:
                        yield out
                    now, block = place, _Scored(k, mean)
                some = batch.slice(start, end - start)
                if not turn:
                    for query_id, terms in zip(some.column("query_id").to_pylist(), some.column("asked").to_pylist()):
                        block.ask(query_id, terms)
                    continue
                for first in range(0, some.num_rows, _SCORED_ROWS):
                    block.offer(some.slice(first, _SCORED_ROWS))
        if (out := block.found(types)) is not None:
            yield out

    return run


def bm25_rows(queries: DataFrame, counted: DataFrame, k: int = TOP_K, id_col: str = "chunk_id") -> DataFrame:
    """The hits of :func:`bm25` over :func:`counted_rows`, best stored.

    A frequent word makes a pair of nearly every query and row. So rows go to groups by
    their id, blocks of queries go to every group, and a task sends the k best of each query
    there in place of the pairs.
    """
    check_k(k)
    asked = stored(term_index(queries, "query_id").select("query_id", "term"), "asked")
    sizes = counted.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("total")).first()
    blocks = max(-(-asked.select("query_id").distinct().count() // BLOCK_QUERIES), 1)
    groups = max(-(-sizes.n // GROUP_ROWS), 1)
    mean = (sizes.total or 0) / max(sizes.n, 1)
    frequency = counted.select(F.explode(F.split("terms", " ")).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("df")
    )
    idf = F.log(1 + (F.lit(sizes.n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = asked.join(frequency, "term").groupBy("query_id").agg(
        F.collect_list(F.struct("term", idf.alias("idf"))).alias("asked")  # the words of one query
    )
    block, group = F.pmod(F.xxhash64("query_id"), F.lit(blocks)), F.pmod(F.xxhash64("id"), F.lit(groups))
    left = weights.select(
        F.explode(F.sequence(block * groups, block * groups + (groups - 1))).alias("place"),
        F.lit(0).alias("turn"), "query_id", "asked",
    )
    right = counted.withColumnRenamed(id_col, "id").select(
        F.explode(F.sequence(group, group + groups * (blocks - 1), F.lit(groups).cast("bigint"))).alias("place"),
        F.lit(1).alias("turn"), "id", "length", "terms", "tf",
    )
    met = left.unionByName(right, allowMissingColumns=True)
    tasks = min(groups * blocks, MOST_TASKS)
    dealt = met.repartitionById(tasks, F.pmod("place", F.lit(tasks)).cast("int"))
    schema = T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField("id", counted.schema[id_col].dataType),
        T.StructField("score", T.DoubleType()),
    ])
    types = [to_arrow_type(f.dataType) for f in schema.fields]
    found = dealt.sortWithinPartitions("place", "turn", "id").mapInArrow(_scored(k, mean, types), schema)
    best = ranked(found, k, ["query_id"], "id")
    return best.select("query_id", F.col("id").alias(id_col), "score", "rank")
