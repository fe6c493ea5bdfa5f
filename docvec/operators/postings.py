"""Stored postings: BM25 over a term table kept by part, in which most blocks are not scored.

Rows are dealt to parts of some thousand by a hash of their id. Within a part the rows are
numbered by id, and each term has blocks of row numbers with counts and lengths; a block
says how often its term occurs at most and how long its shortest row is, which bounds what
it can add to a score. An update rewrites the parts that its rows fall in, from their own
blocks.

A search sends each query to every group of parts and to each group the blocks of the asked
terms. For one query and part the terms are taken by falling bound. The k-th best score so
far, over all parts that the task has seen, decides what is still worth reading: once the
terms left cannot lift a new row to it, only rows with a part of a score are followed, and
blocks without such a row, or whose bound is too low, are passed over. The hits are those of
the full sums.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from docvec.operators.lexical import K1, B, term_counts, term_index
from docvec.operators.search import MOST_TASKS, SCORE_DIGITS, check_k, ranked, stored
from docvec.options import TOP_K
from docvec.sources.tables import ManagedTable

PART_ROWS = 8192
BLOCK_ROWS = 128
# Up to so many asked terms are looked up by value in the files, more by a join.
LISTED_TERMS = 1000
_SLACK = 2 * 10.0**-SCORE_DIGITS

# The columns of the stored table. The rows of a part, with their lengths,
# come as a block of the empty term; ``total`` is the sum of those lengths.
SCHEMA = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("term", T.StringType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("rows", T.BinaryType()),
        T.StructField("times", T.BinaryType()),
        T.StructField("most", T.IntegerType()),
        T.StructField("shortest", T.IntegerType()),
        T.StructField("total", T.LongType()),
        T.StructField("ids", T.ArrayType(T.StringType(), True)),
    ]
)
_ARROW = to_arrow_schema(SCHEMA)


class _Numbers(dict):
    """Terms to numbers, in the order in which they are first asked for."""

    def __missing__(self, term: str) -> int:
        self[term] = number = len(self)
        return number

    def of(self, terms, n: int) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, terms), np.int64, n)


@dataclass
class PartRows:
    """The rows of one part while they are gathered: each term of each row, with its count."""

    ids: list[str] = field(default_factory=list)
    row: list[np.ndarray] = field(default_factory=list)
    term: list[np.ndarray] = field(default_factory=list)
    times: list[np.ndarray] = field(default_factory=list)
    numbers: _Numbers = field(default_factory=_Numbers)

    def add(self, row_id: str, counts: dict[str, int]) -> None:
        if counts:
            n = len(counts)
            self.row.append(np.full(n, len(self.ids), np.int32))
            self.term.append(self.numbers.of(counts, n))
            self.times.append(np.fromiter(counts.values(), np.int32, n))
            self.ids.append(row_id)

    def add_blocks(self, terms: list[str], sizes: list[int], rows: list[bytes], times: list[bytes]) -> None:
        """Stored blocks; their rows have the numbers that they had."""
        self.row.append(np.frombuffer(b"".join(rows), np.int32))
        self.term.append(np.repeat(self.numbers.of(terms, len(terms)), sizes))
        self.times.append(np.frombuffer(b"".join(times), np.int32))

    def add_rows(self, other: PartRows) -> None:
        """The rows of another, numbered after those here."""
        if other.ids:
            self.row.append(np.concatenate(other.row) + np.int32(len(self.ids)))
            self.term.append(self.numbers.of(other.numbers, len(other.numbers))[np.concatenate(other.term)])
            self.times.append(np.concatenate(other.times))
            self.ids += other.ids

    def blocks(self, part: int, gone: set[str] = frozenset()) -> pa.RecordBatch | None:
        """The part as it is stored, without rows that are gone. Of rows with one id the
        last added stays."""
        last = {row_id: i for i, row_id in enumerate(self.ids)}
        kept = sorted((i for i, row_id in enumerate(self.ids) if last[row_id] == i and row_id not in gone), key=self.ids.__getitem__)
        if not kept:
            return None
        place = np.full(len(self.ids), -1, np.int32)
        place[kept] = np.arange(len(kept))
        row = place[np.concatenate(self.row)]
        term, times = np.concatenate(self.term)[row >= 0], np.concatenate(self.times)[row >= 0]
        row = row[row >= 0]
        order = np.argsort(term * len(kept) + row)
        row, term, times = row[order], term[order], times[order]
        lengths = np.bincount(row, weights=times, minlength=len(kept)).astype(np.int32)
        # Where a term begins, and within it every so many rows.
        begins = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
        nth = np.arange(len(term)) - np.repeat(begins, np.diff(np.r_[begins, len(term)]))
        starts = np.flatnonzero(nth % BLOCK_ROWS == 0)
        n, ends = len(starts), np.r_[starts, len(term)]
        words = pa.array(self.numbers, pa.string()).take(pa.array(term[starts]))
        most, shortest = np.maximum.reduceat(times, starts), np.minimum.reduceat(lengths[row], starts)
        first = [part, "", len(kept), b"", lengths.tobytes(), 0, 0, int(lengths.sum()), [self.ids[i] for i in kept]]
        rest = [np.full(n, part), words, np.diff(ends), _cut(row, ends), _cut(times, ends), most, shortest, pa.nulls(n), pa.nulls(n)]
        columns = [
            pa.concat_arrays([pa.array([a], f.type), (b if isinstance(b, pa.Array) else pa.array(b)).cast(f.type)])
            for a, b, f in zip(first, rest, _ARROW)
        ]
        return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def _cut(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Whole numbers as one string of bytes for each stretch between ``ends``."""
    values = np.ascontiguousarray(values, np.int32)
    places = pa.py_buffer((ends * values.itemsize).astype(np.int64))
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, places, pa.py_buffer(values)])


_GATHERED = "part int, turn int, id string, text string, term string, n int, rows binary, times binary, ids array<string>"


def _stretches(*columns: pa.Array) -> Iterator[tuple[int, int]]:
    """Where the values of the columns stay the same, as (first, number of rows)."""
    held = [c.to_numpy(zero_copy_only=False) for c in columns]
    if len(held[0]):
        ends = np.flatnonzero(np.any([v[1:] != v[:-1] for v in held], axis=0)) + 1
        bounds = [0, *ends.tolist(), len(held[0])]
        yield from ((a, b - a) for a, b in zip(bounds, bounds[1:]))


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by part: its row list (turn 0), its blocks (1), ids that are gone (2), new
    rows (3)."""
    now, held, gone, new = None, PartRows(), set(), PartRows()

    def finished():
        # New rows replace those with their id; ids that are gone and come again stay.
        gone.difference_update(new.ids)
        held.add_rows(new)
        return held.blocks(now, gone)

    for batch in batches:
        for start, size in _stretches(batch["part"], batch["turn"]):
            some = batch.slice(start, size)
            part, turn = some["part"][0].as_py(), some["turn"][0].as_py()
            if part != now:
                if now is not None and (out := finished()) is not None:
                    yield out
                now, held, gone, new = part, PartRows(), set(), PartRows()
            if turn == 0:
                held.ids = some["ids"][-1].as_py()
            elif turn == 1:
                held.add_blocks(*(some[c].to_pylist() for c in ("term", "n", "rows", "times")))
            elif turn == 2:
                gone.update(some["id"].to_pylist())
            else:
                for row_id, text in zip(some["id"], some["text"]):
                    new.add(row_id.as_py(), term_counts(text.as_py()))
    if now is not None and (out := finished()) is not None:
        yield out


@dataclass
class Block:
    rows: np.ndarray
    times: np.ndarray
    most: int
    shortest: int


class Part:
    """The blocks of one part for the asked terms, ready to be scored."""

    def __init__(self, mean: float):
        self.mean = mean
        self.ids: list[str] = []
        self.lengths = np.empty(0)
        self.blocks: dict[str, list[Block]] = {}
        self.shares: dict[tuple[str, int], np.ndarray] = {}
        self.wholes: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self.most: dict[str, list[float]] = {}
        self.scored = 0

    def add(self, term: str, rows: bytes, times: bytes, most: int, shortest: int, ids: list[str] | None) -> None:
        if term == "":
            self.ids, self.lengths = ids, np.frombuffer(times, np.int32).astype(np.float64)
            return
        block = Block(np.frombuffer(rows, np.int32), np.frombuffer(times, np.int32), most, shortest)
        self.blocks.setdefault(term, []).append(block)

    def ready(self) -> None:
        for of in self.blocks.values():
            of.sort(key=lambda b: b.rows[0])

    def _share(self, times, length):
        return times / (times + K1 * (1 - B + B * length / self.mean))

    def bound(self, block: Block) -> float:
        return float(self._share(block.most, block.shortest))

    def share(self, term: str, n: int) -> np.ndarray:
        """What a block adds to its rows, but for the weight of the term."""
        if (term, n) not in self.shares:
            block = self.blocks[term][n]
            self.shares[term, n] = self._share(block.times.astype(np.float64), self.lengths[block.rows])
            self.scored += 1
        return self.shares[term, n]

    def whole(self, term: str) -> tuple[np.ndarray, np.ndarray]:
        """All rows of a term, and what it adds to them but for its weight."""
        if term not in self.wholes:
            blocks = self.blocks[term]
            shares = [self.share(term, n) for n in range(len(blocks))]
            self.wholes[term] = np.concatenate([b.rows for b in blocks]), np.concatenate(shares)
        return self.wholes[term]

    def bounds(self, term: str) -> list[float]:
        if term not in self.most:
            self.most[term] = [self.bound(b) for b in self.blocks[term]]
        return self.most[term]

    def best(self, asked: list[tuple[str, float]], k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the k best rows that reach the floor, best first, ties by id."""
        terms = []
        for term, weight in asked:
            if term in self.blocks:
                bounds = [weight * b for b in self.bounds(term)]
                terms.append((max(bounds), term, weight, bounds))
        terms.sort(reverse=True)
        left = np.cumsum([t[0] for t in terms][::-1])[::-1].tolist() + [0.0]
        sums = np.zeros(len(self.ids))
        for i, (_, term, weight, bounds) in enumerate(terms):
            if left[i] >= floor - _SLACK:
                rows, shares = self.whole(term)
                sums[rows] += weight * shares  # a term has a row once
            else:
                followed = np.flatnonzero((sums > 0) & (sums + left[i] >= floor - _SLACK))
                if not followed.size:
                    return np.empty(0, np.int64), np.empty(0)
                for n, block in enumerate(self.blocks[term]):
                    a, b = np.searchsorted(followed, (block.rows[0], block.rows[-1] + 1))
                    some = followed[a:b]
                    if not some.size or sums[some].max() + bounds[n] + left[i + 1] < floor - _SLACK:
                        continue
                    places = np.minimum(np.searchsorted(block.rows, some), len(block.rows) - 1)
                    there = block.rows[places] == some
                    sums[some[there]] += weight * self.share(term, n)[places[there]]
            # The k-th best is looked for once it can be above what is left.
            if i + 1 < len(terms) and sums.max() >= left[i + 1] - _SLACK and np.count_nonzero(sums) >= k:
                floor = max(floor, float(np.partition(sums, -k)[-k]))
        rows = np.flatnonzero((sums > 0) & (sums >= floor - _SLACK))
        scores = np.round(sums[rows], SCORE_DIGITS)
        order = np.lexsort((rows, -scores))[:k]
        return rows[order], scores[order]


class _Asked:
    """The queries of one group of parts and the best rows found for each."""

    def __init__(self, k: int):
        self.k = k
        self.ids: list = []
        self.terms: list[list[tuple[str, float]]] = []
        self.hits: list[list[tuple[float, str]]] = []

    def add(self, query_id, terms: list[dict]) -> None:
        self.ids.append(query_id)
        self.terms.append([(t["term"], t["idf"]) for t in terms])
        self.hits.append([])

    def score(self, part: Part) -> None:
        part.ready()
        for asked, hits in zip(self.terms, self.hits):
            floor = -hits[-1][0] if len(hits) == self.k else 0.0
            rows, scores = part.best(asked, self.k, floor)
            if len(rows):
                hits += [(-s, part.ids[r]) for r, s in zip(rows.tolist(), scores.tolist())]
                hits.sort()
                del hits[self.k :]

    def found(self, types: list[pa.DataType]) -> pa.RecordBatch | None:
        rows = [(q, row_id, -s) for q, hits in zip(self.ids, self.hits) for s, row_id in hits]
        if not rows:
            return None
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["query_id", "id", "score"])


def _searched(k: int, mean: float, types: list[pa.DataType]):
    """Rows come by group and part, the queries of a group before its blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, now, asked, part = None, None, _Asked(k), None
        for batch in batches:
            for place, number, query_id, terms, term, rows, times, most, shortest, ids in zip(
                *(c.to_pylist() for c in batch.columns)
            ):
                if place != group or number != now:
                    if part is not None:
                        asked.score(part)
                    part, now = None, number
                if place != group:
                    if (out := asked.found(types)) is not None:
                        yield out
                    group, asked = place, _Asked(k)
                if query_id is not None:
                    asked.add(query_id, terms)
                    continue
                part = part or Part(mean)
                part.add(term, rows, times, most, shortest, ids)
        if part is not None:
            asked.score(part)
        if (out := asked.found(types)) is not None:
            yield out

    return run


def _without_null_lists(df: DataFrame, *columns: str) -> DataFrame:
    """Empty lists for null ones. On its way to a worker Spark looks at the size of a batch
    after each row, and then goes through all null lists since the last other one."""
    return df.withColumns({c: F.coalesce(c, F.array().cast(df.schema[c].dataType)) for c in columns})


def _by(first: str, second: str) -> Column:
    """The order by two numbers as one number, which Spark sorts without comparing rows."""
    return F.col(first).cast("long") * F.lit(1 << 32) + F.col(second)


class Postings:
    """A stored term table over rows of an id and a text."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 8, id_col: str = "chunk_id", part_rows: int = PART_ROWS):
        self.spark, self.id_col, self.part_rows = spark, id_col, part_rows
        self.table = ManagedTable(spark, path, SCHEMA, "part", buckets, sort_by=["term", "part"])

    def note(self) -> dict:
        return json.loads(self.table.note() or "{}")

    def _part(self, parts: int):
        return F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part")

    def _gathered(self, parts: int, new: DataFrame | None, gone: DataFrame | None, old: DataFrame | None) -> DataFrame:
        """What the parts are made of, by part."""
        sides = []
        if old is not None:
            sides.append(old.select("part", F.when(F.col("term") == "", 0).otherwise(1).alias("turn"), "term", "n", "rows", "times", "ids"))
        if gone is not None:
            sides.append(gone.select(self._part(parts), F.lit(2).alias("turn"), "id"))
        if new is not None:
            sides.append(new.select(self._part(parts), F.lit(3).alias("turn"), "id", "text"))
        every = self.spark.createDataFrame([], _GATHERED)
        for side in sides:
            every = every.unionByName(side, allowMissingColumns=True)
        every = _without_null_lists(every, "ids")
        tasks = max(min(parts, MOST_TASKS), 1)
        return every.repartitionById(tasks, F.pmod("part", F.lit(tasks))).sortWithinPartitions(_by("part", "turn"))

    def build(self, rows: DataFrame, text_col: str = "text", **note) -> None:
        """Store the terms of all rows anew. ``note`` is kept with the table."""
        rows = rows.select(F.col(self.id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
        parts = max(-(-rows.count() // self.part_rows), self.spark.sparkContext.defaultParallelism)
        made = self._gathered(parts, rows, None, None).mapInArrow(_built, SCHEMA)
        self.table.replace(self.table.put(made), json.dumps({"parts": parts, **note}))

    def update(self, rows: DataFrame, gone: DataFrame, text_col: str = "text", **note) -> None:
        """Add rows, replacing those with their id, and take away rows whose id is gone and
        that do not come again. Only parts that such a row falls in are written."""
        noted = {**self.note(), **note}
        parts = noted["parts"]
        new = stored(rows.select(F.col(self.id_col).cast("string").alias("id"), F.col(text_col).alias("text")), "terms_new")
        away = stored(gone.select(F.col(self.id_col).cast("string").alias("id")).distinct(), "terms_gone")
        touched = new.select(self._part(parts)).unionByName(away.select(self._part(parts))).distinct()
        touched = stored(touched, "terms_parts")
        old = self.table.read(within=touched).join(touched, "part", "left_semi")
        made = self._gathered(parts, new, away, old).mapInArrow(_built, SCHEMA)
        self.table.show(self.table.put(made), delete=touched, note=json.dumps(noted))

    def search(self, queries: DataFrame, k: int = TOP_K) -> DataFrame:
        """``query_id``, id, ``score``, ``rank``: the k best rows by BM25 for ``query_id`` (unique)
        and ``text``."""
        check_k(k)
        asked = stored(term_index(queries, "query_id").select("query_id", "term"), "asked")
        blocks = self._asked_blocks(asked)
        sizes = self.table.read("term", "n", "total").filter("term = ''")
        n, total = sizes.agg(F.sum("n"), F.sum("total")).first()
        id_type = queries.schema["query_id"].dataType
        schema = T.StructType(
            [T.StructField("query_id", id_type), T.StructField("id", T.StringType()), T.StructField("score", T.DoubleType())]
        )
        if not n:
            empty = self.spark.createDataFrame([], schema).withColumn("rank", F.lit(0))
            return empty.withColumnRenamed("id", self.id_col)
        held = blocks.filter("term <> ''").groupBy("term").agg(F.sum("n").alias("df"))
        idf = F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
        weights = asked.join(held, "term").groupBy("query_id").agg(
            F.collect_list(F.struct("term", idf.alias("idf"))).alias("terms")  # the words of one query
        )
        groups = min(self.note()["parts"], max(self.spark.sparkContext.defaultParallelism, self.note()["parts"] // 64))
        every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
        columns = ["place", "part", "query_id", "terms", "term", "rows", "times", "most", "shortest", "ids"]
        left = weights.select(every.alias("place"), F.lit(-1).alias("part"), "query_id", "terms")
        right = blocks.select(
            F.pmod("part", F.lit(groups)).alias("place"), "part", "term", "rows", "times", "most", "shortest", "ids"
        )
        met = _without_null_lists(left.unionByName(right, allowMissingColumns=True).select(*columns), "terms", "ids")
        dealt = met.repartitionById(groups, F.col("place").cast("int")).sortWithinPartitions(_by("place", "part"))
        types = [to_arrow_type(f.dataType) for f in schema.fields]
        found = dealt.mapInArrow(_searched(k, total / n, types), schema)
        best = ranked(found, k, ["query_id"], "id")
        return best.select("query_id", F.col("id").alias(self.id_col), "score", "rank")

    def _asked_blocks(self, asked: DataFrame) -> DataFrame:
        """The blocks of asked terms and the row lists. Files are sorted by term, so a short
        list of terms is looked up in them."""
        terms = asked.select("term").distinct()
        some = terms.limit(LISTED_TERMS + 1).collect()
        rows = self.table.read()
        if len(some) <= LISTED_TERMS:
            return rows.filter(F.col("term").isin(["", *(r.term for r in some)]))
        return rows.join(terms.unionByName(self.spark.createDataFrame([("",)], "term string")), "term", "left_semi")
