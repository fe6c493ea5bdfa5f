"""Ranked lexical search of many items at once, with shared parts of their sums added up once.

An item's score of a document is a sum over the item's terms, so items that have terms in
common have partial sums in common. Three steps, for a block of items of bounded size:

1. Documents are read once and keep the counts of the block's terms; the numbers that all
   scores need (documents, length, documents of each term) are counted from these in Spark.
2. Shared term sets are mined from the items: terms that the same items have become one
   atom, and pairs of sets that two or more items have become a new set, round after
   round. The result is a graph in which every set is the sum of two earlier ones.
3. Each task holds one accumulator a set and document for a few documents at a time. Atoms
   are filled from term counts, sets add two accumulators in order of rounds, items add the
   few sets they are left with. A task keeps the best documents of each item; the short
   lists meet in two ranked windows.

No pair of item and document is ever a row, but for the best of a task. Items are the
query set: they are collected block by block, each block below a fixed number of terms,
with one pass over the documents for each block. All sums are whole numbers, so the order
of adding does not matter.

Terms are runs of letters, digits and non-ASCII characters, A-Z in lower case. Null and
empty texts have no terms; a document without terms counts for nothing and is found by
nothing. Repeated rows are documents of their own. Rows of one item id, null among them,
are one item with the terms of all. Documents without an id come last among equal scores.
Empty tables give no rows. Ids of documents are read as long; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docvec.llm.common import stored, table

# What separates terms, and the numbers of the score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE, SLOPE = 10, 90
K = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BLOCK_TERMS = 50_000  # terms of the items of one block, repeats among items counted
BLOCK_CELLS = 4_000_000  # accumulators held at a time
NEIGHBOURS = 8  # a set is paired with so many of the next ones of its item
_PARTS = 64

_SPACES = bytes(
    c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)
).lower()  # ASCII signs become blanks, A-Z lower case


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_SPACES).split()


@dataclass(frozen=True)
class Sharing:
    """Sets to add up: atoms, then sums of two earlier sets in ``rounds`` [first, last);
    item i adds the sets ``members[starts[i]:starts[i + 1]]``."""

    atom: np.ndarray  # of each term
    left: np.ndarray  # of each set that is a sum, numbered from the first after the atoms
    right: np.ndarray
    rounds: list[tuple[int, int]]
    members: np.ndarray
    starts: np.ndarray
    size: int


def share(items: list[list[int]], n_terms: int) -> Sharing:
    """Mine shared sets of terms; every item has a term."""
    holders: dict[int, list[int]] = defaultdict(list)
    for i, terms in enumerate(items):
        for term in terms:
            holders[term].append(i)
    atoms: dict[tuple[int, ...], int] = {}
    atom = np.zeros(n_terms, np.int64)
    for term in range(n_terms):
        atom[term] = atoms.setdefault(tuple(holders[term]), len(atoms))
    # Widely held sets first, so that they stand next to each other in many items.
    held = {number: len(of) for of, number in atoms.items()}
    sets = [sorted({int(atom[t]) for t in terms}, key=lambda s: (-held[s], s)) for terms in items]
    left: list[int] = []
    right: list[int] = []
    rounds: list[tuple[int, int]] = []
    size = len(atoms)
    while True:
        users: dict[tuple[int, int], list[int]] = defaultdict(list)
        for i, of in enumerate(sets):
            shared = [s for s in of if held[s] > 1]
            for j, a in enumerate(shared):
                for b in shared[j + 1 : j + 1 + NEIGHBOURS]:
                    users[min(a, b), max(a, b)].append(i)
        free = [set(of) for of in sets]
        made: list[list[int]] = [[] for _ in sets]
        first = size
        for (a, b), of in sorted(users.items(), key=lambda u: (-len(u[1]), u[0])):
            using = [i for i in of if a in free[i] and b in free[i]]
            if len(using) < 2:
                continue
            for i in using:
                free[i] -= {a, b}
                made[i].append(size)
            held[size] = len(using)
            left.append(a)
            right.append(b)
            size += 1
        if size == first:
            break
        rounds.append((first, size))
        sets = [sorted(kept | set(new), key=lambda s: (-held[s], s)) for kept, new in zip(free, made)]
    return Sharing(
        atom,
        np.array(left, np.int64),
        np.array(right, np.int64),
        rounds,
        np.array([s for of in sets for s in of], np.int64),
        np.cumsum([0, *(len(of) for of in sets[:-1])], dtype=np.int64),
        size,
    )


def accumulate(sharing: Sharing, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, docs: int) -> np.ndarray:
    """Items × documents: sums of the impacts (term, document, impact), set by set."""
    sums = np.zeros((sharing.size, docs), np.int64)
    np.add.at(sums, (sharing.atom[term], doc), impact)
    after = sharing.size - len(sharing.left)
    for first, last in sharing.rounds:
        part = slice(first - after, last - after)
        sums[first:last] = sums[sharing.left[part]] + sums[sharing.right[part]]
    return np.add.reduceat(sums[sharing.members], sharing.starts, axis=0)


class Best:
    """The k best documents of each item: highest score, then smallest id."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.floor = np.ones(items, np.int64)
        self.item, self.score, self.doc = (np.empty(0, np.int64) for _ in range(3))

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        item, place = np.nonzero(scores >= self.floor[:, None])
        if not item.size:
            return
        both = np.r_[self.item, item], np.r_[self.score, scores[item, place]], np.r_[self.doc, docs[place]]
        order = np.lexsort((both[2], -both[1], both[0]))
        item, score, doc = (c[order] for c in both)
        starts = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
        rank = np.arange(item.size) - np.repeat(starts, np.diff(np.r_[starts, item.size]))
        self.floor[item[rank == self.k - 1]] = score[rank == self.k - 1]
        self.item, self.score, self.doc = (c[rank < self.k] for c in (item, score, doc))


COUNTS = "doc_id long, n long, terms array<int>, times array<long>"


def _counted(vocabulary: dict[bytes, int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, starts, terms, times = [], [0], [], []
            for value in batch.column(1):
                found = Counter(terms_of(value.as_py() or b""))
                sizes.append(found.total())
                for term in found.keys() & vocabulary.keys():
                    terms.append(vocabulary[term])
                    times.append(found[term])
                starts.append(len(terms))
            offsets = pa.array(starts, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
                ],
                ["doc_id", "n", "terms", "times"],
            )

    return run


_NO_ID = np.iinfo(np.int64).max


def _scored(sharing: Sharing, weight: np.ndarray, n_docs: int, length: int, k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(sharing.starts), k)
        step = max(BLOCK_CELLS // (sharing.size + len(sharing.members)), 1)
        for batch in batches:
            for first in range(0, batch.num_rows, step):
                part = batch.slice(first, step)
                ids = part.column(0).fill_null(_NO_ID).to_numpy()
                per_doc = part.column(2).value_lengths().to_numpy()
                doc = np.repeat(np.arange(part.num_rows), per_doc)
                if not len(doc):
                    continue
                term = part.column(2).flatten().to_numpy()
                times = part.column(3).flatten().to_numpy()
                # Whole numbers of any size until the division is done.
                norm = np.array([BASE + SLOPE * n * n_docs // length for n in part.column(1).to_pylist()], np.int64)
                impact = weight[term] * (10**9 * times // (1000 * times + 8 * norm[doc]))
                best.add(accumulate(sharing, term, doc, impact, part.num_rows), ids)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(best.item.astype(np.int32)),
                pa.array(best.doc, mask=best.doc == _NO_ID),
                pa.array(best.score),
            ],
            ["item", "doc_id", "score"],
        )

    return run


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each item with their rank: first in parts, then of all parts."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(_PARTS))
    within = F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))
    some = found.withColumn("part", part).withColumn("rank", within).filter(F.col("rank") <= k).drop("part", "rank")
    place = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return some.withColumn("rank", place).filter(F.col("rank") <= k)


def _blocks(items: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[list]:
    """Lists of (id, terms), each of some ``limit`` terms at most, or of one item."""
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    each = items.select(F.col(id_col).alias("item_id"), F.regexp_extract_all(text, F.lit(TERM), F.lit(0)).alias("t"))
    merged = each.groupBy("item_id").agg(F.array_distinct(F.flatten(F.collect_list("t"))).alias("terms"))
    kept = stored(merged.filter(F.size("terms") > 0), "items")
    total = kept.agg(F.sum(F.size("terms"))).first()[0] or 0
    # Hash blocks are aimed at half the limit; one that still exceeds it is split again.
    parts = max(-(-2 * total // limit), 1) if total > limit else 1
    todo = [(parts, p) for p in range(parts)] if total else []
    while todo:
        parts, p = todo.pop()
        block = kept.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == p)
        seen = block.agg(F.sum(F.size("terms")), F.count(F.lit(1))).first()
        if (seen[0] or 0) > limit and seen[1] > 1:
            todo.extend((2 * parts, q) for q in (p, p + parts))
        elif seen[1]:
            yield block.orderBy("item_id").collect()


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``item_col``, rank (from 1), doc_id, score: the k best documents of each item."""
    if k < 1:
        raise ValueError("k must be at least 1")
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    item_type = items.schema[item_col].dataType
    parts = []
    for block in _blocks(items, item_col, item_text_col, block_terms):
        vocabulary: dict[bytes, int] = {}
        of_item = [[vocabulary.setdefault(t.encode(), len(vocabulary)) for t in r.terms] for r in block]
        counts = stored(rows.mapInArrow(_counted(vocabulary), COUNTS), "counts")
        held = dict(counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
        seen = counts.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        if not seen[1]:
            break
        n_docs, length = seen
        weight = np.array(
            [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held.get(t, 0) + 1))) for t in range(len(vocabulary))],
            np.int64,
        )
        score = _scored(share(of_item, len(vocabulary)), weight, n_docs, length, k)
        found = counts.filter(F.size("terms") > 0).mapInArrow(score, "item int, doc_id long, score long")
        names = spark.createDataFrame(
            [(i, r.item_id) for i, r in enumerate(block)],
            T.StructType([T.StructField("item", T.IntegerType()), T.StructField(item_col, item_type)]),
        )
        named = ranked(found, k).join(F.broadcast(names), "item")  # a block's items
        parts.append(named.select(item_col, F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    if not parts:
        kind = T.StructType([T.StructField(item_col, item_type)])
        return spark.createDataFrame([], kind).selectExpr(
            f"`{item_col}`", "0 AS rank", "0L AS doc_id", "0L AS score"
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def op12_search(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return search(docs, table(spark, sf, "benchmark").select("item_id", "text"))


def _terms_sql(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{TERM}')"


OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_terms_sql("text")} AS terms FROM documents),
c AS (SELECT count(*) FILTER (len(terms) > 0) AS docs, sum(len(terms))::BIGINT AS length FROM d),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
q AS (SELECT DISTINCT item_id, unnest({_terms_sql("text")}) AS term FROM benchmark),
w AS (
  SELECT term, floor(1000 * ln((2.0 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM t, c WHERE term IN (SELECT term FROM q) GROUP BY term
),
m AS (SELECT r, doc_id, {BASE} + ({SLOPE} * len(terms) * docs) // length AS m FROM d, c WHERE len(terms) > 0),
i AS (SELECT r, term, doc_id, w * ((1000000000 * tf) // (1000 * tf + 8 * m)) AS impact
  FROM t JOIN w USING (term) JOIN m USING (r)),
s AS (SELECT item_id, r, any_value(doc_id) AS doc_id, sum(impact)::BIGINT AS score
  FROM q JOIN i USING (term) GROUP BY item_id, r)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST)::INT AS rank,
  doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= {K}
"""
