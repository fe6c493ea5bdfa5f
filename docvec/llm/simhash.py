"""Near-duplicate groups by SimHash and meet-in-the-middle ball hashing.

A fingerprint has one bit per majority of its shingles' hash bits. Two texts are
linked when their fingerprints differ in at most three bits.

Half of a radius of three is two flips on one side at least: 2,081 variants of a
fingerprint, too many rows for the shuffle. So one of three bit blocks is left out in
turn. Of three differing bits some block holds at least one; without that block at most
two remain, and half of two is one. Each fingerprint emits, for each block left out,
the rest and its one-bit variants (131 in all). Two fingerprints that differ in at most three bits meet at one of
them, always; whoever meets is verified on all 64 bits.

Null and empty texts, and texts of blanks, have fingerprint zero and are linked like
any other. Equal fingerprints are one node, so copies are never paired. Rows with a
null id keep their row; a group's id is the smallest id that is not null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docvec.llm.common import stored, table
from docvec.llm.graph import components

RADIUS = 3
SHINGLE = 3
SEED = 42
# Three blocks of bits, each left out in turn: first bit and length.
BLOCKS = ((0, 21), (21, 21), (42, 22))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def variants(blocks=BLOCKS) -> list[tuple[int, int]]:
    """(bits kept, bits flipped) of every variant, as signed 64-bit numbers."""
    out = []
    for first, n in blocks:
        gone = ((1 << n) - 1) << first
        keep = ((1 << 64) - 1) & ~gone
        flips = [0] + [1 << i for i in range(64) if keep >> i & 1]
        out += [(_signed(keep), _signed(f)) for f in flips]
    return out


def shingle_hashes(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    words = (text or b"").lower().split()  # ASCII letters and ASCII blanks alone
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    digest = xxhash.xxh64_intdigest
    last = ends[shingle - 1 :] or ends[-1:]
    return np.fromiter(
        (digest(joined[s : e - 1], SEED) for s, e in zip(starts, last)), np.uint64, len(last)
    )


def majority(hashes: np.ndarray) -> int:
    """A bit is set where more than half of the hashes have it."""
    if not len(hashes):
        return 0
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    most = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(most, bitorder="little").view(np.uint64)[0])


def mixed(hashes: np.ndarray, look: int) -> np.ndarray:
    """Other hashes of the same shingles, for another look; look 0 leaves them."""
    if look == 0:
        return hashes
    out = (hashes ^ np.uint64(look)) * np.uint64(0xFF51AFD7ED558CCD)
    out ^= out >> np.uint64(33)
    out *= np.uint64(0xC4CEB9FE1A85EC53)
    return out ^ (out >> np.uint64(33))


def text_fingerprint(text: bytes | None, shingle: int = SHINGLE, look: int = 0) -> int:
    return majority(mixed(shingle_hashes(text, shingle), look))


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", looks: int = 1
) -> DataFrame:
    """(id, looks) of every row: an array of fingerprints, the first being the text's.

    Other columns of the input are not read.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")
    )
    kind = rows.schema["id"].dataType
    schema = T.StructType(
        [T.StructField("id", kind), T.StructField("looks", T.ArrayType(T.LongType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text in batch.column(1):
                hashes = shingle_hashes(text.as_py())
                made.append([_signed(majority(mixed(hashes, k))) for k in range(looks)])
            prints = pa.array(made, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), prints], ["id", "looks"])

    return rows.mapInArrow(run, schema)


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits that differ. Unsigned: of a negative number numpy counts those of its absolute value."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def _forest(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that join whatever is linked among fingerprints of one key: a spanning
    forest, so a key gives fewer edges than members."""
    label = np.arange(len(prints))
    edges = []
    for i in range(len(prints) - 1):
        near = _differing(prints[i + 1 :], prints[i]) <= radius
        other = i + 1 + np.flatnonzero(near & (label[i + 1 :] != label[i]))
        for j in other:
            if label[j] != label[i]:
                edges.append((i, int(j)))
                label[label == label[j]] = label[i]
    return edges


def _links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = prints = np.empty(0, np.int64)
        for batch in batches:
            k = np.concatenate([keys, batch.column(0).to_numpy()])
            f = np.concatenate([prints, batch.column(1).to_numpy()])
            cut = int(np.searchsorted(k, k[-1])) if len(k) else 0  # the last key may go on
            yield _pairs(k[:cut], f[:cut], radius)
            keys, prints = k[cut:], f[cut:]
        yield _pairs(keys, prints, radius)

    return run


def _pairs(keys: np.ndarray, prints: np.ndarray, radius: int) -> pa.RecordBatch:
    a, b = [], []
    if len(keys):
        new = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1])])
        size = np.diff(np.r_[new, len(keys)])
        two = new[size == 2]
        near = _differing(prints[two], prints[two + 1]) <= radius
        a.append(prints[two][near])
        b.append(prints[two + 1][near])
        for s, n in zip(new[size > 2], size[size > 2]):
            group = np.unique(prints[s : s + n])
            found = np.array(_forest(group, radius), np.int64).reshape(-1, 2)
            a.append(group[found[:, 0]])
            b.append(group[found[:, 1]])
    none = np.empty(0, np.int64)
    a, b = np.concatenate([none, *a]), np.concatenate([none, *b])
    pairs = np.unique(np.stack([a, b], 1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) between different fingerprints within the radius.

    Not every pair: enough of them that linked fingerprints stay connected.
    ``prints`` has one column, without repeats.
    """
    masks = F.array(*[F.struct(F.lit(k).alias("keep"), F.lit(f).alias("flip")) for k, f in variants()])
    emitted = prints.select(F.col(prints.columns[0]).alias("f"), F.explode(masks).alias("m")).select(
        F.col("f").bitwiseAND(F.col("m.keep")).bitwiseXOR(F.col("m.flip")).alias("key"), "f"
    )
    met = emitted.repartition("key").sortWithinPartitions("key")
    return met.mapInArrow(_links(radius), "a long, b long").distinct()


def _edges(prints: DataFrame, looks: int) -> DataFrame:
    """Edges between first fingerprints. Those of another look's link stand for it: the
    smallest first fingerprint that has a value stands for the value."""
    edges = stored(links(prints.select("fingerprint").distinct()), "edges")
    for k in range(1, looks):
        seen = prints.select(F.get("looks", F.lit(k)).alias("v"), "fingerprint").distinct()
        first = stored(seen.groupBy("v").agg(F.min("fingerprint").alias("first")), "first")
        found = stored(links(first.select("v")), "edges")
        a, b = first.toDF("a", "from"), first.toDF("b", "to")
        linked = found.join(a, "a").join(b, "b").select("from", "to")
        same = seen.join(first, "v").filter("fingerprint <> first").select("fingerprint", "first")
        edges = edges.union(linked).union(same)
    return edges


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", looks: int = 1
) -> DataFrame:
    """(id, fingerprint, component_id) of every row of ``docs``.

    ``component_id`` is the smallest id that can be reached over links, the row's own
    included. With more ``looks``, texts are also linked when fingerprints of other hashes
    of the same shingles are within the radius: near copies whose bits happen to differ in
    one look are caught in another, and texts of little in common in none. No rows give no
    rows.
    """
    prints = stored(fingerprints(docs, id_col, text_col, looks), "prints")
    prints = prints.withColumn("fingerprint", F.get("looks", F.lit(0)))
    nodes = prints.groupBy("fingerprint").agg(F.min("id").alias("least"))
    roots = stored(components(_edges(prints, looks)), "roots")
    placed = nodes.join(roots, nodes.fingerprint == roots.node, "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of = placed.join(named, "root").select("fingerprint", "component_id")
    return prints.join(of, "fingerprint").select(
        F.col("id").alias(id_col), "fingerprint", "component_id"
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", looks: int = 1
) -> DataFrame:
    """One row of each near-duplicate group, with all its columns: that of the smallest
    id. Rows without an id stand after those with one, and are told apart by their text;
    of wholly repeated rows one stays.
    """
    me = F.struct(
        F.col(id_col).isNull().alias("missing"),
        F.coalesce(F.col(id_col), F.lit(0)).alias("id"),
        F.xxhash64(F.col(text_col)).alias("hash"),
    )
    named = docs.select(me.alias("me"), F.col(text_col).alias("text"))
    found = near_duplicates(named, "me", "text", looks)
    kept = found.filter("me = component_id").select("me.*").distinct()
    names = [f"__keep_{c}" for c in kept.columns]
    marked = docs.select("*", me.alias("__keep")).select(
        "*", *[F.col(f"__keep.{c}").alias(n) for c, n in zip(kept.columns, names)]
    )
    one = W.partitionBy(*names).orderBy(F.lit(0))
    return (
        marked.join(kept.toDF(*names), names, "left_semi")
        .withColumn("__keep_row", F.row_number().over(one))
        .filter("__keep_row = 1")
        .select(*docs.columns)
    )


def op9_simhash(spark, sf):
    found = near_duplicates(table(spark, sf, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
