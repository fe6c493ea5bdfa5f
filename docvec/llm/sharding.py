"""Sharding by balanced label propagation.

Nodes with sizes are linked through hubs (documents through equal texts, say): a hub
stands for a group and no pair of its members is ever written. Linked nodes start in
shards by hash. In each round every node counts its neighbours per shard with one join
of membership and hub histogram, and wishes to go where most of them are. Wishes are
summed per pair of shards, a quota per pair keeps every shard under its capacity, and a
wish is granted by hash at the rate of its quota, without sorting or collecting nodes.
Rounds end when nobody wishes to move, or after ``ROUNDS``.

Then sizes are made even. Shards that linked nodes alone would overfill give some back.
Free nodes larger than a thousandth of a shard are placed largest first on the driver;
there can be no more than a thousand per shard. The rest is cut along 65,536 hash
buckets into stretches that fill the shards to one level. So shards differ by less than
the larger of one such node and a bucket, unless a single row is larger than a shard.

Hubs and copies with a third of all rows meet one-row sides in the joins, which adaptive
execution splits. A row that is repeated is one node with the size of all its copies, or
several when these are more than a thousandth of a shard. Null and empty texts are texts like any other, with size one. An empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docvec.llm.common import stored, table

SHARDS = 8
ROUNDS = 10
FULL = 0.97  # of its capacity: a full shard
HEAVY = 1000  # nodes over 1/HEAVY of a shard are placed one by one
BUCKETS = 65_536
SLOT_BUCKETS = 1024


def _start(node: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(node, F.lit("start")), F.lit(shards)).cast("int")


def _bucket(node: Column) -> Column:
    return F.pmod(F.xxhash64(node, F.lit("fill")), F.lit(BUCKETS)).cast("int")


def _chance(node: Column, turn: int) -> Column:
    return F.pmod(F.xxhash64(node, F.lit(turn)), F.lit(1 << 30)) / float(1 << 30)


def quotas(demand: np.ndarray, load: np.ndarray, capacity: float) -> np.ndarray:
    """The share of each shard-to-shard demand that keeps all loads under capacity.

    Starts from everything and lowers what flows into overfull shards until none is.
    """
    share = np.ones_like(demand)
    for _ in range(200):
        flow = demand * share
        after = load - flow.sum(1) + flow.sum(0)
        over = np.maximum(after - np.maximum(capacity, load), 0)
        if over.max(initial=0) <= 1e-9 * capacity:
            return share
        into = flow.sum(0)
        keep = np.where(into > 0, 1 - np.minimum(over / np.maximum(into, 1e-300), 1), 1.0)
        share = share * keep[None, :]
    return np.where(over[None, :] > 0, 0.0, share)


def propagate(nodes: DataFrame, links: DataFrame, capacity: float, shards: int) -> DataFrame:
    """(node, size, shard) of the linked nodes, after the rounds.

    ``nodes`` is (node, size), ``links`` (node, hub), without repeats; hubs have two
    nodes at least.
    """
    linked = links.select("node").distinct()
    now = stored(
        nodes.join(linked, "node", "left_semi").withColumn("shard", _start(F.col("node"), shards)), "labels"
    )
    still = 0
    for turn in range(ROUNDS):
        load = np.zeros(shards)
        for row in now.groupBy("shard").agg(F.sum("size").alias("size")).collect():  # one row a shard
            load[row.shard] = row.size
        counts = links.join(now, "node").groupBy("hub", "shard").agg(F.count("*").alias("n"))
        votes = (
            links.join(counts, "hub")
            .groupBy("node", F.col("shard").alias("to"))
            .agg(F.sum("n").alias("n"), F.max(F.xxhash64("hub", "shard")).alias("tie"))
        )
        # Every other round, a group that is split over a full shard meets elsewhere; who
        # has no neighbour outside of full shards stays. In between, shards can exchange.
        full = [s for s in range(shards) if turn % 2 and load[s] > FULL * capacity]
        best = (
            votes.filter(~F.col("to").isin(full))
            .groupBy("node")
            .agg(F.max_by("to", F.struct("n", "tie")).alias("to"))
        )
        wishes = now.join(best, "node", "left").withColumn("to", F.coalesce("to", "shard"))
        wishes = stored(wishes, "wishes")
        demand = np.zeros((shards, shards))
        moving = wishes.filter("shard <> to").groupBy("shard", "to").agg(F.sum("size").alias("size"))
        for row in moving.collect():  # one row a pair of shards
            demand[row.shard, row.to] = row.size
        share = quotas(demand, load, capacity)
        still = 0 if (demand * share).any() else still + 1
        if not demand.any() and not full or still == 2:
            break
        rate = F.element_at(
            F.array(*[F.lit(float(x)) for x in share.ravel()]), F.col("shard") * shards + F.col("to") + 1
        )
        moves = (F.col("shard") != F.col("to")) & (_chance(F.col("node"), turn) < rate)
        now = stored(
            wishes.select("node", "size", F.when(moves, F.col("to")).otherwise(F.col("shard")).alias("shard")),
            "labels",
        )
    return now


def _sums(df: DataFrame, *by: str) -> list:
    return df.groupBy(*by).agg(F.sum("size").alias("size")).collect()


def _evict(now: DataFrame, goal: float, shards: int) -> DataFrame:
    """``now`` with null shards where a shard's linked nodes alone are above the goal."""
    load = {r.shard: r.size for r in _sums(now, "shard")}
    full = [s for s in load if load[s] > goal]
    if not full:
        return now
    limits = {s: BUCKETS for s in range(shards)}
    marked = now.withColumn("bucket", _bucket(F.col("node")))
    run = {s: 0.0 for s in full}
    over = marked.filter(F.col("shard").isin(full))
    for r in sorted(_sums(over, "shard", "bucket"), key=lambda r: r.bucket):  # BUCKETS a shard at most
        run[r.shard] += r.size
        if run[r.shard] > goal:
            limits[r.shard] = min(limits[r.shard], r.bucket)
    limit = F.element_at(F.array(*[F.lit(limits[s]) for s in range(shards)]), F.col("shard") + 1)
    return marked.withColumn("shard", F.when(F.col("bucket") < limit, F.col("shard"))).drop("bucket")


def fill(load: np.ndarray, sums: np.ndarray) -> list[int]:
    """For each shard the first bucket after its stretch: the stretches bring all
    shards up to one level."""
    low, high = load.min(), load.max() + sums.sum()
    for _ in range(200):
        level = (low + high) / 2
        low, high = (low, level) if np.maximum(level - load, 0).sum() >= sums.sum() else (level, high)
    room = np.cumsum(np.maximum(high - load, 0))
    middle = np.cumsum(sums) - sums / 2
    ends = np.searchsorted(middle, room, side="right")
    ends[-1] = len(sums)
    return [int(x) for x in np.maximum.accumulate(ends)]


def balance(nodes: DataFrame, links: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``nodes`` (node, size) with a column ``shard``, of even size, few links cut."""
    total = nodes.agg(F.sum("size")).first()[0] or 0
    goal = total / shards
    now = stored(_evict(propagate(nodes, links, goal, shards), goal, shards), "linked")
    settled = now.filter("shard is not null").select("node", "shard")
    load = np.zeros(shards)
    for r in _sums(now.filter("shard is not null"), "shard"):
        load[r.shard] = r.size
    placed = nodes.join(settled, "node", "left")
    free = placed.filter("shard is null")
    heavy = free.filter(F.col("size") > goal / HEAVY)
    spark = nodes.sparkSession
    chosen = []
    for r in sorted(heavy.select("node", "size").collect(), key=lambda r: (-r.size, r.node)):  # HEAVY * shards at most
        shard = int(np.argmin(load))
        load[shard] += r.size
        chosen.append((r.node, shard))
    sums = np.zeros(BUCKETS)
    light = free.filter(F.col("size") <= goal / HEAVY)
    for r in _sums(light.withColumn("bucket", _bucket(F.col("node"))), "bucket"):  # BUCKETS at most
        sums[r.bucket] = r.size
    ends = fill(load, sums)
    by_bucket = F.lit(shards - 1)
    for shard in reversed(range(shards - 1)):
        by_bucket = F.when(_bucket(F.col("node")) < ends[shard], shard).otherwise(by_bucket)
    heavies = spark.createDataFrame(chosen, f"node {nodes.schema['node'].dataType.simpleString()}, heavy int")
    return placed.join(F.broadcast(heavies), "node", "left").select(
        "node", "size", F.coalesce("shard", "heavy", by_bucket).cast("int").alias("shard")
    )


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _row_hash(columns: list[str]) -> Column:
    """A hash of a whole row; nulls count, wherever they are."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(*[F.col(c) for c in columns], nulls, F.lit("node"))


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
    more_links: DataFrame | None = None,
) -> DataFrame:
    """``docs`` with a column ``shard``; equal texts stay together as far as sizes allow.

    ``more_links`` (id, hub) links documents through other things that they share.
    A row that comes so often that its copies are more than 1/``HEAVY`` of a shard is cut
    into pieces of copies, each a node of its own; there are few such rows.
    """
    text = F.col(text_col)
    names = [c for c in docs.columns if c != "shard"]
    node = _row_hash(names)
    rows = docs.select(
        node.alias("node"), F.xxhash64(text, F.length(text)).alias("hub"), text_size(text).alias("size"),
        F.col(id_col).alias("id"),
    )
    whole = rows.groupBy("node", "hub", "id").agg(F.sum("size").alias("size"), F.count("*").alias("copies"))
    whole = stored(whole, "nodes")
    total = whole.agg(F.sum("size")).first()[0] or 0
    most = total / shards / HEAVY
    often = whole.filter((F.col("copies") > 1) & (F.col("size") > most))
    parts = F.least(F.col("copies"), F.ceil(F.col("size") / most)).cast("int")
    pieces = often.select("node", "hub", "id", "size", "copies", parts.alias("parts")).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("nth")
    )
    # The first pieces have one copy more where the copies do not come out even.
    own = F.expr("copies div parts") + F.when(F.col("nth") < F.col("copies") % F.col("parts"), 1).otherwise(0)
    pieces = stored(
        pieces.select(
            F.col("node").alias("row"), F.xxhash64("node", "nth").alias("node"), "hub", "id",
            (own * F.expr("size div copies")).alias("size"), own.cast("int").alias("own"),
        ),
        "pieces",
    )
    single = whole.filter((F.col("copies") == 1) | (F.col("size") <= most))
    units = stored(
        single.select("node", "hub", "id", "size").unionByName(pieces.select("node", "hub", "id", "size")), "units"
    )
    links = units.select("node", "hub")
    if more_links is not None:
        named = more_links.select(F.col("id").alias("__id"), F.xxhash64(F.col("hub"), F.lit("more")).alias("hub"))
        links = links.unionByName(units.select("node", "id").join(named, F.col("id") == F.col("__id")).select("node", "hub"))
    links = links.distinct()
    shared = links.groupBy("hub").agg(F.count("*").alias("n")).filter("n > 1").select("hub")
    links = stored(links.join(shared, "hub", "left_semi").select("node", "hub"), "links")
    nodes = units.groupBy("node").agg(F.sum("size").alias("size"))
    found = stored(balance(nodes, links, shards).select("node", "shard"), "shards")
    placed = found.select(F.col("node").alias("__node"), F.col("shard").alias("__shard"))
    marked = docs.select(*names, node.alias("__node"))
    out = [F.col(c) for c in names] + [F.col("__shard").alias("shard")]
    if not pieces.limit(1).count():
        return marked.join(placed, "__node").select(*out)
    # Equal rows stand for each other: one of them comes for every copy of every piece.
    several = F.broadcast(pieces.select(F.col("row").alias("__node")).distinct())  # HEAVY * shards rows at most
    dealt = pieces.join(found, "node").select(
        F.col("row").alias("__node"), F.col("shard").alias("__shard"), F.explode(F.sequence(F.lit(1), "own")).alias("__n")
    )
    one = marked.join(several, "__node", "left_semi").dropDuplicates([*names, "__node"])
    copies = one.join(dealt, "__node").select(*out)
    return marked.join(several, "__node", "left_anti").join(placed, "__node").select(*out).unionByName(copies)


def with_slots(rows: DataFrame, order: list[Column]) -> DataFrame:
    """A column ``slot``: rows of a shard are numbered from 0 without gaps.

    Numbers are given per shard and hash bucket and moved up by the counts of the
    buckets before, so a shard is never one task.
    """
    bucket = F.pmod(F.xxhash64(*order), F.lit(SLOT_BUCKETS)).cast("int")
    rows = rows.withColumn("__b", bucket)
    counts = rows.groupBy("shard", "__b").agg(F.count("*").alias("n"))
    before = W.partitionBy("shard").orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    base = counts.select(
        F.col("shard").alias("__s"), F.col("__b").alias("__c"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__base"),
    )
    own = W.partitionBy("shard", "__b").orderBy(*order)
    return (
        rows.join(base, (F.col("shard") == F.col("__s")) & (F.col("__b") == F.col("__c")))
        .withColumn("slot", (F.col("__base") + F.row_number().over(own) - 1).cast("long"))
        .drop("__b", "__s", "__c", "__base")
    )


def op6_sharding(spark, sf):
    text = F.col("text")
    # Taken before the shard is joined on, so that the join does not carry texts.
    docs = table(spark, sf, "documents").select(
        "doc_id",
        "text",
        text_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    rows = shard_documents(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard")
    numbered = with_slots(rows, [F.col("doc_id"), F.col("text_crc32"), F.col("size")])
    return numbered.withColumn("grown_shard", F.lit(None).cast("int"))
