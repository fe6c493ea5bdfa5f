"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target in words; a document of it is wanted ``target / size of the
source`` times. The whole part of that is taken for certain. The words still missing come
from a sample of one more copy, in which documents have unequal chances: a document's
chance falls with the logarithm of its size, is one at most, and all chances of a source
together give the missing words. Documents are ranked by their random odds over the odds
of inclusion (Pareto order sampling), and the ranking is cut where the missing words are
reached, so the sample has a fixed size in words and not just an expected one.

A cut stops before the document that would pass it, which leaves a gap. One more document
is taken, a little above or below, that brings the words nearest to the target. Where that
is not near, further rounds first fill the gap in the same order from documents that fit in
it, and the round is chosen after which one more document comes nearest. Where a source
has many documents, hardly anything but the ranking decides who is in. Where it still does
not end near, as when nearly all of a small source is wanted and one long document is
left, a free document first in rank takes the place of a taken one.

No source is sorted as a whole. Words are summed per source and bucket of the rank
value, buckets are cumulated, and exact ranks are needed in the bucket that holds the
cut alone. The result of all rounds is one small row per source, and a document is
decided by its own row and that of its source: texts are never shuffled, and a source
with a third of all rows is spread over all tasks.

Null texts have no words. Rows without a source form a source of their own, the last.
A source without words has target zero. Wholly repeated rows share one rank and are
taken or left together. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docvec.llm.common import WORD, hash_unit, stored, table

WEIGHTS = (5, 2, 1)  # by source in code point order, repeating
SHARE = 1.5  # of all words
MOST = 2.0  # times the words of a source
ROUNDS = 4
OFFERED = 8  # free documents that may take the place of a taken one
NEAR = 0.002  # of a target: so near that no further round is tried
BUCKETS = 4096
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Weights share ``share`` of all words; a target stops at ``most`` times its source,
    and what is over goes to the others by weight until none is above. That level is
    found without iteration: with sources in order of room per weight, it is the largest
    of the levels at which everything before is full.
    """
    every = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.row_number().over(every) - 1) % len(weights) + 1).cast("int"),
    )
    ranked = sizes.select(
        "source", "source_size", weight.alias("w"), (F.lit(most) * F.col("source_size")).alias("room")
    ).withColumn("order", F.col("room") / F.col("w"))
    everyone = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = W.orderBy("order", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    total = F.lit(share) * F.sum("source_size").over(everyone)
    full = F.coalesce(F.sum("room").over(before), F.lit(0.0))
    rest = F.sum("w").over(everyone) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    level = F.max("level").over(everyone)
    return ranked.withColumn("level", (total - full) / rest).select(
        "source", "source_size", F.least("room", level * F.col("w")).alias("target")
    )


def size_class(size: Column) -> Column:
    """Binary digits of a size: documents of one class are at most twice as long as another."""
    return F.length(F.bin(size))


def _plan(rows: DataFrame, **kw) -> DataFrame:
    """Targets with whole copies, the words still missing, and the level of the chances.

    A document of class c has the chance ``least(1, level / c)``. The level at which all
    chances give the missing words is found like that of the targets: classes fill up in
    order, smallest first, and it is the largest of the levels at which those before are
    full. There are 63 classes at most.
    """
    sums = rows.groupBy("source", size_class(F.col("size")).alias("c")).agg(F.sum("size").alias("words"))
    sums = stored(sums, "mix_sizes")
    sizes = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = targets(sizes, **kw).withColumn("copies", F.floor(wanted)).withColumn(
        "gap_1", F.col("target") - F.col("copies") * F.col("source_size")
    )
    plan = stored(plan, "mix_targets")
    smaller = W.partitionBy("source").orderBy("c").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("source")
    spread = F.col("words") / F.col("c")
    rest = F.sum(spread).over(whole) - F.coalesce(F.sum(spread).over(smaller), F.lit(0.0))
    full = F.coalesce(F.sum("words").over(smaller), F.lit(0))
    classes = sums.filter("words > 0").select("source", full.alias("full"), rest.alias("rest"))
    gaps = plan.select(F.col("source").alias("s"), F.col("gap_1").alias("gap"))
    levels = (
        classes.join(gaps, F.col("source").eqNullSafe(F.col("s")))
        .groupBy("s")
        .agg(F.max((F.col("gap") - F.col("full")) / F.col("rest")).alias("level"))
    )
    joined = plan.join(levels, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    return joined.withColumn("level", F.coalesce("level", F.lit(0.0)))


def _rank() -> Column:
    """Random odds over inclusion odds; null where nothing more is wanted."""
    u, p = F.col("u"), F.least(F.lit(1.0), F.col("level") / size_class(F.col("size")))
    return F.when((p > 0) & (F.col("size") > 0), (u / (1 - u)) * ((1 - p) / p))


def _open(k: int) -> Column:
    """Whether a row can be taken in round k: it was not before, and it fits in the gap."""
    free = F.col("rank").isNotNull()
    for i in range(1, k):
        free = free & ~_taken(i)
    return free if k == 1 else free & (F.col("size") <= F.col(f"gap_{k}"))


def _taken(k: int) -> Column:
    small = F.lit(True) if k == 1 else F.col("size") <= F.col(f"gap_{k}")
    return F.coalesce(F.col("rank") <= F.col(f"cut_{k}"), F.lit(False)) & small


def _bucket() -> Column:
    """Buckets in the order of ranks, which go from zero up without end."""
    return F.floor(F.col("rank") / (1 + F.col("rank")) * BUCKETS)


def _cut(rows: DataFrame, plan: DataFrame, k: int) -> DataFrame:
    """The plan with the rank at which round k stops, and the gap that it leaves."""
    gap = F.col(f"gap_{k}")
    found = (
        _with_plan(rows, plan)
        .filter(_open(k))
        .select("source", "rank", "size", gap.alias("gap"), _bucket().alias("bucket"))
    )
    sums = found.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.first("gap").alias("gap"))
    running = W.partitionBy("source").orderBy("bucket")
    over = (
        sums.withColumn("after", F.sum("words").over(running))
        .filter(F.col("after") > F.col("gap"))
        .groupBy("source")
        .agg(F.min("bucket").alias("at"), F.min_by(F.col("after") - F.col("words"), "bucket").alias("base"))
    )
    # Where even all of it does not fill the gap, everything is taken.
    all_of = sums.groupBy("source").agg(F.sum("words").alias("all_words"))
    edge = all_of.join(over, all_of.source.eqNullSafe(over.source), "left").select(
        all_of.source.alias("s"), "all_words", "at", "base"
    )
    edge = stored(edge, "edges")
    near = (
        found.join(F.broadcast(edge) if edge.count() <= 10_000 else edge, F.col("source").eqNullSafe(F.col("s")))
        .filter(F.col("bucket") == F.col("at"))
        .groupBy("source", "rank")
        .agg(F.sum("size").alias("size"), F.first("gap").alias("gap"), F.first("base").alias("base"))
    )
    inside = W.partitionBy("source").orderBy("rank")
    last = (
        near.withColumn("after", F.col("base") + F.sum("size").over(inside))
        .filter(F.col("after") <= F.col("gap"))
        .groupBy("source")
        .agg(F.max("rank").alias("rank"), F.max("after").alias("taken"))
    )
    # The bucket's first document may be too large already: then the bucket before it
    # ends the round, and its rank limit is the lower end of this bucket.
    first = near.groupBy("source").agg(F.min("rank").alias("lowest"))
    ends = (
        edge.join(last, F.col("s").eqNullSafe(last.source), "left")
        .drop("source")
        .withColumnRenamed("rank", "last_rank")
        .join(first, F.col("s").eqNullSafe(first.source), "left")
        .drop("source")
    )
    below = F.when(F.col("lowest") > 0, F.col("lowest") * F.lit(1.0 - 1e-12)).otherwise(-1.0)
    cut = (
        F.when(F.col("at").isNull(), F.lit(float("inf")))
        .when(F.col("last_rank").isNotNull(), F.col("last_rank"))
        .otherwise(below)
    )
    taken = F.when(F.col("at").isNull(), F.col("all_words")).otherwise(
        F.coalesce(F.col("taken"), F.col("base"))
    )
    ends = ends.select("s", cut.alias(f"cut_{k}"), taken.alias("round_words"))
    joined = plan.join(ends, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    return stored(
        joined.withColumn(
            f"gap_{k + 1}", F.col(f"gap_{k}") - F.coalesce("round_words", F.lit(0))
        ).drop("round_words"),
        "mix_plan",
    )


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with their source's plan. The plan is broadcast while it is small, which the
    size of its stored table tells."""
    plan = plan.withColumnRenamed("source", "__of")
    on = rows.source.eqNullSafe(F.col("__of"))
    return rows.join(plan, on).drop("__of").withColumn("rank", _rank())


MIXED = ("mix_size", "mix_source_size", "mix_target", "mix_copies")


def _nearest(rows: DataFrame, plan: DataFrame, k: int) -> DataFrame:
    """The plan with ``last_k``, the rank of the document with which the words end nearest to
    the target after round k, null where they end nearer without one, and ``off_k``, how
    far off they are then. Ties go to the smaller rank."""
    gap = F.col(f"gap_{k + 1}")
    free = _with_plan(rows, plan).filter(F.col("rank").isNotNull())
    for i in range(1, k + 1):
        free = free.filter(~_taken(i))
    # Repeated rows share a rank, and are one document here.
    each = free.groupBy("source", "rank").agg(F.sum("size").alias("size"), F.first(gap).alias("gap"))
    off = F.abs(F.col("size") - F.col("gap"))
    best = (
        each.filter(off < F.col("gap"))
        .groupBy(F.col("source").alias("s"))
        .agg(F.min_by(F.struct(off.alias("off"), F.col("rank")), F.struct(off.alias("off"), F.col("rank"))).alias("b"))
    )
    joined = plan.join(best, F.col("source").eqNullSafe(F.col("s")), "left")
    joined = joined.withColumns({f"last_{k}": F.col("b.rank"), f"off_{k}": F.coalesce("b.off", gap)}).drop("s", "b")
    return stored(joined, "mix_plan")


def mix_plan(rows: DataFrame, **kw) -> DataFrame:
    """The plan of every source from rows (source, size, u). ``stop`` is the round it ends
    with: the first that is near enough, or else that which is nearest."""
    plan = stored(_plan(rows, **kw), "mix_plan")
    for k in range(1, ROUNDS + 1):
        plan = _nearest(rows, _cut(rows, plan, k), k)
    rounds = range(1, ROUNDS + 1)
    off = F.least(*[F.col(f"off_{k}") for k in rounds])
    nearest = F.coalesce(*[F.when(F.col(f"off_{k}") == off, k) for k in rounds])
    enough = F.coalesce(*[F.when(F.col(f"off_{k}") <= NEAR * F.col("target"), k) for k in rounds])
    plan = plan.withColumn("stop", F.coalesce(enough, nearest))
    last = F.coalesce(*[F.when(F.col("stop") == k, F.col(f"last_{k}")) for k in rounds])
    plan = stored(plan.withColumns({"last": last, "off": off}), "mix_plan")
    return _exchanged(rows, plan)


def _exchanged(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan with ``swap_in`` and ``swap_out``: where a source does not end near its target,
    one of the ``OFFERED`` free documents first in rank takes the place of a taken one, if
    that brings the words nearer. Each of the few is compared with the taken ones alone."""
    needy = plan.filter(F.col("off") > NEAR * F.col("target"))
    each = (
        _with_plan(rows, needy)
        .filter(F.col("rank").isNotNull())
        .groupBy("source", "rank")
        .agg(F.sum("size").alias("size"), F.first(_chosen()).alias("e"), F.first("gap_1").alias("gap"))
    )
    each = stored(each, "mix_needy")
    left = each.groupBy(F.col("source").alias("s")).agg((F.first("gap") - F.sum(F.col("size") * F.col("e"))).alias("left"))
    nth = F.row_number().over(W.partitionBy("source").orderBy("rank"))
    offered = each.filter("e = 0").withColumn("nth", nth).filter(F.col("nth") <= OFFERED)
    offered = offered.select(F.col("source").alias("f"), F.col("rank").alias("rank_in"), F.col("size").alias("size_in"))
    taken = each.filter("e = 1").select("source", F.col("rank").alias("rank_out"), F.col("size").alias("size_out"))
    off = F.abs(F.col("left") - F.col("size_in") + F.col("size_out"))
    choice = F.struct(off.alias("off"), "rank_in", "rank_out")
    best = (
        taken.join(offered, F.col("source").eqNullSafe(F.col("f")))
        .join(left, F.col("source").eqNullSafe(F.col("s")))
        .filter(off < F.abs("left"))
        .groupBy(F.col("source").alias("of"))
        .agg(F.min(choice).alias("swap"))
    )
    joined = plan.join(best, F.col("source").eqNullSafe(F.col("of")), "left")
    joined = joined.withColumns({"swap_in": F.col("swap.rank_in"), "swap_out": F.col("swap.rank_out")})
    return stored(joined.drop("of", "swap"), "mix_plan")


def _chosen() -> Column:
    """Whether the rounds and the last document have a row: 0 or 1."""
    taken = F.coalesce(F.col("rank") == F.col("last"), F.lit(False))
    for k in range(1, ROUNDS + 1):
        taken = taken | ((F.col("stop") >= k) & _taken(k))
    return F.when(taken, 1).otherwise(0)


def _extra() -> Column:
    return F.when(F.col("rank") == F.col("swap_in"), 1).when(F.col("rank") == F.col("swap_out"), 0).otherwise(_chosen())


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    seed: str = SEED, **kw,
) -> DataFrame:
    """``docs`` with ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_copies``
    (how often the mix takes the row: 0, 1 or 2). Columns of these names are replaced."""
    size = word_count(F.col(text_col))
    u = hash_unit(F.lit(seed), F.col(id_col), F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    rows = docs.select(F.col(source_col).alias("source"), size.alias("size"), u.alias("u"))
    plan = mix_plan(stored(rows, "mix_rows"), **kw)
    inner = docs.select(
        F.struct(*docs.columns).alias("__row"), F.col(source_col).alias("source"), size.alias("size"), u.alias("u")
    )
    return _with_plan(inner, plan).select(
        *[F.col("__row")[c].alias(c) for c in docs.columns if c not in MIXED],
        F.col("size").alias("mix_size"),
        F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"),
        (F.col("copies") + _extra()).cast("int").alias("mix_copies"),
    )


def take(docs: DataFrame, **kw) -> DataFrame:
    """The mix itself: rows of ``docs``, as often as the mix takes them."""
    n = F.col("mix_copies")
    inner = docs.select(F.struct(*docs.columns).alias("__docs"), *[F.col(c) for c in ("doc_id", "text", "source")])
    return (
        mix(inner, **kw)
        .filter(n > 0)
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), n)))
        .select("__docs.*")
    )


def op4_mixing(spark, sf):
    found = mix(table(spark, sf, "documents"))
    size = F.col("mix_size")
    return found.select(
        "doc_id",
        size.alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (size * F.col("mix_copies")).alias("taken"),
    )


def _round_sql(k: int) -> str:
    """Round k over the plain ranking: a running sum per source, stopped before the gap."""
    small = "" if k == 1 else "AND size <= gap"
    return f"""
    o{k} AS (SELECT *, rank IS NOT NULL AND turn IS NULL {small} AS free FROM r{k - 1}),
    c{k} AS (
      SELECT *, CASE WHEN free THEN sum(size) OVER (
        PARTITION BY source, free ORDER BY rank RANGE UNBOUNDED PRECEDING) END AS after FROM o{k}
    ),
    r{k} AS (
      SELECT doc_id, source, size, source_size, target, copies, rank,
        CASE WHEN free AND after <= gap THEN {k} ELSE turn END AS turn,
        gap - coalesce(sum(CASE WHEN free AND after <= gap THEN size END) OVER (PARTITION BY source), 0) AS gap
      FROM c{k}
    ),
    e{k} AS (SELECT source, rank, sum(size) AS size, any_value(gap) AS gap FROM r{k}
      WHERE rank IS NOT NULL AND turn IS NULL GROUP BY source, rank),
    n{k} AS (
      SELECT source, rank AS last, abs(size - gap) AS off FROM e{k} WHERE abs(size - gap) < gap
      QUALIFY row_number() OVER (PARTITION BY source ORDER BY abs(size - gap), rank) = 1
    ),
    a{k} AS (
      SELECT g.source AS source, {k} AS k, n.last AS last, coalesce(n.off, g.gap) AS off, target
      FROM (SELECT source, any_value(gap) AS gap, any_value(target) AS target FROM r{k} GROUP BY source) g
      LEFT JOIN n{k} n ON g.source IS NOT DISTINCT FROM n.source
    )"""


OP4_SQL = f"""
WITH d AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    (('0x' || substr(md5(concat_ws('|', '{SEED}', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))), 1, 13))
      ::UBIGINT::DOUBLE + 0.5) / {2**52}.0::DOUBLE AS u
  FROM documents
),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, ([5.0, 2.0, 1.0]::DOUBLE[])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w,
    2.0::DOUBLE * source_size AS room
  FROM s
),
l AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(room) OVER b, 0.0))
      / ((sum(w) OVER ()) - coalesce(sum(w) OVER b, 0.0)) AS level
  FROM w
  WINDOW b AS (ORDER BY room / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
t AS (SELECT source, source_size, least(room, (max(level) OVER ()) * w) AS target FROM l),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0.0 END AS copies,
    target - copies * source_size AS gap
  FROM t
),
z AS (
  SELECT source, length(bin(size)) AS c, sum(size)::DOUBLE AS words FROM d GROUP BY ALL HAVING sum(size) > 0
),
y AS (
  SELECT source, c, coalesce(sum(words) OVER b, 0.0) AS filled,
    sum(words / c) OVER (PARTITION BY source) - coalesce(sum(words / c) OVER b, 0.0) AS rest
  FROM z WINDOW b AS (PARTITION BY source ORDER BY c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
v AS (
  SELECT p.source AS source, max((gap - filled) / rest) AS level
  FROM y JOIN p ON y.source IS NOT DISTINCT FROM p.source GROUP BY p.source
),
q AS (
  SELECT doc_id, d.source AS source, size, u, source_size, target, copies, gap,
    least(1.0::DOUBLE, level / length(bin(size))) AS chance
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN v ON d.source IS NOT DISTINCT FROM v.source
),
r0 AS (
  SELECT *, CASE WHEN chance > 0 AND size > 0 THEN (u / (1 - u)) * ((1 - chance) / chance) END AS rank, NULL::INT AS turn FROM q
),{",".join(_round_sql(k) for k in range(1, ROUNDS + 1))},
a AS ({" UNION ALL ".join(f"SELECT * FROM a{k}" for k in range(1, ROUNDS + 1))}),
n AS (
  SELECT source, k AS stop, last, min(off) OVER (PARTITION BY source) > {NEAR} * target AS needy FROM a
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY
    CASE WHEN off <= {NEAR} * target THEN 0 ELSE 1 END, CASE WHEN off <= {NEAR} * target THEN k ELSE off END, k) = 1
),
g AS (
  SELECT r.*, needy,
    CASE WHEN coalesce(rank = last, false) OR coalesce(turn <= stop, false) THEN 1 ELSE 0 END AS e
  FROM r{ROUNDS} r LEFT JOIN n ON r.source IS NOT DISTINCT FROM n.source
),
h AS (
  SELECT source, rank, sum(size) AS size, any_value(e) AS e, any_value(target - copies * source_size) AS gap
  FROM g WHERE needy AND rank IS NOT NULL GROUP BY source, rank
),
j AS (SELECT source, any_value(gap) - sum(size * e) AS missing FROM h GROUP BY source),
i AS (SELECT * FROM h WHERE e = 0 QUALIFY row_number() OVER (PARTITION BY source ORDER BY rank) <= {OFFERED}),
x AS (
  SELECT h.source AS source, i.rank AS swap_in, h.rank AS swap_out
  FROM h JOIN i ON h.source IS NOT DISTINCT FROM i.source JOIN j ON h.source IS NOT DISTINCT FROM j.source
  WHERE h.e = 1 AND abs(missing - i.size + h.size) < abs(missing)
  QUALIFY row_number() OVER (PARTITION BY h.source ORDER BY abs(missing - i.size + h.size), i.rank, h.rank) = 1
)
SELECT doc_id, size, source_size, target,
  (size * (copies + CASE WHEN rank = swap_in THEN 1 WHEN rank = swap_out THEN 0 ELSE e END))::BIGINT AS taken
FROM g LEFT JOIN x ON g.source IS NOT DISTINCT FROM x.source
"""
