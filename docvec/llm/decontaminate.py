"""Benchmark decontamination by spaced seeds, in DataFrame operations alone.

Tokens are lower-case runs of letters and digits. Two fixed masks pick six tokens each
and ignore those between, so a replaced token does not break every hash around it: any
thirteen aligned tokens of which at most two differ hold a place where a mask sees equal
tokens only (a test tries all patterns). Hashes of both masks at every place of every
document are joined with those of the benchmark. Around each hit the aligned tokens are
compared: an item is in a document when thirteen aligned tokens agree in eleven.

Shorter items are compared whole: ten to twelve tokens may differ in one, fewer in none.
Items of four to six tokens are found by one hash of the whole sequence. One to three tokens
occur in any text by chance: such an item is in a document that consists of it alone. Items
without a token are in none. Scripts that are written without blanks (Chinese, Japanese,
Thai, Lao, Khmer, Burmese) are split into characters.

The benchmark side of the join is broadcast in blocks of a bounded number of seeds, one
pass each; document tokens never leave their task, and only verified hits are shuffled.

Null and empty texts match nothing. Repeated rows count as one; benchmark rows with equal
texts are each reported. A null id is kept as null. No rows on either side give no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docvec.llm.common import stored, table

# Places of the tokens that a mask sees.
MASKS = ((0, 1, 2, 4, 5, 6), (0, 1, 3, 6, 8, 10))
WINDOW = 13
NEEDED = 11
SHORTEST = 7  # tokens that the masks are for
ALONE = 3  # items of up to so many tokens have to be the whole document
BLOCK_SEEDS = 100_000  # seeds in one broadcast, about 30 MB

TOKEN_GAP = r"[^\p{L}\p{N}]+"
SCRIPTS = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")


def token_hashes(text: Column) -> Column:
    lowered = F.lower(F.coalesce(text, F.lit("")))
    unspaced = f"([{''.join(rf'\p{{Is{s}}}' for s in SCRIPTS)}])"
    # Texts without such a script, told by a plain search, are split as they are.
    apart = F.when(F.rlike(lowered, F.lit(unspaced)), F.regexp_replace(lowered, unspaced, " $1 ")).otherwise(lowered)
    tokens = F.filter(F.split(apart, TOKEN_GAP), lambda t: t != "")
    return F.transform(tokens, lambda t: F.xxhash64(t))


def needed(size: Column) -> Column:
    """Tokens that have to agree in a window of the size."""
    return (
        F.when(size >= WINDOW, NEEDED).when(size >= 10, size - 1).otherwise(size).cast("int")
    )


def _places(rows: DataFrame, tokens: str, short: list[int]) -> DataFrame:
    """Rows by place and mask, with the hash of the tokens that the mask sees there.

    After the spaced masks come the whole sequences of ``short`` lengths, those up to
    ``ALONE`` only where the row has no other tokens.
    """
    masks = [*MASKS, *(tuple(range(size)) for size in short)]
    n = len(masks)
    # No filter on the tokens here: it would move below and split the text twice.
    at = F.sequence(F.lit(0), F.greatest(n * F.size(tokens) - 1, F.lit(0)))
    out = rows.select("*", F.explode(at).alias("__p"))
    mask, place = F.col("__p") % n, F.expr(f"cast(__p div {n} as int)")
    key, fits = F.lit(None).cast("long"), F.lit(False)
    for m, mask_places in enumerate(masks):
        size = len(mask_places)
        label = m if m < len(MASKS) else 100 + size
        seen = F.xxhash64(F.lit(label), *[F.get(tokens, place + o) for o in mask_places])
        key = F.when(mask == m, seen).otherwise(key)
        whole = F.size(tokens) == size if m >= len(MASKS) and size <= ALONE else F.lit(True)
        fits = fits | ((mask == m) & whole & (place + mask_places[-1] < F.size(tokens)))
    return out.filter(fits).select(*rows.columns, place.alias("place"), mask.alias("mask"), key.alias("key"))


def short_lengths(benchmark: DataFrame, text_col: str = "text") -> list[int]:
    """Which lengths below the masks' the items have: at most ``SHORTEST - 1`` numbers."""
    size = F.size(token_hashes(F.col(text_col))).alias("n")
    return sorted(r.n for r in benchmark.select(size).distinct().filter(f"n between 1 and {SHORTEST - 1}").collect())


def seeds(
    benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", short: list[int] | None = None
) -> DataFrame:
    """(key, block, item, around, left, window): the item's tokens around each seed, of
    which ``left`` come before it, and the size of the window to agree in."""
    short = short_lengths(benchmark, text_col) if short is None else short
    rows = benchmark.select(F.col(id_col).alias("item"), token_hashes(F.col(text_col)).alias("t"))
    own = (F.size("t") >= SHORTEST) & (F.col("mask") < len(MASKS))
    for i, size in enumerate(short):
        own = own | ((F.size("t") == size) & (F.col("mask") == len(MASKS) + i))
    found = _places(rows, "t", short).filter(own)
    reach = WINDOW - 1
    left = F.least("place", F.lit(reach))
    size = F.least(F.size("t") - F.col("place") + left, left + WINDOW)
    return found.select(
        "key",
        "item",
        F.slice("t", F.col("place") - left + 1, size).alias("around"),
        left.alias("left"),
        F.least(F.size("t"), F.lit(WINDOW)).alias("window"),
    ).distinct()


def _around_hit(names: list[str]) -> list[Column]:
    """The aligned tokens around a hit: of the document, of the item, and the window."""
    before = F.least("left", "place")
    after = F.least(F.size("around") - F.col("left"), F.size("t") - F.col("place"))
    return [
        *[F.col(n) for n in names],
        "item",
        F.slice("t", F.col("place") - before + 1, before + after).alias("mine"),
        F.slice("around", F.col("left") - before + 1, before + after).alias("theirs"),
        "window",
    ]


def _agrees() -> Column:
    """Whether some window over the aligned tokens agrees enough."""
    equal = F.zip_with("mine", "theirs", lambda a, b: F.when(a == b, 1).otherwise(0))
    last = F.size("mine") - F.col("window") + 1
    return (last >= 1) & F.exists(
        F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
        lambda k: F.aggregate(F.slice(equal, k, F.col("window")), F.lit(0), lambda s, x: s + x)
        >= needed(F.col("window")),
    )


def _verified(hits: DataFrame, names: list[str]) -> DataFrame:
    """Hits that agree. A plain filter would move into the join, whose code is then no
    longer generated, and every place would be copied out with all of its document's
    tokens; what an outer explode makes cannot move."""
    hit = F.explode_outer(F.when(_agrees(), F.array(F.struct("item"))))
    return hits.select(*names, hit.alias("hit")).filter("hit is not null").select(*names, "hit.item")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, keys: list[Column], id_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """(k0, k1, ..., item): which benchmark items are in which rows, told by ``keys``."""
    names = [f"k{i}" for i in range(len(keys))]
    rows = docs.select(*[k.alias(n) for k, n in zip(keys, names)], token_hashes(F.col("text")).alias("t"))
    short = short_lengths(benchmark, text_col)
    found = stored(seeds(benchmark, id_col, text_col, short), "seeds")
    blocks = max(1, -(-found.count() // BLOCK_SEEDS))
    block = F.pmod(F.xxhash64("key", "item", "left", "around"), F.lit(blocks))
    places = _places(rows, "t", short)
    hits = [
        _verified(
            places.join(F.broadcast(found.filter(block == i)), "key").select(*_around_hit(names)), names
        )
        for i in range(blocks)
    ]
    return reduce(DataFrame.union, hits).distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    keys = [F.coalesce(F.col("doc_id"), F.lit(0)), F.xxhash64("text")]
    found = contaminated(docs, benchmark, keys).select("k0", "k1").distinct()
    bad = stored(found.toDF("__bad_id", "__bad_text"), "contaminated")
    on = (keys[0] == F.col("__bad_id")) & (keys[1] == F.col("__bad_text"))
    return docs.join(bad, on, "left_anti")


def op3_decontamination(spark, sf):
    """Pairs (doc_id, item_id): the benchmark item is in the document."""
    docs, items = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    found = contaminated(docs, items, [F.col("doc_id")])
    return found.select(F.col("k0").alias("doc_id"), F.col("item").alias("item_id"))


def _tokens_sql(name: str, key: str) -> str:
    unspaced = "".join(rf"\p{{{s}}}" for s in SCRIPTS)
    apart = f"regexp_replace(lower(text), '([{unspaced}])', ' \\1 ', 'g')"
    return f"""
      SELECT {key}, unnest(t) AS w, generate_subscripts(t, 1) - 1 AS p, len(t) AS n FROM (
        SELECT {key}, list_filter(regexp_split_to_array({apart}, '{TOKEN_GAP}'), lambda x: x <> '') AS t
        FROM {name} WHERE text IS NOT NULL)"""


OP3_SQL = f"""
WITH d AS ({_tokens_sql("documents", "doc_id")}),
b AS ({_tokens_sql("benchmark", "item_id")}),
e AS (
  SELECT doc_id, item_id, d.p AS dp, b.p AS bp, d.p - b.p AS diagonal, d.n AS dn, b.n AS bn
  FROM d JOIN b ON d.w = b.w WHERE b.n > {ALONE} OR b.n = d.n
),
c AS (
  SELECT *,
    {", ".join(f"count(*) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY dp RANGE BETWEEN CURRENT ROW AND {WINDOW - 1 - k} FOLLOWING) AS c{k}" for k in range(WINDOW - NEEDED + 1))}
  FROM e WHERE bn >= {WINDOW}
),
long AS (
  SELECT DISTINCT doc_id, item_id FROM c
  WHERE {" OR ".join(f"(c{k} >= {NEEDED} AND dp >= {k} AND bp >= {k} AND dp - {k} + {WINDOW} <= dn AND bp - {k} + {WINDOW} <= bn)" for k in range(WINDOW - NEEDED + 1))}
),
short AS (
  SELECT DISTINCT doc_id, item_id FROM (
    SELECT doc_id, item_id, diagonal, count(*) AS n, any_value(dn) AS dn, any_value(bn) AS bn
    FROM e WHERE bn < {WINDOW} GROUP BY ALL)
  WHERE diagonal >= 0 AND diagonal + bn <= dn AND n >= CASE WHEN bn >= 10 THEN bn - 1 ELSE bn END
)
SELECT doc_id, item_id FROM long UNION SELECT doc_id, item_id FROM short
"""
