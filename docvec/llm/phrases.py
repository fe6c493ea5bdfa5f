"""Collocations: phrases counted by multikey quicksort of suffix pointers, routed by their leading words.

Every word of a text begins a suffix, which ends with its piece. Suffixes are counted to a
depth of one word, then two, then three, each in the same two steps:

1. *Near the text.* A task takes a bounded number of words at a time, numbers them, and
   adds up equal suffixes, so that a phrase is sent once from each block however often it
   is there. Suffixes of which a shorter phrase is already known to be infrequent are
   abandoned before that: a bitmap of fixed size holds the frequent phrases of one word
   less. It may let others pass, which the next step drops; it never stops a frequent one.
2. *Routed.* A hash of the leading words, down to the depth reached, deals suffixes to
   buckets. Within a bucket pointers to the suffixes are sorted by a three-way quicksort on
   one word after the other: the part equal to the pivot goes on with the next word, and at
   the last one its weight is the phrase's count. Parts whose weight is below the least
   count are abandoned, for no phrase in them can reach it.

A phrase that a third of all words belong to is one entry of a block, and one bucket gets
at most one entry of it from each block; there is no hot group to split. Buckets hold a
bounded number of words and are read one after another, so a task may have several.

Texts are split at the marks of a sentence and at line ends into pieces, pieces at blanks
into words; A-Z become lower case. Everything is counted by language; rows without one
belong to ``und``. Null and empty texts have no words; repeated rows count each; an empty
table gives no rows. Very long texts are cut at blocks with the words that follow at hand,
so nothing is lost at a cut. Other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docvec.llm.common import stored, table

# What splits pieces and words, and the rules of the report.
PIECE = r"[.,;:!?\x0A-\x0D]"
WORD = r"[^\x20\x09]+"
LEAST, LONGEST, COVERED, TOP = 10, 3, 50, 2000
UNKNOWN = "und"

BLOCK_WORDS = 700_000
SMALL = 256  # suffixes of a part that is not sorted further
STRETCH_BYTES = 4_000_000  # of a text, split at a time
BUCKET_BYTES = 16_000_000  # of text, for each bucket
PARTS = 32
BITS = 1 << 23  # of the bitmap of frequent phrases
_BREAK = b"."
_MARKS = bytes(
    0x2E if c in b".,;:!?\x0a\x0b\x0c\x0d" else c + 32 if 65 <= c <= 90 else c for c in range(256)
)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def tokens_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, with ``_BREAK`` between pieces, a stretch at a time."""
    first = 0
    while first < len(text):
        last = len(text)
        if last - first > STRETCH_BYTES:
            last = max(text.rfind(b" ", first, first + STRETCH_BYTES), text.rfind(b"\n", first, first + STRETCH_BYTES)) + 1
            if last <= first:  # one word longer than a stretch
                last = text.find(b" ", first + STRETCH_BYTES) + 1 or len(text)
        # No other blank than these two is left by then, so a plain split will do.
        yield text[first:last].translate(_MARKS).replace(_BREAK, b" . ").split()
        first = last


def word_key(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, seed=xxhash.xxh32_intdigest(lang))


def phrase_keys(keys: list[np.ndarray]) -> np.ndarray:
    """One number a phrase from the numbers of its words in order."""
    out = keys[0].copy()
    for key in keys[1:]:
        out ^= out >> np.uint64(31)
        out = out * _MIX + key
    out ^= out >> np.uint64(29)
    return out


def quicksort(words: list[np.ndarray], weight: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """(a pointer, weight) of each group of equal suffixes that weighs ``least`` or more.

    ``words[d][p]`` is word ``d`` of suffix ``p``. Parts are kept on a stack, not sorted
    into place: only their sizes are asked for. Small parts are counted as they are.
    """
    depth = len(words)
    todo = [(np.arange(len(weight)), 0)] if len(weight) else []
    while todo:
        part, at = todo.pop()
        if at == depth:
            yield int(part[0]), int(weight[part].sum())
            continue
        if len(part) <= SMALL:
            sums: dict[tuple, int] = {}
            rest = list(zip(*(words[d][part].tolist() for d in range(at, depth))))
            for suffix, n in zip(rest, weight[part].tolist()):
                sums[suffix] = sums.get(suffix, 0) + n
            for suffix, n in sums.items():
                if n >= least:
                    yield int(part[rest.index(suffix)]), n
            continue
        of = words[at][part]
        pivot = of[len(of) >> 1]
        for side, goes_to in ((of < pivot, at), (of == pivot, at + 1), (of > pivot, at)):
            some = part[side]
            if len(some) and (len(some) >= least or weight[some].sum() >= least):
                todo.append((some, goes_to))


# The words of a row's suffixes one after the other, and how often each suffix comes.
SUFFIXES = "bucket int, lang string, words binary, times binary"
_SUFFIXES = pa.schema([("bucket", pa.int32()), ("lang", pa.string()), ("words", pa.binary()), ("times", pa.binary())])


class Block:
    """Tokens of one language, numbered, up to a bounded number of words."""

    def __init__(self, lang: str):
        self.lang = lang
        self.numbers: dict[bytes, int] = defaultdict(count(1).__next__)
        self.numbers[_BREAK] = 0
        self.parts: list[tuple[np.ndarray, int]] = []
        self.size = 0

    def add(self, tokens: list[bytes], new: int) -> None:
        """The first ``new`` tokens begin suffixes here; those behind only end them."""
        self.parts.append((np.fromiter(map(self.numbers.__getitem__, tokens), np.int64, len(tokens)), new))
        self.size += new

    def rows(self, depth: int, passed: np.ndarray | None, buckets: int) -> Iterator[tuple]:
        """Counted suffixes of the block, one row for each bucket they go to."""
        at = np.concatenate([*(part for part, _ in self.parts), np.zeros(depth, np.int64)])
        begins = np.concatenate([np.arange(len(part)) < new for part, new in self.parts])
        n = len(begins)
        words = list(self.numbers)
        words[0] = b""
        keys = np.fromiter((word_key(self.lang, w) for w in words), np.uint64, len(words))
        whole = begins & (at[:n] != 0)
        for d in range(1, depth):
            whole &= at[d : n + d] != 0
        first = np.flatnonzero(whole)
        if passed is not None:  # both shorter phrases of the suffix
            shorter = depth - 1
            for begin in (0, 1):
                known = phrase_keys([keys[at[first + begin + d]] for d in range(shorter)]) % np.uint64(BITS)
                first = first[(passed[known >> np.uint64(3)] >> (known & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        # Equal suffixes are added up: their word numbers make one number a suffix.
        base = len(words)
        packed = at[first]
        for d in range(1, depth):
            packed = packed * base + at[first + d]
        if depth == 1:
            times = np.bincount(packed, minlength=base)
            packed = np.flatnonzero(times)
            times = times[packed]
        else:
            packed, times = np.unique(packed, return_counts=True)
        columns = []
        for _ in range(depth):
            packed, last = np.divmod(packed, base)
            columns.insert(0, last)
        bucket = (phrase_keys([keys[c] for c in columns]) >> np.uint64(20)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[order].astype(np.int64), prepend=-1))
        for picked in np.split(order, edges[1:]) if len(order) else []:
            in_turn = np.stack([c[picked] for c in columns], axis=1).ravel().tolist()
            yield (
                int(bucket[picked[0]]),
                self.lang,
                b" ".join([words[i] for i in in_turn]),
                times[picked].astype(np.int32).tobytes(),
            )


def _local(depth: int, bitmap: bytes | None, buckets: int, block_words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed = None if bitmap is None else np.frombuffer(bitmap, np.uint8)
        blocks: dict[str, Block] = {}

        def full(some: list[str]) -> Iterator[pa.RecordBatch]:
            for lang in some:
                rows = list(zip(*blocks.pop(lang).rows(depth, passed, buckets)))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(rows, _SUFFIXES)], schema=_SUFFIXES
                    )

        for batch in batches:
            for lang, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens: list[bytes] = []
                for stretch in tokens_of(value.as_py()):
                    tokens += stretch
                    while len(tokens) >= (room := block_words - (blocks[lang].size if lang in blocks else 0)) + depth:
                        blocks.setdefault(lang, Block(lang)).add(tokens[: room + depth - 1], room)
                        tokens = tokens[room:]
                        yield from full([lang])
                tokens.append(_BREAK)
                blocks.setdefault(lang, Block(lang)).add(tokens, len(tokens))
                if len(blocks) > 1 and sum(b.size for b in blocks.values()) >= 2 * block_words:
                    yield from full([max(blocks, key=lambda of: blocks[of].size)])
        yield from full(list(blocks))

    return run


COUNTED = "lang string, phrase string, n long, key long"
_COUNTED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64()), ("key", pa.int64())])


class Bucket:
    """The suffixes of one bucket and language, from all blocks."""

    def __init__(self, lang: str):
        self.lang = lang
        self.numbers: dict[bytes, int] = defaultdict(count().__next__)
        self.words: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []

    def add(self, words: bytes, times: bytes) -> None:
        self.words.append(np.fromiter(map(self.numbers.__getitem__, words.split(b" ")), np.int32))
        self.weights.append(np.frombuffer(times, np.int32))

    def counted(self, depth: int, least: int) -> pa.RecordBatch:
        """The frequent phrases, and a row without a phrase that has the weight of all."""
        every = np.concatenate(self.words).reshape(-1, depth)
        columns = [np.ascontiguousarray(every[:, d]) for d in range(depth)]
        weight = np.concatenate(self.weights).astype(np.int64)
        groups = list(quicksort(columns, weight, least))
        words = list(self.numbers)
        chosen = [[words[c[p]] for c in columns] for p, _ in groups]
        keys = phrase_keys(
            [np.array([word_key(self.lang, of[d]) for of in chosen], np.uint64) for d in range(depth)]
        )
        arrays = [
            pa.array([self.lang] * (len(groups) + 1), pa.string()),
            pa.array([None, *(b" ".join(of).decode() for of in chosen)], pa.string()),
            pa.array([int(weight.sum()), *(n for _, n in groups)], pa.int64()),
            pa.array(np.r_[0, keys.view(np.int64)], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=_COUNTED)


def _routed(depth: int, least: int) -> Callable:
    """Rows come by bucket and language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        for batch in batches:
            for place, lang, words, times in zip(*batch.columns):
                place, lang = place.as_py(), lang.as_py()
                if (place, lang) != now:
                    if held is not None:
                        yield held.counted(depth, least)
                    now, held = (place, lang), Bucket(lang)
                held.add(words.as_py(), times.as_py())
        if held is not None:
            yield held.counted(depth, least)

    return run


def _bitmap(counted: DataFrame) -> bytes:
    """The keys of all frequent phrases, a bit for each: ``BITS`` bits, however many they are."""
    bit = F.pmod(F.col("key"), F.lit(BITS))
    of = counted.select(F.shiftright(bit, 15).alias("part"), (bit % 32768).alias("place"))
    out = np.zeros(BITS // 8, np.uint8)
    for part, bits in of.groupBy("part").agg(F.bitmap_construct_agg("place")).collect():
        out[part * 4096 : part * 4096 + 4096] = np.frombuffer(bits, np.uint8)
    return out.tobytes()


def phrases(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    longest: int = LONGEST,
    least: int = LEAST,
    block_words: int = BLOCK_WORDS,
    bucket_bytes: int = BUCKET_BYTES,
) -> tuple[DataFrame, list[DataFrame]]:
    """Words of each language (lang, n), and for each depth the frequent phrases
    (lang, phrase, n), stored."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("binary")
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit(UNKNOWN)), text).filter(F.length(text) > 0)
    total = rows.agg(F.sum(F.length(text))).first()[0] or 0
    buckets = max(-(-total // bucket_bytes), 1)
    tasks = min(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")) * 4)
    totals, levels, bitmap = None, [], None
    for depth in range(1, longest + 1):
        sent = rows.mapInArrow(_local(depth, bitmap, buckets, block_words), SUFFIXES)
        dealt = sent.repartitionById(tasks, F.pmod("bucket", F.lit(tasks)))
        in_order = dealt.sortWithinPartitions("bucket", "lang")
        found = stored(in_order.mapInArrow(_routed(depth, least), COUNTED), "phrases")
        counted = found.filter("phrase is not null")
        if totals is None:
            totals = found.filter("phrase is null").groupBy("lang").agg(F.sum("n").alias("n"))
        levels.append(counted.select("lang", "phrase", "n"))
        bitmap = _bitmap(counted) if depth < longest else None
    return totals, levels


def _exact(value: Column) -> Column:
    return value.cast("decimal(18,0)")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of two and three words of
    each language. ``phrases`` gives all counts."""
    totals, (one, two, three) = phrases(docs, lang_col, text_col)
    parts = F.split("phrase", " ")

    def cut(of: DataFrame, k: int) -> DataFrame:
        """l, r and score of a cut after ``k`` words; both parts are frequent, as the whole is."""
        words = F.size("words")
        sides = of.select(
            "lang", "phrase", "a", F.lit(k).alias("k"),
            F.array_join(F.slice("words", F.lit(1), F.lit(k)), " ").alias("head"),
            F.array_join(F.slice("words", F.lit(k + 1), words - k), " ").alias("tail"),
        )
        heads = (one, two)[k - 1].select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
        return sides.join(heads, ["lang", "head"])

    def with_tail(of: DataFrame, tails: DataFrame) -> DataFrame:
        found = of.join(tails.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r")), ["lang", "tail"])
        squared = F.lit(1_000_000).cast("decimal(7,0)") * (_exact(F.col("a")) * _exact(F.col("a")))
        score = F.expr("squared div product").cast("long")
        product = _exact(F.col("l")) * _exact(F.col("r"))
        return found.withColumns({"squared": squared, "product": product}).select(
            "lang", "phrase", "a", "k", "l", "r", score.alias("score")
        )

    pairs = two.select("lang", "phrase", F.col("n").alias("a"), parts.alias("words"))
    triples = three.select("lang", "phrase", F.col("n").alias("a"), parts.alias("words"))
    # A pair goes when a triple that holds it is at least as frequent as the share says.
    inside = triples.select(
        "lang",
        F.explode(F.array(*[F.array_join(F.slice("words", i, 2), " ") for i in (1, 2)])).alias("phrase"),
        F.col("a").alias("longer"),
    )
    covering = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    alone = pairs.join(covering, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < COVERED * F.col("a"))
    )
    scored = (
        with_tail(cut(alone.drop("longer"), 1), one)
        .unionByName(with_tail(cut(triples, 1), two))
        .unionByName(with_tail(cut(triples, 2), one))
    )
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    best = scored.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # In two steps, so that one task ranks no more than what is best in the parts.
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    within = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    some = best.withColumn("part", part).withColumn("rank", within).filter(F.col("rank") <= top).drop("part", "rank")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = some.withColumn("rank", place).filter(F.col("rank") <= top)
    return ranked.join(F.broadcast(totals), "lang").select(  # a row for each language
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def op11_phrases(spark, sf):
    return collocations(table(spark, sf, "documents").select("lang", "text"))


def _grams_sql(size: int) -> str:
    joined = " || ' ' || ".join(f"ws[i + {d}]" if d else "ws[i]" for d in range(size))
    return (
        f"SELECT lang, phrase, count(*) AS f FROM (SELECT lang, unnest(list_transform("
        f"range(1, greatest(len(ws) - {size - 2}, 1)::BIGINT), lambda i: {joined})) AS phrase FROM w) "
        f"GROUP BY lang, phrase HAVING count(*) >= {LEAST}"
    )


def _cut_sql(of: str, k: int, head: str, tail: str) -> str:
    words = f"string_split({of}.phrase, ' ')"
    return (
        f"SELECT {of}.lang, {of}.phrase, {of}.f AS a, {k} AS k, h.f AS l, t.f AS r, "
        f"((1000000::HUGEINT * {of}.f * {of}.f) // (h.f::HUGEINT * t.f))::BIGINT AS score FROM {of} "
        f"JOIN {head} h ON h.lang = {of}.lang AND h.phrase = array_to_string({words}[:{k}], ' ') "
        f"JOIN {tail} t ON t.lang = {of}.lang AND t.phrase = array_to_string({words}[{k + 1}:], ' ')"
    )


OP11_SQL = f"""
WITH d AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '{PIECE}')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '{WORD}') AS ws FROM p),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
one AS ({_grams_sql(1)}),
two AS ({_grams_sql(2)}),
three AS ({_grams_sql(3)}),
inside AS (
  SELECT lang, phrase, max(f) AS longer FROM (
    SELECT lang, f, array_to_string(string_split(phrase, ' ')[:2], ' ') AS phrase FROM three
    UNION ALL SELECT lang, f, array_to_string(string_split(phrase, ' ')[2:], ' ') FROM three)
  GROUP BY lang, phrase
),
alone AS (
  SELECT two.* FROM two LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < {COVERED} * f
),
cuts AS ({_cut_sql("alone", 1, "one", "one")} UNION ALL {_cut_sql("three", 1, "one", "two")}
  UNION ALL {_cut_sql("three", 2, "two", "one")}),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best JOIN n USING (lang) QUALIFY rank <= {TOP}
"""
