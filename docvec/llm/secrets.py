"""Secret scan with fixed patterns and sliding-window entropy, in DataFrame operations alone.

Fixed patterns find assignments, access keys and long hex strings. Besides, every long
run of key characters is a candidate: a window slides over it and the Shannon entropy of
the characters inside is kept up to date from their counts, one character in and one out
at a step. A candidate whose highest entropy reaches the limit of its character class is
a secret too, unless the allow-list knows it or a fixed pattern has it already.

Random characters of a small alphabet reach less entropy than those of a large one, so
each class has a limit of its own: what 99.5 % of random windows of its alphabet reach
(tested: of random keys of 20 characters, 95 % or more are found in every class). The
allow-list has what is long and no key: runs without a letter, identifiers of the usual
form and names in which digits only end a word and capitals only begin one.

Spans are [start, end) in code points. A text is looked at as a whole, wherever it is;
nothing is shuffled. Work grows with the length of the text and the number of matches: a
megabyte of base64 takes seconds (tested), and so do 100,000 matches. Null texts are empty;
repeated rows are scanned each; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docvec.llm.common import table

# The base patterns, in the order of their kinds.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{12,}"  # AKIA[A-Z0-9]+ of 16 characters or more
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex")
LEAST_VALUE = 8

UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
WINDOW = 20


@dataclass(frozen=True)
class CharClass:
    """Candidates of one class: its characters, and the entropy a window has to reach."""

    kind: str
    alphabet: str
    pattern: str
    limit: float


# In order; a candidate belongs to the first class that has all its characters. Limits are
# the 0.5 % quantile of the entropy of 20 random characters, of 32 letters and digits for
# entropy_upper (base32), rounded down.
CLASSES = (
    CharClass("entropy_hex", DIGITS + "abcdefABCDEF", "^[0-9a-fA-F]+$", 2.8),
    CharClass("entropy_lower", DIGITS + LOWER, "^[0-9a-z]+$", 3.3),
    CharClass("entropy_upper", DIGITS + UPPER, "^[0-9A-Z]+$", 3.25),
    CharClass("entropy_base64", UPPER + LOWER + DIGITS + "+/=_-", "^[A-Za-z0-9+/=_-]+$", 3.55),
)
CANDIDATE = r"[A-Za-z0-9+/=_-]{20,}"
# What is long and varied, and no secret. No group is repeated in them: on a long
# candidate that would take a regular expression's stack.
ALLOWED = (
    "^[^A-Za-z]+$",  # numbers, dates, phone numbers
    "(?i)example|placeholder|changeme|0123456789abcdef|abcdefghijklmnop",
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUID
)
# A name has neither a digit before a letter nor a small letter alone between others.
UNLIKE_NAMES = "[0-9][A-Za-z]|[A-Z][a-z][A-Z0-9]"

_BLOCK = 256
_UNIT = 10**12  # of whole numbers that stand for bits


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, add: Callable[[Column, Column], Column]) -> Column:
    """An array of longs combined from the first up to each.

    Arrays can only be copied to grow, so they grow in blocks, which are then put in line.
    """

    def last(of: Column) -> Column:
        return F.coalesce(F.get(of, F.size(of) - 1), F.lit(0).cast("long"))

    def grown(of: Column) -> Column:
        return F.aggregate(
            of, F.lit([]).cast("array<bigint>"), lambda held, v: F.concat(held, F.array(add(last(held), v)))
        )

    def in_line(blocks: Column) -> Column:
        ends = F.concat(F.array(F.lit(0).cast("long")), grown(F.transform(blocks, last)))
        return _bound(
            ends, lambda before: F.flatten(F.transform(blocks, lambda b, i: F.transform(b, lambda v: add(F.get(before, i), v))))
        )

    def of_all(every: Column) -> Column:
        most = F.greatest(F.ceil(F.size(every) / _BLOCK) - 1, F.lit(0))
        blocks = F.transform(F.sequence(F.lit(0), most.cast("int")), lambda b: F.slice(every, b * _BLOCK + 1, _BLOCK))
        return _bound(F.transform(blocks, grown), in_line)

    return _bound(values, of_all)


def found(text: Column, pattern: str) -> Column:
    """Matches of a pattern as (match, start, end). Positions follow from the lengths of
    the matches and of what lies between."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def placed(of: Column) -> Column:
        sizes = F.transform(of.matches, lambda m, i: (F.length(m) + F.length(F.get(of.gaps, i))).cast("long"))
        return _bound(
            running(sizes, lambda a, b: a + b),
            lambda ends: F.transform(
                of.matches,
                lambda m, i: F.struct(
                    m.alias("match"),
                    (F.get(ends, i) - F.length(m)).cast("int").alias("start"),
                    F.get(ends, i).cast("int").alias("end"),
                ),
            ),
        )

    empty = F.lit([]).cast("array<struct<match:string,start:int,end:int>>")
    spans = _bound(F.struct(matches.alias("matches"), gaps.alias("gaps")), placed)
    return F.when(F.rlike(text, F.lit(pattern)), spans).otherwise(empty)


def highest_entropy(text: Column, of: CharClass, window: int = WINDOW) -> Column:
    """The highest entropy, in bits, of a window sliding over the text.

    The state holds a count for each character of the alphabet, as a string of that many
    characters of which two are overlaid at a step, and the sum of count times its
    logarithm in whole numbers, so that it stays exact however far the window slides.
    """
    # A count stands in the string as the character with the next code.
    change = [round((c + 1) * math.log2(c + 1) * _UNIT) - (round(c * math.log2(c) * _UNIT) if c else 0) for c in range(window + 1)]
    rise = F.lit(change).cast("array<bigint>")

    def count(counts: Column, symbol: Column) -> Column:
        return F.ascii(F.substring(counts, symbol, F.lit(1))) - 1

    def put(counts: Column, symbol: Column, n: Column) -> Column:
        return F.overlay(counts, F.char(n + 1), symbol, F.lit(1))

    def step(state: Column, s: Column) -> Column:
        def left(had: Column) -> Column:
            out = s.out.isNotNull()
            counts = F.when(out, put(state.counts, s.out, had - 1)).otherwise(state.counts)
            total = F.when(out, state["sum"] - F.get(rise, had - 1)).otherwise(state["sum"])
            return _bound(F.struct(counts.alias("counts"), total.alias("sum")), entered)

        def entered(now: Column) -> Column:
            return _bound(
                count(now.counts, s.into),
                lambda had: _bound(
                    now["sum"] + F.get(rise, had),
                    lambda total: F.struct(
                        put(now.counts, s.into, had + 1).alias("counts"),
                        total.alias("sum"),
                        F.when(s.i >= window - 1, F.least(state.least, total)).otherwise(state.least).alias("least"),
                    ),
                ),
            )

        return _bound(F.when(s.out.isNotNull(), count(state.counts, s.out)).otherwise(F.lit(0)), left)

    def slide(symbols: Column) -> Column:
        steps = F.transform(
            symbols,
            lambda c, i: F.struct(c.alias("into"), F.when(i >= window, F.get(symbols, i - window)).alias("out"), i.alias("i")),
        )
        start = F.struct(
            F.repeat(F.lit("\x01"), len(of.alphabet)).alias("counts"),
            F.lit(0).cast("long").alias("sum"),
            F.lit(1 << 62).cast("long").alias("least"),
        )
        # With no whole window the least sum stays out of reach, and the entropy below zero.
        return F.aggregate(steps, start, step, lambda s: F.round(F.lit(math.log2(window)) - s.least / (window * _UNIT), 9))

    symbols = F.transform(F.split(text, ""), lambda c: F.position(c, F.lit(of.alphabet)))
    return _bound(F.filter(symbols, lambda c: c > 0), slide)


def _class_kind(candidate: Column) -> Column:
    """The entropy kind of a candidate; null for one that is no secret."""
    allowed = ~F.rlike(candidate, F.lit(UNLIKE_NAMES))
    for pattern in ALLOWED:
        allowed = allowed | F.rlike(candidate, F.lit(pattern))
    kind = F.lit(None).cast("string")
    for of in reversed(CLASSES):
        high = highest_entropy(candidate, of) >= of.limit
        kind = F.when(F.rlike(candidate, F.lit(of.pattern)), F.when(high, of.kind)).otherwise(kind)
    return F.when(~allowed, kind)


def _outside(candidates: Column, base: Column) -> Column:
    """Candidates that lie in no base span: none that begins at or before one reaches its end."""
    nothing = F.lit(None).cast("string")
    marks = F.transform(
        base, lambda s: F.struct(s.start.alias("start"), F.lit(0).alias("turn"), s.end.alias("end"), nothing.alias("match"))
    )
    asked = F.transform(
        candidates, lambda s: F.struct(s.start.alias("start"), F.lit(1).alias("turn"), s.end.alias("end"), s.match.alias("match"))
    )

    def kept(line: Column) -> Column:
        reach = F.transform(line, lambda s: F.when(s.turn == 0, s.end).otherwise(F.lit(0)).cast("long"))
        return _bound(
            running(reach, F.greatest),
            lambda ends: F.filter(line, lambda s, i: (s.turn == 1) & (F.get(ends, i) < s.end)),
        )

    return _bound(F.array_sort(F.concat(marks, asked)), kept)


def scan(docs: DataFrame, text_col: str = "text", name: str = "secrets") -> DataFrame:
    """``docs`` with a column ``name``: a struct of ``base`` and ``added``, arrays of (start,
    rank, kind, end), sorted.

    ``base`` has what the fixed patterns find, ``added`` what entropy finds beside it.
    """
    if name in docs.columns:
        raise ValueError(f"the table has a column {name} already")
    text = F.coalesce(F.col(text_col), F.lit(""))
    value = lambda s: F.length(F.regexp_extract(s.match, ASSIGN, 2)) >= LEAST_VALUE
    per_kind = (F.filter(found(text, ASSIGN), value), found(text, ACCESS), found(text, HEX))

    def spans(of: Column, rank: int, kind: str) -> Column:
        return F.transform(
            of,
            lambda s: F.struct(
                s.start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s.end.alias("end")
            ),
        )

    base = F.array_sort(F.concat(*[spans(f, i, k) for i, (f, k) in enumerate(zip(per_kind, KINDS))]))

    def with_added(of: Column) -> Column:
        judged = F.transform(
            _outside(of.candidates, of.base),
            lambda c: F.struct(c.start.alias("start"), c.end.alias("end"), _class_kind(c.match).alias("kind")),
        )
        added = F.transform(
            F.filter(judged, lambda c: c.kind.isNotNull()),
            lambda c: F.struct(
                c.start.alias("start"), F.lit(len(KINDS)).alias("rank"), c.kind.alias("kind"), c.end.alias("end")
            ),
        )
        return F.struct(of.base.alias("base"), added.alias("added"))

    candidates = found(text, CANDIDATE)
    return docs.withColumn(name, _bound(F.struct(base.alias("base"), candidates.alias("candidates")), with_added))


def _written(spans: Column) -> Column:
    return F.concat_ws(
        ",",
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string")),
        ),
    )


def op8_secrets(spark, sf):
    found_ = scan(table(spark, sf, "documents").select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets.base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found_.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(_written(F.col("secrets.base")), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("secrets.base", "secrets.added"))).alias("spans"),
    )


def spans_sql(pattern: str, text: str = "text") -> str:
    quoted = pattern.replace("'", "''")
    return (
        f"list_transform(regexp_extract_all({text}, '{quoted}'), lambda m, i: {{"
        f"'match': m, 'start': list_sum(list_transform(regexp_split_to_array({text}, '{quoted}')[1:i], lambda g: len(g)))"
        f" + coalesce(list_sum(list_transform(regexp_extract_all({text}, '{quoted}')[1:i - 1], lambda g: len(g))), 0)}})"
    )


def _kind_sql(candidate: str) -> str:
    allowed = " OR ".join(f"regexp_matches({candidate}, '{p}')" for p in ALLOWED)
    whens = []
    for of in CLASSES:
        entropy = (
            f"list_max(list_transform(range(1, (len({candidate}) - {WINDOW} + 2)::BIGINT), lambda p: "
            f"round(list_aggregate(string_split({candidate}[p:p + {WINDOW - 1}], ''), 'entropy'), 9)))"
        )
        whens.append(
            f"WHEN regexp_matches({candidate}, '{of.pattern}') THEN CASE WHEN {entropy} >= {of.limit} THEN '{of.kind}' END"
        )
    return f"CASE WHEN {allowed} OR NOT regexp_matches({candidate}, '{UNLIKE_NAMES}') THEN NULL {' '.join(whens)} END"


OP8_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS (
  SELECT doc_id, 0 AS rank, 'assign' AS kind, unnest({spans_sql(ASSIGN)}) AS s FROM d
  UNION ALL SELECT doc_id, 1, 'access', unnest({spans_sql(ACCESS)}) FROM d
  UNION ALL SELECT doc_id, 2, 'hex', unnest({spans_sql(HEX)}) FROM d
),
base AS (
  SELECT doc_id, rank, kind, s.start::BIGINT AS a, (s.start + len(s.match))::BIGINT AS b FROM m
  WHERE rank > 0 OR len(regexp_extract(s.match, '{ASSIGN.replace("'", "''")}', 2)) >= {LEAST_VALUE}
),
c AS (
  SELECT doc_id, s.match AS match, s.start::BIGINT AS a, (s.start + len(s.match))::BIGINT AS b
  FROM (SELECT doc_id, unnest({spans_sql(CANDIDATE)}) AS s FROM d)
),
added AS (
  SELECT doc_id, {len(KINDS)} AS rank, {_kind_sql("match")} AS kind, a, b FROM c
  WHERE NOT EXISTS (SELECT 1 FROM base x WHERE x.doc_id = c.doc_id AND x.a <= c.a AND c.b <= x.b)
),
every AS (SELECT * FROM base UNION ALL SELECT * FROM added WHERE kind IS NOT NULL),
w AS (SELECT *, kind || ':' || a || ':' || b AS span FROM every),
g AS (
  SELECT doc_id,
    count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
    string_agg(span, ',' ORDER BY a, rank, b) FILTER (rank < {len(KINDS)}) AS base,
    string_agg(span, ',' ORDER BY a, rank, kind, b) AS spans
  FROM w GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""
