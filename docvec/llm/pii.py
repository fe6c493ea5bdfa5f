"""Personal data found by anchors and expanded to their boundaries.

One Aho-Corasick automaton runs over a text and stops at anchors: at-signs, plus signs,
digits, the ``://`` of a scheme, and cue words for identifiers (``IBAN``, ``account``).
At each anchor small parsers look left and right as far as the thing can reach, and then
check it: parts of an address, number of digits, Luhn sum, ISO 7064 remainder. A parser
never looks at a stretch of text again that it has passed, so the work is linear in the
text, whatever it holds.

Base kinds are ``email``, ``ip``, ``card`` and ``phone``. Added are ``login`` (a URL with
user information), ``iban`` and ``account`` (the identifier after a cue) and ``street`` (a
number and a street name); an added span inside a base span is left out.

Spans are [start, end) in code points. A text is looked at as a whole where it is; nothing
is shuffled. Null and empty texts have no spans; repeated rows are scanned each; an empty
table gives no rows. ``find`` and ``redact`` are column functions, so no column of the
input can clash with them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from docvec.llm.common import table
from docvec.llm.secrets import spans_sql

# The kinds in their order, and the shapes of all of them.
KINDS = ("email", "ip", "card", "phone")
ADDED = ("login", "iban", "account", "street")
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
LOGIN = r"[A-Za-z][A-Za-z0-9+.-]*://[A-Za-z0-9._~%+:-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*"
IBAN_CUES = ("iban", "Iban", "IBAN")
IBAN = rf"(?:{'|'.join(IBAN_CUES)})[\x20:]{{0,3}}([A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}})"
ACCOUNT_CUES = ("account", "Account", "ACCOUNT", "acct", "Acct", "ACCT", "passport", "Passport", "PASSPORT")
ACCOUNT = (
    rf"(?:{'|'.join(ACCOUNT_CUES)})(?:\x20(?:no|No|NO|number|Number|id|ID))?\.?[\x20:#]{{1,3}}"
    r"([A-Z]{0,3}[0-9](?:[\x20-]?[0-9])+)"
)
STREET = r"[0-9]+(\x20[A-Z][a-z]+){1,3}\x20(?:Street|Road|Avenue|Lane|Boulevard|Drive|Square)"

SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"
_SPAN = pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("kind", pa.string()), ("end", pa.int32())])

_DIGITS = re.compile("[0-9]+")
_LETTER = re.compile("[A-Za-z]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_USER = re.compile(r"[A-Za-z0-9._~%+:-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*")
_PARSE = {k: re.compile(p) for k, p in {"ip": IP, "card": CARD, "phone": PHONE, "street": STREET}.items()}
_CUED = {"iban": re.compile(IBAN), "account": re.compile(ACCOUNT)}
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def iban_length(text: str) -> int:
    """Length of the longest run of whole groups from the start whose remainder is right."""
    for end in [len(text), *sorted((m.start() for m in re.finditer(" ", text)), reverse=True)]:
        plain = text[:end].replace(" ", "")
        if len(plain) >= 15 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
            return end
    return 0


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def _valid(kind: str, text: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in text.split("."))
    if kind == "street":
        return len(_DIGITS.match(text)[0]) <= 5
    digits = _digits(text)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return {"phone": 10, "account": 6}[kind] <= len(digits) <= {"phone": 15, "account": 20}[kind]


@lru_cache(maxsize=1)
def _anchors():
    import ahocorasick

    machine = ahocorasick.Automaton()
    for digit in "0123456789":
        machine.add_word(digit, ("digit", 1))
    for cue in IBAN_CUES:
        machine.add_word(cue, ("iban", len(cue)))
    for cue in ACCOUNT_CUES:
        machine.add_word(cue, ("account", len(cue)))
    for sign, name in (("@", "email"), ("+", "phone"), ("://", "login")):
        machine.add_word(sign, (name, len(sign)))
    machine.make_automaton()
    return machine


def _reach(text: str, at: int, least: int, of: frozenset[str]) -> int:
    """Where the run of such characters that ends before ``at`` begins."""
    while at > least and text[at - 1] in of:
        at -= 1
    return at


def find_spans(text: str) -> tuple[list[tuple[int, int, str, int]], list[tuple[int, int, str, int]]]:
    """(base, added): spans as (start, rank, kind, end), sorted."""
    passed = dict.fromkeys((*KINDS, *ADDED), 0)
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in passed}

    def at_digit(kind: str, at: int) -> None:
        if at < passed[kind]:
            return
        match = _PARSE[kind].match(text, at)
        if match is None:
            passed[kind] = _DIGITS.match(text, at).end()
            return
        passed[kind] = match.end()
        if _valid(kind, match[0]):
            found[kind].append(match.span())

    for last, (anchor, size) in _anchors().iter(text):
        at = last + 1 - size
        if anchor == "digit":
            at_digit("ip", at)
            at_digit("card", at)
            at_digit("street", at)
        elif anchor == "phone":
            match = _PARSE["phone"].match(text, at)
            if match and _valid("phone", match[0]):
                found["phone"].append(match.span())
        elif anchor in _CUED:
            match = _CUED[anchor].match(text, at) if at >= passed[anchor] else None
            if match:
                passed[anchor] = match.end()
                length = iban_length(match[1]) if anchor == "iban" else _valid(anchor, match[1]) * len(match[1])
                if length:
                    found[anchor].append((match.start(1), match.start(1) + length))
        else:
            first = _reach(text, at, passed[anchor], _LOCAL if anchor == "email" else _SCHEME)
            if anchor == "login":
                letter = _LETTER.search(text, first, at)
                first = letter.start() if letter else at
            match = (_DOMAIN if anchor == "email" else _USER).match(text, last + 1) if first < at else None
            if match:
                passed[anchor] = match.end()
                found[anchor].append((first, match.end()))

    base = sorted((a, rank, k, b) for rank, k in enumerate(KINDS) for a, b in found[k])
    taken = sorted({(a, b) for a, _, _, b in base})
    added = [(a, len(KINDS) + r, k, b) for r, k in enumerate(ADDED) for a, b in found[k]]
    return base, _outside(sorted(added), taken)


def _outside(spans: list, taken: list[tuple[int, int]]) -> list:
    """Spans, by start, that lie in none of the taken ones, by start."""
    kept, i, reach = [], 0, 0
    for span in spans:
        while i < len(taken) and taken[i][0] <= span[0]:
            reach = max(reach, taken[i][1])
            i += 1
        if span[3] > reach:
            kept.append(span)
    return kept


def find(text: Column) -> Column:
    """Struct of ``base`` and ``added``, each an array of (start, rank, kind, end), sorted."""

    @F.arrow_udf(f"struct<base:{SPANS},added:{SPANS}>")
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            base, added = [], []
            for value in texts:
                for held, made in zip((base, added), find_spans(value.as_py() or "")):
                    held.append([dict(zip(("start", "rank", "kind", "end"), s)) for s in made])
            columns = [pa.array(c, pa.list_(_SPAN)) for c in (base, added)]
            yield pa.StructArray.from_arrays(columns, ["base", "added"])

    return spans(text)


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of spans that overlap,
    the stretch that they cover together by the kind of the first."""

    @F.arrow_udf("string")
    def replaced(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for value, held in zip(texts, spans):
            text, parts, last = value.as_py(), [], 0
            for s in sorted(held.as_py() or [], key=lambda s: (s["start"], s["rank"])) if text else []:
                if s["start"] >= last:
                    parts += [text[last : s["start"]], f"[{s['kind'].upper()}]"]
                last = max(last, s["end"])
            out.append(text if not parts else "".join([*parts, text[last:]]))
        return pa.array(out, pa.string())

    return replaced(text, spans)


def _written(spans: Column) -> Column:
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string")))
    )


def op13_pii(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    marked = docs.select("doc_id", find(F.col("text")).alias("found"))

    def count(kind: str) -> Column:
        return F.size(F.filter("found.base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return marked.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(_written(F.col("found.base")), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("found.base", "found.added"))).alias("spans"),
    )


def _remainder_sql(text: str) -> str:
    """Remainder by 97 of an identifier's letters and digits, its first four last."""
    plain = f"replace({text}, ' ', '')"
    numeral = (
        f"array_to_string(list_transform(string_split({plain}[5:] || {plain}[:4], ''), "
        "lambda c: CASE WHEN c >= 'A' THEN (ascii(c) - 55)::VARCHAR ELSE c END), '')"
    )
    digits = f"list_transform(string_split('0' || {numeral}, ''), lambda c: c::BIGINT)"
    return f"list_reduce({digits}, lambda a, b: (a * 10 + b) % 97)"


_IDENTIFIER = "regexp_extract(s.match, '{}', 1)"
_ENDS = (
    "list_max(list_filter(range(1, len(g) + 1), lambda e: (e = len(g) OR g[e + 1] = ' ') "
    f"AND len(replace(g[:e], ' ', '')) >= 15 AND {_remainder_sql('g[:e]')} = 1))"
)
_NUMBER = "regexp_replace({}, '[^0-9]', '', 'g')"
_LUHN = (
    "list_sum(list_transform(string_split(reverse(digits), ''), lambda d, i: "
    "CASE WHEN i % 2 = 1 THEN d::INT WHEN d::INT > 4 THEN 2 * d::INT - 9 ELSE 2 * d::INT END)) % 10 = 0"
)

OP13_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS (
  SELECT doc_id, 0 AS rank, 'email' AS kind, unnest({spans_sql(EMAIL)}) AS s FROM d
  UNION ALL SELECT doc_id, 1, 'ip', unnest({spans_sql(IP)}) FROM d
  UNION ALL SELECT doc_id, 2, 'card', unnest({spans_sql(CARD)}) FROM d
  UNION ALL SELECT doc_id, 3, 'phone', unnest({spans_sql(PHONE)}) FROM d
  UNION ALL SELECT doc_id, 4, 'login', unnest({spans_sql(LOGIN)}) FROM d
  UNION ALL SELECT doc_id, 5, 'iban', unnest({spans_sql(IBAN)}) FROM d
  UNION ALL SELECT doc_id, 6, 'account', unnest({spans_sql(ACCOUNT)}) FROM d
  UNION ALL SELECT doc_id, 7, 'street', unnest({spans_sql(STREET)}) FROM d
),
g AS (
  SELECT doc_id, rank, kind, s.match AS match, s.start::BIGINT AS a,
    CASE kind WHEN 'iban' THEN {_IDENTIFIER.format(IBAN)} WHEN 'account' THEN {_IDENTIFIER.format(ACCOUNT)}
      ELSE s.match END AS g,
    {_NUMBER.format("g")} AS digits
  FROM m
),
e AS (
  SELECT doc_id, rank, kind, a + len(match) - len(g) AS a,
    CASE kind
      WHEN 'iban' THEN {_ENDS}
      WHEN 'ip' THEN CASE WHEN list_bool_and(list_transform(string_split(g, '.'), lambda p:
        len(ltrim(p, '0')) <= 3 AND right(p, 3)::INT <= 255)) THEN len(g) END
      WHEN 'card' THEN CASE WHEN len(digits) BETWEEN 14 AND 19 AND {_LUHN} THEN len(g) END
      WHEN 'phone' THEN CASE WHEN len(digits) BETWEEN 10 AND 15 THEN len(g) END
      WHEN 'account' THEN CASE WHEN len(digits) BETWEEN 6 AND 20 THEN len(g) END
      WHEN 'street' THEN CASE WHEN len(digits) <= 5 THEN len(g) END
      ELSE len(g)
    END AS size
  FROM g
),
x AS (SELECT doc_id, rank, kind, a, a + size AS b, kind || ':' || a || ':' || (a + size) AS span FROM e WHERE size IS NOT NULL),
every AS (
  SELECT * FROM x WHERE rank < {len(KINDS)} OR NOT EXISTS (
    SELECT 1 FROM x y WHERE y.doc_id = x.doc_id AND y.rank < {len(KINDS)} AND y.a <= x.a AND x.b <= y.b)
),
w AS (
  SELECT doc_id,
    count(*) FILTER (rank = 0) AS n_email, count(*) FILTER (rank = 1) AS n_ip,
    count(*) FILTER (rank = 2) AS n_card, count(*) FILTER (rank = 3) AS n_phone,
    string_agg(span, ',' ORDER BY a, rank, b) FILTER (rank < {len(KINDS)}) AS base,
    string_agg(span, ',' ORDER BY a, rank, b) AS spans
  FROM every GROUP BY doc_id
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN w USING (doc_id)
"""
