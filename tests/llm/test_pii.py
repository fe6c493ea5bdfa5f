from __future__ import annotations

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from docvec.llm import pii as P

PLAIN = {k: re.compile(p) for k, p in {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}.items()}


def plain_valid(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        odd, even = digits[-1::-2], digits[-2::-2]
        return 14 <= len(digits) <= 19 and (sum(odd) + sum(sum(divmod(2 * d, 10)) for d in even)) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def plain_base(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        out += [(m.start(), rank, kind, m.end()) for m in pattern.finditer(text or "") if plain_valid(kind, m[0])]
    return sorted(out)


TEXTS = [
    None, "", "nothing", "a@b.com@c.org", "x..y@z.a.b.-c.", "@a.b c@d e@f.g", "é ü joé@ä.de jo@x.de ß",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 1.2.3 1..2.3.4", "4539 1488 0343 6467 and 4539-1488-0343-6467",
    "45391488034364670 4111111111111111", "+1 (017) 555-7713 +1 2 +49..-(0) 12345678901234567", "++1234567890123",
    "ftp://joe:pw@host.example/x http://host/y ://a@b x+y://u@h", "IBAN: GB82 WEST 1234 5698 7654 32 AND MORE",
    "iban DE89370400440532013000.", "IBAN DE00370400440532013000", "IBAN IBAN: DE89 3704 0044 0532 0130 00",
    "Account no. 12345-678 acct: 1 account 99", "12 Old Mill Road, 123456 High Street, 7 Road Street",
    "9" * 3000, "1." * 3000, "a" * 3000 + "@" + "b." * 3000, "1 " * 4000, "+1" * 2000, "a@" * 2000, "iban " * 1000,
]


def scanned(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    found = rows.select("i", "t", P.find(F.col("t")).alias("f"))
    return {r.i: r for r in found.select("i", "f", P.redact(F.col("t"), F.col("f.base")).alias("clean")).collect()}


def test_base_spans_against_plain_search(spark):
    rng = random.Random(7)
    made = ["".join(rng.choice("ab1279.@+- :()/é") for _ in range(rng.randint(1, 90))) for _ in range(3000)]
    made += ["".join(rng.choice("0123456789 -.+") for _ in range(rng.randint(10, 60))) for _ in range(2000)]
    got = scanned(spark, TEXTS + made)
    for i, text in enumerate(TEXTS + made):
        assert [tuple(s) for s in got[i].f.base] == plain_base(text), text
    assert sum(len(plain_base(t)) for t in made) > 500


def test_added_spans(spark):
    got = scanned(spark, TEXTS)
    added = {i: [(s.kind, TEXTS[i][s.start : s.end]) for s in r.f.added] for i, r in got.items()}
    assert added[12] == [("login", "ftp://joe:pw@host.example"), ("login", "x+y://u@h")]
    assert added[13] == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert added[14] == [("iban", "DE89370400440532013000")] and added[15] == []
    assert added[16] == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert added[17] == [("account", "12345-678")]
    assert added[18] == [("street", "12 Old Mill Road"), ("street", "7 Road Street")]
    assert not any(added[i] for i in (0, 1, 2, 3, 4, 5, 6))


def test_redacted_text(spark):
    got = scanned(spark, ["mail jo@x.de now", None, "", "4111111111111111", "10.0.0.1 a@b.c"])
    assert [got[i].clean for i in range(5)] == ["mail [EMAIL] now", None, "", "[CARD]", "[IP] [EMAIL]"]


def test_sql_gives_the_same(spark, tmp_path):
    rng = random.Random(3)
    bits = ["a@b.de", "1.2.3.4", "4111 1111 1111 1111", "+1 (017) 555-7713", "x://u@h.de", " ", "é", "9", "no",
            "IBAN GB82 WEST 1234 5698 7654 32", "account no 123456", "5 High Street"]
    texts = TEXTS[:19] + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 12))) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    got = P.op13_pii(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(P.OP13_SQL)
    names = [c[0] for c in want.description]
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(want.fetchall())


def test_edge_rows(spark, edge_docs):
    clashing = edge_docs.withColumn("base", F.lit("x")).withColumn("found", F.lit("y"))
    rows = clashing.select("*", P.find(F.col("text")).alias("pii"))
    assert rows.count() == edge_docs.count()
    assert clashing.filter("false").select(P.find(F.col("text"))).count() == 0


@pytest.mark.parametrize("text", ["7" * 1_000_000, "1." * 500_000, "a@" * 500_000, "1 " * 500_000, "+1(" * 300_000])
def test_long_texts_take_linear_time(text):
    import time

    started = time.perf_counter()
    P.find_spans(text)
    assert time.perf_counter() - started < 20
