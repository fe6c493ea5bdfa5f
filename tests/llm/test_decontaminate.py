from __future__ import annotations

import itertools
import random
import re

import pytest

from docvec.llm import decontaminate as D
from tests.llm.conftest import words


def tokens(text):
    apart = re.sub("([\u0e01-\u0e30\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fff])", r" \1 ", (text or "").lower())
    return [t for t in re.split(r"[^\w]+|_", apart) if t]


def plain(doc, item):
    """Whether some aligned window agrees enough, by trying all alignments."""
    a, b = tokens(doc), tokens(item)
    if not b or (len(b) <= D.ALONE and len(a) != len(b)):
        return False
    size = min(D.WINDOW, len(b))
    need = 11 if size == 13 else size - 1 if size >= 10 else size
    for i in range(len(a) - size + 1):
        for j in range(len(b) - size + 1):
            if sum(x == y for x, y in zip(a[i : i + size], b[j : j + size])) >= need:
                return True
    return False


@pytest.mark.parametrize("size,differing", [(13, 2), (12, 1), (11, 1), (10, 1), (9, 0), (8, 0), (7, 0)])
def test_some_mask_sees_equal_tokens_only(size, differing):
    places = [{o + p for p in m} for m in D.MASKS for o in range(size - max(m))]
    for wrong in itertools.combinations(range(size), differing):
        assert any(not p & set(wrong) for p in places)


def changed(text, seed, share):
    rng = random.Random(seed)
    parts = text.split()
    return " ".join("changed%d" % rng.randrange(10**6) if rng.random() < share else w for w in parts)


def found(docs, items):
    from pyspark.sql import functions as F

    return {(r.k0, r["item"]) for r in D.contaminated(docs, items, [F.col("doc_id")]).collect()}


def test_against_all_alignments(spark, docs_of):
    items = [words(n, 1000 + n) for n in (3, 4, 6, 7, 8, 9, 10, 11, 12, 13, 14, 20, 40)] + ["", None, words(20, 77)]
    items += ["yes", "日本語の文章です", "北京是中国的首都也是全国的政治文化中心城市", "ภาษาไทย", "一二三", "。、！"]
    texts = [words(60, 1)]
    for n, item in enumerate(items):
        for share in (0, 0.05, 0.1, 0.15, 0.25):
            start, end = words(n % 5, n), words((n + 3) % 7, n + 50)
            texts.append(f"{start} {changed(item or '', n, share)} {end}")
            texts.append(f"{start} {changed(item or '', n + 99, share).upper().replace(' ', ', ')}. {end}")
    texts += ["Yes!", "yes no", "前文北京是中国的首都也是全国的政治文化中心城市后文", "北京是美国的首都也是全国的经济文化中心城市"]
    texts += ["x日本語の文章です。y", "日本語の文", "一二三", "一二三四", "（一）二、三"]
    texts += [None, "", items[9][: len(items[9]) // 2]]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = found(docs_of(texts), bench)
    expect = {(i, j) for i, t in enumerate(texts) for j, item in enumerate(items) if plain(t, item)}
    assert got == expect and len(expect) > 30


def test_blocks_give_the_same(spark, docs_of, monkeypatch):
    items = [words(20, i) for i in range(8)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = docs_of([f"{words(5, 90 + i)} {item} {words(5, 80 + i)}" for i, item in enumerate(items)] + [words(50, 555)])
    whole = found(docs, bench)
    monkeypatch.setattr(D, "BLOCK_SEEDS", 50)
    assert found(docs, bench) == whole == {(i, i) for i in range(8)}


def test_edge_rows(spark, edge_docs):
    bench = spark.createDataFrame([(1, words(80, 3)), (2, None), (None, words(80, 2))], "item_id long, text string")
    kept = D.decontaminate(edge_docs, bench)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [0, 1, 2, 3, 4] and ids.count(None) == 1
    assert D.decontaminate(edge_docs.filter("false"), bench).count() == 0
    assert D.decontaminate(edge_docs, bench.filter("false")).count() == edge_docs.count()
