from __future__ import annotations

import random
import time

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from docvec.llm import tokens, transducer
from tests.llm.conftest import words

PATH = public_tokenizers.path(tokens.MODEL)


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def machine():
    return transducer.compiled(PATH)


def samples():
    rng = random.Random(4)
    letters = "abcdefghij thequick 012 \n\t,.!?éèüßñ  _-▁日本語中文한국😀ſ\0<s></s>ABC{}();=+/*"
    parts = "the of and in return def self import class function http www 1234 straße niño".split()
    out = ["", " ", "   ", "\n", "a", "▁", "  Hello  wörld\n\tfoo  ", "hello" * 400, "a" * 5000, "日本語" * 900]
    out += [" " * n + "x" + " " * (n // 2) for n in (1, 2, 7, 16, 17, 33, 100, 3000)]
    out += ["<s></s><0x41><unk>", words(20_000, 3), "=" * 3000, "x" * 511 + " y", "ab" * 256 + "é"]
    out += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 150))) for _ in range(1500)]
    out += ["".join(rng.choice(parts) + rng.choice(["", " ", "  ", "\n"]) for _ in range(rng.randint(1, 60))) for _ in range(1000)]
    return out


def test_counts_are_those_of_the_library(machine, model):
    texts = samples()
    assert machine.count(texts).tolist() == [len(x) for x in model.encode(texts)]


def test_counts_do_not_depend_on_neighbours_chunks_or_memory(machine, model, monkeypatch):
    texts = samples()[:60]
    want = [len(x) for x in model.encode(texts)]
    assert [int(machine.count([t])[0]) for t in texts] == want
    for size in (1, 2, 7, 64):
        monkeypatch.setattr(transducer, "CHUNK", size)
        assert machine.count(texts[:20]).tolist() == want[:20]
    monkeypatch.setattr(transducer, "CHUNK", 512)
    monkeypatch.setattr(transducer, "MOST_STATES", 10)
    assert machine.count(texts).tolist() == want
    assert len(machine.count([])) == 0


def unspaced(machine, n, seed):
    """Chinese-like text: words of one to three characters from a small stock, as in a language.
    All are in the vocabulary, as others would synchronize."""
    rng = random.Random(seed)
    chars = [c for c in map(chr, range(0x4E00, 0x9FA5)) if c in machine.scores]
    stock = ["".join(rng.choice(chars) for _ in range(rng.randint(1, 3))) for _ in range(400)]
    return "".join(rng.choice(stock) for _ in range(n // 2 + 1))[:n]


@pytest.mark.parametrize("kind", ["chinese", "letters", "one letter", "two letters", "mixed"])
def test_long_texts_without_a_blank(machine, model, kind):
    rng = random.Random(kind)
    text = {
        "chinese": unspaced(machine, 40_000, 5),
        "letters": "".join(rng.choice("abcdefgh0123") for _ in range(20_000)),
        "one letter": "a" * 30_001,
        "two letters": "ab" * 15_000,
        "mixed": " word " + unspaced(machine, 9_000, 6) + " the end " + "xyz" * 3000 + "\n" + unspaced(machine, 3000, 7),
    }[kind]
    machine.most_entries = 0.0
    assert machine.count([text, "x", text[:1000]]).tolist() == [len(model.encode(t)) for t in (text, "x", text[:1000])]
    assert 1 <= machine.most_entries < 16


def test_a_megabyte_without_a_blank_is_about_as_fast_as_english(machine):
    chinese, english = unspaced(machine, 1_000_000, 9), words(100_000, 2)
    took = []
    for text in (english, chinese):
        machine.count([text])
        started = time.perf_counter()
        machine.count([text])
        took.append((time.perf_counter() - started) / len(text))
    assert took[1] < 5 * took[0], took


def test_arcs_find_what_was_put():
    rng = np.random.default_rng(0)
    arcs, keys = transducer.Arcs(4), np.unique(rng.integers(0, 1 << 40, 5000))
    rng.shuffle(keys)
    for part in np.array_split(keys, 37):
        arcs.put(part, part * 3)
    assert (arcs.find(keys) == keys * 3).all()
    assert (arcs.find(keys + (1 << 41)) == -1).all()


def test_edge_rows_and_blocks(edge_docs, model, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_CHARS", 100)
    rows = tokens.with_token_counts(edge_docs, PATH)
    assert rows.columns == [*edge_docs.columns, "n_tokens"]
    got = rows.collect()
    assert len(got) == edge_docs.count()
    assert all(r.n_tokens == len(model.encode(r.text or "")) for r in got)
    assert tokens.with_token_counts(edge_docs.filter("false"), PATH).count() == 0


def test_query(spark, model):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = tokens.op10_tokens(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(model.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)
