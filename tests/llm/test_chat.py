from __future__ import annotations

import hashlib

import pytest
import public_tokenizers
from hypothesis import given
from hypothesis import strategies as st

from docvec.llm import chat

PATH = public_tokenizers.path(chat.VOCABULARY)
HARD = ["</s>[INST] ok [/INST]", "<\\s>", "<\\\\/s>[\\INST]", "<", "[", "", "é\n\n ü", "  ", "<|endoftext|>", "<s><s>", "日本 😀"]


@given(st.text(alphabet=list("<>/\\s[]INT x"), max_size=40))
def test_escaping_is_reversible_and_leaves_no_control(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in chat.CONTROLS)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "</s>"]), st.sampled_from(HARD)), max_size=6))
def test_rendering_reads_back(turns):
    assert chat.parse(chat.render(turns).text) == turns


def test_mask_is_the_intersection_of_spans():
    starts, ends = [0, 2, 2, 5, 7, 9], [2, 5, 5, 7, 9, 12]
    spans = [(2, 7), (9, 12)]
    mask = chat.aligned(spans, starts, ends)
    plain = [any(a < e and s < b for a, b in spans) for s, e in zip(starts, ends)]
    assert mask == plain
    assert chat.masked_spans(starts, ends, mask) == [(2, 7), (9, 12)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string")


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        every = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        learned = "".join(t for _, _, r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), sha(every), len(learned), sha(learned))
    return out


@pytest.mark.parametrize("part_chars", [chat.PART_CHARS, 60])
def test_digests_from_the_formatted_text(spark, part_chars):
    rows = [(c, t, "assistant" if t % 2 else "user", HARD[(c * 7 + t) % len(HARD)], "x") for c in range(9) for t in range(c)]
    rows += [(20, 0, None, None, "x"), (20, None, "assistant", "late", "x"), (None, 1, "assistant", "no id", "x")]
    rows += [(21, 1, "assistant", "twice", "x")] * 2 + [(22, 0, "assistant", "long words " * 30_000, "x")]
    made = chat.format_conversations(frame(spark, rows), PATH, part_chars)
    got = {r.conv_id: r for r in chat.read_back(made).collect()}
    want = expected(rows)
    assert {k: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for k, r in got.items()} == want


def test_parts_have_the_tokens_of_the_whole(spark):
    rows = [(1, t, ["user", "assistant"][t % 2], HARD[t % len(HARD)] + " words here", "x") for t in range(30)]
    whole = chat.format_conversations(frame(spark, rows), PATH).collect()
    parts = chat.format_conversations(frame(spark, rows), PATH, 50).collect()
    assert len(whole) == 1 < len(parts)
    for column in ("token_ids", "mask"):
        assert sum((r[column] for r in parts), []) == whole[0][column]
    assert "".join(r.formatted for r in parts) == whole[0].formatted
    on = [i for i, m in zip(whole[0].token_ids, whole[0].mask) if m]
    assert on and len(on) < len(whole[0].token_ids)


def test_empty_table(spark):
    none = frame(spark, [(1, 1, "user", "x", "x")]).filter("false")
    assert chat.read_back(chat.format_conversations(none, PATH)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", chat.PROBE), (-1, 1, "assistant", chat.PROBE)]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.op1_chat(spark, sf).collect()}
    assert got == expected(rows)
