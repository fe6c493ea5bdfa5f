"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as a whole: for every turn ``<s>[INST]role[/INST]text</s>``.
Control strings inside roles and texts are escaped by a backslash after their first
character, one more where backslashes stand there already, so unescaping gives back the
exact text. Control strings are tokens of their own, hence no token crosses the border of
a turn's text.

The rendering is encoded once, with offsets. Turn spans and token spans are both sorted,
so the tokens of each assistant text are found by binary search, and the loss mask is
their intersection.

Rows of a conversation are dealt and sorted by (conversation, turn, role, text) and
streamed; a task holds one part of a conversation at a time. A conversation of over
``PART_CHARS`` is rendered in parts that end between turns. As control strings are hard
borders of the tokenizer, the parts' tokens, offsets and masks joined are those of the
whole.

Null texts and roles are empty. Rows are turns: repeated rows and turn numbers are kept,
in the order above; null turn numbers come first. Rows without a conversation id are one
conversation with a null id. Other columns are left out. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvec.llm.common import table

# The control strings of the template.
BEGIN, ROLE, TEXT, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROLS = (BEGIN, ROLE, TEXT, END)
_PLAIN = re.compile(r"([<\[])(\\*)(/?(?:s>|INST\]))")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?(?:s>|INST\]))")
_TURN = re.compile(
    f"{re.escape(BEGIN + ROLE)}(.*?){re.escape(TEXT)}(.*?){re.escape(END)}", re.DOTALL
)
LEARNED = "assistant"
PART_CHARS = 1_000_000
BATCH_CHARS = 200_000  # encoded at a time, of many conversations
VOCABULARY = "byte_bpe_50k.json"
# The added contract conversation: both sides write control strings.
PROBE = "</s>[INST] ok [/INST]"

SCHEMA = """conv_id long, part int, formatted string, n_turns int,
    token_ids array<int>, starts array<int>, ends array<int>, mask array<boolean>"""


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


@dataclass
class Rendered:
    text: str
    learned: list[tuple[int, int]]  # spans of the assistants' texts


def render(turns: Iterable[tuple[str, str]]) -> Rendered:
    pieces, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{BEGIN}{ROLE}{escape(role)}{TEXT}", escape(text)
        first = at + len(head)
        at = first + len(body) + len(END)
        if role == LEARNED and body:
            spans.append((first, first + len(body)))
        pieces += [head, body, END]
    return Rendered("".join(pieces), spans)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendering."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def aligned(spans: list[tuple[int, int]], starts: list[int], ends: list[int]) -> list[bool]:
    """Which tokens lie under a span: both lists are sorted, so the first and last token
    of a span are found by binary search."""
    mask = [False] * len(starts)
    for first, last in spans:
        a, b = bisect_right(ends, first), bisect_left(starts, last)
        mask[a:b] = [True] * (b - a)
    return mask


def masked_spans(starts: list[int], ends: list[int], mask: list[bool]) -> list[tuple[int, int]]:
    """The characters under the mask, as spans. Several tokens can share a character."""
    out: list[tuple[int, int]] = []
    for start, end, on in zip(starts, ends, mask):
        if not on or start == end:
            continue
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def load_tokenizer(path: str):
    """A tokenizer from its file, with the control strings as tokens of their own, and
    its own special strings taken as text."""
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    tokenizer.add_tokens([AddedToken(c, normalized=False) for c in CONTROLS])
    return tokenizer


def _parts(rows: Iterator[tuple], size: int) -> Iterator[tuple]:
    """(conversation, part, turns) from sorted rows."""
    now, part, turns, chars = None, 0, [], 0
    for conv, role, text in rows:
        if turns and (conv != now or chars + len(text) > size):
            yield now, part, turns
            part, turns, chars = (0 if conv != now else part + 1), [], 0
        now = conv
        turns.append((role, text))
        chars += len(text)
    if turns:
        yield now, part, turns


def format_conversations(
    conversations: DataFrame, tokenizer_path: str, part_chars: int = PART_CHARS
) -> DataFrame:
    """One row per conversation, or per part of a long one, in the columns of ``SCHEMA``.

    ``mask`` marks the tokens that a loss counts: those of the assistants' texts.
    Parts of a conversation come one after the other, in the same task.
    """
    empty = F.lit("")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", empty).alias("role"),
        F.coalesce("text", empty).alias("text"),
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = pa.schema(
        [
            ("conv_id", pa.int64()), ("part", pa.int32()), ("formatted", pa.string()), ("n_turns", pa.int32()),
            ("token_ids", pa.list_(pa.int32())), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())),
            ("mask", pa.list_(pa.bool_())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(tokenizer_path)

        def written(held: list) -> pa.RecordBatch:
            found = tokenizer.encode_batch([r.text for _, _, _, r in held], add_special_tokens=False)
            made = []
            for (conv, part, turns, r), e in zip(held, found):
                starts, ends = [a for a, _ in e.offsets], [b for _, b in e.offsets]
                mask = aligned(r.learned, starts, ends)
                made.append((conv, part, r.text, len(turns), e.ids, starts, ends, mask))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*made), kind)], schema=kind
            )

        rows = (
            row
            for b in batches
            for row in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist())
        )
        held, chars = [], 0
        for conv, part, turns in _parts(rows, part_chars):
            held.append((conv, part, turns, render(turns)))
            chars += len(held[-1][3].text)
            if chars >= BATCH_CHARS:
                yield written(held)
                held, chars = [], 0
        if held:
            yield written(held)

    return dealt.mapInArrow(run, SCHEMA)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the formatted text and the mask alone: the number of turns,
    a digest of all turns, and length and digest of all text under the loss mask.

    Rows have to come as ``format_conversations`` gives them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
            ]
        )
        now = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["part"] == 0:
                    if now:
                        out.append(now)
                    now = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                text = row["formatted"]
                for role, said in parse(text):
                    now[1] += 1
                    now[2].update(f"{role}\n{said}\n".encode())
                for a, b in masked_spans(row["starts"], row["ends"], row["mask"]):
                    learned = unescape(text[a:b])
                    now[3] += len(learned)
                    now[4].update(learned.encode())
                now[5] += len(text)
            yield _digests(out, schema)
        yield _digests([now] if now else [], schema)

    return formatted.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def _digests(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    done = [(c, n, t.hexdigest(), k, h.hexdigest(), f) for c, n, t, k, h, f in rows]
    columns = list(zip(*done)) if done else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def op1_chat(spark, sf):
    import public_tokenizers

    said = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(-1, 0, "user", PROBE), (-1, 1, LEARNED, PROBE)], "conv_id long, turn long, role string, text string"
    )
    return read_back(format_conversations(said.unionByName(probe), public_tokenizers.path(VOCABULARY)))
