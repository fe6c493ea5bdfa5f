"""Overlapping split of a text into pieces that prefer to end at a sentence.

Rule, with ``pos`` starting at 0 and running while it is inside the text: take
``max_chars`` characters from ``pos``; when the last full stop among them lies at
or beyond 60 % of ``max_chars``, end the piece there; step on by the length of
the piece less ``overlap``, by one character at least.

Once a piece reaches the end of the text, the rule goes on emitting the shrinking
rest. ``tail="compat"`` keeps those pieces; ``tail="compact"`` stops at the piece
that reaches the end, which loses no text since the others are suffixes of it.

Characters are code points. The walk depends on every earlier cut, so it runs as
an Arrow UDF in time linear in the text: a ``substring`` fold on the JVM side walks
every text from its start for each piece. The UDF works through an Arrow batch by slices
of bounded length, so a worker holds the pieces of a few texts, not of ten thousand.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from docvec.options import MAX_CHARS, OVERLAP

TAILS = ("compat", "compact")
SENTENCE_SHARE = 0.6
# Bytes of text that a worker turns into Python strings at a time, about.
SLICE_BYTES = 1 << 19


def check_split(max_chars: int, overlap: int, tail: str) -> None:
    if not 0 <= overlap < max_chars:
        raise ValueError("overlap must be at least 0 and below max_chars")
    if tail not in TAILS:
        raise ValueError(f"tail must be one of {TAILS}")


def walk(text: str, max_chars: int, overlap: int, compact: bool) -> list[str]:
    least_cut = int(max_chars * SENTENCE_SHARE)
    size, pos, out = len(text), 0, []
    while pos < size:
        end = min(pos + max_chars, size)
        stop = text.rfind(".", pos + least_cut, end)
        if stop >= 0:
            end = stop + 1
        out.append(text[pos:end])
        if compact and end == size:
            break
        pos += max(end - pos - overlap, 1)
    return out


def tails_follow(max_chars: int, overlap: int) -> bool:
    """Whether the pieces after the one that reaches the end are its suffixes of
    ``overlap`` characters and less, one by one: none of them has room for a cut."""
    return overlap <= int(max_chars * SENTENCE_SHARE)


def tail_count(last: int, overlap: int) -> int:
    """Pieces that follow one of ``last`` characters that reaches the end."""
    return min(overlap, last - 1)


def slices(batch: pa.Array, most: int = SLICE_BYTES, rows: int = 1024, step: int = 1) -> Iterator[list]:
    """The values of a batch in lists of a bounded number of rows, a multiple of ``step``
    unless the batch ends, and of about ``most`` bytes unless ``step`` rows have more."""
    if not len(batch):
        yield []
    per_row = max(batch.nbytes // max(len(batch), 1), 1)
    size = max(min(rows, most // per_row) // step, 1) * step
    for start in range(0, len(batch), size):
        yield batch.slice(start, size).to_pylist()


def split_clean(
    text: Column,
    max_chars: int = MAX_CHARS,
    overlap: int = OVERLAP,
    tail: str = "compat",
) -> Column:
    """``array<string>`` of pieces of an already normalized text."""
    check_split(max_chars, overlap, tail)
    compact = tail == "compact"

    @F.arrow_udf("array<string>")
    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for texts in slices(batch):
                yield pa.array(
                    [walk(t or "", max_chars, overlap, compact) for t in texts],
                    pa.list_(pa.string()),
                )

    return pieces(text)


def count_clean(
    text: Column,
    max_chars: int = MAX_CHARS,
    overlap: int = OVERLAP,
    tail: str = "compat",
) -> Column:
    """The number of those pieces; no piece leaves the worker."""
    check_split(max_chars, overlap, tail)
    follow = tail == "compat" and tails_follow(max_chars, overlap)

    def count(t: str) -> int:
        found = walk(t, max_chars, overlap, tail == "compact" or follow)
        return len(found) + (tail_count(len(found[-1]), overlap) if follow and found else 0)

    @F.arrow_udf("int")
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for texts in slices(batch):
                yield pa.array([count(t or "") for t in texts], pa.int32())

    return counts(text)


COMPARED = "struct<pieces: array<string>, same: array<int>, had: int>"


def compare_clean(
    text: Column,
    earlier: Column,
    max_chars: int = MAX_CHARS,
    overlap: int = OVERLAP,
    tail: str = "compat",
) -> Column:
    """A text's pieces beside those of its earlier texts (``array<string>``, or null).

    ``pieces`` leaves out the suffixes at the end where they follow from the last piece;
    ``same`` has the ordinals, suffixes included, at which an earlier text has the same piece,
    and ``had`` the most pieces that an earlier text has.
    """
    check_split(max_chars, overlap, tail)
    follow = tail == "compat" and tails_follow(max_chars, overlap)

    def folded(t: str) -> tuple[list[str], int]:
        found = walk(t, max_chars, overlap, tail == "compact" or follow)
        return found, tail_count(len(found[-1]), overlap) if follow and found else 0

    def piece(found: list[str], tails: int, i: int) -> str:
        return found[i] if i < len(found) else found[-1][i - len(found) - tails :]

    def row(t: str, olds: list[str]) -> tuple[list[str], list[int], int]:
        now, tails = folded(t)
        same, had = set(), 0
        for old in olds:
            before, more = folded(old)
            had = max(had, len(before) + more)
            both = range(min(len(now) + tails, len(before) + more))
            same.update(i for i in both if piece(now, tails, i) == piece(before, more, i))
        return now, sorted(same), had

    kinds = [("pieces", pa.list_(pa.string())), ("same", pa.list_(pa.int32())), ("had", pa.int32())]

    @F.arrow_udf(COMPARED)
    def compared(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, olds in batches:
            pair = pa.StructArray.from_arrays([texts, olds], ["text", "olds"])
            for rows in slices(pair):
                made = [row(r["text"] or "", r["olds"] or []) for r in rows]
                columns = [pa.array([m[i] for m in made], kind) for i, (_, kind) in enumerate(kinds)]
                yield pa.StructArray.from_arrays(columns, [name for name, _ in kinds])

    return compared(text, earlier)
