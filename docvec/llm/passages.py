"""Substring dedup: passages of fifty words that an earlier document has are cut out.

A window is fifty consecutive words. Its phrase is the one of twenty words in it whose
hash is smallest; equal windows have equal phrases, and neighbouring windows mostly share
theirs, so a document has one phrase for every sixteen words or so.

1. Phrases that occur in two documents or more are found by their hashes.
2. Windows around such phrases are hashed, and those that recur are confirmed; the owner
   of a window is the smallest document that has it.
3. Owners cut their recurring passages out as pieces: the windows around one phrase.
4. Documents with recurring phrases are dealt to shards of a bounded number of words. A
   shard gets the pieces whose phrases occur in it and compiles the phrases to an
   Aho-Corasick automaton. Every document is streamed through its shard's automaton; at each
   occurrence the windows around it are compared with those of the pieces, and equal ones
   are removed when the piece's owner comes before the document.

Hashes choose what to compare; what is removed was compared word by word. Phrases and
windows are summed per hash before anything is joined, a passage that a third of all
documents share has one owner and one piece a shard, and nothing is collected.

Words are compared exactly. Null texts have no words. Repeated ids are one document as
far as order goes; rows without an id neither lose nor own words. Texts of under fifty
words are left as they are. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvec.llm.common import WORD, stored, table

WINDOW = 50
PHRASE = 20
SHARD_WORDS = 500_000
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse
_INVERSE = pow(_BASE, -1, 1 << 64)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, ``n`` or more of each; kept per worker for the
    longest text so far."""
    held = max(_POWERS, default=0)
    if held < n:
        _POWERS.clear()
        held = max(n, 4096)
        _POWERS[held] = tuple(
            np.cumprod(np.r_[np.uint64(1), np.full(held - 1, np.uint64(x))], dtype=np.uint64) for x in (_BASE, _INVERSE)
        )
    return _POWERS[held]


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, from running sums."""
    n = len(hashes) - size + 1
    if n < 1:
        return np.empty(0, np.int64)
    powers, back = _powers(len(hashes))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers[: len(hashes)], dtype=np.uint64, out=sums[1:])
    grams = (sums[size:] - sums[:-size]) * back[:n]
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(32)
    return grams.view(np.int64)


def phrase_places(phrases: np.ndarray) -> np.ndarray:
    """Where the phrase of each window begins."""
    span = WINDOW - PHRASE + 1
    if len(phrases) < span:
        return np.empty(0, np.int64)
    around = np.lib.stride_tricks.sliding_window_view(phrases, span)
    return np.arange(len(around)) + around.argmin(axis=1)


def _split(text: bytes | None) -> list[bytes]:
    return (text or b"").split()  # at ASCII blanks alone


def _map(rows: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` makes the columns of the result from each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [[] for _ in names]
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                for held, made in zip(columns, fn(*row)):
                    held.append(made)
            arrays = [
                pa.array(np.concatenate(c) if c else [], t) if t in (pa.int64(), pa.int32()) else
                pa.array([x for part in c for x in part], t)
                for c, t in zip(columns, kinds)
            ]
            yield pa.RecordBatch.from_arrays(arrays, names)

    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    names, kinds = zip(*((n, types[t]) for n, t in (part.split() for part in schema.split(", "))))
    return rows.mapInArrow(run, schema)


def _phrases(doc: int, text: bytes):
    phrases = gram_hashes(word_hashes(_split(text)), PHRASE)
    found = np.unique(phrases[phrase_places(phrases)])
    return found, np.full(len(found), doc)


def _windows(doc: int, text: bytes, recurring: list[int]):
    hashes = word_hashes(_split(text))
    phrases = gram_hashes(hashes, PHRASE)
    places = phrase_places(phrases)
    known = np.isin(phrases[places], np.array(recurring, np.int64))
    found = np.unique(gram_hashes(hashes, WINDOW)[known])
    return found, np.full(len(found), doc)


def _pieces(doc: int, text: bytes, confirmed: list[int]):
    """(phrase hash, owner, words of the piece, where in it the phrase begins)."""
    words = _split(text)
    hashes = word_hashes(words)
    phrases = gram_hashes(hashes, PHRASE)
    places = phrase_places(phrases)
    own = np.flatnonzero(np.isin(gram_hashes(hashes, WINDOW), np.array(confirmed, np.int64)))
    cuts = np.flatnonzero((np.diff(own) > 1) | (np.diff(places[own]) != 0)) + 1
    keys, texts, begins = [], [], []
    for run in np.split(own, cuts) if len(own) else []:
        first, last, place = run[0], run[-1] + WINDOW, places[run[0]]
        keys.append(phrases[place])
        texts.append(b" ".join(words[first:last]).decode())
        begins.append(place - first)
    return keys, [doc] * len(keys), texts, begins


class Automaton:
    """The phrases of a shard, compiled, with the windows of pieces around each.

    A window is entered under its phrase, the place of the phrase in it, and its first
    and last word. So the pieces that agree with a document around a phrase are found
    without trying all, however many there are.
    """

    def __init__(self, pieces: list[tuple[int, str, int]]):
        import ahocorasick

        self.windows: dict[str, dict[tuple, list[tuple[int, list[str], int]]]] = {}
        for owner, text, begin in pieces:
            words = text.split(" ")
            phrase = f" {' '.join(words[begin : begin + PHRASE])} "
            entered = self.windows.setdefault(phrase, {})
            for i in range(len(words) - WINDOW + 1):
                key = (begin - i, words[i], words[i + WINDOW - 1])
                entered.setdefault(key, []).append((owner, words, i))
        self.machine = ahocorasick.Automaton()
        for phrase in self.windows:
            self.machine.add_word(phrase, phrase)
        self.machine.make_automaton()

    def spans(self, doc: int, words: list[str]) -> list[tuple[int, int]]:
        """Stretches of words that an earlier document has, merged, in order."""
        text, at, place = f" {' '.join(words)} ", 0, 0
        found = []
        for end, phrase in self.machine.iter(text):
            # Phrases are of one number of words, so they begin in the order they end in;
            # as many words lie before as blanks.
            begin = end + 1 - len(phrase)
            place += text.count(" ", at, begin)
            at = begin
            entered = self.windows[phrase]
            i = max(0, place - WINDOW + PHRASE)
            while i <= min(place, len(words) - WINDOW):
                last = self._match(entered.get((place - i, words[i], words[i + WINDOW - 1]), ()), doc, words, i)
                if last:
                    found.append((i, last))
                    i = last - WINDOW
                i += 1
        merged: list[tuple[int, int]] = []
        for a, b in sorted(found):
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        return merged

    @staticmethod
    def _match(entries, doc: int, words: list[str], first: int) -> int:
        """How far an earlier document's piece goes on with the words, 0 if no window
        does. Equal windows have one owner, so the first that agrees will do."""
        mine = words[first : first + WINDOW]
        for owner, piece, i in entries:
            if owner < doc and piece[i : i + WINDOW] == mine:
                end, more = first + WINDOW, i + WINDOW
                while end < len(words) and more < len(piece) and words[end] == piece[more]:
                    end, more = end + 1, more + 1
                return end
        return 0


REMOVED = "doc long, hash long, spans array<struct<start:int,end:int>>, n_removed long, kept string"


def _locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by shard, pieces before documents: (shard, owner or document, text,
    begin; null for documents, hash)."""
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    schema = pa.schema(
        [("doc", pa.int64()), ("hash", pa.int64()), ("spans", spans_type), ("n_removed", pa.int64()), ("kept", pa.string())]
    )
    shard, pieces, machine = None, [], None
    for batch in batches:
        out = []
        for now, doc, text, begin, key in zip(*(c.to_pylist() for c in batch.columns)):
            if now != shard:
                shard, pieces, machine = now, [], None
            if begin is not None:
                pieces.append((doc, text, begin))
                continue
            if not pieces:
                continue
            machine = machine or Automaton(pieces)
            words = b" ".join(_split(text.encode())).decode().split(" ")
            spans = machine.spans(doc, words)
            if not spans:
                continue
            kept, last = [], 0
            for a, b in spans:
                kept += words[last:a]
                last = b
            kept += words[last:]
            held = [{"start": a, "end": b} for a, b in spans]
            out.append((doc, key, held, len(words) - len(kept), " ".join(kept)))
        columns = list(zip(*out)) if out else [()] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents that lose words: (doc, hash, spans, n_removed, kept). ``hash`` is
    ``xxhash64`` of the text, ``spans`` are word positions, ``kept`` the words that stay,
    joined by blanks."""
    rows = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")
    )
    raw = F.col("text").cast("binary")
    spread = F.pmod(F.xxhash64("doc"), F.lit(1 << 20))
    phrases = stored(_map(rows.select("doc", raw), _phrases, "phrase long, doc long"), "phrases")
    recurring = (
        phrases.groupBy("phrase").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).filter("a < b").select("phrase")
    )
    occurrences = stored(phrases.join(recurring, "phrase"), "occurrences")
    of_doc = occurrences.groupBy("doc").agg(F.collect_set("phrase").alias("phrases"))
    affected = stored(rows.join(of_doc, "doc"), "affected")

    windows = _map(affected.select("doc", raw, "phrases"), _windows, "window long, doc long")
    confirmed = (
        windows.groupBy("window").agg(F.min("doc").alias("doc"), F.max("doc").alias("last")).filter("doc < last")
    )
    owned = confirmed.groupBy("doc").agg(F.collect_list("window").alias("windows"))
    pieces = stored(
        _map(
            affected.join(owned, "doc").select("doc", raw, "windows"),
            _pieces,
            "phrase long, owner long, piece string, begin int",
        ).distinct(),
        "pieces",
    )

    total = affected.agg(F.sum(F.regexp_count("text", F.lit(WORD)))).first()[0] or 0
    shards = max(-(-total // SHARD_WORDS), 1)
    shard = F.pmod(spread, F.lit(shards)).cast("int")
    latest = occurrences.groupBy("phrase", shard.alias("shard")).agg(F.max("doc").alias("latest"))
    sent = latest.join(pieces, "phrase").filter("owner < latest")
    streamed = sent.select(
        "shard", F.col("owner").alias("doc"), F.col("piece").alias("text"), "begin", F.lit(None).cast("long").alias("hash")
    ).union(
        affected.select(shard.alias("shard"), "doc", "text", F.lit(None).cast("int"), F.xxhash64("text"))
    )
    dealt = streamed.repartition(int(shards), "shard").sortWithinPartitions("shard", F.col("begin").isNull())
    return dealt.mapInArrow(_locate, REMOVED).dropDuplicates(["doc", "hash"])


def op7_passages(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    cut = stored(
        repeats(docs).select("doc", "hash", "n_removed", F.sha2("kept", 256).alias("kept_sha256")), "cut"
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))
    whole = docs.select(
        "doc_id",
        F.xxhash64("text").alias("hash"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"),
        F.sha2(plain, 256).alias("whole_sha256"),
    )
    on = (whole.doc_id == cut.doc) & (whole.hash == cut.hash)
    return whole.join(cut, on, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    )
