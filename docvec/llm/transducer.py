"""A BPE tokenizer compiled to a deterministic finite-state transducer that counts tokens.

Reading one more character changes the encoding of a prefix only from its last tokens on.
For any prefix the last token of its encoding is the one piece that ends there and goes
together with the last token before it: two pieces go together when merging their joined
characters gives just these two again, and a row of pieces is an encoding when every
neighbouring two go together. So a state needs, for each suffix of the prefix that may
still grow into a piece, the last token before that suffix and how many tokens there
were. That is finite. A transition is annotated with the tokens that it adds, or takes
away where a character joins tokens. States and transitions are compiled when first
met, and a table of them runs thousands of places at once in numpy.

No piece holds a blank mark after another character, and none holds a character outside
the vocabulary. After such a symbol the state is always the same: it synchronizes. A
chunk's map from entry state to exit state is therefore a constant behind its first
synchronizing symbol, and chunks run independently from there.

A chunk without any such symbol has a map that is not constant. It is worked out for the
entry states that may occur: that which some characters before the chunk lead to, and
every state in which the chunk before may end by its own map, until no new one comes. All
chunks run side by side in this; encodings that begin apart soon meet, so there are few
states a chunk (tested). The maps are composed by doubling, which marks the state each
chunk is really entered in. Heads of the chunks with a constant are run last.
"""

from __future__ import annotations

import numpy as np

BLANK = "▁"  # U+2581, the mark of a blank in pieces
END, SYNC = 0, 8  # symbols below SYNC synchronize; END also stands for unknown characters
CHUNK = 512
WARM = 48  # characters before a chunk that tell a likely entry state
BIAS = 1 << 7
MOST_STATES = 400_000  # kept; beyond, they are compiled anew, with the same results


class Arcs:
    """Transitions by (state, symbol) in an open-addressed table, looked up in numpy."""

    def __init__(self, bits: int = 16):
        self.bits, self.n = bits, 0
        self.keys = np.full(1 << bits, -1, np.int64)
        self.cells = np.zeros(1 << bits, np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Cells of the keys, -1 for those that are not there."""
        slots = self._slots(keys)
        seen = self.keys[slots]
        out = self.cells[slots]
        away = np.flatnonzero(seen != keys)
        while len(away):
            none = seen[away] < 0
            out[away[none]] = -1
            away = away[~none]
            slots[away] = (slots[away] + 1) & (len(self.keys) - 1)
            seen[away] = self.keys[slots[away]]
            out[away] = self.cells[slots[away]]
            away = away[seen[away] != keys[away]]
        return out

    def put(self, keys: np.ndarray, cells: np.ndarray):
        while 2 * (self.n + len(keys)) > len(self.keys):
            held, old = self.keys >= 0, self
            bigger = Arcs(self.bits + 1)
            bigger._insert(old.keys[held], old.cells[held])
            self.bits, self.keys, self.cells = bigger.bits, bigger.keys, bigger.cells
        self._insert(keys, cells)

    def _insert(self, keys: np.ndarray, cells: np.ndarray):
        """New and different keys only."""
        self.n += len(keys)
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] < 0
            where, who = np.unique(slots[free], return_index=True)
            who = np.flatnonzero(free)[who]
            self.keys[where], self.cells[where] = keys[who], cells[who]
            rest = np.ones(len(keys), bool)
            rest[who] = False
            keys, cells = keys[rest], cells[rest]
            slots = (slots[rest] + 1) & (len(self.keys) - 1)


class Transducer:
    def __init__(self, scores: dict[str, float], blank_runs):
        """``scores`` of all pieces that merges may form; ``blank_runs(n)`` tokens of n
        blank marks in a row."""
        assert not any(BLANK in p.lstrip(BLANK) for p in scores)
        self.blank_runs = blank_runs
        self.scores = {p: s for p, s in scores.items() if BLANK not in p[1:]}
        self.own = {p: p for p in self.scores}  # one string object for each piece
        self.prefixes = {p[:i] for p in self.scores for i in range(1, len(p) + 1)}
        self.fits: dict[tuple[str | None, str], bool] = {}
        self.run_shift: dict[int, int] = {}
        self.symbol_of = np.full(0x110000, -1, np.int32)  # by code point
        self.chars: list[str] = [""] * SYNC
        self.shifts = [0]  # of the blank symbols from 1 on
        self.most_entries = 0.0  # entry states a chunk, where a map is not constant
        self._clear()

    # -- compilation -------------------------------------------------------

    def _clear(self):
        self.arcs = Arcs()
        self.states: list[tuple] = []
        self.ids: dict[tuple, int] = {}
        self.root = self._state(((0, None, 0, False),), "", 0)

    def _state(self, entries: tuple, tail: str, shift: int) -> int:
        key = (tail, entries, shift)
        found = self.ids.get(key)
        if found is None:
            found = self.ids[key] = len(self.states)
            self.states.append(key)
        return found

    def _merged(self, text: str) -> list[str]:
        parts = list(text)
        while len(parts) > 1:
            at, best = -1, -np.inf
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and score > best:
                    at, best = i, score
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _goes(self, before: str | None, piece: str) -> bool:
        key = (before, piece)
        found = self.fits.get(key)
        if found is None:
            want = [piece] if before is None else [before, piece]
            found = self.fits[key] = self._merged("".join(want)) == want
        return found

    def _step(self, state: int, char: str) -> tuple[int, int]:
        """Entries of a state: (length of the suffix, last token before it, tokens there
        less those of the whole prefix, whether the encoding there begins with a lone
        blank mark)."""
        tail, entries, shift = self.states[state]
        size = len(tail)
        chosen = None
        for length, last, tokens, lone in entries:
            piece = tail[size - length :] + char
            if piece in self.scores and self._goes(last, piece):
                chosen = (piece, tokens + 1, piece == BLANK if last is None else lone)
                break
        assert chosen is not None, (tail, char)
        piece, added, lone = chosen
        piece = self.own[piece]
        grown = tail + char
        kept = [
            (n + 1, last, tokens - added, l)
            for n, last, tokens, l in entries
            if grown[len(grown) - n - 1 :] in self.prefixes
        ]
        longest = max((n for n, *_ in kept), default=0)
        kept.append((0, piece, 0, lone and shift != 0))
        return self._state(tuple(kept), grown[len(grown) - longest :], shift), added

    def _compile(self, state: int, symbol: int) -> int:
        if symbol >= SYNC:
            following, added = self._step(state, self.chars[symbol])
        else:
            _, entries, shift = self.states[state]
            added = shift if entries[-1][3] else 0
            following = self.root
            if symbol != END:
                start = self._state(((0, None, 0, False),), "", self.shifts[symbol - 1])
                following, one = self._step(start, BLANK)
                added += one
        return (following << 8) + added + BIAS

    def _arcs(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        keys = states << 16 | symbols
        cells = self.arcs.find(keys)
        if (cells < 0).any():
            new = np.unique(keys[cells < 0])
            made = [self._compile(k >> 16, k & 0xFFFF) for k in new.tolist()]
            self.arcs.put(new, np.array(made, np.int64))
            cells = self.arcs.find(keys)
        return cells

    # -- symbols -----------------------------------------------------------

    def _symbols(self, codes: np.ndarray) -> np.ndarray:
        """Symbols of code points; characters outside the vocabulary are END."""
        found = self.symbol_of[codes]
        for code in np.unique(codes[found < 0]):
            char = chr(code)
            if char in self.scores:
                self.symbol_of[code] = len(self.chars)
                self.chars.append(char)
            else:
                self.symbol_of[code] = END
        return self.symbol_of[codes] if (found < 0).any() else found

    def _blank_symbol(self, n: int) -> int:
        """The symbol of the last mark of a run of n. It carries what the run costs less
        if that mark stays alone and joins the run, rather than the word behind it."""
        if n not in self.run_shift:
            self.run_shift[n] = self.blank_runs(n) - self.blank_runs(n - 1) - 1 if n > 1 else 0
        shift = self.run_shift[n]
        if shift not in self.shifts:
            self.shifts.append(shift)
            assert len(self.shifts) < SYNC
        return 1 + self.shifts.index(shift)

    # -- running -----------------------------------------------------------

    def _run(
        self, symbols: np.ndarray, weights: np.ndarray, at: np.ndarray, size: np.ndarray, state: np.ndarray,
        to: np.ndarray | None = None,
    ):
        """Runs places of the stream side by side: ``size`` symbols each from ``at`` on,
        beginning in ``state``. Writes weights, from place ``to`` on if it is not ``at``, and
        returns the states at the end."""
        order = np.argsort(-size, kind="stable")
        at, size, now = at[order], size[order], state[order].astype(np.int64)
        to = at if to is None else to[order]
        ends = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), side="right")
        for t, n in enumerate(ends):
            cell = self._arcs(now[:n], symbols[at[:n] + t])
            weights[to[:n] + t] = (cell & 0xFF) - BIAS
            now[:n] = cell >> 8
        out = np.empty_like(now)
        out[order] = now
        return out

    def _weights(self, symbols: np.ndarray) -> np.ndarray:
        """Tokens added at each symbol of a stream that begins in the root state."""
        n = len(symbols)
        weights = np.zeros(n, np.int16)
        first = np.arange(0, n, CHUNK)
        last = np.minimum(first + CHUNK, n)
        sync = np.flatnonzero(symbols < SYNC)
        nearest = np.searchsorted(sync, first)
        found = np.append(sync, n)[nearest]
        constant = found < last
        head = np.where(constant, found + 1, last) - first
        # Behind the first synchronizing symbol: the constant part of each chunk's map.
        begin = np.full(len(first), self.root, np.int64)
        begin[constant] = self._arcs(begin[constant], symbols[found[constant]]) >> 8
        exits = begin.copy()
        exits[constant] = self._run(
            symbols, weights, (first + head)[constant], (last - first - head)[constant], begin[constant]
        )
        self._moving(symbols, weights, first, last, constant, exits)
        entry = np.r_[self.root, exits[:-1]][: len(first)]
        self._run(symbols, weights, first[constant], head[constant], entry[constant])
        return weights

    def _moving(self, symbols, weights, first, last, constant, exits) -> None:
        """Weights and exits of the chunks without a synchronizing symbol, by their maps."""
        moving = np.flatnonzero(~constant)
        if not len(moving):
            return
        told = (moving == 0) | constant[moving - 1]  # entered in a state that is known
        entry = np.where(moving == 0, self.root, exits[moving - 1])
        warm = np.maximum(first[moving] - WARM, 0)
        spare = np.zeros(len(symbols), np.int16)
        guess = self._run(symbols, spare, warm[~told], (first[moving] - warm)[~told], np.full((~told).sum(), self.root))
        entry[~told] = guess
        # Nodes are the pairs of a chunk and an entry state that its map is known for.
        chunk, state = moving, entry
        nodes: dict[tuple[int, int], int] = {}
        chunks, ends, held = [], [], []
        while len(chunk):
            for pair in zip(chunk.tolist(), state.tolist()):
                nodes[pair] = len(nodes)
            part = np.zeros((len(chunk), CHUNK), np.int16)
            out = self._run(
                symbols, part.reshape(-1), first[chunk], (last - first)[chunk], state, np.arange(len(chunk)) * CHUNK
            )
            chunks.append(chunk)
            ends.append(out)
            held.append(part)
            after = np.append(~constant, False)[chunk + 1]
            following = dict.fromkeys(zip((chunk[after] + 1).tolist(), out[after].tolist()))
            new = [pair for pair in following if pair not in nodes]
            chunk, state = (np.array([p[i] for p in new], np.int64) for i in (0, 1))
        self.most_entries = max(self.most_entries, len(nodes) / len(moving))
        chunk, out, part = np.concatenate(chunks), np.concatenate(ends), np.concatenate(held)
        # Composition: a node leads to the one its exit enters; jumps double each round.
        jump = np.array([nodes.get(pair, len(nodes)) for pair in zip((chunk + 1).tolist(), out.tolist())] + [len(nodes)])
        real = np.zeros(len(nodes) + 1, bool)
        real[[nodes[pair] for pair in zip(moving[told].tolist(), entry[told].tolist())]] = True
        for _ in range(max(len(moving) - 1, 1).bit_length()):
            real[jump[real]] = True
            jump = jump[jump]
        for node in np.flatnonzero(real[:-1]):
            a, b = first[chunk[node]], last[chunk[node]]
            weights[a:b] = part[node, : b - a]
            exits[chunk[node]] = out[node]

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text: a mark before it, blanks as marks, unknown characters as
        one token a byte."""
        if len(self.states) > MOST_STATES:
            self._clear()
        lengths = np.array([len(t) + 2 if t else 1 for t in texts], np.int64)
        ends = np.cumsum(lengths) - 1
        joined = "".join([f" {t}\0" if t else "\0" for t in texts])
        codes = np.frombuffer(joined.encode("utf-32-le"), np.int32)
        codes = np.where(codes == 32, ord(BLANK), codes)
        symbols = self._symbols(codes)
        symbols = np.where(codes == ord(BLANK), 1, symbols)
        symbols = symbols.astype(np.int64)
        extra = np.zeros(len(codes), np.int64)
        unknown = np.flatnonzero(symbols == END)
        strange = codes[unknown]
        extra[unknown] = 1 + (strange >= 0x80).astype(np.int64) + (strange >= 0x800) + (strange >= 0x10000)
        extra[ends] = 0
        symbols[ends] = END
        # Runs of marks: all but the last are counted at once and left out.
        blank = symbols == 1
        begins = np.flatnonzero(blank & ~np.r_[False, blank[:-1]])
        stops = np.flatnonzero(blank & ~np.r_[blank[1:], False])
        keep = np.ones(len(symbols), bool)
        for a, b in zip(begins[stops > begins], stops[stops > begins]):
            n = int(b - a + 1)
            symbols[b] = self._blank_symbol(n)
            extra[b] += self.blank_runs(n - 1)
            keep[a:b] = False
        weights = np.zeros(len(symbols), np.int64)
        weights[keep] = self._weights(symbols[keep])
        return np.add.reduceat(weights + extra, np.r_[0, ends[:-1] + 1]) if len(texts) else np.empty(0, np.int64)


def compiled(model_path: str) -> Transducer:
    """The transducer of a sentencepiece BPE model with byte fallback, identity
    normalization and a blank put before each text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ids = range(model.get_piece_size())
    if not any(model.is_byte(i) for i in ids) or model.normalize("ﬁ  x ") != f"{BLANK}ﬁ{BLANK}{BLANK}x{BLANK}":
        raise ValueError("a model with byte fallback and identity normalization is needed")
    scores = {
        model.id_to_piece(i): model.get_score(i)
        for i in ids
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    }
    runs: dict[int, int] = {0: 0, 1: 1}

    def blank_runs(n: int) -> int:
        if n not in runs:
            runs[n] = len(model.encode(" " * (n - 1)))
        return runs[n]

    return Transducer(scores, blank_runs)
