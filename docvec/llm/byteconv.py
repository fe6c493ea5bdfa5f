"""A byte-level convolutional network in numpy: forward, backward, training.

Filters of eight taps run over embedded bytes. A text is cut into chunks of 256 bytes
that overlap by half; each filter keeps its largest response in a chunk. A small dense
layer turns these into chunk features, which are max-pooled and averaged over all chunks
of the text and combined into one probability. The largest response tells that something
occurs, a small one over a whole chunk that the chunk lacks variety.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TAPS = 8
HALF = 128  # a chunk is two halves, the next chunk shares one of them
DIMS = 12
FILTERS = 16
HIDDEN = 12
PAD = 256


@dataclass
class Params:
    embed: np.ndarray  # (257, DIMS)
    kernel: np.ndarray  # (TAPS, DIMS, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    dense: np.ndarray  # (FILTERS, HIDDEN)
    dense_bias: np.ndarray  # (HIDDEN,)
    out: np.ndarray  # (2 * HIDDEN,)
    out_bias: np.ndarray  # (1,)

    def arrays(self) -> list[np.ndarray]:
        return [self.embed, self.kernel, self.bias, self.dense, self.dense_bias, self.out, self.out_bias]


def start(seed: int) -> Params:
    """Random weights; bytes begin with their character class as part of the embedding."""
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.2, (257, DIMS))
    codes = np.arange(256)
    classes = [
        (codes >= 65) & (codes <= 90), (codes >= 97) & (codes <= 122), (codes >= 48) & (codes <= 57),
        codes == 32, codes == 10, codes >= 128,
        (codes > 32) & (codes < 128) & ~np.isin(codes, np.r_[48:58, 65:91, 97:123]),
    ]
    for i, own in enumerate(classes):
        embed[:256, i] += own
    embed[PAD] = 0
    return Params(
        embed.astype(np.float32),
        rng.normal(0, 0.3, (TAPS, DIMS, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.4, (FILTERS, HIDDEN)).astype(np.float32),
        np.zeros(HIDDEN, np.float32),
        rng.normal(0, 0.3, 2 * HIDDEN).astype(np.float32),
        np.zeros(1, np.float32),
    )


def halves(text: bytes) -> np.ndarray:
    """(n, HALF + TAPS - 1) bytes: the halves of a text, each with the bytes that its last
    filter places still reach. Every text has one half at least."""
    n = max(1, -(-len(text) // HALF))
    padded = np.full(n * HALF + TAPS - 1, PAD, np.int16)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, HALF + TAPS - 1)[::HALF]


def responses(tables: np.ndarray, parts: np.ndarray, where: bool = False):
    """The largest response of each filter in each half; with ``where`` its place too."""
    total = tables[0].take(parts[:, :HALF], axis=0)
    for k in range(1, TAPS):
        total += tables[k].take(parts[:, k : k + HALF], axis=0)
    if not where:
        return total.max(axis=1)
    at = total.argmax(axis=1)
    return np.take_along_axis(total, at[:, None], 1)[:, 0], at


def tap_tables(p: Params) -> np.ndarray:
    """(TAPS, 257, FILTERS): what a byte adds to a filter at a tap."""
    return np.einsum("bd,kdf->kbf", p.embed, p.kernel)


def _chunks(largest: np.ndarray, first: np.ndarray):
    """Chunks of documents that start at ``first``: pairs of neighbouring halves; the
    last half of a document is a chunk of its own."""
    last = np.zeros(len(largest), bool)
    last[np.r_[first[1:], len(largest)] - 1] = True
    follower = np.where(last, np.arange(len(largest)), np.arange(len(largest)) + 1)
    other = largest[follower]
    return np.maximum(largest, other), follower, other > largest


def combine(p: Params, largest: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Probabilities from the responses of all halves of all documents."""
    pooled, _, _ = _chunks(largest + p.bias, first)
    hidden = np.maximum(np.maximum(pooled, 0) @ p.dense + p.dense_bias, 0)
    counts = np.diff(np.r_[first, len(largest)])[:, None]
    doc = np.hstack([np.maximum.reduceat(hidden, first), np.add.reduceat(hidden, first) / counts])
    return 1 / (1 + np.exp(-np.clip(doc @ p.out + p.out_bias[0], -30, 30)))


class Scorer:
    """Scores whole texts, a bounded number of halves at a time."""

    BLOCK = 2048

    def __init__(self, params: Params):
        self.params, self.tables = params, tap_tables(params)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        out, held, n, first = np.empty(len(texts)), [], 0, 0
        for i, text in enumerate(texts):
            held.append(halves(text))
            n += len(held[-1])
            if n >= self.BLOCK or i == len(texts) - 1:
                out[first : i + 1] = self._block(held)
                held, n, first = [], 0, i + 1
        return out

    def _block(self, parts: list[np.ndarray]) -> np.ndarray:
        """Scores of some texts; their halves are looked at ``BLOCK`` at a time, so that a
        very long text needs no more memory than many short ones."""
        every = np.concatenate(parts)
        largest = [responses(self.tables, every[i : i + self.BLOCK]) for i in range(0, len(every), self.BLOCK)]
        return combine(self.params, np.concatenate(largest), np.r_[0, np.cumsum([len(x) for x in parts])[:-1]])


def _gradients(p: Params, parts: np.ndarray, first: np.ndarray, label: np.ndarray, weight: np.ndarray):
    tables = tap_tables(p)
    largest, at = responses(tables, parts, where=True)
    pooled, follower, from_next = _chunks(largest + p.bias, first)
    active = np.maximum(pooled, 0)
    before = active @ p.dense + p.dense_bias
    hidden = np.maximum(before, 0)
    counts = np.diff(np.r_[first, len(parts)])
    owner = np.repeat(np.arange(len(first)), counts)
    top, mean = np.maximum.reduceat(hidden, first), np.add.reduceat(hidden, first) / counts[:, None]
    doc = np.hstack([top, mean])
    prob = 1 / (1 + np.exp(-np.clip(doc @ p.out + p.out_bias[0], -30, 30)))
    d_logit = ((prob - label) * weight / weight.sum()).astype(p.out.dtype)
    d_out, d_out_bias = doc.T @ d_logit, d_logit.sum(keepdims=True)
    d_doc = d_logit[:, None] * p.out[None, :]
    is_top = (hidden == top[owner]) & (hidden > 0)
    ties = np.maximum(np.add.reduceat(is_top.astype(np.float32), first), 1)
    d_hidden = is_top * (d_doc[:, :HIDDEN] / ties)[owner] + (d_doc[:, HIDDEN:] / counts[:, None])[owner]
    d_before = d_hidden * (before > 0)
    d_dense, d_dense_bias = active.T @ d_before, d_before.sum(0)
    d_pooled = (d_before @ p.dense.T) * (pooled > 0)
    d_largest = np.where(from_next, 0, d_pooled)
    np.add.at(d_largest, follower, np.where(from_next, d_pooled, 0))
    rows, filters = np.nonzero(d_largest)
    g, place = d_largest[rows, filters], at[rows, filters]
    d_kernel, d_embed = np.empty_like(p.kernel), np.zeros_like(p.embed)
    for k in range(TAPS):
        seen = parts[rows, place + k].astype(np.int64)
        d_table = np.bincount(seen * FILTERS + filters, g, 257 * FILTERS).reshape(257, FILTERS).astype(p.embed.dtype)
        d_kernel[k] = p.embed.T @ d_table
        d_embed += d_table @ p.kernel[k].T
    d_embed[PAD] = 0
    return [d_embed, d_kernel, d_largest.sum(0), d_dense, d_dense_bias, d_out, d_out_bias]


def train(
    texts: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, steps: int, batch: int = 64, seed: int = 7
) -> Params:
    """Adam on the weighted log loss. ``texts`` are the halves of each document; every
    batch has as many of either label as there are, weighted back to their shares."""
    p, rng = start(seed), np.random.default_rng(seed)
    moments = [(np.zeros_like(a), np.zeros_like(a)) for a in p.arrays()]
    by_label = [np.flatnonzero(labels == v) for v in (0, 1)]
    shares = np.array([weights[ids].sum() for ids in by_label])
    shares = shares / shares.sum()
    for step in range(1, steps + 1):
        picked = np.concatenate([rng.choice(ids, batch // 2) for ids in by_label])
        weight = np.repeat(np.sqrt(shares), batch // 2)  # between the true shares and even ones
        parts = [texts[i] for i in picked]
        first = np.r_[0, np.cumsum([len(x) for x in parts])[:-1]]
        grads = _gradients(p, np.concatenate(parts), first, labels[picked], weight)
        rate = 0.01 * min(1.0, 2 * (1 - step / (steps + 1)))
        for a, g, (m, v) in zip(p.arrays(), grads, moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            a -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return p
