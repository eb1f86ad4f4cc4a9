"""A linear-chain conditional random field with two tags: plain (0) and toxic (1)."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np

BUCKETS = 1 << 18
_BLOCK = 64
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_CACHED, _LONGEST = 400_000, 64  # words remembered, and their greatest length


def core(word: str) -> str:
    """A word in lower case without the signs around it."""
    return _EDGES.sub("", word.lower())


def features(word: str) -> list[str]:
    """Names of a word's features: itself, and its beginnings of four to eight letters."""
    return ["=" + word, *(f"{n}{word[:n]}" for n in range(4, 9) if len(word) >= n)] if word else []


def bucket(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % BUCKETS


def _prefix(emit: np.ndarray, first: np.ndarray, matrix: tuple[float, float, float, float], start: float) -> np.ndarray:
    """Odds r[t] = emit[t] * (m11 r[t-1] + m01) / (m10 r[t-1] + m00), with r = emit * start where `first`.

    Each step is a 2 by 2 matrix that acts on the odds, so blocks of steps are multiplied side by side and only
    the blocks' results are carried on one by one. The result is exact, whatever the length.
    """
    n = len(emit)
    if not n:
        return np.zeros(0)
    m11, m01, m10, m00 = matrix
    blocks = -(-n // _BLOCK)
    e, f = np.ones(blocks * _BLOCK), np.zeros(blocks * _BLOCK, bool)
    e[:n], f[:n] = emit, first
    e, f = e.reshape(blocks, _BLOCK).T.copy(), f.reshape(blocks, _BLOCK).T.copy()
    a, b, c, d = np.ones(blocks), np.zeros(blocks), np.zeros(blocks), np.ones(blocks)
    steps = np.empty((_BLOCK, 4, blocks))
    for k in range(_BLOCK):
        na, nb = e[k] * (m11 * a + m01 * c), e[k] * (m11 * b + m01 * d)
        nc, nd = m10 * a + m00 * c, m10 * b + m00 * d
        s = f[k]
        if s.any():
            na[s], nb[s], nc[s], nd[s] = 0.0, e[k][s] * start, 0.0, 1.0
        top = np.maximum(np.maximum(na, nb), np.maximum(nc, nd))
        a, b, c, d = na / top, nb / top, nc / top, nd / top
        steps[k] = a, b, c, d
    carried, r = np.empty(blocks), 1.0
    for i, (w, x, y, z) in enumerate(zip(a.tolist(), b.tolist(), c.tolist(), d.tolist())):
        carried[i] = r
        r = (w * r + x) / (y * r + z)
    odds = (steps[:, 0] * carried + steps[:, 1]) / np.maximum(steps[:, 2] * carried + steps[:, 3], 1e-300)
    return odds.T.reshape(-1)[:n]


@dataclass
class Field:
    """Weights of the field: one for each feature bucket, a bias, and the four transitions in logarithms."""

    weights: np.ndarray
    bias: float = -4.0
    moves: np.ndarray = field(default_factory=lambda: np.array([[0.0, -2.0], [-0.5, 0.5]]))
    start: float = -2.0
    scores: dict[str, float] = field(default_factory=dict)
    held: dict[int, float] | None = None

    def __getstate__(self):
        kept = np.flatnonzero(self.weights)
        return {"kept": kept, "values": self.weights[kept], "bias": self.bias, "moves": self.moves, "start": self.start}

    def __setstate__(self, state):
        self.weights = np.zeros(BUCKETS)
        self.weights[state["kept"]] = state["values"]
        self.bias, self.moves, self.start, self.scores, self.held = state["bias"], state["moves"], state["start"], {}, None

    def score(self, word: str) -> float:
        """What speaks for tag 1 at a word, in logarithms."""
        if self.held is None:
            self.held = {int(b): float(self.weights[b]) for b in np.flatnonzero(self.weights)}
        held = self.held.get
        return self.bias + sum([held(bucket(name), 0.0) for name in features(core(word))])

    def emissions(self, words: list[str]) -> list[float]:
        """The scores of words; those of many words are remembered."""
        known = self.scores
        if len(known) > _CACHED:
            known.clear()
        long = {}
        for word in set(words).difference(known):
            (known if len(word) <= _LONGEST else long)[word] = self.score(word)
        if long:
            return [known[w] if w in known else long[w] for w in words]
        return list(map(known.__getitem__, words))

    def marginals(self, emissions: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Chance of tag 1 at each word of sequences that follow one another, by forward and backward passes."""
        emit = np.exp(np.clip(emissions, -30, 30))
        lengths = lengths[lengths > 0]
        ends = np.cumsum(lengths)
        first, last = np.zeros(len(emit), bool), np.zeros(len(emit), bool)
        first[ends - lengths], last[ends - 1] = True, True
        t = np.exp(self.moves)
        forward = _prefix(emit, first, (t[1, 1], t[0, 1], t[1, 0], t[0, 0]), float(np.exp(self.start)))
        # With q = emit * (odds from behind), the backward pass has the same form.
        behind = _prefix(emit[::-1], last[::-1], (t[1, 1], t[1, 0], t[0, 1], t[0, 0]), 1.0)[::-1]
        odds = forward * behind / emit
        return odds / (1.0 + odds)


def cues(docs: list[np.ndarray], toxic: np.ndarray, count: int, least: int = 5, lift: float = 3.5) -> np.ndarray:
    """Marks features that speak for label 1, of `count`: in at least `least` texts of it, and `lift` more (in logarithms) than in others.

    `docs` has the numbers of each text's features, none twice.
    """
    ours, theirs = np.zeros(count), np.zeros(count)
    for numbers, label in zip(docs, toxic):
        (ours if label else theirs)[numbers] += 1
    n, m = max(int(toxic.sum()), 1), max(int((~toxic).sum()), 1)
    gain = np.log((ours + 0.5) / (n + 1)) - np.log((theirs + 0.5) / (m + 1))
    return (ours >= least) & (gain >= lift) & (5 * ours >= 4 * theirs)


def trained(texts: list[list[str]], toxic: np.ndarray, rounds: int = 60, rate: float = 0.3) -> Field:
    """A field fitted to labelled words: those of toxic texts with a cue among their features are tagged 1, all others 0.

    Gradients are of the conditional likelihood of the tags (expected minus observed counts), with Adam steps and a weak
    penalty on the weights. Sequences are the texts as they are.
    """
    numbers: dict[str, int] = {}
    ids = [np.fromiter((numbers.setdefault(core(w), len(numbers)) for w in words), np.int64, len(words)) for words in texts]
    listed, width = list(numbers), 6
    known: dict[str, int] = {}
    exact = np.full((len(listed), width), -1, np.int64)
    for i, word in enumerate(listed):
        names = features(word)
        exact[i, : len(names)] = [known.setdefault(n, len(known)) for n in names]
    buckets = np.array([*map(bucket, known), BUCKETS], np.int64)
    seen = [np.unique(exact[np.unique(x)]) for x in ids]
    chosen = np.append(cues([x[x >= 0] for x in seen], toxic, len(known)), False)
    marked = chosen[exact].any(axis=1)
    table = buckets[exact]
    del known, exact, seen
    flow = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    lengths = np.array([len(x) for x in ids], np.int64)
    tags = np.concatenate([marked[x] & bool(y) for x, y in zip(ids, toxic)]) if ids else np.zeros(0, bool)
    model = Field(np.zeros(BUCKETS))
    if not len(flow) or not tags.any():
        model.bias = -12.0
        return model
    used = lengths[lengths > 0]
    ends = np.cumsum(used)
    first = np.zeros(len(flow), bool)
    first[ends - used] = True
    inner = ~first
    pairs = np.zeros((2, 2))
    before, now = tags[:-1][inner[1:]].astype(int), tags[1:][inner[1:]].astype(int)
    np.add.at(pairs, (before, now), 1)
    # The tags are known, so transitions are set by their counts; weights and bias are fitted by gradient.
    model.moves = np.log((pairs + 1.0) / (pairs + 1.0).sum(axis=1, keepdims=True))
    model.moves[1] = np.maximum(model.moves[1], np.log(0.05))
    model.start = float(np.log((tags[first].sum() + 1.0) / ((~tags[first]).sum() + 1.0)))
    model.bias = 0.0
    spread = np.bincount(table.ravel(), np.repeat(np.bincount(flow, minlength=len(listed)), width), BUCKETS + 1)[:BUCKETS]
    first_m, second_m = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for step in range(1, rounds + 1):
        padded = np.append(model.weights, 0.0)
        by_word = model.bias + padded[table].sum(axis=1)
        residual = model.marginals(by_word[flow], lengths) - tags
        per_word = np.bincount(flow, residual, len(listed))
        gradient = np.bincount(table.ravel(), np.repeat(per_word, width), BUCKETS + 1)[:BUCKETS] + 0.05 * model.weights
        full = np.append(gradient * (spread > 0), per_word.sum())
        first_m = 0.9 * first_m + 0.1 * full
        second_m = 0.99 * second_m + 0.01 * full**2
        move = rate * (first_m / (1 - 0.9**step)) / (np.sqrt(second_m / (1 - 0.99**step)) + 1e-6)
        model.weights = model.weights - move[:-1]
        model.bias -= float(move[-1])
    return model
