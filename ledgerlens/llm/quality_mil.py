"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded from measures of its characters and
words and from its words and pairs of words, hashed with a sign; a gated attention network, learned
from document labels only together with the encoding, weighs the passages, and the weighted sum of
their encodings is scored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import fold, per_row, sample_labelled

PASSAGE_WORDS = 64
#: Labelled documents of each class that the network is fitted on, about, at most.
DOCS_PER_CLASS = 3000
#: Bags that fitting holds have so many rows at most: of a longer text, rows that follow each other are averaged, so all of it is seen. Scoring looks at each passage.
FIT_PASSAGES = 32
#: Columns that a passage's words and pairs of words are hashed to.
WORD_COLUMNS = 256
PREDICT_FROM = 0.3
HIDDEN, GATE = 24, 12
EPOCHS, BATCH, RATE = 30, 256, 0.01

_CLASSES = 9
_CLASS = np.full(256, 7, np.int64)  # other ASCII
_CLASS[ord("A") : ord("Z") + 1] = 0
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[ord(c) for c in "#*$%&|<>"]] = 3
_CLASS[[ord(c) for c in ".,;:!?"]] = 4
_CLASS[10] = 5
_CLASS[[9, 11, 12, 13, 32]] = 6
_CLASS[128:] = 8
_MEASURES = _CLASSES + 6
FEATURES = _MEASURES + WORD_COLUMNS
_PAIR = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """64-bit hashes of words, remembered while they are few."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_hashes = _Hashes()


def _word_columns(words: list[bytes], n: int) -> np.ndarray:
    """For each of n passages the signed counts of its words and of pairs that begin in it, over the root of their number."""
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    where = np.arange(len(words)) // PASSAGE_WORDS
    pair = (h[:-1] * _PAIR) ^ h[1:]
    pair ^= pair >> np.uint64(29)
    h, where = np.concatenate([h, pair * _PAIR]), np.concatenate([where, where[:-1]])
    column = (h >> np.uint64(40)).astype(np.int64) % WORD_COLUMNS
    sign = np.where(h >> np.uint64(63) == 1, 1.0, -1.0)
    counts = np.bincount(where * WORD_COLUMNS + column, sign, n * WORD_COLUMNS).reshape(n, WORD_COLUMNS)
    return counts / np.sqrt(np.bincount(where, minlength=n))[:, None]


def pooled(bag: np.ndarray, most: int = FIT_PASSAGES) -> np.ndarray:
    """The bag itself or, of a larger one, the means of ``most`` runs of rows of nearly equal length."""
    if len(bag) <= most:
        return bag
    edge = np.arange(most) * len(bag) // most
    return np.add.reduceat(bag, edge, axis=0) / np.diff(np.append(edge, len(bag)))[:, None]


def passages(text: str | None) -> np.ndarray:
    """One row of features for every 64 words of the text; a text without words has one row of zeros."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.lower().split()
    if not words:
        return np.zeros((1, FEATURES))
    n = -(-len(words) // PASSAGE_WORDS)
    raw = np.frombuffer(data, np.uint8)
    kind = _CLASS[raw]
    blank = (kind == 5) | (kind == 6)
    starts = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
    # a passage runs from its first word to the next one's; what stands before the first word is the first's
    edge = np.concatenate(([0], starts[PASSAGE_WORDS::PASSAGE_WORDS]))
    where = np.zeros(len(raw), np.int64)
    where[edge[1:]] = 1
    hist = np.bincount(np.cumsum(where) * _CLASSES + kind, minlength=n * _CLASSES).reshape(n, _CLASSES)
    out = np.zeros((n, FEATURES))
    solid = np.maximum(hist.sum(1) - hist[:, 5] - hist[:, 6], 1)
    out[:, :_CLASSES] = hist / hist.sum(1, keepdims=True)
    seen: set[bytes] = set()
    for i in range(n):
        part = words[i * PASSAGE_WORDS : (i + 1) * PASSAGE_WORDS]
        own = set(part)
        out[i, _CLASSES:_MEASURES] = (
            len(part) / PASSAGE_WORDS,
            len(own) / len(part),
            min(solid[i] / len(part), 40) / 10,
            len(own & seen) / len(own),
            sum(a == b for a, b in zip(part, part[1:])) / len(part),
            np.log1p(len(words)) / 10,
        )
        seen |= own
    out[:, _MEASURES:] = _word_columns(words, n)
    return out


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w: dict[str, np.ndarray]

    def _forward(self, x: np.ndarray, first: np.ndarray):
        w = self.w
        h = np.tanh(x @ w["enc"] + w["enc0"])
        t, s = np.tanh(h @ w["v"]), 1 / (1 + np.exp(-(h @ w["u"])))
        e = (t * s) @ w["a"]
        size = np.diff(np.append(first, len(x)))
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), size))
        a = e / np.repeat(np.add.reduceat(e, first), size)
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        return h, t, s, a, z, size, 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["c0"], -30, 30)))

    def score(self, bag: np.ndarray) -> float:
        return float(self._forward((bag - self.mean) / self.scale, np.zeros(1, np.int64))[-1][0])

    def gradients(self, x, first, y, weight) -> dict[str, np.ndarray]:
        w = self.w
        h, t, s, a, z, size, p = self._forward(x, first)
        g = (p - y) * weight / len(y)
        dz = np.repeat(g[:, None] * w["c"][None, :], size, axis=0)
        da = (h * dz).sum(1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, first), size))
        dg = de[:, None] * w["a"][None, :]
        dv, du = dg * s * (1 - t * t), dg * t * s * (1 - s)
        dh = a[:, None] * dz + dv @ w["v"].T + du @ w["u"].T
        de_ = dh * (1 - h * h)
        return {"enc": x.T @ de_, "enc0": de_.sum(0), "v": h.T @ dv, "u": h.T @ du, "a": (t * s).T @ de, "c": z.T @ g, "c0": np.array([g.sum()])}


def train(bags: list[np.ndarray], y: np.ndarray, weight: np.ndarray, seed: int = 7) -> Network:
    """Adam on the weighted log loss over the document labels."""
    rng = np.random.default_rng(seed)
    n = sum(map(len, bags))
    mean = sum(b.sum(0, dtype=float) for b in bags) / n
    scale = np.sqrt(np.maximum(sum((b.astype(float) ** 2).sum(0) for b in bags) / n - mean**2, 0))
    scale[:_MEASURES] += 1e-6
    scale[_MEASURES:] = 1.0  # counts of words are of one scale, and rare ones shall not weigh more
    mean[_MEASURES:] = 0.0
    w = {"enc": rng.normal(0, FEATURES**-0.5, (FEATURES, HIDDEN)), "enc0": np.zeros(HIDDEN), "v": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "u": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "a": rng.normal(0, 0.1, GATE), "c": np.zeros(HIDDEN), "c0": np.zeros(1)}
    net = Network(mean, scale, w)
    scaled = lambda b: (b - mean) / scale
    m = {k: np.zeros_like(v) for k, v in w.items()}
    q = {k: np.zeros_like(v) for k, v in w.items()}
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            sizes = [len(bags[i]) for i in pick]
            grads = net.gradients(scaled(np.concatenate([bags[i] for i in pick])), np.cumsum([0, *sizes[:-1]]), y[pick], weight[pick])
            step += 1
            rate = RATE * (1 - epoch / EPOCHS) + 5e-4
            for k, g in grads.items():
                g = g + 1e-4 * w[k]
                m[k] += 0.1 * (g - m[k])
                q[k] += 0.001 * (g * g - q[k])
                w[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(q[k] / (1 - 0.999**step)) + 1e-8)
    return net


def fit(docs: DataFrame, labels: DataFrame, per_class: int = DOCS_PER_CLASS) -> Network | float:
    """A network from rows outside the held-out fold, or, where fewer than two classes are labelled, their rate.

    The classes are sampled to a bounded number each and weighed back to their true shares. A repeated id is fitted once; empty tables give 0.5.
    """
    known = labels.select("doc_id", "quality").where("quality in (0, 1)").where(fold() != 0)
    share = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    if len(share) < 2:
        return 0.5 if not share else float(next(iter(share)))
    picked = sample_labelled(known, "quality", per_class, "quality").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    # bounded by twice per_class, about; where an id repeats, the row of the least text hash is taken
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.first("quality").alias("quality"), F.min_by("text", F.xxhash64("text")).alias("text"))

    def run(b):
        return {"doc_id": b.column(0), "quality": b.column(1), "bag": [pooled(passages(t)).astype("<f4").tobytes() for t in b.column(2).to_pylist()]}

    # bounded: about two classes of per_class bags of FIT_PASSAGES rows, 35 kB each at most
    got = per_row(rows.select("doc_id", "quality", "text"), run, "doc_id long, quality int, bag binary").toPandas().sort_values("doc_id", kind="stable")
    y = got["quality"].to_numpy(float)
    if len(set(y)) < 2:
        return float(share.get(1, 0) / sum(share.values()))
    rate = share[1] / sum(share.values())
    weight = np.where(y == 1, rate / y.mean(), (1 - rate) / (1 - y.mean()))
    return train([np.frombuffer(b, "<f4").reshape(-1, FEATURES) for b in got["bag"]], y, weight)


def score(docs: DataFrame, net: Network | float) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row's whole text; empty and null texts are a bag of one empty passage.

    Repeated rows are scored each, null ids are kept, other columns are ignored; an empty table gives an empty result.
    """

    def run(b):
        found = [net if isinstance(net, float) else net.score(passages(t)) for t in b.column(2).to_pylist()]
        return {"doc_id": b.column(0), "held_out": b.column(1), "score": found, "predicted": [int(x >= PREDICT_FROM) for x in found]}

    return per_row(docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold() == 0).alias("held_out"), "text"), run, "doc_id long, held_out boolean, score double, predicted int")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labels outside the held-out fold; score every row. Null ids count as the empty text in the fold rule.

    Without labels every score is 0.5; with labels of one kind only it is that label.
    """
    return score(docs, fit(docs, labels))
