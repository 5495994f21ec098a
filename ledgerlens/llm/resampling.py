"""Importance resampling of documents towards a target distribution, by hashed word n-grams.

A text's features are its runs of one and of two words. Each task builds a trie of the
words it meets: the first level has a node for each word, the second one for each word
that followed it. A node carries the CRC-32 of its path, so a child's goes on from its parent's,
and a payload. Counting, the payload is how often the path was walked, and a task gives bucket totals; scoring,
it is the gain of the path's bucket, and a text's sum is taken along the nodes it walks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import map_arrow
from ledgerlens.operators.relational import with_index
from ledgerlens.plans import scratch

BUCKETS = 10_000
SHARE = 25
LEAST_WORDS = 20
SEED = 7
#: A task's trie starts anew beyond so many nodes or bytes of words; totals of both tries add up to the same.
MAX_NODES = 2_000_000
MAX_BYTES = 64_000_000
#: Bytes of text that are walked at once; longer texts go in slices that share a word.
SLICE = 8_000_000

_OTHERS = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


class _Words(dict):
    """Word to node number; a word that is new gets the next one."""

    def __init__(self):
        super().__init__()
        self.list: list[bytes] = []
        self.size = 0

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.list)
        self.list.append(word)
        self.size += len(word)
        return n


class Trie:
    """Words and pairs of words. ``payload(crcs)`` gives what new nodes carry."""

    def __init__(self, payload):
        self.payload = payload
        self.words = _Words()
        self.after = np.zeros(0, np.uint32)  # CRC states of the words and a blank
        self.first = payload(np.zeros(0, np.uint32))
        self.edges = np.zeros(0, np.int64)  # sorted: parent node << 32 | word
        self.crcs = [np.zeros(0, np.uint32), np.zeros(0, np.uint32)]
        self.second = payload(np.zeros(0, np.uint32))

    def full(self) -> bool:
        return len(self.words) + len(self.edges) > MAX_NODES or self.words.size > MAX_BYTES

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The words' nodes; new ones are added."""
        n = len(self.first)
        found = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        crc = np.array([crc32(w) for w in self.words.list[n:]], np.uint32)
        self.after = np.concatenate([self.after, np.array([crc32(b" ", c) for c in crc.tolist()], np.uint32)])
        self.crcs[0] = np.concatenate([self.crcs[0], crc])
        self.first = np.concatenate([self.first, self.payload(crc)])
        return found

    def children(self, edges: np.ndarray) -> np.ndarray:
        """Places of the edges, which are distinct and sorted, in the second level; new ones are added."""
        at = np.searchsorted(self.edges, edges)
        new = edges[(at == len(self.edges)) | (self.edges[np.minimum(at, len(self.edges) - 1)] != edges)] if len(self.edges) else edges
        if len(new):
            words = self.words.list
            states = self.after[new >> 32].tolist()
            crc = np.array([crc32(words[w], s) for w, s in zip((new & 0xFFFFFFFF).tolist(), states)], np.uint32)
            where = np.searchsorted(self.edges, new)
            self.edges = np.insert(self.edges, where, new)
            self.crcs[1] = np.insert(self.crcs[1], where, crc)
            self.second = np.insert(self.second, where, self.payload(crc))
            at = np.searchsorted(self.edges, edges)
        return at


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text, slice by slice; each slice but the first starts with the last word of the one before."""
    text = text.translate(_OTHERS)
    at, last = 0, None
    while at < len(text) or at == 0:
        end = len(text) if len(text) - at <= SLICE else text.find(b" ", at + SLICE)
        end = len(text) if end < 0 else end
        words = text[at:end].split()
        if words:
            yield words if last is None else [last, *words]
            last = words[-1]
        if end == len(text):
            return
        at = end


def _steps(texts: list[bytes | None]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """(words, row of each word, whether it counts here, whether the next word follows it) for about SLICE bytes at a time."""

    def packed():
        row = np.repeat(rows, sizes)
        counts, follows = np.ones(len(words), bool), np.ones(len(words), bool)
        start = np.cumsum(sizes) - sizes
        counts[start[np.array(repeats)]] = False
        follows[start + sizes - 1] = False
        return words, row, counts, follows

    words, rows, sizes, repeats, size = [], [], [], [], 0
    for i, text in enumerate(texts):
        for j, part in enumerate(words_of(text or b"")):
            words += part
            rows.append(i)
            sizes.append(len(part))
            repeats.append(j > 0)
            size += 8 * len(part) if j else min(len(text), SLICE)
            if size >= SLICE:
                yield packed()
                words, rows, sizes, repeats, size = [], [], [], [], 0
    if words:
        yield packed()


def _pairs(ids: np.ndarray, follows: np.ndarray) -> np.ndarray:
    here = np.flatnonzero(follows)
    return ids[here] << 32 | ids[here + 1]


def bucket_totals(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all ``text`` fall in each bucket; empty buckets are absent, null texts have none.

    A task sends no more rows than there are buckets for each trie it fills.
    """

    def totals(trie: Trie) -> pa.RecordBatch:
        n = np.zeros(buckets, np.int64)
        for crc, count in zip(trie.crcs, (trie.first, trie.second)):
            np.add.at(n, (crc % np.uint32(buckets)).astype(np.int64), count)
        some = np.flatnonzero(n)
        return pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(n[some], pa.int64())], names=["bucket", "n"])

    def run(batches):
        fresh = lambda: Trie(lambda crcs: np.zeros(len(crcs), np.int64))
        trie = fresh()
        for b in batches:
            for words, _, counts, follows in _steps(b.column("text").cast(pa.binary()).to_pylist()):
                ids = trie.numbers(words)
                trie.first += np.bincount(ids[counts], minlength=len(trie.first))
                edges, n = np.unique(_pairs(ids, follows), return_counts=True)
                at = trie.children(edges)
                trie.second[at] += n
                if trie.full():
                    yield totals(trie)
                    trie = fresh()
        yield totals(trie)

    return map_arrow(df.select("text"), run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's share in ``target`` and in ``docs``, one more counted in each; one whole number a bucket."""
    n = []
    for df in (docs, target):
        count = np.zeros(buckets, np.int64)
        for r in bucket_totals(df, buckets).collect():  # one row a bucket
            count[r.bucket] = r.n
        n.append(count.tolist())
    s, t = sum(n[0]), sum(n[1])
    return np.array([math.floor(1000 * math.log(float(b + 1) * float(t0) / (float(a + 1) * float(s0)))) for a, b in zip(*n) for t0, s0 in ((s + buckets, t + buckets),)], np.int64)


def noise(seed: int, doc_id: str) -> int:
    """Thousandths of a Gumbel draw hashed from the id: the largest of score plus noise are a draw without replacement by weight."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, target: DataFrame, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row of ``docs(doc_id, text)``.

    ``weight`` is the floored mean gain of a text's features, 0 without any. A null text is empty, a null id hashed as the empty text.
    Rows of one id draw the same noise; repeated rows count as often as they are there.
    """
    gain = gains(docs, target, buckets)

    def run(batches):
        fresh = lambda: Trie(lambda crcs: gain[crcs % np.uint32(buckets)])
        trie = fresh()
        for b in batches:
            rows = len(b)
            n_words, total = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            for words, row, counts, follows in _steps(b.column("text").cast(pa.binary()).to_pylist()):
                ids = trie.numbers(words)
                np.add.at(n_words, row[counts], 1)
                np.add.at(total, row[counts], trie.first[ids[counts]])
                edges, where = np.unique(_pairs(ids, follows), return_inverse=True)
                at = trie.children(edges)
                np.add.at(total, row[follows], trie.second[at][where])
                if trie.full():
                    trie = fresh()
            n = np.where(n_words > 0, 2 * n_words - 1, 0)
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            drawn = np.array([noise(seed, k or "") for k in b.column("key").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(c, pa.int64()) for c in (n_words, n, weight, weight + drawn)]], names=["doc_id", "n_words", "n_features", "weight", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", F.col("doc_id").cast("string").alias("key"), "text"), run, f"doc_id {kind}, n_words long, n_features long, weight long, score long")


def judge(docs: DataFrame, target: DataFrame, share: int = SHARE, least: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is 1, 2, 3... for those drawn and null for the others.

    Of the documents with ``least`` words or more, ``share`` percent (rounded down) with the highest scores are drawn, equal ones
    by the smaller id, then by fewer features. Of an empty table none are; without a target the weights compare with even shares.
    """
    found = scratch.keep(scores(docs, target, seed, buckets).select("*", (F.col("n_words") < least).alias("short"), (-F.col("score")).alias("low")), "scores")
    enough = found.where("not short").count()
    ranked = with_index(found, "short", "low", "doc_id", "n_features", name="place")
    scratch.drop(found)
    rank = F.when(~F.col("short") & (F.col("place") <= enough * share // 100), F.col("place")).cast("long")
    return ranked.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))


def draw(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` whose id was drawn, with all their columns."""
    return docs.join(judge(docs, target, **how).where("rank is not null").select("doc_id").distinct(), "doc_id", "left_semi")
