"""Language identification with a bit-sliced Bloom filter of character n-grams.

One filter per language, all of the same length and hash functions, stored the
other way round: a slot holds one bit per language, so the AND of a gram's slots
is the set of all languages that contain it. A text's per-language popcounts,
less the hits that the filter's own fill makes expected by chance, decide.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import fold, map_arrow, per_row, sample_labelled

#: Training documents of each language at most, about; the filters are fitted on these.
DOCS_PER_LANGUAGE = 2000
#: Most frequent grams of each language that its filter holds.
GRAMS_PER_LANGUAGE = 60_000
#: A gram belongs to a language if its rate there is this share of its highest rate in any.
RATE_SHARE = 0.2
SIZES = (3, 4)
HASHES = 3
SLOT_BITS = 22
_PIECE = 1 << 20
_PRIMES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For every code point its lower case (non-letters: a space) and whether it is a letter."""
    low, letter = np.full(0x110000, 32, np.uint32), np.zeros(0x110000, bool)
    for i in range(0x110000):
        if (c := chr(i)).isalpha():
            letter[i] = True
            low[i] = ord(x) if len(x := c.lower()) == 1 else i
    return low, letter


def grams(text: str | None):
    """Hash arrays of all n-grams of the lower-cased letters and word edges, in bounded pieces."""
    low, letter = _tables()
    cp = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    if not letter[cp].any():
        return
    cp = np.concatenate(([32], low[cp], [32])).astype(np.uint64)
    for at in range(0, len(cp), _PIECE):
        part = cp[at : at + _PIECE + max(SIZES) - 1]
        for n in SIZES:
            to = min(_PIECE, len(part) - n + 1)
            if to <= 0:
                continue
            h = np.full(to, n, np.uint64)
            blank = np.ones(to, bool)
            for k in range(n):
                h += part[k : k + to] * _PRIMES[k]
                blank &= part[k : k + to] == 32
            h = h[~blank]
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(32)
            if len(h):
                yield h


class Filters:
    """Bloom filters of all languages, one bit plane word of eight languages after the other."""

    def __init__(self, languages: list[str], hashes: list[np.ndarray], slot_bits: int = SLOT_BITS):
        self.languages, self.mask = languages, np.uint64((1 << slot_bits) - 1)
        self.planes = np.zeros(((len(languages) + 7) // 8, 1 << slot_bits), np.uint8)
        for k, h in enumerate(hashes):
            for s in self._slots(h):
                self.planes[k // 8][s] |= np.uint8(1 << (k % 8))
        fill = [float(((self.planes[k // 8] >> (k % 8)) & 1).mean()) for k in range(len(languages))]
        self.chance = np.array(fill) ** HASHES
        self._bits = (np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1

    def _slots(self, h: np.ndarray):
        step = (h >> np.uint64(33)) | np.uint64(1)
        for i in range(HASHES):
            yield (h + np.uint64(i) * step) & self.mask

    def hits(self, h: np.ndarray) -> np.ndarray:
        """For each language, how many of the grams its filter holds (chance hits included)."""
        out = np.zeros(len(self.planes) * 8, np.int64)
        slots = list(self._slots(h))
        for p, plane in enumerate(self.planes):
            found = plane[slots[0]]
            for s in slots[1:]:
                found = found & plane[s]
            out[8 * p : 8 * p + 8] = np.bincount(found, minlength=256) @ self._bits
        return out[: len(self.languages)]

    def predict(self, text: str | None) -> tuple[str, float]:
        n, hits = 0, np.zeros(len(self.languages), np.int64)
        for h in grams(text):
            n += len(h)
            hits += self.hits(h)
        if n == 0 or not self.languages:
            return "und", 0.0
        sure = np.maximum(0.0, (hits - n * self.chance) / (1 - self.chance))
        share = (sure + 0.5) / (sure + 0.5).sum()
        best = int(share.argmax())
        return self.languages[best], float(share[best])


def fit(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE, per_filter: int = GRAMS_PER_LANGUAGE) -> Filters:
    """Filters from ``docs(doc_id, text, lang)``; rows with null lang or id teach nothing. Over 256 languages raise.

    Of a language's sampled grams those seen three times or more and typical of it are held, the ``per_filter`` most frequent. This bounds
    what comes to the driver, 256 times per_filter hashes, and the planes, 32 of them. On the test tables no language has
    more, so the bound leaves nothing out there.
    """

    def count(batches):
        for b in batches:
            by: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by.setdefault(lang, []).extend(grams(text))
            for lang, hs in by.items():
                g, n = np.unique(np.concatenate(hs) if hs else np.zeros(0, np.uint64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    counts = map_arrow(sample_labelled(docs.select("doc_id", "lang", "text"), "lang", per_language, "langid").select("lang", "text"), count, "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).where("n >= 3")
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rated = counts.join(total, "lang").withColumn("rate", F.col("n") / F.col("total"))
    top = rated.withColumn("most", F.max("rate").over(Window.partitionBy("gram"))).where(F.col("rate") >= RATE_SHARE * F.col("most"))
    kept = top.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("k") <= per_filter)
    table = kept.select("lang", "gram").toArrow()  # bounded by languages and per_filter
    langs, gram = np.array(table.column(0).to_pylist(), object), table.column(1).to_numpy().view(np.uint64)
    names = sorted(set(langs))
    return Filters(names, [gram[langs == x] for x in names])


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row; null and letterless texts give `und` and 0."""

    def run(b):
        found = [filters.predict(t) for t in b.column(2).to_pylist()]
        return {"doc_id": b.column(0), "held_out": b.column(1), "lang_pred": [x for x, _ in found], "score": [x for _, x in found]}

    return per_row(docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold() == 0).alias("held_out"), "text"), run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows outside the held-out fold and predict every row.

    A null id counts as the empty text in the fold rule. Repeated rows are predicted each.
    No learnable row: every text is `und` with score 0. Other columns are ignored.
    """
    return predict(docs, fit(docs.where(fold() != 0)))
