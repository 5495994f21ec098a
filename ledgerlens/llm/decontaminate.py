"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over token positions that ignores some of them, so a seed hash
survives substitutions there. Documents' seed hashes are joined with the benchmark's;
around every hit the aligned tokens are compared, and an overlap counts if some window
of 13 tokens (the whole item, if it is shorter) agrees in at least four fifths.

The three masks meet every placement of two substitutions in 13 tokens: some mask, at
some offset, ignores both. Shorter items have masks over their whole length, each without
some blocks of it, so that some mask ignores all substitutions allowed. The benchmark goes to the workers in slices of bounded size,
one pass over the documents for each; a usual benchmark is one slice.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import map_arrow

#: Positions that a mask looks at.
MASKS = ((0, 1, 2, 4, 7, 8), (0, 1, 2, 5, 6, 8), (0, 2, 3, 4, 7, 8))
SPAN = 9
WINDOW = 13
SHARE = 0.8
#: Shorter items (in tokens) are not looked for unless asked: they recur in text of any kind.
LEAST_TOKENS = 5
#: Characters of a slice of the benchmark, about.
SLICE_CHARS = 16_000_000
_TOKEN = re.compile(r"\w+")
#: Scripts written without spaces: Han, kana, bopomofo, Thai, Lao, Tibetan, Burmese, Khmer.
_RANGES = "\u3005-\u3007\u3041-\u3096\u309d-\u309f\u30a1-\u30fa\u30fc-\u30ff\u3105-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
_RANGES += "".join(chr(c) for a, b in ((0x0E00, 0x1000), (0x1000, 0x10A0), (0x1780, 0x1800)) for c in range(a, b) if unicodedata.category(chr(c))[0] in "LM")
_UNSPACED = re.compile(f"[{_RANGES}]")
_CHARACTER_OR_WORD = re.compile(f"[{_RANGES}]|[^\\W{_RANGES}]+")
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)
_FILTER_BITS = 22
#: Hits of seeds that are looked at together.
_SLICE = 1_000_000


def tokens(text: str | None) -> np.ndarray:
    """Process-wide hashes of the lower-cased word tokens; in scripts without spaces each character is one."""
    low = (text or "").lower()
    found = (_TOKEN if low.isascii() or not _UNSPACED.search(low) else _CHARACTER_OR_WORD).findall(low)
    return np.fromiter(map(hash, found), np.int64, len(found)).view(np.uint64)


def _seeds(t: np.ndarray, mask: tuple[int, ...], span: int) -> np.ndarray:
    n = len(t) - span + 1
    h = np.full(max(n, 0), len(mask) * 1000 + span, np.uint64)
    if n > 0:
        for k, at in enumerate(mask):
            h += (t[at : at + n] ^ (t[at : at + n] >> np.uint64(31))) * _FACTORS[k % 6] * np.uint64(2 * (k // 6) + 1)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


def short_masks(n: int) -> list[tuple[int, ...]]:
    """Masks for an item of ``n`` tokens, under 13: whichever tokens are substituted, as many as may be, some mask looks at none of them.

    One substitution: three blocks, of which each mask has two. Two: four blocks, each mask has two. None: all tokens.
    """
    k = n - next(x for x in range(n + 1) if x >= SHARE * n)
    if not k:
        return [tuple(range(n))]
    blocks = [tuple(b.tolist()) for b in np.array_split(np.arange(n), k + 2)]
    return [tuple(x for b in two for x in b) for two in itertools.combinations(blocks, 2)]


class Index:
    """Seeds of a slice of the benchmark: hash, item, position; built in the process that uses it, as token hashes are its own."""

    def __init__(self, items: list[tuple[int, str]], least: int = LEAST_TOKENS):
        self.ids = [i for i, _ in items]
        self.tokens = [tokens(t) for _, t in items]
        lengths = {len(t) for t in self.tokens if len(t) >= max(least, 1)}
        self.masks = [(m, SPAN, WINDOW) for m in MASKS if any(n >= WINDOW for n in lengths)] + [(m, n, n) for n in sorted(lengths) if n < WINDOW for m in short_masks(n)]
        self.tables = []
        for mask, span, length in self.masks:
            hs, who, at = [], [], []
            for k, t in enumerate(self.tokens):
                if len(t) >= WINDOW if length == WINDOW else len(t) == length:
                    h = _seeds(t, mask, span)
                    hs.append(h)
                    who.append(np.full(len(h), k))
                    at.append(np.arange(len(h)))
            h, who, at = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (hs, who, at))
            order = np.argsort(h, kind="stable")
            bits = np.zeros(1 << min(_FILTER_BITS, (256 * len(h)).bit_length()), bool)
            h = h[order].astype(np.uint64)
            bits[h & np.uint64(len(bits) - 1)] = True
            self.tables.append((h, who[order], at[order], bits))

    def overlaps(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item, first token, token after the last, agreeing tokens) of the best verified overlap with each item."""
        t = tokens(text)
        hits = [np.zeros((2, 0), np.int64)]
        for (mask, span, _), (h, who, at, bits) in zip(self.masks, self.tables):
            if not len(h):
                continue
            s = _seeds(t, mask, span)
            p = np.flatnonzero(bits[s & np.uint64(len(bits) - 1)])
            lo, hi = np.searchsorted(h, s[p], "left"), np.searchsorted(h, s[p], "right")
            p, lo, n = p[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            ends, i = np.cumsum(n), 0
            while i < len(p):  # slices of bounded size; a repeated seed meets its place in an item again and again, a shift is kept once
                j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + _SLICE, "right")))
                m = n[i:j]
                k = np.repeat(lo[i:j], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                hits.append(np.unique(np.stack([who[k], np.repeat(p[i:j], m) - at[k]]), axis=1))
                i = j
        pairs = zip(*np.unique(np.concatenate(hits, 1), axis=1).tolist())
        best: dict[int, tuple[int, int, int]] = {}
        for k, shift in pairs:
            item = self.tokens[k]
            a, b = max(0, shift), min(len(t), shift + len(item))
            w = min(WINDOW, len(item))
            if b - a < w:
                continue
            same = t[a:b] == item[a - shift : b - shift]
            sums = np.concatenate(([0], np.cumsum(same)))
            good = np.flatnonzero(sums[w:] - sums[:-w] >= SHARE * w)
            if len(good):
                start, end = int(good[0]), int(good[-1]) + w
                found = (a + start, a + end, int(sums[end] - sums[start]))
                if k not in best or found[2] > best[k][2] or (found[2] == best[k][2] and found < best[k]):
                    best[k] = found
        return sorted((self.ids[k], *v) for k, v in best.items())


_built: dict[int, Index] = {}


def _index(items: list[tuple[int, str]], key: int, least: int) -> Index:
    if key not in _built:
        _built.clear()
        _built[key] = Index(items, least)
    return _built[key]


def slices(benchmark: DataFrame, slice_chars: int = SLICE_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's (item_id, text) in slices of about ``slice_chars`` characters; null ids and texts are left out."""
    b = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").dropna()
    n = -(-(b.agg(F.sum(F.length("text"))).first()[0] or 0) // slice_chars)
    for k in range(n):
        yield sorted((r[0], r[1]) for r in b.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect())


def find(docs: DataFrame, benchmark: DataFrame, slice_chars: int = SLICE_CHARS, least: int = LEAST_TOKENS) -> DataFrame:
    """(doc_id, item_id, start, end, matched, contaminated) for every document and item that overlap; positions count tokens.

    Items under ``least`` tokens are not looked for; under 5, all tokens must agree. A document without overlap has no row. Null and empty texts overlap nothing; repeated rows are
    reported each; an empty benchmark gives an empty result. Other columns are ignored.
    """
    schema = "doc_id long, item_id long, start long, end long, matched long, contaminated boolean"
    kinds = [pa.int64()] * 5 + [pa.bool_()]
    names = [x.split(" ")[0] for x in schema.split(", ")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for items in slices(benchmark, slice_chars):
        key = hash((least, *items))

        def run(batches, items=items, key=key):
            index = _index(items, key, least)
            for b in batches:
                got = [(d, *o, True) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for o in index.overlaps(t)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*got) if got else [()] * 6, kinds)], names=names)

        part = map_arrow(rows, run, schema)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame, slice_chars: int = SLICE_CHARS, least: int = LEAST_TOKENS) -> DataFrame:
    """The rows of ``docs``, all columns, that overlap no item of ``least`` tokens or more.

    Null and empty texts, null ids and repeated rows stay as they come; columns of any name pass through. An empty
    benchmark leaves everything, an empty table stays empty.
    """
    for items in slices(benchmark, slice_chars):
        key = hash((least, *items))

        def run(batches, items=items, key=key):
            index = _index(items, key, least)
            for b in batches:
                yield b.filter(pa.array([not index.overlaps(t) for t in b.column("text").to_pylist()], pa.bool_()))

        docs = map_arrow(docs, run, docs.schema)
    return docs
