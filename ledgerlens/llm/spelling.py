"""Spelling variants: words at one edit from each other, each led to a more frequent one.

Two words at one edit agree in all letters before or in all after the middle. So a word goes to four groups, by each half, once among
words of its own length and once among those of one letter more. A group is searched by one task with a wavelet tree for edits
at the positions of the other half; a group too large for that is dealt again by halves of those positions, until
all letters but one agree, and such a group holds no more words than there are letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import map_arrow
from ledgerlens.llm.wavelet import one_edit
from ledgerlens.plans import scratch

LEAST_LETTERS = 5
LEAST_COUNT = 3
TIMES = 2
SLIP = 97
#: Words, and bytes of words, beyond which a group is dealt again.
GROUP_ROWS = 16_384
GROUP_BYTES = 16_000_000
#: Words searched at once by a task, all of whole groups.
SEARCH_ROWS = 65_536
#: Words a task counts before it sends them on, and bytes of text taken apart at once.
COUNTED = 300_000
COUNTED_BYTES = 32_000_000
SLICE = 8_000_000

#: Latin letters in one byte each, A-Z lower-cased; all others are blanks.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
_GROUP = ["width", "first", "last", "rest"]


def runs(text: str) -> Iterator[list[bytes]]:
    """Lower-cased runs of letters, as Latin-1, slice by slice."""
    data = text.encode("latin-1", "replace").translate(_LETTERS)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SLICE) if len(data) - at > SLICE else len(data)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def slipped(run: bytes, seed: int, slip: int) -> bytes:
    """The run, or for one in ``slip`` that without one letter, both by a hash that goes on from ``seed``."""
    h = crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % slip:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, slip: int | None = SLIP) -> DataFrame:
    """(word, n) of ``docs(doc_id, text)``: runs of Latin letters that occur ``least_count`` times or more in all texts.

    With ``slip`` about one occurrence in so many lacks a letter, the same for one word of a document. A null
    text has no words, a null id counts as the empty text, repeated rows count each. Tasks send sums, not occurrences.
    """

    def run(batches):
        total: dict[bytes, int] = {}
        size = 0

        def table():
            names = [w.decode("latin-1") for w in total]
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for b in batches:
            for key, text in zip(b.column("key").to_pylist(), b.column("text").to_pylist()):
                seed = crc32(f"{key or ''}:".encode())
                for part in runs(text or ""):
                    own: dict[bytes, int] = {}
                    for w in part:
                        own[w] = own.get(w, 0) + 1
                    for w, n in own.items():
                        if slip:
                            w = slipped(w, seed, slip)
                        if len(w) >= least_letters:
                            if w not in total:
                                size += len(w)
                            total[w] = total.get(w, 0) + n
                    if len(total) >= COUNTED or size >= COUNTED_BYTES:
                        yield table()
                        total, size = {}, 0
        yield table()

    counts = map_arrow(docs.select(F.col("doc_id").cast("string").alias("key"), "text"), run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _rest(first: Column, last: Column) -> Column:
    """Hash of a word's letters outside the positions first..last-1 of a word of ``width``."""
    after = last + F.when(F.length("word") == F.col("width"), 1).otherwise(0)
    return F.xxhash64(F.left("word", first), F.substring("word", after, F.length("word")))


def _halves(first: Column, last: Column) -> Column:
    middle = ((first + last) / 2).cast("int")
    half = lambda a, b: F.struct(a.alias("first"), b.alias("last"), _rest(a, b).alias("rest"))
    return F.explode(F.array(half(first, middle), half(middle, last)))


def groups(words: DataFrame) -> DataFrame:
    """(width, first, last, rest, word, n): words that agree but for the positions first..last-1, in groups of bounded size."""
    wide = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("width"))
    rows = scratch.keep(wide.select("word", "n", "width", _halves(F.lit(0), F.col("width")).alias("h")).select("width", "h.*", "word", "n"), "groups")
    done = None
    while True:
        large = (F.col("rows") > GROUP_ROWS) | (F.col("rows") * F.col("width") > GROUP_BYTES)
        counts = rows.where(F.col("last") - F.col("first") > 1).groupBy(*_GROUP).agg(F.count("*").alias("rows"))
        again = scratch.keep(counts.where(large).select(*_GROUP, F.lit(True).alias("large")), "large")
        if again.isEmpty():
            return rows if done is None else done.unionByName(rows)
        marked = rows.join(again, _GROUP, "left")
        small = scratch.keep(marked.where("large is null").drop("large"), "groups")
        done = small if done is None else done.unionByName(small)
        deeper = marked.where("large").select("width", "word", "n", _halves(F.col("first"), F.col("last")).alias("h")).select("width", "h.*", "word", "n")
        before, rows = rows, scratch.keep(deeper, "groups")
        scratch.drop(before)


def _search(words: np.ndarray, n: np.ndarray, width: int, group: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
    """Of each word with near ones: how many, and the most frequent of them."""
    found = list(one_edit(words.tolist(), group, width, first, last)) or [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    row, other = (np.concatenate(x) for x in zip(*found))
    text = np.argsort(np.argsort(np.array([w.decode("latin-1") for w in words.tolist()], object), kind="stable"))
    order = np.lexsort((text[other], -n[other], row))
    row, other = row[order], other[order]
    begin = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else np.zeros(0, np.int64)
    near = np.diff(np.append(begin, len(row)))
    name = lambda rows: pa.array([w.decode("latin-1") for w in words[rows].tolist()], pa.string())
    return pa.RecordBatch.from_arrays([name(row[begin]), pa.array(near, pa.int64()), pa.array(n[other[begin]], pa.int64()), name(other[begin])], names=["word", "near", "best_n", "best"])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): words at exactly one edit, and of these the most frequent, of equals the first in code-point order.

    Words without any are absent. ``words(word, n)`` are distinct words of Latin letters.
    """

    def searched(parts):
        keys = [np.concatenate([p[i] for p in parts]) for i in range(4)]
        n = np.concatenate([p[5] for p in parts])
        words = np.concatenate([p[4] for p in parts])
        new = np.concatenate(([True], np.any([k[1:] != k[:-1] for k in keys], 0)))
        group = np.cumsum(new) - 1
        several = np.bincount(group)[group] > 1
        for width in np.unique(keys[0][several]).tolist():
            at = np.flatnonzero(several & (keys[0] == width))
            yield _search(words[at], n[at], width, group[at], keys[1][at], keys[2][at])

    def run(batches):
        held, size = [], 0
        for b in batches:
            if not len(b):
                continue
            text = np.empty(len(b), object)
            text[:] = [w.encode("latin-1") for w in b.column("word").to_pylist()]
            part = [*(b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in _GROUP), text, b.column("n").to_numpy(zero_copy_only=False)]
            if held:  # whole groups that the batch doesn't continue go out once they are many
                last = held[-1]
                same = np.all([p == q[-1] for p, q in zip(part[:4], last[:4])], 0)
                go_on = len(b) if same.all() else int(same.argmin())
                held.append([x[:go_on] for x in part])
                size += int(part[0][:go_on].sum())
                part = [x[go_on:] for x in part]
                if len(part[0]) and (sum(len(h[0]) for h in held) >= SEARCH_ROWS or size >= 2 * GROUP_BYTES):
                    yield from searched(held)
                    held, size = [], 0
            if len(part[0]):
                held.append(part)
                size += int(part[0].sum())
        if held:
            yield from searched(held)

    dealt = groups(words).repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    found = map_arrow(dealt.select(*_GROUP, "word", "n"), run, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where a word's forms ``forms(word, form)`` lead. Forms become more frequent at each step, so there is no way round; steps double each round."""
    now = scratch.keep(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = scratch.keep(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        scratch.drop(now)
        now = new
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = _kept(now.select("word", "root"), now)


def _kept(df: DataFrame, of: DataFrame) -> DataFrame:
    """``df`` with the scratch table that it reads, so that it can be dropped."""
    df._scratch_path = of._scratch_path
    return df


def variants(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, times: int = TIMES, slip: int | None = SLIP) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``vocabulary``.

    A word's form is its most frequent near word if that occurs ``times`` as often or more, its root the
    last word that forms lead to, itself without a form. An empty table has no words.
    """
    words = scratch.keep(vocabulary(docs, least_letters, least_count, slip), "words")
    near = near_words(words)
    better = F.col("best_n") >= times * F.col("n")
    forms = scratch.keep(words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(better, F.col("best")).alias("form"), F.when(better, F.col("best_n")).alias("form_n")), "forms")
    led = roots(forms.where("form is not null"))
    return forms.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
