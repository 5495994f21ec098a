"""SimHash near-duplicate detection with Burkhard-Keller trees.

Fingerprints that differ in at most ``radius`` bits agree wholly in one of
radius + 1 blocks of bits, so shards keyed by (block, value) lose no link. Each
shard holds a tree whose child edges are Hamming distances; a search follows only
edges within the radius. A shard over ``limit`` points is dealt out anew by shares
of the bits in which its points differ, as often as that makes fewer copies than what follows: a shard that is still over the limit
is cut into chunk trees, each sent to the chunks that query it. So no task holds an unbounded group. Only a spanning
star of each shard's links leaves a task, never all pairs of a group.

Trees travel by shuffle and not by broadcast: all trees together grow with the
corpus and have no proven size bound.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import bktree
from ledgerlens.llm.common import join_counted, map_arrow, maybe_among, per_row
from ledgerlens.operators.components import connected_components
from ledgerlens.plans import scratch

RADIUS = 4
#: Points of a tree at most.
SHARD_POINTS = 4096
#: Bits that a shard's fingerprints must differ in to be dealt anew.
LEAST_VARIED = 16
_SEED = 42


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 of every shingle of ``width`` words, repeats included, in text order."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII spaces only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, _SEED)], np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    h = xxhash.xxh64_intdigest
    return np.array([h(joined[a:b], _SEED) for a, b in zip(start[: len(words) - width + 1].tolist(), end[width - 1 :].tolist())], np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """64 bits; a bit is set if it is set in more than half of the hashes; no hash gives 0."""
    n = len(hashes)
    if n == 0:
        return 0
    count = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        part = hashes[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(count * 2 > n, bitorder="little").view("<u8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprints(docs: DataFrame, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): a signed 64-bit SimHash of each row's whole text; null or wordless texts get 0."""

    def run(b):
        return {"doc_id": b.column(0), "fp": [_signed(simhash(shingle_hashes(t, width))) for t in b.column(1).to_pylist()]}

    return per_row(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, "doc_id long, fp long")


def _widths(bits: int, blocks: int) -> list[int]:
    return [bits // blocks + (i < bits % blocks) for i in range(blocks)]


def _masks(varied: Column, radius: int) -> Column:
    """radius + 1 masks that share the bits of ``varied`` out among them."""
    bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftrightunsigned", varied, i).bitwiseAND(F.lit(1).cast("long")) == 1)
    turn = lambda s: F.filter(bits, lambda _, at: at % (radius + 1) == s)
    return F.array(*[F.aggregate(turn(s), F.lit(0).cast("long"), lambda mask, i: mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))) for s in range(radius + 1)])


def _split(rows: DataFrame, radius: int, limit: int) -> DataFrame:
    """(shard, fp) from rows like these: shards that chunks would copy more often than a new deal are dealt anew, again and again.

    The bits in which a shard's fingerprints differ at all are shared out among radius + 1 masks; fingerprints within ``radius`` bits
    agree under one of them. Where fewer than LEAST_VARIED bits differ there are few fingerprints, and the shard stays as it is.
    """
    done = None
    while True:
        rows = scratch.keep(rows, "dealt")
        varied = F.bit_or("fp").bitwiseXOR(F.bit_and("fp"))
        counts = rows.groupBy("shard").agg(F.count("*").alias("rows"), varied.alias("varied"))
        dense = (F.col("rows") > limit * (radius + 1)) & (F.bit_count("varied") >= LEAST_VARIED)
        large = scratch.keep(counts.where(dense).select("shard", "rows", _masks(F.col("varied"), radius).alias("masks")), "dense")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(large, "shard", "left_anti")
        done = small if done is None else done.unionByName(small)
        dealt = join_counted(rows, large, ["shard"], "rows").select("shard", "fp", F.posexplode("masks").alias("s", "mask"))
        rows = dealt.select(F.xxhash64("shard", "s", F.col("fp").bitwiseAND(F.col("mask"))).alias("shard"), "fp")


def _shards(points: DataFrame, radius: int, limit: int) -> DataFrame:
    """(shard, ci, cj, side, fp) of distinct fingerprints: side 1 builds the tree, 2 queries it, 3 does both."""
    blocks, lo = [], 0
    for k, w in enumerate(_widths(64, radius + 1)):
        value = F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << w) - 1))
        blocks.append(F.shiftleft(F.lit(k).cast("long"), 20).bitwiseOR(value))
        lo += w
    tops = points.select(F.explode(F.array(*blocks)).alias("shard"), "fp")
    # the counts have at most one row for each block value, a bound that doesn't grow with the corpus
    hot = scratch.keep(tops.groupBy("shard").count().where(F.col("count") > limit).select("shard"), "hot")
    whole = {"ci": F.lit(0), "cj": F.lit(0), "side": F.lit(3)}
    if hot.isEmpty():
        return tops.select("shard", *[v.alias(k) for k, v in whole.items()], "fp")
    marked = tops.join(F.broadcast(hot.withColumn("hot", F.lit(True))), "shard", "left")
    cold = marked.where("hot is null").select("shard", "fp")
    again = _split(marked.where("hot").select("shard", "fp"), radius, limit)
    return cold.withColumns(whole).unionByName(_chunked(again, limit, "fp"))


def _groups(batches, keys: int, flush):
    """Integer rows sorted by their first ``keys`` columns, handed to ``flush`` in whole groups, many at a time."""
    held: list[np.ndarray] = []
    size = 0
    for batch in batches:
        held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]))
        size += batch.num_rows
        if size >= 1 << 16:
            rows = np.concatenate(held, 1)
            last = np.flatnonzero((rows[:keys] != rows[:keys, -1:]).any(0))
            to = last[-1] + 1 if len(last) else 0  # the last group may go on
            if to:
                yield flush(np.ascontiguousarray(rows[:, :to]))
            held, size = [rows[:, to:]], 0 if to else rows.shape[1]
    if held and (rows := np.concatenate(held, 1)).shape[1]:
        yield flush(np.ascontiguousarray(rows))


def _stars(vertex: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    out = np.unique(np.stack([vertex, label], 1)[vertex != label], axis=0)
    return pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], names=["src", "dst"])


def _links(batches, radius: int):
    """Stars of linked vertices from rows (shard, ci, cj, side, fp, vertex) sorted by shard, ci, cj."""

    def flush(rows):
        shard, ci, cj, side, fp, vertex = rows
        group = np.cumsum(np.concatenate(([True], (shard[1:] != shard[:-1]) | (ci[1:] != ci[:-1]) | (cj[1:] != cj[:-1]))))
        tree, ask = np.flatnonzero(side & 1), np.flatnonzero(side & 2)
        points = fp.view(np.uint64)
        forest = bktree.Forest(points[tree], group[tree])
        a, b = [], []
        for q, p, _ in forest.within(points[ask], group[ask], radius):
            x, y = ask[q], tree[p]
            a.append(x[x != y])
            b.append(y[x != y])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
        return _stars(vertex, bktree.lowest(len(fp), a, b, vertex))

    return _groups(batches, 3, flush)


def _deal(rows: DataFrame, radius: int) -> DataFrame:
    dealt = rows.repartition("shard", "ci", "cj").sortWithinPartitions("shard", "ci", "cj").select("shard", "ci", "cj", "side", "fp", "vertex")
    return map_arrow(dealt, lambda it: _links(it, radius), "src long, dst long")


def _chunked(rows: DataFrame, limit: int, key: str) -> DataFrame:
    """``rows(shard, ...)`` with ci, cj and side: shards of more than ``limit`` rows are cut into chunks, each pair of which meets once."""
    large = scratch.keep(rows.groupBy("shard").count().where(F.col("count") > limit).withColumn("chunks", F.ceil(F.col("count") / limit).cast("int")).select("shard", "chunks"), "large")
    whole = lambda d: d.withColumns({"ci": F.lit(0), "cj": F.lit(0), "side": F.lit(3)})
    if large.isEmpty():
        return whole(rows)
    c = F.pmod(F.xxhash64(key), F.col("chunks")).cast("int")
    cut = rows.join(large, "shard").withColumn("c", c).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    cut = cut.withColumns({"ci": F.least("c", "o"), "cj": F.greatest("c", "o"), "side": F.when(F.col("c") == F.col("o"), 3).when(F.col("c") < F.col("o"), 1).otherwise(2)}).drop("c", "o", "chunks")
    return whole(rows.join(large, "shard", "left_anti")).unionByName(cut)


def fingerprint_links(points: DataFrame, radius: int = RADIUS, limit: int = SHARD_POINTS) -> DataFrame:
    """Links (src, dst) that connect whatever distinct fingerprints ``points(fp)`` differ in at most ``radius`` bits.

    Transitively complete: two fingerprints are joined by a path of these links exactly if
    they are joined by a path of pairs within the radius. Null fingerprints are ignored.
    """
    return _deal(_shards(points.where("fp is not null"), radius, limit).withColumn("vertex", F.col("fp")), radius)


def near_duplicates(docs: DataFrame, width: int = 4, radius: int = RADIUS, limit: int = SHARD_POINTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    component_id is the smallest id in the row's group of linked fingerprints. Empty and null
    texts share fingerprint zero. A null id keeps its row and is never a component_id unless all
    ids of the group are null. Repeated rows are returned as often as they come. Other columns are ignored.
    """
    prints = scratch.keep(fingerprints(docs, width, id_col, text_col), "fp")
    classes = scratch.keep(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")), "classes")
    links = scratch.keep(fingerprint_links(classes.select("fp"), radius, limit), "links")
    groups = scratch.keep(connected_components(links).withColumnsRenamed({"vid": "fp", "cc": "root"}), "groups")
    lowest = groups.join(classes, "fp").groupBy("root").agg(F.min("first_id").alias("group_id"))
    table = classes.join(groups.join(lowest, "root").select("fp", "group_id", F.lit(True).alias("linked")), "fp", "left").select("fp", "n", F.when(F.col("linked"), F.col("group_id")).otherwise(F.col("first_id")).alias("component_id"))
    return join_counted(prints, scratch.keep(table, "table"), ["fp"], "n").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# Near duplicates by similarity of shingle sets

#: A text's minimum hashes in bands of ROWS: texts with four fifths of their shingles in common share no band in 1 of a million cases.
ROWS, BANDS = 4, 26
#: Bits that the fingerprints of such texts may differ in; a tree search goes no farther.
SET_RADIUS = 26
#: Of MARKS minimum hashes one byte each is kept, in longs; candidates must agree in ALIKE of them.
MARKS, ALIKE = 48, 24
#: Rows of a tree at most; shards with more are dealt anew by a second band.
SET_SHARD = 4096
#: Rows, and hashes in them, that are compared in one task, about.
BLOCK_ROWS, BLOCK_HASHES = 8192, 4_000_000
#: Rows that stand for each of a block's STANDING largest parts when blocks of one cluster are compared, and blocks that meet in one task.
DELEGATES, STANDING, FAN = 4, 32, 64
#: Disjoint pairs of marks by which a band of too many rows is dealt anew.
MARK_PAIRS = MARKS // 2
_MIX = np.random.default_rng(_SEED).integers(0, 1 << 63, ROWS * BANDS, np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = np.random.default_rng(_SEED + 1).integers(0, 1 << 63, (ROWS, BANDS), np.uint64) * np.uint64(2) + np.uint64(1)
_PAIRS = 100_000


def _stir(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted 64-bit ids of the distinct shingles of ``width`` words, each made of its words' hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = max(1, len(w) - width + 1)
    h = np.full(n, min(width, len(w)), np.uint64)
    for k in range(min(width, len(w))):
        h = _stir(h ^ w[k : k + n]) + np.uint64(k)
    return np.unique(h)


def _sketch(hashes: np.ndarray) -> tuple[int, int, list[int], list[int]]:
    """(class of the shingle set, fingerprint, band keys, marks) of distinct sorted hashes."""
    if not len(hashes):
        return 0, 0, [0] * BANDS, [0] * (MARKS // 8)
    low = np.full(len(_MIX), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 1 << 11):
        low = np.minimum(low, (hashes[None, i : i + (1 << 11)] * _MIX[:, None]).min(1))
    keys = _stir((low.reshape(ROWS, BANDS) * _FOLD).sum(0) + np.arange(BANDS, dtype=np.uint64))
    marks = (_stir(low[:: len(low) // MARKS][:MARKS]) >> np.uint64(56)).astype(np.uint8)
    return _signed(xxhash.xxh64_intdigest(hashes.tobytes(), _SEED)), _signed(simhash(hashes)), keys.view(np.int64).tolist(), marks.view("<i8").tolist()


def _candidates(batches, radius: int):
    """Stars of rows that may be alike, from rows (shard, fp, vertex, marks ...) sorted by shard."""

    def flush(rows):
        first = np.concatenate(([True], rows[0, 1:] != rows[0, :-1]))
        group = np.cumsum(first)
        rows = rows[:, np.bincount(group)[group] > 1]
        if not rows.shape[1]:
            return _stars(rows[2], rows[2])
        shard, fp, vertex = rows[:3]
        marks, points = np.ascontiguousarray(rows[3:].T).view(np.uint8), np.ascontiguousarray(fp).view(np.uint64)
        forest = bktree.Forest(points, shard)

        def alike(x, y):
            parts = [(marks[x[i : i + _PAIRS]] == marks[y[i : i + _PAIRS]]).sum(1) >= ALIKE for i in range(0, len(x), _PAIRS)]
            return np.concatenate(parts) if parts else np.zeros(0, bool)

        # rows that fit their tree's root are joined by it, whatever else they fit; only the others search
        every, root = np.arange(len(fp)), forest.roots[np.searchsorted(forest.groups, shard)]
        near = (bktree.distance(points, points[root]) <= radius) & alike(every, root)
        a, b = [every[near]], [root[near]]
        ask = np.flatnonzero(~near)
        for q, p, _ in forest.within(points[ask], shard[ask], radius):
            ok = alike(ask[q], p)
            a.append(ask[q][ok])
            b.append(p[ok])
        return _stars(vertex, bktree.lowest(len(fp), np.concatenate(a), np.concatenate(b), vertex))

    return _groups(batches, 1, flush)


def _apart(rows: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """``rows(shard, ...)`` of shards that surely have at most ``limit`` rows, and the rest: those of larger ones and a few by chance."""
    large = scratch.keep(rows.groupBy("shard").count().where(F.col("count") > limit).select("shard"), "large")
    told = maybe_among(rows, large, "shard")
    return told.where("not __maybe").drop("__maybe"), told.where("__maybe").drop("__maybe")


def _candidate_links(classes: DataFrame, radius: int, limit: int) -> DataFrame:
    """Links (src, dst) among the classes that may be alike, some by way of a vertex that stands for a shard.

    Shards are bands. What shares a band with more than ``limit`` rows is dealt by that band and each of MARK_PAIRS pairs of marks: two rows of which
    four fifths are alike agree in none of these in 2 of 100 thousand million cases, so a band counts as much where it is frequent as elsewhere.
    What shares band and pair with more than ``limit`` rows counts as alike without a search.
    """
    marks = [F.get("marks", F.lit(i)).alias(f"m{i}") for i in range(MARKS // 8)]
    payload = ["shard", "fp", "vertex", *[f"m{i}" for i in range(MARKS // 8)]]
    rows = classes.where("sig <> 0").select(F.explode("bands").alias("shard"), "fp", F.col("sig").alias("vertex"), *marks)
    few, many = _apart(rows, limit)
    pair = lambda j: F.shiftrightunsigned(f"m{j // 4}", 16 * (j % 4)).bitwiseAND(F.lit(0xFFFF).cast("long"))
    again = many.withColumn("shard", F.explode(F.array(*[F.xxhash64("shard", F.lit(j), pair(j)) for j in range(MARK_PAIRS)])))
    few_again, dense = _apart(again, limit)
    dealt = few.select(payload).unionByName(few_again.select(payload)).repartition("shard").sortWithinPartitions("shard")
    return map_arrow(dealt, lambda it: _candidates(it, radius), "src long, dst long").unionByName(dense.select(F.col("vertex").alias("src"), F.col("shard").alias("dst")))


class _Sets:
    """Sets of hashes, held as small local ids, in ascending order of size."""

    def __init__(self, sets: list[np.ndarray]):
        size = np.array([len(s) for s in sets], np.int64)
        self.rows = np.argsort(size, kind="stable")
        self.size = size[self.rows]
        self.known, ids = np.unique(np.concatenate([sets[i] for i in self.rows]), return_inverse=True)
        self.ids = ids.astype(np.int32)
        self.start = np.concatenate(([0], np.cumsum(self.size)))
        self.mark = np.zeros(len(self.known), bool)

    def own(self, i: int) -> np.ndarray:
        return self.ids[self.start[i] : self.start[i + 1]]

    def alike_to(self, hashes: np.ndarray, similarity: float, left: np.ndarray) -> np.ndarray:
        """Like ``alike`` for a set from elsewhere, given by its distinct sorted hashes."""
        at = np.searchsorted(self.known, hashes)
        own = at[self.known[np.minimum(at, len(self.known) - 1)] == hashes].astype(np.int32)
        return self.alike(own, similarity, left, len(hashes))

    def alike(self, own: np.ndarray, similarity: float, left: np.ndarray | None = None, n: int | None = None) -> np.ndarray:
        """Places of the sets that are alike to ``own``; among ``left`` only, which ascends."""
        n = len(own) if n is None else n
        size = self.size if left is None else self.size[left]
        lo, hi = np.searchsorted(size, similarity * n - 1e-9, "left"), np.searchsorted(size, n / similarity + 1e-9, "right")
        if lo == hi:
            return np.zeros(0, np.int64)
        where = np.arange(lo, hi) if left is None else left[lo:hi]
        size = size[lo:hi]
        self.mark[own] = True
        if len(where) == where[-1] - where[0] + 1:
            flat = self.ids[self.start[where[0]] : self.start[where[-1] + 1]]
        else:
            end = np.cumsum(size)
            flat = self.ids[np.repeat(self.start[where] - end + size, size) + np.arange(end[-1])]
        common = np.add.reduceat(self.mark[flat].astype(np.int32), np.cumsum(size) - size)
        self.mark[own] = False
        return where[common >= similarity * (n + size - common)]


def alike_parts(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """For each of the non-empty sets the number of its part: sets are in one if a chain of sets that are alike joins them.

    A set that has been reached is not compared again but as the one that asks, so a dense group costs little more than its strays.
    """
    s = _Sets(sets)
    part = np.full(len(sets), -1, np.int64)
    left = np.arange(len(sets))
    parts = 0
    while len(left):
        queue = [int(left[0])]
        part[s.rows[queue[0]]] = parts
        left = left[1:]
        while queue and len(left):
            hit = s.alike(s.own(queue.pop()), similarity, left)
            if len(hit):
                part[s.rows[hit]] = parts
                left = left[~np.isin(left, hit, assume_unique=True)]
                queue += hit.tolist()
        parts += 1
    return part


def _blocks(batches, keys: int):
    """Rows of one block after the other, from batches sorted by their first ``keys`` columns."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield key, rows


_PARTS = "cluster long, block int, blocks int, vertex long, part long, hashes binary"


def _compared(batches, similarity: float):
    """The part of every row of a block, named by its least vertex; of blocks that are not alone in their cluster, delegates keep their sets."""
    names, kinds = [x.split(" ")[0] for x in _PARTS.split(", ")], [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    for (cluster, block), rows in _blocks(batches, 2):
        rows.sort(key=lambda r: r[1])
        part = alike_parts([np.frombuffer(r[2], np.uint64) for r in rows], similarity)
        least: dict[int, int] = {}
        for p, r in zip(part.tolist(), rows):
            least.setdefault(p, r[1])
        best = np.argsort(-np.bincount(part), kind="stable")[:STANDING] if rows[0][0] > 1 else ()
        sent = {i for p in best for i in np.flatnonzero(part == p)[:DELEGATES].tolist()}
        out = [(cluster, block, r[0], r[1], least[p], r[2] if i in sent else None) for i, (p, r) in enumerate(zip(part.tolist(), rows))]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


class _Joined:
    """Labels, and which of them links have joined so far."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _strays(batches, similarity: float):
    """Links between the labels of strays (side 1) and of rows of a block (side 0) that are alike; none that follows from those before it.

    A block comes before its strays, which pass by one at a time. So a task holds one block, and sends fewer links than it met labels.
    """
    for _, rows in _by_block(batches):
        block, joined, sets, out = [], _Joined(), None, []
        for side, label, hashes in rows:
            own = np.frombuffer(hashes, np.uint64)
            if side == 0:
                block.append((label, own))
                continue
            if sets is None:
                sets = _Sets([h for _, h in block]) if block else ()
                labels = np.array([block[i][0] for i in sets.rows], np.int64) if block else np.zeros(0, np.int64)
            if not len(labels):
                continue
            known, at = np.unique(labels, return_inverse=True)
            open_ = np.array([joined.root(x) != joined.root(label) for x in known.tolist()])[at]
            left = np.flatnonzero(open_)
            if len(left):
                for x in np.unique(labels[sets.alike_to(own, similarity, left)]).tolist():
                    if joined.join(label, x):
                        out.append((label, x))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["src", "dst"])


def _by_block(batches):
    """(key, rows) of each block, rows (side, label, hashes) as they come; batches are sorted by cluster, block and side."""
    rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
    for key, of in itertools.groupby(rows, key=lambda r: r[:2]):
        yield key, (r[2:] for r in of)


def _deal_sets(rows: DataFrame, keys: list[str], fn, schema: str) -> DataFrame:
    return map_arrow(rows.repartition(*keys).sortWithinPartitions(*keys), fn, schema)


def _alike_links(sets: DataFrame, similarity: float) -> DataFrame:
    """Links that join whatever rows of ``sets(cluster, blocks, vertex, hashes)`` of one cluster are alike, exactly.

    Every row is compared within its block. Delegates of each block's largest parts are compared in turn, in groups of
    blocks, until a cluster's blocks have met. What is then outside its cluster's largest part goes to every block of the cluster, where
    it is compared with the rows of other parts; a task tells at most one link for each part it met.
    """
    spot = F.pmod(F.xxhash64("vertex"), F.col("blocks")).cast("int")
    sets = sets.withColumn("block", spot)
    columns = ["cluster", "block", "blocks", "vertex", "hashes"]
    found = scratch.keep(_deal_sets(sets.select(columns), ["cluster", "block"], lambda it: _compared(it, similarity), _PARTS), "parts")
    every, links = found, found.select(F.col("vertex").alias("src"), F.col("part").alias("dst"))
    while True:
        up = found.where("hashes is not null").withColumns({"block": F.floor(F.col("block") / FAN).cast("int"), "blocks": F.ceil(F.col("blocks") / FAN).cast("int")})
        found = scratch.keep(_deal_sets(up.select(columns), ["cluster", "block"], lambda it: _compared(it, similarity), _PARTS), "delegates")
        links = links.unionByName(found.select(F.col("vertex").alias("src"), F.col("part").alias("dst")))
        if found.where("hashes is not null").isEmpty():
            break
    many = every.where("blocks > 1").select("cluster", "block", "vertex", "part")
    named = scratch.keep(connected_components(links.join(many.select(F.col("vertex").alias("src")), "src", "left_semi")).withColumnsRenamed({"vid": "vertex", "cc": "label"}), "labels")
    labels = scratch.keep(many.join(named, "vertex", "left").select("cluster", "vertex", F.coalesce("label", "vertex").alias("label")), "many")
    # one row a cluster that has several blocks
    largest = labels.groupBy("cluster", "label").agg(F.count("*").alias("n")).groupBy("cluster").agg(F.max_by("label", F.struct("n", "label")).alias("largest"), (F.sum("n") - F.max("n")).alias("strays"), F.sum("n").alias("n")).where("strays > 0").drop("strays")
    told = join_counted(labels, scratch.keep(largest, "largest"), ["cluster"], "n").select("vertex", "label", (F.col("label") != F.col("largest")).alias("stray"))
    with_sets = scratch.keep(sets.join(told, "vertex"), "told")
    stray = with_sets.where("stray").withColumns({"side": F.lit(1), "block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))})
    columns = ["cluster", "block", "side", "label", "hashes"]
    met = with_sets.withColumn("side", F.lit(0)).select(columns).unionByName(stray.select(columns))
    dealt = met.repartition("cluster", "block").sortWithinPartitions("cluster", "block", "side")
    more = map_arrow(dealt, lambda it: _strays(it, similarity), "src long, dst long")
    return links.unionByName(more).where("src <> dst")


def row_key() -> Column:
    """128 bits that tell rows of different id or text apart."""
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("text").isNull().cast("string"), F.coalesce("text", F.lit("")))))


def near_groups(docs: DataFrame, width: int = 5, similarity: float = 0.8, radius: int = SET_RADIUS, limit: int = SET_SHARD) -> tuple[DataFrame, DataFrame]:
    """Groups of rows of ``docs(doc_id, text)`` linked by shingle sets with a Jaccard similarity of at least ``similarity``.

    Returns (members(rk, doc_id, sig), groups(sig, keep, n)): a row's key is a hash of its id and text, its class
    stands for its set of shingles, and ``keep`` is the key of the row of the group's smallest id.

    Shards are bands of minimum hashes. Each shard's tree gives candidates within ``radius`` bits, which must also
    agree in half of their marks; linked candidates form clusters, and within these, in tasks of bounded size, the sets
    themselves are compared. The sizes behind SHARD and BLOCK decide where work is done, never which links are found.
    """
    rk = row_key()

    def sketches(b):
        sets = [shingle_set(t, width) for t in b.column(2).to_pylist()]
        got = [_sketch(s) for s in sets]
        return {"rk": b.column(0), "doc_id": b.column(1), "sig": [g[0] for g in got], "fp": [g[1] for g in got], "bands": [g[2] for g in got], "marks": [g[3] for g in got], "size": [len(s) for s in sets]}

    rows = scratch.keep(per_row(docs.select(rk.alias("rk"), F.col("doc_id").cast("long").alias("doc_id"), "text"), sketches, "rk binary, doc_id long, sig long, fp long, bands array<long>, marks array<long>, size long"), "sketch")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.col("rk").alias("rk"))
    classes = scratch.keep(rows.groupBy("sig").agg(F.min(order).alias("first"), *[F.first(c).alias(c) for c in ("fp", "bands", "marks", "size")], F.count("*").alias("n")), "classes")
    candidates = scratch.keep(_candidate_links(classes, radius, limit), "candidates")
    clusters = scratch.keep(connected_components(candidates).withColumnsRenamed({"vid": "sig", "cc": "cluster"}), "clusters")
    members = scratch.keep(clusters.join(classes, "sig").select(F.col("first.rk").alias("rk"), F.col("sig").alias("vertex"), "cluster", "size"), "members")
    per = members.groupBy("cluster").agg(F.count("*").alias("n"), F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("size") / BLOCK_HASHES)).cast("int").alias("blocks")).where("n > 1")
    placed = scratch.keep(join_counted(members, scratch.keep(per, "per"), ["cluster"], "n").select("rk", "vertex", "cluster", "blocks"), "placed")

    def sets(b):
        return {"cluster": b.column(0), "blocks": b.column(1), "vertex": b.column(2), "hashes": [shingle_set(t, width).tobytes() for t in b.column(3).to_pylist()]}

    # rows that repeat id and text have one key; one of them will do
    texts = maybe_among(docs.withColumn("rk", rk).select("rk", "text"), placed, "rk").where("__maybe").join(placed, "rk").dropDuplicates(["rk"]).select("cluster", "blocks", "vertex", "text")
    compared = scratch.keep(per_row(texts, sets, "cluster long, blocks int, vertex long, hashes binary"), "sets")
    links = scratch.keep(_alike_links(compared, similarity), "links")
    groups = scratch.keep(connected_components(links).withColumnsRenamed({"vid": "sig", "cc": "root"}), "groups")
    best = groups.join(classes, "sig").groupBy("root").agg(F.min("first").alias("best"))
    linked = groups.join(best, "root").select("sig", F.col("best.rk").alias("best"))
    return rows.select("rk", "doc_id", "sig"), classes.join(linked, "sig", "left").select("sig", F.coalesce("best", F.col("first.rk")).alias("keep"), "n")


def deduplicate(docs: DataFrame, width: int = 5, similarity: float = 0.8, radius: int = SET_RADIUS, limit: int = SET_SHARD) -> DataFrame:
    """``docs``, all columns, with one row of each group of near duplicates: that of its smallest id.

    Null and empty texts are one group. Rows that repeat id and text are one row afterwards. A null id ranks last.
    """
    rows, groups = near_groups(docs, width, similarity, radius, limit)
    groups = scratch.keep(groups, "keeps")
    gone = scratch.keep(join_counted(rows, groups, ["sig"], "n").where("rk <> keep").select("rk").distinct(), "gone")
    twice = scratch.keep(rows.groupBy("rk").count().where("count > 1").select("rk"), "twice")
    listed = gone.unionByName(twice).withColumnRenamed("rk", "__rk")
    # the input's columns travel in one, so that their names can't clash with the ones used here
    packed = docs.select(row_key().alias("__rk"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    keyed = maybe_among(packed, listed, "__rk")
    # texts of rows that are surely on neither list are not shuffled
    kept, some = keyed.where("not __maybe").select("__row.*"), keyed.where("__maybe").drop("__maybe")
    left = some.join(gone.withColumnRenamed("rk", "__rk"), "__rk", "left_anti")
    again = twice.withColumnRenamed("rk", "__rk")
    once = left.join(again, "__rk", "left_anti").unionByName(left.join(again, "__rk").dropDuplicates(["__rk"]))
    return kept.unionByName(once.select("__row.*"))
