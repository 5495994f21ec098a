"""op1 and the pipeline's near-duplicate stage against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerlens.llm import bktree, neardup

SCHEMA = "doc_id long, text string, fp string, n long, count long, shard long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in rows], SCHEMA)


def corpus(seed=3, n=60):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, texts = [], []
    for i in range(n):
        if texts and rnd.random() < 0.5:
            t = rnd.choice(texts).split()
            for _ in range(rnd.choice([0, 0, 1, 2, 5])):
                t[rnd.randrange(len(t))] = rnd.choice(words)
            texts.append(" ".join(t))
        else:
            texts.append(" ".join(rnd.choice(words) for _ in range(rnd.choice([3, 40, 120]))))
        rows.append((i, texts[-1]))
    return rows + [(n, ""), (n + 1, None), (n + 2, " \n\t"), (n, ""), (None, "lone words here and there"), (n + 9, "A  b\u00a0c É"), (n + 8, "a b\u00a0c É")]


def test_fingerprint_by_definition(spark):
    for text in ("a b c d e a b c d e", "one two", "", None, "É x\u00a0y Z z z z z z"):
        words = (text or "").encode().lower().split()
        parts = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        if parts:
            got = spark.createDataFrame([(p.decode(),) for p in parts], "s string").select(F.xxhash64("s").alias("h")).collect()
            hs = [r.h % 2**64 for r in got]
        else:
            hs = []
        want = sum(1 << b for b in range(64) if hs and sum(h >> b & 1 for h in hs) * 2 > len(hs))
        assert neardup.simhash(neardup.shingle_hashes(text, 4)) == want


@pytest.mark.parametrize("limit", [4096, 9, 2])
def test_components(spark, limit):
    rows = corpus()
    got = neardup.near_duplicates(docs(spark, rows), limit=limit).collect()
    assert len(got) == len(rows)
    fps = [neardup.simhash(neardup.shingle_hashes(t, 4)) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= 4 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    ids = {}
    for (d, _), k in zip(rows, label):
        ids.setdefault(k, []).append(d)
    low = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    want = sorted((str(d), f"{f:016x}", str(low[k])) for (d, _), f, k in zip(rows, fps, label))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


@pytest.mark.parametrize("low", [20, 40])
def test_dense_fingerprints_are_dealt_again(spark, low):
    """Many fingerprints that agree in all high bits, or in all low ones: copies stay far below rows times rows over the limit, and no link is lost."""
    rnd = random.Random(low)
    base = rnd.getrandbits(64)
    points = {base ^ rnd.getrandbits(low) for _ in range(300)} | {base ^ (rnd.getrandbits(low) << (64 - low)) for _ in range(300)}
    points |= {p ^ sum(1 << b for b in rnd.sample(range(64), rnd.choice([1, 4, 5]))) for p in sorted(points)[:60]}
    points = sorted(points)
    table = spark.createDataFrame([(neardup._signed(p),) for p in points], "fp long")
    limit = 8
    shards = neardup._shards(table, 4, limit)
    assert shards.groupBy("shard", "ci", "cj", "side").count().agg({"count": "max"}).first()[0] <= 4 * limit
    assert set(x.fp for x in shards.select("fp").distinct().collect()) == {neardup._signed(p) for p in points}
    links = [(r.src, r.dst) for r in neardup.fingerprint_links(table, limit=limit).collect()]
    number = {neardup._signed(p): i for i, p in enumerate(points)}
    got, want = list(range(len(points))), list(range(len(points)))

    def root(up, x):
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    def join(up, x, y):
        x, y = root(up, x), root(up, y)
        up[max(x, y)] = min(x, y)

    for a, b in links:
        join(got, number[a], number[b])
    for i, p in enumerate(points):
        for j in range(i):
            if (p ^ points[j]).bit_count() <= 4:
                join(want, i, j)
    assert [root(got, i) for i in range(len(points))] == [root(want, i) for i in range(len(points))]


def test_empty_table(spark):
    assert neardup.near_duplicates(docs(spark, [])).count() == 0
    assert neardup.deduplicate(docs(spark, [])).count() == 0


def test_tree_search():
    rng = np.random.default_rng(1)
    p = rng.integers(0, 2**64, 500, dtype=np.uint64)
    p[250:] = p[:250] ^ (np.uint64(1) << rng.integers(0, 64, 250).astype(np.uint64))
    g = rng.integers(0, 3, 500)
    for r in (0, 2, 9):
        got = {(a, b) for q, n, _ in bktree.Forest(p, g).within(p, g, r) for a, b in zip(q.tolist(), n.tolist())}
        assert got == {(i, j) for i in range(500) for j in range(500) if g[i] == g[j] and int(p[i] ^ p[j]).bit_count() <= r}
    assert not list(bktree.Forest(p[:0], g[:0]).within(p, g, 4))


def brute_groups(rows):
    sets = [set(neardup.shingle_hashes(t, 5).tolist()) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                a, b = sets[i], sets[j]
                if label[i] != label[j] and (a == b or len(a & b) >= 0.8 * len(a | b)):
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    groups = {}
    for (d, _), k in zip(rows, label):
        groups.setdefault(k, []).append(d)
    return sorted(str(min((x for x in v if x is not None), default=None)) for v in groups.values())


@pytest.mark.parametrize("sizes", [(4096, 8192, 16, 256), (3, 4, 2, 2)])
def test_deduplicate(spark, sizes, monkeypatch):
    for name, v in zip(("SET_SHARD", "BLOCK_ROWS", "DELEGATES", "FAN"), sizes):
        monkeypatch.setattr(neardup, name, v)
    rows = corpus(5, 80)
    out = neardup.deduplicate(docs(spark, rows), limit=sizes[0])
    assert out.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert sorted(str(r.doc_id) for r in out.collect()) == brute_groups(rows)


@pytest.mark.parametrize("sizes", [(4096, 8192, 16, 256), (20, 16, 2, 2)])
def test_one_dense_group(spark, sizes, monkeypatch):
    """Copies of one text, each with its own changes: many pairs on either side of the threshold."""
    for name, v in zip(("SET_SHARD", "BLOCK_ROWS", "DELEGATES", "FAN"), sizes):
        monkeypatch.setattr(neardup, name, v)
    rnd = random.Random(11)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(90):
        t = list(base)
        for _ in range(rnd.choice([1, 2, 3, 4])):
            t[rnd.randrange(100)] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    rows += [(100 + i, " ".join(base[:50] + [f"y{i}_{k}" for k in range(60)])) for i in range(40)]
    assert sorted(str(r.doc_id) for r in neardup.deduplicate(docs(spark, rows), limit=sizes[0]).collect()) == brute_groups(rows)


def test_parts_by_definition():
    rng = np.random.default_rng(4)
    for _ in range(30):
        pool = rng.integers(0, 2**64, 60, dtype=np.uint64)
        sets = [np.unique(rng.choice(pool[: rng.choice([8, 20, 60])], rng.integers(1, 40))) for _ in range(40)]
        part = neardup.alike_parts(sets, 0.5)
        label = list(range(40))
        for _ in sets:
            for i in range(40):
                for j in range(i):
                    c = len(np.intersect1d(sets[i], sets[j]))
                    if c >= 0.5 * (len(sets[i]) + len(sets[j]) - c):
                        label[i] = label[j] = min(label[i], label[j])
        assert len(set(zip(part.tolist(), label))) == len(set(part.tolist())) == len(set(label))


def test_bands_and_marks_find_similar_sets():
    """Sets with exactly four fifths in common share a band and half of their marks; dissimilar ones hardly ever do."""
    rng = np.random.default_rng(9)
    shared = np.zeros(BANDS_SEEN := 400)
    for i in range(BANDS_SEEN):
        n = int(rng.choice([5, 45, 450]))
        pool = rng.integers(0, 2**64, n * 2, dtype=np.uint64)
        common, own = pool[: 4 * n // 5], n // 10
        a, b = (np.concatenate([common, pool[n : n + n - len(common)]]), common) if n == 5 else (np.concatenate([common, pool[n : n + own]]), np.concatenate([common, pool[n + own : n + 2 * own]]))
        x, y = (neardup._sketch(np.unique(s)) for s in (a, b))
        assert set(x[2]) & set(y[2])
        shared[i] = len(set(x[2]) & set(y[2]))
        assert (np.array(x[3]).view(np.uint8) == np.array(y[3]).view(np.uint8)).sum() >= neardup.ALIKE
        assert ((x[1] ^ y[1]) & (2**64 - 1)).bit_count() <= neardup.SET_RADIUS
    assert abs(shared.mean() / neardup.BANDS - 0.8**neardup.ROWS) < 0.03


def test_shingle_sets_are_those_of_the_texts():
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice("ab C é".split()) for _ in range(n)) for n in (0, 1, 4, 5, 6, 40)]
    for t in texts:
        for u in texts:
            a, b, c, d = neardup.shingle_set(t, 5), neardup.shingle_set(u, 5), neardup.shingle_hashes(t, 5), neardup.shingle_hashes(u, 5)
            assert len(np.intersect1d(a, b)) == len(np.intersect1d(c, d)) and len(a) == len(np.unique(c))


def near_copies(rnd, base, n):
    out = []
    for _ in range(n):
        t = base.copy()
        t[rnd.integers(0, len(t), 2)] = rnd.integers(0, 2**64, 2, dtype=np.uint64)
        out.append(np.unique(t))
    return out


@pytest.mark.parametrize("groups", [2, 7])
def test_links_grow_with_rows(spark, groups):
    """Tight groups in one cluster of many blocks: links are enough to join each, and their number is linear in rows."""
    rnd = np.random.default_rng(3)
    counts = []
    for n in (60, 240):
        sets = [s for _ in range(groups) for s in near_copies(rnd, rnd.integers(0, 2**64, 60, dtype=np.uint64), n)]
        rows = [(1, len(sets) // 30, i, s.tobytes()) for i, s in enumerate(sets)]
        links = neardup._alike_links(spark.createDataFrame(rows, "cluster long, blocks int, vertex long, hashes binary"), 0.8).collect()
        counts.append(len(links) / len(rows))
        found = bktree.lowest(len(rows), *(np.array([r[k] for r in links]) for k in ("src", "dst")), np.arange(len(rows)))
        part = neardup.alike_parts(sets, 0.8)
        assert len(set(zip(found.tolist(), part.tolist()))) == len(set(part.tolist())) == len(set(found.tolist())) == groups
    assert max(counts) < 4


def test_rows_outside_the_largest_part_meet_all_blocks(spark):
    """Small parts whose only link runs from one block to another: as by comparing all."""
    rnd = np.random.default_rng(5)
    sets = near_copies(rnd, rnd.integers(0, 2**64, 60, dtype=np.uint64), 60)
    for _ in range(60):
        sets += near_copies(rnd, rnd.integers(0, 2**64, 60, dtype=np.uint64), 2)
    rows = [(1, 12, i, s.tobytes()) for i, s in enumerate(sets)]
    links = neardup._alike_links(spark.createDataFrame(rows, "cluster long, blocks int, vertex long, hashes binary"), 0.8).collect()
    found = bktree.lowest(len(rows), *(np.array([r[k] for r in links]) for k in ("src", "dst")), np.arange(len(rows)))
    part = neardup.alike_parts(sets, 0.8)
    assert len(set(zip(found.tolist(), part.tolist()))) == len(set(part.tolist())) == len(set(found.tolist()))


@pytest.mark.parametrize("limit", [100, 4, 2])
def test_a_frequent_band_loses_no_pair(spark, limit):
    """Two alike rows that share no other band than one that many rows have."""
    rnd = np.random.default_rng(7)
    long = lambda n: rnd.integers(-(2**63), 2**63, n).tolist()
    rows = [(i + 1, long(1)[0], [77, *long(neardup.BANDS - 1)], long(neardup.MARKS // 8)) for i in range(20)]
    twin = np.array(rows[3][3]).view(np.uint8).copy()
    twin[rnd.permutation(neardup.MARKS)[:9]] ^= 1  # nine marks differ
    rows.append((50, rows[3][1] ^ 5, [77, *long(neardup.BANDS - 1)], twin.view("<i8").tolist()))
    links = neardup._candidate_links(spark.createDataFrame(rows, "sig long, fp long, bands array<long>, marks array<long>"), neardup.SET_RADIUS, limit)
    assert {frozenset(r) for r in links.collect()} == {frozenset((4, 50))}


def test_long_texts(spark):
    """A text of 400,000 words, and a word of two million letters."""
    rnd = random.Random(1)
    text = " ".join(rnd.choice("abcdefgh") * rnd.randint(1, 3) for _ in range(400_000))
    rows = [(1, text), (2, text + " more"), (3, "z" * 2_000_000), (4, "z")]
    got = {r.doc_id: r for r in neardup.near_duplicates(docs(spark, rows)).collect()}
    assert got[1].component_id == got[2].component_id == 1 and got[3].component_id == 3
    for i, t in rows[2:]:
        assert got[i].fingerprint == f"{neardup.simhash(neardup.shingle_hashes(t, 4)):016x}" == f"{xxhash.xxh64_intdigest(t, 42):016x}"
    words = text.split()
    count = np.zeros(64, np.int64)
    for i in range(len(words) - 3):
        h = np.uint64(xxhash.xxh64_intdigest(" ".join(words[i : i + 4]), 42))
        count += ((h >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.int64)
    assert got[1].fingerprint == f"{sum(1 << int(b) for b in np.flatnonzero(2 * count > len(words) - 3)):016x}"
