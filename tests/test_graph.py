"""Literal graphs with known answers, and random graphs against plain Python."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import graph
from ledgerlens.operators.components import connected_components
from ledgerlens.operators.grid import Grid
from ledgerlens.plans import scratch


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "src long, dst long")


def as_dict(df, k, v):
    return {r[k]: r[v] for r in df.collect()}


CYCLES = [(1, 2), (2, 3), (3, 1), (2, 4), (4, 5), (5, 2), (5, 6), (3, 6), (7, 8)]
CORES = [(1, 2), (2, 3), (3, 1), (2, 4), (1, 4), (3, 4), (4, 5), (5, 2), (5, 6), (3, 6), (7, 8)]


def test_degrees(spark):
    e = edges(spark, [(2, 1), (2, 3), (3, 2), (3, 4)])
    v = spark.createDataFrame([(i,) for i in range(1, 7)], "vid long")
    d = {r.vid: (r.in_degree, r.out_degree, r.degree) for r in graph.degrees(e, v).collect()}
    assert d == {1: (1, 0, 1), 2: (1, 2, 3), 3: (1, 2, 3), 4: (1, 0, 1), 5: (0, 0, 0), 6: (0, 0, 0)}


def test_components_and_strong_components(spark):
    e = edges(spark, CYCLES)
    assert as_dict(connected_components(e), "vid", "cc") == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 7, 8: 7}
    assert as_dict(graph.strongly_connected(e), "vid", "scc") == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 6, 7: 7, 8: 8}


def test_components_of_nothing_loops_and_nulls(spark):
    assert connected_components(edges(spark, [])).count() == 0
    assert as_dict(connected_components(edges(spark, [(3, 3), (None, 4), (1, 2), (2, 1)])), "vid", "cc") == {3: 3, 1: 1, 2: 1}


def test_cores(spark):
    e = edges(spark, CORES)
    assert as_dict(graph.k_core_labels(e, 10), "vid", "core") == {1: 3, 2: 3, 3: 3, 4: 3, 5: 2, 6: 2, 7: 1, 8: 1}
    assert as_dict(graph.k_core_degrees(e, 2), "vid", "degree") == {1: 3, 2: 4, 3: 4, 4: 4, 5: 3, 6: 2}
    lone = spark.createDataFrame([(1,), (99,)], "vid long")
    assert as_dict(graph.k_core_labels(e, 3, lone), "vid", "core")[99] == 0


def test_star_has_core_one(spark):
    e = edges(spark, [(0, i) for i in range(1, 42)])
    assert set(as_dict(graph.k_core_labels(e, 6), "vid", "core").values()) == {1}


def test_lone_pairs(spark):
    e = edges(spark, CORES)
    assert graph.without_lone_pairs(e, complement=True).collect() == [(7, 8)]
    assert graph.without_lone_pairs(e).count() == len(CORES) - 1


def test_expansion(spark):
    e = edges(spark, [(1, 2), (3, 2), (3, 4), (4, 5), (9, 8)])
    seeds = spark.createDataFrame([(1,)], "vid long")
    got = lambda n: sorted(r.vid for r in graph.expand(e, seeds, n).collect())
    assert got(1) == [1, 2] and got(2) == [1, 2, 3] and got(9) == [1, 2, 3, 4, 5]


def test_page_rank(spark):
    pairs = [(1, 2), (2, 3), (3, 1), (3, 2), (4, 1)]
    rank = {v: 1.0 for v in range(1, 5)}
    out = {s: sum(a == s for a, _ in pairs) for s in range(1, 5)}
    for _ in range(5):
        rank = {v: 0.15 + 0.85 * sum(rank[a] / out[a] for a, b in pairs if b == v) for v in rank}
    got = as_dict(graph.page_rank(edges(spark, pairs), rounds=5), "vid", "rank")
    assert got == pytest.approx(rank)
    close = as_dict(graph.page_rank(edges(spark, pairs)), "vid", "rank")
    for _ in range(60):
        rank = {v: 0.15 + 0.85 * sum(rank[a] / out[a] for a, b in pairs if b == v) for v in rank}
    assert close == pytest.approx(rank, abs=0.02)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs(spark, seed):
    rnd = random.Random(seed)
    pairs = [(rnd.randrange(40), rnd.randrange(40)) for _ in range(45)]
    vs = {v for p in pairs for v in p}
    reach = {v: {v} for v in vs}
    for _ in vs:
        for a, b in pairs:
            reach[a] |= reach[b]
    scc = {v: min(w for w in vs if w in reach[v] and v in reach[w]) for v in vs}
    assert as_dict(graph.strongly_connected(edges(spark, pairs)), "vid", "scc") == scc
    cc = {v: v for v in vs}
    for _ in vs:
        for a, b in pairs:
            cc[a] = cc[b] = min(cc[a], cc[b])
    assert as_dict(connected_components(edges(spark, pairs)), "vid", "cc") == cc


def test_merge_and_messages(spark):
    e = spark.createDataFrame([(1, 2, 5, "b"), (1, 2, 7, "a"), (2, 1, 1, "c")], "src long, dst long, money long, tag string")
    m = {(r.src, r.dst): (r.money, r.tag) for r in graph.merge_edges(e, ["money"], ["tag"]).collect()}
    assert m == {(1, 2): (12, "a"), (2, 1): (1, "c")}
    assert as_dict(graph.aggregate_messages(e, F.col("money"), None), "vid", "msg") == {2: 12, 1: 1}


def test_long_paths_and_rings(spark):
    """A path of 300 vertices hangs on a ring."""
    n = 300
    rnd = random.Random(3)
    name = rnd.sample(range(1000, 2000), n + 5)
    path = [(name[i], name[i + 1]) for i in range(n - 1)]
    ring = [(name[n - 1], name[n]), (name[n], name[n + 1]), (name[n + 1], name[n - 1])]
    e = spark.createDataFrame(path + ring, "src long, dst long")
    scc = {r.vid: r.scc for r in graph.strongly_connected(e, max_rounds=8).collect()}
    low = min(name[n - 1 : n + 2])
    assert scc == {v: low if v in name[n - 1 : n + 2] else v for v in name[: n + 2]}
    assert {r.vid for r in graph.vertices(graph.k_core(e, 2, max_rounds=20)).collect()} == set(name[n - 1 : n + 2])
    assert {r.vid: r.core for r in graph.k_core_labels(e, None).collect()} == {v: 2 if v in name[n - 1 : n + 2] else 1 for v in name[: n + 2]}


def test_least_ancestor_of_a_long_path(spark):
    n = 300
    e = spark.createDataFrame([(i, i + 1) for i in range(1, n)], "src long, dst long")
    got = graph.least_ancestor(graph.vertices(e), e, max_rounds=15).collect()
    assert {r.vid: r.least for r in got} == {i: 1 for i in range(1, n + 1)}


def test_loops_raise_when_rounds_run_out(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(9)], "src long, dst long")
    v = graph.vertices(e).withColumn("x", F.col("vid"))
    least = lambda **kw: graph.pregel(v, e, "x", F.when(F.col("src_state") < F.col("dst_state"), F.col("src_state")), None, F.min, lambda s, m: F.least(s, m), **kw)
    for loop in (lambda: least(max_rounds=3), lambda: graph.k_core(e, 2, max_rounds=2), lambda: graph.page_rank(e, max_rounds=2), lambda: graph.strongly_connected(e, max_rounds=1), lambda: graph.least_ancestor(v, e, max_rounds=1)):
        with pytest.raises(RuntimeError):
            loop()
    assert {r.vid: r.x for r in least().collect()} == {i: 0 for i in range(10)}
    assert least(patience=2).count() == 10


def plain_cores(pairs):
    alive, core, k = {v for p in pairs for v in p}, {}, 0
    while alive:
        degree = collections.Counter(x for a, b in pairs if a in alive and b in alive for x in (a, b))
        out = {v for v in alive if degree[v] <= k}
        core |= dict.fromkeys(out, k)
        alive -= out
        k += not out
    return core


@pytest.mark.parametrize("chain", [3, 100])
def test_random_cores(spark, chain, monkeypatch):
    """Many small graphs side by side, with parallel edges and self-loops, with chains in every round and in none."""
    monkeypatch.setattr(graph, "CHAIN_ROUNDS", chain)
    rnd = random.Random(5)
    pairs = [(100 * g + rnd.randrange(14), 100 * g + rnd.randrange(14)) for g in range(40) for _ in range(rnd.randrange(1, 60))]
    pairs += [(9000 + i, 9000 + i + d) for i in range(24) for d in (1, 2)]  # a strip: numbers fall from its ends
    want = plain_cores(pairs)
    e = spark.createDataFrame(pairs, "src long, dst long")
    assert {r.vid: r.core for r in graph.k_core_labels(e, None).collect()} == want
    assert {r.vid: r.core for r in graph.core_numbers(e, 3).collect()} == {v: min(c, 3) for v, c in want.items()}


def test_no_search_for_chains_while_many_fall(spark, monkeypatch):
    """Falls are told along the edges from round to round, parallel ones and a hub's included; chains are looked for only once few fall."""
    rnd, searched = random.Random(5), []
    chains = graph._chains
    monkeypatch.setattr(graph, "_chains", lambda *a: searched.append(1) or chains(*a))
    monkeypatch.setattr(graph, "CHAIN_ROUNDS", 2)
    monkeypatch.setattr(graph, "CHAIN_SHARE", 1000)
    pairs = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(260)] + [(0, v) for v in range(100, 200)] + [(v, v + 1) for v in range(100, 130)]
    e = spark.createDataFrame(pairs, "src long, dst long")
    assert {r.vid: r.core for r in graph.core_numbers(e).collect()} == plain_cores(pairs)
    assert not searched


def test_random_strong_components(spark):
    rnd = random.Random(6)
    pairs = [(100 * g + rnd.randrange(14), 100 * g + rnd.randrange(14)) for g in range(40) for _ in range(rnd.randrange(1, 30))]
    reach = {v: {v} for p in pairs for v in p}
    for _ in range(15):
        for a, b in pairs:
            reach[a] |= reach[b]
    got = {r.vid: r.scc for r in graph.strongly_connected(spark.createDataFrame(pairs, "src long, dst long")).collect()}
    assert got == {v: min(w for w in reach[v] if v in reach[w]) for v in reach}


def plain_strong(pairs):
    out = {v: {b for a, b in pairs if a == v} for p in pairs for v in p}

    def reach(v):
        seen, new = {v}, [v]
        while new:
            new = [w for w in {w for u in new for w in out[u]} if w not in seen]
            seen |= set(new)
        return seen

    reached = {v: reach(v) for v in out}
    return {v: min(w for w in reached[v] if v in reached[w]) for v in out}


def test_the_largest_strong_component_is_found_around_one_vertex(spark, monkeypatch):
    """Pivots are looked for only outside it; where what a vertex reaches grows too slowly, they are looked for in all."""
    rnd, asked = random.Random(8), []
    ancestors = graph.least_ancestor
    monkeypatch.setattr(graph, "least_ancestor", lambda v, *a, **k: asked.append(v.count()) or ancestors(v, *a, **k))
    pairs = [(rnd.randrange(80), rnd.randrange(80)) for _ in range(500)] + [(7, 100), (100, 101), (101, 100), (200, 9), (201, 200), (200, 201), (300, 301), (301, 302), (302, 300), (400, 3), (5, 401)]
    e = spark.createDataFrame(pairs, "src long, dst long")
    want = plain_strong(pairs)
    assert {r.vid: r.scc for r in graph.strongly_connected(e).collect()} == want
    assert len(asked) == 1 and asked[0] <= 4 * 7, asked
    asked.clear()
    monkeypatch.setattr(graph, "HUB_GROWTH", 1)
    monkeypatch.setattr(graph, "HUB_SLOW", 0)
    assert {r.vid: r.scc for r in graph.strongly_connected(e).collect()} == want
    assert asked and asked[0] > 4 * 80


def exchanges_over(df, column):
    """How many exchanges stand above a scan that reads the column."""
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.initialPlan().toString() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan.toString()
    found, path = 0, []
    for line in text.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*"))
        path = [p for p in path if p[0] < depth] + [(depth, line)]
        if "Scan parquet" in line and column in line.split("]")[0]:
            found += sum("Exchange" in p[1] for p in path)
    assert column in text
    return found


def test_hub_edges_are_spread_and_stay_where_they_are(spark):
    """90 % of the edges end at one vertex and 5 % start at another."""
    n = 20_000
    star = [(i, -1) for i in range(18 * n // 20)] + [(-2, i) for i in range(n // 20)] + [(i, i + 1) for i in range(n // 20)]
    e = spark.createDataFrame(star, "src long, dst long").withColumn("tag", F.lit(1))
    with scratch.settings(spark, {"spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        g = Grid(e)
        files = [r["count"] for r in g.edges.groupBy(F.input_file_name()).count().collect()]
        assert sum(files) == len(star) and max(files) < len(star) / 4
        state = graph.vertices(e).withColumn("state", F.lit(1)).withColumn("active", F.col("vid") % 2 == 0)
        with g.planned():
            for direction in ("out", "in", "either", "both"):
                sends = graph._active_edges(g, state, direction)
                assert exchanges_over(sends, "tag") == 0
                a, b = F.col("src") % 2 == 0, F.col("dst") % 2 == 0
                want = {"out": a, "in": b, "either": a | b, "both": a & b}[direction]
                assert sends.count() == e.where(want).count()
            assert as_dict(g.messages(state, F.col("src_state")), "vid", "msg") == as_dict(graph.aggregate_messages(e, F.lit(1)), "vid", "msg")
        assert sorted(graph.degrees(g.edges).collect()) == sorted(graph.degrees(e).collect())
        hub = graph.page_rank(e, rounds=2).where("vid = -1").first().rank
    assert hub == pytest.approx(plain_rank(star, 2)[-1])


def plain_rank(pairs, rounds):
    out = collections.Counter(a for a, _ in pairs)
    rank = {v: 1.0 for p in pairs for v in p}
    for _ in range(rounds):
        got = collections.Counter()
        for a, b in pairs:
            got[b] += rank[a] / out[a]
        rank = {v: 0.15 + 0.85 * got[v] for v in rank}
    return rank


def test_rank_by_residuals(spark):
    """Only rises above the tolerance are passed on, and a vertex that gets nothing has no rise."""
    rnd = random.Random(8)
    pairs = [(rnd.randrange(30), rnd.randrange(30)) for _ in range(90)]
    out = collections.Counter(a for a, _ in pairs)
    for tol in (0.2, 0.02, 0.001):
        rank, rise, active = {v: 0.15 for p in pairs for v in p}, {v: 0.15 for p in pairs for v in p}, []
        while any(x > tol for x in rise.values()):
            active.append(sum(x > tol for x in rise.values()))
            got = collections.defaultdict(float)
            for a, b in pairs:
                if rise.get(a, 0) > tol:
                    got[b] += rise[a] / out[a]
            rise = {v: 0.85 * x for v, x in got.items()}
            rank = {v: r + rise.get(v, 0) for v, r in rank.items()}
        assert as_dict(graph.page_rank(edges(spark, pairs), tol=tol), "vid", "rank") == pytest.approx(rank)
    assert active[-1] < active[0]
    assert rank == pytest.approx(plain_rank(pairs, 200), abs=0.02)


@pytest.mark.parametrize("direction", ["out", "in", "either", "both"])
def test_pregel_directions_and_patience(spark, direction):
    """Messages that grow: what is reached depends on which edges send, and patience ends where the counts stand still."""
    rnd = random.Random(9)
    pairs = sorted({(rnd.randrange(20), rnd.randrange(20)) for _ in range(40)})
    start = {v: v for p in pairs for v in p}

    def plain(patience):
        now, active, last, same = dict(start), dict.fromkeys(start, True), None, 0
        while True:
            send = {"out": lambda a, b: active[a], "in": lambda a, b: active[b], "either": lambda a, b: active[a] or active[b], "both": lambda a, b: active[a] and active[b]}[direction]
            msg = {}
            for a, b in pairs:
                if send(a, b):
                    msg[b] = min(msg.get(b, 99), now[a])
            new = {v: min(x, msg.get(v, 99)) for v, x in now.items()}
            active = {v: new[v] != now[v] for v in now}
            now, n = new, sum(active.values())
            same = same + 1 if n == last else 1
            last = n
            if not n or (patience and same >= patience):
                return now

    v = spark.createDataFrame(list(start.items()), "vid long, x long")
    for patience in (None, 2):
        got = graph.pregel(v, edges(spark, pairs), "x", F.col("src_state"), None, F.min, lambda s, m: F.least(s, m), patience=patience, active_direction=direction)
        assert as_dict(got, "vid", "x") == plain(patience)


def test_states_go_only_where_their_edges_lie(spark):
    """A state has no more copies than its vertex has edges, and none is broadcast on the word of a small file; a loop that raises leaves no table."""
    e = edges(spark, [(i, 10_000 + i) for i in range(500)])
    with scratch.scope():
        g = Grid(e)
        state = scratch.keep(graph.vertices(e).withColumn("state", F.lit(1)), "state")
        with g.planned():
            assert g.copies(state, "src", "").count() == 500
            got = g.messages(state, F.col("src_state"))
            assert "Broadcast" not in got._jdf.queryExecution().sparkPlan().toString()
            assert got.count() == 500
        with pytest.raises(RuntimeError):
            graph.page_rank(edges(spark, CYCLES), tol=1e-9, max_rounds=1)
        assert not spark.sql("SHOW TABLES LIKE 'ledgerlens*'").where("isTemporary = false").collect()


def test_small_graphs_lie_in_few_bucket_files(spark, monkeypatch):
    """Core numbers of a small graph: eight bucket files, however many shuffle partitions there are; a larger one has more."""
    pairs = {(i, (i * 7 + k) % 60) for i in range(60) for k in range(1, 4) if i != (i * 7 + k) % 60}
    e = spark.createDataFrame(sorted(pairs), "src long, dst long")
    seen = []
    keep = scratch.keep_bucketed
    monkeypatch.setattr(scratch, "keep_bucketed", lambda df, name, *c, buckets=None, **k: (seen.append(buckets), keep(df, name, *c, buckets=buckets, **k))[1])
    with scratch.settings(spark, {"spark.sql.shuffle.partitions": "40"}):
        assert {r.vid: r.core for r in graph.core_numbers(e).collect()} == plain_cores(pairs)
        assert set(seen) == {8}
        seen.clear()
        monkeypatch.setattr(graph, "CORE_EDGES", 10)
        assert {r.vid: r.core for r in graph.core_numbers(e).collect()} == plain_cores(pairs)
        assert set(seen) == {len(pairs) // 10}
