"""The graph queries on all transfers against plain Python: small ones count as well as large ones."""

import os

import duckdb
import pytest

from ledgerlens import registry
from ledgerlens.registry import QUERIES

registry.load()
from ledgerlens.sources.transactions import EDGES

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pairs():
    c = duckdb.connect()
    for f in os.listdir(D):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{D}/{f}'")
    return {(a, b): m for a, b, m in c.sql(f"WITH {EDGES} SELECT src, dst, money FROM edges WHERE src <> dst").fetchall()}


@pytest.fixture
def run(spark):
    return lambda name, k="vid", v=None: {r[k]: r[v] if v else tuple(r) for r in QUERIES[name](spark, D).collect()}


def reach(start, after):
    seen, front = set(start), set(start)
    while front:
        front = {w for v in front for w in after.get(v, ())} - seen
        seen |= front
    return seen


def sides(pairs):
    out, back = {}, {}
    for a, b in pairs:
        out.setdefault(a, set()).add(b)
        back.setdefault(b, set()).add(a)
    return out, back


def test_degrees_of_all(run, pairs):
    out, back = sides(pairs)
    want = {v: len(out.get(v, ())) + len(back.get(v, ())) for v in {*out, *back}}
    assert run("vertex_degrees", v="degree") == want


def test_components_of_all(run, pairs):
    out, back = sides(pairs)
    vs = {*out, *back}
    both = {v: out.get(v, set()) | back.get(v, set()) for v in vs}
    assert run("components", v="cc") == {v: min(reach([v], both)) for v in vs}
    assert run("strong_components", v="scc") == {v: min(reach([v], out) & reach([v], back)) for v in vs}
    assert run("pregel_smallest_ancestor", v="least_seen") == {v: min(reach([v], back)) for v in vs}


def cores(pairs):
    """Core number of each vertex: one edge end at a time is peeled off."""
    left, core, k = set(pairs), {}, 0
    while left:
        ends = [v for p in left for v in p]
        low = {v for v in set(ends) if ends.count(v) <= k}
        core |= {v: k for v in low}
        left = {p for p in left if not low & set(p)}
        for v in set(ends) - {v for p in left for v in p}:
            core.setdefault(v, k)
        k += not low
    return core


def test_cores_of_all(run, pairs):
    want = cores(pairs)
    assert max(want.values()) > 5
    assert run("core_labels", v="core") == want
    assert set(run("three_core_degrees", v="degree")) == {v for v, k in want.items() if k >= 3}
    assert run("community_members", v="core") == want


def test_rank_of_all(run, pairs):
    out, back = sides(pairs)
    vs = {*out, *back}
    rank = {v: 1.0 for v in vs}
    for _ in range(6):
        rank = {v: 0.15 + 0.85 * sum(rank[a] / len(out[a]) for a in back.get(v, ())) for v in vs}
    assert run("page_rank_six_rounds", v="rank") == pytest.approx(rank, abs=1e-5)
    for _ in range(300):
        rank = {v: 0.15 + 0.85 * sum(rank[a] / len(out[a]) for a in back.get(v, ())) for v in vs}
    assert run("page_rank_to_tolerance", v="rank") == pytest.approx(rank, abs=0.05)


def test_money_of_communities_is_that_of_all(run, pairs):
    assert sum(run("community_totals", "cc", "money").values()) == sum(pairs.values())
