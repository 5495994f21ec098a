"""Graphs as edge tables (src, dst, ...): degrees, pruning, cores, ranks and reachability.

Loops keep their state in tables under the checkpoint folder, so a plan never grows with
the rounds and lost executors cost no more than a stage.
"""

from __future__ import annotations

import itertools
import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.grid import PLANNED, Grid
from ledgerlens.operators.relational import join_counted

from ledgerlens.operators.components import connected_components
from ledgerlens.plans import scratch

log = logging.getLogger(__name__)

#: After so many rounds of core numbers, and whenever these have doubled, whole chains of vertices that hang on each other drop together,
CHAIN_ROUNDS = 16
#: if in half as many rounds running fewer than one vertex in so many fell: else looking for chains costs more than the rounds that it saves.
CHAIN_SHARE = 256
#: Core numbers lie in a bucket file for so many edges, in eight at least and never in more than there are shuffle partitions: a round of a small graph is mostly opening and writing files.
CORE_EDGES, CORE_BUCKETS = 100_000, 8
#: Hash orders in which strong components look for pivots at once.
PIVOT_ORDERS = 2
#: Strong components first look around one vertex where there are over so many edges a vertex: only there may most vertices be in one component.
HUB_DEGREE = 2
#: That search goes on while what is reached grows by one in so many a round, and for so many rounds more: a graph that is long as well as dense is left to the pivots.
HUB_GROWTH, HUB_SLOW = 8, 8
#: It is done again while it finds one in so many of the vertices.
HUB_SHARE = 4


def _rounds(most: int | None):
    """Counts rounds; raises once there were ``most`` and the loop goes on. None: as many as it takes."""
    for i in itertools.count():
        if most is not None and i >= most:
            raise RuntimeError(f"not settled in {most} rounds")
        yield i


def ends(edges: DataFrame, *cols: str) -> DataFrame:
    """(vid, ...) twice for each edge: once for each endpoint."""
    return edges.select(F.explode(F.array("src", "dst")).alias("vid"), *cols)


def vertices(edges: DataFrame) -> DataFrame:
    return ends(edges).distinct()


def degrees(edges: DataFrame, vertex: DataFrame | None = None) -> DataFrame:
    """(vid, in_degree, out_degree, degree); parallel edges count, a self-loop counts two. Vertices without edges get zeros if given."""
    e = edges.select(F.explode(F.array(F.struct(F.col("dst").alias("vid"), F.lit(1).alias("i")), F.struct(F.col("src").alias("vid"), F.lit(0).alias("i")))).alias("e")).select("e.*")
    d = e.groupBy("vid").agg(F.sum("i").alias("in_degree"), F.sum(1 - F.col("i")).alias("out_degree"), F.count("*").alias("degree"))
    return d if vertex is None else vertex.select("vid").join(d, "vid", "left").fillna(0)


def merge_edges(edges: DataFrame, sums: list[str], firsts: list[str] = (), *keys: str) -> DataFrame:
    """One edge for each (src, dst, *keys): sums, and the smallest value of the other attributes."""
    return edges.groupBy("src", "dst", *keys).agg(*[F.sum(c).alias(c) for c in sums], *[F.min(c).alias(c) for c in firsts])


def subgraph(edges: DataFrame, vertex: DataFrame) -> DataFrame:
    """Edges whose endpoints are both among the vertices."""
    v = vertex.select(F.col("vid")).distinct()
    return edges.join(v.withColumnRenamed("vid", "src"), "src", "left_semi").join(v.withColumnRenamed("vid", "dst"), "dst", "left_semi")


def without_lone_pairs(edges: DataFrame, complement: bool = False) -> DataFrame:
    """Without edges whose endpoints have two edge ends together: a pair that knows nobody else. ``complement`` gives those."""
    edges = edges if hasattr(edges, "_scratch_path") else scratch.keep(edges, "pairs")
    d = degrees(edges).select("vid", "degree")
    j = edges.join(d.withColumnsRenamed({"vid": "src", "degree": "__a"}), "src").join(d.withColumnsRenamed({"vid": "dst", "degree": "__b"}), "dst")
    pair = F.col("__a") + F.col("__b") <= 2
    return j.where(pair if complement else ~pair).select(edges.columns)


def aggregate_messages(edges: DataFrame, to_dst: Column | None = None, to_src: Column | None = None, how=F.sum) -> DataFrame:
    """(vid, msg): what every vertex gets along its edges, aggregated."""
    sides = [F.struct(F.col(c).alias("vid"), m.alias("m")) for c, m in (("dst", to_dst), ("src", to_src)) if m is not None]
    return edges.select(F.explode(F.array(*sides)).alias("x")).select("x.*").where("m is not null").groupBy("vid").agg(how("m").alias("msg"))


def keep_vertices(vertex: DataFrame, values: DataFrame, column: str, default) -> DataFrame:
    """All vertices with the value that the table has for them, or the default."""
    return vertex.join(values, "vid", "left").withColumn(column, F.coalesce(column, F.lit(default)))


def join_vertices(vertex: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """``vertex`` with ``column`` replaced by the value that the other table has for the vertex; others keep theirs."""
    new = values.select("vid", F.col(column).alias("__new"))
    return vertex.join(new, "vid", "left").withColumn(column, F.coalesce("__new", column)).drop("__new")


def touching_communities(edges: DataFrame, members: DataFrame, chosen: DataFrame) -> DataFrame:
    """Edges with an end in one of the ``chosen(cc)`` communities; ``members(vid, cc)``."""
    inside = members.join(chosen.select("cc").distinct(), "cc", "left_semi").select("vid")
    hit = edges.select("src", "dst").join(inside.withColumnRenamed("vid", "src"), "src", "left_semi").select("src", "dst")
    hit = hit.union(edges.select("src", "dst").join(inside.withColumnRenamed("vid", "dst"), "dst", "left_semi").select("src", "dst")).distinct()
    return edges.join(hit, ["src", "dst"], "left_semi")


def _near_edges(edges: DataFrame, buckets: int) -> DataFrame:
    """(vid, other, w): every edge from both ends, parallel ones counted; a self-loop counts twice. Bucketed by vid."""
    ways = F.explode(F.array(F.struct(F.col("src").alias("vid"), F.col("dst").alias("other")), F.struct(F.col("dst").alias("vid"), F.col("src").alias("other"))))
    return scratch.keep_bucketed(edges.select(ways.alias("e")).select("e.*").groupBy("vid", "other").agg(F.count("*").alias("w")), "near", "vid", buckets=buckets)


def _h_index(bars: str) -> Column:
    """The largest h such that the values of h or more in the map ``bars`` (value: weight) weigh h or more.

    A vertex has fewer distinct values than the square root of four times the edges.
    """
    return F.expr(f"aggregate(sort_array(map_entries({bars}), false), named_struct('seen', 0L, 'h', 0L), (a, x) -> named_struct('seen', a.seen + x.value, 'h', greatest(a.h, least(x.key, a.seen + x.value))), a -> a.h)")


def _bars(values: DataFrame, name: str) -> DataFrame:
    """(vid, <name>) of ``values(vid, value, w)``: a map of each value to the sum of its weights, zeros left out. A hub's rows are summed where they lie first."""
    sums = values.groupBy("vid", "value").agg(F.sum("w").alias("w")).where("w <> 0")
    return sums.groupBy("vid").agg(F.map_from_entries(F.collect_list(F.struct("value", "w"))).alias(name))


def _chains(near: DataFrame, known: DataFrame) -> DataFrame | None:
    """(vid) of vertices that must drop below their number as a chain: each has just as many neighbours of its number or more as the
    number says, or too few, and one of those that it is linked to through such of the same number has too few. None if there are none."""
    held = F.expr("aggregate(map_entries(bars), 0L, (a, x) -> a + if(x.key >= core, x.value, 0L))")
    tight = scratch.keep(known.select("vid", F.col("core").alias("own"), held.alias("held")).where("held <= own").select("vid", "own", (F.col("held") < F.col("own")).alias("weak")), "tight")
    if tight.where("weak").isEmpty():
        return None
    a, b = tight.withColumnsRenamed({"own": "a", "weak": "weak_a"}), tight.withColumnsRenamed({"vid": "other", "own": "b", "weak": "weak_b"})
    links = near.where("vid < other").join(a, "vid").join(b, "other").where("a = b and not (weak_a and weak_b)").select(F.col("vid").alias("src"), F.col("other").alias("dst"))
    cc = connected_components(links)
    falling = cc.join(tight.where("weak"), "vid", "left_semi").select("cc").distinct()
    return cc.join(falling, "cc", "left_semi").select("vid").union(tight.where("weak").select("vid")).distinct()


def core_numbers(edges: DataFrame, most: int | None = None, max_rounds: int | None = None) -> DataFrame:
    """(vid, core): core numbers, those over ``most`` as ``most``. Parallel edges count each, self-loops twice. Raises if ``max_rounds`` is given and not enough.

    A vertex's number starts as its degree and falls to the largest h such that h of its edges lead to numbers of h or
    more. Each vertex keeps how many of its edges lead to each number. In a round those that fell say so along their edges, which is all that is
    shuffled, and who is told takes the h of what it then knows. Edges and states lie in bucket files by vertex; one table is written a round.
    """
    edges = edges if hasattr(edges, "_scratch_path") else scratch.keep(edges.select("src", "dst"), "core")
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(parts, max(CORE_BUCKETS, edges.count() // CORE_EDGES))
    near = _near_edges(edges, buckets)
    degree = scratch.keep(near.groupBy("vid").agg(F.sum("w").alias("core")), "cores")
    if most is not None:
        degree = degree.select("vid", F.least("core", F.lit(most)).alias("core"))
    told = lambda numbers: near.join(numbers.hint("shuffle_hash"), "vid").select(F.col("other").alias("vid"), F.col("core").alias("value"), "w")
    now = degree.join(_bars(told(degree), "bars"), "vid").select("vid", "core", F.col("core").alias("was"), "bars")
    now = scratch.keep_bucketed(now, "cores", "vid", buckets=buckets)
    scratch.drop(degree)
    chain, total, n, slow = CHAIN_ROUNDS, now.count(), 0, 0
    with scratch.settings(edges.sparkSession, PLANNED | {"spark.sql.shuffle.partitions": str(buckets)}):
        for i in _rounds(max_rounds):
            if i and 2 * n > total:  # to tell all anew is less than what fell where it was and where it is
                known = now.drop("bars").join(_bars(told(now.select("vid", "core")), "bars"), "vid").withColumn("told", F.lit(True))
            elif i:
                fell = now.where("core < was").select("vid", "was", "core").hint("shuffle_hash")
                moves = F.explode(F.array(F.struct(F.col("was").alias("value"), (-F.col("w")).alias("w")), F.struct(F.col("core").alias("value"), F.col("w"))))
                news = _bars(near.join(fell, "vid").select(F.col("other").alias("vid"), moves.alias("m")).select("vid", "m.*"), "news")
                merged = F.expr("map_filter(map_zip_with(bars, news, (k, a, b) -> coalesce(a, 0L) + coalesce(b, 0L)), (k, n) -> n <> 0)")
                known = now.join(news, "vid", "left").select("vid", "core", F.when(F.col("news").isNull(), F.col("bars")).otherwise(merged).alias("bars"), F.col("news").isNotNull().alias("told"))
            else:
                known = now.withColumn("told", F.lit(True))
            h = F.when(F.col("told"), F.least("core", _h_index("bars"))).otherwise(F.col("core"))
            new = known.select("vid", h.alias("to"), "core", "bars")
            if i >= chain and 2 * slow >= chain:
                drop, chain = _chains(near, known), 2 * i
                if drop is not None:
                    new = new.join(drop.withColumn("chained", F.lit(1)), "vid", "left")
                    new = new.select("vid", F.least("to", F.col("core") - F.coalesce("chained", F.lit(0))).alias("to"), "core", "bars")
            kept = scratch.keep_bucketed(new.select("vid", F.col("to").alias("core"), F.col("core").alias("was"), "bars"), "cores", "vid", buckets=buckets, dealt=True)
            scratch.drop(now)
            now = kept
            n = now.where("core < was").count()
            slow = slow + 1 if n * CHAIN_SHARE < total else 0
            log.info("core numbers, round %d: %d vertices fell", i + 1, n)
            if not n:
                break
    scratch.drop(near)
    return now.select("vid", "core")


def k_core(edges: DataFrame, k: int, max_rounds: int | None = None) -> DataFrame:
    """Edges of the largest subgraph in which every vertex has degree k or more. Raises if ``max_rounds`` is given and not enough."""
    e = scratch.keep(edges.select("src", "dst"), "core")
    left = scratch.keep(subgraph(e, core_numbers(e, k, max_rounds).where(F.col("core") >= k)), "core")
    scratch.drop(e)
    return left


def k_core_degrees(edges: DataFrame, k: int) -> DataFrame:
    """(vid, degree) in the k-core."""
    return degrees(k_core(edges, k)).select("vid", "degree")


def k_core_labels(edges: DataFrame, kmax: int | None, vertex: DataFrame | None = None) -> DataFrame:
    """(vid, core): the core number of each vertex, at most ``kmax`` - 1 (null: no limit); vertices without edges get 0."""
    core = core_numbers(edges, None if kmax is None else kmax - 1).withColumn("core", F.col("core").cast("int"))
    return core if vertex is None else core.unionByName(vertex.select("vid").distinct().join(core, "vid", "left_anti").withColumn("core", F.lit(0)))


def _shares(edges: DataFrame) -> DataFrame:
    """(src, dst, share): what part of a vertex's rank goes to another; parallel edges weigh each."""
    out = edges.groupBy("src").agg(F.count("*").alias("out_degree"))
    return edges.groupBy("src", "dst").agg(F.count("*").alias("w")).join(out, "src").select("src", "dst", (F.col("w") / F.col("out_degree")).alias("share"))


def page_rank(edges: DataFrame, rounds: int | None = None, tol: float = 0.001, reset: float = 0.15, max_rounds: int | None = None) -> DataFrame:
    """(vid, rank), unnormalised: reset + (1 - reset) * sum of rank / out-degree of those that point here.

    A fixed number of rounds from rank 1. Or without ``rounds`` by residuals: all ranks start at ``reset``, each vertex whose rank
    rose by more than ``tol`` in the last round passes its rise on, and the others keep theirs; it ends when no vertex has such a rise. So
    ranks are a little low, and later rounds touch fewer and fewer vertices. Raises if ``max_rounds`` is given and not enough.
    """
    edges = scratch.keep(edges.select("src", "dst"), "rank")
    v = scratch.keep_bucketed(vertices(edges), "rank", "vid")
    grid = Grid(_shares(edges))
    scratch.drop(edges)
    with grid.planned():
        if rounds:
            rank = v.withColumn("rank", F.lit(1.0))
            for _ in range(rounds):
                got = grid.messages(rank, F.col("src_rank") * F.col("share"))
                kept = grid.keep_states(v.join(got, "vid", "left").select("vid", (reset + (1 - reset) * F.coalesce("msg", F.lit(0.0))).alias("rank")), "rank")
                scratch.drop(rank)
                rank = kept
        else:
            rank = grid.keep_states(v.select("vid", F.lit(reset).alias("rank"), F.lit(reset).alias("rise")), "rank")
            for i in _rounds(max_rounds):
                active = rank.where(F.col("rise") > tol)
                log.info("ranks, round %d: %d vertices pass on", i + 1, n := active.count())
                if not n:
                    break
                got = grid.messages(active.select("vid", "rise"), F.col("src_rise") * F.col("share"))
                rise = (1 - reset) * F.col("msg")
                kept = grid.keep_states(rank.select("vid", "rank").join(got, "vid", "left").select("vid", (F.col("rank") + F.coalesce(rise, F.lit(0.0))).alias("rank"), rise.alias("rise")), "rank")
                scratch.drop(rank)
                rank = kept
    grid.drop()
    scratch.drop(v)
    return rank.select("vid", "rank")


def expand(edges: DataFrame, seeds: DataFrame, max_hops: int = 5) -> DataFrame:
    """(vid): all vertices within ``max_hops`` edges of the seeds, in either direction, the seeds included."""
    ways = F.explode(F.array(F.struct(F.col("src").alias("a"), F.col("dst").alias("b")), F.struct(F.col("dst").alias("a"), F.col("src").alias("b"))))
    both = scratch.keep(edges.select(ways.alias("w")).select("w.*").distinct(), "expand")
    seen = scratch.keep(seeds.select("vid").distinct(), "expand")
    front = seen
    for _ in range(max_hops):
        near = both.join(front.withColumnRenamed("vid", "a"), "a").select(F.col("b").alias("vid")).distinct()
        front = scratch.keep(near.join(seen, "vid", "left_anti"), "expand")
        if front.isEmpty():
            break
        seen = scratch.keep(seen.union(front), "expand")
    return seen


def _active_edges(grid: Grid, now: DataFrame, direction: str) -> DataFrame:
    """Edges that send, with src_state and dst_state: those of inactive vertices are left out by the first join, or where either end may be active after both."""
    sends = {"out": ("src",), "in": ("dst",), "either": (), "both": ("src", "dst")}[direction]
    e = grid.edges
    for end in sorted(("src", "dst"), key=lambda end: end not in sends):
        e = grid.joined(e, now.where("active").select("vid", "state") if end in sends else now, end)
    return e.where("src_active or dst_active") if direction == "either" else e


def pregel(vertex: DataFrame, edges: DataFrame, state: str, to_dst: Column | None, to_src: Column | None, merge: Callable[[Column], Column], update: Callable[[Column, Column], Column], max_rounds: int | None = None, patience: int | None = None, active_direction: str = "either") -> DataFrame:
    """Message passing to a fixpoint: (vid, state).

    ``to_dst``/``to_src`` are messages over the edge's columns, src_state and dst_state (null: none), ``merge`` aggregates
    them, ``update`` gives the new state from (state, msg). An edge sends if a vertex changed in the last round: its source (``active_direction``
    out), its target (in), any (either) or each of them (both); all count as changed at first. Edges stay in the bucket files of a
    `Grid`, states come to them. Raises if ``max_rounds`` is given and not enough; with ``patience`` it ends, as it then stands,
    once as many vertices changed in that many rounds running (the older rule, 3 or 5, which can end too soon).
    """
    last, same = None, 0
    grid = Grid(edges)
    now = scratch.keep_bucketed(vertex.select("vid", F.col(state).alias("state"), F.lit(True).alias("active")), "pregel", "vid")
    with grid.planned():
        for i in _rounds(max_rounds):
            msg = aggregate_messages(_active_edges(grid, now, active_direction), to_dst, to_src, merge)
            new = now.join(msg, "vid", "left").select("vid", "state", F.when(F.col("msg").isNull(), F.col("state")).otherwise(update(F.col("state"), F.col("msg"))).alias("to"))
            kept = grid.keep_states(new.select("vid", F.col("to").alias("state"), (~F.col("to").eqNullSafe(F.col("state"))).alias("active")), "pregel")
            scratch.drop(now)
            now = kept
            active = now.where("active").count()
            log.info("messages, round %d: %d vertices changed", i + 1, active)
            same = same + 1 if active == last else 1
            last = active
            if not active or (patience and same >= patience):
                break
    grid.drop()
    return now.select("vid", F.col("state").alias(state))


def least_ancestor(vertex: DataFrame, edges: DataFrame, max_rounds: int | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """(vid, least): the smallest vertex that can reach each vertex, itself included. With columns ``by`` in both tables, in each such graph apart.

    Every round a vertex takes the least its predecessors know, and then what the vertex so found knows itself: that
    one reaches it as well. On a path known distances so double instead of growing by one.
    """
    now = scratch.keep(vertex.select(*by, "vid", F.col("vid").alias("least")), "least")
    e = scratch.keep_bucketed(edges.select(*by, "src", "dst").where("src <> dst").distinct(), "least", *by, "src")
    for _ in _rounds(max_rounds):
        got = e.join(now.select(*by, F.col("vid").alias("src"), "least"), [*by, "src"]).groupBy(*by, F.col("dst").alias("vid")).agg(F.min("least").alias("got"))
        one = now.join(got, [*by, "vid"], "left").select(*by, "vid", "least", F.least("least", "got").alias("new"))
        jump = now.select(*by, F.col("vid").alias("new"), F.col("least").alias("far"))
        kept = scratch.keep(one.join(jump, [*by, "new"], "left").select(*by, "vid", F.least("new", "far").alias("to"), "least").select(*by, "vid", F.col("to").alias("least"), (F.col("to") != F.col("least")).alias("moved")), "least")
        scratch.drop(now)
        now = kept
        if now.where("moved").isEmpty():
            break
    scratch.drop(e)
    return now.select(*by, "vid", "least")


def _around_hub(inner: DataFrame, edges: DataFrame) -> DataFrame | None:
    """(vid, forth, back): whether the vertex through which most pairs of edges go reaches each vertex, and is reached from it. None if what is reached grows too slowly.

    Both ways go at once, and a vertex passes on once each way, when it is new: so all rounds together send at most two messages an edge. Edges and states lie in bucket files by vertex.
    """
    buckets = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ways = F.explode(F.array(F.struct(F.col("src").alias("vid"), F.col("dst").alias("other"), F.lit(True).alias("forth")), F.struct(F.col("dst").alias("vid"), F.col("src").alias("other"), F.lit(False).alias("forth"))))
    near = scratch.keep_bucketed(edges.select(ways.alias("e")).select("e.*"), "near", "vid", buckets=buckets)
    hub = near.groupBy("vid").agg((F.count_if("forth") * F.count_if(~F.col("forth"))).alias("n")).orderBy(F.desc("n"), "vid").first().vid
    start = [(F.col("vid") == hub).alias(c) for c in ("forth", "back", "new_forth", "new_back")]
    now = scratch.keep_bucketed(inner.select("vid", *start), "around", "vid", buckets=buckets)
    slow = 0
    with scratch.settings(edges.sparkSession, PLANNED):
        for i in itertools.count():
            n = now.agg(*[F.count_if(c).alias(c) for c in now.columns[1:]]).first()
            log.info("around vertex %d, round %d: reaches %d, reached from %d", hub, i, n.forth, n.back)
            if not n.new_forth and not n.new_back:
                break
            slow += HUB_GROWTH * n.new_forth < n.forth and HUB_GROWTH * n.new_back < n.back
            if slow > HUB_SLOW:
                scratch.drop(now)
                now = None
                break
            new = now.where("new_forth or new_back").select("vid", "new_forth", "new_back").hint("shuffle_hash")
            told = near.join(new, "vid").where("if(forth, new_forth, new_back)").groupBy(F.col("other").alias("vid")).agg(F.bool_or("forth").alias("told_forth"), F.bool_or(~F.col("forth")).alias("told_back"))
            known = now.join(told, "vid", "left").select("vid", "forth", "back", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("told_forth", "told_back")])
            kept = scratch.keep_bucketed(known.selectExpr("vid", "forth or told_forth as forth", "back or told_back as back", "told_forth and not forth as new_forth", "told_back and not back as new_back"), "around", "vid", buckets=buckets, dealt=True)
            scratch.drop(now)
            now = kept
    scratch.drop(near)
    return now


def _pivots(inner: DataFrame, cut: DataFrame, orders: int) -> DataFrame:
    """(vid, pivot, class): in ``orders`` hash orders the first vertex that reaches each and the first that it reaches; the pivot where both are one, and a name of all that was learnt."""
    name = lambda k, c: F.xxhash64(F.lit(k), F.col(c))  # noqa: E731 - one to one for each k
    kinds = range(2 * orders)
    ways = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), name(k // 2, "dst" if k % 2 else "src").alias("a"), name(k // 2, "src" if k % 2 else "dst").alias("b")) for k in kinds]))
    directed = cut.select(ways.alias("w")).select("w.kind", F.col("w.a").alias("src"), F.col("w.b").alias("dst"))
    named = scratch.keep(inner.select("vid", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), name(k // 2, "vid").alias("h")) for k in kinds])).alias("w")).select("vid", "w.*"), "scc")
    least = least_ancestor(named.select("kind", F.col("h").alias("vid")), directed, by=("kind",)).withColumnRenamed("vid", "h")
    learnt = named.join(least, ["kind", "h"]).groupBy("vid").agg(*[F.max(F.when(F.col("kind") == k, F.col("least"))).alias(f"p{k}") for k in kinds])
    pivot = F.coalesce(*[F.when(F.col(f"p{k}") == F.col(f"p{k + 1}"), F.struct(F.lit(k).alias("kind"), F.col(f"p{k}").alias("p"))) for k in kinds[::2]])
    told = scratch.keep(learnt.select("vid", pivot.alias("pivot"), F.xxhash64(*[f"p{k}" for k in kinds]).alias("class")), "scc")
    scratch.drop(named)
    return told


def strongly_connected(edges: DataFrame, max_rounds: int | None = None, orders: int = PIVOT_ORDERS) -> DataFrame:
    """(vid, scc): the smallest vertex id of each vertex's strongly connected component.

    Each round vertices without edges in or out are taken out. Where many edges are left a vertex, what one vertex reaches and is reached from
    is looked for first, as most vertices may be in its component. Else, in ``orders`` hash orders at once, every vertex learns the first
    vertex that reaches it and the first that it reaches. Where both are one, that pivot's component is found; all others are told apart by
    what they learnt, as a component learns alike, and edges between such classes go. So one round finds many components and cuts the rest into
    many parts: a long path falls apart as in a quicksort. Raises if ``max_rounds`` is given and not enough.
    """
    e = scratch.keep(edges.select("src", "dst").where("src <> dst").distinct(), "scc")
    left, done = scratch.keep(vertices(edges), "scc"), []
    hub = True
    for i in _rounds(max_rounds):
        inner = scratch.keep(e.select(F.col("src").alias("vid")).intersect(e.select("dst")), "scc")
        done.append(scratch.keep(left.join(inner, "vid", "left_anti").withColumn("scc", F.col("vid")), "scc"))
        cut = scratch.keep(subgraph(e, inner), "scc")
        scratch.drop(left)
        scratch.drop(e)
        if cut.isEmpty():
            done.append(scratch.keep(inner.withColumn("scc", F.col("vid")), "scc"))
            scratch.drop(inner)
            break
        n, around = inner.count(), None
        if hub and cut.count() > HUB_DEGREE * n:
            around = _around_hub(inner, cut)
            hub = around is not None and HUB_SHARE * around.where("forth and back").count() >= n
        if around is not None:
            told = around.select("vid", F.when(F.col("forth") & F.col("back"), F.struct(F.lit(0).alias("kind"), F.lit(0).cast("long").alias("p"))).alias("pivot"), F.struct("forth", "back").alias("class"))
        else:
            told = _pivots(inner, cut, orders)
        found = told.where("pivot is not null").select("vid", "pivot.*")
        of = scratch.keep(found.groupBy("kind", "p").agg(F.min("vid").alias("scc"), F.count("*").alias("n")), "scc")
        done.append(scratch.keep(join_counted(found, of, ["kind", "p"], "n").select("vid", "scc"), "scc"))
        rest = told.where("pivot is null")
        a, b = rest.select(F.col("vid").alias("src"), F.col("class").alias("ca")), rest.select(F.col("vid").alias("dst"), F.col("class").alias("cb"))
        e = scratch.keep(cut.join(a, "src").join(b, "dst").where("ca = cb").select("src", "dst"), "scc")
        left = scratch.keep(rest.select("vid"), "scc")
        for t in (inner, cut, told if around is None else around, of):
            scratch.drop(t)
        if left.isEmpty():
            break
        log.info("strong components, round %d", i + 1)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out
