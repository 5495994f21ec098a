"""Queries on the transfer graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import flow, graph
from ledgerlens.operators.components import connected_components
from ledgerlens.registry import query
from ledgerlens.sources.transactions import EDGES, EDGES_AT_MERCHANTS, table, transfer_edges

#: All transfer edges between two cards.
_BETWEEN = ",\nbetween_cards AS MATERIALIZED (SELECT src, dst, money, cnt FROM edges WHERE src <> dst)"
BETWEEN, BETWEEN_AT_MERCHANTS = EDGES + _BETWEEN, EDGES_AT_MERCHANTS + _BETWEEN
_BOTH = "both_ways AS MATERIALIZED (SELECT src AS a, dst AS b FROM between_cards UNION SELECT dst, src FROM between_cards)"
#: Lists of cards: those whose balance is below zero, and as seeds those far below.
LISTED, SEEDED = "c_acctbal < 0", "c_acctbal < -900"
_DEG = "deg AS MATERIALIZED (SELECT vid, sum(i)::BIGINT AS in_degree, sum(1 - i)::BIGINT AS out_degree, count(*) AS degree FROM (SELECT dst AS vid, 1 AS i FROM between_cards UNION ALL SELECT src, 0 FROM between_cards) GROUP BY 1)"
THRESHOLDS = [*range(0, 10), *range(10, 100, 10), *range(100, 1000, 100), *range(1000, 10001, 1000)]


def between_cards(spark, d, apart=False):
    """All transfer edges between two cards, whatever their money. ``apart``: of cards at each merchant, a graph of many components."""
    return transfer_edges(spark, d, apart).where("src <> dst").select("src", "dst", "money", "cnt")


def for_both(sql: str, ctes: str = ""):
    """Register f(edges) twice: on all transfers and, as <name>_at_merchants, with every card apart at each merchant."""

    def add(f):
        for name, apart, between in ((f.__name__, False, BETWEEN), (f"{f.__name__}_at_merchants", True, BETWEEN_AT_MERCHANTS)):
            registered = lambda spark, d, apart=apart: f(between_cards(spark, d, apart))
            registered.__name__, registered.__doc__ = name, f.__doc__
            query(sql, f"{between}, {ctes}" if ctes else between)(registered)
        return f

    return add


def cards_with(spark, d, condition):
    return table(spark, d, "customer").where(condition).select(F.col("c_custkey").alias("vid"))


@for_both("SELECT * FROM deg", f"{_DEG}")
def vertex_degrees(e):
    return graph.degrees(e)


@query("SELECT c_custkey AS vid, coalesce(in_degree, 0) AS in_degree, coalesce(out_degree, 0) AS out_degree, coalesce(degree, 0) AS degree FROM customer LEFT JOIN deg ON c_custkey = vid", f"{BETWEEN}, {_DEG}")
def all_vertex_degrees(spark, d):
    return graph.degrees(between_cards(spark, d), table(spark, d, "customer").select(F.col("c_custkey").alias("vid")))


@query("SELECT t AS threshold, count(CASE WHEN in_degree >= t THEN 1 END) AS n_in, count(CASE WHEN out_degree >= t THEN 1 END) AS n_out, count(CASE WHEN degree >= t THEN 1 END) AS n_all FROM deg, (SELECT unnest([" + ", ".join(map(str, THRESHOLDS)) + "]) AS t) GROUP BY 1", f"{BETWEEN}, {_DEG}")
def cumulative_degree_histogram(spark, d):
    return flow.cumulative_degrees(graph.degrees(between_cards(spark, d)), THRESHOLDS)


@query("SELECT src, dst, cnt FROM edges WHERE cnt > 1", EDGES)
def frequent_edges(spark, d):
    return transfer_edges(spark, d).where("cnt > 1").select("src", "dst", "cnt")


@query(f"SELECT src, dst, money FROM between_cards WHERE src IN (SELECT c_custkey FROM customer WHERE {LISTED}) AND dst IN (SELECT c_custkey FROM customer WHERE {LISTED})", BETWEEN)
def vertex_subgraph(spark, d):
    return graph.subgraph(between_cards(spark, d), cards_with(spark, d, LISTED)).select("src", "dst", "money")


_SUMS = "SELECT src, dst, money FROM between_cards JOIN deg a ON a.vid = src JOIN deg b ON b.vid = dst WHERE a.degree + b.degree "


@for_both(_SUMS + "> 2", f"{_DEG}")
def lone_pairs_removed(e):
    return graph.without_lone_pairs(e).select("src", "dst", "money")


@for_both(_SUMS + "<= 2", f"{_DEG}")
def lone_pairs(e):
    return graph.without_lone_pairs(e, complement=True).select("src", "dst", "money")


@query("SELECT vid, sum(m)::BIGINT AS msg FROM (SELECT dst AS vid, money AS m FROM between_cards UNION ALL SELECT src, cnt FROM between_cards) GROUP BY 1", BETWEEN)
def messages_both_ways(spark, d):
    return graph.aggregate_messages(between_cards(spark, d), F.col("money"), F.col("cnt"))


@for_both("SELECT a AS vid, min(r) AS cc FROM (SELECT a, least(a, min(r)) AS r FROM reach GROUP BY a UNION ALL SELECT a, r FROM reach) GROUP BY 1", f"{_BOTH}, reach(a, r) AS (SELECT a, b FROM both_ways UNION SELECT both_ways.a, reach.r FROM both_ways JOIN reach ON both_ways.b = reach.a)")
def components(e):
    return connected_components(e)


@for_both("SELECT vid, count(*) OVER (PARTITION BY cc) AS size FROM (SELECT a AS vid, least(a, min(r)) AS cc FROM reach GROUP BY 1)", f"{_BOTH}, reach(a, r) AS (SELECT a, b FROM both_ways UNION SELECT both_ways.a, reach.r FROM both_ways JOIN reach ON both_ways.b = reach.a)")
def component_sizes(e):
    cc = connected_components(e)
    return cc.join(cc.groupBy("cc").agg(F.count("*").alias("size")), "cc").select("vid", "size")


@for_both("SELECT vid, least(vid, coalesce(min(b.r), vid)) AS scc FROM (SELECT src AS vid FROM between_cards UNION SELECT dst FROM between_cards) v LEFT JOIN (SELECT f.a, f.r FROM reach f JOIN reach g ON f.a = g.r AND f.r = g.a) b ON v.vid = b.a GROUP BY vid", f"reach(a, r) AS (SELECT src, dst FROM between_cards UNION SELECT between_cards.src, reach.r FROM between_cards JOIN reach ON between_cards.dst = reach.a)")
def strong_components(e):
    return graph.strongly_connected(e)


def _unrolled_core(k: int, rounds: int) -> str:
    parts = ["e0 AS MATERIALIZED (SELECT src, dst FROM between_cards)"]
    for i in range(rounds):
        parts.append(f"d{i} AS MATERIALIZED (SELECT vid FROM (SELECT src AS vid FROM e{i} UNION ALL SELECT dst FROM e{i}) GROUP BY 1 HAVING count(*) >= {k})")
        parts.append(f"e{i + 1} AS MATERIALIZED (SELECT src, dst FROM e{i} WHERE src IN (SELECT vid FROM d{i}) AND dst IN (SELECT vid FROM d{i}))")
    return ", ".join(parts)


@query("SELECT vid, count(*) AS degree FROM (SELECT src AS vid FROM e40 UNION ALL SELECT dst FROM e40) GROUP BY 1", f"{BETWEEN}, {_unrolled_core(3, 40)}")
def three_core_degrees(spark, d):
    return graph.k_core_degrees(between_cards(spark, d), 3)


def unrolled_labels(source: str, rounds: int = 120) -> str:
    """CTEs that end in labels(vid, core). A vertex's number starts as its degree and becomes the largest h such that h of its edges lead to numbers of h or more; on the 0.1 tables 40 rounds are too few and 80 enough."""
    parts = [f"ends AS MATERIALIZED (SELECT src AS vid, dst AS other FROM {source} UNION ALL SELECT dst, src FROM {source})", "h0 AS MATERIALIZED (SELECT vid, count(*) AS core FROM ends GROUP BY 1)"]
    for i in range(rounds):
        parts.append(f"h{i + 1} AS MATERIALIZED (SELECT vid, max(least(core, place)) AS core FROM (SELECT ends.vid, core, row_number() OVER (PARTITION BY ends.vid ORDER BY core DESC) AS place FROM ends JOIN h{i} ON other = h{i}.vid) GROUP BY 1)")
    return ", ".join(parts) + f", labels AS MATERIALIZED (SELECT * FROM h{rounds})"


@for_both("SELECT * FROM labels", f"{unrolled_labels('between_cards')}")
def core_labels(e):
    return graph.k_core_labels(e, None)


def _unrolled_rank(rounds: int) -> str:
    parts = ["vs AS MATERIALIZED (SELECT src AS vid FROM between_cards UNION SELECT dst FROM between_cards)", "share AS MATERIALIZED (SELECT src, dst, 1.0::DOUBLE / count(*) OVER (PARTITION BY src) AS share FROM between_cards)", "r0 AS (SELECT vid, 1.0::DOUBLE AS rank FROM vs)"]
    for i in range(rounds):
        parts.append(f"r{i + 1} AS MATERIALIZED (SELECT vid, 0.15 + 0.85 * coalesce((SELECT sum(rank * share) FROM share JOIN r{i} ON share.src = r{i}.vid WHERE share.dst = vs.vid), 0) AS rank FROM vs)")
    return ", ".join(parts)


@query("SELECT vid, round(rank, 6) AS rank FROM r6", f"{BETWEEN}, {_unrolled_rank(6)}")
def page_rank_six_rounds(spark, d):
    return graph.page_rank(between_cards(spark, d), rounds=6).select("vid", F.round("rank", 6).alias("rank"))


def _unrolled_rises(rounds: int, tol: float = 0.001) -> str:
    """Ranks by residuals; once no rise is above the tolerance, further rounds change nothing."""
    parts = ["vs AS MATERIALIZED (SELECT src AS vid FROM between_cards UNION SELECT dst FROM between_cards)", "share AS MATERIALIZED (SELECT src, dst, 1.0::DOUBLE / count(*) OVER (PARTITION BY src) AS share FROM between_cards)", "r0 AS (SELECT vid, 0.15::DOUBLE AS rank, 0.15::DOUBLE AS rise FROM vs)"]
    for i in range(rounds):
        got = f"(SELECT dst AS vid, 0.85 * sum(rise * share)::DOUBLE AS rise FROM share JOIN r{i} ON share.src = r{i}.vid WHERE rise > {tol} GROUP BY 1)"
        parts.append(f"r{i + 1} AS MATERIALIZED (SELECT vid, r.rank + coalesce(g.rise, 0) AS rank, g.rise FROM r{i} r LEFT JOIN {got} g USING (vid))")
    return ", ".join(parts)


@for_both("SELECT vid, round(rank, 6) AS rank FROM r80", f"{_unrolled_rises(80)}")
def page_rank_to_tolerance(e):
    return graph.page_rank(e).select("vid", F.round("rank", 6).alias("rank"))


@query("SELECT DISTINCT vid FROM near", f"{BETWEEN}, {_BOTH}, near(vid, hop) AS (SELECT c_custkey, 0 FROM customer WHERE {SEEDED} UNION SELECT b, hop + 1 FROM near JOIN both_ways ON a = vid WHERE hop < 3)")
def seed_expansion(spark, d):
    return graph.expand(between_cards(spark, d), cards_with(spark, d, SEEDED), 3)


@for_both("SELECT vid, min(money_seen) AS least_seen FROM (SELECT a AS vid, min(r) AS money_seen FROM reach GROUP BY 1 UNION ALL SELECT vid, vid FROM (SELECT src AS vid FROM between_cards UNION SELECT dst FROM between_cards)) GROUP BY 1", f"reach(a, r) AS (SELECT dst, src FROM between_cards UNION SELECT between_cards.dst, reach.r FROM between_cards JOIN reach ON between_cards.src = reach.a)")
def pregel_smallest_ancestor(e):
    """Each vertex learns the smallest vertex that can reach it."""
    return graph.least_ancestor(graph.vertices(e), e).withColumnRenamed("least", "least_seen")


@for_both("SELECT a AS vid, min(r) AS cc FROM (SELECT a, least(a, min(r)) AS r FROM reach GROUP BY a UNION ALL SELECT a, r FROM reach) GROUP BY 1", f"{_BOTH}, reach(a, r) AS (SELECT a, b FROM both_ways UNION SELECT both_ways.a, reach.r FROM both_ways JOIN reach ON both_ways.b = reach.a)")
def pregel_components(e):
    """Components by messages both ways: the general loop."""
    less = lambda a, b: F.when(F.col(a) < F.col(b), F.col(a))
    return graph.pregel(graph.vertices(e).withColumn("cc", F.col("vid")), e, "cc", less("src_state", "dst_state"), less("dst_state", "src_state"), F.min, lambda s, m: F.least(s, m))


_RATIO = "round({}::DOUBLE / degree, 6)"


@query(f"SELECT vid, in_degree, out_degree, degree, {_RATIO.format('in_degree')} AS in_ratio, {_RATIO.format('out_degree')} AS out_ratio, round(rank, 6) AS rank FROM deg JOIN r6 USING (vid)", f"{BETWEEN}, {_DEG}, {_unrolled_rank(6)}")
def degree_ratios_with_rank(spark, d):
    e = between_cards(spark, d)
    share = lambda c: F.round(F.try_divide(F.col(c).cast("double"), F.col("degree")), 6)
    j = graph.degrees(e).join(graph.page_rank(e, rounds=6), "vid")
    return j.select("vid", "in_degree", "out_degree", "degree", share("in_degree").alias("in_ratio"), share("out_degree").alias("out_ratio"), F.round("rank", 6).alias("rank"))


@query(f"SELECT vid, in_degree, out_degree, degree, {_RATIO.format('abs(in_degree - out_degree)')} AS gap_ratio, round(rank, 6) AS rank FROM deg JOIN r6 USING (vid)", f"{BETWEEN}, {_DEG}, {_unrolled_rank(6)}")
def degree_gap_with_rank(spark, d):
    e = between_cards(spark, d)
    gap = F.abs(F.col("in_degree") - F.col("out_degree")).cast("double")
    j = graph.degrees(e).join(graph.page_rank(e, rounds=6), "vid")
    return j.select("vid", "in_degree", "out_degree", "degree", F.round(F.try_divide(gap, F.col("degree")), 6).alias("gap_ratio"), F.round("rank", 6).alias("rank"))


@query("SELECT c_custkey AS vid, coalesce(got, c_acctbal) AS worth FROM customer LEFT JOIN (SELECT dst, sum(money)::DOUBLE AS got FROM between_cards GROUP BY 1) ON dst = c_custkey", BETWEEN)
def old_value_without_message(spark, d):
    """Vertices keep what they had unless a message came."""
    msg = graph.aggregate_messages(between_cards(spark, d), F.col("money")).select("vid", F.col("msg").cast("double").alias("worth"))
    return graph.join_vertices(table(spark, d, "customer").select(F.col("c_custkey").alias("vid"), F.col("c_acctbal").alias("worth")), msg, "worth")


@query(f"SELECT vid FROM (SELECT src AS vid FROM e40 UNION SELECT dst FROM e40) INTERSECT SELECT c_custkey FROM customer WHERE {LISTED}", f"{BETWEEN}, {_unrolled_core(2, 40)}")
def listed_cards_in_core(spark, d):
    return graph.vertices(graph.k_core(between_cards(spark, d), 2)).intersect(cards_with(spark, d, LISTED))


@query(f"SELECT c_custkey AS vid FROM customer WHERE {SEEDED} UNION SELECT b FROM both_ways WHERE a IN (SELECT c_custkey FROM customer WHERE {SEEDED})", f"{BETWEEN}, {_BOTH}")
def one_round_expansion(spark, d):
    return graph.expand(between_cards(spark, d), cards_with(spark, d, SEEDED), 1)


@query("SELECT src, dst, money FROM between_cards WHERE src IN (SELECT vid FROM chosen) AND dst IN (SELECT vid FROM chosen)", f"{BETWEEN}, {_BOTH}, near(vid, hop) AS (SELECT c_custkey, 0 FROM customer WHERE {SEEDED} UNION SELECT b, hop + 1 FROM near JOIN both_ways ON a = vid WHERE hop < 2), chosen AS (SELECT DISTINCT vid FROM near)")
def neighbourhood_extraction(spark, d):
    e = between_cards(spark, d)
    near = graph.expand(e, cards_with(spark, d, SEEDED), 2)
    return graph.subgraph(e, near).select("src", "dst", "money")


@query("SELECT c_custkey AS vid, coalesce(sum(money)::BIGINT, 0) AS got FROM customer LEFT JOIN between_cards ON dst = c_custkey GROUP BY 1", BETWEEN)
def default_for_lone_vertices(spark, d):
    msg = graph.aggregate_messages(between_cards(spark, d), F.col("money")).withColumnRenamed("msg", "got")
    return graph.keep_vertices(table(spark, d, "customer").select(F.col("c_custkey").alias("vid")), msg, "got", 0)


@query("SELECT src, dst, sum(money)::BIGINT AS money, sum(cnt)::BIGINT AS cnt FROM (SELECT least(src, dst) AS src, greatest(src, dst) AS dst, money, cnt FROM between_cards) GROUP BY 1, 2", BETWEEN)
def undirected_merge(spark, d):
    e = between_cards(spark, d).select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), "money", "cnt")
    return graph.merge_edges(e, ["money", "cnt"])
