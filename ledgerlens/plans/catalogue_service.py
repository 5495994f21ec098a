"""Queries of the card risk service and the mixed graph."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import cli
from ledgerlens.operators import communities, features, graph, hetero
from ledgerlens.operators import relational as R
from ledgerlens.operators.components import connected_components
from ledgerlens.registry import query
from ledgerlens.plans import scratch
from ledgerlens.plans.catalogue_graph import LISTED, unrolled_labels
from ledgerlens.sources import io
from ledgerlens.sources import schema as S
from ledgerlens.sources.transactions import TX, TX_AT_MERCHANTS, at_merchants, table, transactions

_Y = "(money // 100)"
_B = f"length(CAST({_Y} AS STRING))"
_FLAGS = {
    "night_cnt": "sum(CASE WHEN CAST(substr(loc_trans_tm, 1, 2) AS INTEGER) IN (23, 0, 1, 2, 3, 4, 5) THEN 1.0::DOUBLE ELSE 0 END)",
    "tot_regions": "count(DISTINCT region_cd)",
    "tot_term_ids": "count(DISTINCT term_id)",
    "tot_provs": "count(DISTINCT left(region_cd, 2))",
    "tot_big500": f"sum(CASE WHEN {_Y} % 500 = 0 THEN 1.0::DOUBLE ELSE 0 END)",
    "tot_big1000": f"sum(CASE WHEN {_Y} % 1000 = 0 THEN 1.0::DOUBLE ELSE 0 END)",
    "tot_large_integer": f"sum(CASE WHEN abs({_Y} / pow(10.0, {_B} - 1) - round({_Y} / pow(10.0, {_B} - 1))) / {_B} < 0.01 AND {_Y} > 1000 THEN 1.0::DOUBLE ELSE 0 END)",
    "tot_hrloc_trans": f"sum(CASE WHEN region_cd IN {features.HIGH_RISK} THEN 1.0::DOUBLE ELSE 0 END)",
    "tot_cardholder_fails": f"sum(CASE WHEN resp_cd4 IN {S.HOLDER_FAILURES} THEN 1.0::DOUBLE ELSE 0 END)",
    "tot_abnorm_rate": "sum(CASE WHEN trans_curr_cd <> '156' THEN 1.0::DOUBLE ELSE 0 END)",
    "tot_count_89": "sum(length(regexp_replace(CAST(money AS STRING), '[^89]', '', 'g'))::DOUBLE)",
    "tot_foreign": "sum(CASE WHEN trans_md <> '1' THEN 1.0::DOUBLE ELSE 0 END)",
    "tot_counts": "count(*)",
    "tot_amounts": f"sum({_Y})::BIGINT",
}
for _n, _c in S.TYPED.items():
    _own = f"CASE WHEN trans_id = '{_c}' THEN {_Y} END"
    _FLAGS |= {f"{_n}_counts": f"count({_own})", f"{_n}_amounts": f"sum({_own})::BIGINT", f"{_n}_avg": f"round(avg({_own}), 4)", f"{_n}_max": f"max({_own})"}
_FLAGS |= {"distinct_cards_in": "count(DISTINCT CASE WHEN trans_id = 'S33' THEN srccard END)", "distinct_cards_out": "count(DISTINCT CASE WHEN trans_id = 'S25' THEN dstcard END)"}
_CARDS = "cards AS MATERIALIZED (SELECT card, " + ", ".join(f"{e} AS {k}" for k, e in _FLAGS.items()) + " FROM tx GROUP BY card)"


@query("SELECT * FROM cards", f"{TX}, {_CARDS}")
def card_feature_vector(spark, d):
    return features.card_features(transactions(spark, d, holders_first=True))


_OLD = {k: e for k, e in _FLAGS.items()}
_OLD |= {f"{n}_max": f"round(avg(CASE WHEN trans_id = '{c}' THEN {_Y} END), 4)" for n, c in S.TYPED.items()} | {"distinct_cards_out": "count(DISTINCT CASE WHEN trans_id = 'S33' THEN dstcard END)"}


@query("SELECT card, " + ", ".join(f"{e} AS {k}" for k, e in _OLD.items()) + " FROM tx GROUP BY card", TX)
def card_feature_vector_compat(spark, d):
    return features.card_features(transactions(spark, d, holders_first=True), compat=True)


_WEIGHTS: dict[str, float] = {}
for _names, _w in ((features.FULL, 1.0), (features.HALF, 0.5)):
    for _n in _names:
        if _n in _FLAGS:
            _WEIGHTS[_n] = _WEIGHTS.get(_n, 0.0) + _w
_SCORE = "SELECT card, " + " + ".join(f"{w}::DOUBLE * dense_rank() OVER (ORDER BY coalesce({k}, 0))" for k, w in _WEIGHTS.items()) + " AS score FROM cards"


@query(_SCORE, f"{TX}, {_CARDS}")
def card_rank_sum_score(spark, d):
    return features.rank_sum_score(features.card_features(transactions(spark, d, holders_first=True)))


@query(f"SELECT c_name AS oricard, card, score FROM (SELECT c_custkey AS card, c_name FROM customer WHERE {LISTED}) LEFT JOIN ({_SCORE}) USING (card)", f"{TX}, {_CARDS}")
def scores_of_listed_cards(spark, d):
    listed = table(spark, d, "customer").where(LISTED).select(F.col("c_custkey").alias("card"), F.col("c_name").alias("oricard"))
    return features.attach_originals(features.rank_sum_score(features.card_features(transactions(spark, d, holders_first=True))), listed).select("oricard", "card", "score")


def for_both(sql: str, ctes: str = ""):
    """Register f(tx) twice: on all transactions and, as <name>_at_merchants, with every card apart at each merchant."""

    def add(f):
        def whole(spark, d):
            return f(transactions(spark, d))

        def apart(spark, d):
            return f(at_merchants(transactions(spark, d)))

        for g, name, tx in ((whole, f.__name__, TX), (apart, f"{f.__name__}_at_merchants", TX_AT_MERCHANTS)):
            g.__name__, g.__doc__ = name, f.__doc__
            query(sql, f"{tx}, {ctes}" if ctes else tx)(g)
        return f

    return add


def _transfers(tx):
    return tx.where("trans_id in ('S33', 'S25') and srccard <> dstcard")


def _merged(tx, *columns):
    """Transfers merged by pair, written once, with the ``columns`` beside src and dst that a query needs; sums only."""
    return scratch.keep(features.merge_sums(_transfers(tx)).select("src", "dst", *columns), "merged")


def _communities(tx):
    """Members of the communities and their features, from transfers written once and merged once."""
    transfers = scratch.keep(_transfers(tx).select(*features.TRANSFER), "transfers")
    merged = scratch.keep(features.merge_transfers(transfers), "merged")
    members = features.community_vertices(merged, None)
    return members, features.community_features(merged, members, transfers)


MODE = "list_sort(list_transform(map_entries(histogram({c})), lambda e: {{'n': -(e.value::BIGINT), 'v': e.key}}))[1].v AS mode_{c}"
MERGE = (
    "sum(money)::BIGINT AS money, count(*) AS cnt, sum(CAST(round(charge * 10000) AS BIGINT))::BIGINT AS charge4, sum(CASE WHEN substr(loc_trans_tm, 1, 2) BETWEEN '01' AND '05' THEN 1 ELSE 0 END)::BIGINT AS night, count(CASE WHEN trans_md = '2' THEN 1 END) AS other_city, "
    + ", ".join([*[MODE.format(c=c) for c in features.MODES], *[f"count(DISTINCT {c}) AS n_{c}" for c in features.COUNTED]])
)
_COMM = (
    f"t AS MATERIALIZED (SELECT * FROM tx WHERE trans_id IN ('S33', 'S25') AND srccard <> dstcard), m AS MATERIALIZED (SELECT srccard AS src, dstcard AS dst, {MERGE} FROM t GROUP BY 1, 2),"
    "deg AS MATERIALIZED (SELECT vid, count(*) AS degree FROM (SELECT src AS vid FROM m UNION ALL SELECT dst FROM m) GROUP BY 1),"
    "k AS MATERIALIZED (SELECT m.* FROM m JOIN deg a ON a.vid = src JOIN deg b ON b.vid = dst WHERE a.degree + b.degree > 2),"
    "w AS MATERIALIZED (SELECT src AS a, dst AS b FROM k UNION SELECT dst, src FROM k), reach(a, r) AS (SELECT a, b FROM w UNION SELECT w.a, reach.r FROM w JOIN reach ON w.b = reach.a),"
    "cc AS MATERIALIZED (SELECT a AS vid, least(a, min(r)) AS cc FROM reach GROUP BY 1)"
)


_MEMBERS = (
    unrolled_labels("k")
    + ", mem AS MATERIALIZED (SELECT cc.vid, cc, core, in_degree, out_degree, degree, CASE WHEN amt_in > 0 AND amt_out > 0 AND (abs(amt_in - amt_out) < 500 OR abs(amt_in - amt_out)::DOUBLE / (amt_in + amt_out) < 0.01) THEN 1 ELSE 0 END AS transit FROM cc JOIN labels USING (vid) JOIN (SELECT vid, sum(i)::BIGINT AS in_degree, sum(1 - i)::BIGINT AS out_degree, count(*) AS degree, sum(money * i)::BIGINT AS amt_in, sum(money * (1 - i))::BIGINT AS amt_out FROM (SELECT dst AS vid, 1 AS i, money FROM k UNION ALL SELECT src, 0, money FROM k) GROUP BY 1) USING (vid)),"
    "comm AS MATERIALIZED (SELECT * FROM (SELECT cc, count(*) AS cc_num, max(core) AS max_core, max(in_degree) AS max_in, max(out_degree) AS max_out, max(degree) AS max_degree, count(CASE WHEN core > 4 THEN 1 END) AS big_core_num, sum(transit)::BIGINT AS transit_num FROM mem GROUP BY 1) JOIN (SELECT cc, sum(cnt)::BIGINT AS trans_num, sum(money)::BIGINT AS money, sum(charge4)::BIGINT / 10000 AS charge, sum(night)::BIGINT AS night, sum(other_city)::BIGINT AS other_city, count(DISTINCT mode_card_class) AS class_modes, count(DISTINCT mode_mchnt_tp) AS mchnt_tp_modes, count(DISTINCT mode_trans_chnl) AS channel_modes, count(DISTINCT mode_acpt_ins_tp) AS ins_tp_modes, count(DISTINCT mode_resp_cd4) AS resp_modes, max(n_acpt_bank) AS max_banks, max(n_mchnt_cd) AS max_merchants, max(n_term_id) AS max_terminals, max(n_fwd_ins_id_cd) AS max_fwd, max(n_rcv_ins_id_cd) AS max_rcv FROM m JOIN mem ON src = vid GROUP BY 1) USING (cc)"
    " JOIN (SELECT cc, count(DISTINCT region_cd) AS regions, count(DISTINCT mchnt_tp) AS mchnt_tps, count(DISTINCT mchnt_cd) AS merchants, count(DISTINCT address) AS addresses FROM t JOIN mem ON srccard = vid GROUP BY 1) USING (cc))"
)


@for_both("SELECT * FROM comm", f"{_COMM}, {_MEMBERS}")
def community_feature_vector(tx):
    return _communities(tx)[1]


@for_both("SELECT * FROM mem", f"{_COMM}, {_MEMBERS}")
def community_members(tx):
    return features.community_vertices(_merged(tx, "money", "cnt"), None)


@for_both("SELECT src, dst, money::BIGINT AS money, cnt, charge4, night::BIGINT AS night, other_city, " + ", ".join([*[f"mode_{c}" for c in features.MODES], *[f"n_{c}" for c in features.COUNTED]]) + f" FROM (SELECT srccard AS src, dstcard AS dst, {MERGE} FROM tx WHERE trans_id IN ('S33', 'S25') AND srccard <> dstcard GROUP BY 1, 2)")
def merged_transfers_five_modes(tx):
    """All transfers merged by pair: five modes and five distinct counts."""
    return features.merge_transfers(_transfers(tx))


@for_both("SELECT cc, count(DISTINCT region_cd) AS regions, count(DISTINCT term_id) AS terminals, count(DISTINCT trans_chnl) AS channels FROM t JOIN cc ON srccard = vid GROUP BY 1", f"{_COMM}")
def component_distinct_counts(tx):
    cc = connected_components(graph.without_lone_pairs(_merged(tx)))
    return features.community_distinct(_transfers(tx), cc, {"regions": "region_cd", "terminals": "term_id", "channels": "trans_chnl"})


@for_both("SELECT m.src, m.dst, m.money::BIGINT AS money FROM m WHERE src IN (SELECT vid FROM mem JOIN comm USING (cc) WHERE max_core > 1 AND max_degree > 3) OR dst IN (SELECT vid FROM mem JOIN comm USING (cc) WHERE max_core > 1 AND max_degree > 3)", f"{_COMM}, {_MEMBERS}")
def edges_of_chosen_communities(tx):
    merged = _merged(tx, "money", "cnt")
    m = features.community_vertices(merged, None)
    chosen = m.groupBy("cc").agg(F.max("core").alias("core"), F.max("degree").alias("degree")).where("core > 1 and degree > 3")
    return graph.touching_communities(merged, m, chosen).select("src", "dst", "money")


_ALL_WEIGHTS: dict[str, float] = {}
for _names, _w in ((features.FULL, 1.0), (features.HALF, 0.5), (features.QUARTER, 0.25)):
    for _n in _names:
        _ALL_WEIGHTS[_n] = _ALL_WEIGHTS.get(_n, 0.0) + _w

_SUMMARY = "chosen AS (SELECT cc FROM mem GROUP BY 1 HAVING count(*) BETWEEN 4 AND 4000)"


def _stored(tx):
    """Merged edges stored by community, and what is known of each community."""
    merged = _merged(tx, "money", "cnt")
    m = features.community_vertices(merged, None)
    path = scratch.new_path(tx.sparkSession, "communities")
    communities.store(merged.select("src", "dst", "money"), m, path)
    return path, scratch.keep(m.groupBy("cc").agg(F.count("*").alias("size")), "summary")


@for_both("SELECT cc, src, dst, money::BIGINT AS money FROM k JOIN cc ON src = vid WHERE cc IN (SELECT cc FROM chosen)", f"{_COMM}, {_MEMBERS}, {_SUMMARY}")
def stored_edges_of_chosen_communities(tx):
    """As edges_of_chosen_communities, from edges stored by community: others' folders are not read."""
    path, summary = _stored(tx)
    return communities.edges_of(tx.sparkSession, path, summary.where("size between 4 and 4000")).select("cc", "src", "dst", "money")


@for_both("SELECT cc, src, dst, money::BIGINT AS money FROM k JOIN cc ON src = vid WHERE cc IN (SELECT cc FROM k JOIN cc ON src = vid GROUP BY 1 HAVING count(*) >= 6)", _COMM)
def community_dump_read_back(tx):
    """The edges of every community of six edges or more, a folder for each, read back with the community from the folder's name."""
    e = graph.without_lone_pairs(_merged(tx, "money"))
    cc = connected_components(e)
    path = scratch.new_path(tx.sparkSession, "dump")
    io.write_groups(e.select("src", "dst", "money").join(cc.select(F.col("vid").alias("src"), "cc"), "src"), path, "cc", 6)
    return tx.sparkSession.read.schema("src long, dst long, money long, cc long").parquet(path)


@for_both("SELECT src, dst, money::BIGINT AS money FROM k JOIN cc ON src = vid WHERE cc = (SELECT cc FROM cc GROUP BY 1 ORDER BY count(*) DESC, cc LIMIT 1)", _COMM)
def edges_of_largest_community(tx):
    """The subgraph of one label: the community of most cards, of equal ones that of the smallest."""
    e = graph.without_lone_pairs(_merged(tx, "money"))
    cc = scratch.keep(connected_components(e), "cc")
    largest = cc.groupBy("cc").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "cc").limit(1).select("cc")
    return graph.subgraph(e, R.restricted(cc, largest, "cc")).select("src", "dst", "money")


@query(f"SELECT c_name AS oricard, score FROM (SELECT c_custkey AS card, c_name FROM customer WHERE {LISTED}) LEFT JOIN (%s) USING (card)" % ("SELECT card, " + " + ".join(f"{w}::DOUBLE * dense_rank() OVER (ORDER BY coalesce({k}, 0))" for k, w in _ALL_WEIGHTS.items()) + " AS score FROM cards LEFT JOIN (SELECT vid AS card, comm.* FROM mem JOIN comm USING (cc)) USING (card)"), f"{TX}, {_CARDS}, {_COMM}, {_MEMBERS}")
def command_line_scores(spark, d):
    """The command line on a file of listed cards, half of them by MD5; its one output file read back. Enough hops reach every card of the test tables."""
    listed, out = scratch.new_path(spark, "cards"), scratch.new_path(spark, "scores")
    card = F.col("c_custkey").cast("string")
    io.write_lines(table(spark, d, "customer").where(LISTED).select("c_name", F.when(F.col("c_custkey") % 2 == 0, F.md5(card)).otherwise(card).alias("card")), listed)
    cli.score(spark, listed, d, out, hops=60)
    return io.read_delimited(spark, out, T.StructType([T.StructField("oricard", T.StringType()), T.StructField("score", T.DoubleType())]), ",")


@for_both("SELECT cc, cc_num, trans_num::BIGINT AS trans_num, money::BIGINT AS money, night::BIGINT AS night, other_city::BIGINT AS other_city FROM (SELECT cc, count(*) AS cc_num FROM cc GROUP BY 1) JOIN (SELECT cc, sum(cnt)::BIGINT AS trans_num, sum(money)::BIGINT AS money, sum(night)::BIGINT AS night, sum(other_city)::BIGINT AS other_city FROM k JOIN cc ON src = vid GROUP BY 1) USING (cc)", f"{_COMM}")
def community_totals(tx):
    e = graph.without_lone_pairs(_merged(tx, "cnt", "money", "night", "other_city"))
    cc = connected_components(e)
    inside = e.join(cc.select(F.col("vid").alias("src"), "cc"), "src").groupBy("cc").agg(F.sum("cnt").alias("trans_num"), F.sum("money").alias("money"), F.sum("night").alias("night"), F.sum("other_city").alias("other_city"))
    return cc.groupBy("cc").agg(F.count("*").alias("cc_num")).join(inside, "cc")


@for_both("SELECT cc, vid, place FROM (SELECT *, row_number() OVER (PARTITION BY cc ORDER BY core DESC, degree DESC, in_degree DESC, out_degree DESC, transit DESC, vid) AS place FROM mem) WHERE place < 100", f"{_COMM}, {_MEMBERS}")
def top_members_of_communities(tx):
    m = features.community_vertices(_merged(tx, "money", "cnt"), None)
    return R.top_in_group(m, "cc", 99, F.desc("core"), F.desc("degree"), F.desc("in_degree"), F.desc("out_degree"), F.desc("transit"), F.asc("vid")).select("cc", "vid", "place")


@for_both("SELECT * FROM comm WHERE cc_num < 2000 ORDER BY max_degree DESC, big_core_num DESC, money DESC, max_core DESC, trans_num DESC, cc LIMIT 100", f"{_COMM}, {_MEMBERS}")
def top_100_communities(tx):
    c = _communities(tx)[1].where("cc_num < 2000")
    return c.orderBy(F.desc("max_degree"), F.desc("big_core_num"), F.desc("money"), F.desc("max_core"), F.desc("trans_num"), "cc").limit(100)


@for_both("SELECT card, " + " + ".join(f"{w}::DOUBLE * dense_rank() OVER (ORDER BY coalesce({k}, 0))" for k, w in _ALL_WEIGHTS.items()) + " AS score FROM cards LEFT JOIN (SELECT vid AS card, comm.* FROM mem JOIN comm USING (cc)) USING (card)", f"{_CARDS}, {_COMM}, {_MEMBERS}")
def card_and_community_score(tx):
    """Card features with those of the card's community, nulls as zero, ranked and summed."""
    m, c = _communities(tx)
    c = m.select(F.col("vid").alias("card"), "cc").join(c, "cc").drop("cc")
    return features.rank_sum_score(features.card_features(tx).join(c, "card", "left"))


_HET = "het AS (" + " UNION ALL ".join(f"SELECT 'card:' || srccard AS src, '{k}:' || {c} AS dst, '{t}' AS edge_type, money, CASE WHEN substr(loc_trans_tm, 1, 2) BETWEEN '01' AND '05' THEN 1 ELSE 0 END AS night FROM tx WHERE trans_id IN ({', '.join(repr(x) for x in codes)})" for t, (codes, k, c) in hetero.EDGE_TYPES.items()) + ")"


@query("SELECT src, dst, edge_type, sum(money)::BIGINT AS money, count(*) AS cnt, sum(night)::BIGINT AS night FROM het GROUP BY 1, 2, 3", f"{TX}, {_HET}")
def mixed_graph_edges(spark, d):
    return hetero.typed_edges(transactions(spark, d))


@query("SELECT vid, split_part(vid, ':', 1) AS vertex_type, split_part(vid, ':', 2) AS value FROM (SELECT src AS vid FROM het UNION SELECT dst FROM het)", f"{TX}, {_HET}")
def mixed_graph_vertices(spark, d):
    return hetero.typed_vertices(hetero.typed_edges(transactions(spark, d)))


@query("SELECT vertex_type, count(*) AS n FROM (SELECT DISTINCT vid, split_part(vid, ':', 1) AS vertex_type FROM (SELECT src AS vid FROM het UNION SELECT dst FROM het)) GROUP BY 1", f"{TX}, {_HET}")
def mixed_graph_vertex_counts(spark, d):
    return hetero.typed_vertices(hetero.typed_edges(transactions(spark, d))).groupBy("vertex_type").agg(F.count("*").alias("n"))


_HCC = "h AS (SELECT * FROM het WHERE edge_type IN ('trans_at', 'quxian_at')), names AS (SELECT 'card:' || vid AS vid, cc FROM cc)"


def _regions(tx):
    m = connected_components(graph.without_lone_pairs(_merged(tx))).select(F.concat(F.lit("card:"), F.col("vid").cast("string")).alias("vid"), "cc")
    return hetero.regions_of_communities(hetero.typed_edges(tx, hetero.TO_REGIONS), m)


@for_both("SELECT cc, count(DISTINCT dst) AS regions FROM h JOIN names ON src = vid GROUP BY 1", f"{_COMM}, {_HET}, {_HCC}")
def regions_per_community(tx):
    return _regions(tx)[0]


@for_both("SELECT dst AS region, count(DISTINCT cc) AS communities FROM h JOIN names ON src = vid GROUP BY 1", f"{_COMM}, {_HET}, {_HCC}")
def communities_per_region(tx):
    return _regions(tx)[1]
