"""Queries on day and week profiles, time gaps and money flow."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import flow, gaps, graph, profiles, states
from ledgerlens.operators import relational as R
from ledgerlens.plans import scratch
from ledgerlens.registry import query
from ledgerlens.sources.transactions import EDGES, TX, table, transactions, transfer_edges

_PROFILE = "sum(money)::BIGINT AS amount, count(*) AS cnt, round(avg(money), 4) AS mean, round(stddev_pop(money), 4) AS dev, round(stddev_pop(money) / nullif(avg(money), 0), 6) AS cv, count(DISTINCT region_cd) AS places, count(CASE WHEN trans_md <> '1' THEN 1 END) AS away"
_DAYS = f"days AS (SELECT card, pdate, {_PROFILE} FROM tx GROUP BY 1, 2)"
_AVERAGES = "averages AS (SELECT card, round(avg(amount), 4) AS dam, round(avg(cnt), 4) AS dac, round(avg(cv), 4) AS dacv, CAST(floor(avg(places)) AS BIGINT) AS dloc, CAST(floor(avg(away)) AS BIGINT) AS daway FROM days GROUP BY 1)"
_SECS = "CAST(epoch(day) + secs AS BIGINT) AS at_s"


def _days(spark, d):
    return profiles.profile(transactions(spark, d), ["card", "pdate"])


def _timed(spark, d):
    """Transactions with a time in seconds."""
    return transactions(spark, d).withColumn("at", F.unix_timestamp(F.col("day").cast("timestamp")) + F.col("secs"))


@query("SELECT * FROM days", f"{TX}, {_DAYS}")
def day_profile(spark, d):
    return _days(spark, d)


@query(f"SELECT card, {_PROFILE} FROM tx GROUP BY 1", TX)
def period_profile(spark, d):
    return profiles.profile(transactions(spark, d), ["card"])


@query(f"SELECT srccard, {_PROFILE} FROM tx WHERE trans_id = 'S25' GROUP BY 1", TX)
def sender_profile(spark, d):
    return profiles.profile(transactions(spark, d).where("trans_id = 'S25'"), ["srccard"])


@query("SELECT * FROM averages", f"{TX}, {_DAYS}, {_AVERAGES}")
def average_days(spark, d):
    return profiles.averages_of_days(_days(spark, d))


@query("SELECT days.card, pdate, round(amount / nullif(dam, 0), 4) AS amount_ratio, round(cnt / nullif(dac, 0), 4) AS count_ratio FROM days JOIN averages ON days.card = averages.card", f"{TX}, {_DAYS}, {_AVERAGES}")
def abnormal_day_ratios(spark, d):
    days = scratch.keep(_days(spark, d), "days")
    return profiles.abnormal_days(days, profiles.averages_of_days(days))


@query("SELECT card, CAST(date_diff('day', DATE '1992-01-01', day) // 7 AS INTEGER) AS week, sum(money)::BIGINT AS amount, count(*) AS cnt FROM tx GROUP BY 1, 2", TX)
def week_sums(spark, d):
    week = F.floor(F.date_diff(F.col("day"), F.lit("1992-01-01").cast("date")) / 7).cast("int")
    return transactions(spark, d).groupBy("card", week.alias("week")).agg(F.sum("money").alias("amount"), F.count("*").alias("cnt"))


@query("SELECT card, count(*) AS weeks, round(var_pop(amount) / nullif(avg(amount), 0), 4) AS dispersion FROM (SELECT card, date_diff('day', DATE '1992-01-01', day) // 7 AS week, sum(money)::BIGINT / 100.0 AS amount FROM tx GROUP BY 1, 2) GROUP BY 1", TX)
def week_dispersion(spark, d):
    week = F.floor(F.date_diff(F.col("day"), F.lit("1992-01-01").cast("date")) / 7).cast("int")
    return profiles.dispersion(transactions(spark, d).groupBy("card", week.alias("week")).agg((F.sum("money") / 100).alias("amount")), "card", "amount")


@query("SELECT srccard, date_diff('day', DATE '1992-01-01', day) // 7 AS week, sum(money)::BIGINT AS amount, count(*) AS cnt, count(DISTINCT dstcard) AS receivers, count(DISTINCT CASE WHEN length(region_cd || mchnt_cd) > 4 THEN substr(region_cd || mchnt_cd, 5) ELSE '0000' END) AS places, count(DISTINCT pdate) AS days FROM tx WHERE trans_id = 'S25' GROUP BY 1, 2", TX)
def week_sets(spark, d):
    t = transactions(spark, d).where("trans_id = 'S25'").withColumn("place", profiles.location(F.concat("region_cd", "mchnt_cd")))
    week = F.floor(F.date_diff(F.col("day"), F.lit("1992-01-01").cast("date")) / 7).cast("long")
    return t.groupBy("srccard", week.alias("week")).agg(F.sum("money").alias("amount"), F.count("*").alias("cnt"), F.count_distinct("dstcard").alias("receivers"), F.count_distinct("place").alias("places"), F.count_distinct("pdate").alias("days"))


_WEEK = "CAST(date_diff('day', DATE '1992-01-01', day) // 7 AS INTEGER)"


def _states(spark, d):
    """A state for each card and day, kept: all that the merged profiles read."""
    nations = table(spark, d, "nation").count()
    return scratch.keep(states.day_states(transactions(spark, d), ["card", "day"], F.col("region_cd").cast("int") - 1000, nations), "states")


@query(f"SELECT card, {_PROFILE} FROM tx GROUP BY 1", TX)
def period_profile_of_days(spark, d):
    """The period's profile out of day states."""
    return states.profile_of(states.merge(_states(spark, d), "card"), "card")


@query(f"SELECT card, {_WEEK} AS week, {_PROFILE} FROM tx GROUP BY 1, 2", TX)
def week_profile_of_days(spark, d):
    week = F.floor(F.date_diff(F.col("day"), F.lit("1992-01-01").cast("date")) / 7).cast("int")
    return states.profile_of(states.merge(_states(spark, d).withColumn("week", week), "card", "week"), "card", "week")


@query(f"SELECT card, {_PROFILE}, min(money) AS least, max(money) AS most FROM tx GROUP BY 1", TX)
def period_profile_of_weeks_of_days(spark, d):
    """Merged twice, days to weeks and weeks to the period, with the extremes."""
    week = F.floor(F.date_diff(F.col("day"), F.lit("1992-01-01").cast("date")) / 7).cast("int")
    weeks = states.merge(_states(spark, d).withColumn("week", week), "card", "week")
    return states.profile_of(states.merge(weeks, "card").select("*"), "card", "least", "most")


def _lag(key, where, cols, order="at_s DESC, tid, money", extra=""):
    return f"SELECT {cols}{extra} FROM (SELECT *, round(abs(at_s - lag(at_s) OVER w) / 60.0, 2) AS gap_minutes, lag(money) OVER w AS prev_money, lag(card) OVER w AS prev_card FROM (SELECT *, {_SECS} FROM tx) WHERE {where} WINDOW w AS (PARTITION BY {key} ORDER BY {order}))"


@query(_lag("card", "trans_id IN ('S33', 'S25')", "tid, card, pdate, gap_minutes", extra=", CASE WHEN prev_money - money >= 0 THEN prev_money - money END AS gap_money, round(CASE WHEN prev_money - money >= 0 THEN prev_money - money END / nullif(gap_minutes, 0), 4) AS gap_rate"), TX)
def transfer_gaps(spark, d):
    t = _timed(spark, d).where("trans_id in ('S33', 'S25')").select("tid", "card", "pdate", "money", "at")
    return gaps.amount_gaps(t, "card", F.col("at"), "money", "tid", "money").select("tid", "card", "pdate", "gap_minutes", "gap_money", "gap_rate")


@query("SELECT card, at_s, money, CAST(floor((at_s - lag(at_s) OVER (PARTITION BY card ORDER BY at_s, money)) / 60) AS BIGINT) AS gap FROM (SELECT DISTINCT card, CAST(epoch(day) + secs AS BIGINT) AS at_s, money FROM tx)", TX)
def ascending_gaps_of_distinct(spark, d):
    t = _timed(spark, d).select("card", "at", "money").distinct()
    g = gaps.gaps(t, "card", F.col("at"), "money", descending=False, carry=("at",))
    return g.select("card", F.col("at").alias("at_s"), "money", F.floor((F.col("at") - F.col("prev_at")) / 60).cast("long").alias("gap"))


@query(_lag("card", "trans_id = 'S24'", "tid, card, pdate, money, mchnt_cd || term_id AS atm, gap_minutes"), TX)
def withdrawal_gaps_of_card(spark, d):
    t = _timed(spark, d).where("trans_id = 'S24'").select("tid", "card", "pdate", "money", F.concat("mchnt_cd", "term_id").alias("atm"), "at")
    return gaps.gaps(t, "card", F.col("at"), "tid", "money").drop("at")


@query(_lag("mchnt_cd || term_id", "trans_id = 'S24'", "tid, mchnt_cd || term_id AS atm, pdate, money, card, gap_minutes"), TX)
def withdrawal_gaps_of_atm(spark, d):
    t = _timed(spark, d).where("trans_id = 'S24'").select("tid", F.concat("mchnt_cd", "term_id").alias("atm"), "pdate", "money", "card", "at")
    return gaps.gaps(t, "atm", F.col("at"), "tid", "money").drop("at")


@query(_lag("card", "trans_id = 'S24' AND trans_md = '4'", "tid, card, pdate, money, trans_md, gap_minutes"), TX)
def cross_border_gaps(spark, d):
    t = _timed(spark, d).where("trans_id = 'S24' and trans_md = '4'").select("tid", "card", "pdate", "money", "trans_md", "at")
    return gaps.gaps(t, "card", F.col("at"), "tid", "money").drop("at")


@query(_lag("mchnt_cd || term_id", "trans_id = 'S24' AND trans_md = '2' AND money >= 500000", "tid, mchnt_cd || term_id AS atm, pdate, money, card, gap_minutes, CASE WHEN prev_card IS NULL OR prev_card <> card THEN 1 ELSE 0 END AS card_diff"), TX)
def other_city_gaps_with_switch(spark, d):
    t = _timed(spark, d).where("trans_id = 'S24' and trans_md = '2' and money >= 500000").select("tid", F.concat("mchnt_cd", "term_id").alias("atm"), "pdate", "money", "card", "at")
    return gaps.with_switch(gaps.gaps(t, "atm", F.col("at"), "tid", "money", carry=("card",)), "card").drop("at", "prev_card")


@query("SELECT user_id, count(*) AS n, round(avg(gap), 4) AS mean_gap FROM (SELECT user_id, round(abs(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id)) / 60e6, 2) AS gap FROM events) GROUP BY 1")
def mean_event_gaps(spark, d):
    e = table(spark, d, "events").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    return gaps.gaps(e, "user_id", F.col("at"), "event_id").groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.avg("gap_minutes"), 4).alias("mean_gap"))


_FLOW = "ends AS (SELECT dst AS vid, TRUE AS i, money, cnt, foreign_cnt FROM edges UNION ALL SELECT src, FALSE, money, cnt, foreign_cnt FROM edges), flow AS (SELECT vid, sum(CASE WHEN i THEN money ELSE 0 END)::BIGINT AS amt_in, sum(CASE WHEN i THEN cnt ELSE 0 END)::BIGINT AS cnt_in, sum(CASE WHEN NOT i THEN money ELSE 0 END)::BIGINT AS amt_out, sum(CASE WHEN NOT i THEN cnt ELSE 0 END)::BIGINT AS cnt_out, sum(money)::BIGINT AS amt_all, sum(cnt)::BIGINT AS cnt_all, sum(foreign_cnt)::BIGINT AS foreign_cnt FROM ends GROUP BY 1), flows AS (SELECT *, abs(amt_in - amt_out) AS net, round(abs(amt_in - amt_out)::DOUBLE / nullif(amt_in + amt_out, 0), 6) AS net_ratio FROM flow)"


@query("SELECT vid, amt_in::BIGINT AS amt_in, cnt_in::BIGINT AS cnt_in, amt_out::BIGINT AS amt_out, cnt_out::BIGINT AS cnt_out, amt_all::BIGINT AS amt_all, cnt_all::BIGINT AS cnt_all, foreign_cnt::BIGINT AS foreign_cnt, net::BIGINT AS net, net_ratio FROM flows", f"{EDGES}, {_FLOW}")
def money_in_out(spark, d):
    return flow.in_out(transfer_edges(spark, d), "money", "cnt", "foreign_cnt")


@query("SELECT vid, CASE WHEN amt_in > 0 AND amt_out > 0 AND (net < 50000 OR net_ratio < 0.01) THEN 1 ELSE 0 END AS transit FROM flows", f"{EDGES}, {_FLOW}")
def transit_vertices(spark, d):
    f = flow.in_out(transfer_edges(spark, d))
    return f.select("vid", flow.transit(F.col("amt_in"), F.col("amt_out"), 50000, ratio=F.col("net_ratio")).alias("transit"))


@query("SELECT vid, CASE WHEN net <= 500000 THEN 1 ELSE 0 END AS balanced FROM flows", f"{EDGES}, {_FLOW}")
def low_net_income(spark, d):
    return flow.in_out(transfer_edges(spark, d)).select("vid", F.when(F.col("net") <= 500000, 1).otherwise(0).alias("balanced"))


_RANKED = "vs AS MATERIALIZED (SELECT src AS vid FROM edges UNION SELECT dst FROM edges), share AS MATERIALIZED (SELECT src, dst, 1.0::DOUBLE / count(*) OVER (PARTITION BY src) AS share FROM edges), r0 AS (SELECT vid, 1.0::DOUBLE AS rank FROM vs), " + ", ".join(f"r{i + 1} AS MATERIALIZED (SELECT vid, 0.15 + 0.85 * coalesce(got, 0) AS rank FROM vs LEFT JOIN (SELECT dst, sum(rank * share) AS got FROM share JOIN r{i} ON src = vid GROUP BY 1) ON dst = vid)" for i in range(6))
_METRICS = _RANKED + (
    ", degs AS (SELECT vid, sum(CASE WHEN i THEN 1 ELSE 0 END)::BIGINT AS in_degree, sum(CASE WHEN i THEN 0 ELSE 1 END)::BIGINT AS out_degree, count(*) AS degree FROM ends GROUP BY 1)"
    ", metrics AS MATERIALIZED (SELECT vid, amt_all, cnt_all, net_ratio, foreign_cnt, in_degree, out_degree, degree, round(in_degree::DOUBLE / degree, 9) AS in_ratio, round(out_degree::DOUBLE / degree, 9) AS out_ratio, round(rank, 9) AS rank FROM flows JOIN degs USING (vid) JOIN r6 USING (vid))"
    + "".join(f", l_{k} AS MATERIALIZED (SELECT vid FROM metrics WHERE {c} IS NOT NULL ORDER BY {c} {'ASC' if up else 'DESC'}, vid LIMIT 300)" for k, (c, up) in flow.METRICS.items())
)
_INTERSECT = lambda *k: " INTERSECT ".join(f"SELECT vid FROM l_{x}" for x in k)
_SQL_SETS = {
    "MaxInOut": _INTERSECT("out", "in"),
    "MostSum": _INTERSECT("amount", "count"),
    "MostSumRatio": "SELECT vid FROM MostSum INTERSECT SELECT vid FROM l_ratio",
    "MostSumForeign": "SELECT vid FROM MostSum INTERSECT SELECT vid FROM l_foreign",
    "MostDeg": _INTERSECT("deg", "rank"),
    "DegInRatio": _INTERSECT("deg", "in_ratio"),
    "DegOutRatio": _INTERSECT("deg", "out_ratio"),
    "MostSuspectDeg": "SELECT vid FROM DegInRatio UNION SELECT vid FROM DegOutRatio",
    "MostDegSum": "SELECT vid FROM MostDeg JOIN MostSum USING (vid)",
    "MostDegSumForeign": "SELECT vid FROM MostDeg JOIN MostSumForeign USING (vid)",
    "MostSuspectSum": "SELECT vid FROM MostSumForeign INTERSECT SELECT vid FROM l_ratio",
    "maybe_useful": "SELECT vid FROM MostSuspectDeg JOIN MostSumForeign USING (vid)",
    "MostSuspect": "SELECT vid FROM MostSuspectDeg JOIN MostSumRatio USING (vid)",
    "MostSuspectAll": "SELECT vid FROM MostSuspectSum JOIN MostSuspectDeg USING (vid)",
}
_SUSPECTS = _METRICS + "".join(f", {k} AS ({q})" for k, q in _SQL_SETS.items())


def _metrics(spark, d):
    """Money flow, degrees and rank of every card in one row."""
    e = scratch.keep(transfer_edges(spark, d), "edges")
    ratio = lambda c: F.round(F.col(c).cast("double") / F.col("degree"), 9)
    f = flow.in_out(e, "money", "cnt", "foreign_cnt").join(graph.degrees(e), "vid").join(graph.page_rank(e, rounds=6), "vid")
    return scratch.keep(f.select("vid", "amt_all", "cnt_all", "net_ratio", "foreign_cnt", "in_degree", "out_degree", "degree", ratio("in_degree").alias("in_ratio"), ratio("out_degree").alias("out_ratio"), F.round("rank", 9).alias("rank")), "metrics")


@query(" UNION ALL ".join(f"SELECT '{k}' AS set, vid FROM {k}" for k in _SQL_SETS), f"{EDGES}, {_FLOW}, {_SUSPECTS}")
def suspect_sets(spark, d):
    """The members of all fourteen suspect sets, from lists of the first 300 by ten metrics."""
    return flow.suspect_sets(_metrics(spark, d), 300)


@query("SELECT vid, amt_all::BIGINT AS amt_all, cnt_all::BIGINT AS cnt_all FROM metrics JOIN l_count USING (vid) JOIN l_ratio USING (vid)", f"{EDGES}, {_FLOW}, {_METRICS}")
def suspects_joined(spark, d):
    m = _metrics(spark, d)
    return m.join(flow.first_by_metric(m, 300).where("`count` and ratio").select("vid"), "vid", "left_semi").select("vid", "amt_all", "cnt_all")


_GAPS = "gapped AS (SELECT card, pdate, round(abs(at_s - lag(at_s) OVER (PARTITION BY card ORDER BY at_s DESC, tid, money)) / 60.0, 2) AS gap FROM (SELECT *, " + _SECS + " FROM tx) WHERE trans_id IN ('S33', 'S25'))"


def _gaps(spark, d):
    t = _timed(spark, d).where("trans_id in ('S33', 'S25')").select("tid", "card", "pdate", "money", "at")
    return gaps.gaps(t, "card", F.col("at"), "tid", "money")


@query("SELECT card, pdate, round(avg(gap), 4) AS mean_gap FROM gapped WHERE gap IS NOT NULL GROUP BY 1, 2", f"{TX}, {_GAPS}")
def mean_gaps_by_card_and_day(spark, d):
    return gaps.mean_gaps(_gaps(spark, d), "card", "pdate")


@query("SELECT card, round(avg(gap), 4) AS mean_gap FROM gapped WHERE gap IS NOT NULL GROUP BY 1", f"{TX}, {_GAPS}")
def mean_gaps_by_card(spark, d):
    return gaps.mean_gaps(_gaps(spark, d), "card")


@query("SELECT averages.*, dadt FROM averages LEFT JOIN (SELECT card, round(avg(mean_gap), 4) AS dadt FROM (SELECT card, pdate, round(avg(gap), 4) AS mean_gap FROM gapped WHERE gap IS NOT NULL GROUP BY 1, 2) GROUP BY 1) USING (card)", f"{TX}, {_DAYS}, {_AVERAGES}, {_GAPS}")
def average_days_with_gaps(spark, d):
    """Means of the daily values with the mean of the daily mean gaps."""
    daily = gaps.mean_gaps(_gaps(spark, d), "card", "pdate").groupBy("card").agg(F.round(F.avg("mean_gap"), 4).alias("dadt"))
    return profiles.averages_of_days(_days(spark, d)).join(daily, "card", "left")


_ID = "CASE WHEN substr(md5({c}), 1, 1) >= '8' THEN ((607431768211456 - {u}) % 1000000000000000 + 1000000000000000) % 1000000000000000 ELSE {u} END::BIGINT"
_U = "(((('0x' || substr(md5({c}), 1, 16))::UBIGINT::HUGEINT % 1000000000000000) * 744073709551616 + ('0x' || substr(md5({c}), 17, 16))::UBIGINT::HUGEINT % 1000000000000000) % 1000000000000000)"


def _md5_sql(column: str) -> str:
    text = f"CAST({column} AS STRING)"
    return _ID.format(c=text, u=_U.format(c=text))


@query(f"SELECT in_card, {_md5_sql('in_card')} AS in_id, out_card, {_md5_sql('out_card')} AS out_id, msum::BIGINT AS msum, csum, locsum, foreignsum FROM (SELECT dstcard AS in_card, srccard AS out_card, sum(money)::BIGINT AS msum, count(*) AS csum, count(DISTINCT substr(region_cd || mchnt_cd, 5)) AS locsum, count(CASE WHEN trans_md = '2' THEN 1 END) AS foreignsum FROM tx WHERE trans_id IN ('S33', 'S25') GROUP BY 1, 2)", TX)
def pair_statistics_with_ids(spark, d):
    """Transfers by receiver and sender with hashed ids of both."""
    t = transactions(spark, d).where("trans_id in ('S33', 'S25')")
    return profiles.pair_statistics(t.withColumn("place", profiles.location(F.concat("region_cd", "mchnt_cd"))))


@query("SELECT metric, place, vid FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS metric, row_number() OVER (ORDER BY {c} {'ASC' if up else 'DESC'} NULLS LAST, vid) AS place, vid FROM metrics" for k, (c, up) in flow.METRICS.items()) + ")", f"{EDGES}, {_FLOW}, {_METRICS}")
def sorted_by_each_metric(spark, d):
    """The whole table in the order of each of ten metrics, places numbered range by range in one sort of all of them."""
    m = _metrics(spark, d)
    values = [F.struct(F.lit(k).alias("metric"), F.col(c).isNull().alias("none"), (F.col(c) if up else -F.col(c)).cast("double").alias("v")) for k, (c, up) in flow.METRICS.items()]
    rows = m.select("vid", F.explode(F.array(*values)).alias("x")).select("x.*", "vid")
    numbered = R.with_index(rows, "metric", "none", "v", "vid", name="n")
    before = numbered.groupBy("metric").agg((F.min("n") - 1).alias("before"))  # one row a metric
    return numbered.join(F.broadcast(before), "metric").select("metric", (F.col("n") - F.col("before")).cast("long").alias("place"), "vid")
