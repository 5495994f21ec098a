"""Queries on single operators: projection, filters, joins, aggregation, order and sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as X
from ledgerlens.operators import relational as R
from ledgerlens.registry import query
from ledgerlens.sources.io import dates_of, read_events
from ledgerlens.sources.transactions import EDGES, TX, table, transactions, transfer_edges


@query("SELECT srccard AS src, dstcard AS dst, sum(money)::BIGINT AS amount, count(*) AS cnt FROM tx WHERE trans_id IN ('S33', 'S25') GROUP BY 1, 2 HAVING sum(money)::BIGINT > 10000000", TX)
def pair_totals_having(spark: SparkSession, d: str) -> DataFrame:
    e = transfer_edges(spark, d)
    return e.where("money > 10000000").select("src", "dst", F.col("money").alias("amount"), "cnt")


@query("SELECT tid, srccard, dstcard, money, charge, pdate, loc_trans_tm, region_cd, trans_md, mchnt_cd, term_id, trans_id, card FROM tx WHERE pdate BETWEEN '19950101' AND '19951231' AND trans_id = 'S33'", TX)
def scan_date_range(spark, d):
    t = transactions(spark, d).where(F.col("day").between("1995-01-01", "1995-12-31") & (F.col("trans_id") == "S33"))
    return t.select("tid", "srccard", "dstcard", "money", "charge", "pdate", "loc_trans_tm", "region_cd", "trans_md", "mchnt_cd", "term_id", "trans_id", "card")


@query("SELECT CASE WHEN trans_id IN ('S33', 'S25') THEN 'transfer' WHEN trans_id = 'S24' THEN 'withdrawal' WHEN trans_id = 'S00' THEN 'query' ELSE 'purchase' END AS event, count(*) AS n, sum(money)::BIGINT AS money FROM tx WHERE trans_id IN ('S33', 'S25', 'S24', 'S00', 'S22') GROUP BY 1", TX)
def four_events(spark, d):
    t = transactions(spark, d).select("trans_id", "money")
    parts = [v.withColumn("event", F.lit(k)) for k, v in read_events(t).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("event").agg(F.count("*").alias("n"), F.sum("money").alias("money"))


_DATES = "ends AS (SELECT {} AS a, max(pdate) AS b FROM tx), calendar AS (SELECT strftime(strptime(a, '%Y%m%d') + to_days(i::INTEGER), '%Y%m%d') AS pdate, i::INTEGER AS day_index FROM ends, range(0, 10000) t(i) WHERE i <= date_diff('day', strptime(a, '%Y%m%d'), strptime(b, '%Y%m%d')))"


@query("SELECT pdate, day_index FROM calendar", f"{TX}, {_DATES.format("'19920101'")}")
def date_dictionary_1992(spark, d):
    """Every day from the first of 1992 to that of the last transaction."""
    return dates_of(transactions(spark, d), first="19920101")


@query("SELECT pdate, day_index, count(tid) AS cnt, coalesce(sum(money)::BIGINT, 0) AS money FROM calendar LEFT JOIN tx USING (pdate) GROUP BY 1, 2", f"{TX}, {_DATES.format('min(pdate)')}")
def sums_of_every_day(spark, d):
    """All days of the tables' calendar, those without a transaction with zeros."""
    t = transactions(spark, d)
    days = t.groupBy("pdate").agg(F.count("*").alias("cnt"), F.sum("money").alias("money"))
    return dates_of(t).join(days, "pdate", "left").fillna(0, ["cnt", "money"])


@query("SELECT tid, right(region_cd, 2) AS region_tail, left(acpt_bank, 2) AS bank_head, trim(mchnt_cd) AS mchnt, substr(pdate, 5, 4) AS month_day, CAST(money AS DOUBLE) / 100 AS yuan, reverse(pdate) AS reversed, concat(mchnt_cd, term_id) AS atm FROM tx", TX)
def project_cast_substring(spark, d):
    t = transactions(spark, d)
    return t.select("tid", F.right("region_cd", F.lit(2)).alias("region_tail"), F.left("acpt_bank", F.lit(2)).alias("bank_head"), F.trim("mchnt_cd").alias("mchnt"), F.substring("pdate", 5, 4).alias("month_day"), (F.col("money").cast("double") / 100).alias("yuan"), F.reverse("pdate").alias("reversed"), F.concat("mchnt_cd", "term_id").alias("atm"))


@query("SELECT tid, money FROM tx WHERE pdate > '19960101' AND pdate < '19960201' AND resp_cd4 = '00' AND trans_id <> '' AND mchnt_cd IS NOT NULL AND trans_id NOT IN ('S00', 'S31')", TX)
def filter_exclusive_dates_not_in(spark, d):
    t = transactions(spark, d).where((F.col("day") > "1996-01-01") & (F.col("day") < "1996-02-01") & (F.col("resp_cd4") == "00") & (F.col("trans_id") != "") & F.col("mchnt_cd").isNotNull())
    return R.without(t, "trans_id", ["S00", "S31"]).select("tid", "money")


_SEEDS = "seeds AS (SELECT c_custkey AS card FROM customer WHERE c_acctbal < -900)"


def _seeds(spark, d):
    return table(spark, d, "customer").where("c_acctbal < -900").select(F.col("c_custkey").alias("card"))


@query("SELECT src, dst, money, cnt FROM edges WHERE src IN (SELECT card FROM seeds) OR dst IN (SELECT card FROM seeds)", f"{EDGES}, {_SEEDS}")
def edges_touching_seeds(spark, d):
    return R.touching(transfer_edges(spark, d), _seeds(spark, d)).select("src", "dst", "money", "cnt")


@query("SELECT tid, card, money FROM tx WHERE card IN (SELECT card FROM seeds)", f"{TX}, {_SEEDS}")
def rows_of_seeds(spark, d):
    return R.restricted(transactions(spark, d), _seeds(spark, d), "card").select("tid", "card", "money")


@query("SELECT tid FROM tx WHERE sha256('k' || reverse(CAST(srccard AS STRING))) IN (SELECT sha256('k' || reverse(CAST(card AS STRING))) FROM seeds)", f"{TX}, {_SEEDS}")
def semi_join_on_hashed_key(spark, d):
    hashed = lambda c: X.keyed_hash(F.col(c).cast("string"), "k")
    t = transactions(spark, d).withColumn("h", hashed("srccard"))
    return R.restricted(t, _seeds(spark, d).select(hashed("card").alias("h")), "h").select("tid")


@query("SELECT c_custkey AS card, coalesce(n, 0) AS n, coalesce(money, 0) AS money FROM customer LEFT JOIN (SELECT card, count(*) AS n, sum(money)::BIGINT AS money FROM tx GROUP BY card) ON c_custkey = card", TX)
def left_join_fill_zero(spark, d):
    a = transactions(spark, d).groupBy("card").agg(F.count("*").alias("n"), F.sum("money").alias("money"))
    return table(spark, d, "customer").select(F.col("c_custkey").alias("card")).join(a, "card", "left").fillna(0)


@query("SELECT a.card, a.money_in, b.money_out FROM (SELECT dstcard AS card, sum(money)::BIGINT AS money_in FROM tx WHERE trans_id = 'S33' GROUP BY 1) a RIGHT JOIN (SELECT srccard AS card, sum(money)::BIGINT AS money_out FROM tx WHERE trans_id = 'S25' GROUP BY 1) b ON a.card = b.card", TX)
def right_join_in_out(spark, d):
    t = transactions(spark, d)
    a = t.where("trans_id = 'S33'").groupBy(F.col("dstcard").alias("card")).agg(F.sum("money").alias("money_in"))
    b = t.where("trans_id = 'S25'").groupBy(F.col("srccard").alias("k")).agg(F.sum("money").alias("money_out"))
    return a.join(b, F.col("card") == F.col("k"), "right").select("card", "money_in", "money_out")


_TWO = "a AS (SELECT card, pdate, sum(money)::BIGINT AS money FROM tx GROUP BY 1, 2), b AS (SELECT card, pdate, count(*) AS n FROM tx WHERE trans_md <> '1' GROUP BY 1, 2)"


def _two(spark, d):
    t = transactions(spark, d)
    return t.groupBy("card", "pdate").agg(F.sum("money").alias("money")), t.where("trans_md <> '1'").groupBy("card", "pdate").agg(F.count("*").alias("n"))


@query("SELECT a.card, a.pdate, money, n FROM a JOIN b ON a.card = b.card AND a.pdate = b.pdate", f"{TX}, {_TWO}")
def inner_join_two_keys(spark, d):
    a, b = _two(spark, d)
    return a.join(b, ["card", "pdate"])


@query("SELECT a.card, a.pdate, money, n FROM a LEFT JOIN b ON a.card = b.card AND a.pdate = b.pdate", f"{TX}, {_TWO}")
def left_join_two_keys(spark, d):
    a, b = _two(spark, d)
    return a.join(b, ["card", "pdate"], "left")


@query("SELECT tid, region_cd, n_name FROM tx JOIN nation ON CAST(region_cd AS BIGINT) - 1000 = n_nationkey", TX)
def dictionary_lookup(spark, d):
    names = table(spark, d, "nation").select((F.col("n_nationkey") + 1000).cast("string").alias("region_cd"), "n_name")
    return R.lookup(transactions(spark, d).select("tid", "region_cd"), names, "region_cd")


@query("SELECT src, dst, money, ps.c_acctbal AS src_balance, pd.c_acctbal AS dst_balance FROM edges JOIN customer ps ON src = ps.c_custkey JOIN customer pd ON dst = pd.c_custkey", EDGES)
def triplets(spark, d):
    c = table(spark, d, "customer")
    e = transfer_edges(spark, d)
    return e.join(c.select(F.col("c_custkey").alias("src"), F.col("c_acctbal").alias("src_balance")), "src").join(c.select(F.col("c_custkey").alias("dst"), F.col("c_acctbal").alias("dst_balance")), "dst").select("src", "dst", "money", "src_balance", "dst_balance")


@query("SELECT srccard AS card, sum(money)::BIGINT AS amount FROM tx WHERE trans_id = 'S25' GROUP BY 1", TX)
def sums_by_sender(spark, d):
    return transactions(spark, d).where("trans_id = 'S25'").groupBy(F.col("srccard").alias("card")).agg(F.sum("money").alias("amount"))


@query("SELECT trans_id, count(*) AS n FROM tx GROUP BY 1", TX)
def counts_by_type(spark, d):
    return transactions(spark, d).groupBy("trans_id").agg(F.count("*").alias("n"))


@query("SELECT card, count(CASE WHEN trans_id = 'S33' THEN 1 END) AS n_in, count(CASE WHEN trans_id = 'S25' THEN 1 END) AS n_out, count(CASE WHEN trans_md <> '1' THEN 1 END) AS n_foreign, sum(CASE WHEN trans_id = 'S24' THEN money ELSE 0 END)::BIGINT AS cash FROM tx GROUP BY 1", TX)
def conditional_counts(spark, d):
    when = lambda c: F.count_if(F.expr(c))
    return transactions(spark, d).groupBy("card").agg(when("trans_id = 'S33'").alias("n_in"), when("trans_id = 'S25'").alias("n_out"), when("trans_md <> '1'").alias("n_foreign"), F.sum(F.when(F.col("trans_id") == "S24", F.col("money")).otherwise(0)).alias("cash"))


@query("SELECT DISTINCT card, region_cd FROM tx", TX)
def distinct_card_regions(spark, d):
    return transactions(spark, d).select("card", "region_cd").distinct()


@query("SELECT region_cd, count(DISTINCT card) AS cards, count(DISTINCT mchnt_cd) AS merchants, count(DISTINCT term_id) AS terminals, count(DISTINCT trans_chnl) AS channels, max(money) AS most, sum(charge > 100) AS dear FROM tx GROUP BY 1", TX)
def distinct_counts_by_region(spark, d):
    n = F.count_distinct
    return transactions(spark, d).groupBy("region_cd").agg(n("card").alias("cards"), n("mchnt_cd").alias("merchants"), n("term_id").alias("terminals"), n("trans_chnl").alias("channels"), F.max("money").alias("most"), F.count_if(F.col("charge") > 100).alias("dear"))


@query("SELECT src, dst, money, cnt, first_day, n_regions, channel FROM (SELECT srccard AS src, dstcard AS dst, sum(money)::BIGINT AS money, count(*) AS cnt, min(pdate) AS first_day, count(DISTINCT region_cd) AS n_regions FROM tx GROUP BY 1, 2) JOIN (SELECT src, dst, channel FROM (SELECT srccard AS src, dstcard AS dst, trans_chnl AS channel, row_number() OVER (PARTITION BY srccard, dstcard ORDER BY count(*) DESC, trans_chnl) AS k FROM tx GROUP BY 1, 2, 3) WHERE k = 1) USING (src, dst)", TX)
def merged_edges_with_mode(spark, d):
    t = transactions(spark, d).select(F.col("srccard").alias("src"), F.col("dstcard").alias("dst"), "money", "pdate", "region_cd", "trans_chnl")
    per = t.groupBy("src", "dst", "trans_chnl").agg(F.count("*").alias("c"), F.sum("money").alias("money"), F.min("pdate").alias("first_day"), F.collect_set("region_cd").alias("regions"))
    mode = F.min_by("trans_chnl", F.struct(-F.col("c"), F.col("trans_chnl")))
    out = per.groupBy("src", "dst").agg(F.sum("money").alias("money"), F.sum("c").alias("cnt"), F.min("first_day").alias("first_day"), F.size(F.array_distinct(F.flatten(F.collect_list("regions")))).cast("long").alias("n_regions"), mode.alias("channel"))
    return out


@query("SELECT tid, card, money, place FROM (SELECT *, row_number() OVER (PARTITION BY card ORDER BY money DESC, tid) AS place FROM tx) WHERE place < 20", TX)
def top_19_of_card(spark, d):
    return R.top_in_group(transactions(spark, d), "card", 19, F.desc("money"), F.asc("tid")).select("tid", "card", "money", "place")


@query("SELECT tid, mchnt_cd, place FROM (SELECT *, row_number() OVER (PARTITION BY mchnt_cd ORDER BY trans_md DESC, money DESC, charge DESC, trans_id, tid) AS place FROM tx) WHERE place < 100", TX)
def top_99_of_merchant_many_keys(spark, d):
    return R.top_in_group(transactions(spark, d), "mchnt_cd", 99, F.desc("trans_md"), F.desc("money"), F.desc("charge"), F.asc("trans_id"), F.asc("tid")).select("tid", "mchnt_cd", "place")


@query("SELECT card, n, dense_rank() OVER (ORDER BY n) AS rank FROM (SELECT card, count(*) AS n FROM tx GROUP BY 1)", TX)
def dense_rank_of_counts(spark, d):
    return R.dense_rank_of(transactions(spark, d).groupBy("card").agg(F.count("*").alias("n")), "n", "rank").select("card", "n", "rank")


@query("SELECT card, CAST(row_number() OVER (ORDER BY card) AS BIGINT) AS id FROM (SELECT DISTINCT srccard AS card FROM tx UNION SELECT DISTINCT dstcard FROM tx)", TX)
def card_dictionary(spark, d):
    t = transactions(spark, d)
    cards = t.select(F.col("srccard").alias("card")).union(t.select("dstcard")).distinct()
    return R.with_index(cards, "card", name="id").select("card", "id")


@query("SELECT srccard, pdate, loc_trans_tm, tid FROM tx WHERE trans_id = 'S25'", TX)
def global_composite_sort(spark, d):
    return transactions(spark, d).where("trans_id = 'S25'").select("srccard", "pdate", "loc_trans_tm", "tid").orderBy("srccard", "pdate", "loc_trans_tm", "tid")


@query("SELECT card, pdate, money FROM tx WHERE trans_id = 'S24'", TX)
def distributed_sort(spark, d):
    return transactions(spark, d).where("trans_id = 'S24'").select("card", "pdate", "money").repartition("card").sortWithinPartitions("card", F.desc("pdate"))


@query("SELECT card, amount FROM (SELECT card, sum(money)::BIGINT AS amount FROM tx GROUP BY 1) ORDER BY amount DESC, card LIMIT 100", TX)
def top_100_amounts(spark, d):
    return R.top_n(transactions(spark, d).groupBy("card").agg(F.sum("money").alias("amount")), 100, F.col("amount"), "card")


@query("SELECT c_custkey AS card FROM customer ORDER BY md5('7:' || CAST(c_custkey AS STRING)), c_custkey LIMIT 50")
def random_50_cards(spark, d):
    return R.sample_rows(table(spark, d, "customer").select(F.col("c_custkey").alias("card")), 50, 7, "card")


@query("SELECT srccard AS card FROM tx WHERE trans_id = 'S33' UNION ALL SELECT dstcard FROM tx WHERE trans_id = 'S33' UNION ALL SELECT card FROM tx WHERE trans_id = 'S24' AND money > 5000000", TX)
def union_all_three(spark, d):
    t = transactions(spark, d)
    s33 = t.where("trans_id = 'S33'")
    return s33.select(F.col("srccard").alias("card")).union(s33.select("dstcard")).union(t.where("trans_id = 'S24' and money > 5000000").select("card"))


@query("SELECT srccard AS card FROM tx WHERE trans_id = 'S25' INTERSECT SELECT dstcard FROM tx WHERE trans_id = 'S33'", TX)
def intersect_in_out(spark, d):
    t = transactions(spark, d)
    return t.where("trans_id = 'S25'").select(F.col("srccard").alias("card")).intersect(t.where("trans_id = 'S33'").select("dstcard"))


@query("SELECT card, pdate, n, try_div FROM (SELECT card, pdate, count(*) AS n, round(sum(charge) / nullif(sum(CASE WHEN trans_md = '2' THEN charge ELSE 0 END), 0), 6) AS try_div FROM tx GROUP BY 1, 2)", TX)
def ratio_or_null(spark, d):
    other = F.sum(F.when(F.col("trans_md") == "2", F.col("charge")).otherwise(0.0))
    return transactions(spark, d).groupBy("card", "pdate").agg(F.count("*").alias("n"), F.round(F.try_divide(F.sum("charge"), other), 6).alias("try_div"))


_HEX = "('0x' || substr(md5(s), {}, 16))::UBIGINT::HUGEINT"


@query(
    f"SELECT s, CASE WHEN substr(md5(s), 1, 1) >= '8' THEN ((607431768211456 - u) % 1000000000000000 + 1000000000000000) % 1000000000000000 ELSE u END::BIGINT AS vid FROM (SELECT s, (({_HEX.format(1)} % 1000000000000000) * 744073709551616 + {_HEX.format(17)} % 1000000000000000) % 1000000000000000 AS u FROM (SELECT CAST(c_custkey AS STRING) AS s FROM customer))"
)
def md5_vertex_ids(spark, d):
    s = F.col("c_custkey").cast("string")
    return table(spark, d, "customer").select(s.alias("s"), X.md5_id(s).alias("vid"))


@query("SELECT n_name AS s, (SELECT list_reduce(list_prepend(0::BIGINT, list_transform(string_split(n_name, ''), lambda c: ascii(c)::BIGINT)), lambda h, c: (h * 131 + c) & 536870911)) AS h FROM nation")
def bkdr_hashes(spark, d):
    return table(spark, d, "nation").select(F.col("n_name").alias("s"), X.bkdr_hash(F.col("n_name"), 0x1FFFFFFF).alias("h"))


@query(
    "SELECT tid, CAST(substr(loc_trans_tm, 1, 2) AS INTEGER) AS hr, CASE WHEN CAST(substr(loc_trans_tm, 1, 2) AS INTEGER) IN (23, 0, 1, 2, 3, 4, 5) THEN 1.0 ELSE 0.0 END AS night, left(region_cd, 2) AS province, money // 100 AS rmb, CASE WHEN (money // 100) % 500 = 0 THEN 1.0 ELSE 0.0 END AS by500, CASE WHEN (money // 100) % 1000 = 0 THEN 1.0 ELSE 0.0 END AS by1000, CASE WHEN abs(c - round(c)) / b < 0.01 AND money // 100 > 1000 THEN 1.0 ELSE 0.0 END AS large_integer, CAST(length(regexp_replace(CAST(money AS STRING), '[^89]', '', 'g')) AS DOUBLE) AS n89, CASE WHEN resp_cd4 IN ('51', '55', '61', '65', '75') THEN 1.0 ELSE 0.0 END AS holder_fail, CASE WHEN trans_curr_cd <> '156' THEN 1.0 ELSE 0.0 END AS odd_rate, CASE WHEN trans_md <> '1' THEN 1.0 ELSE 0.0 END AS is_foreign FROM (SELECT *, length(CAST(money // 100 AS STRING)) AS b, (money // 100) / pow(10.0, length(CAST(money // 100 AS STRING)) - 1) AS c FROM tx)",
    TX,
)
def transaction_flags(spark, d):
    t = transactions(spark, d)
    rmb = X.rmb(F.col("money"))
    return t.select(
        "tid", X.hour(F.col("loc_trans_tm")).alias("hr"), X.is_night(F.col("loc_trans_tm")).alias("night"), F.left("region_cd", F.lit(2)).alias("province"), rmb.alias("rmb"), X.multiple_of(rmb, 500).alias("by500"), X.multiple_of(rmb, 1000).alias("by1000"),
        X.is_large_integer(rmb).alias("large_integer"), X.count_89(F.col("money")).alias("n89"), X.in_list(F.col("resp_cd4"), ("51", "55", "61", "65", "75")).alias("holder_fail"), X.differs(F.col("trans_curr_cd"), "156").alias("odd_rate"), X.differs(F.col("trans_md"), "1").alias("is_foreign"),
    )


@query("SELECT region_cd, count(DISTINCT card) AS cards FROM tx WHERE trans_id = 'S22' GROUP BY 1 ORDER BY 1", TX)
def sql_surface(spark, d):
    """The same through a temporary view and a SQL text."""
    transactions(spark, d).createOrReplaceTempView("ledgerlens_tx")
    return spark.sql("SELECT region_cd, count(DISTINCT card) AS cards FROM ledgerlens_tx WHERE trans_id = 'S22' GROUP BY region_cd ORDER BY region_cd")
