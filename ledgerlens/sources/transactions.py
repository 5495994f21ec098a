"""Card transactions out of the star-schema test tables, the same in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Expressions that Spark and DuckDB read alike; {customers} is the number of customers.
_FIELDS = {
    "tid": "l_orderkey * 10 + l_linenumber",
    "srccard": "o_custkey",
    "dstcard": "l_partkey % {customers}",
    "money": "CAST(round(l_extendedprice * 100) AS BIGINT)",
    "charge": "round(l_extendedprice * l_tax, 4)",
    "day": "CAST(l_shipdate AS DATE)",
    "secs": "(l_orderkey * 7919 + l_linenumber * 3607) % 86400",
    "region_cd": "CAST(1000 + c_nationkey AS STRING)",
    "trans_md": "CASE l_returnflag WHEN 'A' THEN '1' WHEN 'N' THEN '2' ELSE '4' END",
    "mchnt_cd": "CAST(l_suppkey AS STRING)",
    "term_id": "CAST(l_linenumber AS STRING)",
    "mchnt_tp": "concat('5', CAST(l_suppkey % 17 AS STRING))",
    "trans_chnl": "concat('0', CAST(l_partkey % 4 AS STRING))",
    "card_class": "concat('0', CAST(l_linenumber % 3 AS STRING))",
    "acpt_bank": "CAST(1000 + l_suppkey % 23 AS STRING)",
    "acpt_ins_tp": "concat('0', CAST(l_linenumber % 5 AS STRING))",
    "fwd_ins_id_cd": "CAST(2000 + l_suppkey % 11 AS STRING)",
    "rcv_ins_id_cd": "CAST(3000 + l_partkey % 13 AS STRING)",
    "address": "concat('Loc', CAST((l_suppkey * 7 + l_linenumber) % 149 AS STRING))",
    "resp_cd4": "CASE l_partkey % 20 WHEN 0 THEN '51' WHEN 1 THEN '55' WHEN 2 THEN '61' WHEN 3 THEN '65' WHEN 4 THEN '75' ELSE '00' END",
    "trans_curr_cd": "CASE WHEN l_suppkey % 10 = 0 THEN '840' ELSE '156' END",
    "trans_id": "CASE (l_orderkey + l_linenumber) % 6 WHEN 0 THEN 'S33' WHEN 1 THEN 'S25' WHEN 2 THEN 'S24' WHEN 3 THEN 'S00' WHEN 4 THEN 'S22' ELSE 'S31' END",
}
_CARD = "CASE WHEN trans_id = 'S33' THEN dstcard ELSE srccard END"

TX = (
    "tx0 AS (SELECT "
    + ", ".join(f"{e.replace('{customers}', '(SELECT count(*) FROM customer)')} AS {k}" for k, e in _FIELDS.items())
    + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),\n"
    + f"tx AS (SELECT *, {_CARD} AS card, strftime(day, '%Y%m%d') AS pdate, lpad(CAST(secs // 3600 AS STRING), 2, '0') || lpad(CAST(secs // 60 % 60 AS STRING), 2, '0') || lpad(CAST(secs % 60 AS STRING), 2, '0') AS loc_trans_tm FROM tx0)"
)
#: What a card is called at one merchant: its transfers there are a graph apart, so there are many communities.
_THERE = "CAST(mchnt_cd AS BIGINT) * 1000000000 + {c}"
_CARDS = ("srccard", "dstcard", "card")
TX_AT_MERCHANTS = TX.replace("\ntx AS (", "\neverywhere AS (") + f",\ntx AS (SELECT * REPLACE ({', '.join(f'{_THERE.format(c=c)} AS {c}' for c in _CARDS)}) FROM everywhere)"
#: Merged edges of the transfer graph, self-loops kept.
_EDGES = ",\nedges AS (SELECT srccard AS src, dstcard AS dst, sum(money)::BIGINT AS money, count(*) AS cnt, sum(CASE WHEN trans_md <> '1' THEN 1 ELSE 0 END)::BIGINT AS foreign_cnt FROM tx WHERE trans_id IN ('S33', 'S25') GROUP BY 1, 2)"
EDGES, EDGES_AT_MERCHANTS = TX + _EDGES, TX_AT_MERCHANTS + _EDGES


def transactions(spark: SparkSession, sf_dir: str, holders_first: bool = False) -> DataFrame:
    """One row per transaction; the columns that a query doesn't use are never read.

    ``holders_first``: orders are joined to their customers first, so lines are shuffled once, by order; else they lie by sender at the end.
    """
    line, orders, customer = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    count = customer.agg(F.count("*").alias("__customers"))  # one row
    of_order, of_customer = line.l_orderkey == orders.o_orderkey, orders.o_custkey == customer.c_custkey
    rows = line.join(orders.join(customer, of_customer), of_order) if holders_first else line.join(orders, of_order).join(customer, of_customer)
    rows = rows.crossJoin(F.broadcast(count))
    base = rows.select(*[F.expr(e.replace("{customers}", "__customers")).alias(k) for k, e in _FIELDS.items()])
    hms = F.concat(*[F.lpad(F.expr(e).cast("string"), 2, "0") for e in ("secs div 3600", "secs div 60 % 60", "secs % 60")])
    return base.select("*", F.expr(_CARD).alias("card"), F.date_format("day", "yyyyMMdd").alias("pdate"), hms.alias("loc_trans_tm"))


def at_merchants(tx: DataFrame) -> DataFrame:
    """Transactions with every card apart at each merchant."""
    return tx.withColumns({c: F.expr(_THERE.format(c=c)) for c in _CARDS})


def transfer_edges(spark: SparkSession, sf_dir: str, apart: bool = False) -> DataFrame:
    """Transfers merged by sender and receiver: src, dst, money, cnt, foreign_cnt. ``apart``: of cards at each merchant."""
    tx = transactions(spark, sf_dir)
    t = (at_merchants(tx) if apart else tx).where(F.col("trans_id").isin("S33", "S25"))
    return t.groupBy(F.col("srccard").alias("src"), F.col("dstcard").alias("dst")).agg(F.sum("money").alias("money"), F.count("*").alias("cnt"), F.count_if(F.col("trans_md") != "1").alias("foreign_cnt"))
