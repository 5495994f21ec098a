"""Queries that write tables, folders or text and read them back, and SQL clauses that deal and sort."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import scalars as X
from ledgerlens.operators import gaps, profiles
from ledgerlens.operators import relational as R
from ledgerlens.plans import scratch
from ledgerlens.registry import query
from ledgerlens.sources import io, tables
from ledgerlens.sources import schema as S
from ledgerlens.sources.transactions import TX, table, transactions

_BY_CARD = "SELECT card, sum(money)::BIGINT AS amount FROM tx WHERE trans_id = 'S33' GROUP BY 1"


def _name() -> str:
    return f"ledgerlens_{uuid.uuid4().hex}"


@contextmanager
def _view(spark, d):
    """The name of a temporary view of the transactions, dropped at the end: a frame made of it keeps the plan."""
    name = _name()
    transactions(spark, d).createOrReplaceTempView(name)
    try:
        yield name
    finally:
        spark.catalog.dropTempView(name)


def _read(spark, name: str, path: str):
    """The rows at ``path``, the table of the name taken out of the catalog again."""
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)


@query("SELECT CAST(c_custkey AS STRING) AS card, c_nationkey::BIGINT AS nation FROM customer")
def load_text_into_table(spark, d):
    """A text file loaded into a table twice, once overwriting."""
    text, path, name = scratch.new_path(spark, "text"), scratch.new_path(spark, "table"), _name()
    io.write_lines(table(spark, d, "customer").select("c_custkey", "c_nationkey"), text, io.FIELD)
    tables.create_table(spark, name, T.StructType([T.StructField("card", T.StringType()), T.StructField("nation", T.LongType())]), path)
    tables.load_text(spark, name, text)
    tables.load_text(spark, name, text, overwrite=True)
    return _read(spark, name, path)


@query(_BY_CARD, TX)
def table_as_select(spark, d):
    path, name = scratch.new_path(spark, "table"), _name()
    with _view(spark, d) as view:
        tables.create_table_as(spark, name, f"SELECT card, sum(money)::BIGINT AS amount FROM {view} WHERE trans_id = 'S33' GROUP BY card", path)
    return _read(spark, name, path)


def _in_rows(spark, d, name: str, path: str) -> None:
    """A table of the money that cards got, one row a transfer."""
    with _view(spark, d) as view:
        tables.create_table_as(spark, name, f"SELECT card, money AS amount FROM {view} WHERE trans_id = 'S33'", path)


@query("SELECT card, money AS amount FROM tx WHERE trans_id = 'S25'", TX)
def table_emptied_and_appended(spark, d):
    """A table emptied; what is appended afterwards is all it holds."""
    path, name = scratch.new_path(spark, "table"), _name()
    _in_rows(spark, d, name, path)
    tables.truncate(spark, name)
    transactions(spark, d).where("trans_id = 'S25'").select("card", F.col("money").alias("amount")).write.insertInto(name)
    return _read(spark, name, path)


@query("SELECT card, sum(money)::BIGINT AS amount FROM tx WHERE trans_id = 'S25' GROUP BY 1", TX)
def table_overwritten(spark, d):
    path, name = scratch.new_path(spark, "table"), _name()
    _in_rows(spark, d, name, path)
    with _view(spark, d) as view:
        tables.insert_overwrite(spark, name, f"SELECT card, sum(money)::BIGINT FROM {view} WHERE trans_id = 'S25' GROUP BY card")
    return _read(spark, name, path)


@query("SELECT card, money AS total FROM tx WHERE trans_id = 'S33'", TX)
def table_and_column_renamed(spark, d):
    path, moved, name, other = scratch.new_path(spark, "table"), scratch.new_path(spark, "table"), _name(), _name()
    _in_rows(spark, d, name, path)
    tables.rename_table(spark, name, other)
    tables.rename_column(spark, other, "amount", "total", moved)
    return _read(spark, other, moved)


@query("SELECT card, sum(money)::BIGINT AS total FROM tx WHERE trans_id = 'S25' GROUP BY 1", TX)
def table_emptied_filled_and_renamed(spark, d):
    path, moved, name = scratch.new_path(spark, "table"), scratch.new_path(spark, "table"), _name()
    _in_rows(spark, d, name, path)
    tables.truncate(spark, name)
    with _view(spark, d) as view:
        tables.insert_overwrite(spark, name, f"SELECT card, sum(money)::BIGINT FROM {view} WHERE trans_id = 'S25' GROUP BY card")
    tables.rename_column(spark, name, "amount", "total", moved)
    return _read(spark, name, moved)


_MONTHLY = T.StructType([T.StructField("card", T.LongType()), T.StructField("money", T.LongType()), T.StructField("pdate", T.StringType()), T.StructField("month", T.StringType())])


def _monthly(spark, d, code: str):
    return transactions(spark, d).where(F.col("trans_id") == code).select("card", "money", "pdate", F.left("pdate", F.lit(6)).alias("month"))


def _monthly_table(spark, d) -> tuple[str, str]:
    """A table of transfers in, a folder a month."""
    name, path = _name(), scratch.new_path(spark, "months")
    tables.create_partitioned(spark, name, _MONTHLY, ["month"], path)
    tables.write_partitions(_monthly(spark, d, "S33"), name, ["month"])
    return name, path


@query("SELECT card, money, pdate, left(pdate, 6) AS month FROM tx WHERE trans_id = 'S33' AND left(pdate, 6) NOT IN (SELECT left(pdate, 6) FROM tx WHERE trans_id = 'S25' AND pdate BETWEEN '19960310' AND '19960620') UNION ALL SELECT card, money, pdate, left(pdate, 6) FROM tx WHERE trans_id = 'S25' AND pdate BETWEEN '19960310' AND '19960620'", TX)
def some_partitions_overwritten(spark, d):
    """The months that new rows fall in are replaced whole; all others stay."""
    name, path = _monthly_table(spark, d)
    tables.write_partitions(_monthly(spark, d, "S25").where(F.col("pdate").between("19960310", "19960620")), name, ["month"])
    return _read_months(spark, name, path)


@query("SELECT card, money, pdate, left(pdate, 6) AS month FROM tx WHERE trans_id IN ('S33', 'S25') AND left(pdate, 6) <> '199701'", TX)
def partitions_appended_and_dropped(spark, d):
    name, path = _monthly_table(spark, d)
    tables.write_partitions(_monthly(spark, d, "S25"), name, ["month"], replace=False)
    tables.drop_partition(spark, name, month="199701")
    return _read_months(spark, name, path)


@query("SELECT card, money, pdate, left(pdate, 6) AS month FROM tx WHERE trans_id = 'S33' AND pdate BETWEEN '19970115' AND '19970310'", TX)
def partition_range_scan(spark, d):
    """A date range on a partitioned table: months outside it are not read."""
    name, path = _monthly_table(spark, d)
    return _read_months(spark, name, path).where(F.col("month").between("199701", "199703") & F.col("pdate").between("19970115", "19970310"))


def _read_months(spark, name: str, path: str):
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(_MONTHLY).parquet(path)


@query(_BY_CARD, TX)
def directory_overwritten(spark, d):
    path = scratch.new_path(spark, "directory")
    with _view(spark, d) as view:
        tables.insert_overwrite_directory(spark, path, f"SELECT card, sum(money)::BIGINT AS amount FROM {view} WHERE trans_id = 'S33' GROUP BY card")
    return spark.read.parquet(path)


@query(_BY_CARD, TX)
def saved_table(spark, d):
    path, name = scratch.new_path(spark, "table"), _name()
    tables.save_table(transactions(spark, d).where("trans_id = 'S33'").groupBy("card").agg(F.sum("money").alias("amount")), name, path)
    return _read(spark, name, path)


@query(_BY_CARD, TX)
def saved_in_default_format(spark, d):
    path = scratch.new_path(spark, "default")
    tables.save(transactions(spark, d).where("trans_id = 'S33'").groupBy("card").agg(F.sum("money").alias("amount")), path)
    return spark.read.load(path)


@query(_BY_CARD, TX)
def clustered_by_amount(spark, d):
    with _view(spark, d) as view:
        return spark.sql(f"SELECT * FROM (SELECT card, sum(money)::BIGINT AS amount FROM {view} WHERE trans_id = 'S33' GROUP BY card) CLUSTER BY amount")


@query("SELECT srccard, pdate, loc_trans_tm, money FROM tx WHERE trans_id = 'S33'", TX)
def distributed_and_sorted(spark, d):
    with _view(spark, d) as view:
        return spark.sql(f"SELECT srccard, pdate, loc_trans_tm, money FROM {view} WHERE trans_id = 'S33' DISTRIBUTE BY srccard SORT BY pdate, loc_trans_tm")


@query(
    "SELECT key, pdate, money, gap FROM (SELECT CAST(card AS STRING) AS key, pdate, CAST(money AS STRING) AS money, CASE WHEN lag(at_s) OVER w IS NULL THEN 'null' ELSE printf('%.2f', round(abs(at_s - lag(at_s) OVER w) / 60.0, 2)) END AS gap FROM (SELECT *, CAST(epoch(day) + secs AS BIGINT) AS at_s FROM tx) WHERE trans_id = 'S24' WINDOW w AS (PARTITION BY card ORDER BY at_s DESC, money, mchnt_cd))",
    TX,
)
def gap_job_on_text(spark, d):
    """Withdrawals as text of nine fields, with lines that must be dropped, through the text-to-text job."""
    path, out = scratch.new_path(spark, "text"), scratch.new_path(spark, "gaps")
    t = transactions(spark, d).where("trans_id = 'S24'")
    lines = t.select("card", "money", "pdate", "loc_trans_tm", F.lit("-"), "trans_md", F.lit("0"), "mchnt_cd", "term_id")
    io.write_lines(lines, path, io.FIELD)
    bad = spark.createDataFrame([("short",), (io.FIELD.join(["", "1", "20200101", "000000", "-", "1", "0", "m", "t"]),), (io.FIELD.join(["c", "1", "2020", "000000", "-", "1", "0", "m", "t"]),)], "value string")
    bad.write.mode("append").text(path)
    gaps.withdrawal_gap_job(spark, path, out)
    parts = F.split("value", ",")
    return spark.read.text(out).select(*[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(("key", "pdate", "money"))], F.when(F.get(parts, F.lit(3)) == "null", "null").otherwise(F.format_string("%.2f", F.get(parts, F.lit(3)).try_cast("double"))).alias("gap"))


@query("SELECT CAST(dstcard AS STRING) AS in_card, CAST(srccard AS STRING) AS out_card, sum(money)::DOUBLE AS msum, count(*)::INTEGER AS csum FROM tx WHERE trans_id IN ('S33', 'S25') GROUP BY 1, 2", TX)
def pair_statistics_as_text(spark, d):
    """Pair statistics written as lines and read under their schema."""
    path = scratch.new_path(spark, "pairs")
    t = transactions(spark, d).where("trans_id in ('S33', 'S25')").withColumn("place", profiles.location(F.concat("region_cd", "mchnt_cd")))
    io.write_lines(profiles.pair_statistics(t), path, io.FIELD)
    return io.read_delimited(spark, path, S.PAIR_STATS).select("in_card", "out_card", "msum", "csum")


@query("SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS id, CAST(c_custkey AS STRING) AS card FROM customer")
def dictionary_as_text(spark, d):
    """A card dictionary written blank-separated and read again."""
    path = scratch.new_path(spark, "dictionary")
    cards = R.with_index(table(spark, d, "customer").select("c_custkey"), "c_custkey", name="id")
    io.write_lines(cards.select("id", "c_custkey"), path, " ")
    return io.read_blank_separated(spark, path, S.CARD_DICT)


@query("SELECT card, n, n::DOUBLE / dense_rank() OVER (ORDER BY n) AS ratio FROM (SELECT card, count(*) AS n FROM tx GROUP BY 1)", TX)
def count_rank_ratios(spark, d):
    r = R.dense_rank_of(transactions(spark, d).groupBy("card").agg(F.count("*").alias("n")), "n", "rank")
    return r.select("card", "n", X.rank_ratio(F.col("n"), F.col("rank")).alias("ratio"))


@query("SELECT event_id, round(date_diff('second', min(ts) OVER (PARTITION BY user_id), ts) / 60.0, 2) AS minutes FROM events")
def minutes_since_first_event(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.date_trunc("second", "ts"))
    first = e.groupBy("user_id").agg(F.min("ts").alias("first"))
    return e.join(first, "user_id").select("event_id", X.two_places(X.minutes_between(F.col("ts"), F.col("first"))).alias("minutes"))


@query("SELECT trans_id, count(*) AS n, sum(money)::BIGINT AS money FROM tx GROUP BY 1", TX)
def lines_in_one_file(spark, d):
    """A small result as one file of lines, read back from that file."""
    path = scratch.new_path(spark, "lines")
    io.write_lines(transactions(spark, d).groupBy("trans_id").agg(F.count("*").alias("n"), F.sum("money").alias("money")), path, single=True)
    schema = T.StructType([T.StructField("trans_id", T.StringType()), T.StructField("n", T.LongType()), T.StructField("money", T.LongType())])
    lines = io.read_delimited(spark, path, schema, ",")
    if len(lines.inputFiles()) != 1:
        raise RuntimeError("lines are not in one file")
    return lines
