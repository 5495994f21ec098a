"""Gaps between successive transactions of a card or a terminal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as X
from ledgerlens.plans import scratch
from ledgerlens.sources import io
from ledgerlens.sources import schema as S


#: Rows of a key that one task sorts; a key with more, and with over 1/HOT_SHARE of all rows, is cut by time over several tasks.
HOT_ROWS, HOT_SHARE = 1_000_000, 512


def gaps(df: DataFrame, key: str | list[str], seconds: Column, *ties: str, descending: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """Adds gap_minutes and prev_<column> for every column in ``carry``, from the row before in the key's time order.

    In descending order "before" is the later transaction. A key's first row has nulls. Rows of one key form a window. Keys with
    very many rows, at most HOT_SHARE of them, are dealt by key and time instead, and each part's last row is carried to the next.
    """
    keys = [key] if isinstance(key, str) else key
    count = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    sizes = scratch.keep(count.where(F.col("__n") > HOT_ROWS), "hot")
    rows = df.withColumn("__at", seconds)
    now = F.struct(F.col("__at"), *[F.col(c) for c in carry])
    order = [F.col("__at").desc() if descending else F.col("__at").asc(), *[F.col(t).asc() for t in ties]]
    if sizes.isEmpty():
        found = rows.withColumn("__prev", F.lag(now).over(Window.partitionBy(*keys).orderBy(*order)))
    else:
        total = df.count()
        hot = sizes.where(F.col("__n") * HOT_SHARE > F.lit(total)).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
        cold = rows.join(F.broadcast(hot), same, "left_anti").withColumn("__prev", F.lag(now).over(Window.partitionBy(*keys).orderBy(*order)))
        found = cold.unionByName(_cut_by_time(rows.join(F.broadcast(hot), same, "left_semi"), keys, order, now))
    gap = F.round(F.abs(F.col("__at") - F.col("__prev.__at")) / 60.0, 2)
    return found.select(*df.columns, gap.alias("gap_minutes"), *[F.col(f"__prev.{c}").alias(f"prev_{c}") for c in carry])


def _cut_by_time(rows: DataFrame, keys: list[str], order: list[Column], now: Column) -> DataFrame:
    """``rows`` with __prev, dealt by ranges of key and time. Rows equal in key, time and ties stay together."""
    dealt = scratch.keep(rows.repartitionByRange(*keys, *order).withColumn("__part", F.spark_partition_id()), "ranges")
    w = Window.partitionBy("__part", *keys).orderBy(*order)
    marked = scratch.keep(dealt.select("*", F.lag(now).over(w).alias("__before"), F.row_number().over(w).alias("__place"), F.lead(F.lit(1)).over(w).isNull().alias("__last")), "marked")
    # one row for each part and key in it: parts follow each other, so these are parts and hot keys together at most
    ends = marked.where("__last").select("__part", *keys, now.alias("__end"))
    carried = ends.select(F.col("__part").alias("__p"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.lag("__end").over(Window.partitionBy(*keys).orderBy("__part")).alias("__carried"))
    on = F.col("__part") == F.col("__p")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    out = marked.join(F.broadcast(carried), on, "left")
    return out.select(*rows.columns, F.when(F.col("__place") == 1, F.col("__carried")).otherwise(F.col("__before")).alias("__prev"))


def amount_gaps(df: DataFrame, key: str, seconds: Column, money: str, *ties: str) -> DataFrame:
    """gap_minutes, the money difference where it is not negative, and their ratio, in descending time order."""
    g = gaps(df, key, seconds, *ties, carry=(money,))
    diff = F.col(f"prev_{money}") - F.col(money)
    diff = F.when(diff >= 0, diff)
    return g.select("*", diff.alias("gap_money"), F.round(F.try_divide(diff, F.col("gap_minutes")), 4).alias("gap_rate")).drop(f"prev_{money}")


def with_switch(df: DataFrame, column: str) -> DataFrame:
    """card_diff: 1 where ``column`` differs from the row before or there is none. Needs prev_<column>."""
    prev = F.col(f"prev_{column}")
    return df.withColumn("card_diff", F.when(prev.isNull() | (prev != F.col(column)), 1).otherwise(0))


def mean_gaps(gapped: DataFrame, *by: str) -> DataFrame:
    """Mean of the gaps that there are; keys without any are left out."""
    return gapped.where("gap_minutes is not null").groupBy(*by).agg(F.round(F.avg("gap_minutes"), 4).alias("mean_gap"))


def withdrawal_gap_job(spark: SparkSession, path: str, out: str, key: str = "card") -> None:
    """Text to text: lines of nine fields in, lines "key,date,money,gap minutes" out.

    Lines of another number of fields, without a key, or without 14 characters of date and time are dropped; money that
    is no number is 0. Rows of one key and time go by money and merchant.
    """
    rows = io.read_delimited(spark, path, S.WITHDRAWALS)
    name = F.concat("mchnt_cd", "term_id") if key == "atm" else F.col("card")
    rows = rows.select(name.alias("key"), "pdate", X.number_or_zero(F.col("money")).cast("long").alias("money"), "mchnt_cd", F.unix_timestamp(X.event_time(F.col("pdate"), F.col("time"))).alias("at"))
    found = gaps(rows.where("key <> '' and at is not null"), "key", F.col("at"), "money", "mchnt_cd")
    io.write_lines(found.select("key", "pdate", "money", "gap_minutes"), out)
