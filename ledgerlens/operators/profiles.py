"""Day, period and week profiles of cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as X
from ledgerlens.sources import schema as S


def profile(df: DataFrame, by: list[str], money: str = "money", place: str = "region_cd", foreign: Column | None = None) -> DataFrame:
    """sum, count, mean, population deviation and its share of the mean, distinct places and rows away from home."""
    away = F.col("trans_md") != "1" if foreign is None else foreign
    mean, dev = F.avg(money), F.stddev_pop(money)
    return df.groupBy(*by).agg(F.sum(money).alias("amount"), F.count("*").alias("cnt"), F.round(mean, 4).alias("mean"), F.round(dev, 4).alias("dev"), F.round(F.try_divide(dev, mean), 6).alias("cv"), F.count_distinct(place).alias("places"), F.count_if(away).alias("away"))


def averages_of_days(days: DataFrame, by: str = "card") -> DataFrame:
    """Means of the daily values of a card."""
    return days.groupBy(by).agg(F.round(F.avg("amount"), 4).alias("dam"), F.round(F.avg("cnt"), 4).alias("dac"), F.round(F.avg("cv"), 4).alias("dacv"), F.floor(F.avg("places")).cast("long").alias("dloc"), F.floor(F.avg("away")).cast("long").alias("daway"))


def abnormal_days(days: DataFrame, averages: DataFrame, by: str = "card", day: str = "pdate") -> DataFrame:
    """A day's amount and count over the card's daily means."""
    return days.join(averages, by).select(by, day, F.round(F.try_divide("amount", "dam"), 4).alias("amount_ratio"), F.round(F.try_divide("cnt", "dac"), 4).alias("count_ratio"))


def dispersion(weeks: DataFrame, by: str, value: str) -> DataFrame:
    """Population variance over mean of the weekly values: an index of dispersion."""
    return weeks.groupBy(by).agg(F.count("*").alias("weeks"), F.round(F.try_divide(F.var_pop(value), F.avg(value)), 4).alias("dispersion"))


def location(text: Column) -> Column:
    """Characters from the fifth on; 0000 where there are none."""
    return F.when(F.length(text) > 4, F.substring(text, 5, 1000)).otherwise("0000")


def pair_statistics(tx: DataFrame, place: str = "place") -> DataFrame:
    """Transfers by receiver and sender: in_card, in_id, out_card, out_id, msum, csum, locsum, foreignsum; the ids are `md5_id` of the cards as text."""
    text = lambda c: F.col(c).cast("string")
    g = tx.groupBy(F.col("dstcard").alias("in_card"), F.col("srccard").alias("out_card")).agg(F.sum("money").alias("msum"), F.count("*").alias("csum"), F.count_distinct(place).alias("locsum"), F.count_if(F.col("trans_md") == S.OTHER_CITY).alias("foreignsum"))
    return g.select("in_card", X.md5_id(text("in_card")).alias("in_id"), "out_card", X.md5_id(text("out_card")).alias("out_id"), "msum", "csum", "locsum", "foreignsum")
