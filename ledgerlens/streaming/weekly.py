"""Week sums of a stream of transactions: an extension, as card jobs run in batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def week_sums(stream: DataFrame, time: str = "ts", key: str = "user_id", value: str = "value", late: str = "1 day") -> DataFrame:
    """(key, week start, amount, cnt) in seven-day windows, rows later than ``late`` left out."""
    w = F.window(time, "7 days")
    g = stream.withWatermark(time, late).groupBy(key, w).agg(F.sum(value).alias("amount"), F.count("*").alias("cnt"))
    return g.select(key, F.col("window.start").alias("week"), "amount", "cnt")
