"""Mergeable states of cards: made once for each day, then merged to weeks and periods without the transactions.

A state holds count, sum, sum of squares, extremes, a count of rows away from home and the places as bits of whole numbers. All of these are
sums, extremes or unions, so merging states of days gives what one pass over the transactions would give.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of a state beside its keys and its place bits.
VALUES = ("cnt", "amount", "squares", "least", "most", "away")


def _words(places: int) -> int:
    return -(-places // 64)


def day_states(tx: DataFrame, by: list[str], place: Column, places: int, money: str = "money", away: Column | None = None) -> DataFrame:
    """One state for each combination of ``by``. ``place`` numbers the places from 0 to ``places`` - 1; rows whose number is null or outside count elsewhere but have no place."""
    square = F.col(money).cast("decimal(38,0)") * F.col(money).cast("decimal(38,0)")
    rows = tx.withColumn("__place", F.when((place >= 0) & (place < places), place).cast("int"))
    bits = [F.bit_or(F.when(F.floor(F.col("__place") / 64) == i, F.expr("shiftleft(1L, pmod(__place, 64))")).otherwise(F.lit(0).cast("long"))).alias(f"places{i}") for i in range(_words(places))]
    gone = F.col("trans_md") != "1" if away is None else away
    sums = [F.count(money).alias("cnt"), F.sum(money).alias("amount"), F.sum(square.cast("decimal(38,0)")).alias("squares"), F.min(money).alias("least"), F.max(money).alias("most"), F.count_if(gone).alias("away")]
    return rows.groupBy(*by).agg(*sums, *bits)


def merge(states: DataFrame, *by: str | Column) -> DataFrame:
    """States of coarser keys: of one card and week, say, out of those of its days."""
    bits = [c for c in states.columns if c.startswith("places")]
    how = {"least": F.min, "most": F.max}
    return states.groupBy(*by).agg(*[how.get(c, F.sum)(c).alias(c) for c in VALUES], *[F.bit_or(c).alias(c) for c in bits])


def profile_of(states: DataFrame, *keys: str) -> DataFrame:
    """amount, cnt, mean, population deviation and its share of the mean, distinct places and rows away, like `profiles.profile` over the transactions."""
    bits = [c for c in states.columns if c.startswith("places")]
    n, s, q = (F.col(c).cast("double") for c in ("cnt", "amount", "squares"))
    # n * squares - sum^2 is exact before it is rounded to a double
    wide = F.col("cnt").cast("decimal(38,0)") * F.col("squares") - F.col("amount").cast("decimal(19,0)") * F.col("amount").cast("decimal(19,0)")
    spread = F.coalesce(wide.cast("double"), n * q - s * s)
    mean, dev = F.try_divide(s, n), F.try_divide(F.sqrt(F.greatest(spread, F.lit(0.0))), n)
    places = sum((F.bit_count(c) for c in bits), F.lit(0)).cast("long")
    return states.select(*keys, "amount", "cnt", F.round(mean, 4).alias("mean"), F.round(dev, 4).alias("dev"), F.round(F.try_divide(dev, mean), 6).alias("cv"), places.alias("places"), "away")
