"""Money flow per vertex of a transfer graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_out(edges: DataFrame, money: str = "money", cnt: str = "cnt", *more: str) -> DataFrame:
    """Per vertex: amounts and counts in and out, totals, net and its share, and totals of the columns ``more``.

    One pass: each edge is given to both ends and summed conditionally. A self-loop counts both ways.
    """
    ends = F.explode(F.array(F.struct(F.col("dst").alias("vid"), F.lit(True).alias("into")), F.struct(F.col("src").alias("vid"), F.lit(False).alias("into"))))
    e = edges.select(money, cnt, *more, ends.alias("end")).select(money, cnt, *more, "end.vid", "end.into")
    side = lambda c, into: F.sum(F.when(F.col("into") == into, F.col(c)).otherwise(0))
    g = e.groupBy("vid").agg(side(money, True).alias("amt_in"), side(cnt, True).alias("cnt_in"), side(money, False).alias("amt_out"), side(cnt, False).alias("cnt_out"), F.sum(money).alias("amt_all"), F.sum(cnt).alias("cnt_all"), *[F.sum(c).alias(c) for c in more])
    net = F.abs(F.col("amt_in") - F.col("amt_out"))
    return g.select("*", net.alias("net"), F.round(F.try_divide(net.cast("double"), F.col("amt_in") + F.col("amt_out")), 6).alias("net_ratio"))


def transit(amt_in: Column, amt_out: Column, within: float = 500, share: float = 0.01, ratio: Column | None = None) -> Column:
    """1 where what comes in nearly all goes out; 0 where one side is missing. ``ratio``: the net's share as the caller has it, rounded perhaps."""
    gap = F.abs(amt_in - amt_out)
    ratio = F.try_divide(gap.cast("double"), amt_in + amt_out) if ratio is None else ratio
    near = (gap < within) | (F.coalesce(ratio, F.lit(9999.0)) < share)
    return F.when(near & (amt_in > 0) & (amt_out > 0), 1).otherwise(0)


def cumulative_degrees(degrees: DataFrame, thresholds: list[int]) -> DataFrame:
    """(threshold, n_in, n_out, n_all): vertices with at least that degree. One aggregation, then the few sums are turned to rows."""
    aggs = [F.count_if(F.col(c) >= t).alias(f"{c}_{t}") for t in thresholds for c in ("in_degree", "out_degree", "degree")]
    rows = F.explode(F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"in_degree_{t}").alias("n_in"), F.col(f"out_degree_{t}").alias("n_out"), F.col(f"degree_{t}").alias("n_all")) for t in thresholds]))
    return degrees.agg(*aggs).select(rows.alias("r")).select("r.*")


#: Metrics that suspect sets are made of, with the order in which they are bad: totals and degrees from the top, ratios from the bottom.
METRICS = {"amount": ("amt_all", False), "count": ("cnt_all", False), "ratio": ("net_ratio", True), "foreign": ("foreign_cnt", False), "in": ("in_degree", False), "out": ("out_degree", False), "deg": ("degree", False), "in_ratio": ("in_ratio", True), "out_ratio": ("out_ratio", True), "rank": ("rank", False)}
#: Suspect sets as conditions on "is among the first n by this metric".
SUSPECT_SETS = {
    "MaxInOut": "`out` and `in`",
    "MostSum": "amount and `count`",
    "MostSumRatio": "amount and `count` and ratio",
    "MostSumForeign": "amount and `count` and `foreign`",
    "MostDeg": "deg and rank",
    "DegInRatio": "deg and in_ratio",
    "DegOutRatio": "deg and out_ratio",
    "MostSuspectDeg": "deg and (in_ratio or out_ratio)",
    "MostDegSum": "deg and rank and amount and `count`",
    "MostDegSumForeign": "deg and rank and amount and `count` and `foreign`",
    "MostSuspectSum": "amount and `count` and `foreign` and ratio",
    "maybe_useful": "deg and (in_ratio or out_ratio) and amount and `count` and `foreign`",
    "MostSuspect": "deg and (in_ratio or out_ratio) and amount and `count` and ratio",
    "MostSuspectAll": "deg and (in_ratio or out_ratio) and amount and `count` and `foreign` and ratio",
}


def first_by_metric(metrics: DataFrame, n: int) -> DataFrame:
    """(vid, <metric> ...): which of the ten lists of the first ``n`` vertices each vertex is on; vertices on none are left out.

    Equal values go by vid, nulls come last. The lists are the only rows that meet: at most ten times n.
    """
    lists = [metrics.where(F.col(c).isNotNull()).orderBy(F.col(c).asc() if up else F.col(c).desc(), "vid").limit(n).select("vid", F.lit(k).alias("metric")) for k, (c, up) in METRICS.items()]
    out = lists[0]
    for x in lists[1:]:
        out = out.unionByName(x)
    return out.groupBy("vid").agg(*[F.bool_or(F.col("metric") == k).alias(k) for k in METRICS])


def suspect_sets(metrics: DataFrame, n: int) -> DataFrame:
    """(set, vid): the members of all fourteen sets; intersections, unions and joins of the lists are conditions on one row."""
    named = F.array_compact(F.array(*[F.when(F.expr(e), F.lit(k)) for k, e in SUSPECT_SETS.items()]))
    return first_by_metric(metrics, n).select(F.explode(named).alias("set"), "vid")
