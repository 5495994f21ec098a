"""Connected components of an undirected graph by alternating star contraction.

Every round joins an edge table with one minimum per vertex. Hubs only make
one side of the join uneven, which adaptive execution splits; nothing is
gathered on the driver but two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.plans import scratch


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 100) -> DataFrame:
    """(vid, cc) for every endpoint of ``edges``; cc is the smallest vertex id reachable.

    Edges with a null endpoint are ignored; self-loops count as isolated vertices
    and give cc = vid; an empty table gives an empty result. Repeated edges are harmless.
    """
    e = scratch.keep(edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).dropna(), "cc")  # computed once, read twice
    loops = e.where("u = v").select(F.col("u").alias("vid"), F.col("u").alias("cc"))
    stars = scratch.keep(e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    state = None
    for _ in range(max_rounds):
        found = stars.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (found.n, found.h) == state or found.n == 0:
            break
        state = (found.n, found.h)
        before, stars = stars, scratch.keep(_small_star(_large_star(stars)).distinct(), "cc")
        scratch.drop(before)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = stars.select(F.col("v").alias("vid")).distinct().withColumn("cc", F.col("vid"))
    return stars.select(F.col("u").alias("vid"), F.col("v").alias("cc")).unionByName(roots).unionByName(loops).groupBy("vid").agg(F.min("cc").alias("cc"))
