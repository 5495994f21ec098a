"""Edges stored by community, so that some communities are read without the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folders that communities are dealt to by hash.
BUCKETS = 64


def _bucket(cc: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(cc), F.lit(buckets)).cast("int")


def store(edges: DataFrame, members: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """``edges(src, dst, ...)`` of the communities of ``members(vid, cc)`` with the column cc, a folder for each bucket of communities.

    Both ends of an edge are in one community. A bucket goes to as many tasks as its size asks for. Edges of no community are left out.
    """
    inside = edges.join(members.select(F.col("vid").alias("src"), "cc"), "src").withColumn("bucket", _bucket(F.col("cc"), buckets))
    inside.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(path)


def edges_of(spark: SparkSession, path: str, chosen: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The stored edges of the ``chosen(cc)`` communities. Folders without any of them are pruned, at the latest when the choice is known."""
    few = chosen.select("cc", _bucket(F.col("cc"), buckets).alias("bucket"))
    stored = spark.read.parquet(path)
    return stored.join(few, ["bucket", "cc"], "left_semi").drop("bucket")
