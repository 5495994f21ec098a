"""Filters, joins, orderings and samples that the card queries are made of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.plans import scratch


def touching(edges: DataFrame, seeds: DataFrame, key: str = "card", src: str = "src", dst: str = "dst") -> DataFrame:
    """Edges with an endpoint among the seeds, each once."""
    s = seeds.select(F.col(key).alias("__s")).distinct()
    hit = lambda c, n: edges_.join(s.withColumn(n, F.lit(True)).withColumnRenamed("__s", "__k" + n), F.col(c) == F.col("__k" + n), "left").drop("__k" + n)
    edges_ = edges
    edges_ = hit(src, "__a")
    edges_ = hit(dst, "__b")
    return edges_.where("__a or __b").drop("__a", "__b")


def restricted(df: DataFrame, keys: DataFrame, on: str, key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``on`` is among the keys: a semi join, which Spark broadcasts if it knows the keys to be few."""
    return df.join(keys.select(F.col(key or on).alias(on)).distinct(), on, "left_semi")


def join_counted(left: DataFrame, right: DataFrame, keys: list[str], n: str, parts: int = 512) -> DataFrame:
    """Inner join where ``right`` has one row a key and its column ``n`` says how many rows ``left`` has of it, about.

    Keys with over 1/parts of all rows are at most ``parts`` in number, a bound that doesn't grow with the
    tables; those are broadcast, and what is left to the shuffle is even. Keys must not be null. ``n`` is dropped.
    """
    total = right.agg(F.sum(n)).first()[0] or 0
    hot = F.col(n) * parts > F.lit(total)
    few = right.where(hot)
    rest = left.join(F.broadcast(few.select(*keys)), keys, "left_anti").join(right.where(~hot), keys)
    return left.join(F.broadcast(few), keys).unionByName(rest).drop(n)


def lookup(df: DataFrame, dictionary: DataFrame, on: str, strict: bool = False) -> DataFrame:
    """Dictionary columns joined to ``df``; unknown keys are dropped, or with ``strict`` raise."""
    out = df.join(dictionary, on, "left" if strict else "inner")
    if not strict:
        return out
    value = [c for c in dictionary.columns if c != on][0]
    return out.withColumn(value, F.when(F.col(value).isNull(), F.raise_error(F.concat(F.lit("unknown key "), F.col(on).cast("string")))).otherwise(F.col(value)))


def top_n(df: DataFrame, n: int, by: Column, *ties: str) -> DataFrame:
    """The n rows with the largest ``by``; equal ones by the tie columns ascending."""
    return df.orderBy(by.desc_nulls_last(), *ties).limit(n)


def top_in_group(df: DataFrame, group: str, n: int, *order: Column) -> DataFrame:
    """The first n rows of each group with their place."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("place") <= n)


def with_index(df: DataFrame, *order: str, name: str = "row_index", first: int = 1) -> DataFrame:
    """Consecutive numbers in the given order, without bringing all rows to one task.

    Rows are sorted by range; each partition is numbered on its own, and the partitions' offsets, one
    row each, are added.
    """
    ranged = scratch.keep(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id()), "index")
    sizes = ranged.groupBy("__p").count()
    base = sizes.select("__p", (F.coalesce(F.sum("count").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + first - 1).alias("__base"))
    within = F.row_number().over(Window.partitionBy("__p").orderBy(*order))
    return ranged.join(F.broadcast(base), "__p").withColumn(name, F.col("__base") + within).drop("__p", "__base")


def dense_rank_of(df: DataFrame, column: str, name: str) -> DataFrame:
    """Ascending dense rank over the whole table, null first: distinct values are numbered and joined back, those of very many rows by broadcast."""
    df = scratch.keep(df, "ranked")
    values = df.groupBy(column).agg(F.count("*").alias("__n"))
    numbers = scratch.keep(with_index(values, column, name=name), "values")
    known = join_counted(df.where(F.col(column).isNotNull()), numbers.where(F.col(column).isNotNull()), [column], "__n")
    none = numbers.where(F.col(column).isNull()).select(name)  # one row, if any
    return known.select(*df.columns, name).unionByName(df.where(F.col(column).isNull()).crossJoin(F.broadcast(none)))


def sample_rows(df: DataFrame, n: int, seed: int, *key: str) -> DataFrame:
    """n rows in an order given by a seeded hash of their key."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])), *key).limit(n)


def without(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(~F.col(column).isin(values))
