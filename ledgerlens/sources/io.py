"""Readers and writers for the text layouts of card data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.sources import schema as S

FIELD = "\u0001"


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = FIELD, exact: bool = True) -> DataFrame:
    """Delimited text under a fixed schema, fields trimmed; unparsable fields are null.

    With ``exact`` only lines with as many fields as the schema has are read: shorter ones are
    dropped, never filled from the line before.
    """
    parts = F.split("value", _quote(sep), -1)
    rows = spark.read.text(path).select(parts.alias("f"))
    if exact:
        rows = rows.where(F.size("f") == len(schema))
    return rows.select(*[F.trim(F.get("f", F.lit(i))).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema)])


def _quote(sep: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c.isprintable() and c != " " else c for c in sep)


def read_blank_separated(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Fields separated by any white space."""
    parts = F.split(F.trim("value"), "\\s+")
    return spark.read.text(path).select(parts.alias("f")).where(F.size("f") >= len(schema)).select(*[F.get("f", F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema)])


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """One card a line: distinct, trimmed, without empty lines."""
    return spark.read.text(path).select(F.trim("value").alias("card")).where("card <> ''").distinct()


def read_events(tx: DataFrame) -> dict[str, DataFrame]:
    """The four event tables of the mixed graph, from one transactions frame."""
    kinds = {"transfer": (S.TRANSFER_IN, S.TRANSFER_OUT), "withdrawal": (S.WITHDRAWAL,), "query": (S.BALANCE,), "purchase": (S.PURCHASE,)}
    return {k: tx.where(F.col("trans_id").isin(*v)) for k, v in kinds.items()}


def date_dictionary(spark: SparkSession, start: str, end: str) -> DataFrame:
    """(pdate, day_index) for every day from start to end, both included; dates as yyyyMMdd."""
    days = F.sequence(F.to_date(F.lit(start), "yyyyMMdd"), F.to_date(F.lit(end), "yyyyMMdd"))
    return spark.range(1).select(F.posexplode(days).alias("day_index", "d")).select(F.date_format("d", "yyyyMMdd").alias("pdate"), "day_index")


def dates_of(df: DataFrame, column: str = "pdate", first: str | None = None) -> DataFrame:
    """(pdate, day_index) for every day from ``first``, else the first date in ``column``, to the last there, both included; none where there is no date."""
    ends = df.agg((F.min(column) if first is None else F.lit(first)).alias("first"), F.max(column).alias("last"))
    days = F.sequence(F.to_date("first", "yyyyMMdd"), F.to_date("last", "yyyyMMdd"))
    return ends.select(F.posexplode(days).alias("day_index", "d")).select(F.date_format("d", "yyyyMMdd").alias("pdate"), "day_index")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in whatever store it lies."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def write_lines(df: DataFrame, path: str, sep: str = ",", single: bool = False) -> None:
    """Rows as lines of joined fields, nulls as the word null; ``single`` for one file (small results only)."""
    line = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in df.columns])
    out = df.select(line.alias("value"))
    (out.coalesce(1) if single else out).write.mode("overwrite").text(path)


def write_groups(df: DataFrame, path: str, group: str, least: int = 3) -> None:
    """One folder for each group of at least ``least`` rows, all in one job."""
    sizes = df.groupBy(group).count().where(F.col("count") >= least).select(group)
    df.join(sizes, group, "left_semi").write.mode("overwrite").partitionBy(group).parquet(path)
