"""Tables of the session's catalog and default-format folders: create, load, overwrite, save."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.plans import scratch
from ledgerlens.sources import io
from ledgerlens.sources.io import FIELD, read_delimited


def create_table(spark: SparkSession, name: str, schema: T.StructType, path: str) -> None:
    """An empty table, unless there is one of the name."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{path}'")


def create_partitioned(spark: SparkSession, name: str, schema: T.StructType, by: list[str], path: str) -> None:
    """An empty table with a folder for each combination of the columns ``by``, which go last."""
    fields = [f for f in schema if f.name not in by] + [schema[c] for c in by]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(f'`{c}`' for c in by)}) LOCATION '{path}'")


def write_partitions(df: DataFrame, name: str, by: list[str], replace: bool = True) -> None:
    """Rows into a partitioned table. With ``replace`` the partitions that ``df`` has rows of are theirs alone afterwards; all others stay.

    Each partition is dealt to as many tasks as its size asks for, not to one, and not to all.
    """
    spark = df.sparkSession
    columns = spark.table(name).columns
    with scratch.settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        df.select(*columns).hint("rebalance", *[F.col(c) for c in by]).write.insertInto(name, overwrite=replace)


def drop_partition(spark: SparkSession, name: str, **values: str) -> None:
    """One partition out of a table, with its files."""
    spec = ", ".join(f"`{k}`='{v}'" for k, v in values.items())
    folder = f"{location(spark, name)}/" + "/".join(f"{k}={v}" for k, v in values.items())
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
    io.remove(spark, folder)


def create_table_as(spark: SparkSession, name: str, query: str, path: str) -> None:
    """A table with the rows of a SQL query."""
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}' AS {query}")


def load_text(spark: SparkSession, name: str, path: str, sep: str = FIELD, overwrite: bool = False) -> None:
    """Delimited text files into a table, under the table's own columns; lines of another number of fields are dropped."""
    read_delimited(spark, path, spark.table(name).schema, sep).write.insertInto(name, overwrite=overwrite)


def insert_overwrite(spark: SparkSession, name: str, query: str) -> None:
    spark.sql(f"INSERT OVERWRITE TABLE {name} {query}")


def insert_overwrite_directory(spark: SparkSession, path: str, query: str, form: str = "parquet") -> None:
    spark.sql(f"INSERT OVERWRITE DIRECTORY '{path}' USING {form} {query}")


def truncate(spark: SparkSession, name: str) -> None:
    """All rows out of a table, wherever its files lie: an overwrite with nothing."""
    spark.createDataFrame([], spark.table(name).schema).write.insertInto(name, overwrite=True)


def location(spark: SparkSession, name: str) -> str:
    """The folder of a table's files."""
    return next(r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r.col_name == "Location")


def rename_column(spark: SparkSession, name: str, old: str, new: str, path: str) -> None:
    """The table with another column name, its rows moved to ``path``; the folder they lay in is removed."""
    before = location(spark, name)
    spark.table(name).withColumnRenamed(old, new).write.mode("overwrite").parquet(path)
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    io.remove(spark, before)


def rename_table(spark: SparkSession, old: str, new: str) -> None:
    """Another name for the table; its files stay."""
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")


def save_table(df: DataFrame, name: str, path: str) -> None:
    df.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)


def save(df: DataFrame, path: str) -> None:
    """In the session's default format."""
    df.write.mode("overwrite").save(path)
