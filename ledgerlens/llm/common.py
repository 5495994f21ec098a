"""Helpers that the text operators share."""

from __future__ import annotations

import ctypes
import platform
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.relational import join_counted  # noqa: F401
from ledgerlens.plans import scratch

#: Rows and bytes of an Arrow batch; they bound a Python worker's memory on long texts.
BATCH_ROWS = 512
BATCH_BYTES = 32_000_000
#: Distinct class values that a classifier can be fitted to; its models and samples are bounded by this.
MAX_VALUES = 256


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5


def give_back() -> None:
    """What this process has freed goes back to the system, where its C library can do that."""
    if platform.libc_ver()[0] == "glibc":
        ctypes.CDLL(None).malloc_trim(0)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with batches small enough for long texts.

    Batches have at most BATCH_ROWS rows and, where Spark has that setting, about BATCH_BYTES bytes; this lowers the session's settings.
    Workers serve later stages as well, so what Arrow holds without use goes back at a task's end.
    """
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        try:
            now = conf.get(key)
        except PySparkException:  # no such setting
            continue
        if not (now.isdigit() and 0 < int(now) <= most):
            conf.set(key, str(most))

    def run(batches):
        yield from fn(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def per_row(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, list]], schema: str) -> DataFrame:
    """Arrow batches through ``fn``, which returns the columns named in ``schema``."""
    names = [x.strip().split(" ")[0] for x in schema.split(",")]
    types = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64())}
    kinds = [types[x.strip().split(" ", 1)[1]] for x in schema.split(",")]

    def run(batches):
        for b in batches:
            cols = fn(b)
            yield pa.RecordBatch.from_arrays([c if isinstance(c := cols[n], pa.Array) else pa.array(c, t) for n, t in zip(names, kinds)], names=names)

    return map_arrow(df, run, schema)


def sample_labelled(df: DataFrame, by: str, per_value: int, seed: str) -> DataFrame:
    """About ``per_value`` rows of every value of ``by``: those whose seeded hash falls under a threshold.

    The only use of it is to bound what a classifier is fitted on. Needs a column doc_id. Rows with a null value are left out;
    a column of over MAX_VALUES values is not one of classes and raises.
    The counts come from a scan of two columns; the texts of other rows are never read on.
    """
    counts = df.where(F.col(by).isNotNull()).groupBy(by).count().limit(MAX_VALUES + 1).collect()
    if len(counts) > MAX_VALUES:
        raise ValueError(f"{by} has over {MAX_VALUES} values; it is no column of classes")
    u = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"))), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))
    if not counts:
        return df.where(F.lit(False))
    share = F.create_map(*[F.lit(x) for r in counts for x in (r[0], per_value / r["count"])])
    return df.where(F.col(by).isNotNull() & (u < share[F.col(by)]))


#: Bits of the filter that `maybe_among` broadcasts: 4 MB at most, whatever the number of keys.
FILTER_BITS = 1 << 25


def maybe_among(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``df`` with a column __maybe: false only where ``key`` is surely not among ``keys``.

    A bitmap with one bit a hashed key, built by aggregation and broadcast in rows of 4 kB. It keeps rows that need no
    join out of a shuffle; with very many keys it says true more often, which costs only that shuffle.
    """
    place = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    bits = keys.select(F.bitmap_bucket_number(place).alias("__bucket"), F.bitmap_bit_position(place).alias("__at"))
    table = scratch.keep(bits.groupBy("__bucket").agg(F.bitmap_construct_agg("__at").alias("__bits")), "filter")
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("__bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return df.withColumn("__bucket", F.bitmap_bucket_number(place)).join(F.broadcast(table), "__bucket", "left").withColumn("__maybe", hit).drop("__bucket", "__bits")
