"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its target share of the text over its actual share.
Every document draws its number of copies from a Poisson distribution of that mean by
inverting the distribution at a uniform number hashed from its id, so a rerun, a retried
task or another partitioning gives the same copies. Copies are dealt out and ordered by a
second hash. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.plans import scratch

SEED = 17
TEMPERATURE = 0.7
#: More sources than this are joined by shuffle, salted, and not broadcast.
BROADCAST_SOURCES = 10_000
SALTS = 64


def _hash(seed: int, what: str, digits: int, *cols: Column) -> Column:
    text = F.concat_ws(":", F.lit(f"{what}:{seed}"), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def rates(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, total: float = 1.0) -> DataFrame:
    """(source, rate): the mean number of copies of each source's documents.

    Sizes are characters plus one for each document, so empty texts count. Without ``weights``
    a source's weight is its size to the power ``temperature``; with them, sources that
    they lack get none. ``total`` is the target size over the present one. A null source is a source.
    """
    size = docs.groupBy("source").agg(F.sum(F.length(F.coalesce("text", F.lit(""))) + 1).cast("double").alias("size"))
    if weights is None:
        weight = F.pow("size", F.lit(temperature))
    else:
        weight = F.coalesce(F.create_map(*[F.lit(x) for k, v in weights.items() for x in (k, float(v))])[F.coalesce("source", F.lit(""))], F.lit(0.0)) if weights else F.lit(0.0)
    table = scratch.keep(size.withColumn("weight", weight), "sources")
    sums = table.agg(F.sum("weight").alias("w"), F.sum("size").alias("s"))  # one row
    return table.crossJoin(F.broadcast(sums)).select("source", F.when(F.col("w") > 0, F.col("weight") / F.col("w") * F.col("s") * total / F.col("size")).otherwise(0.0).alias("rate"))


def _distribution(rate: Column) -> Column:
    """Cumulative probabilities of 0, 1, 2, ... copies, as far as a double tells them from one."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 24).cast("int")
    start = F.struct((-rate).alias("logp"), F.array(F.exp(-rate)).alias("cum"))

    def step(s, k):
        logp = s["logp"] + F.log(rate / k)
        return F.struct(logp.alias("logp"), F.array_append(s["cum"], F.element_at(s["cum"], -1) + F.exp(logp)).alias("cum"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), last), start, step, lambda s: s["cum"])).otherwise(F.array(F.lit(1.0)))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, total: float = 1.0, seed: int = SEED) -> DataFrame:
    """``docs(doc_id, text, source, ...)``, each row as often as its draw says, in a random global order.

    Adds copy (1, 2, ...) and order_key, by which and the text rows are dealt to partitions by hash, and sorted by order_key
    within them; input columns of these names are dropped. Rows of one id draw alike. Null ids draw as one id;
    null texts are empty and are kept like others. An empty table stays empty.
    """
    docs = docs.drop("copy", "order_key")
    table = scratch.keep(rates(docs, weights, temperature, total).withColumn("__mix_cum", _distribution(F.col("rate"))).withColumnRenamed("source", "__mix_source").drop("rate"), "rates")
    if table.count() <= BROADCAST_SOURCES:
        joined = docs.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("__mix_source")))
    else:
        salted = table.withColumn("__mix_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        left = docs.withColumn("__mix_salt0", F.pmod(F.xxhash64("doc_id", "text"), F.lit(SALTS)).cast("int"))
        joined = left.join(salted, F.col("source").eqNullSafe(F.col("__mix_source")) & (F.col("__mix_salt0") == F.col("__mix_salt"))).drop("__mix_salt", "__mix_salt0")
    u = _hash(seed, "mix", 13, F.col("doc_id")) / F.lit(float(2**52))
    copies = F.size(F.filter("__mix_cum", lambda c: c <= F.col("__mix_u")))
    drawn = joined.withColumn("__mix_u", u).withColumn("__mix_n", copies).where("__mix_n > 0").drop("__mix_u", "__mix_cum", "__mix_source")
    out = drawn.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__mix_n")))).drop("__mix_n").withColumn("order_key", _hash(seed, "order", 15, F.col("doc_id"), F.col("copy")))
    # the texts' hashes part rows that have no id or share one
    return out.repartition(F.col("order_key"), F.xxhash64("text")).sortWithinPartitions("order_key")


ORACLE = f"""
WITH RECURSIVE size AS (SELECT source, sum(length(coalesce(text, '')) + 1)::DOUBLE AS size FROM documents GROUP BY source),
weight AS (SELECT source, size, pow(size, {TEMPERATURE}) AS weight FROM size),
rate AS (SELECT source, weight / (SELECT sum(weight) FROM weight) * (SELECT sum(size) FROM weight) / size AS rate FROM weight),
p AS (
  SELECT source, rate, 0 AS k, -rate AS logp, exp(-rate) AS cum FROM rate
  UNION ALL
  SELECT source, rate, k + 1, logp + ln(rate / (k + 1)), cum + exp(logp + ln(rate / (k + 1))) FROM p WHERE k < ceil(rate + 12 * sqrt(rate) + 24)
),
drawn AS (
  SELECT d.*, (SELECT count(*) FROM p WHERE p.source IS NOT DISTINCT FROM d.source AND p.cum <= ('0x' || substr(md5('mix:{SEED}:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT / {float(2**52)}) AS n
  FROM documents d
)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy, ('0x' || substr(md5('order:{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || copy::VARCHAR), 1, 15))::BIGINT AS order_key
FROM (SELECT * EXCLUDE (n), unnest(range(1, n + 1)) AS copy FROM drawn WHERE n > 0)
"""
