"""Score a file of cards: python -m ledgerlens.cli CARDS TABLES OUT

CARDS: lines "original,card"; a card is its number or the MD5 of it in 32 hexadecimal digits. TABLES: folder of the tables.
OUT: folder for one CSV, best score first. On a cluster the session needs spark.checkpoint.dir, a folder all executors share.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import features, graph
from ledgerlens.operators import relational as R
from ledgerlens.plans import scratch
from ledgerlens.sources import io
from ledgerlens.sources import schema as S
from ledgerlens.sources.transactions import transactions


def known_cards(spark: SparkSession, cards: str, tx: DataFrame) -> DataFrame:
    """(oricard, card) of every listed line; card is null where no transaction has it."""
    listed = io.read_delimited(spark, cards, S.MD5_CARD, ",").where("md5card <> ''").distinct()
    card = F.col("card").cast("string")
    names = tx.select("card").distinct().select("card", F.explode(F.array(card, F.md5(card))).alias("md5card"))
    return listed.withColumn("md5card", F.lower("md5card")).join(names, "md5card", "left").select("oricard", "card")


def score(spark: SparkSession, cards: str, tables: str, out: str, hops: int = 5, kmax: int | None = None) -> None:
    """Seeds, their neighbourhood, features of its cards and of their communities, scores of the listed ones."""
    every = transactions(spark, tables, holders_first=True)
    every = scratch.keep(every.select("card", "trans_id", "trans_curr_cd", *features.TRANSFER), "every")  # made once: all below reads it
    listed = scratch.keep(known_cards(spark, cards, every), "listed")
    between = F.col("trans_id").isin(S.TRANSFER_IN, S.TRANSFER_OUT) & (F.col("srccard") != F.col("dstcard"))
    edges = every.where(between).select(F.col("srccard").alias("src"), F.col("dstcard").alias("dst"))
    near = graph.expand(edges, listed.where("card is not null").select(F.col("card").alias("vid")), hops)
    tx = R.restricted(every, near.select(F.col("vid").alias("card")), "card")
    transfers = scratch.keep(tx.where(between).select(*features.TRANSFER), "transfers")
    merged = scratch.keep(features.merge_transfers(transfers), "merged")
    members = features.community_vertices(merged, kmax)
    community = members.select(F.col("vid").alias("card"), "cc").join(features.community_features(merged, members, transfers), "cc").drop("cc")
    scores = features.rank_sum_score(features.card_features(tx).join(community, "card", "left"))
    io.write_lines(features.attach_originals(scores, listed).select("oricard", "score"), out, single=True)


if __name__ == "__main__":
    if len(sys.argv) != 4:
        sys.exit(__doc__)
    score(SparkSession.builder.getOrCreate(), *sys.argv[1:])
