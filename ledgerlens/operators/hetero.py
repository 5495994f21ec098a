"""A graph of cards, regions, merchants and terminals, with typed vertices and edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_KINDS = {"card": "srccard", "region": "region_cd", "merchant": "mchnt_cd", "terminal": "term_id"}
#: Edge types with their transaction codes and target kinds.
EDGE_TYPES = {"trans_to": (("S33", "S25"), "card", "dstcard"), "trans_at": (("S33", "S25"), "region", "region_cd"), "quxian_at": (("S24",), "region", "region_cd"), "query_at": (("S00",), "terminal", "term_id"), "consume_at": (("S22",), "merchant", "mchnt_cd")}


def _name(kind: str, column: str):
    return F.concat(F.lit(kind + ":"), F.trim(F.col(column).cast("string")))


def typed_edges(tx: DataFrame, types=tuple(EDGE_TYPES)) -> DataFrame:
    """Merged edges (src, dst, edge_type, money, cnt, night) of the ``types``, each row of ``tx`` giving one edge for every type it fits; one scan, of rows with their codes only."""
    chosen = {t: EDGE_TYPES[t] for t in types}
    tx = tx.where(F.col("trans_id").isin(*{c for codes, _, _ in chosen.values() for c in codes}))
    made = [F.when(F.col("trans_id").isin(*codes), F.struct(F.lit(t).alias("edge_type"), _name("card", "srccard").alias("src"), _name(kind, col).alias("dst"))) for t, (codes, kind, col) in chosen.items()]
    night = F.left("loc_trans_tm", F.lit(2)).between("01", "05").cast("int")
    rows = tx.select("money", night.alias("night"), F.explode(F.array_compact(F.array(*made))).alias("e")).select("e.*", "money", "night")
    return merge_typed(rows.withColumn("cnt", F.lit(1).cast("long")))


def merge_typed(edges: DataFrame, types=tuple(EDGE_TYPES)) -> DataFrame:
    """One edge for each (src, dst, edge_type), with sums of money, cnt and night. Raises on an edge whose type is none of ``types``, null included."""
    known = F.when(F.col("edge_type").isin(*types), F.col("edge_type")).otherwise(F.raise_error(F.concat(F.lit("unknown edge type "), F.coalesce("edge_type", F.lit("null")))))
    return edges.withColumn("edge_type", known).groupBy("src", "dst", "edge_type").agg(*[F.sum(c).alias(c) for c in ("money", "cnt", "night")])


def typed_vertices(edges: DataFrame) -> DataFrame:
    """(vid, vertex_type, value) of all endpoints."""
    v = edges.select(F.explode(F.array("src", "dst")).alias("vid")).distinct()
    return v.select("vid", F.substring_index("vid", ":", 1).alias("vertex_type"), F.expr("substring(vid, instr(vid, ':') + 1)").alias("value"))


#: Edge types that lead to regions.
TO_REGIONS = ("trans_at", "quxian_at")


def regions_of_communities(edges: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cc, regions) and (region, communities): distinct counts each way over edges from member cards to regions."""
    at = edges.where(F.col("edge_type").isin(*TO_REGIONS)).join(members.select(F.col("vid").alias("src"), "cc"), "src")
    return at.groupBy("cc").agg(F.count_distinct("dst").alias("regions")), at.groupBy(F.col("dst").alias("region")).agg(F.count_distinct("cc").alias("communities"))
