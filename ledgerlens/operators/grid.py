"""Edges dealt over a square of cells: a row by the hash of src, a column by that of dst.

The edges of a hub lie in all cells of one row or column instead of one task, and a state is copied to the
cells where its vertex has edges only: at most as many as the square has rows, and all states together at most
once an edge. Cells are kept in bucket files, and states go to them: the edges themselves are shuffled once,
however many rounds read them.
"""

from __future__ import annotations

import math
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.plans import scratch

#: Cells for each bucket file, which evens out how their hashes fall.
CELLS_PER_BUCKET = 4
#: What is planned over a grid. States are broadcast only where they are known, once shuffled, to be that small: a table's size on disk doesn't tell how many copies it gives.
PLANNED = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "1m"}


class Grid:
    """``edges(src, dst, ...)`` in ``side`` times ``side`` cells; four cells a shuffle partition unless given."""

    def __init__(self, edges: DataFrame, side: int | None = None):
        self.buckets = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.side = side or max(2, math.isqrt(CELLS_PER_BUCKET * self.buckets))
        cell = self._place("src") * self.side + self._place("dst")
        self.edges = scratch.keep_bucketed(edges.withColumn("cell", cell), "grid", "cell", buckets=self.buckets)
        self._where: dict[str, DataFrame] = {}

    def _place(self, column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.side)).cast("int")

    @contextmanager
    def planned(self):
        """Joins on a cell and a vertex take the files' dealing by cell as it is, for what is written inside; so do joins of states kept by ``keep_states``."""
        with scratch.settings(self.edges.sparkSession, PLANNED):
            yield

    def where(self, end: str) -> DataFrame:
        """(vid, cell): the cells that hold edges whose ``end`` is the vertex. Written when first asked for, bucketed by vid."""
        if end not in self._where:
            self._where[end] = scratch.keep_bucketed(self.edges.select(F.col(end).alias("vid"), "cell").distinct(), "where", "vid", buckets=self.buckets)
        return self._where[end]

    def keep_states(self, states: DataFrame, name: str) -> DataFrame:
        """``states(vid, ...)`` in bucket files by vid, so that neither joins with messages nor those with cells shuffle them; as it lies if it was joined or grouped by vid."""
        return scratch.keep_bucketed(states, name, "vid", buckets=self.buckets, dealt=True)

    def copies(self, state: DataFrame, end: str, prefix: str) -> DataFrame:
        """``state(vid, ...)`` once for each cell with edges of the vertex at ``end``, its columns prefixed."""
        values = [F.col(c).alias(f"{prefix}{c}") for c in state.columns if c != "vid"]
        return state.join(self.where(end), "vid").select("cell", F.col("vid").alias(end), *values)

    def joined(self, edges: DataFrame, state: DataFrame, end: str, prefix: str | None = None) -> DataFrame:
        """``edges`` of this grid whose ``end`` has a row in ``state(vid, ...)``, with its columns as <end>_<column>."""
        return edges.join(self.copies(state, end, f"{end}_" if prefix is None else prefix), [end, "cell"])

    def messages(self, senders: DataFrame, message: Column, how=F.sum) -> DataFrame:
        """(vid, msg): ``message`` over the edge's columns and src_<column>, from the senders along their edges; what reaches a vertex is aggregated in each cell first."""
        return self.joined(self.edges, senders, "src").groupBy(F.col("dst").alias("vid")).agg(how(message).alias("msg"))

    def drop(self) -> None:
        for table in (self.edges, *self._where.values()):
            scratch.drop(table)
