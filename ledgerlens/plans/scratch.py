"""Tables that cut lineage, in the folder all executors share.

A table written here survives the loss of any executor, and reading it back
gives the optimizer true sizes, so a later join is broadcast only when the
written table is known to be small.
"""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.sources import io

_own: dict[str, str] = {}
_scopes: list[Scope] = []


class Scope:
    """Tables and paths made while it is open; those not released are removed at its end, so their users must have been written by then."""

    def __init__(self):
        self.kept: list[DataFrame] = []
        self.paths: list[tuple[SparkSession, str]] = []

    def release(self, df: DataFrame) -> DataFrame:
        """Keep ``df`` beyond this scope, and leave it to the one around it."""
        self.kept = [k for k in self.kept if k._scratch_path != df._scratch_path]
        self.paths = [p for p in self.paths if p[1] != df._scratch_path]
        outer = _scopes[: _scopes.index(self)]
        if outer:
            outer[-1].kept.append(df)
        return df


@contextmanager
def scope() -> Iterator[Scope]:
    s = Scope()
    _scopes.append(s)
    try:
        yield s
    finally:
        _scopes.remove(s)
        for df in s.kept:
            drop(df)
        for spark, path in s.paths:
            io.remove(spark, path)


def roots_of(df: DataFrame) -> set[str]:
    """All parts of the paths of folders and files that a frame's plan reads."""
    leaves, found = df._jdf.queryExecution().analyzed().collectLeaves(), set()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            paths = leaf.relation().location().rootPaths()
            found |= {part for k in range(paths.size()) for part in paths.apply(k).toString().split("/")}
    return found


def tidy(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, leaving only those of its tables that the result's plan reads."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with scope() as s:
            out = query(spark, sf_dir)
            read = roots_of(out)
            used = lambda path: path.rsplit("/", 1)[-1] in read
            for df in [k for k in s.kept if used(k._scratch_path)]:
                s.release(df)
            s.paths = [(session, path) for session, path in s.paths if not used(path)]
        return out

    return run


def root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where that is unset, on a local master only, a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", None) or ""
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        key = spark.sparkContext.applicationId
        if key not in _own:
            _own[key] = tempfile.mkdtemp(prefix="ledgerlens-")
            atexit.register(shutil.rmtree, _own[key], True)
        base = f"file://{_own[key]}"
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{root(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].paths.append((spark, path))
    return path


def keep(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` once and read it back."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    if _scopes:
        _scopes[-1].kept.append(out)
    return out


def keep_bucketed(df: DataFrame, name: str, *columns: str, buckets: int | None = None, dealt: bool = False) -> DataFrame:
    """Like ``keep``, dealt into bucket files by ``columns``: a join on them reads the files as they lie, without a shuffle of this side.

    As many buckets as there are shuffle partitions unless given. Each is written by one task. ``dealt``: the rows lie by these
    columns already, as after a join or grouping on them, and are written as they lie. The catalog has the table only while it is made.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path, table = new_path(spark, name), f"ledgerlens_scratch_{uuid.uuid4().hex}"
    try:
        (df if dealt else df.repartition(n, *columns)).write.format("parquet").bucketBy(n, *columns).option("path", path).saveAsTable(table)
        out = spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # the files stay, and the frame knows them
    out._scratch_path = path
    if _scopes:
        _scopes[-1].kept.append(out)
    return out


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for what is planned inside; those from before come back at the end."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def drop(df: DataFrame | None) -> None:
    """Remove the files behind a frame returned by ``keep``; its users must have been written by then."""
    if (path := getattr(df, "_scratch_path", None)) is None:
        return
    io.remove(df.sparkSession, path)
