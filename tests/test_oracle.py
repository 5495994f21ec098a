"""Every query with an SQL counterpart gives its rows on the smallest tables."""

import math
import os
import subprocess
import sys

import duckdb
import pytest

from ledgerlens import registry
from ledgerlens.registry import ORACLE, QUERIES

registry.load()

D = "/root/testdata/sf0.001"


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    return f"{float(v):.8g}" if isinstance(v, (int, float)) or type(v).__name__ == "Decimal" else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(D):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{D}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, D)
    want = duck.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    a = sorted(tuple(_norm(r[c]) for c in sorted(got.columns)) for r in got.collect())
    b = sorted(tuple(_norm(r[want.columns.index(c)]) for c in sorted(want.columns)) for r in want.fetchall())
    assert a == b


@pytest.mark.parametrize("name", ["basic", "graph", "service", "profiles", "tables"])
def test_each_catalogue_is_imported_alone(name):
    subprocess.run([sys.executable, "-c", f"import ledgerlens.plans.catalogue_{name}"], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
