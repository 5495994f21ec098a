"""op11 against its definition in plain Python."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import queries, resampling

D = "/root/testdata/sf0.001"


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def brute(docs, target, buckets=10_000, seed=7, share=25, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = collections.Counter(bucket(f) for _, x in docs for f in features(x)[1])
    t = collections.Counter(bucket(f) for x in target for f in features(x)[1])
    total_s, total_t = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets))))
    rows = []
    for i, x in docs:
        n, f = features(x)
        weight = math.floor(sum(gain(bucket(y)) for y in f) / len(f)) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], -(10**18) if r[0] is None else r[0], r[2]))
    drawn = order[: share * len(order) // 100]
    place = collections.defaultdict(list)
    for k, r in enumerate(drawn, 1):
        place[r].append(k)
    return sorted(((i, n, w, sc, place[(i, k, n, w, sc)].pop(0) if place[(i, k, n, w, sc)] else None) for i, k, n, w, sc in rows), key=repr)


def rows(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=repr)


def test_query_is_its_definition(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{D}/documents.parquet'").fetchall()
    target = [r[0] for r in duckdb.sql(f"SELECT text FROM '{D}/benchmark.parquet'").fetchall()]
    got = queries.op11_importance_resampling(spark, D)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    assert rows(got) == brute(docs, target)


@pytest.fixture(scope="module")
def odd():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abZ9é漢😀") for _ in range(rnd.randint(1, 4)))
    docs = [(i, rnd.choice([" ", "_", "\x7f", "\n", "@"]).join(word() for _ in range(rnd.randint(0, 60)))) for i in range(80)]
    docs += [(None, None), (None, "x " * 30), (200, None), (201, ""), (202, " \t--"), (203, "w" * 5000)]
    docs += [docs[7], docs[7], docs[8], (9, "other words " * 12), (9, "other words " * 11)]
    docs.append((300, " ".join(word() for _ in range(9000))))
    return docs


@pytest.mark.parametrize("small", [False, True])
def test_odd_rows_slices_and_small_tries(spark, odd, small, monkeypatch):
    if small:
        monkeypatch.setattr(resampling, "MAX_NODES", 50)
        monkeypatch.setattr(resampling, "SLICE", 100)
    target = ["ab aZ é漢 w", None, "", "other words"]
    df = spark.createDataFrame(odd, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("score", "rank", "key", "bucket", "n", "short")})
    t = spark.createDataFrame([(x, 1) for x in target], "text string, n long")
    assert rows(resampling.judge(df, t)) == brute(odd, [x for x in target])
    drawn = resampling.draw(df, t)
    assert drawn.columns == df.columns
    assert {r.doc_id for r in drawn.collect()} == {r[0] for r in brute(odd, target) if r[4] and r[0] is not None}


def test_a_slice_loses_no_pair(monkeypatch):
    text = b"one two  three four five sixsixsixsix seven " * 3
    whole = text.split()
    for size in (1, 5, 9, 40):
        monkeypatch.setattr(resampling, "SLICE", size)
        parts = list(resampling.words_of(text))
        assert parts[0] + [w for p in parts[1:] for w in p[1:]] == whole
        assert all(a[-1] == b[0] for a, b in zip(parts, parts[1:]))


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b " * 10)] * 4, "doc_id long, text string")
    assert resampling.judge(none, some.select("text")).count() == 0
    assert rows(resampling.judge(some, none.select("text"))) == brute([(1, "a b " * 10)] * 4, [])
