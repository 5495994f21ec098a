"""Scalar functions, readers and writers, gaps, indexes."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as X
from ledgerlens.operators import features, flow, gaps, profiles
from ledgerlens.operators import relational as R
from ledgerlens.operators.features import card_features, rank_sum_score
from ledgerlens.sources import io
from ledgerlens.sources import schema as S

# Ids known for these texts.
KNOWN = {"1710": 554213000667325, "f6dcd82d211c45964f11ea5e1ebd12fa": 895004484848200, "898440458120183": 759701945336593, "13213491": 869297802268839}


def test_md5_ids(spark):
    texts = list(KNOWN) + [f"card{i}" for i in range(300)]
    got = {r.t: r.i for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.md5_id(F.col("t")).alias("i")).collect()}
    for t in texts:
        signed = int.from_bytes(hashlib.md5(t.encode()).digest(), "big", signed=True)
        assert got[t] == abs(signed) % 10**15  # the digits as written, whatever the sign
    assert all(got[t] == i for t, i in KNOWN.items())


def test_bkdr(spark):
    def plain(s, mask):
        h = 0
        for c in s:
            h = (h * 131 + ord(c)) & mask
        return h

    got = spark.createDataFrame([("",), ("6212abc",)], "s string").select("s", X.bkdr_hash(F.col("s"), 0x1FFFFFFFFF).alias("h")).collect()
    assert {r.s: r.h for r in got} == {s: plain(s, 0x1FFFFFFFFF) for s in ("", "6212abc")}


def test_flags(spark):
    rows = spark.createDataFrame([(200000, "235959"), (200100, "x"), (8998, "060000"), (None, None)], "m long, t string")
    r = rows.select(X.is_large_integer(F.col("m")).alias("li"), X.hour(F.col("t")).alias("h"), X.is_night(F.col("t")).alias("n"), X.count_89(F.col("m")).alias("c")).collect()
    assert [x.h for x in r] == [23, -1, 6, -1] and [x.n for x in r][:3] == [1.0, 0.0, 0.0]
    assert [x.c for x in r][:3] == [0.0, 0.0, 4.0] and r[0].li == 1.0 and r[2].li == 1.0


def test_event_time(spark):
    r = spark.createDataFrame([("20160707", "101112"), ("20160631", "101112"), ("2016070", "101112")], "d string, t string").select(X.event_time(F.col("d"), F.col("t")).cast("string").alias("x")).collect()
    assert [x.x for x in r] == ["2016-07-07 10:11:12", None, None]


def test_delimited_files(spark, tmp_path):
    p = tmp_path / "in"
    p.mkdir()
    (p / "a.txt").write_text("c1\x01 c2 \x0112.5\x013\nshort\x01row\nc3\x01c4\x01bad\x014\n")
    rows = [tuple(r) for r in io.read_delimited(spark, str(p), S.PAIR_EDGES).collect()]
    assert rows == [("c1", "c2", 12.5, 3), ("c3", "c4", None, 4)]
    (p / "a.txt").write_text("1  2 3.5 4\n5 6 7 8\n")
    assert [tuple(r) for r in io.read_blank_separated(spark, str(p), S.ENCODED_EDGES).collect()] == [(1, 2, 3.5, 4), (5, 6, 7.0, 8)]
    (p / "a.txt").write_text("aa\n\nbb \naa\n")
    assert sorted(r.card for r in io.read_seeds(spark, str(p)).collect()) == ["aa", "bb"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "i int, s string")
    io.write_lines(df, str(tmp_path / "o"), single=True)
    files = [f for f in os.listdir(tmp_path / "o") if f.startswith("part-")]
    assert len(files) == 1 and sorted((tmp_path / "o" / files[0]).read_text().split()) == ["1,a", "2,null", "3,c"]
    g = spark.createDataFrame([(1, i) for i in range(3)] + [(2, 9)], "cc int, v int")
    io.write_groups(g, str(tmp_path / "g"), "cc")
    assert [f for f in os.listdir(tmp_path / "g") if f.startswith("cc=")] == ["cc=1"]


def test_dates(spark):
    r = io.date_dictionary(spark, "20160228", "20160302").collect()
    assert [(x.pdate, x.day_index) for x in r] == [("20160228", 0), ("20160229", 1), ("20160301", 2), ("20160302", 3)]
    days = lambda *v: [(x.pdate, x.day_index) for x in io.dates_of(spark.createDataFrame([(x,) for x in v], "pdate string")).collect()]
    assert days("20160301", "20160228", None, "20160301") == [("20160228", 0), ("20160229", 1), ("20160301", 2)]
    assert days() == days(None) == []


def test_gaps(spark):
    df = spark.createDataFrame([("c", 0, 100), ("c", 90, 60), ("c", 600, 80), ("d", 5, 1)], "card string, at long, money long")
    r = {(x.card, x.at): (x.gap_minutes, x.gap_money) for x in gaps.amount_gaps(df, "card", F.col("at"), "money").collect()}
    assert r == {("c", 600): (None, None), ("c", 90): (8.5, 20), ("c", 0): (1.5, None), ("d", 5): (None, None)}


def test_index_and_ranks(spark):
    df = spark.range(1000).select(F.col("id").alias("x"), (F.col("id") % 7).alias("k")).repartition(5)
    assert sorted((r.x, r.row_index) for r in R.with_index(df, "x").collect()) == [(i, i + 1) for i in range(1000)]
    assert {(r.k, r.rank) for r in R.dense_rank_of(df, "k", "rank").collect()} == {(i, i + 1) for i in range(7)}


def test_strict_lookup(spark):
    import pytest

    d = spark.createDataFrame([("a", 1)], "k string, v int")
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    assert R.lookup(df, d, "k").count() == 1
    with pytest.raises(Exception, match="unknown key b"):
        R.lookup(df, d, "k", strict=True).collect()


def test_dispersion_and_flow(spark):
    w = spark.createDataFrame([("a", 2), ("a", 4), ("b", 5)], "card string, x long")
    assert {r.card: r.dispersion for r in profiles.dispersion(w, "card", "x").collect()} == {"a": 0.3333, "b": 0.0}
    e = spark.createDataFrame([(1, 2, 100, 1), (2, 3, 99, 2), (3, 3, 5, 1)], "src long, dst long, money long, cnt long")
    r = {x.vid: (x.amt_in, x.amt_out, x.net) for x in flow.in_out(e).collect()}
    assert r == {1: (0, 100, 100), 2: (100, 99, 1), 3: (104, 5, 99)}


def test_compatible_features_and_score(spark):
    cols = "card long, srccard long, dstcard long, money long, loc_trans_tm string, region_cd string, term_id string, resp_cd4 string, trans_curr_cd string, trans_md string, trans_id string"
    rows = [(1, 2, 1, 100000, "030000", "1003", "1", "51", "156", "1", "S33"), (1, 3, 1, 300000, "120000", "1004", "1", "00", "840", "2", "S33"), (2, 2, 1, 500, "120000", "1004", "2", "00", "156", "1", "S24")]
    df = spark.createDataFrame(rows, cols)
    new, old = card_features(df).where("card = 1").first(), card_features(df, compat=True).where("card = 1").first()
    assert (new.transin_max, old.transin_max, new.distinct_cards_in, new.distinct_cards_out, old.distinct_cards_out) == (3000, 2000.0, 2, 0, 1)
    f = spark.createDataFrame([(1, 5, 1), (2, None, 1), (3, 9, 2)], "card long, tot_counts long, tot_provs long")
    assert {r.card: r.score for r in rank_sum_score(f).collect()} == {1: 2.5, 2: 1.5, 3: 4.0}


def test_features_make_the_transactions_once(spark):
    """Both aggregations read one table of flags by card; which join comes first changes no row; unknown flags stay unknown, and one card may have all rows."""
    from ledgerlens.plans import scratch
    from ledgerlens.sources.transactions import transactions

    d = "/root/testdata/sf0.001"
    by_sender, by_order = transactions(spark, d), transactions(spark, d, holders_first=True)
    assert by_sender.columns == by_order.columns
    assert by_sender.exceptAll(by_order).isEmpty() and by_order.exceptAll(by_sender).isEmpty() and by_order.count() > 0
    found = scratch.roots_of(card_features(by_order))
    assert "lineitem.parquet" not in found and any(f.startswith("by_card-") for f in found)
    hub = by_order.withColumns({"card": F.lit(7), "trans_md": F.lit(None).cast("string")})
    got, n = card_features(hub).collect(), hub.count()
    assert [(r.card, r.tot_counts, r.tot_foreign) for r in got] == [(7, n, None)]
    assert got[0].distinct_cards_in == hub.where("trans_id = 'S33'").select("srccard").distinct().count() > 0


def test_unknown_edge_types_raise(spark):
    from ledgerlens.operators import hetero

    e = spark.createDataFrame([("a", "b", "trans_to", 5, 1, 0), ("a", "b", "trans_to", 6, 1, 1), ("a", "b", "query_at", 0, 1, 0)], "src string, dst string, edge_type string, money long, cnt long, night long")
    assert sorted(hetero.merge_typed(e).collect()) == [("a", "b", "query_at", 0, 1, 0), ("a", "b", "trans_to", 11, 2, 1)]
    for bad in ("trans_too", None):
        with pytest.raises(Exception, match="unknown edge type"):
            hetero.merge_typed(e.withColumn("edge_type", F.lit(bad).cast("string"))).collect()


def test_dense_ranks_with_null_and_ties(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 5), (4, -1), (5, None)], "k long, v long")
    assert sorted((r.k, r.place) for r in R.dense_rank_of(df, "v", "place").collect()) == [(1, 1), (2, 3), (3, 3), (4, 2), (5, 1)]


def test_queries_leave_only_what_their_result_reads(spark):
    """What a query wrote is gone afterwards, but for the tables its result is read from; the result is whole."""
    import glob

    from ledgerlens import registry
    from ledgerlens.plans import scratch

    registry.load()
    folder = lambda: {p.rsplit("/", 1)[-1] for p in glob.glob(scratch.root(spark).removeprefix("file://") + "/*")}
    for name in ("components", "core_labels", "page_rank_six_rounds", "vertex_subgraph", "card_rank_sum_score", "strong_components", "directory_overwritten", "some_partitions_overwritten", "count_rank_ratios"):
        before = folder()
        out = registry.QUERIES[name](spark, "/root/testdata/sf0.001")
        left = folder() - before
        assert left <= scratch.roots_of(out), name
        assert len(left) <= 6 and out.count() > 0, name
    assert not spark.sql("SHOW TABLES LIKE 'ledgerlens*'").where("isTemporary = false").collect()


def test_communities_merge_only_what_they_need(spark, monkeypatch):
    """Pairs are merged without modes and sets, and written once, where a query asks for components or money only; typed edges are made of the asked types only."""
    from ledgerlens import registry
    from ledgerlens.operators import hetero
    from ledgerlens.plans import scratch
    from ledgerlens.sources.transactions import transactions

    registry.load()
    kept, keep = [], scratch.keep
    monkeypatch.setattr(scratch, "keep", lambda df, name="cut": kept.append((name, df.columns)) or keep(df, name))
    for name, columns in {"regions_per_community": [], "component_distinct_counts": [], "community_dump_read_back": ["money"], "edges_of_largest_community": ["money"], "community_members": ["money", "cnt"]}.items():
        kept.clear()
        assert registry.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
        assert [c for n, c in kept if n in ("merged", "pairs")][0] == ["src", "dst", *columns], name
        assert name == "community_members" or not [n for n, _ in kept if n == "pairs"], name
    tx = transactions(spark, "/root/testdata/sf0.001")
    some, every = hetero.typed_edges(tx, hetero.TO_REGIONS), hetero.typed_edges(tx)
    want = every.where(F.col("edge_type").isin("trans_at", "quxian_at"))
    assert some.exceptAll(want).isEmpty() and want.exceptAll(some).isEmpty() and some.count() > 0


def test_transit_goes_by_the_rounded_ratio(spark, tmp_path):
    """A net of 0.0099996 of all is 0.01 as the ratio is kept, so not below it."""
    import duckdb

    from ledgerlens import registry

    registry.load()
    c = duckdb.connect()
    at = "TIMESTAMP '1995-01-01'"
    for name, rows in {
        "customer": "SELECT * FROM (VALUES (0::BIGINT, 0), (1, 0)) t(c_custkey, c_nationkey)",
        "orders": "SELECT * FROM (VALUES (5::BIGINT, 0::BIGINT), (11, 1)) t(o_orderkey, o_custkey)",
        "lineitem": f"SELECT *, 0.0::DOUBLE AS l_tax, 'A' AS l_returnflag, {at} AS l_shipdate FROM (VALUES (5::BIGINT, 1, 1::BIGINT, 0::BIGINT, 50499.98::DOUBLE), (11, 1, 0, 0, 49500.02)) t(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)",
    }.items():
        c.sql(f"COPY ({rows}) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
        c.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    want = sorted(c.sql(registry.ORACLE["transit_vertices"]).fetchall())
    assert want == [(0, 0), (1, 0)]
    assert sorted(map(tuple, registry.QUERIES["transit_vertices"](spark, str(tmp_path)).collect())) == want


def _plain_scores(rows, weights):
    ranks = {n: {v: i + 1 for i, v in enumerate(sorted({r[n] or 0.0 for r in rows}))} for n in weights}
    return {r["card"]: sum(w * ranks[n][r[n] or 0.0] for n, w in weights.items()) for r in rows}


def test_rank_sum_rows_are_what_is_not_zero(spark, monkeypatch):
    """Negative values, nulls, features that are never or always zero; zeros are no rows."""
    made = [{"card": i, "a": float(i % 5 - 2), "b": None if i % 3 else float(i), "c": 0.0, "d": float(i % 4 + 1), "e": -1.0 if i % 7 else None, "f": -float(i % 2) - 1} for i in range(40)]
    made.append({"card": 99, "a": 0.0, "b": None, "c": None, "d": 1.0, "e": 0.0, "f": -1.0})
    seen = []
    monkeypatch.setattr(features, "join_counted", lambda left, *a, **b: (seen.append(left.count()), R.join_counted(left, *a, **b))[1])
    got = rank_sum_score(spark.createDataFrame(made, "card long, a double, b double, c double, d double, e double, f double"), ["a", "b"], ["c", "d", "a"], ["e", "f"])
    assert {r.card: r.score for r in got.collect()} == _plain_scores(made, {"a": 1.5, "b": 1.0, "c": 0.5, "d": 0.5, "e": 0.25, "f": 0.25})
    assert seen == [len(made) + sum(1 for r in made for n in "abcdef" if r[n])]


def test_modes_of_single_transfers_need_no_buffers(spark, monkeypatch):
    """Pairs with one transfer are taken as they are, nulls included; modes and sets are made of the others only."""
    at = {c: None for c in features.TRANSFER} | {"money": 7, "charge": 0.5, "loc_trans_tm": "020000", "trans_md": "2"}
    kinds = ", ".join(f"{c} {'long' if c in ('srccard', 'dstcard', 'money') else 'double' if c == 'charge' else 'string'}" for c in at)
    made = [at | {"srccard": i, "dstcard": i + 1, "card_class": "01", "mchnt_cd": "m"} for i in range(20)]
    made += [at | {"srccard": 1, "dstcard": 2, "card_class": c, "mchnt_cd": c, "trans_md": None} for c in ("02", "02", "01", None)]
    seen = []
    monkeypatch.setattr(features, "join_counted", lambda left, right, *a, **b: (seen.append(right.count()), R.join_counted(left, right, *a, **b))[1])
    tx = spark.createDataFrame([tuple(r.values()) for r in made], kinds)
    got = {(r.src, r.dst): r for r in features.merge_transfers(tx).collect()}
    assert seen == [1] and set(got) == {(i, i + 1) for i in range(20)}
    many, one = got[1, 2], got[3, 4]
    assert (many.money, many.cnt, many.charge4, many.night, many.other_city, many.mode_card_class, many.n_mchnt_cd, many.mode_resp_cd4, many.n_term_id) == (35, 5, 25000, 5, 1, "01", 3, None, 0)
    assert (one.money, one.cnt, one.charge4, one.night, one.other_city, one.mode_card_class, one.n_mchnt_cd, one.mode_resp_cd4, one.n_term_id) == (7, 1, 5000, 1, 1, "01", 1, None, 0)
    sums = {(r.src, r.dst): r.asDict() for r in features.merge_sums(tx).collect()}
    assert sums == {k: {c: r[c] for c in ("src", "dst", "money", "cnt", "charge4", "night", "other_city")} for k, r in got.items()}
