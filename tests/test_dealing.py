"""Hot keys cut by time, partitions pruned and replaced, states merged, communities read apart."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators import communities, gaps, profiles, states
from ledgerlens.plans import scratch
from ledgerlens.sources import tables


@pytest.fixture(scope="module")
def hot(spark):
    """One terminal with 90 % of the rows, one with a null name, with ties in time, and rows alike."""
    rnd = random.Random(2)
    rows = [(rnd.choice(["a"] * 18 + ["b", None]), rnd.choice([None, *range(3000)]), i % 40, rnd.randrange(9)) for i in range(6000)]
    rows += rows[:50]
    return spark.createDataFrame(rows, "atm string, at long, tid long, money long")


@pytest.mark.parametrize("descending", [True, False])
def test_gaps_of_a_hot_key(spark, hot, descending, monkeypatch):
    ask = lambda: gaps.gaps(hot, "atm", F.col("at"), "tid", "money", descending=descending, carry=("money",))
    want = sorted(ask().collect(), key=repr)
    monkeypatch.setattr(gaps, "HOT_ROWS", 100)
    dealt, keep = {}, scratch.keep
    monkeypatch.setattr(scratch, "keep", lambda df, name="cut": dealt.setdefault(name, keep(df, name)))
    with scratch.settings(spark, {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        assert sorted(ask().collect(), key=repr) == want
        parts = [r["count"] for r in dealt["marked"].where("atm = 'a'").groupBy("__part").count().collect()]
    assert sum(parts) > 5000 and max(parts) < 2000


DAYS = T.StructType([T.StructField("card", T.LongType()), T.StructField("day", T.DateType())])


def test_one_day_replaced_others_stay(spark):
    name, path = "days_of_cards", scratch.new_path(spark, "days")
    rows = spark.range(60).select("id", F.expr("date'2020-01-01' + cast(id % 6 as int)").alias("day")).withColumnRenamed("id", "card")
    tables.create_partitioned(spark, name, DAYS, ["day"], path)
    try:
        tables.write_partitions(rows, name, ["day"])
        tables.write_partitions(rows.where("day = '2020-01-03'").limit(1).withColumn("card", F.lit(-1).cast("long")), name, ["day"])
        got = {(r.card, str(r.day)) for r in spark.table(name).collect()}
        assert got == {(r.card, str(r.day)) for r in rows.where("day <> '2020-01-03'").collect()} | {(-1, "2020-01-03")}
        ranged = spark.table(name).where("day between '2020-01-02' and '2020-01-04'")
        assert "PartitionFilters: [isnotnull(day" in ranged._jdf.queryExecution().toString()
        assert len(ranged.inputFiles()) < len(spark.table(name).inputFiles())
        tables.drop_partition(spark, name, day="2020-01-02")
        assert spark.table(name).where("day = '2020-01-02'").count() == 0 and spark.table(name).count() == 41
        tables.truncate(spark, name)
        assert spark.table(name).count() == 0
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_merged_states_are_those_of_one_pass(spark):
    rnd = random.Random(4)
    rows = [(rnd.randrange(5), rnd.randrange(9), rnd.choice([1, 5, 10**9, -3]), rnd.choice([None, *range(-1, 131)]), rnd.choice("124")) for _ in range(900)]
    rows.append((7, 1, 4, None, "1"))
    t = spark.createDataFrame(rows, "card long, day int, money long, region int, trans_md string")
    day = states.day_states(t, ["card", "day"], F.col("region"), 130)
    assert len([c for c in day.columns if c.startswith("places")]) == 3
    weeks = states.merge(day.withColumn("week", F.floor(F.col("day") / 4)), "card", "week")
    for merged in (states.merge(day, "card"), states.merge(weeks, "card")):
        got = {r.card: r.asDict() for r in states.profile_of(merged, "card").collect()}
        known = F.when(F.col("region").between(0, 129), F.col("region"))
        want = {r.card: r.asDict() for r in profiles.profile(t.withColumn("region", known), ["card"], place="region").collect()}
        assert got.keys() == want.keys()
        for k in want:
            assert got[k] == pytest.approx(want[k], rel=1e-9)
    assert states.merge(day.limit(0), "card").count() == 0


def test_folders_of_other_communities_are_not_read(spark):
    pairs = [(10 * c + i, 10 * c + i + 1, c) for c in range(200) for i in range(3)]
    e = spark.createDataFrame(pairs, "src long, dst long, money long")
    members = spark.createDataFrame([(10 * c + i, 10 * c) for c in range(200) for i in range(4)], "vid long, cc long")
    path = scratch.new_path(spark, "communities")
    communities.store(e, members, path)
    known = scratch.keep(members.groupBy("cc").agg(F.count("*").alias("size")), "known")
    got = communities.edges_of(spark, path, known.where("cc in (50, 70)"))
    assert sorted(r.money for r in got.collect()) == [5, 5, 5, 7, 7, 7]
    plan = got._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan.lower()
    read = []
    todo = [got._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        while (kind := node.getClass().getSimpleName()) == "AdaptiveSparkPlanExec" or kind.endswith("QueryStageExec"):
            node = node.executedPlan() if kind == "AdaptiveSparkPlanExec" else node.plan()
        if node.getClass().getSimpleName() == "FileSourceScanExec" and node.metrics().contains("numPartitions"):
            read.append(node.metrics().apply("numPartitions").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert read and max(read) <= 2
