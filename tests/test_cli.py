"""The command line on a file of cards."""

import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerlens import cli
from ledgerlens.operators import features
from ledgerlens.plans import catalogue_service, scratch
from ledgerlens.sources.transactions import transactions

D = "/root/testdata/sf0.001"


def test_scores_of_listed_cards(spark, tmp_path):
    """Numbers, 32 hexadecimal digits and unknown cards; with enough hops the scores are those over all cards that can be reached."""
    seen = [r.card for r in transactions(spark, D).select("card").distinct().orderBy("card").limit(3).collect()]
    lines = [f"a,{seen[0]}", f"b,{hashlib.md5(str(seen[1]).encode()).hexdigest()}", f"c,{hashlib.md5(b'nobody').hexdigest()}", "broken line", "d,"]
    (tmp_path / "cards.csv").write_text("\n".join(lines))
    cli.score(spark, f"file://{tmp_path}/cards.csv", D, f"file://{tmp_path}/out", hops=30)
    got = dict(line.split(",") for p in (tmp_path / "out").glob("part-*") for line in p.read_text().splitlines())
    assert set(got) == {"a", "b", "c"} and got["c"] == "null"
    tx = transactions(spark, D)
    members, community = catalogue_service._communities(tx)
    c = members.select(F.col("vid").alias("card"), "cc").join(community, "cc").drop("cc")
    want = {r.card: r.score for r in features.rank_sum_score(features.card_features(tx).join(c, "card", "left")).collect()}
    assert float(got["a"]) == want[seen[0]] and float(got["b"]) == want[seen[1]]


def test_transactions_are_made_once(spark, tmp_path, monkeypatch):
    """What is listed, near and scored is read from one written table, not made out of the source tables again."""

    class Seen(Exception):
        pass

    def expand(edges, seeds, hops):
        raise Seen(scratch.roots_of(edges) | scratch.roots_of(seeds))

    monkeypatch.setattr(cli.graph, "expand", expand)
    (tmp_path / "cards.csv").write_text("a,1\n")
    with pytest.raises(Seen) as seen, scratch.scope():
        cli.score(spark, f"file://{tmp_path}/cards.csv", D, f"file://{tmp_path}/out")
    assert not any(part.endswith(".parquet") for part in seen.value.args[0])
