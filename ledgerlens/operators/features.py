"""Feature vectors of cards and communities, and the rank-sum score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as X
from ledgerlens.operators import flow, graph
from ledgerlens.operators.components import connected_components
from ledgerlens.operators.relational import join_counted, with_index
from ledgerlens.plans import scratch
from ledgerlens.sources import schema as S

#: Place codes that count as high-risk; a parameter of card_features.
HIGH_RISK = ("1003", "1007", "1019")


def card_features(tx: DataFrame, high_risk: tuple[str, ...] = HIGH_RISK, compat: bool = False) -> DataFrame:
    """One row per card. Sums, counts and extremes are one aggregation; distinct counts another, over the cards' distinct
    values alone, so that no sum is carried once for each of them.

    What both read of ``tx``, flags in a byte each, is written once, a card's rows together unless they are very many: so ``tx`` is
    made once, and nearly all is summed where it lies.

    With ``compat`` *_max columns hold the mean and distinct_cards_out counts senders' partners on transfers in,
    as the older service computed them.
    """
    flags = {
        "night_cnt": X.is_night(F.col("loc_trans_tm")),
        "tot_cardholder_fails": X.in_list(F.col("resp_cd4"), S.HOLDER_FAILURES),
        "tot_abnorm_rate": X.differs(F.col("trans_curr_cd"), S.DOMESTIC),
        "tot_foreign": X.differs(F.col("trans_md"), S.SAME_CITY),
    }
    partners = {
        "distinct_cards_in": F.when(F.col("trans_id") == S.TRANSFER_IN, F.col("srccard")),
        "distinct_cards_out": F.when(F.col("trans_id") == (S.TRANSFER_IN if compat else S.TRANSFER_OUT), F.col("dstcard")),
    }
    rows = tx.select("card", "money", "region_cd", "term_id", "trans_id", *[c.cast("byte").alias(k) for k, c in flags.items()], *[c.alias(k) for k, c in partners.items()])
    tx = scratch.keep(rows.hint("rebalance", F.col("card")), "by_card")
    money = F.col("money")
    yuan = X.rmb(money)
    flag = lambda k: F.sum(F.col(k).cast("double"))
    aggs: dict[str, Column] = {
        "night_cnt": flag("night_cnt"),
        "tot_big500": F.sum(X.multiple_of(yuan, 500)),
        "tot_big1000": F.sum(X.multiple_of(yuan, 1000)),
        "tot_large_integer": F.sum(X.is_large_integer(yuan)),
        "tot_hrloc_trans": F.sum(X.in_list(F.col("region_cd"), high_risk)),
        "tot_cardholder_fails": flag("tot_cardholder_fails"),
        "tot_abnorm_rate": flag("tot_abnorm_rate"),
        "tot_count_89": F.sum(X.count_89(money)),
        "tot_foreign": flag("tot_foreign"),
        "tot_counts": F.count("*"),
        "tot_amounts": F.sum(yuan),
    }
    for name, code in S.TYPED.items():
        own = F.when(F.col("trans_id") == code, yuan)
        aggs |= {f"{name}_counts": F.count(own), f"{name}_amounts": F.sum(own), f"{name}_avg": F.round(F.avg(own), 4), f"{name}_max": F.round(F.avg(own), 4) if compat else F.max(own)}
    sets = {
        "tot_regions": F.col("region_cd"),
        "tot_term_ids": F.col("term_id"),
        "tot_provs": F.left("region_cd", F.lit(2)),
        **{k: F.col(k) for k in partners},
    }
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("kind"), c.cast("string").alias("value")) for i, c in enumerate(sets.values())]))
    own = tx.select("card", pairs.alias("p")).select("card", "p.kind", "p.value").where("value is not null").distinct()
    distinct = own.groupBy("card").agg(*[F.count_if(F.col("kind") == i).alias(k) for i, k in enumerate(sets)])
    # every card with a transaction is in the first; a card without any distinct value would miss in the second
    out = tx.groupBy("card").agg(*[c.alias(k) for k, c in aggs.items()]).join(distinct, "card", "left")
    return out.select("card", *aggs, *[F.coalesce(k, F.lit(0)).alias(k) for k in sets])


#: Attributes of transfers whose most frequent value, and whose number of distinct values, a merged edge keeps.
MODES = ("card_class", "mchnt_tp", "trans_chnl", "acpt_ins_tp", "resp_cd4")
COUNTED = ("acpt_bank", "mchnt_cd", "term_id", "fwd_ins_id_cd", "rcv_ins_id_cd")


#: What merged edges and communities read of a transfer.
TRANSFER = ("srccard", "dstcard", "money", "charge", "loc_trans_tm", "trans_md", "region_cd", "address", *MODES, *COUNTED)


def _of_transfer() -> dict[str, Column]:
    """What a merged edge sums up, for one transfer. Charges are whole ten-thousandths, whose sum is the same in any order."""
    night = F.left("loc_trans_tm", F.lit(2)).between("01", "05").cast("int")
    return {"money": F.col("money"), "cnt": F.lit(1).cast("long"), "charge4": F.round(F.col("charge") * 10000).cast("long"), "night": night, "other_city": F.coalesce(F.col("trans_md") == "2", F.lit(False)).cast("int")}


def merge_sums(tx: DataFrame) -> DataFrame:
    """One edge for each (srccard, dstcard): sums only."""
    return tx.groupBy(F.col("srccard").alias("src"), F.col("dstcard").alias("dst")).agg(*[F.sum(c).alias(k) for k, c in _of_transfer().items()])


def merge_transfers(tx: DataFrame) -> DataFrame:
    """As `merge_sums`, with the mode of each of MODES (the least of equals) and distinct counts of COUNTED.

    Pairs with one transfer are taken as they are: buffers of modes and sets take many times as long as the rows themselves. For the others
    these are merged on the map side and hold at most as many values as a code has; pairs of very many transfers come to them by broadcast.
    """
    tx = tx if hasattr(tx, "_scratch_path") else scratch.keep(tx.select(*TRANSFER), "transfers")
    pair = ["srccard", "dstcard"]
    several = scratch.keep(tx.groupBy(*pair).agg(F.count("*").alias("__n")).where("__n > 1"), "several")
    there = [F.col("srccard").alias("src"), F.col("dstcard").alias("dst")]
    sums = {k: c.cast("long") for k, c in _of_transfer().items()}
    one = tx.join(several.select(*pair), pair, "left_anti")
    one = one.select(*there, *[c.alias(k) for k, c in sums.items()], *[F.col(c).alias(f"mode_{c}") for c in MODES], *[F.col(c).isNotNull().cast("long").alias(f"n_{c}") for c in COUNTED])
    more = join_counted(tx, several, pair, "__n").groupBy(*there)
    more = more.agg(*[F.sum(c).alias(k) for k, c in sums.items()], *[F.mode(c, True).alias(f"mode_{c}") for c in MODES], *[F.size(F.collect_set(c)).cast("long").alias(f"n_{c}") for c in COUNTED])
    return one.unionByName(more)


def community_vertices(edges: DataFrame, kmax: int | None = 6) -> DataFrame:
    """(vid, cc, core, degrees, transit) of the merged edge graph without lone pairs."""
    kept = scratch.keep(graph.without_lone_pairs(edges.where("src <> dst")), "kept")
    cc = connected_components(kept)
    money = flow.in_out(kept).select("vid", flow.transit(F.col("amt_in"), F.col("amt_out")).alias("transit"))
    return scratch.keep(cc.join(graph.k_core_labels(kept, kmax), "vid").join(graph.degrees(kept), "vid").join(money, "vid"), "community")


#: Attributes whose distinct values are counted over all transfers of a community.
COMMUNITY_SETS = {"regions": "region_cd", "mchnt_tps": "mchnt_tp", "merchants": "mchnt_cd", "addresses": "address"}


def community_distinct(tx: DataFrame, members: DataFrame, sets: dict[str, str] | None = None) -> DataFrame:
    """(cc, ...): distinct values over the transfers whose sender is in the community."""
    sets = sets or COMMUNITY_SETS
    inside = tx.select(F.col("srccard").alias("vid"), *sets.values()).join(members.select("vid", "cc"), "vid")
    return inside.groupBy("cc").agg(*[F.count_distinct(c).alias(k) for k, c in sets.items()])


def community_features(edges: DataFrame, members: DataFrame, tx: DataFrame) -> DataFrame:
    """One row per community, 23 columns: aggregates of its vertices, of its inner edges (`merge_transfers`) and of its transfers ``tx``."""
    v = members.groupBy("cc").agg(F.count("*").alias("cc_num"), F.max("core").alias("max_core"), F.max("in_degree").alias("max_in"), F.max("out_degree").alias("max_out"), F.max("degree").alias("max_degree"), F.count_if(F.col("core") > 4).alias("big_core_num"), F.sum("transit").alias("transit_num"))
    inside = edges.where("src <> dst").join(members.select(F.col("vid").alias("src"), "cc"), "src")
    # sets of codes, at most as large as the code lists
    modes = [F.size(F.collect_set(f"mode_{c}")).cast("long").alias(f"{k}_modes") for c, k in zip(MODES, ("class", "mchnt_tp", "channel", "ins_tp", "resp"))]
    most = [F.max(f"n_{c}").alias(f"max_{k}") for c, k in zip(COUNTED, ("banks", "merchants", "terminals", "fwd", "rcv"))]
    e = inside.groupBy("cc").agg(F.sum("cnt").alias("trans_num"), F.sum("money").alias("money"), (F.sum("charge4") / 10000).alias("charge"), F.sum("night").alias("night"), F.sum("other_city").alias("other_city"), *modes, *most)
    return v.join(e, "cc").join(community_distinct(tx, members), "cc")


#: Features of full, half and quarter weight in the score; one named twice counts twice.
FULL = ["tot_counts", "tot_amounts", "tot_regions", "night_cnt", "tot_large_integer", "tot_big1000", "tot_cardholder_fails", "tot_count_89", "tot_term_ids", "cc_num", "max_core", "max_degree", "transit_num", "trans_num"]
HALF = ["tot_provs", "tot_big500", "tot_hrloc_trans", "tot_abnorm_rate", "tot_count_89", "tot_foreign", *[f"{t}_{w}" for t in S.TYPED for w in ("counts", "amounts", "avg", "max")], "distinct_cards_in", "distinct_cards_out"]
QUARTER = ["max_in", "max_out", "big_core_num", "money", "charge", "night", "other_city", "mchnt_tp_modes", "channel_modes", "max_banks", "max_merchants", "mchnt_tps", "merchants", "addresses"]


def rank_sum_score(features: DataFrame, full: list[str] = FULL, half: list[str] = HALF, quarter: list[str] = QUARTER) -> DataFrame:
    """(card, score): the sum of every feature's ascending dense rank, weighted 1, 1/2 or 1/4; missing features are skipped, nulls are 0.

    Only what is not zero is made a row (card, feature, value): a card starts with the ranks that its features have at zero, and each
    other value adds how far its rank is from there. Each feature's distinct values are ranked apart, all features in one table, so no
    window runs over all cards in one task. Only the wide table is kept; its rows by feature are made anew where they are read.
    """
    features = scratch.keep(features, "score")
    weight: dict[str, float] = {}
    for names, w in ((full, 1.0), (half, 0.5), (quarter, 0.25)):
        for n in names:
            if n in features.columns:
                weight[n] = weight.get(n, 0.0) + w
    # features by their place, and last a one for the card itself: an array of numbers, as structs with names take several times as long
    values = F.array(*[F.coalesce(F.col(n).cast("double"), F.lit(0.0)) for n in weight], F.lit(1.0))
    rows = features.select("card", F.posexplode(values).alias("feature", "value")).where("value <> 0")
    counts = rows.groupBy("feature", "value").agg(F.count("*").alias("cards"))
    ordered = scratch.keep(with_index(counts, "feature", "value", name="n").select("feature", "value", "n", "cards"), "ranks")
    known = {r.feature: r for r in ordered.groupBy("feature").agg((F.min("n") - 1).alias("base"), F.sum("cards").alias("cards"), F.count_if(F.col("value") < 0).alias("below")).collect()}  # one row a feature
    own = len(weight)
    cards = known[own].cards if known else 0
    gain, start = F.lit(None), 0.0
    for i, w in enumerate(weight.values()):
        r = known.get(i)
        zero = r is None or r.cards < cards
        start += w * ((r.below if r else 0) + 1) if zero else 0.0
        if r:
            before = F.lit(r.base) + (F.when(F.col("value") < 0, r.below + 1).otherwise(r.below) if zero else 0)
            gain = F.when(F.col("feature") == i, (F.col("n") - before) * F.lit(w)).otherwise(gain)
    ranks = ordered.select("feature", "value", "cards", F.when(F.col("feature") == own, F.lit(start)).otherwise(gain).alias("gain"))
    # what very many cards have is joined by broadcast
    return join_counted(rows, ranks, ["feature", "value"], "cards").groupBy("card").agg(F.sum("gain").alias("score"))


def attach_originals(scores: DataFrame, cards: DataFrame, key: str = "card") -> DataFrame:
    """Scores under the original card names, every listed card kept, best first."""
    return scores.join(cards, key, "right").orderBy(F.desc_nulls_last("score"), key)
