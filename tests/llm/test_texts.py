"""op2, op3, op6, op9 and op10: classifiers, decontamination, personal data and quality."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import decontaminate, langid, pii, quality_mil, quality_rules, toxicity

D = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{D}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{D}/labels.parquet")


ODD = [(1, None, None, "gram"), (2, "", "en", "n"), (None, "12 345 !!", "en", "x"), (None, "Ça va", None, "x"), (1, None, None, "gram")]
ODD_SCHEMA = "doc_id long, text string, lang string, gram string"


def test_language_held_out(spark, documents):
    got = {r.doc_id: r for r in langid.identify(documents).collect()}
    true = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    held = [d for d in true if got[d].held_out]
    assert len(got) == len(true) and 100 < len(held) < 300
    assert sum(got[d].lang_pred == true[d] for d in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_odd_rows(spark):
    got = langid.identify(spark.createDataFrame(ODD, ODD_SCHEMA)).collect()
    assert len(got) == 5 and {r.lang_pred for r in got} == {"und"}
    assert langid.identify(spark.createDataFrame([], ODD_SCHEMA)).count() == 0


def test_filters_hold_what_they_learn():
    rng = np.random.default_rng(0)
    hs = [rng.integers(0, 2**64, 2000, dtype=np.uint64) for _ in range(11)]
    f = langid.Filters([f"l{i:02d}" for i in range(11)], hs)
    for k, h in enumerate(hs):
        hits = f.hits(h)
        assert hits[k] == 2000 and hits.sum() < 2000 + 200


def test_language_by_exact_sets(spark, documents, monkeypatch):
    """The filters' verdicts are those of exact sets of the same grams."""
    seen = {}

    class Exact(langid.Filters):
        def __init__(self, languages, hashes, **kw):
            super().__init__(languages, hashes, **kw)
            seen.update(zip(languages, ({int(x) for x in h} for h in hashes)))

    monkeypatch.setattr(langid, "Filters", Exact)
    filters = langid.fit(documents, 60)
    some = documents.where("doc_id < 250")
    got = {r.doc_id: r for r in langid.predict(some, filters).collect()}
    names = sorted(seen)
    for r in some.collect():
        grams = [int(x) for h in langid.grams(r.text) for x in h]
        hits = [sum(g in seen[x] for g in grams) + 0.5 for x in names]
        best, p = max(zip(hits, names)), got[r.doc_id]
        if not grams:
            assert (p.lang_pred, p.score) == ("und", 0.0)
        elif sorted(hits)[-1] - sorted(hits)[-2] > 0.01 * len(grams) + 2:
            assert p.lang_pred == best[1] and p.score == pytest.approx(best[0] / sum(hits), abs=0.02)


def test_language_of_long_text():
    f = langid.Filters(["a"], [next(langid.grams("hello world"))])
    n = sum(len(h) for h in langid.grams("abc " * 600_000))
    assert n == sum(2_400_000 + 3 - k for k in langid.SIZES)
    assert f.predict("hello world")[0] == "a"


def test_decontamination(spark):
    rnd = random.Random(2)
    vocab = [f"v{i}" for i in range(5000)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(n))) for i, n in enumerate([30, 13, 7, 3])] + [(9, None), (None, "x y z x y z")]
    t = items[0][1].split()
    swapped = list(t)
    swapped[4] = swapped[11] = swapped[20] = "other"
    filler = " ".join(rnd.choice(vocab) for _ in range(200))
    rows = [(1, filler + " " + items[0][1]), (2, filler), (3, " ".join(swapped).upper() + "."), (4, filler + ", " + items[2][1] + " " + filler), (5, " ".join(t[:6])), (6, None), (7, ""), (8, items[3][1]), (None, items[1][1]), (1, filler + " " + items[0][1])]
    b = spark.createDataFrame(items, "item_id long, text string")
    d = spark.createDataFrame([(i, t, "q") for i, t in rows], "doc_id long, text string, item_id string")
    want = [(1, 0), (1, 0), (3, 0), (4, 2), (None, 1)]
    for chars in (10**6, 40):
        got = decontaminate.find(d, b, chars)
        assert sorted(((r.doc_id, r.item_id) for r in got.collect()), key=str) == sorted(want, key=str)
        assert sorted(r.doc_id for r in decontaminate.clean(d, b, chars).collect()) == [2, 5, 6, 7, 8]
    assert decontaminate.find(d, b.limit(0)).count() == 0 and decontaminate.clean(d, b.limit(0)).count() == len(rows)


def test_masks_meet_all_pairs_of_substitutions():
    import itertools

    for e in itertools.combinations(range(13), 2):
        assert any(all(x - p not in m for x in e) for m in decontaminate.MASKS for p in range(13 - decontaminate.SPAN + 1))


def test_short_items_meet_every_allowed_substitution():
    import itertools

    for n in range(1, 13):
        item = [f"w{i}" for i in range(n)]
        index = decontaminate.Index([(1, " ".join(item))], least=1)
        k = n - math.ceil(0.8 * n)
        for gone in itertools.combinations(range(n), k):
            text = " ".join(["a", "b", *["x" if i in gone else w for i, w in enumerate(item)], "c"])
            assert index.overlaps(text) == [(1, 2, 2 + n, n - k)], (n, gone)
        for gone in itertools.combinations(range(n), k + 1):
            assert not index.overlaps(" ".join("x" if i in gone else w for i, w in enumerate(item)))


def test_overlaps_by_brute_force():
    """Items of any length with random substitutions in random places: found exactly if some window agrees in four fifths."""
    rnd = random.Random(21)
    found = 0
    for _ in range(1500):
        n = rnd.choice([1, 3, 5, 7, 9, 10, 11, 12, 13, 14, 20, 45])
        item = [f"w{rnd.randrange(12 if rnd.random() < 0.2 else 900)}" for _ in range(n)]
        put = [f"z{rnd.randrange(900)}" if rnd.random() < rnd.choice([0, 0.1, 0.2, 0.3]) else w for w in item]
        text = [f"f{rnd.randrange(900)}" for _ in range(rnd.randint(0, 8))] + put[rnd.choice([0, 0, n // 3]) :] + [f"f{rnd.randrange(900)}" for _ in range(rnd.randint(0, 8))]
        w = min(13, n)
        want = 0
        for shift in range(-n + w, len(text) - w + 1):
            same = [0 <= i - shift < n and text[i] == item[i - shift] for i in range(len(text))]
            if any(sum(same[i : i + w]) >= 0.8 * w for i in range(max(0, shift), min(len(text), shift + n) - w + 1)):
                want = 1
        got = decontaminate.Index([(4, " ".join(item))], least=1).overlaps(" ".join(text))
        assert len(got) == want, (item, text)
        found += want
    assert 400 < found < 1400


def test_overlaps_of_repetitive_texts():
    index = decontaminate.Index([(1, "a " * 300), (2, "a b " * 100)], least=1)
    got = index.overlaps("a " * 20_000 + "c " * 50_000)
    assert [o[0] for o in got] == [1] and got[0][3] == 300


def test_short_items_only_if_asked():
    assert decontaminate.Index([(1, "x y z")]).overlaps("x y z") == []
    assert decontaminate.Index([(1, "x y z"), (2, "..."), (3, "q")], least=1).overlaps("w x y z") == [(1, 1, 4, 3)]


def test_unspaced_scripts_by_character():
    index = decontaminate.Index([(1, "水は百度で沸騰し零度で凍ります"), (2, "ภาษาไทยไม่มีช่องว่าง")])
    assert [o[0] for o in index.overlaps("昨日、水は百度で沸騰し一度で凍りますと書いた abc")] == [1]
    assert [o[0] for o in index.overlaps("กกภาษาไทยไม่มีช่องว่างขข")] == [2]
    assert len(decontaminate.tokens("été naïve 한국어 text_1")) == 4


def plain(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out, key=lambda x: (x[1], pii.KINDS.index(x[0])))


def test_plain_spans_by_definition():
    rnd = random.Random(4)
    for k in range(20000):
        alphabet = ["a@.b-1é", "0123456789. -", "+1 2().-34567890", "ab@@..--%_ \n"][k % 4]
        t = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40)))
        base, full = pii.all_spans(t)
        assert base == plain(t), repr(t)
        assert set(base) <= set(full)


@pytest.mark.parametrize(
    "text,kind,piece",
    [
        ("mail jane.doe (at) example [dot] org now", "email", "jane.doe (at) example [dot] org"),
        ("write bob at example dot com please", "email", "bob at example dot com"),
        ("jаne@example.com", "email", "jаne@example.com"),
        ("call plus four four two zero seven nine four six zero nine five eight ok", "phone", "plus four four two zero seven nine four six zero nine five eight"),
        ("host one nine two dot one six eight dot zero dot one.", "ip", "one nine two dot one six eight dot zero dot one"),
        ("card ４１１１１１１１１１１１１１１１ x", "card", "４１１１１１１１１１１１１１１１"),
        ("card 4111 1111 1111 one one 11 x", "card", "4111 1111 1111 one one 11"),
        ("mail jane at corp dot app or call", "email", "jane at corp dot app"),
        ("mail jane.doe at corp.com or call", "email", "jane.doe at corp.com"),
        ("bob at mail dot corp dot co dot uk then", "email", "bob at mail dot corp dot co dot uk"),
        ("net 10 dot 0 dot 0 dot 1 up", "ip", "10 dot 0 dot 0 dot 1"),
    ],
)
def test_disguises(text, kind, piece):
    _, full = pii.all_spans("é " + text)
    assert (kind, text.index(piece) + 2, text.index(piece) + 2 + len(piece)) in full


def test_no_false_disguises():
    for t in ("look at the dot on the page", "one two three", "at dot at", "meet at noon. dot the i", "look at example.com now", "meet at noon dot the i", "dot dot dot", "plus one", "one at a time dot"):
        assert pii.all_spans(t) == ([], [])


@pytest.mark.parametrize("piece", ["x dot ", "a at b dot com ", "one dot ", "plus one two ", "( at ) ", "      ", " (", "at ", "1 dot ", "j\u0430ne@example.com one two three ", "x dot com dot ", "4111 one-", "+1 ", "a@"])
def test_long_disguised_texts_take_linear_time(piece):
    """Four times the text, about four times as long."""
    import time

    pii.all_spans(piece * 1000)
    took = []
    for n in (60_000, 240_000):
        text = piece * (n // len(piece))
        start = time.process_time()
        pii.all_spans(text)
        took.append(time.process_time() - start)
    assert took[1] < 8 * took[0] + 0.2, took


def test_spans_map_back_to_the_source():
    """What a disguised span covers is what was put there, wherever it stands."""
    rnd = random.Random(12)
    made = [("email", "ann.lee (at) mail [dot] example {dot} org"), ("email", "bob at example dot com"), ("phone", "plus four nine three zero one two three four five six seven"), ("card", "4111-1111-1111-one one 11"), ("ip", "one nine two dot one six eight dot zero dot one"), ("email", "\u0430nn@example.org")]
    fill = ["plain", "words", "é", "\u200b", "中", "-", ",", "\n", "the", "is", "2 3"]
    for _ in range(300):
        text, want = "", set()
        for _ in range(rnd.randint(1, 6)):
            text += " ".join(rnd.choice(fill) for _ in range(rnd.randint(1, 8))) + " ; "
            kind, piece = rnd.choice(made)
            want.add((kind, len(text), len(text) + len(piece)))
            text += piece + " ; "
        base, full = pii.all_spans(text)
        assert want <= set(full) and set(base) <= set(full), (text, want - set(full))


def test_pii_rows(spark):
    rows = [(1, "a@b.co 1.2.3.4"), (None, None), (2, ""), (1, "a@b.co 1.2.3.4")]
    got = pii.digest(spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, spans string")).collect()
    import hashlib

    first = [r for r in got if r.doc_id == 1]
    assert len(got) == 4 and len(first) == 2 and (first[0].n_email, first[0].n_ip, first[0].n_card, first[0].n_phone) == (1, 1, 0, 0)
    assert first[0].spans == "email:0:6,ip:7:14" and first[0].base_sha256 == hashlib.sha256(b"email:0:6,ip:7:14").hexdigest()
    assert all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in got if r.doc_id != 1)
    assert pii.all_spans("1" * 200_000 + "." * 5 + "x" * 300_000 + "@") == ([], [])


def measure(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = collections.Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_quality_measures(spark):
    rnd = random.Random(6)
    texts = [None, "", " \n ", "a b\n\na b\n a b", "#" * 50]
    for _ in range(60):
        words = [rnd.choice("ab c é# <d".split(" ")) for _ in range(rnd.randint(1, 60))]
        texts.append("".join(w + rnd.choice([" ", "\n", "  ", "\t", " \n"]) for w in words))
    rows = [(i, t, "z", i) for i, t in enumerate(texts)] + [(None, "x", "z", 0), (None, "x", "z", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string, at long")
    got = quality_rules.judge(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            continue
        want = measure(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, repr(texts[r.doc_id])
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def test_quality_em_document_by_document(spark, documents):
    """EM over pattern counts equals EM that goes over all documents one by one."""
    voted = quality_rules.votes(quality_rules.measures(documents))
    p = quality_rules.fit(voted, rounds=4)
    rows = np.array([[r[f"vote_{k}"] for k in quality_rules.RULES] for r in voted.collect()])
    q, w = {"prior": quality_rules.PRIOR_GOOD}, quality_rules.START_DOCS
    for k in quality_rules.RULES:
        q |= {f"{k}_{v}_{c}": quality_rules.START[c][v] for c in ("good", "bad") for v in (0, 1, 2)}
    for _ in range(4):
        like = {c: np.ones(len(rows)) for c in ("good", "bad")}
        for i, k in enumerate(quality_rules.RULES):
            for c in like:
                table = np.array([1.0] + [q[f"{k}_{v}_{c}"] / (1 - q[f"{k}_0_{c}"]) for v in (1, 2)])
                like[c] *= table[rows[:, i]]
        post = q["prior"] * like["good"] / (q["prior"] * like["good"] + (1 - q["prior"]) * like["bad"])
        new = {"prior": (post.sum() + w * quality_rules.PRIOR_GOOD) / (len(rows) + w)}
        for i, k in enumerate(quality_rules.RULES):
            for v in (0, 1, 2):
                for c, g in (("good", post), ("bad", 1 - post)):
                    new[f"{k}_{v}_{c}"] = (g[rows[:, i] == v].sum() + w * quality_rules.START[c][v]) / (g.sum() + w)
        q = new
    assert p == pytest.approx(q, rel=1e-6)


def test_quality_verdicts_come_from_the_data(spark, documents):
    """Where the rules agree, EM trusts them; where one contradicts the others on many documents, it is not believed."""
    voted = quality_rules.votes(quality_rules.measures(documents))
    p = quality_rules.fit(voted)
    assert max(abs(p[k] - v) for k, v in quality_rules.start_values().items()) > 0.1
    good, n = (2,) * len(quality_rules.RULES), len(quality_rules.RULES)
    odd = (1,) + (2,) * (n - 1)
    both = (1, 1) + (2,) * (n - 2)

    def verdict(patterns, row):
        before, by = quality_rules._weights(quality_rules.em(patterns))
        return before + sum(w[v] for w, v in zip(by, row)) >= 0

    noisy, sound = [(good, 50_000), (odd, 20_000)], [(good, 50_000), (both, 5_000), (odd, 50)]
    assert verdict(noisy, odd) and not verdict(sound, both)
    # the same shares of ten times the documents: the starting values weigh less, not as much
    few, many = quality_rules.em([(v, c // 100) for v, c in sound]), quality_rules.em([(v, c * 10) for v, c in sound])
    start = quality_rules.start_values()
    assert abs(many["symbols_1_good"] - start["symbols_1_good"]) >= abs(few["symbols_1_good"] - start["symbols_1_good"])
    assert quality_rules.em([]) == start


def test_quality_votes_follow_labels(spark, documents, labels):
    kept = {r.doc_id: r.kept for r in quality_rules.judge(documents).collect()}
    y = {r.doc_id: r["quality"] for r in labels.collect()}
    good = [kept[d] for d in y if y[d] == 1]
    bad = [kept[d] for d in y if y[d] == 0]
    assert sum(good) / len(good) > 0.95 and sum(bad) / len(bad) < 0.02
    assert quality_rules.judge(documents.limit(0)).count() == 0


def test_attention_gradients():
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(n, quality_mil.FEATURES)) for n in (1, 3, 2)]
    y, weight = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])
    net = quality_mil.train(bags, y, weight)
    x, first = np.concatenate(bags), np.array([0, 1, 4])

    def loss():
        p = net._forward(x, first)[-1]
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).mean()

    for k, g in net.gradients(x, first, y, weight).items():
        i = tuple(0 for _ in g.shape)
        old, e = net.w[k][i], 1e-5
        net.w[k][i] = old + e
        up = loss()
        net.w[k][i] = old - e
        down = loss()
        net.w[k][i] = old
        assert (up - down) / (2 * e) == pytest.approx(g[i], rel=1e-3, abs=1e-7)


def test_attention_held_out(spark, documents, labels):
    got = {r.doc_id: r for r in quality_mil.judge(documents, labels).collect()}
    y = {r.doc_id: r["quality"] for r in labels.collect() if got[r.doc_id].held_out}
    assert len(got) == documents.count() and all(0 <= r.score <= 1 for r in got.values())
    assert sum(got[d].predicted == v for d, v in y.items()) / len(y) > 0.9
    odd = spark.createDataFrame([(1, None, "q"), (None, "", "q"), (1, None, "q")], "doc_id long, text string, quality string")
    assert quality_mil.judge(odd, labels.limit(0)).count() == 3
    assert quality_mil.judge(odd.limit(0), labels).count() == 0


def test_attention_sees_words(spark):
    """Texts alike in all their measures but for which words they have; and long texts that differ in one place only."""
    rnd = random.Random(3)
    good, bad = ["alpha", "bravo", "civic"], ["delta", "eager", "fancy"]
    text = lambda own, n: " ".join(rnd.choice(own + ["hotel"] * 3) for _ in range(n))
    rows = [(i, text(good if i % 2 else bad, 80)) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id long, quality int")
    got = [r for r in quality_mil.judge(df, marks).collect() if r.held_out]
    assert sum((r.score > 0.5) == r.doc_id % 2 for r in got) / len(got) > 0.95
    a = quality_mil.passages("x " * 64 * 100 + "y")
    assert len(a) == 101 and not (a[99] == a[100]).all()
    p = quality_mil.pooled(a, 7)
    assert len(p) == 7 and p[6] == pytest.approx(a[86:].mean(0)) and p[0] == pytest.approx(a[:14].mean(0))
    assert (quality_mil.pooled(a, 101) == a).all()


def test_attention_by_plain_arithmetic():
    rng = np.random.default_rng(5)
    bags = [rng.normal(size=(n, quality_mil.FEATURES)) for n in (1, 4, 2, 7)]
    net = quality_mil.train(bags, np.array([1.0, 0.0, 1.0, 0.0]), np.ones(4))
    w = {k: v.tolist() for k, v in net.w.items()}
    for bag in bags:
        encoded, logits = [], []
        for row in ((bag - net.mean) / net.scale).tolist():
            h = [math.tanh(sum(x * w["enc"][i][j] for i, x in enumerate(row)) + w["enc0"][j]) for j in range(quality_mil.HIDDEN)]
            gate = [math.tanh(sum(x * w["v"][i][j] for i, x in enumerate(h))) / (1 + math.exp(-sum(x * w["u"][i][j] for i, x in enumerate(h)))) for j in range(quality_mil.GATE)]
            encoded.append(h)
            logits.append(sum(a * b for a, b in zip(w["a"], gate)))
        share = [math.exp(x) / sum(map(math.exp, logits)) for x in logits]
        z = sum(c * sum(a * h[j] for a, h in zip(share, encoded)) for j, c in enumerate(w["c"])) + w["c0"][0]
        assert net.score(bag) == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-9)


def test_attention_of_long_and_repeated_texts(spark, labels):
    long = " ".join(f"w{i % 977}" for i in range(400_000))
    rows = spark.createDataFrame([(i % 7, long if i == 3 else f"short text {i}", "q") for i in range(40)], "doc_id long, text string, quality string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(7)], "doc_id long, quality int")
    got = quality_mil.judge(rows, marks).collect()
    assert len(got) == 40 and all(0 <= r.score <= 1 for r in got)


def test_classes_are_few(spark):
    from ledgerlens.llm import common

    df = spark.range(300).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("lang"))
    with pytest.raises(ValueError):
        common.sample_labelled(df, "lang", 5, "x")


def test_passages_cover_the_text():
    text = " ".join(f"w{i}" for i in range(200))
    b = quality_mil.passages(text)
    assert len(b) == 4 and b[:, quality_mil._CLASSES].tolist() == [1, 1, 1, 8 / 64]
    assert quality_mil.passages(None).shape == (1, quality_mil.FEATURES)


def test_toxicity_held_out(spark, documents, labels):
    """Fitted on four fifths of the labels, judged on the rest; the chain's last link leans on earlier ones."""
    from ledgerlens.llm.common import fold

    big = "/root/testdata/sf0.1"
    documents, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    links = toxicity.fit(documents, labels.where(fold() != 0))
    assert tuple(k.category for k in links) == toxicity.CHAIN
    held = labels.where(fold() == 0)
    got = toxicity.score(documents.join(held.select("doc_id"), "doc_id", "left_semi"), links).join(held, "doc_id").collect()
    right = lambda f: sum(map(f, got)) / len(got)
    assert len(got) > 500 and right(lambda r: r.rejected == r.toxic) > 0.96 > right(lambda r: not r.toxic) + 0.05
    assert right(lambda r: (r.p_low_quality >= 0.5) == (r.quality == 0)) > right(lambda r: r.quality == 1)
    assert sum(1 for k in links if k.words) >= 4 and max(map(abs, links[-1].earlier)) > 0.05
    themed = [r for r in got if r.toxic]
    assert sum(max(r.p_theme_1, r.p_theme_2, r.p_theme_3) for r in themed) / len(themed) > 10 * sum(max(r.p_theme_1, r.p_theme_2, r.p_theme_3) for r in got if not r.toxic) / (len(got) - len(themed))


def test_toxicity_by_plain_arithmetic(spark, documents, labels):
    links = toxicity.fit(documents, labels)
    texts = {r.doc_id: r.text for r in documents.collect()}
    got = toxicity.score(documents, links).collect()
    assert len(got) == len(texts)
    for r in got:
        found, ps = set(re.findall(r"[^\W\d_]+", (texts[r.doc_id] or "").lower())), []
        for k in links:
            z = k.bias + sum(v for w, v in k.words.items() if w in found)
            for a, p in zip(k.earlier, ps):
                p = min(max(p, 1e-4), 1 - 1e-4)
                z += a * math.log(p / (1 - p))
            ps.append(1 / (1 + math.exp(-min(max(z, -30), 30))))
        assert [r[f"p_{c}"] for c in toxicity.CHAIN] == pytest.approx(ps, abs=1e-9) and r.rejected == (ps[-1] >= 0.5)
    kept = toxicity.without_toxic(documents, labels)
    assert kept.columns == documents.columns and {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in got if not r.rejected}


def test_toxicity_fit_does_not_depend_on_partitions(spark, documents, labels):
    a, b = toxicity.fit(documents, labels), toxicity.fit(documents.repartition(5), labels.repartition(3))
    assert [(k.words, k.earlier, k.bias) for k in a] == [(k.words, k.earlier, k.bias) for k in b]


def test_themes():
    rng = np.random.default_rng(3)
    true = np.repeat([0, 1, 2], [60, 40, 20])
    x = np.zeros((120, 30))
    for i, k in enumerate(true):
        x[i, rng.choice(np.arange(10 * k, 10 * k + 10), 4, replace=False)] = 1
    assert (toxicity.themes(x) == true).mean() > 0.95
    assert (toxicity.themes(np.zeros((50, 4))) == -1).all() and (toxicity.themes(np.ones((5, 4))) == -1).all()


def test_toxicity_odd_rows(spark, labels):
    odd = spark.createDataFrame([(1, None, "q"), (None, "", "q"), (1, None, "q")], "doc_id long, text string, rejected string")
    assert [r.rejected for r in toxicity.judge(odd, labels.limit(0)).collect()] == [False] * 3
    assert toxicity.judge(odd.limit(0), labels).count() == 0
    assert toxicity.without_toxic(odd, labels.limit(0)).count() == 3
    again = spark.createDataFrame([(1, "a b " * 200_000, "q")] * 3, "doc_id long, text string, rejected string")
    assert toxicity.judge(again, labels).count() == 3


def _disguised(rnd):
    """(kind, disguised text) of a random identifier, disguised in one to several of the ways that are looked for."""
    alike = {}
    for c, a in pii._LOOKALIKE.items():
        alike.setdefault(a, []).append(c)

    def veil(text, share):
        out = []
        for i, c in enumerate(text):
            if i and rnd.random() < share / 3:
                out.append(rnd.choice(alike[""]))
            wide = [chr(ord(c) + 0xFEE0)] if "!" <= c <= "~" else []
            own = [x for x in alike.get(c, []) if c.isalpha()] + wide
            out.append(rnd.choice(own) if own and rnd.random() < share else c)
        return "".join(out)

    def number(n):
        return "".join(rnd.choice("0123456789") for _ in range(n))

    names = {v: k for k, v in pii._DIGITS.items()}
    case = lambda w: rnd.choice([w, w.upper(), w.title()])

    def tokens(digits):
        """The digits as numbers and spelled digits, at least one of these."""
        while True:
            out, i = [], 0
            while i < len(digits):
                n = rnd.choice([0, 0, 1, 2, 4])
                out.append(digits[i : i + n] if n else case(names[digits[i]]))
                i += n or 1
            if any(t.isalpha() for t in out):
                return out

    kind = rnd.choice(pii.KINDS)
    if kind == "email":
        local = rnd.choice("abcekmop") + "".join(rnd.choice("aceiopxy019._") for _ in range(rnd.randint(1, 6))) + rnd.choice("aceo7")
        labels = ["".join(rnd.choice("aceopxymk7") for _ in range(rnd.randint(2, 6))) for _ in range(rnd.randint(1, 2))] + [rnd.choice(["com", "org", "de", "dev"])]
        way = rnd.randrange(3)
        if way == 0:
            return kind, local + f" {case('at')} " + f" {case('dot')} ".join(labels)
        if way == 1:
            at = rnd.choice(["{}", " {} "]).format(rnd.choice(["({})", "[{}]", "{{ {} }}", "<{}>"]).format(case("at")))
            dots = [rnd.choice([".", " [dot] ", "(DOT)", "。", "․"]) for _ in labels[1:]]
            return kind, local + at + labels[0] + "".join(d + x for d, x in zip(dots, labels[1:]))
        text = veil(local + "@" + ".".join(labels), 0.4)
        return kind, text
    if kind == "card":
        while True:
            digits = number(rnd.choice([12, 13, 15, 16, 19]))
            if pii._luhn(digits):
                break
        return kind, veil(digits, 0.4) if rnd.random() < 0.4 else "".join(t + rnd.choice(" -") for t in tokens(digits))[:-1]
    if kind == "phone":
        digits = number(rnd.randint(9, 15))
        if rnd.random() < 0.3:
            return kind, "+" + veil(digits, 0.4)
        return kind, f"{case('plus')} " + " ".join(tokens(digits))
    parts = [str(rnd.randint(0, 255)) for _ in range(4)]
    way = rnd.randrange(3)
    if way == 0:
        return kind, " dot ".join(parts)
    if way == 1:
        return kind, f" {case('dot')} ".join(" ".join(case(names[c]) for c in p) for p in parts)
    return kind, veil(".".join(parts), 0.4)


def test_disguises_by_brute_force():
    """Identifiers made up, disguised and put anywhere: each is found with exactly the characters that it was put there as."""
    rnd = random.Random(21)
    fill = ["plain", "words", "é", "中", ",", "\n", "the", "is", "(see", "it)", "№"]
    for _ in range(3000):
        text, want = "", []
        for _ in range(rnd.randint(1, 3)):
            text += " ".join(rnd.choice(fill) for _ in range(rnd.randint(1, 6))) + " ; "
            kind, piece = _disguised(rnd)
            want.append((kind, len(text), len(text) + len(piece)))
            text += piece + " ; "
        base, full = pii.all_spans(text)
        assert set(base) <= set(full)
        assert set(want) <= set(full), (text, set(want) - set(full), full)
