"""op4, op5, op8 and the pipeline."""

import math
import os
import random
import re
import sys
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlens.llm import mixing, neardup, queries, tokens, toxicity, urltree
from ledgerlens.plans import scratch

D = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_mixing_is_its_sql(spark):
    got = sorted(map(tuple, queries.op4_poisson_mixing(spark, D).collect()))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{D}/documents.parquet'")
    assert got == sorted(con.sql(queries.oracle_sql()["op4_poisson_mixing"]).fetchall())


@pytest.mark.parametrize("broadcast", [10_000, 0])
def test_mixing_rates_and_odd_rows(spark, broadcast, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", broadcast)
    rows = [(i, "x" * 9, None, "a" if i % 3 else None, 9) for i in range(6000)] + [(None, None, None, "b", 0), (5, "x" * 9, None, "a", 9)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("copy", F.lit("old")).withColumn("rate", F.lit(1))
    rates = {r.source: r.rate for r in mixing.rates(df).collect()}
    out = mixing.mix(df)
    n = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    for s, size in (("a", 4001), (None, 2000)):
        assert abs(n[s] - rates[s] * size) < 5 * math.sqrt(rates[s] * size)
    assert sum(rates[s] * c * 10 for s, c in (("a", 4001), (None, 2000))) + rates["b"] == pytest.approx(60011, rel=1e-6)
    assert mixing.mix(df.limit(0)).count() == 0
    only = {r.source for r in mixing.mix(df, {"a": 1.0}).select("source").distinct().collect()}
    assert only == {"a"}


def test_poisson_inverse(spark):
    cum = spark.createDataFrame([(0.0,), (0.3,), (40.0,)], "r double").select("r", mixing._distribution(F.col("r")).alias("c")).collect()
    for r in cum:
        p, total = math.exp(-r.r), 0.0
        for k, c in enumerate(r.c[:30]):
            total += p
            p *= r.r / (k + 1)
            assert c == pytest.approx(total, abs=1e-12)
        assert r.c[-1] == pytest.approx(1.0, abs=1e-12)


def test_urls(spark):
    rnd = random.Random(1)
    urls = [None, "", "no scheme", "http://", "http://Example.ORG/es/1", "https://www.example.org/en/17?x", "https://notexample.org/es/3", "x://a.com/fr/2#t", "x://a.com", "x://a.com?/fr/", "x://org/", "http://u:p@H.com:80/de/://x", "a://b://c/d"]
    for _ in range(300):
        urls.append(f"http://{rnd.choice(['a.net', 'b.com', 'w.b.com', 'example.org'])}/{rnd.choice(['en', 'fr', 'de', 'es'])}/{rnd.randint(1, 300)}{rnd.choice(['', '/', '.html'])}")
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(None, urls[5], "h"), (3, urls[3], "h")], "page_id long, url string, host string")
    got = urltree.judge(df).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        if r.page_id is None:
            continue
        u = urls[r.page_id]
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host) :])[0]
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [(h + p, v) for v, h, p in urltree.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, key=lambda f: len(f[0]), default=(None, None))
        assert (r.host, r.path, r.rule) == (host, path, best[0])
        assert r.verdict == (best[1] or ("block" if r.share >= urltree.BLOCK_FROM else "allow"))
    assert urltree.judge(df.limit(0)).count() == 0


def test_templates(spark):
    rows = [("h", f"/good/{i}", 0) for i in range(40)] + [("h", f"/bad/{i}", 1) for i in range(40)] + [("h", f"/user/n{chr(97 + i % 26)}{chr(97 + i // 26)}/x", None) for i in range(200)] + [("h", "/bad/9", None)]
    df = spark.createDataFrame(rows, "host string, path string, bad int").select("host", urltree.typed_path(F.col("path")).alias("tpath"), "bad")
    t = {r.tpath: r for r in urltree.tree(df).collect()}
    assert t["bad/{num}"].share > 0.8 > 0.2 > t["good/{num}"].share
    assert t["bad/{num}"].template == "/bad/{num}" and t["user/naa/x"].template.startswith("/*")


def test_templates_of_any_depth_and_many_siblings(spark):
    deep = [("h", f"a/b/c/d/e/{kind}/{i}x", kind == "spam") for kind in ("good", "spam") for i in range(20)]
    wide = [("w", f"s{i}/p{j}", i == 60) for i in range(61) for j in range(15)] + [("w", "s0", None), ("w", "", None)]
    got = {(r.host, r.tpath): r for r in urltree.tree(spark.createDataFrame(deep + wide, "host string, tpath string, bad boolean")).collect()}
    assert len(got) == len(deep + wide)
    for host, path, bad in deep:
        assert f"/{path.split('/')[5]}/" in got[host, path].template and (got[host, path].share >= urltree.BLOCK_FROM) == bad
    assert got["w", "s60/p1"].template.startswith("/s60/") and got["w", "s60/p1"].share >= urltree.BLOCK_FROM
    assert got["w", "s1/p1"].template.startswith("/*/") and got["w", "s1/p1"].share < 0.1
    assert got["w", ""].template == "" and got["w", "s0"].template == "/*"


def test_rounds_go_by_branching(spark):
    """One url of 500 segments, two that share 300 labelled ones, and unlabelled paths that vary at many depths."""
    path = "/".join(f"s{i}" for i in range(500))
    shared = "/".join(f"t{i}" for i in range(300))
    pages = [("a", path, None), ("a", "x", True), ("b", f"{shared}/u/v", True), ("b", f"{shared}/w/v", False)] + [("c", "/".join(f"k{i if i % 7 == j else 'x'}" for i in range(60 + j)), None) for j in range(5)]
    before = len(scratch._scopes)
    with scratch.scope() as s:
        got = {(r.host, r.tpath): (r.template, r.share) for r in urltree.tree(spark.createDataFrame(pages, "host string, tpath string, bad boolean")).collect()}
        assert len(s.kept) < 50 and len(scratch._scopes) == before + 1
    want = brute_tree(pages)
    assert got.keys() == want.keys()
    for k, (template, share) in want.items():
        assert got[k] == (template, pytest.approx(share))


def brute_tree(pages):
    """Template and share of every (host, path), by recursion over lists."""
    count = {}
    for host, path, bad in pages:
        c = count.setdefault((host, path), [0, 0, 0])
        c[0] += 1
        c[1] += bad is not None
        c[2] += bool(bad)
    smooth = lambda b, n, above: (b + urltree.SMOOTHING * above) / (n + urltree.SMOOTHING)
    sys.setrecursionlimit(5000)
    total = lambda keys: [sum(count[k][i] for k in keys) for i in range(3)]
    _, lab, bad = total(count)
    prior, out = (bad + 1) / (lab + 2), {}

    def grow(keys, depth, template, share):
        """``keys`` share ``template``, which stands for their first ``depth`` segments; shorter paths end here."""
        by = {}
        for k in keys:
            segs = k[1].split("/") if k[1] else []
            by.setdefault(segs[depth] if len(segs) > depth else "", []).append(k)
        n, lab, bad = total(keys)
        branches = {}
        for seg, own in by.items():
            cn, clab, cbad = total(own)
            z = 0.0
            if lab and clab and lab > clab and 0 < bad < lab:
                mean = bad / lab
                z = abs(cbad / clab - (bad - cbad) / (lab - clab)) / math.sqrt(mean * (1 - mean) * (1 / clab + 1 / (lab - clab)))
            many = len(by) > urltree.SIBLINGS and cn < urltree.COMMON * n and z < math.sqrt(urltree.DIFFER**2 + 2 * math.log(len(by)))
            name = "" if seg == "" else "/*" if many or (z < urltree.DIFFER and len(by) > 1) else "/" + seg
            branches.setdefault(name, []).extend(own)
        for name, own in branches.items():
            _, clab, cbad = total(own)
            if name == "":
                for k in own:
                    out[k] = (template, share)
            else:
                grow(own, depth + 1, template + name, smooth(cbad, clab, share))

    for host in {h for h, _ in count}:
        own = [k for k in count if k[0] == host]
        _, lab, bad = total(own)
        grow(own, 0, "", smooth(bad, lab, prior))
    return out


def test_tree_by_brute_force(spark):
    rnd = random.Random(17)
    pages = []
    for host in ("a", "b", "hot"):
        for _ in range(900 if host == "hot" else 200):
            segs = [rnd.choice(["x", "y", "z", f"s{rnd.randrange(90)}"]) for _ in range(rnd.randrange(6))]
            pages.append((host, "/".join(segs), rnd.choice([None, False, segs[:1] == ["x"], segs[1:2] == ["y"]])))
    got = urltree.tree(spark.createDataFrame(pages, "host string, tpath string, bad boolean")).collect()
    want = brute_tree(pages)
    assert len(got) == len(want)
    for r in got:
        assert r.template == want[r.host, r.tpath][0] and r.share == pytest.approx(want[r.host, r.tpath][1], rel=1e-9), (r, want[r.host, r.tpath])


def test_long_urls(spark):
    urls = ["http://h.net/" + "/".join(f"p{i}" for i in range(30)), "http://h.net/" + "x" * 200_000, "http://" + "h" * 100_000 + ".org/a?" + "q" * 100_000, "http://h.net/p0"]
    got = {r.page_id: r for r in urltree.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()}
    assert len(got) == 4 and got[0].path.count("/") == 30 and len(got[1].path) == 200_001 and got[2].rule == "org/" and got[2].path == "/a"


def test_tokens_round_trip(spark):
    from tokenizers import Tokenizer

    rnd = random.Random(3)
    alphabet = ["a", "Bc", " ", "  ", "\n", "\n\n", "\t", "é", "中", "'s", ".", ",", "12", "\u00a0", "<|endoftext|>", "!?", "can't", "\u3000"]
    rows = [(rnd.randrange(-50, 50), "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40)))) for _ in range(400)] + [(None, "null id"), (7, None), (8, ""), (9, "word " * 30_000)]
    df = spark.createDataFrame([(*r, "t") for r in rows], "doc_id long, text string, ids string")
    out = scratch.new_path(spark, "test-tokens")
    got = tokens.digest(df, out).orderBy("start").collect()
    tok = Tokenizer.from_file(tokens.vocabulary_path())
    want = {}
    for d, t in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.setdefault(d, []).append((len(ids), zlib.crc32(ids.tobytes())))
    have = {}
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
        have.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    # one record by its offset
    r = tokens.read_index(spark, out).where("doc_id = 9").first()
    with open(os.path.join(out.removeprefix("file://"), "data", r.file), "rb") as f:
        f.seek(r.offset)
        record = f.read(r.length)
    (_, size, payload), = tokens.records(record)
    assert size == r.length and tokens.decode_payload(payload)[0] == 9
    for k in (2, 9, 30, len(record) - 2):
        broken = bytearray(record)
        broken[k] ^= 1
        with pytest.raises(ValueError):
            list(tokens.records(bytes(broken)))
    with pytest.raises(ValueError):
        list(tokens.records(record[:-3]))
    assert tokens.digest(df.limit(0)).count() == 0


def test_words_forgotten(spark):
    e = tokens.Encoder(tokens.vocabulary_path())
    e.room = 40
    rnd = random.Random(8)
    for _ in range(300):
        t = " ".join(rnd.choice("abcdefgh") * rnd.randint(1, 6) + rnd.choice(["", ",", "."]) for _ in range(30))
        assert np.frombuffer(e.encode(t), e.kind).tolist() == e.tok.encode(t, add_special_tokens=False).ids
    assert len(e.words) < 200


def test_encoder_is_the_library(monkeypatch):
    monkeypatch.setattr(tokens, "PIECE_CHARS", 50)
    rnd = random.Random(5)
    parts = ["a", "Bc", " ", " ", "\n", "é", "中", "'s", ".", "12", "<|endoftext|>", "can't", " x", "\nand", " #", "\u00a0"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 120))) for _ in range(3000)]
    texts += [" ".join(rnd.choice(["word", "A", "b,", "\nline", "é!"]).replace(" \n", "\n") for _ in range(rnd.randint(1, 80))).replace(" \n", "\n").strip() for _ in range(500)]
    for as_text in (False, True):
        e = tokens.Encoder(tokens.vocabulary_path(), as_text)
        assert e.cuts
        want = [x.ids for x in e.tok.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(x, e.kind).tolist() for x in e.encode_all(texts)] == want


def test_other_vocabularies_go_to_the_library():
    e = tokens.Encoder(tokens.vocabulary_path("word_bpe_49k.json"))
    assert not e.cuts
    for t in ("", "Some  words here", "<|endoftext|> x"):
        assert np.frombuffer(e.encode_all([t])[0], e.kind).tolist() == e.tok.encode(t, add_special_tokens=False).ids


def test_parts_sort_as_numbers(spark):
    rows = [(f"part-{k:05d}-x.txt", 0, 9, k, 1, 0) for k in (99_998, 99_999, 100_000, 100_001)]
    out = scratch.new_path(spark, "test-index")
    spark.createDataFrame(rows, "file string, offset long, length long, doc_id long, n_tokens long, start_in_file long").write.parquet(f"{out}/index")
    assert sorted((r.doc_id, r.start) for r in tokens.read_index(spark, out).collect()) == [(99_998, 0), (99_999, 1), (100_000, 2), (100_001, 3)]


def holds_any(text, items):
    """Whether 13 tokens in a row, or a whole shorter item, agree in four fifths at any shift. By comparing all tokens with all."""
    words = lambda t: re.findall(r"\w+", (t or "").lower())  # noqa: E731 - the test tables have no unspaced scripts
    doc = np.array([hash(w) for w in words(text)])
    for item in items:
        own = np.array([hash(w) for w in words(item)])
        n = min(13, len(own))
        if not n or len(doc) < n:
            continue
        same = np.zeros((len(doc), len(own)), np.int64)
        same[:] = doc[:, None] == own[None, :]
        run = sum(same[k : len(doc) - n + 1 + k, k : len(own) - n + 1 + k] for k in range(n))
        if (run >= 0.8 * n).any():
            return True
    return False


def test_pipeline(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "tokens"]
    got = docs
    for name, stage in corpus_pipeline.STAGES:
        before, got = got, scratch.keep(stage(spark, got, D), "t")
        if name != "tokens":
            assert got.columns == docs.columns
        a, b = [r.doc_id for r in before.collect()], [r.doc_id for r in got.collect()]
        texts = {r.doc_id: r.text for r in before.collect()}
        if name == "toxicity":
            links = toxicity.fit(before, spark.read.parquet(f"{D}/labels.parquet"))
            assert sorted(b) == sorted(r.doc_id for r in toxicity.score(before, links).where("not rejected").collect())
        if name == "near_dedup":
            sets = {d: set(neardup.shingle_hashes(t, 5).tolist()) for d, t in texts.items()}
            for i, x in enumerate(b):
                for y in b[:i]:
                    assert len(sets[x] & sets[y]) < 0.8 * len(sets[x] | sets[y])
            for x in set(a) - set(b):
                assert any(y != x and len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y]) for y in a)
        if name == "decontamination":
            items = [r.text for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()]
            assert sorted(b) == sorted(d for d in a if not holds_any(texts[d], items)) and len(b) < len(a)
        if name == "mixing":
            assert set(b) <= set(a)
        if name == "tokens":
            assert sorted(b) == sorted(a)
    assert corpus_pipeline.run(spark, D).count() == got.count()


def test_pipeline_with_odd_rows(spark, tmp_path):
    """Null, empty, repeated and very long texts, null ids and columns of names used inside."""
    base = " ".join(f"word{i}" for i in range(60))
    rows = [(1, base), (2, base), (3, base + " more"), (None, base), (None, None), (4, None), (5, ""), (5, ""), (6, "alone with few words"), (6, "alone with few words"), (7, "long " + " ".join(f"l{i % 5000}" for i in range(300_000))), (8, "holds the benchmark passage of thirteen words or so that was put there today")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, rk string, sig long, copy string, shard long, __maybe string"
    spark.createDataFrame([(d, t, None, None if d == 6 else "s", 1, "r", 1, "c", 2, "m") for d, t in rows], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "the benchmark passage of thirteen words or so that was put there"), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.keep(stage(spark, docs, str(tmp_path)), "odd")
        kept[name] = sorted(str(r.doc_id) for r in docs.select("doc_id").collect())
        if name in ("toxicity", "near_dedup", "decontamination"):
            assert sorted(docs.columns) == sorted(x.split(" ")[0] for x in schema.split(", "))
    assert len(kept["toxicity"]) == len(rows)
    assert kept["near_dedup"] == ["1", "4", "6", "7", "8"]
    assert kept["decontamination"] == ["1", "4", "6", "7"]
    assert len(kept["tokens"]) == len(kept["mixing"])
    for name in ("documents", "benchmark", "labels"):
        empty = spark.read.parquet(f"{tmp_path}/{name}.parquet").limit(0)
        empty.write.parquet(f"{tmp_path}/empty/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0


@pytest.mark.parametrize("name", ["op4_poisson_mixing", "op8_token_records", "op11_importance_resampling", "op12_warc_archive", "op13_spelling_variants"])
def test_registered_queries_give_what_the_operators_give(spark, name):
    """As registered, without the tables that the result doesn't read."""
    plain = getattr(queries, name)(spark, D).collect()
    with scratch.scope() as s:
        got = queries.queries()[name](spark, D)
        assert len(s.kept) + len(s.paths) <= 6
        assert sorted(map(repr, got.collect())) == sorted(map(repr, plain)) and plain
