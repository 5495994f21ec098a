"""op13 against its definition in plain Python, and the wavelet tree against counting."""

import collections
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import queries, spelling, wavelet

D = "/root/testdata/sf0.001"


def brute_words(docs, slip=97, letters=5, count=3):
    total = collections.Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= letters:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= count}


def edits(word, alphabet):
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    for i in range(len(word) + 1):
        for c in alphabet:
            out.add(word[:i] + c + word[i:])
            out.add(word[:i] + c + word[i + 1 :])
    return out - {word}


def brute(words, times=2):
    alphabet = sorted({c for w in words for c in w})
    near = {w: [v for v in edits(w, alphabet) if v in words] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= times * n:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out)


def rows(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_query_is_its_definition(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{D}/documents.parquet'").fetchall()
    got = queries.op13_spelling_variants(spark, D)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert [t for _, t in got.dtypes] == ["string", "string", "string", "bigint", "bigint", "bigint"]
    want = brute(brute_words(docs))
    assert rows(got) == want and any(r[1] for r in want)


def crowd(rnd, n):
    """Documents whose words have many near words, of few letters, with ties, accents and chains."""
    base = ["aabba", "abcab", "aaaaaa", "bàbébÿ", "prefixprefixprefix", "a×b÷ca"]
    docs = []
    for i in range(n):
        words = []
        for _ in range(60):
            w = rnd.choice(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                at = rnd.randrange(len(w) + 1)
                w = rnd.choice([w[:at] + rnd.choice("abàÿZ") + w[at:], w[:at] + w[at + 1 :], w[:at] + rnd.choice("abéB") + w[at + 1 :]])
            words.append(w)
        docs.append((i, rnd.choice([" ", "1", "\n", "一", "Ā"]).join(words)))
    return docs


@pytest.mark.parametrize("small", [False, True])
def test_crowds_and_odd_rows(spark, small, monkeypatch):
    if small:  # every group is dealt again down to single positions, texts are cut, searches and counts are short
        for name, value in (("GROUP_ROWS", 2), ("SEARCH_ROWS", 8), ("COUNTED", 20), ("SLICE", 40)):
            monkeypatch.setattr(spelling, name, value)
        monkeypatch.setattr(wavelet, "SLICE", 7)
    docs = crowd(random.Random(6), 25 if small else 60)
    docs += [(None, None), (None, "aabba aabba"), (100, None), (101, ""), (102, "12 \t"), docs[0], docs[0], (0, "aabba")]
    docs += [(200, "x" * 3000 + " " + "x" * 2999 + "y" + " " + "x" * 2999 + " " + "x" * 1500 + "z" + "x" * 1499)] * 3
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("z") for c in ("word", "n", "width", "rest", "root")})
    want = brute_words(docs)
    got = rows(spelling.variants(df))
    assert {r[0]: r[3] for r in got} == want
    long = {w for w in want if len(w) > 100}
    assert [r for r in got if r[0] not in long] == brute({w: n for w, n in want.items() if w not in long})
    less = {w: {w[:i] + w[i + 1 :] for i in range(len(w))} for w in long}
    near = lambda v, w: v in less[w] or w in less[v] or len(v) == len(w) and sum(a != b for a, b in zip(v, w)) == 1
    assert len(long) > 2 and any(near(v, w) for v in long for w in long)
    assert all(r[4] == sum(near(v, r[0]) for v in long) for r in got if r[0] in long)


def test_empty_and_without_near_words(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(none).count() == 0
    lone = spark.createDataFrame([(1, "alpha alpha alpha gamma gamma gamma")], "doc_id long, text string")
    assert rows(spelling.variants(lone, slip=None)) == [("alpha", None, "alpha", 3, 0, None), ("gamma", None, "gamma", 3, 0, None)]


def test_chains_lead_to_their_end(spark):
    words = {f"{'a' * i}{'b' * (40 - i)}": 2 ** (i // 2) * 3 + i % 2 for i in range(41)}
    df = spark.createDataFrame([(w, f) for w, f, *_ in brute(words, 1) if f], "word string, form string")
    assert {r.word: r.root for r in spelling.roots(df).collect()} == {w: r for w, f, r, *_ in brute(words, 1) if f}


def test_wavelet_tree():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 17, 64, 100):
        values = rng.permutation(n)
        tree = wavelet.WaveletTree(values)
        a, b = np.sort(rng.integers(0, n + 1, (2, 200)), 0)
        c, d = np.sort(rng.integers(0, n + 1, (2, 200)), 0)
        want = [sorted(v for v in values[i:j].tolist() if k <= v < m) for i, j, k, m in zip(a, b, c, d)]
        assert (tree.below(a, b, d) - tree.below(a, b, c)).tolist() == [len(w) for w in want]
        q, v = tree.report(a, b, c, d)
        got = [sorted(v[q == i].tolist()) for i in range(200)]
        assert got == want
