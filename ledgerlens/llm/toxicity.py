"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other; each model sees, beside the words, the
probabilities that the earlier ones gave. In training these are out-of-fold predictions,
so a later model learns from probabilities as good as those it will get.

The categories are what the labels give: low quality first, then themes of the toxic documents,
found by clustering them by the words that tell them from the others, then the overall label, which decides.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import map_arrow, per_row, sample_labelled
from ledgerlens.plans import scratch

#: Labelled documents of each class that the models are fitted on, about, at most.
DOCS_PER_CLASS = 4000
FOLDS = 5
#: Words a model looks at.
WORDS = 150
#: Candidate words that leave the cluster.
CANDIDATES = 3000
REJECT_FROM = 0.5

#: Themes of toxic documents, each of at least THEME_DOCS sampled ones.
THEMES = 3
THEME_DOCS = 10
#: Words, those that speak most for toxic, that themes are told apart by.
THEME_WORDS = 80
CHAIN = ("low_quality", *[f"theme_{k + 1}" for k in range(THEMES)], "toxic")
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 2.0, rounds: int = 8) -> np.ndarray:
    """Weights of a ridge-penalised logistic regression by Newton steps; the last is the intercept."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], l2)
    ridge[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-5:
            break
    return w


@dataclass
class Link:
    """One category's model: weights of words, of the earlier categories' logits, and an intercept."""

    category: str
    words: dict[str, float] = field(default_factory=dict)
    earlier: list[float] = field(default_factory=list)
    bias: float = -8.0

    def score(self, found: set[str], before: list[float]) -> float:
        z = self.bias + sum(self.words[w] for w in self.words.keys() & found)
        z += sum(a * b for a, b in zip(self.earlier, _logit(np.array(before)).tolist())) if before else 0.0
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _chosen(n: np.ndarray, pos: np.ndarray, total: float, total_pos: float) -> np.ndarray:
    """Words by how far their share of positives stands above the rest's, in standard errors."""
    base = total_pos / max(total, 1)
    z = (pos - n * base) / np.sqrt(np.maximum(n * base * (1 - base), 1e-9))
    order = np.argsort(-np.abs(z), kind="stable")
    return order[(np.abs(z[order]) > 4) & (n[order] >= 5)][:WORDS]


def themes(x: np.ndarray, most: int = THEMES, rounds: int = 30) -> np.ndarray:
    """The theme (0, 1, ...; largest first) of every row of binary ``x`` by spherical k-means; rows without words have none (-1).

    Starts from the row nearest to the mean and then, again and again, the row farthest from those chosen.
    """
    out = np.full(len(x), -1)
    some = x.sum(1) > 0
    k = min(most, int(some.sum()) // THEME_DOCS)
    if k < 1:
        return out
    v = x[some] / np.sqrt(x[some].sum(1, keepdims=True))
    centres = [v[np.argmax(v @ v.mean(0))]]
    while len(centres) < k:
        centres.append(v[np.argmin((v @ np.array(centres).T).max(1))])
    centre = np.array(centres)
    near = np.zeros(len(v), int)
    for _ in range(rounds):
        near = np.argmax(v @ centre.T, 1)
        new = np.array([v[near == i].mean(0) if (near == i).any() else centre[i] for i in range(k)])
        new /= np.maximum(np.sqrt((new * new).sum(1, keepdims=True)), 1e-12)
        if np.allclose(new, centre):
            break
        centre = new
    rank = np.argsort(np.argsort(-np.bincount(near, minlength=k), kind="stable"))
    out[some] = rank[near]
    return out


def _training(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(doc_id, toxic, low_quality, text) of the sampled rows, one for each id: that of the least text hash where an id repeats."""
    known = labels.select("doc_id", "toxic", F.coalesce((F.col("quality") == 0).cast("int"), F.lit(0)).alias("low_quality")).where("toxic in (0, 1)")
    picked = sample_labelled(known, "toxic", per_class, "toxicity").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("low_quality").alias("low_quality"))
    # its rows are bounded by twice per_class, about
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return rows.groupBy("doc_id").agg(F.first("toxic").alias("toxic"), F.first("low_quality").alias("low_quality"), F.min_by("text", F.xxhash64("text")).alias("text"))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = DOCS_PER_CLASS) -> list[Link]:
    """The chain's links in the order of CHAIN, the overall label `toxic` last.

    ``docs(doc_id, text)``, ``labels(doc_id, quality, toxic)``; the models see words only. A category with fewer than
    ten examples gets a model that always says no. Without labels of both kinds so does every category. Labels of null or unknown ids teach
    nothing; an id that is labelled twice is toxic (of low quality) if any label says so.
    """
    sample = scratch.keep(_training(docs, labels, per_class), "toxicity")

    def counts(batches):
        for b in batches:
            tally: dict[str, list[int]] = {}
            for toxic, low, text in zip(*[b.column(i).to_pylist() for i in (1, 2, 3)]):
                for w in words_of(text):
                    v = tally.setdefault(w, [0, 0, 0])
                    v[0] += 1
                    v[1] += toxic
                    v[2] += low
            yield pa.RecordBatch.from_arrays([pa.array(list(tally), pa.string()), *[pa.array([v[i] for v in tally.values()], pa.int64()) for i in range(3)]], names=["word", "n", "toxic", "low"])

    total = sample.agg(F.count("*").alias("n"), F.avg("toxic").alias("toxic"), F.avg("low_quality").alias("low")).first()
    if not total["n"] or not 0 < total["toxic"] < 1:
        return [Link(c) for c in CHAIN]
    per = map_arrow(sample, counts, "word string, n long, toxic long, low long").groupBy("word").agg(*[F.sum(c).alias(c) for c in ("n", "toxic", "low")])
    n = F.col("n")
    z = lambda c: F.abs(F.col(c) - n * total[c]) / F.sqrt(n * max(total[c] * (1 - total[c]), 1e-9))
    words = sorted(r["word"] for r in per.where("n >= 5").orderBy(F.greatest(z("toxic"), z("low")).desc(), "word").limit(CANDIDATES).select("word").collect())
    at = {w: i for i, w in enumerate(words)}

    def vectors(batches):
        for b in batches:
            r = [((d or 0) % FOLDS, t, low, sorted(at[w] for w in at.keys() & words_of(text))) for d, t, low, text in zip(*[c.to_pylist() for c in b.columns])]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*r) if r else [()] * 4, (pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32())))], names=["fold", "toxic", "low", "at"])

    got = map_arrow(sample.select("doc_id", "toxic", "low_quality", "text"), vectors, "fold int, toxic int, low int, at array<int>").toArrow()
    scratch.drop(sample)
    fold, toxic, low, lists = *[got.column(i).to_numpy() for i in range(3)], got.column(3).to_pylist()
    x = np.zeros((len(fold), len(words)), np.float32)
    for i, l in enumerate(lists):
        x[i, l] = 1
    # the order of rows that arrive must not matter: sums of floats depend on it
    order = np.array(sorted(range(len(lists)), key=lambda i: (fold[i], toxic[i], low[i], lists[i])), int)
    return chain(x[order], fold[order], toxic[order], low[order], words)


def chain(x: np.ndarray, fold: np.ndarray, toxic: np.ndarray, low: np.ndarray, words: list[str]) -> list[Link]:
    """Links from binary word vectors ``x``, the fold of each row and its two labels."""
    share, n = toxic.mean(), x.sum(0)
    z = (x[toxic == 1].sum(0) - n * share) / np.sqrt(np.maximum(n * share * (1 - share), 1e-9))
    telling = np.argsort(-z, kind="stable")[:THEME_WORDS]
    telling = telling[z[telling] > 4]
    theme = np.full(len(x), -1)
    theme[toxic == 1] = themes(x[toxic == 1][:, telling])
    labels = np.stack([low, *[theme == k for k in range(THEMES)], toxic], 1).astype(float)

    links, before = [], np.zeros((len(fold), 0))
    for c, name in enumerate(CHAIN):
        y = labels[:, c]
        if y.sum() < 10 or y.sum() == len(y):
            links.append(Link(name, earlier=[0.0] * c))
            before = np.concatenate([before, np.full((len(y), 1), -8.0)], 1)
            continue

        def model(train: np.ndarray, y=y, before=before):
            seen = x[train]
            use = _chosen(seen.sum(0).astype(float), seen[y[train] == 1].sum(0).astype(float), train.sum(), y[train].sum())
            return use, logistic(np.concatenate([seen[:, use], before[train]], 1), y[train])

        out = np.zeros(len(y))
        for f in range(FOLDS):
            if not (fold == f).any() or y[fold != f].sum() == 0:
                continue
            use, w = model(fold != f)
            s = np.concatenate([x[fold == f][:, use], before[fold == f]], 1) @ w[:-1] + w[-1]
            out[fold == f] = 1 / (1 + np.exp(-np.clip(s, -30, 30)))
        use, w = model(np.ones(len(y), bool))
        links.append(Link(name, {words[i]: float(v) for i, v in zip(use, w)}, [float(v) for v in w[len(use) : -1]], float(w[-1])))
        before = np.concatenate([before, _logit(out)[:, None]], 1)
    return links


def score(docs: DataFrame, links: list[Link]) -> DataFrame:
    """doc_id, a probability p_<category> of every link, and rejected, for every row of ``docs``.

    Every whole text is scored; null and empty texts hold no word and get the chain's intercepts. Repeated rows
    are scored each, null ids kept, other columns ignored; an empty table gives an empty result.
    """
    known = {w for k in links for w in k.words}
    names = [f"p_{k.category}" for k in links]

    def run(b):
        out = [[] for _ in links]
        for text in b.column(1).to_pylist():
            found, ps = words_of(text) & known, []
            for i, link in enumerate(links):
                ps.append(link.score(found, ps))
                out[i].append(ps[-1])
        return {"doc_id": b.column(0), **dict(zip(names, out)), "rejected": [p >= REJECT_FROM for p in out[-1]]}

    return per_row(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, " + ", ".join(f"{n} double" for n in names) + ", rejected boolean")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that the chain does not reject.

    Repeated rows and null ids are judged by their own text; null and empty texts stay, as does everything where labels are
    missing. Columns of any name pass through; an empty table stays empty.
    """
    links = fit(docs, labels)
    known = {w for k in links for w in k.words}

    def run(batches):
        for b in batches:
            ok = []
            for text in b.column("text").to_pylist():
                found, ps = words_of(text) & known, []
                for link in links:
                    ps.append(link.score(found, ps))
                ok.append(ps[-1] < REJECT_FROM)
            yield b.filter(pa.array(ok, pa.bool_()))

    return map_arrow(docs, run, docs.schema)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit the chain on a bounded sample of the labelled rows and score every row; odd rows as in ``fit`` and ``score``."""
    return score(docs, fit(docs, labels))
