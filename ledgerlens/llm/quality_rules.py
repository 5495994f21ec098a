"""Quality rules that vote or abstain, weighed by expectation-maximisation.

Each rule says good (2), bad (1) or nothing (0) about a document. Only how often each
pattern of votes occurs is gathered: at most 3 to the number of rules rows, whatever the
corpus' size. EM on these counts estimates, without labels, how often each rule says what
on good and on bad documents. Starting values count as a fixed number of documents, so a corpus
of any size worth the name outweighs them. Several rules look at each kind of damage in their own
way; what they agree on is how EM tells bad documents from odd ones.

Everything runs in DataFrame and SQL functions, but for EM itself: arithmetic on the counts.
"""

from __future__ import annotations

from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.plans import scratch

WINDOW = 8
#: EM ends when no value moves by more than this; it raises if that takes more than so many rounds.
TOLERANCE = 1e-7
ROUNDS = 20_000
#: Documents with a lower posterior are dropped.
KEEP_FROM = 0.5
PRIOR_GOOD = 0.8
#: What a rule is taken to say of good and of bad documents (abstains, bad, good) before any is seen.
START = {"good": (0.05, 0.02, 0.93), "bad": (0.05, 0.35, 0.6)}
#: Documents that these starting values count for, whatever the number of documents.
START_DOCS = 100.0

_SPACE = "[\\x20\\x09-\\x0D]+"
RULES = ("symbols", "marks", "dup_lines", "repeats", "word_length", "upper", "variety", "stops")


def measures(docs: DataFrame, *extra: str) -> DataFrame:
    """doc_id and the counts of each row's whole text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper, n_distinct, n_stops.

    A null text counts as empty. Equal windows are told by a 64-bit hash over their words.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    a = docs.select(*extra, F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.filter(F.split(text, _SPACE), lambda w: w != "").alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.regexp_replace(x, _SPACE, "")) > 0)
    b = a.select(
        *extra,
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("\\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("text", F.lit("[.!?]")).cast("long").alias("n_stops"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        lines.alias("lines"),
        F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1))).alias("two"),
    )
    # hashes of 2, 4 and 8 words in a row, each from two of the step before; those that reach past the end are cut off
    four = b.select("*", F.size("two").alias("__n"), F.transform("two", lambda h, i: F.xxhash64(h, F.get("two", i + 2))).alias("four")).drop("two")
    eight = four.select("*", F.size("four").alias("__m"), F.transform("four", lambda h, i: F.xxhash64(h, F.get("four", i + 4))).alias("eight")).drop("four")
    full = eight.select("*", F.slice("eight", 1, F.greatest(F.lit(0), F.col("__n") - (WINDOW - 1))).alias("windows")).drop("eight")
    sized = full.select("*", F.size("lines").alias("__lines"), F.size("windows").alias("__windows"))
    at = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    c = sized.select(*extra, "doc_id", "n_words", "word_chars", "n_symbols", "n_upper", "n_stops", "n_distinct", (F.col("__lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), F.when(F.size(F.array_distinct("windows")) < F.col("__windows"), at).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias("at"))
    same = lambda x, y: y.isNotNull() & (x["h"] == y["h"])
    hits = F.filter(F.transform("at", lambda x, k: F.when(same(x, F.get("at", k - 1)) | same(x, F.get("at", k + 1)), x["i"])), lambda i: i.isNotNull())
    d = c.select("*", F.array_sort(hits).alias("hits")).drop("at")
    covered = F.aggregate("hits", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")), lambda s, i: F.struct((s["n"] + WINDOW - F.greatest(F.lit(0), s["end"] - i)).alias("n"), (i + WINDOW).alias("end")), lambda s: s["n"])
    return d.select(*extra, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.when(F.size("hits") > 0, covered).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"), "n_upper", "n_distinct", "n_stops")


def votes(measured: DataFrame) -> DataFrame:
    """``measured`` with a column vote_<rule> for every rule: 1 bad, 2 good, 0 abstains."""

    def by(value: Column, bad: Column, good: Column, when: Column | None = None) -> Column:
        vote = F.when(bad, 1).when(good, 2).otherwise(0)
        return F.coalesce(vote if when is None else F.when(when, vote).otherwise(0), F.lit(0))

    per = lambda c: F.try_divide(F.col(c), F.col("n_words"))
    chars = F.try_divide(F.col("word_chars"), F.col("n_words"))
    upper = F.try_divide(F.col("n_upper"), F.col("word_chars"))
    enough = F.col("n_words") >= 20
    marks = F.try_divide(F.col("n_symbols") + F.col("n_stops"), F.col("word_chars"))
    rules = {
        "symbols": by(per("n_symbols"), per("n_symbols") > 0.3, per("n_symbols") < 0.05),
        "marks": by(marks, marks > 0.1, marks < 0.05),
        "dup_lines": by(per("n_dup_lines"), F.col("n_dup_lines") > F.greatest(F.lit(2), F.col("n_words") / 60), F.col("n_dup_lines") == 0),
        "repeats": by(per("n_repeat_words"), per("n_repeat_words") > 0.2, per("n_repeat_words") < 0.1, enough),
        "word_length": by(chars, (chars < 3.5) | (chars > 7), chars.between(4.5, 6.5), enough),
        "upper": by(upper, upper > 0.4, upper < 0.15),
        "variety": by(per("n_distinct"), (per("n_distinct") < 0.3) & (F.col("n_words") < 2000), per("n_distinct") > 0.5, enough),
        "stops": by(per("n_stops"), (per("n_stops") > 0.5) | ((F.col("n_stops") == 0) & enough), per("n_stops").between(0.005, 0.35), enough),
    }
    return measured.select("*", *[rules[r].alias(f"vote_{r}") for r in RULES])


def _weights(p: dict[str, float]) -> tuple[float, list[dict[int, float]]]:
    """The log odds of good before any vote, and what each rule's votes add. Rules that abstain say nothing."""
    by = []
    for r in RULES:
        said = {k: 1.0 - p[f"{r}_0_{k}"] for k in ("good", "bad")}
        by.append({v: log((p[f"{r}_{v}_good"] / said["good"]) / (p[f"{r}_{v}_bad"] / said["bad"])) for v in (1, 2)} | {0: 0.0})
    return log(p["prior"] / (1 - p["prior"])), by


def start_values() -> dict[str, float]:
    return {"prior": PRIOR_GOOD} | {f"{r}_{v}_{k}": START[k][v] for r in RULES for k in START for v in (0, 1, 2)}


def em(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> dict[str, float]:
    """Maximum a posteriori values {"prior", "<rule>_<vote>_<class>"} for patterns of votes and their counts.

    The class whose documents the rules call bad more often is called bad. Without patterns the starting values stay.
    """
    p = start_values()
    total = sum(n for _, n in patterns)
    if not total:
        return p
    for _ in range(rounds):
        before, by = _weights(p)
        mass = {f"{r}_{v}_{k}": START_DOCS * START[k][v] for r in RULES for k in START for v in (0, 1, 2)}
        size = {"good": 0.0, "bad": 0.0}
        for votes_, n in patterns:
            z = before + sum(w[v] for w, v in zip(by, votes_))
            good = 1 / (1 + exp(-z)) if z > -700 else 0.0
            size["good"] += n * good
            size["bad"] += n * (1 - good)
            for r, v in zip(RULES, votes_):
                mass[f"{r}_{v}_good"] += n * good
                mass[f"{r}_{v}_bad"] += n * (1 - good)
        new = {"prior": (size["good"] + START_DOCS * PRIOR_GOOD) / (total + START_DOCS)}
        new |= {key: m / (size[key.rsplit("_", 1)[1]] + START_DOCS) for key, m in mass.items()}
        moved = max(abs(new[k] - p[k]) for k in p)
        p = new
        if moved <= tolerance:
            break
    else:
        if rounds == ROUNDS:
            raise RuntimeError(f"EM did not settle in {rounds} rounds")
    if sum(p[f"{r}_1_good"] - p[f"{r}_1_bad"] for r in RULES) > 0:
        p = {k.replace("_good", "_x").replace("_bad", "_good").replace("_x", "_bad"): v for k, v in p.items()} | {"prior": 1 - p["prior"]}
    return p


def fit(voted: DataFrame, rounds: int = ROUNDS) -> dict[str, float]:
    """EM over the counts of vote patterns, which are all that comes to the driver: at most 3 ** rules rows."""
    cols = [f"vote_{r}" for r in RULES]
    found = voted.groupBy(*cols).agg(F.count("*").alias("n")).collect()
    return em(sorted((tuple(r[c] for c in cols), r["n"]) for r in found), rounds)


def posterior(p: dict[str, float]) -> Column:
    """Probability of good, given the votes and the fitted values."""
    before, by = _weights(p)
    logit = F.lit(before)
    for r, w in zip(RULES, by):
        logit = logit + F.when(F.col(f"vote_{r}") == 1, w[1]).when(F.col(f"vote_{r}") == 2, w[2]).otherwise(0.0)
    return 1 / (1 + F.exp(-logit))


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, quality.

    base_failed: under 20 words, or over 30 % of the words in repeated windows. kept: not
    base_failed and a posterior of at least 0.5. Null and empty texts have no words and
    fail. Repeated rows are judged each, null ids are kept, other columns are ignored.
    """
    voted = scratch.keep(votes(measures(docs)), "measures")
    p = fit(voted)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    quality = posterior(p)
    return voted.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & (quality >= KEEP_FROM)).alias("kept"), quality.alias("quality"))
