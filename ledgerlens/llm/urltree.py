"""URL filtering: prefix rules, and beyond them a tree of path templates per host.

Path segments that vary (numbers, hashes, dates, or one of very many siblings) become
wildcards; sibling branches whose labels do not differ significantly are merged into one;
a template is blocked if its labelled share of bad pages, smoothed towards its parent's,
is high. The tree is built level by level by aggregation over distinct (host, typed path)
rows, so a host with any share of all pages is never in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import join_counted
from ledgerlens.plans import scratch

# (verdict, host with its subdomains, path prefix)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: A segment with more siblings than this, none of them common, is a variable, unless its labels differ by more
#: than so many siblings would by chance.
SIBLINGS = 50
COMMON = 0.05
#: Siblings differ if their shares of bad pages lie this many standard errors apart.
DIFFER = 1.96
#: Weight of the parent's share in a template's.
SMOOTHING = 4.0
BLOCK_FROM = 0.6


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)).otherwise("")
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)).otherwise(""), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule's name and verdict, null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def typed_path(path: Column) -> Column:
    """Segments, with those that are variable by their form as wildcards, joined by slashes."""

    def typed(s):
        ext = F.regexp_extract(s, r"(\.[A-Za-z]{1,5})$", 1)
        stem = F.substr(s, F.lit(1), F.length(s) - F.length(ext))
        kind = F.when(stem.rlike(r"^[0-9]+$"), "{num}").when(stem.rlike(r"^[0-9]{4}-[0-9]{1,2}(-[0-9]{1,2})?$"), "{date}").when(stem.rlike(r"^(?=.*[0-9])[0-9A-Fa-f-]{8,}$"), "{hex}").when(stem.rlike(r"[0-9]{3,}"), "{id}").otherwise(stem)
        return F.concat(kind, ext)

    return F.array_join(F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), typed), "/")


def _shared(a: Column, b: Column) -> Column:
    """How many first elements two arrays share."""
    n = F.least(F.size(a), F.size(b))
    differ = F.array_min(F.filter(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), lambda i: F.element_at(a, i) != F.element_at(b, i)))
    return F.coalesce(differ - 1, n)


def _smoothed(bad: Column, lab: Column, above: Column, times: Column | None = None) -> Column:
    """The share of bad ones smoothed towards the one above; ``times`` over for as many levels that change nothing else."""
    if times is None:
        return (bad + SMOOTHING * above) / (lab + SMOOTHING)
    own = F.coalesce(F.try_divide(bad, lab), above)
    return own + (above - own) * F.pow(F.lit(SMOOTHING) / (lab + SMOOTHING), times)


def _unlabelled(t: DataFrame) -> DataFrame:
    """Templates of groups without any label, all levels at once: a level is a wildcard where its segments, or an end, differ."""
    t = scratch.keep(t, "unlabelled")
    level = F.explode(F.sequence(F.col("depth") + 1, F.size("segs") + 1))
    segs = t.select("host", "template", "segs", level.alias("level")).select("host", "template", "level", F.coalesce(F.get("segs", F.col("level") - 1), F.lit("")).alias("seg")).distinct()
    varied = segs.groupBy("host", "template", "level").agg(F.count("*").alias("k")).where("k > 1").groupBy("host", "template").agg(F.collect_list("level").alias("varied"))
    sizes = t.groupBy("host", "template").agg(F.count("*").alias("rows"))
    known = scratch.keep(sizes.join(varied, ["host", "template"], "left"), "varied")
    j = join_counted(t, known, ["host", "template"], "rows")
    names = F.transform(F.when(F.size("segs") > F.col("depth"), F.sequence(F.col("depth") + 1, F.size("segs"))).otherwise(F.array().cast("array<int>")), lambda k: F.when(F.coalesce(F.array_contains("varied", k), F.lit(False)), "/*").otherwise(F.concat(F.lit("/"), F.get("segs", k - 1))))
    return j.select("host", "tpath", "n", F.concat("template", F.array_join(names, "")).alias("template"), "share")


def tree(pages: DataFrame) -> DataFrame:
    """From (host, tpath, bad), bad null where unlabelled: (host, tpath, n, template, share), share the smoothed share of bad pages.

    Paths under one template grow by a level each round. Segments that all of them share are taken at once, and so is what remains of a
    template with one path or without labels. So rounds go by how often labelled paths branch, not by how long paths are.
    """
    lab, bad = F.count("bad").alias("lab"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("bad")
    rows = scratch.keep(pages.groupBy("host", "tpath").agg(F.count("*").alias("n"), lab, bad), "paths")
    add = lambda *by: [F.sum(c).alias(a) for c, a in zip(("n", "lab", "bad"), by)]
    first = rows.agg(F.sum("lab").alias("lab"), F.sum("bad").alias("bad")).first()
    prior = ((first["bad"] or 0) + 1.0) / ((first["lab"] or 0) + 2.0)
    hosts = scratch.keep(rows.groupBy("host").agg(F.count("*").alias("__rows"), *add("__n", "__lab", "__bad")), "hosts")
    segs = F.when(F.col("tpath") == "", F.array().cast("array<string>")).otherwise(F.split("tpath", "/"))
    columns = ["host", "tpath", "n", "lab", "bad", "segs", "depth", "template", "share"]
    t = join_counted(rows, hosts, ["host"], "__rows").select("host", "tpath", "n", "lab", "bad", segs.alias("segs"), F.lit(0).alias("depth"), F.lit("").alias("template"), _smoothed(F.col("__bad"), F.col("__lab"), F.lit(prior)).alias("share"))
    done = []
    while True:
        t = scratch.keep(t.select(columns), "tree")
        left = F.expr("slice(segs, depth + 1, size(segs))")
        of = t.select("*", left.alias("left")).groupBy("host", "template").agg(F.count("*").alias("rows"), F.sum("lab").alias("glab"), F.sum("bad").alias("gbad"), F.min("left").alias("a"), F.max("left").alias("b"))
        of = scratch.keep(of.select("host", "template", "rows", "glab", "gbad", _shared(F.col("a"), F.col("b")).alias("jump"), (F.col("rows") > 1).alias("many")), "groups")
        j = join_counted(t, of, ["host", "template"], "rows")
        taken = F.when(F.col("jump") > 0, F.concat(F.lit("/"), F.array_join(F.expr("slice(segs, depth + 1, jump)"), "/"))).otherwise("")
        j = j.select("host", "tpath", "n", "lab", "bad", "segs", (F.col("depth") + F.col("jump")).alias("depth"), F.concat("template", taken).alias("template"), _smoothed(F.col("gbad"), F.col("glab"), F.col("share"), F.col("jump")).alias("share"), "many", "glab")
        j = scratch.keep(j, "jumped")
        done.append(j.where("not many").select("host", "tpath", "n", "template", "share"))
        if not j.where("many and glab = 0").isEmpty():
            done.append(_unlabelled(j.where("many and glab = 0").select(columns)))
        t = j.where("many and glab > 0").select(columns)
        if t.isEmpty():
            break
        t = t.withColumn("seg", F.coalesce(F.get("segs", F.col("depth")), F.lit("")))
        kids = scratch.keep(t.groupBy("host", "template", "seg").agg(F.count("*").alias("rows"), *add("cn", "clab", "cbad")), "kids")
        parents = scratch.keep(kids.groupBy("host", "template").agg(F.count("*").alias("sn"), F.count("*").alias("__sn"), F.sum("cn").alias("pn"), F.sum("clab").alias("plab"), F.sum("cbad").alias("pbad")), "parents")
        j = join_counted(kids, parents, ["host", "template"], "__sn")
        rest_lab, rest_bad = F.col("plab") - F.col("clab"), F.col("pbad") - F.col("cbad")
        mean = F.try_divide(F.col("pbad"), F.col("plab"))
        error = F.sqrt(mean * (1 - mean) * (F.try_divide(F.lit(1.0), F.col("clab")) + F.try_divide(F.lit(1.0), rest_lab)))
        z = F.try_divide(F.abs(F.try_divide(F.col("cbad"), F.col("clab")) - F.try_divide(rest_bad, rest_lab)), error)
        variable = (F.col("sn") > SIBLINGS) & (F.col("cn") < COMMON * F.col("pn"))
        alike = F.coalesce(z, F.lit(0.0)) < DIFFER
        chance = F.coalesce(z, F.lit(0.0)) < F.sqrt(DIFFER**2 + 2 * F.log("sn"))
        branch = F.when(F.col("seg") == "", "").when((variable & chance) | (alike & (F.col("sn") > 1)), "/*").otherwise(F.concat(F.lit("/"), F.col("seg")))
        named = scratch.keep(j.select("host", "template", "seg", branch.alias("branch"), "rows", "clab", "cbad"), "named")
        pooled = scratch.keep(named.groupBy("host", "template", "branch").agg(F.count("*").alias("__kids"), F.sum("clab").alias("blab"), F.sum("cbad").alias("bbad")), "pooled")
        nodes = scratch.keep(join_counted(named, pooled, ["host", "template", "branch"], "__kids").select("host", "template", "seg", "branch", "rows", "blab", "bbad"), "nodes")
        joined = join_counted(t, nodes, ["host", "template", "seg"], "rows")
        done.append(joined.where("seg = ''").select("host", "tpath", "n", "template", "share"))
        t = joined.where("seg <> ''").select("host", "tpath", "n", "lab", "bad", "segs", (F.col("depth") + 1).alias("depth"), F.concat("template", "branch").alias("template"), _smoothed(F.col("bbad"), F.col("blab"), F.col("share")).alias("share"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, share) for every page.

    The labels that the tree learns from are the rules' verdicts. Urls that are null or have no `://`
    have an empty host and path. Repeated rows are judged each; null ids are kept; other columns are ignored.
    """
    parts = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = scratch.keep(parts.select("*", name.alias("rule"), verdict.alias("said"), typed_path(F.col("path")).alias("tpath")), "pages")
    shares = tree(rows.select("host", "tpath", (F.col("said") == "block").alias("bad")))
    out = join_counted(rows, shares, ["host", "tpath"], "n")
    method = F.when(F.col("share") >= BLOCK_FROM, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("said", method).alias("verdict"), F.when(F.col("template") == "", "/").otherwise(F.col("template")).alias("template"), "share")
