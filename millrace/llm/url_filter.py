"""URL filters: given rules by host and path first, then a learned tree of path templates.

Paths are counted per (host, path) before anything else. Level by level, the segments below a node are generalised: a
segment that is one of many (`min_children`) and rare among them (`max_share`) becomes a wildcard, digits as `*` within
what surrounds them, other text as `*` as a whole. A node whose labelled rate is within `z` standard errors of its
parent's is merged into the parent. Siblings that stand apart from their parent are merged with one another, so that a parent of any number
of children is a short array: siblings of like size form classes on the arcsine scale, so narrow that a two-proportion test can't tell two of
a class apart (its width is z standard errors of the difference of its two largest, and four times the labels make classes half
as wide; their number grows with the cube root of a parent's labels). In the order of their rates, neighbouring classes are pooled as long as
the test doesn't tell them apart. A path belongs to the deepest node on its way that is not merged
into its parent, and takes the counts of that node's branch. A template is rejected when its branch's smoothed share of bad labels is
at least `reject`. A branch of several siblings is named by the first, with the number of the others.

All are DataFrame operations; a host with a third of the rows is pre-aggregated, and joins on it can be split by AQE.
Segments after the `depth`-th are one last segment. The tree grows with distinct paths, not with pages.

Nulls: a null url, or one without `://`, has an empty host and path, fits no rule and is allowed unless that template is
rejected. Repeated pages are each judged. Without labels all templates are allowed. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

#: (verdict, host, path) of the given rules.
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
DEPTH, MIN_CHILDREN, MAX_SHARE, Z, STRENGTH, REJECT = 6, 8, 0.05, 1.96, 8.0, 0.5


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path)."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def matched(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.when(F.lit(False), F.lit("")), F.when(F.lit(False), F.lit(""))
    for what, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2]), reverse=True):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = rule.when(fits, F.lit(h + p)), verdict.when(fits, F.lit(what))
    return rule, verdict


def templates(scratch: shared.Scratch, paths: DataFrame, depth: int = DEPTH, min_children: int = MIN_CHILDREN, max_share: float = MAX_SHARE) -> DataFrame:
    """paths (host, path, n, labelled, bad) with t0 .. t<depth>: the node of each level, null below the last segment."""
    segments = F.split(F.expr("substring(path, 2)"), "/", depth)
    out = paths.withColumn("_s", F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(segments)).withColumn("t0", F.col("host"))
    for k in range(depth):
        out = scratch.save(out.withColumn("_x", F.get("_s", F.lit(k))), f"level{k}")  # a table for each level keeps plans short
        child = out.filter(F.col("_x").isNotNull()).groupBy(F.col(f"t{k}").alias("_t"), F.col("_x").alias("_y")).agg(F.sum("n").alias("_n"))
        node = child.groupBy("_t").agg(F.count("*").alias("_c"), F.sum("_n").alias("_all"))
        wild = child.join(node, "_t").select("_t", "_y", ((F.col("_c") >= min_children) & (F.col("_n") <= max_share * F.col("_all"))).alias("_wild"))
        out = out.join(wild, (F.col(f"t{k}") == F.col("_t")) & (F.col("_x") == F.col("_y")), "left").drop("_t", "_y")
        shape = F.when(~F.col("_wild"), F.col("_x")).when(F.col("_x").rlike("[0-9]"), F.regexp_replace("_x", "[0-9]+", "*")).otherwise(F.when(F.col("_x") == "", "").otherwise("*"))
        out = out.withColumn(f"t{k + 1}", F.when(F.col("_x").isNotNull(), F.concat(F.col(f"t{k}"), F.lit("/"), shape))).drop("_x", "_wild")
    return out.drop("_s")


def branches(apart: DataFrame, z: float = Z) -> DataFrame:
    """apart (k, t, up, n, b; n > 0) with branch, bn, bb: the name and the counts of the branch of like siblings."""
    # a class holds 4**s to 4**(s + 1) - 1 labels a sibling and is no wider than z standard errors of the difference of its two largest
    scale = F.floor(F.log2(F.col("n").cast("double")) / 2 + 1e-9)
    bins = F.ceil(F.pow(F.lit(2.0), F.col("scale")) * (math.pi * math.sqrt(2) / z))
    at = F.floor(F.asin(F.sqrt(F.col("b") / F.col("n"))) * F.col("bins") * (2 / math.pi) + 1e-9)
    told = apart.withColumn("scale", scale).withColumn("bins", bins).withColumn("bin", F.least(at, F.col("bins") - 1)).drop("bins")
    classes = told.groupBy("k", "up", "scale", "bin").agg(F.sum("n").alias("n"), F.sum("b").alias("b"), F.count("*").alias("c"), F.min("t").alias("t"))
    row = F.struct((F.col("b") / F.col("n")).alias("rate"), "t", "scale", "bin", "n", "b", "c")
    runs = classes.groupBy("k", "up").agg(F.sort_array(F.collect_list(row)).alias("runs"))

    def alike(x: Column, y: Column) -> Column:
        p = (x["b"] + y["b"]) / (x["n"] + y["n"])
        return F.abs(x["b"] / x["n"] - y["b"] / y["n"]) <= z * F.sqrt(p * (1 - p) * (1 / x["n"] + 1 / y["n"]) + F.lit(1e-12))

    def pooled(x: Column, y: Column) -> Column:
        sums = [(x[c] + y[c]).alias(c) for c in ("n", "b", "c")]
        return F.struct(x["lo"].alias("lo"), y["hi"].alias("hi"), *sums, F.least(x["t"], y["t"]).alias("t"))

    def merge(done: Column, y: Column) -> Column:
        x = F.get(done, F.size(done) - 1)
        both = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(pooled(x, y)))
        return F.when((F.size(done) > 0) & alike(x, y), both).otherwise(F.concat(done, F.array(y)))

    def members(r: Column) -> Column:
        name = F.when(r["c"] == 1, r["t"]).otherwise(F.concat(r["t"], F.lit(" +"), r["c"] - 1))
        return F.transform(F.slice("runs", r["lo"], r["hi"] - r["lo"] + 1), lambda x: F.struct(x["scale"].alias("scale"), x["bin"].alias("bin"), name.alias("branch"), r["n"].alias("bn"), r["b"].alias("bb")))

    empty = F.array().cast("array<struct<lo:int,hi:int,n:bigint,b:bigint,c:bigint,t:string>>")
    placed = F.transform("runs", lambda x, i: F.struct((i + 1).alias("lo"), (i + 1).alias("hi"), x["n"].alias("n"), x["b"].alias("b"), x["c"].alias("c"), x["t"].alias("t")))
    named = runs.select("k", "up", F.explode(F.flatten(F.transform(F.aggregate(placed, empty, merge), members))).alias("r")).select("k", "up", "r.*")
    return told.join(named, ["k", "up", "scale", "bin"]).drop("scale", "bin")


def tree(spark: SparkSession, pages: DataFrame, labels: DataFrame, depth: int = DEPTH, z: float = Z, strength: float = STRENGTH, reject: float = REJECT, **more) -> DataFrame:
    """host, path, template, labelled, bad, purity, rejected of every distinct (host, path). pages: page_id, host, path;
    labels: page_id, bad (boolean); its repeated rows count each."""
    told = labels.filter(F.col("page_id").isNotNull() & F.col("bad").isNotNull()).groupBy("page_id").agg(F.count("*").alias("l"), F.sum(F.col("bad").cast("long")).alias("b"))
    paths = pages.join(told, "page_id", "left").groupBy("host", "path").agg(F.count("*").alias("n"), F.coalesce(F.sum("l"), F.lit(0)).alias("labelled"), F.coalesce(F.sum("b"), F.lit(0)).alias("bad"))
    scratch = shared.Scratch(spark, "url-tree")
    held = templates(scratch, paths, depth, **more)
    levels = F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"t{k}").alias("t"), (F.col(f"t{k - 1}") if k else F.lit("")).alias("up")) for k in range(depth + 1)))
    walks = scratch.save(held.select("host", "path", "labelled", "bad", F.explode(F.filter(levels, lambda x: x["t"].isNotNull())).alias("v")).select("host", "path", "labelled", "bad", "v.*"), "walks")
    nodes = scratch.save(walks.groupBy("k", "t", "up").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b")), "nodes")
    n_all, bad_all = nodes.filter("k = 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("b"), F.lit(0))).first()
    upper = nodes.select((F.col("k") + 1).alias("k"), F.col("t").alias("up"), F.col("n").alias("un"), F.col("b").alias("ub"))
    beside = nodes.join(upper, ["k", "up"], "left")
    un, ub = F.coalesce("un", F.lit(n_all)), F.coalesce("ub", F.lit(bad_all))
    rate = ub / F.greatest(un, F.lit(1))
    far = F.abs(F.col("b") / F.greatest(F.col("n"), F.lit(1)) - rate) > z * F.sqrt(rate * (1 - rate) / F.greatest(F.col("n"), F.lit(1)) + F.lit(1e-12))
    prior = F.lit(bad_all / max(n_all, 1))
    hosts = beside.filter("k = 0").select("k", "t", F.col("t").alias("branch"), F.col("n").alias("_n"), F.col("b").alias("_b"))
    apart = scratch.save(beside.filter((F.col("k") > 0) & (F.col("n") > 0) & far).select("k", "t", "up", "n", "b"), "apart")
    kept = hosts.unionByName(branches(apart, z).select("k", "t", "branch", F.col("bn").alias("_n"), F.col("bb").alias("_b")))
    kept = kept.withColumn("_purity", (F.col("_b") + strength * prior) / (F.col("_n") + strength))
    deepest = walks.select("host", "path", "k", "t").join(kept, ["k", "t"]).groupBy("host", "path").agg(F.max(F.struct("k", "branch", "_n", "_b", "_purity")).alias("v"))
    found = deepest.select("host", "path", F.col("v.branch").alias("template"), F.col("v._n").alias("labelled"), F.col("v._b").alias("bad"), F.round("v._purity", 12).alias("purity"), ((F.col("v._n") > 0) & (F.col("v._purity") >= reject)).alias("rejected"))
    found = scratch.save(found, "templates")
    scratch.keep("templates")
    return found


def judge(spark: SparkSession, pages: DataFrame, labels: DataFrame, rules=RULES, **more) -> DataFrame:
    """page_id, host, path, rule, verdict, template of every page."""
    host, path = parts(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = matched(F.col("host"), F.col("path"), rules)
    found = tree(spark, split, labels, **more)
    said = F.when(F.col("rejected"), "block").otherwise("allow")
    return split.join(found, ["host", "path"]).select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, said).alias("verdict"), "template")


def labels_of_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, bad: a page's path names its document by its first number, if that is one of 64 bits; that is bad if its quality is 0 or
    it is toxic."""
    _, path = parts(F.col("url"))
    named = pages.select("page_id", F.regexp_extract(path, "([0-9]+)", 1).alias("d")).select("page_id", F.col("d").try_cast("long").alias("doc_id")).filter("doc_id IS NOT NULL")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return named.join(labels.select("doc_id", F.coalesce(bad, F.lit(False)).alias("bad")), "doc_id").select("page_id", "bad")
