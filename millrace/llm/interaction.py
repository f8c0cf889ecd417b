"""Interaction audit of five filters by inclusion and exclusion.

One pass gives each document the five flags of the conditions that it fails. A flag of exact repeats needs the smallest doc_id of
its text; equal texts fail the other four alike, so their rows meet by digest as counts, with the smallest doc_id of each count.
For every part, the documents that fail all filters of a set are counted as the sum of the product of its flags, for all 32 sets
(J below). Everything else follows from J by Möbius inversion, without another look at a document:
survivors of the filters in M are the sum over S within M of (-1)^|S| J(S); what fails f alone is the sum over S that hold f of
(-1)^(|S|-1) J(S); the Harsanyi dividend of S in the game "documents removed by a coalition" is (-1)^(|S|+1) J(S), and the Shapley
value of f is the sum of the dividends of the sets that hold f, each shared equally.

Memory: the shuffles move a narrow row for each document (by doc_id, for its label), then counts for each distinct text; a
text that a third of the rows share is one row for each task there. Nothing of the texts but a digest moves.

Nulls: a null text is empty, a null lang is the empty part. A null doc_id is neither smaller nor larger than another, so such a
row doesn't fail the repeat condition and makes no other fail it. Of rows with the same doc_id and text none repeats the other by
itself. A doc_id with several labels is good or toxic if any of them says so; labels of other documents are ignored. Other columns are
ignored. Without documents there are no parts and no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared
from .quality import let

FILTERS = "ABCDE"
SETS = range(1 << len(FILTERS))
_WEIGHTS = ("n", "good", "toxic")


def failures(text: Column) -> dict[str, Column]:
    """The conditions of one text, as 0 or 1: few words, few distinct words, many capitals, symbols."""
    words = F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")
    counts = let(words, lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))
    n, distinct = counts["n"], counts["d"]
    return {
        "A": (n < 200).cast("long"),
        "B": (100 * distinct < 50 * n).cast("long"),
        "C": (100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.length(text)).cast("long"),
        "D": text.rlike("[#$%&*|]").cast("long"),
    }


def flagged(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts (n, good, toxic) by part and flags; several rows may have equal ones."""
    text = shared.whole_text()
    flags = failures(text)
    docs = documents.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), *[c.alias(f) for f, c in flags.items()])
    known = labels.groupBy("doc_id").agg(F.max((F.coalesce("quality", F.lit(0)) == 1).cast("long")).alias("good"), F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("long")).alias("toxic"))
    docs = docs.join(known, "doc_id", "left").withColumns({"good": F.coalesce("good", F.lit(0)), "toxic": F.coalesce("toxic", F.lit(0))})
    by_text = ["digest", "part", *flags, "good", "toxic"]
    rows = docs.groupBy("doc_id", *by_text).agg(F.count("*").alias("copies"))
    # of each kind of copy: its rows, the smallest doc_id with its rows, and the rows without a doc_id
    kinds = rows.groupBy(*by_text).agg(F.sum("copies").alias("copies"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "copies"))).alias("first"), F.sum(F.when(F.col("doc_id").isNull(), F.col("copies")).otherwise(0)).alias("unnamed"))
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    kept = F.col("unnamed") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.copies")).otherwise(0)
    kinds = kinds.withColumn("least", least).withColumn("kept", kept)
    both = kinds.select("part", *flags, "good", "toxic", F.explode(F.array(F.struct(F.lit(0).cast("long").alias("E"), F.col("kept").alias("n")), F.struct(F.lit(1).cast("long").alias("E"), (F.col("copies") - F.col("kept")).alias("n")))).alias("x"))
    n = F.col("x.n")
    return both.select("part", *flags, "x.E", n.alias("n"), (n * F.col("good")).alias("good"), (n * F.col("toxic")).alias("toxic"))


def joint(rows: DataFrame) -> DataFrame:
    """For each part, arrays of J(S) by the number of S (bit i is filter i), for all documents, good and toxic ones."""
    of = lambda s: [F.col(f) for i, f in enumerate(FILTERS) if s >> i & 1]
    sums = [F.sum(reduce(lambda a, b: a * b, of(s), F.col(w))).alias(f"{w}{s}") for w in _WEIGHTS for s in SETS]
    return rows.groupBy("part").agg(*sums).select("part", *[F.array(*[f"{w}{s}" for s in SETS]).alias(w) for w in _WEIGHTS])


def _sign(s: Column) -> Column:
    return F.when(F.bit_count(s) % 2 == 0, F.lit(1)).otherwise(F.lit(-1)).cast("long")


def _over_sets(j: Column, term) -> Column:
    """The sum of term(S, J(S)) over all sets."""
    return F.aggregate(F.sequence(F.lit(0), F.lit(SETS[-1])), F.lit(0).cast("long"), lambda a, s: a + term(s, F.get(j, s)))


def _survivors(j: Column) -> Column:
    """By the number of M: documents that no filter of M removes."""
    return F.transform(F.sequence(F.lit(0), F.lit(SETS[-1])), lambda m: _over_sets(j, lambda s, x: F.when(s.bitwiseAND(m) == s, _sign(s) * x).otherwise(F.lit(0).cast("long"))))


def _shapley(j: Column, orders: int) -> Column:
    """By filter: its Shapley value times the number of orders, which every size of a set divides."""
    dividend = lambda s, x: -_sign(s) * x * (F.lit(orders) / F.greatest(F.bit_count(s), F.lit(1))).cast("long")
    return F.transform(F.sequence(F.lit(0), F.lit(len(FILTERS) - 1)), lambda f: _over_sets(j, lambda s, x: F.when(F.getbit(s, f) == 1, dividend(s, x)).otherwise(F.lit(0).cast("long"))))


def _alone(j: Column) -> Column:
    """By filter: documents that fail it only."""
    return F.transform(F.sequence(F.lit(0), F.lit(len(FILTERS) - 1)), lambda f: _over_sets(j, lambda s, x: F.when(F.getbit(s, f) == 1, -_sign(s) * x).otherwise(F.lit(0).cast("long"))))


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    j = joint(flagged(documents, labels))
    made = j.select("part", F.col("n").alias("j"), *[_survivors(F.col(w)).alias(f"left_{w}") for w in _WEIGHTS], _alone(F.col("n")).alias("alone"), _shapley(F.col("n"), len(orders)).alias("shapley"))
    steps = made.withColumn("filter_order", F.explode(F.array(*map(F.lit, orders)))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    steps = steps.withColumn("set", F.split("filter_order", "")).withColumn("set", F.transform("set", lambda x: F.element_at(F.create_map(*[F.lit(v) for i, f in enumerate(FILTERS) for v in (f, i)]), x)))
    sum_of = lambda k: F.aggregate(F.slice("set", F.lit(1), k), F.lit(0), lambda m, f: m + F.pow(F.lit(2), f).cast("int"))
    steps = steps.withColumns({"before": sum_of(F.col("step") - 1), "after": sum_of(F.col("step")), "f": F.get("set", F.col("step") - 1)})
    left = lambda w, m: F.get(f"left_{w}", F.col(m))
    removed = left("n", "before") - left("n", "after")
    return steps.select(
        "part",
        "filter_order",
        "step",
        left("n", "after").alias("kept"),
        removed.alias("removed"),
        (F.get("j", F.pow(F.lit(2), F.col("f")).cast("int")) - removed).alias("redundant"),
        F.get("alone", F.col("f")).alias("unique_fails"),
        (left("good", "before") - left("good", "after")).alias("good_lost"),
        (left("toxic", "before") - left("toxic", "after")).alias("toxic_lost"),
        F.get("shapley", F.col("f")).alias("shapley"),
    )
