"""Quality rules: a learned decision list over statistics of the text, as Spark conditional expressions.

Statistics and verdicts are built-in expressions of the one text, so nothing is shuffled, and a long or odd text costs
its own task only. The list is learned by sequential covering from a bounded sample of labelled rows (`sample`, the
rows whose hashed doc_id is smallest): a rule grows by threshold conditions while its FOIL gain is positive, is pruned on
rows held back, and stays if it still is precise; what it covers is set aside, and the next rule is grown.

Nulls: a null text has no words (and fails the base rules); labels with a null id or quality are left out; a label's
repeated rows count each. Without labels of both kinds no rule is learned, and the base rules decide alone. Repeated
documents are judged alike. All columns pass through keep(); names that clash are no matter, as nothing is added.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 4096
_SPACE = " \\t-\\r"  # within a character class: U+0020 and U+0009 to U+000D

#: What conditions may test: all are ratios or sizes made from statistics.
FEATURES = {
    "n_words": lambda s: s["n_words"].cast("double"),
    "mean_word": lambda s: s["word_chars"] / F.greatest(s["n_words"], F.lit(1)),
    "symbols_per_word": lambda s: s["n_symbols"] / F.greatest(s["n_words"], F.lit(1)),
    "upper_share": lambda s: s["n_upper"] / F.greatest(s["word_chars"], F.lit(1)),
    "digit_share": lambda s: s["n_digits"] / F.greatest(s["word_chars"], F.lit(1)),
    "marks_per_word": lambda s: s["n_marks"] / F.greatest(s["n_words"], F.lit(1)),
    "stops_per_word": lambda s: s["n_stops"] / F.greatest(s["n_words"], F.lit(1)),
    "dup_line_share": lambda s: s["n_dup_lines"] / F.greatest(s["n_lines"], F.lit(1)),
    "repeat_share": lambda s: s["n_repeat_words"] / F.greatest(s["n_words"], F.lit(1)),
    "distinct_share": lambda s: s["n_distinct"] / F.greatest(s["n_words"], F.lit(1)),
}


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, wherever the optimizer moves the expression."""
    return F.transform(F.array(value), body)[0]


def _repeated(words: Column) -> Column:
    """Words that lie in a window of three words that occurs twice or more."""

    def covered(at: Column) -> Column:  # ascending starts of such windows
        steps = F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.try_element_at(at, k + 2) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def starts(sorted_: Column) -> Column:
        same = lambda x, k: (k > 0) & (F.get(sorted_, k - 1)["h"] == x["h"]) | F.coalesce(F.get(sorted_, k + 1)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(sorted_, same), lambda x: x["i"]))

    def all_(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        found = let(let(pairs, starts), covered)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(found)

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(let(windows, all_))


def statistics(text: Column) -> Column:
    """A struct of counts of the whole text."""
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")

    def of(x: Column) -> Column:
        words, lines = x["words"], x["lines"]
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
            count("[#*$%&|<>]").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeated(words).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
            count("[A-Z]").alias("n_upper"),
            count("[0-9]").alias("n_digits"),
            count("[!?]").alias("n_marks"),
            count("[.,;:]").alias("n_stops"),
        )

    parts = F.struct(
        F.filter(F.split(text, f"[{_SPACE}]+"), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda s: s.rlike(f"[^{_SPACE}]")).alias("lines"),
    )
    return let(parts, of)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"

    def covers(self, row: dict) -> bool:
        return (row[self.feature] >= self.threshold) == self.above

    def column(self, s: Column) -> Column:
        x = FEATURES[self.feature](s)
        return x >= self.threshold if self.above else x < self.threshold


def _covered(rule: list[Condition], rows: list[dict]) -> list[dict]:
    return [x for x in rows if all(c.covers(x) for c in rule)]


def _counts(rows: list[dict]) -> tuple[int, int]:
    bad = sum(x["bad"] for x in rows)
    return bad, len(rows) - bad


def _best(rows: list[dict]) -> tuple[float, Condition | None]:
    """The condition of the highest FOIL gain on rows, by a sweep over each feature's sorted values."""
    p, n = _counts(rows)
    best: tuple[float, Condition | None] = (0.0, None)
    if not p or not n:
        return best
    before = math.log2(p / (p + n))
    for name in FEATURES:
        order = sorted(rows, key=lambda x, name=name: x[name])
        below_p = below_n = 0
        for x, y in zip(order, order[1:], strict=False):
            below_p, below_n = below_p + x["bad"], below_n + 1 - x["bad"]
            if x[name] == y[name]:
                continue
            for above, a, b in ((False, below_p, below_n), (True, p - below_p, n - below_n)):
                if a and (gain := a * (math.log2(a / (a + b)) - before)) > best[0] + 1e-9:
                    best = (gain, Condition(name, above, (x[name] + y[name]) / 2))
    return best


def learn(rows: list[dict], min_precision: float = 0.9, min_rows: int = 8, most: int = 16, conditions: int = 5) -> list[list[Condition]]:
    """Rules for the rows with bad = 1, in order. rows: features, bad (0 or 1), hold (True: kept for pruning)."""
    rules: list[list[Condition]] = []
    left = list(rows)
    while len(rules) < most:
        grow, hold = [x for x in left if not x["hold"]], [x for x in left if x["hold"]]
        rule: list[Condition] = []
        inside = grow
        while len(rule) < conditions:
            gain, found = _best(inside)
            if found is None:
                break
            rule.append(found)
            inside = _covered([found], inside)
        worth = []  # (p - n) / (p + n) on the rows held back, of each shorter form
        for k in range(1, len(rule) + 1):
            p, n = _counts(_covered(rule[:k], hold))
            worth.append(((p - n) / (p + n) if p + n else -1, -k))
        if not worth:
            break
        rule = rule[: -max(worth)[1]]
        hit = _covered(rule, left)
        p, n = _counts(hit)
        hp, hn = _counts(_covered(rule, hold))
        if p < min_rows or p / (p + n) < min_precision or not hp or hp / (hp + hn) < min_precision:
            break
        rules.append(rule)
        left = [x for x in left if not all(c.covers(x) for c in rule)]
    return rules


def sample_rows(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[dict]:
    """Features of at most `sample` labelled documents; the labels' bound lets the join broadcast them."""
    usable = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_quality")).dropna()
    few = usable.orderBy(F.xxhash64("_id"), "_id", "_quality").limit(sample)
    stats = statistics(F.coalesce(F.col("text"), F.lit("")))
    made = let(stats, lambda s: F.struct(base_failed(s).alias("base"), *(f(s).alias(k) for k, f in FEATURES.items())))
    rows = documents.select("doc_id", "text").join(F.broadcast(few), F.col("doc_id") == F.col("_id")).select("_id", "_quality", made.alias("s"), F.pmod(F.xxhash64("_id", F.lit(7)), F.lit(3)).alias("third"))
    found = rows.limit(4 * sample).collect()  # more only if documents repeat their ids
    found.sort(key=lambda x: (x["_id"], x["_quality"]))
    return [{**x["s"].asDict(), "bad": int(x["_quality"] == 0), "hold": x["third"] == 0} for x in found if not x["s"]["base"]]


def verdict(rules: list[list[Condition]], s: Column) -> Column:
    """True to keep: the rules in order, then the default."""
    out = F.when(F.lit(False), F.lit(False))
    for rule in rules:
        test = rule[0].column(s)
        for c in rule[1:]:
            test = test & c.column(s)
        out = out.when(test, F.lit(False))
    return out.otherwise(F.lit(True))


def judge(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, the statistics, base_failed, kept."""
    rules = learn(sample_rows(documents, labels, sample))
    judged = let(
        statistics(F.coalesce(F.col("text"), F.lit(""))),
        lambda s: F.struct(s.alias("s"), base_failed(s).alias("base_failed"), (~base_failed(s) & verdict(rules, s)).alias("kept")),
    )
    found = documents.select("doc_id", judged.alias("j"))
    return found.select("doc_id", "j.s.*", "j.base_failed", "j.kept")


def keep(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of documents that neither the base rules nor the learned list reject."""
    rules = learn(sample_rows(documents, labels, sample))
    kept = let(statistics(F.coalesce(F.col("text"), F.lit(""))), lambda s: ~base_failed(s) & verdict(rules, s))
    return documents.filter(kept)
