"""Phrases, mixing and the filter audit against brute-force versions, with odd rows."""

import math
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from millrace.llm import interaction, mixing, phrases, shared

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(900, "Ta ta.ta, ta ta\tta  ta ta! \x1c É é", None, None, 0, 1, "x"), (901, "", "", "s", 0, 1, "x"), (902, "ta ta " * 40, "", None, 0, 1, "x"), (None, "ta ta " * 40, None, "t", 0, 1, "x")]


@pytest.fixture(scope="module")
def odd_rows(rows):
    return [*rows, *ODD, ODD[0]]


@pytest.fixture(scope="module")
def odd(spark, odd_rows, documents):
    return spark.createDataFrame(odd_rows, documents.schema).repartition(3)


def brute_phrases(rows, least, longest, top, within):
    counts, words = defaultdict(Counter), Counter()
    for r in rows:
        lang = "und" if r[2] is None else r[2]
        text = re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, of in counts.items():
        f = {g: c for g, c in of.items() if c >= least}
        found = []
        for g, a in f.items():
            if len(g) > 1:
                score, cut = min((1000 * a * words[lang] // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
                holds = lambda x, g=g: any(x[i : i + len(g)] == g for i in range(len(x) - len(g) + 1))
                if not any(len(x) > len(g) and 100 * c >= within * a and holds(x) for x, c in f.items()):
                    found.append((-score, -a, " ".join(g).encode(), f[g[:cut]], f[g[cut:]]))
        out += [(lang, i, p.decode(), -a, left, right, words[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize(("least", "within", "top", "block"), [(2, 100, 2000, 4_000_000), (3, 80, 7, 50)])
def test_phrases(spark, odd, odd_rows, monkeypatch, least, within, top, block):
    if block == 50:  # blocks of some words, cut within texts
        monkeypatch.setattr(phrases, "CHUNK", 300)
    some, rows = odd.filter("doc_id is null or doc_id <> 3"), [r for r in odd_rows if r[0] != 3]
    got = phrases.collocations(spark, some, least=least, within=within, top=top, block=block)
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, least, 5, top, within)


def test_phrases_of_nothing(spark, empty, odd):
    assert phrases.collocations(spark, empty).count() == 0
    assert phrases.collocations(spark, odd, least=10**6).count() == 0


def test_blocks_hold_whole_pieces(monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK", 10)
    text = b"one two three four. five six seven\neight, nine ten eleven twelve"
    parts = list(phrases._parts(text))
    assert len(parts) > 1
    whole = [w for p in parts for w in p if w]
    assert whole == text.replace(b".", b" \xff ").replace(b",", b" \xff ").replace(b"\n", b" \xff ").split()


@pytest.mark.parametrize("k", [2, 3, 4, 5])
def test_distinct_grams_beyond_one_number(k):
    import numpy as np

    r = np.random.default_rng(k)
    ids = r.integers(0, 4, 3000).astype(np.int32) + np.int32(2_000_000)
    at, n = phrases._distinct(ids, np.arange(len(ids) - k + 1), k, 2_100_000)
    assert {tuple(ids[a : a + k].tolist()): c for a, c in zip(at, n.tolist(), strict=True)} == Counter(tuple(ids[i : i + k].tolist()) for i in range(len(ids) - k + 1))


def test_bit_table_only_prunes(spark, odd, odd_rows, monkeypatch):
    """With two bits for everything all grams look frequent, and the result is the same."""
    monkeypatch.setattr(phrases, "LEAST_BITS", 6)
    monkeypatch.setattr(phrases, "MOST_BITS", 6)
    some, rows = odd.filter("doc_id is null or doc_id <> 3"), [r for r in odd_rows if r[0] != 3]
    got = phrases.collocations(spark, some, least=3)
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, 3, 5, 2000, 100)


def test_levels_are_tables(spark, odd):
    frequent, totals = phrases.levels(spark, odd, shared.Scratch(spark, "test"), least=2)
    assert {r["k"] for r in frequent.select("k").distinct().collect()} == {1, 2, 3, 4, 5}
    assert totals.filter("lang = 'und'").first()["n"] > 0


def brute_targets(sizes, weights=(3, 1, 2), most=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = {}, 1.5 * sum(sizes.values()), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > most * sizes[s]}
        for s in over or free:
            target[s] = most * sizes[s] if over else weight[s] * level
        left -= sum(target[s] for s in over)
        free -= over or free
    return target


def test_mixing(spark, odd, odd_rows):
    more = [(2000 + i, " ".join(["w"] * (i % 90)), "en", f"s{i % 7}" if i % 3 else "big", 0, 1, "x") for i in range(3000)]
    table = odd.unionByName(spark.createDataFrame(more, odd.schema))
    mixed = mixing.mix(spark, table, block_words=500, shard_words=20_000, bucket_rows=64).cache()
    got = mixing.taken(mixed).collect()
    rows = [*odd_rows, *more]
    size_of = lambda t: len(WORD.findall(t or ""))
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((r[0], r[3], size_of(r[1])) for r in rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size_of(r[1])
    target, words, longest = brute_targets(sizes), Counter(), Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        words[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    for s in sizes:
        assert abs(words[s] - target[s]) <= longest[s] / 2 + 1e-6
    # shards: every place once, each shard about as long as the others, sources spread as their quotas are
    of = mixed.filter("shard is not null").collect()
    by = defaultdict(list)
    for r in of:
        by[r["shard"]].append(r)
    assert len(by) == math.ceil(sum(r["quota"] for r in mixing.passes(mixing.targets(mixing.sized(table)), 500).collect()) * 500 / 20_000)
    for shard in by.values():
        assert sorted(r["position"] for r in shard) == list(range(len(shard)))
    assert Counter((r["rank"], r["bucket"], r["place"], r["pass"]) for r in of).most_common(1)[0][1] == 1
    again = mixing.mix(spark, table.repartition(5), block_words=500, shard_words=20_000, bucket_rows=64)
    named = lambda rows: Counter((r["doc_id"], r["key"], r["pass"], r["shard"]) for r in rows)
    assert named(again.filter("shard is not null").collect()) == named(of)
    mixed.unpersist()


def test_mixing_tree(spark):
    """Sums of sources and shards are exact; over many seeds the quotas have the mean and spread of a multivariate hypergeometric draw."""
    quotas = [(0, 40), (1, 7), (2, 0), (3, 53)]
    table = spark.createDataFrame(quotas, "rank long, quota long")
    first = []
    for seed in range(40):
        got = mixing.tree(table, 5, f"s{seed}").collect()
        shards, sources = Counter(), Counter()
        for r in got:
            shards[r["shard"]] += r["q"]
            sources[r["rank"]] += r["q"]
            assert r["q"] > 0
        assert sources == {k: q for k, q in quotas if q}
        assert sorted(shards.values()) == [20] * 5
        first += [next((r["q"] for r in got if r["shard"] == s and r["rank"] == 0), 0) for s in range(5)]
    mean = sum(first) / len(first)
    var = sum((x - mean) ** 2 for x in first) / len(first)
    assert mean == pytest.approx(8)
    assert 2.9 < var < 5.1  # 20 * 0.4 * 0.6 * 80 / 99 = 3.88


def test_hypergeometric(spark):
    """The inverse of the distribution at evenly spread points, for lopsided and large counts."""
    for q, rest, n in [(5, 0, 3), (0, 9, 4), (3, 7, 5), (10, 2, 6), (4000, 6000, 5000), (1, 10**6, 10)]:
        points = spark.range(200).select(mixing._hypergeometric((F.col("id") + 0.5) / 200, *[F.lit(x).cast("long") for x in (q, rest, n)]).alias("k"))
        got = [r["k"] for r in points.collect()]
        log = lambda k, q=q, rest=rest, n=n: math.lgamma(q + 1) - math.lgamma(k + 1) - math.lgamma(q - k + 1) + math.lgamma(rest + 1) - math.lgamma(n - k + 1) - math.lgamma(rest - n + k + 1)
        ks = range(max(0, n - rest), min(q, n) + 1)
        p = [math.exp(log(k) - (math.lgamma(q + rest + 1) - math.lgamma(n + 1) - math.lgamma(q + rest - n + 1))) for k in ks]
        want, at, done = [], 0, p[0]
        for i in range(200):
            while done <= (i + 0.5) / 200 and at + 1 < len(ks):
                at += 1
                done += p[at]
            want.append(ks[at])
        assert sum(a != b for a, b in zip(got, want, strict=True)) <= 1


def test_mixing_writes_shards(spark, odd, tmp_path):
    mixed = mixing.mix(spark, odd, block_words=200, shard_words=5_000, bucket_rows=8)
    mixing.write(odd, mixed, str(tmp_path / "out"))
    files = spark.read.parquet(str(tmp_path / "out"))
    want = mixed.filter("shard is not null").groupBy("shard").agg(F.count("*").alias("n"), F.sum("size").alias("w"))
    got = files.groupBy("shard").agg(F.count("*").alias("n"), F.sum(F.regexp_count("text", F.lit("[^ \\t-\\r]+"))).alias("w"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_mixing_of_nothing(spark, empty):
    assert mixing.taken(mixing.mix(spark, empty)).count() == 0
    blank = empty.sparkSession.createDataFrame([(1, None, "en", None, 0, 1, "x"), (2, "", "en", "a", 0, 1, "x")], empty.schema)
    assert [(r["size"], r["target"], r["taken"]) for r in mixing.taken(mixing.mix(spark, blank)).collect()] == [(0, 0.0, 0)] * 2


def brute_audit(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for r in rows:
        if r[0] is not None:
            least[r[1] or ""] = min(least.get(r[1] or "", r[0]), r[0])
    docs = []
    for r in rows:
        text = r[1] or ""
        w = WORD.findall(text)
        fails = "".join(
            f
            for f, x in zip("ABCDE", (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), re.search("[#$%&*|]", text), r[0] is not None and r[0] > least[text]), strict=True)
            if x
        )
        docs.append((r[2] or "", fails, r[0] in good, r[0] in toxic))
    out, shapley = [], Counter()
    for part in {d[0] for d in docs}:
        for order in map("".join, permutations("ABCDE")):
            left = [d for d in docs if d[0] == part]
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                failing = [d for d in docs if d[0] == part and f in d[1]]
                shapley[part, f] += len(gone)
                out.append((part, order, step, len(left), len(gone), len(failing) - len(gone), sum(d[1] == f for d in failing), sum(d[2] for d in gone), sum(d[3] for d in gone)))
    return sorted((*x, shapley[x[0], x[1][x[2] - 1]]) for x in out)


def test_filter_audit(spark, odd, odd_rows):
    labels = [(4, 1, 0), (5, 1, 1), (5, 0, None), (902, None, 1), (None, 1, 1), (9, 1, 1), (77_777, 1, 1), (20, 1, 0)]
    more = [(3000 + i, "A# " * i, "fr", "s", 0, 1, "x") for i in range(9)]
    table = odd.unionByName(spark.createDataFrame(more, odd.schema))
    got = interaction.audit(table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert sorted(map(tuple, got.collect())) == brute_audit([*odd_rows, *more], labels)


def test_filter_audit_of_nothing(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interaction.audit(empty, labels).count() == 0


def test_joint_failures_are_sums_of_products(spark):
    rows = spark.createDataFrame([("p", 1, 0, 1, 0, 1, 5, 2, 1), ("p", 1, 1, 0, 0, 0, 7, 0, 0)], "part string, A long, B long, C long, D long, E long, n long, good long, toxic long")
    j = interaction.joint(rows).first()
    assert j["n"][0] == 12
    assert j["n"][0b00001] == 12
    assert j["n"][0b10101] == 5
    assert j["n"][0b00011] == 7
    assert j["good"][0b00100] == 2
    assert j["toxic"][0b10000] == 1
