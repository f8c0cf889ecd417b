"""Filters, dedup, scoring and formatting against brute-force versions on small rows with odd cases."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from millrace.llm import decontaminate, line_dedup, near_dedup, preference, quality, suffix_tree_lm, url_filter

from .conftest import SCHEMA, prose

SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return SPACES.findall(lower(text))


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


@pytest.fixture(scope="module")
def bench(spark, rows):
    texts = {r[0]: r[1] for r in rows}
    long = " ".join(texts[3].split()[5000:5040])
    items = [(1, long), (2, long.upper()), (3, "東京 é"), (4, None), (5, ""), (6, " ".join(texts[20].split()[3:18])), (7, "nothing of this occurs anywhere in those rows at all ever"), (1, long), (None, "a b")]
    return spark.createDataFrame(items, "item_id long, text string")


def brute_contamination(rows, items, window=10):
    grams = defaultdict(set)
    for item, text in items:
        w = bench_words(text)
        k = min(window, len(w))
        for i in range(len(w) - k + 1) if w else ():
            grams[tuple(w[i : i + k])].add("null" if item is None else str(item))
    out = Counter()
    for r in rows:
        w, hit, found = bench_words(r[1]), set(), set()
        for k in {len(g) for g in grams}:
            for i in range(len(w) - k + 1):
                if got := grams.get(tuple(w[i : i + k])):
                    hit |= set(range(i, i + k))
                    found |= got
        out[(r[0], len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))] += 1
    return out


@pytest.mark.parametrize("most", [10_000, 30])  # one automaton, and several in turn
def test_contamination(spark, documents, rows, bench, most):
    got = decontaminate.contamination(spark, documents, bench, max_words=most).collect()
    assert Counter(map(tuple, got)) == brute_contamination(rows, [tuple(x) for x in bench.collect()])


def test_remove_spans(spark, documents, empty, bench):
    got = decontaminate.remove_spans(spark, documents, bench)
    assert got.columns == documents.columns
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert 2 not in texts and texts[8] == prose(1, 80) and texts[0] is None
    assert len(bench_words(texts[3])) == 30_000 - 40
    assert decontaminate.without("One two, three! four", [[1, 3]]) == "One ! four"
    assert decontaminate.remove_spans(spark, empty, bench).count() == 0
    assert decontaminate.contamination(spark, documents, bench.limit(0)).filter("contaminated").count() == 0


def test_quality(spark, documents, rows, empty):
    junk = [(1000 + i, " ".join(w + "###" for w in prose(500 + i, 90).split(" ")), "en", "s", 1, 1, "x") for i in range(60)]
    good = [(2000 + i, prose(700 + i, 90), "en", "s", 1, 1, "x") for i in range(120)]
    docs = documents.unionByName(spark.createDataFrame(junk + good, SCHEMA))
    labels = spark.createDataFrame([(i, int(i >= 2000), 0) for i, *_ in junk[:50] + good[:100]] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.judge(docs, labels).collect()}
    assert all(not got[r[0]]["kept"] for r in junk) and all(got[r[0]]["kept"] for r in good)
    for r in [*rows, *junk[:3], *good[:3]]:
        w, text, g = SPACES.findall(r[1] or ""), r[1] or "", got[r[0]]
        tri = Counter(zip(w, w[1:], w[2:], strict=False))
        hit = {k for i, t in enumerate(zip(w, w[1:], w[2:], strict=False)) if tri[t] > 1 for k in (i, i + 1, i + 2)}
        lines = [x for x in text.split("\n") if SPACES.search(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))
        assert tuple(g[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert g["base_failed"] == (len(w) < 50 or 100 * len(hit) > 50 * len(w))
    kept = quality.keep(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {k for k, r in got.items() if r["kept"]}
    assert quality.judge(empty, labels).count() == 0 and quality.judge(documents, labels.limit(0)).count() == len(rows)


def brute_groups(texts):
    sets = {}
    for i, t in texts.items():
        w = words(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def test_near_dedup(spark, documents, rows, empty):
    plain = documents.filter("doc_id IS NOT NULL")
    got = near_dedup.groups(spark, plain, 5).collect()
    want = brute_groups({r[0]: r[1] for r in rows if r[0] is not None})
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert len(got) == plain.count() and all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    odd = {r["doc_id"]: r["component_id"] for r in near_dedup.groups(spark, documents, 5).collect()}
    assert odd[None] == odd[23]
    kept = near_dedup.keep(spark, plain)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, (_, c) in want.items() if i == c}
    assert near_dedup.groups(spark, empty).count() == 0


def test_pairs_at_the_threshold_meet():
    """Of 20,000 pairs of sets at a resemblance of 0.75 none is lost by the signatures."""
    import numpy as np

    r = np.random.default_rng(5)
    pool = [r.integers(0, 2**63, 40, dtype=np.uint64) for _ in range(20_000)]  # 30 in both, 5 in each alone
    a, b = near_dedup._signatures([x[:35] for x in pool]), near_dedup._signatures([np.concatenate((x[:30], x[35:])) for x in pool])
    unlike = (a.view(np.uint16) != b.view(np.uint16)).reshape(len(pool), -1, 4).sum(2)
    assert ((unlike.min(1) <= 1) & (unlike.sum(1) <= near_dedup.DISTANCE)).all()


def test_large_group_of_near_copies(spark):
    """Edits so many that many pairs are below the threshold: components are still those of all pairs."""
    from .conftest import edited

    base = prose(7, 150, 10**6)
    texts = {i: edited(base, i, 0.05) for i in range(120)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.groups(spark, docs).collect()}
    assert got == brute_groups(texts)


def test_line_dedup(spark, documents, rows, empty):
    got = line_dedup.dedup(spark, documents)
    assert got.columns == [*documents.columns, "_n_lines", "_n_removed"]
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert texts[0] is None and texts[1] == "" and texts[2] == "a b" and texts[None] == prose(3, 80)
    assert texts[4] == prose(0, 80) and texts[5] == "" and texts[8] == "" and texts[7] == prose(1, 80).upper() and texts[20] == ""
    assert texts[3] == prose(99, 30_000)
    kept = {r["doc_id"] for r in line_dedup.keep(spark, documents).collect()}
    assert {0, 1, 2, 3, 4, 7, 10} <= kept and not {5, 8, 20} & kept
    assert line_dedup.dedup(spark, empty).count() == 0


def test_near_dedup_keeps_rows_not_ids(spark):
    """Ids that repeat with other texts, null ids, clashing names: no text is lost, and no copy stays."""
    a, u, v, w = prose(31, 60), prose(32, 60), prose(33, 60), prose(34, 60)
    rows = [(1, a), (None, a), (5, u), (9, u), (5, a), (None, v), (None, w), (7, v), (8, None), (8, None), (3, w), (3, w)]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, _doc string, node string")
    kept = near_dedup.keep(spark, docs)
    assert kept.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter([(1, a), (5, u), (7, v), (8, None), (8, None), (3, w)])


def test_pairs_are_made_once(spark):
    """Of the keys that two signatures have in common, exactly one is the earliest; without a common key none is."""
    import numpy as np
    from pyspark.sql import functions as F

    r = np.random.default_rng(2)
    x = r.integers(0, 2**16, (150, 48)).astype(np.uint16)
    y = np.where(r.random((150, 48)) < r.random((150, 1)), x, r.integers(0, 2**16, (150, 48)).astype(np.uint16))
    side = lambda v: spark.createDataFrame(list(enumerate(np.ascontiguousarray(v).view(np.int64).tolist())), "node int, s array<long>")
    both = []
    for name, v in (("a", x), ("b", y)):
        table = side(v)
        both.append(near_dedup.index_keys(table).join(table, "node").select("node", F.col("keys").alias(f"k{name}"), F.col("s").alias(name)))
    common = both[0].join(both[1], "node").select("node", "a", "b", F.explode_outer(F.array_intersect("ka", "kb")).alias("key"))
    told = common.groupBy("node").agg(F.count("key").alias("keys"), F.count_if(near_dedup.earliest(F.col("key"), F.col("a"), F.col("b"))).alias("n")).collect()
    assert all(t["n"] == (t["keys"] > 0) for t in told)
    assert {t["keys"] > 1 for t in told} == {True, False}


def test_signature_distance(spark):
    """The distance by carries is the number of 16-bit values that differ."""
    import numpy as np

    r = np.random.default_rng(1)
    x = r.integers(0, 3, (200, 48)).astype(np.uint16) * 0x5555
    y = np.where(r.random((200, 48)) < 0.5, x, r.integers(0, 2**16, (200, 48))).astype(np.uint16)
    x[0], y[0] = 0, 0xFFFF
    rows = list(zip(x.view(np.int64).tolist(), y.view(np.int64).tolist(), (x != y).sum(1).tolist(), strict=True))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>, n int")
    from pyspark.sql import functions as F

    assert df.filter(near_dedup.distance(F.col("a"), F.col("b")) != F.col("n")).count() == 0


def line_norm(line):
    return re.sub(r"[\W_]+", " ", line.lower()).strip()


def brute_lines(rows):
    """{row number: text} by comparing all lines: of each group of alike lines the first stays."""
    places = [(i, k) for i, (_, t) in sorted(enumerate(rows), key=lambda x: (x[1][0] is not None, x[1][0] or 0)) for k in range(len((t or "").split("\n")))]
    norm = {(i, k): line_norm((rows[i][1] or "").split("\n")[k]) for i, k in places}
    texts = sorted({n for n in norm.values() if n})
    up = {n: n for n in texts}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for x in texts:
        for y in texts:
            if x < y and min(len(x), len(y)) >= line_dedup.MIN_CHARS and min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and root(x) != root(y) and levenshtein(x, y) <= 0.2 * max(len(x), len(y)) + 1e-9:
                up[root(y)] = root(x)
    seen, out = set(), {}
    for i, k in places:
        n = norm[i, k]
        if not n or root(n) not in seen:
            out.setdefault(i, []).append((rows[i][1] or "").split("\n")[k])
        if n:
            seen.add(root(n))
    return {i: "\n".join(out.get(i, [])) if t is not None else None for i, (_, t) in enumerate(rows)}


def test_fuzzy_lines(spark):
    """Texts of several lines with words changed, lost and put in, against a comparison of all lines with all."""
    import random

    r, rows = random.Random(8), []
    for i in range(30):
        lines = prose(600 + i, 40, 9 + i % 5).split("\n")
        rows.append((2 * i, "\n".join(lines)))
        for k, x in enumerate(lines):
            w = x.split(" ")
            at = r.randrange(len(w))
            w[at : at + 1] = [["changed"], [], [w[at], "put"], [w[at][:-1] + "q"]][k % 4]
            lines[k] = " ".join(w)
        rows.append((2 * i + 1, "\n".join([*lines, f"short {i % 3}", "---", ""])))
    rows += [(None, "a line of its own in a row without an id\nshort 1"), (100, None), (101, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r["doc_id"]): r["text"] for r in line_dedup.report(spark, docs).collect()}
    want = brute_lines(rows)
    assert got == {rows[i][0]: t for i, t in want.items()}


def test_line_removal_by_row(spark):
    """Ids that repeat with other texts, null ids, rows that repeat, and columns with the names used inside."""
    x, y = "some line that two of the rows have in common", "another line that only a single row of all has"
    rows = [(7, x + "\nfirst of seven is this one"), (7, y + "\n" + x), (None, "one row without an id at all, truly"), (None, x + "\nthe other row without an id"), (8, "twice the same row\nreally"), (8, "twice the same row\nreally")]
    docs = spark.createDataFrame([(i, t, "d", "g") for i, t in rows], "doc_id long, text string, _doc string, _gone string")
    got = line_dedup.dedup(spark, docs)
    assert got.columns == [*docs.columns, "_n_lines", "_n_removed"]
    texts = Counter(r["text"] for r in got.collect())
    assert sum(t.count(x) for t in texts.elements()) == 1 and sum(t.count(y) for t in texts.elements()) == 1
    assert texts["twice the same row\nreally"] == 1 and texts[""] == 1
    for line in ("first of seven is this one", "one row without an id at all, truly", "the other row without an id"):
        assert sum(line in t for t in texts.elements()) == 1
    assert line_dedup.keep(spark, docs).columns == docs.columns


def test_line_recall(spark):
    """Real lines with a word or a letter changed meet and are linked in at least nine of ten cases."""
    import random

    from pyspark.sql import functions as F

    r = random.Random(4)
    lines = sorted({line_norm(x) for (t,) in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect() for x in (t or "").split("\n")})
    lines = [x for x in lines if 16 <= len(x) <= 3000]
    pairs = []
    for x in lines:
        w = x.split(" ")
        at = r.randrange(len(w))
        for changed in ("zebra", w[at][:-1] + ("q" if w[at][-1] != "q" else "z")):
            y = " ".join([*w[:at], changed, *w[at + 1 :]])
            if levenshtein(x, y, 0.2 * max(len(x), len(y))) <= 0.2 * max(len(x), len(y)):
                pairs.append((len(pairs), x, y))
    df = spark.createDataFrame(pairs, "i long, x string, y string")
    keys = lambda c: line_dedup.occurrences(df.select(F.col("i").alias("doc_id"), F.col(c).alias("text"))).select("doc_id", F.explode("keys").alias("k"))
    met = keys("x").join(keys("y"), ["doc_id", "k"]).select("doc_id").distinct().count()
    assert len(pairs) > 500 and met >= 0.97 * len(pairs)
    assert df.filter(~line_dedup.similar(F.col("x"), F.col("y"))).count() == 0


def test_lines_with_words_changed_on_each_side_meet(spark):
    """A word on each side of 8 to 14, two on each side of 18 to 30, all pairs with an edit similarity of 0.8: nine in ten share a key."""
    import random

    r = random.Random(5)
    letters = "abcdefghijklmnoprstuvyz"
    words = ["".join(r.choice(letters) for _ in range(r.randint(2, 9))) for _ in range(3000)]
    often = [1 / (i + 5) for i in range(3000)]

    def pairs(least, most, each):
        out = []
        while len(out) < 150:
            w = r.choices(words, often, k=r.randint(least, most))
            at = r.sample(range(len(w)), 2 * each)
            a, b = (" ".join(r.choice(words) if i in side else x for i, x in enumerate(w)) for side in (at[:each], at[each:]))
            if levenshtein(a, b, 0.2 * max(len(a), len(b))) <= 0.2 * max(len(a), len(b)):
                out.append((a, b))
        return out

    made = pairs(8, 14, 1) + pairs(18, 30, 2)
    rows = spark.createDataFrame([(2 * i + k, x) for i, ab in enumerate(made) for k, x in enumerate(ab)], "doc_id long, text string")
    keys = {}
    for x in line_dedup.occurrences(rows).select("doc_id", "keys").collect():
        keys.setdefault(x["doc_id"], set()).update(x["keys"])
    met = [bool(keys[2 * i] & keys[2 * i + 1]) for i in range(300)]
    assert sum(met[:150]) >= 135 and sum(met[150:]) >= 135


def test_lines_with_a_changed_word_meet(spark):
    """One word in six to twelve changed, lost or put in: far beyond three bits of a SimHash of few words."""
    import random

    r, docs = random.Random(3), []
    for i in range(60):
        w = [f"{r.choice('bdgklm')}{r.choice('aeiou')}{r.randrange(10**6)}" for _ in range(6 + i % 7)]
        other, at = list(w), r.randrange(len(w))
        other[at : at + 1] = [["zq" + w[at][2:5] + "xx"], [], [w[at], "and"]][i % 3]
        docs += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(other))]
    got = {r["doc_id"]: r["n_removed"] for r in line_dedup.report(spark, spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    shares = [1 - levenshtein(docs[2 * i][1], docs[2 * i + 1][1]) / max(len(docs[2 * i][1]), len(docs[2 * i + 1][1])) for i in range(60)]
    assert min(shares) >= 0.8 and all(got[2 * i] == 0 for i in range(60)) and sum(got.values()) >= 57


def test_long_lines_by_edit_similarity(spark):
    """Over 1,000 characters: the same words in another order aren't alike, one letter changed in every fourth word is."""
    from pyspark.sql import functions as F

    base = prose(11, 300, 10**6).replace("\n", " ").split(" ")
    letters = [w[:-1] + "q" if i % 4 == 0 else w for i, w in enumerate(base)]
    pairs = spark.createDataFrame([(1, " ".join(base), " ".join(sorted(base))), (2, " ".join(base), " ".join(letters))], "i int, x string, y string")
    assert dict(pairs.select("i", line_dedup.similar(F.col("x"), F.col("y"))).collect()) == {1: False, 2: True}


def test_lines_without_blanks(spark):
    """A passage in a script without blanks: its copy and its near copy go, as does a repeated line of few long words."""
    base = "".join(chr(0x4E00 + (i * i * 31 + i * 7) % 5000) for i in range(120))
    near, other = base[:60] + "日" + base[61:], "".join(chr(0x4E00 + (i * i * 17 + i * 5) % 5000) for i in range(120))
    docs = spark.createDataFrame([(1, base), (2, base), (3, near), (4, other), (5, "Subscribe to newsletters"), (6, "subscribe to newsletters!")], "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in line_dedup.report(spark, docs).collect()} == {1: 0, 2: 1, 3: 1, 4: 0, 5: 0, 6: 1}


def levenshtein(a, b, most=None):
    """The edit distance; equal ends are cut off first."""
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    a, b = a[k:], b[k:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        before, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, before + (x != y))
    return row[-1]


def test_suffix_tree(spark, documents, rows, empty):
    got = suffix_tree_lm.score(spark, documents, context=1e-3, entry=1e-4, head=1e-4).collect()
    tokens = [(r[0], [*words(r[1]), ""]) for r in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    c = Counter(w for i, t in tokens if not held(i) for w in t)
    n, v = sum(c.values()), len(c)
    want = Counter((i, held(i), len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 6)) for i, t in tokens)
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert suffix_tree_lm.score(spark, empty).count() == 0


def test_suffix_tree_is_a_distribution_and_learns(spark):
    """A text in which each word fixes the next: held-out texts gain, and probabilities sum to one."""
    import numpy as np

    cycle = " ".join(f"w{i % 7}" for i in range(140))
    docs = spark.createDataFrame([(i, cycle) for i in range(40)], "doc_id long, text string")
    got = suffix_tree_lm.score(spark, docs, context=1e-3, entry=1e-4, head=1e-4).filter("held_out").collect()
    assert got and all(r["score"] > 0.2 * r["base_score"] for r in got)
    training = docs.select("text")
    vocabulary = suffix_tree_lm.word_counts(training).cache()
    tree = suffix_tree_lm.learn(spark, training, vocabulary, context=1e-3, entry=1e-4, head=1e-4)
    root = tree.root_logs()
    assert any(level.kept.any() for level in tree.levels)
    for before in ([1], [2, 3], [1, 1]):
        p = 0.5 / tree.total  # the unknown word
        for s in range(tree.size):
            ids = np.array([*before, s], np.int64)
            logs, open_ = tree.token_logs(ids, root)
            p_s = 10 ** logs[-1]
            if s:
                p += p_s
            else:
                p += (p_s - 1) * 0.5 / tree.total if open_[-1] else 0
        assert p == pytest.approx(1.0, abs=1e-6)


def test_preference(spark):
    def turn(pair, side, k, role, text):
        return (pair, side, k, role, text)

    rows = [
        turn(1, "chosen", 0, "user", "hi"), turn(1, "chosen", 1, "assistant", "yes"), turn(1, "chosen", 2, "user", "q"), turn(1, "chosen", 3, "assistant", "good"),
        turn(1, "rejected", 0, "user", "hi"), turn(1, "rejected", 1, "assistant", "yes"), turn(1, "rejected", 2, "user", "q"), turn(1, "rejected", 3, "assistant", "bad"), turn(1, "rejected", 3, "assistant", "bad"),
        turn(2, "chosen", 0, None, None), turn(None, "chosen", None, "user", "x"), turn(3, "chosen", 0, "user", "a"), turn(3, "rejected", 0, "user", "a"),
    ]
    schema = "pair_id long, side string, turn long, role string, text string"
    got = {r["pair_id"]: r for r in preference.format_pairs(spark.createDataFrame(rows, schema)).collect()}
    one = got[1]
    assert one["n_prompt_turns"] == 3 and one["prompt"].count("<|end|>") == 3
    (a, b), (c, d) = (tuple(map(int, one[k].split(":"))) for k in ("chosen_spans", "rejected_spans"))
    assert one["chosen"][a:b] == "good" and one["rejected"][c:d] == "bad"
    assert got[2]["prompt"] == "" and got[2]["chosen"] == "<||>\n<|end|>\n" and got[2]["rejected"] == ""
    assert got[3]["n_prompt_turns"] == 1 and got[3]["chosen"] == got[3]["rejected"] == "" and got[None]["chosen_spans"] == ""
    long = [turn(9, side, k, "user", f"t{k}" + side * (k == 700)) for side in ("chosen", "rejected") for k in range(701)]
    parts = preference.format_pairs(spark.createDataFrame(long, schema)).orderBy("part").collect()
    assert [p["n_prompt_turns"] for p in parts] == [256, 256, 188] and parts[2]["chosen"] != parts[2]["rejected"]
    assert preference.format_pairs(spark.createDataFrame([], schema)).count() == 0


def test_url_filter(spark):
    urls = ["HTTP://A.Example.COM/en/7x", "http://x.example.com/en/1?q", "ftp://net/de/1", "http://a.example.net/de/8#x", "http://b.org/es/", "no scheme", None, "http://notcom/en/", "http://h.test/p"]
    good = [f"http://s.test/good/{i}" for i in range(60)] + [f"http://s.test/ads/{i}.html" for i in range(60)]
    pages = spark.createDataFrame(list(enumerate([*urls, *good, "http://h.test/p"])), "page_id long, url string")
    labels = spark.createDataFrame([(9 + i, i >= 60) for i in range(0, 120, 2)] + [(None, True), (3, None)], "page_id long, bad boolean")
    rows = url_filter.judge(spark, pages, labels).collect()
    got = {r["page_id"]: r for r in rows}
    assert len(rows) == 130
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) for i in range(8)] == [
        ("a.example.com", "/en/7x", "example.com/en/7", "allow"), ("x.example.com", "/en/1", "com/en/", "block"), ("net", "/de/1", "net/de/", "allow"),
        ("a.example.net", "/de/8", "example.net/de/8", "block"), ("b.org", "/es/", "org/es/", "block"), ("", "", None, "allow"), ("", "", None, "allow"), ("notcom", "/en/", None, "allow"),
    ]
    assert {got[9 + i]["verdict"] for i in range(60)} == {"allow"} and {got[69 + i]["verdict"] for i in range(60)} == {"block"}
    assert got[70]["template"] in ("s.test/ads", "s.test/ads/*.html")
    assert url_filter.judge(spark, pages.limit(0), labels).count() == 0
    assert {r["verdict"] for r in url_filter.judge(spark, pages.filter("page_id > 8"), labels.limit(0)).collect()} == {"allow"}


def brute_templates(pages, bad):
    """host, path -> (template, labelled, bad) by a restatement of the rule for segments that are no wildcards."""
    z, counts, n_all, b_all = 1.96, defaultdict(lambda: [0, 0]), 0, 0
    walk = lambda h, p: [h, *(h + "/" + "/".join(p[1:].split("/")[: i + 1]) for i in range(len(p[1:].split("/"))))]
    for i, h, p in pages:
        for t in walk(h, p):
            counts[t][0] += i in bad
            counts[t][1] += bad.get(i, False)
    children = defaultdict(list)
    for t in counts:
        if "/" in t:
            up = t.rsplit("/", 1)[0]
            (n, b), (un, ub) = counts[t], counts[up]
            rate = ub / max(un, 1)
            if n and abs(b / n - rate) > z * math.sqrt(rate * (1 - rate) / n + 1e-12):
                children[up].append(t)
    found = {}
    for up, ts in children.items():
        bins = defaultdict(list)
        for t in ts:
            n, b = counts[t]
            scale = math.floor(math.log2(n) / 2 + 1e-9)
            many = math.ceil(2**scale * math.pi * math.sqrt(2) / z)
            bins[scale, min(many - 1, math.floor(math.asin(math.sqrt(b / n)) * many * 2 / math.pi + 1e-9))].append(t)
        for own in bins.values():  # no two of a class can be told apart
            for (n, b), (m, a) in itertools.combinations([counts[t] for t in own], 2):
                assert abs(math.asin(math.sqrt(b / n)) - math.asin(math.sqrt(a / m))) <= z * math.sqrt(1 / (4 * n) + 1 / (4 * m)) + 1e-8
        runs = []
        for own in sorted(bins.values(), key=lambda own: (sum(counts[t][1] for t in own) / sum(counts[t][0] for t in own), min(own))):
            n, b = (sum(counts[t][j] for t in own) for j in (0, 1))
            if runs:
                old, m, a = runs[-1]
                p = (a + b) / (m + n)
                if abs(a / m - b / n) <= z * math.sqrt(p * (1 - p) * (1 / m + 1 / n) + 1e-12):
                    runs[-1] = (old + own, m + n, a + b)
                    continue
            runs.append((own, n, b))
        for own, n, b in runs:
            for t in own:
                found[t] = (min(own) + (f" +{len(own) - 1}" if len(own) > 1 else ""), n, b)
    return {(h, p): next((found[t] for t in reversed(walk(h, p)) if t in found), (h, *counts[h])) for _, h, p in pages}


def test_url_branches(spark):
    """Siblings that resemble each other are one branch, on random labels, as a restatement has it; few labels of many bad siblings reject together."""
    import random

    r, pages, bad = random.Random(8), [], {}
    for host in ("a.test", "b.test", "c.test"):
        for k in range(7):
            share = (0.02, 0.05, 0.5, 0.55, 0.9, 0.95, 0.3)[k]
            for leaf in range(3):
                for _ in range(r.randrange(2, 30)):
                    i = len(pages)
                    pages.append((i, host, f"/s{'abcdefg'[k]}/l{'xyz'[leaf]}"))
                    if r.random() < 0.8:
                        bad[i] = r.random() < share
    pages += [(len(pages), "c.test", "/new/one"), (len(pages) + 1, "d.test", "/")]
    labels = spark.createDataFrame(list(bad.items()), "page_id long, bad boolean")
    got = url_filter.tree(spark, spark.createDataFrame(pages, "page_id long, host string, path string"), labels).collect()
    assert {(x["host"], x["path"]): (x["template"], x["labelled"], x["bad"]) for x in got} == brute_templates(pages, bad)
    assert any(" +" in x["template"] for x in got)
    few = [(i, "e.test", f"/{c}/p") for i, c in enumerate("abcdef" * 3)] + [(100 + i, "e.test", f"/good{'uvwxyz'[i % 6]}/p") for i in range(60)]
    labels = spark.createDataFrame([(i, i < 100) for i, *_ in few], "page_id long, bad boolean")
    said = url_filter.tree(spark, spark.createDataFrame(few, "page_id long, host string, path string"), labels, strength=8.0).collect()
    assert {x["path"]: x["rejected"] for x in said} == {p: i < 100 for i, _, p in few}


def test_url_siblings_are_told_apart(spark):
    """Two siblings with many labels whose rates differ are two branches, and like ones of any size are one."""
    rows = [(2, "h/a", "h", 100_000, 51_000), (2, "h/b", "h", 100_000, 57_000), (2, "h/c", "h", 100_000, 51_050), (2, "h/d", "h", 100, 51), (2, "g/a", "g", 1, 0), (2, "g/b", "g", 2, 0), (2, "g/c", "g", 9000, 9000), (2, "g/d", "g", 3, 3)]
    got = url_filter.branches(spark.createDataFrame(rows, "k int, t string, up string, n long, b long")).collect()
    assert {r["t"]: (r["branch"], r["bn"], r["bb"]) for r in got} == {
        "h/a": ("h/a +2", 200_100, 102_101), "h/c": ("h/a +2", 200_100, 102_101), "h/d": ("h/a +2", 200_100, 102_101), "h/b": ("h/b", 100_000, 57_000),
        "g/a": ("g/a +1", 3, 0), "g/b": ("g/a +1", 3, 0), "g/c": ("g/c +1", 9003, 9003), "g/d": ("g/c +1", 9003, 9003),
    }


def brute_scores(rows, order, least=2, discount=0.75, gain=1.0):
    """A suffix tree of dictionaries, without a head: every context with its counts, retained by the same leave-one-out test."""
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    tokens = [(r[0], [*words(r[1]), ""]) for r in rows]
    c, follow = Counter(), defaultdict(Counter)
    for i, t in tokens:
        if not held(i):
            c.update(t)
            for k, w in enumerate(t):
                for d in range(1, min(order, k) + 1):
                    follow[tuple(t[k - d : k])][w] += 1
    n, v = sum(c.values()), len(c)
    kept: dict = {}

    def p(before, w):
        if not before:
            return (c[w] + 0.5) / (n + 0.5 * (v + 1))
        up, f = p(before[1:], w), follow.get(before)
        if not f or sum(f.values()) < least:
            return up
        t, k = sum(f.values()), len(f)
        if before not in kept:
            one = lambda x, m: (m - 1 - discount + discount * k * p(before[1:], x) if m > 1 else discount * (k - 1) * p(before[1:], x)) / (t - 1)
            kept[before] = sum(m * (math.log(one(x, m)) - math.log(p(before[1:], x))) for x, m in f.items()) > gain
        return (max(f[w] - discount, 0) + discount * k * up) / t if kept[before] else up

    scores = Counter((i, round(sum(math.log10(p(tuple(t[max(0, k - order) : k]), w)) for k, w in enumerate(t)), 2)) for i, t in tokens)
    return scores, c, n, v


def test_suffix_tree_equals_dictionaries(spark):
    """Without a head all contexts are in buckets; longer contexts help on held-out texts."""
    texts = [prose(60 + i % 25, 60) + " " + prose(90 + i % 7, 25) for i in range(150)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(150, None), (151, ""), (152, texts[3]), (3, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sums = {}
    for order in (1, 4):
        want, *_ = brute_scores(rows, order)
        got = suffix_tree_lm.score(spark, docs, order=order, context=2.0, entry=1e-9, head=1e-9).collect()
        left, right = sorted((r["doc_id"], r["score"]) for r in got), sorted(want.elements())
        assert [x[0] for x in left] == [x[0] for x in right] and all(abs(x[1] - y[1]) < 0.02 for x, y in zip(left, right, strict=True))
        sums[order] = sum(r["score"] for r in got if r["held_out"]), sum(r["base_score"] for r in got if r["held_out"])
    assert sums[4][0] > sums[1][0] > sums[1][1]
    with_head = suffix_tree_lm.score(spark, docs, context=1e-3, entry=1e-4, head=1e-4).filter("held_out").agg({"score": "sum"}).first()[0]
    assert with_head > sums[4][1]


def test_suffix_tree_splits_each_text_once(spark):
    """Words, levels of the head and scores come from one reading of the texts."""
    from pyspark.sql import functions

    seen = spark.sparkContext.accumulator(0)

    def counted(text):
        seen.add(1)
        return text

    docs = spark.createDataFrame([(i, prose(i, 80)) for i in range(30)], "doc_id long, text string").coalesce(1)
    each = docs.withColumn("text", functions.udf(counted, "string")("text"))
    assert suffix_tree_lm.score(spark, each, context=1e-3, entry=1e-4, head=1e-4).count() == 30
    assert seen.value == 30


def test_line_keys_in_parts(spark):
    """The parts of the keys are together all keys, and a key of one part is in no other, whatever the line."""
    texts = [prose(i, 2 + i % 70, 10**6) for i in range(140)]
    held = line_dedup._lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).select("doc_id", "scale", line_dedup._keys().alias("all"), *(line_dedup._keys(k).alias(f"k{k}") for k in range(line_dedup.KEY_PARTS))).collect()
    own = [{k for x in held for k in x[f"k{p}"]} for p in range(line_dedup.KEY_PARTS)]
    assert all(sorted(x["all"]) == sorted(k for p in range(line_dedup.KEY_PARTS) for k in x[f"k{p}"]) and len(set(x["all"])) == len(x["all"]) for x in held)
    assert all(own) and sum(map(len, own)) == len(set().union(*own))


def test_lines_are_refused_by_letters(spark):
    """Pairs with an edit similarity of 0.8 are never refused by their letters; most pairs of unlike lines are."""
    import random

    from pyspark.sql import functions as F

    r, made = random.Random(12), []
    words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyzäöüßéàж字09") for _ in range(r.randint(2, 9))) for _ in range(400)]
    for i in range(200):
        x = " ".join(r.choices(words, k=r.randint(4, 60)))
        y = list(x)
        for _ in range(int(0.2 * len(x))):
            at = r.randrange(len(y))
            y[at : at + 1] = [[], [r.choice("eqä字")], [y[at], r.choice("eqä字")]][r.randrange(3) if i % 2 else 1]
        made += [(2 * i, x, "".join(y)), (2 * i + 1, x, " ".join(r.choices(words, k=len(x) // 6)))]
    rows = spark.createDataFrame([*((i, "x", x) for i, x, _ in made), *((i, "y", y) for i, _, y in made)], "i long, side string, norm string")
    signs = rows.select("i", "side", F.length("norm").alias("len"), *line_dedup._letters(F.col("norm")))
    x, y = signs.filter("side = 'x'").alias("x"), signs.filter("side = 'y'").alias("y")
    got = dict(x.join(y, F.col("x.i") == F.col("y.i")).select("x.i", line_dedup._near("x", "y")).collect())
    alike = {i for i, x, y in made if levenshtein(x, y, 0.2 * max(len(x), len(y))) <= 0.2 * max(len(x), len(y)) + 1e-9}
    assert len(alike) >= 100 and all(got[i] for i in alike)
    assert sum(not got[2 * i + 1] for i in range(200)) >= 100


def test_lines_are_told_without_the_whole_band(spark):
    """Words in common and beginnings are never wrong about the edit distance, and tell nearly all pairs: copies with words changed, some
    of them to words that the line has elsewhere, and lines of other words."""
    import random

    from pyspark.sql import functions as F

    r, made = random.Random(21), []
    words = ["".join(r.choice("abcdefghijklmnoprstuvyzé") for _ in range(r.randint(2, 11))) for _ in range(900)]
    for i in range(300):
        x = r.choices(words, k=r.randint(20, 150))
        y = r.choices(words, k=len(x) + r.randrange(3)) if i % 3 == 0 else list(x)
        for _ in range(0 if i % 3 == 0 else 1 + int(len(x) * (0.05 if i % 3 == 1 else 0.3))):
            at = r.randrange(len(y))
            y[at : at + 1] = [[], [r.choice(words)], [r.choice(x)], [y[at], r.choice(x)]][r.randrange(4)]
        made.append((i, " ".join(x), " ".join(y)))
    pairs = spark.createDataFrame(made, "i int, x string, y string").withColumn("most", F.floor(0.2 * F.greatest(F.length("x"), F.length("y")) + 1e-9).cast("int"))
    x, y, most = F.col("x"), F.col("y"), F.col("most")
    split = F.struct(F.split(x, " ").alias("x"), F.split(y, " ").alias("y"))
    told = pairs.select("i", "most", line_dedup._told(split, x, y, most).alias("aligned"), line_dedup._apart(x, y, most).alias("apart"), line_dedup._within(x, y, most).alias("within")).collect()
    far = {i: levenshtein(x, y) for i, x, y in made}
    assert all(t["within"] == (far[t["i"]] <= t["most"]) for t in told)
    assert all(far[t["i"]] <= t["most"] for t in told if t["aligned"]) and all(far[t["i"]] > t["most"] for t in told if t["apart"])
    assert sum(t["aligned"] for t in told if t["i"] % 3 == 1) >= 90 and sum(t["apart"] for t in told if t["i"] % 3 == 0) >= 90


def test_lines_of_large_blocks_of_unlike_lines(spark):
    """Lines that have all words but one in common, a long one, so that the rounds of linking meet further members of one block: none of them goes,
    near copies of some of them do, and a table that others read is never written anew."""
    import random

    from millrace.llm import shared

    r = random.Random(31)
    word = lambda n: "".join(r.choice("abcdefghijklmnoprstuvyz") for _ in range(n))
    lines = [f"ship goes from east port {word(12)}" for _ in range(60)]
    near = [x[:-1] + "q" for x in lines[:5]]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate([*lines, *near])], "doc_id long, text string")
    got = {x["doc_id"]: x["n_removed"] for x in line_dedup.report(spark, docs).collect()}
    assert got == {i: int(i >= 60) for i in range(65)}
    scratch = shared.Scratch(spark, "test")
    scratch.save(spark.range(3), "a")
    with pytest.raises(Exception, match="(?i)already.exists"):
        scratch.save(spark.range(4), "a")
    scratch.drop()


def test_lines_are_refused_by_beginnings(spark):
    """Pairs with an edit similarity of 0.8 are never refused by their beginnings, be the edits at the beginning or lengths unlike; lines of the same words in
    another order, which have the same letters, nearly always are."""
    import random

    from pyspark.sql import functions as F

    r, made = random.Random(17), []
    words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyzäöüß字") for _ in range(r.randint(2, 9))) for _ in range(400)]
    for i in range(200):
        w = r.choices(words, k=r.randint(4, 200))
        x = " ".join(w)
        y = list(x)
        for _ in range(int(0.2 * len(x))):
            at = r.randrange(len(y) if i % 4 < 2 else max(1, len(y) // 4))
            y[at : at + 1] = [[], [r.choice("eqä字")], [y[at], r.choice("eqä字")]][r.randrange(3) if i % 2 else i // 4 % 3]
        made += [(2 * i, x, "".join(y)), (2 * i + 1, x, " ".join(r.sample(w, len(w))))]
    rows = spark.createDataFrame([*((i, "x", x) for i, x, _ in made), *((i, "y", y) for i, _, y in made)], "i long, side string, norm string")
    signs = rows.select("i", "side", F.length("norm").alias("len"), line_dedup._head(F.col("norm")))
    x, y = signs.filter("side = 'x'").alias("x"), signs.filter("side = 'y'").alias("y")
    got = dict(x.join(y, F.col("x.i") == F.col("y.i")).select("x.i", line_dedup._begin_apart("x", "y")).collect())
    far = {i: levenshtein(x, y) - 0.2 * max(len(x), len(y)) for i, x, y in made}
    alike = {i for i in far if far[i] <= 1e-9}
    assert len(alike) >= 100 and not any(got[i] for i in alike)
    assert sum(got[i] for i in far if i % 2 and i not in alike) >= 0.8 * sum(i % 2 and i not in alike for i in far)
