"""Costly work on the rows of a short table is dealt over the cores; one scan of a text finds the names that a scan for each name finds."""

import random
import re

import pytest
from pyspark.sql import functions as F

from millrace import plans
from millrace.functions import noise, places
from millrace.sources import extract

SPREAD = ["src13_card_fields", "fn11_places", "src27_recipes"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    customer = spark.range(50).selectExpr("id AS c_custkey", "concat('Customer#', id) AS c_name", "cast(id % 25 AS int) AS c_nationkey", "'BUILDING' AS c_mktsegment")
    customer.coalesce(1).write.parquet(f"{d}/customer.parquet")
    spark.range(5).selectExpr("id AS s_suppkey", "concat('Supplier#', id) AS s_name", "cast(id AS int) AS s_nationkey").coalesce(1).write.parquet(f"{d}/supplier.parquet")
    return d


@pytest.mark.parametrize("name", SPREAD)
def test_one_row_group_is_dealt_over_the_cores(spark, folder, name):
    plan = plans.QUERIES[name](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert f"Repartition {4 * spark.sparkContext.defaultParallelism}, true" in plan


@pytest.mark.parametrize("name", ["src25_chunks", "src11_script_points", "src12_containers", "src20_captured", "src32_trimmed"])
def test_pages_go_to_python_a_few_at_a_time(spark, folder, name):
    plan = plans.QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan and "MapInPandas" not in plan


def test_pages_are_read_once_for_the_best_group(spark, folder):
    plan = plans.QUERIES["src12_containers"](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("BatchEvalPython") == 1


def test_best_group_of_records(spark):
    """Ties go to the greater group, odd groups and null urls to nobody."""
    rows = [("u", g, i, n, t) for g, names in {"a": ["x", "y"], "b": ["x", "y"], "c": ["z"], "d": ["", ""]}.items() for i, (n, t) in enumerate((n, "1" if n else "") for n in names)]
    rows += [(None, "a", 0, "x", "1"), (None, "a", 1, "y", "1"), ("v", "a", 0, "x", "1"), ("v", "a", 1, "x", "1"), ("v", "b", 0, "x", "1"), ("v", "b", 1, "y", "")]
    records = spark.createDataFrame(rows, "url string, grp string, ord int, bayi_adi string, telefon string").withColumn("adres", F.lit(""))
    best = extract.best_group(records)
    assert best.columns == ["url", "grp", "ord", "bayi_adi", "telefon", "adres", "quality"]
    got = sorted((r["url"], r["grp"], r["ord"], r["bayi_adi"], r["quality"]) for r in best.collect())
    assert got == [("u", "b", 0, "x", 0.8), ("u", "b", 1, "y", 0.8), ("v", "a", 0, "x", 0.75), ("v", "a", 1, "x", 0.75)]


def test_line_kinds_are_told_once(spark, tmp_path):
    spark.createDataFrame([(1, "Can Motor\nAra"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = plans.QUERIES["fil07_noise"](spark, str(tmp_path))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("avigasyon") == 1
    assert sum(r["n_lines"] for r in found.collect()) == 3


def test_factored_words_fit_what_a_plain_list_fits():
    r = random.Random(5)
    for words in (noise.CALLS, noise.CATEGORIES, noise.TRADES):
        plain, factored = re.compile(f"(?<!\\w)(?:{'|'.join(words)})(?!\\w)"), re.compile(rf"(?<!\w){noise._any(words)}(?!\w)")
        heads = [re.sub(r"\\s[*+]", " ", re.sub(r"\[(.)[^]]*\]", r"\1", w)).replace("\\.?", ".") for w in words]
        for _ in range(3000):
            w = r.choice(heads)
            t = r.choice(["", "x ", "ş"]) + w[: r.randrange(len(w) + 1)] + r.choice(["", w[-1], "ı", " y"]) + r.choice(heads)[r.randrange(3) :]
            assert bool(plain.search(t)) == bool(factored.search(t)) and bool(re.search("|".join(words), t)) == bool(re.search(noise._any(words), t)), t


def test_provinces_of_texts_equal_a_scan_for_each(spark):
    r = random.Random(3)
    words = [*r.sample(list(places.BY_KEY), 9), "konya", "yolu", "cad", "gul", "5", "afyon", "k maras"]
    texts = [" ".join(r.choice(words) for _ in range(r.randrange(7))) for _ in range(400)]

    def told(t: str) -> str:
        held = f" {t} "
        roads = "|".join(places.ROAD_WORDS)
        named = [(-len(k), i, p) for i, (k, p) in enumerate(places.BY_KEY.items()) if re.search(rf"(?<= ){k}(?= )(?! (?:[a-z0-9]+ )?(?:{roads})\b)", held)]
        return min(named)[2] if named else next((p for k, p in places.ALIASES.items() if f" {k} " in held), "")

    def resolved(t: str) -> str:
        names = {k: v for k, v in places.ALIASES.items() if k not in places.BY_KEY} | places.BY_KEY
        return names.get(t) or next((p for k, p in places.BY_KEY.items() if t.startswith(k + " ")), None) or ""

    rows = spark.createDataFrame([(t, told(t), resolved(t)) for t in texts], "t string, want string, name string")
    got = rows.select("t", "want", "name", places.province_in_text(F.col("t")).alias("x"), places.resolve_province(F.col("t")).alias("y")).collect()
    assert not [g for g in got if g["x"] != g["want"] or (g["name"] and g["y"] != g["name"])]
