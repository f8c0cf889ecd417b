"""Recipes by the rows of a registry, and targets by the kinds of sources."""

import json

import pytest

from millrace.sources import registry

RECIPES = [
    ("A", json.dumps({"idiom": "html", "row": "div.k", "fields": {"bayi_adi": {"sel": "b"}, "telefon": {"label": "Tel"}, "il": {"heading": "h2"}, "rol": {"attr": "data-r"}}})),
    ("B", json.dumps({"idiom": "json", "row": "a.list", "fields": {"bayi_adi": "n", "kod": {"path": "c.0", "regex": "x(.*)"}}})),
    ("C", json.dumps({"idiom": "script", "row": r"new P\(.*?\)", "fields": {"bayi_adi": "t"}})),
    ("D", None),
]
PAGES = [
    ("A", "1", "<div class=k><b>Bir</b></div><h2>Rize</h2><div class='k' data-r=s><b>Can</b><i>Tel:</i><u>05</u></div><h2>Adana</h2><div class=k><p>TEL: 06 07</p></div>"),
    ("A", "2", None), ("A", "3", ""), ("D", "4", "<b>"), ("none", "5", "x"), (None, "6", "x"),
    ("B", "7", '{"a":{"list":[{"n":"Ova","c":["x9",1]},{"n":5,"c":[]},3]}}'), ("B", "8", "{cut"), ("B", "9", '{"a":{"list":{"p":{"n":null}}}}'), ("B", "10", "[" * 100_000),
    ("C", "11", "new P({'t':'Gül'}); new P({\"t\": \"Su\"}) new P({})"),
]


def test_records_by_registry(spark):
    made = registry.read(spark.createDataFrame(PAGES, "marka string, url string, body string"), spark.createDataFrame(RECIPES, "marka string, recipe string"))
    assert made.columns == ["marka", "url", "ord", "bayi_adi", "telefon", "il", "rol", "kod"]
    assert sorted(tuple(r) for r in made.collect()) == sorted([
        ("A", "1", 0, "Bir", "", "", "", None), ("A", "1", 1, "Can", "05", "Rize", "s", None), ("A", "1", 2, "", "06 07", "Adana", "", None),
        ("B", "7", 0, "Ova", None, None, None, "9"), ("B", "7", 1, "5", None, None, None, ""), ("B", "7", 2, "", None, None, None, ""), ("B", "9", 0, "", None, None, None, ""),
        ("C", "11", 0, "Gül", None, None, None, None), ("C", "11", 1, "Su", None, None, None, None), ("C", "11", 2, "", None, None, None, None),
    ])


def test_records_in_sql(spark):
    registry.register(spark)
    spark.createDataFrame(PAGES, "marka string, url string, body string").createOrReplaceTempView("landed_pages")
    got = spark.sql("""SELECT bayi_adi FROM records(TABLE(landed_pages), '{"C": {"idiom": "script", "row": "new P", "fields": {"bayi_adi": "t"}}}')""")
    assert [r[0] for r in got.collect()] == ["", "", ""]


def test_recipes_are_checked():
    for wrong in ({"idiom": "pdf", "fields": {"a": "b"}}, {"idiom": "json", "fields": {}}, {"idiom": "html", "fields": {"a": {}}}, {"idiom": "json", "fields": {"URL": "b"}}):
        with pytest.raises(ValueError):
            registry.checked({"A": wrong})


def test_targets(spark):
    sources = [("s1", ["A", "B"], "satis", "tek", "https://a", None), ("s2", ["C"], "servis", "il", "https://c/{slug}?p={plate}&n={AD}", "il={ad}"), ("s3", ["D"], "hepsi", "secenek", "{code}", "x={code}"), ("s4", ["E"], "hepsi", "secenek", "{code}", None)]
    places = spark.createDataFrame([("İzmir", 35), ("Rize", 53)], "il string, plate int")
    options = spark.createDataFrame([("s3", "7", "Rize"), ("s3", "7", "Rize"), ("s3", "", "Adana"), ("other", "1", "Adana")], "url string, code string, il string")
    got = registry.targets(spark.createDataFrame(sources, "kaynak string, markalar array<string>, rol string, kind string, url string, post string"), places, options)
    assert sorted(tuple(r) for r in got.collect()) == [
        ("A", "satis", "https://a", "", ""), ("B", "satis", "https://a", "", ""),
        ("C", "servis", "https://c/izmir?p=35&n=İZMİR", "il=İzmir", "İzmir"), ("C", "servis", "https://c/rize?p=53&n=RİZE", "il=Rize", "Rize"), ("D", "hepsi", "7", "x=7", "Rize"),
    ]
