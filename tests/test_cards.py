"""Fields of cards, each rule with a case, and points in the scripts of pages."""

import json

from millrace.sources import cards, embedded

CARD = "url string, grp string, ord int, n_phones int, heading string, parts array<string>"
DISTRICTS = [("Rize", "Pazar"), ("Adana", "Seyhan"), ("İzmir", "Torbalı")]
PHONE = "0532 111 22 33"


def fields(spark, *parts):
    rows = [("u", "g", i, 0, "", p) for i, p in enumerate(parts)]
    got = cards.card_fields(spark.createDataFrame(rows, CARD), spark.createDataFrame(DISTRICTS, "il string, ilce string"))
    return {r["ord"]: tuple(r)[3:] for r in got.collect()}


def test_card_fields(spark):
    got = fields(
        spark,
        ["Seyhan", "Ali Demir", "Gül Mah. Ova Cad. No: 4", PHONE],  # a district is no name
        ["İlçe: Pazar", "Tel:", PHONE, "Can Motor", "Adres: Gül Sok. No: 5"],  # labels, one with its value in the next text
        ["Can Motor", "Yetkili Servis", "Yetkili Servis", "RİZE", "Haritada göster", "tel:0532 444 55 66", "mailto:a@b.co", "0532 000 11 22"],
        ["İZMİR-TORBALI", "Ova Ticaret", PHONE, "x@y.com.tr"],  # a place in one text
        ["24d", "Ara", "Konum yok", PHONE],  # nothing that may be a name
        ["Can Motor", "Merhaba Dünya"],  # neither phone nor address
        ["Pazar", PHONE],  # a place alone stays as the name
        ["Kestel", "Veli Ak", "Kestel Mah. Ova Cad. No: 4", None, PHONE],  # stands in the address
        ["Can Motor", "Can Motor", "Yeni Yol", PHONE],
        [],
        None,
    )
    assert got == {
        0: ("Ali Demir", "", "Seyhan", "Gül Mah. Ova Cad. No: 4", PHONE, "", ""),
        1: ("Can Motor", "", "Pazar", "Gül Sok. No: 5", PHONE, "", ""),
        2: ("Can Motor", "Rize", "", "", "0532 444 55 66", "a@b.co", "servis"),
        3: ("Ova Ticaret", "İzmir", "TORBALI", "", PHONE, "x@y.com.tr", ""),
        6: ("Pazar", "", "", "", PHONE, "", ""),
        7: ("Veli Ak", "", "Kestel", "Kestel Mah. Ova Cad. No: 4", PHONE, "", ""),
        8: ("Can Motor", "", "Yeni Yol", "", PHONE, "", ""),
    }
    assert fields(spark, None) == {}


BORDER = [(26.0, 36.0), (45.0, 36.0), (45.0, 42.0), (26.0, 42.0)]
CENTRES = [("Adana", 37.0, 35.3), ("Rize", 41.0, 40.5)]


def page(*values):
    return "<html>" + "".join(f"<script>var x = {v if isinstance(v, str) else json.dumps(v)};</script>" for v in values)


def point(**x):
    return {"Name": "Can Motor", "phone": "0532", "address": "Gül Sok."} | x


def points(spark, *pages):
    made = spark.createDataFrame(list(enumerate(pages)), "url string, html string")
    return {(r["url"], r["ord"]): r for r in embedded.script_points(made, BORDER, CENTRES).collect()}


def test_script_points(spark):
    kinds = [
        point(unvan="other", city="", il="Rize"), point(Lat="41.1", LNG=40.4), point(lat=50, lng=10), point(country="DE"), point(country="Türkiye", type="Yetkili Servis"), point(Name=""),
        point(lat="x", lng=1), point(name="1uj", Name=None), {"title": "Ova Motor", "latitude": 37.1, "x": 35.2}, {"a": 1}, point(lat=39.0, lng=30.0), point(lat=0, lng=0),
    ]
    got = points(spark, page([point()] * 3, {"in": [{"deep": kinds}]}), page([point()] * 2), None, page("[{]" + " " * 60), page([point(Name="a1b2")] * 3 + [point()] * 2), page([point(Name="a1b2")] * 2 + [point()] * 2))
    assert {k: (r["bayi_adi"], r["il"], r["rol"]) for k, r in got.items()} == {
        ("0", 0): ("Can Motor", "Rize", ""), ("0", 1): ("Can Motor", "Rize", ""), ("0", 4): ("Can Motor", "", "servis"), ("0", 8): ("Ova Motor", "Adana", ""), ("0", 9): ("Can Motor", "", ""),
        ("5", 2): ("Can Motor", "", ""), ("5", 3): ("Can Motor", "", ""),
    }


def test_deep_scripts():
    deep = "[" * 3000 + json.dumps([point()] * 3) + "]" * 3000
    assert embedded.largest_list(page(deep)) == [point()] * 3
    assert embedded.largest_list(page("[" * 200_000)) == []
    assert embedded.largest_list(page("{" * 100_000 + "]")) == []
    assert len(embedded.largest_list(page([point()] * 3, [point(a=1)] * 3, [point(b=1)] * 4))) == 4
    assert embedded.largest_list(page([point()] * 3, [point(a=1)] * 3)) == [point()] * 3
    assert embedded.largest_list('<script>[{"phone":1,"address":2}]</script>' * 3) == []
