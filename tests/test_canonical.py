"""The chain from raw to canonical records, branch by branch."""

import pytest

from millrace.operators import canonical

DISTRICTS = [("Adana", "Seyhan"), ("Adana", "Çukurova"), ("Antalya", "Alanya"), ("Antalya", "Antalya"), ("Denizli", "Denızlı"), ("İstanbul", "Kadıköy"), ("İstanbul", "Gazi Osmanpaşa"), ("Hatay", "Antakya"), ("Iğdır", "Aralık"), ("Ankara", "Yenişehir"), ("Mersin", "Yenişehir"), ("Muğla", "Bodrum"), ("Adıyaman", "Besni")]


@pytest.fixture(scope="module")
def districts(spark):
    return spark.createDataFrame(DISTRICTS, "il string, ilce string")


# name, il, ilce, adres, heading, combined -> name, il, ilce
CASES = {
    "own fields": (("Can Motor", "adana", "SEYHAN", "Gül Sok. No:1", "", ""), ("Can Motor", "Adana", "Seyhan")),
    "shifted name": (("SEYHAN", "Adana", "", "Yıldız Motorlu Araçlar  Ova Cad. No:3", "", ""), ("Yıldız Motorlu Araçlar", "Adana", "Seyhan")),
    "no shift to an address line": (("SEYHAN", "Adana", "", "Ova Cad. No:3", "", ""), ("SEYHAN", "Adana", "")),
    "combined cell": (("Can Motor", "", "", "", "", "ANTALYA / Alanya"), ("Can Motor", "Antalya", "Alanya")),
    "province of the address": (("Can Motor", "", "", "Gül Sok. No:1 Kadıköy / İstanbul", "Zonguldak", ""), ("Can Motor", "İstanbul", "Kadıköy")),
    "province of the heading": (("Can Motor", "", "", "Bir Aralık Okulu Yanı", "Adıyaman", ""), ("Can Motor", "Adıyaman", "")),
    "district in a part of the field": (("Can Motor", "Antalya", "Batı / Alanya", "", "", ""), ("Can Motor", "Antalya", "Alanya")),
    "province in the district field": (("Can Motor", "", "Muğla yöresi", "", "", ""), ("Can Motor", "Muğla", "")),
    "district of the address": (("Can Motor", "Antalya", "", "Alanya Mah. Gül Sok. No:8 Alanya/Antalya", "", ""), ("Can Motor", "Antalya", "Alanya")),
    "a street is no district": (("Can Motor", "Antalya", "", "Alanya Cad. No:8", "", ""), ("Can Motor", "Antalya", "")),
    "field names the province, address the district": (("Can Motor", "Antalya", "Antalya", "Gül Sok. Alanya Antalya", "", ""), ("Can Motor", "Antalya", "Alanya")),
    "province of a district": (("Can Motor", "", "Bodrum", "", "", ""), ("Can Motor", "Muğla", "Bodrum")),
    "ambiguous district": (("Can Motor", "", "Yenişehir", "", "", ""), ("Can Motor", "", "Yenişehir")),
    "ambiguous district, told by province": (("Can Motor", "Mersin", "yenişehir", "", "", ""), ("Can Motor", "Mersin", "Yenişehir")),
    "centre": (("Can Motor", "Denizli", "Merkez", "", "", ""), ("Can Motor", "Denizli", "Denizli")),
    "spelling repaired": (("Can Motor", "Denizli", "DENİZLİ", "", "", ""), ("Can Motor", "Denizli", "Denizli")),
    "end of the address overrides": (("Can Motor", "Ankara", "Yenişehir", "Gül Sok. Kadıköy, İstanbul", "", ""), ("Can Motor", "İstanbul", "Kadıköy")),
    "overridden, district stays where it fits": (("Can Motor", "Ankara", "Yenişehir", "Gül Sok. No:3, Mersin", "", ""), ("Can Motor", "Mersin", "Yenişehir")),
    "district as province": (("Can Motor", "Antakya", "", "", "", ""), ("Can Motor", "Hatay", "Antakya")),
    "province that is none": (("Can Motor", "Narnia", "", "", "", ""), ("Can Motor", "", "")),
    "district of another province": (("Can Motor", "Adana", "Alanya", "", "", ""), ("Can Motor", "Adana", "")),
    "alias without blanks": (("Can Motor", "", "GOP", "", "", ""), ("Can Motor", "İstanbul", "Gazi Osmanpaşa")),
    "glued key in an address": (("Can Motor", "", "", "Gül Sok. No:4 Gaziosmanpaşa", "", ""), ("Can Motor", "İstanbul", "Gazi Osmanpaşa")),
    "longest of those at a place": (("Can Motor", "İstanbul", "", "No:4 Gazi Osmanpaşa", "", ""), ("Can Motor", "İstanbul", "Gazi Osmanpaşa")),
    "road named as a province": (("Can Motor", "", "", "Ankara Yolu No:4", "Muğla", ""), ("Can Motor", "Muğla", "")),
    "no name": (("  ", "Adana", "", "x", "", ""), None),
}


def test_canonical_branches(spark, districts):
    names = list(CASES)
    raw = spark.createDataFrame([(n, *CASES[n][0]) for n in names], "case string, bayi_adi string, il string, ilce string, adres string, il_baslik string, birlesik string")
    got = {r["case"]: (r["bayi_adi"], r["il"], r["ilce"]) for r in canonical.canonical(raw.repartition(3), districts).collect()}
    assert got == {n: CASES[n][1] for n in names if CASES[n][1]}


def test_canonical_cells(spark, districts):
    raw = spark.createDataFrame([(7, "A&amp;B  Motor", None, "Adana", "Adres: Gül Sok. No:1 Tel:", "0532 111 22 33 / 0322 222 33 44", "Can@X.COM ", None)], "id int, bayi_adi string, ilce string, il string, adres string, telefon string, email string, rol string")
    got = canonical.canonical(raw, districts).first()
    assert tuple(got) == (7, "A&B Motor", "Adana", "", "Gül Sok. No:1", "+905321112233", "can@x.com", "", "")


def test_canonical_of_nothing(spark, districts):
    raw = spark.createDataFrame([], "bayi_adi string, adres string")
    assert canonical.canonical(raw, districts).count() == 0
    one = spark.createDataFrame([("Can Motor", "Gül Sok. Alanya/Antalya")], "bayi_adi string, adres string")
    nowhere = spark.createDataFrame([], "il string, ilce string")
    assert [(r["il"], r["ilce"]) for r in canonical.canonical(one, nowhere).collect()] == [("Antalya", "")]


def test_district_keys(spark, districts):
    keys = {r["key"]: [(x["il"], x["name"], x["home"]) for x in r["found"]] for r in canonical.district_keys(districts).collect()}
    assert keys["denizli"] == [("Denizli", "Denizli", "Denizli")]
    assert keys["mugla"] == [("Muğla", "Muğla", "Muğla")]
    assert [x[0] for x in keys["yenisehir"]] == ["Ankara", "Mersin"]
    assert keys["gaziosmanpasa"] == keys["gazi osmanpasa"] == keys["gop"]


def test_localise(spark):
    rows = [(1, "Fabrika Satış Mağazası / Satış", "İstanbul", "", "Moda Mah. No:1"), (2, "Fabrika Satış Mağazası / Satış / Servis", "İstanbul", "", "Gül Mahallesi No:2"), (3, "Fabrika Satış Mağazası", "Kayseri", "Develi", ""), (4, "Can Motor", "Kayseri", "", ""), (5, "Fabrika Satış Mağazası", "İstanbul", "", "No:5")]
    table = spark.createDataFrame(rows, "id int, bayi_adi string, il string, ilce string, adres string")
    got = {r["id"]: r["bayi_adi"] for r in canonical.localise(table, ["fabrika satış"]).collect()}
    assert got == {1: "İstanbul Fabrika Satış Mağazası (Moda)", 2: "İstanbul Fabrika Satış Mağazası (Gül)", 3: "Develi Fabrika Satış Mağazası", 4: "Can Motor", 5: "İstanbul Fabrika Satış Mağazası"}
