"""Text, place and geo expressions, case by case."""

import pytest
from pyspark.sql import functions as F

from millrace.functions import geo, places
from millrace.functions import text as T


def values(spark, fn, inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


def check(spark, fn, cases):
    assert values(spark, fn, [a for a, _ in cases]) == [b for _, b in cases]


def test_fold(spark):
    check(spark, T.fold, [("İSTANBUL / Kadıköy", "istanbul kadikoy"), ("IĞDIR", "igdir"), ("Hakkâri", "hakkari"), ("café Ñandú", "cafe nandu"), ("  ", ""), (None, ""), ("Ä°stanbul", "istanbul"), ("é", "e")])


def test_case(spark):
    check(spark, T.tr_lower, [("İSTANBUL IŞIK", "istanbul ışık")])
    check(spark, T.tr_upper, [("istanbul ışık", "İSTANBUL IŞIK")])
    check(spark, T.title_tr, [("KADIKÖY  iLÇESİ", "Kadıköy İlçesi"), ("", ""), (None, "")])


def test_repairs(spark):
    broken = "Şişli".encode().decode("latin-1")
    check(spark, T.repair_mojibake, [(broken, "Şişli"), ("Ärger", "Ärger"), ("plain", "plain"), ("Ã€ 東", "Ã€ 東")])
    check(spark, T.repair_latin5, [("KÝRAZ DAÐI", "KİRAZ DAĞI")])
    check(spark, T.unescape, [("MOTOR&#039;S &amp; &#x15f;", "MOTOR'S & ş"), ("a &# b", "a &# b"), ("&#99999999;", "&#99999999;"), (None, "")])
    check(spark, T.clean_text, [("  a  b​ \n c ", "a b c")])
    check(spark, T.clean_address, [("Adres: Adres: Bahar Mah. No:3 Telefon:", "Bahar Mah. No:3"), ("Adres : Telefon", ""), ("Ata Cad. 5 -", "Ata Cad. 5")])


def test_phones(spark):
    check(spark, T.clean_phone, [("0500 123 45 67", "+905001234567"), ("(500) 123 45 67", "+905001234567"), ("+90 500 123 45 67", "+905001234567"), ("0500 111 22 33 - 0501 444 55 66", "+905001112233"), ("0500111223305014445566", "+905001112233"), ("123", "123"), ("", ""), (None, "")])
    check(spark, T.phone_display, [("+905001234567", "0500 123 45 67"), ("x", "x")])
    check(spark, T.phone_count, [("0500 123 45 67", 1), ("12345678901234567890", 0), ("0212-555-44-33 ve 0850 111 22 33", 2), ("9321234567", 0), ("40.123456 29.123456", 0)])


def test_roles(spark):
    check(spark, T.role_of_label, [("Satış Noktası", "satis"), ("Yetkili Servis", "servis"), ("Bayi ve Servis", "satis_servis"), ("Yılmaz Motor", ""), ("Bölge Bayisi", "satis"), ("x" * 40, ""), (None, "")])
    check(spark, T.role_of_heading, [("Bayiler", "satis"), ("Satış + Servis", "satis_servis"), ("Yedek Parça Bayi", ""), ("Kurumsal", "")])
    check(spark, lambda c: T.role_of_type(c, {"yetkili-satici": "satis", "servis": "servis"}), [("Yetkili Satıcı", "satis"), ("yedek parça", ""), ("bilinmeyen", ""), ("Ana Servis", "servis")])


def test_places(spark):
    check(spark, places.resolve_province, [("ISTANBUL (Anadolu)", "İstanbul"), ("Afyon", "Afyonkarahisar"), ("K.Maraş", "Kahramanmaraş"), ("foo bar", "Foo Bar"), ("", "")])
    got = values(spark, places.split_place, ["KADIKÖY - İSTANBUL", "İzmir / Bornova", "Ankara", "Kadıköy", ""])
    assert [(r["il"], r["ilce"]) for r in got] == [("İstanbul", "Kadıköy"), ("İzmir", "Bornova"), ("Ankara", ""), ("", "Kadıköy"), ("", "")]
    check(spark, places.province_in_text, [("Ata Mah. Kayseri Yolu No:3 Adana", "Adana"), ("İzmir Aydın Caddesi 5 Muğla", "Muğla"), ("Afyon merkez", "Afyonkarahisar"), ("boş", "")])
    check(spark, places.plate, [("Adana", 1), ("Düzce", 81), ("yok", None)])


def test_districts(spark):
    dim = spark.createDataFrame([("Antalya", "Alanya"), ("Antalya", "Antalya"), ("İstanbul", "Bahçelievler"), ("İstanbul", "Pendik"), ("Bursa", "Ortak"), ("Konya", "Ortak")], "il string, ilce string")
    rows = spark.createDataFrame([(1, "X Sok. No:81 Alanya/Antalya", "Antalya"), (2, "Bahçelievler Mah. 5 Pendik", ""), (3, "Ortak 5", ""), (4, None, "Antalya")], "id int, adres string, il string")
    got = {r["id"]: r["ilce_adres"] for r in places.district_in_text(rows, dim).collect()}
    assert got == {1: "Alanya", 2: "Pendik", 3: "", 4: ""}


def test_geo(spark):
    square = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
    df = spark.createDataFrame([(5.0, 5.0), (11.0, 5.0), (None, 1.0)], "lat double, lng double")
    assert [r[0] for r in df.select(geo.inside(F.col("lat"), F.col("lng"), square)).collect()] == [True, False, False]
    near = geo.nearest(df.filter("lat IS NOT NULL"), [("a", 5.0, 5.1), ("b", 50.0, 50.0)], 180.0)
    assert [r["place"] for r in near.collect()] == ["a", ""]
    d = df.limit(1).select(geo.haversine(F.lit(41.0), F.lit(29.0), F.lit(39.9), F.lit(32.9))).first()[0]
    assert d == pytest.approx(351, abs=3)


def test_freshness(spark):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    rows = [("kaldirildi", False, None, None), ("aktif", True, None, None), ("aktif", False, None, "hatali"), ("aktif", False, None, None), ("aktif", False, "2024-01-30 00:00:00", "kismi"), ("aktif", False, "2024-01-20 00:00:00", "basarili"), ("aktif", False, "2024-01-25 00:00:00", "basarili")]
    df = spark.createDataFrame(rows, "s string, q boolean, g string, t string")
    got = [r[0] for r in df.select(T.freshness(F.col("s"), F.col("q"), F.col("g").cast("timestamp"), F.coalesce("t", F.lit("")), now)).collect()]
    assert got == ["dropped", "quarantine", "failed so far", "never scanned", "last good 2 days ago", "old 12 days", "current"]


def test_short_numbers_and_source_types(spark):
    rows = spark.createDataFrame([(999_960, "Servis Ağı"), (1250, "Yedek Parça / servis ağı"), (7, "x")], "n long, s string")
    got = rows.select(T.short_number(F.col("n")).alias("n"), T.role_of_type(F.col("s"), {"servis ağı": "servis"}).alias("r")).collect()
    assert [tuple(r) for r in got] == [("1000,0 B", "servis"), ("1,2 B", ""), ("7", "")]
