"""Views and the audit, with nulls, empty tables and ties."""

from pyspark.sql import functions as F

from millrace.operators import views as W

POINT = "marka string, kod string, ad string, il string, ilce string, rol string, tel string, adres string, durum string, ord long"


def _points(spark):
    rows = [("A", "1", "Kiraz Motor", "Ankara", "Cankaya", "satis", "", "", "aktif", 1), ("A", "2", "Elma Motor", "", "", "servis", None, None, "aktif", 2), ("B", "", None, None, None, "satis_servis", "", "", "aktif", 3), ("A", "1", "Kiraz Motor", "Ankara", "", "servis", "", "", "aktif", 4)]
    return spark.createDataFrame(rows, POINT)


def test_brand_page(spark):
    pts = _points(spark)
    got = {r["marka"]: tuple(r)[1:] for r in W.brand_coverage(pts).collect()}
    assert got == {"A": (3, 1, 2, 1, 1, 1, 0), "B": (1, 1, 1, 0, 0, 0, 0)}
    assert {(r["grup"], r["n"]) for r in W.brand_list(pts, "A").collect()} == {("Ankara", 2), (W.NO_PROVINCE, 1)}
    assert W.brand_list(pts, "A", il="Ankara", ilce="Cankaya").count() == 1 and W.brand_coverage(pts.limit(0)).count() == 0


def test_averages_of_brands(spark):
    summary = spark.createDataFrame([("A", 2), ("B", 0), ("C", 3), ("D", 1)], "marka string, n_points long")
    sales = spark.createDataFrame([("A", 24, 32), ("B", 5, 0), ("D", 0, 8)], "marka string, before long, now long")
    got = {r["marka"]: (r["per_before"], r["per_now"], r["monthly_before"], r["change_pct"]) for r in W.per_point_by_brand(summary, sales).collect()}
    assert got == {"A": (12.0, 16.0, 1.0, 100.0), "B": (0.0, 0.0, 0.0, None), "C": (None, None, None, None), "D": (0.0, 8.0, 0.0, None)}
    assert tuple(W.national_average(summary.withColumn("y", F.lit(3)).limit(0), "y").first()) == (0, 0, 0.0)


def test_suggestions_and_corrections(spark):
    pts = _points(spark)
    assert {tuple(r) for r in W.suggest(pts, "KİRAZ").collect()} == {("bayi", "Kiraz Motor", "Ankara", 2)}
    assert W.suggest(pts, "k").count() == 0
    new = spark.createDataFrame([("A", "Kiraz Motor", "Ankara", "0500", None)], "marka string, ad string, il string, yeni_tel string, yeni_ilce string")
    got = W.corrected(pts, new)
    assert got.columns == pts.columns and [(r["tel"], r["ilce"]) for r in got.orderBy("ord").collect()] == [("0500", "Cankaya"), (None, ""), ("", None), ("0500", "")]


def test_problems(spark):
    rows = [("Yetkili Servis", "Ankara", "", "x sok 1 abc", "+905001112233"), ("Elma", "Yokistan", "Izmir", "", ""), ("Detay", "", "", None, None), ("Kiraz Motor", "Ankara", "Cankaya", "Elma Mah. 3", "0500")]
    df = spark.createDataFrame([("A", *r) for r in rows], "marka string, ad string, il string, ilce string, adres string, tel string")
    got = [r["problems"] for r in W.problems(df, ["ankara", "izmir"]).collect()]
    assert got == [["ad_tur_etiketi"], ["ilce_il_adi", "il_gecersiz", "iletisim_yok"], ["ad_gurultu", "il_bos", "iletisim_yok"], ["telefon_bozuk"]]


def test_replaced_and_rebased(spark):
    base = spark.createDataFrame([("A", 1), ("B", 2)], "marka string, x int")
    parts = spark.createDataFrame([("A", 5, "p1"), ("A", 6, "p2"), ("C", 7, "p1")], "marka string, x int, part string")
    assert {tuple(r) for r in W.replaced(base, parts, "marka", "part").collect()} == {("A", 6), ("B", 2), ("C", 7)}
    state = spark.createDataFrame([("A", 31, 1, "karantina"), ("B", 30, 1, "karantina"), ("C", None, 0, "hatali")], "marka string, beklenen int, karantina int, durum string")
    got = {r["marka"]: tuple(r)[1:] for r in W.rebased(state, spark.createDataFrame([("A", 20), ("B", 20)], "marka string, adet int")).collect()}
    assert got == {"A": (20, 0, "basarili", True), "B": (30, 1, "karantina", False), "C": (None, 0, "hatali", False)}


def test_content_hash_counts_equal_rows(spark):
    from millrace.sources import sinks

    hash_of = lambda rows: sinks.content_hash(spark.createDataFrame(rows, "a int, b string")).first()["hash"]
    assert hash_of([(1, "x"), (2, None)]) == hash_of([(2, None), (1, "x")])
    assert len({hash_of([(1, "x"), (1, "x")]), hash_of([(2, "y"), (2, "y")]), hash_of([])}) == 3


def test_a_name_that_is_a_phone(spark):
    rows = [("m", x, "", "ankara", "Gül Sok. No:4", "") for x in ("0312 000 00 00", "12345678901", "0(532) 111-22-33")]
    df = spark.createDataFrame(rows, "marka string, ad string, ilce string, il string, adres string, tel string")
    assert [r["problems"] for r in W.problems(df, ["ankara"]).collect()] == [["ad_telefon"], [], ["ad_telefon"]]
