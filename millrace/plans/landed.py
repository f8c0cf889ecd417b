"""Landed bytes, captured pages and the diagnosis of brands, made of customers, nations and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.diagnosis import diagnosis
from millrace.sources import captures, decoding, trimming

from .points import read

SIZE = 24  # customers on a page
_TEXT = "'<meta charset=utf-8> Şişli Çığır Göğüş ' || k || ' <b>İnşaat'"
_LATIN5 = f"encode(translate({_TEXT}, 'ışğİŞĞ', 'ýþðÝÞÐ'), 'ISO-8859-1')"


def decoded(s: SparkSession, d: str) -> DataFrame:
    """Texts of customers as bytes of several codes, of which some are declared, some wrongly."""
    made = read(s, d, "customer").selectExpr(
        "c_custkey AS k", f"CASE WHEN c_custkey % 5 IN (0, 3) THEN encode({_TEXT.replace(' k ', ' c_custkey ')}, 'UTF-8') ELSE {_LATIN5.replace(' k ', ' c_custkey ')} END AS content",
        "CASE c_custkey % 5 WHEN 3 THEN 'utf8' WHEN 4 THEN 'ISO-8859-9' END AS charset", "CASE c_custkey % 5 WHEN 0 THEN 'text/html; charset=windows-1254' WHEN 2 THEN 'text/html; charset=\"windows-1254\"' END AS content_type",
    )
    return decoding.decoded(made).select("k", "body")


_CARD = "concat('<li class=\"k\">0532 111 2', c_custkey % 10, ' 33</li>')"


def trimmed(s: SparkSession, d: str) -> DataFrame:
    """Pages with SIZE customers each, cut down to the list of their phones."""
    c = read(s, d, "customer").selectExpr("c_custkey AS k", f"c_custkey div {SIZE} AS page", f"{_CARD} AS x")
    lists = c.groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "x"))), lambda p: p["x"]), "").alias("x"))
    html = F.concat(F.lit("<body><script>0532 111 11 11</script><div>0532 000 00 00</div><ul onclick=\"x\" id=\"l\">"), "x", F.lit("</ul></body>"))
    return trimming.trimmed(lists.select("page", html.alias("html")))


def brand_diagnosis(s: SparkSession, d: str) -> DataFrame:
    """Nations as brands, their customers as records and customers' orders as runs; lists are shown as texts."""
    label = "CASE WHEN c_nationkey % 4 = 0 OR (c_nationkey % 4 = 1 AND c_custkey % 50 > 0) THEN 'Güncel' WHEN c_custkey % 3 = 0 THEN '' ELSE 'Eski' END"
    c = read(s, d, "customer").filter("c_nationkey % 7 != 6")
    records = c.selectExpr("CAST(c_nationkey AS string) AS marka", "lpad(c_custkey, 9, '0') AS bayi_adi", "'' AS il", "'' AS ilce", "'' AS rol", f"{label} AS veri_durumu", "'2026-01-02T03' AS son_gorulme")
    tried = "CASE n_nationkey % 6 WHEN 5 THEN 'hatali' WHEN 4 THEN NULL ELSE 'basarili' END"
    brands = read(s, d, "nation").selectExpr("CAST(n_nationkey AS string) AS marka", f"{tried} AS son_deneme_durum", "n_nationkey = 3 AS karantina", "repeat(n_name, 40) AS son_hata", "'2026-01-02T03:04:05' AS son_basarili", "n_nationkey AS son_basarili_adet", "'' AS son_deneme")
    held = read(s, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
    runs = held.selectExpr("CAST(c_nationkey AS string) AS marka", "o_orderkey AS sira", "'2026' AS bitis", "'basarili' AS durum", "CAST(o_orderkey AS int) AS adet", "'' AS mesaj")
    found = diagnosis(records, brands, runs)
    shown = lambda c, f: F.array_join(F.transform(c, f), ",").alias(c)
    labels = F.array_join(F.transform(F.array_sort(F.map_entries("etiketler")), lambda e: F.concat(e["key"], F.lit(":"), e["value"])), ",").alias("etiketler")
    return found.select("marka", "onem", "durum", "karantina", "hata", "son_basarili", "toplam", "sorunlu", labels, shown("denemeler", lambda x: x["adet"].cast("string")), shown("kayitlar", lambda x: x["bayi_adi"]))


QUERIES = {"src02_decoded": decoded, "src32_trimmed": trimmed, "agg19_diagnosis": brand_diagnosis}
ORACLES = {
    "src02_decoded": f"SELECT c_custkey AS k, {_TEXT.replace(' k ', ' c_custkey ')} AS body FROM customer",
    "src32_trimmed": f"""WITH p AS (SELECT c_custkey // {SIZE} AS page, count(*) AS n, string_agg('<li class="k">0532 111 2' || c_custkey % 10 || ' 33</li>', '' ORDER BY c_custkey) AS x FROM customer GROUP BY 1)
  SELECT page, CASE WHEN n >= 9 THEN '<ul id="l">' || x || '</ul>' ELSE '<body><div>0532 000 00 00</div><ul id="l">' || x || '</ul></body>' END AS html, CAST(CASE WHEN n >= 9 THEN n ELSE n + 1 END AS INTEGER) AS n_phones FROM p""",
    "agg19_diagnosis": """WITH c AS (SELECT c_custkey AS k, c_nationkey AS m, CASE WHEN c_nationkey % 4 = 0 OR (c_nationkey % 4 = 1 AND c_custkey % 50 > 0) THEN 'Güncel' WHEN c_custkey % 3 = 0 THEN '?' ELSE 'Eski' END AS l FROM customer WHERE c_nationkey % 7 != 6),
  s AS (SELECT *, row_number() OVER (PARTITION BY m ORDER BY k) AS n FROM c WHERE l <> 'Güncel'), t AS (SELECT m, count(*) AS toplam FROM c GROUP BY m),
  b AS (SELECT m, count(*) AS sorunlu, string_agg(lpad(CAST(k AS VARCHAR), 9, '0'), ',' ORDER BY n) FILTER (n <= 300) AS kayitlar FROM s GROUP BY m),
  e AS (SELECT m, string_agg(l || ':' || n, ',' ORDER BY l) AS etiketler FROM (SELECT m, l, count(*) AS n FROM s GROUP BY m, l) GROUP BY m),
  r AS (SELECT m, string_agg(CAST(o AS VARCHAR), ',' ORDER BY o DESC) AS denemeler FROM (SELECT m, o_orderkey AS o FROM orders JOIN c ON o_custkey = k QUALIFY row_number() OVER (PARTITION BY m ORDER BY o_orderkey DESC) <= 5) GROUP BY m)
  SELECT CAST(n_nationkey AS VARCHAR) AS marka, CASE WHEN n_nationkey = 3 OR n_nationkey % 6 = 5 THEN 3 WHEN 20 * sorunlu > toplam THEN 2 WHEN sorunlu > 0 THEN 1 ELSE 0 END AS onem,
    CASE WHEN n_nationkey % 6 = 5 THEN 'hatali' WHEN n_nationkey % 6 <> 4 THEN 'basarili' WHEN toplam IS NULL THEN 'veri yok' ELSE '?' END AS durum, n_nationkey = 3 AS karantina,
    substr(repeat(n_name, 40), 1, 160) AS hata, '2026-01-02T03:04' AS son_basarili, coalesce(toplam, 0) AS toplam, coalesce(sorunlu, 0) AS sorunlu, coalesce(etiketler, '') AS etiketler, coalesce(denemeler, '') AS denemeler, coalesce(kayitlar, '') AS kayitlar
  FROM nation LEFT JOIN t ON t.m = n_nationkey LEFT JOIN b ON b.m = n_nationkey LEFT JOIN e ON e.m = n_nationkey LEFT JOIN r ON r.m = n_nationkey""",
}


def captured(s: SparkSession, d: str) -> DataFrame:
    """A capture for each nation: its list of provinces, then an answer for each of its customers, asked for by code."""
    c = read(s, d, "customer")
    page = """concat('<div><h3>Can Motor ', c_custkey div 2, '</h3><p>Gül Mah. Ova Cad. No:', c_custkey, ' Kat 2 EDREMİT / BALIKESİR</p><a href="tel:0532', c_custkey div 2, '">Ara</a></div>')"""
    url = "concat('https://a/', CASE WHEN c_custkey % 3 = 0 THEN 'servis' ELSE 'bayi' END)"
    one = f"named_struct('request', named_struct('url', {url}, 'postData', named_struct('text', concat('x=1&city_box=', c_custkey % 4))), 'response', named_struct('content', named_struct('text', {page}, 'mimeType', 'text/html')))"
    head = """named_struct('request', named_struct('url', 'https://a/', 'postData', named_struct('text', '')), 'response', named_struct('content', named_struct('text', '<select name="city_box"><option value="1">Adana</option><option value="2">Rize</option><option value="0">Seç</option></select>', 'mimeType', 'text/html')))"""
    answers = c.selectExpr("c_nationkey", "c_custkey", f"{one} AS e").groupBy("c_nationkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "e"))), lambda x: x["e"]).alias("es"))
    landed = answers.selectExpr("concat('M', c_nationkey) AS marka", "'1' AS capture", f"to_json(named_struct('log', named_struct('entries', concat(array({head}), es)))) AS body")
    return captures.capture_points(landed)


QUERIES["src20_captured"] = captured
ORACLES["src20_captured"] = """WITH c AS (SELECT c_custkey AS k, 'M' || c_nationkey AS marka, CASE WHEN c_custkey % 3 = 0 THEN 'servis' ELSE 'satis' END AS rol, c_custkey // 2 AS n FROM customer)
  SELECT marka, rol, 'Can Motor ' || n AS bayi_adi, CASE k % 4 WHEN 1 THEN 'Adana' WHEN 2 THEN 'Rize' ELSE '' END AS il, 'EDREMİT' AS ilce, 'Gül Mah. Ova Cad. No:' || k || ' Kat 2 EDREMİT / BALIKESİR' AS adres, '0532' || n AS telefon
  FROM c QUALIFY row_number() OVER (PARTITION BY marka, rol, n ORDER BY k) = 1"""
