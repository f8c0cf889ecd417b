"""Cards, scripts and registries over pages that are made of customers and suppliers: each row a shape of what sites write."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.places import BY_KEY
from millrace.sources import cards, embedded, registry

from .points import dealt, read

PLACES = (("Adana", "Çukurova"), ("Antalya", "Alanya"), ("Hatay", "Antakya"), ("Muğla", "Bodrum"), ("İzmir", "Çeşme"))
_PLACE = " ".join(f"WHEN {i} THEN named_struct('il', '{il}', 'ilce', '{ilce}')" for i, (il, ilce) in enumerate(PLACES))
_PLACE_SQL = " ".join(f"WHEN {i} THEN {{'il': '{il}', 'ilce': '{ilce}'}}" for i, (il, ilce) in enumerate(PLACES))
PHONE = "'0532 111 22 3' || (k % 10)"
#: Texts of a card by k % 8, as SQL over k, p.il, p.ilce and phone.
CARDS = (
    "p.ilce, 'Ali Demir', 'Gül Mah. No: ' || k || ' Blok', phone",
    "'İlçe: ' || p.ilce, 'Tel:', phone, 'Can Motor ' || k, 'İl: ' || p.il, 'Yetkili Servis'",
    "'Ova Ticaret ' || k, p.il, 'tel:' || phone, '0212 000 00 00'",
    "p.il || '-' || p.ilce, 'Su Otomotiv', phone",
    "'Can Motor ' || k, 'Merhaba Dünya'",
    "'24d', 'Haritada göster', 'Konum yok', phone",
    "'Veli Ak', 'Gül Mah. Ova Cad. No: ' || k, 'mailto:a' || k || '@b.co'",
    "'Kestel', 'Satış', 'Ayşe Tan', 'Kestel Mah. Yol Cad. No: ' || k, phone",
)


def card_fields(s: SparkSession, d: str) -> DataFrame:
    """What each customer's card tells."""
    c = dealt(read(s, d, "customer").select("c_custkey")).selectExpr("c_custkey AS k", f"CASE c_custkey % 5 {_PLACE} END AS p").selectExpr("k", "p", f"{PHONE} AS phone")
    parts = "CASE k % 8 " + " ".join(f"WHEN {i} THEN array({x})" for i, x in enumerate(CARDS)) + " END"
    made = c.selectExpr("CAST(k AS string) AS url", "'g' AS grp", "0 AS ord", "1 AS n_phones", "'' AS heading", f"{parts} AS parts")
    districts = s.createDataFrame(list(PLACES), "il string, ilce string")
    return cards.card_fields(made, districts).select("url", "bayi_adi", "il", "ilce", "adres", "telefon", "email", "rol")


SIZE = 24  # customers on a page
BORDER = ((26.0, 36.0), (45.0, 36.0), (45.0, 42.0), (26.0, 42.0))
CENTRES = (("Adana", 37.0, 35.3), ("Rize", 41.0, 40.5), ("Konya", 37.9, 32.5))
#: A point by k % 6, as SQL.
POINTS = (
    "'name', 'Can Motor ' || k, 'PHONE', '0532' || k, 'address', 'Gül Sok. No: ' || k, 'city', 'Rize'",
    "'title', 'Ova Motor ' || k, 'Latitude', CAST(CASE k % 3 WHEN 1 THEN 37.1 ELSE 40.9 END AS double), 'lng', CAST(CASE k % 3 WHEN 1 THEN 35.2 ELSE 40.4 END AS double)",
    "'name', 'Uzak Motor', 'phone', '1', 'address', 'Yol Sok.', 'lat', 50.5, 'lng', 10.5",
    "'name', 'Uzak Motor', 'tel', '1', 'street', 'Yol Sok.', 'country', 'DE'",
    "'firma', 'Su Motor ' || k, 'gsm', '0533' || k, 'adres', '', 'adres1', 'Su Cad. No: ' || k, 'countryCode', 'TR', 'type', 'Yetkili Servis'",
    "'name', 'x1', 'phone', '7uj', 'address', 'Gül Sok.'",
)


def script_points(s: SparkSession, d: str) -> DataFrame:
    """The points of pages that hold SIZE customers each within a script."""
    shape = "CASE k % 6 " + " ".join(f"WHEN {i} THEN to_json(named_struct({x}))" for i, x in enumerate(POINTS)) + " END"
    c = read(s, d, "customer").selectExpr("c_custkey AS k", f"c_custkey div {SIZE} AS page").selectExpr("k", "page", f"{shape} AS x")
    lists = c.groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "x"))), lambda p: p["x"]), ",").alias("x"))
    html = F.concat(F.lit('<script id="d">{"props":{"n":[1,2],"in":{"list":['), "x", F.lit("]}}}</script>"))
    pages = lists.select(F.concat(F.lit("https://z.example/"), "page").alias("url"), html.alias("html"))
    return embedded.script_points(pages, list(BORDER), list(CENTRES)).select("url", "bayi_adi", "il", "adres", "telefon", "rol")


RECIPES = {
    "kart": {"idiom": "html", "row": "div.kart", "fields": {"bayi_adi": {"sel": "b"}, "telefon": {"label": "Tel"}, "bolge": {"heading": "h2"}}},
    "liste": {"idiom": "json", "row": "data.points", "fields": {"bayi_adi": "info.name", "telefon": "phones.0", "kod": {"path": "id", "regex": "^S-(.*)$"}}},
}


def recipes(s: SparkSession, d: str) -> DataFrame:
    """Customers' pages by a recipe of cards and suppliers' answers by one of JSON paths, in one table function; the registry is a table."""
    c, sup = dealt(read(s, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")), dealt(read(s, d, "supplier").select("s_suppkey", "s_name", "s_nationkey"))
    html = "concat('<h2>Bölge ', c_nationkey, '</h2><div class=\"x kart\"><b>', c_name, '</b><p>Tel: <i>', c_mktsegment, '</i></p></div>')"
    body = """to_json(named_struct('data', named_struct('points', array(named_struct('id', concat('S-', s_suppkey), 'info', named_struct('name', s_name), 'phones', array(CAST(s_nationkey AS string), 'x'))))))"""
    pages = c.selectExpr("'kart' AS marka", "CAST(c_custkey AS string) AS url", f"{html} AS body").unionByName(sup.selectExpr("'liste' AS marka", "CAST(s_suppkey AS string) AS url", f"{body} AS body"))
    rows = [(k, json.dumps(v)) for k, v in RECIPES.items()]
    return registry.read(pages, s.createDataFrame(rows, "marka string, recipe string")).drop("ord")


def targets(s: SparkSession, d: str) -> DataFrame:
    """What is to be fetched of suppliers' sites: each a source of one of three kinds; customers' nations are the options of the third."""
    kind = "CASE s_suppkey % 3 WHEN 0 THEN 'tek' WHEN 1 THEN 'il' ELSE 'secenek' END"
    url = "CASE s_suppkey % 3 WHEN 0 THEN concat('https://a/', s_suppkey) WHEN 1 THEN 'https://b/{slug}?p={plate}' ELSE 'https://c/{code}' END"
    sources = read(s, d, "supplier").selectExpr("CAST(s_nationkey AS string) AS kaynak", "array(s_name, concat(s_name, ' 2')) AS markalar", "'satis' AS rol", f"{kind} AS kind", f"{url} AS url", "CASE WHEN s_suppkey % 3 = 2 THEN 'il={code}' END AS post")
    places = s.createDataFrame([(il, list(BY_KEY.values()).index(il) + 1) for il, _ in PLACES], "il string, plate int")
    options = read(s, d, "customer").selectExpr("CAST(c_nationkey AS string) AS url", "CAST(c_custkey % 4 AS string) AS code", "concat('il ', c_custkey % 4) AS il")
    return registry.targets(sources, places, options)


QUERIES = {"src13_card_fields": card_fields, "src11_script_points": script_points, "src27_recipes": recipes, "src29_targets": targets}
_SLUG = " ".join(f"WHEN '{il}' THEN '{slug}'" for (il, _), slug in zip(PLACES, ("adana", "antalya", "hatay", "mugla", "izmir"), strict=True))
_IL = ", ".join(f"('{il}', {list(BY_KEY.values()).index(il) + 1})" for il, _ in PLACES)
ORACLES = {
    "src13_card_fields": f"""WITH c AS (SELECT c_custkey AS k, CASE c_custkey % 5 {_PLACE_SQL} END AS p, c_custkey % 8 AS s FROM customer), t AS (SELECT *, {PHONE} AS phone FROM c)
  SELECT CAST(k AS VARCHAR) AS url, CASE s WHEN 0 THEN 'Ali Demir' WHEN 1 THEN 'Can Motor ' || k WHEN 2 THEN 'Ova Ticaret ' || k WHEN 3 THEN 'Su Otomotiv' WHEN 6 THEN 'Veli Ak' ELSE 'Ayşe Tan' END AS bayi_adi,
    CASE WHEN s IN (1, 2, 3) THEN p.il ELSE '' END AS il, CASE WHEN s IN (0, 1, 3) THEN p.ilce WHEN s = 7 THEN 'Kestel' ELSE '' END AS ilce,
    CASE s WHEN 0 THEN 'Gül Mah. No: ' || k || ' Blok' WHEN 6 THEN 'Gül Mah. Ova Cad. No: ' || k WHEN 7 THEN 'Kestel Mah. Yol Cad. No: ' || k ELSE '' END AS adres,
    CASE WHEN s = 6 THEN '' ELSE phone END AS telefon, CASE WHEN s = 6 THEN 'a' || k || '@b.co' ELSE '' END AS email, CASE s WHEN 1 THEN 'servis' WHEN 7 THEN 'satis' ELSE '' END AS rol
  FROM t WHERE s NOT IN (4, 5)""",
    "src11_script_points": f"""WITH c AS (SELECT c_custkey AS k, c_custkey // {SIZE} AS page, c_custkey % 6 AS s FROM customer),
  t AS (SELECT *, count(*) OVER w AS n, count(*) FILTER (s = 5) OVER w AS junk FROM c WINDOW w AS (PARTITION BY page))
  SELECT 'https://z.example/' || page AS url, CASE s WHEN 0 THEN 'Can Motor ' WHEN 1 THEN 'Ova Motor ' ELSE 'Su Motor ' END || k AS bayi_adi,
    CASE WHEN s = 0 THEN 'Rize' WHEN s = 4 THEN '' WHEN k % 3 = 1 THEN 'Adana' ELSE 'Rize' END AS il, CASE s WHEN 0 THEN 'Gül Sok. No: ' || k WHEN 4 THEN 'Su Cad. No: ' || k ELSE '' END AS adres,
    CASE s WHEN 0 THEN '0532' || k WHEN 4 THEN '0533' || k ELSE '' END AS telefon, CASE WHEN s = 4 THEN 'servis' ELSE '' END AS rol
  FROM t WHERE s IN (0, 1, 4) AND n >= 3 AND 2 * junk <= n""",
    "src27_recipes": """SELECT 'kart' AS marka, CAST(c_custkey AS VARCHAR) AS url, c_name AS bayi_adi, c_mktsegment AS telefon, 'Bölge ' || c_nationkey AS bolge, NULL AS kod FROM customer
  UNION ALL SELECT 'liste', CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR), NULL, CAST(s_suppkey AS VARCHAR) FROM supplier""",
    "src29_targets": f"""WITH s AS (SELECT s_suppkey AS k, s_nationkey AS n, unnest([s_name, s_name || ' 2']) AS marka FROM supplier), o AS (SELECT DISTINCT c_nationkey AS n, CAST(c_custkey % 4 AS VARCHAR) AS code FROM customer), p(il, plate) AS (VALUES {_IL})
  SELECT marka, 'satis' AS rol, 'https://a/' || k AS url, '' AS post, '' AS il FROM s WHERE k % 3 = 0
  UNION ALL SELECT marka, 'satis', 'https://b/' || CASE il {_SLUG} END || '?p=' || plate, '', il FROM s CROSS JOIN p WHERE k % 3 = 1
  UNION ALL SELECT marka, 'satis', 'https://c/' || code, 'il=' || code, 'il ' || code FROM s JOIN o USING (n) WHERE k % 3 = 2""",
}
