"""Queries of the screens, orders, corrections and the audit over the points of `points`, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import PHONE, ROLE_LABELS
from millrace.operators import reports as R
from millrace.operators import views as W

from .points import POINTS, S, V, points, read
from .records import FOLD


def _brand_sales(s: SparkSession, d: str) -> DataFrame:
    year = lambda y: F.count_if(F.col("yil") == y)
    return points(s, d).filter("marka <> 'Brand#2' AND yil IN (1996, 1997)").groupBy("marka").agg(year(1996).alias("before"), year(1997).alias("now"))


def agg10_brand_average(s: SparkSession, d: str) -> DataFrame:
    summary = points(s, d).groupBy("marka").agg(F.count_if(R.sells() & (F.col("yil") == 1995)).alias("n_points"))
    return W.per_point_by_brand(summary, _brand_sales(s, d))


def agg11_national(s: SparkSession, d: str) -> DataFrame:
    rows = points(s, d).filter("durum = 'aktif'").groupBy("il").agg(F.count_distinct("kod").alias("n_points"), F.count_if(F.col("yil") == 1996).alias("y1996"), F.count_if(F.col("yil") == 1997).alias("y1997"))
    return W.national_average(rows.filter("il < 'NATION_2'"), "y1996", "y1997")


#: Customers as records with odd names, places and contacts; those of one segment are clean. Both engines read these expressions.
_RECORD = """c_mktsegment AS marka,
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN c_name ELSE CASE c_custkey % 13 WHEN 0 THEN 'Yetkili Servis' WHEN 1 THEN 'Harita' WHEN 2 THEN 'ab' WHEN 3 THEN '0312 000 00 00' WHEN 4 THEN 'İZMİR' WHEN 5 THEN 'Ana Yol' WHEN 6 THEN '12345678901' WHEN 7 THEN 'Bayi Ay' ELSE c_name END END AS ad,
  CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'Yok' WHEN 2 THEN 'İzmir' ELSE 'Ankara' END AS il,
  CASE c_custkey % 7 WHEN 0 THEN 'Izmir' WHEN 1 THEN '' WHEN 2 THEN 'Detay' WHEN 3 THEN 'Satış Noktası' ELSE 'Çankaya' END AS ilce,
  CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'Ana Yol Sok. 3' ELSE 'birinci bina' END AS adres,
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '+905000000000' ELSE CASE c_custkey % 6 WHEN 0 THEN '' WHEN 1 THEN '123' ELSE '+905000000000' END END AS tel"""


_RECORD_COLUMNS = [x.strip() for x in _RECORD.split(",\n")]


def agg17_audit(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "customer").selectExpr(*_RECORD_COLUMNS)
    n = rows.groupBy("marka").agg(F.count("*").cast("int").alias("n"))
    low = F.when(F.col("marka") == "BUILDING", 1).when(F.col("marka") == "MACHINERY", 1_000_000_000).otherwise(F.floor(F.col("n") * 8 / 5).cast("int"))
    expected = n.filter("marka IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')").select("marka", low.alias("low"), (low.cast("long") * 2).alias("high"))
    return W.audit(rows, ["ankara", "izmir"], expected)


def mean_coverage(s: SparkSession, d: str) -> DataFrame:
    sources = read(s, d, "events").select(F.col("event_type").alias("marka"), F.when(F.col("user_id") % 4 > 0, F.col("user_id") % 10 / 10).alias("kapsam"))
    return W.mean_coverage(sources)


def fil13_shown(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "events").select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("son"))
    return W.shown(rows, {"event_id": "no", "event_type": "tip", "son": "son_guncelleme", "email": "eposta"}, "son")


def fil14_corrected(s: SparkSession, d: str) -> DataFrame:
    c = read(s, d, "customer").select(F.col("c_mktsegment").alias("marka"), F.col("c_name").alias("ad"), F.col("c_nationkey").cast("string").alias("il"), F.lit("T").alias("tel"), F.col("c_custkey").alias("k"))
    new = c.filter("k % 3 = 0").select("marka", "ad", "il", F.when(F.col("k") % 2 == 0, "T2").alias("yeni_tel"), F.when(F.col("k") % 9 == 0, "").alias("yeni_il"))
    return W.corrected(c, new)


def mrg02_replaced(s: SparkSession, d: str) -> DataFrame:
    o = read(s, d, "orders")
    base = o.filter("o_orderkey % 2 = 0").select(F.col("o_custkey").alias("marka"), F.col("o_orderstatus").alias("durum")).groupBy("marka").agg(F.max("durum").alias("durum"))
    parts = o.filter("o_orderkey % 2 = 1").select(F.col("o_custkey").alias("marka"), F.concat(F.lit("new "), "o_orderpriority").alias("durum"), F.col("o_orderkey").alias("sira"))
    return W.replaced(base, parts, "marka", "sira")


def cln05_rebased(s: SparkSession, d: str) -> DataFrame:
    state = read(s, d, "part").select(F.col("p_name").alias("marka"), F.col("p_size").alias("beklenen"), F.lit(1).alias("karantina"), F.lit("karantina").alias("durum"), F.col("p_partkey").alias("k"))
    base = state.filter("k % 2 = 0").groupBy("marka").agg(F.lit(20).alias("adet"))
    return W.rebased(state.drop("k"), base)


QUERIES = {
    "agg10_brand_average": agg10_brand_average,
    "agg11_national": agg11_national,
    "agg17_audit": agg17_audit,
    "agg20_mean_coverage": mean_coverage,
    "agg24_province_picker": lambda s, d: W.province_picker(points(s, d)),
    "agg26_brand_coverage": lambda s, d: W.brand_coverage(points(s, d)),
    "agg26_brand_list": lambda s, d: W.brand_list(points(s, d).withColumn("il", F.when(F.col("ord") % 5 == 0, "").otherwise(F.col("il"))), "Brand#17", R.serves(), ilce="D3"),
    "sort07_page": lambda s, d: W.page(read(s, d, "orders").select("o_orderkey", "o_totalprice"), 1, "o_orderkey"),
    "sort08_suggest": lambda s, d: W.suggest(points(s, d), "n_1"),
    "sort08_suggest_brand": lambda s, d: W.suggest(points(s, d), "Brand#1"),
    "fil10_districts": lambda s, d: W.in_districts(points(s, d), ["D1", "D3"]).groupBy("ilce").count(),
    "fil10_all": lambda s, d: W.in_districts(points(s, d), []).groupBy("ilce").count(),
    "fil13_shown": fil13_shown,
    "fil14_corrected": fil14_corrected,
    "join14_known_brands": lambda s, d: W.known_brands(points(s, d), read(s, d, "part").filter("p_partkey < 50").select(F.col("p_brand").alias("marka"))),
    "join18_codes": lambda s, d: W.with_codes(read(s, d, "orders").select("o_orderkey", F.col("o_custkey").alias("anahtar")), read(s, d, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("anahtar"), F.col("c_name").alias("kod"))),
    "mrg02_replaced": mrg02_replaced,
    "cln05_rebased": cln05_rebased,
    "snk08_manual_source": lambda s, d: W.manual_source(points(s, d), "Brand#17", "page", "2026-01-01").select("marka", F.size(F.from_json("json", "kayitlar array<struct<bayi_adi: string>>")["kayitlar"]).cast("long").alias("n"), F.get_json_object("json", "$.kayitlar[0].bayi_adi").alias("first")),
}


def _label(folded: str, raw: str) -> str:
    """SQL: whether a text is the label of a kind of point."""
    one = (f"{folded} = '{x}' OR (contains({folded}, '{x}') AND length({folded}) <= {len(x) + 10})" for _, labels in ROLE_LABELS for x in labels)
    return f"(length({raw}) <= 32 AND {folded} <> '' AND ({' OR '.join(one)}))"


_NOISE = ", ".join(f"'{x}'" for x in W.PAGE_NOISE)
_ONLY_PHONE = PHONE.removeprefix("(?<![0-9])").removesuffix("(?![0-9])")
_AUDIT = f"""WITH r AS (SELECT {_RECORD} FROM customer), f AS (SELECT *, {FOLD.format('ad')} AS fn, {FOLD.format('il')} AS fp, {FOLD.format('ilce')} AS fi, {FOLD.format('adres')} AS fa FROM r),
  p AS (SELECT *, CASE WHEN {_label('fn', 'ad')} THEN 'ad_tur_etiketi' WHEN fn IN ({_NOISE}) THEN 'ad_gurultu' WHEN fn IN ('ankara', 'izmir') THEN 'ad_il_adi' WHEN length(trim(ad)) < 4 THEN 'ad_cok_kisa' WHEN regexp_full_match(trim(ad), '{_ONLY_PHONE}') THEN 'ad_telefon'
      WHEN adres <> '' AND fn <> '' AND len(string_split(fn, ' ')) <= 2 AND contains(fa, fn) THEN 'ad_konum' END AS a,
    CASE WHEN ilce = '' THEN NULL WHEN {_label('fi', 'ilce')} THEN 'ilce_tur_etiketi' WHEN fi IN ('ankara', 'izmir') AND fi <> fp THEN 'ilce_il_adi' WHEN fi IN ({_NOISE}) THEN 'ilce_gurultu' END AS b,
    CASE WHEN il = '' THEN 'il_bos' WHEN fp NOT IN ('ankara', 'izmir') THEN 'il_gecersiz' END AS c, CASE WHEN tel = '' AND adres = '' THEN 'iletisim_yok' WHEN length(adres) > 8 AND NOT regexp_matches(lower(adres), '{W.ADDRESS_SIGNS}') THEN 'adres_supheli' END AS d,
    CASE WHEN tel <> '' AND NOT regexp_full_match(tel, '\\+90[0-9]{{10}}') THEN 'telefon_bozuk' END AS e FROM f),
  q AS (SELECT marka, unnest([a, b, c, d, e]) AS x FROM p), k AS (SELECT marka, count(*) FILTER (x IN {W.SEVERE}) AS bad, count(x) FILTER (x NOT IN {W.SEVERE}) AS light FROM q GROUP BY 1),
  n AS (SELECT marka, fn, count(*) AS c FROM p GROUP BY 1, 2), m AS (SELECT marka, count(*) AS names, max(c) FILTER (fn <> '') AS most FROM n GROUP BY 1),
  g AS (SELECT marka, count(*) AS n, round(avg((il <> '')::INT), 6) AS il_share, round(avg((ilce <> '')::INT), 6) AS ilce_share, round(avg((tel <> '')::INT), 6) AS tel_share, count(DISTINCT nullif(il, '')) AS n_il FROM p GROUP BY 1),
  x AS (SELECT g.*, names, light, bad + CASE WHEN most >= 3 AND most >= n * 0.15 THEN 3 ELSE 0 END AS s, CASE marka WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 1000000000 WHEN 'HOUSEHOLD' THEN n * 8 // 5 END AS low FROM g JOIN m USING (marka) JOIN k USING (marka)),
  y AS (SELECT *, CASE WHEN s / n > 0.5 THEN 'BOZUK' WHEN s / n > 0.1 THEN 'sorunlu' WHEN s > 0 THEN 'kontrol' ELSE 'temiz' END AS st FROM x)
  SELECT marka, n, s AS severe, light, il_share, ilce_share, tel_share, round(names / n, 6) AS name_share, n_il,
    CASE WHEN low IS NULL THEN st WHEN n < low * 0.5 THEN 'ÇOK AZ' WHEN n > low * 4 THEN 'ÇOK FAZLA' WHEN st = 'temiz' AND (n < low * 0.7 OR n > low * 2.8) THEN 'sayı şüpheli' ELSE st END AS status FROM y"""


ORACLES = {
    "agg10_brand_average": f"""WITH {POINTS}, m AS (SELECT marka, count(*) FILTER ({S} AND yil = 1995) AS n FROM pts GROUP BY 1), s AS (SELECT marka, count(*) FILTER (yil = 1996) AS b, count(*) FILTER (yil = 1997) AS a FROM pts WHERE marka <> 'Brand#2' AND yil IN (1996, 1997) GROUP BY 1),
      j AS (SELECT marka, n, coalesce(b, 0) AS b, coalesce(a, 0) AS a, coalesce(b, 0) <> 0 OR coalesce(a, 0) <> 0 AS h FROM m LEFT JOIN s USING (marka))
      SELECT marka, n AS n_points, h AS has_sales, CASE WHEN h THEN b END AS before, CASE WHEN h THEN a END AS now, CASE WHEN h AND n > 0 THEN round(b / n, 0) WHEN h THEN 0.0 END AS per_before, CASE WHEN h AND n > 0 THEN round(a / n, 0) WHEN h THEN 0.0 END AS per_now,
        CASE WHEN h AND n > 0 THEN round(b / n / 12, 6) WHEN h THEN 0.0 END AS monthly_before, CASE WHEN h AND n > 0 THEN round(a / n / 8, 6) WHEN h THEN 0.0 END AS monthly_now, CASE WHEN h AND n > 0 AND b <> 0 THEN round((a / n / 8 - b / n / 12) / (b / n / 12) * 100, 6) END AS change_pct FROM j""",
    "agg11_national": f"WITH {POINTS}, r AS (SELECT il, count(DISTINCT kod) AS n, count(*) FILTER (yil = 1996) AS a, count(*) FILTER (yil = 1997) AS b FROM pts WHERE durum = 'aktif' GROUP BY 1) SELECT sum(n)::BIGINT AS n_points, sum(a)::BIGINT AS sum_y1996, sum(b)::BIGINT AS sum_y1997, round(sum(a) / sum(n), 0) AS avg_y1996, round(sum(b) / sum(n), 0) AS avg_y1997 FROM r WHERE il < 'NATION_2'",
    "agg17_audit": _AUDIT,
    "agg20_mean_coverage": "SELECT event_type AS marka, round(avg(CASE WHEN user_id % 4 > 0 THEN user_id % 10 / 10 ELSE 0 END), 6) AS coverage FROM events GROUP BY 1",
    "agg24_province_picker": f"WITH {POINTS} SELECT il, count(*) AS n FROM pts GROUP BY 1",
    "agg26_brand_coverage": f"WITH {POINTS} SELECT marka, count(*) AS total, count(*) FILTER {S} AS sales_points, count(*) FILTER {V} AS service_points, count(DISTINCT il) FILTER {S} AS il_sales, count(DISTINCT il) FILTER {V} AS il_service, count(DISTINCT CASE WHEN ilce <> '' THEN il || '|' || ilce END) FILTER {S} AS ilce_sales, count(DISTINCT CASE WHEN ilce <> '' THEN il || '|' || ilce END) FILTER {V} AS ilce_service FROM pts GROUP BY marka",
    "agg26_brand_list": f"WITH {POINTS} SELECT CASE WHEN ord % 5 = 0 THEN '— il bilinmiyor —' ELSE il END AS grup, count(*) AS n, count(DISTINCT kod) AS n_firms FROM pts WHERE marka = 'Brand#17' AND {V} AND ilce = 'D3' GROUP BY 1",
    "sort07_page": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 450",
    "sort08_suggest": f"""WITH {POINTS} SELECT * FROM (SELECT 'il' AS kind, il AS label, '' AS place, count(*) AS n FROM pts WHERE regexp_replace(lower(il), '[^a-z0-9]+', ' ', 'g') LIKE '%n 1%' GROUP BY il ORDER BY il LIMIT 4)
      UNION ALL SELECT * FROM (SELECT 'marka', marka, '', count(*) FROM pts WHERE regexp_replace(lower(marka), '[^a-z0-9]+', ' ', 'g') LIKE '%n 1%' GROUP BY marka ORDER BY marka LIMIT 4) UNION ALL SELECT * FROM (SELECT 'bayi', ad, il, count(*) FROM pts WHERE regexp_replace(lower(ad), '[^a-z0-9]+', ' ', 'g') LIKE '%n 1%' GROUP BY ad, il ORDER BY ad, il LIMIT 5)""",
    "sort08_suggest_brand": f"""WITH {POINTS} SELECT * FROM (SELECT 'marka' AS kind, marka AS label, '' AS place, count(*) AS n FROM pts WHERE regexp_replace(lower(marka), '[^a-z0-9]+', ' ', 'g') LIKE '%brand 1%' GROUP BY marka ORDER BY marka LIMIT 4)""",
    "fil10_districts": f"WITH {POINTS} SELECT ilce, count(*) AS count FROM pts WHERE ilce IN ('D1', 'D3') GROUP BY 1",
    "fil10_all": f"WITH {POINTS} SELECT ilce, count(*) AS count FROM pts GROUP BY 1",
    "fil13_shown": "SELECT CAST(event_id AS VARCHAR) AS no, event_type AS tip, strftime(ts, '%Y-%m-%d %H:%M') AS son_guncelleme, '' AS eposta FROM events",
    "fil14_corrected": "SELECT c_mktsegment AS marka, c_name AS ad, CASE WHEN c_custkey % 9 = 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS il, CASE WHEN c_custkey % 6 = 0 THEN 'T2' ELSE 'T' END AS tel, c_custkey AS k FROM customer",
    "join14_known_brands": f"WITH {POINTS} SELECT marka, count(*) FILTER ({S} AND NOT {V}) AS only_sales, count(*) FILTER ({V} AND NOT {S}) AS only_service, count(*) FILTER ({S} AND {V}) AS both, count(*) FILTER {S} AS sales_points, count(*) FILTER {V} AS service_points, count(*) AS total FROM pts WHERE marka IN (SELECT p_brand FROM part WHERE p_partkey < 50) GROUP BY marka",
    "join18_codes": "SELECT o_orderkey, o_custkey AS anahtar, CASE WHEN o_custkey % 2 = 0 THEN coalesce(c_name, '') ELSE '' END AS kod FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
    "mrg02_replaced": "WITH b AS (SELECT o_custkey AS marka, max(o_orderstatus) AS durum FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), p AS (SELECT o_custkey AS marka, 'new ' || arg_max(o_orderpriority, o_orderkey) AS durum FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 1) SELECT coalesce(p.marka, b.marka) AS marka, coalesce(p.durum, b.durum) AS durum FROM b FULL JOIN p ON b.marka = p.marka",
    "cln05_rebased": "WITH b AS (SELECT DISTINCT p_name FROM part WHERE p_partkey % 2 = 0) SELECT p.p_name AS marka, CASE WHEN b.p_name IS NOT NULL AND p_size > 30 THEN 20 ELSE p_size END AS beklenen, CASE WHEN b.p_name IS NOT NULL AND p_size > 30 THEN 0 ELSE 1 END AS karantina, CASE WHEN b.p_name IS NOT NULL AND p_size > 30 THEN 'basarili' ELSE 'karantina' END AS durum, b.p_name IS NOT NULL AND p_size > 30 AS duzeltildi FROM part p LEFT JOIN b ON p.p_name = b.p_name",
    "snk08_manual_source": f"WITH {POINTS} SELECT marka, count(*) AS n, arg_min(ad, marka || chr(1) || rol || chr(1) || ad) AS first FROM pts WHERE marka = 'Brand#17' GROUP BY marka",
}
