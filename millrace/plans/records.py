"""Queries of text, filter, join, dedup, merge, schedule and extraction operators over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import geo
from millrace.functions import text as T
from millrace.operators import identity, schedule, store
from millrace.sources import extract, sinks

from .points import POINTS, dealt, points, read

FOLD = "trim(regexp_replace(regexp_replace(translate(lower(translate({0}, 'IİĞÜŞÖÇ', 'ıiğüşöç')), '" + T.ACCENTED + "', '" + T.PLAIN + "'), '\\p{{M}}+', '', 'g'), '[^a-z0-9]+', ' ', 'g'))"

#: Phones of customers in several shapes, as one expression that both engines read.
RAW_PHONE = """CASE c_custkey % 6 WHEN 0 THEN concat('0', cast(5320000000 + c_custkey AS STRING)) WHEN 1 THEN concat('+90 ', cast(5320000000 + c_custkey AS STRING))
  WHEN 2 THEN cast(5320000000 + c_custkey AS STRING) WHEN 3 THEN concat('0532 ', cast(1000000 + c_custkey AS STRING), ' / 0212 000 00 00') WHEN 4 THEN '' ELSE concat('dahili ', cast(c_custkey AS STRING)) END"""
_D = "regexp_replace(r, '[^0-9]', '', 'g')"
CLEAN_PHONE = f"CASE WHEN r = '' THEN '' WHEN length({_D}) = 10 THEN '+90' || {_D} WHEN length({_D}) = 11 AND {_D} LIKE '0%' THEN '+90' || substr({_D}, 2) WHEN length({_D}) = 12 AND {_D} LIKE '90%' THEN '+' || {_D} ELSE trim(r) END"


def phones(s: SparkSession, d: str) -> DataFrame:
    raw = read(s, d, "customer").selectExpr("c_custkey", f"{RAW_PHONE} AS r")
    number = T.clean_phone(F.col("r"))
    return raw.select("c_custkey", number.alias("phone"), T.phone_display(number).alias("shown"))


def dedup_signature(s: SparkSession, d: str) -> DataFrame:
    docs = read(s, d, "documents").select("doc_id", "source", T.fold(F.col("text")).substr(1, 60).alias("sig"), "lang")
    return identity.first_by(docs, [F.col("lang"), F.col("sig")], ["doc_id"]).select("doc_id", "lang", "source")


def unique_keys(s: SparkSession, d: str) -> DataFrame:
    c = read(s, d, "customer")
    phone = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("+90"), F.col("c_custkey").cast("string"))).otherwise("")
    return c.select("c_custkey", identity.unique_key(F.col("c_mktsegment"), phone, F.col("c_name"), F.concat(F.col("c_name"), F.lit(" Sok. No:"), F.col("c_nationkey").cast("string"))).alias("k"))


def customer_store(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Two snapshots of customers: the store has those with key % 10 < 8, the scan those with key % 10 > 1, some changed."""
    c = read(s, d, "customer")
    name = F.concat(F.col("c_name"), F.lit(" "), F.col("c_mktsegment"))
    base = c.select(F.col("c_mktsegment").alias("marka"), name.alias("bayi_adi"), F.col("c_nationkey").cast("string").alias("il"), F.lit("").alias("ilce"), F.lit("").alias("adres"), F.concat(F.lit("+90"), F.lpad(F.col("c_custkey").cast("string"), 10, "5")).alias("telefon"), F.when(F.col("c_custkey") % 3 == 0, "satis").otherwise("servis").alias("rol"), F.col("c_custkey").alias("k"))
    held = base.filter("k % 10 < 8").withColumn("tekil_key", identity.unique_key(F.col("marka"), F.col("telefon"), F.col("bayi_adi"), F.col("adres")))
    old = held.select("tekil_key", "marka", "bayi_adi", "il", "ilce", "adres", "telefon", "rol", F.when(F.col("k") % 10 == 3, "dogrulanamadi").otherwise("aktif").alias("durum"), F.when(F.col("k") % 20 == 1, 2).otherwise(0).alias("kayip_sayaci"), F.lit("2024-01-01").cast("timestamp").alias("ilk_gorulme"), F.lit("2024-01-01").cast("timestamp").alias("son_gorulme"))
    scan = base.filter("k % 10 > 1").withColumn("rol", F.when(F.col("k") % 10 == 4, "satis_servis").otherwise(F.col("rol"))).drop("k")
    return old, scan


def merged(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    old, scan = customer_store(s, d)
    states = old.select("marka").distinct().withColumn("state", F.lit("basarili"))
    return store.merge(old, scan, states, F.lit("2024-02-01").cast("timestamp"))


_MERGE = """c AS (SELECT c_custkey AS k, c_mktsegment AS marka, CASE WHEN c_custkey % 3 = 0 THEN 'satis' ELSE 'servis' END AS rol FROM customer),
  m AS (SELECT k, marka, k % 10 < 8 AS o, k % 10 > 1 AS n, k % 10 = 3 AS unver, CASE WHEN k % 20 = 1 THEN 2 ELSE 0 END AS miss, rol, CASE WHEN k % 10 = 4 THEN 'satis_servis' ELSE rol END AS nrol FROM c)"""


def scd_counts(s: SparkSession, d: str) -> DataFrame:
    return merged(s, d)[0].groupBy("marka", "durum", "kayip_sayaci", "rol").agg(F.count("*").alias("n"))


def day_anomalies(s: SparkSession, d: str) -> DataFrame:
    """Events by type and day against the day before: the scan state of each."""
    n = read(s, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.lag("n").over(Window.partitionBy("event_type").orderBy("day")), F.lit(0))
    return n.select("event_type", F.col("day").cast("string").alias("day"), "n", before.alias("expected"), store.scan_state(F.col("n"), before, F.lit(1.0)).alias("state"))


def filled_forward(s: SparkSession, d: str) -> DataFrame:
    """Each event with the last purchase value of its user before it."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    e = read(s, d, "events")
    return e.select("event_id", F.last(F.when(F.col("event_type") == "purchase", F.col("event_id")), ignorenulls=True).over(w).alias("after"))


def nearest_vectors(s: SparkSession, d: str) -> DataFrame:
    """The first two numbers of a vector as a place, and the nearest of five fixed centres."""
    e = read(s, d, "embeddings").select("vec_id", (F.col("embedding")[0] * 10 + 39).cast("double").alias("lat"), (F.col("embedding")[1] * 10 + 35).cast("double").alias("lng"))
    centres = [("a", 39.0, 35.0), ("b", 40.0, 33.0), ("c", 38.0, 27.0), ("d", 41.0, 29.0), ("e", 37.0, 37.0)]
    return geo.nearest(e, centres, 400.0).select("vec_id", "place")


_HAV = "2 * 6371.0 * asin(sqrt(pow(sin((radians({1}) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians({1})) * pow(sin((radians({2}) - radians(lng)) / 2), 2)))"


def nation_plan(s: SparkSession, d: str) -> DataFrame:
    b = read(s, d, "nation").select(F.col("n_name").alias("marka"), (F.col("n_nationkey") * 7 % 81 + 1).alias("pages"), F.lit(1.2).alias("pause"), (F.col("n_regionkey") % 3).alias("priority"))
    p = schedule.plan(b, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return p.join(schedule.weekday_slots(b), "marka").select("marka", "minutes", F.unix_timestamp("start").alias("start"), "slot")


def manual_gone(s: SparkSession, d: str) -> DataFrame:
    """Customers without an order in 1996."""
    return read(s, d, "customer").join(read(s, d, "orders").filter(F.year("o_orderdate") == 1996), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_mktsegment")


def suppliers_alike(s: SparkSession, d: str) -> DataFrame:
    """Customers as records with few names and places: pairs that are one firm."""
    c = dealt(read(s, d, "customer"))
    rec = c.select(F.col("c_custkey").alias("id"), F.concat(F.lit("Firma"), (F.col("c_custkey") % 40).cast("string")).alias("bayi_adi"), (F.col("c_nationkey") % 5).cast("string").alias("il"), (F.col("c_custkey") % 8).cast("string").alias("ilce"), F.concat(F.lit("Yol"), (F.col("c_custkey") % 3).cast("string"), F.lit(" Sok. No: "), (F.col("c_custkey") % 4 + 1).cast("string")).alias("adres"), F.lit("").alias("telefon"), F.col("c_mktsegment").alias("marka"))
    return identity.same_pairs(rec)


def event_flags(s: SparkSession, d: str) -> DataFrame:
    """Flags of repeated keys OR-ed into roles."""
    e = read(s, d, "events").groupBy("user_id").agg(F.bool_or(F.col("event_type") == "purchase").alias("a"), F.bool_or(F.col("event_type") == "click").alias("b"))
    return e.select("user_id", T.role_of_flags(F.col("a"), F.col("b")).alias("rol"))


def pages_best(s: SparkSession, d: str) -> DataFrame:
    p = read(s, d, "pages").select(F.concat_ws("#", "url", "page_id").alias("url"), "html")
    return extract.best_group(extract.card_records(extract.card_groups(p))).select("url", "grp", "ord", "bayi_adi", "telefon", "adres", "quality")


QUERIES = {
    "fn02_fold": lambda s, d: read(s, d, "documents").select("doc_id", F.md5(T.fold(F.col("text"))).alias("key")),
    "fn03_title": lambda s, d: read(s, d, "part").select("p_partkey", T.title_tr(F.col("p_name")).alias("title")),
    "fn09_phone": phones,
    "fn27_backoff": lambda s, d: read(s, d, "nation").select("n_nationkey", T.backoff_hours(F.col("n_nationkey") % 6).alias("hours")),
    "fn30_slug": lambda s, d: read(s, d, "customer").select("c_custkey", T.slug(F.col("c_name"), "-").alias("slug")),
    "fil05_needles": lambda s, d: read(s, d, "documents").filter(F.contains(T.fold(F.col("text")), F.lit("released under")) | F.contains(T.fold(F.col("text")), F.lit("mit license"))).select("doc_id"),
    "fil08_machine_url": lambda s, d: read(s, d, "pages").filter(~T.machine_url(F.col("url"))).select("page_id"),
    "fil09_search": lambda s, d: points(s, d).filter(F.contains(T.fold(F.concat_ws(" ", "marka", "ad", "il", "adres")), F.lit("nation 7"))).groupBy("marka").agg(F.count("*").alias("n")),
    "fil11_localise": lambda s, d: points(s, d).groupBy("il", "ilce", "rol").agg(F.count("*").alias("n")).withColumn("new_name", F.concat_ws(" ", F.when(F.col("ilce") != "", F.col("ilce")).otherwise(F.col("il")), F.lit("Fabrika"))).withColumn("c", F.count("*").over(Window.partitionBy("new_name"))).select("il", "ilce", "rol", F.when(F.col("c") > 1, F.concat("new_name", F.lit(" ("), "rol", F.lit(")"))).otherwise(F.col("new_name")).alias("name")),
    "join01_left": lambda s, d: read(s, d, "customer").join(read(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "c_name", "n_name"),
    "join05_blocked_pairs": suppliers_alike,
    "join06_not_seen": manual_gone,
    "join11_nearest": nearest_vectors,
    "join15_three_way": lambda s, d: read(s, d, "nation").select(F.col("n_name").alias("il"), "n_nationkey").join(read(s, d, "supplier").groupBy("s_nationkey").agg(F.count("*").alias("points")), F.col("n_nationkey") == F.col("s_nationkey"), "left").join(read(s, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("sales")), F.col("n_nationkey") == F.col("c_nationkey"), "left").select("il", F.coalesce("points", F.lit(0)).alias("points"), F.coalesce("sales", F.lit(0)).alias("sales")).filter("points > 0 OR sales > 3"),
    "join17_key_union": lambda s, d: read(s, d, "supplier").select(F.col("s_nationkey").alias("k")).distinct().withColumn("a", F.lit(1)).join(read(s, d, "customer").select(F.col("c_nationkey").alias("k")).distinct().withColumn("b", F.lit(1)), "k", "full_outer").select("k", F.coalesce("a", F.lit(0)).alias("in_a"), F.coalesce("b", F.lit(0)).alias("in_b")),
    "ded01_signature": dedup_signature,
    "ded02_unique_key": unique_keys,
    "sort05_nulls_last": lambda s, d: read(s, d, "orders").orderBy(F.coalesce(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")), F.lit(-1.0)).desc(), "o_orderkey").limit(50).select("o_orderkey"),
    "sort06_feed": lambda s, d: read(s, d, "events").orderBy(F.col("event_id").desc()).limit(50).select("event_id", "event_type"),
    "src09_json": lambda s, d: read(s, d, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "long").alias("k")),
    "src14_fill_forward": filled_forward,
    "src16_links": lambda s, d: extract.page_links(read(s, d, "pages")).groupBy("url").agg(F.count("*").alias("n")),
    "src15_best_group": pages_best,
    "src24_flags": event_flags,
    "snk05_payload": lambda s, d: sinks.payload(read(s, d, "nation").select(F.col("n_regionkey"), "n_nationkey", "n_name"), "n_regionkey"),
    "sta02_anomaly": day_anomalies,
    "sta03_merge": scd_counts,
    "sta03_events": lambda s, d: merged(s, d)[1].groupBy("marka", "tip").agg(F.count("*").alias("n")),
    "mrg03_log": lambda s, d: store.append_log(read(s, d, "events").filter("event_id < 500").select("event_id", "event_type"), read(s, d, "events").filter("event_id > 200").select("event_id", "event_type"), "event_id"),
    "sch03_plan": nation_plan,
    "er01_firm_groups": lambda s, d: identity.firm_groups(read(s, d, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("Firma"), F.floor(F.col("c_custkey") / 16).cast("string")).alias("bayi_adi"), (F.col("c_nationkey") % 5).cast("string").alias("il"), F.lit("").alias("ilce"), F.concat(F.lit("Yol Sok. No: "), (F.col("c_custkey") % 4 + 1).cast("string")).alias("adres"), F.lit("").alias("telefon"))),
}

ORACLES = {
    "er01_firm_groups": "WITH r AS (SELECT c_custkey AS id, c_custkey // 16 AS f, c_nationkey % 5 AS il, c_custkey % 4 AS no FROM customer), g AS (SELECT *, min(id) OVER (PARTITION BY f, il, no) AS t FROM r) SELECT id, (dense_rank() OVER (PARTITION BY f, il ORDER BY length('Yol Sok. No: ' || (no + 1)) DESC, t) - 1)::INT AS firma_no, t AS temsilci FROM g",
    "fn02_fold": f"SELECT doc_id, md5({FOLD.format('text')}) AS key FROM documents",
    "fn03_title": "SELECT p_partkey, array_to_string(list_transform(list_filter(regexp_split_to_array(lower(translate(p_name, 'IİĞÜŞÖÇ', 'ıiğüşöç')), '\\s+'), lambda w: w <> ''), lambda w: upper(translate(w[1], 'iığüşöç', 'İIĞÜŞÖÇ')) || w[2:]), ' ') AS title FROM part",
    "fn09_phone": f"WITH c AS (SELECT c_custkey, {RAW_PHONE} AS w FROM customer), x AS (SELECT c_custkey, CASE WHEN w LIKE '%/%' THEN trim(string_split(w, '/')[1]) ELSE w END AS r FROM c), p AS (SELECT c_custkey, {CLEAN_PHONE} AS phone FROM x) SELECT c_custkey, phone, CASE WHEN phone LIKE '+90%' AND length(phone) = 13 THEN '0' || phone[4:6] || ' ' || phone[7:9] || ' ' || phone[10:11] || ' ' || phone[12:13] ELSE phone END AS shown FROM p",
    "fn27_backoff": "SELECT n_nationkey, least(3 * pow(2.0, greatest(n_nationkey % 6, 1) - 1), 24.0) AS hours FROM nation",
    "fn30_slug": f"SELECT c_custkey, replace({FOLD.format('c_name')}, ' ', '-') AS slug FROM customer",
    "fil05_needles": f"SELECT doc_id FROM documents WHERE contains({FOLD.format('text')}, 'released under') OR contains({FOLD.format('text')}, 'mit license')",
    "fil08_machine_url": "SELECT page_id FROM pages WHERE NOT regexp_matches(lower(url), '(/api/|/ajax|/wp-json/|graphql|\\.json(\\?|$)|\\.xml(\\?|$)|admin-ajax)')",
    "fil09_search": f"WITH {POINTS} SELECT marka, count(*) AS n FROM pts WHERE contains({FOLD.format('concat_ws(chr(32), marka, ad, il, adres)')}, 'nation 7') GROUP BY 1",
    "fil11_localise": f"WITH {POINTS}, g AS (SELECT DISTINCT il, ilce, rol, CASE WHEN ilce <> '' THEN ilce ELSE il END || ' Fabrika' AS nn FROM pts) SELECT il, ilce, rol, CASE WHEN count(*) OVER (PARTITION BY nn) > 1 THEN nn || ' (' || rol || ')' ELSE nn END AS name FROM g",
    "join01_left": "SELECT c_custkey, c_name, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
    "join05_blocked_pairs": "WITH r AS (SELECT c_custkey AS id, c_custkey % 40 AS f, c_nationkey % 5 AS il, c_custkey % 8 AS ilce, c_custkey % 3 AS y, c_custkey % 4 + 1 AS no FROM customer) SELECT a.id AS a, b.id AS b FROM r a JOIN r b ON a.id < b.id AND a.f = b.f AND a.il = b.il AND a.ilce = b.ilce AND a.no = b.no",
    "join06_not_seen": "SELECT c_custkey, c_mktsegment FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND year(o_orderdate) = 1996)",
    "join11_nearest": "WITH e AS (SELECT vec_id, (embedding[1] * 10 + 39)::DOUBLE AS lat, (embedding[2] * 10 + 35)::DOUBLE AS lng FROM embeddings), d AS (SELECT vec_id, " + ", ".join(f"{_HAV.format('', y, x)} AS {n}" for n, y, x in (("a", 39.0, 35.0), ("b", 40.0, 33.0), ("c", 38.0, 27.0), ("d", 41.0, 29.0), ("e", 37.0, 37.0))) + " FROM e) SELECT vec_id, CASE WHEN least(a, b, c, d, e) > 400 THEN '' WHEN a = least(a, b, c, d, e) THEN 'a' WHEN b = least(a, b, c, d, e) THEN 'b' WHEN c = least(a, b, c, d, e) THEN 'c' WHEN d = least(a, b, c, d, e) THEN 'd' ELSE 'e' END AS place FROM d",
    "join15_three_way": "WITH s AS (SELECT s_nationkey, count(*) AS points FROM supplier GROUP BY 1), c AS (SELECT c_nationkey, count(*) AS sales FROM customer GROUP BY 1) SELECT n_name AS il, coalesce(points, 0) AS points, coalesce(sales, 0) AS sales FROM nation LEFT JOIN s ON n_nationkey = s_nationkey LEFT JOIN c ON n_nationkey = c_nationkey WHERE coalesce(points, 0) > 0 OR coalesce(sales, 0) > 3",
    "join17_key_union": "WITH a AS (SELECT DISTINCT s_nationkey AS k, 1 AS a FROM supplier), b AS (SELECT DISTINCT c_nationkey AS k, 1 AS b FROM customer) SELECT k, coalesce(a, 0) AS in_a, coalesce(b, 0) AS in_b FROM a FULL JOIN b USING (k)",
    "ded01_signature": f"SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY lang, substr({FOLD.format('text')}, 1, 60) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1",
    "ded02_unique_key": f"SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN {FOLD.format('c_mktsegment')} || '|+90' || c_custkey || '|' || substr(" + FOLD.format("c_name || ' Sok. No:' || c_nationkey") + f", 1, 80) || '|' || substr({FOLD.format('c_name')}, 1, 40) ELSE {FOLD.format('c_mktsegment')} || '|' || substr({FOLD.format('c_name')}, 1, 40) || '|' || substr(" + FOLD.format("c_name || ' Sok. No:' || c_nationkey") + ", 1, 80) END AS k FROM customer",
    "sort05_nulls_last": "SELECT o_orderkey FROM orders ORDER BY CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE -1 END DESC, o_orderkey LIMIT 50",
    "sort06_feed": "SELECT event_id, event_type FROM events ORDER BY event_id DESC LIMIT 50",
    "src09_json": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "src14_fill_forward": "SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS after FROM events",
    "src16_links": "SELECT url, sum(len(regexp_extract_all(html, '(?is)<a\\b[^>]*?href\\s*=\\s*[\"''][^\"'']*[\"''][^>]*>.*?</a>')))::BIGINT AS n FROM pages GROUP BY url HAVING n > 0",
    "src24_flags": "WITH e AS (SELECT user_id, bool_or(event_type = 'purchase') AS a, bool_or(event_type = 'click') AS b FROM events GROUP BY 1) SELECT user_id, CASE WHEN a AND b THEN 'satis_servis' WHEN a THEN 'satis' WHEN b THEN 'servis' ELSE '' END AS rol FROM e",
    "sta02_anomaly": "WITH n AS (SELECT event_type, ts::DATE AS day, count(*) AS n FROM events GROUP BY 1, 2), p AS (SELECT *, coalesce(lag(n) OVER (PARTITION BY event_type ORDER BY day), 0) AS expected FROM n) SELECT event_type, day::VARCHAR AS day, n, expected, CASE WHEN n = 0 THEN 'hatali' WHEN expected > 0 AND n < 0.6 * expected THEN 'karantina' ELSE 'basarili' END AS state FROM p",
    "sta03_merge": f"WITH {_MERGE} SELECT marka, CASE WHEN n THEN 'aktif' WHEN miss + 1 >= 3 THEN 'kaldirildi' ELSE 'dogrulanamadi' END AS durum, (CASE WHEN n THEN 0 ELSE miss + 1 END)::INT AS kayip_sayaci, CASE WHEN o AND n THEN CASE WHEN nrol = rol THEN rol ELSE 'satis_servis' END WHEN n THEN nrol ELSE rol END AS rol, count(*) AS n FROM m GROUP BY ALL",
    "sta03_events": f"WITH {_MERGE}, e AS (SELECT marka, unnest(list_filter([CASE WHEN n AND NOT o THEN 'eklendi' END, CASE WHEN n AND o AND unver THEN 'geri_geldi' END, CASE WHEN n AND o AND nrol <> rol THEN 'rol_degisti' END, CASE WHEN o AND NOT n AND miss + 1 >= 3 THEN 'kaldirildi' END], lambda x: x IS NOT NULL)) AS tip FROM m) SELECT marka, tip, count(*) AS n FROM e GROUP BY 1, 2",
    "mrg03_log": "SELECT event_id, event_type FROM events",
    "sch03_plan": "WITH b AS (SELECT n_name AS marka, round((n_nationkey * 7 % 81 + 1) * 3.2 / 60, 1) AS minutes, n_regionkey % 3 AS priority FROM nation) SELECT marka, minutes::DOUBLE AS minutes, (1704067200 + floor(coalesce(sum(minutes * 60 + 180) OVER (ORDER BY priority, marka ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1e-6))::BIGINT AS start, ((row_number() OVER (ORDER BY marka) - 1) % 7)::INT AS slot FROM b",
}
