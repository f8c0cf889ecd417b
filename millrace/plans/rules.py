"""Queries of the text, place, store and order rules over records made from the given tables, and SQL by the same rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import places
from millrace.functions import text as T
from millrace.operators import brands, identity, schedule, store
from millrace.operators import views as W

from .points import POINTS, dealt, points, read
from .records import FOLD

#: Words around which texts with faults are made; both engines read these expressions.
CITY = "element_at(array('Zonguldak', 'Çorum', 'Iğdır', 'İzmir', 'Şırnak', 'Sivas', 'Ordu', 'Çankırı', 'Ömerli', 'Denizli', 'ağrı', 'Üsküdar'), cast(c_custkey % 12 AS INT) + 1)"
_CITY = "(['Zonguldak', 'Çorum', 'Iğdır', 'İzmir', 'Şırnak', 'Sivas', 'Ordu', 'Çankırı', 'Ömerli', 'Denizli', 'ağrı', 'Üsküdar'])[(c_custkey % 12 + 1)::INT]"
_TURKISH = "['ağrı', 'Çankırı', 'Çorum', 'Denizli', 'Iğdır', 'İzmir', 'Ordu', 'Ömerli', 'Sivas', 'Şırnak', 'Üsküdar', 'Zonguldak']"
LABEL = "element_at(array('Yetkili Servis', 'SATIŞ NOKTASI', 'Bayi ve Servis', 'Yedek Parça', 'Showroom', 'Merkez Ofis', 'Servis Ağı', 'Bayi Girişi', ''), cast(c_custkey % 9 AS INT) + 1)"
_LABEL = "(['Yetkili Servis', 'SATIŞ NOKTASI', 'Bayi ve Servis', 'Yedek Parça', 'Showroom', 'Merkez Ofis', 'Servis Ağı', 'Bayi Girişi', ''])[(c_custkey % 9 + 1)::INT]"
DAY0 = "TIMESTAMP '2024-03-10 12:00:00'"


def customers(s: SparkSession, d: str, *columns: str) -> DataFrame:
    return dealt(read(s, d, "customer")).selectExpr("c_custkey", *columns)


def fn01_case(s: SparkSession, d: str) -> DataFrame:
    t = F.concat_ws(" ", "city", "c_name")
    return customers(s, d, f"{CITY} AS city", "c_name").select("c_custkey", T.tr_lower(t).alias("low"), T.tr_upper(t).alias("up"))


def fn04_repairs(s: SparkSession, d: str) -> DataFrame:
    """City names in UTF-8 read as Latin-1, in Latin-5 read as Latin-1, and whole ones."""
    wrong = F.when(F.col("c_custkey") % 3 == 0, F.decode(F.encode("city", "UTF-8"), "ISO-8859-1")).when(F.col("c_custkey") % 3 == 1, F.translate("city", T.LATIN5_RIGHT, T.LATIN5_WRONG)).otherwise(F.col("city"))
    c = customers(s, d, f"{CITY} AS city").withColumn("wrong", wrong)
    return c.select("c_custkey", T.repair_mojibake(F.col("wrong")).alias("mojibake"), T.repair_latin5(F.col("wrong")).alias("latin5"), T.clean_text(F.concat(F.lit("  &quot;"), F.col("wrong"), F.lit("&#39;&nbsp; x &amp; y "))).alias("clean"))


def fn07_address(s: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey") % 5
    raw = F.concat(F.when(k == 0, "Adres: Adres - ").when(k == 1, "ADDRESS ").otherwise(""), F.col("c_name"), F.lit(" Cad. No: "), F.col("c_custkey").cast("string"), F.when(k == 2, " Tel: ").when(k == 0, " GSM E-posta: ").otherwise(" ,"))
    return read(s, d, "customer").select("c_custkey", T.clean_address(raw).alias("address"))


def fn11_places(s: SparkSession, d: str) -> DataFrame:
    """Provinces by name, alias, first word, combined with a district in either order, in a text, and abroad."""
    k = F.col("c_custkey") % 12
    cell = F.when(k < 3, "ISTANBUL").when(k == 3, "Afyon").when(k == 4, "Konya Merkez").when(k == 5, "yok böyle").when(k == 6, "Kıbrıs").otherwise("İzmir")
    both = F.when(k % 4 == 0, "Bornova / İzmir").when(k % 4 == 1, "İzmir - Bornova").when(k % 4 == 2, "bornova").otherwise("")
    free = F.when(k % 3 == 0, "Ankara Yolu 5. km Bursa").when(k % 3 == 1, "Eski Konya Caddesi, Kahramanmaraş").otherwise("hiçbir yer")
    c = customers(s, d)
    place = places.split_place(both)
    return c.select("c_custkey", places.resolve_province(cell).alias("il"), places.abroad(cell).alias("abroad"), place["il"].alias("split_il"), place["ilce"].alias("split_ilce"), places.province_in_text(free).alias("free"))


def fn14_districts(s: SparkSession, d: str) -> DataFrame:
    """Districts of nations: the rightmost that an address names, not before a street word."""
    dim = read(s, d, "nation").select(F.concat(F.lit("Merkez"), F.col("n_nationkey").cast("string")).alias("ilce"), F.concat(F.lit("Bolge"), F.col("n_regionkey").cast("string")).alias("il"))
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    second = F.concat(F.lit("Merkez"), ((F.col("c_nationkey") + 5) % 25).cast("string"))
    c = read(s, d, "customer").select("c_custkey", F.concat(F.lit("Merkez"), n, F.lit(" No 4 "), second, F.when(k % 3 == 0, " Mah").otherwise("")).alias("adres"), F.lit("").alias("il"))
    return places.district_in_text(c, dim).select("c_custkey", "ilce_adres")


def fn17_roles(s: SparkSession, d: str) -> DataFrame:
    c = customers(s, d, f"{LABEL} AS label")
    mapping = {"showroom": "satis", "servis ağı": "servis", "ofis": "satis_servis"}
    return c.select("c_custkey", T.role_of_label(F.col("label")).alias("by_label"), T.role_of_heading(F.col("label"), "satis").alias("by_heading"), T.role_of_type(F.col("label"), mapping).alias("by_type"))


def fn20_addresses(s: SparkSession, d: str) -> DataFrame:
    """What tells addresses and names apart, and how alike neighbours by key are."""
    k = F.col("c_custkey")
    adres = F.concat(F.lit("Gul"), (k % 7).cast("string"), F.lit(" Mahallesi Cam Sokak No: "), (k % 90).cast("string"), F.when(k % 4 == 0, " Sevkiyat Adresi: Depo 3").otherwise(""))
    c = read(s, d, "customer").select("c_custkey", adres.alias("adres"), F.concat(F.lit("Yildiz "), (k % 5).cast("string"), F.lit(" Motor San. Tic. Ltd. Sti. (Merkez)")).alias("ad"))
    return c.select("c_custkey", identity.door(F.col("adres")).alias("door"), identity.main_address(F.col("adres")).alias("main"), F.array_join(identity.address_tokens(F.col("adres")), "+").alias("tokens"), identity.name_core(F.col("ad")).alias("core"), F.array_join(identity.distinctive(F.col("ad")), "+").alias("telling"))


def fn24_phones(s: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    t = F.concat(F.lit("a "), F.when(k % 3 == 0, "0(312) 555 12 34").when(k % 3 == 1, "1312 555 12 34").otherwise("90312555123412"), F.lit(" b "), F.when(k % 2 == 0, "+90 532 111 22 33").otherwise("x"))
    return read(s, d, "customer").select("c_custkey", T.phone_count(t).cast("long").alias("n"))


def fn26_freshness(s: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    state = F.when(k % 11 == 0, "kaldirildi").when(k % 11 == 1, "dogrulanamadi").otherwise("aktif")
    good = F.when(k % 7 == 0, F.lit(None)).otherwise(F.expr(f"{DAY0} - make_interval(0, 0, 0, 0, cast(o_orderkey % 300 AS INT), 0, 0)"))
    last = F.when(k % 5 == 0, "hatali").when(k % 5 == 1, "kismi").when(k % 5 == 2, "karantina").otherwise("basarili")
    return read(s, d, "orders").select("o_orderkey", T.freshness(state, k % 13 == 0, good, last, F.expr(DAY0)).alias("label"))


def sch01_due(s: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    good = F.when(k % 9 == 0, F.lit(None)).otherwise(F.expr(f"{DAY0} - make_interval(0, 0, 0, 0, cast(o_orderkey % 400 AS INT), 0, 0)"))
    tried = F.expr(f"{DAY0} - make_interval(0, 0, 0, 0, cast(o_orderkey % 30 AS INT), 0, 0)")
    last = F.when(k % 5 == 0, "hatali").when(k % 5 == 1, "karantina").otherwise("basarili")
    told = schedule.due(good, tried, last, (k % 5).cast("int"), F.when(k % 2 == 0, 168).otherwise(24), (k % 7).cast("int"), (k % 3).cast("int"), F.expr(DAY0))
    return read(s, d, "orders").select("o_orderkey", told.alias("t")).select("o_orderkey", "t.due", "t.why")


def sta05_brand_states(s: SparkSession, d: str) -> DataFrame:
    """Parts as brands with what was known of their scans; of most a new scan."""
    k = F.col("p_partkey")
    time = lambda day: F.lit(f"2024-03-{day} 00:00:00").cast("timestamp")
    p = read(s, d, "part")
    held = p.filter("p_partkey % 7 <> 0").select(k.cast("string").alias("marka"), time("01").alias("son_basarili"), F.when(k % 3 == 0, 0).otherwise(F.col("p_size")).cast("long").alias("son_basarili_adet"), time("02").alias("son_deneme"), F.lit("kismi").alias("son_deneme_durum"), (k % 4).cast("int").alias("ardisik_hata"), (k % 2 == 0).alias("karantina"))
    scans = p.filter("p_partkey % 11 <> 0").select(k.cast("string").alias("marka"), F.when(k % 5 == 0, 0).otherwise(k % 40).cast("long").alias("adet"), F.when(k % 6 == 0, 0.5).otherwise(1.0).alias("kapsam"), (k % 17 == 0).alias("elle"), time("09").alias("bitis"))
    out = brands.after(held, brands.judged(held, scans))
    day = lambda c: F.date_format(c, "dd").alias(c)
    return out.select("marka", day("son_basarili"), F.coalesce("son_basarili_adet", F.lit(-1)).alias("son_basarili_adet"), day("son_deneme"), "son_deneme_durum", "ardisik_hata", "karantina")


def sta06_manual(s: SparkSession, d: str) -> DataFrame:
    """A hand-kept list of two segments' customers with an even key: the others of the two go."""
    c = read(s, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("marka"), F.upper("c_name").alias("bayi_adi"), F.lit("Merkez").alias("ilce"), F.lit("aktif").alias("durum"))
    listed = c.filter("k % 2 = 0 AND marka IN ('BUILDING', 'MACHINERY')").withColumn("bayi_adi", F.lower("bayi_adi"))
    return store.replace_manual(c, listed.drop("k")).select("k", "durum")


def ded03_same_keys(s: SparkSession, d: str) -> DataFrame:
    """Orders as rows of their customer: the earliest survives, blanks filled from the next."""
    k = F.col("o_orderkey")
    o = read(s, d, "orders").select(F.col("o_custkey").cast("string").alias("tekil_key"), k.alias("id"), F.when(k % 3 == 0, F.concat(F.lit("t"), k.cast("string"))).otherwise("").alias("telefon"), F.when(k % 5 == 0, F.col("o_orderpriority")).alias("email"), F.col("o_orderdate").alias("son"), F.when(k % 4 == 0, "servis").when(k % 4 == 1, "satis").otherwise("").alias("rol"))
    out = identity.merge_same_keys(o, "tekil_key", "id", ["telefon", "email"], "son", "rol")
    return out.withColumn("son", F.date_format("son", "yyyy-MM-dd"))


def mrg01_parts(s: SparkSession, d: str) -> DataFrame:
    """Orders by customer in two parts over customers: the last part wins, but what base alone keeps stays."""
    c = read(s, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("telefon"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("email"))
    o = read(s, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("telefon"), F.lit("part").alias("email"), F.col("o_orderkey").alias("sira"))
    return store.merge_parts(c, o, "k", ["email"], "sira")


def cln_rows(s: SparkSession, d: str) -> DataFrame:
    """Customers as unverified and active rows of few brands, with labels as names, twins, moved ones and old ones."""
    k = F.col("c_custkey")
    pair = F.floor(k / 2).cast("string")
    t = lambda x: F.lit(x).cast("timestamp")
    rows = read(s, d, "customer").select(
        k.cast("string").alias("tekil_key"), (F.floor(k / 2) % 3).cast("string").alias("marka"), F.when(k % 14 == 2, "Yetkili Servis").when(k % 14 == 4, "0312 000 00 00").otherwise(F.concat(F.lit("Firma"), pair, F.lit(" Yildiz"))).alias("bayi_adi"), F.lit("Konya").alias("il"), F.lit("").alias("ilce"),
        F.concat(F.lit("Yol"), pair, F.lit(" Cad. No: "), F.when(k % 4 < 2, 5).otherwise(k % 2).cast("string")).alias("adres"), F.when(k % 6 < 4, F.concat(F.lit("t"), pair)).otherwise("").alias("telefon"),
        F.when(k % 2 == 0, "dogrulanamadi").otherwise("aktif").alias("durum"), F.when(k % 10 == 0, t("2024-01-05")).otherwise(t("2024-03-03")).alias("son_gorulme"),
    )
    day = F.explode(F.array(*(F.lit(f"2024-03-0{x}").cast("timestamp") for x in (2, 3, 4)), F.lit("2024-01-01").cast("timestamp")))
    segment = rows.select("marka").distinct()
    scans = segment.select("marka", day.alias("bitis"), F.when(F.col("marka") == "1", "kismi").otherwise("basarili").alias("durum"))
    state = segment.select("marka", (F.col("marka") == "2").alias("karantina"), F.lit("basarili").alias("son_deneme_durum"))
    return store.cleanup(rows, scans, state, ["yetkili servis"], F.lit("2024-03-10").cast("timestamp"))


QUERIES = {
    "fn01_case": fn01_case,
    "fn04_repairs": fn04_repairs,
    "fn07_address": fn07_address,
    "fn11_places": fn11_places,
    "fn14_districts": fn14_districts,
    "fn17_roles": fn17_roles,
    "fn20_addresses": fn20_addresses,
    "fn24_phones": fn24_phones,
    "fn26_freshness": fn26_freshness,
    "fn28_short_number": lambda s, d: read(s, d, "orders").select("o_orderkey", T.short_number((F.col("o_orderkey") * 977 % 3_000_000).cast("long")).alias("shown")),
    "fil02_matches": lambda s, d: customers(s, d, f"{CITY} AS city").filter(T.matches(F.col("city"), F.when(F.col("c_custkey") % 5 == 0, "").otherwise("IR"))),
    "sort01_binary": lambda s, d: W.placed(points(s, d), "marka", "il", "ilce", "ad", "ord").select("ord", "place"),
    "sort02_turkish": lambda s, d: W.placed(read(s, d, "customer").selectExpr("c_custkey", "c_nationkey", f"{CITY} AS il"), "c_nationkey", W.turkish("il"), "c_custkey").select("c_custkey", "il", "place"),
    "sort03_fold": lambda s, d: W.placed(read(s, d, "part").select("p_partkey", "p_brand", F.col("p_type").alias("ad")), "p_brand", *W.fold_order("ad"), "p_partkey").select("p_partkey", "place"),
    "sort04_chosen": lambda s, d: W.placed(read(s, d, "customer"), "c_nationkey", *W.chosen_order("c_acctbal", True, "c_name")).select("c_custkey", "place"),
    "sort09_severity": lambda s, d: W.placed(read(s, d, "customer").selectExpr("c_custkey", "c_nationkey", "c_custkey % 3 AS onem", "c_custkey % 4 AS sorunlu", f"{CITY} AS marka"), "c_nationkey", *W.severity_order(), "c_custkey").select("c_custkey", "place"),
    "sch01_due": sch01_due,
    "sta05_brand_states": sta05_brand_states,
    "sta06_manual": sta06_manual,
    "ded03_same_keys": ded03_same_keys,
    "mrg01_parts": mrg01_parts,
    "cln_rows": cln_rows,
}

_BAD = "c_custkey"
for _letter in "çÇğĞıİöÖşŞüÜ":
    _BAD = f"replace({_BAD}, '{_letter}', '{_letter.encode().decode('latin-1')}')"
_MOJIBAKE = _BAD.replace("c_custkey", "city", 1)
_TIMES = "o_orderkey AS k, o_orderkey % 300 AS h, (o_orderkey % 300) // 24 AS age"

ORACLES = {
    "fn01_case": f"WITH c AS (SELECT c_custkey, concat_ws(' ', {_CITY}, c_name) AS t FROM customer) SELECT c_custkey, lower(translate(t, 'IİĞÜŞÖÇ', 'ıiğüşöç')) AS low, upper(translate(t, 'iığüşöç', 'İIĞÜŞÖÇ')) AS up FROM c",
    "fn04_repairs": f"""WITH c AS (SELECT c_custkey, {_CITY} AS city FROM customer), w AS (SELECT c_custkey, city, CASE c_custkey % 3 WHEN 0 THEN {_MOJIBAKE} WHEN 1 THEN translate(city, '{T.LATIN5_RIGHT}', '{T.LATIN5_WRONG}') ELSE city END AS wrong FROM c)
      SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN city ELSE wrong END AS mojibake, CASE WHEN c_custkey % 3 = 1 THEN city ELSE wrong END AS latin5, '"' || city || ''' x & y' AS clean FROM w""",
    "fn07_address": "SELECT c_custkey, c_name || ' Cad. No: ' || c_custkey AS address FROM customer",
    "fn11_places": """WITH c AS (SELECT c_custkey, c_custkey % 12 AS k FROM customer)
      SELECT c_custkey, CASE WHEN k < 3 THEN 'İstanbul' WHEN k = 3 THEN 'Afyonkarahisar' WHEN k = 4 THEN 'Konya' WHEN k = 5 THEN 'Yok Böyle' WHEN k = 6 THEN 'Kıbrıs' ELSE 'İzmir' END AS il, k = 6 AS abroad, CASE WHEN k % 4 < 2 THEN 'İzmir' ELSE '' END AS split_il,
        CASE WHEN k % 4 < 3 THEN 'Bornova' ELSE '' END AS split_ilce, CASE k % 3 WHEN 0 THEN 'Bursa' WHEN 1 THEN 'Kahramanmaraş' ELSE '' END AS free FROM c""",
    "fn14_districts": "SELECT c_custkey, 'Merkez' || CASE WHEN c_custkey % 3 = 0 THEN c_nationkey ELSE (c_nationkey + 5) % 25 END AS ilce_adres FROM customer",
    "fn17_roles": f"""WITH c AS (SELECT c_custkey, {_LABEL} AS l FROM customer)
      SELECT c_custkey, CASE WHEN l = 'Bayi ve Servis' THEN 'satis_servis' WHEN l IN ('Yetkili Servis', 'Servis Ağı') THEN 'servis' WHEN l IN ('SATIŞ NOKTASI', 'Showroom', 'Bayi Girişi') THEN 'satis' ELSE '' END AS by_label,
        CASE WHEN l IN ('Yedek Parça', 'Bayi Girişi') THEN '' WHEN l = 'Bayi ve Servis' THEN 'satis_servis' WHEN l LIKE '%Servis%' THEN 'servis' ELSE 'satis' END AS by_heading,
        CASE l WHEN 'Showroom' THEN 'satis' WHEN 'Servis Ağı' THEN 'servis' WHEN 'Merkez Ofis' THEN 'satis_servis' ELSE '' END AS by_type FROM c""",
    "fn20_addresses": """SELECT c_custkey, (c_custkey % 90)::VARCHAR AS door, 'Gul' || c_custkey % 7 || ' Mahallesi Cam Sokak No: ' || c_custkey % 90 AS main, 'gul+cam' || CASE WHEN c_custkey % 90 > 9 THEN '+' || c_custkey % 90 ELSE '' END AS tokens, 'yildiz' AS core, 'yildiz' AS telling FROM customer""",
    "fn24_phones": "SELECT c_custkey, ((c_custkey % 3 = 0)::INT + (c_custkey % 2 = 0)::INT)::BIGINT AS n FROM customer",
    "fn26_freshness": f"""WITH o AS (SELECT {_TIMES} FROM orders) SELECT k AS o_orderkey, CASE WHEN k % 11 = 0 THEN 'dropped' WHEN k % 11 = 1 THEN 'unverified' WHEN k % 13 = 0 THEN 'quarantine' WHEN k % 7 = 0 AND k % 5 < 3 THEN 'failed so far' WHEN k % 7 = 0 THEN 'never scanned'
      WHEN k % 5 < 2 AND age > 0 THEN 'last good ' || age || ' days ago' WHEN k % 5 < 2 THEN 'last good today' WHEN h > 168 THEN 'old ' || age || ' days' ELSE 'current' END AS label FROM o""",
    "fn28_short_number": "WITH o AS (SELECT o_orderkey, o_orderkey * 977 % 3000000 AS n FROM orders) SELECT o_orderkey, CASE WHEN n >= 1000000 THEN replace(printf('%.1f', n / 1000000), '.', ',') || ' Mn' WHEN n >= 1000 THEN replace(printf('%.1f', n / 1000), '.', ',') || ' B' ELSE n::VARCHAR END AS shown FROM o",
    "fil02_matches": f"WITH c AS (SELECT c_custkey, {_CITY} AS city FROM customer) SELECT * FROM c WHERE c_custkey % 5 = 0 OR contains({FOLD.format('city')}, 'ir')",
    "sort01_binary": f"WITH {POINTS} SELECT ord, (row_number() OVER (PARTITION BY marka ORDER BY il, ilce, ad, ord))::INT AS place FROM pts",
    "sort02_turkish": f"WITH c AS (SELECT c_custkey, c_nationkey, {_CITY} AS il FROM customer) SELECT c_custkey, il, (row_number() OVER (PARTITION BY c_nationkey ORDER BY list_position({_TURKISH}, il), c_custkey))::INT AS place FROM c",
    "sort03_fold": f"SELECT p_partkey, (row_number() OVER (PARTITION BY p_brand ORDER BY {FOLD.format('p_type')}, p_type, p_partkey))::INT AS place FROM part",
    "sort04_chosen": "SELECT c_custkey, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_name))::INT AS place FROM customer",
    "sort09_severity": f"WITH c AS (SELECT c_custkey, c_nationkey, {_CITY} AS marka FROM customer) SELECT c_custkey, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey % 3 DESC, c_custkey % 4 DESC, list_position({_TURKISH}, marka), c_custkey))::INT AS place FROM c",
    "sch01_due": """WITH o AS (SELECT o_orderkey AS k, o_orderkey % 400 AS good, o_orderkey % 30 AS tried, CASE WHEN o_orderkey % 2 = 0 THEN 168 ELSE 24 END AS period FROM orders),
      t AS (SELECT k, CASE WHEN k % 9 = 0 THEN 'never scanned well' WHEN k % 5 < 2 AND tried < 3 THEN 'waits after a bad scan' WHEN k % 5 < 2 THEN 'again after a bad scan' WHEN good < period THEN 'within its period' WHEN period = 168 AND k % 3 <> 1 AND k % 7 <> 6 THEN 'on another weekday' ELSE 'period is over' END AS why FROM o)
      SELECT k AS o_orderkey, why IN ('never scanned well', 'again after a bad scan', 'period is over') AS due, why FROM t""",
    "sta05_brand_states": """WITH p AS (SELECT p_partkey AS k, p_partkey % 7 <> 0 AS b, p_partkey % 11 <> 0 AS s, CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN 0 ELSE p_size END AS held, CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE p_partkey % 40 END AS n FROM part),
      t AS (SELECT *, CASE WHEN k % 17 = 0 AND n > 0 THEN 'basarili' WHEN n = 0 THEN 'hatali' WHEN coalesce(held, 0) > 0 AND n < 0.6 * held THEN 'karantina' WHEN k % 6 = 0 THEN 'kismi' ELSE 'basarili' END AS state, CASE WHEN b THEN k % 4 ELSE 0 END AS streak FROM p WHERE b OR s)
      SELECT k::VARCHAR AS marka, CASE WHEN s AND state = 'basarili' THEN '09' WHEN b THEN '01' END AS son_basarili, coalesce(CASE WHEN s AND state = 'basarili' THEN n ELSE held END, -1)::BIGINT AS son_basarili_adet, CASE WHEN s THEN '09' ELSE '02' END AS son_deneme, CASE WHEN s THEN state ELSE 'kismi' END AS son_deneme_durum,
        (CASE WHEN NOT s THEN streak WHEN state = 'hatali' THEN streak + 1 WHEN state = 'basarili' THEN 0 ELSE streak END)::INT AS ardisik_hata, CASE WHEN s AND state <> 'hatali' THEN state = 'karantina' ELSE b AND k % 2 = 0 END AS karantina FROM t""",
    "sta06_manual": "SELECT c_custkey AS k, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_custkey % 2 = 1 THEN 'kaldirildi' ELSE 'aktif' END AS durum FROM customer",
    "ded03_same_keys": """SELECT o_custkey::VARCHAR AS tekil_key, min(o_orderkey) AS id, coalesce(arg_min('t' || o_orderkey, o_orderkey) FILTER (o_orderkey % 3 = 0), '') AS telefon, coalesce(arg_min(o_orderpriority, o_orderkey) FILTER (o_orderkey % 5 = 0), '') AS email, strftime(max(o_orderdate), '%Y-%m-%d') AS son,
      CASE WHEN bool_or(o_orderkey % 4 = 1) AND bool_or(o_orderkey % 4 = 0) THEN 'satis_servis' WHEN bool_or(o_orderkey % 4 = 1) THEN 'satis' WHEN bool_or(o_orderkey % 4 = 0) THEN 'servis' ELSE '' END AS rol, count(*) AS n_rows FROM orders GROUP BY o_custkey""",
    "mrg01_parts": "WITH p AS (SELECT o_custkey AS k, arg_max(o_orderpriority, o_orderkey) AS telefon FROM orders GROUP BY 1) SELECT coalesce(c_custkey, k) AS k, coalesce(telefon, c_name) AS telefon, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END, CASE WHEN k IS NOT NULL THEN 'part' END) AS email FROM customer FULL JOIN p ON k = c_custkey",
    "cln_rows": """WITH c AS (SELECT c_custkey AS k, c_custkey + 1 IN (SELECT c_custkey FROM customer) AS twin FROM customer WHERE c_custkey % 2 = 0),
      w AS (SELECT k::VARCHAR AS tekil_key, CASE WHEN k % 14 IN (2, 4) THEN 'A' WHEN twin AND k % 4 = 0 THEN 'B' WHEN twin AND k % 6 IN (0, 2) THEN 'C' WHEN k % 10 = 0 AND k // 2 % 3 = 0 THEN 'D' END AS why FROM c) SELECT * FROM w WHERE why IS NOT NULL""",
}
