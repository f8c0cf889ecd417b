"""Report queries over points that stand in for a directory: a line item is a point of a supplier (the firm) for a part's
brand, its return flag the role, the supplier's nation the province."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import reports as R


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame) -> DataFrame:
    """rows over several tasks for each core: short rows lie in few row groups, too few tasks for costly work on each of them."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism)


def points(spark: SparkSession, sf: str) -> DataFrame:
    line, part, sup, nat = (read(spark, sf, t) for t in ("lineitem", "part", "supplier", "nation"))
    j = line.join(part, line.l_partkey == part.p_partkey).join(sup, line.l_suppkey == sup.s_suppkey).join(nat, sup.s_nationkey == nat.n_nationkey)
    return j.select(
        F.col("p_brand").alias("marka"), F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("kod"), F.col("s_name").alias("ad"), F.col("n_name").alias("il"),
        F.when(F.col("l_partkey") % 7 == 0, "").otherwise(F.concat(F.lit("D"), (F.col("l_partkey") % 5).cast("string"))).alias("ilce"),
        F.when(F.col("l_returnflag") == "A", "satis").when(F.col("l_returnflag") == "R", "servis").otherwise("satis_servis").alias("rol"),
        F.when(F.col("l_linenumber") % 3 == 0, "").otherwise(F.concat(F.lit("T"), F.col("l_suppkey").cast("string"))).alias("tel"),
        F.concat(F.col("p_type"), F.lit(" "), F.col("p_size").cast("string")).alias("adres"),
        F.when(F.col("l_linestatus") == "O", "aktif").when(F.col("l_linenumber") == 1, "kaldirildi").otherwise("dogrulanamadi").alias("durum"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), F.year("l_shipdate").alias("yil"),
    )


POINTS = """pts AS (SELECT p_brand AS marka, 'S' || l_suppkey AS kod, s_name AS ad, n_name AS il,
  CASE WHEN l_partkey % 7 = 0 THEN '' ELSE 'D' || (l_partkey % 5) END AS ilce,
  CASE l_returnflag WHEN 'A' THEN 'satis' WHEN 'R' THEN 'servis' ELSE 'satis_servis' END AS rol,
  CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE 'T' || l_suppkey END AS tel, p_type || ' ' || p_size AS adres,
  CASE WHEN l_linestatus = 'O' THEN 'aktif' WHEN l_linenumber = 1 THEN 'kaldirildi' ELSE 'dogrulanamadi' END AS durum,
  l_orderkey * 10 + l_linenumber AS ord, year(l_shipdate) AS yil
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""
S, V = "(rol IN ('satis','satis_servis'))", "(rol IN ('servis','satis_servis'))"


def _roles(s: str = S, v: str = V) -> str:
    return f"count(*) FILTER ({s} AND NOT {v}) AS only_sales, count(*) FILTER ({v} AND NOT {s}) AS only_service, count(*) FILTER ({s} AND {v}) AS both, count(*) FILTER ({s}) AS sales_points, count(*) FILTER ({v}) AS service_points, count(*) AS total"


def per_point_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by nation and year for each distinct customer, with the partial year 2001 of seven months."""
    o, c, n = (read(spark, sf, t) for t in ("orders", "customer", "nation"))
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    pts = c.join(n, c.c_nationkey == n.n_nationkey).select(F.col("n_name").alias("il"), F.col("c_custkey").cast("string").alias("kod"), F.lit("").alias("ad"), F.lit("").alias("ilce"))
    sales = j.groupBy(F.col("n_name").alias("il"), F.year("o_orderdate").alias("yil")).agg(F.count("*").alias("adet"))
    return R.per_point(pts, sales, "il", [1998, 1999, 2000], 2001, 7)


QUERIES = {
    "agg02_role_counts": lambda s, d: R.role_counts(points(s, d), "marka"),
    "agg03_firm_counts": lambda s, d: R.firm_counts(points(s, d), "il"),
    "agg04_firms": lambda s, d: R.firms(points(s, d)),
    "agg05_several_brands": lambda s, d: R.several_brands(points(s, d), "Brand#17"),
    "agg06_brand_summary": lambda s, d: R.brand_summary(points(s, d)),
    "agg07_breakdown": lambda s, d: R.breakdown(points(s, d), "ilce", 60),
    "agg08_overview": lambda s, d: R.overview(points(s, d)),
    "agg09_per_point": per_point_orders,
    "agg12_role_totals": lambda s, d: R.with_totals(points(s, d), "rol"),
    "agg13_matrix": lambda s, d: R.matrix(points(s, d)),
    "agg14_province_totals": lambda s, d: R.with_totals(points(s, d), "il"),
    "agg15_brand_totals": lambda s, d: R.with_totals(points(s, d), "marka"),
    "agg16_brand_size": lambda s, d: R.breakdown(points(s, d), "marka"),
    "agg18_name_repeats": lambda s, d: R.name_repeats(points(s, d).withColumn("ad", F.col("ilce"))),
    "agg22_empty_majority": lambda s, d: R.empty_majority(points(s, d).withColumn("email", F.when(F.col("ord") % 3 == 0, "x").otherwise("")), "tel", "ilce", "email"),
    "agg23_growth": lambda s, d: R.growth(points(s, d).filter("yil = 1996").groupBy("marka").agg(F.count("*").alias("n")), points(s, d).filter("yil = 1996 AND ord % 3 = 0").groupBy("marka").agg(F.count("*").alias("n"))),
    "agg25_chips": lambda s, d: R.chips(points(s, d).filter("il = 'NATION_3'")),
    "agg01_health": lambda s, d: R.health(read(s, d, "part").select(F.col("p_brand").alias("marka")).distinct(), points(s, d)),
    "agg27_counters": lambda s, d: points(s, d).agg(F.count("*").alias("n"), F.count_distinct("marka").alias("n_brands"), F.count_distinct("il", "ilce").alias("n_places"), F.count_if(F.col("durum") != "aktif").alias("stale")),
    "agg28_region_brands": lambda s, d: points(s, d).filter("durum = 'aktif'").groupBy("il", "marka").agg(F.count_if(R.sells()).alias("sales"), F.count_if(R.serves()).alias("service")).filter("sales + service > 0"),
    "agg29_pickers": lambda s, d: points(s, d).select("marka", "il").distinct(),
    "fil01_query": lambda s, d: points(s, d).filter(F.col("durum").isin("aktif", "dogrulanamadi") & (F.lower("il") == "nation_7") & F.contains("ilce", F.lit("3")) & F.col("marka").isin("Brand#17", "Brand#2", "Brand#4")).select("marka", "il", "ilce", "ad", "ord").orderBy("marka", "il", "ilce", "ad", "ord"),
    "fil03_roles": lambda s, d: points(s, d).filter(R.sells()).groupBy("rol", "durum").agg(F.count("*").alias("n")),
}

_TOT = "SELECT CASE WHEN grouping({c}) = 1 THEN 'TOPLAM' ELSE {c} END AS {c}, " + _roles() + ", count(DISTINCT marka) AS n_brands FROM pts GROUP BY ROLLUP ({c})"
ORACLES = {
    "agg02_role_counts": f"WITH {POINTS} SELECT marka, {_roles()} FROM pts GROUP BY marka",
    "agg03_firm_counts": f"WITH {POINTS}, f AS (SELECT il, kod, bool_or{S} AS s, bool_or{V} AS v FROM pts GROUP BY il, kod) SELECT il, {_roles('s', 'v')} FROM f GROUP BY il",
    "agg04_firms": f"WITH {POINTS} SELECT kod AS firm, arg_max(ad, length(ad)::BIGINT * 1000000000 - ord) AS ad, arg_max(adres, length(adres)::BIGINT * 1000000000 - ord) AS adres, arg_min(il, ord) AS il, arg_min(ilce, ord) AS ilce, arg_min(tel, ord) AS tel, coalesce(array_to_string(list_sort(list_distinct(list(marka) FILTER {S})), ','), '') AS sales_brands, coalesce(array_to_string(list_sort(list_distinct(list(marka) FILTER {V})), ','), '') AS service_brands, count(DISTINCT marka) AS n_brands FROM pts GROUP BY kod",
    "agg05_several_brands": f"WITH {POINTS}, f AS (SELECT kod AS firm, list_sort(list_distinct(list(marka))) AS b FROM pts GROUP BY kod) SELECT firm, array_to_string(CASE WHEN list_contains(b, 'Brand#17') THEN list_concat(['Brand#17'], list_filter(b, lambda x: x <> 'Brand#17')) ELSE b END, ',') AS brands FROM f WHERE len(b) >= 2",
    "agg06_brand_summary": f"WITH {POINTS} SELECT marka, {_roles()}, count(DISTINCT il) AS n_il, count(DISTINCT CASE WHEN ilce <> '' THEN il || '|' || ilce END) AS n_ilce, count(DISTINCT il) FILTER {S} AS n_il_sales, count(DISTINCT il) FILTER {V} AS n_il_service, count(DISTINCT CASE WHEN ilce <> '' THEN il || '|' || ilce END) FILTER {S} AS n_ilce_sales, count(DISTINCT CASE WHEN ilce <> '' THEN il || '|' || ilce END) FILTER {V} AS n_ilce_service FROM pts GROUP BY marka",
    "agg07_breakdown": f"WITH {POINTS} SELECT ilce, count(*) AS total, count(DISTINCT marka) AS n_brands FROM pts WHERE ilce <> '' GROUP BY ilce ORDER BY total DESC, ilce LIMIT 60",
    "agg08_overview": f"WITH {POINTS} SELECT {_roles()}, round(100 * count(*) FILTER (tel <> '') / count(*), 2) AS phone_pct, round(100 * count(*) FILTER (ilce <> '') / count(*), 2) AS ilce_pct, count(DISTINCT il) AS n_il, round(100 * count(DISTINCT il) / 81, 2) AS il_pct, count(DISTINCT marka) AS n_brands, count(*) FILTER (durum <> 'aktif') AS stale FROM pts",
    "agg09_per_point": """WITH n AS (SELECT n_name AS il, count(DISTINCT c_custkey) AS k FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
      s AS (SELECT n_name AS il, count(*) FILTER (year(o_orderdate) = 1998) AS a, count(*) FILTER (year(o_orderdate) = 1999) AS b, count(*) FILTER (year(o_orderdate) = 2000) AS c, count(*) FILTER (year(o_orderdate) = 2001) AS d FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
      SELECT il, k AS n_points, round(nullif(a, 0) / k, 0) AS y1998, round(nullif(b, 0) / k, 0) AS y1999, round(nullif(c, 0) / k, 0) AS y2000, round(nullif(d, 0) / k / 7, 4) AS monthly_now, round(nullif(c, 0) / k / 12, 4) AS monthly_before, round(100 * (nullif(d, 0) / k / 7 - nullif(c, 0) / k / 12) / (nullif(c, 0) / k / 12), 2) AS change_pct FROM n LEFT JOIN s USING (il)""",
    "agg12_role_totals": f"WITH {POINTS} " + _TOT.format(c="rol"),
    "agg13_matrix": f"WITH {POINTS} SELECT il, marka, count(*) FILTER (rol = 'satis') AS satis, count(*) FILTER (rol = 'servis') AS servis, count(*) FILTER (rol = 'satis_servis') AS satis_servis FROM pts GROUP BY il, marka",
    "agg14_province_totals": f"WITH {POINTS} " + _TOT.format(c="il"),
    "agg15_brand_totals": f"WITH {POINTS} " + _TOT.format(c="marka"),
    "agg16_brand_size": f"WITH {POINTS} SELECT marka, count(*) AS total, count(DISTINCT marka) AS n_brands FROM pts GROUP BY marka",
    "agg18_name_repeats": f"WITH {POINTS}, n AS (SELECT marka, ilce AS ad, count(*) AS n FROM pts GROUP BY 1, 2) SELECT marka, ad, n FROM (SELECT *, sum(n) OVER (PARTITION BY marka) AS a FROM n) WHERE n >= 3 AND n >= 0.15 * a AND ad <> ''",
    "agg22_empty_majority": f"WITH {POINTS}, s AS (SELECT unnest(['tel', 'ilce', 'email']) AS field, unnest([avg((tel = '')::INT), avg((ilce = '')::INT), avg((ord % 3 <> 0)::INT)]) AS x FROM pts) SELECT field, round(x, 6) AS share FROM s WHERE round(x, 6) > 0.5",
    "agg23_growth": f"WITH {POINTS}, b AS (SELECT marka, count(*) AS n FROM pts WHERE yil = 1996 GROUP BY 1), a AS (SELECT marka, count(*) AS n FROM pts WHERE yil = 1996 AND ord % 3 = 0 GROUP BY 1) SELECT marka, b.n AS n_before, coalesce(a.n, 0) AS n_after, CASE WHEN coalesce(a.n, 0) / b.n > 1.3 THEN 'grew' ELSE 'shrank' END AS warning FROM b LEFT JOIN a USING (marka) WHERE b.n >= 20 AND (coalesce(a.n, 0) / b.n > 1.3 OR coalesce(a.n, 0) / b.n < 0.6)",
    "agg25_chips": f"WITH {POINTS} SELECT count(*) AS all_, count(*) FILTER {S} AS sales, count(*) FILTER {V} AS service, count(*) FILTER (rol = 'satis') AS only_sales, count(*) FILTER (rol = 'servis') AS only_service, count(*) FILTER (rol = 'satis_servis') AS both FROM pts WHERE il = 'NATION_3'",
    "agg01_health": f"WITH {POINTS}, b AS (SELECT DISTINCT p_brand AS marka FROM part), p AS (SELECT * FROM pts) SELECT marka, count(*) FILTER (durum = 'aktif') AS aktif, count(*) FILTER (durum = 'dogrulanamadi') AS supheli, count(*) FILTER (durum = 'kaldirildi') AS dusen, count(*) FILTER (durum IN ('aktif', 'dogrulanamadi')) AS toplam FROM b LEFT JOIN p USING (marka) GROUP BY marka",
    "agg27_counters": f"WITH {POINTS} SELECT count(*) AS n, count(DISTINCT marka) AS n_brands, count(DISTINCT il || '|' || ilce) AS n_places, count(*) FILTER (durum <> 'aktif') AS stale FROM pts",
    "agg28_region_brands": f"WITH {POINTS} SELECT il, marka, count(*) FILTER {S} AS sales, count(*) FILTER {V} AS service FROM pts WHERE durum = 'aktif' GROUP BY 1, 2",
    "agg29_pickers": f"WITH {POINTS} SELECT DISTINCT marka, il FROM pts",
    "fil01_query": f"WITH {POINTS} SELECT marka, il, ilce, ad, ord FROM pts WHERE durum IN ('aktif', 'dogrulanamadi') AND lower(il) = 'nation_7' AND ilce LIKE '%3%' AND marka IN ('Brand#17', 'Brand#2', 'Brand#4')",
    "fil03_roles": f"WITH {POINTS} SELECT rol, durum, count(*) AS n FROM pts WHERE {S} GROUP BY 1, 2",
}
