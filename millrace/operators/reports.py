"""Reports over points: marka, kod, ad, il, ilce, rol, tel, adres, durum, ord. Each is one aggregate plan; ratios are null
where their base is 0. rol is satis, servis or satis_servis; missing text is empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import text



def sells() -> Column:
    return F.col("rol").isin("satis", "satis_servis")


def serves() -> Column:
    return F.col("rol").isin("servis", "satis_servis")


def role_columns(sales: Column, service: Column) -> list[Column]:
    count = lambda test, name: F.count_if(test).alias(name)
    return [count(sales & ~service, "only_sales"), count(service & ~sales, "only_service"), count(sales & service, "both"), count(sales, "sales_points"), count(service, "service_points"), F.count("*").alias("total")]


def role_counts(points: DataFrame, *by: str) -> DataFrame:
    return points.groupBy(*by).agg(*role_columns(sells(), serves()))


def firm_key() -> Column:
    """The code, else name and place."""
    return F.when(text("kod") != "", F.col("kod")).otherwise(F.concat_ws("|", F.lit("x"), text("ad"), text("il"), text("ilce")))


def firm_counts(points: DataFrame, *by: str) -> DataFrame:
    """role_counts() of distinct firms: a firm has the roles of all its rows."""
    firms = points.groupBy(*by, firm_key().alias("_firm")).agg(F.bool_or(sells()).alias("_s"), F.bool_or(serves()).alias("_v"))
    return firms.groupBy(*by).agg(*role_columns(F.col("_s"), F.col("_v")))


def firms(points: DataFrame) -> DataFrame:
    """A row a firm: longest name and address (the first of equals), place and phone of the first row, brands by role."""
    longest = lambda c: F.max_by(c, F.struct(F.length(c), -F.col("ord"))).alias(c)
    first = lambda c: F.min_by(c, "ord").alias(c)
    brands = lambda test, name: F.array_join(F.array_sort(F.collect_set(F.when(test, F.col("marka")))), ",").alias(name)
    return points.groupBy(firm_key().alias("firm")).agg(longest("ad"), longest("adres"), first("il"), first("ilce"), first("tel"), brands(sells(), "sales_brands"), brands(serves(), "service_brands"), F.count_distinct("marka").alias("n_brands"))


def several_brands(points: DataFrame, brand: str) -> DataFrame:
    """firm, brands of firms with two brands or more, the given one first."""
    sets = points.groupBy(firm_key().alias("firm")).agg(F.array_sort(F.collect_set("marka")).alias("b")).filter(F.size("b") >= 2)
    led = F.when(F.array_contains("b", brand), F.concat(F.array(F.lit(brand)), F.array_remove("b", brand))).otherwise(F.col("b"))
    return sets.select("firm", F.array_join(led, ",").alias("brands"))


def brand_summary(points: DataFrame) -> DataFrame:
    """Role counts of each brand and its provinces and districts, in all and by role; a row without a province has none, and one
    without a district no district. Two levels: a place once with its roles, then a province once, so nothing is expanded."""
    s, v = sells(), serves()
    counts = [F.count_if(s & ~v).alias("only_sales"), F.count_if(v & ~s).alias("only_service"), F.count_if(s & v).alias("both"), F.count("*").alias("total")]
    places = points.groupBy("marka", text("il").alias("il"), text("ilce").alias("ilce")).agg(*counts)
    sums = [F.sum(c).alias(c) for c in ("only_sales", "only_service", "both", "total")]
    sold, served = F.col("only_sales") + F.col("both") > 0, F.col("only_service") + F.col("both") > 0
    district = F.col("ilce") != ""
    provinces = places.groupBy("marka", "il").agg(F.count_if(district).alias("d"), F.count_if(district & sold).alias("ds"), F.count_if(district & served).alias("dv"), *sums)
    named = F.col("il") != ""
    out = provinces.groupBy("marka").agg(*sums, F.count_if(named).alias("n_il"), F.sum("d").alias("n_ilce"), F.count_if(named & sold).alias("n_il_sales"), F.count_if(named & served).alias("n_il_service"), F.sum("ds").alias("n_ilce_sales"), F.sum("dv").alias("n_ilce_service"))
    points_of = [(F.col(x) + F.col("both")).alias(y) for x, y in (("only_sales", "sales_points"), ("only_service", "service_points"))]
    return out.select("marka", "only_sales", "only_service", "both", *points_of, "total", "n_il", "n_ilce", "n_il_sales", "n_il_service", "n_ilce_sales", "n_ilce_service")


def breakdown(points: DataFrame, by: str, top: int | None = None) -> DataFrame:
    """Rows and distinct brands by a column, most first; top is a report's length."""
    out = points.filter(text(by) != "").groupBy(by).agg(F.count("*").alias("total"), F.count_distinct("marka").alias("n_brands"))
    return out.orderBy(F.col("total").desc(), by).limit(top) if top else out


def overview(points: DataFrame, provinces: int = 81) -> DataFrame:
    share = lambda test: F.round(F.try_divide(100 * F.count_if(test), F.count("*")), 2)
    n_il = F.count_distinct(F.when(text("il") != "", F.col("il")))
    return points.agg(*role_columns(sells(), serves()), share(text("tel") != "").alias("phone_pct"), share(text("ilce") != "").alias("ilce_pct"), n_il.alias("n_il"), F.round(100 * n_il / provinces, 2).alias("il_pct"), F.count_distinct("marka").alias("n_brands"), F.count_if(F.col("durum") != "aktif").alias("stale"))


def with_totals(points: DataFrame, by: str) -> DataFrame:
    """role_counts() by a column and a row TOPLAM, in one rollup."""
    out = points.rollup(by).agg(*role_columns(sells(), serves()), F.count_distinct("marka").alias("n_brands"), F.grouping(by).alias("_all"))
    return out.withColumn(by, F.when(F.col("_all") == 1, "TOPLAM").otherwise(F.col(by))).drop("_all")


def matrix(points: DataFrame) -> DataFrame:
    """il by marka with a column for each role."""
    return points.groupBy("il", "marka").pivot("rol", ["satis", "servis", "satis_servis"]).agg(F.count(F.lit(1))).na.fill(0)


def chips(points: DataFrame) -> DataFrame:
    """The six overlapping role filters of a page, in one pass."""
    r = F.col("rol")
    return points.agg(F.count("*").alias("all_"), F.count_if(sells()).alias("sales"), F.count_if(serves()).alias("service"), F.count_if(r == "satis").alias("only_sales"), F.count_if(r == "servis").alias("only_service"), F.count_if(r == "satis_servis").alias("both"))


def per_point(points: DataFrame, sales: DataFrame, by: str, years: list[int], partial: int, months: int) -> DataFrame:
    """Yearly sales for each distinct firm, monthly averages, and the change of the last full year to the partial one.
    sales: by, yil, adet. Rows without points are left out."""
    n = points.groupBy(by).agg(F.count_distinct(firm_key()).alias("n_points"))
    s = sales.groupBy(by).pivot("yil", [*years, partial]).agg(F.sum("adet"))
    full, part = F.col(str(years[-1])) / F.col("n_points") / 12, F.col(str(partial)) / F.col("n_points") / months
    out = n.join(s, by, "left").filter("n_points > 0")
    yearly = [F.round(F.col(str(y)) / F.col("n_points"), 0).alias(f"y{y}") for y in years]
    return out.select(by, "n_points", *yearly, F.round(part, 4).alias("monthly_now"), F.round(full, 4).alias("monthly_before"), F.round(F.when(full > 0, 100 * (part - full) / full), 2).alias("change_pct"))


def health(brands: DataFrame, points: DataFrame) -> DataFrame:
    """aktif, supheli, dusen, toplam of every brand, also of those without points."""
    state = lambda s, name: F.count_if(F.coalesce(F.col("durum") == s, F.lit(False))).alias(name)
    out = brands.select("marka").join(points.select("marka", "durum"), "marka", "left").groupBy("marka").agg(state("aktif", "aktif"), state("dogrulanamadi", "supheli"), state("kaldirildi", "dusen"))
    return out.withColumn("toplam", F.col("aktif") + F.col("supheli"))


def name_repeats(points: DataFrame, share: float = 0.15, least: int = 3) -> DataFrame:
    """marka, ad, n of names that make up so much of their brand."""
    n = points.groupBy("marka", "ad").agg(F.count("*").alias("n"))
    all_ = n.groupBy("marka").agg(F.sum("n").alias("_all"))
    return n.join(all_, "marka").filter((F.col("n") >= least) & (F.col("n") >= share * F.col("_all")) & (F.col("ad") != "")).drop("_all")


def empty_majority(rows: DataFrame, *columns: str) -> DataFrame:
    """field, share of fields that are empty in more than half of the rows."""
    shares = rows.agg(*(F.avg((text(c) == "").cast("double")).alias(c) for c in columns))
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.round(F.col(c), 6).alias("share")) for c in columns)))
    return shares.select(pairs.alias("x")).select("x.*").filter("share > 0.5")


def growth(before: DataFrame, after: DataFrame, least: int = 20) -> DataFrame:
    """Brands that grew over 1.3 times or shrank under 0.6 times. before, after: marka, n."""
    both = before.select("marka", F.col("n").alias("n_before")).join(after.select("marka", F.col("n").alias("n_after")), "marka", "left").na.fill(0, ["n_after"])
    ratio = F.col("n_after") / F.col("n_before")
    return both.filter((F.col("n_before") >= least) & ((ratio > 1.3) | (ratio < 0.6))).withColumn("warning", F.when(ratio > 1.3, "grew").otherwise("shrank"))
