"""What a screen of the directory shows: filters, orders, pages, suggestions, brand details, corrections and the quality audit.
Points are as in `reports`; each function is one plan of built-in expressions. Missing text is empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import PHONE, fold, role_of_label, text

from .reports import firm_key, role_columns, sells, serves

NO_PROVINCE = "— il bilinmiyor —"


def per_point_by_brand(summary: DataFrame, sales: DataFrame, months: int = 8) -> DataFrame:
    """AGG-10, JOIN-16. summary: marka, n_points; sales: marka, before, now (a full year and one of so many months). A brand has data if
    either year isn't 0: then its numbers are at least 0, else null. Averages are 0 without points, the change is null then."""
    j = summary.join(sales, "marka", "left")
    has = (F.coalesce("before", F.lit(0)) != 0) | (F.coalesce("now", F.lit(0)) != 0)
    before, now, n = F.coalesce("before", F.lit(0)), F.coalesce("now", F.lit(0)), F.col("n_points")
    per = lambda x: F.when(has & (n > 0), x / n).when(has, F.lit(0.0))
    b, a = before / n / 12, now / n / months
    change = F.when(has & (n > 0) & (before != 0), F.round((a - b) / b * 100, 6))
    return j.select("marka", "n_points", has.alias("has_sales"), F.when(has, before).alias("before"), F.when(has, now).alias("now"), F.round(per(before), 0).alias("per_before"), F.round(per(now), 0).alias("per_now"), F.round(per(before) / 12, 6).alias("monthly_before"), F.round(per(now) / months, 6).alias("monthly_now"), change.alias("change_pct"))


def national_average(rows: DataFrame, *years: str) -> DataFrame:
    """AGG-11. Sums over the rows that a filter left, and for each year the sum for one point, rounded; 0 without points."""
    n = F.coalesce(F.sum("n_points"), F.lit(0))
    sums = [F.coalesce(F.sum(y), F.lit(0)).alias(f"sum_{y}") for y in years]
    return rows.agg(n.alias("n_points"), *sums, *(F.round(F.when(n > 0, F.sum(y) / n).otherwise(0.0), 0).alias(f"avg_{y}") for y in years))


def mean_coverage(sources: DataFrame) -> DataFrame:
    """AGG-20. marka, coverage: the mean over its sources, of which a failed one (null) counts 0."""
    return sources.groupBy("marka").agg(F.round(F.avg(F.coalesce("kapsam", F.lit(0.0))), 6).alias("coverage"))


def province_picker(points: DataFrame) -> DataFrame:
    """AGG-24. il, n of the provinces that have points, most first, equal ones in Turkish order."""
    return points.filter(text("il") != "").groupBy("il").agg(F.count("*").alias("n")).orderBy(F.desc("n"), turkish("il"))


def turkish(column: str) -> Column:
    """SORT-02. The column in Turkish order."""
    return F.collate(F.col(column), "tr")


def placed(rows: DataFrame, within: str, *order: Column | str) -> DataFrame:
    """rows with their place, from 1, in that order among the rows of one group."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(within).orderBy(*order)))


def fold_order(column: str) -> tuple[Column, ...]:
    """SORT-03. The matching key of a column, then the column itself."""
    return fold(F.col(column)), F.col(column)


def by_fold(rows: DataFrame, column: str) -> DataFrame:
    """SORT-03. Rows in fold_order()."""
    return rows.orderBy(*fold_order(column))


def chosen_order(key: str, descending: bool, *ties: str) -> tuple[Column, ...]:
    """SORT-04. A chosen key and direction, then the ties, ascending."""
    return (F.desc(key) if descending else F.asc(key), *(F.asc(x) for x in ties))


def ordered(rows: DataFrame, key: str, descending: bool, *ties: str) -> DataFrame:
    """SORT-04. Rows by a chosen key and direction; ties by name, ascending."""
    return rows.orderBy(*chosen_order(key, descending, *ties))


def page(rows: DataFrame, number: int, *by: str, first: int = 150, more: int = 300) -> DataFrame:
    """SORT-07. The rows that the first page, and `number` more pages, show."""
    return rows.orderBy(*by).limit(first + more * number)


def suggest(points: DataFrame, query: str, provinces: int = 4, brands: int = 4, districts: int = 4, firms: int = 5) -> DataFrame:
    """SORT-08. kind, label, place, n: a few matches of each kind for a query of two characters or more."""
    q = fold(F.lit(query))
    hit = lambda c: (F.length(q) >= 2) & F.contains(fold(F.col(c)), q)

    def few(kind: str, label: str, place: Column, by: list[str], n: int) -> DataFrame:
        found = points.filter((text(label) != "") & hit(label)).groupBy(*by).agg(F.count("*").alias("n"))
        return found.orderBy(*by).limit(n).select(F.lit(kind).alias("kind"), F.col(label).alias("label"), place.alias("place"), "n")

    out = few("il", "il", F.lit(""), ["il"], provinces).unionByName(few("marka", "marka", F.lit(""), ["marka"], brands))
    return out.unionByName(few("ilce", "ilce", F.col("il"), ["il", "ilce"], districts)).unionByName(few("bayi", "ad", F.col("il"), ["ad", "il"], firms))


def severity_order() -> tuple[Column, ...]:
    """SORT-09. Worst first, then by brand in Turkish order."""
    return F.desc("onem"), F.desc("sorunlu"), turkish("marka")


def by_severity(rows: DataFrame) -> DataFrame:
    """SORT-09. Diagnosis rows, worst first."""
    return rows.orderBy(*severity_order())


def in_districts(points: DataFrame, chosen: list[str]) -> DataFrame:
    """FIL-10. Points of the chosen districts; of all if none is chosen."""
    return points.filter(F.col("ilce").isin(*chosen)) if chosen else points


def shown(rows: DataFrame, names: dict[str, str], time: str) -> DataFrame:
    """FIL-13. The named columns under their headings, absent ones empty; the column `time` to the minute, with a blank for its T."""
    value = lambda c: text(c) if c in rows.columns else F.lit("")
    cut = lambda c: F.replace(F.substring(value(c).cast("string"), 1, 16), F.lit("T"), F.lit(" ")) if c == time else value(c)
    return rows.select(*(cut(c).alias(heading) for c, heading in names.items()))


def corrected(points: DataFrame, corrections: DataFrame) -> DataFrame:
    """FIL-14. Points with the fields that a correction of their marka, ad and il gives (null: not given). corrections: marka, ad, il, and
    yeni_<field>; one row for each key."""
    new = [c for c in corrections.columns if c.startswith("yeni_")]
    j = points.join(corrections, ["marka", "ad", "il"], "left")
    over = {c.removeprefix("yeni_"): c for c in new}
    return j.select(*(F.coalesce(F.col(over[c]), F.col(c)).alias(c) if c in over else F.col(c) for c in points.columns))


def known_brands(points: DataFrame, brands: DataFrame) -> DataFrame:
    """JOIN-14. Role counts of the brands of the directory; points of unknown brands are left out."""
    return points.join(brands.select("marka").distinct(), "marka").groupBy("marka").agg(*role_columns(sells(), serves()))


def with_codes(points: DataFrame, codes: DataFrame) -> DataFrame:
    """JOIN-18. Points with the code of their key, empty if it has none. codes: anahtar, kod; one row for each key."""
    given = codes.select(F.col("anahtar").alias("_k"), F.col("kod").alias("_kod"))
    return points.join(given, F.col("anahtar") == F.col("_k"), "left").withColumn("kod", F.coalesce("_kod", F.lit(""))).drop("_k", "_kod")


def replaced(base: DataFrame, parts: DataFrame, key: str, order: str) -> DataFrame:
    """MRG-02. Rows of base, of which a part's row of the same key takes the place; of several parts the last by `order`. parts: the columns
    of base and order."""
    newest = parts.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).filter("_r = 1").select(*base.columns)
    return base.join(newest.select(key), key, "left_anti").select(*base.columns).unionByName(newest)


def rebased(state: DataFrame, baselines: DataFrame, factor: float = 1.5) -> DataFrame:
    """CLN-05. Brand states whose expected number exceeds a known baseline `factor` times get the baseline and leave quarantine.
    state: marka, beklenen, karantina, durum; baselines: marka, adet."""
    j = state.join(baselines, "marka", "left")
    over = F.coalesce(F.coalesce("beklenen", F.lit(0)) > F.col("adet") * factor, F.lit(False))
    pick = lambda new, c: F.when(over, new).otherwise(F.col(c)).alias(c)
    return j.select("marka", pick(F.col("adet"), "beklenen"), pick(F.lit(0), "karantina"), pick(F.lit("basarili"), "durum"), over.alias("duzeltildi"))


def brand_coverage(points: DataFrame) -> DataFrame:
    """AGG-26, the head of a brand's page: points, and provinces and districts of sales and of service apart. Districts count within
    their province. Two levels: a place once with its roles, then counts."""
    places = points.groupBy("marka", "il", "ilce").agg(F.count_if(sells()).alias("s"), F.count_if(serves()).alias("v"), F.count("*").alias("n"))
    rolled = places.groupBy("marka", "il").agg(*(F.sum(c).alias(c) for c in ("s", "v", "n")), *(F.count_if((text("ilce") != "") & (F.col(c) > 0)).alias(f"d{c}") for c in ("s", "v")))
    il = text("il") != ""
    return rolled.groupBy("marka").agg(
        F.sum("n").alias("total"), F.sum("s").alias("sales_points"), F.sum("v").alias("service_points"), F.count_if(il & (F.col("s") > 0)).alias("il_sales"), F.count_if(il & (F.col("v") > 0)).alias("il_service"),
        F.sum("ds").alias("ilce_sales"), F.sum("dv").alias("ilce_service"),
    )


def brand_list(points: DataFrame, brand: str, role: Column | None = None, il: str = "", ilce: str = "") -> DataFrame:
    """AGG-26, the list: a brand's points under the filters, by province; those without one in a group of their own."""
    out = points.filter(F.col("marka") == brand)
    for test in (role, F.col("il") == il if il else None, F.col("ilce") == ilce if ilce else None):
        out = out if test is None else out.filter(test)
    return out.groupBy(F.coalesce(F.nullif(text("il"), F.lit("")), F.lit(NO_PROVINCE)).alias("grup")).agg(F.count("*").alias("n"), F.count_distinct(firm_key()).alias("n_firms"))


def manual_source(points: DataFrame, brand: str, source: str, day: str) -> DataFrame:
    """SNK-08. marka, json: a brand's points as a hand-kept source that the reader of such sources takes back. One row for one brand."""
    record = F.struct("marka", "rol", F.col("ad").alias("bayi_adi"), "il", "ilce", "adres", F.col("tel").alias("telefon"), F.lit("").alias("email"), F.lit("").alias("website"))
    held = points.filter(F.col("marka") == brand).groupBy("marka").agg(F.array_sort(F.collect_list(record)).alias("kayitlar"))
    return held.select("marka", F.to_json(F.struct(F.array(F.lit(source)).alias("_kaynak"), F.lit(day).alias("_tarih"), F.lit(True).alias("_duzenlenebilir"), "kayitlar")).alias("json"))


# What shows that a text is an address, names that are noise of a page, and the problems that are severe.
ADDRESS_SIGNS = r"mah|cad|sok|blv|bulv|no\s*:|osb|sanayi|apt|plaza|kat|meydan|yol|cd|sk|mh"
PAGE_NOISE = (
    "ara", "detay", "harita", "yol tarifi", "devam", "daha fazla", "iletisim", "bilgi al", "goster", "adres", "telefon", "tikla", "konum",
    "haritada goster", "tumu", "tum", "filtre", "sirala", "veriler yukleniyor", "yukleniyor", "sonuc bulunamadi", "kayit yok", "secim yapin",
    "sehir seciniz", "il seciniz", "ilce seciniz", "lutfen bekleyin",
)
SEVERE = ("ad_tur_etiketi", "ad_gurultu", "ad_il_adi", "ad_cok_kisa", "ad_telefon", "iletisim_yok", "ad_tekrari", "ad_konum")


def problems(rows: DataFrame, provinces: list[str], signs: str = ADDRESS_SIGNS, noise: tuple[str, ...] = PAGE_NOISE) -> DataFrame:
    """AGG-17, the checks of one record: rows with a further column `problems`. rows: marka, ad, il, ilce, adres, tel. Of a name, of a
    district, of a province and of the contact the first that holds counts."""
    name, ilce, il, adres, tel = (text(c) for c in ("ad", "ilce", "il", "adres", "tel"))
    fn, fi, fp = fold(name), fold(ilce), fold(il)
    known = lambda x: x.isin(*[p for p in provinces])
    of_name = F.when(role_of_label(name) != "", "ad_tur_etiketi").when(fn.isin(*noise), "ad_gurultu").when(known(fn), "ad_il_adi").when(F.length(F.trim(name)) < 4, "ad_cok_kisa").when(F.trim(name).rlike(f"^(?:{PHONE})$"), "ad_telefon").when((adres != "") & (fn != "") & (F.size(F.split(fn, " ")) <= 2) & F.contains(fold(adres), fn), "ad_konum")
    of_district = F.when(ilce == "", F.lit(None)).when(role_of_label(ilce) != "", "ilce_tur_etiketi").when(known(fi) & (fi != fp), "ilce_il_adi").when(fi.isin(*noise), "ilce_gurultu")
    of_province = F.when(il == "", "il_bos").when(~known(fp), "il_gecersiz")
    contact = F.when((tel == "") & (adres == ""), "iletisim_yok").when((F.length(adres) > 8) & ~F.lower(adres).rlike(signs), "adres_supheli")
    phone = F.when((tel != "") & ~tel.rlike(r"^\+90[0-9]{10}$"), "telefon_bozuk")
    return rows.withColumn("problems", F.array_compact(F.array(of_name, of_district, of_province, contact, phone)))


def audit(rows: DataFrame, provinces: list[str], expected: DataFrame, severe: tuple[str, ...] = SEVERE, **more) -> DataFrame:
    """AGG-17. A row for each brand: n, severe and light problems, coverage ratios, distinct-name ratio, provinces, status. Of the names that
    make up 15 % of a brand, three records at least, the first one adds up to three to its problems. expected: marka, low, high."""
    seen = problems(rows, provinces, **more)
    bad = F.size(F.filter("problems", lambda p: p.isin(*severe))).cast("long")
    share = lambda c: F.round(F.avg((text(c) != "").cast("double")), 6)
    by_name = seen.withColumn("_name", fold(text("ad"))).groupBy("marka", "_name").agg(F.count("*").alias("k"))
    names = by_name.groupBy("marka").agg(F.count("*").alias("n_names"), F.max(F.when(F.col("_name") != "", F.col("k"))).alias("most"))
    found = seen.groupBy("marka").agg(F.count("*").alias("n"), F.sum(bad).alias("_bad"), F.sum(F.size("problems").cast("long") - bad).alias("light"), share("il").alias("il_share"), share("ilce").alias("ilce_share"), share("tel").alias("tel_share"), F.count_distinct(F.nullif(text("il"), F.lit(""))).alias("n_il"))
    j = found.join(names, "marka").join(expected, "marka", "left")
    repeated = F.when((F.col("most") >= 3) & (F.col("most") >= F.col("n") * 0.15), F.lit(3)).otherwise(F.lit(0))
    j = j.withColumn("severe", (F.col("_bad") + (repeated if "ad_tekrari" in severe else F.lit(0))).cast("long")).withColumn("light", (F.col("light") + (F.lit(0) if "ad_tekrari" in severe else repeated)).cast("long"))
    ratio, n = F.col("severe") / F.col("n"), F.col("n")
    status = F.when(ratio > 0.5, "BOZUK").when(ratio > 0.1, "sorunlu").when(F.col("severe") > 0, "kontrol").otherwise("temiz")
    told = F.when(F.col("low").isNull(), status).when(n < F.col("low") * 0.5, "ÇOK AZ").when(n > F.col("high") * 2, "ÇOK FAZLA").when(~n.between(F.col("low") * 0.7, F.col("high") * 1.4) & (status == "temiz"), "sayı şüpheli").otherwise(status)
    return j.select("marka", "n", "severe", "light", "il_share", "ilce_share", "tel_share", F.round(F.col("n_names") / n, 6).alias("name_share"), "n_il", told.alias("status"))
