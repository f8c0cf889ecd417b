"""Provinces and districts: lookups, free text, and combined cells, as native expressions over small literal maps.

Districts and coordinates are data of the caller: a DataFrame or plain rows, as they number some hundreds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import fold, let, text, title_tr

# The provinces in the order of their plate codes, and short or old names.
PROVINCES = (
    "Adana", "Adıyaman", "Afyonkarahisar", "Ağrı", "Amasya", "Ankara", "Antalya", "Artvin", "Aydın", "Balıkesir",
    "Bilecik", "Bingöl", "Bitlis", "Bolu", "Burdur", "Bursa", "Çanakkale", "Çankırı", "Çorum", "Denizli",
    "Diyarbakır", "Edirne", "Elazığ", "Erzincan", "Erzurum", "Eskişehir", "Gaziantep", "Giresun", "Gümüşhane", "Hakkâri",
    "Hatay", "Isparta", "Mersin", "İstanbul", "İzmir", "Kars", "Kastamonu", "Kayseri", "Kırklareli", "Kırşehir",
    "Kocaeli", "Konya", "Kütahya", "Malatya", "Manisa", "Kahramanmaraş", "Mardin", "Muğla", "Muş", "Nevşehir",
    "Niğde", "Ordu", "Rize", "Sakarya", "Samsun", "Siirt", "Sinop", "Sivas", "Tekirdağ", "Tokat",
    "Trabzon", "Tunceli", "Şanlıurfa", "Uşak", "Van", "Yozgat", "Zonguldak", "Aksaray", "Bayburt", "Karaman",
    "Kırıkkale", "Batman", "Şırnak", "Bartın", "Ardahan", "Iğdır", "Yalova", "Karabük", "Kilis", "Osmaniye",
    "Düzce",
)
ALIASES = {
    "afyon": "Afyonkarahisar", "icel": "Mersin", "k maras": "Kahramanmaraş", "kmaras": "Kahramanmaraş", "maras": "Kahramanmaraş",
    "urfa": "Şanlıurfa", "s urfa": "Şanlıurfa", "antep": "Gaziantep", "g antep": "Gaziantep",
    "ist": "İstanbul", "ank": "Ankara", "izm": "İzmir", "hakkari": "Hakkâri",
}
# Places abroad, words that make a place's name before them a road, and those that make a district's name a street.
ABROAD = ("kibris", "kuzey kibris", "kktc", "lefkosa", "girne", "magusa", "gazimagusa", "guzelyurt", "iskele", "lefke")
ROAD_WORDS = ("yolu", "yol", "caddesi", "cad", "cd", "bulvari", "bulvar", "blv", "asfalti", "asfalt", "mahallesi", "mah", "mh", "sokak", "sok", "sk", "sitesi", "apartmani", "apt", "kavsagi", "kavsak", "otoyolu", "karayolu", "istikameti", "yonu", "cikisi")
STREET_WORDS = ("mah", "mh", "mahalle", "mahallesi", "cad", "cd", "cadde", "caddesi", "sok", "sk", "sokak", "bulv", "blv", "apt", "sit", "sitesi")

_LOWER, _PLAIN = str.maketrans("IİĞÜŞÖÇ", "ıiğüşöç"), str.maketrans("çğıöşüâîû", "cgiosuaiu")


def key(name: str) -> str:
    """fold() of a plain name, for literals."""
    low = name.translate(_LOWER).lower().translate(_PLAIN)
    return " ".join("".join(x if x.isascii() and x.isalnum() else " " for x in low).split())


BY_KEY = {key(p): p for p in PROVINCES}


def _map(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in d.items() for x in pair])


def is_province(c: Column) -> Column:
    return fold(c).isin(*BY_KEY)


def plate(c: Column) -> Column:
    """1 to 81, else null."""
    return F.try_element_at(_map({k: str(i) for i, k in enumerate(BY_KEY, 1)}), fold(c)).cast("int")


def resolve_province(c: Column) -> Column:
    """The province of a cell: exact, alias, first words; else the cell in title case."""
    names = _map(BY_KEY | {k: v for k, v in ALIASES.items() if k not in BY_KEY})

    def told(f: Column) -> Column:
        begins = F.regexp_extract(f, f"^(?:{'|'.join(BY_KEY)})(?= )", 0)  # keys are one word each
        return F.when(f == "", "").otherwise(F.coalesce(F.try_element_at(names, f), F.try_element_at(names, begins), title_tr(c)))

    return let(fold(c), told)


def split_place(c: Column) -> Column:
    """(il, ilce) of a combined cell in either order; of several other parts the last is the district."""
    parts = F.filter(F.split(text(c), r"[/\-–,|]"), lambda p: F.trim(p) != "")
    shown = F.transform(parts, lambda p: let(resolve_province(p), lambda r: F.struct(r.alias("il"), is_province(r).alias("ok"), title_tr(p).alias("t"))))

    def step(a: Column, x: Column) -> Column:
        takes = x["ok"] & (a["il"] == "")
        return F.struct(F.when(takes, x["il"]).otherwise(a["il"]).alias("il"), F.when(takes, a["ilce"]).otherwise(x["t"]).alias("ilce"))

    def put(shown: Column) -> Column:
        return let(F.aggregate(shown, F.struct(F.lit("").alias("il"), F.lit("").alias("ilce")), step), lambda both: chosen(shown, both))

    def chosen(shown: Column, both: Column) -> Column:
        plain = (both["il"] != "") | (F.size(shown) <= 1)
        return F.when(plain, both).otherwise(F.struct(F.get(shown, 0)["il"].alias("il"), F.try_element_at(shown, F.lit(-1))["t"].alias("ilce")))

    return let(shown, put)


def province_in_text(c: Column) -> Column:
    """The longest province named in free text, the first of equals; a name before a road word is a street."""
    # keys are one word each, so that one scan of the text finds all of them
    named = f"(?<= )(?:{'|'.join(BY_KEY)})(?= )(?! (?:[a-z0-9]+ )?(?:{'|'.join(ROAD_WORDS)})\\b)"
    places = F.create_map(*(x for i, (k, p) in enumerate(BY_KEY.items()) for x in (F.lit(k), F.struct(F.lit(-len(k)).alias("n"), F.lit(i).alias("i"), F.lit(p).alias("p")))))

    def told(f: Column) -> Column:
        alias = F.lit("")
        for k, p in reversed(ALIASES.items()):
            alias = F.when(F.contains(f, F.lit(f" {k} ")), p).otherwise(alias)
        return F.coalesce(F.array_min(F.transform(F.regexp_extract_all(f, F.lit(named), F.lit(0)), lambda k: F.try_element_at(places, k)))["p"], alias)

    return let(F.concat(F.lit(" "), fold(c), F.lit(" ")), told)


def district_in_text(records: DataFrame, districts: DataFrame, address: str = "adres", province: str = "il") -> DataFrame:
    """records with ilce_adres: the rightmost district named in the address (within its province if that is known), not
    before a street word; a district named as its province only if there is no other. districts: il, ilce. A row number
    ties each record to its tokens; the token join is an equi-join, so that it shuffles or broadcasts as sizes ask."""
    dim = districts.select(fold(F.col("ilce")).alias("_k"), fold(F.col("il")).alias("_il"), F.col("ilce").alias("_name")).filter("length(_k) >= 4")
    unique = dim.groupBy("_k").agg(F.count_distinct("_il").alias("_n"), F.min("_name").alias("_only"))
    held = records.withColumn("_row", F.monotonically_increasing_id())
    words = F.split(fold(F.col(address)), " ")
    grams = lambda n: F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.struct(i.alias("at"), F.array_join(F.slice(words, i + 1, n), " ").alias("k"), F.coalesce(F.get(words, i + n), F.lit("")).alias("after")))
    tokens = held.select("_row", fold(F.col(province)).alias("_p"), F.explode(F.concat(grams(1), F.when(F.size(words) > 1, grams(2)).otherwise(F.array()))).alias("t")).select("_row", "_p", "t.*").filter(~F.col("after").isin(*STREET_WORDS))
    scoped = tokens.filter("_p != ''").join(dim, (F.col("k") == F.col("_k")) & (F.col("_p") == F.col("_il"))).select("_row", "_p", "at", "k", "_name")
    free = tokens.filter("_p = ''").join(unique.filter("_n = 1"), F.col("k") == F.col("_k")).select("_row", "_p", "at", "k", F.col("_only").alias("_name"))
    best = scoped.unionByName(free).groupBy("_row").agg(F.max_by("_name", F.struct((F.col("k") != F.col("_p")).alias("a"), F.col("at"))).alias("ilce_adres"))
    return held.join(best, "_row", "left").drop("_row").withColumn("ilce_adres", text("ilce_adres"))


def abroad(c: Column) -> Column:
    return fold(c).isin(*ABROAD)
