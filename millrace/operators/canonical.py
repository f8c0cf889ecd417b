"""From raw records to canonical ones: places told from fields, address and headings, then cleaned cells.

A record's place is a chain of inferences. The province is that of its own field, else the one named in the address, else that of the
heading above it; the district is its own field's, checked within the province, else the rightmost one that the address names. A
province at the end of the address overrides both, a province field that holds a district moves there, and a district that isn't in
the province is left out. All of it is one native projection over a record and the districts that its words name.

District names come from a table, by one equi-join of the words of all records with it (Spark broadcasts the table where it is small, and
shuffles the words otherwise); only words that are district names come back to their record. Missing cells are empty strings.
Records without a name go; places abroad are no provinces, so theirs is empty (`places.abroad` tells them from the raw field). Extra
columns pass through. Nothing is filtered after the chain: a filter would be pushed below it with all of the chain in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import places as P
from millrace.functions import text as T

RAW = ("bayi_adi", "il", "ilce", "adres", "telefon", "email", "website", "il_baslik", "rol", "birlesik")

# Words for the centre of a province, signs of an address line, district names that sources write otherwise, and
# labels that follow a shop's general name.
CENTRE = ("merkez", "merkez ilce", "il merkezi", "sehir merkezi", "merkezi")
LINE_SIGNS = r"(?iu)\b(mah|mahalle|mahallesi|cad|cadde|caddesi|sok|sokak|blv|bulvar|bulvari|no\s*:|osb|apt)\b"
DISTRICT_ALIASES = (
    ("gaziosmanpasa", "İstanbul", "Gazi Osmanpaşa"), ("gop", "İstanbul", "Gazi Osmanpaşa"), ("eyup", "İstanbul", "Eyüpsultan"), ("sisli", "İstanbul", "Şişli"),
    ("besiktas", "İstanbul", "Beşiktaş"), ("kucukcekmece", "İstanbul", "Küçükçekmece"), ("buyukcekmece", "İstanbul", "Büyükçekmece"), ("seyhan", "Adana", "Seyhan"), ("merkezefendi", "Denizli", "Merkezefendi"),
)
ROLE_TAIL = r"(?iu)(?:\s*/\s*(?:satış|satis|servis|bayi|bayii|teslimat\s*noktası|teslimat\s*noktasi|yedek\s*parça|yedek\s*parca|aksesuar))+\s*$"
NEIGHBOURHOOD = r"(?iu)^\s*([^,/]{2,30}?)\s*(?:mah\.?|mahallesi|mh\.?)\b"
_WORDS = 3  # of the longest district key


def district_keys(districts: DataFrame, aliases: tuple = DISTRICT_ALIASES) -> DataFrame:
    """key, found: what each key of a district may mean, in the order of plates and names. districts: il, ilce, of known provinces.
    A district named as its province takes the province's spelling, and each province has one; keys without blanks count too."""
    spark = districts.sparkSession
    dim = districts.select(F.col("il"), F.col("ilce"), P.plate(F.col("il")).alias("n"), F.lit(0).alias("late")).filter(F.col("n").isNotNull())
    dim = dim.withColumn("ilce", F.when(T.fold(F.col("ilce")) == T.fold(F.col("il")), F.col("il")).otherwise(F.col("ilce")))
    dim = dim.unionByName(dim.select("il", F.col("il").alias("ilce"), "n", F.lit(1).alias("late"))).groupBy("il", "ilce", "n").agg(F.min("late").alias("late"))
    each = dim.withColumn("k", T.fold(F.col("ilce")))
    each = each.select("n", "il", "ilce", "late", F.explode(F.array_distinct(F.array("k", F.replace("k", F.lit(" "), F.lit(""))))).alias("key"))
    more = spark.createDataFrame(list(aliases), "key string, il string, ilce string").join(dim.select("il").distinct(), "il", "left_semi")
    each = each.unionByName(more.select(P.plate(F.col("il")).alias("n"), "il", "ilce", F.lit(2).alias("late"), "key"))
    means = each.groupBy("key", "il", "ilce", "n").agg(F.min("late").alias("late"))
    homes = means.groupBy("key").agg(F.collect_set("il").alias("homes"))
    named = means.withColumn("k", T.fold(F.col("ilce"))).join(homes.withColumnRenamed("key", "k"), "k").select("key", "n", "late", "il", "ilce", "homes")
    named = named.select("key", "n", "late", F.col("ilce").alias("name"), "il", T.fold(F.col("il")).alias("pk"), T.fold(F.col("ilce")).alias("nk"), F.transform("homes", T.fold).alias("homes"), F.when(F.size("homes") == 1, F.get("homes", F.lit(0))).otherwise("").alias("home"))
    return named.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("n", "late", "name", "il", "pk", "nk", "homes", "home"))).alias("found"))


def _grams(words: Column) -> Column:
    """Words of an address by ones, twos and threes, with their place and the word after them."""
    gram = lambda n: F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.struct(i.alias("at"), F.lit(n).alias("n"), F.array_join(F.slice(words, i, n), " ").alias("key"), F.coalesce(F.get(words, i + n - 1), F.lit("")).alias("after"))))
    empty = F.array().cast("array<struct<at:int,n:int,key:string,after:string>>")
    return F.concat(*(F.coalesce(gram(n), empty) for n in range(1, _WORDS + 1)))


def _parts(c: Column) -> Column:
    return F.transform(F.split(c, r"[/,\-–_|]"), lambda p: T.fold(p))


def with_districts(records: DataFrame, keys: DataFrame) -> DataFrame:
    """records with known: the meanings of all words of theirs that are a district's key. Columns: il, ilce, adres, and the provinces told so far."""
    lookups = F.array_distinct(
        F.concat(
            F.transform(_grams(F.split(T.fold(F.col("adres")), " ")), lambda x: x["key"]),
            F.transform(F.array("il", "ilce"), T.fold),
            _parts(F.col("ilce")),
            F.transform(F.array("_ilA", "_ilT", "_ilD", "_ilF", "_ilH"), T.fold),
        )
    )
    held = records.withColumn("_words", F.array_sort(F.filter(lookups, lambda k: k != ""))).withColumn("_row", F.md5(F.array_join("_words", "|")))
    words = held.select("_row", F.explode("_words").alias("key")).distinct()  # records of the same words share their meanings
    known = words.join(keys, "key").groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("key", "found"))).alias("known"))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast(known.schema["known"].dataType.simpleString().replace("map<string,", "array<", 1)))
    return held.join(known, "_row", "left").drop("_row", "_words").withColumn("known", F.coalesce("known", empty))


def shift_repaired(records: DataFrame, keys: DataFrame) -> DataFrame:
    """Where the name is a place and the address begins with a line that isn't an address, that line is the name."""
    place = keys.select(F.col("key").alias("_key"))
    r = records.withColumn("_key", T.fold(F.col("bayi_adi"))).join(place.withColumn("_is", F.lit(True)), "_key", "left").drop("_key")
    line = F.coalesce(F.get(F.filter(F.transform(F.split("_a", r"\s{2,}|\n"), lambda p: F.trim(p)), lambda p: p != ""), F.lit(0)), F.lit(""))
    r = r.withColumn("_a", F.regexp_replace("adres", r"^\s+|\s+$", "")).withColumn("_line", line)
    moves = (F.trim("bayi_adi") != "") & (F.coalesce("_is", F.lit(False)) | P.is_province(F.col("bayi_adi"))) & (F.length("_line") >= 6) & ~F.col("_line").rlike(LINE_SIGNS)
    rest = F.regexp_replace(F.col("_a").substr(F.length("_line") + 1, F.length("_a")), r"^[ \-,;·]+|[ \-,;·]+$", "")
    r = r.withColumn("_moves", moves).withColumn("ilce", F.when(F.col("_moves") & (F.trim("ilce") == ""), F.trim("bayi_adi")).otherwise(F.col("ilce")))
    r = r.withColumn("bayi_adi", F.when(F.col("_moves"), F.substring("_line", 1, 120)).otherwise(F.col("bayi_adi")))
    return r.withColumn("adres", F.when(F.col("_moves"), rest).otherwise(F.col("adres"))).drop("_is", "_a", "_line", "_moves")


def _district(name: Column, key: Column, homes: Column, home: Column) -> Column:
    """A district: its name, folded too, the folded names of provinces that have one so named, and its province if that is the only one."""
    return F.struct(name.alias("name"), key.alias("nk"), homes.alias("homes"), home.alias("home"))


def _no_district() -> Column:
    return _district(F.lit(""), F.lit(""), F.array().cast("array<string>"), F.lit(""))


def _found(key: Column) -> Column:
    return F.try_element_at(F.col("known"), key)


def _of(x: Column) -> Column:
    return _district(x["name"], x["nk"], x["homes"], x["home"])


def _named(key: Column, il: Column) -> Column:
    """The district of a key within a province (any, the first, for an empty one), or null."""
    first = F.get(F.filter(_found(key), lambda x: (il == "") | (x["pk"] == il)), F.lit(0))
    return T.let(first, lambda x: F.when(x.isNotNull(), _of(x)))


def _told(name: Column) -> Column:
    """A place's name as a district of that name, whether or not there is one."""

    def of(key: Column) -> Column:
        homes = F.coalesce(F.array_distinct(F.transform(_found(key), lambda x: x["pk"])), F.array().cast("array<string>"))
        return T.let(homes, lambda h: _district(name, key, h, F.when(F.size(h) == 1, F.get(_found(key), F.lit(0))["il"]).otherwise("")))

    return T.let(T.fold(name), of)


def _in_address(il: Column) -> Column:
    """The rightmost district that the address names, the longest of those that start there; not before a street word, and
    one named as the province only if there is no other. il: folded."""
    ok = F.filter(F.col("_grams"), lambda g: (F.length(g["key"]) >= 4) & ~g["after"].isin(*P.STREET_WORDS) & _found(g["key"]).isNotNull())

    def hit(g: Column, il: Column) -> Column:
        free = T.let(_found(g["key"]), lambda f: F.when(F.size(F.array_distinct(F.transform(f, lambda x: x["pk"]))) == 1, _of(F.get(f, F.lit(0)))))
        d = F.when(il == "", free).otherwise(_named(g["key"], il))
        return T.let(d, lambda d: F.struct((d["nk"] != il).alias("a"), g["at"].alias("at"), F.length(g["key"]).alias("n"), d.alias("d")))

    best = T.let(il, lambda il: F.array_max(F.filter(F.transform(ok, lambda g: hit(g, il)), lambda h: h["d"].isNotNull())))
    return F.coalesce(best["d"], _no_district())


def canonical(raw: DataFrame, districts: DataFrame) -> DataFrame:
    """Canonical records of raw ones (the columns RAW; other columns pass through). districts: il, ilce."""
    have = [c for c in RAW if c in raw.columns]
    r = raw.select(*(c for c in raw.columns if c not in RAW), *(T.text(c).alias(c) if c in have else F.lit("").alias(c) for c in RAW))
    keys = district_keys(districts).persist()  # a thousand rows, read twice
    r = shift_repaired(r, keys).withColumn("bayi_adi", T.clean_text(F.col("bayi_adi"))).filter("bayi_adi <> ''")
    both = P.split_place(F.col("birlesik"))
    r = r.withColumn("_both", F.when(F.col("birlesik") != "", both))
    for c in ("il", "ilce"):
        r = r.withColumn(c, F.when(F.coalesce(F.col("_both")[c], F.lit("")) != "", F.col("_both")[c]).otherwise(F.col(c)))
    # what is named where
    tail = F.trim(F.element_at(F.split("adres", "[/,]"), -1))
    centre = T.fold(T.clean_text(F.col("ilce"))).isin(*CENTRE)
    r = r.withColumn("_centre", centre).withColumn("_field", F.when(F.col("_centre"), "").otherwise(T.clean_text(F.col("ilce"))))
    told = F.transform(F.array(F.col("adres"), tail, F.col("_field")), P.province_in_text)
    cells = F.transform(F.array("il", "il_baslik"), P.resolve_province)
    r = r.withColumns({"_told": told, "_cells": cells})
    r = r.withColumns({"_ilA": F.get("_told", F.lit(0)), "_ilT": F.get("_told", F.lit(1)), "_ilD": F.get("_told", F.lit(2)), "_ilF": F.get("_cells", F.lit(0)), "_ilH": F.get("_cells", F.lit(1))})
    r = with_districts(r, keys).withColumn("_grams", _grams(F.split(T.fold(F.col("adres")), " ")))
    # province: its own field, the address, the heading
    first = lambda *cs: F.coalesce(*(F.when(c != "", c) for c in cs), F.lit(""))
    r = r.withColumn("_il", first(F.col("_ilF"), F.col("_ilA"), F.col("_ilH")))
    # district: its own field or a part of it, within the province. What lambdas read is a value of let(), computed once a record.
    own_of = lambda x, il: F.coalesce(_named(x["key"], il), F.get(F.filter(F.transform(x["parts"], lambda p: _named(p, il)), lambda d: d.isNotNull()), F.lit(0)), _no_district())
    field = F.struct(T.fold(F.col("_field")).alias("key"), _parts(F.col("_field")).alias("parts"))
    own = T.let(field, lambda x: T.let(T.fold(F.col("_il")), lambda il: own_of(x, il)))
    r = r.withColumn("_d", F.when(F.col("_field") != "", own).otherwise(_no_district()))
    r = r.withColumn("_il", F.when((F.col("_il") == "") & (F.col("_d.name") == ""), F.col("_ilD")).otherwise(F.col("_il")))
    r = r.withColumn("_k", T.fold(F.col("_il"))).withColumn("_near", _in_address(F.col("_k")))
    d, near, k = F.col("_d"), F.col("_near"), F.col("_k")
    r = r.withColumn("_d", F.when(d["name"] == "", near).when((k != "") & (d["nk"] == k) & (near["name"] != "") & (near["nk"] != k), near).otherwise(d))
    r = r.withColumn("_il", F.when((F.col("_il") == "") & (d["name"] != ""), d["home"]).otherwise(F.col("_il")))
    central = (F.col("_il") != "") & ((d["name"] == "") & F.col("_centre") | d["nk"].isin(*CENTRE))
    r = r.withColumn("_d", F.when(central, _told(F.col("_il"))).otherwise(d))
    # the address's end goes before all that
    r = r.withColumn("_moved", (F.col("_ilT") != "") & (T.fold(F.col("_ilT")) != T.fold(F.col("_il"))))
    r = r.withColumn("_il", F.when(F.col("_moved"), F.col("_ilT")).otherwise(F.col("_il"))).withColumn("_k", T.fold(F.col("_il")))
    lost = F.col("_moved") & ((d["name"] == "") | ~F.array_contains(d["homes"], k))
    r = r.withColumn("_d", F.when(lost, _in_address(k)).otherwise(d))
    # a province that is none may be a district
    r = r.withColumn("_odd", (F.col("_il") != "") & (P.province_in_text(F.col("_il")) == "")).withColumn("_as", _told(F.col("_il")))
    r = r.withColumn("_d", F.when(F.col("_odd") & (F.col("_as.home") != "") & (d["name"] == ""), F.col("_as")).otherwise(d))
    r = r.withColumn("_il", F.when(F.col("_odd"), F.col("_as.home")).otherwise(F.col("_il"))).withColumn("_k", T.fold(F.col("_il")))
    fits = (d["name"] == "") | (F.col("_il") == "") | (d["nk"] == k) | F.array_contains(d["homes"], k)
    return r.select(
        *(c for c in raw.columns if c not in RAW),
        "bayi_adi",
        F.col("_il").alias("il"),
        F.when(fits, F.col("_d.name")).otherwise("").alias("ilce"),
        T.clean_address(F.col("adres")).alias("adres"),
        T.clean_phone(F.col("telefon")).alias("telefon"),
        F.lower(T.clean_text(F.col("email"))).alias("email"),
        T.clean_text(F.col("website")).alias("website"),
        "rol",
    )


def localise(records: DataFrame, general: list[str]) -> DataFrame:
    """Records whose name holds one of the general names get their district's (else province's) name before it; those that still
    share a name get their neighbourhood behind it."""
    wanted = [P.key(x) for x in general if P.key(x)]
    if not wanted:
        return records
    hit = F.lit(False)
    for w in wanted:
        hit = hit | F.contains(T.fold(F.col("bayi_adi")), F.lit(w))
    place = F.coalesce(*(F.when(T.clean_text(F.col(c)) != "", T.clean_text(F.col(c))) for c in ("ilce", "il")), F.lit(""))
    made = F.trim(F.concat_ws(" ", F.when(place != "", place), F.regexp_replace(T.clean_text(F.col("bayi_adi")), ROLE_TAIL, "")))
    r = records.withColumn("_new", F.when(hit, made))
    shared = r.filter("_new is not null").groupBy("_new").agg(F.count("*").alias("_n")).filter("_n > 1").withColumnRenamed("_new", "_key")
    r = r.join(shared, F.col("_new") == F.col("_key"), "left").withColumn("_hood", T.clean_text(F.regexp_extract("adres", NEIGHBOURHOOD, 1)))
    name = F.when(F.col("_n").isNotNull() & (F.col("_hood") != ""), F.concat("_new", F.lit(" ("), "_hood", F.lit(")"))).otherwise(F.coalesce("_new", "bayi_adi"))
    return r.withColumn("bayi_adi", name).drop("_new", "_key", "_n", "_hood")
