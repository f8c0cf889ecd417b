"""The fields of a card: what its texts are, told by labels first, then by form, then by place names.

A card's texts are rows while they are looked up among the districts (an equi-join), then one row again: a card is a piece of a
page, so its texts are few. All native. A null among the texts is left out; a card without a phone and an address, or with no text
that may be a name, gives no record; of equal texts the first counts, and equal cards give a record each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import noise
from millrace.functions import text as T
from millrace.functions.places import is_province, province_in_text, resolve_province

# Labels before a value, and signs of an address.
LABELS = {
    "ilce": r"(?iu)^\s*(il[çc]e|semt|b[öo]lge)\s*[:：]",
    "il": r"(?iu)^\s*(il|[şs]ehir|province)\s*[:：]",
    "telefon": r"(?iu)^\s*(tel|telefon|gsm|cep|phone)\s*[:：]",
    "adres": r"(?iu)^\s*(adres|address)\s*[:：]",
    "email": r"(?iu)^\s*(e-?posta|e-?mail|mail)\s*[:：]",
}
ADDRESS_SIGN = r"(?iu)\b(mah|mh|mahalle|mahallesi|cad|cd|cadde|caddesi|sok|sk|sokak|blv|bulv|bulvar|no\s*:|osb|sanayi|apt|plaza|iş\s*mrk)\b[.\s:]"
_MAIL = r"^\S+@\S+\.\S+$"
_EDGE = r"^[\s:：\-–]+|[\s:：\-–]+$"


def _first(rows: Column, holds) -> Column:
    return F.get(F.filter(rows, holds), 0)


def _last_part(c: Column) -> Column:
    return F.trim(F.element_at(F.split(c, r"[_/\-–]"), -1))


def _labelled(bare: Column, label: str) -> Column:
    """(at, upto, value) of the first text with that label; a label alone has its value in the next text."""

    def told(x: Column) -> Column:
        rest = F.regexp_replace(F.regexp_replace(x["t"], label, ""), _EDGE, "")
        after = F.coalesce(F.get(bare, x["at"] + 1), F.lit(""))
        return T.let(F.struct(x["at"].alias("at"), rest.alias("rest"), after.alias("after")), put)

    def put(x: Column) -> Column:
        follows = (x["rest"] == "") & (x["after"] != "") & ~x["after"].rlike("|".join(f"(?:{p})" for p in LABELS.values()))
        return F.struct(x["at"].alias("at"), (x["at"] + follows.cast("int")).alias("upto"), F.when(follows, F.regexp_replace(x["after"], _EDGE, "")).otherwise(x["rest"]).alias("value"))

    labelled = F.filter(F.transform(bare, lambda t, i: F.struct(i.alias("at"), t.alias("t"))), lambda x: (F.length(x["t"]) <= 300) & x["t"].rlike(label))
    return _first(F.transform(labelled, told), lambda x: x["value"] != "")


def _texts(cards: DataFrame) -> DataFrame:
    """Cards with the values of links and labels, and bare: the other texts."""
    held = cards.withColumn("_card", F.monotonically_increasing_id()).withColumn("_p", F.array_compact(F.coalesce("parts", F.array().cast("array<string>"))))
    link = lambda scheme: F.regexp_replace(_first(F.col("_p"), lambda p: p.startswith(scheme)), f"^{scheme}", "")
    held = held.withColumns({"_tel": link("tel:"), "_mailto": link("mailto:"), "_bare": F.filter("_p", lambda p: ~p.startswith("tel:") & ~p.startswith("mailto:"))})
    held = held.withColumns({f"_l_{name}": _labelled(F.col("_bare"), label) for name, label in LABELS.items()})
    # columns, as what doesn't hang on a lambda's own variable would be computed for each text
    held = held.withColumn("_found", F.array_compact(F.array(*(F.col(f"_l_{name}") for name in LABELS))))
    held = held.withColumn("_values", F.filter(F.transform("_found", lambda x: T.fold(x["value"])), lambda v: v != ""))
    starts = lambda t: (F.size("_values") > 0) & T.let(T.fold(t), lambda f: F.exists("_values", lambda v: F.startswith(f, v)))
    used = lambda t, i: F.exists("_found", lambda x: i.between(x["at"], x["upto"])) | starts(t)
    numbered = F.filter(F.transform("_bare", lambda t, i: F.struct(i.alias("at"), t.alias("t"), used(t, i).alias("used"))), lambda x: ~x["used"])
    return held.withColumn("_left", numbered)


def _told(texts: DataFrame, districts: DataFrame) -> DataFrame:
    """texts with _rows: a card's texts that no label has, in turn, with what each of them is. Cards without any are left out. A card goes
    along with its rows, as a number that was given twice would not be the same."""
    own = [c for c in texts.columns if c.startswith(("_l_", "_tel", "_mailto")) or c in ("url", "grp", "ord")]
    each = texts.select("_card", F.struct(*own).alias("_own"), F.explode("_left").alias("x")).select("_card", "_own", "x.at", F.trim(F.regexp_replace("x.t", r"\s+", " ")).alias("t"))
    t = F.col("t")
    each = each.withColumns({"key": T.fold(t), "phone": F.regexp_like(t, F.lit(T.PHONE)), "address": t.rlike(ADDRESS_SIGN), "mail": t.rlike(_MAIL), "role": T.role_of_label(t)})
    shown = (F.length(t) >= 3) & ~noise.button(t) & ~noise.call_to_action(t) & ~noise.placeholder(t) & ~noise.category_list(t)
    each = each.withColumn("shown", ~F.col("phone") & ~F.col("address") & shown)
    names = F.col("shown") & (F.col("role") == "")
    each = each.withColumn("il", F.when(names & is_province(t), resolve_province(t)).otherwise(""))
    each = each.withColumn("name", names & (F.col("il") == "") & noise.name_like(t))
    each = each.withColumns({"trade": F.col("name") & noise.trade_word(t), "words": F.size(F.split("key", " "))})
    each = each.withColumn("province", F.when(F.col("name") & ~F.col("trade") & (F.length(t) <= 120), province_in_text(t)).otherwise(""))
    dim = districts.select(T.fold(F.col("ilce")).alias("key")).filter("key != ''").distinct().withColumn("_d", F.lit(True))
    each = each.join(dim, "key", "left").withColumn("district", F.coalesce("_d", F.lit(False)))
    row = F.struct("at", "t", "key", "phone", "address", "mail", "role", "shown", "il", "name", "trade", "words", "province", "district")
    return each.groupBy("_card").agg(F.first("_own").alias("_own"), F.array_sort(F.collect_list(row)).alias("_rows")).select("_own.*", "_rows")


def card_fields(cards: DataFrame, districts: DataFrame) -> DataFrame:
    """url, grp, ord and bayi_adi, il, ilce, adres, telefon, email, rol of each card (of containers() or card_groups()).
    districts: il, ilce.

    A phone is that of a link, of a text, of a label; mails likewise. The address is the first text of more than 15 characters with
    a sign of one, else the labelled one. Of the other texts, interface words and noise are left out, labels of kind give the role and provinces
    the province. What is left is a place if it has no firm's word and is a district, stands within the address, or names a province
    (in up to three, two and three words); the name is the first text with a firm's word, else the first that is no place, else the first; a
    further short text without a firm's word is the district, else the first place is."""
    held = _told(_texts(cards), districts)
    rows = F.col("_rows")
    a_phone = F.get(F.transform(F.filter(rows, lambda x: x["phone"]), lambda x: x["t"]), 0)
    number = lambda c: F.regexp_substr(c, F.lit(T.PHONE))
    phone_at = F.when(F.col("_tel").isNull(), _first(rows, lambda x: x["phone"])["at"])
    mail_at = F.when(F.col("_mailto").isNull(), _first(rows, lambda x: x["mail"])["at"])
    held = held.withColumns({
        "_phone_at": F.coalesce(phone_at, F.lit(-1)), "_mail_at": F.coalesce(mail_at, F.lit(-1)),
        "telefon": F.coalesce(F.when(F.col("_tel").isNotNull(), F.coalesce(number("_tel"), "_tel")), number(a_phone), number(F.col("_l_telefon.value")), "_l_telefon.value", F.lit("")),
        "email": F.coalesce("_mailto", _first(rows, lambda x: x["mail"])["t"], "_l_email.value", F.lit("")),
    })
    free = lambda x: (x["at"] != F.col("_phone_at")) & (x["at"] != F.col("_mail_at"))
    held = held.withColumn("_address", _first(rows, lambda x: free(x) & x["address"] & (F.length(x["t"]) > 15)))
    held = held.withColumn("adres", F.coalesce(F.regexp_replace("_address.t", r"(?iu)^\s*adres\s*[:\-]\s*", ""), "_l_adres.value", F.lit("")))
    held = held.withColumn("_key", T.fold(F.col("adres")))
    left = F.filter(rows, lambda x: free(x) & x["name"])
    place = lambda x: ~x["trade"] & (((x["words"] <= 3) & (x["district"] | (x["province"] != ""))) | ((x["words"] <= 2) & (x["key"] != "") & F.contains(F.col("_key"), x["key"])))
    held = held.withColumn("_left", left).filter("size(_left) > 0")
    held = held.withColumns({"_places": F.filter("_left", place), "_real": F.filter("_left", lambda x: ~place(x))})
    held = held.withColumn("_names", F.when(F.size("_real") > 0, F.col("_real")).otherwise(F.col("_left")))
    held = held.withColumn("_places", F.when(F.size("_real") > 0, F.col("_places")))
    held = held.withColumn("_name", F.coalesce(_first(F.col("_names"), lambda x: x["trade"]), F.get("_names", 0)))
    first = F.struct(F.coalesce("_l_il.value", F.lit("")).alias("il"), F.coalesce("_l_ilce.value", F.lit("")).alias("ilce"))

    def take(a: Column, x: Column) -> Column:
        names = (x["province"] != "") & (a["il"] == "")
        part = _last_part(x["t"])
        own = F.when((part != "") & (T.fold(part) != T.fold(x["province"])), part).otherwise("")
        ilce = F.when(a["ilce"] != "", a["ilce"]).when(names, own).otherwise(x["t"])
        return F.struct(F.when(names, x["province"]).otherwise(a["il"]).alias("il"), ilce.alias("ilce"))

    held = held.withColumn("_place", F.aggregate(F.coalesce("_places", F.slice("_left", 1, 0)), first, take))
    other = _first(F.col("_names"), lambda x: (x["at"] != F.col("_name.at")) & (F.length(x["t"]) <= 30) & ~x["trade"])["t"]
    held = held.withColumns({"_ilce": F.coalesce(other, "_place.ilce"), "_il": F.when(F.col("_place.il") != "", F.col("_place.il")).otherwise(F.coalesce(_first(rows, lambda x: free(x) & (x["il"] != ""))["il"], F.lit("")))})
    named = F.when((F.col("_il") == "") & (F.col("_ilce") != ""), province_in_text(F.col("_ilce"))).otherwise("")
    held = held.withColumn("_named", named)
    tail = _last_part(F.col("_ilce"))
    il = F.when(F.col("_named") != "", F.col("_named")).otherwise(F.col("_il"))
    ilce = F.when(F.col("_named") == "", F.col("_ilce")).when(T.fold(tail) != T.fold(F.col("_named")), tail).otherwise("")
    rol = F.coalesce(_first(rows, lambda x: free(x) & x["shown"] & (x["role"] != ""))["role"], F.lit(""))
    made = held.select("url", "grp", "ord", F.col("_name.t").alias("bayi_adi"), il.alias("il"), ilce.alias("ilce"), "adres", "telefon", "email", rol.alias("rol"))
    return made.filter("telefon != '' OR adres != ''")
