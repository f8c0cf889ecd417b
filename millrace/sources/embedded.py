"""Records within the scripts of framework pages: streamed chunks that make one text, and flat lists of state objects.

Chunks aren't valid JSON together, so the array after a key is cut out by matching brackets outside of strings, in one scan of the
page's text (a function of one text; no recursion). All else is native. Nulls, cut pages and pages without such
scripts give no records; of records with equal keys on a page the first stays."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import geo, noise
from millrace.functions import text as T

# How chunks are pushed, and the keys that hold points.
_CHUNK = re.compile(r'self\.__next_f\.push\(\[1,\s*"((?:[^"\\]|\\.)*)"\]\)')
POINT_KEYS = ("dealers", "points", "locations")
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\\?\Z)|[\[\]]', re.S)  # a string that is cut goes to the end
STATE_SCRIPT = r'(?s)<script type="qwik/json"[^>]*>(.*?)</script>'

RECORD = "bayi_adi string, il string, ilce string, adres string, telefon string, email string, rol string"


def chunk_text(html: str | None) -> str:
    """The text of a page's pushed chunks in turn; a chunk that is no JSON string is left out."""
    out = []
    for chunk in _CHUNK.findall(html or ""):
        try:
            out.append(json.loads(f'"{chunk}"'))
        except ValueError:
            continue
    return "".join(out)


def array_after(text: str, name: str) -> str | None:
    """The JSON array after a key, up to its own closing bracket; null if the key or the end is missing."""
    at = text.find(f'"{name}":')
    start = text.find("[", at) if at >= 0 else -1
    depth = 0
    for m in _TOKEN.finditer(text, start) if start >= 0 else ():
        depth += {"[": 1, "]": -1}.get(m[0], 0)
        if not depth:
            return text[start : m.end()]
    return None


def _of_page(f):
    """A function of one page's text. Pages go to Python a hundred at a time, where a batch of Arrow holds ten thousand of them."""
    return F.udf(f, "string", useArrow=False)


def chunk_arrays(pages: DataFrame, names: tuple[str, ...] = POINT_KEYS) -> DataFrame:
    """url, array: the JSON text after the first of the names that has an array, of pages with one."""

    def cut(html):
        text = chunk_text(html)
        return next((x for x in (array_after(text, n) for n in names) if x is not None), None)

    return pages.select("url", _of_page(cut)("html").alias("array")).filter("array is not null")


def _first(records: DataFrame, *keys: Column) -> DataFrame:
    w = Window.partitionBy("url", *keys).orderBy("ord")
    return records.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


_POINT = "array<struct<erp_user_name: string, name: string, city: string, district: string, address: string, phone: string, email: string, shop: string, service: string>>"


def chunk_points(pages: DataFrame) -> DataFrame:
    """url, ord and the fields of RECORD of every named point that sells or serves."""
    flat = lambda c: F.trim(F.regexp_replace(T.text(c), r"\s+", " "))
    truthy = lambda c: ~F.coalesce(F.lower(c), F.lit("")).isin("", "false", "0", "null", "[]", "{}")
    each = chunk_arrays(pages).select("url", F.posexplode(F.from_json("array", _POINT)).alias("ord", "x"))
    name = F.coalesce(F.when(T.text("x.erp_user_name") != "", F.col("x.erp_user_name")), F.col("x.name"))
    made = each.select(
        "url", "ord", flat(name).alias("bayi_adi"), F.trim(T.text("x.city")).alias("il"), F.trim(T.text("x.district")).alias("ilce"), flat(F.col("x.address")).alias("adres"),
        F.trim(T.text("x.phone")).alias("telefon"), F.trim(T.text("x.email")).alias("email"), T.role_of_flags(truthy(F.col("x.shop")), truthy(F.col("x.service"))).alias("rol"),
    )
    return _first(made.filter("bayi_adi <> '' and rol <> ''"), *(F.lower(c) for c in ("bayi_adi", "il", "ilce", "adres")))


def state_points(pages: DataFrame) -> DataFrame:
    """url, ord and the fields of RECORD from a flat list of state objects, where a name, an address and a phone stand before a place's
    coordinates. Its objects are read as variants; one that isn't a string can't be a field."""
    script = F.regexp_extract("html", STATE_SCRIPT, 1)
    objects = F.try_variant_get(F.try_parse_json(script), "$.objs", "array<variant>")
    shown = F.transform(objects, lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")))
    each = pages.select("url", shown.alias("o")).select("url", "o", F.posexplode("o").alias("ord", "x"))
    at = lambda k: F.get("o", F.col("ord") - k)
    found = each.filter(F.col("x").startswith('{"lat"') & (F.col("ord") >= 3)).select("url", "ord", F.trim(at(3)).alias("bayi_adi"), at(2).alias("adres"), at(1).alias("telefon"))
    found = found.filter("bayi_adi <> '' and length(telefon) <= 30 and length(adres) >= 8")
    empty = F.lit("")
    made = found.select("url", "ord", "bayi_adi", empty.alias("il"), empty.alias("ilce"), F.trim("adres").alias("adres"), "telefon", empty.alias("email"), F.lit("satis_servis").alias("rol"))
    return _first(made, F.col("bayi_adi"), F.col("telefon")).withColumn("telefon", F.trim("telefon"))


# The names that sites give to fields, best first, and how they write the country.
ALIASES = {
    "bayi_adi": ("name", "title", "unvan", "bayi", "dealername", "firma"),
    "il": ("city", "il", "sehir", "province", "town"),
    "ilce": ("district", "ilce", "county", "region"),
    "adres": ("address", "adres", "adres1", "street", "addressline1"),
    "telefon": ("phone", "telefon", "tel", "gsm", "phonenumber", "telephone"),
    "email": ("email", "eposta", "mail"),
    "website": ("website", "web", "url", "site"),
    "type": ("type", "tur", "tür", "tip", "kategori", "category", "nokta_turu", "dealertype", "pointtype"),
    "country": ("country", "countrycode", "ulke", "iso"),
    "lat": ("lat", "latitude", "enlem", "y"),
    "lng": ("lng", "lon", "long", "longitude", "boylam", "x"),
}
NAMED = ("name", "title", "unvan", "dealername", "firma")
HOME = ("tr", "tur", "turkey", "turkiye", "turkei")


def _point_like(x: object) -> bool:
    """An object with a phone and an address, or with a name and coordinates."""
    if not isinstance(x, dict):
        return False
    names = {k.lower() for k in x}
    has = lambda *fields: all(names.intersection(ALIASES[f]) for f in fields)
    return has("telefon", "adres") or (bool(names.intersection(NAMED)) and has("lat", "lng"))


def _spans(script: str, most: int = 3):
    """Up to three texts from a bracket to the last one of its kind, which don't overlap."""
    at, last = 0, {"{": script.rfind("}"), "[": script.rfind("]")}
    for _ in range(most):
        starts = [(s, b) for b in "{[" if 0 <= (s := script.find(b, at)) < last[b]]
        if not starts:
            return
        start, bracket = min(starts)
        at = last[bracket] + 1
        yield script[start:at]


def largest_list(html: str | None, least: int = 3, shortest: int = 60) -> list[dict]:
    """The largest list with that many point-like objects within a page's scripts, the first of equals; a script that is no
    JSON between its brackets, or is nested beyond what the reader takes, is left out. Values are walked with a stack."""
    best: list[dict] = []
    for script in re.findall(r"(?is)<script\b[^>]*>(.*?)</script", html or ""):
        for span in _spans(script) if len(script) >= shortest else ():
            try:
                stack = [json.loads(span)]
            except (ValueError, RecursionError):
                continue
            while stack:
                x = stack.pop()
                if isinstance(x, list):
                    points = [y for y in x if _point_like(y)]
                    if len(points) >= max(least, len(best) + 1):
                        best = points
                inner = x if isinstance(x, list) else x.values() if isinstance(x, dict) else ()
                stack += [y for y in reversed(list(inner)) if isinstance(y, list | dict)]
    return best


def script_points(pages: DataFrame, border: list[tuple[float, float]], centres: list[tuple[str, float, float]], most_km: float = 180.0) -> DataFrame:
    """url, ord and the fields of RECORD and website of the points in a page's largest list.

    border: (lng, lat) of the country's outline; centres: (province, lat, lng). A field is the first alias with a value. Points outside
    of the border or of another country are dropped, points without a name too; one that names no province has that of the nearest
    centre within most_km. A page more than half of whose points have tokens in place of names or addresses gives none."""

    def points(html):
        found = largest_list(html)
        return json.dumps(found, ensure_ascii=False) if found else None

    entries = F.transform(F.from_json("_json", "array<map<string, string>>"), lambda m: F.transform(F.map_entries(m), lambda e: F.struct(F.lower(e["key"]).alias("k"), e["value"].alias("v"))))

    def field(e: Column, name: str, nothing: tuple[str, ...] = ("", "false", "0", "0.0", "[]", "{}")) -> Column:
        names = F.array(*map(F.lit, ALIASES[name]))
        held = F.filter(e, lambda x: F.array_contains(names, x["k"]) & x["v"].isNotNull() & ~x["v"].isin(*nothing))
        return F.array_min(F.transform(held, lambda x, i: F.struct(F.array_position(names, x["k"]), i.alias("i"), x["v"].alias("v"))))["v"]

    def told(e: Column) -> Column:
        texts = [T.text(field(e, f)).alias(f) for f in ALIASES if f not in ("lat", "lng")]
        return T.let(F.struct(*texts, field(e, "lat", ("",)).alias("lat"), field(e, "lng", ("",)).alias("lng")), checked)

    def checked(x: Column) -> Column:
        lat, lng = (x[f].try_cast("double") for f in ("lat", "lng"))
        placed = x["lat"].isNotNull() & x["lng"].isNotNull()
        at_home = (~placed | geo.inside(lat, lng, border)) & ((x["country"] == "") | T.fold(x["country"]).isin(*HOME))
        junk = ~noise.name_like(x["bayi_adi"]) | ((x["adres"] != "") & ~noise.name_like(x["adres"]))
        return F.struct(*(x[f].alias(f) for f in ALIASES if f not in ("lat", "lng", "country")), F.when(placed, lat).alias("lat"), F.when(placed, lng).alias("lng"), ((x["bayi_adi"] != "") & at_home).alias("ok"), junk.alias("junk"))

    held = pages.select("url", _of_page(points)("html").alias("_json")).filter("_json IS NOT NULL").select("url", F.transform(entries, told).alias("_x"))
    sound = held.filter(2 * F.size(F.filter("_x", lambda x: x["ok"] & x["junk"])) <= F.size("_x"))
    each = sound.select("url", F.posexplode("_x").alias("ord", "x")).filter("x.ok AND NOT x.junk").select("url", "ord", "x.*")
    near = geo.nearest(each, centres, most_km)
    il = F.when(F.col("il") != "", F.col("il")).otherwise(T.text("place"))
    return near.select("url", "ord", "bayi_adi", il.alias("il"), "ilce", "adres", "telefon", "email", "website", T.text(T.role_of_label(F.col("type"))).alias("rol"))
