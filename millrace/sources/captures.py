"""Points in browser captures: the site's own list of provinces tells what its forms asked for, and phones tell where the cards are.

A capture's codes are learnt from its captured pages and joined to its answers; pages are walked one by one, each in its row's task."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as T

from .extract import _PHONE, HAR, leaves, nodes
from .trimming import page_tree

# The forms' names for a province, the list that explains them, what a district's name doesn't hold.
FORM_NAMES = ("city_box", "city", "sehir", "il")
LIST_NAME = "city_box"
_STREET = re.compile(r"(?i)\d|no:|mah\.|cad\.|sok|blv|bulv")
_HEADS = {"h1", "h2", "h3", "h4", "h5", "h6", "strong", "b"}
_PLACE = re.compile(r"([^/,]{2,60})\s*/\s*([^/,]{2,30})\s*$")


def answers(landed: DataFrame) -> DataFrame:
    """marka, capture, ord, url, post, html of every textual answer with a body. landed: marka, capture (a name), body (the capture's JSON)."""
    e = landed.select("marka", "capture", F.posexplode(F.from_json("body", HAR)["log"]["entries"]).alias("ord", "e"))
    kind = F.lower(T.text("e.response.content.mimeType"))
    out = e.select("marka", "capture", "ord", T.text("e.request.url").alias("url"), T.text("e.request.postData.text").alias("post"), F.col("e.response.content.text").alias("html"), kind.alias("_kind"))
    return out.filter("html != '' AND (contains(_kind, 'html') OR contains(_kind, 'json') OR contains(_kind, 'text'))").drop("_kind")


def province_codes(found: DataFrame, name: str = LIST_NAME) -> DataFrame:
    """marka, capture, code, ad of the options of the lists of that name; of equal codes the first in the capture counts, `0` is none."""
    lists = F.regexp_extract_all("html", F.lit(rf"(?is)<select\b[^>]*\bname\s*=\s*[\"']?{re.escape(name)}[\"'\s>].*?</select>"), 0)
    options = found.filter(F.contains("html", F.lit(name))).select("marka", "capture", "ord", F.posexplode(lists).alias("k", "s"))
    options = options.select("marka", "capture", "ord", "k", F.posexplode(F.regexp_extract_all("s", F.lit(r"(?is)<option\b[^>]*>[^<]*"), 0)).alias("i", "o"))
    code = F.trim(F.regexp_extract("o", r"(?is)value\s*=\s*[\"']?([^\"'>]*)", 1))
    named = options.select("marka", "capture", "ord", "k", "i", code.alias("code"), T.clean_text(F.regexp_replace("o", "<[^>]*>", "")).alias("ad")).filter("code NOT IN ('', '0') AND ad != ''")
    return named.groupBy("marka", "capture", "code").agg(F.min_by("ad", F.struct("ord", "k", "i")).alias("ad"))


def asked(post: Column, url: Column) -> Column:
    """What a form or an address asked for, by the first of FORM_NAMES that has a value, forms first; else ''."""
    value = lambda c, n: F.nullif(F.regexp_extract(c, rf"(?:^|[&?]){n}=([^&#]+)", 1), F.lit(""))
    query = F.regexp_extract(url, r"\?.*$", 0)
    raw = F.coalesce(*(value(post, n) for n in FORM_NAMES), *(value(query, n) for n in FORM_NAMES), F.lit(""))
    return F.coalesce(F.try_url_decode(raw), raw)


def _shown(node: dict) -> str:
    return " ".join(x for x in leaves(node) if not x.startswith(("tel:", "mailto:")))


def _district(address: str) -> str:
    """The one or two words before the slash of `... EDREMİT / BALIKESİR`, unless they are of a street."""
    m = _PLACE.search(address)
    words = m[1].split() if m else []
    return next((c for n in (1, 2) if (c := " ".join(words[-n:])) and not _STREET.search(c)), "")


def page_cards(html: str | None) -> list[tuple[str, str, str, str]]:
    """(name, district, address, phone) of each link to a phone: its box is the first of five nodes above it with more than eight words,
    else the fifth; the name is the box's first heading, the address its longest other text. Equal names and phones count once."""
    found: dict[tuple[str, str], tuple[str, str, str, str]] = {}
    for link in nodes(page_tree(html)):
        href = link["attrs"].get("href") or ""
        phone = href[4:].strip() if link["tag"] == "a" and href.startswith("tel:") else ""
        box = link if phone else None
        for _ in range(5 if phone else 0):
            box = box["up"]
            if box is None or len(_shown(box).split()) > 8:
                break
        if box is None:
            continue
        inner = [n for n in nodes(box) if n is not box]
        name = next((_shown(n) for n in inner if n["tag"] in _HEADS), "")
        if not name or _PHONE.fullmatch(name):
            continue
        texts = [t for n in inner if n["tag"] in ("p", "span", "td", "div") if (t := _shown(n)) and t != name and not _PHONE.fullmatch(t)]
        address = max(texts, key=len, default="")
        found.setdefault((name.casefold(), phone), (name, _district(address), address, phone))
    return list(found.values())


def capture_points(landed: DataFrame) -> DataFrame:
    """marka, rol, bayi_adi, il, ilce, adres, telefon of the cards in captures (see answers). The role is servis if the address or the form
    says so, else satis; the province is what was asked for, by its name in the capture's list, empty for an unknown number. Of cards with equal
    brand, name, phone and role the first by capture and answer stays. Null bodies and what is no capture give nothing."""

    # pages go to Python a hundred at a time, where a batch of Arrow holds ten thousand of them
    cards = F.udf(lambda html: list(page_cards(html)), "array<struct<bayi_adi: string, ilce: string, adres: string, telefon: string>>", useArrow=False)

    found = answers(landed)
    service = F.lower("url").rlike("servis|service") | F.contains(F.lower("post"), F.lit("servis"))
    held = found.filter(F.contains("html", F.lit("tel:"))).withColumn("code", asked(F.col("post"), F.col("url"))).withColumn("rol", F.when(service, "servis").otherwise("satis"))
    named = held.join(province_codes(found), ["marka", "capture", "code"], "left")
    il = F.coalesce("ad", F.when(F.col("code").rlike("^[0-9]+$"), "").otherwise(F.col("code")))
    each = named.select("marka", "capture", "ord", "rol", il.alias("il"), F.posexplode(cards("html")).alias("at", "c")).select("marka", "capture", "ord", "at", "rol", "il", "c.*")
    w = Window.partitionBy("marka", F.lower("bayi_adi"), "telefon", "rol").orderBy("capture", "ord", "at")
    return each.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select("marka", "rol", "bayi_adi", "il", "ilce", "adres", "telefon")
