"""What a text of a page is not: a name. Native predicates over one text; a null text is empty, and none of them holds for it."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, text

# Words of interfaces and categories as they occur on pages.
PLACEHOLDERS = ("konum yok", "adres yok", "bilgi yok", "belirtilmemi[sş]", "bulunamad[iı]", "se[cç]iniz", "se[cç]im yap", "t[uü]m[uü]", "hepsi", "di[gğ]er")
CALLS = (
    "istiyorum", "ediyorum", "alın", "alin", "arayın", "arayin", "geçin", "gecin", "konuma git", "yol tarifi", "haritaya git", "haritada g", "rota", "navigasyon",
    "ulaşın", "ulasin", "tıklayın", "tiklayin", "görüntüle", "goruntule", "randevu", "şimdi ara", "simdi ara", "iletişime", "iletisime", "whatsapp", "konuşun",
    "konusun", "bize ulaş", "bilgi al", "teklif", "daha fazla", "devamını", "detaylı bilgi", "haritada",
)
BUTTONS = ("ara", "detay", "harita", "yol tarifi al", "yol tarifi", "devamı", "daha fazla", "iletişim", "bilgi al", "göster", "adres", "telefon", "tıklayınız", "detaylı bilgi", "konum", "haritada göster")
CATEGORIES = ("servisi", "servis", "bayisi", "bayi", "noktas[ıi]", "sat[ıi][şs][ıi]", "mağazas[ıi]", "magazasi", "merkezi")
TRADES = (
    "motor", "motorlu", "motosiklet", "moto", "bisiklet", "oto", "otomotiv", "ticaret", "tic", "ltd", "şti", "sti", "san", "sanayi", r"a\.?ş", "as", "koll", "kollektif",
    "grup", "group", "market", "merkez[iı]", "servis", "plaza", "center", "garage", "garaj", "makina", "makine", "traktör", "yedek", "aksesuar", r"show\s*room", "showroom",
    "kardeşler", r"ve\s+o[gğ]ullar[iı]", "limited", "anonim",
)
MAIL_OR_SITE = r"(?iu)^[^@\s]+@[^@\s]+\.[a-z]{2,}$|^(https?://|www\.)"


_UNIT = re.compile(r"(?:\[[^\]]*\]|\\.|.)[?*+]?")


def _any(words: tuple[str, ...]) -> str:
    """A pattern that fits what any of the words does, common beginnings written once: at each place of a text a few units are tried, not
    all the words."""
    heads: dict[str, list[str]] = {}
    for w in words:
        unit = _UNIT.match(w)
        heads.setdefault(unit[0] if unit else "", []).append(w[unit.end() :] if unit else "")
    shown = [h + (rest[0] if len(rest) == 1 else _any(tuple(dict.fromkeys(rest)))) for h, rest in heads.items()]
    return f"(?:{'|'.join(shown)})"


def _whole(words: tuple[str, ...]) -> str:
    """Any of the words, not within a longer one."""
    return r"(?iu)(?<![\p{L}\p{N}_])" + _any(words) + r"(?![\p{L}\p{N}_])"


def placeholder(c: Column) -> Column:
    """Shown where there is no value."""
    return text(c).rlike(r"(?iu)^[^\p{L}\p{N}_]*(" + "|".join(PLACEHOLDERS) + r")[^\p{L}\p{N}_]*$")


def call_to_action(c: Column) -> Column:
    return text(c).rlike("(?iu)" + _any(CALLS))


def button(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(text(c))), ":+$", "").isin(*BUTTONS)


def trade_word(c: Column) -> Column:
    """A word that firms have in their names and places have not."""
    return text(c).rlike(_whole(TRADES))


def category_list(c: Column) -> Column:
    """Kinds of service with slashes between them: two parts or more with a category's word, and 70% of all."""
    parts = F.filter(F.transform(F.split(text(c), "/"), F.trim), lambda p: p != "")
    told = lambda p: let(F.size(F.filter(p, lambda x: x.rlike(_whole(CATEGORIES)))), lambda n: (n >= 2) & (10 * n >= 7 * F.size(p)))
    return F.contains(text(c), F.lit("/")) & (F.length(text(c)) <= 140) & let(parts, told)


def name_like(c: Column) -> Column:
    """Four characters, three letters, no mail or web address, no short token of letters and digits."""

    def told(t: Column) -> Column:
        token = (F.length(t) <= 8) & t.rlike("^[A-Za-z0-9]+$") & t.rlike("[0-9]")
        return (F.length(t) >= 4) & t.rlike(r"\p{L}\P{L}*+\p{L}\P{L}*+\p{L}") & ~t.rlike(MAIL_OR_SITE) & ~token

    return let(F.regexp_replace(text(c), r"^\s+|\s+$", ""), told)


def may_be_name(c: Column) -> Column:
    """No placeholder, call, button or list of categories, and like a name."""
    return named(name_like(c), placeholder(c), call_to_action(c), button(c), category_list(c))


def named(like: Column, *others: Column) -> Column:
    """may_be_name() of what the other predicates told."""
    for told in others:
        like = like & ~told
    return like
