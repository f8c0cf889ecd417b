"""Native column expressions for Turkish text, phones, addresses and labels. Missing text is the empty string."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters and their counterparts.
UPPER, LOWER = "IİĞÜŞÖÇ", "ıiğüşöç"
LOWER_OF_UPPER, UPPER_OF_LOWER = "iığüşöç", "İIĞÜŞÖÇ"
ACCENTED, PLAIN = "çğıöşüâîûéèêëñáàäóòôúùíìïãõåýÿ", "cgiosuaiueeeenaaaooouuiiiaoayy"
LATIN5_WRONG, LATIN5_RIGHT = "ýþðÝÞÐ", "ışğİŞĞ"
#: Marks of UTF-8 read as Latin-1, and the letters that a repair must bring.
MOJIBAKE, TURKISH = "ÃÄÅÂ", "çğıöşüÇĞİÖŞÜ"


def text(c: Column | str) -> Column:
    """The column as text, null as empty."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def let(value: Column, body) -> Column:
    """body(value) with the value written and computed once."""
    return F.transform(F.array(value), body)[0]


def tr_lower(c: Column) -> Column:
    return F.lower(F.translate(text(c), UPPER, LOWER))


def tr_upper(c: Column) -> Column:
    return F.upper(F.translate(text(c), LOWER_OF_UPPER, UPPER_OF_LOWER))


def repair_mojibake(c: Column) -> Column:
    """UTF-8 that was read as Latin-1, if the repair is valid and brings Turkish letters."""

    def repaired(x: Column) -> Column:
        raw = F.encode(x, "ISO-8859-1").cast("string")
        ok = lambda y: F.when(F.is_valid_utf8(y) & y.rlike(f"[{TURKISH}]"), y).otherwise(x)
        return F.when(x.rlike(f"[{MOJIBAKE}]") & x.rlike(r"^[\x00-\xFF]*$"), let(raw, ok)).otherwise(x)

    return let(text(c), repaired)


def repair_latin5(c: Column) -> Column:
    return F.translate(text(c), LATIN5_WRONG, LATIN5_RIGHT)


def fold(c: Column) -> Column:
    """The matching key: repaired, lower case, plain letters and digits, single blanks."""
    plain = F.translate(tr_lower(repair_mojibake(c)), ACCENTED, PLAIN)
    return F.trim(F.regexp_replace(F.regexp_replace(plain, r"\p{M}+", ""), "[^a-z0-9]+", " "))


def label_key(c: Column) -> Column:
    """Like fold, but punctuation stays."""
    plain = F.lower(F.translate(F.translate(F.trim(F.regexp_replace(text(c), r"\s+", " ")), "ıİI", "iii"), ACCENTED + "ĞÜŞÖÇÂ", PLAIN + "gusoca"))
    return F.regexp_replace(plain, r"\p{M}+", "")


def title_tr(c: Column) -> Column:
    words = F.filter(F.split(tr_lower(c), r"\s+"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.translate(F.substring(w, 1, 1), LOWER_OF_UPPER, UPPER_OF_LOWER)), w.substr(F.lit(2), F.length(w)))), " ")


#: Named character references that occur in practice.
ENTITIES = (("&nbsp;", " "), ("&quot;", '"'), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&ccedil;", "ç"), ("&Ccedil;", "Ç"), ("&ouml;", "ö"), ("&Ouml;", "Ö"), ("&uuml;", "ü"), ("&Uuml;", "Ü"), ("&acirc;", "â"), ("&icirc;", "î"), ("&amp;", "&"))


def unescape(c: Column) -> Column:
    """Character references: the named ones above and decimal or hexadecimal numbers."""

    def piece(x: Column, i: Column) -> Column:
        number = F.regexp_extract(x, "^([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});?", 1)
        rest = F.regexp_replace(x, "^(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});?", "")
        code = F.when(F.lower(number).startswith("x"), F.conv(F.substring(number, 2, 6), 16, 10)).otherwise(number).try_cast("int")

        def shown(k: Column) -> Column:  # a code point as UTF-32 in big-endian bytes
            valid = F.coalesce((k > 0) & (k < 0x110000) & ~k.between(0xD800, 0xDFFF), F.lit(False))
            return F.when(valid, F.concat(F.decode(F.unhex(F.lpad(F.hex(k), 8, "0")), "UTF-32"), rest)).otherwise(F.concat(F.lit("&#"), x))

        return F.when(i == 0, x).otherwise(let(code, shown))

    def numbers(x: Column) -> Column:
        return F.when(F.instr(x, "&#") > 0, F.array_join(F.transform(F.split(x, "&#"), piece), "")).otherwise(x)

    out = let(text(c), numbers)
    for name, letter in ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(letter))
    return out


def clean_text(c: Column) -> Column:
    """References, repairs, odd blanks, one blank between words."""
    out = repair_latin5(repair_mojibake(unescape(c)))
    out = F.regexp_replace(F.regexp_replace(out, " ", " "), "[​̇]", "")
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def clean_address(c: Column) -> Column:
    """Without labels at either end."""
    out = F.regexp_replace(clean_text(c), r"(?iu)^(?:\s*(?:adres|address)\s*[:\-–]?\s*)+", "")
    out = F.regexp_replace(out, r"(?iu)(?:\s*(?:telefon|tel|gsm|e-?posta|e-?mail)\s*[:\-–]?\s*)+$", "")
    out = F.regexp_replace(out, r"(?iu)^(?:\s*(?:adres|address)\s*[:\-–]?\s*)+", "")
    return F.regexp_replace(out, "^[ ·\\-–,]+|[ ·\\-–,]+$", "")


def digits(c: Column) -> Column:
    return F.regexp_replace(text(c), r"[^0-9]", "")


def first_number(c: Column) -> Column:
    """The first of several phone numbers in one cell, glued ones cut by length."""

    def cut(x: Column) -> Column:
        whole, part, d = x["c"], x["part"], x["d"]
        n = F.length(d)
        out = F.when(F.length(digits(part)).between(10, 13), part)
        for size in (12, 11, 10):
            out = out.when((n >= 2 * size - 2) & (n % size == 0), F.substring(d, 1, size))
        return out.when((n > 13) & d.startswith("0"), F.substring(d, 1, 11)).when(n > 13, F.substring(d, 1, 10)).otherwise(whole)

    pieces = lambda x: F.struct(x.alias("c"), F.trim(F.split(x, r"(?iu)[-/,;]|\bve\b|\bveya\b")[0]).alias("part"), digits(x).alias("d"))
    return let(let(text(c), pieces), cut)


def clean_phone(c: Column) -> Column:
    """+90 and ten digits, else the cleaned text."""

    def shaped(x: Column) -> Column:
        number, d = x["n"], x["d"]
        n = F.length(d)
        return (
            F.when(number == "", "")
            .when(n == 10, F.concat(F.lit("+90"), d))
            .when((n == 11) & d.startswith("0"), F.concat(F.lit("+90"), F.substring(d, 2, 10)))
            .when((n == 12) & d.startswith("90"), F.concat(F.lit("+"), d))
            .otherwise(clean_text(number))
        )

    return let(let(first_number(c), lambda x: F.struct(x.alias("n"), digits(x).alias("d"))), shaped)


def phone_display(c: Column) -> Column:
    c = text(c)
    shown = F.concat(F.lit("0"), c.substr(4, 3), F.lit(" "), c.substr(7, 3), F.lit(" "), c.substr(10, 2), F.lit(" "), c.substr(12, 2))
    return F.when(c.startswith("+90") & (F.length(c) == 13), shown).otherwise(c)


# Fixed value: a phone is ten digits, area 2 to 5 or 8, not inside a longer run of digits.
PHONE = r"(?<![0-9])(?:\+90[\s.\-]?)?0?[\s(]*[2-58][0-9]{2}[)\s.\-]*[0-9]{3}[\s.\-]*[0-9]{2}[\s.\-]*[0-9]{2}(?![0-9])"


def phone_count(c: Column) -> Column:
    return F.regexp_count(text(c), F.lit(PHONE))


# Labels of a point's kind, joint ones first.
ROLE_LABELS = (
    ("satis_servis", ("satis ve servis", "bayi ve servis", "satis servis", "satis / servis", "bayi servis", "satis+servis", "bayi ve yetkili servis", "satis noktasi ve servis")),
    ("servis", ("yetkili servis", "servis noktasi", "teknik servis", "servis agi", "sadece servis", "servis merkezi", "authorized service", "service point", "servis")),
    ("satis", ("satis noktasi", "bolge bayisi", "yetkili bayi", "yetkili satici", "teslimat noktasi", "showroom", "bayi", "satici", "magaza", "dealer", "sales point", "satis magazasi", "satis")),
)
SALES_WORDS = ("yetkili satici", "yetkili bayi", "satis noktasi", "satis noktalari", "satis merkezi", "satici", "bayii", "bayi", "showroom", "dealer", "magaza", "satis")
SERVICE_WORDS = ("yetkili servis", "teknik servis", "servis noktasi", "servis noktalari", "servis merkezi", "servisler", "servis")
IGNORED_WORDS = ("yedek parca", "aksesuar bayi", "aksesuar noktasi", "bayilik basvuru", "servislik basvuru", "bayi girisi", "bayi portali")
PARTS_WORDS = ("yedek parca", "yedekparca", "sparepart", "spare part", "spareparts", "parca bayi", "parts", "aksesuar")


def _any(c: Column, words) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(c, F.lit(w))
    return out


def role_of_label(c: Column) -> Column:
    """The role that a short label names, or ''."""

    def told(f: Column) -> Column:
        out = F.when(f == "", "")
        for role, labels in ROLE_LABELS:
            for label in labels:
                out = out.when((f == label) | (F.contains(f, F.lit(label)) & (F.length(f) <= len(label) + 10)), role)
        return out.otherwise("")

    return F.when(F.length(text(c)) > 32, "").otherwise(let(fold(c), told))


def role_of_heading(c: Column, default: str = "") -> Column:

    def told(key: Column) -> Column:
        sales, service = _any(key, SALES_WORDS), _any(key, SERVICE_WORDS)
        return F.when(key == "", default).when(_any(key, IGNORED_WORDS), "").when(sales & service, "satis_servis").when(service, "servis").when(sales, "satis").otherwise(default)

    return let(label_key(c), told)


def role_of_flags(sales: Column, service: Column) -> Column:
    return F.when(sales & service, "satis_servis").when(sales, "satis").when(service, "servis").otherwise("")


def role_of_type(c: Column, mapping: dict[str, str]) -> Column:
    """The role that a source's own category maps to; unknown ones and parts give ''. Categories are compared by fold()."""

    def told(s: Column) -> Column:
        out = F.when((s == "") | _any(s, PARTS_WORDS), "")
        for k, v in mapping.items():
            out = out.when(s == fold(F.lit(k)), v)
        for k, v in mapping.items():
            out = out.when(F.contains(s, fold(F.lit(k))), v)
        return out.otherwise("")

    return let(fold(c), told)


def merge_roles(a: Column, b: Column) -> Column:
    """Both roles together; never less than the first."""
    return F.when(a == "", b).when((b == "") | (a == b), a).otherwise("satis_servis")


def matches(value: Column, query: Column) -> Column:
    """An empty query passes everything."""
    return (text(query) == "") | F.contains(fold(value), fold(query))


def backoff_hours(failures: Column) -> Column:
    return F.least(3 * F.pow(F.lit(2.0), F.greatest(failures, F.lit(1)) - 1), F.lit(24.0))


def age_days(now: Column, then: Column) -> Column:
    """Elapsed periods of 24 hours."""
    return F.floor((F.unix_timestamp(now) - F.unix_timestamp(then)) / 86400)


def freshness(state: Column, quarantine: Column, last_good: Column, last_state: Column, now: Column) -> Column:
    """The label of a record's data, the first that holds."""
    age = age_days(now, last_good)
    failed = last_state.isin("hatali", "kismi")
    return (
        F.when(state == "kaldirildi", "dropped")
        .when(state == "dogrulanamadi", "unverified")
        .when(quarantine, "quarantine")
        .when(last_good.isNull() & (failed | (last_state == "karantina")), "failed so far")
        .when(last_good.isNull(), "never scanned")
        .when(failed & (age > 0), F.concat(F.lit("last good "), age.cast("string"), F.lit(" days ago")))
        .when(failed, "last good today")
        .when(F.unix_timestamp(now) - F.unix_timestamp(last_good) > 7 * 86400, F.concat(F.lit("old "), age.cast("string"), F.lit(" days")))
        .otherwise("current")
    )


def machine_url(c: Column) -> Column:
    """An endpoint for programs rather than a page."""
    return F.lower(text(c)).rlike(r"(/api/|/ajax|/wp-json/|graphql|\.json(\?|$)|\.xml(\?|$)|admin-ajax)")


def slug(c: Column, by: str = "") -> Column:
    return F.replace(fold(c), F.lit(" "), F.lit(by))


def short_number(c: Column) -> Column:
    """1234 as 1,2 B and 1234567 as 1,2 Mn."""
    shown = lambda x: F.translate(F.format_number(x, 1), ".,", ",")  # noqa: E731  without marks of thousands
    return F.when(c >= 1_000_000, F.concat(shown(c / 1_000_000), F.lit(" Mn"))).when(c >= 1000, F.concat(shown(c / 1000), F.lit(" B"))).otherwise(c.cast("string"))
