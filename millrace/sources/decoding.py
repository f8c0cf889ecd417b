"""The text of landed bytes: each code that is declared or likely is tried on the bytes, and the text that looks least broken is kept.

Native code: single-byte codes are read as Latin-1 and their own letters put in place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as T

#: Names of codes that can be read, by the name of the codec; others are passed over.
NAMES = {
    "utf-8": ("utf-8", "utf8"), "cp1254": ("cp1254", "windows-1254"), "iso8859-9": ("iso-8859-9", "iso8859-9", "latin5", "latin-5"),
    "cp1252": ("cp1252", "windows-1252"), "latin-1": ("iso-8859-1", "iso8859-1", "latin1", "latin-1"), "ascii": ("ascii", "us-ascii"),
}
# Traces of a wrong code, and where a code is declared.
BROKEN = "[ÃÄÅ][\\x80-\\xBF]|[ýþðÝÞÐ]|\\x{FFFD}"
_CHARSET = r"(?i)charset\s*=\s*[\"']?\s*([\w-]+)"


def _single_byte(content: Column, codec: str) -> Column:
    """The text, null if a byte means nothing in that code."""
    told = {b: bytes([b]).decode(codec, "ignore") for b in range(128, 256)}
    other = {chr(b): c for b, c in told.items() if c and c != chr(b)}
    latin = F.decode(content, "ISO-8859-1")
    text = F.translate(latin, "".join(other), "".join(other.values())) if other else latin
    missing = [b for b, c in told.items() if not c]
    return F.when(~latin.rlike("[" + "".join(f"\\x{b:02X}" for b in missing) + "]"), text) if missing else text


def decoded_as(content: Column, name: Column) -> Column:
    """The text of bytes in a named code; null if the code is unknown or the bytes aren't valid in it."""
    utf8 = content.cast("string")
    out = F.when(name.isin(*NAMES["utf-8"]), F.when(F.is_valid_utf8(utf8), utf8))
    for codec, names in NAMES.items():
        if codec != "utf-8":
            out = out.when(name.isin(*names), _single_byte(content, codec))
    return out


def score(c: Column) -> Column:
    """Turkish letters, less five for each trace of a wrong code."""
    return F.regexp_count(c, F.lit(f"[{T.TURKISH}]")) - 5 * F.regexp_count(c, F.lit(BROKEN))


def decoded(landed: DataFrame, content: str = "content", wanted: str = "charset", header: str = "content_type") -> DataFrame:
    """landed with body, of the columns content (binary), charset (a code that is known, or null) and content_type (the header, or null).

    Tried are, in this order, the wanted code, the header's, that of the first 4096 bytes, UTF-8 and Windows-1254; the wanted one is taken if
    the bytes are valid in it, else the best score, of equal ones the earlier. Bytes that are valid in none are read as UTF-8 with marks for what
    can't be read. Null bytes give a null body, no bytes an empty one."""
    b = F.col(content)
    named = lambda c: F.lower(F.trim(c))
    declared = lambda c: named(F.regexp_extract(F.coalesce(c, F.lit("")), _CHARSET, 1))
    start = F.decode(F.substring(b, 1, 4096), "ISO-8859-1")
    tried = F.array(named(F.col(wanted)), declared(F.col(header)), declared(start), F.lit("utf-8"), F.lit("cp1254"))
    texts = F.transform(tried, lambda n, i: F.struct(i.alias("i"), decoded_as(b, n).alias("t")))
    valid = F.filter(texts, lambda x: x["t"].isNotNull())
    scored = F.transform(valid, lambda x: F.struct((x["i"] == 0).alias("given"), score(x["t"]).alias("s"), (-x["i"]).alias("i"), x["t"].alias("t")))
    return landed.withColumn("body", F.when(b.isNotNull(), F.coalesce(F.array_max(scored)["t"], F.make_valid_utf8(b.cast("string")))))
