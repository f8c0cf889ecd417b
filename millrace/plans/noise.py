"""The noise predicates over the lines of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import noise

from .points import read

#: Besides prose, lines that a page may have, by the line's number in its document.
EXTRA = ("Konum yok!", "Bize ulaşın", "Detay:", "Yedek Parça Servisi / Satış Bayisi", "info@x.com", "24d", "www.x.com/a", "Can Motor Ltd", "Tümü", "a/b", "Çakmak / Şaban")
_LINE = "CASE WHEN (doc_id + i) % 3 = 0 THEN {extra} ELSE line END"


def line_noise(s: SparkSession, d: str) -> DataFrame:
    """How many lines of each document are of each kind."""
    lines = read(s, d, "documents").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("i", "line"))
    extra = "element_at(array(" + ", ".join(f"'{x}'" for x in EXTRA) + f"), cast((doc_id + i) div 3 % {len(EXTRA)} as int) + 1)"
    shown = lines.selectExpr("doc_id", f"{_LINE.format(extra=extra)} AS line")
    kinds = {"placeholders": noise.placeholder, "calls": noise.call_to_action, "buttons": noise.button, "categories": noise.category_list, "trades": noise.trade_word, "name_like": noise.name_like}
    told = shown.select("doc_id", *(f(F.col("line")).alias(k) for k, f in kinds.items()))
    names = noise.named(*(F.col(k) for k in ("name_like", "placeholders", "calls", "buttons", "categories")))
    return told.groupBy("doc_id").agg(F.count("*").alias("n_lines"), *(F.count_if(k).alias(k) for k in kinds), F.count_if(names).alias("names"))


_EDGE = r"[^\p{L}\p{N}_]"
_ANY = {k: "|".join(v) for k, v in (("p", noise.PLACEHOLDERS), ("c", noise.CALLS), ("k", noise.CATEGORIES), ("t", noise.TRADES))}
QUERIES = {"fil07_noise": line_noise}
ORACLES = {
    "fil07_noise": rf"""WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents), u AS (SELECT doc_id, unnest(range(0, len(w))) AS i, unnest(w) AS line FROM t),
  l AS (SELECT doc_id, {_LINE.format(extra="[" + ", ".join(f"'{x}'" for x in EXTRA) + f"][(doc_id + i) // 3 % {len(EXTRA)} + 1]")} AS line FROM u),
  x AS (SELECT doc_id, line, regexp_replace(line, '^\s+|\s+$', '', 'g') AS n, list_filter(list_transform(string_split(line, '/'), lambda p: trim(p)), lambda p: p <> '') AS parts FROM l),
  f AS (SELECT doc_id, regexp_matches(line, '(?i)^{_EDGE}*({_ANY["p"]}){_EDGE}*$') AS p, regexp_matches(line, '(?i)({_ANY["c"]})') AS c, regexp_replace(lower(trim(line)), ':+$', '') IN {noise.BUTTONS} AS b,
    contains(line, '/') AND length(line) <= 140 AND len(list_filter(parts, lambda q: regexp_matches(q, '(?i)(^|{_EDGE})({_ANY["k"]})($|{_EDGE})'))) >= greatest(2, 0.7 * len(parts)) AS k,
    regexp_matches(line, '(?i)(^|{_EDGE})({_ANY["t"]})($|{_EDGE})') AS t,
    length(n) >= 4 AND len(regexp_extract_all(n, '\p{{L}}')) >= 3 AND NOT regexp_matches(n, '(?i)^[^@\s]+@[^@\s]+\.[a-z]{{2,}}$|^(https?://|www\.)') AND NOT (length(n) <= 8 AND regexp_matches(n, '^[A-Za-z0-9]+$') AND regexp_matches(n, '[0-9]')) AS o FROM x)
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (p) AS placeholders, count(*) FILTER (c) AS calls, count(*) FILTER (b) AS buttons, count(*) FILTER (k) AS categories, count(*) FILTER (t) AS trades, count(*) FILTER (o) AS name_like,
    count(*) FILTER (o AND NOT p AND NOT c AND NOT b AND NOT k) AS names FROM f GROUP BY doc_id""",
}
