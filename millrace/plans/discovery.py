"""Container discovery over pages that are made of customers, as brands' dealer pages are: cards in blocks, menus, empty cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.places import PROVINCES
from millrace.sources import embedded, extract

from .points import read

SIZE = 24  # customers on a page
_CARD = """concat('<div class="kart col-', c_custkey % 3, '"><h4>Can Motor ', c_custkey, '</h4><p>Gül Sok. No: ', c_custkey, '</p><span>',
  CASE WHEN c_custkey % 7 = 0 THEN 'Telefon yok' ELSE concat('0', 5320000000 + c_custkey) END, '</span></div>')"""


def customer_pages(s: SparkSession, d: str) -> DataFrame:
    """url, html: SIZE customers a page, in blocks of eight under a province's heading each."""
    cards = read(s, d, "customer").selectExpr("c_custkey", f"c_custkey div {SIZE} AS page", f"c_custkey % {SIZE} div 8 AS block", f"{_CARD} AS card")
    blocks = cards.groupBy("page", "block").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "card"))), lambda x: x["card"]), "").alias("cards"))
    names = F.array(*map(F.lit, PROVINCES[:5]))
    shown = F.concat(F.lit("<section><h2>"), F.element_at(names, (F.col("block") + 1).cast("int")), F.lit("</h2>"), F.col("cards"), F.lit("</section>"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", shown.alias("x")))), lambda x: x["x"]), "")
    menu = F.lit("<nav><a>0532 000 00 00</a></nav><ul class='menu'>" + "<li class='m'><a>Model</a></li>" * 9 + "</ul>")
    return blocks.groupBy("page").agg(body.alias("body")).select(F.concat(F.lit("https://x.example/"), F.col("page")).alias("url"), F.concat(F.lit("<html><body>"), menu, "body", F.lit("</body></html>")).alias("html"))


def best_cards(s: SparkSession, d: str) -> DataFrame:
    """The records of each page's best container."""
    return extract.best_group(extract.card_records(extract.containers(customer_pages(s, d)))).select("url", "bayi_adi", "adres", "telefon", "il_baslik")


def chunk_pages(s: SparkSession, d: str) -> DataFrame:
    """url, html: customers as an array of points in a text that is pushed in chunks of 97 characters; names hold quotes and brackets."""
    c = read(s, d, "customer").selectExpr(
        f"c_custkey div {SIZE} AS page", "c_custkey", """named_struct('name', concat('Can "Motor" ] ', c_custkey div 4), 'city', c_mktsegment, 'address', concat('Gül  Sok. No:', c_nationkey),
        'phone', concat('0', 5320000000 + c_custkey), 'shop', c_custkey % 2 = 0, 'service', c_custkey % 3 = 0, 'tags', array(c_custkey)) AS x"""
    )
    points = c.groupBy("page").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "x"))), lambda p: p["x"])).alias("points"))
    whole = points.select("page", F.concat(F.lit('1:["$",{"tags":[2],"dealers":'), "points", F.lit(',"more":[3]}]')).alias("t"))
    chunks = F.transform(F.expr("sequence(0, length(t) div 97)"), lambda i: F.col("t").substr(i * 97 + 1, F.lit(97)))
    pushed = F.transform(chunks, lambda x: F.concat(F.lit('<script>self.__next_f.push([1,"'), F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"])</script>')))
    return whole.select(F.concat(F.lit("https://y.example/"), F.col("page")).alias("url"), F.concat(F.lit("<html>"), F.array_join(pushed, ""), F.lit("</html>")).alias("html"))


def chunk_records(s: SparkSession, d: str) -> DataFrame:
    return embedded.chunk_points(chunk_pages(s, d)).select("url", "bayi_adi", "il", "adres", "telefon", "rol")


QUERIES = {"src12_containers": best_cards, "src25_chunks": chunk_records}
_IL = ", ".join(f"'{p}'" for p in PROVINCES[:5])
ORACLES = {
    "src12_containers": f"""WITH c AS (SELECT c_custkey AS k, c_custkey // {SIZE} AS page, c_custkey % {SIZE} // 8 AS block FROM customer), b AS (SELECT page, count(DISTINCT block) AS n FROM c GROUP BY page)
  SELECT 'https://x.example/' || page AS url, 'Can Motor ' || k AS bayi_adi, 'Gül Sok. No: ' || k AS adres, CASE WHEN k % 7 = 0 THEN '' ELSE '+90' || (5320000000 + k) END AS telefon, CASE WHEN n >= 3 THEN [{_IL}][block + 1] ELSE '' END AS il_baslik
  FROM c JOIN b USING (page)""",
    "src25_chunks": f"""SELECT 'https://y.example/' || c_custkey // {SIZE} AS url, 'Can "Motor" ] ' || c_custkey // 4 AS bayi_adi, c_mktsegment AS il, 'Gül Sok. No:' || c_nationkey AS adres, '0' || (5320000000 + c_custkey) AS telefon,
  CASE WHEN c_custkey % 6 = 0 THEN 'satis_servis' WHEN c_custkey % 2 = 0 THEN 'satis' ELSE 'servis' END AS rol FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0
  QUALIFY row_number() OVER (PARTITION BY c_custkey // {SIZE}, c_custkey // 4, c_mktsegment, c_nationkey ORDER BY c_custkey) = 1""",
}
