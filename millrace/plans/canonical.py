"""Queries of the canonicalising chain: customers as raw records, each a shape of what sources leave out or misplace."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import canonical

from .points import read

#: Places of the raw records. Yenişehir is a district of two provinces.
PLACES = (
    ("Adana", "Çukurova"), ("Antalya", "Alanya"), ("İstanbul", "Kadıköy"), ("İstanbul", "Gazi Osmanpaşa"), ("Hatay", "Antakya"),
    ("Muğla", "Bodrum"), ("Adıyaman", "Besni"), ("İzmir", "Çeşme"), ("Bursa", "İnegöl"), ("Konya", "Akşehir"),
)
OTHERS = (("Ankara", "Yenişehir"), ("Mersin", "Yenişehir"), ("Rize", "Pazar"))
#: By shape: name, il, ilce, adres, heading and combined cell, as SQL over il, ilce and k.
SHAPES = (
    ("n", "upper(il)", "ilce", "'Gül Sok.'", "''", "''"),
    ("ilce", "il", "''", "'Yıldız Motorlu Araçlar  Ova Cad. No:' || k", "''", "''"),
    ("n", "''", "''", "''", "''", "ilce || ' / ' || il"),
    ("n", "''", "''", "'Gül Sok. No:' || k || ' ' || ilce || '/' || il", "'Zonguldak'", "''"),
    ("n", "''", "''", "'Bir Okul Yanı'", "il", "''"),
    ("n", "il", "'Batı / ' || ilce", "''", "''", "''"),
    ("n", "''", "il || ' yöresi'", "''", "''", "''"),
    ("n", "il", "''", "ilce || ' Cad. No:8'", "''", "''"),
    ("n", "il", "il", "'Gül Sok. ' || ilce || ' ' || il", "''", "''"),
    ("n", "''", "lower(ilce)", "''", "''", "''"),
    ("n", "''", "'Yenişehir'", "''", "''", "''"),
    ("n", "il", "'Merkez'", "''", "''", "''"),
    ("n", "'Rize'", "'Yenişehir'", "'Gül Sok. ' || ilce || ', ' || il", "''", "''"),
    ("n", "ilce", "''", "''", "''", "''"),
    ("n", "'Narnia'", "''", "''", "''", "''"),
    ("n", "'Rize'", "ilce", "''", "''", "''"),
)


def _case(column: int) -> str:
    return "CASE s " + " ".join(f"WHEN {i} THEN {shape[column]}" for i, shape in enumerate(SHAPES)) + " END"


def raw_customers(s: SparkSession, d: str) -> DataFrame:
    place = s.createDataFrame([(i, *p) for i, p in enumerate(PLACES)], "p long, il string, ilce string")
    c = read(s, d, "customer").selectExpr("c_custkey AS k", f"c_custkey % {len(SHAPES)} AS s", f"c_custkey div {len(SHAPES)} % {len(PLACES)} AS p", "'Can Motor ' || c_custkey AS n", "'0' || (5320000000 + c_custkey) AS telefon")
    names = ("bayi_adi", "il", "ilce", "adres", "il_baslik", "birlesik")
    return c.join(place, "p").selectExpr("k AS c_custkey", "telefon", *(f"{_case(i)} AS {x}" for i, x in enumerate(names)))


def finalized(s: SparkSession, d: str) -> DataFrame:
    districts = s.createDataFrame(list(PLACES + OTHERS), "il string, ilce string")
    return canonical.canonical(raw_customers(s, d), districts).select("c_custkey", "bayi_adi", "il", "ilce", "telefon")


def localised(s: SparkSession, d: str) -> DataFrame:
    """Customers of a general name, told apart by district, else nation, and then by neighbourhood."""
    c = read(s, d, "customer").join(read(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "c_custkey", "CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE 'Fabrika Satış Mağazası / Satış / Servis' END AS bayi_adi", "n_name AS il",
        "CASE WHEN c_custkey % 5 = 0 THEN 'Semt ' || c_custkey % 7 ELSE '' END AS ilce", "CASE WHEN c_custkey % 4 = 0 THEN 'No:1' ELSE 'Moda ' || c_custkey % 6 || ' Mah. No:1' END AS adres",
    )
    return canonical.localise(c, ["FABRİKA SATIŞ"]).select("c_custkey", "bayi_adi")


QUERIES = {"fn29_finalize": finalized, "fil11_general_names": localised}

_PLACE = ", ".join(f"({i}, '{il}', '{ilce}')" for i, (il, ilce) in enumerate(PLACES))
ORACLES = {
    "fn29_finalize": f"""WITH v(p, il, ilce) AS (VALUES {_PLACE}), c AS (SELECT c_custkey, c_custkey % {len(SHAPES)} AS s, il, ilce FROM customer JOIN v ON p = c_custkey // {len(SHAPES)} % {len(PLACES)})
  SELECT c_custkey, CASE WHEN s = 1 THEN 'Yıldız Motorlu Araçlar' ELSE 'Can Motor ' || c_custkey END AS bayi_adi, CASE WHEN s IN (10, 14) THEN '' WHEN s = 15 THEN 'Rize' ELSE il END AS il,
    CASE WHEN s = 10 THEN 'Yenişehir' WHEN s = 11 THEN il WHEN s IN (4, 6, 7, 14, 15) THEN '' ELSE ilce END AS ilce, '+90' || (5320000000 + c_custkey) AS telefon FROM c""",
    "fil11_general_names": """WITH c AS (SELECT c_custkey AS k, c_name, n_name, c_custkey % 3 <> 0 AS g, CASE WHEN c_custkey % 5 = 0 THEN 'Semt ' || c_custkey % 7 ELSE n_name END || ' Fabrika Satış Mağazası' AS nn FROM customer JOIN nation ON c_nationkey = n_nationkey),
  m AS (SELECT nn, count(*) AS n FROM c WHERE g GROUP BY nn)
  SELECT k AS c_custkey, CASE WHEN NOT g THEN c_name WHEN n > 1 AND k % 4 <> 0 THEN c.nn || ' (Moda ' || k % 6 || ')' ELSE c.nn END AS bayi_adi FROM c LEFT JOIN m ON g AND m.nn = c.nn""",
}
