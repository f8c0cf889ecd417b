"""Diagnosis of brands: what went wrong where, for the report's tab."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as T

#: Fixed value: the label of a record that is up to date.
FRESH = "Güncel"
FAILED = ("hatali", "karantina")


def _top(rows: DataFrame, most: int, *order: Column) -> DataFrame:
    """The first rows of each brand in an order, with their place _n. Spark limits each partition to as many before the shuffle, so a
    brand with a third of all rows is a few hundred rows in its task."""
    w = Window.partitionBy("marka").orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= most)


def _ordered(*fields) -> Column:
    held = F.array_sort(F.collect_list(F.struct("_n", F.struct(*fields).alias("x"))))
    return F.transform(held, lambda r: r["x"])


def diagnosis(records: DataFrame, brands: DataFrame, runs: DataFrame, last: int = 5, first: int = 300) -> DataFrame:
    """A row for each brand of records or brands.

    records: marka, bayi_adi, il, ilce, rol, veri_durumu, son_gorulme; brands: marka, son_deneme_durum, karantina (boolean), son_hata,
    son_basarili, son_basarili_adet, son_deneme; runs: marka, sira (a growing number), bitis, durum, adet, mesaj.
    onem is 3 for a brand in quarantine or whose last try failed, 2 if more than a twentieth of its records are stale, 1 if any, else 0. etiketler
    counts stale records by label (`?` without one), denemeler has the last runs, latest first, kayitlar the first stale records by il, ilce, bayi_adi, rol
    and the rest of their fields. Nulls: rows without a brand are left out, other nulls are empty texts; of equal brands the one with the largest
    row counts. Empty tables give no rows, or brands without records and runs."""
    r = records.filter("marka IS NOT NULL").select("marka", *(T.text(c).alias(c) for c in ("bayi_adi", "il", "ilce", "rol", "veri_durumu")), F.substring(T.text("son_gorulme"), 1, 10).alias("son_gorulme"))
    stale = r.filter(F.col("veri_durumu") != FRESH)
    label = F.when(F.col("veri_durumu") == "", "?").otherwise(F.col("veri_durumu"))
    by_label = r.groupBy("marka", label.alias("label")).agg(F.count("*").alias("n"))
    is_stale = F.col("label") != FRESH
    counts = by_label.groupBy("marka").agg(
        F.sum("n").alias("toplam"), F.coalesce(F.sum(F.when(is_stale, F.col("n"))), F.lit(0)).alias("sorunlu"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(is_stale, F.struct("label", "n"))))).alias("etiketler"),
    )
    fields = ("bayi_adi", "il", "ilce", "rol", "veri_durumu", "son_gorulme")
    listed = _top(stale, first, *(F.col(c) for c in ("il", "ilce", "bayi_adi", "rol", "veri_durumu", "son_gorulme"))).groupBy("marka").agg(_ordered(*fields).alias("kayitlar"))
    tried = runs.filter("marka IS NOT NULL").select("marka", "sira", F.substring(T.text("bitis"), 1, 16).alias("bitis"), T.text("durum").alias("durum"), "adet", F.substring(T.text("mesaj"), 1, 120).alias("mesaj"))
    tried = _top(tried, last, F.desc_nulls_last("sira"), F.desc("bitis"), F.col("durum"), F.col("adet"), F.col("mesaj")).groupBy("marka").agg(_ordered("bitis", "durum", "adet", "mesaj").alias("denemeler"))
    state = ("son_deneme_durum", "karantina", "son_hata", "son_basarili", "son_basarili_adet", "son_deneme")
    known = brands.filter("marka IS NOT NULL").groupBy("marka").agg(F.max(F.struct(*state)).alias("s")).select("marka", "s.*")
    both = known.join(counts, "marka", "full").join(listed, "marka", "left").join(tried, "marka", "left")
    total, bad = F.coalesce("toplam", F.lit(0)), F.coalesce("sorunlu", F.lit(0))
    quarantined = F.coalesce("karantina", F.lit(False))
    grave = F.when(quarantined | T.text("son_deneme_durum").isin(*FAILED), 3).when(20 * bad > total, 2).when(bad > 0, 1).otherwise(0)
    shown = F.when(T.text("son_deneme_durum") != "", F.col("son_deneme_durum")).when(total == 0, "veri yok").otherwise("?")
    none = lambda c, kind: F.coalesce(c, F.array().cast(kind)).alias(c)
    return both.select(
        "marka", grave.alias("onem"), shown.alias("durum"), quarantined.alias("karantina"), F.substring(T.text("son_hata"), 1, 160).alias("hata"), F.substring(T.text("son_basarili"), 1, 16).alias("son_basarili"),
        "son_basarili_adet", F.substring(T.text("son_deneme"), 1, 16).alias("son_deneme"), total.alias("toplam"), bad.alias("sorunlu"),
        F.coalesce("etiketler", F.create_map().cast("map<string,bigint>")).alias("etiketler"), none("denemeler", both.schema["denemeler"].dataType), none("kayitlar", both.schema["kayitlar"].dataType),
    )
