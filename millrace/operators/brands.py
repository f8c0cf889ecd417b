"""What is known of each brand's scans: the last good one, the streak of failures, quarantine; and the log of scans.

A brand row: marka, son_basarili, son_basarili_adet, son_deneme, son_deneme_durum, ardisik_hata, karantina. A scan row, one for each
brand: marka, adet (records that came), kapsam (share of pages that came), elle (a hand-kept full list), bitis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store

BRANDS = "marka string, son_basarili timestamp, son_basarili_adet long, son_deneme timestamp, son_deneme_durum string, ardisik_hata int, karantina boolean"


def scans_of(landed: DataFrame) -> DataFrame:
    """One scan row for each brand of landed records (marka, bayi_adi, kapsam, elle, tarih). A landed row without a name is no record: alone
    it stands for a scan that brought nothing. Rows without a brand are left out."""
    adet = F.count_if(F.col("bayi_adi").isNotNull())
    return landed.filter("coalesce(marka, '') != ''").groupBy("marka").agg(adet.alias("adet"), F.coalesce(F.min("kapsam"), F.lit(0.0)).alias("kapsam"), F.coalesce(F.bool_or("elle"), F.lit(False)).alias("elle"), F.max("tarih").alias("bitis"))


def judged(brands: DataFrame, scans: DataFrame) -> DataFrame:
    """scans with beklenen, the number of the last good scan, and state (store.scan_state). A hand-kept list with records is always good."""
    known = brands.select("marka", F.col("son_basarili_adet").alias("beklenen"))
    j = scans.join(known, "marka", "left").withColumn("beklenen", F.coalesce("beklenen", F.lit(0)).cast("long"))
    told = store.scan_state(F.col("adet"), F.col("beklenen"), F.col("kapsam"))
    return j.withColumn("state", F.when(F.col("elle") & (F.col("adet") > 0), "basarili").otherwise(told))


def after(brands: DataFrame, scans: DataFrame) -> DataFrame:
    """Brand rows after judged scans; brands without a scan stay as they are. A failure adds to the streak and leaves all else; a partial
    scan or a fall leaves the streak and tells quarantine; a good one resets both and gives the number to expect."""
    s = scans.select("marka", F.lit(True).alias("_seen"), "adet", "state", "bitis")
    j = brands.join(s, "marka", "full_outer")
    seen, good, failed = F.coalesce("_seen", F.lit(False)), F.col("state") == "basarili", F.col("state") == "hatali"
    pick = lambda test, new, old: F.when(seen & test, new).otherwise(F.col(old)).alias(old)
    streak = F.when(seen, store.failures_after(F.col("state"), F.col("ardisik_hata"))).otherwise(F.col("ardisik_hata"))
    quarantine = F.when(seen & ~failed, F.col("state") == "karantina").otherwise(F.coalesce("karantina", F.lit(False)))
    return j.select("marka", pick(good, F.col("bitis"), "son_basarili"), pick(good, F.col("adet"), "son_basarili_adet"), pick(F.lit(True), F.col("bitis"), "son_deneme"), pick(F.lit(True), F.col("state"), "son_deneme_durum"), streak.cast("int").alias("ardisik_hata"), quarantine.alias("karantina"))


def scan_log(scans: DataFrame) -> DataFrame:
    """marka, bitis, durum, adet, beklenen, kapsam, mesaj of judged scans."""
    share = F.format_string("%.0f%%", F.col("kapsam") * 100)
    said = F.when(F.col("state") == "hatali", "no record came").when(F.col("state") == "karantina", F.concat(F.lit("records fell from "), F.col("beklenen").cast("string"), F.lit(" to "), F.col("adet").cast("string")))
    return scans.select("marka", "bitis", F.col("state").alias("durum"), "adet", "beklenen", "kapsam", said.when(F.col("state") == "kismi", F.concat(share, F.lit(" of the pages came"))).otherwise("").alias("mesaj"))


def commit(held: DataFrame, brands: DataFrame, landed: DataFrame, now: Column) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(new store rows of the landed brands, events, brand rows, scan log). held: the store's rows of those brands. A scan that brought nothing
    leaves its rows; a hand-kept list drops at once what it lacks."""
    scans = judged(brands, scans_of(landed))
    records = landed.filter("bayi_adi IS NOT NULL AND coalesce(marka, '') != ''")
    new, events = store.merge(held, records, scans.select("marka", "state"), now)
    listed = records.join(scans.filter("elle").select("marka"), "marka", "left_semi")
    new = store.replace_manual(new.withColumn("_was", F.col("durum")), listed)
    gone = new.filter("durum = 'kaldirildi' AND _was != 'kaldirildi'")
    events = events.unionByName(gone.select("tekil_key", "marka", "bayi_adi", "il", "ilce", F.lit("kaldirildi").alias("tip"), now.alias("tarih")))
    return new.drop("_was"), events, after(brands, scans), scan_log(scans)
