"""The store as snapshots: new = f(old, scan). Nothing is updated in place and no record is deleted.

A store row: tekil_key, marka, bayi_adi, il, ilce, adres, telefon, rol, durum, kayip_sayaci, ilk_gorulme, son_gorulme.
A scan row: marka, bayi_adi, il, ilce, adres, telefon, rol. Times are parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import merge_roles, text

from . import identity

ANOMALY, COVERAGE, MISSES = 0.60, 0.95, 3
ROLES = ("satis", "servis", "satis_servis")
FIELDS = ("marka", "bayi_adi", "il", "ilce", "adres", "telefon")


def scan_state(count: Column, expected: Column, coverage: Column) -> Column:
    """hatali, karantina, kismi or basarili."""
    return F.when(count == 0, "hatali").when((expected > 0) & (count < ANOMALY * expected), "karantina").when(coverage < COVERAGE, "kismi").otherwise("basarili")


def failures_after(state: Column, before: Column) -> Column:
    return F.when(state == "hatali", F.coalesce(before, F.lit(0)) + 1).when(state == "basarili", F.lit(0)).otherwise(F.coalesce(before, F.lit(0)))


def keyed(scan: DataFrame) -> DataFrame:
    """Scan rows with a known role, one for each key (the last in `ord` if there is such a column)."""
    rows = scan.filter(F.col("rol").isin(*ROLES)).select(*(text(c).alias(c) for c in FIELDS), "rol", *(["ord"] if "ord" in scan.columns else []))
    rows = rows.withColumn("tekil_key", identity.unique_key(F.col("marka"), F.col("telefon"), F.col("bayi_adi"), F.col("adres")))
    order = F.col("ord").desc() if "ord" in scan.columns else F.struct(*FIELDS, "rol").asc()
    return identity.first_by(rows, [F.col("tekil_key")], [order])


def matched(store: DataFrame, scan: DataFrame) -> DataFrame:
    """keyed scan rows with match: the store's key they go to. Equal keys first; else the first row of the same brand and
    province that same_firm() accepts (the smallest key of several). Those meet by phone or by a name word: same_firm() asks for equal phones, or
    for name cores of which six tenths of all words are shared, and so is one of the first n - ceil(0.6 n) + 1 of either side's n words in any
    one order. The order is that of their hashes."""
    new = scan.join(store.select("tekil_key", F.col("tekil_key").alias("match")), "tekil_key", "left")
    def meeting(rows: DataFrame) -> DataFrame:
        words = F.array_sort(F.transform(F.array_distinct(F.split("core", " ")), lambda w: F.xxhash64(w)))
        first = F.slice(words, 1, F.size(words) - F.ceil(F.size(words) * 3 / F.lit(5)).cast("int") + 1)
        by_name = F.when(F.length("core") >= 4, first).otherwise(F.array().cast("array<bigint>"))
        by_phone = F.when(F.col("tel") != "", F.array(F.xxhash64(F.col("tel"), F.lit(1)))).otherwise(F.array().cast("array<bigint>"))
        return identity.prepared(rows).withColumn("meet", F.explode(F.concat(by_phone, by_name)))

    open_ = meeting(new.filter("match IS NULL").drop("match")).alias("x")
    held = meeting(store.select("tekil_key", *FIELDS)).alias("y")
    on = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("marka", "f_il", "meet")]
    met = open_.join(held, on[0] & on[1] & on[2] & identity.same_firm("x", "y"))
    found = met.groupBy(F.col("x.tekil_key").alias("tekil_key")).agg(F.min("y.tekil_key").alias("like"))
    return new.join(found, "tekil_key", "left").withColumn("match", F.coalesce("match", "like")).drop("like")


def merge(store: DataFrame, scan: DataFrame, states: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(new snapshot, events). states: marka, state of this scan (scan_state). Rows that a healthy scan lacks gain a miss,
    and are dropped at the third; other scans leave them."""
    seen = matched(store, keyed(scan))
    # of several scan rows for one store row the one with the row's own key counts, else the smallest
    one = identity.first_by(seen.withColumn("goal", F.coalesce("match", "tekil_key")), [F.col("goal")], [(F.col("tekil_key") != F.col("goal")), "tekil_key"])
    n = one.select("goal", *(F.col(c).alias(f"n_{c}") for c in FIELDS), F.col("rol").alias("n_rol"))
    o = store.join(n, store["tekil_key"] == n["goal"], "full_outer").join(states.select(F.col("marka").alias("s_marka"), "state"), F.col("s_marka") == F.coalesce("marka", "n_marka"), "left")
    is_new, is_seen = F.col("tekil_key").isNull(), F.col("goal").isNotNull()
    back = ~is_new & is_seen & (F.col("durum") != "aktif")
    changed = ~is_new & is_seen & (F.col("durum") == "aktif") & ((F.col("adres") != F.col("n_adres")) | (F.col("telefon") != F.col("n_telefon")))
    role = F.when(is_new, F.col("n_rol")).when(is_seen, merge_roles(text("rol"), F.col("n_rol"))).otherwise(F.col("rol"))
    missed = ~is_seen & (F.col("state") == "basarili") & (F.col("durum") != "kaldirildi")
    misses = F.when(is_seen, F.lit(0)).when(missed, F.col("kayip_sayaci") + 1).otherwise(F.col("kayip_sayaci"))
    dropped = missed & (F.col("kayip_sayaci") + 1 >= MISSES)
    state = F.when(is_seen, "aktif").when(dropped, "kaldirildi").when(missed, "dogrulanamadi").otherwise(F.col("durum"))
    event = lambda test, name: F.when(F.coalesce(test, F.lit(False)), F.lit(name))
    events = F.array_compact(F.array(event(is_new, "eklendi"), event(back, "geri_geldi"), event(changed, "guncellendi"), event(~is_new & is_seen & (role != text("rol")), "rol_degisti"), event(dropped, "kaldirildi")))
    out = o.select(
        F.coalesce("tekil_key", "goal").alias("tekil_key"), *(F.when(is_seen, F.col(f"n_{c}")).otherwise(F.col(c)).alias(c) for c in FIELDS), role.alias("rol"), state.alias("durum"),
        misses.cast("int").alias("kayip_sayaci"), F.coalesce("ilk_gorulme", now).alias("ilk_gorulme"), F.when(is_seen, now).otherwise(F.col("son_gorulme")).alias("son_gorulme"), events.alias("_events"),
    )
    log = out.select("tekil_key", "marka", "bayi_adi", "il", "ilce", F.explode("_events").alias("tip"), now.alias("tarih"))
    return out.drop("_events"), log


def replace_manual(store: DataFrame, listed: DataFrame) -> DataFrame:
    """A hand-kept full list of a brand: its rows that the list lacks, by name and district, are dropped."""
    brands = listed.select("marka").distinct().withColumn("_listed", F.lit(True))
    key = lambda p: F.concat_ws("|", F.lower(text(f"{p}.bayi_adi")), F.lower(text(f"{p}.ilce")))
    names = listed.alias("l").select(F.col("l.marka").alias("_m"), key("l").alias("_k")).distinct().withColumn("_there", F.lit(True))
    s = store.alias("s").join(brands, "marka", "left").withColumn("_key", key("s"))
    s = s.join(names, (F.col("marka") == F.col("_m")) & (F.col("_key") == F.col("_k")), "left")
    gone = F.col("_listed") & F.col("_there").isNull()
    return s.withColumn("durum", F.when(gone, "kaldirildi").otherwise(F.col("durum"))).drop("_listed", "_m", "_k", "_key", "_there")


def merge_parts(base: DataFrame, part: DataFrame, key: str, keep: list[str], order: str) -> DataFrame:
    """base with the last part row (by order) of each key; columns in keep stay as base has them."""
    last = identity.first_by(part, [F.col(key)], [F.col(order).desc()]).drop(order)
    p = last.select(key, *(F.col(c).alias(f"p_{c}") for c in last.columns if c != key)).withColumn("_p", F.lit(True))
    both = base.withColumn("_b", F.lit(True)).join(p, key, "full_outer")
    value = lambda c: F.coalesce(F.col(c), F.col(f"p_{c}")) if c in keep else F.coalesce(F.col(f"p_{c}"), F.col(c))
    return both.select(key, *(value(c).alias(c) if f"p_{c}" in p.columns else F.col(c) for c in base.columns if c != key))


def append_log(base: DataFrame, part: DataFrame, id: str = "id") -> DataFrame:
    """base and the part's rows above base's highest id; a part that is a copy of base adds nothing."""
    high = base.agg(F.coalesce(F.max(id), F.lit(-1))).first()[0]
    return base.unionByName(part.filter(F.col(id) > high))


def cleanup(store: DataFrame, scans: DataFrame, brands: DataFrame, labels: list[str], now: Column) -> DataFrame:
    """tekil_key, why (A to D) of unverified rows to drop: A the name is a label or a number; B an active twin of like
    address; C moved, the same phone and a shared name; D healthy brand, three good scans and three days since. scans: marka,
    bitis, durum; brands: marka, karantina, son_deneme_durum."""
    rows = identity.prepared(store).withColumn("f_ad", identity.fold(F.col("bayi_adi")))
    waiting, active = rows.filter("durum = 'dogrulanamadi'").alias("x"), rows.filter("durum = 'aktif'").alias("y")
    x, y = (lambda n: F.col(f"x.{n}")), (lambda n: F.col(f"y.{n}"))
    label = waiting.filter(x("f_ad").isin(*labels) | x("bayi_adi").rlike(r"^[\d\s()+/.\-]{7,}$")).select(x("tekil_key").alias("tekil_key"), F.lit("A").alias("why"))
    by_phone = waiting.filter("tel != ''").join(active, (x("marka") == y("marka")) & (x("tel") == y("tel")))
    by_name = waiting.join(active, (x("marka") == y("marka")) & (x("f_ad") == y("f_ad")) & (x("f_il") == y("f_il")))
    like = identity.address_like(x("a_tokens"), y("a_tokens"), x("a_door"), y("a_door"))
    twin = by_phone.filter(like).select(x("tekil_key").alias("tekil_key")).unionByName(by_name.filter(like).select(x("tekil_key").alias("tekil_key"))).withColumn("why", F.lit("B"))
    moved = by_phone.filter(F.arrays_overlap(x("telling"), y("telling")) | (x("f_ad") == y("f_ad"))).select(x("tekil_key").alias("tekil_key"), F.lit("C").alias("why"))
    good = scans.filter("durum = 'basarili'").select(F.col("marka").alias("g_marka"), "bitis")
    later = waiting.join(good, (x("marka") == F.col("g_marka")) & (F.col("bitis") > x("son_gorulme"))).groupBy(x("tekil_key").alias("tekil_key"), x("marka").alias("marka"), x("son_gorulme").alias("son")).agg(F.count("*").alias("n"))
    healthy = brands.filter("NOT coalesce(karantina, false) AND son_deneme_durum = 'basarili'").select("marka")
    gone = later.join(healthy, "marka", "left_semi").filter((F.col("n") >= 3) & (F.floor((F.unix_timestamp(now) - F.unix_timestamp("son")) / 86400) >= 3)).select("tekil_key", F.lit("D").alias("why"))
    return label.unionByName(twin).unionByName(moved).unionByName(gone).groupBy("tekil_key").agg(F.min("why").alias("why"))
