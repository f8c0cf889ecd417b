"""Identity, store, schedule, extraction and streaming on small fixtures."""

import json

from pyspark.sql import functions as F

from millrace.operators import identity, reports, schedule, store
from millrace.sources import extract, sinks
from millrace.streaming import scans

REC = "id long, bayi_adi string, il string, ilce string, adres string, telefon string"


def pairs(spark, rows):
    return {(r["a"], r["b"]) for r in identity.same_pairs(spark.createDataFrame(rows, REC)).collect()}


def test_same_firm(spark):
    a = (1, "Yıldız Motor Ltd. Şti.", "Konya", "Selçuklu", "Ata Cad. No: 5", "+901")
    assert pairs(spark, [a, (2, "YILDIZ MOTORLU ARAÇLAR", "Konya", "Selçuklu", "Ata Caddesi No:5 Konya", "+901")]) == {(1, 2)}
    assert pairs(spark, [a, (2, "Bambaşka Ticaret", "Konya", "Selçuklu", "Ata Cad. No: 5", "+901")]) == set()  # other name
    assert pairs(spark, [a, (2, "Yıldız Motor", "Konya", "Selçuklu", "Ata Cad. No: 9", "+901")]) == set()  # other door
    assert pairs(spark, [a, (2, "Yıldız Motor", "Konya", "Meram", "Ata Cad. No: 5", "+901")]) == set()  # other district
    assert pairs(spark, [a, (2, "Yıldız Motor", "Konya", "", "", "+901")]) == {(1, 2)}  # unknown district
    assert pairs(spark, [a, (2, "Yıldız Motor", "Konya", "Selçuklu", "", "")]) == {(1, 2)}  # name and district
    assert pairs(spark, [a, (2, "Yıldız Motor", "Ankara", "", "Ata Cad. No: 5", "")]) == set()  # other province
    assert pairs(spark, [a, (2, None, None, None, None, None)]) == set()
    assert pairs(spark, [a, (2, "Yıldız Motor", "Konya", "Selçuklu", "Güneş Bulvarı Uzun Apt 7", "+902")]) == set()


def test_same_pairs_of_copies(spark, monkeypatch):
    """Many copies in several arrays, ids with two records, nulls: the pairs of comparing all with all, each once; and nothing sorts or
    shuffles them."""
    rows = [(i, ("Ay Motor", "Gün Yıldız", "Kuzey Yıldız")[i % 3], "Konya", ("Meram", "Ilgın")[i // 3 % 2], f"Ata Cad. No: {i % 2 + 1}", ("", "+901")[i % 5 == 0]) for i in range(60)]
    rows += [(7, "Gün Yıldız", "Konya", "Meram", "Ata Cad. No: 1", ""), (7, "Gün Yıldız", "Konya", "Meram", "Ata Cad. No: 1", ""), (8, "Gün Yıldız", "Konya", "Meram", "Ata Cad. No: 1", ""), (None, "Ay Motor", "Konya", "Meram", "", "+901"), (99, None, None, None, None, None)]
    monkeypatch.setattr(identity, "CHUNK", 4)
    df = spark.createDataFrame(rows, REC)
    found = identity.same_pairs(df)
    p = identity.prepared(df).withColumn("keys", identity.block_keys())
    x, y = p.alias("x"), p.alias("y")
    every = x.join(y, (F.col("x.id") < F.col("y.id")) & F.arrays_overlap("x.keys", "y.keys") & identity.same_firm("x", "y")).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    got, expected = sorted(map(tuple, found.collect())), sorted(map(tuple, every.collect()))
    assert got == expected and len(got) > 150
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode") < plan.index("Aggregate")  # no aggregate above the pairs


def test_same_pairs_are_held_by_id(spark):
    """The ids of one array and those of the other become rows in stages of their own: a compiled stage holds all that it makes of a row, which would be
    the pairs of an array with an array."""
    import re

    df = spark.createDataFrame([(i, "Kuzey Yıldız", "Konya", "Meram", "Ata Cad. No: 1", "") for i in range(20)], REC)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = identity.same_pairs(df)
        stages = re.findall(r"\*\((\d+)\) Generate (?:pos)?explode\(i[xy]", found._jdf.queryExecution().executedPlan().toString())
        assert sorted(map(tuple, found.collect())) == [(i, j) for i in range(20) for j in range(i + 1, 20)]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(stages) == len(set(stages)) == 2


def test_firm_groups(spark):
    rows = [(1, "Koç Motor", "Konya", "Meram", "Ata Cad. No: 5", "05321234567"), (2, "Koç Motor", "Konya", "Meram", "", "5321234567"), (3, "Koç Motor", "Konya", "Meram", "Ata Cad. No: 9", "05321234567"), (4, None, None, None, None, None)]
    got = {r["id"]: r["temsilci"] for r in identity.firm_groups(spark.createDataFrame(rows, REC)).collect()}
    assert got[1] == got[2] != got[3] and len(got) == 4


def test_codes(spark):
    firms = spark.createDataFrame([(i,) for i in range(500)], "temsilci long")
    known = spark.createDataFrame([(7, "ABCD")], "temsilci long, kod string")
    got = {r["temsilci"]: r["kod"] for r in identity.assign_codes(firms, known).collect()}
    assert got[7] == "ABCD" and len(set(got.values())) == 500
    audit = identity.audit_codes(spark.createDataFrame([(1, "AAAA", "No: 1 x"), (2, "AAAA", "No: 2 x"), (3, "", ""), (4, "bad!", "")], "id long, kod string, adres string"))
    assert {(r["kod"], r["problem"]) for r in audit.collect()} == {("AAAA", "mixed addresses"), ("", "uncoded"), ("bad!", "form")}


def scan(spark, rows):
    return spark.createDataFrame(rows, "marka string, bayi_adi string, il string, ilce string, adres string, telefon string, rol string")


def test_merge_life(spark):
    old = spark.createDataFrame([], scans.STORE)
    t = lambda d: F.lit(f"2024-01-{d:02d}").cast("timestamp")
    ok = spark.createDataFrame([("m", "basarili")], "marka string, state string")
    a, b = ("m", "Ay Motor", "Konya", "Meram", "A Cad. No: 1", "+905000000001", "satis"), ("m", "Gün Motor", "Konya", "Meram", "B Cad. No: 2", "+905000000002", "servis")
    new, log = store.merge(old, scan(spark, [a, b, ("m", "x", "", "", "", "", "")]), ok, t(1))
    assert {r["tip"] for r in log.collect()} == {"eklendi"} and new.count() == 2
    for day, state in ((2, ("dogrulanamadi", 1)), (3, ("dogrulanamadi", 2)), (4, ("kaldirildi", 3))):
        new, log = store.merge(spark.createDataFrame(new.collect(), scans.STORE), scan(spark, [a]), ok, t(day))
        assert {(r["durum"], r["kayip_sayaci"]) for r in new.filter("telefon = '+905000000002'").collect()} == {state}
    assert [r["tip"] for r in log.collect()] == ["kaldirildi"]
    held = spark.createDataFrame(new.collect(), scans.STORE)
    partial = spark.createDataFrame([("m", "kismi")], "marka string, state string")
    new, log = store.merge(held, scan(spark, [b[:6] + ("satis",)]), partial, t(5))
    assert {r["tip"] for r in log.collect()} == {"geri_geldi", "rol_degisti"}
    assert {(r["telefon"], r["durum"], r["rol"]) for r in new.collect()} == {("+905000000001", "aktif", "satis"), ("+905000000002", "aktif", "satis_servis")}


def test_cleanup(spark):
    rows = [("k1", "m", "Detay", "dogrulanamadi", "+901", "A", "2024-01-01"), ("k2", "m", "Ayla Motor", "aktif", "+902", "Z Cad. No: 1", "2024-01-01"), ("k3", "m", "Ayla Motor", "dogrulanamadi", "+902", "Z Cad. No: 1", "2024-01-01"), ("k4", "m", "Ayla Ticaret", "dogrulanamadi", "+902", "Y Cad. No: 7", "2024-01-01"), ("k5", "m", "Tek Firma", "dogrulanamadi", "", "Q", "2024-01-01")]
    s = spark.createDataFrame([(k, m, n, "Konya", "Meram", a, p, "satis", d, 0, None, None) for k, m, n, d, p, a, _ in rows], scans.STORE).withColumn("son_gorulme", F.lit("2024-01-01").cast("timestamp"))
    good = spark.createDataFrame([("m", f"2024-01-0{i} 10:00:00", "basarili") for i in (2, 3, 4)], "marka string, bitis string, durum string").withColumn("bitis", F.col("bitis").cast("timestamp"))
    brands = spark.createDataFrame([("m", False, "basarili")], "marka string, karantina boolean, son_deneme_durum string")
    got = {r["tekil_key"]: r["why"] for r in store.cleanup(s, good, brands, ["detay"], F.lit("2024-01-10").cast("timestamp")).collect()}
    assert got == {"k1": "A", "k3": "B", "k4": "C", "k5": "D"}


def test_parts_and_manual(spark):
    base = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, n int, first string")
    part = spark.createDataFrame([("b", 5, "z", 1), ("b", 6, "w", 2), ("c", 7, "q", 1)], "k string, n int, first string, part int")
    got = {tuple(r) for r in store.merge_parts(base, part, "k", ["first"], "part").collect()}
    assert got == {("a", 1, "x"), ("b", 6, "y"), ("c", 7, "q")}
    s = spark.createDataFrame([("k1", "m", "A", "i", "d", "", "", "satis", "aktif", 0, None, None), ("k2", "m", "B", "i", "d", "", "", "satis", "aktif", 0, None, None), ("k3", "o", "C", "i", "d", "", "", "satis", "aktif", 0, None, None)], scans.STORE)
    listed = spark.createDataFrame([("m", "a", "D")], "marka string, bayi_adi string, ilce string")
    assert {r["tekil_key"]: r["durum"] for r in store.replace_manual(s, listed).collect()} == {"k1": "aktif", "k2": "kaldirildi", "k3": "aktif"}


def test_schedule(spark):
    b = spark.createDataFrame([("a", 30.0), ("b", 20.0), ("c", 10.0), ("d", 5.0)], "marka string, minutes double")
    got = {r["marka"]: r["job"] for r in schedule.deal(b, 2).collect()}
    assert got == {"a": 0, "b": 1, "c": 1, "d": 0}
    now = F.lit("2024-01-10 12:00:00").cast("timestamp")
    rows = [(None, None, "", 0, 168.0, 0, 5), ("2024-01-01 00:00:00", "2024-01-10 11:00:00", "hatali", 1, 168.0, 0, 5), ("2024-01-09 00:00:00", None, "basarili", 0, 168.0, 0, 5), ("2024-01-01 00:00:00", None, "basarili", 0, 168.0, 0, 5), ("2024-01-01 00:00:00", None, "basarili", 0, 168.0, 2, 5)]
    df = spark.createDataFrame(rows, "g string, t string, s string, f int, p double, slot int, prio int")
    due = schedule.due(F.col("g").cast("timestamp"), F.col("t").cast("timestamp"), F.col("s"), F.col("f"), F.col("p"), F.col("slot"), F.col("prio"), now)
    assert [r[0]["due"] for r in df.select(due).collect()] == [True, False, False, False, True]


CARDS = """<html><body><h3>KONYA</h3><div class="k"><h4>Ay Motor</h4><p>Ata Mah. Gün Cad. No: 5</p><a href="tel:05321234567">Ara</a><span>Yetkili Servis</span></div>
<div class="k"><h4>Gün Motor</h4><p>Zafer Sok. No: 7</p><a href="tel:05321234568">Ara</a></div>
<script>var t = [{"ad":"A","il":"x"},{"ad":"B","il":"y"},{"ad":"C","il":"z"}];</script></body></html>"""


def test_extraction(spark):
    pages = spark.createDataFrame([("u1", CARDS), ("u2", ""), ("u3", None)], "url string, html string")
    got = extract.best_group(extract.card_records(extract.card_groups(pages))).orderBy("ord").collect()
    assert [(r["bayi_adi"], r["telefon"], r["rol"], r["il_baslik"]) for r in got if r["grp"] == "div.k"] == [("Ay Motor", "+905321234567", "servis", ""), ("Gün Motor", "+905321234568", "", "")] or [(r["bayi_adi"], r["telefon"]) for r in got] == [("Ay Motor", "+905321234567"), ("Gün Motor", "+905321234568")]
    rows = extract.recipe_rows(pages, "div.k", {"ad": {"sel": "h4"}, "tel": {"sel": "a[href^=tel:]", "attr": "href", "regex": r"tel:(\d+)"}}).orderBy("ord").collect()
    assert [(r["ad"], r["tel"]) for r in rows] == [("Ay Motor", "05321234567"), ("Gün Motor", "05321234568")]
    assert [json.loads(r["record"])["ad"] for r in extract.embedded_json(pages).orderBy("ord").collect()] == ["A", "B", "C"]


def test_declared_sources(spark):
    body = json.dumps({"data": {"rows": [{"n": "A&amp;B", "p": {"x": 1}}, {"n": None}]}})
    got = extract.json_rows(spark.createDataFrame([("u", body), ("v", "broken")], "url string, body string"), "data.rows", {"ad": "n", "x": "p.x"}).collect()
    assert [(r["ad"], r["x"]) for r in got] == [("A&B", "1"), ("", "")]
    js = "x = [{'name': 'Ay', 'type': 'yetkili'}, {'name': 'Gün', 'type': 'yok'}]"
    got = extract.embedded_rows(spark.createDataFrame([("u", js)], "url string, html string"), r"\{[^}]*\}", {"ad": "name"}, ("type", {"yetkili": "satis"})).collect()
    assert [(r["ad"], r["rol"]) for r in got] == [("Ay", "satis"), ("Gün", "")]
    xml = "<r><AD>Ay & Gün</AD><IL>Konya</IL></r>"
    assert extract.xml_rows(spark.createDataFrame([("u", xml)], "url string, body string"), "AD string, IL string").first()["AD"] == "Ay & Gün"
    har = json.dumps({"log": {"entries": [{"request": {"url": "h", "postData": {"text": "il=6"}}, "response": {"content": {"text": "<p>", "mimeType": "text/html"}}}]}})
    assert extract.har_pages(spark.createDataFrame([(har,)], "body string")).first()["post"] == "il=6"
    raw = [("a", "Şişli".encode(), None), ("b", "Şişli".encode("iso-8859-9"), None), ("c", "Şişli".encode("cp1254"), "windows-1254")]
    got = extract.best_decoding(spark.createDataFrame(raw, "k string, content binary, charset string")).collect()
    assert [r["body"] for r in got] == ["Şişli"] * 3
    src = spark.createDataFrame([("m", "plate", "http://h/{plate}", 0, 0), ("n", "range", "http://h/{i}", 1, 3), ("o", "none", "http://o", 0, 0)], "marka string, kind string, url string, lo int, hi int")
    dim = spark.createDataFrame([("Adana", 1), ("Muş", 49)], "il string, plate int")
    assert {r["url"] for r in extract.expand_urls(spark, src, dim).collect()} == {"http://h/1", "http://h/49", "http://h/2", "http://h/3", "http://o"}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("Konya", "ğ;x"), ("Muş", "b")], "il string, ad string")
    sinks.write_csv(df, str(tmp_path / "c"))
    raw = b"".join(p.read_bytes() for p in (tmp_path / "c").glob("part-*"))
    assert raw.startswith("﻿".encode()) and '"ğ;x"'.encode() in raw
    sinks.write_by_key(df, str(tmp_path / "k"), "il")
    assert sinks.content_hash(spark.read.parquet(str(tmp_path / "k")).select("il", "ad")).first() == sinks.content_hash(df).first()


def test_stream(spark, tmp_path):
    landed = tmp_path / "in"
    landed.mkdir()
    row = {"marka": "m", "bayi_adi": "Ay Motor", "il": "Konya", "ilce": "Meram", "adres": "A Cad. No: 1", "telefon": "+905000000001", "rol": "satis", "kapsam": 1.0}
    (landed / "1.json").write_text(json.dumps(row | {"tarih": "2024-01-01T00:00:00"}))
    assert scans.run(spark, str(landed), str(tmp_path / "s"), str(tmp_path / "c")) == 1
    (landed / "2.json").write_text(json.dumps(row | {"rol": "servis", "tarih": "2024-01-02T00:00:00"}))
    assert scans.run(spark, str(landed), str(tmp_path / "s"), str(tmp_path / "c")) == 2
    got = scans.snapshot(spark, str(tmp_path / "s"), 2).collect()
    assert [(r["rol"], r["durum"]) for r in got] == [("satis_servis", "aktif")]
    assert [r["tip"] for r in spark.read.parquet(str(tmp_path / "s" / "log" / "v2")).collect()] == ["rol_degisti"]


def test_stream_touches_its_brands_only(spark, tmp_path):
    landed, base = tmp_path / "in", str(tmp_path / "s")
    landed.mkdir()

    def land(number, rows):
        (landed / f"{number}.json").write_text("\n".join(json.dumps(r | {"tarih": f"2024-01-0{number}T00:00:00"}) for r in rows))
        assert scans.run(spark, str(landed), base, str(tmp_path / "c")) == number
        return {r["marka"]: r for r in scans.brands(spark, base, number).collect()}

    def points(brand, numbers, **more):
        return [{"marka": brand, "bayi_adi": f"Firma{n} Ay", "il": "Konya", "ilce": "Meram", "adres": f"Yol{n} Cad. No: {n}", "telefon": "", "rol": "satis", "kapsam": 1.0} | more for n in numbers]

    state = lambda version, brand: sorted((r["bayi_adi"][5], r["durum"], r["kayip_sayaci"]) for r in scans.snapshot(spark, base, version).filter(f"marka = '{brand}'").collect())
    got = land(1, points("a", range(1, 6)) + points("b/1", [1, 2]))
    assert {k: (v["version"], v["son_basarili_adet"], v["ardisik_hata"], v["karantina"]) for k, v in got.items()} == {"a": (1, 5, 0, False), "b/1": (1, 2, 0, False)}
    got = land(2, [{"marka": "a", "kapsam": 0.0}, {"bayi_adi": "no brand"}])  # nothing came
    assert (got["a"]["version"], got["a"]["ardisik_hata"], got["a"]["son_deneme_durum"], got["a"]["son_basarili_adet"]) == (2, 1, "hatali", 5)
    assert got["b/1"]["version"] == 1 and not list((tmp_path / "s" / "store" / "version=2").glob("marka=b*"))
    got = land(3, [{"marka": "a", "kapsam": 0.0}])
    assert got["a"]["ardisik_hata"] == 2 and state(3, "a") == [(str(n), "aktif", 0) for n in range(1, 6)]
    got = land(4, points("a", [1, 2]))  # a fall: quarantine, nobody is missed, the streak stays
    assert (got["a"]["karantina"], got["a"]["ardisik_hata"], got["a"]["son_deneme_durum"]) == (True, 2, "karantina") and ("5", "aktif", 0) in state(4, "a")
    got = land(5, points("a", [1, 2], elle=True))  # a hand-kept full list
    assert (got["a"]["karantina"], got["a"]["ardisik_hata"], got["a"]["son_basarili_adet"]) == (False, 0, 2)
    assert [x[1] for x in state(5, "a")] == ["aktif"] * 2 + ["kaldirildi"] * 3 and state(5, "b/1") == [("1", "aktif", 0), ("2", "aktif", 0)]
    assert [r["tip"] for r in spark.read.parquet(f"{base}/log/v5").collect()] == ["kaldirildi"] * 3
    assert [r["mesaj"] for r in spark.read.parquet(f"{base}/scans/v4").collect()] == ["records fell from 5 to 2"]
    assert scans.vacuum(spark, base, 5) == [] and len(state(1, "a")) == 5
    land(6, points("b/1", [1]))
    assert state(6, "b/1") == [("1", "aktif", 0), ("2", "aktif", 0)] and scans.vacuum(spark, base, 6) == [1, 2, 3, 4] and len(state(6, "a")) == 5


def test_matched_meets_all_that_same_firm_accepts(spark):
    from millrace.operators import identity

    words = ("ay", "yildiz", "demir", "kaya", "deniz", "akin")
    made = [("m", f"{words[k % 6]} {words[k * 5 % 6]} {words[k // 6 % 6]}", "Konya", "" if k % 3 else "Meram", f"Yol{k % 2} Cad. No: {k % 2 + 1}", "" if k % 4 else f"+9050000000{k % 5:02d}", "satis") for k in range(40)]
    rows = spark.createDataFrame(made, "marka string, bayi_adi string, il string, ilce string, adres string, telefon string, rol string")
    held, scan = store.keyed(rows.limit(20)), store.keyed(rows)
    x, y = identity.prepared(scan).alias("x"), identity.prepared(held).alias("y")
    every = x.join(y, (F.col("x.f_il") == F.col("y.f_il")) & identity.same_firm("x", "y")).groupBy(F.col("x.tekil_key").alias("k")).agg(F.min("y.tekil_key").alias("m"))
    own = {r["tekil_key"] for r in held.collect()}
    want = {r["k"]: r["m"] for r in every.collect() if r["k"] not in own}
    got = {r["tekil_key"]: r["match"] for r in store.matched(held, scan).collect() if r["tekil_key"] not in own and r["match"]}
    assert got == want and want


def test_reports_empty(spark):
    empty = spark.createDataFrame([], "marka string, kod string, ad string, il string, ilce string, rol string, tel string, adres string, durum string, ord long")
    assert reports.overview(empty).first()["total"] == 0
    assert reports.firm_counts(empty, "il").count() == 0
