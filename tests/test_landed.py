"""Decoding by candidates, trimming against all subtrees, and the diagnosis of brands."""

import datetime as dt
import random

from millrace.operators import diagnosis
from millrace.sources import decoding, trimming

TURKISH = "Şişli Çığır Göğüş"


def test_decoding(spark):
    meta = "<meta charset=utf-8>"
    rows = [
        ("utf8", TURKISH.encode(), None, None, TURKISH), ("1254", TURKISH.encode("cp1254"), None, None, TURKISH), ("lie", (meta + TURKISH).encode("cp1254"), None, "text/html; charset=utf-8", meta + TURKISH),
        ("given", TURKISH.encode("iso8859-9"), "ISO-8859-9 ", "charset=utf-8", TURKISH), ("given, broken", TURKISH.encode("cp1254"), "utf-8", None, TURKISH), ("given, worse", TURKISH.encode(), "latin1", None, TURKISH.encode().decode("latin-1")),
        ("header", b"d\xe9j\xe0 \x80", None, 'text/html; charset="windows-1252"', "déjà €"), ("unknown", b"abc", "koi9", "charset=x", "abc"), ("ascii", b"abc", "us-ascii", None, "abc"), ("neither", b"\x81a\xff\x8d", None, None, None),
        ("empty", b"", None, None, ""), ("null", None, "utf-8", None, None), ("late meta", b" " * 5000 + b"charset=latin1 \xfe", None, None, None),
    ]
    got = decoding.decoded(spark.createDataFrame([r[:4] for r in rows], "k string, content binary, charset string, content_type string"))
    got = {r["k"]: r["body"] for r in got.collect()}
    assert {k: got[k] for k, *_, want in rows if want is not None} == {r[0]: r[4] for r in rows if r[4] is not None}
    assert got["null"] is None and "�" in got["neither"] and got["late meta"].endswith("ş")


def test_trimming_keeps_the_smallest_subtree():
    r = random.Random(4)

    def made(depth):
        phones = "".join(f" 0532 {r.randint(100, 999)} 11 22 " for _ in range(r.choice((0, 0, 1, 3))))
        inner = "".join(made(depth - 1) for _ in range(r.randint(0, 3))) if depth else ""
        return f"<div class='a b' style='x'>{phones}<script>0532 111 11 11</script>{inner}</div>"

    for _ in range(60):
        root = trimming.page_tree(made(4))
        count = lambda n: len(trimming._PHONE.findall(trimming.markup(n).replace("<", " <")))
        every, total = list(trimming.nodes(root)), count(root)
        fit = [n for n in every if count(n) >= 0.9 * total] if total else [root]
        best = min(fit, key=lambda n: len(trimming.markup(n))) if total else root
        assert trimming.markup(trimming.region(root)) == trimming.markup(best)
        assert "style" not in trimming.markup(root) and "script" not in trimming.markup(root)


def test_trimmed_pages(spark):
    deep = "<b>" * 3000 + "0532 111 22 33" + "</b>" * 3000
    page = "<body><picture><source src=x><img></picture><p id='m' onclick=1>&lt;a&gt;<br>x</p><ul>" + "".join(f"<li>0532 111 22 3{i}</li>" for i in range(9)) + "</ul><i>0532 000 00 00</i></body>"
    got = {r["url"]: (r["html"], r["n_phones"]) for r in trimming.trimmed(spark.createDataFrame([("a", page), ("b", deep), ("c", None), ("d", "<p id=1 title=2>x &amp; y")], "url string, html string")).collect()}
    assert got["a"] == ("<ul>" + "".join(f"<li>0532 111 22 3{i}</li>" for i in range(9)) + "</ul>", 9)
    assert got["b"] == ("<b>0532 111 22 33</b>", 1) and got["c"] == ("", 0) and got["d"] == ('<p id="1">x &amp; y</p>', 0)


RECORD = "marka string, bayi_adi string, il string, ilce string, rol string, veri_durumu string, son_gorulme string"
BRAND = "marka string, son_deneme_durum string, karantina boolean, son_hata string, son_basarili string, son_basarili_adet int, son_deneme string"
RUN = "marka string, sira long, bitis string, durum string, adet int, mesaj string"


def test_diagnosis(spark):
    now = dt.datetime(2026, 1, 2, 3, 4, 5).isoformat()
    record = lambda m, k, s, name=None: (m, name or f"n{k:04d}", "Rize", None, "satis", s, now)
    records = [record("A", i, "Eski") for i in range(350)] + [record("A", 0, None)] + [record("B", i, "Güncel") for i in range(40)] + [record("B", 99, "Eski")] + [record("C", 0, "Güncel"), record(None, 0, "Eski"), record("D", 0, "Güncel")]
    brands = [("A", "basarili", False, None, now, 5, now), ("C", "hatali", False, "x" * 200, None, None, None), ("E", None, True, None, None, None, None), ("F", None, None, None, None, None, None), ("F", "", None, None, None, None, None), (None,) * 7]
    runs = [("A", i, now, "basarili", i, "m" * 200) for i in range(7)] + [("B", None, None, None, None, None), (None, 1, now, "x", 1, "")]
    got = {r["marka"]: r for r in diagnosis.diagnosis(spark.createDataFrame(records, RECORD), spark.createDataFrame(brands, BRAND), spark.createDataFrame(runs, RUN)).collect()}
    assert {k: (r["onem"], r["durum"], r["toplam"], r["sorunlu"], r["etiketler"]) for k, r in got.items()} == {
        "A": (2, "basarili", 351, 351, {"Eski": 350, "?": 1}), "B": (1, "?", 41, 1, {"Eski": 1}), "C": (3, "hatali", 1, 0, {}), "D": (0, "?", 1, 0, {}), "E": (3, "veri yok", 0, 0, {}), "F": (0, "veri yok", 0, 0, {}),
    }
    assert [x["adet"] for x in got["A"]["denemeler"]] == [6, 5, 4, 3, 2] and {len(x["mesaj"]) for x in got["A"]["denemeler"]} == {120}
    assert [x["bayi_adi"] for x in got["A"]["kayitlar"]] == ["n0000", "n0000", *(f"n{i:04d}" for i in range(1, 299))]
    assert got["A"]["son_basarili"] == now[:16] and len(got["C"]["hata"]) == 160 and got["E"]["denemeler"] == [] and got["B"]["denemeler"][0]["durum"] == ""
    empty = [spark.createDataFrame([], x) for x in (RECORD, BRAND, RUN)]
    assert diagnosis.diagnosis(*empty).collect() == []
