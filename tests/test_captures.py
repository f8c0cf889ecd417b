"""Codes learnt from captured lists, forms that ask for them, cards at phones."""

import json

from millrace.sources import captures


def entry(url="https://a/bayiler", post=None, html="", kind="text/html"):
    return {"request": {"url": url, **({"postData": {"text": post}} if post else {})}, "response": {"content": {"text": html, "mimeType": kind}}}


def card(name, tel, address="Gül Mah. Ova Cad. No:4 Kat 2 EDREMİT / BALIKESİR"):
    return f"<div class=k><h3>{name}</h3><p>{address}</p><span>0266 111 22 33</span><a href='tel:{tel}'>Ara</a></div>"


LIST = "<select name='other'><option value=1>Yok</option></select><select id=x name='city_box' class=y><option value=0>Seç</option><option value='10'> Balıkesir </option><option value=10>İki</option><option value=''>x</option></select>"


def test_capture_points(spark):
    entries = [
        entry(html=LIST), entry(post="a=1&city_box=10", html=card("Can Motor", "0532") + card("CAN Motor", "0532") + card("Ova Motor", " 0533 ", "Kısa bir yol üstünde sekiz kelimeden uzun adres yazısı burada")),
        entry(url="https://a/servis?city=10&x=1", html=card("Can Motor", "0532")), entry(post="email=7&il=%C4%B0zmir", html=card("Su Motor", "1")), entry(post="city=99", html=card("Su Motor", "2", "A Sok. No:5 / İZMİR ilinde bir yerde sekiz kelime")),
        entry(post="city_box=10", html=card("Can Motor", "0532")), entry(html=card("Resim", "3"), kind="image/png"), entry(html="<a href='tel:4'>x</a>"), entry(html=card("", "5")), entry(html=card("0532 111 22 33", "6")), entry(html=None),
    ]
    rows = [("A", "1", json.dumps({"log": {"entries": entries}})), ("A", "2", json.dumps({"log": {"entries": [entry(post="city_box=10", html=card("Can Motor", "0532") + card("Ek", "9"))]}})), ("A", "3", None), ("A", "4", "{cut"), ("A", "5", "{}")]
    got = captures.capture_points(spark.createDataFrame(rows, "marka string, capture string, body string")).collect()
    assert sorted((r["rol"], r["bayi_adi"], r["il"], r["ilce"], r["telefon"]) for r in got) == [
        ("satis", "Can Motor", "Balıkesir", "EDREMİT", "0532"), ("satis", "Ek", "", "EDREMİT", "9"), ("satis", "Ova Motor", "Balıkesir", "", "0533"),
        ("satis", "Su Motor", "", "", "2"), ("satis", "Su Motor", "İzmir", "EDREMİT", "1"), ("servis", "Can Motor", "Balıkesir", "EDREMİT", "0532"),
    ]
    assert {r["adres"] for r in got if r["bayi_adi"] == "Can Motor"} == {"Gül Mah. Ova Cad. No:4 Kat 2 EDREMİT / BALIKESİR"}


def test_deep_cards():
    assert captures.page_cards("<div>" * 3000 + card("Can Motor", "1") + "</div>" * 3000)[0][0] == "Can Motor"
    assert captures.page_cards(None) == []
