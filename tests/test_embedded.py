"""Embedded records of framework pages: broken, nested and cut inputs."""

import json

from millrace.sources import embedded


def push(text: str, size: int) -> str:
    return "".join(f"<script>self.__next_f.push([1,{json.dumps(text[i : i + size])}])</script>" for i in range(0, len(text), size))


def test_arrays_are_cut_at_their_own_bracket():
    points = [{"name": 'a ] "b" \\', "in": [[1], []]}, {"name": "["}]
    text = '0:["$",{"dealers":' + json.dumps(points) + ',"after":[9]}]'
    for size in (3, 7, 1000):
        assert json.loads(embedded.array_after(embedded.chunk_text(push(text, size)), "dealers")) == points
    assert embedded.array_after(text[:40], "dealers") is None
    assert embedded.array_after(text, "points") is None
    assert embedded.array_after('"dealers": 5', "dealers") is None
    assert embedded.array_after('"dealers":' + "[" * 5000 + "]" * 5000, "dealers") == "[" * 5000 + "]" * 5000


def test_a_broken_chunk_is_left_out():
    assert embedded.chunk_text('self.__next_f.push([1,"a"]) self.__next_f.push([1,"\\x"]) self.__next_f.push([1, "b"])') == "ab"
    assert embedded.chunk_text(None) == ""


def test_chunk_points(spark):
    point = lambda **x: {"name": "Can  Motor", "city": "Rize", "address": "Gül Sok.", "phone": "0532", "shop": True, "service": False} | x
    points = [point(), point(phone="again"), point(district="Pazar", shop=False, service=True), point(name="", erp_user_name=" "), point(name="x", shop=0, service=None), point(name="y", service=[1])]
    text = '"points":' + json.dumps(points)
    rows = [("a", push(text, 11)), ("b", None), ("c", "<html>"), ("d", push('"dealers":[{"name":', 4)), ("e", push('"dealers":[{]', 99))]
    got = [tuple(r) for r in embedded.chunk_points(spark.createDataFrame(rows, "url string, html string")).orderBy("ord").select("url", "ord", "bayi_adi", "ilce", "telefon", "rol").collect()]
    assert got == [("a", 0, "Can Motor", "", "0532", "satis"), ("a", 2, "Can Motor", "Pazar", "0532", "servis"), ("a", 5, "y", "", "0532", "satis_servis")]


def test_state_points(spark):
    objs = ["Can Motor ", "Gül Sok. No:4", "0532", '{"lat":1}', 7, "Ova", "kısa", "1", '{"lat":2}', "Can Motor ", "Gül Sok. No:4", "0532", '{"lat":3}', ["x"], "Gül Sok. No:5", "2", '{"lat":4}', '{"lat":5}']
    page = lambda o: f'<script type="qwik/json" id="q">{json.dumps({"objs": o})}</script>'
    rows = [("a", page(objs)), ("b", page([])), ("c", '<script type="qwik/json">{cut</script>'), ("d", None)]
    got = embedded.state_points(spark.createDataFrame(rows, "url string, html string")).collect()
    assert [(r["url"], r["ord"], r["bayi_adi"], r["adres"], r["telefon"], r["rol"]) for r in got if r["bayi_adi"] == "Can Motor"] == [("a", 3, "Can Motor", "Gül Sok. No:4", "0532", "satis_servis")]
    assert {r["url"] for r in got} == {"a"}
