"""Containers of pages against a plain restatement, and pages that break walkers."""

import random

from millrace.sources import extract

CARD = '<div class="{c}"><b>{n}</b><p>Gül Sok. No: 4</p><span>{t}</span></div>'


def page(seed: int) -> str:
    r = random.Random(seed)
    card = lambda i: CARD.format(c=r.choice(["kart", "kart col-6", "w-3 kart", "kart yeni"]), n=f"Can Motor {i}", t=r.choice(["0532 111 22 33", "0212 555 44 33", "yok", ""]))
    block = lambda: f"<section><h3>{r.choice(['Adana', 'Rize', 'Muğla', 'Haber'])}</h3>{''.join(card(i) for i in range(r.randrange(5)))}</section>"
    return "<ul><li>0532 111 22 33<li>0532 111 22 34</ul>" + "".join(block() for _ in range(r.randrange(1, 6))) + "<div class='kart'><div class='kart'>0532 999 88 77</div></div>"


def brute(html: str) -> list[list[str]]:
    """The groups' texts: all pairs of nodes compared, none walked up from."""
    root = extract.tree(html)
    every = [n for n in extract.nodes(root) if n["up"] is not None]
    kind = lambda n: (n["tag"], tuple(c for c in n["class"].split() if not (c[:4] in ("col-", "row-") and c[4:5].isdigit() or c[:2] == "w-" and c[2:3].isdigit())))
    inside = lambda a, b: a is not b and any(x is a for x in extract.nodes(b))
    groups = []
    for i, n in enumerate(every):
        if not any(m["up"] is n["up"] and kind(m) == kind(n) for m in every[:i]):
            groups.append([m for m in every if m["up"] is n["up"] and kind(m) == kind(n)])
    for i, n in enumerate(every):
        if kind(n)[1] and not any(kind(m) == kind(n) for m in every[:i]):
            same = [m for m in every if kind(m) == kind(n)]
            inner = [m for m in same if not any(inside(x, m) for x in same)]
            if len(inner) > 3:
                groups.append(inner)
    out = []
    for g in groups:
        texts = [" ".join(extract.leaves(m)) for m in g]
        n = sum(bool(extract._PHONE.search(t)) for t in texts)
        if len(g) >= 2 and n >= 2 and 10 * n >= 4 * len(g):
            out.append((-n, -sum(map(extract._score, texts)) / len(g), texts))
    return [x[2] for x in sorted(out, key=lambda x: x[:2])[:12]]


def test_containers_equal_brute_force():
    for seed in range(60):
        got = [[" ".join(m[2]) for m in g] for g in extract.page_containers(page(seed))]
        assert sorted(got) == sorted(brute(page(seed))), seed


def test_blocks_of_one_class_are_one_group():
    html = "".join(f"<section>{''.join(CARD.format(c='kart', n=f'Can Motor {i}', t='0532 111 22 33') for i in range(k))}</section>" for k in (3, 2))
    assert len(extract.page_containers(html)[0]) == 5


def test_headings_need_three():
    cards = lambda t: CARD.format(c="kart", n="Can Motor", t="0532 111 22 33") * 2 + t
    two = "<h2>Adana</h2>" + cards("<h2>Rize</h2>") + cards("")
    assert {m[1] for m in extract.page_containers(two)[0]} == {""}
    assert [m[1] for m in extract.page_containers(two.replace("<h2>Rize</h2>", "<h2>Muğla</h2><h2>Rize</h2>"))[0]] == ["Adana", "Adana", "Rize", "Rize"]


def test_deep_pages_are_walked():
    html = "<div>" * 3000 + "Can Motor" + "</div>" * 3000
    assert list(extract.leaves(extract.tree(html))) == ["Can Motor"]
    assert extract.page_containers(html) == []


def test_containers_of_odd_pages(spark):
    rows = [("a", None), ("b", ""), ("c", "<div"), ("d", page(3) + page(4)), ("d", page(3) + page(4))]
    got = extract.containers(spark.createDataFrame(rows, "url string, html string")).collect()
    assert {r["url"] for r in got} == {"d"}
    assert extract.containers(spark.createDataFrame([], "url string, html string")).count() == 0
