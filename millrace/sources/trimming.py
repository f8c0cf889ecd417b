"""Captured pages, without code, styles and pictures, cut down to the part that holds their phones."""

from __future__ import annotations

import html as _html

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .extract import _PHONE, _VOID, _Tree, nodes

# What is left out, and the attributes that stay.
NOISE = {"script", "style", "noscript", "svg", "iframe", "picture", "source", "video", "audio", "canvas", "template"}
ATTRIBUTES = ("class", "id", "href", "data-il", "data-city", "value", "name", "type")


class _Page(_Tree):
    skip = NOISE


def page_tree(html: str | None) -> dict:
    parser = _Page()
    parser.feed(html or "")
    parser.close()
    return parser.root


def markup(node: dict) -> str:
    """HTML of a node, with the attributes that stay; no recursion."""
    out: list[str] = []
    stack: list = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, tuple):
            out.append(x[0])
        elif isinstance(x, str):
            out.append("<br>" if x == "\n" else _html.escape(x, quote=False))
        else:
            held = "".join(f' {a}="{_html.escape(x["attrs"][a] or "")}"' for a in ATTRIBUTES if a in x["attrs"])
            out.append(f"<{x['tag']}{held}>" if x["tag"] else "")
            if x["tag"] and x["tag"] not in _VOID:
                stack.append((f"</{x['tag']}>",))
            stack += reversed(x["parts"])
    return "".join(out)


def phone_counts(root: dict) -> dict[int, int]:
    """The phones in the texts below each node, by its id: a text's phones are counted once and summed up the tree."""
    order = list(nodes(root))
    counts = {id(n): sum(len(_PHONE.findall(p)) for p in n["parts"] if isinstance(p, str)) for n in order}
    for n in reversed(order):
        if n["up"] is not None and n is not root:
            counts[id(n["up"])] += counts[id(n)]
    return counts


def region(root: dict, share: float = 0.9) -> dict:
    """The smallest subtree with that share of the page's phones, the whole page if it has none. share: more than a half, so of
    the nodes side by side one at most has it."""
    counts, at = phone_counts(root), root
    least = share * counts[id(root)]
    while least:
        below = next((n for n in at["parts"] if not isinstance(n, str) and counts[id(n)] >= least), None)
        if below is None:
            break
        at = below
    return at


def trimmed(pages: DataFrame, share: float = 0.9) -> DataFrame:
    """pages with html cut down to the region, and n_phones, the phones in it. A null page is an empty one; all columns pass through."""

    def cut(html):
        part = region(page_tree(html), share)
        return markup(part), phone_counts(part)[id(part)]

    # pages go to Python a hundred at a time, where a batch of Arrow holds ten thousand of them
    cutter = F.udf(cut, "html string, n_phones int", useArrow=False)
    return pages.withColumn("_cut", cutter("html")).withColumns({"html": F.col("_cut.html"), "n_phones": F.col("_cut.n_phones")}).drop("_cut")
