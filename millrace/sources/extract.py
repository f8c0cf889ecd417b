"""Records out of landed pages: HTML cards, embedded JSON and JavaScript, JSON paths, XML, browser captures.

What has a declared shape is read with native functions. HTML has none, so one table function walks it with the standard
parser, page by page (mapInPandas keeps a page within its row's task); ranking and choice are SQL on its rows."""

from __future__ import annotations

import bisect
import json
import re
from collections.abc import Callable, Iterable, Iterator
from html.parser import HTMLParser

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.functions.places import BY_KEY, is_province, key, resolve_province

_SKIP = {"script", "style", "noscript", "svg", "head", "iframe", "footer", "nav"}
_VOID = {"br", "img", "input", "meta", "link", "hr", "area", "base", "col", "embed", "source", "track", "wbr"}
_PHONE = re.compile(T.PHONE)


class _Tree(HTMLParser):
    """Nodes as dicts: tag, class, parts (texts and nodes), attrs."""

    skip = _SKIP

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = {"tag": "", "class": "", "attrs": {}, "parts": [], "up": None}
        self.at, self.skipped = self.root, 0

    def handle_starttag(self, tag, attrs):
        if tag in self.skip:
            if tag in _VOID:
                return
            self.skipped += 1
        if self.skipped:
            return
        if tag == "br":
            self.at["parts"].append("\n")
            return
        names = dict(attrs)
        node = {"tag": tag, "class": " ".join(sorted((names.get("class") or "").split())), "attrs": names, "parts": [], "up": self.at}
        self.at["parts"].append(node)
        if tag not in _VOID:
            self.at = node

    def handle_endtag(self, tag):
        if tag in self.skip:
            if tag in _VOID:
                return
            self.skipped = max(0, self.skipped - 1)
            return
        node = self.at
        while node is not None and node["tag"] != tag:
            node = node["up"]
        if node is not None and node["up"] is not None and not self.skipped:
            self.at = node["up"]

    def handle_data(self, data):
        if not self.skipped:
            self.at["parts"].append(data)


def tree(html: str) -> dict:
    parser = _Tree()
    parser.feed(html or "")
    parser.close()
    return parser.root


def leaves(node: dict) -> Iterator[str]:
    """Texts in document order, phones and mails of links as `tel:` and `mailto:` texts."""
    stack: list = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            for line in x.split("\n"):
                if line.strip():
                    yield " ".join(line.split())
            continue
        href = x["attrs"].get("href") or ""
        if href.startswith(("tel:", "mailto:")):
            yield href
        stack += reversed(x["parts"])


def nodes(node: dict) -> Iterator[dict]:
    stack = [node]
    while stack:
        x = stack.pop()
        yield x
        stack += [p for p in reversed(x["parts"]) if not isinstance(p, str)]


def select(node: dict, selector: str) -> list[dict]:
    """Nodes for `tag`, `.class`, `tag.class`, `tag[attr]` or `tag[attr^=value]`, steps below each other by blanks."""
    found = [node]
    for step in selector.split():
        m = re.fullmatch(r"([\w-]*)((?:\.[\w-]+)*)(?:\[([\w-]+)(?:(\^?=)[\"']?([^\]\"']*)[\"']?)?\])?", step)
        if not m:
            return []
        tag, classes, attr, op, value = m[1], set(m[2].split(".")[1:]), m[3], m[4], m[5]

        def fits(x, tag=tag, classes=classes, attr=attr, op=op, value=value):
            held = x["attrs"].get(attr) if attr else None
            return (not tag or x["tag"] == tag) and classes <= set(x["class"].split()) and (not attr or held is not None and (not op or (held == value if op == "=" else held.startswith(value))))

        found = [y for x in found for y in nodes(x) if y is not x and fits(y)]
    return found


def field_value(node: dict, spec: dict) -> str:
    """The text of a node below, or an attribute of it, or a part of either. spec: sel, attr, regex, index."""
    hit = select(node, spec["sel"]) if spec.get("sel") else [node]
    k, value = spec.get("index", 0), ""
    if -len(hit) <= k < len(hit):
        value = hit[k]["attrs"].get(spec["attr"]) or "" if spec.get("attr") else " ".join(x for x in leaves(hit[k]) if not x.startswith(("tel:", "mailto:")))
    if spec.get("regex") and (m := re.search(spec["regex"], value)):
        value = m[1] or "" if m.groups() else m[0]
    return value


def by_page(pages: DataFrame, rows: Callable[[str | None], Iterable[tuple]], schema: str) -> DataFrame:
    """url and schema: the rows of each page's html. Pages go to Python a hundred at a time, where batches of Arrow hold ten thousand of them
    with all their rows."""
    found = F.udf(lambda html: list(rows(html)), f"array<struct<{schema}>>", useArrow=False)
    return pages.select("url", F.explode(found("html")).alias("_x")).select("url", "_x.*")


def recipe_rows(pages: DataFrame, row: str, fields: dict[str, dict]) -> DataFrame:
    """url, ord and a text column for each field of every node that `row` selects. A field: sel, attr, regex, index."""

    def rows(html):
        for i, node in enumerate(select(tree(html), row)):
            yield (i, *(field_value(node, spec) for spec in fields.values()))

    found = by_page(pages, rows, ", ".join(["ord: int", *(f"`{f}`: string" for f in fields)]))
    return found.select("url", "ord", *(T.clean_text(F.col(f)).alias(f) for f in fields))


_CARD = "grp: string, ord: int, n_phones: int, heading: string, parts: array<string>"


def card_groups(pages: DataFrame) -> DataFrame:
    """Candidate cards: leaf-most nodes that repeat their (tag, class) on the page, with the heading before each."""

    def rows(html):
        heading, groups = "", {}
        for node in nodes(tree(html)):
            if re.fullmatch("h[1-6]", node["tag"]):
                heading = " ".join(leaves(node))
            if node["tag"] and node["tag"] not in ("html", "body"):
                groups.setdefault(f"{node['tag']}.{node['class']}", []).append((node, heading))
        for name, members in groups.items():
            same = {id(n) for n, _ in members}
            inner = [(n, h) for n, h in members if not any(id(x) in same for x in nodes(n) if x is not n)]
            if len(inner) < 2:
                continue
            for i, (node, h) in enumerate(inner):
                parts = list(leaves(node))
                yield name, i, sum(1 for p in parts if _PHONE.search(p.removeprefix("tel:"))), h, parts

    return by_page(pages, rows, _CARD)


# Classes of a page's grid, and signs of an address.
_GRID = re.compile(r"(w|col|row)-?\d")
_ADDRESS_SIGN = re.compile(r"(?i)\b(mah|mh|mahalle|mahallesi|cad|cd|cadde|caddesi|sok|sk|sokak|blv|bulv|bulvar|no\s*:|osb|sanayi|apt|plaza|iş\s*mrk)\b[.\s:]")


def _groups(root: dict, least: int) -> list[list[dict]]:
    """Nodes that repeat: siblings of one tag and class, and, as pages cut their lists into blocks, all innermost nodes of one tag and class."""
    siblings: dict[tuple, list[dict]] = {}
    alike: dict[tuple, list[dict]] = {}
    for node in nodes(root):
        if node["up"] is None:
            continue
        kind = (node["tag"], tuple(c for c in node["class"].split() if not _GRID.match(c)))
        siblings.setdefault((id(node["up"]), *kind), []).append(node)
        if kind[1]:
            alike.setdefault(kind, []).append(node)
    found = list(siblings.values())
    for members in alike.values():
        ids, outer = {id(n) for n in members}, set()
        for n in members:
            up = n["up"]
            while up is not None and id(up) not in outer:
                if id(up) in ids:
                    outer.add(id(up))
                up = up["up"]
        inner = [n for n in members if id(n) not in outer]
        if len(inner) > 3:
            found.append(inner)
    return [g for g in found if len(g) >= least]


def _score(text: str) -> int:
    return 5 * bool(_PHONE.search(text)) + 4 * bool(_ADDRESS_SIGN.search(text)) + 2 * (40 < len(text) < 900)


def page_containers(html: str, least: int = 2, first: int = 12) -> list[list[tuple[int, str, list[str]]]]:
    """The groups of a page that look like lists of points, best first: phones in two members and 40% of them at least, ordered by the
    number of members with a phone, then by the mean score. A member is its number of phones, the province heading above it (where the
    page has three or more), and its texts."""
    root, headings, order = tree(html), [], {}
    for i, node in enumerate(nodes(root)):
        order[id(node)] = i
        if node["up"] is not None and all(isinstance(p, str) for p in node["parts"]):
            shown = " ".join(leaves(node))
            if len(shown) <= 40 and key(shown) in BY_KEY:
                headings.append((i, shown))
    ranked = []
    for group in _groups(root, least):
        parts = [list(leaves(n)) for n in group]
        texts = [" ".join(x for x in p if not x.startswith(("tel:", "mailto:"))) for p in parts]
        phones = [len(_PHONE.findall(t)) for t in texts]
        n = sum(p > 0 for p in phones)
        if n >= max(2, 0.4 * len(group)):
            ranked.append((-n, -sum(map(_score, texts)) / len(group), len(ranked), group, phones, parts))
    out = []
    for *_, group, phones, parts in sorted(ranked, key=lambda x: x[:3])[:first]:
        above = [bisect.bisect_left(headings, (order[id(n)], "")) for n in group]
        out.append([(p, headings[k - 1][1] if k and len(headings) >= 3 else "", x) for p, k, x in zip(phones, above, parts, strict=True)])
    return out


def containers(pages: DataFrame, least: int = 2, first: int = 12) -> DataFrame:
    """The members of the first groups of each page (see page_containers), as card_records() reads them; grp is the group's rank."""

    def rows(html):
        for rank, group in enumerate(page_containers(html, least, first)):
            for i, member in enumerate(group):
                yield (f"{rank:03d}", i, *member)

    return by_page(pages, rows, _CARD)


ADDRESS = r"\b(mah|mh|mahalle|mahallesi|cad|cd|cadde|caddesi|sok|sk|sokak|blv|bulv|bulvar|no|osb|sanayi|apt|plaza)\b"


def card_records(cards: DataFrame) -> DataFrame:
    """url, grp, ord and the fields of each card that has a phone or an address; il_baslik is the last province heading."""
    is_phone = lambda p: F.regexp_like(p, F.lit(T.PHONE))
    is_mail = lambda p: p.startswith("mailto:") | p.rlike(r"^\S+@\S+\.\S+$")
    is_address = lambda p: T.fold(p).rlike(ADDRESS)
    bare = F.filter("parts", lambda p: ~p.startswith("tel:") & ~is_mail(p))
    w = Window.partitionBy("url", "grp").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    made = cards.select(
        "url", "grp", "ord", F.last(F.when(is_province(F.col("heading")), resolve_province(F.col("heading"))), ignorenulls=True).over(w).alias("il_baslik"),
        F.coalesce(F.get(F.filter("parts", is_phone), 0), F.lit("")).alias("telefon"), F.coalesce(F.get(F.filter("parts", is_mail), 0), F.lit("")).alias("email"),
        F.coalesce(F.get(F.filter(bare, is_address), 0), F.lit("")).alias("adres"), F.get(F.filter(F.transform(bare, T.role_of_label), lambda r: r != ""), 0).alias("rol"),
        F.get(F.filter(bare, is_province), 0).alias("il"),
        F.get(F.filter(bare, lambda p: ~is_phone(p) & ~is_address(p) & ~is_province(p) & (T.role_of_label(p) == "") & (F.length(p) > 2)), 0).alias("bayi_adi"),
    )
    out = made.select("url", "grp", "ord", T.clean_text(F.col("bayi_adi")).alias("bayi_adi"), T.text(F.when(F.col("il").isNotNull(), resolve_province(F.col("il")))).alias("il"), T.text("il_baslik").alias("il_baslik"), T.clean_address(F.col("adres")).alias("adres"), T.clean_phone(F.regexp_replace("telefon", "^tel:", "")).alias("telefon"), F.regexp_replace("email", "^mailto:", "").alias("email"), T.text("rol").alias("rol"))
    return out.filter((F.col("telefon") != "") | (F.col("adres") != ""))


def best_group(records: DataFrame, least: float = 0.45) -> DataFrame:
    """The records of each page's best group: two or more, quality at least `least`, the most n * (1 + quality). A group of a page is one row
    while they are ranked, so pages are read once and not again for a join with the best."""
    name = F.col("bayi_adi") != ""
    q = 0.45 * F.avg(name.cast("double")) + 0.25 * F.avg((F.col("telefon") != "").cast("double")) + 0.2 * F.avg((F.col("adres") != "").cast("double")) + 0.1 * F.size(F.collect_set("bayi_adi")) / F.count("*")
    fields = [c for c in records.columns if c not in ("url", "grp")]
    ranked = records.filter("url IS NOT NULL AND grp IS NOT NULL").groupBy("url", "grp").agg(F.count("*").alias("_n"), q.alias("quality"), F.collect_list(F.struct(*fields)).alias("_rows")).filter((F.col("_n") >= 2) & (F.col("quality") >= least))
    best = ranked.groupBy("url").agg(F.max_by(F.struct("grp", "quality", "_rows"), F.struct((F.col("_n") * (1 + F.col("quality"))).alias("s"), "grp", "quality")).alias("_b"))
    return best.select("url", "_b.grp", F.explode("_b._rows").alias("_x"), F.round("_b.quality", 6).alias("quality")).select("url", "grp", "_x.*", "quality")


def page_links(pages: DataFrame) -> DataFrame:
    """url, href, label of every link, in native code."""
    links = F.regexp_extract_all("html", F.lit(r"(?is)<a\b[^>]*?href\s*=\s*[\"'][^\"']*[\"'][^>]*>.*?</a>"), 0)
    one = pages.select("url", F.explode(links).alias("a"))
    return one.select("url", F.regexp_extract("a", r"(?is)href\s*=\s*[\"']([^\"']*)[\"']", 1).alias("href"), T.clean_text(F.regexp_replace("a", "<[^>]*>", " ")).alias("label"))


def province_directories(pages: DataFrame, least: int = 20) -> DataFrame:
    """url, n_il of pages with links that name that many provinces."""
    return page_links(pages).filter(is_province(F.col("label"))).groupBy("url").agg(F.count_distinct(resolve_province(F.col("label"))).alias("n_il")).filter(F.col("n_il") >= least)


def province_selects(pages: DataFrame, least: int = 20) -> DataFrame:
    """url, code, il of the options of a page's fullest select, if that many name provinces."""
    selects = pages.select("url", F.posexplode(F.regexp_extract_all("html", F.lit(r"(?is)<select\b.*?</select>"), 0)).alias("k", "s"))
    options = selects.select("url", "k", F.explode(F.regexp_extract_all("s", F.lit(r"(?is)<option\b[^>]*>[^<]*"), 0)).alias("o"))
    named = options.select("url", "k", F.regexp_extract("o", r"(?is)value\s*=\s*[\"']?([^\"'>]*)", 1).alias("code"), T.clean_text(F.regexp_replace("o", "<[^>]*>", "")).alias("label")).filter(is_province(F.col("label")))
    n = named.groupBy("url", "k").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    best = n.groupBy("url").agg(F.max_by("k", F.struct("n", -F.col("k"))).alias("k"))
    return named.join(best, ["url", "k"]).select("url", "code", resolve_province(F.col("label")).alias("il"))


def json_rows(landed: DataFrame, root: str, fields: dict[str, str], body: str = "body") -> DataFrame:
    """A row for each element under root (a path a.b of objects), with a text column for each field's path. An object at
    the root gives its values."""
    path = "$" + "".join(f".{p}" for p in root.split(".") if p)
    v = F.try_parse_json(F.col(body))
    held = F.try_variant_get(v, path, "array<variant>")
    values = F.map_values(F.try_variant_get(v, path, "map<string, variant>"))
    one = landed.withColumn("_x", F.explode(F.coalesce(held, values)))
    return one.select(*(c for c in landed.columns if c != body), *(T.clean_text(F.coalesce(F.try_variant_get("_x", f"$.{p}", "string"), F.lit(""))).alias(k) for k, p in fields.items()))


def embedded_rows(pages: DataFrame, record: str, fields: dict[str, str], roles: tuple[str, dict[str, str]] | None = None) -> DataFrame:
    """Records that a regular expression bounds in a page's script, with quoted keys as fields and a role by map."""
    one = pages.select("url", F.posexplode(F.regexp_extract_all("html", F.lit(record), 0)).alias("ord", "_b"))
    value = lambda k: T.clean_text(F.regexp_extract("_b", f"(?s)['\"]{re.escape(k)}['\"]\\s*:\\s*['\"](.*?)['\"]", 1))
    role = [F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in roles[1].items() for x in p]), value(roles[0])), F.lit("")).alias("rol")] if roles else []
    return one.select("url", "ord", *(value(k).alias(name) for name, k in fields.items()), *role)


def embedded_json(pages: DataFrame, least: int = 3) -> DataFrame:
    """url, ord, record (JSON text) of the largest list of alike objects within a page's scripts."""

    def lists(x) -> Iterator[list]:
        if isinstance(x, list):
            if sum(isinstance(y, dict) and len(y) >= 2 for y in x) >= least:
                yield [y for y in x if isinstance(y, dict)]
            for y in x:
                yield from lists(y)
        elif isinstance(x, dict):
            for y in x.values():
                yield from lists(y)

    def rows(html):
        best: list = []
        for script in re.findall(r"(?is)<script\b[^>]*>(.*?)</script>", html or ""):
            at = 0
            while (m := re.compile(r"[\[{]").search(script, at)) is not None:
                try:
                    value, at = json.JSONDecoder().raw_decode(script, m.start())
                except ValueError:
                    at = m.start() + 1
                    continue
                best = max([best, *lists(value)], key=len)
        return [(i, json.dumps(r, ensure_ascii=False)) for i, r in enumerate(best)]

    return by_page(pages, rows, "ord: int, record: string")


def xml_rows(landed: DataFrame, schema: str, body: str = "body") -> DataFrame:
    """from_xml after bare ampersands are repaired."""
    fixed = F.regexp_replace(body, "&(?!#?[A-Za-z0-9]+;)", "&amp;")
    return landed.select(*(c for c in landed.columns if c != body), F.from_xml(fixed, schema).alias("x")).select(*(c for c in landed.columns if c != body), "x.*")


HAR = "log struct<entries: array<struct<request: struct<url: string, postData: struct<text: string>>, response: struct<content: struct<text: string, mimeType: string>>>>>"


def har_pages(landed: DataFrame, body: str = "body") -> DataFrame:
    """url, post, html of the HTML answers in a browser capture."""
    e = landed.select(F.explode(F.from_json(body, HAR)["log"]["entries"]).alias("e"))
    return e.select(F.col("e.request.url").alias("url"), T.text("e.request.postData.text").alias("post"), F.col("e.response.content.text").alias("html")).filter(F.col("e.response.content.mimeType").contains("html"))


def first_stage(*stages: DataFrame) -> DataFrame:
    """Rows of the first stage that has any for a url; all stages have the same columns."""
    both = None
    for k, s in enumerate(stages):
        s = s.withColumn("_k", F.lit(k))
        both = s if both is None else both.unionByName(s, allowMissingColumns=True)
    least = both.groupBy("url").agg(F.min("_k").alias("_k"))
    return both.join(least, ["url", "_k"], "left_semi").drop("_k")


def best_decoding(landed: DataFrame, content: str = "content") -> DataFrame:
    """landed with body: bytes as UTF-8 or a Turkish single-byte code, whichever has more Turkish letters and fewer broken
    marks; a declared charset wins. columns: content (binary), charset (or null)."""
    utf8 = F.when(F.is_valid_utf8(F.col(content).cast("string")), F.col(content).cast("string"))
    latin = F.translate(F.decode(content, "ISO-8859-1"), T.LATIN5_WRONG, T.LATIN5_RIGHT)
    score = lambda s: F.regexp_count(s, F.lit(f"[{T.TURKISH}]")) - 5 * F.regexp_count(s, F.lit(f"[{T.MOJIBAKE}�]"))
    named = F.lower(F.coalesce(F.col("charset"), F.lit("")))
    guessed = F.when(utf8.isNotNull() & (score(utf8) >= score(latin)), utf8).otherwise(latin)
    return landed.withColumn("body", F.when(named.isin("utf-8", "utf8") & utf8.isNotNull(), utf8).when(named.isin("windows-1254", "iso-8859-9", "cp1254"), latin).otherwise(guessed))


def expand_urls(spark: SparkSession, sources: DataFrame, places: DataFrame) -> DataFrame:
    """A url for each source and what it iterates over: kind none, plate, slug or range (with lo and hi). places: il, plate.
    Sources and places are some tens of rows each, joined by kind."""
    each = places.select("il", "plate", T.slug(F.col("il")).alias("slug"), F.explode(F.array(F.lit("plate"), F.lit("slug"))).alias("kind"))
    by_place = sources.join(each, "kind").select("marka", "kind", F.replace(F.replace("url", F.lit("{plate}"), F.col("plate").cast("string")), F.lit("{slug}"), F.col("slug")).alias("url"), "il")
    ranged = sources.filter("kind = 'range'").select("marka", "kind", "url", F.explode(F.sequence("lo", "hi")).alias("i")).select("marka", "kind", F.replace("url", F.lit("{i}"), F.col("i").cast("string")).alias("url"), F.lit("").alias("il"))
    return by_place.unionByName(ranged).unionByName(sources.filter("kind = 'none'").select("marka", "kind", "url", F.lit("").alias("il")))


def inherit(sources: DataFrame, brands: DataFrame, *columns: str) -> DataFrame:
    """Source settings with those of their brand where they are null."""
    b = brands.select("marka", *(F.col(c).alias(f"_{c}") for c in columns))
    joined = sources.join(b, "marka", "left")
    return joined.select(*(F.coalesce(c, f"_{c}").alias(c) if c in columns else F.col(c) for c in sources.columns))


