"""Sites as rows of a registry: where their lists are (targets) and how a page of theirs is read (recipes), without code per site.

A registry has some tens of rows, one for each brand and role; its recipes are JSON texts. read() hands them as one constant to a
table function whose columns follow from the recipes (its analyze step), so pages are read where they lie, with no join and no shuffle."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from millrace.functions import text as T

from . import extract

MOST = 2_000  # rows of a registry; more are an error

_EITHER_QUOTED = r"['\"]{}['\"]\s*:\s*['\"]((?:[^'\"\\]|\\.)*)['\"]"


def _at(value: object, path: str) -> object:
    """What a path of names and numbers, `a.b.0`, leads to; null if it leads nowhere."""
    for step in path.split(".") if path else ():
        if isinstance(value, list) and step.isdigit():
            value = value[int(step)] if int(step) < len(value) else None
        else:
            value = value.get(step) if isinstance(value, dict) else None
    return value


def _shown(value: object) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _json(recipe: dict, body: str) -> Iterator[dict[str, str]]:
    """Elements of a list, or values of an object, at the path `row`; a field is a path, or {path, regex}."""
    try:
        held = _at(json.loads(body), recipe.get("row", ""))
    except (ValueError, RecursionError):
        return
    for x in held.values() if isinstance(held, dict) else held if isinstance(held, list) else ():
        yield {name: _part(_shown(_at(x, spec if isinstance(spec, str) else spec["path"])), spec) for name, spec in recipe["fields"].items()}


def _part(value: str, spec: object) -> str:
    if isinstance(spec, dict) and spec.get("regex"):
        m = re.search(spec["regex"], value)
        return "" if m is None else (m[1] or "") if m.groups() else m[0]
    return value


def _html(recipe: dict, body: str) -> Iterator[dict[str, str]]:
    """Nodes that `row` selects; a field is a spec of extract.field_value, {label: text before a value}, or {heading: selector}, the last such
    node before the row."""
    root = extract.tree(body)
    chosen = {id(n) for n in extract.select(root, recipe["row"])}
    headings = {name: {id(n) for n in extract.select(root, spec["heading"])} for name, spec in recipe["fields"].items() if "heading" in spec}
    last = dict.fromkeys(headings, "")
    for node in extract.nodes(root):
        for name, ids in headings.items():
            if id(node) in ids:
                last[name] = " ".join(extract.leaves(node))
        if id(node) in chosen:
            yield {name: last[name] if "heading" in spec else _labelled(node, spec["label"]) if "label" in spec else extract.field_value(node, spec) for name, spec in recipe["fields"].items()}


def _labelled(node: dict, label: str) -> str:
    """What follows a label in its text, or the next text."""
    texts = [x for x in extract.leaves(node) if not x.startswith(("tel:", "mailto:"))]
    for x, after in zip(texts, [*texts[1:], ""], strict=True):
        m = re.match(rf"(?i)\s*{re.escape(label)}\s*:?\s*", x)
        if m:
            return x[m.end() :] or after
    return ""


def _script(recipe: dict, body: str) -> Iterator[dict[str, str]]:
    """Records that the expression `row` bounds in a script; a field is its quoted key."""
    for m in re.finditer(recipe["row"], body):
        hit = {name: re.search(_EITHER_QUOTED.format(re.escape(k)), m[0]) for name, k in recipe["fields"].items()}
        yield {name: x[1] if x else "" for name, x in hit.items()}


_IDIOMS = {"html": _html, "json": _json, "script": _script}


def checked(recipes: dict[str, dict]) -> dict[str, dict]:
    """recipes, or an error that names the first that can't be read."""
    for name, recipe in recipes.items():
        if recipe.get("idiom") not in _IDIOMS or not isinstance(recipe.get("fields"), dict) or not recipe["fields"]:
            raise ValueError(f"recipe of {name}: idiom must be one of {', '.join(_IDIOMS)}, fields must name some")
        if {"marka", "url", "ord"} & {f.lower() for f in recipe["fields"]}:
            raise ValueError(f"recipe of {name}: marka, url and ord can't be fields")
        if recipe["idiom"] != "json" and not recipe.get("row"):
            raise ValueError(f"recipe of {name}: row is missing")
    return recipes


class Records:
    """The table function: rows of a table (marka, url, body) by the recipes of their marka; a row without a recipe gives none."""

    @staticmethod
    def analyze(row: AnalyzeArgument, recipes: AnalyzeArgument) -> AnalyzeResult:
        if not row.isTable or not recipes.isConstantExpression or recipes.value is None:
            raise ValueError("records(TABLE(pages), recipes): the recipes must be a constant")
        schema = StructType().add("marka", StringType()).add("url", StringType()).add("ord", IntegerType())
        for name in dict.fromkeys(f for r in checked(json.loads(recipes.value)).values() for f in r["fields"]):
            schema = schema.add(name, StringType())
        return AnalyzeResult(schema)

    def __init__(self):
        self.recipes, self.names = None, []

    def eval(self, row, recipes):
        if self.recipes is None:
            self.recipes = json.loads(recipes)
            self.names = list(dict.fromkeys(f for r in self.recipes.values() for f in r["fields"]))
        recipe = self.recipes.get(row["marka"])
        if recipe is None or not row["body"]:
            return
        for i, made in enumerate(_IDIOMS[recipe["idiom"]](recipe, row["body"])):
            yield (row["marka"], row["url"], i, *(made.get(n) for n in self.names))


def register(spark: SparkSession, name: str = "records") -> None:
    """For SQL: SELECT * FROM records(TABLE(pages), '{"brand": {"idiom": ..., "row": ..., "fields": {...}}}')."""
    spark.udtf.register(name, F.udtf(Records))


def read(landed: DataFrame, registry: DataFrame) -> DataFrame:
    """marka, url, ord and a text column for each field of any recipe (null where a brand's recipe hasn't it). landed: marka, url,
    body; registry: marka, recipe (of equal brands the smallest recipe counts; nulls are left out)."""
    held = registry.filter("marka IS NOT NULL AND recipe IS NOT NULL").groupBy("marka").agg(F.min("recipe").alias("recipe")).limit(MOST + 1).collect()
    if len(held) > MOST:
        raise ValueError(f"a registry has {MOST} brands at most")
    recipes = {r["marka"]: json.loads(r["recipe"]) for r in sorted(held)}
    return F.udtf(Records)(landed.select("marka", "url", "body").asTable(), F.lit(json.dumps(recipes, ensure_ascii=False)))


def targets(sources: DataFrame, places: DataFrame, options: DataFrame) -> DataFrame:
    """marka, rol, url, post, il: what is to be fetched of each source.

    sources: kaynak (its url, where options were captured), markalar (array), rol, kind, url, post (null, or a form body). places: il,
    plate, some tens of rows. options: url (of the source), code, il, as extract.province_selects() finds them.
    kind `tek` is one url; `il` takes each place for {plate}, {slug}, {ad} and {AD}; `secenek` takes each option of the source's own page
    for {code}; a source without options then has no target. A source of several brands has its targets for each."""
    s = sources.select("kaynak", F.explode("markalar").alias("marka"), "rol", "kind", "url", T.text("post").alias("post"))

    def put(c: str, values: dict[str, Column]) -> Column:
        out = F.col(c)
        for name, v in values.items():
            out = F.replace(out, F.lit(f"{{{name}}}"), v)
        return out.alias(c)

    one = s.filter("kind = 'tek'").select("marka", "rol", "url", "post", F.lit("").alias("il"))
    il = F.col("il")
    by_place = {"plate": F.col("plate").cast("string"), "slug": T.slug(il), "ad": il, "AD": T.tr_upper(il)}
    each = s.filter("kind = 'il'").join(places.withColumn("kind", F.lit("il")), "kind").select("marka", "rol", put("url", by_place), put("post", by_place), "il")
    of = options.select(F.col("url").alias("kaynak"), "code", "il").filter("code != ''").distinct()
    chosen = s.filter("kind = 'secenek'").join(of, "kaynak").select("marka", "rol", put("url", {"code": F.col("code")}), put("post", {"code": F.col("code")}), "il")
    return one.unionByName(each).unionByName(chosen)
