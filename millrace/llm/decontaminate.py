"""Benchmark decontamination with a generalised suffix automaton.

The benchmark's items, as words, go into suffix automata of bounded size. Every document streams its words
through each of them, which tracks the longest item passage that ends at each word; words inside a passage of
`window` words of an item are hit. An item of fewer words counts when it occurs whole.

Memory: an automaton holds at most `max_words` item words (a state or two for each), and a longer benchmark goes
through several automata, one pass over the rows for each, so its size is not bounded. A document is one row of an
Arrow batch. Nothing is shuffled.

Nulls: a null text has no words; a null item text has none; a null item id is named as "null". An empty benchmark
leaves every document clean. Repeated items and repeated documents are judged alike. Columns of documents other than
the named ones pass through in remove_spans().
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

WINDOW, MAX_WORDS = 10, 200_000

#: Bytes of words stay (A-Z in lower case), all others are blanks.
_WORD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD).split() if text else []


class Automaton:
    """The suffix automaton of several word sequences. States carry the items that hold their passage."""

    def __init__(self, window: int = WINDOW):
        self.window, self.ids = window, {}
        self.next, self.link, self.length = [{}], [-1], [0]
        self._seen: list[tuple[int, str, list[int], list[int]]] = []

    def add(self, item: str, words: list[bytes]) -> None:
        last, ids, states = 0, [self.ids.setdefault(w, len(self.ids)) for w in words], []
        for w in ids:
            last = self._extend(last, w)
            states.append(last)
        if ids:
            self._seen.append((len(ids), item, ids, states))

    def _new(self, length: int, nexts: dict, link: int) -> int:
        self.next.append(nexts)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        clone = self._new(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        known = self.next[last].get(w)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, known, w)
        new, p = self._new(self.length[last] + 1, {}, -1), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return new

    def finish(self) -> Automaton:
        """For each state: the window lengths that may end there (a full window, whole short items), with their items."""
        n, window = len(self.next), self.window
        self.items: list[dict[int, set[str]]] = [{} for _ in range(n)]  # by window length, at the state of that passage
        for size, item, ids, _ in self._seen:
            width, state, length = min(size, window), 0, 0
            for w in ids:
                state, length = self.step(state, length, w)
                while self.length[self.link[state]] >= width:
                    state = self.link[state]
                length = min(length, self.length[state])
                if length >= width:
                    self.items[state].setdefault(width, set()).add(item)
        #: For each state: [(width, items)] of itself and of the states its suffix links lead to.
        self.ends: list[tuple] = [()] * n
        for s in sorted(range(1, n), key=self.length.__getitem__):
            self.ends[s] = (*sorted(((k, frozenset(v)) for k, v in self.items[s].items()), reverse=True), *self.ends[self.link[s]])
        del self.items, self._seen
        return self

    def step(self, state: int, length: int, w: int) -> tuple[int, int]:
        nexts = self.next
        while state >= 0:
            to = nexts[state].get(w)
            if to is not None:
                return to, length + 1
            state = self.link[state]
            length = self.length[state] if state >= 0 else 0
        return 0, 0

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """The hit spans [first, last), in order and disjoint, and the items that have an occurring window."""
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        nexts, link, lengths, ends = self.next, self.link, self.length, self.ends
        state = length = 0
        for i, w in enumerate(map(self.ids.get, words, repeat(-1))):
            if w < 0:
                state = length = 0
                continue
            to = nexts[state].get(w)
            while to is None:
                state = link[state]
                if state < 0:
                    break
                length = lengths[state]
                to = nexts[state].get(w)
            if to is None:
                state = length = 0
                continue
            state, length = to, length + 1
            if ends[state]:
                longest = 0
                for width, items in ends[state]:
                    if width <= length:
                        longest = max(longest, width)
                        found |= items
                if longest:
                    first = i + 1 - longest
                    while spans and spans[-1][1] >= first:
                        first = min(first, spans.pop()[0])
                    spans.append((first, i + 1))
        return spans, found


def automata(benchmark: DataFrame, window: int = WINDOW, max_words: int = MAX_WORDS, item: str = "item_id", text: str = "text") -> Iterator[Automaton]:
    """Automata of at most max_words item words each (a single longer item has its own)."""
    held, size = Automaton(window), 0
    for row in benchmark.select(F.col(item).cast("string"), F.col(text)).toLocalIterator():
        words = words_of(row[1])
        if size and size + len(words) > max_words:
            yield held.finish()
            held, size = Automaton(window), 0
        held.add("null" if row[0] is None else row[0], words)
        size += len(words)
    yield held.finish()


def find_spans(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_words: int = MAX_WORDS) -> DataFrame:
    """documents with further columns _n_words, _spans (array of [first, last) word numbers) and _items (sorted
    strings). Columns of documents that have such a name come back as they are if renamed first, see remove_spans()."""
    df = documents.select("*", F.lit(0).cast("long").alias("_n_words"), F.array().cast("array<array<bigint>>").alias("_spans"), F.array().cast("array<string>").alias("_items"))
    schema = df.schema
    for automaton in automata(benchmark, window, max_words):
        shipped = spark.sparkContext.broadcast(automaton)

        def scanned(batches, shipped=shipped):
            automaton = shipped.value
            for batch in batches:
                n_words, all_spans, all_items = [], [], []
                for text, spans, items in zip(batch.column("text").to_pylist(), batch.column("_spans").to_pylist(), batch.column("_items").to_pylist(), strict=True):
                    words = words_of(text)
                    new, found = automaton.scan(words)
                    n_words.append(len(words))
                    all_spans.append(union(spans, new))
                    all_items.append(sorted(found.union(items)))
                own = {"_n_words": pa.array(n_words, pa.int64()), "_spans": pa.array(all_spans, pa.list_(pa.list_(pa.int64()))), "_items": pa.array(all_items, pa.list_(pa.string()))}
                yield pa.RecordBatch.from_arrays([own.get(x, batch.column(x) if x not in own else None) for x in batch.schema.names], names=batch.schema.names)

        df = df.mapInArrow(scanned, schema)
    return df


def union(a: list, b: list) -> list[list[int]]:
    """Spans of either list, merged where they touch or overlap."""
    out: list[list[int]] = []
    for first, last in sorted([*map(tuple, a), *b]):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


def contamination(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_words: int = MAX_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_spans(spark, documents.select("doc_id", "text"), benchmark, window, max_words)
    n_hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda a, x: a + x[1] - x[0])
    return found.select(
        "doc_id", F.col("_n_words").alias("n_words"), n_hit.alias("n_hit"), F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "_items"), 256).alias("items_sha256"), (F.size("_spans") > 0).alias("contaminated"),
    )


def remove_spans(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = 0.5, max_words: int = MAX_WORDS) -> DataFrame:
    """documents without their hit words. A document of which more than max_coverage of the words are hit goes as a
    whole. Others lose the text from a span's first word to its last, nothing else; clean ones stay as they are."""
    names = documents.columns
    held = documents.toDF(*(x if x == "text" else f"c{i}" for i, x in enumerate(names)))
    found = find_spans(spark, held, benchmark, window, max_words)

    def cut(batches):
        for batch in batches:
            texts = [t if not s else without(t, s) for t, s in zip(batch.column("text").to_pylist(), batch.column("_spans").to_pylist(), strict=True)]
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))

    n_hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda a, x: a + x[1] - x[0])
    return found.filter(n_hit <= max_coverage * F.col("_n_words")).mapInArrow(cut, found.schema).drop("_n_words", "_spans", "_items").toDF(*names)


def without(text: str, spans: list) -> str:
    """The text without the words of spans, and what stands between the words of one span."""
    raw, at, out = text.encode("utf-8", "surrogatepass"), 0, []
    marked, places, inside = raw.translate(_WORD), [], False
    for i, b in enumerate(marked):
        if (b != 32) != inside:
            places.append(i)
            inside = not inside
    places += [len(raw)] * (len(places) % 2)
    for first, last in spans:
        out.append(raw[at : places[2 * first]])
        at = places[2 * last - 1]
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")

