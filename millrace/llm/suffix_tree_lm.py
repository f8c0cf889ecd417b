"""Probabilistic suffix tree over words: learning from a corpus, and scoring of whole texts.

The root is the distribution of single tokens, c + 0.5 over N + 0.5 (V + 1); words that are rarer than HEAD share theirs equally. The
contexts of a token are the 1 to ORDER tokens before it in its text. They are held in two parts.

The head has the contexts that make up CONTEXT of all training tokens or more: at most 1/CONTEXT a level, with 1/ENTRY listed
symbols a level and 1/HEAD words. Those bounds hold for any corpus, and only this part goes to the driver and to all executors. Of the
symbols that follow a context, those that with it make up ENTRY or more, and HEAD_LEAST occurrences, are listed and have their count less
DISCOUNT; the rest of the mass goes to all others as the parent (the longest kept suffix) has them. It is kept if the count-weighted
divergence from the parent, with each token's own occurrence left out, exceeds HEAD_GAIN nats.

All other contexts are dealt into buckets, each token by its shortest context that the head hasn't, so a bucket has all tokens of
that context and of the longer ones with the same end, and no context has more than CONTEXT of all tokens. They grow with the corpus:
each context of LEAST training tokens or more, with all symbols that follow it, is retained if the same divergence exceeds GAIN. A
retained one has P(s) = (max(n(s) - DISCOUNT, 0) + DISCOUNT * kinds * parent(s)) / n. A token is scored by its longest retained context.

Work: texts are split into words once, and saved in compressed batches of texts as places in the batch's list of words; these lists give the
vocabulary, and the places become symbols, or hashes of rarer words. All that follows reads numbers: a pass for each level of the head, one that saves what the head tells of each token,
and one for each of _SLICES parts of the buckets, which deals the part's tokens as compressed columns of a batch and bucket; what the buckets change goes
back to the batch's texts. So no more than one part of the tokens is in a shuffle at once. The number of buckets grows with the corpus, a bucket
doesn't. Memory: a batch of _BATCH_WORDS words (or one text), a bucket. Counts of words that the head hasn't are joined by word for the
base score, after a text's equal words are summed. Words of the buckets are 32-bit hashes, contexts 64-bit ones;
what a bucket is told and tells of a token is in units of 1/_UNIT, so a token is exact to some 6e-5 in log10.

Nulls: a null text is empty (the end alone); a null doc_id is training data. Repeated rows are texts of their own. Without
training texts the root is uniform over the one unknown symbol. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass, field, replace
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

ORDER, CONTEXT, ENTRY, HEAD, LEAST, DISCOUNT, GAIN = 4, 5e-5, 1e-6, 4e-7, 2, 0.75, 1.0
HEAD_LEAST, HEAD_GAIN = 4, 10.0
END = b""
_FLUSH_KEYS, _BATCH_WORDS, _BUCKET_WORDS, _UNIT, _SLICES = 1_000_000, 250_000, 1_000_000, 2**14, 6


def words_of(text: str | None) -> list[bytes]:
    """A-Z in lower case, split at ASCII white space, then the end."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    words.append(END)
    return words


@dataclass
class Level:
    """Contexts of one length. context_keys: sorted keys of all candidates; entry_keys: sorted context * size + symbol."""

    context_keys: np.ndarray
    kept: np.ndarray  # by context number
    back: np.ndarray  # log10 of what goes before the parent's probability, by context number
    entry_keys: np.ndarray
    entry_logs: np.ndarray  # log10 of a listed symbol's probability


@dataclass
class Tree:
    """words[i] is symbol i + 1; 0 is every rarer word."""

    n: int  # N
    v: int  # V
    words: list[bytes] = field(default_factory=list)
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    levels: list[Level] = field(default_factory=list)

    @property
    def size(self) -> int:
        return len(self.counts) + 1

    @property
    def total(self) -> float:
        return self.n + 0.5 * (self.v + 1)

    def root_logs(self) -> np.ndarray:
        return np.concatenate(([0.0], np.log10((self.counts + 0.5) / self.total)))

    def symbols(self) -> dict[bytes, int]:
        return dict(zip(self.words, range(1, self.size), strict=True))

    def contexts(self, ids: np.ndarray, depth: int) -> list[np.ndarray]:
        """By depth from 1: for each token the number of the candidate context of so many tokens before it, or -1. ids: texts one after
        another; no context has an end in it, so none reaches into the text before."""
        out: list[np.ndarray] = []
        for d in range(1, depth + 1):
            own = np.full(len(ids), -1, np.int64)
            if d == 1:
                table = np.full(self.size, -1, np.int64)
                table[self.levels[0].context_keys] = np.arange(len(self.levels[0].context_keys))
                own[1:] = table[ids[:-1]]
            else:
                live = np.flatnonzero(out[-1][:-1] >= 0)
                own[live + 1] = find(self.levels[d - 1].context_keys, out[-1][live] * self.size + ids[live])
            out.append(own)
        return out

    def token_logs(self, ids: np.ndarray, root: np.ndarray, contexts: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(log10 probabilities, whether the root's of a rare word is still to be added) of the tokens of texts one after another."""
        logs, open_ = root[ids], ids == 0
        for level, context in zip(self.levels, contexts or self.contexts(ids, len(self.levels)), strict=True):
            live = np.flatnonzero(context >= 0)
            live = live[level.kept[context[live]]]
            if not len(live):
                continue
            at = find(level.entry_keys, context[live] * self.size + ids[live])
            listed = at >= 0
            logs[live[listed]] = level.entry_logs[at[listed]]
            open_[live[listed]] = False
            rest = live[~listed]
            logs[rest] += level.back[context[rest]]
        return logs, open_


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The places of wanted in sorted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


_held: dict = {}


def _made(shipped, make):
    """make(value of a broadcast), done once in each worker."""
    if shipped._path not in _held:
        _held.clear()
        _held[shipped._path] = make(shipped.value)
    return _held[shipped._path]


_DOCS, _WORDS = pa.schema([("doc_id", pa.int64())]), pa.schema([("word", pa.binary()), ("n", pa.int64())])
_TEXT = np.dtype([("n", "<u4"), ("train", "u1")])
_ID = np.dtype([("id", "<u4")])
SPLIT = "batch long, docs binary, texts binary, ids binary, words binary"
ENCODED = "batch long, docs binary, texts binary, ids binary, rare array<struct<row: bigint, word: binary, n: bigint>>"


def _split(documents: DataFrame) -> DataFrame:
    """SPLIT of documents (doc_id, held_out, text): batches of texts. docs: _DOCS; texts: _TEXT of each text; words: _WORDS, the batch's distinct
    words with their number in training texts; ids: of each token, its word's place there."""

    def numbered() -> defaultdict:
        """Gives each new word the next number."""
        places: defaultdict = defaultdict()
        places.default_factory = places.__len__
        return places

    def batch_row(batch, docs, held, texts, places):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ids = np.concatenate(texts)
        train = ~np.array(held, bool)
        n = np.bincount(ids[np.repeat(train, sizes)], minlength=len(places))
        told = _ipc(_DOCS, docs), _pack({"n": sizes.astype("<u4"), "train": train.astype("u1")}), _pack({"id": ids}), _ipc(_WORDS, list(places), n)
        return _table(SPLIT, [(batch, *told)])

    def rows(batches):
        docs, held, texts, n, places, batch = [], [], [], 0, numbered(), TaskContext.get().partitionId() << 24
        for given in batches:
            for doc, h, text in zip(given.column("doc_id"), given.column("held_out"), given.column("text"), strict=True):
                words = words_of(text.as_py())
                docs.append(doc.as_py()), held.append(h.as_py()), texts.append(np.fromiter(map(places.__getitem__, words), "<u4", len(words)))
                n += len(words)
                if n > _BATCH_WORDS or len(texts) == 2**16:
                    yield batch_row(batch, docs, held, texts, places)
                    docs, held, texts, n, places, batch = [], [], [], 0, numbered(), batch + 1
        if texts:
            yield batch_row(batch, docs, held, texts, places)

    return documents.select("doc_id", "held_out", "text").mapInArrow(rows, SPLIT)


def _training(training: DataFrame) -> DataFrame:
    return _split(training.select(F.lit(None).cast("long").alias("doc_id"), F.lit(False).alias("held_out"), "text"))


def word_counts(training: DataFrame) -> DataFrame:
    """(word, n) of all tokens of training (text)."""
    return _word_counts(_training(training))


def _word_counts(split: DataFrame) -> DataFrame:
    """(word, n) of all training tokens."""

    def rows(batches):
        for given in batches:
            for words in given.column("words"):
                yield from _read(words).to_batches()

    return split.select("words").mapInArrow(rows, "word binary, n long").filter("n > 0").groupBy("word").agg(F.sum("n").alias("n"))


def _encoded(spark: SparkSession, split: DataFrame, tree: Tree) -> DataFrame:
    """ENCODED of SPLIT. ids: the tokens' symbols, or from tree.size on hashes of words without one; rare: these words, with
    the text's row and their number there. Of the tree only the words are used."""
    shipped = spark.sparkContext.broadcast(tree)

    def batch_row(size, symbols, batch, docs, texts_, data, words):
        texts, at, words = _unpack(texts_, _TEXT), _unpack(data, _ID)["id"].astype(np.int64), words["word"].combine_chunks()
        found = words.to_numpy(zero_copy_only=False).tolist()
        own = np.fromiter(map(symbols.get, found, repeat(0)), np.int64, len(found))
        rare = np.flatnonzero(own == 0)
        full = own.copy()
        full[rare] = size + np.fromiter(map(xxhash.xxh32_intdigest, map(found.__getitem__, rare.tolist())), np.int64, len(rare)) % (2**32 - size)
        # of each text: its words without a symbol, and how often it has them
        here = np.flatnonzero(own[at] == 0)
        text = np.repeat(np.arange(len(texts["n"])), texts["n"].astype(np.int64))[here]
        pairs, n = np.unique(text * max(1, len(words)) + at[here], return_counts=True)
        text, word = np.divmod(pairs, max(1, len(words)))
        made = _table("batch long, docs binary, texts binary, ids binary", [(batch, docs, texts_, _pack({"id": full[at].astype("<u4")}))])
        rare = pa.StructArray.from_arrays([pa.array((batch << 16) + text, pa.int64()), words.take(pa.array(word, pa.int64())), pa.array(n, pa.int64())], names=["row", "word", "n"])
        return pa.RecordBatch.from_arrays([*made.columns, pa.ListArray.from_arrays(pa.array([0, len(rare)], pa.int32()), rare)], names=[*made.schema.names, "rare"])

    def rows(batches):
        size, symbols = _made(shipped, lambda tree: (tree.size, tree.symbols()))
        for given in batches:
            for batch, docs, texts, ids, words in zip(*(given.column(x) for x in ("batch", "docs", "texts", "ids", "words")), strict=True):
                yield batch_row(size, symbols, batch.as_py(), docs.as_py(), texts.as_py(), ids.as_py(), _read(words))

    return split.mapInArrow(rows, ENCODED)


def _ipc(schema: pa.Schema, *columns) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, schema.types, strict=True)], schema=schema))
    return sink.getvalue().to_pybytes()


def _read(data: pa.BinaryScalar) -> pa.Table:
    return pa.ipc.open_stream(data.as_buffer()).read_all()


def _table(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    """rows of longs, ints and binaries as a batch."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(x, kinds[k]) for x, (_, k) in zip(columns, fields, strict=True)], names=[name for name, _ in fields])


def _symbols_of(full: np.ndarray, size: int) -> np.ndarray:
    return np.where(full < size, full, 0).astype(np.int64)


def _pair_counts(spark: SparkSession, encoded: DataFrame, tree: Tree, depth: int) -> DataFrame:
    """(key, n): candidate contexts of that depth with the symbol that follows, in training texts; words without a symbol are left out."""
    shipped = spark.sparkContext.broadcast(replace(tree, words=[]))

    def rows(batches):
        tree = _made(shipped, lambda tree: tree)
        held, size = [], 0

        def out():
            keys, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.int64),) * 2
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64())], names=["key", "n"])

        for given in batches:
            for texts, data in zip(given.column("texts"), given.column("ids"), strict=True):
                texts, ids = _unpack(texts.as_py(), _TEXT), _symbols_of(_unpack(data.as_py(), _ID)["id"], tree.size)
                context = tree.contexts(ids, depth)[-1]
                live = (context >= 0) & (ids > 0) & np.repeat(texts["train"] > 0, texts["n"].astype(np.int64))
                held.append(context[live] * tree.size + ids[live])
                size += len(held[-1])
                if size > _FLUSH_KEYS:
                    yield out()
                    size = 0
        yield out()

    return encoded.select("texts", "ids").mapInArrow(rows, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _numbers(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(key, n) of a table of bounded size, sorted by key."""
    got = df.toPandas().sort_values("key")
    return got["key"].to_numpy(np.int64), got["n"].to_numpy(np.int64)


def _test(tree: Tree, level: Level, depth: int, totals: np.ndarray, suffixes: list[np.ndarray], counts: np.ndarray, discount: float, gain: float) -> None:
    """Sets kept, back and entry_logs. totals: by context; suffixes[d]: its suffix of d tokens as a context number or -1;
    counts: by entry."""
    context, symbol = level.entry_keys // tree.size, level.entry_keys % tree.size
    parent = tree.root_logs()[symbol]  # of the entries
    for d in range(1, depth):
        up = suffixes[d][context]
        live = (up >= 0) & tree.levels[d - 1].kept[up]
        at = find(tree.levels[d - 1].entry_keys, up * tree.size + symbol)
        parent = np.where(live, np.where(at >= 0, tree.levels[d - 1].entry_logs[at] if len(tree.levels[d - 1].entry_logs) else 0, parent + tree.levels[d - 1].back[up]), parent)
    n = len(totals)
    held = np.bincount(context, counts - discount, n)
    rest = totals + 1 - held  # one more than seen, so that others always have some
    share = np.minimum(np.bincount(context, 10**parent, n), 1 - 1e-9)
    level.back = np.log10(rest / (totals + 1)) - np.log10(1 - share)
    level.entry_logs = np.log10((counts - discount) / (totals[context] + 1))
    own = counts * (np.log10((counts - 1 - discount) / totals[context]) - parent)
    unlisted = totals - np.bincount(context, counts, n)
    level.kept = (np.bincount(context, own, n) + unlisted * level.back) * math.log(10) > gain


def rooted(vocabulary: DataFrame, head: float = HEAD) -> Tree:
    """The tree of a vocabulary = word_counts(training), saved, with no context yet."""
    n, v = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    tree = Tree(n, v)
    if n:
        frequent = vocabulary.filter(F.col("n") >= head * n).toPandas().sort_values(["n", "word"], ascending=[False, True])  # at most 1 / head rows
        tree.words, tree.counts = [bytes(x) for x in frequent["word"]], frequent["n"].to_numpy(np.int64)
    return tree


def learn(spark: SparkSession, training: DataFrame, vocabulary: DataFrame, depth: int = ORDER, context: float = CONTEXT, entry: float = ENTRY, head: float = HEAD, least: int = HEAD_LEAST, discount: float = DISCOUNT, gain: float = HEAD_GAIN) -> Tree:
    """The tree of training (text), with vocabulary = word_counts(training), saved."""
    tree = rooted(vocabulary, head)
    encoded = _encoded(spark, _training(training), tree)
    return grown(spark, encoded, tree, depth, context, entry, head, least, discount, gain)


def grown(spark: SparkSession, encoded: DataFrame, tree: Tree, depth: int = ORDER, context: float = CONTEXT, entry: float = ENTRY, head: float = HEAD, least: int = HEAD_LEAST, discount: float = DISCOUNT, gain: float = HEAD_GAIN) -> Tree:
    """The rooted tree with the levels of its head, learnt from the training texts of encoded."""
    assert entry >= head and context >= head and least >= 2
    n = tree.n
    if not n:
        return tree
    end = tree.symbols().get(END, -1)
    keys = np.flatnonzero(tree.counts >= context * n) + 1
    keys = keys[keys != end]
    totals, suffixes = tree.counts[keys - 1], [np.zeros(0, np.int64)]
    for d in range(1, depth + 1):
        level = Level(keys, np.zeros(len(keys), bool), np.zeros(len(keys)), np.zeros(0, np.int64), np.zeros(0))
        tree.levels.append(level)
        if not len(keys):
            break
        found = _pair_counts(spark, encoded, tree, d).filter(F.col("n") >= max(least, entry * n))  # at most 1 / entry rows
        level.entry_keys, counts = _numbers(found)
        del found
        shared.collect(spark)
        _test(tree, level, d, totals, suffixes, counts, discount, gain)
        longer = (counts >= context * n) & (level.entry_keys % tree.size != end)
        keys, totals = level.entry_keys[longer], counts[longer]
        # the suffix of d tokens of a context of d + 1: its first token dropped
        first, last = keys // tree.size, keys % tree.size
        suffixes = [np.zeros(0, np.int64), *(_suffix(tree, suffixes, first, last, k) for k in range(1, d + 1))]
    return tree


def _suffix(tree: Tree, suffixes: list[np.ndarray], first: np.ndarray, last: np.ndarray, k: int) -> np.ndarray:
    if k == 1:
        return find(tree.levels[0].context_keys, last)
    up = suffixes[k - 1][first]
    return np.where(up >= 0, find(tree.levels[k - 1].context_keys, up * tree.size + last), -1)


SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"
_KINDS = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
_SHIPPED = "batch long, bucket long, kind int, data binary"


def rare_log(tree: Tree) -> float:
    """log10 of the root's probability of a word without a symbol: all of these, and one unknown word, share what the others leave."""
    rest = tree.n - tree.counts.sum() + 0.5 * (tree.v - len(tree.words)) + 0.5
    return float(np.log10(rest / tree.total / (tree.v - len(tree.words) + 1)))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _record(depth: int) -> np.dtype:
    """A token: its symbol, the depth words before it (0: none), its log10 probability by the head (in units of 1/_UNIT), how many of the words the
    head's contexts have, whether it is a training token, and its text's number in the batch."""
    return np.dtype([("sym", "<u4"), *((f"w{d}", "<u4") for d in range(1, depth + 1)), ("p", "<i4"), ("head", "u1"), ("train", "u1"), ("doc", "<u2")])


def _pack(columns: dict[str, np.ndarray]) -> bytes:
    """Columns one after another, each as its first bytes, its second bytes and so on, compressed."""
    n = len(next(iter(columns.values())))
    raw = b"".join(np.ascontiguousarray(x.view(np.uint8).reshape(n, x.itemsize).T).data if n else b"" for x in map(np.ascontiguousarray, columns.values()))
    return n.to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes, kind: np.dtype) -> dict[str, np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    raw, at = pa.decompress(data[8:], n * kind.itemsize, codec="zstd", asbytes=True), 0
    columns = {}
    for x in kind.names:
        size = kind[x].itemsize
        columns[x] = np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).view(kind[x]).ravel()
        at += n * size
    return columns


TOLD = "batch long, docs binary, texts binary, tokens binary"
_TOKEN = np.dtype([("sym", "<u4"), ("p", "<i4"), ("head", "u1"), ("part", "u1")])


def _keys(before: list[np.ndarray], head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of tokens with the words before each, nearest first (0: none): the key of its shortest context that the head hasn't, and whether there is one. All
    longer contexts of a token go by the same key."""
    context, key, live = np.zeros(len(head), np.uint64), np.zeros(len(head), np.uint64), np.zeros(len(head), bool)
    for d, words in enumerate(before, 1):
        context = _mixed(context * np.uint64(0x9E3779B97F4A7C15) + words)
        first = (head == d - 1) & (words > 0)
        np.copyto(key, context, where=first)
        live |= first
    return key, live


def _places(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the tokens of texts of those sizes, one after another: where each text begins; each token's text and its number there."""
    sizes = sizes.astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    return starts, np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - np.repeat(starts, sizes)


def _told(spark: SparkSession, encoded: DataFrame, tree: Tree, order: int, buckets: int) -> DataFrame:
    """TOLD of each batch: what the head tells of its texts (docs: SCORED) and of its tokens (_TOKEN; part: that of its bucket, _SLICES if it has none)."""
    shipped, rare_at = spark.sparkContext.broadcast(replace(tree, words=[])), rare_log(tree)
    schema = pa.schema(list(zip((x.split()[0] for x in SCORED.split(", ")), _KINDS, strict=True)))

    def rows(batches):
        tree, root = _made(shipped, lambda tree: (tree, tree.root_logs()))
        for given in batches:
            for batch, docs, texts_, data in zip(*(given.column(x) for x in ("batch", "docs", "texts", "ids")), strict=True):
                batch, texts, full = batch.as_py(), _unpack(texts_.as_py(), _TEXT), _unpack(data.as_py(), _ID)["id"]
                ids = _symbols_of(full, tree.size)
                contexts = tree.contexts(ids, len(tree.levels))
                logs, open_ = tree.token_logs(ids, root, contexts)
                logs[open_] += rare_at
                starts, _, place = _places(texts["n"])
                known = np.add.reduceat(ids != 0, starts, dtype=np.int64)
                doc_ids = _read(docs)["doc_id"].combine_chunks()
                columns = [(batch << 16) + np.arange(len(starts)), doc_ids, texts["train"] == 0, texts["n"], known, np.add.reduceat(root[ids], starts), np.add.reduceat(logs, starts)]
                head = np.zeros(len(ids), np.uint8)
                for at in contexts:
                    head += at >= 0
                before = [np.zeros(len(ids), np.uint32) for _ in range(order)]
                for d, x in enumerate(before, 1):
                    if d < len(ids):
                        x[d:] = np.where(place[d:] >= d, full[:-d], 0)
                key, live = _keys(before, head)
                part = np.where(live, key % np.uint64(buckets) % np.uint64(_SLICES), _SLICES).astype(np.uint8)
                tokens = {"sym": full, "p": np.rint(logs * _UNIT).astype("<i4"), "head": head, "part": part}
                yield _table(TOLD, [(batch, _ipc(schema, *columns), texts_.as_py(), _pack(tokens))])

    return encoded.select("batch", "docs", "texts", "ids").mapInArrow(rows, TOLD)


def _tokens(told: DataFrame, order: int, buckets: int, part: int) -> DataFrame:
    """_SHIPPED of kind 1: a batch's tokens of one bucket, of that part of the buckets."""
    kind = _record(order)

    def dealt(batch, texts, tokens):
        _, own, place = _places(texts["n"])
        at = np.flatnonzero(tokens["part"] == part)
        place, full = place[at], tokens["sym"]
        before = [np.where(place >= d, full[np.maximum(at - d, 0)], np.uint32(0)) for d in range(1, order + 1)]
        head, sym, own = tokens["head"][at], full[at], own[at]
        bucket = (_keys(before, head)[0] % np.uint64(buckets)).astype(np.int64)
        # within a bucket by the word before and the symbol, so that columns are in runs
        low = np.uint64(2**20 - 1)
        by = np.argsort((bucket.astype(np.uint64) << np.uint64(40)) | ((before[0] & low) << np.uint64(20)) | (sym & low))
        bucket = bucket[by]
        columns = [sym, *before, tokens["p"][at], head, texts["train"][own], own]
        table = {x: y[by].astype(kind[x], copy=False) for x, y in zip(kind.names, columns, strict=True)}
        ends = np.flatnonzero(np.diff(bucket, append=-1)) + 1
        return [(batch, int(bucket[start]), 1, _pack({x: y[start:end] for x, y in table.items()})) for start, end in zip(np.concatenate(([0], ends))[:-1], ends, strict=True)]

    def rows(batches):
        for given in batches:
            for batch, texts, data in zip(*(given.column(x) for x in ("batch", "texts", "tokens")), strict=True):
                yield _table(_SHIPPED, dealt(batch.as_py(), _unpack(texts.as_py(), _TEXT), _unpack(data.as_py(), _TOKEN)))

    return told.select("batch", "texts", "tokens").mapInArrow(rows, _SHIPPED)


def refined(table: dict[str, np.ndarray], order: int, least: int, discount: float, gain: float) -> np.ndarray:
    """The probability of each token of a bucket by its longest retained context. A context is retained if, each training token
    being left out in turn, its own distribution tells them better than its parent's by more than `gain` nats in all."""
    p = 10.0 ** (table["p"] / _UNIT)
    context = np.zeros(len(p), np.uint64)
    for d in range(1, order + 1):
        context = _mixed(context * np.uint64(0x9E3779B97F4A7C15) + table[f"w{d}"])
        live = np.flatnonzero((table["head"] < d) & (table[f"w{d}"] > 0))
        _, own = np.unique(context[live], return_inverse=True)
        total = np.bincount(own, table["train"][live])
        often = total[own] >= least if len(live) else np.zeros(0, bool)
        live, own = live[often], own[often]
        if not len(live):
            continue
        pair = _mixed(context[live] + table["sym"][live] * np.uint64(0xD6E8FEB86659FD93))
        _, back = np.unique(pair, return_inverse=True)
        at = np.zeros(int(back.max()) + 1, np.int64)
        at[back] = np.arange(len(back))  # any token of the pair: all have the same parent
        c, n, up = own[at], np.bincount(back, table["train"][live]), p[live[at]]
        kinds = np.bincount(c, n > 0, len(total))
        k, t = kinds[c], total[c]
        left_out = np.where(n >= 2, n - 1 - discount + discount * k * up, discount * (k - 1) * up) / (t - 1)
        better = np.where(n > 0, n * (np.log(np.where(n > 0, left_out, 1.0)) - np.log(up)), 0.0)
        kept = np.bincount(c, better, len(total)) > gain
        fresh = (np.maximum(n - discount, 0.0) + discount * k * up) / t
        chosen = kept[c][back]
        p[live[chosen]] = fresh[back[chosen]]
    return p


def _scored(spark: SparkSession, scratch: shared.Scratch, encoded: DataFrame, tree: Tree, order: int = ORDER, least: int = LEAST, discount: float = DISCOUNT, gain: float = GAIN) -> DataFrame:
    """SCORED of each text, without what words that have no symbol add to base and n_known. encoded: a saved table under that name: it is dropped once it is read."""
    buckets = max(64, -(-tree.n // _BUCKET_WORDS))  # grows with the corpus, a bucket doesn't
    assert buckets < 2**24
    kind, change = _record(order), np.dtype([("doc", "<u2"), ("by", "<i4")])

    def tail(given: pd.DataFrame) -> pd.DataFrame:
        tables = [_unpack(x, kind) for x in given["data"]]
        table = {x: np.concatenate([own[x] for own in tables]) for x in kind.names}
        by = np.rint(np.log10(refined(table, order, least, discount, gain)) * _UNIT).astype(np.int32) - table["p"]
        out, at = [], 0
        for batch, own in zip(given["batch"], tables, strict=True):
            here = by[at : at + len(own["doc"])]
            at += len(here)
            moved = np.flatnonzero(here)
            if len(moved):
                moved = moved[np.argsort(own["doc"][moved], kind="stable")]
                out.append((batch, 0, 2, _pack({"doc": own["doc"][moved], "by": here[moved]})))
        return pd.DataFrame(out, columns=["batch", "bucket", "kind", "data"])

    def texts(given: pd.DataFrame) -> pd.DataFrame:
        docs = pa.ipc.open_stream(given.loc[given["kind"] == 0, "data"].iloc[0]).read_all().to_pandas()
        more = np.zeros(len(docs))
        for x in given.loc[given["kind"] == 2].sort_values("data")["data"]:  # in one order, so sums are the same in each run
            moved = _unpack(x, change)
            more += np.bincount(moved["doc"], moved["by"] / _UNIT, len(docs))
        docs["score"] += more
        return docs

    told = scratch.save(_told(spark, encoded, tree, order, buckets), "told")
    scratch.drop("encoded")
    found = told.select("batch", F.lit(0).cast("long").alias("bucket"), F.lit(0).alias("kind"), F.col("docs").alias("data"))
    for part in range(_SLICES):
        found = found.unionByName(scratch.save(_tokens(told, order, buckets, part).groupBy("bucket").applyInPandas(tail, _SHIPPED), f"tail{part}"))
    scored = scratch.save(found.groupBy("batch").applyInPandas(texts, SCORED), "scored")
    scratch.drop("told")
    for part in range(_SLICES):
        scratch.drop(f"tail{part}")
    return scored


def held_out():
    """Documents kept from training."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 1, F.lit(False))


def score(spark: SparkSession, documents: DataFrame, order: int = ORDER, least: int = LEAST, gain: float = GAIN, **head) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document, learnt from those that
    aren't held out. head: thresholds of learn()."""
    scratch = shared.Scratch(spark, "suffix-tree")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    split = scratch.save(_split(docs), "split")
    vocabulary = scratch.save(_word_counts(split), "vocabulary")
    tree = rooted(vocabulary, head.get("head", HEAD))
    encoded = scratch.save(_encoded(spark, split, tree), "encoded")
    scratch.drop("split")
    grown(spark, encoded, tree, depth=order, **head)
    log = F.col("r.n") * F.log10((F.coalesce(F.col("c"), F.lit(0)) + 0.5) / F.lit(tree.total))
    rare = encoded.select(F.explode("rare").alias("r"))
    counts = vocabulary.select("word", F.col("n").alias("c"))
    told = rare.join(counts, F.col("r.word") == F.col("word"), "left").groupBy("r.row").agg(F.sum(log).alias("_log"), F.sum(F.when(F.col("c") > 0, F.col("r.n"))).alias("_known"))
    told = scratch.save(told, "rare")
    scratch.drop("vocabulary")
    scored = _scored(spark, scratch, encoded, tree, order, least, gain=gain)
    found = scored.join(told, "row", "left")
    base = F.col("base") + F.coalesce("_log", F.lit(0.0))
    return found.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"), F.lit(tree.n).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
