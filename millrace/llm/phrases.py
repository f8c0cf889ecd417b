"""Phrase collocations by level-wise Apriori passes.

The texts are read twice: for the words, and to keep the runs of frequent words as blocks of numbers. Level k goes over the blocks:
a k-gram is emitted only where the (k-1)-grams at its start and at its end are both frequent, is counted as a string, and stays when
it is frequent itself. Every level leaves a small table of frequent grams; the cuts of a candidate are scored from these tables
alone, and a level without frequent grams ends the passes.

What is broadcast for a level is a table of bits, one for the hash of each frequent (k-1)-gram: 32 bits a gram, and at most
2**29 in all (64 MB), however large the corpus is. A gram whose hash only looks frequent costs a row that the exact count then
drops, so no size of the table changes a result.

Memory: a task holds a block of at most `block` words as 32-bit numbers; a long text is cut into blocks between pieces, which
phrases don't cross. A block sends one row for each distinct gram, so a word, passage or copy that is everywhere is a row of
each block. Scores need 1000 * a * n and l * r, which are 38-digit decimals. The best phrases of a language are found in
256 parts first, so the last sort of a language is over 256 * `top` rows at most.

Nulls: a null text has no words, a null lang is `und` (an empty one is its own language). Repeated rows count each. Other
columns are ignored. An empty table, or one without frequent words, gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import shared

LEAST, LONGEST, TOP, WITHIN = 100, 5, 2000, 100
BLOCK, MOST_WORDS, CHUNK = 4_000_000, 1 << 21, 1 << 22
LEAST_BITS, MOST_BITS, BITS_A_GRAM = 16, 29, 32
PARTS = 3  # pairs are most of what is counted, and are counted a part at a time, so that a third of them is on disk

#: Ends of pieces become a byte that no UTF-8 text has, tabs become blanks, A-Z are lowered.
_END = 0xFF
_BYTES = bytes(_END if chr(b) in ".,;:!?" or 10 <= b <= 13 else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_BLOCKS, _COUNTS = "lang string, words binary, ids binary", "lang string, phrase string, c long"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _parts(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, with the end mark between pieces, in parts of about CHUNK bytes that hold whole pieces."""
    text, start, mark = text.translate(_BYTES), 0, bytes([_END])
    while start < len(text):
        end = text.find(mark, start + CHUNK) if start + CHUNK < len(text) else len(text)
        end = len(text) if end < 0 else end
        yield text[start:end].replace(mark, b" " + mark + b" ").split(b" ")
        start = end


class _Block:
    """Words of some texts as numbers, by language. 0 is the end mark, 1 is the empty string between two blanks (left out)."""

    def __init__(self):
        self.words: dict[bytes, int] = defaultdict(count().__next__)
        self.words[bytes([_END])], self.words[b""]
        self.ids: dict[str, list[np.ndarray]] = defaultdict(list)
        self.size = 0

    def add(self, lang: str, words: list[bytes]) -> None:
        ids = np.fromiter(map(self.words.__getitem__, words), np.int32, len(words))
        self.ids[lang] += [ids[ids != 1], np.zeros(1, np.int32)]
        self.size += len(ids)

    def of(self) -> Iterator[tuple[str, np.ndarray]]:
        for lang, ids in self.ids.items():
            yield lang, np.concatenate(ids)


def _blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[_Block]:
    held = _Block()
    joined: dict[str, list[bytes]] = defaultdict(list)  # short texts go through the library together
    chars = 0

    def flush():
        for lang, texts in joined.items():
            for words in _parts(b"\n".join(texts)):
                held.add(lang, words)
        joined.clear()

    for batch in batches:
        langs, texts = batch.column(0), batch.column(1)
        for i in range(batch.num_rows):
            text = texts[i].as_py()
            joined[langs[i].as_py()].append(text)
            chars += len(text)
            if chars >= CHUNK:
                flush()
                chars = 0
                if held.size >= block or len(held.words) >= MOST_WORDS // 2:
                    yield held
                    held = _Block()
    flush()
    yield held


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _mixed(lang: str, parts: list[np.ndarray]) -> np.ndarray:
    """Hashes of grams whose first, second, ... words have these hashes."""
    h = np.full(len(parts[0]), xxhash.xxh3_64_intdigest(lang.encode()), np.uint64)
    for x in parts:
        h = (h ^ x) * _ODD
        h ^= h >> np.uint64(29)
    return h * _ODD


def _distinct(ids: np.ndarray, at: np.ndarray, k: int, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of one occurrence of each distinct k-gram that starts at `at`, and how often it does. Words' numbers are packed
    into 63 bits; where they don't fit, what is packed so far is numbered anew."""
    width = max(1, int(n_words - 1).bit_length())
    key, used = ids[at].astype(np.uint64), width
    for j in range(1, k):
        if used + width > 63:
            found, key = np.unique(key, return_inverse=True)
            key, used = key.astype(np.uint64), max(1, int(len(found) - 1).bit_length())
        key, used = (key << np.uint64(width)) | ids[at + j].astype(np.uint64), used + width
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    return at[first], n


def _rows(lang: str, words: list[np.ndarray], vocabulary: list[bytes], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    strings = pa.array([b"", *vocabulary[1:]], pa.binary()).cast(pa.string())  # the end mark is no string
    for i in range(0, len(counts), 50_000):
        some = slice(i, i + 50_000)
        parts = [strings.take(pa.array(x[some])) for x in words]
        phrase = pc.binary_join_element_wise(*parts, " ") if len(parts) > 1 else parts[0]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(phrase), pa.string()), phrase, pa.array(counts[some].astype(np.int64))], names=["lang", "phrase", "c"])


def _words(block: int):
    """Level 1: counts of words, and of all words in a row with a null phrase."""

    def run(batches):
        for held in _blocks(batches, block):
            vocabulary = list(held.words)
            for lang, ids in held.of():
                n = np.bincount(ids, minlength=len(vocabulary))
                n[:2] = 0
                if n.any():
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([None], pa.string()), pa.array([int(n.sum())], pa.int64())], names=["lang", "phrase", "c"])
                    at = np.flatnonzero(n)
                    yield from _rows(lang, [at], vocabulary, n[at])

    return run


def _holds(table: tuple, h: np.ndarray) -> np.ndarray:
    bits, found = table[1], table[0].value
    slot = h >> np.uint64(64 - bits)
    return (found[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0


def _numbered(block: int, frequent: tuple):
    """Blocks: a language, its words in the table with blanks between them (the end mark first), and the text as their numbers. Other words
    end a run, as the end of a piece does."""

    def run(batches):
        for held in _blocks(batches, block):
            words = list(held.words)
            hashes = _hashes(words)
            for lang, ids in held.of():
                kept = _holds(frequent, _mixed(lang, [hashes]))
                kept[:2] = False
                kept &= np.bincount(ids, minlength=len(words)) > 0
                own = np.where(kept, np.cumsum(kept), 0).astype("<i4")[ids]
                before, after = np.concatenate(([0], own[:-1])), np.concatenate((own[1:], [0]))
                own = own[(own != 0) & ((before != 0) | (after != 0)) | (own == 0) & (before != 0)]  # words alone go, ends of runs stay
                vocabulary = b" ".join([words[0], *(words[i] for i in np.flatnonzero(kept))])
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([vocabulary], pa.binary()), pa.array([own.tobytes()], pa.binary())], names=["lang", "words", "ids"])

    return run


def _grams(k: int, frequent: tuple, part: int, parts: int):
    """Level k: counts of the k-grams whose two (k-1)-grams are in the table, and whose hash is of that part."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                lang, words, ids = batch.column(0)[i].as_py(), batch.column(1)[i].as_py().split(b" "), np.frombuffer(batch.column(2)[i].as_buffer(), "<i4")
                n = len(ids) - k + 2  # places of (k-1)-grams
                if n < 2:
                    continue
                hashes = _hashes(words)
                ok = _holds(frequent, _mixed(lang, [hashes[ids[j : n + j]] for j in range(k - 1)]))
                for j in range(k - 1):
                    ok &= ids[j : n + j] != 0
                at = np.flatnonzero(ok[:-1] & ok[1:])
                if parts > 1:
                    at = at[_mixed(lang, [hashes[ids[at + j]] for j in range(k)]) % np.uint64(parts) == part]
                if len(at):
                    at, c = _distinct(ids, at, k, len(words))
                    yield from _rows(lang, [ids[at + j] for j in range(k)], words, c)

    return run


def _bit_table(spark: SparkSession, grams: DataFrame) -> tuple:
    """The broadcast table of bits of a level's grams. It is gathered by Spark as 64-bit words, so the driver gets no grams."""
    bits = min(MOST_BITS, max(LEAST_BITS, (BITS_A_GRAM * max(1, grams.count()) - 1).bit_length()))

    def slots(batches):
        for batch in batches:
            found = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.append(int(_mixed(lang, [np.array([h], np.uint64) for h in map(xxhash.xxh3_64_intdigest, phrase.encode().split(b" "))])[0]) >> (64 - bits))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["slot"])

    set_ = grams.select("lang", "phrase").mapInArrow(slots, "slot long")
    words = set_.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")).toArrow()
    table = np.zeros((1 << bits) // 64, np.int64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return spark.sparkContext.broadcast(table.astype("<i8").view(np.uint8)), bits


def levels(spark: SparkSession, documents: DataFrame, scratch: shared.Scratch, least: int = LEAST, longest: int = LONGEST, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The frequent grams of all levels (lang, phrase, c, k), and the words of each language (lang, n)."""
    texts = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.encode(shared.whole_text(), "UTF-8").alias("text"))
    summed = lambda df: df.groupBy("lang", "phrase").agg(F.sum("c").alias("c"))
    first = scratch.save(summed(texts.mapInArrow(_words(block), _COUNTS)).filter((F.col("c") >= least) | F.col("phrase").isNull()), "level1")
    totals = first.filter(F.col("phrase").isNull()).select("lang", F.col("c").alias("n"))
    found, blocks = [first.filter(F.col("phrase").isNotNull()).withColumn("k", F.lit(1))], None
    for k in range(2, longest + 1):
        if found[-1].isEmpty():
            break
        frequent = _bit_table(spark, found[-1])
        if blocks is None:
            blocks = scratch.save(texts.mapInArrow(_numbered(block, frequent), _BLOCKS), "blocks")
        for i in range(PARTS if k == 2 else 1):
            some = scratch.save(summed(blocks.mapInArrow(_grams(k, frequent, i, PARTS if k == 2 else 1), _COUNTS)).filter(F.col("c") >= least), f"level{k}.{i}")
            level = some if i == 0 else level.unionByName(some)
        found.append(level.withColumn("k", F.lit(k)))
        frequent[0].destroy()
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out, totals


def scores(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, k, a, l, r, n, score of every candidate, by its lowest cut."""
    of = frequent.select("lang", "phrase", F.col("c").alias("f"))
    cuts = (
        frequent.filter("k >= 2")
        .join(totals, "lang")
        .select("lang", "phrase", "k", F.col("c").alias("a"), "n", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
        .select("*", F.expr("substring_index(phrase, ' ', cut)").alias("head"), F.expr("substring_index(phrase, ' ', cut - k)").alias("rest"))
    )
    cuts = cuts.join(of.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(of.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr("cast(1000 * cast(a as decimal(15, 0)) as decimal(19, 0)) * cast(n as decimal(18, 0)) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))")
    cuts = cuts.withColumn("score", score)
    best = cuts.groupBy("lang", "phrase", "k", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "k", "a", "best.l", "best.r", "n", "best.score")


def maximal(candidates: DataFrame, within: int = WITHIN) -> DataFrame:
    """Candidates that no longer one holds with 100 * f(longer) >= within * a. A longer phrase is never more frequent than what it holds, so
    if any longer one does, one of a word more does as well, and only these are looked at."""
    longer = candidates.filter("k >= 3").select(
        "lang", F.col("a").alias("f"), F.explode(F.expr("array(substring_index(phrase, ' ', k - 1), substring_index(phrase, ' ', 1 - k))")).alias("phrase")
    )
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    return candidates.join(longer, ["lang", "phrase"], "left").filter(F.col("f").isNull() | (100 * F.col("f") < within * F.col("a"))).drop("f")


def best(candidates: DataFrame, top: int = TOP) -> DataFrame:
    """The first of each language by score, a and phrase, with their rank."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(256))
    some = candidates.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(spark: SparkSession, documents: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, within: int = WITHIN, block: int = BLOCK) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language."""
    scratch = shared.Scratch(spark, "phrases")
    frequent, totals = levels(spark, documents, scratch, least, longest, block)
    found = scratch.save(best(maximal(scores(frequent, totals), within), top), "best")
    scratch.keep("best")
    return found
