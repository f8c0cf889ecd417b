"""MinHash near-duplicates by a multi-index Hamming join.

A document's set is that of its 5-word shingles. Its signature has VALUES minimum hashes, of which 16 bits are kept,
four to a chunk. Each chunk is entered in the index four times, each time without one of its values, so two signatures meet
if they differ in at most one value in some chunk. At a resemblance of 0.75 a chunk fails with a probability of 0.262, and all
twelve once in ten million pairs; the distance (number of differing values) is more than DISTANCE once in a hundred million,
and both are rarer above 0.75. Before a pair leaves the join it must also pass an odd sketch, ODD_BITS bits of which each shingle flips one:
the bits in which two sketches differ are never more than the shingles in which the sets differ, so no pair at the
threshold is refused, and few others pass. Candidates are confirmed on the full sets (64-bit hashes of all shingles), and
components follow.

Equal sets are one node before anything meets, so a group of exact copies is one row of the index however large it is;
large groups of near copies are handled by `linking`. Memory: one Arrow batch of texts, or one document's shingles.
The shingle arrays of candidates alone are stored. Node ids and shingles are 64-bit hashes.

Nulls: a null or wordless text has an empty set and is linked with nothing; a null doc_id counts as larger than all in
choosing a component's id. Rows are told apart by doc_id and text, so an id with two texts is two documents; repeated rows are
copies. Other columns pass through keep(), whatever their names. No documents give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import linking, shared

WORDS, VALUES, DISTANCE = 5, 48, 30
CHUNKS = VALUES // 4
ODD_BITS = 1024
_RANDOM = np.random.default_rng(20240501)
_A = _RANDOM.integers(1, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 2**63, VALUES, dtype=np.uint64)
_POWERS = [pow(0x9E3779B97F4A7C15, k, 2**64) for k in range(WORDS)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None, size: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(words) < size:
        whole = np.uint64(0)
        with np.errstate(over="ignore"):
            for x, p in zip(h, _POWERS, strict=False):
                whole += x * np.uint64(p)
        return _mixed(np.array([whole + np.uint64(len(words))], np.uint64))
    n = len(h) - size + 1
    s = h[:n] * np.uint64(_POWERS[0])
    for k in range(1, size):
        s += h[k : n + k] * np.uint64(_POWERS[k])
    return np.unique(_mixed(s))


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """CHUNKS 64-bit integers for each set, of four 16-bit values each; zeros for empty sets."""
    out = np.zeros((len(sets), VALUES), np.uint16)
    full = [i for i, x in enumerate(sets) if len(x)]
    if full:
        flat = np.concatenate([sets[i] for i in full])
        starts = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
        for k in range(VALUES):
            least = np.minimum.reduceat(_mixed(flat * _A[k] + _B[k]), starts)
            out[full, k] = (least * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype(np.uint16)
    return np.ascontiguousarray(out).view(np.int64)


def _odd_sketches(sets: list[np.ndarray]) -> np.ndarray:
    """ODD_BITS / 64 integers for each set."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    bit = (np.concatenate([np.zeros(0, np.uint64), *sets]) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(54)).astype(np.int64)
    flips = np.bincount(np.repeat(np.arange(len(sets)), sizes) * ODD_BITS + bit, minlength=len(sets) * ODD_BITS)
    return np.packbits((flips & 1).astype(np.uint8)).view(np.int64).reshape(len(sets), -1)


def _longs(rows: np.ndarray) -> pa.Array:
    """A list of longs for each row of a matrix."""
    n, k = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), pa.array(np.ascontiguousarray(rows).ravel(), pa.int64()))


def sets_table(documents: DataFrame, size: int = WORDS) -> DataFrame:
    """doc_id, hash (of the text), n_shingles, node (hash of the set, null if empty), s (the signature's chunks), o (the odd
    sketch)."""

    def rows(batches):
        for batch in batches:
            texts, at = batch.column("text"), 0
            while at < len(texts):
                sets, total, first = [], 0, at
                while at < len(texts) and total < 500_000:
                    sets.append(shingles(texts[at].as_py(), size))
                    total += len(sets[-1])
                    at += 1
                node = [int.from_bytes(hashlib.blake2b(x.tobytes(), digest_size=8).digest(), "little", signed=True) if len(x) else None for x in sets]
                given = [batch.column(x).slice(first, at - first) for x in ("doc_id", "hash")]
                arrays = [*given, pa.array([len(x) for x in sets], pa.int64()), pa.array(node, pa.int64()), _longs(_signatures(sets)), _longs(_odd_sketches(sets))]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "hash", "n_shingles", "node", "s", "o"])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), _row_hash().alias("hash"), "text")
    return docs.mapInArrow(rows, "doc_id long, hash long, n_shingles long, node long, s array<long>, o array<long>")


def _row_hash() -> Column:
    return F.xxhash64("text")


def _arrays(documents: DataFrame, size: int) -> DataFrame:
    def rows(batches):
        for batch in batches:
            texts = batch.column("text")
            for at in range(0, len(texts), 256):
                sets = [shingles(x, size) for x in texts.slice(at, 256).to_pylist()]
                node = [int.from_bytes(hashlib.blake2b(x.tobytes(), digest_size=8).digest(), "little", signed=True) for x in sets]
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))], names=["node", "items"])

    return documents.select("text").mapInArrow(rows, "node long, items array<long>")


def index_keys(nodes: DataFrame) -> DataFrame:
    """(node, keys): each chunk without each of its four values."""
    keys = F.array(*(_key(F.lit(4 * c + e), F.get("s", F.lit(c)), _WITHOUT[e]) for c in range(CHUNKS) for e in range(4)))
    return nodes.select("node", keys.alias("keys"))


#: Masks of a chunk without its value e, as signed longs.
_WITHOUT = [m - (1 << 64) if m >> 63 else m for m in (~(0xFFFF << (16 * e)) & 0xFFFFFFFFFFFFFFFF for e in range(4))]


def _key(number: Column, chunk: Column, mask: int) -> Column:
    return F.xxhash64(number, chunk.bitwiseAND(F.lit(mask).cast("long")))


def earliest(key: Column, a: Column, b: Column) -> Column:
    """Whether key is that of the first chunk in which two signatures differ in one value at most, without the value that differs (the
    first one if none does)."""
    differing = lambda c: F.get(a, c).bitwiseXOR(F.get(b, c))
    first = F.filter(F.sequence(F.lit(0), F.lit(CHUNKS - 1)), lambda c: F.bit_count(_values(differing(c))) <= 1)

    def told(c: Column) -> Column:
        only = lambda e: differing(c).bitwiseAND(F.lit(_WITHOUT[e]).cast("long")) == 0
        of = lambda e: _key(4 * c + e, F.get(a, c), _WITHOUT[e])
        return key == F.when(only(0), of(0)).when(only(1), of(1)).when(only(2), of(2)).otherwise(of(3))

    return F.coalesce(F.get(F.transform(F.slice(first, 1, 1), told), F.lit(0)), F.lit(False))


def _bits(a: Column, b: Column, of: Callable[[Column], Column]) -> Column:
    """The sum of set bits of of(x XOR y) over two arrays of longs."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(of(x.bitwiseXOR(y)))), F.lit(0), lambda n, x: n + x)


def _values(x: Column) -> Column:
    """A bit for each 16-bit value that isn't zero, by the carry out of it."""
    every, one = F.lit(0x0000FFFF0000FFFF).cast("long"), F.lit(0x0000000100000001).cast("long")
    carry = lambda v: F.shiftrightunsigned(v.bitwiseAND(every) + every, 16).bitwiseAND(one)
    return carry(x).bitwiseOR(F.shiftleft(carry(F.shiftrightunsigned(x, 16)), 1))


def distance(a: Column, b: Column) -> Column:
    """The number of differing 16-bit values of two signatures."""
    return _bits(a, b, _values)


def _decided(spark: SparkSession, documents: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, hash, n_shingles, linkable, component_id, kept, and wins: whether the row is the one of its group that keep() keeps."""
    scratch = shared.Scratch(spark, "near-dedup")
    sets = scratch.save(sets_table(documents, size), "sets")
    nodes = sets.filter("node IS NOT NULL").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "hash")).alias("first"), F.first("n_shingles").alias("n"), F.first("s").alias("s"), F.first("o").alias("o"))
    nodes = scratch.save(nodes, "nodes")
    keyed = scratch.save(index_keys(nodes), "keyed")

    def near(a: str, b: str) -> Column:
        least, most = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
        odd = _bits(F.col(f"{a}.o"), F.col(f"{b}.o"), lambda x: x)
        # 100 * both >= percent * all, with both + all = the sizes' sum and all - both >= odd
        differ = (100 + percent) * odd <= (100 - percent) * (least + most)
        return (100 * least >= percent * most) & differ & (distance(F.col(f"{a}.s"), F.col(f"{b}.s")) <= DISTANCE)

    def verify(pairs: DataFrame, name: str) -> DataFrame:
        involved = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = nodes.join(involved, "node", "left_semi").select(F.col("first.doc_id").alias("_doc"), F.col("first.hash").alias("_hash"))
        asked = linking.small(scratch.save(wanted, f"{name}-wanted"))
        held = documents.select("doc_id", "text", _row_hash().alias("hash"))
        texts = held.join(asked, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("hash") == F.col("_hash")), "left_semi")
        arrays = scratch.save(_arrays(texts, size).dropDuplicates(["node"]), f"{name}-arrays")
        a, b = arrays.select(F.col("node").alias("a"), F.col("items").alias("x")), arrays.select(F.col("node").alias("b"), F.col("items").alias("y"))
        both = F.size(F.array_intersect("x", "y")).cast("long")
        return pairs.join(a, "a").join(b, "b").filter(100 * both >= percent * (F.size("x") + F.size("y") - both)).select("a", "b")

    comp = linking.link(scratch, keyed, nodes.select("node", "n", "s", "o"), near, verify, earliest=lambda key, a, b: earliest(F.col(key), F.col(f"{a}.s"), F.col(f"{b}.s")))
    least = nodes.select("node", "first").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    ids = least.groupBy("comp").agg(F.min("first").alias("winner"))
    named = scratch.save(least.join(ids, "comp").select("node", "winner"), "named")
    found = sets.select("doc_id", "hash", "n_shingles", "node").join(named, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("winner.doc_id"))
    alone = F.col("node").isNull() | (F.col("doc_id").eqNullSafe(own) & F.col("hash").eqNullSafe(F.col("winner.hash")))
    out = found.select("doc_id", "hash", "n_shingles", F.col("node").isNotNull().alias("linkable"), own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"), alone.alias("wins"))
    out = scratch.save(out, "groups")
    scratch.keep("groups")
    return out


def groups(spark: SparkSession, documents: DataFrame, size: int = WORDS, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document; links at 100 * intersection >= percent * union."""
    return _decided(spark, documents, size, percent).select("doc_id", "n_shingles", "component_id", "kept")


def keep(spark: SparkSession, documents: DataFrame, size: int = WORDS, percent: int = 75) -> DataFrame:
    """One row of each group: that of the smallest doc_id, of rows with equal ids that of the smallest hash of its text, and of
    rows with equal ids and texts any one. Rows without words all stay."""
    decided = _decided(spark, documents, size, percent)
    key = ("_doc", "_hash")
    of = lambda df: df.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_doc"), F.coalesce("hash", F.lit(0).cast("long")).alias("_hash"))
    names = documents.columns
    held = documents.toDF(*(f"c{i}" for i in range(len(names)))).withColumns({"_doc": F.coalesce(F.col(f"c{names.index('doc_id')}").cast("string"), F.lit("")), "_hash": F.coalesce(F.xxhash64(f"c{names.index('text')}"), F.lit(0).cast("long"))})
    gone = linking.small(of(decided.filter("NOT wins")).distinct())
    stay = held.join(gone, [*key], "left_anti")
    repeated = of(decided.filter("wins AND linkable")).groupBy(*key).count().filter("count > 1").select(*key)
    if not repeated.isEmpty():  # rows equal in id and text: one of them
        many = stay.join(repeated, [*key], "left_semi").withColumn("_k", F.row_number().over(Window.partitionBy(*key).orderBy("_hash"))).filter("_k = 1").drop("_k")
        stay = stay.join(repeated, [*key], "left_anti").unionByName(many)
    return stay.drop(*key).toDF(*names)
