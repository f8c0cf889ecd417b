"""Best-fit packing with a swap-based local search.

Documents become token ids once; only longer ones than a sequence are cut. The pieces' lengths are then packed in
groups of about `group_size` pieces, dealt by a hash of a row number: best fit in order of decreasing length, then moves of one
document, swaps of one for one and of two for one, each of which makes a fuller bin fuller (the sum of squared fills
grows), from the emptiest bin, until it is empty or no exchange helps. The documents of bins that are not full meet in
the next round, in fewer groups, until one group holds them all.

The search ends where no exchange helps. Rounds end with one group, or when nine tenths of the pieces stay in open bins: then every
group has the same mixture of lengths, and to mix them again wouldn't fill more.

Memory: a group is some `group_size` rows of a few integers, dealt by row, so repeated rows are spread; ids never move.

Nulls: a null text is empty and gives a piece of the end id alone. Repeated documents are packed each. No documents
give no rows. Other columns of documents are ignored.
"""

from __future__ import annotations

import math
import zlib
from bisect import insort
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import encoder, shared

CAPACITY, GROUP_SIZE = 4096, 8_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(documents: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False, max_chunks: int = encoder.CHUNKS) -> DataFrame:
    """The pieces of every document: PIECES, and ids (array of int) if asked for. max_chunks: how many chunks of texts a worker holds, for its memory;
    the ids are the same."""

    def rows(batches):
        tokens, end = encoder.encoder(tokenizer, max_chunks), np.array([end_id], np.uint32)
        for batch in batches:
            own = batch.column("doc_id").to_pylist()
            for a, b, flat, bounds in tokens.encode(batch.column("text").to_pylist()):
                out: list[list] = [[] for _ in range(6)]
                for i in range(a, b):
                    ids = np.append(flat[bounds[i - a] : bounds[i - a + 1]], end).astype("<u4")
                    for k, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start : start + capacity]
                        for x, y in zip(out, (own[i], k, start, len(part), zlib.crc32(part.tobytes()), part.astype(np.int32) if with_ids else None), strict=True):
                            x.append(y)
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                arrays = [pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=False)]
                if with_ids:
                    arrays, names = [*arrays, pa.array(out[5], pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), shared.whole_text().alias("text"))
    return docs.mapInArrow(rows, PIECES + ", ids array<int>" * with_ids)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of positions: each length, in decreasing order, to the fullest bin that still takes it."""
    order = sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True)
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin has room r
    for i in order:
        size = lengths[i]
        fit = rooms >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        by_room[room - size].append(b)
        if len(by_room[room - size]) == 1 and room > size:
            rooms |= 1 << (room - size)
    return bins


class _Open:
    """Bins with room, and an index of what they offer: a bin with room r that holds a length y has y + r for whatever takes
    y's place; with y = 0 that is a move into its room."""

    def __init__(self, bins: list[list[int]], capacity: int):
        self.capacity, self.bins, self.fill = capacity, [sorted(x) for x in bins], [sum(x) for x in bins]
        self.offers: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by y + r: a heap of (-r, bin)
        self.some = 0  # bit s is set if there may be an offer of s
        for b in range(len(bins)):
            self.show(b)

    def show(self, b: int) -> None:
        """Enters what the bin offers now. What it offered before is found out of date when it is met."""
        room = self.capacity - self.fill[b]
        if room and self.bins[b]:
            for y in {0, *self.bins[b]}:
                heappush(self.offers[y + room], (-room, b))
                self.some |= 1 << (y + room)

    def taker(self, size: int, giver: int) -> tuple[int, int, int] | None:
        """(room left, what leaves, bin) of the exchange that leaves least room where `size` goes, something smaller leaving."""
        at = size
        while rest := self.some >> at:
            at += (rest & -rest).bit_length() - 1
            heap = self.offers[at]
            while heap:
                room, b = -heap[0][0], heap[0][1]
                if b != giver and self.fill[b] == self.capacity - room and (room == at or at - room in self.bins[b]):
                    break
                heappop(heap)  # out of date, or the giver's, which is entered again
            else:
                self.some ^= 1 << at
                continue
            if room > at - size:
                return at - size, at - room, b
            at += 1
        return None

    def give(self, a: int) -> int:
        """The best exchange of bin a with another: one length moves, or one or two for a smaller one. Returns the gain, 0 if there is none."""
        own = self.bins[a]
        sizes = {x: (x,) for x in own} | {x + y: (x, y) for i, x in enumerate(own) for y in own[:i] if x + y <= self.capacity and x + y not in own}
        found = [(y - x, left, x, y, b) for x in sizes if (t := self.taker(x, a)) for left, y, b in (t,) if self.fill[b] + x - y > self.fill[a]]
        gain = 0
        if found:
            less, _, x, y, b = min(found)
            gain = -less
            for z in sizes[x]:
                own.remove(z)
                insort(self.bins[b], z)
            if y:
                self.bins[b].remove(y)
                insort(own, y)
            self.fill[a] -= gain
            self.fill[b] += gain
            self.show(b)
        self.show(a)
        return gain


def local_search(bins: list[list[int]], capacity: int, least_gain: float = 1e-3) -> list[list[int]]:
    """Bins as sorted lists of lengths, in fewer bins if exchanges can empty some. The emptiest bin gives until it is empty or no
    exchange makes a fuller bin fuller; passes over all bins follow until one raises the sum of squared fills by no more than
    that share, which ends them: the sum only grows."""
    held = _Open(bins, capacity)
    least = math.ceil(sum(held.fill) / capacity)
    live = [b for b in range(len(bins)) if held.bins[b]]
    squares = sum(x * x for x in held.fill)
    while len(live) > least:
        for a in sorted((b for b in live if held.fill[b] < capacity), key=held.fill.__getitem__):
            while held.bins[a] and held.give(a):
                pass
        live = [b for b in live if held.bins[b]]
        before, squares = squares, sum(x * x for x in held.fill)
        if squares - before <= least_gain * before:
            break
    return [held.bins[b] for b in live]


def pack_lengths(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[int], list[int]]:
    """(bin, offset) of each length."""
    bins = best_fit(lengths, capacity)
    short = [x for x in bins if sum(lengths[i] for i in x) < capacity]
    if len(short) > 1:
        kept = [x for x in bins if sum(lengths[i] for i in x) == capacity]
        by_length: dict[int, list[int]] = {}
        for i in (i for x in short for i in x):
            by_length.setdefault(lengths[i], []).append(i)
        found = local_search([[lengths[i] for i in x] for x in short], capacity)
        bins = kept + [[by_length[n].pop() for n in x] for x in found]
    number, offset = [0] * len(lengths), [0] * len(lengths)
    for b, x in enumerate(bins):
        at = 0
        for i in x:
            number[i], offset[i] = b, at
            at += lengths[i]
    return number, offset


def _packed(group: int, rows: pd.DataFrame, round_: int, capacity: int) -> pd.DataFrame:
    """A group's rows with their places. Its worker lets the chunks of the texts go, as lengths need none: a reused worker would hold them, next
    to a full heap, until long after the last step."""
    encoder.forget()
    number, offset = pack_lengths(rows["length"].tolist(), capacity)
    number = np.array(number, np.int64)
    fill = np.bincount(number, rows["length"].to_numpy(), minlength=int(number.max(initial=-1)) + 1)
    return rows.drop(columns="_group").assign(sequence_id=number + (group << 28) + (round_ << 57), offset=offset, _open=fill[number] < capacity)


def pack(spark: SparkSession, table: DataFrame, capacity: int = CAPACITY, group_size: int = GROUP_SIZE) -> DataFrame:
    """The rows of a table with a column length (1 to capacity), with sequence_id and offset as further columns."""
    scratch, done = shared.Scratch(spark, "packing"), []
    schema = f"{', '.join(f'`{x.name}` {x.dataType.simpleString()}' for x in table.schema)}, sequence_id long, offset long, _open boolean, _deal long"
    left = scratch.save(table.withColumn("_deal", F.xxhash64(F.monotonically_increasing_id())), "pieces")
    round_, n = 0, left.count()
    names = [*table.columns, "sequence_id", "offset", "_open", "_deal"]
    while n:
        groups = max(1, math.ceil(n / group_size))

        def packed(key, rows):
            return _packed(int(key[0]), rows, round_, capacity)[names]

        grouped = left.withColumn("_group", F.pmod("_deal", F.lit(groups))).groupBy("_group")
        found = scratch.save(grouped.applyInPandas(packed, schema), f"round{round_}")
        if groups == 1:
            done.append(found)
            break
        done.append(found.filter(~F.col("_open")))
        left = found.filter("_open").select(*table.columns, "_deal")
        n, before = left.count(), n
        if n > before * 0.9:  # lengths that leave room everywhere: no further round would fill it
            done.append(found.filter("_open"))
            break
        round_ += 1
    if not done:
        return table.limit(0).selectExpr("*", "0L AS sequence_id", "0L AS offset")
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out.drop("_open", "_deal")
