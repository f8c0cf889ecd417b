"""Simple-8b: word-aligned coding of unsigned integers, vectorised in numpy.

A 64-bit word has a selector in its top 4 bits. Selectors 0 to 13 hold COUNTS[s] values of WIDTHS[s] bits, the first
value lowest; the last word of a block may hold fewer, the block's length tells. Selector 14 is an escape: one value
of more than 60 bits stands in the next word. Selector 15 is a run: the low 32 bits are a value, the 28 above them
how often it repeats. Every block of BLOCK values starts in a word of its own, and its word offset is kept, so that
blocks are decoded side by side, or alone.
"""

from __future__ import annotations

import numpy as np

COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
RAW, RUN = 14, 15
BLOCK = 1024
_TOP = np.uint64(60)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bit lengths, exact for all 64 bits."""
    if not len(values) or values.max() < 1 << 32:
        return np.frexp(values.astype(np.float64))[1].astype(np.uint8)
    high = (values >> np.uint64(32)).astype(np.float64)
    low = (values & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, np.frexp(high)[1] + 32, np.frexp(low)[1]).astype(np.uint8)


def _over(a: np.ndarray, count: int, levels: list[np.ndarray]) -> np.ndarray:
    """The maximum of a[i .. i+count-1] for all i, from two overlapping windows of a power of two."""
    k = count.bit_length() - 1
    return np.maximum(levels[k][: len(a)], levels[k][count - (1 << k) : len(a) + count - (1 << k)])


def _levels(a: np.ndarray) -> list[np.ndarray]:
    levels = [np.concatenate((a, np.zeros(64, np.uint8)))]
    for k in range(5):
        levels.append(np.maximum(levels[-1], np.concatenate((levels[-1][1 << k :], np.zeros(1 << k, np.uint8)))))
    return levels


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, the word offset of each block). A run needs more than 60 equal values of at most 32 bits."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # blocks side by side with zeros between, so that no word looks into the next block
    blocks, wide = -(-n // BLOCK), BLOCK + 64
    laid = np.zeros((blocks, wide), np.uint64)
    laid[: n // BLOCK, :BLOCK] = values[: n // BLOCK * BLOCK].reshape(-1, BLOCK)
    laid[-1, : n - (blocks - 1) * BLOCK] = values[(blocks - 1) * BLOCK :]
    laid = laid.ravel()
    begin = np.arange(blocks, dtype=np.int64) * wide
    stop = begin + np.minimum(BLOCK, n - np.arange(blocks) * BLOCK)
    bits = _bits(laid)
    levels = _levels(bits)
    widest = np.searchsorted(WIDTHS, bits.max())  # selectors from here on hold any of the values, the first of them the most
    selector = np.full(len(laid), widest if widest < len(COUNTS) else RAW, np.uint8)
    for s in range(widest - 1, -1, -1):
        np.copyto(selector, np.uint8(s), where=_over(bits, COUNTS[s], levels) <= WIDTHS[s])
    take = np.array([*COUNTS, 1, 0], np.int64)[selector]
    changes = (laid != np.append(laid[1:], ~laid[-1])).astype(np.uint8)
    long = np.flatnonzero((_over(changes, 60, _levels(changes)) == 0) & (laid < np.uint64(1 << 32)) & (np.arange(len(laid)) % wide < BLOCK))
    if len(long):
        change = np.flatnonzero(changes) + 1
        run = np.minimum(change[np.searchsorted(change, long, side="right")], stop[long // wide]) - long
        long, run = long[run > 60], run[run > 60]
        selector[long], take[long] = RUN, run
    # follow the words of all blocks at once
    heads, at = np.zeros(len(laid), bool), begin.copy()
    while (at < stop).any():
        for _ in range(16):  # a block that has ended stays at its end, which is no head
            heads[at] = True
            at += take[at]
            np.minimum(at, stop, out=at)
    heads[stop] = False
    at = np.flatnonzero(heads)
    chosen = selector[at]
    size = np.where(chosen == RAW, 2, 1)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    words[place] = chosen.astype(np.uint64) << _TOP
    for s in range(len(COUNTS)):
        own = np.flatnonzero(chosen == s)
        if len(own):
            word = laid[at[own]]
            for j in range(1, COUNTS[s]):
                word |= laid[at[own] + j] << np.uint64(j * WIDTHS[s])
            words[place[own]] |= word
    own = np.flatnonzero(chosen == RAW)
    words[place[own] + 1] = laid[at[own]]
    own = np.flatnonzero(chosen == RUN)
    words[place[own]] |= laid[at[own]] | take[at[own]].astype(np.uint64) << np.uint64(32)
    return words, place[np.searchsorted(at, begin)]


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The n values, from the words and the word offset of each block."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    selector = (words >> _TOP).astype(np.uint8)
    head = np.ones(len(words), bool)
    for i in np.flatnonzero(selector == RAW):  # the value after a raw head is no head, whatever its top bits are
        if head[i]:
            head[i + 1] = False
    counts = np.zeros(16, np.int64)
    counts[: len(COUNTS)], counts[RAW] = COUNTS, 1
    at = np.flatnonzero(head)
    chosen = selector[at]
    taken = counts[chosen]
    run = chosen == RUN
    taken[run] = (words[at[run]] >> np.uint64(32) & np.uint64((1 << 28) - 1)).astype(np.int64)
    # each block starts where its number says, so a short last word needs no mark
    first = np.searchsorted(at, offsets)
    ends = np.cumsum(taken)
    before = ends - taken
    block = np.searchsorted(first, np.arange(len(at)), side="right") - 1
    start = before - before[first[block]] + block * BLOCK
    limit = np.minimum((block + 1) * BLOCK, n)
    for s in range(len(COUNTS)):
        own = np.flatnonzero(chosen == s)
        mask = np.uint64((1 << WIDTHS[s]) - 1)
        for j in range(COUNTS[s]):
            live = own[start[own] + j < limit[own]]
            out[start[live] + j] = words[at[live]] >> np.uint64(j * WIDTHS[s]) & mask
    own = np.flatnonzero(chosen == RAW)
    out[start[own]] = words[at[own] + 1]
    own = np.flatnonzero(run)
    size = taken[own]
    out[np.repeat(start[own] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))] = np.repeat(words[at[own]] & np.uint64(0xFFFFFFFF), size)
    return out
