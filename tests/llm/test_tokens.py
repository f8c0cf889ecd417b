"""Encoding, Simple-8b, packing and token counts against the libraries and exact round trips."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import encoder, packing, shared, simple8b, token_counts, token_ids
from millrace.llm.encoder import ChunkEncoder, tokenizer_path

ODD = ["", "a  b", "<|endoftext|> x", " lead", "trail ", "a\n\nb\t c", "a \n b", "it's don't 'S", "a\x1cb c", "\x00z q", "\x01", "été ́x", "a\r\nb", "  ", "\n", "x" * 3000, "ΣΑΣ Σ", "1234 567 ab12", "end.\nNext, one!", "東京 タワー", "word" * 200 + " " + "word" * 200, " a  b"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunks_equal_whole_texts(name, rows):
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(tokenizer_path(name)), ChunkEncoder(tokenizer_path(name), max_chunks=50)
    texts = [*ODD, *(r[1] or "" for r in rows), *ODD]
    got = {}
    for a, b, ids, bounds in own.encode(texts):
        got |= {i: ids[bounds[i - a] : bounds[i - a + 1]].tolist() for i in range(a, b)}
    assert [got[i] for i in range(len(texts))] == [library.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 2**20), st.integers(0, 2**64 - 1)), max_size=400), st.integers(1, 40))
def test_simple8b_round_trip(values, times):
    v = np.repeat(np.array(values, np.uint64), times)
    words, offsets = simple8b.encode(v)
    assert (simple8b.decode(words, offsets, len(v)) == v).all()
    if len(v) > simple8b.BLOCK:  # a block alone
        last = simple8b.decode(words[offsets[-1] :], offsets[-1:] - offsets[-1], len(v) - (len(offsets) - 1) * simple8b.BLOCK)
        assert (last == v[(len(offsets) - 1) * simple8b.BLOCK :]).all()


def test_simple8b_looks_at_no_wider_selector(monkeypatch):
    looks, over = [], simple8b._over
    monkeypatch.setattr(simple8b, "_over", lambda a, count, levels: looks.append(count) or over(a, count, levels))
    v = np.arange(3000, dtype=np.uint64) % 128
    words, offsets = simple8b.encode(v)
    assert (simple8b.decode(words, offsets, 3000) == v).all() and len(looks) == 7  # widths of 1 to 6 bits, and runs


def test_simple8b_is_small():
    assert len(simple8b.encode(np.zeros(100_000, np.uint64))[0]) <= 100
    assert len(simple8b.encode(np.full(1024, 2**15 - 1, np.uint64) - np.arange(1024, dtype=np.uint64) % 2)[0]) == 256


def expected_ids(name, text, end):
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(tokenizer_path(name)).encode(text or "", add_special_tokens=False).ids, end]


def test_token_ids(spark, documents, rows, empty, tmp_path):
    token_ids.write(documents, str(tmp_path / "ids"), tokenizer_path("byte_bpe_50k.json"), 2)
    got = token_ids.read(spark, str(tmp_path / "ids")).collect()
    want = Counter((r[0], tuple(expected_ids("byte_bpe_50k.json", r[1], 2))) for r in rows)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want
    got.sort(key=lambda r: r["start"])
    at = 0
    for r in got:
        assert r["start"] == at
        at += len(r["ids"])
    assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in got), key=lambda x: (x is not None, x))
    crc = Counter((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_ids.summary(spark, str(tmp_path / "ids")).collect())
    assert crc == Counter((r["doc_id"], r["start"], len(r["ids"]), zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in got)
    token_ids.write(empty, str(tmp_path / "none"), tokenizer_path("byte_bpe_50k.json"), 2)
    assert token_ids.read(spark, str(tmp_path / "none")).count() == 0


def test_packing(spark, documents, rows, empty):
    table = packing.pieces(documents, tokenizer_path("word_bpe_49k.json"), 1, 512)
    got = packing.pack(spark, table, 512, group_size=40).collect()
    want = {r[0]: expected_ids("word_bpe_49k.json", r[1], 1) for r in rows}
    seen = Counter()
    for r in got:
        part = want[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["piece"] * 512 == r["start"] and zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        seen[r["doc_id"]] += r["length"]
    assert seen == Counter({k: len(v) * sum(1 for r in rows if r[0] == k) for k, v in want.items()})
    bins = {}
    for r in sorted(got, key=lambda r: r["offset"]):
        assert r["offset"] == bins.get(r["sequence_id"], 0)
        bins[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(bins.values()) <= 512 and math.ceil(sum(bins.values()) / 512) <= len(bins) <= len(packing.best_fit([r["length"] for r in got], 512)) + 2
    assert packing.pack(spark, packing.pieces(empty, tokenizer_path("word_bpe_49k.json"), 1)).count() == 0


def test_local_search_saves_bins():
    # best fit leaves three bins; a swap of one for one frees the room that two need
    bins = packing.local_search([[5, 3], [4, 4], [2, 2]], 10)
    assert sorted(x for b in bins for x in b) == [2, 2, 3, 4, 4, 5] and len(bins) == 2 and all(sum(b) <= 10 for b in bins)
    assert len(packing.local_search([[6, 3], [6, 3], [2]], 10)) == 3  # 9, 9, 2: nothing fits
    number, offset = packing.pack_lengths([4, 4, 4, 3, 3, 2], 10)
    assert max(number) == 1 and all(o >= 0 for o in offset)
    assert packing.best_fit([], 10) == []


def best_possible(lengths, capacity):
    """The fewest bins, by trying all."""
    lengths, best = sorted(lengths, reverse=True), [len(lengths)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(rooms)
            return
        for r in {r for r in rooms if r >= lengths[k]}:
            at = rooms.index(r)
            place(k + 1, [*rooms[:at], r - lengths[k], *rooms[at + 1 :]])
        place(k + 1, [*rooms, capacity - lengths[k]])

    place(0, [])
    return best[0]


def test_packing_is_near_the_best_possible():
    import random

    r, bins, best, fit = random.Random(2), 0, 0, 0
    for _ in range(120):
        lengths = [r.randrange(15, 60) for _ in range(10)]
        number, offset = packing.pack_lengths(lengths, 100)
        for b in set(number):
            inside = sorted((o, n) for o, n, x in zip(offset, lengths, number, strict=True) if x == b)
            assert inside[0][0] == 0 and all(o + n == p for (o, n), (p, _) in zip(inside, inside[1:], strict=False)) and sum(inside[-1]) <= 100
        bins, best, fit = bins + len(set(number)), best + best_possible(lengths, 100), fit + len(packing.best_fit(lengths, 100))
    assert best <= bins <= fit and bins <= 1.01 * best


def test_packing_search_ends_only_where_nothing_helps():
    """Lengths of a third to a half of the capacity, of which best fit leaves much room."""
    import random

    r = random.Random(1)
    lengths = [r.randrange(1200, 2000) for _ in range(8000)]
    assert max(packing.pack_lengths(lengths)[0]) + 1 <= 3520 < len(packing.best_fit(lengths, 4096))


def test_token_counts_cache(spark, documents, rows, empty, tmp_path):
    import sentencepiece

    path, cache = tokenizer_path("piece_bpe_32k.model"), str(tmp_path / "cache")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    want = Counter((r[0], len((r[1] or "").encode()), len(library.encode(r[1] or ""))) for r in rows)
    first = documents.filter("doc_id < 8")
    token_counts.count(spark, first, path, cache).collect()
    n = spark.read.parquet(cache).count()
    assert n == first.select(shared.whole_text()).distinct().count()
    assert Counter(tuple(r) for r in token_counts.count(spark, documents, path, cache).collect()) == want
    held = spark.read.parquet(cache)
    assert held.count() == held.select("digest").distinct().count() == documents.select(shared.whole_text()).distinct().count()
    assert token_counts.count(spark, empty, path, cache).count() == 0 and spark.read.parquet(cache).count() == held.count()


def test_packing_lets_a_workers_chunks_go():
    import pandas as pd

    path = tokenizer_path("word_bpe_49k.json")
    encoder.encoder(path)
    got = packing._packed(3, pd.DataFrame({"length": [4000, 96, 5], "_group": 3}), 0, 4096)
    assert not encoder._loaded
    assert sorted(zip(got["length"], got["_open"], strict=True)) == [(5, True), (96, False), (4000, False)]


def test_packing_holds_few_chunks(spark):
    """A bound on the chunks that a worker holds, as the pipeline has one, changes no piece."""
    import corpus_pipeline

    from .conftest import prose

    docs = spark.createDataFrame([(i, prose(i, 300)) for i in range(12)], "doc_id long, text string").coalesce(2)
    path = encoder.tokenizer_path("word_bpe_49k.json")
    got, want = (sorted(map(tuple, packing.pieces(docs, path, 1, **more).collect())) for more in ({"max_chunks": 50}, {}))
    assert got == want and corpus_pipeline.CHUNKS < encoder.CHUNKS
    held = encoder.encoder(path, 50)
    for i in range(12):
        list(held.encode([prose(i, 300)]))
    assert held.used <= 50 + 300 and encoder.encoder(path) is not held
    encoder.forget()
