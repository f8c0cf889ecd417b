"""Token ids of whole texts from the tokenizers library, one library call for each distinct chunk.

Both vocabularies split a text before any merge, and never across the step from a character that is no white
space to a space or a line end. So a text's ids are those of its chunks in turn, and a worker keeps the ids of
the chunks it has met. A text with an added token's string goes to the library whole."""

from __future__ import annotations

import contextlib
import ctypes
import json
import os
import re
import unicodedata
from itertools import repeat

import numpy as np
import pyarrow as pa

_BATCH_CHARS = 2_000_000
_RUN = 256
CHUNKS = 1_000_000
_loaded: dict[tuple[str, int], ChunkEncoder] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str, max_chunks: int = CHUNKS) -> ChunkEncoder:
    """One encoder for each Python worker, file and bound."""
    if (path, max_chunks) not in _loaded:
        _loaded[path, max_chunks] = ChunkEncoder(path, max_chunks)
    return _loaded[path, max_chunks]


def forget() -> None:
    """Lets this worker's encoders and their chunks go, and gives what is free to the system."""
    _loaded.clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries than glibc have no such call
        ctypes.CDLL(None).malloc_trim(0)


class ChunkEncoder:
    """max_chunks bounds the memory for chunks; when it is full, the worker starts anew."""

    _MARKS = re.compile("[\x00\x01\x1c-\x1f]")
    _CHUNKS = re.compile(r"\s*\S+|\s+")

    def __init__(self, path: str, max_chunks: int = CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library, self.max_chunks = Tokenizer.from_file(path), max_chunks
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.lower = False
        self.added = [x["content"] for x in spec.get("added_tokens") or []]
        before, normal = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        parts = before.get("pretokenizers") or []
        if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not normal:
            self.kind = "spaced"  # a blank belongs to the word that follows
        elif parts and parts[0].get("type") == "Split" and parts[0].get("behavior") == "Removed" and parts[0].get("invert"):
            self.kind = "words"  # white space is dropped
            self.lower = any(x.get("type") == "Lowercase" for x in (normal or {}).get("normalizers") or [normal or {}])
        else:
            self.kind = "whole"
        vocabulary = self.library.get_vocab()
        self.widths = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)  # bytes of each token
        for token, i in vocabulary.items():
            self.widths[i] = len(token.removesuffix("</w>"))
        self._clear()

    def _clear(self) -> None:
        self.slots: dict[str, int] = {"": 0} if self.kind == "words" else {}
        self.used, self.filled = len(self.slots), 0
        self.starts, self.lengths = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.flat = np.zeros(1 << 18, np.uint32)

    def _keys(self, text: str) -> list[str]:
        """\\x01: the text goes to the library whole. \\x00: the chunk stands as it is; else a blank goes before it."""
        if self.kind == "whole" or any(x in text for x in self.added):
            return ["\x01" + text]
        words = text.split()
        plain = " ".join(words) == text.replace("\n", " ")  # single blanks and line ends only
        if not plain and self._MARKS.search(text) or words and ("\x00" in text or "\x01" in text):
            return ["\x01" + text]
        if self.kind == "words":
            return text.lower().split() if self.lower and text.isascii() else words
        if not plain:
            return ["\x00" + x for x in self._CHUNKS.findall(text)]
        if not words:
            return []
        keys = text.replace("\n", " \n").split(" ")
        keys[0] = "\x00" + keys[0]
        return keys

    def _text(self, key: str) -> str:
        if key[:1] in ("\x00", "\x01"):
            return key[1:]
        return key if self.kind == "words" or key[:1] == "\n" else " " + key

    def _learn(self, keys: list[str]) -> None:
        keys, flat, sizes = self._library(keys)
        while self.used + len(keys) > len(self.starts):
            self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
        while self.filled + len(flat) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        span = slice(self.used, self.used + len(keys))
        self.lengths[span] = sizes
        self.starts[span] = self.filled + np.cumsum(sizes) - sizes
        self.flat[self.filled : self.filled + len(flat)] = flat
        self.slots.update(zip(keys, range(self.used, self.used + len(keys)), strict=True))
        self.used, self.filled = self.used + len(keys), self.filled + len(flat)

    def _library(self, keys: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The keys in a new order, the ids of their chunks in turn, and how many each has. Chunks that may stand side by side are encoded in
        runs, since a call for each costs as much as the merges; the bytes of their tokens tell where each ends."""
        texts = list(map(self._text, keys))
        widths = list(map(self._joinable, keys, texts))
        side = [i for i, x in enumerate(widths) if x]
        runs = [side[i : i + _RUN] for i in range(0, len(side), _RUN)]
        alone = [i for i, x in enumerate(widths) if not x]
        blank = " " if self.kind == "words" else ""
        order, flat, sizes = [], [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        found = self.library.encode_batch_fast([blank.join([texts[i] for i in run]) for run in runs], add_special_tokens=False) if runs else []
        for run, x in zip(runs, found, strict=True):
            ids = np.array(x.ids, np.uint32)
            ends = np.cumsum(self.widths[ids])
            last = np.cumsum([widths[i] for i in run])
            at = np.searchsorted(ends, last) + 1
            if len(ids) and at[-1] == len(ids) and (ends[at - 1] == last).all():
                order += run
                flat.append(ids)
                sizes.append(np.diff(at, prepend=0))
            else:
                alone += run
        for i, x in zip(alone, self.library.encode_batch_fast([texts[i] for i in alone], add_special_tokens=False) if alone else [], strict=True):
            order.append(i)
            flat.append(np.array(x.ids, np.uint32))
            sizes.append(np.array([len(flat[-1])], np.int64))
        return [keys[i] for i in order], np.concatenate(flat), np.concatenate(sizes)

    def _joinable(self, key: str, text: str) -> int:
        """The bytes of the chunk's tokens if others may stand before and after it, else 0."""
        if not text or key[:1] == "\x01" or self.kind == "whole" or text[-1].isspace():
            return 0
        if self.kind == "words":
            return len(text) if text.isascii() else len(unicodedata.normalize("NFC", text).lower().encode())
        return (len(text) if text.isascii() else len(text.encode())) if text[0] in " \n" else 0

    def encode(self, texts: list[str]):
        """Yields (first, last, ids, bounds) for runs of texts: ids of texts first..last-1, text i's between
        bounds[i - first] and bounds[i - first + 1]."""
        first = 0
        while first < len(texts):
            last, size, keys, counts = first, 0, [], []
            while last < len(texts) and (last == first or size + len(texts[last]) <= _BATCH_CHARS):
                own = self._keys(texts[last])
                keys += own
                counts.append(len(own))
                size += len(texts[last])
                last += 1
            yield (first, last, *self._encode(keys, counts))
            first = last

    def _encode(self, keys: list[str], counts: list[int]):
        if self.used > self.max_chunks or self.filled > 8 * self.max_chunks:
            self._clear()
        slot = np.fromiter(map(self.slots.get, keys, repeat(-1)), np.int64, len(keys))
        missing = np.flatnonzero(slot < 0)
        if len(missing):
            found = [keys[i] for i in missing.tolist()]
            new = list(dict.fromkeys(found))
            self._learn(new)
            slot[missing] = np.fromiter(map(self.slots.__getitem__, found), np.int64, len(found))
            for key in new:  # whole texts aren't kept
                if key[:1] == "\x01":
                    self.slots.pop(key, None)
        sizes, starts = self.lengths[slot], self.starts[slot]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
        done = np.concatenate(([0], ends))
        return self.flat[at], done[np.concatenate(([0], np.cumsum(np.asarray(counts, np.int64))))]
