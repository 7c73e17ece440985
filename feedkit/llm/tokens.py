"""Token ids of whole Arrow columns, with any file of the ``tokenizers`` library that splits words before spaces."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import BASES, ranges, release

CACHE = 600_000  # pieces that an encoder keeps, about 50 bytes each


class Encoder:
    """Encodes each distinct piece of a batch once.

    A text is cut before every space that follows a visible character. Byte-level vocabularies never join a visible
    character with a space after it, so the ids of a text are those of its pieces, one after another. Pieces are looked
    up by a 128-bit hash among those already encoded, ``cache`` at most; the rest are encoded again when they come back.
    Names of added tokens (``<|endoftext|>``) are ordinary text, or with ``added`` become their ids, as the library's plain
    call has it; they hold no space, so pieces are the same.
    """

    def __init__(self, path: str, cache: int = CACHE, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.cache = cache
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        #: Bytes that each id stands for; byte-level names have one character a byte.
        self.width = np.zeros(max(names.values()) + 1, np.int64)
        for name, i in names.items():
            self.width[i] = len(name)
        #: Pieces by the first half of their hash: sorted, with the second half, and where their ids are in ``arena``.
        self.keys, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.begin, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.arena = np.zeros(0, np.uint32)

    def _pieces(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Sorted byte offsets where pieces begin, ``bounds`` among them."""
        before = np.zeros(len(data), bool)
        if len(data) > 1:
            prev = data[:-1]
            seen = (prev > 0x20) & (prev < 0x7F)
            # Two-byte characters from U+00C0 on: no white space among them.
            seen[1:] |= (prev[1:] >= 0x80) & (prev[1:] < 0xC0) & (prev[:-1] >= 0xC3) & (prev[:-1] < 0xE0)
            before[1:] = (data[1:] == 0x20) & seen
        inner = bounds[(bounds > 0) & (bounds < len(data))]
        before[inner] = True
        if len(data):
            before[0] = True
        return np.append(np.flatnonzero(before), len(data))

    def _ids(self, pieces: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pieces: where each begins in the array returned last, and how many it has."""
        _, offsets, data = pieces.buffers()
        bounds = np.frombuffer(offsets, np.int64)[: len(pieces) + 1]
        data = np.frombuffer(data, np.uint8)[: int(bounds[-1])]
        key, check = (ranges(data, bounds[:-1], bounds[1:], base) for base in BASES)
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        known = (self.keys[at] == key) & (self.check[at] == check) if len(self.keys) else np.zeros(len(key), bool)
        begin, sizes = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
        begin[known], sizes[known] = self.begin[at[known]], self.sizes[at[known]]
        if known.all():
            return begin, sizes, self.arena
        new = np.flatnonzero(~known)
        ids, place, sizes[new] = self._fresh(pieces.take(pa.array(new)))
        begin[new] = len(self.arena) + place
        arena = np.concatenate((self.arena, ids))
        if len(self.keys) + len(new) <= self.cache:
            order = new[np.argsort(key[new])]
            place = np.searchsorted(self.keys, key[order])
            self.begin, self.sizes = np.insert(self.begin, place, begin[order]), np.insert(self.sizes, place, sizes[order])
            self.keys, self.check = np.insert(self.keys, place, key[order]), np.insert(self.check, place, check[order])
            self.arena = arena
        return begin, sizes, arena

    def _fresh(self, pieces: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Encode pieces, fifty at a time end to end where their joints are safe; ids are told apart by their bytes."""
        width = pc.binary_length(pieces).to_numpy(zero_copy_only=False)
        pieces = pieces.to_pylist()
        safe = np.fromiter((p[0] == " " and "!" <= p[-1] <= "~" for p in pieces), bool, len(pieces))
        joined, alone = np.flatnonzero(safe), np.flatnonzero(~safe)
        ids, sizes = [], [np.zeros(0, np.int64)]
        for lo in range(0, len(joined), 5000):
            part = joined[lo : lo + 5000]
            got = self._encode(["".join([pieces[i] for i in part[at : at + 50]]) for at in range(0, len(part), 50)])
            ids += got
            upto = np.cumsum(self.width[np.concatenate(got)])
            sizes.append(np.diff(np.searchsorted(upto, np.cumsum(width[part]), "left") + 1, prepend=0))
        for lo in range(0, len(alone), 1000):
            got = self._encode([pieces[i] for i in alone[lo : lo + 1000]])
            ids += got
            sizes.append(np.fromiter(map(len, got), np.int64, len(got)))
        n, begin = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        order = np.concatenate((joined, alone))
        n[order] = np.concatenate(sizes)
        begin[order] = np.cumsum(n[order]) - n[order]
        return np.concatenate(ids), begin, n

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after another, and the number of each; null has none."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        n = len(texts)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
        data = np.frombuffer(data, np.uint8)[int(bounds[0]) : int(bounds[-1])] if bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
        bounds = bounds - bounds[0]
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        cuts = self._pieces(data, bounds)
        pieces = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data))
        coded = pieces.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        begin, sizes, flat = self._ids(coded.dictionary)
        per = sizes[codes]
        ends = np.cumsum(per)
        ids = flat[np.arange(int(ends[-1])) + np.repeat(begin[codes] - (ends - per), per)]
        upto = np.concatenate(([0], ends))
        return ids, np.diff(upto[np.searchsorted(cuts, bounds)])


@contextmanager
def encoder(path: str, reuse: bool = False, added: bool = False) -> Iterator[Encoder]:
    """An encoder for one task; its pieces go with it, as Python workers live on and may next run something else.

    With ``reuse`` the worker keeps it for its next task, with twice as many pieces, as later tasks meet them again.
    """
    yield _kept(path, added) if reuse else Encoder(path, added=added)
    release()


@lru_cache(maxsize=1)
def _kept(path: str, added: bool) -> Encoder:
    return Encoder(path, 2 * CACHE, added)
