"""Words of whole Arrow text batches as numpy arrays, without a Python loop per word.

A batch is taken in slices of whole texts, so that temporary arrays stay small
however many texts a batch holds. One text is never cut, except where its words
are hashed, which goes block by block.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
HASH_BLOCK = 1 << 20
MULTIPLIER = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1

# The bytes that separate words.
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"


@lru_cache(1)
def _libc():
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:
        return None


def let_go() -> None:
    """Give freed memory back to the system: Python workers live on from one stage to the
    next, and what one has used at most is of no use to another."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_libc(), "malloc_trim", None)
    if trim:
        trim(0)


class Texts(NamedTuple):
    """Texts that lie one behind the other in ``data``."""

    first: int  # index of the first text in its batch
    data: np.ndarray  # bytes
    offsets: np.ndarray  # where each text begins, and the end of the last


ROWS_AT_ONCE = 1024


def portions(batch, rows: int = ROWS_AT_ONCE) -> Iterator:
    """Consecutive rows of a batch or an array, a bounded number at a time: what is made of
    them takes several times their size."""
    for at in range(0, len(batch), rows):
        yield batch.slice(at, rows)


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray  # words of each text


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[Texts]:
    """Consecutive texts of about ``size`` bytes; a NULL is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    _, raw, body = texts.buffers()
    ends = np.frombuffer(raw, kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(body, np.uint8) if body else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(ends, ends[i] + size, "right")) - 1
        j = min(n, max(j, i + 1))
        yield Texts(i, data[ends[i] : ends[j]], ends[i : j + 1] - ends[i])
        i = j


def spans(texts: Texts, separator: np.ndarray) -> Words:
    """Maximal runs of bytes that ``separator`` (256 booleans) does not mark."""
    inside = np.zeros(len(texts.data) + 2, np.int8)
    inside[1:-1] = ~separator[texts.data]
    edge = np.diff(inside)
    # A text's end ends its last word, also where no separator follows.
    cut = texts.offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(texts.data))]
    cut = np.unique(cut[(inside[cut] == 1) & (inside[cut + 1] == 1)])
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if len(cut):
        starts, ends = np.sort(np.append(starts, cut)), np.sort(np.append(ends, cut))
    counts = np.diff(np.searchsorted(starts, texts.offsets))
    return Words(starts, ends, counts)


def separators(marked: bytes = SPACE_BYTES) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(marked, np.uint8)] = True
    return table


@lru_cache(1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64."""
    up = np.full(HASH_BLOCK + 1, MULTIPLIER, np.uint64)
    down = np.full(HASH_BLOCK + 1, pow(MULTIPLIER, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: every bit of the result depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans, which may overlap. Starts ascend.

    Sums of byte * power up to each position give any span's hash by a difference.
    """
    out = np.empty(len(starts), np.uint64)
    up, down = _powers()
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = int(np.searchsorted(starts, base + HASH_BLOCK // 2, "left"))
        s, e = starts[i:j] - base, ends[i:j] - base
        fits = e <= HASH_BLOCK
        stop = int(e[fits].max()) if fits.any() else 0
        sums = np.zeros(stop + 1, np.uint64)
        np.cumsum((data[base : base + stop].astype(np.uint64) + np.uint64(1)) * up[:stop], out=sums[1:])
        s_in, e_in = np.where(fits, s, 0), np.where(fits, e, 0)
        value = mix((sums[e_in] - sums[s_in]) * down[s_in] + (e_in - s_in).astype(np.uint64))
        for k in np.flatnonzero(~fits):  # a word as long as a block
            word = data[base + s[k] : base + e[k]].tobytes()
            value[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        out[i:j] = value
        i = j
    return out


def owners(counts: np.ndarray) -> np.ndarray:
    """For each word the index of its text."""
    return np.repeat(np.arange(len(counts)), counts)


def shingles(word_hashes: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``n`` words within a text, and windows of each text.

    A text of fewer words (one at least) has a single window, all its words.
    """
    total = len(word_hashes)
    factor = np.uint64(MULTIPLIER)
    value = np.zeros(total, np.uint64)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(total)  # words from here on
    for k in range(n):
        there = left > k
        value[there] = mix(value[there] * factor + word_hashes[np.flatnonzero(there) + k])
    first = np.repeat(np.cumsum(counts) - counts, counts) == np.arange(total)
    keep = (left >= n) | first
    return value[keep], np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
