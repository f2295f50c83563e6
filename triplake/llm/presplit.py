"""Words of the byte-level pattern, found in whole batches by character classes.

The pattern is 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
and its words tile the text, so a batch's words are its bytes cut at positions.
"""

from __future__ import annotations

import gc
import re
import unicodedata
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from tokenizers.pre_tokenizers import ByteLevel

from triplake.llm.words import Texts, let_go, slices

OTHER, LETTER, NUMBER, SPACE = range(4)
# What a quote takes with it.
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")
SURROGATES = range(0xD800, 0xE000)
# Unicode's white space.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
# Code points that are classified together.
RANGE = 1 << 14
# Words whose ids a worker keeps at a time: half of them in use since the last change.
KNOWN_WORDS = 300_000


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of every code point, as the tokenizers library sees it.

    Python's own tables give it, except for letters and numbers that are younger
    than these: each of them is shown to the library.
    """
    table = np.zeros(0x110000, np.uint8)
    # Range by range, as a list of all code points takes a hundred times the table.
    for first in range(0, 0x110000, RANGE):
        _classify(table, range(first, min(first + RANGE, 0x110000)))
    table[list(WHITE_SPACE)] = SPACE
    let_go()
    return table


def _classify(table: np.ndarray, points: range) -> None:
    """Letters and numbers among ``points``."""
    kinds = {"L": LETTER, "N": NUMBER}
    table[points.start : points.stop] = [kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in points]
    every = "".join(chr(c) for c in points if c not in SURROGATES)
    for kind, pattern, before in ((LETTER, r"\p{L}", "x"), (NUMBER, r"\p{N}", "1")):
        young = [ord(c) for c in regex.findall(pattern, every) if table[ord(c)] != kind]
        if not young:
            continue
        shown = "".join(f"{before}{chr(c)}\n" for c in young)
        words = ByteLevel(add_prefix_space=False).pre_tokenize_str(shown)
        begin = {span[0] for _, span in words}
        table[[c for i, c in enumerate(young) if 3 * i + 1 not in begin]] = kind


def cuts(texts: Texts) -> np.ndarray:
    """Byte positions at which words begin, and the end of the last word."""
    data, size = texts.data, len(texts.data)
    if not size:
        return np.zeros(1, np.int64)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(points)
    kind = classes()[points]
    begin = np.zeros(n + 1, bool)
    begin[np.searchsorted(lead, texts.offsets)] = True  # n for the end
    edge = begin.copy()
    begin[1:n] |= kind[1:] != kind[:-1]
    # The last of some white space before a word goes with it if it is a blank, and
    # stands by itself if not.
    i = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~edge[1:n])
    begin[i] = True
    blank = points[i] == 0x20
    begin[i[blank] + 1] = False
    # A quote that begins a word and stands alone before letters may take some of them.
    q = np.flatnonzero((points[:-1] == 0x27) & begin[:-2] & (kind[1:] == LETTER) & ~edge[1:n])
    if len(q):
        second = np.where(q + 2 < n, points[np.minimum(q + 2, n - 1)], 0)
        second[(q + 2 < n) & edge[np.minimum(q + 2, n)]] = 0
        for suffix in SUFFIXES:
            fits = points[q + 1] == ord(suffix[0])
            if len(suffix) == 2:
                fits &= second == ord(suffix[1])
            at = q[fits]
            begin[at + 1] = False
            begin[at + 1 + len(suffix)] = True
    return np.append(lead, size)[np.flatnonzero(begin)]


def distinct_words(texts: Texts) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, the index of each word among them, words of each text."""
    at = cuts(texts)
    arrays = [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(texts.data))]
    coded = pa.Array.from_buffers(pa.binary(), len(at) - 1, arrays).dictionary_encode()
    counts = np.diff(np.searchsorted(at, texts.offsets))
    # Through numpy, which makes the bytes without a scalar for each.
    words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    return words, coded.indices.to_numpy(zero_copy_only=False), counts


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of ``flat``, one behind the other."""
    before = np.cumsum(sizes) - sizes
    return flat[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


class TextEncoder:
    """Ids of whole texts from the ids of their words, each distinct word encoded once.

    ``encode_word`` takes a word's bytes. Added tokens in a text are ids of their own
    and part the text.
    """

    def __init__(
        self, encode_word: Callable[[bytes], list[int]], added: dict[str, int], known_words: int = KNOWN_WORDS
    ):
        self.encode_word, self.known_words = encode_word, known_words
        # Ids as 32-bit numbers. Words that are met again move from the older table.
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.added = {k.encode(): v for k, v in added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.marks = re.compile(b"|".join(map(re.escape, longest_first))) if added else None

    def slice_ids(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice, and how many each text has."""
        if not len(texts.data):
            return np.zeros(0, np.int64), np.zeros(len(texts.offsets) - 1, np.int64)
        if self.marks and self.marks.search(texts.data):
            return self._parted(texts)
        words, index, counts = distinct_words(texts)
        if len(self.known) > self.known_words // 2:
            self.known, self.older = {}, self.known
        ids = self._ids_of(words)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), np.int32)
        taken = sizes[index]
        ends = np.append(0, np.cumsum(taken))[np.append(0, np.cumsum(counts))]
        return gather(flat, (np.cumsum(sizes) - sizes)[index], taken), np.diff(ends)

    def _ids_of(self, words: list[bytes]) -> list[bytes]:
        known, older, encode = self.known, self.older, self.encode_word
        ids = list(map(known.get, words))
        # Many short-lived objects and no cycles: collections would only walk the tables.
        collecting = gc.isenabled()
        gc.disable()
        try:
            for i, found in enumerate(ids):
                if found is None:
                    word = words[i]
                    ids[i] = known[word] = older.get(word) or array("i", encode(word)).tobytes()
        finally:
            if collecting:
                gc.enable()
        return ids

    def _parted(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The same with added tokens: pieces between them are texts of their own."""
        pieces, marks, of_text = [], [], []
        for k in range(len(texts.offsets) - 1):
            at, stop = (int(x) for x in texts.offsets[k : k + 2])
            text = texts.data[at:stop].tobytes()
            last = 0
            for m in self.marks.finditer(text):
                pieces.append(text[last : m.start()])
                marks.append(self.added[m[0]])
                of_text.append(k)
                last = m.end()
            pieces.append(text[last:])
            marks.append(-1)
            of_text.append(k)
        ids, counts = [], np.zeros(len(texts.offsets) - 1, np.int64)
        at = np.append(0, np.cumsum([len(p) for p in pieces]))
        body = Texts(0, np.frombuffer(b"".join(pieces), np.uint8), at)
        plain = TextEncoder(self.encode_word, {}, self.known_words)
        plain.known, plain.older = self.known, self.older
        found, sizes = plain.slice_ids(body)
        self.known, self.older = plain.known, plain.older
        for run, mark, k in zip(np.split(found, np.cumsum(sizes)[:-1]), marks, of_text):
            run = run if mark < 0 else np.append(run, mark)
            ids.append(run)
            counts[k] += len(run)
        return np.concatenate(ids), counts

    def texts_ids(self, texts: pa.Array):
        """(ids, counts) for one slice of a batch after the other."""
        for part in slices(texts):
            yield self.slice_ids(part)
