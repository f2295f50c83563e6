"""Token ids in grammar-compressed shards (Re-Pair), read back by position.

Documents are put in order of doc_id by one range shuffle of their texts. Each task
encodes its texts with the tokenizers library, one distinct word at a time, and cuts
its ids into shards of bounded size. In a shard the most frequent pairs of ids are
replaced by nonterminals, many in a round, until a round over all pairs (of those that
overlap, every other one counts) finds none that pays, or the numbers for nonterminals
are used up. A shard is one row of a Parquet file: where it begins in its part, and a
payload of

    magic, five counts | doc ids, their NULL marks | ids of each document
    | rules (left, right) | expansion length of each rule | symbols

in little-endian numbers. Symbols and rules take 16 bits, so a shard makes no more
rules than fit. The expansion lengths, summed up over the symbols, tell which symbols
cover a range of ids; only these are expanded.

The whole file set is ordered by (part, position in the part). Parts are as many as
shuffle partitions, so their totals are a small table, and no other state is shared.
A task that runs again writes the same shards.

Defined cases: a NULL or empty text is the end id alone; NULL ids come last and stay
NULL; rows of one doc_id are ordered by a hash of their text, equal rows stay apart;
an empty table gives no shards and no rows.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from triplake.llm.bpe_automaton import byte_letters
from triplake.llm.bpe_codec import VOCABULARY, vocabulary_path
from triplake.llm.presplit import TextEncoder, gather
from triplake.session import scratch_dir

MAGIC = b"RPG1"
END_ID = 2
SHARD_IDS = 1 << 19
# A rule costs eight bytes, a replaced pair saves two.
LEAST_USES = 8
PAIRS_A_ROUND = 4096
SYMBOLS = 1 << 16
SLOT_BITS = 18
# Words whose ids a worker keeps, some 200 bytes each.
KNOWN_WORDS = 1_600_000


@lru_cache(2)
def library_encoder(path: str) -> TextEncoder:
    """Words encoded by the library's model, in letters that stand for bytes."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    model = tokenizer.model
    letters = {byte: letter for letter, byte in byte_letters().items()}
    added = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}

    def encode_word(word: bytes) -> list[int]:
        return [t.id for t in model.tokenize(word.decode("latin-1").translate(letters))]

    return TextEncoder(encode_word, added, KNOWN_WORDS)


# --- one shard ----------------------------------------------------------------


def _slots(codes: np.ndarray) -> np.ndarray:
    return (codes * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOT_BITS)


def _frequent_pairs(codes: np.ndarray, slots: np.ndarray, most: int) -> np.ndarray:
    """Codes of the most frequent pairs, ascending."""
    # Counts of hashed codes are never too small: what stays below is not sorted.
    crowded = np.bincount(slots, minlength=1 << SLOT_BITS) >= LEAST_USES
    values, counts = np.unique(codes[crowded[slots]], return_counts=True)
    values, counts = values[counts >= LEAST_USES], counts[counts >= LEAST_USES]
    return np.sort(values[np.lexsort((values, -counts))[:most]])


def _places(codes: np.ndarray, slots: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where chosen pairs are, and which of them each is. No two of them share a slot."""
    named = np.full(1 << SLOT_BITS, -1, np.int16)
    named[_slots(chosen)] = np.arange(len(chosen))
    pair = named[slots]
    place = np.flatnonzero(pair >= 0)
    pair = pair[place].astype(np.int64)
    same = chosen[pair] == codes[place]
    return place[same], pair[same]


class Uses(NamedTuple):
    """Places at which pairs that pay are replaced, and which pair each is."""

    place: np.ndarray
    pair: np.ndarray
    paid: np.ndarray  # of all pairs


def _uses(place: np.ndarray, pair: np.ndarray, n: int) -> Uses:
    """Of pairs that overlap, every other one is replaced, from the left."""
    order = np.arange(len(place))
    opens = np.append(True, np.diff(place) != 1)[: len(place)]
    first = np.maximum.accumulate(np.where(opens, order, 0)) if len(place) else order
    apart = (order - first) % 2 == 0
    place, pair = place[apart], pair[apart]
    paid = np.bincount(pair, minlength=n) >= LEAST_USES
    return Uses(place[paid[pair]], pair[paid[pair]], paid)


def compress(ids: np.ndarray, terminals: int) -> tuple[np.ndarray, np.ndarray]:
    """(rules, symbols): rule i is the pair that nonterminal ``terminals + i`` stands for.

    All pairs are counted once. After a round no old pair has become more frequent, so
    the next one counts pairs with a new nonterminal only; all are counted again where
    pairs had to wait for a later round, and at the end, where no use must be left that pays.
    """
    symbols = ids.astype(np.uint32)
    rules = np.zeros((0, 2), np.uint32)
    newest = 0  # pairs with a symbol from here on are counted
    while True:
        room = SYMBOLS - terminals - len(rules)
        if len(symbols) < 2 or room <= 0:
            break
        codes = (symbols[:-1] << np.uint32(16)) | symbols[1:]
        at = None
        if newest:
            new = symbols >= newest
            at = np.flatnonzero(new[:-1] | new[1:])
            codes = codes[at]
        slots, most = _slots(codes), min(room, PAIRS_A_ROUND)
        frequent = _frequent_pairs(codes, slots, most)
        left = frequent
        while True:
            # One pair of a slot at a time; the others wait, unless none of these pays.
            chosen = left[np.unique(_slots(left), return_index=True)[1]]
            place, pair = _places(codes, slots, chosen)
            found = _uses(place if at is None else at[place], pair, len(chosen))
            left = np.setdiff1d(left, chosen)
            if found.paid.any() or not len(left):
                break
        if not found.paid.any():
            if not newest:
                break
            newest = 0
            continue
        place, pair, paid = found
        number = (np.cumsum(paid) - 1 + terminals + len(rules)).astype(np.uint32)
        symbols[place] = number[pair]
        stay = np.ones(len(symbols), bool)
        stay[place + 1] = False
        symbols = symbols[stay]
        waiting = len(frequent) == most or len(chosen) < len(frequent)
        newest = 0 if waiting else terminals + len(rules)
        made = chosen[paid]
        rules = np.concatenate([rules, np.stack([made >> np.uint32(16), made & np.uint32(0xFFFF)], axis=1)])
    return rules, symbols


def expansion_lengths(rules: np.ndarray, terminals: int) -> np.ndarray:
    """Ids under each nonterminal; a rule uses only earlier ones."""
    lengths = np.ones(terminals + len(rules), np.int64)
    for i, (a, b) in enumerate(rules.tolist()):
        lengths[terminals + i] = lengths[a] + lengths[b]
    return lengths[terminals:]


def expand(symbols: np.ndarray, rules: np.ndarray, terminals: int) -> np.ndarray:
    """The ids that symbols stand for: nonterminals give way to pairs until none is left."""
    symbols, rules = symbols.astype(np.int64), rules.astype(np.int64)
    while len(symbols) and int(symbols.max()) >= terminals:
        inner = symbols >= terminals
        place = np.cumsum(1 + inner) - 1 - inner
        wider = np.empty(len(symbols) + int(inner.sum()), np.int64)
        wider[place[~inner]] = symbols[~inner]
        pairs = rules[symbols[inner] - terminals]
        wider[place[inner]], wider[place[inner] + 1] = pairs[:, 0], pairs[:, 1]
        symbols = wider
    return symbols


def pack(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray, terminals: int) -> tuple[bytes, int]:
    """The payload of a shard, and its number of symbols."""
    rules, symbols = compress(ids, terminals)
    head = struct.pack("<4s5q", MAGIC, len(doc_ids), len(ids), terminals, len(rules), len(symbols))
    parts = b"".join(
        [
            head,
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], "u1").tobytes(),
            counts.astype("<i8").tobytes(),
            rules.astype("<u2").tobytes(),
            expansion_lengths(rules, terminals).astype("<u4").tobytes(),
            symbols.astype("<u2").tobytes(),
        ]
    )
    return parts, len(symbols)


class Shard:
    """A payload, expanded only where it is asked for."""

    def __init__(self, payload: bytes):
        magic, docs, self.n_ids, self.terminals, rules, symbols = struct.unpack_from("<4s5q", payload)
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        at = struct.calcsize("<4s5q")
        parts = []
        for kind, n in (("<i8", docs), ("u1", docs), ("<i8", docs), ("<u2", 2 * rules), ("<u4", rules), ("<u2", symbols)):
            parts.append(np.frombuffer(payload, kind, n, at))
            at += parts[-1].nbytes
        ids, missing, self.counts, pairs, lengths, self.symbols = parts
        self.doc_ids = [None if m else int(d) for d, m in zip(ids, missing)]
        self.rules = pairs.reshape(-1, 2)
        size = np.ones(self.terminals + rules, np.int64)
        size[self.terminals :] = lengths
        self.size = size
        self.ends = np.cumsum(size[self.symbols])

    @cached_property
    def expansions(self) -> np.ndarray:
        """What each symbol stands for, one behind the other: each rule is expanded once,
        however often its nonterminal is used."""
        nonterminals = np.arange(self.terminals, len(self.size))
        inner = expand(nonterminals, self.rules, self.terminals)
        return np.concatenate([np.arange(self.terminals), inner]).astype(np.int32)

    @cached_property
    def begins(self) -> np.ndarray:
        return np.cumsum(self.size) - self.size

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids at positions start to stop: only the symbols that cover them are expanded."""
        if stop <= start:
            return np.zeros(0, np.int64)
        first = int(np.searchsorted(self.ends, start, "right"))
        last = int(np.searchsorted(self.ends, stop, "left"))
        begin = int(self.ends[first - 1]) if first else 0
        covering = self.symbols[first : last + 1]
        found = gather(self.expansions, self.begins[covering], self.size[covering])
        return found[start - begin : stop - begin]

    def document(self, k: int) -> np.ndarray:
        start = int(self.counts[:k].sum())
        return self.ids(start, start + int(self.counts[k]))


# --- file sets ----------------------------------------------------------------

SHARD_TYPE = "part long, part_start long, n_docs long, n_ids long, n_symbols long, payload binary"


def _shards(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    encoder = library_encoder(vocabulary_path(vocabulary))
    path = vocabulary_path(vocabulary)
    terminals = _terminals(path)
    part, done = TaskContext.get().partitionId(), 0
    doc_ids: list[int | None] = []
    runs: list[np.ndarray] = []
    held = 0

    def shard() -> pa.RecordBatch:
        counts = np.array([len(r) for r in runs], np.int64)
        payload, symbols = pack(doc_ids, counts, np.concatenate(runs), terminals)
        values = [part, done, len(doc_ids), held, symbols, payload]
        names = ["part", "part_start", "n_docs", "n_ids", "n_symbols", "payload"]
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names)

    for batch in batches:
        names, row = batch.column("doc_id").to_pylist(), 0
        for ids, counts in encoder.texts_ids(batch.column("text")):
            for run in np.split(ids, np.cumsum(counts)[:-1]):
                doc_ids.append(names[row])
                runs.append(np.append(run, END_ID))
                held += len(run) + 1
                row += 1
                if held >= SHARD_IDS:
                    yield shard()
                    done += held
                    doc_ids, runs, held = [], [], 0
    if doc_ids:
        yield shard()


@lru_cache(2)
def _terminals(path: str) -> int:
    size = Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)
    if size >= SYMBOLS:
        raise ValueError(f"{path} has more ids than 16 bits hold")
    return size


def write_ids(docs: DataFrame, path: str, vocabulary: str = VOCABULARY) -> None:
    """Write the ids of all texts, in order of doc_id, as shards under ``path``."""
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows.mapInArrow(lambda batches: _shards(batches, vocabulary), SHARD_TYPE).write.parquet(path)


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    for batch in batches:
        for base, start, payload in zip(*(batch.column(c).to_pylist() for c in ("base", "part_start", "payload"))):
            shard = Shard(payload)
            first = base + start + np.cumsum(shard.counts) - shard.counts
            ids = shard.ids(0, shard.n_ids).astype("<u4", copy=False)
            runs = np.split(ids, np.cumsum(shard.counts)[:-1])
            crcs = [zlib.crc32(run.tobytes()) for run in runs]
            arrays = [pa.array(shard.doc_ids, pa.int64()), pa.array(first), pa.array(shard.counts), pa.array(crcs, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start among all ids, number of ids, and their crc32, from the files."""
    shards = spark.read.schema(SHARD_TYPE).parquet(path)
    # As many rows as the writing shuffle had partitions.
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = shards.join(F.broadcast(bases), "part").select("base", "part_start", "payload")
    return placed.mapInArrow(_positions, "doc_id long, start long, n_tokens long, ids_crc32 long")


def document_positions(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` written as shards in the shared folder, then read back."""
    path = scratch_dir(docs.sparkSession, "token-ids")
    write_ids(docs, path, vocabulary)
    return read_documents(docs.sparkSession, path)
