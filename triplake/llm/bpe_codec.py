"""Encode whole texts with the BPE automaton, and decode by its arc labels.

Defined cases: a NULL or empty text has no ids and decodes to an empty text. Rows
are independent, so equal texts have equal ids.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.llm.bpe_automaton import automaton
from triplake.llm.presplit import TextEncoder
from triplake.llm.words import let_go

VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


@lru_cache(2)
def encoder(path: str) -> TextEncoder:
    machine, added = automaton(path)
    return TextEncoder(machine.encode_word, added)


def _runs(texts: pa.Array, name: str):
    """The ids of one text after the other."""
    for ids, counts in encoder(vocabulary_path(name)).texts_ids(texts):
        yield from np.split(ids, np.cumsum(counts)[:-1])


def encode_column(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """array<int> of token ids."""

    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.int32())
        return pa.array([run.astype(np.int32) for run in _runs(texts, vocabulary)], kind)

    return encoded(text)


def decode_column(ids: Column, vocabulary: str = VOCABULARY) -> Column:
    """The text of token ids; bytes that are not UTF-8 become U+FFFD."""

    @F.arrow_udf("string")
    def decoded(runs: pa.Array) -> pa.Array:
        machine, _ = automaton(vocabulary_path(vocabulary))
        values = (machine.decode(run.as_py() or []) for run in runs)
        return pa.array([v.decode("utf-8", "replace") for v in values], pa.string())

    return decoded(ids)


def round_trip_column(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Number of ids, and digests of the ids and of the text decoded from them."""

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: pa.Array) -> pa.Array:
        machine, _ = automaton(vocabulary_path(vocabulary))
        sizes, encoded, decoded = [], [], []
        for run in _runs(texts, vocabulary):
            ids = run.tolist()
            sizes.append(len(ids))
            encoded.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
            text = machine.decode(ids).decode("utf-8", "replace")
            decoded.append(hashlib.sha256(text.encode()).hexdigest())
        let_go()
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())],
            ["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return digests(text)


def round_trips(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row for each of ``docs``: doc_id and the digests of its round trip."""
    trips = docs.select("doc_id", round_trip_column(F.col("text"), vocabulary).alias("trip"))
    return trips.select("doc_id", "trip.*")
