"""Document quality: random-indexing word vectors, pooled, and a two-layer network.

1. Every word falls in one of ``BUCKETS`` buckets by its hash and has a sparse random
   index vector (a few +1 and -1). The vector of a word is the sum of its neighbours'
   index vectors, over all occurrences in the whole corpus. Tasks add up their share in
   one matrix; matrices are sent as compressed blocks and added up in two steps, as a
   stream, so that no task holds more than a block of each kind.
2. A text's words are pooled: the mean of their unit vectors, the mean of their index
   vectors (which is long where few words are repeated), and shares of kinds of words.
3. A network with one hidden layer is trained in numpy on at most ``TRAINING_ROWS``
   labelled rows that are not held out. A part of them, not trained on, sets the
   temperature by which its logits are divided, so that scores are probabilities.

Words are runs of letters, of digits, or of marks; case counts.

Defined cases: a NULL or empty text has the zero vector and gets its score; rows of
equal text score alike; without training labels, or with one class only, all texts
score the smoothed share of good labels; NULL labels are left out, of repeated ones
the largest counts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.llm.common import id_remainder
from triplake.llm.toxicity import training_labels
from triplake.llm.words import Texts, hashes, mix, owners, slices

BUCKETS, WIDTH, NONZERO, WINDOW = 8192, 32, 4, 2
BLOCK = 1024  # buckets sent as one piece
BRANCHES = 32  # partial sums of each block in the first step
TRAINING_ROWS = 16_000
HELD_OUT_DIVISOR, HELD_OUT_REMAINDER = 5, 0
PREDICT_AT = 0.3
HIDDEN, EPOCHS, BATCH, CALIBRATION = 24, 40, 256, 0.2

SPACE, LETTERS, DIGITS, MARKS = range(4)
KIND = np.full(256, MARKS, np.uint8)
KIND[[0x20, *range(0x09, 0x0E)]] = SPACE
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = LETTERS
KIND[0x30:0x3A] = DIGITS


class Tokens(NamedTuple):
    bucket: np.ndarray
    kind: np.ndarray
    upper: np.ndarray  # begins with two capitals
    counts: np.ndarray


def tokens(texts: Texts) -> Tokens:
    kind = KIND[texts.data]
    change = np.ones(len(kind) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[texts.offsets] = True
    at = np.flatnonzero(change)
    starts, ends = at[:-1], at[1:]
    word = kind[starts] != SPACE if len(kind) else np.zeros(0, bool)
    starts, ends = starts[word], ends[word]
    hashed = hashes(texts.data, starts, ends)
    capital = np.zeros(len(kind) + 1, bool)
    capital[:-1] = (texts.data >= 0x41) & (texts.data <= 0x5A)
    upper = capital[starts] & capital[starts + 1] & (ends - starts > 1)
    counts = np.diff(np.searchsorted(starts, texts.offsets))
    return Tokens((hashed % np.uint64(BUCKETS)).astype(np.int64), kind[starts], upper, counts)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero parts of each bucket's index vector."""
    base = np.arange(BUCKETS, dtype=np.uint64)[:, None] * np.uint64(NONZERO)
    random = mix(base + np.arange(NONZERO, dtype=np.uint64) + np.uint64(0x5151))
    place = (random % np.uint64(WIDTH)).astype(np.int64)
    return place, np.where((random >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)


def add_contexts(total: np.ndarray, bucket: np.ndarray, of: np.ndarray) -> None:
    """Add to each word's row of ``total`` the index vectors of its neighbours."""
    place, sign = index_vectors()
    for apart in range(1, WINDOW + 1):
        same = of[apart:] == of[:-apart]
        left, right = bucket[:-apart][same], bucket[apart:][same]
        for word, near in ((left, right), (right, left)):
            for k in range(NONZERO):
                at = word * WIDTH + place[near, k]
                total += np.bincount(at, sign[near, k], minlength=BUCKETS * WIDTH)


def _context_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS * WIDTH)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = texts_seen = 0
    for batch in batches:
        for part in slices(batch.column(0)):
            found = tokens(part)
            held.append((found.bucket, owners(found.counts) + texts_seen))
            texts_seen += len(found.counts)
            size += len(found.bucket)
            if size > 1_000_000:
                add_contexts(total, *map(np.concatenate, zip(*held)))
                held, size = [], 0
    if held:
        add_contexts(total, *map(np.concatenate, zip(*held)))
    if total.any():
        yield from _packed(dict(enumerate(np.split(total, BUCKETS // BLOCK))))


def _packed(blocks: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    body = [zlib.compress(b.astype("<i8").tobytes(), 1) for b in blocks.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(blocks), pa.int32()), pa.array(body, pa.binary())], ["block", "body"])


def _added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by block of what a task reads, one piece at a time."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, body in zip(batch.column("block").to_pylist(), batch.column("body")):
            piece = np.frombuffer(zlib.decompress(body.as_py()), "<i8")
            sums[block] = sums.get(block, 0) + piece
    if sums:
        yield from _packed(sums)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors of all buckets, from the neighbours in all of ``docs``."""
    kind = "block int, body binary"
    blocks = docs.select("text").mapInArrow(_context_blocks, kind)
    branch = F.pmod(F.spark_partition_id(), F.lit(BRANCHES))
    spread = blocks.withColumn("branch", branch).repartition("block", "branch")
    partial = spread.select("block", "body").mapInArrow(_added_up, kind)
    sums = partial.repartition("block").mapInArrow(_added_up, kind).collect()
    total = np.zeros((BUCKETS // BLOCK, BLOCK * WIDTH))
    for row in sums:
        total[row.block] += np.frombuffer(zlib.decompress(row.body), "<i8")
    total = total.reshape(BUCKETS, WIDTH)
    return total / np.maximum(np.sqrt((total**2).sum(axis=1, keepdims=True)), 1.0)


PLAIN = 7
POOLED = 2 * WIDTH + PLAIN


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """One row of features for each text."""
    place, sign = index_vectors()
    own = np.zeros((BUCKETS, WIDTH))
    np.add.at(own, (np.arange(BUCKETS)[:, None], place), sign)
    both = np.concatenate([vectors, own], axis=1).astype(np.float32)
    out = np.zeros((len(texts), POOLED))
    for part in slices(texts):
        found = tokens(part)
        n = len(found.counts)
        of, size = owners(found.counts), np.maximum(found.counts, 1)[:, None]
        rows = slice(part.first, part.first + n)
        full = np.flatnonzero(found.counts)
        sums = np.zeros((n, 2 * WIDTH))
        if len(full):
            first = (np.cumsum(found.counts) - found.counts)[full]
            sums[full] = np.add.reduceat(both[found.bucket], first, axis=0, dtype=np.float64)
        mean = sums / size
        out[rows, : 2 * WIDTH] = mean
        share = lambda mark: np.bincount(of[mark], minlength=n) / size[:, 0]  # noqa: E731, B023
        # Of pairs of neighbours and of next but one, how many are the same word.
        again = [np.zeros(len(of), bool) for _ in range(2)]
        for k, same in enumerate(again, 1):
            same[k:] = (found.bucket[k:] == found.bucket[:-k]) & (of[k:] == of[:-k])
        length = np.diff(part.offsets) / size[:, 0]
        spread = (mean[:, WIDTH:] ** 2).sum(axis=1)
        plain = [share(found.kind == MARKS), share(found.upper), share(again[0]), share(again[1])]
        plain += [np.minimum(length, 40) / 10, np.log1p(found.counts) / 5, np.sqrt(spread)]
        out[rows, 2 * WIDTH :] = np.stack(plain, axis=1)
    return out


class Network(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(z @ self.inner + self.inner_bias) @ self.outer + self.outer_bias

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def constant(share: float, width: int = POOLED) -> Network:
    zero = np.zeros(width)
    return Network(zero, zero + 1, np.zeros((width, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))


def train(x: np.ndarray, y: np.ndarray, seed: int = 7) -> Network:
    """Adam on the log loss, then the temperature on rows that were left out."""
    if len(y) < 10 or y.min() == y.max():
        return constant((float(y.sum()) + 1) / (len(y) + 2))
    random = np.random.default_rng(seed)
    order = random.permutation(len(y))
    cut = max(1, int(len(y) * CALIBRATION))
    held, used = order[:cut], order[cut:]
    mean, scale = x[used].mean(axis=0), x[used].std(axis=0) + 1e-6
    z = np.clip((x[used] - mean) / scale, -8, 8)
    target = y[used]
    width = x.shape[1]
    parts = [random.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN), random.normal(0, 0.3, HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    step = 0
    for _ in range(EPOCHS):
        shuffled = random.permutation(len(target))
        for i in range(0, len(target), BATCH):
            rows = shuffled[i : i + BATCH]
            inner, bias, outer, last = parts
            hidden = np.tanh(z[rows] @ inner + bias)
            error = 1 / (1 + np.exp(-np.clip(hidden @ outer + last, -40, 40))) - target[rows]
            back = error[:, None] * outer * (1 - hidden**2)
            slopes = [z[rows].T @ back, back.sum(axis=0), hidden.T @ error, error.sum(keepdims=True)]
            step += 1
            for p, g, a, b in zip(parts, slopes, m, v):
                g = g / len(rows) + 1e-4 * p
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= 0.003 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    network = Network(mean, scale, parts[0], parts[1], parts[2], float(parts[3][0]))
    logits, truth = network.logits(x[held]), y[held]
    choices = np.geomspace(0.25, 8, 61)
    loss = [np.mean(np.logaddexp(0, logits / t) - truth * logits / t) for t in choices]
    return network._replace(temperature=float(choices[int(np.argmin(loss))]))


# --- on Spark -----------------------------------------------------------------


def is_held_out() -> Column:
    return id_remainder("doc_id", HELD_OUT_DIVISOR) == HELD_OUT_REMAINDER


class QualityModel(NamedTuple):
    vectors: np.ndarray
    network: Network

    def column(self, text: Column) -> Column:
        vectors, network = self

        @F.arrow_udf("double")
        def score(texts: pa.Array) -> pa.Array:
            return pa.array(network.probabilities(pooled(texts, vectors)))

        return score(text)


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS) -> QualityModel:
    vectors = word_vectors(docs)

    @F.arrow_udf("array<double>")
    def pool(texts: pa.Array) -> pa.Array:
        return pa.array(list(pooled(texts, vectors)), pa.list_(pa.float64()))

    chosen = training_labels(labels, "quality", is_held_out(), limit)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = texts.select("doc_id", "label", pool("text").alias("x")).collect()
    rows.sort(key=lambda r: (r.doc_id, r.x))  # tasks end in any order
    x = np.array([r.x for r in rows]).reshape(len(rows), POOLED)
    return QualityModel(vectors, train(x, np.array([r.label for r in rows], float)))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``."""
    model = fit(docs, labels)
    scored = docs.select("doc_id", model.column(F.col("text")).alias("score"))
    return scored.select(
        "doc_id",
        is_held_out().alias("held_out"),
        "score",
        (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"),
    )
