"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard.

1. Each text gives its set of word 4-grams. Two fixed permutations of 32-bit numbers
   make all signature coordinates: the first places the grams, the second, shifted by
   one place for each coordinate, ranks them; a coordinate is the least rank. Texts of
   one set are one class from here on.
2. Bands of coordinates are bucket keys. Bands and rows are chosen so that a pair at the
   threshold shares a bucket with the target recall.
3. Classes that share a bucket are compared by sketches (a byte a coordinate). Pairs
   that cannot be told from linked ones, by four standard deviations, are tied; a bucket
   gives a forest of its ties, not its pairs. So a pair that fell into a bucket by chance
   ties nothing together.
4. Within what is tied, links are confirmed on full sets, block against block: each
   set that was reached is compared with all that were not, until every set is.
   Blocks bound what a task holds; a confirmed forest is all they give back.

Words are runs without white space, A-Z lower-cased. Components join what links, over
any number of steps.

Defined cases: a NULL text is an empty one; a text without a word has an empty set and
is linked with nothing; a text of fewer than four words has one gram, all of them, which
is no other text's 4-gram; repeated rows are copies; NULL ids count only where a
component has no other (its id is NULL then, and kept is true); a row's id that occurs
twice in a component is kept twice; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplake.llm.common import join_counted, small_side, stored, text_of
from triplake.llm.components import components
from triplake.llm.words import hashes, mix, separators, shingles, slices, spans

N = 4
# A share in hundredths, as links are decided in whole numbers.
LEAST_HUNDREDTHS = 80
RECALL, MOST_COORDINATES = 0.999, 256
DEVIATIONS = 4
BUCKET = 2048
BLOCK_SETS, BLOCK_GRAMS = 512, 1 << 18
SEPARATOR = separators()


def banding(similarity: float, recall: float = RECALL, most: int = MOST_COORDINATES) -> tuple[int, int]:
    """(bands, rows): the longest bands, which have the fewest chance meetings, with which
    ``most`` coordinates find a pair of that similarity with the given recall."""
    best = None
    for rows in range(1, most + 1):
        alone = similarity**rows
        bands = 1 if alone == 1 else math.ceil(math.log(1 - recall) / math.log1p(-alone))
        if bands * rows <= most:
            best = bands, rows
    if best is None:
        raise ValueError(f"{most} coordinates do not reach recall {recall}")
    return best


BANDS, ROWS = banding(LEAST_HUNDREDTHS / 100)
COORDINATES = BANDS * ROWS


def plausible(similarity: float, coordinates: int) -> float:
    """The share of equal coordinates below which no linked pair is expected."""
    return similarity - DEVIATIONS * math.sqrt(similarity * (1 - similarity) / coordinates)


def _permuted(x: np.ndarray, factors: tuple[int, int]) -> np.ndarray:
    """A permutation of the 32-bit numbers: every step can be undone."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(factors[0])
    x ^= x >> np.uint32(15)
    x *= np.uint32(factors[1])
    x ^= x >> np.uint32(16)
    return x


PLACING, RANKING = (0x7FEB352D, 0x846CA68B), (0x21F0AAAD, 0xD35A2D97)


def gram_sets(texts: pa.Array, n: int = N) -> Iterator[np.ndarray]:
    """The sorted set of n-gram hashes of each text."""
    for part in slices(texts):
        upper = (part.data >= ord("A")) & (part.data <= ord("Z"))
        part = part._replace(data=np.where(upper, part.data | np.uint8(32), part.data))
        found = spans(part, SEPARATOR)
        grams, counts = shingles(hashes(part.data, found.starts, found.ends), found.counts, n)
        ends = np.cumsum(counts)
        for end, count in zip(ends.tolist(), counts.tolist()):
            yield np.unique(grams[end - count : end])


def signature(grams: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """Least rank of the grams' places at each shift. An empty set has none."""
    placed = _permuted(grams.astype(np.uint32), PLACING)
    least = np.empty(coordinates, np.uint32)
    for k in range(coordinates):
        least[k] = _permuted(placed + np.uint32(k), RANKING).min()
    return least


def signatures(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """As ``signature``, of many sets at once."""
    out = np.zeros((len(sets), coordinates), np.uint32)
    sizes = np.array([len(s) for s in sets])
    full = np.flatnonzero(sizes)
    if len(full):
        placed = _permuted(np.concatenate([sets[i] for i in full]).astype(np.uint32), PLACING)
        first = np.cumsum(sizes[full]) - sizes[full]
        for k in range(coordinates):
            out[full, k] = np.minimum.reduceat(_permuted(placed + np.uint32(k), RANKING), first)
    return out


def band_keys(signed: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One key for each band of each signature; equal keys mean equal bands."""
    keys = np.empty((len(signed), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(signed), band, np.uint64)
        for k in range(band * rows, (band + 1) * rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + signed[:, k])
        keys[:, band] = key
    return keys.view(np.int64)


SET_GRAMS = 1 << 20


def _in_groups(sets: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Sets in lists of bounded size, so that their temporary arrays are bounded."""
    group, size = [], 0
    for grams in sets:
        group.append(grams)
        size += len(grams)
        if size >= SET_GRAMS:
            yield group
            group, size = [], 0
    yield group


SKETCH = "doc_id long, text_hash long, set_key binary, n_shingles long, bands array<long>, sketch binary"


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for sets in _in_groups(gram_sets(batch.column("text"))):
            part = batch.slice(at, len(sets))
            at += len(sets)
            signed = signatures(sets)
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            offsets = pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32())
            arrays = [
                part.column("doc_id"),
                part.column("text_hash"),
                pa.array(keys, pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(band_keys(signed).reshape(-1))),
                pa.array([row.tobytes() for row in signed.astype(np.uint8)], pa.binary()),
            ]
            names = ["doc_id", "text_hash", "set_key", "n_shingles", "bands", "sketch"]
            yield pa.RecordBatch.from_arrays(arrays, names)


def _identified(docs: DataFrame) -> DataFrame:
    text = text_of()
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def reached(n: int, near) -> np.ndarray:
    """For each of n items the item that stands for its component. ``near(i, others)``
    tells which of ``others`` are linked with i. An item is compared with those only that
    nothing has reached yet."""
    root = np.arange(n)
    left = np.arange(n)
    while len(left):
        first, left = left[0], left[1:]
        queue = [first]
        while queue and len(left):
            linked = near(queue.pop(), left)
            found, left = left[linked], left[~linked]
            root[found] = first
            queue.extend(found.tolist())
    return root


# --- ties within buckets -----------------------------------------------------


def _ties(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Forests of buckets, whose entries come one behind the other."""
    keys: list[bytes] = []
    sketches: list[bytes] = []
    held = None
    for batch in batches:
        u: list[bytes] = []
        v: list[bytes] = []
        names = ("band", "i", "j", "set_key", "sketch")
        for *bucket, key, sketch in zip(*(batch.column(c).to_pylist() for c in names)):
            if bucket != held:
                _tied(keys, sketches, least, u, v)
                held, keys, sketches = bucket, [], []
            keys.append(key)
            sketches.append(sketch)
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], ["u", "v"])
    u, v = [], []
    _tied(keys, sketches, least, u, v)
    yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], ["u", "v"])


def _tied(keys: list[bytes], sketches: list[bytes], least: float, u: list, v: list) -> None:
    if len(keys) < 2:
        return
    signed = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(keys), -1)
    enough = least * signed.shape[1]

    def near(i: int, others: np.ndarray) -> np.ndarray:
        return (signed[others] == signed[i]).sum(axis=1) >= enough

    root = reached(len(keys), near)
    for i in np.flatnonzero(root != np.arange(len(keys))).tolist():
        u.append(keys[i])
        v.append(keys[root[i]])


def _plausible_groups(sets: DataFrame) -> DataFrame:
    """(set_key, root): classes tied by buckets and sketches, directly or through others."""
    entries = sets.filter("n_shingles > 0").select("set_key", F.explode("bands").alias("band"))
    buckets = entries.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = join_counted(entries, stored(buckets, "buckets"), "band")
    parts = F.ceil(F.col("n") / BUCKET).cast("int")
    # A part of a bucket meets itself and each other part once.
    met = met.select("set_key", "band", parts.alias("parts")).withColumn(
        "part", F.pmod(F.xxhash64("set_key"), F.col("parts")).cast("int")
    )
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = met.select(
        "set_key", "band", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j")
    )
    entries = met.join(sets.select("set_key", "sketch"), "set_key")
    entries = entries.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    least = plausible(LEAST_HUNDREDTHS / 100, COORDINATES)
    ties = entries.select("band", "i", "j", "set_key", "sketch").mapInArrow(
        lambda batches: _ties(batches, least), "u binary, v binary"
    )
    return components(ties.distinct()).withColumnRenamed("node", "set_key")


# --- confirmation on full sets -----------------------------------------------


def linked(a: int, b: int, shared: np.ndarray | int) -> np.ndarray | bool:
    """Whether sets of a and b grams that share so many are linked."""
    return 100 * shared >= LEAST_HUNDREDTHS * (a + b - shared)


def confirmed(sets: list[np.ndarray]) -> np.ndarray:
    """For each set the one that stands for its component, over links on full sets."""
    sizes = np.array([len(s) for s in sets], np.int64)
    grams = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    begin = np.cumsum(sizes) - sizes

    def near(i: int, others: np.ndarray) -> np.ndarray:
        # A set beyond these sizes cannot share enough.
        small, large = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        fits = 100 * small >= LEAST_HUNDREDTHS * large
        out = np.zeros(len(others), bool)
        tried = others[fits]
        if len(tried):
            count = sizes[tried]
            ends = np.cumsum(count)
            place = np.arange(ends[-1]) + np.repeat(begin[tried] - (ends - count), count)
            mine, theirs = sets[i], grams[place]
            at = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
            shared = np.add.reduceat((mine[at] == theirs).astype(np.int64), ends - count)
            out[fits] = linked(sizes[i], count, shared)
        return out

    return reached(len(sets), near)


def _confirm(rows: pa.Table) -> pa.Table:
    """Links among the sets of two blocks, or of one, as a forest."""
    texts = rows.column("text")
    keys = rows.column("set_key").to_pylist()
    first = {}
    for k, key in enumerate(keys):
        first.setdefault(key, k)  # repeated rows of the first copy
    order = sorted(first)
    sets = list(gram_sets(texts.combine_chunks().take(pa.array([first[k] for k in order], pa.int64()))))
    root = confirmed(sets)
    moved = np.flatnonzero(root != np.arange(len(order))).tolist()
    return pa.table(
        {
            "u": pa.array([order[k] for k in moved], pa.binary()),
            "v": pa.array([order[root[k]] for k in moved], pa.binary()),
        }
    )


def _links(docs: DataFrame, sets: DataFrame, groups: DataFrame) -> DataFrame:
    """A forest (u, v) of the links between classes of one group."""
    grouped = groups.join(sets.select("set_key", "doc_id", "text_hash", "n_shingles"), "set_key")
    grouped = stored(grouped, "groups")
    sizes = grouped.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("grams"))
    parts = F.ceil(F.greatest(F.col("n") / BLOCK_SETS, F.col("grams") / BLOCK_GRAMS)).cast("int")
    blocked = join_counted(grouped, stored(sizes.select("root", "n", parts.alias("parts")), "sizes"), "root")
    blocked = blocked.withColumn("part", F.pmod(F.xxhash64("set_key"), F.col("parts")).cast("int"))
    blocked = stored(blocked.select("root", "parts", "part", "set_key", "doc_id", "text_hash"), "blocks")
    # The first copy of each set brings its text; several rows may be that copy.
    there = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_hash") == F.col("b.text_hash"))
    texts = _identified(docs).alias("a").join(small_side(blocked).alias("b"), there)
    other = F.explode(F.sequence(F.lit(0), F.col("b.parts") - 1)).alias("other")
    texts = texts.select("b.root", "b.part", "b.set_key", "a.text", other)
    met = texts.select(
        "root", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "set_key", "text"
    )
    return met.groupBy("root", "i", "j").applyInArrow(_confirm, "u binary, v binary")


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (its least doc_id) and kept, of each row."""
    members = stored(_identified(docs).mapInArrow(_sketches, SKETCH), "sketches")
    # Sketches of one set are alike, so that any of them will do.
    sets = members.filter("n_shingles > 0").groupBy("set_key").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch"),
    )
    sets = stored(
        sets.select("set_key", "n", "first.doc_id", "first.text_hash", "n_shingles", "bands", "sketch"), "sets"
    )
    groups = stored(_plausible_groups(sets), "plausible")
    tied = components(_links(docs, sets, groups)).withColumnRenamed("node", "set_key")
    classes = sets.select("set_key", "n", "doc_id").join(tied, "set_key", "left")
    least = classes.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    classes = classes.join(least, "root", "left").select(
        "set_key", "n", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")
    )
    rows = members.filter("n_shingles > 0").select("set_key", "doc_id", "n_shingles")
    found = join_counted(rows, stored(classes, "classes"), "set_key")
    alone = members.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    found = found.select("doc_id", "n_shingles", "component_id").union(alone)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
