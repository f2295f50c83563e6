"""Self-join of documents by the Jaccard similarity of their sets of word n-grams.

1. Each text gives its set of n-gram hashes, a fingerprint of that set and MinHash
   bands. Texts of the same set are one class from here on, however many they are.
2. Bands and rows are chosen so that a pair at the threshold shares a band with the
   target recall. Classes are shuffled on their band hashes; in each bucket, every
   class is tied to the least one. These ties, as many as there are bucket entries,
   give candidate groups (connected components).
3. Within a group all pairs are verified on the full sets, in blocks: a group beyond
   ``BLOCK_CLASSES`` or ``BLOCK_GRAMS`` is split, and each pair of blocks is a task's
   unit of work of its own. A block pair counts links and gives a spanning forest of
   them; no pair is ever a row.
4. Counts are summed and forests joined to the final classes of documents.

So a group of any size is compared in full, but what is shuffled grows with its
members times its blocks, not with its pairs.

Words are runs without white space. A text of fewer than n words has one n-gram, all
of its words; texts without a word are copies of one another.

Defined cases: a NULL text is an empty one; repeated rows are copies; NULL ids are
left out of the class id, which is the least id in a class (NULL if it has none).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.llm.components import components
from triplake.llm.common import join_counted, stored, text_of
from triplake.llm.words import hashes, let_go, mix, portions, separators, shingles, slices, spans

N, THRESHOLD, RECALL = 5, 0.8, 0.999
MOST_HASHES = 160
BLOCK_CLASSES, BLOCK_GRAMS = 512, 1 << 19
SEPARATOR = separators()


class Bands(NamedTuple):
    bands: int
    rows: int

    def recall(self, similarity: float) -> float:
        return 1 - (1 - similarity**self.rows) ** self.bands


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> Bands:
    """The most rows a band (so the fewest chance candidates) with which a pair at the
    threshold is found with the given recall by at most ``most`` hashes."""
    best = None
    for rows in range(1, most + 1):
        if threshold >= 1:
            bands = 1
        else:
            bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows) - 1e-9)
        if bands * rows <= most:
            best = Bands(bands, rows)
    if best is None:
        raise ValueError(f"no banding reaches recall {recall} with {most} hashes")
    return best


def gram_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted set of n-gram hashes of each text."""
    for part in slices(texts):
        found = spans(part, SEPARATOR)
        grams, counts = shingles(hashes(part.data, found.starts, found.ends), found.counts, n)
        for run in np.split(grams, np.cumsum(counts)[:-1]):
            yield np.unique(run)


def signatures(sets: list[np.ndarray], bands: Bands) -> np.ndarray:
    """Band hashes of each set; of an empty set they mean nothing."""
    sizes = np.array([len(s) for s in sets])
    out = np.zeros((len(sets), bands.bands), np.int64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    grams = np.concatenate([sets[i] for i in full])
    first = (np.cumsum(sizes[full]) - sizes[full]).astype(np.int64)
    low, high = grams.astype(np.uint32), (grams >> np.uint64(32)).astype(np.uint32)
    random = mix(np.arange(2 * bands.bands * bands.rows, dtype=np.uint64) + np.uint64(0xA5A5))
    factor, offset = np.split(random.astype(np.uint32), 2)
    for band in range(bands.bands):
        value = np.full(len(full), band, np.uint64)
        for k in range(band * bands.rows, (band + 1) * bands.rows):
            permuted = (low ^ offset[k]) * (factor[k] | np.uint32(1)) + high
            permuted ^= permuted >> np.uint32(15)
            permuted *= np.uint32(0x2C1B3C6D)
            least = np.minimum.reduceat(permuted, first)
            value = mix(value * np.uint64(0x9E3779B97F4A7C15) + least)
        out[full, band] = value.view(np.int64)
    return out


SKETCH_TYPE = "doc_id long, text_hash long, set_key binary, n_grams long, bands array<long>"


def _sketches(batches: Iterator[pa.RecordBatch], n: int, bands: Bands) -> Iterator[pa.RecordBatch]:
    for batch in (portion for batch in batches for portion in portions(batch)):
        sets = list(gram_sets(batch.column("text"), n))
        keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
        signs = signatures(sets, bands)
        listed = pa.ListArray.from_arrays(
            pa.array(np.arange(len(sets) + 1) * bands.bands, pa.int32()), pa.array(signs.reshape(-1))
        )
        sizes = pa.array([len(s) for s in sets], pa.int64())
        arrays = [batch.column("doc_id"), batch.column("text_hash"), pa.array(keys, pa.binary()), sizes, listed]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_hash", "set_key", "n_grams", "bands"])
        del batch, sets, keys, signs, listed, sizes, arrays
        let_go()


def _identified(docs: DataFrame) -> DataFrame:
    text = text_of()
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


class Links(NamedTuple):
    """``members``: doc_id, text_hash, set_key, n_grams of every document.
    ``classes``: set_key, copies, doc_id and text_hash of the first copy, n_links of
    each class with others (copies counted), class_id of its whole group, and
    class_key, the set_key that stands for the group."""

    members: DataFrame
    classes: DataFrame


def find_links(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL) -> Links:
    bands = choose_bands(threshold, recall)
    sketches = _identified(docs).mapInArrow(lambda b: _sketches(b, n, bands), SKETCH_TYPE)
    members = stored(sketches, "grams")
    # Sketches of one set are alike, so that any of them will do.
    sets = members.groupBy("set_key").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first"),
        F.first("n_grams").alias("n_grams"),
        F.first("bands").alias("bands"),
    )
    sets = stored(sets.select("set_key", "copies", "n_grams", "bands", "first.doc_id", "first.text_hash"), "sets")
    groups = _candidate_groups(sets)
    checked = stored(_verified(docs, sets, groups, n, threshold), "links")
    counts = checked.groupBy("set_key").agg(F.sum("links").alias("links"))
    forest = checked.select(F.col("set_key").alias("u"), F.col("root").alias("v"))
    tied = components(forest)
    classes = (
        sets.select("set_key", "copies", "doc_id", "text_hash")
        .join(tied.withColumnRenamed("node", "set_key"), "set_key", "left")
        .join(counts, "set_key", "left")
        .withColumn("class_key", F.coalesce("root", "set_key"))
    )
    # Classes of a single set, most of them, need no further aggregation.
    least = classes.filter("root is not null").groupBy("class_key").agg(F.min("doc_id").alias("least"))
    classes = classes.join(least, "class_key", "left").select(
        "set_key",
        "copies",
        "doc_id",
        "text_hash",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("class_id"),
        "class_key",
    )
    return Links(members.drop("bands"), stored(classes, "classes"))


def _candidate_groups(sets: DataFrame) -> DataFrame:
    """(set_key, root): sets that share bands, directly or through others."""
    entries = sets.filter("n_grams > 0").select("set_key", F.explode("bands").alias("band"))
    buckets = entries.groupBy("band").agg(F.min("set_key").alias("least"), F.count(F.lit(1)).alias("n"))
    tied = join_counted(entries, stored(buckets.filter("n > 1"), "buckets"), "band")
    ties = tied.select(F.col("set_key").alias("u"), F.col("least").alias("v")).distinct()
    return components(ties).withColumnRenamed("node", "set_key")


def _block_of(n_blocks: Column) -> Column:
    return F.pmod(F.xxhash64("set_key"), n_blocks).cast("int")


def _verified(docs: DataFrame, sets: DataFrame, groups: DataFrame, n: int, threshold: float) -> DataFrame:
    """set_key, links, root: what each pair of blocks found for each of its sets."""
    grouped = groups.join(sets.select("set_key", "doc_id", "text_hash", "copies", "n_grams"), "set_key")
    grouped = stored(grouped, "groups")
    sizes = grouped.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_grams").alias("grams"))
    parts = F.ceil(F.greatest(F.col("n") / BLOCK_CLASSES, F.col("grams") / BLOCK_GRAMS)).cast("int")
    blocked = join_counted(grouped, stored(sizes.select("root", "n", parts.alias("n_blocks")), "sizes"), "root")
    blocked = blocked.withColumn("block", _block_of(F.col("n_blocks"))).drop("n_grams", "n")
    # The first copy of each set brings its text; several rows may be that copy.
    there = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_hash") == F.col("b.text_hash"))
    texts = _identified(docs).alias("a").join(blocked.alias("b"), there)
    texts = texts.select("b.root", "b.n_blocks", "b.block", "b.set_key", "b.copies", "a.text")

    @F.arrow_udf("binary")
    def grams(batch: pa.Array) -> pa.Array:
        return pa.array([s.tobytes() for s in gram_sets(batch, n)], pa.binary())

    # A block meets itself and every other block of its group once.
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    met = texts.select("root", "block", "set_key", "copies", grams("text").alias("grams"), other.alias("other"))
    met = met.select(
        "root",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "block",
        "set_key",
        "copies",
        "grams",
    )

    def check(block_pair: pa.Table) -> pa.Table:
        return _check_blocks(block_pair, threshold)

    return met.groupBy("root", "i", "j").applyInArrow(check, "set_key binary, links long, root binary")


def _check_blocks(rows: pa.Table, threshold: float) -> pa.Table:
    """Links between two blocks, or within one, of the sets in ``rows``."""
    first = {}
    for k, key in enumerate(rows.column("set_key").to_pylist()):
        first.setdefault(key, k)  # repeated rows of the first copy
    order = sorted(first)
    at = [first[key] for key in order]
    block, copies = (rows.column(c).to_numpy()[at] for c in ("block", "copies"))
    grams = rows.column("grams")
    sets = [np.frombuffer(grams[k].as_buffer(), np.uint64) for k in at]
    near = similar(sets, threshold)
    let_go()
    i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
    if i != j:
        near &= block[:, None] != block[None, :]
    links = near @ copies
    root = forest(near)
    linked = np.flatnonzero(links > 0)
    return pa.table(
        {
            "set_key": pa.array([order[k] for k in linked], pa.binary()),
            "links": pa.array(links[linked], pa.int64()),
            "root": pa.array([order[root[k]] for k in linked], pa.binary()),
        }
    )


def similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which of the sets are at least ``threshold`` alike, the diagonal left out.

    Grams in the same sets are counted as one with a weight, which leaves few columns
    where texts are near copies; the shared weights of all pairs are matrix products.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    shared = np.zeros((m, m), np.float64)
    row = np.repeat(np.arange(m), sizes)
    gram, column = np.unique(np.concatenate(sets) if m else np.zeros(0, np.uint64), return_inverse=True)
    if len(gram):
        # Two grams of equal sums of their sets' random numbers are in the same sets.
        numbers = mix(np.arange(m, dtype=np.uint64) + np.uint64(0x1234))
        order = np.argsort(column, kind="stable")
        begin = np.searchsorted(column[order], np.arange(len(gram)))
        marks = np.add.reduceat(numbers[row[order]], begin)
        _, kept, pattern, weight = np.unique(marks, return_index=True, return_inverse=True, return_counts=True)
        members = np.diff(np.append(begin, len(column)))
        wide = np.flatnonzero(members[kept] > 1)
        place = np.full(len(kept), -1)
        place[wide] = np.arange(len(wide))
        leads = np.zeros(len(gram), bool)
        leads[kept[wide]] = True
        entry = leads[column]
        entry_row, entry_column = row[entry], place[pattern[column[entry]]]
        by_column = np.argsort(entry_column, kind="stable")
        entry_row, entry_column = entry_row[by_column], entry_column[by_column]
        step = max(1, (1 << 22) // m)
        for start in range(0, len(wide), step):
            a, b = np.searchsorted(entry_column, [start, start + step])
            inside = np.zeros((m, min(step, len(wide) - start)), np.float32)
            inside[entry_row[a:b], entry_column[a:b] - start] = 1
            shared += (inside * weight[wide[start : start + step]].astype(np.float32)) @ inside.T
    union = sizes[:, None] + sizes[None, :] - shared
    near = (shared >= threshold * union - 1e-9) & (shared > 0)
    np.fill_diagonal(near, False)
    return near


def forest(near: np.ndarray) -> np.ndarray:
    """The least row of each row's component."""
    label = np.arange(len(near))
    while len(near):
        least = np.where(near, label[None, :], len(near)).min(axis=1)
        moved = np.minimum(label, least)
        moved = np.minimum(moved, moved[moved])
        if (moved == label).all():
            break
        label = moved
    return label


def linked_documents(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, n_links, copies, n_grams for each row of ``docs``.

    ``n_links`` counts all other rows at the threshold or above, copies among them.
    """
    links = find_links(docs, n, threshold, recall)
    classes = links.classes.select("set_key", "class_id", "n_links", "copies")
    rows = join_counted(links.members, classes, "set_key", "copies")
    return rows.select("doc_id", "class_id", "n_links", "copies", "n_grams")


def one_of_each(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``docs`` with its columns, one row of each class: that of the least id, of rows
    with one id that of the least text hash, of equal rows one."""
    links = find_links(docs, n, threshold, recall)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    kept = links.classes.groupBy("class_key").agg(first.alias("first"))
    kept = kept.select(F.col("first.doc_id").alias("kept_id"), F.col("first.text_hash").alias("kept_hash"))
    row_id, row_hash = F.coalesce("doc_id", F.lit(0)), F.xxhash64(text_of())
    marked = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col("doc_id").isNull().alias("none"),
        row_id.cast("long").alias("row_id"),
        row_hash.alias("row_hash"),
    )
    chosen = kept.select(
        F.col("kept_id").isNull().alias("none"),
        F.coalesce("kept_id", F.lit(0)).alias("row_id"),
        F.col("kept_hash").alias("row_hash"),
    )
    keys = ["none", "row_id", "row_hash"]
    rows = marked.join(chosen, keys, "left_semi")
    return rows.groupBy(*keys).agg(F.first("row").alias("row")).select("row.*")
