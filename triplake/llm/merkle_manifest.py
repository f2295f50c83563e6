"""Merkle manifest of a dataset: leaves by source, checkpointed trees, proofs.

Every row of ``documents`` is a leaf. The leaves of a source, in ascending order of
their ids, are the bottom of a ternary tree whose top is the source's subroot; the
subroots, ordered by source, are the bottom of one more such tree, whose top is the
root.

1. Leaf digests are made in the scan of the texts; only digests go on from there.
2. Leaves are numbered by a range sort over (source, id, digest), so that a source with
   a third of all rows is many ranges, and by the sizes of the runs before them.
3. Only every ``STRIDE``-th level is stored. A step up takes aligned subtrees of
   ``3 ** STRIDE`` nodes at most, each a group of its own, and keeps their tops.
4. Proofs come from the top down: the missing interior nodes of each aligned subtree are
   made again from its stored lowest nodes, every one of these gets its siblings in
   front of those of its top, and the interior nodes are let go.

All of it is DataFrame functions. No group is larger than a subtree; what one number of
a tree needs (its size) comes from one row per source and range.

Defined cases: a NULL source is a source of its own and the first one; NULL ids are the
first of their source, and count as '' where the choice of tampered rows needs their
text; rows with the same id are ordered by their digest, and each is a leaf; an empty
text is not a NULL one; other columns are not part of a leaf; an empty table has no
rows and no root.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.llm.common import small_side, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN, STRIDE = 3, 4
# Powers of the fan that fit into 64 bits.
POWERS = [FAN**k for k in range(40)]

TREE, INDEX, SIZE, HASH, CARRY = "tree", "idx", "size", "hash", "carry"
PATH_TYPE = "array<struct<left:string,right:string>>"


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def leaf_digest(fields: list[Column]) -> Column:
    """Each field as byte count, ':' and value, or '-'; so no two rows read the same."""
    parts = []
    for field in fields:
        value = field.cast("string")
        counted = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(counted, F.lit("-")))
    return digest(F.concat(*parts))


def tree_of(source: Column) -> Column:
    """A key that is never NULL and sorts a NULL source first, others by their bytes."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def power(exponent: Column) -> Column:
    return F.element_at(F.array(*(F.lit(p) for p in POWERS)), exponent.cast("int") + 1)


def depth_of(size: Column) -> Column:
    """Steps until one node remains."""
    powers = F.array(*(F.lit(p) for p in POWERS))
    return F.size(F.filter(powers, lambda p: p < size))


def next_level(nodes: Column) -> Column:
    """Every run of three (the last may be shorter) becomes the digest of its digests."""
    begins = F.sequence(F.lit(0), F.size(nodes) - 1, F.lit(FAN))
    return F.transform(begins, lambda i: digest(F.array_join(F.slice(nodes, i + 1, FAN), "")))


def interior(nodes: Column, steps: Column) -> Column:
    """The lowest ``steps`` levels of a subtree, from its bottom up."""
    bottom = F.array(nodes)
    more = F.aggregate(
        F.sequence(F.lit(1), steps - 1),
        bottom,
        lambda done, _: F.concat(done, F.array(next_level(F.element_at(done, -1)))),
    )
    return F.when(steps > 1, more).otherwise(bottom)


def top_node(nodes: Column, steps: Column) -> Column:
    return F.aggregate(F.sequence(F.lit(1), steps), nodes, lambda level, _: next_level(level))[0]


def siblings(levels: Column, at: Column, steps: Column) -> Column:
    """What stands left and right of the path from node ``at``, level by level."""

    def beside(k: Column) -> Column:
        level = F.element_at(levels, k + 1)
        own = F.floor(at / power(k)).cast("int")
        first = own - own % FAN
        left = F.slice(level, first + 1, own - first)
        right = F.slice(level, own + 2, first + (FAN - 1) - own)
        return F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))

    return F.transform(F.sequence(F.lit(0), steps - 1), beside)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, leaf, lambda h, s: digest(F.concat(s["left"], h, s["right"])))


def proof_digest(path: Column) -> Column:
    beside = F.transform(path, lambda s: F.concat(s["left"], s["right"]))
    return digest(F.array_join(beside, ""))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with their place in their tree, by ``order``, and the tree's size.

    The range sort splits a large tree; places in a range follow from the first one of
    the tree's run there, and the run's from the sizes of the tree's runs before it.
    """
    ranged = rows.repartitionByRange(TREE, *order).sortWithinPartitions(TREE, *order)
    # Ids of this kind ascend within a partition, and from one partition to the next.
    placed = ranged.select("*", F.monotonically_increasing_id().alias("place"))
    placed = stored(placed.withColumn("part", F.spark_partition_id()), "places")
    runs = placed.groupBy(TREE, "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    # A row for each range that a tree has rows in, not for each of its leaves.
    before = "coalesce(sum(n) over (partition by tree order by part rows between unbounded preceding and 1 preceding), 0)"
    runs = runs.selectExpr(
        TREE, "part", f"{before} - first as shift", f"sum(n) over (partition by tree) as {SIZE}"
    )
    joined = placed.join(small_side(stored(runs, "runs")), [TREE, "part"])
    return joined.withColumn(INDEX, F.col("place") + F.col("shift")).drop("place", "part", "shift")


class Tree(NamedTuple):
    """``checkpoints``: nodes of each stored level, from the bottom, with their tree's
    size. ``tops``: the last node of every tree."""

    checkpoints: list[DataFrame]
    tops: DataFrame


def _subtrees(nodes: DataFrame, level: int) -> DataFrame:
    """One row for each aligned subtree: its lowest nodes in order, its place as a node
    of its top's level, and how many levels lie between."""
    steps = F.least(F.lit(STRIDE), depth_of(F.col(SIZE)) - level)
    rows = nodes.withColumn("steps", steps).filter("steps > 0")
    group = F.floor(F.col(INDEX) / power(F.col("steps"))).cast("long").alias(INDEX)
    child = F.struct(F.col(INDEX), F.col(HASH), F.col(CARRY))
    grouped = rows.groupBy(F.col(TREE), F.col(SIZE), F.col("steps"), group)
    # At most 81 rows.
    return grouped.agg(F.array_sort(F.collect_list(child), _by_index).alias("children"))


def _by_index(a: Column, b: Column) -> Column:
    return F.when(a[INDEX] < b[INDEX], -1).when(a[INDEX] > b[INDEX], 1).otherwise(0)


def _hashes() -> Column:
    return F.transform("children", lambda c: c[HASH])


def build(leaves: DataFrame) -> Tree:
    """Trees over ``leaves``: tree, idx, size, hash, and carry, which stays with them."""
    checkpoints, level = [stored(leaves, "level-0")], 0
    deepest = checkpoints[0].agg(F.max(depth_of(F.col(SIZE)))).first()[0] or 0
    while level < deepest:
        subtrees = _subtrees(checkpoints[-1], level)
        nodes = subtrees.select(
            TREE,
            INDEX,
            SIZE,
            top_node(_hashes(), F.col("steps")).alias(HASH),
            F.lit(None).cast("string").alias(CARRY),
        )
        level += STRIDE
        checkpoints.append(stored(nodes, f"level-{level}"))
    # A tree ends in the first checkpoint at its depth or above it.
    tops = None
    for i, nodes in enumerate(checkpoints):
        depth = depth_of(F.col(SIZE))
        ends = nodes.filter((depth <= i * STRIDE) & (depth > (i - 1) * STRIDE)).select(TREE, HASH, SIZE)
        tops = ends if tops is None else tops.union(ends)
    return Tree(checkpoints, stored(tops, "tops"))


def paths(tree: Tree, above: DataFrame) -> DataFrame:
    """Every leaf (tree, hash, carry) with ``path``, its siblings up to the root.

    ``above`` has, for each tree, the ``path`` from its top on, and ``extra``, handed on.
    """
    tops = above.join(tree.tops.select(TREE, SIZE), TREE)
    depth = depth_of(F.col(SIZE))
    known = None
    for i in range(len(tree.checkpoints) - 1, -1, -1):
        level = i * STRIDE
        # Tops that the subtrees from this level end in.
        ends = tops.filter((depth > level) & (depth <= level + STRIDE))
        ends = ends.select(TREE, F.lit(0).cast("long").alias(INDEX), "path", "extra")
        known = ends if known is None else known.union(ends)
        known = _descend(_subtrees(tree.checkpoints[i], level).join(known, [TREE, INDEX]))
        if i:
            known = stored(known.drop(HASH, CARRY), f"paths-{level}")
    lone = tree.checkpoints[0].filter(depth == 0).join(tops.drop(SIZE), TREE)
    return known.select(TREE, HASH, CARRY, "path", "extra").union(
        lone.select(TREE, HASH, CARRY, "path", "extra")
    )


def _descend(subtrees: DataFrame) -> DataFrame:
    """The lowest nodes of each subtree, with their paths in front of their top's."""
    steps = F.col("steps")

    def with_path(levels: Column) -> Column:
        return F.transform(
            "children",
            lambda c, j: F.struct(c.alias("child"), siblings(levels, j, steps).alias("below")),
        )

    # Bound to a name of the function, interior nodes are made once for a subtree.
    found = F.transform(F.array(interior(_hashes(), steps)), with_path)[0]
    rows = subtrees.select(TREE, F.explode(found).alias("found"), "path", "extra")
    return rows.select(
        TREE,
        f"found.child.{INDEX}",
        f"found.child.{HASH}",
        f"found.child.{CARRY}",
        F.concat("found.below", "path").alias("path"),
        "extra",
    )


class Manifest(NamedTuple):
    sources: Tree
    root: str | None
    # For each source's tree: the path of its subroot, and the subroot as ``extra``.
    above: DataFrame

    def proofs(self) -> DataFrame:
        """leaf, carry, subroot, path, of every row."""
        found = paths(self.sources, self.above)
        return found.select(F.col(HASH).alias("leaf"), CARRY, F.col("extra").alias("subroot"), "path")


def manifest(docs: DataFrame, carried: dict[str, Column] | None = None) -> Manifest:
    """The trees of ``docs``; ``carried`` values stay with each leaf."""
    kept = {"doc_id": F.col("doc_id")} | (carried or {})
    leaves = docs.select(
        tree_of(F.col("source")).alias(TREE),
        leaf_digest([F.col(c) for c in FIELDS]).alias(HASH),
        F.struct(*(value.alias(name) for name, value in kept.items())).alias(CARRY),
        F.col("doc_id").alias("by_id"),
    )
    leaves = numbered(stored(leaves, "leaves"), "by_id", HASH)
    sources = build(leaves.select(TREE, INDEX, SIZE, HASH, CARRY))
    subroots = sources.tops.select(F.lit("").alias(TREE), F.col(TREE).alias(CARRY), HASH)
    whole = build(numbered(subroots, CARRY).select(TREE, INDEX, SIZE, HASH, CARRY))
    top = whole.tops.select(TREE, F.array().cast(PATH_TYPE).alias("path"), F.lit("").alias("extra"))
    found = paths(whole, top)
    above = found.select(F.col(CARRY).alias(TREE), "path", F.col(HASH).alias("extra"))
    end = whole.tops.first()
    return Manifest(sources, end[HASH] if end else None, stored(above, "above"))


def verified(docs: DataFrame) -> DataFrame:
    """Every row's leaf and proof, and whether a copy that may have been tampered with
    still leads to the root. Tampering takes the line breaks out of the text of rows whose
    id has an even crc32."""
    even = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 2 == 0
    text = F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    now = leaf_digest([*(F.col(c) for c in FIELDS[:-1]), text])
    made = manifest(docs, {"now": now})
    proofs = made.proofs()
    rows = proofs.select(
        f"{CARRY}.doc_id",
        "leaf",
        "subroot",
        F.lit(made.root).cast("string").alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.col(f"{CARRY}.now"), F.col("path")).alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
