"""SpotSigs: fingerprints from the content words that follow common words.

Every common word (anchor) of a text gives a signature: the anchor and the next
``CHAIN`` content words, other anchors skipped. The set of signature hashes is the
fingerprint. Headers, lists and junk hold few anchors, so they hardly count.

Sets are partitioned by length: partition p holds lengths from r**p up to r**(p+1), with
r = 1 / threshold, so that sets at the threshold lie in one partition or in two that are
neighbours. A pair is compared only if the bound min / max of its lengths reaches the
threshold; below, the result is 0 without looking at the sets.

Everything is made of DataFrame functions. ``with_next`` gives each document the text of
the next one in order without sorting the table in one task: ids fall in buckets of
equal width, each bucket is ordered by itself, and the first row of each bucket goes to
the bucket before it.

Defined cases: a NULL or empty text, and any text without a signature, has one signature
made of its whole text, so equal texts are alike and others are not; NULL ids come last,
ordered by a hash of their text, as rows that share an id are; a table of one row is its
own next row; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triplake.llm.common import text_of
from triplake.llm.quality_rules import let

CHAIN = 2
LEAST = 0.05
BUCKET_ROWS = 1024
BUCKETS_TOGETHER = 4096
# Common words of English, German, French and Spanish.
ANCHORS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of",
    "on", "that", "the", "this", "to", "was", "with",
    "auf", "das", "den", "der", "des", "die", "ein", "eine", "für", "ist", "mit", "nicht",
    "und", "von", "zu",
    "au", "avec", "de", "dans", "du", "elle", "en", "est", "et", "la", "le", "les", "par",
    "pas", "pour", "que", "qui", "sur", "un", "une",
    "al", "con", "del", "el", "es", "esta", "los", "no", "para", "por", "se", "su", "y",
)
# ASCII characters that are neither letters nor digits part words.
MARKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def signatures(text: Column) -> Column:
    """The sorted set of signature hashes of a text.

    The j-th anchor, at word i, has i - j content words before it, so the content words
    that follow it stand from there on in the list of content words.
    """
    common = lambda w: w.isin(*ANCHORS)

    def of(words: Column) -> Column:
        placed = F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
        anchors = F.filter(placed, lambda x: common(x["w"]))
        content = F.filter(words, lambda w: ~common(w))

        def chains(rest: Column) -> Column:
            with_rest = F.transform(
                anchors, lambda x, j: F.struct(x["w"].alias("w"), (x["i"] - j).alias("at"))
            )
            whole = F.filter(with_rest, lambda x: x["at"] + CHAIN <= F.size(rest))
            return F.transform(
                whole, lambda x: F.xxhash64(x["w"], *(F.get(rest, x["at"] + k) for k in range(CHAIN)))
            )

        return let(content, chains)

    words = F.filter(F.split(F.lower(text), MARKS), lambda w: w != "")
    found = let(words, of)
    return let(found, lambda s: F.when(F.size(s) == 0, F.array(F.xxhash64(text))).otherwise(F.sort_array(F.array_distinct(s))))


def fingerprint(signs: Column) -> Column:
    """The set as text: hexadecimal hashes in order."""
    return F.array_join(F.transform(signs, lambda h: F.lower(F.hex(h))), "")


def length_partition(size: Column, threshold: float) -> Column:
    return F.floor(F.log(1 / threshold, size.cast("double")) + 1e-12).cast("int")


def pruned_jaccard(a: Column, b: Column, least: float = LEAST) -> Column:
    """Jaccard similarity of two sets; 0 where their lengths rule out ``least``."""
    near = F.abs(length_partition(F.size(a), least) - length_partition(F.size(b), least)) <= 1
    bound = F.least(F.size(a), F.size(b)) / F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    return F.when(near & (bound >= least), both / (F.size(a) + F.size(b) - both)).otherwise(F.lit(0.0))


def _bucketed(docs: DataFrame) -> DataFrame:
    """``bucket`` ascends as ids descend, about ``BUCKET_ROWS`` rows each."""
    span = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("doc_id").alias("n")).first()
    low, high, n = span.low or 0, span.high or 0, max(span.n, 1)
    width = max(1, (high - low + 1) * BUCKET_ROWS // n)
    last = (high - low) // width
    by_id = F.floor((F.lit(high) - F.col("doc_id")) / F.lit(width)).cast("long")
    by_text = F.lit(last + 1) + F.pmod(F.xxhash64("text"), F.lit(BUCKETS_TOGETHER))
    return docs.withColumn("bucket", F.coalesce(by_id, by_text))


def _before(buckets: DataFrame) -> DataFrame:
    """``bucket`` and ``before``, the bucket that has it next; the first follows the last.

    Buckets are ordered within runs of ``BUCKETS_TOGETHER``; only the ends of the runs
    meet in one task.
    """
    run = F.floor(F.col("bucket") / BUCKETS_TOGETHER)
    inside = Window.partitionBy("run").orderBy("bucket")
    rows = buckets.withColumn("run", run)
    ends = rows.groupBy("run").agg(F.max("bucket").alias("end"))
    order, every = Window.orderBy("run"), Window.partitionBy(F.lit(0))
    ends = ends.select("run", F.coalesce(F.lag("end").over(order), F.max("end").over(every)).alias("run_before"))
    rows = rows.withColumn("inside", F.lag("bucket").over(inside)).join(ends, "run")
    return rows.select("bucket", F.coalesce("inside", "run_before").alias("before"))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text, and a window by which the next row can be had again."""
    rows = _bucketed(docs.select(F.col("doc_id").cast("long"), text_of().alias("text")))
    order = Window.partitionBy("bucket").orderBy(F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    placed = rows.select("*", F.row_number().over(order).alias("place"), F.lead("text").over(order).alias("inside"))
    heads = placed.filter("place = 1").select("bucket", F.col("text").alias("head"))
    heads = heads.join(_before(rows.select("bucket").distinct()), "bucket")
    heads = heads.select(F.col("before").alias("bucket"), "head")
    joined = placed.join(heads, "bucket")
    return joined.select("bucket", "place", "doc_id", "text", F.coalesce("inside", "head").alias("next_text"))


def edited(text: Column, following: Column) -> Column:
    """The last half of the code points replaced by as many of the following text."""
    half = F.floor(F.length(text) / 2).cast("int")
    kept = F.substring(text, F.lit(1), F.length(text) - half)
    return F.concat(kept, F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, and how alike they are."""
    rows = with_next(docs)
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    signed = rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        signatures(F.col("text")).alias("own"),
        signatures(F.col("edited")).alias("changed"),
        signatures(F.col("next_text")).alias("following"),
    )
    return signed.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("changed")).alias("edited_fingerprint"),
        pruned_jaccard(F.col("own"), F.col("changed")).alias("near_edited"),
        pruned_jaccard(F.col("own"), F.col("following")).alias("near_next"),
        F.size("own").cast("long").alias("n_signatures"),
        length_partition(F.size("own"), LEAST).alias("length_partition"),
    )
