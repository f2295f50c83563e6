"""Quality rules as a ledger of failure bits.

``ledger`` measures every text once and evaluates every rule once: one row for each
document with its measurements and a mask, one bit a rule. Policies are versioned
masks. Applying one is a bitwise test, and what each rule does to a policy (``ablations``)
comes from the counts of distinct masks, without looking at a text again.

Everything is made of DataFrame functions. Windows of five words are compared by
64-bit hashes within one text.

Defined cases: a NULL or empty text has no words, all measurements 0, and fails the
rule on few words; rows are judged one by one, so equal rows have equal results.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.llm.common import text_of

# What parts words, and what counts as a symbol.
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5


def let(value: Column, body) -> Column:
    """``body(value)``, with the value made once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def n_repeat_words(words: Column) -> Column:
    """Words in windows that occur twice or more in the text.

    Windows are sorted with their positions, equal ones then stand side by side. Of
    positions p < q in order, the words of p that q does not cover are min(5, q - p).
    """

    def of(hashed: Column) -> Column:
        last = F.size(hashed) - WINDOW
        windows = F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.xxhash64(*(F.get(hashed, i + k) for k in range(WINDOW))),
        )
        return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(covered(w)))

    def covered(windows: Column) -> Column:
        placed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        twice = let(
            F.sort_array(placed),
            lambda s: F.filter(
                s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])
            ),
        )
        at = F.sort_array(F.transform(twice, lambda x: x["i"]))
        step = lambda p, q: F.least(F.lit(WINDOW), F.coalesce(q - p, F.lit(WINDOW)))
        return let(at, lambda a: total(F.transform(a, lambda p, k: step(p, F.get(a, k + 1)).cast("long"))))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < 2 * 1 + WINDOW - 1, F.lit(0)).otherwise(let(hashes, of)).cast("long")


def n_dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACE_CHARS, "")) > 0)
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def measurements(docs: DataFrame) -> DataFrame:
    text = F.col("text")
    bare = docs.select("doc_id", text_of().alias("text"))
    split = bare.select(
        "doc_id", "text", F.filter(F.split(text, SPACES), lambda w: w != "").alias("words")
    )
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return split.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate(text, SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        n_dup_lines(text).alias("n_dup_lines"),
        n_repeat_words(F.col("words")).alias("n_repeat_words"),
        (F.length(text) - F.length(F.translate(text, letters, ""))).cast("long").alias("n_capitals"),
    )


class Rule(NamedTuple):
    name: str
    fails: Column


def rules() -> list[Rule]:
    """The rules in the order of their bits, which stored ledgers rely on: new rules go
    to the end."""
    words = F.col("n_words")
    return [
        Rule("few_words", words < 10),
        Rule("repeated_words", 100 * F.col("n_repeat_words") > 20 * words),
        Rule("symbols", 10 * F.col("n_symbols") > 3 * words),
        Rule("capitals", 2 * F.col("n_capitals") > F.col("word_chars")),
        Rule("word_length", (F.col("word_chars") < 2 * words) | (F.col("word_chars") > 20 * words)),
        Rule("duplicate_lines", 2 * F.col("n_dup_lines") > words),
    ]


RULE_NAMES = ("few_words", "repeated_words", "symbols", "capitals", "word_length", "duplicate_lines")


def mask_of(*names: str) -> int:
    return sum(1 << RULE_NAMES.index(n) for n in names)


# Versions are never changed, only added.
POLICIES = {
    "base": mask_of("few_words", "repeated_words"),
    "v1": mask_of("few_words", "repeated_words", "symbols", "capitals"),
    "v2": mask_of(*RULE_NAMES),
}
LATEST = "v2"


def failure_bits() -> Column:
    bits = [F.when(r.fails, F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(rules())]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return mask.cast("long")


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements, and ``failed``, the mask of failed rules."""
    measured = measurements(docs)
    return measured.select("*", failure_bits().alias("failed"))


def passes(policy: str) -> Column:
    return F.col("failed").bitwiseAND(F.lit(POLICIES[policy])) == 0


def ablations(rows: DataFrame) -> DataFrame:
    """For each policy and rule: documents, how many the policy rejects, how many fail
    the rule, and how many would be kept without it. One shuffle of distinct masks."""
    masks = rows.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    policy = F.explode(
        F.array(*(F.struct(F.lit(k).alias("policy"), F.lit(v).cast("long").alias("mask")) for k, v in POLICIES.items()))
    )
    rule = F.explode(
        F.array(*(F.struct(F.lit(k).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, k in enumerate(RULE_NAMES)))
    )
    each = masks.select("failed", "n", policy.alias("p")).select("failed", "n", "p.*", rule.alias("r"))
    each = each.select("*", "r.rule", "r.bit").filter(F.col("mask").bitwiseAND(F.col("bit")) != 0)
    hit = F.col("failed").bitwiseAND(F.col("mask"))
    count = lambda where: F.sum(F.when(where, F.col("n")).otherwise(0))
    return each.groupBy("policy", "rule").agg(
        F.sum("n").alias("n_docs"),
        count(hit != 0).alias("n_rejected"),
        count(hit.bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        count(hit == F.col("bit")).alias("n_rejected_by_it_alone"),
    )


def judged_documents(docs: DataFrame, policy: str = LATEST) -> DataFrame:
    """The ledger with ``base_failed`` and, by ``policy``, ``kept``."""
    rows = ledger(docs)
    return rows.select("*", (~passes("base")).alias("base_failed"), (passes("base") & passes(policy)).alias("kept"))
