"""URL filter: a tree of path templates for each host.

Paths are cut into segments, and the tree is built from the root down, one level at a
time for all hosts together. At each branch point

- rare segments, with too few labelled pages to test (fewer than ``TESTED``, however
  large the branch point), become the wildcard ``*`` if there are many of them;
- of the others, those whose labelled share of bad pages does not differ from that of
  the whole branch point (a two-sided test at ``Z``) are merged into one branch ``+``;
  those that differ stay as they are.

A template (a path of the tree) is rejected by its purity: its share of bad labelled
pages, smoothed towards its host's, which is smoothed towards that of all pages. Rules
given for hosts and path beginnings come before the templates.

Levels are aggregated from distinct paths with counts. Tables of branch points and
segments are joined back without collecting any; a host with a third of all pages has
its distinct paths spread over tasks by segment. Children of one branch point, paths of
one template and templates of one host are dealt over copies of it.

Defined cases: a NULL url or one without ``://`` has an empty host and path, and its
template is judged as any other; repeated rows are judged alike; without labels no
template is rejected; paths are walked to their last segment, however deep.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.llm.common import stored

MANY, TESTED = 8, 5
Z = 2.58
SPREAD = 32
SMOOTHING, REJECT = 10.0, 0.5
ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rule(verdict: str, text: str) -> Rule:
    host, slash, path = text.partition("/")
    return Rule(verdict, host, slash + path)


# The rules.
RULES = (
    rule(ALLOW, "org/"),
    rule(BLOCK, "example.org/es/"),
    rule(BLOCK, "example.org/en/1"),
    rule(ALLOW, "com/fr/"),
    rule(BLOCK, "com/de/"),
)


PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Text and verdict of the longest rule that fits, else NULL."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def segments(path: Column) -> Column:
    """The parts between slashes."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/")
    return F.when(path == "", F.array().cast("array<string>")).otherwise(parts)


COUNTS = ("n", "labelled", "bad")


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in COUNTS]


def distinct_paths(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """host, path with the number of pages, of labelled pages, of bad ones."""
    known = labels.filter("id is not null and bad is not null")
    known = known.groupBy("id").agg(F.max(F.col("bad").cast("int")).alias("is_bad"))
    rows = pages.join(known, pages["page_id"] == known["id"], "left")
    return rows.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("is_bad").alias("labelled"),
        F.coalesce(F.sum("is_bad"), F.lit(0)).alias("bad"),
    )


def _spread_join(rows: DataFrame, groups: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Rows with what ``groups`` tells of their ``keys``. Rows are dealt by ``by`` over
    ``SPREAD`` parts of their group, and the group is repeated for those parts only that
    have rows, so that one of very many rows is no single task's work."""
    dealt = rows.withColumn("spread", F.pmod(F.xxhash64(by), F.lit(SPREAD)))
    parts = dealt.select(*keys, "spread").distinct().join(groups, keys)
    return dealt.join(parts, [*keys, "spread"]).drop("spread")


def _generalised(children: DataFrame) -> DataFrame:
    """For each (host, prefix, segment) the token that stands for it."""
    at = ["host", "prefix"]
    rare = F.col("labelled") < TESTED
    points = children.groupBy(*at).agg(
        F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad")
    )
    seen = _spread_join(children, points, at, "segment").withColumn("rare", rare)
    many = seen.groupBy(*at).agg(F.sum(F.col("rare").cast("long")).alias("n_rare"), F.count(F.lit(1)).alias("n_children"))
    seen = _spread_join(seen, many, at, "segment")
    share = (F.col("all_bad") + 1) / (F.col("all_labelled") + 2)
    apart = F.abs(F.col("bad") - F.col("labelled") * share)
    similar = apart <= Z * F.sqrt(F.col("labelled") * share * (1 - share)) + 0.5
    many_rare = F.col("n_rare") >= MANY
    others = F.col("n_children") - F.when(many_rare, F.col("n_rare")).otherwise(0)
    token = (
        F.when(F.col("rare") & many_rare, "*")
        .when(similar & (others > 1), "+")
        .otherwise(F.col("segment"))
    )
    return seen.select("host", "prefix", "segment", token.alias("token"))


def templates(paths: DataFrame) -> DataFrame:
    """host, path, template, level by level."""
    open_rows = paths.select("host", "path", *COUNTS, F.lit("").alias("prefix"), segments(F.col("path")).alias("rest"))
    open_rows = stored(open_rows, "urls")
    deepest = open_rows.agg(F.max(F.size("rest"))).first()[0] or 0
    for _ in range(deepest):
        ahead = open_rows.withColumn("segment", F.get("rest", F.lit(0)))
        children = ahead.filter("segment is not null").groupBy("host", "prefix", "segment").agg(*_sums())
        tokens = _generalised(children)
        moved = ahead.join(tokens, ["host", "prefix", "segment"], "left")
        prefix = F.concat("prefix", F.lit("/"), "token")
        rest = F.when(F.size("rest") > 1, F.slice("rest", F.lit(2), F.size("rest") - 1))
        open_rows = stored(
            moved.select(
                "host",
                "path",
                *COUNTS,
                F.coalesce(prefix, F.col("prefix")).alias("prefix"),
                F.coalesce(rest, F.array().cast("array<string>")).alias("rest"),
            ),
            "urls",
        )
    return open_rows.withColumnRenamed("prefix", "template").drop("rest")


def judged_templates(rows: DataFrame) -> DataFrame:
    """host, template, purity and verdict of each template."""
    found = rows.groupBy("host", "template").agg(*_sums())
    hosts = found.groupBy("host").agg(F.sum("labelled").alias("host_labelled"), F.sum("bad").alias("host_bad"))
    every = hosts.agg(F.sum("host_labelled").alias("n"), F.sum("host_bad").alias("bad")).first()
    overall = (every.bad or 0) / every.n if every.n else 0.0
    host_share = (F.col("host_bad") + SMOOTHING * overall) / (F.col("host_labelled") + SMOOTHING)
    purity = (F.col("bad") + SMOOTHING * host_share) / (F.col("labelled") + SMOOTHING)
    verdict = F.when(F.col("purity") >= REJECT, BLOCK).otherwise(ALLOW)
    scored = _spread_join(found, hosts, ["host"], "template").withColumn("purity", purity)
    return scored.select("host", "template", "purity", verdict.alias("by_template"))


def judged_pages(pages: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity for each row of ``pages``.

    ``labels``: id of a page and whether it is bad.
    """
    url = F.col("url")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    tree = templates(distinct_paths(rows, labels))
    paths = tree.select("host", "path", "template")
    judged = _spread_join(paths, judged_templates(tree), ["host", "template"], "path")
    found = rows.join(judged, ["host", "path"]).withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col("found.verdict"), F.col("by_template"))
    return found.select("page_id", "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"), "template", "purity")
