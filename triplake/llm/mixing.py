"""Mixing documents to target weights by soft membership in domains.

1. A linear classifier learns the domains (clean, junk, toxic) from the labelled table:
   softmax regression over the hash values of a text's words and word endings. At most
   ``TRAINING_ROWS`` labelled rows are used, and only their hash values reach the driver.
2. Every document gets posteriors of the domains and its tokens. These few numbers are
   stored; the steps below read them only.
3. Rates r_i >= 0 are fitted by projected gradient: least squares of the expected domain
   totals sum(r_i * tokens_i * p_i) against the targets. A step is one aggregation to a few
   sums. With the documents' tokens as metric, the gradient of a document is a weighted sum
   of its posteriors; rates are clipped to their bounds after each step. Targets that were
   not met are reported by a warning, with the totals reached.
   There are two fits (``bounded``):
   - ``fit_free_rates``: no bound but 0. The number of tokens stays as it is, and each
     domain gets its share of it, by thinning or by repeating documents. Gradients add up,
     and rates are the projection of 1 less their sum, so that three numbers are all there
     is to keep. Errors are weighted by the inverse of the posteriors' second moments, for
     which a step of 1 never overshoots; a longer one, by the moments of the documents that
     are not at 0, is tried first. It goes on until targets are met (``CLOSE``) or a step
     gains next to nothing (``STALLED``), as where a domain has no tokens at all. Where
     targets are met, the rates are those nearest to 1, counted by tokens.
   - ``fit_rates``: for filters, which repeat nothing and keep the protected domain, as
     below. Errors are relative to the targets. Step sizes are those of Barzilai and
     Borwein, taken back while the error grows. It goes on until all targets are met, or
     the duality gap shows that no rates within the bounds come much nearer (``NEAREST``).
4. A rate gives copies: its whole part, and one more by a hash if that falls below the
   rest, so the same rows come out at every run.

Of a bounded fit, documents that are probably in the protected domain keep a rate of 1 at
least, and the budget is what gives their domain its share: targets are reached by thinning
others. No rate is above ``MOST_RATE``, so a domain that lacks tokens stays below its
target. A free fit may repeat the few documents of a scarce domain very often.

Everything is made of DataFrame functions.

Defined cases: a NULL or empty text has no tokens and the prior as its posteriors; rows
are rated one by one; without labels all posteriors are uniform; if no document has
tokens all rates are 1; NULL labels are left out, of repeated ones the worst counts.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.llm.common import bounded_sample, hash_uniform, stored, text_of
from triplake.llm.quality_rules import SPACES

DOMAINS = ("clean", "junk", "toxic")
PROTECTED = "clean"
TARGETS = {"clean": 0.95, "junk": 0.04, "toxic": 0.01}
BUCKETS = 1 << 13
TRAINING_ROWS = 8_000
ENDING = 3
# Of a bounded fit: rates above 1 would repeat documents.
MOST_RATE = 1.0
# Steps that end a fit which never settles; errors of met targets; and how much of the
# squared error is left to gain, at most, where the bounds keep targets from being met.
MOST_STEPS, CLOSE, NEAREST = 200, 1e-3, 0.05
# Part of the squared error that a plain step of a free fit gains where it ends.
STALLED = 1e-3
# Parts of a free fit's longer step that are tried before the plain one.
LONGER = (1, 1 / 4, 1 / 16)


def domain_of() -> Column:
    return F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0)


def labelled(labels: DataFrame, limit: int = TRAINING_ROWS) -> DataFrame:
    known = labels.filter("doc_id is not null and quality is not null and toxic is not null")
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    return bounded_sample(known.select("doc_id", domain_of().alias("domain")), limit, "doc_id")


def word_list(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def word_buckets(words: Column) -> Column:
    """Distinct hash values of the words and of their endings."""
    bucket = lambda x: F.pmod(F.xxhash64(x), F.lit(BUCKETS)).cast("int")
    endings = F.transform(words, lambda w: bucket(F.concat(F.lit(" "), F.right(w, F.lit(ENDING)))))
    return F.array_distinct(F.concat(F.transform(words, bucket), endings))


class Classifier(NamedTuple):
    """Weights of each bucket and biases, for each domain against the first."""

    weights: np.ndarray
    bias: np.ndarray


def train(texts: list[np.ndarray], domain: np.ndarray, steps: int = 120, ridge: float = 2e-3) -> Classifier:
    """Softmax regression; a text's buckets count by the root of their number."""
    n, others = len(texts), len(DOMAINS) - 1
    counts = np.bincount(domain, minlength=len(DOMAINS)) + 1.0
    bias, weights = np.log(counts[1:] / counts[0]), np.zeros((BUCKETS, others))
    if not n:
        return Classifier(weights, np.zeros(others))
    sizes = np.array([len(t) for t in texts])
    row, column = np.repeat(np.arange(n), sizes), np.concatenate(texts).astype(np.int64)
    value = np.repeat(1 / np.sqrt(np.maximum(sizes, 1)), sizes)
    truth = (domain[:, None] == np.arange(1, len(DOMAINS))).astype(float)
    m, v = np.zeros((BUCKETS + 1, others)), np.zeros((BUCKETS + 1, others))
    for step in range(1, steps + 1):
        z = np.stack([np.bincount(row, value * weights[column, k], minlength=n) for k in range(others)], axis=1) + bias
        top = np.maximum(z.max(axis=1, keepdims=True), 0)
        odds = np.exp(z - top)
        error = (odds / (odds.sum(axis=1, keepdims=True) + np.exp(-top)) - truth) / n
        slope = np.stack([np.bincount(column, value * error[row, k], minlength=BUCKETS) for k in range(others)], axis=1)
        slope = np.concatenate([slope + ridge / n * weights, error.sum(axis=0, keepdims=True)])
        m += 0.1 * (slope - m)
        v += 0.01 * (slope**2 - v)
        move = 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return Classifier(weights, bias)


def fit_classifier(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS) -> Classifier:
    chosen = F.broadcast(labelled(labels, limit))
    rows = docs.select("doc_id", "text").join(chosen, "doc_id")
    buckets = F.array_join(F.sort_array(word_buckets(word_list(text_of()))), " ")
    found = sorted(tuple(r) for r in rows.select("doc_id", "domain", buckets).collect())
    texts = [np.array(r[2].split(), np.int64) for r in found]
    return train(texts, np.array([r[1] for r in found], np.int64))


def _constants(values: np.ndarray) -> Column:
    """An array literal, which would take a call for each value if it were made of them."""
    return F.split(F.lit(",".join(f"{v:.4g}" for v in values)), ",").cast("array<double>")


def _summed(places: Column, values: Column) -> Column:
    return F.aggregate(places, F.lit(0.0), lambda total, place: total + F.get(values, place))


def posteriors(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """``docs`` with ``n_tokens`` and a posterior ``p_<domain>`` for each domain."""
    text = "__text_words"
    counted = docs.withColumn(text, word_list(text_of()))
    counted = counted.withColumn("n_tokens", F.size(text).cast("long")).withColumn(text, word_buckets(F.col(text)))
    scale = F.sqrt(F.greatest(F.size(text), F.lit(1)).cast("double"))
    scores = {"__s0": F.lit(0.0)}
    for k in range(len(DOMAINS) - 1):
        evidence = _summed(F.col(text), _constants(classifier.weights[:, k]))
        scores[f"__s{k + 1}"] = F.lit(float(classifier.bias[k])) + evidence / scale
    scored = counted.withColumns(scores).drop(text)
    top = F.greatest(*scores)
    parts = [F.exp(F.col(s) - top) for s in scores]
    whole = parts[0] + parts[1] + parts[2]
    named = {f"p_{name}": part / whole for name, part in zip(DOMAINS, parts)}
    return scored.withColumns(named).drop(*scores)


class Rates(NamedTuple):
    """The steps taken, as weights of the posteriors, and where they led."""

    steps: list[list[float]]
    totals: list[float]
    targets: list[float]
    met: bool = True
    gap: float = 0.0  # of the squared error, what other rates could gain at most
    bounded: bool = True
    passes: int = 0  # aggregations that a free fit took

    def column(self) -> Column:
        return _rate(self.steps, _moved if self.bounded else _moved_free)


def _protected() -> Column:
    return F.col(f"p_{PROTECTED}") >= 0.5


def _least_rate() -> Column:
    return F.when(_protected(), F.lit(min(1.0, MOST_RATE))).otherwise(F.lit(0.0))


def _moved_free(rate: Column, by: Column) -> Column:
    return F.greatest(F.lit(0.0), rate - by)


def _rate(steps: list[list[float]], moved: Callable[[Column, Column], Column] | None = None) -> Column:
    """1, then step by step against the gradient and back into the bounds."""
    p = [F.col(f"p_{name}") for name in DOMAINS]
    rate = F.lit(1.0)
    if not steps:
        return rate
    path = F.lit(";".join(",".join(repr(x) for x in step) for step in steps))
    moves = F.transform(F.split(path, ";"), lambda s: F.split(s, ",").cast("array<double>"))

    def move(r: Column, step: Column) -> Column:
        return (moved or _moved)(r, p[0] * step[0] + p[1] * step[1] + p[2] * step[2])

    return F.aggregate(moves, rate, move)


def _moved(rate: Column, by: Column) -> Column:
    return F.greatest(_least_rate(), F.least(F.lit(MOST_RATE), rate - by))


def fit_rates(rows: DataFrame, targets: dict[str, float] = TARGETS, steps: int = MOST_STEPS) -> Rates:
    """``rows``: n_tokens and posteriors. Each step is one aggregation."""
    p = [F.col(f"p_{name}") for name in DOMAINS]
    t = F.col("n_tokens")
    free = F.when(_protected(), 0).otherwise(t)  # protected documents do not move
    pairs = [(a, b) for a in range(len(p)) for b in range(a, len(p))]
    sums = [F.sum(t * x) for x in p] + [F.sum(free * p[a] * p[b]) for a, b in pairs] + [F.sum(t - free)]
    first = [x or 0.0 for x in rows.agg(*sums).first()]
    totals, products = np.array(first[: len(p)]), first[len(p) : -1]
    if totals.sum() <= 0:
        return Rates([], [0.0] * len(p), [0.0] * len(p))
    kept = DOMAINS.index(PROTECTED)
    wanted = np.array([targets[name] for name in DOMAINS])
    # Errors are measured against the protected domain's total, whatever thinning the
    # others leaves of it. Without protected documents, which hold it up, it stays as it was.
    follows = np.zeros((len(p), len(p)))
    if first[-1] > 0:
        follows[:, kept] = wanted / wanted[kept]
    goal = totals[kept] / wanted[kept] * wanted
    weight = 1 / np.maximum(goal, 1e-9 * goal.sum() + 1e-9)
    fixed = goal - follows @ totals

    def error_of(reached: np.ndarray) -> np.ndarray:
        return reached - follows @ reached - fixed

    turn = np.eye(len(p)) - follows
    moment = np.zeros((len(p), len(p)))
    for (a, b), value in zip(pairs, products):
        moment[a, b] = moment[b, a] = value
    # The gradient's Lipschitz constant, in the metric of the documents' tokens.
    root = np.sqrt(weight)
    steepest = float(np.linalg.eigvalsh(root[:, None] * (turn @ moment @ turn.T) * root[None, :]).max())
    least_move = move = 1 / steepest if steepest > 0 else 0.0

    path: list[list[float]] = []
    reached, error, met, gap = totals, error_of(totals), False, 0.0
    tried = 0
    while True:
        squared = float((weight * error**2).sum()) / 2
        met = bool((np.abs(error) <= CLOSE * (reached - error)).all())
        if met or tried >= steps or not move:
            break
        slope = turn.T @ (weight * error)
        slopes = sum(F.lit(float(x)) * y for x, y in zip(slope, p))
        at = rows.withColumn("before", _rate(path)).withColumn("slope", slopes)
        while tried < steps:
            tried += 1
            ahead = at.withColumn("after", _moved(F.col("before"), F.lit(move) * F.col("slope")))
            # What the gradient could gain on the way to the better bound of each rate.
            gain = F.greatest(F.col("slope") * (F.col("before") - _least_rate()), F.col("slope") * (F.col("before") - MOST_RATE))
            apart = F.col("after") - F.col("before")
            found = ahead.agg(*(F.sum(F.col("after") * t * x) for x in p), F.sum(t * apart * apart), F.sum(t * gain)).first()
            *after, moved, gap = (x or 0.0 for x in found)
            next_error = error_of(np.array(after))
            if gap <= NEAREST * squared or move <= least_move or (weight * next_error**2).sum() / 2 <= squared:
                break
            move = max(least_move, move / 4)
        if gap <= NEAREST * squared:
            break
        path.append([float(x) for x in move * slope])
        bent = float((weight * (next_error - error) ** 2).sum())
        move = min(max(moved / bent, least_move), 1e6 * least_move) if bent > 0 else least_move
        reached, error = np.array(after), next_error
    gap = 0.0 if met else gap / squared
    fitted = Rates(path, reached.tolist(), (reached - error).tolist(), met, gap)
    return _reported(fitted, f"rates up to {MOST_RATE:g}")


def _reported(fitted: Rates, what: str) -> Rates:
    if not fitted.met:
        names = ", ".join(f"{d} {x:.6g} of {y:.6g}" for d, x, y in zip(DOMAINS, fitted.totals, fitted.targets))
        warnings.warn(f"mixing: targets not met by {what}; tokens reached: {names}; gap {fitted.gap:.3g}", stacklevel=3)
    return fitted


def _inverse(moment: np.ndarray) -> np.ndarray:
    """Inverse of a moment matrix, in which domains without tokens stay 0."""
    scale = np.sqrt(np.diag(moment))
    scale = np.divide(1, scale, out=np.zeros_like(scale), where=scale > 0)
    return scale[:, None] * np.linalg.pinv(scale[:, None] * moment * scale, rcond=1e-12, hermitian=True) * scale


def fit_free_rates(rows: DataFrame, targets: dict[str, float] = TARGETS) -> Rates:
    """``rows``: n_tokens and posteriors. Rates with no bound but 0; each step that is tried
    is one aggregation."""
    p = [F.col(f"p_{name}") for name in DOMAINS]
    t = F.col("n_tokens")
    pairs = [(a, b) for a in range(len(p)) for b in range(a, len(p))]

    def state(moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Totals that the moves so far lead to, and second moments of the documents not at 0."""
        at = rows.withColumn("rate", _rate([moves.tolist()], _moved_free))
        inside = F.when(F.col("rate") > 0, t).otherwise(0)
        sums = [F.sum(F.col("rate") * t * x) for x in p] + [F.sum(inside * p[a] * p[b]) for a, b in pairs]
        found = [x or 0.0 for x in at.agg(*sums).first()]
        moment = np.zeros((len(p), len(p)))
        for (a, b), value in zip(pairs, found[len(p) :]):
            moment[a, b] = moment[b, a] = value
        return np.array(found[: len(p)]), moment

    moves = np.zeros(len(p))
    reached, moment = state(moves)
    if reached.sum() <= 0:
        return Rates([], [0.0] * len(p), [0.0] * len(p), bounded=False)
    wanted = np.array([targets[name] for name in DOMAINS])
    goal = wanted / wanted.sum() * reached.sum()
    weight = _inverse(moment)

    def squared(totals: np.ndarray) -> float:
        return float((totals - goal) @ weight @ (totals - goal)) / 2

    gained, passes = 1.0, 1
    while not (met := bool((np.abs(reached - goal) <= CLOSE * goal).all())) and gained > STALLED:
        before, error = squared(reached), reached - goal
        longer = _inverse(moment) @ error
        for part in (*LONGER, 0):
            ahead = moves + (part * longer if part else weight @ error)
            totals, inside = state(ahead)
            passes += 1
            gained = 1 - squared(totals) / before if before > 0 else 0.0
            # A longer step has to pay; the plain one is taken as it is.
            if gained >= part / 5 and part:
                break
        moves, reached, moment = ahead, totals, inside
    gap = 0.0 if met else max(gained, 0.0)
    fitted = Rates([moves.tolist()], reached.tolist(), goal.tolist(), met, gap, False, passes)
    return _reported(fitted, "rates of 0 or more")


def copies(rate: Column, *identity: Column) -> Column:
    whole = F.floor(rate)
    return (whole + (hash_uniform(*identity) < rate - whole).cast("long")).cast("long")


def document_rates(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, bounded: bool = True
) -> DataFrame:
    """doc_id, n_tokens, posteriors, rate and copies of each row of ``docs``. ``bounded``
    rates thin only, and keep the protected domain."""
    rows = docs.select("doc_id", "text")
    bare = posteriors(rows, fit_classifier(rows, labels))
    numbers = stored(bare.withColumn("__identity", F.xxhash64("doc_id", text_of())).drop("text"), "posteriors")
    fitted = fit_rates(numbers, targets) if bounded else fit_free_rates(numbers, targets)
    rated = numbers.withColumn("rate", fitted.column())
    return rated.withColumn("copies", copies(F.col("rate"), F.col("__identity"))).drop("__identity")


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """``docs`` with its columns, every row as often as its rate says.

    Rows are stored with their posteriors, so that no text is read again for its rate.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    texts = docs.select(row, "doc_id", "text")
    with_posteriors = posteriors(texts, fit_classifier(docs.select("doc_id", "text"), labels))
    identity = F.xxhash64("doc_id", text_of()).alias("identity")
    kept = stored(with_posteriors.select("*", identity).drop("doc_id", "text"), "posteriors")
    rated = kept.withColumn("rate", fit_rates(kept, targets).column())
    repeated = rated.select("row", copies(F.col("rate"), F.col("identity")).alias("copies")).filter("copies > 0")
    return repeated.select("row", F.explode(F.expr("sequence(1, copies)")).alias("copy")).select("row.*")
