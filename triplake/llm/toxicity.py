"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

1. Voters look at a text and fire or not: a fixed lexicon, lexicons of words and of
   word beginnings induced from labelled training rows, the density of such words,
   and patterns (masked letters, shouting). Each text gets a bit mask of votes.
2. The label model sees only how often each mask occurs in the whole corpus. EM
   estimates how often each voter fires on toxic and on other texts; correlations of
   voters within a class, left over by the independent model, temper their weight, so
   that voters that say the same are not counted twice. It gives every mask a
   posterior.
3. A logistic regression over words and word beginnings is trained on the posteriors of
   the training rows, each by its own votes, and scores every text.

The training rows are at most ``TRAINING_ROWS`` labelled rows that are not held out.
What reaches the driver is bounded: hashed features and votes of these rows and one
count for each vote mask.

Defined cases: a NULL or empty text scores as a text without any feature; rows of
equal text score alike; without training labels the induced lexicons are empty and the
fixed lexicon decides; NULL and repeated labels are left out (the largest counts).
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.llm.common import bounded_sample, id_remainder
from triplake.llm.words import hashes, let_go, owners, portions, separators, slices, spans

TRAINING_ROWS = 8_000
HELD_OUT_DIVISOR, HELD_OUT_REMAINDER = 3, 1
PREDICT_AT = 0.7
# Insults.
INSULTS = (
    "idiot", "idiots", "moron", "morons", "stupid", "loser", "losers", "pathetic", "scum",
    "worthless", "trash", "disgusting", "clown", "imbecile", "retard", "bitch", "bastard",
    "asshole", "fuck", "fucking", "shit", "cunt", "whore", "slut", "vermin", "filth",
)
# A feature is a number of 32 bits: two for its family (words, beginnings of each
# length), the others a hash. Chance meetings of two words are rare enough at that.
HASH_BITS = 30
FILTER_BITS = 22
PREFIXES = (4, 5, 6)  # bytes of a word's beginning
LEAST_TEXTS = 3  # toxic training texts that a lexicon entry occurs in, at least
LEAST_SHARE = 0.01  # and as a share of them, as copies of one text repeat its words
LEAST_RATIO = 40.0  # how much more often than in others
FEATURES = 8192
LEAST_GAIN = 1.5  # beginnings of common syllables differ by chance
VOTERS = ("fixed_words", "words", *(f"prefix_{k}" for k in PREFIXES), "density", "masked", "shouting")
DENSITY = 0.01
# Voters that are nearly always right differ by a few texts: no sign of a correlation.
LEAST_SPREAD = 0.02
LEAST_WEIGHT = 0.5  # with less evidence the classes can run together
NOT_WORD = separators(bytes(b for b in range(128) if not chr(b).isalnum()))


class Features(NamedTuple):
    """Hashed features of the words of a slice; ``of`` is each one's text."""

    ids: list[np.ndarray]  # words, then beginnings of each length
    of: list[np.ndarray]
    n_words: np.ndarray
    masked: np.ndarray
    shouting: np.ndarray


def _id(hashed: np.ndarray, family: int) -> np.ndarray:
    return (hashed >> np.uint64(64 - HASH_BITS)).astype(np.uint32) | np.uint32(family << HASH_BITS)


class Known:
    """Where features are in a sorted list; most others are turned away by a table."""

    def __init__(self, ids: np.ndarray):
        self.ids = np.unique(ids).astype(np.uint32)
        self.table = np.zeros(1 << FILTER_BITS, bool)
        self.table[self.ids & np.uint32((1 << FILTER_BITS) - 1)] = True

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``ids`` that are known, and their places in the list."""
        at = np.flatnonzero(self.table[ids & np.uint32((1 << FILTER_BITS) - 1)])
        place = np.searchsorted(self.ids, ids[at])
        place[place == len(self.ids)] = 0
        same = self.ids[place] == ids[at] if len(self.ids) else np.zeros(len(at), bool)
        return at[same], place[same]

    def texts_with(self, ids: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(of[self.find(ids)[0]], minlength=n)


def features(texts: pa.Array):
    """Features of one slice of whole texts after the other, with the place of its first."""
    before = 0
    for portion in portions(texts):
        for first, found in _features(portion.fill_null("")):
            yield before + first, found
        before += len(portion)


def _features(texts: pa.Array):
    lowered = pc.utf8_lower(texts)
    for raw, part in zip(_as_is(texts), slices(lowered)):
        found = spans(part, NOT_WORD)
        of = owners(found.counts)
        ids, owner = [_id(hashes(part.data, found.starts, found.ends), 0)], [of]
        for family, k in enumerate(PREFIXES, 1):
            longer = found.ends - found.starts > k
            start = found.starts[longer]
            ids.append(_id(hashes(part.data, start, start + k), family))
            owner.append(of[longer])
        yield part.first, Features(ids, owner, found.counts, *raw(len(found.counts)))


def _as_is(texts: pa.Array):
    """For the slices of the lowered texts: patterns that need the case."""
    upper = pc.count_substring_regex(texts, r"\p{Lu}").to_numpy(zero_copy_only=False)
    letters = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    masks = pc.count_substring_regex(texts, r"\pL[*@#$]+\pL").to_numpy(zero_copy_only=False)
    at = 0

    def take(n: int):
        nonlocal at
        part = slice(at, at + n)
        at += n
        return masks[part] > 0, upper[part] > 0.3 * np.maximum(letters[part], 1)

    while True:
        yield take


@lru_cache(1)
def fixed_lexicon() -> np.ndarray:
    part = next(slices(pa.array(INSULTS)))
    return np.unique(_id(hashes(part.data, part.offsets[:-1], part.offsets[1:]), 0))


class Voting(NamedTuple):
    """Lexicons as features, one for the words and one for each length of beginnings."""

    lexicons: tuple[np.ndarray, ...]

    def masks(self, texts: pa.Array) -> np.ndarray:
        known, fixed = [Known(ids) for ids in self.lexicons], Known(fixed_lexicon())
        out = np.zeros(len(texts), np.int64)
        for first, f in features(texts):
            n = len(f.n_words)
            hits = [k.texts_with(ids, of, n) for k, ids, of in zip(known, f.ids, f.of)]
            fixed_hits = fixed.texts_with(f.ids[0], f.of[0], n)
            dense = np.maximum.reduce([fixed_hits, *hits]) > DENSITY * np.maximum(f.n_words, 1)
            votes = [fixed_hits > 0, *(h > 0 for h in hits), dense, f.masked, f.shouting]
            out[first : first + n] = sum(v.astype(np.int64) << i for i, v in enumerate(votes))
        let_go()
        return out


class Counted(NamedTuple):
    """Features of the training texts, and how many texts have each."""

    ids: np.ndarray  # distinct, ascending
    row: np.ndarray  # text of each occurrence
    column: np.ndarray  # place in ``ids`` of each occurrence

    def sums(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, weights[self.row], minlength=len(self.ids))


def counted(texts: list[np.ndarray]) -> Counted:
    """``texts`` holds the distinct features of each text."""
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    every = np.concatenate(texts) if texts else np.zeros(0, np.uint32)
    ids, column = np.unique(every, return_inverse=True)
    return Counted(ids.astype(np.uint32), row, column)


def induce(seen: Counted, toxic: np.ndarray) -> tuple[np.ndarray, ...]:
    """Lexicons: features far more frequent in toxic training texts."""
    n = np.array([(1 - toxic).sum(), toxic.sum()], float)
    counts = [seen.sums(1.0 - toxic), seen.sums(toxic.astype(float))]
    rate = [(c + 0.5) / (total + 1) for c, total in zip(counts, n)]
    least = max(LEAST_TEXTS, LEAST_SHARE * n[1])
    chosen = seen.ids[(counts[1] >= least) & (rate[1] >= LEAST_RATIO * rate[0])]
    return tuple(chosen[chosen >> np.uint32(HASH_BITS) == k] for k in range(1 + len(PREFIXES)))


class LabelModel(NamedTuple):
    """Posterior of each vote mask, and what it was made from."""

    posterior: dict[int, float]
    counts: dict[int, int]
    prior: float
    fires: np.ndarray  # rates by class (other, toxic) and voter
    correlations: np.ndarray  # by class and pair of voters
    weights: np.ndarray

    def of(self, masks: np.ndarray) -> np.ndarray:
        return np.array([self.posterior.get(int(m), 0.0) for m in masks])


def fit_label_model(counts: dict[int, int], voters: int = len(VOTERS), rounds: int = 4) -> LabelModel:
    """EM over vote masks. Voters that are correlated within a class, beyond what the
    class explains, share one voter's weight."""
    masks = np.array(sorted(counts), np.int64)
    n = np.array([counts[m] for m in masks.tolist()], float)
    votes = ((masks[:, None] >> np.arange(voters)) & 1).astype(float)
    prior = 0.1
    # Lexicons are taken to be better than chance; patterns may turn out either way.
    fires = np.array([[0.05] * voters, [0.6] * voters])
    fires[:, -2:] = [[0.1, 0.1], [0.12, 0.12]]
    weights = np.ones(voters)
    correlations = np.zeros((2, voters, voters))
    posterior = np.zeros(len(masks))
    for _ in range(rounds):
        for _ in range(60):
            likely = votes @ (weights * np.log(fires)).T + (1 - votes) @ (weights * np.log1p(-fires)).T
            odds = likely[:, 1] - likely[:, 0] + np.log(prior / (1 - prior))
            posterior = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
            by_class = np.stack([n * (1 - posterior), n * posterior])
            total = by_class.sum(axis=1, keepdims=True)
            fires = np.clip((by_class @ votes + 0.5) / (total + 1), 1e-4, 1 - 1e-4)
            prior = float(np.clip(total[1, 0] / n.sum(), 1e-3, 0.5))
        for y in (0, 1):
            apart = votes - fires[y]
            spread = (by_class[y][:, None] * apart).T @ apart / max(total[y, 0], 1e-9)
            scale = np.sqrt(np.maximum(np.diag(spread), LEAST_SPREAD))
            correlations[y] = spread / np.outer(scale, scale)
        strength = np.clip(np.abs(correlations).max(axis=0), 0, 1)
        np.fill_diagonal(strength, 0)
        weights = np.maximum(1 / (1 + np.where(strength > 0.1, strength, 0).sum(axis=1)), LEAST_WEIGHT)
    return LabelModel(dict(zip(masks.tolist(), posterior)), counts, prior, fires, correlations, weights)


class Linear(NamedTuple):
    ids: np.ndarray  # ascending
    weights: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        known, width = Known(self.ids), max(len(self.ids), 1)
        out = np.zeros(len(texts))
        for first, f in features(texts):
            n = len(f.n_words)
            pairs = []
            for ids, of in zip(f.ids, f.of):
                at, place = known.find(ids)
                pairs.append(of[at] * width + place)
            present = np.unique(np.concatenate(pairs))  # a feature counts once a text
            weight = self.weights[present % width] if len(present) else np.zeros(0)
            total = np.bincount(present // width, weight, minlength=n)
            out[first : first + n] = 1 / (1 + np.exp(-np.clip(total + self.bias, -40, 40)))
        let_go()
        return out


def train_linear(seen: Counted, target: np.ndarray, steps: int = 200, ridge: float = 2e-4) -> Linear:
    """Logistic regression on soft targets, over the features that tell most."""
    mean = float(target.mean()) if len(target) else 0.0
    every, toxic = seen.sums(np.ones(len(target))), seen.sums(target)
    gain = np.abs(toxic - mean * every) / np.sqrt(every + 1)
    gain[every < max(LEAST_TEXTS, LEAST_SHARE * target.sum())] = 0
    best = np.argsort(-gain, kind="stable")[:FEATURES]
    chosen = np.sort(best[gain[best] > LEAST_GAIN])
    n, d = len(target), len(chosen)
    if not n or not d:
        return Linear(np.zeros(0, np.uint32), np.zeros(0), float(np.log(0.01)))
    place = np.full(len(seen.ids), -1, np.int64)
    place[chosen] = np.arange(d)
    kept = place[seen.column] >= 0
    row, column = seen.row[kept], place[seen.column[kept]]
    weight, bias = np.zeros(d), float(np.log((mean + 1e-3) / (1 - mean + 1e-3)))
    m, v = np.zeros(d + 1), np.zeros(d + 1)
    for step in range(1, steps + 1):
        z = np.bincount(row, weight[column], minlength=n) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - target) / n
        slope = np.append(np.bincount(column, error[row], minlength=d) + ridge * weight, error.sum())
        m = 0.9 * m + 0.1 * slope
        v = 0.99 * v + 0.01 * slope**2
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        weight -= move[:-1]
        bias -= move[-1]
    return Linear(seen.ids[chosen], weight, float(bias))


# --- on Spark -----------------------------------------------------------------


def is_held_out() -> Column:
    return id_remainder("doc_id", HELD_OUT_DIVISOR) == HELD_OUT_REMAINDER


def training_labels(labels: DataFrame, column: str, held_out: Column, limit: int) -> DataFrame:
    """doc_id and label of at most ``limit`` labelled rows that are not held out."""
    known = labels.select("doc_id", F.col(column).cast("int").alias("label"))
    known = known.filter(~held_out & F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    return bounded_sample(known, limit, "doc_id")


def distinct_features(texts: pa.Array) -> pa.Array:
    """The distinct features of each text, as 32-bit numbers."""
    out = []
    for _, f in features(texts):
        n = len(f.n_words)
        both = [(of.astype(np.uint64) << np.uint64(32)) | ids for ids, of in zip(f.ids, f.of)]
        present = np.unique(np.concatenate(both))
        at = np.searchsorted(present, np.arange(n + 1).astype(np.uint64) << np.uint64(32))
        low = (present & np.uint64(0xFFFFFFFF)).astype("<u4")
        out.extend(low[at[k] : at[k + 1]].tobytes() for k in range(n))
    let_go()
    return pa.array(out, pa.binary())


class ToxicityModel(NamedTuple):
    label_model: LabelModel
    linear: Linear

    def column(self, text: Column) -> Column:
        linear = self.linear

        @F.arrow_udf("double")
        def score(texts: pa.Array) -> pa.Array:
            return pa.array(linear.scores(texts))

        return score(text)


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS) -> ToxicityModel:
    chosen = training_labels(labels, "toxic", is_held_out(), limit)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    read = F.arrow_udf(distinct_features, "binary")
    row = [F.col("doc_id"), F.xxhash64("text").alias("text_hash")]
    rows = texts.select(*row, "label", read("text").alias("ids")).collect()
    toxic = np.array([r.label for r in rows], np.int64)
    seen = counted([np.frombuffer(r.ids, "<u4") for r in rows])
    keys = [(r.doc_id, r.text_hash) for r in rows]
    del rows
    voting = Voting(induce(seen, toxic))

    @F.arrow_udf("long")
    def vote(batch: pa.Array) -> pa.Array:
        return pa.array(voting.masks(batch))

    masks = docs.select(vote("text").alias("mask")).groupBy("mask").count().collect()
    model = fit_label_model({r["mask"]: r["count"] for r in masks})
    own = {(r.doc_id, r.text_hash): r.mask for r in texts.select(*row, vote("text").alias("mask")).collect()}
    target = model.of(np.array([own[k] for k in keys], np.int64))
    return ToxicityModel(model, train_linear(seen, target))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``."""
    model = fit(docs, labels)
    scored = docs.select("doc_id", model.column(F.col("text")).alias("score"))
    return scored.select(
        "doc_id",
        is_held_out().alias("held_out"),
        "score",
        (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with its columns, rejected documents left out."""
    score = fit(docs, labels).column(F.col("text"))
    return docs.filter(score < PREDICT_AT)
