import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from triplake.llm import components, mixing, ngram_join, quality_classifier, toxicity
from triplake.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def near_copies(seed, groups=12):
    pick = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = [f"w{pick.randint(0, 300)}" for _ in range(pick.randint(3, 90))]
        texts.append(" ".join(base))
        for _ in range(pick.randint(0, 6)):
            copy = list(base)
            for _ in range(pick.randint(0, 3)):
                copy[pick.randrange(len(copy))] = f"x{pick.randint(0, 9)}"
            texts.append("  ".join(copy))
    return texts + ["", None, " ", "one", "one", "one two"]


def brute(texts, n=5, threshold=0.8):
    sets = []
    for text in texts:
        words = (text or "").split()
        sets.append({tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set())
    near = defaultdict(set)
    for a in range(len(sets)):
        for b in range(a):
            both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if both >= threshold * either - 1e-9:
                near[a].add(b)
                near[b].add(a)
    root = {}
    for a in range(len(sets)):
        if a in root:
            continue
        todo = [a]
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = a
                todo += near[x]
    return {a + 1: (root[a] + 1, len(near[a])) for a in range(len(sets))}


@pytest.mark.parametrize("block", [512, 2])
def test_links_are_those_of_brute_force(docs, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", block)
    texts = near_copies(11)
    found = ngram_join.linked_documents(docs(*texts)).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in found} == brute(texts)


def test_one_of_each_group_stays_with_its_columns(spark, docs):
    texts = near_copies(12)
    rows = docs(*texts).withColumn("row", F.lit(1)).withColumn("text_hash", F.lit("clash"))
    kept = ngram_join.one_of_each(rows.union(rows))
    assert kept.columns == rows.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for c, _ in brute(texts).values()})
    assert ngram_join.one_of_each(docs()).count() == 0


def test_bands_reach_the_recall():
    bands = ngram_join.choose_bands()
    assert bands.recall(ngram_join.THRESHOLD) >= ngram_join.RECALL
    assert bands.bands * bands.rows <= ngram_join.MOST_HASHES


def test_components_of_chains_and_stars(spark):
    pick = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    pick.shuffle(edges)
    found = components.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.root for r in found} == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


def test_similar_counts_shared_weights():
    pick = np.random.default_rng(9)
    base = pick.integers(0, 1 << 60, 400).astype(np.uint64)
    sets = [np.unique(np.append(base[k:], base[:1])) for k in range(0, 300, 9)]
    for threshold in (0.3, 0.8):
        near = ngram_join.similar(sets, threshold)
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                both = len(np.intersect1d(x, y))
                assert near[a, b] == (a != b and both >= threshold * (len(x) + len(y) - both) - 1e-9)


def labelled_corpus(docs, labels, n=240):
    pick = random.Random(4)
    texts, rows = [], []
    for i in range(1, n + 1):
        words = [f"{pick.choice('abcdefg')}{pick.choice('hijkl')}en" for _ in range(pick.randint(20, 60))]
        toxic, junk = i % 6 == 0, i % 6 == 3
        if toxic:
            for _ in range(4):
                words.insert(pick.randrange(len(words)), pick.choice(["zorgil", "zorgat", "idiot"]))
        texts.append(" ".join(w + "***" if junk else w for w in words))
        rows.append((i, int(not junk), int(toxic)))
    return docs(*texts, None, ""), labels(*rows, (1, 1, 0), (None, 1, 1), (5, None, None))


def test_toxicity_is_learned_from_rows_that_are_not_held_out(docs, labels):
    rows, marks = labelled_corpus(docs, labels)
    scored = toxicity.toxicity_scores(rows, marks).join(marks.dropDuplicates(["doc_id"]), "doc_id", "left").collect()
    assert len(scored) == 242
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scored)
    judged = [r for r in scored if r.held_out and r.toxic is not None]
    assert all(r.predicted == 0 for r in judged if not r.toxic)
    assert sum(r.predicted for r in judged) >= 0.8 * sum(r.toxic for r in judged) > 0
    kept = toxicity.without_toxic(rows, marks)
    assert kept.columns == rows.columns
    assert kept.count() == sum(r.predicted == 0 for r in scored)


def test_training_rows_are_taught_by_their_own_votes(docs, labels, monkeypatch):
    rows, marks = labelled_corpus(docs, labels)
    rows = rows.withColumn("text", F.when(F.col("doc_id") % 5 == 0, F.upper("text")).otherwise(F.col("text")))
    found, induce, train = {}, toxicity.induce, toxicity.train_linear
    monkeypatch.setattr(toxicity, "induce", lambda *a: found.setdefault("lexicons", induce(*a)))
    monkeypatch.setattr(toxicity, "train_linear", lambda seen, target: train(seen, found.setdefault("target", target)))
    model = toxicity.fit(rows, marks)
    chosen = toxicity.training_labels(marks, "toxic", toxicity.is_held_out(), toxicity.TRAINING_ROWS)
    texts = pa.array([r.text for r in rows.join(chosen, "doc_id").collect()], pa.string())
    masks = toxicity.Voting(found["lexicons"]).masks(texts)
    assert len({int(m) >> 5 for m in masks}) > 2
    assert sorted(found["target"]) == pytest.approx(sorted(model.label_model.of(masks)))


def test_models_without_labels_or_rows(docs, labels):
    nothing = labels().filter("false")
    scores = toxicity.toxicity_scores(docs("you idiot", None, ""), nothing).collect()
    assert len(scores) == 3 and all(r.predicted == 0 for r in scores[1:])
    assert toxicity.toxicity_scores(docs(), nothing).count() == 0
    assert len({r.score for r in quality_classifier.quality_scores(docs("a", None), nothing).collect()}) == 1
    assert quality_classifier.quality_scores(docs(), nothing).count() == 0
    assert mixing.document_rates(docs("a b", None), nothing).count() == 2
    assert mixing.document_rates(docs(), nothing).count() == 0


def test_label_model_finds_the_classes_without_labels():
    pick = np.random.default_rng(2)
    truth = pick.random(20000) < 0.2
    good = [np.where(truth, pick.random(20000) < 0.8, pick.random(20000) < 0.05) for _ in range(3)]
    votes = [*good, *(pick.random((5, 20000)) < 0.1)]
    masks = sum(v.astype(int) << i for i, v in enumerate(votes))
    values, counts = np.unique(masks, return_counts=True)
    model = toxicity.fit_label_model(dict(zip(values.tolist(), counts.tolist())))
    assert model.prior == pytest.approx(0.2, abs=0.05)
    assert ((model.of(masks) > 0.5) == truth).mean() > 0.9
    assert (model.fires[1, :3] > 0.7).all() and (model.fires[0, :3] < 0.15).all()


def test_quality_is_learned_and_calibrated(docs, labels):
    rows, marks = labelled_corpus(docs, labels)
    scored = quality_classifier.quality_scores(rows, marks).join(marks.dropDuplicates(["doc_id"]), "doc_id", "left").collect()
    judged = [r for r in scored if r.held_out and r.quality is not None]
    assert judged and all(r.predicted == r.quality for r in judged)
    assert all(0 <= r.score <= 1 for r in scored)


def test_rates_meet_the_targets_and_keep_the_protected(docs, labels):
    rows, marks = labelled_corpus(docs, labels)
    rated = mixing.document_rates(rows, marks)
    assert rated.count() == 242
    sums = rated.agg(*(F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p_{d}")) for d in mixing.DOMAINS)).first()
    shares = [s / sum(sums) for s in sums]
    assert shares[0] > 0.85
    found = rated.join(marks.dropDuplicates(["doc_id"]), "doc_id").filter("quality = 1 and toxic = 0")
    assert found.filter("rate < 0.99 and p_clean >= 0.5").count() == 0
    kept = mixing.mixed(rows.withColumn("rate", F.lit("clash")), marks)
    assert kept.columns[-1] == "rate" and kept.count() == rated.agg(F.sum("copies")).first()[0]


def rated_shares(spark, shares, hard, n=2000):
    pick = np.random.default_rng(5)
    truth = np.eye(3)[pick.choice(3, n, p=shares)]
    soft = np.exp(10 * truth + pick.normal(0, 1.5, (n, 3)))
    p = truth if hard else soft / soft.sum(axis=1, keepdims=True)
    rows = [(int(k), *map(float, x)) for k, x in zip(pick.integers(5, 500, n), p)]
    rows = spark.createDataFrame(rows, "n_tokens long, p_clean double, p_junk double, p_toxic double").coalesce(1).cache()
    rates = mixing.fit_rates(rows)
    rated = rows.withColumn("rate", rates.column())
    sums = np.array(rated.agg(*(F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p_{d}")) for d in mixing.DOMAINS)).first())
    assert rated.filter("rate < 0 or rate > 1 or (p_clean >= 0.5 and rate < 1)").count() == 0
    assert sums == pytest.approx(rates.totals)
    return rates, sums / sums.sum()


@pytest.mark.parametrize("hard", [True, False])
@pytest.mark.parametrize("shares", [(0.62, 0.37, 0.01), (0.4, 0.59, 0.01), (0.25, 0.74, 0.01)])
def test_rates_reach_the_targets_on_skewed_input(spark, shares, hard):
    rates, reached = rated_shares(spark, shares, hard)
    assert rates.met and reached == pytest.approx([mixing.TARGETS[d] for d in mixing.DOMAINS], rel=3e-3)


def test_targets_out_of_reach_are_reported(spark):
    with pytest.warns(UserWarning, match="toxic 0 of"):
        rates, reached = rated_shares(spark, (0.6, 0.4, 0.0), True)
    assert not rates.met and rates.gap <= mixing.NEAREST
    assert reached[1] / reached[0] == pytest.approx(0.04 / 0.95, rel=3e-3)


def test_pipeline_hands_documents_on(spark):
    docs = table(spark, SF_DIR, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_jaccard_join", "secret_scan", "mixing", "bpe_encoding"]
    rows = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, rows = rows.count(), stage(spark, rows, SF_DIR).persist()
        assert rows.columns == docs.columns and 0 < rows.count() <= before
    assert corpus_pipeline.run(spark, SF_DIR).count() == rows.count()
