import hashlib
import math
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from triplake.llm import quality_rules, secret_scan, spotsigs, url_templates

KEY = "q7Rk2ZpL9vXw3TbN8sYd5FgH1jMc4"


def test_base_spans_follow_the_patterns():
    text = f"Token='abcdef' password: abc api_key=xyz123. AKIA{'A' * 16} {'0a' * 12} ſecret=abcdef secret=token =abcdef"
    kinds = Counter(k for _, _, k in secret_scan.base_spans(text))
    assert kinds == {"assign": 2, "access": 1, "hex": 1}


def test_windows_have_the_entropy_of_their_characters():
    run = "aab0c" * 7 + "zzzzzz"
    for start, bits in secret_scan.window_entropies(run, 10):
        counts = Counter(run[start : start + 10]).values()
        assert bits == pytest.approx(-sum(c / 10 * math.log2(c / 10) for c in counts))


def test_entropy_finds_keys_and_leaves_words_alone():
    assert secret_scan.entropy_spans(f"see {KEY} there") != []
    for clean in ("of" * 40, "2024-01-02/2024-01-03/2024", "a/long/path/with/many/parts/v12", "", "1" * 60):
        assert secret_scan.entropy_spans(clean) == []
    allow = (*secret_scan.ALLOWED, re.compile(KEY))
    assert secret_scan.entropy_spans(KEY, allow) == []


@pytest.mark.parametrize("key", ["qRkZpL9vXwTbNsYdFgHjMc", "qRk2pLvXwTbN8sYdFgHjMc", "aB/dEfGh7jKlMnOpQrStUvWx+zAbCdEfGhIjKlMn"])
def test_keys_of_few_digits_are_measured(key):
    assert secret_scan.entropy_spans(f"see {key} there") == [(4, 4 + len(key), "entropy")]
    assert secret_scan.redact(f"see {key} there", "[x]") == "see [x] there"
    # Without any digit it counts as a word, as the allow list says.
    assert secret_scan.entropy_spans(re.sub("[0-9]", "x", key)) == []


def test_tokens_that_a_pattern_covers_in_part_are_masked_whole():
    access = "AKIA" + "QWERTYUIOPASDFGH"
    for token in (f"{access}/{KEY}wJalrXUtn9F", f"{KEY}_{'0a1b2c3d4e5f' * 2}_{KEY}"):
        base, spans = secret_scan.find_secrets(f"see {token} there")
        assert len(base) == 1 and {k for _, _, k in spans} == {base[0][2], "entropy"}
        assert secret_scan.redact(f"see {token} there", "[x]") == "see [x] there"
    base, spans = secret_scan.find_secrets(f"password={KEY}")
    assert base == spans


def test_masking_leaves_no_secret_and_keeps_the_rest(docs):
    rows = secret_scan.redact_secrets(docs(f"a password=hunter22 b {KEY} c", None, "", "plain"), "[x]").collect()
    assert [r.text for r in rows] == ["a [x] b [x] c", None, "", "plain"]
    assert [r.n_chars for r in rows] == [13, None, 0, 5]


def test_scan_of_nulls_and_of_nothing(docs):
    rows = secret_scan.scan_secrets(docs(None, "", "x" * 100_000)).collect()
    assert [(r.n_assign, r.spans) for r in rows] == [(0, "")] * 3
    assert secret_scan.scan_secrets(docs()).count() == 0


def measured(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


TEXTS = [
    None, "", " \n\t", "a b c", "a a a a a a", "a a a a a a a", "x y z w v x y z w v", "one\n\none\n one\n\u00a0\n\u00a0",
    "# * $ é ß 👍 | <>", "a b c d e f a b c d e f g a b c d e", "w " * 400 + "tail", "\x1c a\x85b \u2003",
]


def test_measurements_are_exact(docs):
    rows = {r.doc_id: r for r in quality_rules.judged_documents(docs(*TEXTS)).collect()}
    for i, text in enumerate(TEXTS, 1):
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == measured(text), text
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality_rules.judged_documents(docs()).count() == 0


def test_policies_and_ablations_come_from_the_masks(spark):
    rows = spark.createDataFrame([(0,), (0,), (1,), (3,), (4,), (5,)], "failed long")
    found = {(r.policy, r.rule): r[2:] for r in quality_rules.ablations(rows).collect()}
    assert found["base", "few_words"] == (6, 3, 3, 2)
    assert found["base", "repeated_words"] == (6, 3, 1, 0)
    assert found["v1", "symbols"] == (6, 4, 2, 1)
    assert [r.name for r in quality_rules.rules()] == list(quality_rules.RULE_NAMES)


def test_edited_texts_take_from_the_next_document(docs):
    texts = ["the cat sat", "a", None, "👍👍 of the big red dog", "of the big red dog and so on"]
    rows = {r.doc_id: r for r in spotsigs.fingerprints(docs(*texts)).collect()}
    order = [(i + 1, t or "") for i, t in enumerate(texts)][::-1]
    for k, (i, text) in enumerate(order):
        half, following = len(text) // 2, order[(k + 1) % len(order)][1]
        edited = text[: len(text) - half] + following[:half]
        assert rows[i].n_chars == len(text)
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert spotsigs.fingerprints(docs()).count() == 0
    assert spotsigs.fingerprints(docs("same")).first().near_next == 1.0


def brute_signs(text):
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text.lower()) if w]
    found = set()
    for i, w in enumerate(words):
        rest = [x for x in words[i + 1 :] if x not in spotsigs.ANCHORS][: spotsigs.CHAIN]
        if w in spotsigs.ANCHORS and len(rest) == spotsigs.CHAIN:
            found.add((w, *rest))
    return found or {text}


def test_likeness_is_that_of_the_signature_sets(docs):
    texts = ["the big dog and the red cat of a town", "the big dog and the blue cat of a town", "none here", "", ""]
    rows = {r.doc_id: r for r in spotsigs.fingerprints(docs(*texts)).collect()}
    for i in range(len(texts), 1, -1):
        a, b = brute_signs(texts[i - 1]), brute_signs(texts[i - 2])
        assert rows[i].near_next == pytest.approx(len(a & b) / len(a | b))
    assert rows[4].fingerprint == rows[5].fingerprint


def test_pruning_only_skips_pairs_that_cannot_reach_the_threshold(spark):
    df = spark.range(1, 60).select(F.sequence(F.lit(1), F.col("id")).alias("a"), F.sequence(F.lit(1), F.lit(30)).alias("b"))
    for r in df.select(F.size("a"), spotsigs.pruned_jaccard(F.col("a"), F.col("b"), 0.6)).collect():
        exact = min(r[0], 30) / max(r[0], 30)
        assert r[1] == pytest.approx(exact if exact >= 0.6 else 0.0)


URLS = [
    "http://A.example.ORG/es/1?x", "http://example.org/en/12", "https://example.orgx/es/1", "x://sub.b.com/fr/9#t",
    "http://com/de/1", "no scheme", None, "http://h.net", "http://h.net?q=/a", "s://org/", "http://q.com://x/fr/",
]


def test_rules_and_parts_of_urls(spark, labels):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    bad = spark.createDataFrame([(0, True)], "id long, bad boolean")
    rows = {r.page_id: r for r in url_templates.judged_pages(pages, bad).collect()}
    got = [(rows[i].host, rows[i].path, rows[i].rule) for i in range(len(URLS))]
    assert got == [
        ("a.example.org", "/es/1", "example.org/es/"),
        ("example.org", "/en/12", "example.org/en/1"),
        ("example.orgx", "/es/1", None),
        ("sub.b.com", "/fr/9", "com/fr/"),
        ("com", "/de/1", "com/de/"),
        ("", "", None),
        ("", "", None),
        ("h.net", "", None),
        ("h.net", "", None),
        ("org", "/", "org/"),
        ("q.com:", "//x/fr/", None),
    ]
    assert rows[0].verdict == "block" and rows[3].verdict == "allow"
    assert url_templates.judged_pages(pages.limit(0), bad).count() == 0


def test_bad_branches_are_rejected_and_ids_become_wildcards(spark):
    urls = [f"http://h.net/shop/{i}/x" for i in range(200)] + [f"http://h.net/junk/{i}/x" for i in range(200)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    bad = spark.createDataFrame([(i, i >= 200) for i in range(0, 400, 2)], "id long, bad boolean")
    rows = url_templates.judged_pages(pages, bad).groupBy("template", "verdict").count().collect()
    assert {tuple(r) for r in rows} == {("/shop/*/x", "allow", 200), ("/junk/*/x", "block", 200)}


def test_many_sections_of_equal_size_are_tested_one_by_one(spark):
    urls = [f"http://h.net/s{i % 80}/p" for i in range(1600)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    bad = spark.createDataFrame([(i, i % 80 < 4) for i in range(1600)], "id long, bad boolean")
    rows = url_templates.judged_pages(pages, bad).groupBy("path", "verdict").count().collect()
    assert {tuple(r) for r in rows} == {(f"/s{i}/p", "block" if i < 4 else "allow", 20) for i in range(80)}


def test_paths_are_told_apart_at_any_depth(spark):
    urls = [f"http://h.net/{'d/' * 11}{'junk' if i < 100 else 'shop'}/x" for i in range(200)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    bad = spark.createDataFrame([(i, i < 100) for i in range(200)], "id long, bad boolean")
    rows = url_templates.judged_pages(pages, bad).collect()
    assert all(r.template == r.path for r in rows)
    assert {r.page_id for r in rows if r.verdict == "block"} == set(range(100))


HOSTILE = (
    "a" + "-" * 100_000 + "12345xx",
    "total" + "=" * 100_000 + "20231105",
    "a_" * 50_000 + "12345x",
    "token" * 20_000,
    "token" + " " * 100_000 + "x",
    "secret=" * 20_000,
)


@pytest.mark.parametrize("text", HOSTILE, ids=range(len(HOSTILE)))
def test_long_runs_of_separators_are_read_once(text):
    began = time.process_time()
    secret_scan.find_secrets(text)
    assert time.process_time() - began < 1


def plain_base(text):
    """The three patterns as the task words them; short matches are dropped afterwards."""
    assign = r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    found = [(*m.span(), 0) for m in re.finditer(assign, text, re.I | re.A) if len(m[1]) >= 6]
    found += [(*m.span(), 1) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(*m.span(), 2) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted((s, k, e) for s, e, k in found)


def test_query_columns_against_plain_patterns(spark, docs):
    rng = random.Random(4)
    bits = ["password", "Token", "api_key", "API KEY", "apikey", ":", "=", " ", "'", '"', "AKIA", "ABCD1234" * 3, "0a" * 13]
    bits += ["x/y", "é", "\n", "abc", "secret=", "hunter22", "z" * 40, "-" * 30, "K\u017f", "pa\u017fsword=abcdefgh"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(40))) for _ in range(400)] + ["", None, *HOSTILE]
    rows = secret_scan.scan_secrets(docs(*texts)).collect()
    for text, row in zip(texts, sorted(rows, key=lambda r: r.doc_id)):
        base = plain_base(text or "")
        names = ("assign", "access", "hex")
        written = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in base)
        assert row.base == written
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(k == n for _, k, _ in base) for n in range(3)]
        assert set(written.split(",")) - {""} <= set(row.spans.split(","))
