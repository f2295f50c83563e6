"""Conversation repair, circulant MinHash and Merkle manifest against plain versions."""

import hashlib
import itertools
import os
import random
import re
import zlib
from pathlib import Path

import numpy as np
import oracle
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from triplake.llm import circulant_minhash as dedup
from triplake.llm import conversation_repair as repair
from triplake.llm import merkle_manifest as merkle
from triplake.llm.common import join_counted, small_side
from triplake.llm.components import components
from triplake.llm.oracles import ORACLES
from triplake.llm.queries import QUERIES

SF_DIR = os.environ.get("TRIPLAKE_SF_DIR", "/root/testdata/sf0.001")
CONV = "conv_id long, turn long, role string, text string"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def by_nulls(row):
    return tuple((v is not None, v) for v in row)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=by_nulls)


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="tables not here")
@pytest.mark.parametrize("name", ORACLES)
def test_query_gives_what_its_sql_gives(spark, name):
    assert oracle.difference(QUERIES[name](spark, SF_DIR), oracle.connect(SF_DIR), ORACLES[name]) == ""


# --- conversation repair -----------------------------------------------------

PATTERN = re.compile("(s?(ua)+)?")


def all_repairs(signature, most_inserts=3):
    """(cost, audit) of every way, found by trying all edits; short signatures only."""
    rows = [signature[i : i + 2] for i in range(0, len(signature), 2)]
    found = []

    def go(i, roles, cost, audit, inserted):
        if i == len(rows) and PATTERN.fullmatch(roles):
            found.append((cost, audit))
        if inserted < most_inserts:
            for role in "ua":
                go(i, roles + role, cost + 3, audit + "I", inserted + 1)
        if i == len(rows):
            return
        initial, fault = rows[i]
        go(i + 1, roles, cost + 4, audit + "D", inserted)
        if fault not in "bd":
            more = 3 if fault == "t" else 0
            go(i + 1, roles + initial, cost + more, audit + "K", inserted)
            for role in "ua":
                go(i + 1, roles + role, cost + 3 + more, audit + "R", inserted)

    go(0, "", 0, "", 0)
    return found


def test_search_finds_the_least_of_all_ways():
    rng = random.Random(5)
    rows = [i + f for i in "sua-" for f in ".bt"]
    signatures = ["".join(p) for n in range(3) for p in itertools.product(rows, repeat=n)]
    signatures += ["".join(rng.choices(rows, k=4)) for _ in range(60)]
    for signature in signatures:
        assert repair.search(repair.Rows(signature)) == min(all_repairs(signature)), signature


def test_blocks_give_what_the_whole_gives():
    rng = random.Random(6)
    for _ in range(200):
        rows = ["".join((rng.choice("suauaua-"), rng.choice("....bdt"))) for _ in range(rng.randrange(1, 14))]
        size = rng.randrange(1, 5)
        cut = [rows[i : i + size] for i in range(0, len(rows), size)]
        arcs = []
        for block in cut:
            lattice = repair.Rows("".join(block))
            ways = {(a, b): repair.search(lattice, a, [b]) for a in repair.STATES for b in repair.STATES}
            arcs.append({k: w for k, w in ways.items() if w})
        cost, audit = repair.search(repair.Blocks(arcs))
        assert (cost, audit) == repair.search(repair.Rows("".join(rows)))
        assert "".join(p for _, p in repair.pieces(audit, [len(b) for b in cut])) == audit


def damage(conv_id, turn, role, text):
    conv, at, role, text = (" " if v is None else str(v) for v in (conv_id, turn, role, text))
    what = zlib.crc32(f"{conv}:{at}".encode()) % 20
    text = {1: "", 2: re.sub("[.!?]", "", text)}.get(what, text)
    return [(turn, "user" if what == 4 else role, text)] * {0: 0, 3: 2}.get(what, 1)


def plain_repair(rows):
    """One conversation's result, its id left out, by dynamic programming row by row."""
    rows = [r for row in rows for r in damage(*row)]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
    seen, signs = set(), []
    for _, role, text in rows:
        visible = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "." if visible and visible[-1] in ".!?" else "t"
        fault = "b" if not visible else "d" if (role, text) in seen else fault
        seen.add((role, text))
        signs.append(role[:1] + fault)
    best = {0: (0, "")}

    def inserted():
        for _ in range(4):
            for state, (cost, audit) in list(best.items()):
                for given, target in repair.STEPS[state].items():
                    if given in "ua":
                        best[target] = min(best.get(target, (10**9, "")), (cost + 3, audit + "I"))

    inserted()
    for sign in signs:
        ways = {}
        for state, (cost, audit) in best.items():
            moves = [(state, cost + 4, "D")]
            if sign[-1] not in "bd":
                more = 3 if sign[-1] == "t" else 0
                for given, target in repair.STEPS[state].items():
                    moves += [(target, cost + more, "K")] * (given == sign[:-1])
                    moves += [(target, cost + 3 + more, "R")] * (given in "ua")
            for target, paid, edit in moves:
                ways[target] = min(ways.get(target, (10**9, "")), (paid, audit + edit))
        best = ways
        inserted()
    cost, audit = min(best[s] for s in (0, 3) if s in best)
    left, lines = iter(rows), []
    length = sum(e != "D" for e in audit)
    for edit in audit:
        row = (None, "", "") if edit == "I" else next(left)
        if edit != "D":
            k = len(lines) - length % 2
            role = row[1] if edit == "K" else ("assistant" if k % 2 else "user")
            lines.append(f"{role}:{row[2]}")
    turns = [t for t, _, _ in rows if t is not None]
    faults = [s[-1] for s in signs]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        faults.count("b"),
        faults.count("d"),
        faults.count("t"),
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost,
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def plain_repairs(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    return sorted(((k, *plain_repair(v)) for k, v in groups.items()), key=by_nulls)


def odd_conversations():
    rng = random.Random(7)
    texts = ["Yes.", "Yes.", "No", " \t ", "", None, "Why?\n", "é!", "x" * 50_000, "a.b"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, ""]
    rows = [
        (conv, turn if rng.random() < 0.9 else rng.choice([None, turn - 1, 2**40]), rng.choice(roles), rng.choice(texts))
        for conv in [*range(40), None]
        for turn in range(rng.randrange(1, 9))
    ]
    return rows + rows[::5]


@pytest.mark.parametrize("sizes", [(), (4, 3), (1, 1)])
def test_odd_conversations_short_and_long(spark, sizes):
    rows = odd_conversations()
    df = spark.createDataFrame(rows, CONV)
    assert rows_of(repair.repaired_conversations(df, *sizes)) == plain_repairs(rows)


def test_one_conversation_with_most_rows(spark):
    rng = random.Random(8)
    rows = [(7, t // 2, rng.choice(["user", "assistant"]), rng.choice(["a.", "b.", "c", f"{t}."])) for t in range(3000)]
    rows += [(8, 0, "user", "Hi."), (8, 1, "assistant", "Hi!")]
    df = spark.createDataFrame(rows, CONV)
    assert rows_of(repair.repaired_conversations(df, 100, 64)) == plain_repairs(rows)


def test_no_conversations_and_other_columns(spark):
    df = spark.createDataFrame([], CONV)
    assert repair.repaired_conversations(df).collect() == []
    rows = odd_conversations()[:20]
    more = spark.createDataFrame(rows, CONV).withColumns(
        {n: F.lit(1) for n in ("n", "damage", "sign", "copy", "place", "limit", "text_key")}
    )
    assert rows_of(repair.repaired_conversations(more, 2, 2)) == plain_repairs(rows)


# --- circulant MinHash -------------------------------------------------------


def plain_components(docs):
    lower = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    sets = []
    for row in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (row[1] or "").translate(lower))
        windows = [tuple(words[i : i + 4]) for i in range(len(words) - 3)]
        sets.append(frozenset(windows if len(words) >= 4 else [tuple(words)] if words else []))
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(docs)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            root[find(j)] = find(i)
    least = {}
    for i, row in enumerate(docs):
        ids = [v for v in (row[0], least.get(find(i))) if v is not None]
        least[find(i)] = min(ids, default=None)
    out = [(r[0], len(s), least[find(i)], r[0] == least[find(i)]) for i, (r, s) in enumerate(zip(docs, sets))]
    return sorted(out, key=by_nulls)


def some_documents(n=60):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(n):
        base = rng.choices(words, k=rng.choice([5, 40, 200, 600]))
        for _ in range(rng.choice([1, 1, 2, 5])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 4, 9])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            docs.append(" ".join(copy))
    docs += ["", None, " \n ", "one", "ONE", "one two", "one two three", "one two three four", "ONE\ttwo three\x0bfour"]
    docs += ["É a b c d", "é a b c d", "x " * 30_000, docs[0], docs[0].upper()]
    return [(100 - i if i % 17 else None, t, None, None, None) for i, t in enumerate(docs)] + [(3, "one", None, None, 1)]


def test_components_are_those_of_all_pairs(spark):
    docs = some_documents()
    assert rows_of(dedup.deduplicated(spark.createDataFrame(docs, DOC))) == plain_components(docs)


def test_small_blocks_give_the_same(spark, monkeypatch):
    docs = some_documents(30)
    monkeypatch.setattr(dedup, "BUCKET", 2)
    monkeypatch.setattr(dedup, "BLOCK_SETS", 2)
    assert rows_of(dedup.deduplicated(spark.createDataFrame(docs, DOC))) == plain_components(docs)


def test_a_chain_is_one_component(spark):
    """Each text shares four fifths with the next, the ends share nothing."""
    words = [f"w{i}" for i in range(400)]
    docs = [(200 - i, " ".join(words[8 * i : 8 * i + 100]), None, None, None) for i in range(36)]
    rows = dedup.deduplicated(spark.createDataFrame(docs, DOC)).collect()
    assert {r.component_id for r in rows} == {165} and sum(r.kept for r in rows) == 1


def test_no_documents_and_other_columns(spark):
    assert dedup.deduplicated(spark.createDataFrame([], DOC)).collect() == []
    docs = some_documents(10)
    more = spark.createDataFrame(docs, DOC).withColumns(
        {n: F.lit("x") for n in ("set_key", "n", "bands", "text_hash", "root", "a", "b", "band")}
    )
    assert rows_of(dedup.deduplicated(more)) == plain_components(docs)


def test_recall_of_bands_and_signatures():
    bands, rows = dedup.BANDS, dedup.ROWS
    assert 1 - (1 - 0.8**rows) ** bands >= dedup.RECALL and bands * rows <= dedup.MOST_COORDINATES
    rng = random.Random(10)
    equal = []
    for _ in range(40):
        a = pa.array([" ".join(f"{rng.random()}" for _ in range(300))])
        grams = next(dedup.gram_sets(a))
        other = next(dedup.gram_sets(pa.array([" ".join(f"{rng.random()}" for _ in range(300))])))
        shared = grams[: len(grams) * 8 // 9]
        near = [grams, np.sort(np.concatenate([shared, other[:33]]))]
        signed = dedup.signatures(near)
        assert (signed[0] == dedup.signature(grams)).all()
        equal.append((signed[0] == signed[1]).mean())
    assert abs(sum(equal) / len(equal) - 0.8) < 0.03
    assert min(equal) > dedup.plausible(0.8, dedup.COORDINATES)


def test_components_of_stars_and_chains(spark):
    edges = [(0, i) for i in range(1, 3000)] + [(i, i + 1) for i in range(5000, 5300)] + [(None, 1), (9999, 9999)]
    found = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert found == {i: 0 for i in range(3000)} | {i: 5000 for i in range(5000, 5301)}


def test_join_with_frequent_keys(spark):
    rows = spark.createDataFrame([(1, i) for i in range(5000)] + [(k, k) for k in range(2, 900)] + [(None, 0)], "k long, x long")
    lookup = spark.createDataFrame([(1, 5000, "a")] + [(k, 1, "b") for k in range(2, 800)], "k long, n long, y string")
    joined = join_counted(rows, lookup, "k")
    assert rows_of(joined.select("k", "x", "y")) == rows_of(rows.join(lookup, "k").select("k", "x", "y"))
    assert "BROADCAST" not in small_side(lookup, max_rows=10)._jdf.queryExecution().logical().toString().upper()


# --- Merkle manifest ---------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    values = ("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text))
    return sha("".join(values))


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def plain_path(levels, i):
    path = []
    for level in levels[:-1]:
        first = i - i % 3
        path.append(("".join(level[first:i]), "".join(level[i + 1 : first + 3])))
        i //= 3
    return path


def plain_manifest(docs):
    sources = {}
    for row in docs:
        sources.setdefault(row[3], []).append((plain_leaf(row, row[1]), row))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        sources[source].sort(key=lambda r: (r[1][0] is not None, r[1][0] or 0, r[0]))
        trees[source] = plain_tree([leaf for leaf, _ in sources[source]])
    top = plain_tree([trees[s][-1][0] for s in order])
    root, out = top[-1][0], []
    for k, source in enumerate(order):
        for i, (leaf, row) in enumerate(sources[source]):
            path = plain_path(trees[source], i) + plain_path(top, k)
            text = row[1]
            if zlib.crc32(str("" if row[0] is None else row[0]).encode()) % 2 == 0 and text:
                text = text.replace("\n", "")
            folded = plain_leaf(row, text)
            for left, right in path:
                folded = sha(left + folded + right)
            proof = sha("".join(left + right for left, right in path))
            out.append((row[0], leaf, trees[source][-1][0], root, proof, folded, folded == root))
    return sorted(out, key=by_nulls)


def manifest_documents():
    rng = random.Random(11)
    sources = ["big"] * 400 + [None] * 30 + ["", "é", "z"] + [f"s{i}" for i in range(12)] * 9
    texts = ["a\nb", "", None, "é\n", "-", "1:a", "x\n" * 20_000]
    rows = [
        (rng.choice([i, i, i, 5, None]), rng.choice(texts), rng.choice(["en", None]), s, rng.choice([None, i]))
        for i, s in enumerate(sources)
    ]
    return rows + rows[:7]


def test_manifest_and_proofs(spark):
    docs = manifest_documents()
    more = spark.createDataFrame(docs, DOC).withColumns(
        {n: F.lit("x") for n in ("tree", "idx", "size", "hash", "carry", "part", "place", "now", "root", "path")}
    )
    found = rows_of(merkle.verified(more))
    assert found == plain_manifest(docs)
    assert {r[-1] for r in found} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 81, 82, 244])
def test_trees_of_all_shapes(spark, n):
    docs = [(i, f"t{i}\n", "en", "s", i) for i in range(n)]
    assert rows_of(merkle.verified(spark.createDataFrame(docs, DOC))) == (plain_manifest(docs) if docs else [])


def test_stored_levels_are_few(spark):
    docs = [(i, f"t{i}", "en", "s", i) for i in range(300)]
    made = merkle.manifest(spark.createDataFrame(docs, DOC))
    # 300 leaves and 4 nodes after four steps, 1 after two more.
    assert [nodes.count() for nodes in made.sources.checkpoints] == [300, 4, 1]
    assert made.root == plain_manifest(docs)[0][3]
