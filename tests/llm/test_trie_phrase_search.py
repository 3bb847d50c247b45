"""Conversation trie, recurring passages and shared search against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopledger.llm import common, phrase_dedup, prefix_trie, shared_search, tree_contraction

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module", autouse=True)
def shared(spark):
    common.share_package(spark)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---- tree contraction ----------------------------------------------------------------------


def brute_totals(parent, value):
    total = dict(value)
    depth = {}

    def depth_of(v):
        steps, at = 0, v
        while parent[at] is not None:
            at, steps = parent[at], steps + 1
        return steps

    for v in parent:
        depth[v] = depth_of(v)
    for v in sorted(parent, key=depth.get, reverse=True):
        if parent[v] is not None:
            total[parent[v]] += total[v]
    return total


def shapes(n):
    """A random tree, a chain, a star, a caterpillar and a few trees, as one forest."""
    rng = np.random.default_rng(3)
    yield {i: int(rng.integers(0, i)) if i else None for i in range(n)}
    yield {i: i - 1 if i else None for i in range(n)}
    yield {i: 0 if i else None for i in range(n)}
    yield {i: None if i == 0 else i - 2 if i % 2 == 0 else i - 1 for i in range(n)}
    yield {i: None if i < 5 else int(rng.integers(max(0, i - 6), i)) for i in range(n)}


def test_subtree_totals(spark):
    rng = np.random.default_rng(4)
    parent = {}
    for k, shape in enumerate(shapes(70)):
        parent |= {1000 * k + i: None if p is None else 1000 * k + p for i, p in shape.items()}
    value = {i: int(rng.integers(-5, 50)) for i in parent}
    tree = spark.createDataFrame(
        [(i, parent[i], value[i], 1) for i in parent], "id long, parent long, a long, b long"
    )
    got = {r.id: (r.a, r.b) for r in tree_contraction.subtree_totals(tree, ["a", "b"]).collect()}
    a, b = brute_totals(parent, value), brute_totals(parent, dict.fromkeys(parent, 1))
    assert got == {i: (a[i], b[i]) for i in parent}


def test_subtree_totals_of_nothing(spark):
    tree = spark.createDataFrame([], "id long, parent long, a long")
    assert tree_contraction.subtree_totals(tree, ["a"]).collect() == []


# ---- 11 prefix trie ------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, id long, part long, depth string"


def brute_trie(conversations):
    own = defaultdict(list)
    for conv_id, turn, role, text in conversations:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        head = int(math.fmod(c, 20))
        rebuilt[c] = turns.get(c - head, [])[:h] + turns[c][h:]
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    kids = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node in members:
        words = len(WORD.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(members[node]) - 1) * words
    out = []
    for node, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(rebuilt[c]) == len(node))
        above = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(cs), len(node), above, len(cs), kids[node], leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def conversation_rows():
    rng = np.random.default_rng(11)
    out = []
    for c in range(0, 130):
        if c in (40, 61):
            continue
        for turn in range(int(rng.integers(1, 7))):
            text = " ".join(rng.choice(["hi", "yes", "no you"], int(rng.integers(0, 2))))
            out.append((c, turn, "user" if turn % 2 == 0 else "assistant", text))
    out += [(300, None, None, None), (300, 1, "user", "x" * 50_000), (300, 1, "user", "b"), (300, 1, "user", "b")]
    out += [(-7, 0, "user", "hi"), (-27, 0, "user", "ho"), (None, 0, "user", "hi")]
    out += [(307, t, "user", "same") for t in range(150)] + [(307, 3, "a", "same")]
    out += [(c, 0, "user", "hi") for c in range(500, 560)]
    # A base of one turn whose group rebuilds on it, also to nothing at all.
    out += [(400, 0, "user", "only"), (401, 0, "user", "a"), (402, 0, "user", "b"), (403, 0, "x", "c")]
    out += [(441, 0, "user", "a"), (442, 0, "user", "b"), (443, 0, "x", "c"), (444, 0, "x", "c")]
    return out


def test_trie_equals_brute_force(spark, monkeypatch):
    """More ranges than conversations' ends, and digests made of several pieces."""
    monkeypatch.setattr(prefix_trie, "PIECE_CHARS", 10)
    given = conversation_rows()
    df = spark.createDataFrame([(*r, 5, 6, "x") for r in given], TURNS).repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 7)
    try:
        assert rows(prefix_trie.trie(df)) == brute_trie(given)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_trie_of_nothing(spark):
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).collect() == []


# ---- 12 recurring passages -----------------------------------------------------------------

DOCS = "doc_id long, text string, block long, value long, n_words long"


def brute_removal(documents, window):
    texts = [(i, WORD.findall(t or "")) for i, t in documents]
    places = Counter(tuple(w[k : k + window]) for _, w in texts for k in range(len(w) - window + 1))
    out = []
    for doc_id, w in texts:
        gone = set()
        for k in range(len(w) - window + 1):
            if places[tuple(w[k : k + window])] > 1:
                gone.update(range(k, k + window))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((doc_id, len(w), len(gone), " ".join(kept)))
    return sorted(out, key=repr)


def repeated_texts(seed, window):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["été", "日本", "\x1c"]
    say = lambda n: list(rng.choice(vocabulary, n))
    shared, other = say(window + 9), say(3 * window)
    texts = [
        say(200), shared, say(30) + shared + say(30), shared[1:] + say(5), shared[2 : window + 1],
        say(4) + other[5:] + say(3), other, other[: window + 2] + other[: window + 2],
        ["a"] * (window + 4), ["b"] * window, ["b"] * (window - 1), say(2000) + shared + say(2000),
        [], ["one"], shared + other + shared,
    ]
    base = say(400)
    for _ in range(6):
        near = list(base)
        near[int(rng.integers(0, 400))] = "changed"
        texts.append(near)
    joined = [("\n" if k % 3 else " \t").join(t) for k, t in enumerate(texts)]
    return [*enumerate(joined), (3, joined[3]), (900, None), (901, "  \n"), (None, joined[0]), (None, "x")]


@pytest.mark.parametrize("window, anchor, pack", [(35, 12, 4_000_000), (35, 12, 900), (4, 4, 300)])
def test_removal_equals_brute_force(spark, window, anchor, pack):
    given = repeated_texts(window + pack % 7, window)
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in given], DOCS).repartition(3)
    got = phrase_dedup.without_repeats(df, window, anchor, pack)
    assert rows(got) == brute_removal(given, window)


def test_removal_from_nothing(spark):
    assert phrase_dedup.without_repeats(spark.createDataFrame([], DOCS)).collect() == []


def test_automaton_finds_overlapping_and_nested_passages():
    machine = phrase_dedup.automaton({(1, 2, 3), (2, 3, 4, 5), (3, 4)})
    found = phrase_dedup.covered([0, 1, 2, 3, 4, 9, 2, 3, 4, 5], machine)
    assert found.tolist() == [False, True, True, True, True, False, True, True, True, True]


# ---- 13 ranked search ----------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_search(documents, items, top):
    found = [(i, TERM.findall((t or "").translate(UPPER))) for i, t in documents]
    found = [(i, Counter(t), len(t)) for i, t in found if t]
    total, length = len(found), sum(n for *_, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, c, n in found:
            m = 100 - 25 + (25 * n * total) // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t in TERM.findall((text or "").translate(UPPER))
                if c[t]
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, *_, doc_id) in enumerate(sorted(scores)[:top], 1):
            out.append((item_id, rank, doc_id, -score))
    return sorted(out, key=repr)


def searched(seed):
    rng = np.random.default_rng(seed)
    vocabulary = ["the", "The", "of", "été", "É", "a1", "日本", *[f"t{i}" for i in range(40)]]
    weights = np.array([30, 10, 20, *[1.0] * (len(vocabulary) - 3)])
    say = lambda n: ", ".join(rng.choice(vocabulary, n, p=weights / weights.sum()))
    documents = [(i, say(int(rng.integers(1, 60)))) for i in range(90)]
    documents += [(5, documents[5][1])] * 25 + [(200, None), (201, ""), (202, "--\n!"), (None, say(9))]
    documents += [(203, "t1 " * 9000)]
    items = [(i, say(int(rng.integers(1, 30)))) for i in range(12)]
    items += [(3, "the of t1 t1"), (50, None), (51, "?"), (52, "absent"), (None, "the été")]
    return documents, items


@pytest.mark.parametrize("block", [512, 5])
def test_search_equals_brute_force(spark, block):
    documents, items = searched(block)
    df = spark.createDataFrame([(*r, 1, 2, 3.0) for r in documents], "doc_id long, text string, n long, item long, score double")
    queries = spark.createDataFrame([(*r, 1, 7) for r in items], "item_id long, text string, rank int, doc_id long")
    got = shared_search.search(df.repartition(5), queries, top=7, block_items=block)
    assert rows(got) == brute_search(documents, items, 7)


def test_search_of_nothing(spark):
    documents, items = searched(1)
    df = spark.createDataFrame(documents, "doc_id long, text string")
    queries = spark.createDataFrame(items, "item_id long, text string")
    assert shared_search.search(df.filter("false"), queries).collect() == []
    assert shared_search.search(df, queries.filter("false")).collect() == []
    assert shared_search.search(df.select("doc_id", F.lit("!").alias("text")), queries).collect() == []


def test_shared_sums_are_made_once():
    items = [[b"a", b"b", b"c", b"x"], [b"a", b"b", b"c", b"y"], [b"a", b"b", b"z"], [b"c", b"c"]]
    plan = shared_search.SharedPlan(items)
    terms = [t for t, _ in sorted(plan.vocabulary.items(), key=lambda kv: kv[1])]
    nodes = [[terms[t] for t in leaf] for leaf in plan.leaves]
    assert [b"a", b"b"] in nodes  # used by the same items: one leaf
    for a, b in plan.joins:
        nodes.append(nodes[a] + nodes[b])
    assert sorted(nodes[-1]) == [b"a", b"b", b"c"]  # shared by two items: one inner node
    for item, uses in zip(items, plan.items):
        assert Counter(t for node in uses for t in nodes[node]) == Counter(item)
