"""Each operator against brute force or plain Python, with the awkward rows every table may hold."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shopledger.llm import (
    chat,
    common,
    compress_quality,
    line_dedup,
    mixing,
    near_dedup,
    ngram_trie,
    packing,
    pii,
    quality_rules,
    vptree,
)
from shopledger.llm.elias_fano import Sequence

# Extra columns whose names the operators also use inside or return.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " key string, size long, score double, kept boolean"
)
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi pi rho".split()


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS, n))


@pytest.fixture(scope="module", autouse=True)
def shared(spark):
    common.share_package(spark)


@pytest.fixture(scope="module")
def docs(spark):
    base = prose(1, 120)
    near = base.replace("alpha", "ALPHA", 3) + " tail"
    texts = [
        (1, base, "a"), (2, near, "b"), (3, base, "a"), (3, base, "a"), (4, "", "a"), (5, None, None),
        (6, "  \t\n ", "b"), (7, "one", None), (8, "One", "c"), (None, base, "a"), (9, prose(2, 6000), "c"),
        (10, "x" * 200_000, "b"), (11, "head\n" + prose(3, 60) + "\nhead", "a"),
        (12, "mail a.b@c.example, +1 (269) 555-3296, 4111 1111 1111 1111, 10.0.0.1, 10.0.0.300", "b"),
    ]
    rows = [(i, t, "en" if s != "b" else None, s, len(t or ""), "k", 5, 0.5, True) for i, t, s in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(docs):
    return docs.filter("false")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def pairs(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---- 1 nearest neighbours ------------------------------------------------------------------


def test_nearest_is_exact_at_factor_one(spark):
    rng = np.random.default_rng(5)
    vectors = [[float(x) for x in v] for v in rng.normal(size=(400, 8))]
    vectors[10:60] = [vectors[9]] * 50
    rows = list(enumerate(vectors)) + [(0, vectors[0])]
    bad = [(900, None), (901, [0.0] * 8), (902, [1.0, None] * 4), (903, [float("nan")] * 8), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows + bad + [(904, [float("inf")] * 8), (905, [1.0])], "vec_id long, embedding array<double>")
    asks = F.col("vec_id") % 20 == 0
    got = vptree.nearest(df.withColumn("rank", F.lit(0)), asks, 10, 1.0, shard_rows=90, leaf=8, block=7)
    got = got.toPandas().sort_values(["query_id", "rank"])
    x = np.array(vectors)
    assert got["query_id"].nunique() == 20
    for q, rows_ in got.groupby("query_id"):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        want = np.lexsort((np.arange(len(x)), d))[:10]
        assert rows_["vec_id"].tolist() == want.tolist()
        assert np.allclose(rows_["score"], d[want], rtol=1e-12)
    loose = vptree.nearest(df, asks, 10, 0.6, shard_rows=90, leaf=8).toPandas()
    hits = len(set(zip(got.query_id, got.vec_id)) & set(zip(loose.query_id, loose.vec_id)))
    assert hits >= 0.9 * len(got)
    assert vptree.nearest(df.filter("false"), asks).count() == 0


# ---- 2 personal data -----------------------------------------------------------------------

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain_spans(text):
    out = []
    for i, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), i, kind, m.end()))
    return [(kind, s, e) for s, _, kind, e in sorted(out)]


def test_base_spans_match_the_patterns():
    rng = np.random.default_rng(3)
    pieces = ["a", "@", "b.c", ".", "1", "22", "+", " ", "-", "4111111111111111", "(", "10.0.0.1", "é", "x@y.z", "\n"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces, rng.integers(1, 25)))
        assert pii.base_spans(text)[0] == plain_spans(text), text


def test_bootstrapping_finds_unseen_identifiers(spark):
    ok = [f"4{i:015d}" for i in range(100_000) if pii.luhn(f"4{i:015d}")][:40]
    seen = [(i, f"pay with card {c} now please") for i, c in enumerate(ok)]
    # No digits rule covers this one; its place and form do.
    new = [(100, "pay with card 41a1-1111-1111 now"), (101, "lot 41a1-1111-1111 sold")]
    form = [(200 + i, f"pay with card 4{i:02d}a-2222-3333 now") for i in range(20)]
    mails = [(300 + i, f"write to user{i}@host.example today") for i in range(20)]
    odd = [(400, "write to user7@localhost today")]
    df = spark.createDataFrame(seen + new + form + mails + odd, "doc_id long, text string")
    out = {r.doc_id: r for r in pii.report(pii.find(df, least_confidence=0.5)).collect()}
    assert out[0].n_card == 1 and out[0].n_added == 0
    assert out[300].n_email == 1 and out[101].n_added == 0
    graph = pii.edges(pii.scan(df))
    kinds = {(r.pattern, r.kind) for r in pii.score_patterns(graph).collect()}
    assert ("card 0000000000000000", "card") in kinds


def test_added_spans_follow_trusted_patterns(spark):
    known = [(i, f"call tel +1 (555) 555-{1000 + i} soon") for i in range(30)]
    # The same form after the same word, but too short for the base rule.
    extra = [(99, "call tel +1 (555) 555-9999 soon"), (98, None), (97, "")]
    df = spark.createDataFrame(known + extra, "doc_id long, text string")
    out = {r.doc_id: r for r in pii.report(pii.find(df)).collect()}
    assert out[99].n_phone == 1 and out[98].spans == "" and out[97].n_phone == 0
    assert out[98].base_sha256 == hashlib.sha256(b"").hexdigest()
    rows = [(i, f"id code {10_000 + i}@x.example ok") for i in range(30)] + [(50, "id code 77777@lan ok")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # Two forms differ, so nothing is added across them.
    assert pii.report(pii.find(df)).filter("n_added > 0").count() == 0


def test_pattern_graph_adds_and_spares(spark):
    scanned = [("id 000", str(i), "card") for i in range(9)] + [("id 000", "x", None)]
    scanned += [("of 000", f"o{i}", None) for i in range(9)] + [("of 000", "0", "card")]
    graph = spark.createDataFrame(scanned, "pattern string, value string, seed string")
    got = {r.pattern: r.confidence for r in pii.score_patterns(graph, rounds=3).collect()}
    assert got["id 000"] > 0.8 and got["of 000"] <= got["id 000"]


def test_contexts_discover_new_forms(spark):
    ok = [f"4{i:015d}" for i in range(100_000) if pii.luhn(f"4{i:015d}")][:60]
    rows = [(i, f"pay with card {c} now please") for i, c in enumerate(ok)]
    rows += [(200 + i, f"write to user{i}@host{i}.example today") for i in range(60)]
    rows += [(300 + i, f"call on +1 (269) 555-{3000 + i} soon") for i in range(60)]
    # Forms no seed has, in the seeds' places.
    rows += [(400 + i, f"pay with card 4{i:02d}a-2222-3333 now please") for i in range(12)]
    rows += [(500 + i, f"write to {'abcdefghijkl'[i]}@localhost today") for i in range(12)]
    rows += [(600 + i, f"call on 555-{4000 + i} soon") for i in range(12)]
    # A form that occurs elsewhere, a single odd token, and numbers that fail their check.
    rows += [(700 + i, f"signed {2000 + i}-01-01 in town") for i in range(30)]
    rows += [(800, "pay with card 2000-01-01 now please"), (801, "write to 77777@lan today")]
    rows += [(900 + i, f"lot {4 * 10**15 + 10 * i + 1} sold") for i in range(20) if not pii.luhn(f"{4 * 10**15 + 10 * i + 1}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    text = dict(rows)
    found = {r.doc_id: r.added for r in pii.find(df).collect()}
    got = {i: [(s.kind, text[i][s.start : s.end]) for s in a] for i, a in found.items() if a}
    want = {400 + i: [("ctx_card", f"4{i:02d}a-2222-3333")] for i in range(12)}
    want |= {500 + i: [("ctx_email", f"{'abcdefghijkl'[i]}@localhost")] for i in range(12)}
    want |= {600 + i: [("ctx_phone", f"555-{4000 + i}")] for i in range(12)}
    assert got == want


def test_candidates_are_runs_parts_and_of_any_length(spark):
    def values(text):
        found = pii.occurrences(text, *pii.base_spans(text))
        return {text[o["start"] : o["end"]] for o in found if o["kind"] is None}

    long = "k" * 70 + "-12345"
    assert values("no other digits a1b2c3d4 here") == {"a1b2c3d4"} and long in values(f"see {long} now")
    assert {"1 2 3 4 5", "12 34 56"} <= values("the 1 2 3 4 5 or 12 34 56, 78")
    assert "56, 78" not in values("the 12 34 56, 78") and "555-4081" in values("tel:555-4081x")
    assert len(values("7 " * 2000)) < 2000
    known = [(i, f"call on +1 (269) 555-{3000 + i} soon") for i in range(60)]
    known += [(100 + i, f"call on 555 {4000 + i} soon") for i in range(12)]
    known += [(200, "Des +1 (826) 555-4081 190.137.223.204 du"), (201, "an +1 (843) 555-7672 10.0.0.1")]
    df = spark.createDataFrame(known, "doc_id long, text string")
    text = dict(known)
    found = {r.doc_id: r.added for r in pii.find(df).collect()}
    got = {i: [(s.kind, text[i][s.start : s.end]) for s in a] for i, a in found.items() if a}
    want = {100 + i: [("ctx_phone", f"555 {4000 + i}")] for i in range(12)}
    want |= {200: [("ctx_phone", "+1 (826) 555-4081")], 201: [("ctx_phone", "+1 (843) 555-7672")]}
    assert got == want


def test_pii_edges(spark, docs):
    out = pii.report(pii.find(docs)).toPandas()
    row = out[out.doc_id == 12].iloc[0]
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 1, 1)
    assert len(out) == docs.count() and pii.report(pii.find(empty(docs))).count() == 0


# ---- 3 language model ----------------------------------------------------------------------


def test_elias_fano_successors():
    rng = np.random.default_rng(0)
    for n, universe in ((0, 8), (1, 1), (7, 50), (500, 1 << 40), (3000, 3500)):
        values = np.sort(rng.integers(0, universe, n)).astype(np.uint64)
        seq = Sequence(Sequence.pack(values, universe))
        assert (seq.get(np.arange(n)) == values).all()
        ask = rng.integers(0, universe, 400).astype(np.uint64)
        assert (seq.successor(ask) == np.searchsorted(values, ask)).all()


def test_scores_match_a_plain_model(spark, docs):
    got = ngram_trie.score(docs, strength=2.0, shard_pairs=500).toPandas()
    rows = [(r.doc_id, (r.text or "").encode().lower().split() + [None]) for r in docs.collect()]
    learn = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 != 2
    c, b = Counter(), Counter()
    for i, w in rows:
        if learn(i):
            c.update(w)
            b.update(zip([None] + w[:-1], w))
    n, v = sum(c.values()), len(c)
    base = lambda x: (c[x] + 1) / (n + v + 1)
    want = {}
    for i, w in rows:
        p = sum(math.log10((b[a, x] + 2 * base(x)) / (c[a] + 2)) for a, x in zip([None] + w[:-1], w))
        want[i] = (sum(math.log10(base(x)) for x in w), p, len(w), sum(c[x] > 0 for x in w))
    assert len(got) == len(rows)
    for r in got.itertuples():
        base_score, score, size, known = want[None if pd.isna(r.doc_id) else r.doc_id]
        assert r.train_tokens == n and (r.n_tokens, r.n_known) == (size, known)
        assert abs(r.base_score - base_score) < 1e-6
        assert abs(r.score - score) < 0.02 * size + 1e-9
    assert ngram_trie.score(empty(docs)).count() == 0


# ---- 4 quality classifier ------------------------------------------------------------------


def test_classifier_tells_held_out_texts_apart(spark):
    good = [(i, prose(i, 80), 1) for i in range(300)]
    bad = [(1000 + i, (WORDS[i % 16].upper() + "!! ") * 60, 0) for i in range(150)]
    df = spark.createDataFrame([(i, t, 1) for i, t, _ in good + bad], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, q) for i, _, q in good + bad], "doc_id long, quality int")
    out = compress_quality.classify(df.drop("score"), labels).toPandas().set_index("doc_id")
    truth = {i: q for i, _, q in good + bad}
    held = out[out.held_out]
    assert (held.predicted == held.index.map(truth)).mean() > 0.95
    assert out.score.between(0, 1).all()
    model = compress_quality.train(df, labels)
    kept = compress_quality.accepted(df, model)
    assert kept.columns == df.columns and 280 <= kept.count() <= 320


def test_classifier_edges(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    out = compress_quality.classify(docs, labels).toPandas()
    assert len(out) == docs.count() and (out.score == 0.5).all()
    model = compress_quality.train(docs, labels)
    assert compress_quality.accepted(docs, model).schema == docs.schema
    assert compress_quality.classify(empty(docs), labels).count() == 0


def test_logistic_fit_survives_separable_classes():
    x = np.array([[1.0, i, i * i] for i in range(-50, 50)])
    y = (x[:, 1] > 0).astype(float)
    beta = compress_quality.logistic(x, y, np.ones(100))
    assert np.isfinite(beta).all() and ((x @ beta > 0) == (y == 1)).mean() > 0.97


# ---- 5 near duplicates ---------------------------------------------------------------------


def brute_components(rows, k):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        s = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
        sets.setdefault(i, []).append(frozenset(s))
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(
                100 * len(s & t) >= 80 * len(s | t) for s in sets[a] for t in sets[b] if s and t
            ):
                x, y = sorted((root(a), root(b)))
                top[y] = x
    return {i: root(i) for i in ids}


def test_near_duplicates_match_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = []
    for group in range(6):
        words = prose(100 + group, 90).split()
        for copy in range(30):
            changed = list(words)
            for at in rng.integers(0, 90, rng.integers(0, 16)):
                changed[at] = f"w{rng.integers(0, 9999)}"
            rows.append((group * 100 + copy, " ".join(changed)))
    rows += [(5000 + i, prose(3, 40)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for k in (2, 5):
        got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df, words=k).collect()}
        assert got == brute_components(rows, k)


def test_near_duplicates_edges(spark, docs):
    out = near_dedup.near_duplicates(docs, words=2).toPandas()
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None]
    want = brute_components(rows, 2)
    assert len(out) == docs.count()
    for r in out.itertuples():
        if pd.isna(r.doc_id):
            assert r.kept
        else:
            assert r.component_id == want[r.doc_id]
    kept = near_dedup.one_of_each(docs, words=2)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted({i for i, c in want.items() if i == c})
    assert near_dedup.near_duplicates(empty(docs)).count() == 0


def test_one_of_each_with_clashing_names(spark):
    rows = [(1, prose(1, 60)), (2, prose(1, 60)), (3, prose(2, 60)), (3, prose(2, 60)), (None, prose(1, 60))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.withColumns({n: F.lit(n) for n in ("id", "n", "row", "of", "__id", "__n", "kept")})
    out = near_dedup.one_of_each(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.id, r.n, r.kept) for r in out.collect() if r.doc_id) == [(1, "id", "n", "kept"), (3, "id", "n", "kept")]
    assert out.count() == 3


def test_sketch_fills_every_bin():
    for n in (1, 2, 30, 5000):
        bins = near_dedup.sketch(near_dedup.mixed(np.arange(n, dtype=np.uint64)), 160)
        assert (bins != near_dedup._EMPTY).all()


# ---- 6 packing -----------------------------------------------------------------------------


def test_packing_keeps_every_word_and_every_rule(spark, docs):
    more = [(100 + i, prose(i % 40, 30 + i), "en", f"s{i % 3}", 0, "k", 1, 0.0, True) for i in range(120)]
    df = docs.unionByName(spark.createDataFrame(more, SCHEMA))
    out = packing.pack(df, capacity=300, per_source=2, share=50).toPandas()
    used = out[out.bin_id.notna()]
    assert used.groupby("bin_id").n_words.sum().max() <= 300
    for _, b in used.sort_values(["bin_id", "start"]).groupby("bin_id"):
        assert (b.start.values[1:] >= (b.start + b.n_words).values[:-1]).all()
    want = sum(len(words_of(r.text)) for r in df.collect())
    assert used.n_words.sum() == want
    rows = [(r.doc_id, r.source, hashlib.md5((r.text or "").encode()).hexdigest()) for r in df.collect()]
    source, cluster = {r[0]: r[1] for r in rows}, {r[0]: r[2] for r in rows}
    small = used[used.n_words < 300].dropna(subset=["doc_id"])
    for _, b in small.groupby("bin_id"):
        assert Counter(source[i] for i in b.doc_id).most_common(1)[0][1] <= 2
        assert Counter(cluster[i] for i in b.doc_id).most_common(1)[0][1] == 1
    assert packing.pack(empty(docs)).count() == 0


def test_best_fit_takes_the_tightest_compatible_bin():
    bins = packing.Bins(10, 1)
    assert [bins.place(s, src, 0)[0] for s, src in ((6, 1), (7, 2), (3, 4), (3, 2), (4, 1))] == [0, 1, 1, 0, 2]


# ---- 7 mixing ------------------------------------------------------------------------------


def poured(sizes, weights, most):
    """Targets by resharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, open_ = sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    left = float(total)
    while left > 1e-9 and open_:
        share = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in list(open_):
            target[s] += share * weight[s]
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                open_.remove(s)
    return target


def test_mix_meets_targets(spark, docs):
    out = mixing.mix(docs).toPandas()
    rows = docs.collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len(words_of(r.text))
    want = poured(sizes, (1, 2, 3), 3)
    assert len(out) == len(rows) and (out.taken <= 3 * out["size"]).all()
    for s, size in sizes.items():
        mine = out[np.isclose(out.source_size, size)]
        assert np.allclose(mine.target, want[s])
        assert abs(mine.taken.sum() - want[s]) <= 3
    again = mixing.mix(docs.repartition(2))
    assert pairs(again) == pairs(mixing.mix(docs))
    assert mixing.mix(empty(docs)).count() == 0


def test_mixed_documents_hold_the_words_taken(spark, docs):
    taken = mixing.mix(docs).agg(F.sum("taken")).first()[0]
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert sum(len(words_of(r.text)) for r in out.collect()) == taken


# ---- 8 quality rules -----------------------------------------------------------------------


def test_rule_counts_match_plain_python(spark, docs):
    out = quality_rules.judge(docs).toPandas()
    assert len(out) == docs.count()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in out.itertuples():
        text = texts[None if pd.isna(r.doc_id) else r.doc_id]
        w = words_of(text)
        seen = Counter(zip(w, w[1:], w[2:]))
        places = {i + j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if words_of(x)]
        assert (r.n_words, r.word_chars) == (len(w), sum(map(len, w)))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert r.n_dup_lines == len(lines) - len(set(lines)) and r.n_repeat_words == len(places)
        assert r.base_failed == (len(w) < 50 or 100 * len(places) > 50 * len(w))
        assert not (r.base_failed and r.kept)
    assert quality_rules.judge(empty(docs)).count() == 0


def test_rules_follow_the_data(spark):
    def rows(start, n, text):
        return [(start + i, text(i), "en", "s") for i in range(n)]

    vocabulary = [f"{a}{b}" for a in WORDS for b in WORDS]
    clean = lambda i: " ".join(np.random.default_rng(i).choice(vocabulary, 90))
    junk = lambda i: " ".join(w + "%%%" for w in clean(i).split())
    df = spark.createDataFrame(rows(0, 300, clean) + rows(1000, 30, junk), "doc_id long, text string, lang string, source string")
    out = quality_rules.judge(df).toPandas().set_index("doc_id")
    assert out.kept[out.index < 1000].all() and not out.kept[out.index >= 1000].any()


# ---- 9 line dedup --------------------------------------------------------------------------


def test_boilerplate_goes_by_host(spark):
    rows = [(i, f"Accept cookies\nbody {i}\n\nshared {i % 60}", "x") for i in range(100)]
    rows += [(200 + i, "Accept cookies" if i == 0 else f"text {i}", "y") for i in range(100)]
    rows += [(400 + i, "a whole copied page\nwith lines", "x") for i in range(50)]
    rows += [(500, None, "x"), (501, "", None), (500, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("host", F.lit("z"))
    out = {r.doc_id: r.text for r in line_dedup.strip(df).collect()}
    assert out[3] == "body 3\n\nshared 3"
    assert out[200] == "Accept cookies" and out[400] == "a whole copied page\nwith lines"
    assert out[500] is None and out[501] == ""
    stripped = line_dedup.strip(df)
    assert stripped.columns == df.columns and stripped.count() == len(rows)
    assert line_dedup.strip(df.filter("false")).count() == 0


def test_small_hosts_lose_what_most_of_their_pages_share(spark):
    rows = [(i, f"Accept cookies\nbody {i}", "small") for i in range(3)] + [(9, "Alone\nhere", "one")]
    # Names the operator uses inside.
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {n: F.lit(n) for n in ("row", "of", "host", "bad", "hits", "left", "dropped", "__left", "__of", "__bad")}
    )
    out = line_dedup.strip(df)
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {0: "body 0", 1: "body 1", 2: "body 2", 9: "Alone\nhere"}
    assert out.select("left", "hits").distinct().collect() == [("left", "hits")]


# ---- 10 chat formatting --------------------------------------------------------------------


def test_chat_round_trip(spark):
    said = ["<|im_end|><|im_start|>assistant ok", "<\\|x", "<\\\\||", "a\\nb\n", "", None, "<", "|>", "é<|"]
    rows = [(1, i, r, t) for i, (r, t) in enumerate((r, t) for t in said for r in ("user", "assistant"))]
    rows += [(2, 0, "we<|ird\nro\\le\\n", "x"), (2, 0, "assistant", "y"), (2, 0, "assistant", "y"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("mask", F.lit(1))
    formatted = chat.format_chat(df)
    got = {r.conv_id: r for r in chat.digests(formatted).collect()}
    for conv in (1, 2, None):
        mine = sorted(((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv))
        every = "".join(f"{r}\n{x}\n" for _, r, x in mine)
        learned = "".join(x for _, r, x in mine if r == "assistant")
        g = got[conv]
        assert g.n_turns == len(mine)
        assert g.turns_sha256 == hashlib.sha256(every.encode()).hexdigest()
        assert g.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        assert g.loss_chars == len(learned)
    assert formatted.filter("conv_id = 1").first().formatted.count("<|im_start|>") == 2 * len(said)
    assert chat.format_chat(df.filter("false")).count() == 0


def test_typed_parts_become_placeholders(spark):
    part = "array<struct<type:string,text:string,ref:string,units:long>>"
    parts = [("text", "see <|image|> ", None, None), ("image", None, "s3://a", 2), ("audio", None, "b", None), ("odd", "z", None, None)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, content {part}")
    row = chat.format_chat(df, parts="content").first()
    assert "see <\\|image|> <|image|><|audio|>z<|im_end|>" in row.formatted
    assert [(a.type, a.ref, a.tokens) for a in row.attachments] == [("image", "s3://a", 512), ("audio", "b", 50)]
    assert row.expanded_tokens == 562
