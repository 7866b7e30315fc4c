"""Operator 10: signatures, verified links and classes against brute force."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from errscope.llm.common import ALNUM, words_of
from errscope.llm.near_dedup import _overlap, bags, components_of, keep_one, near_duplicates, signatures

from .conftest import words


def _bag(text, size=5):
    w = words(text)
    return Counter(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else Counter()


def _similarity(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def _classes(rows, similarity=0.8):
    bag = [(i, _bag(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(bag):
        for j, b in bag[:k]:
            if a and b and _similarity(a, b) >= similarity:
                x, y = top(i), top(j)
                parent[max(x, y)] = min(x, y)
    return {i: top(i) for i, _ in rows}


def _near(text, rng, share):
    w = text.split(" ")
    for k in rng.choice(len(w), max(1, int(share * len(w))), replace=False):
        w[k] = f"x{rng.integers(1000)}"
    return " ".join(w)


def test_bags_and_overlap_match_counters():
    texts = ["a b a b a b a b c", "", "one two", "A b, a B a-b", "é é é é é é é é", None]
    for w in words_of(pa.array(texts), ALNUM):
        row, _, count = bags(w, 5)
        for i, t in enumerate(texts):
            assert sorted(count[row == i]) == sorted(_bag(t).values())
    left, right = pa.array(texts[:5]), pa.array(["a b a b a b c", "x", "one two", "a b a b a b a", "é é é é é"])
    got = _overlap(left, right, 5)
    for g, a, b in zip(got, left.to_pylist(), right.to_pylist()):
        assert abs(g - _similarity(_bag(a), _bag(b))) < 1e-12


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    left, right = [], []
    for share in np.linspace(0.01, 0.4, 40):
        text = " ".join(f"w{k}" for k in rng.integers(0, 120, 300))  # words repeat up to about ten times
        left.append(text)
        right.append(_near(text, rng, share))

    def sign(texts):
        w = next(words_of(pa.array(texts), ALNUM, 1 << 30))
        return signatures(len(texts), *bags(w, 1), 1024)

    same = (sign(left) == sign(right)).mean(axis=1)
    truth = np.array([_similarity(_bag(a, 1), _bag(b, 1)) for a, b in zip(left, right)])
    assert abs((same - truth).mean()) < 0.01
    assert np.sqrt(((same - truth) ** 2).mean()) < 0.025


def test_signature_depends_on_the_text_alone():
    texts = ["a b c d e f g", "zz", " ".join(f"q{i}" for i in range(3000)), "a a a a a a a a a a a"]
    alone = [signatures(1, *bags(next(words_of(pa.array([t]), ALNUM)), 5), 48) for t in texts]
    w = next(words_of(pa.array(texts), ALNUM, 1 << 30))
    assert (signatures(4, *bags(w, 5), 48) == np.concatenate(alone)).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 50), (60, 100), (200, 201), (7, 7)]
    got = {r["id"]: r["class"] for r in components_of(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 50: 50, 60: 50, 100: 50, 200: 200, 201: 200}


def test_classes_match_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = _classes(rows)
    got = {r.doc_id: (r.class_id, r.class_size, r.kept) for r in near_duplicates(docs).collect()}
    size = Counter(want.values())
    assert got == {i: (c, size[c], i == c) for i, c in want.items()}


def test_planted_groups_and_mixed_buckets(spark):
    rng = np.random.default_rng(8)
    text = [" ".join(f"v{k}" for k in rng.integers(0, 3000, 120)) for _ in range(6)]
    shared = " ".join(f"p{k}" for k in range(80))  # a passage of many documents, which are no copies
    rows = [(i, _near(text[i % 5], rng, 0.02)) for i in range(60)] + [(100 + i, text[5]) for i in range(30)] + [(200 + i, shared + " " + " ".join(f"o{i}x{k}" for k in range(50))) for i in range(40)]
    # a chain: each text is close to the next, the ends are not
    chain = text[5].split(" ")
    for i in range(8):
        chain[10 * i + 3] = f"c{i}"
        rows.append((300 + i, " ".join(chain)))
    want = _classes(rows)
    got = {r.doc_id: r.class_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_awkward_rows(edge_docs, no_docs):
    got = sorted(((r.doc_id, r.class_id, r.class_size, r.kept) for r in near_duplicates(edge_docs).collect()), key=str)
    want = [(1, 1, 2, True), (2, 2, 1, True), (3, 3, 1, True), (4, 4, 1, True), (5, 1, 2, False), (7, 7, 1, True), (None, None, 1, True)]
    assert got == sorted(want, key=str)
    kept = keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 7, None], key=str)
    assert near_duplicates(no_docs).count() == 0 and keep_one(no_docs).count() == 0


def test_repeated_rows_are_one_document(spark):
    df = spark.createDataFrame([(5, "some words that are repeated here"), (5, "some words that are repeated here"), (6, "others")], "doc_id long, text string")
    assert sorted(r.doc_id for r in near_duplicates(df).collect()) == [5, 6]
    assert sorted(r.doc_id for r in keep_one(df).collect()) == [5, 6]


def test_links_of_all_texts_of_an_id_count(spark):
    rng = np.random.default_rng(4)
    w, v = (" ".join(f"{c}{k}" for k in rng.integers(0, 3000, 150)) for c in "wv")
    rows = [(1, w), (1, v), (2, w + " end"), (3, v + " end"), (4, "another text of its own"), (4, w.replace("w", "u"))]
    for order in (rows, rows[::-1]):
        got = {r.doc_id: (r.class_id, r.class_size) for r in near_duplicates(spark.createDataFrame(order, "doc_id long, text string")).collect()}
        assert got == {1: (1, 3), 2: (1, 3), 3: (1, 3), 4: (4, 1)}
