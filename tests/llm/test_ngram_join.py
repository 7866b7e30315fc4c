"""Operator 12 against the plain definition."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from errscope.llm.ngram_join import forest, ngram_join, overlaps

from .conftest import LOWER, SF

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, percent=80, size=5):
    """{(id, n, component)}: all pairs of rows, one by one."""
    sets = []
    for _, text in rows:
        w = WORDS.findall((text or "").translate(LOWER))
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    own = list(range(len(rows)))

    def root(i):
        while own[i] != i:
            i = own[i]
        return i

    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    for i, (s, (key, _)) in enumerate(zip(sets, rows)):
        shared = {}
        for x in s:
            for j in by[x]:
                shared[j] = shared.get(j, 0) + 1
        for j, k in shared.items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                own[root(i)] = root(j)
    first = {}
    for i, (key, _) in enumerate(rows):
        if key is not None and sets[i]:
            own[root(i)] = root(first.setdefault(key, i))
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(least.get(root(i), key), key)
    return sorted(((k, len(s), least.get(root(i)) if s else k) for i, (k, s) in enumerate(zip([k for k, _ in rows], sets))), key=str)


def got(df, **settings):
    out = ngram_join(df, **settings)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(map(tuple, out.collect()), key=str)


def near_copies(rng, base, n, change):
    out = []
    for _ in range(n):
        out.append(" ".join(w if rng.random() > change else f"x{rng.randrange(10**6)}" for w in base))
    return out


def test_awkward_rows(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert got(edge_docs) == plain(rows)
    assert got(no_docs) == []


def test_table_equals_all_pairs(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = plain(rows)
    assert len({c for _, _, c in want}) < len(want)
    assert got(docs) == want


@pytest.mark.parametrize("limits", [{}, {"part_rows": 4}, {"part_rows": 8, "part_shingles": 600}])
def test_large_groups_in_cells(spark, limits):
    rng = random.Random(7)
    texts = []
    for change in (0.0, 0.01, 0.02, 0.03, 0.05):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([40, 90, 200]))]
        texts += near_copies(rng, base, 30, change) + [" ".join(base[: len(base) * k // 10]) for k in range(5, 11)]
    passage = " ".join(f"p{k}" for k in range(60))
    texts += [f"{passage} {' '.join(f'q{rng.randrange(10**6)}' for _ in range(rng.randrange(25)))}" for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    want = plain(rows)
    assert 10 < len({c for _, _, c in want}) < 200
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(df, **limits) == want


def test_texts_of_one_id_hang_together(spark):
    w, v = (" ".join(f"{c}{k}" for k in range(50)) for c in "wv")
    rows = [(1, w), (1, v), (2, w + " end"), (3, v + " end"), (4, "a b"), (5, "A  b"), (6, " "), (None, w + " end"), (None, "alone here"), (7, "a b c")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == plain(rows)
    assert {c for k, _, c in got(df) if k in (1, 2, 3)} == {1}


def test_any_cut_of_the_order_gives_the_same_sums(docs):
    assert got(docs, fragments=1) == got(docs, fragments=5, head_percent=3)


def test_overlaps_and_forest():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 300, 60)) for _ in range(9)]
    row = np.repeat(np.arange(9), [len(s) for s in sets])
    found = overlaps((row, np.concatenate(sets)), (row, np.concatenate(sets)), 9, 9, run=17)
    assert all(found[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(9) for j in range(9))
    assert forest(np.array([0, 1, 5]), np.array([1, 2, 4]), 6).tolist() == [0, 0, 0, 3, 4, 4]


def test_query_equals_its_sql(spark):
    import duckdb

    from errscope.llm.queries import ORACLES, QUERIES

    duckdb.sql(f"create or replace view documents as select * from read_parquet('{SF}/documents.parquet')")
    want = duckdb.sql(ORACLES["op12_ngram_join"]).fetchall()
    assert sorted(map(tuple, QUERIES["op12_ngram_join"](spark, SF).collect())) == sorted(want)
