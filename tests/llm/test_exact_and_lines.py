"""Operators 1 and 9 against brute force and on awkward rows."""

from __future__ import annotations

import hashlib
from collections import defaultdict

from errscope.llm.exact_dedup import bitmap_bits, exact_dedup
from errscope.llm.line_dedup import LineRuns, drop_lists, line_dedup, line_rows

from .conftest import LONG, LOWER


def test_exact_dedup_matches_brute_force(docs):
    rows = [(r.doc_id, (r.text or "").translate(LOWER)) for r in docs.collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.sha) for r in exact_dedup(docs, digest_col="sha").collect()}
    assert got == {i: (max(groups[t]), len(groups[t]), i == max(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows}
    plain = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup(docs).collect()}
    assert plain == {i: x[:3] for i, x in got.items()}


def test_exact_dedup_steps(spark):
    start = "x" * 256
    rows = [(1, "ab"), (2, "abc"), (3, "abd"), (4, start + "a"), (5, start + "b"), (6, start + "A")]
    got = {r.doc_id: (r.keep_id, r.decided_by) for r in exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, "length"), 2: (2, "prefix"), 3: (3, "prefix"), 4: (6, "full"), 5: (5, "full"), 6: (6, "full")}


def test_exact_dedup_full_bitmap_changes_nothing(docs):
    small = {tuple(r) for r in exact_dedup(docs, filter_bits=64).drop("decided_by").collect()}
    assert small == {tuple(r) for r in exact_dedup(docs).drop("decided_by").collect()}


def test_exact_dedup_awkward_rows(edge_docs, no_docs):
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(edge_docs).collect()), key=str)
    assert got == sorted([(1, 5, 3, False), (2, 3, 2, False), (3, 3, 2, True), (4, 4, 1, True), (5, 5, 3, True), (5, 5, 3, True), (7, 7, 1, True), (None, None, 1, True)], key=str)
    assert exact_dedup(no_docs).count() == 0


def test_exact_dedup_returns_every_row(spark):
    rows = [(1, "Same text"), (1, "same text"), (2, "SAME TEXT"), (2, "same text"), (None, "x"), (None, "x")]
    got = sorted((tuple(r) for r in exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).drop("decided_by").collect()), key=str)
    assert got == sorted([(1, 2, 4, False)] * 2 + [(2, 2, 4, True)] * 2 + [(None, None, 2, True)] * 2, key=str)


def test_bitmaps_follow_the_rows():
    assert bitmap_bits(0) == 1 << 16 and bitmap_bits(10**6) >= 16 * 10**6 and bitmap_bits(10**12) == bitmap_bits(10**13)


def _brute_lines(rows, min_chars=40, min_docs=5):
    keyed = {i: [(x, x.strip(" \t\n\x0b\x0c\r").translate(LOWER)) for x in (t or "").split("\n")] for i, t in rows}
    holders = defaultdict(set)
    for i, lines in keyed.items():
        for _, k in lines:
            if len(k) >= min_chars:
                holders[k].add(i)
    common = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    return {i: (len(lines), "\n".join(x for x, k in lines if common.get(k, i) == i)) for i, lines in keyed.items()}


def test_line_dedup_matches_brute_force(docs):
    want = _brute_lines([(r.doc_id, r.text) for r in docs.collect()])
    for batches, fanout in ((4, 3), (5, 2)):
        got = {r.doc_id: (r.n_lines, r.text) for r in line_dedup(docs, batches=batches, fanout=fanout).collect()}
        assert got == want


def test_line_dedup_planted_lines(spark):
    line = "  This line is long enough to be looked at by the operator.\r"
    rows = [(i, f"first {i}\n{line}\n{line.upper() if i % 2 else line}") for i in range(7)] + [(9, line.strip()[:39])] + [(20 + i, "y" * 60) for i in range(4)]
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[6] == (3, 0, rows[6][1])
    assert got[0] == (3, 2, "first 0") and got[5] == (3, 2, "first 5")
    assert got[9][1] == 0 and got[20][1] == 0


def test_drop_lists_are_bounded_by_a_document(spark):
    """Rows that share an id, null included, have lists of their own."""
    texts = ["\n".join(f"a common line with a number of its own {10 * t + j:06d}" for j in range(3)) for t in range(20)]
    rows = [(i, t) for t in texts for i in (None, None, 1, 1, 2, 3, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    lists = drop_lists(line_rows(df, "doc_id", "text", 40, 4)).collect()
    assert len(lists) == 5 * 20 and {len(r.drops) for r in lists} == {3}
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in line_dedup(df).collect()), key=str)
    assert got == sorted(((i, 3, 0, t) if i == 4 else (i, 3, 3, "") for i, t in rows), key=str)


def test_line_runs_levels(spark):
    lines = spark.createDataFrame([(i, k, k) for i in range(12) for k in range(i % 3, 5)], "id long, hi long, lo long")
    runs = LineRuns(spark, buckets=3, fanout=2)
    first = runs.add(lines.where("id % 6 = 2"))
    assert spark.table(first).count() == 3
    for b in (1, 0, 3, 4, 5):
        runs.add(lines.where(f"id % 6 = {b}"))
        # the anti join: no line stands in two runs
        held = [r.hi for t in runs.tables() for r in spark.table(t).collect()]
        assert len(held) == len(set(held)) == {1: 4}.get(b, 5)
    assert all(len(level) < 2 for level in runs.levels) and sum(map(len, runs.levels)) <= 3 and len(runs.additions) <= 2
    got = sorted((r.hi, r.n_docs, r.owner) for r in runs.counts().collect())
    assert got == [(0, 4, 9), (1, 8, 10), (2, 12, 11), (3, 12, 11), (4, 12, 11)]
    runs.close()
    assert runs.tables() == []


def test_counts_need_the_anti_join(spark, docs, monkeypatch):
    """Without it a line would stand in several runs and be counted in none rightly."""
    want = _brute_lines([(r.doc_id, r.text) for r in docs.collect()], min_docs=3)
    assert {r.doc_id: (r.n_lines, r.text) for r in line_dedup(docs, min_docs=3).collect()} == want
    join = type(docs).join
    monkeypatch.setattr(type(docs), "join", lambda self, other, on=None, how=None: self if how == "left_anti" else join(self, other, on, how))
    assert {r.doc_id: (r.n_lines, r.text) for r in line_dedup(docs, min_docs=3).collect()} != want


def test_rows_of_one_id_are_one_document(spark):
    line = "a line that is long enough to be looked at, in rows of two ids"
    rows = [(1, f"{line}\nx{k}") for k in range(3)] + [(2, f"{line}\ny{k}") for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.n_dropped for r in line_dedup(df).collect()} == {0}
    more = df.unionByName(spark.createDataFrame([(k, line) for k in (3, 4, 5)], df.schema))
    got = sorted((r.doc_id, r.n_dropped) for r in line_dedup(more).collect())
    assert got == [(1, 1)] * 3 + [(2, 1)] * 3 + [(3, 1), (4, 1), (5, 0)]


def test_line_dedup_awkward_rows(edge_docs, no_docs):
    out = line_dedup(edge_docs, min_chars=5, min_docs=2)
    assert set(out.columns) == set(edge_docs.columns)  # result columns replace those of the same name
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect()), key=str)
    whole = "hello World, this is a text.\nwith two lines"
    assert (1, 2, 2, "") in got and got.count((5, 2, 0, whole)) == 2
    assert (2, 1, 0, "") in got and (3, 1, 0, "") in got and (4, 1, 0, LONG) in got
    assert line_dedup(no_docs).count() == 0
    assert line_rows(no_docs, "doc_id", "text", 5, 2).count() == 0
