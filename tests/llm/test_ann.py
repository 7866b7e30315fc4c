"""Operator 8: recall against brute force, exact scores, awkward vectors."""

from __future__ import annotations

import numpy as np
from errscope.llm.ann_search import adaptive_scan, ann_search
from pyspark.sql import functions as F

from .conftest import SF


def _brute(ids, x, queries, k):
    out = {}
    for q in queries:
        score = x @ x[np.flatnonzero(ids == q)[0]]
        keep = np.flatnonzero(ids != q)
        order = keep[np.lexsort((ids[keep], -score[keep]))][:k]
        out[int(q)] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def _result(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def _recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want])


def test_embeddings(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    data = rows.orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in data]), np.array([r.embedding for r in data], dtype=float)
    want = _brute(ids, x, ids[ids % 20 == 0], 20)
    got = _result(ann_search(rows, F.col("vec_id") % 20 == 0))
    assert set(got) == set(want) and _recall(got, want) >= 0.9
    truth = {q: dict(zip(ids.tolist(), x @ x[np.flatnonzero(ids == q)[0]])) for q in want}
    assert all(abs(truth[q][i] - s) < 1e-12 for q in got for i, s in got[q])


def test_many_lists_and_lengths(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(30, 24))
    x = np.round(centre[rng.integers(0, 30, 3000)] + 0.3 * rng.normal(size=(3000, 24)), 3) * rng.uniform(0.5, 2, 3000)[:, None]
    ids = np.arange(3000)
    rows = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>").repartition(4)
    want = _brute(ids, x, ids[::20], 20)
    got = _result(ann_search(rows, F.col("vec_id") % 20 == 0, part_rows=50, list_rows=30))
    assert _recall(got, want) >= 0.9 and all(len(v) == 20 for v in got.values())


def test_adaptive_scan_abandons_and_keeps_the_near_ones():
    rng = np.random.default_rng(3)
    rows, queries = rng.normal(size=(500, 64)), rng.normal(size=(5, 64))
    rows[:10] = queries[0] + 0.1 * rng.normal(size=(10, 64))
    q, r = adaptive_scan(queries, rows, np.full(5, 4.0), 8, 2.1)
    assert set(r[q == 0]) == set(range(10)) and not len(r[q > 0])
    q, r = adaptive_scan(queries, rows, np.full(5, np.inf), 8, 2.1)
    assert len(q) == 2500


def test_common_vector_and_ties(spark):
    rows = [(i, [1.0, 0.0]) for i in range(60)] + [(100 + i, [0.5, 0.1 * i]) for i in range(10)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = _result(ann_search(df, F.col("vec_id") % 20 == 0, k=5))
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[20]] == [0, 1, 2, 3, 4] and [i for i, _ in got[40]] == [0, 1, 2, 3, 4]
    assert [i for i, _ in got[100]] == [0, 1, 2, 3, 4]


def test_awkward_vectors(spark):
    inf = float("inf")
    rows = [(0, [1.0, 1.0], "c"), (1, None, "c"), (2, [], "c"), (3, [0.0, 0.0], "c"), (4, [1.0, None], "c"), (5, [inf, 1.0], "c"), (6, [float("nan"), 1.0], "c"), (20, [2.0, 0.5], "c"), (20, [2.0, 0.5], "c"), (None, [1.0, 1.0], "c"), (7, [1.0, 2.0, 3.0], "c"), (40, None, "c"), (60, [0.0, 0.0], "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id string").withColumn("list", F.lit(1)).withColumn("shard", F.lit(1))
    got = _result(ann_search(df, F.col("vec_id") % 20 == 0))
    assert got == {0: [(20, 2.5), (20, 2.5)], 20: [(0, 2.5)]}
    assert ann_search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_memory_of_a_shard_does_not_follow_its_queries():
    """Queries pass by the rows of a shard in slices, and pairs are scored in slices."""
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa
    from errscope.llm.ann_search import Index, _search

    rng = np.random.default_rng(4)
    rows, asked = rng.normal(size=(1000, 64)), rng.normal(size=(6000, 64))
    index = Index(float((rows**2).sum(1).max()), np.eye(65), np.zeros((1, 65)), 1)

    def batches(ids, x, side):
        for at in range(0, len(ids), 2000):
            some, of_list = x[at : at + 2000], np.zeros(len(x[at : at + 2000]), np.int32)
            number, vec = np.zeros(len(some), np.int32), pa.ListArray.from_arrays(np.arange(len(some) + 1, dtype=np.int32) * 64, some.ravel())
            lists = pa.ListArray.from_arrays(np.arange(len(some) + 1, dtype=np.int32), pa.array(of_list))
            yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(number + side), pa.array(ids[at : at + 2000]), vec, lists], names=["shard", "side", "id", "vec", "lists"])

    ids, names = np.arange(1000), 10_000 + np.arange(6000)
    tracemalloc.start()
    found = {}
    for out in _search(SimpleNamespace(value=index), 5, 16, 2.1)(part for side in (batches(ids, rows, 0), batches(names, asked, 1)) for part in side):
        for q, r, s in zip(*(c.to_numpy() for c in out.columns)):
            found.setdefault(q, []).append((r, s))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    score = asked[:50] @ rows.T
    for q in range(50):
        assert [r for r, _ in sorted(found[10_000 + q], key=lambda f: -f[1])] == np.argsort(-score[q])[:5].tolist()
    assert len(found) == 6000 and peak < 60e6
