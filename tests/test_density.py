"""Exact neighbour searches against NumPy brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from errscope.operators import density as D


@pytest.fixture(scope="module")
def cloud(spark):
    rnd = np.random.default_rng(5)
    centers = rnd.normal(size=(4, 6)) * 3
    x = np.vstack([c + rnd.normal(scale=0.4, size=(40, 6)) for c in centers])
    rows = [(int(i), [float(v) for v in x[i]]) for i in range(len(x))]
    return x, spark.createDataFrame(rows, "id long, vec array<double>")


def brute(x):
    return np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2))


@pytest.mark.parametrize("eps", [0.3, 0.8, 2.0])
def test_radius_join(cloud, eps):
    x, df = cloud
    d = brute(x)
    want = {(i, j) for i, j in zip(*np.nonzero(d <= eps)) if i != j}
    got = {(r.id_q, r.id_p) for r in D.radius_join(df, eps, block=25).collect()}
    assert got == want


def test_knn(cloud):
    x, df = cloud
    d = brute(x)
    k = 7
    got = D.knn(df, k).collect()
    for r in got:
        assert abs(np.sort(d[r.id_q])[r.j - 1] - r.dist) < 1e-9


def test_dbscan_components(cloud):
    x, df = cloud
    d = brute(x)
    eps = 0.9
    # union-find over the eps graph
    parent = list(range(len(x)))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for i, j in zip(*np.nonzero(d <= eps)):
        parent[find(i)] = find(j)
    comp = {}
    for i in range(len(x)):
        comp.setdefault(find(i), []).append(i)
    want = {i: min(m) for m in comp.values() for i in m}
    got = {r.id: r.component for r in D.dbscan(df, eps).collect()}
    assert got == want


def sequential_ward(x, threshold):
    clusters = {i: [i] for i in range(len(x))}
    while True:
        best = None
        keys = sorted(clusters)
        for ai, a in enumerate(keys):
            for b in keys[ai + 1:]:
                na, nb = len(clusters[a]), len(clusters[b])
                d = np.sqrt(2 * na * nb / (na + nb)) * np.linalg.norm(x[clusters[a]].mean(0) - x[clusters[b]].mean(0))
                if d < threshold and (best is None or d < best[0]):
                    best = (d, a, b)
        if best is None:
            return {i: min(m) for m in clusters.values() for i in m}
        _, a, b = best
        clusters[min(a, b)] = clusters[a] + clusters[b]
        del clusters[max(a, b)]


@pytest.mark.parametrize("local_points", [2000, 5])
def test_ward_equals_sequential(spark, cloud, local_points):
    """Inside tasks, and (5) in rounds where components are larger."""
    from errscope.operators.agglomerative import ward_clusters

    x, df = cloud
    n = 10 if local_points == 5 else 60
    for threshold in (1.5,):
        got = {r.id: r.component for r in ward_clusters(df.where(f"id < {n}"), threshold, local_points=local_points).collect()}
        assert got == sequential_ward(x[:n], threshold)


def test_ward_chain_equals_sequential_on_random_points():
    from errscope.operators.agglomerative import nearest_neighbour_chain

    rnd = np.random.default_rng(7)
    for _ in range(12):
        x = rnd.normal(size=(int(rnd.integers(1, 20)), 3))
        for threshold in (0.3, 0.8, 2.0, 10.0):
            got = nearest_neighbour_chain(x, threshold)
            assert dict(enumerate(got.tolist())) == sequential_ward(x, threshold)


def test_radius_join_with_salted_blocks_is_monotone_and_exact(cloud):
    x, df = cloud
    d = brute(x)
    for eps in (2.0, 50.0):  # at 50 one cell holds every point -> several salted blocks
        want = {(i, j) for i, j in zip(*np.nonzero(d <= eps)) if i != j}
        got = {(r.id_q, r.id_p) for r in D.radius_join(df, eps, block=30).collect()}
        assert got == want


@pytest.mark.parametrize("k", [3, 40])
def test_knn_over_blocks_with_repeated_ids(spark, cloud, k):
    """Several blocks of leaves: every list is whole, in order, and of one id."""
    x, df = cloud
    d = brute(x)
    twice = df.unionByName(df.where("id < 5"))
    for points, ids in ((df, np.arange(len(x))), (twice, np.concatenate([np.arange(len(x)), np.arange(5)]))):
        got = {}
        for r in D.knn(points, k, block=12).collect():
            got.setdefault(r.id_q, {})[r.j] = (r.dist, r.id_p)
        assert set(got) == set(range(len(x)))
        for q, found in got.items():
            assert sorted(found) == list(range(1, k + 1))
            pool = sorted([(d[q, p], p) for p in ids for _ in range(int((ids == q).sum()))])
            assert np.allclose([found[j][0] for j in range(1, k + 1)], [w for w, _ in pool[:k]], atol=1e-9)


def test_components_over_blocks(cloud):
    x, df = cloud
    whole = {r.id: r.component for r in D.dbscan(df, 0.9).collect()}
    assert {r.id: r.component for r in D.dbscan(df, 0.9, block=12).collect()} == whole


def test_no_task_holds_all_queries_of_a_leaf(spark):
    """Vectors without clusters need every leaf: a block is bounded all the same, and a leaf goes to a block once."""
    from errscope.operators.metric_tree import build_tree
    from errscope.operators.sweep import BLOCK_LEAVES, needed_leaves, query_blocks

    x = np.random.default_rng(3).normal(size=(1500, 24))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>").withColumn("part", F.lit(""))
    tree = build_tree(df, leaf=40)
    bins = query_blocks(tree, BLOCK_LEAVES * 40).persist()
    sizes = [r.n for r in tree.members.join(bins, "cell").groupBy("bin").agg((F.count("*") / F.first("parts")).alias("n")).collect()]
    assert len(sizes) > 4 and max(sizes) <= 2 * BLOCK_LEAVES * 40
    asked = needed_leaves(tree, bins, D._same_reach(tree, 5.0))
    sent = asked.join(tree.leaves(), "cell").agg(F.sum("n")).collect()[0][0]
    assert sent <= len(sizes) * len(x)


def test_groups_join_over_shared_points():
    from errscope.operators.sweep import joined

    got = joined(np.arange(5), np.array([0, 3, 3, 4]), np.array([0, 0, 1, 1]), 2)
    assert got.tolist() == [0, 1, 2, 0, 0]
