"""Operator 11 against plain Python loops."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from errscope.llm.hard_negatives import exact_scores, hard_negatives, primes_for

from .conftest import CLASHES, SF

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, is_anchor, relabel, positives=5, negatives=5):
    """(vec_id, embedding, label) rows, one by one."""
    use = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        use.append((i, [math.floor(256 * x) for x in v], relabel(i, label)))
    out = []
    for i, v, label in use:
        if not is_anchor(i):
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), j, m) for j, w, m in use if j != i), key=lambda t: t[:2])
        for s, j, _ in [t for t in scored if t[2] == label][:positives]:
            window = [t for t in scored if t[2] != label and 80 * -s <= 100 * -t[0] <= 100 * -s]
            out += [(i, j, rank, k, -s, -t) for rank, (t, k, _) in enumerate(window[:negatives], 1)]
    return sorted(out)


def test_scores_are_exact_whatever_their_size():
    rng = np.random.default_rng(3)
    for width, top in ((1, 3), (7, 255), (64, 256), (700, 40_000), (5, 2**28)):
        a, b = (rng.integers(-top, top + 1, (n, width)).astype(np.int32) for n in (9, 13))
        bound = max(int((x.astype(object) ** 2).sum(1).max()) for x in (a, b))
        primes = primes_for(bound)
        assert math.prod(primes) > 2 * bound and len(set(primes)) == len(primes)
        got = exact_scores(a, b, primes)
        assert (got.astype(object) == a.astype(object) @ b.astype(object).T).all()


@pytest.mark.parametrize("block_rows,anchor_rows", [(4096, 256), (7, 3)])
def test_rows_equal_plain_loops(spark, block_rows, anchor_rows):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 0.3, 1.0]) for _ in range(4)], rng.randrange(3)) for i in range(-20, 160)]
    rows += [(300, None, 1), (400, [1.0, None, 0.0, 0.0], 1), (500, [float("nan")] * 4, 1), (600, [float("inf")] * 4, 0), (700, [1.0] * 4, None), (None, [1.0] * 4, 1)]
    rows += [(800, [0.0] * 4, 0), (900, [0.5, 0.5], 2), (901, [], 1)]
    relabel = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").select("*", *[F.lit(1).alias(c) for c in CLASHES if c != "label"]).repartition(3)
    got = hard_negatives(df, F.col("vec_id") % 10 == 0, relabel, block_rows=block_rows, anchor_rows=anchor_rows)
    assert got.columns == COLUMNS
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], m) for i, v, m in rows]
    want = plain(rows, lambda i: i % 10 == 0, lambda i, m: (m + 1) % 10 if i % 7 == 0 else m)
    assert sorted(map(tuple, got.collect())) == want


def test_rows_that_repeat_an_id(spark):
    rows = [(100, [1.0], 1), (100, [2.0], 1), (1, [1.0], 1), (1, [1.0], 1), (2, [1.0], 2), (3, [0.9], 2)]
    got = hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), F.col("vec_id") == 100)
    # two anchors, each with the two equal positives, each of these with both negatives
    assert got.count() == 8
    assert got.where("negative_id = 2").count() == 4


def test_empty_table_and_huge_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives(none, F.col("vec_id") % 2 == 0).collect() == []
    huge = spark.createDataFrame([(1, [1e18], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(ArithmeticError):
        hard_negatives(huge, F.lit(True))


def test_query_equals_its_sql(spark):
    import duckdb

    from errscope.llm.queries import ORACLES, QUERIES

    duckdb.sql(f"create or replace view embeddings as select * from read_parquet('{SF}/embeddings.parquet')")
    name = "op11_hard_negatives"
    got = QUERIES[name](spark, SF)
    want = duckdb.sql(ORACLES[name]).fetchall()
    assert got.count() > 0 and sorted(map(tuple, got.select(COLUMNS).collect())) == sorted(want)
