"""Leader clustering by rounds equals the sequential loop; similarity join is exact."""

import random

import pytest
from pyspark.sql import functions as F

from errscope.operators import similarity as S


def edit(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1]


def sim(a, b):
    m = max(len(a), len(b))
    return 1.0 if m == 0 else 1 - edit(a, b) / m


def sequential(groups, t):
    """The reference loop: heaviest remaining group leads, absorbs all >= t."""
    left = sorted(groups, key=lambda g: (-g[1], g[0]))
    out = {}
    while left:
        lead = left[0]
        taken = [g for g in left if g is lead or sim(lead[2], g[2]) >= t]
        for g in taken:
            out[g[0]] = lead[0]
        left = [g for g in left if g[0] not in out]
    return out


def random_groups(seed, n=40):
    rnd = random.Random(seed)
    vocab = [f"t{i}" for i in range(8)]
    base = [[rnd.choice(vocab) for _ in range(rnd.randint(3, 9))] for _ in range(5)]
    groups, seen = [], set()
    for i in range(n):
        s = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 3)):
            op = rnd.random()
            if op < 0.4 and s:
                s[rnd.randrange(len(s))] = rnd.choice(vocab)
            elif op < 0.7:
                s.insert(rnd.randrange(len(s) + 1), rnd.choice(vocab))
            elif s:
                s.pop(rnd.randrange(len(s)))
        key = " ".join(s)
        if key in seen:
            continue
        seen.add(key)
        groups.append((f"h{i:03d}", rnd.randint(1, 5), s))
    return groups


@pytest.mark.parametrize("seed,t", [(1, 0.8), (2, 0.7), (3, 0.5), (4, 0.8), (5, 0.6)])
def test_rounds_equal_sequential(spark, seed, t):
    groups = random_groups(seed)
    df = spark.createDataFrame(groups, "hash string, cluster_size long, sequence array<string>")
    got = {r.hash: r.leader for r in S.leader_clustering(df, t).select("hash", "leader").collect()}
    assert got == sequential(groups, t)


@pytest.mark.parametrize("seed,t", [(7, 0.8), (8, 0.6)])
def test_similarity_join_is_complete(spark, seed, t):
    groups = random_groups(seed, 60)
    df = spark.createDataFrame(groups, "hash string, cluster_size long, sequence array<string>")
    got = {(r.key_a, r.key_b) for r in S.similarity_join(df, t).collect()}
    want = set()
    for a in groups:
        for b in groups:
            if a[0] < b[0] and sim(a[2], b[2]) >= t:
                want.add((a[0], b[0]))
    assert got == want


def test_every_code_is_one_character_of_its_own(spark):
    from errscope.operators.tokens import code_point_char

    rows = spark.range(0, 1_112_000, 1, 8).select(code_point_char(F.col("id")).alias("c"))
    got = rows.agg(F.min(F.length("c")).alias("lo"), F.max(F.length("c")).alias("hi"), F.countDistinct("c").alias("n")).first()
    assert (got.lo, got.hi, got.n) == (1, 1, 1_112_000)


def test_similarity_join_with_many_tokens(spark):
    """Over 70,000 distinct tokens: the pairs differ in their last token only."""
    rows = [(f"{i:05d}{side}", [f"t{i}_{k}" for k in range(9)] + [f"{side}{i}"], 1) for i in range(8000) for side in "ab"]
    df = spark.createDataFrame(rows, "hash string, sequence array<string>, cluster_size long")
    got = S.similarity_join(df, 0.9).agg(F.count("*").alias("n"), F.min("similarity").alias("lo"), F.max("similarity").alias("hi")).first()
    assert got.n == 8000 and abs(got.lo - 0.9) < 1e-12 and abs(got.hi - 0.9) < 1e-12


def test_empty_sequence_is_its_own_cluster(spark):
    groups = [("a", 5, ["x", "y"]), ("b", 9, []), ("c", 1, ["x", "y"])]
    df = spark.createDataFrame(groups, "hash string, cluster_size long, sequence array<string>")
    got = {r.hash: r.leader for r in S.leader_clustering(df, 0.8).collect()}
    assert got == {"a": "a", "b": "b", "c": "a"}


@pytest.mark.parametrize("seed", [3, 4])
@pytest.mark.parametrize("least", [0, 40])
def test_blocks_of_falling_priority_equal_the_loop(spark, seed, least):
    groups = random_groups(seed, 70)
    df = spark.createDataFrame(groups, "hash string, cluster_size int, sequence array<string>")
    found, _ = S.leaders_in_blocks(df, 0.7, pairs_per_group=1, pairs_at_least=least)
    assert {r.hash: r.leader for r in found.collect()} == sequential(groups, 0.7)


def test_blocks_within_keys(spark):
    rows = [(site, *g) for site, seed in (("a", 5), ("b", 6), (None, 7)) for g in random_groups(seed, 40)]
    df = spark.createDataFrame(rows, "site string, hash string, cluster_size int, sequence array<string>").where("site is not null")
    found, _ = S.leaders_in_blocks(df, 0.7, by=["site"], pairs_per_group=1, pairs_at_least=10)
    got = {(r.site, r.hash): r.leader for r in found.collect()}
    want = {(s, h): lead for s in "ab" for h, lead in sequential([g[1:] for g in rows if g[0] == s], 0.7).items()}
    assert got == want


def test_similar_groups_cost_pairs_in_proportion(spark):
    """m groups of one cluster: every one is held against its leader, not against the others."""
    words = [f"w{i}" for i in range(20)]
    cost = []
    for m in (400, 1600):
        groups = [(f"h{i:05d}", m - i, [*words[: i % 20], f"x{i}", *words[i % 20 + 1 :]]) for i in range(m)]
        df = spark.createDataFrame(groups, "hash string, cluster_size int, sequence array<string>").checkpoint()
        found, pairs = S.leaders_in_blocks(df, 0.8, pairs_per_group=8, pairs_at_least=100)
        assert {r.leader for r in found.collect()} == {"h00000"}
        cost.append(pairs / m)
    assert cost[1] < 2 * cost[0] and cost[1] < 10


@pytest.mark.parametrize("t", [0.8, 0.6, 0.52, 1.0])
def test_similarity_join_by_grams_is_complete(spark, t):
    """Long and short sequences with repeated tokens: grams and single tokens together find all pairs."""
    rnd = random.Random(11)
    groups = [(f"h{i:03d}", 1, [rnd.choice("abc") for _ in range(rnd.randint(0, 6))]) for i in range(60)]
    for i in range(60, 140):
        s = list(rnd.choice(groups[:5] + groups[60:])[2]) + [rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 12))]
        groups.append((f"h{i:03d}", 1, s))
    df = spark.createDataFrame(groups, "hash string, cluster_size long, sequence array<string>")
    got = {(r.key_a, r.key_b): r.similarity for r in S.similarity_join(df, t).collect()}
    want = {(a[0], b[0]): sim(a[2], b[2]) for a in groups for b in groups if a[0] < b[0] and (a[2] or b[2]) and sim(a[2], b[2]) >= t}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)


def test_common_words_bring_no_candidates(spark):
    """Sequences drawn from the same 400 words: no pair is similar, few may be compared."""
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = [(f"h{i:04d}", 1, [rnd.choice(words) for _ in range(40)]) for i in range(600)]
    df = spark.createDataFrame(rows, "hash string, cluster_size long, sequence array<string>").checkpoint()
    assert S.candidate_pairs(df, 0.8).count() < 600 * 20


def test_pair_codes_number_tokens_once(spark):
    """Two sequences of 20,000 tokens are coded in one pass each."""
    import time

    rows = [([f"t{i}" for i in range(20_000)], [f"t{i}" for i in range(20_000, 0, -1)])]
    ca, cb = S._pair_codes(F.col("a"), F.col("b"))
    began = time.time()
    got = spark.createDataFrame(rows, "a array<string>, b array<string>").select(ca.alias("a"), cb.alias("b")).first()
    assert time.time() - began < 20
    assert len(set(got.a)) == len(set(got.b)) == 20_000 and got.a[1:] == got.b[:0:-1]
