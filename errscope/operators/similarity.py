"""Token-similarity join and leader clustering.

Leader clustering of the reference is a sequential loop: take the heaviest
remaining group, absorb every remaining group whose token similarity to it is
>= accuracy, repeat. Here it runs as joins:

1. ``similarity_join`` finds all pairs with similarity >= t. Candidates come
   from a prefix-filter equi join: with items ``(token, occurrence)`` ordered
   rarest first, two sequences within the edit budget share one of the first
   ``n - ceil(t*n) + 1`` items of each; a length filter is part of the join
   condition. Over all pairs the items are grams of ``GRAM`` neighbouring tokens
   (an edit spoils at most ``GRAM`` of them), as chance seldom repeats those; only
   pairs too short for that meet by single tokens. Candidates are verified with the
   built-in ``levenshtein`` on strings holding one character per token of the pair.
2. ``leader_clustering`` takes undecided groups in blocks of falling priority.
   A block is as large as its prefix items allow for a number of candidates in
   proportion to its groups. ``leader_assignment`` resolves the loop within the
   block, in rounds: a group is a leader when no higher-priority neighbour is a
   leader; a group joins the highest-priority leader among its higher-priority
   neighbours. Then all groups that are still undecided probe an inverted
   prefix index that holds the block's new leaders only. They were similar to no
   earlier leader, so the first of these that they are similar to is theirs.
   This is exactly the sequential result for the same priority order, and m
   similar groups cost about m pairs, not m squared.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.similarity import ratio
from ..session import checkpoint_root, written
from . import tokens as K
from .ordering import global_row_number

EPS = 1e-9


def _ckpt(df: DataFrame) -> DataFrame:
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


_CODES = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])


def _codes(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """Two token sequences as strings of one character per token."""
    coded = []
    for x, y in zip(a, b):
        number: dict = {}
        text = K.code_points(np.array([number.setdefault(t, len(number)) for t in chain(x, y)], dtype=np.uint32))
        coded.append((text[: len(x)], text[len(x) :]))
    return pd.DataFrame(coded, columns=["a", "b"])


def _pair_codes(a, b):
    """Per-pair codes: number the union of the two sequences' tokens. (As an expression
    the union would be built anew for each token.)"""
    both = F.pandas_udf(_codes, _CODES)(a, b)
    return both["a"], both["b"]


def prefix_items(groups: DataFrame, threshold: float, key: str = "hash", seq: str = "sequence", by: Sequence[str] = ()) -> DataFrame:
    """(by..., key, len, token, occ): the first items of each sequence, rarest first."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    g = groups.select(*by, key, F.size(seq).alias("len"), seq)
    ex = g.select(*by, key, "len", F.posexplode(seq).alias("pos", "token"))
    ex = ex.withColumn("occ", F.row_number().over(Window.partitionBy(*by, key, "token").orderBy("pos")))
    tf = ex.groupBy(*by, "token").agg(F.count("*").alias("tf"))
    ranked = ex.join(tf, [*by, "token"]).withColumn(
        "r", F.row_number().over(Window.partitionBy(*by, key).orderBy("tf", "token", "occ"))
    )
    plen = F.col("len") - F.ceil(F.col("len") * F.lit(threshold) - F.lit(EPS)) + 1
    return ranked.where(F.col("r") <= plen).select(*by, key, "len", "token", "occ")


def _meeting(left: DataFrame, right: DataFrame, threshold: float, key: str, by: Sequence[str]) -> DataFrame:
    """(by..., key_a, key_b): sequences of two tables of prefix items that share
    one and may be similar by their lengths."""
    a = left.select(*by, F.col(key).alias("key_a"), F.col("len").alias("len_a"), "token", "occ")
    b = right.select(*by, F.col(key).alias("key_b"), F.col("len").alias("len_b"), "token", "occ")
    near = F.least("len_a", "len_b") >= F.greatest("len_a", "len_b") * F.lit(threshold) - F.lit(EPS)
    return a.join(b, [*by, "token", "occ"]).where(near & (F.col("key_a") != F.col("key_b"))).select(*by, "key_a", "key_b")


#: Neighbouring tokens that make an item of the similarity join.
GRAM = 2


def gram_items(groups: DataFrame, threshold: float, key: str = "hash", seq: str = "sequence", by: Sequence[str] = (), gram: int = GRAM) -> DataFrame:
    """(by..., key, len, token, occ): of the first items of each sequence, rarest
    first, those that another sequence has too; ``token`` is the hash of a gram.

    ``k`` edits spoil at most ``gram * k`` of the ``n - gram + 1`` grams of the longer
    sequence. Items of one sequence alone count for the order but meet nothing, so they
    go no further than the count. (Grams of equal hash only add candidates.)"""
    g = groups.select(*by, key, F.size(seq).alias("len"), seq).where(F.col("len") >= gram)
    at = F.sequence(F.lit(1), F.col("len") - (gram - 1))
    grams = F.transform(at, lambda i: F.xxhash64(*[F.element_at(seq, i + k) for k in range(gram)]))
    ex = g.select(*by, key, "len", F.explode(grams).alias("token"))
    twice = ex.groupBy(*by, "token").agg(F.count("*").alias("_n")).where("_n > 1").select(*by, "token")
    ex = ex.join(twice, [*by, "token"], "left_semi").groupBy(*by, key, "len", "token").agg(F.count("*").cast("int").alias("_n"))
    ex = written(ex.select(*by, key, "len", "token", F.explode(F.sequence(F.lit(1), "_n")).alias("occ")), "grams")
    tf = ex.groupBy(*by, "token", "occ").agg(F.count("*").alias("tf")).where("tf > 1")
    own = Window.partitionBy(*by, key)
    alone = F.col("len") - (gram - 1) - F.count("*").over(own)
    ranked = ex.join(tf, [*by, "token", "occ"]).withColumn("r", alone + F.row_number().over(own.orderBy("tf", "token", "occ")))
    plen = F.col("len") - F.ceil(F.col("len") * F.lit(_kept_share(threshold, gram)) - F.lit(4 * EPS)) + 1
    return ranked.where(F.col("r") <= plen).select(*by, key, "len", "token", "occ")


def _kept_share(threshold: float, gram: int) -> float:
    """Share of a sequence's length that bounds from below what edits leave of its grams."""
    return 1 - gram * (1 - threshold)


def candidate_pairs(groups: DataFrame, threshold: float, key: str = "hash", seq: str = "sequence", by: Sequence[str] = ()) -> DataFrame:
    """Prefix-filter candidates (by..., key_a, key_b) with key_a < key_b: by grams where
    the longer sequence surely keeps one, by single tokens else."""
    share = _kept_share(threshold, GRAM)
    # from this length on a pair shares a gram; below 0.05 it takes such lengths that tokens do as well
    least = math.floor((GRAM - 1 + 8 * EPS) / share) + 1 if share >= 0.05 else None
    short = groups if least is None else groups.where(F.size(seq) < least)
    prefix = prefix_items(short, threshold, key, seq, by)
    met = _meeting(prefix, prefix, threshold, key, by).where(F.col("key_a") < F.col("key_b"))
    if least is not None:
        long = groups.where(F.size(seq) >= F.lit(threshold * least - EPS))
        items = written(gram_items(long, threshold, key, seq, by), "grams")  # both sides read them
        met = met.unionByName(_meeting(items, items, threshold, key, by).where(F.col("key_a") < F.col("key_b")))
    return met.distinct()


def verified_pairs(cand: DataFrame, groups: DataFrame, threshold: float, key: str = "hash", seq: str = "sequence", by: Sequence[str] = ()) -> DataFrame:
    """(by..., key_a, key_b, similarity) of the candidates that are similar enough.

    Tokens are numbered within each pair, so the vocabulary may have any size."""
    ga = groups.select(*by, F.col(key).alias("key_a"), F.col(seq).alias("seq_a"))
    gb = groups.select(*by, F.col(key).alias("key_b"), F.col(seq).alias("seq_b"))
    j = cand.join(ga, [*by, "key_a"]).join(gb, [*by, "key_b"])
    ca, cb = _pair_codes(F.col("seq_a"), F.col("seq_b"))
    j = j.withColumn("ca", ca).withColumn("cb", cb)
    la, lb = F.size("seq_a"), F.size("seq_b")
    budget = F.floor((1 - F.lit(threshold)) * F.greatest(la, lb) + F.lit(EPS)).cast("int")
    # bounded distance: -1 once the edit budget is exceeded
    j = j.withColumn("_budget", budget).withColumn("_d", F.expr("levenshtein(ca, cb, _budget)")).where(F.col("_d") >= 0)
    j = j.withColumn("similarity", ratio(F.col("_d"), la, lb)).where(F.col("similarity") >= F.lit(threshold))
    return j.select(*by, "key_a", "key_b", "similarity")


def similarity_join(
    groups: DataFrame, threshold: float = 0.8, key: str = "hash", seq: str = "sequence", by: Sequence[str] = ()
) -> DataFrame:
    """All pairs (by..., key_a, key_b, similarity) with token similarity >= threshold."""
    return verified_pairs(candidate_pairs(groups, threshold, key, seq, by), groups, threshold, key, seq, by)


def leader_assignment(
    groups: DataFrame,
    edges: DataFrame,
    key: str = "hash",
    weight: str = "cluster_size",
    by: Sequence[str] = (),
    max_rounds: int = 10_000,
) -> DataFrame:
    """V14 core: (by..., key, leader) with priority ``weight desc, key asc``.

    ``edges`` holds undirected similar pairs (key_a, key_b). Rounds run until
    every group is decided; each round's state is checkpointed.
    """
    nodes = groups.select(*by, key, weight)
    prio = lambda w, k: F.struct(-F.col(w), F.col(k))  # noqa: E731 - smaller is higher priority
    ea = edges.select(*by, "key_a", "key_b")
    wa = nodes.select(*by, F.col(key).alias("key_a"), F.col(weight).alias("w_a"))
    wb = nodes.select(*by, F.col(key).alias("key_b"), F.col(weight).alias("w_b"))
    e = ea.join(wa, [*by, "key_a"]).join(wb, [*by, "key_b"])
    a_first = prio("w_a", "key_a") < prio("w_b", "key_b")
    directed = e.select(
        *by,
        F.when(a_first, F.col("key_a")).otherwise(F.col("key_b")).alias("hi"),
        F.when(a_first, F.col("w_a")).otherwise(F.col("w_b")).alias("w_hi"),
        F.when(a_first, F.col("key_b")).otherwise(F.col("key_a")).alias("lo"),
    )
    directed = _ckpt(directed)

    # state: 0 undecided, 1 leader, 2 member
    has_higher = directed.select(*by, F.col("lo").alias(key)).distinct().withColumn("_h", F.lit(True))
    state = nodes.select(*by, key).join(has_higher, [*by, key], "left").select(
        *by, key, F.when(F.col("_h").isNull(), F.lit(1)).otherwise(F.lit(0)).alias("st")
    )
    state = _ckpt(state)
    for _ in range(max_rounds):
        undecided = state.where("st = 0")
        if undecided.isEmpty():
            break
        hi_state = state.select(*by, F.col(key).alias("hi"), F.col("st").alias("st_hi"))
        per_lo = (
            directed.join(undecided.select(*by, F.col(key).alias("lo")), [*by, "lo"], "left_semi")
            .join(hi_state, [*by, "hi"])
            .groupBy(*by, "lo")
            .agg(
                F.max(F.when(F.col("st_hi") == 1, 1).otherwise(0)).alias("any_leader"),
                F.min(F.when(F.col("st_hi") == 2, 1).otherwise(0)).alias("all_member"),
            )
        )
        upd = per_lo.select(
            *by,
            F.col("lo").alias(key),
            F.when(F.col("any_leader") == 1, 2).when(F.col("all_member") == 1, 1).otherwise(0).alias("_new"),
        )
        state = state.join(upd, [*by, key], "left").select(
            *by, key, F.when(F.col("st") == 0, F.coalesce("_new", "st")).otherwise(F.col("st")).alias("st")
        )
        state = _ckpt(state)
    else:
        raise RuntimeError("leader rounds did not converge")

    leaders = state.where("st = 1").select(*by, F.col(key).alias("hi"))
    members = (
        directed.join(leaders, [*by, "hi"], "left_semi")
        .groupBy(*by, "lo")
        .agg(F.min_by("hi", F.struct(-F.col("w_hi"), F.col("hi"))).alias("leader"))
        .select(*by, F.col("lo").alias(key), "leader")
    )
    return state.join(members, [*by, key], "left").select(
        *by, key, F.when(F.col("st") == 1, F.col(key)).otherwise(F.col("leader")).alias("leader")
    )


#: A block may have this many candidates for each of its groups, and this many in any case.
PAIRS_PER_GROUP = 64
PAIRS_AT_LEAST = 1_000_000


def leaders_in_blocks(
    groups: DataFrame,
    accuracy: float = 0.8,
    key: str = "hash",
    seq: str = "sequence",
    weight: str = "cluster_size",
    by: Sequence[str] = (),
    pairs_per_group: int = PAIRS_PER_GROUP,
    pairs_at_least: int = PAIRS_AT_LEAST,
) -> tuple[DataFrame, int]:
    """((by..., key, leader) of all groups, number of pairs that were verified)."""
    prefix = _ckpt(prefix_items(groups, accuracy, key, seq, by))
    ids = [*by, key]
    left = groups.select(*ids, weight)
    total = left.count()
    done, pairs, share = None, 0, 1.0
    ranked = False
    while total:
        block = left
        while True:
            if share < 1:
                if not ranked:
                    # places in the order of priority, which cut blocks off
                    left = _ckpt(global_row_number(left.withColumn("_w", -F.col(weight)), ["_w", key, *by], "_place").drop("_w"))
                    ranked = True
                cut = left.agg(F.percentile_approx("_place", share, 10_000)).first()[0]
                block = left.where(F.col("_place") <= cut)
            size = block.count() if share < 1 else total
            items = prefix if share == 1 and done is None else prefix.join(block.select(*ids), ids, "left_semi")
            met = items.groupBy(*by, "token", "occ").agg(F.count("*").alias("_n")).agg(F.sum(F.col("_n") * (F.col("_n") - 1) / 2)).first()[0] or 0
            if met <= max(pairs_at_least, pairs_per_group * size) or size <= 2:
                break
            share = max(share / 4, 1.5 / total)
        members = groups.join(block.select(*ids), ids, "left_semi")
        cand = _ckpt(_meeting(items, items, accuracy, key, by).where(F.col("key_a") < F.col("key_b")).distinct())
        pairs += cand.count()
        edges = verified_pairs(cand, members, accuracy, key, seq, by)
        found = leader_assignment(members, edges, key, weight, by)
        found = _ckpt(found)
        done = found if done is None else done.unionByName(found)
        if size == total:
            break
        rest = left.join(block.select(*ids), ids, "left_anti")
        leaders = found.where(F.col(key) == F.col("leader")).select(*ids)
        probed = _meeting(prefix.join(leaders, ids, "left_semi"), prefix.join(rest.select(*ids), ids, "left_semi"), accuracy, key, by).distinct()
        probed = _ckpt(probed)
        pairs += probed.count()
        near = verified_pairs(probed, groups, accuracy, key, seq, by)
        order = groups.select(*by, F.col(key).alias("key_a"), F.col(weight).alias("_w"))
        joined = near.join(order, [*by, "key_a"]).groupBy(*by, "key_b").agg(F.min_by("key_a", F.struct(-F.col("_w"), F.col("key_a"))).alias("leader"))
        joined = _ckpt(joined.select(*by, F.col("key_b").alias(key), "leader"))
        done = done.unionByName(joined)
        left = _ckpt(rest.join(joined.select(*ids), ids, "left_anti"))
        total = left.count()
        share = min(1.0, share * 4)
    if done is None:
        done = groups.select(*ids, F.col(key).alias("leader"))
    return done, pairs


def leader_clustering(
    groups: DataFrame, accuracy: float = 0.8, key: str = "hash", seq: str = "sequence", weight: str = "cluster_size", by: Sequence[str] = ()
) -> DataFrame:
    """V14/V15 assignment: groups with their leader key. ``groups`` is read
    several times, so callers pass a checkpointed or written table."""
    assign, _ = leaders_in_blocks(groups, accuracy, key, seq, weight, by)
    return groups.join(assign, [*by, key])
