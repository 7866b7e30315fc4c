"""Pattern mining: order-free common patterns and the native M2/M3/M4/M6."""

import difflib
import random

import pytest
from pyspark.sql import functions as F

from errscope.functions.constants import WILDCARD
from errscope.operators import patterns as PT


def mined(spark, rows, **kw):
    df = spark.createDataFrame([("c", s, w) for s, w in rows], "k string, tk array<string>, n long")
    return PT.common_pattern(df, ["k"], "tk", weight="n", **kw).first().pattern


def test_pattern_keeps_what_all_gated_sequences_match(spark):
    rows = [(["a", "b", "c", "d"], 3), (["a", "x", "c", "d"], 1), (["a", "b", "c", "e"], 1), (["q", "r"], 1)]
    assert mined(spark, rows) == ["a", "c"]
    assert mined(spark, rows, add_placeholder=True) == ["a", WILDCARD, "c"]
    assert mined(spark, rows, gated=False) == []


def test_pattern_of_one_sequence_and_of_empty_ones(spark):
    assert mined(spark, [(["a", "b"], 4)]) == ["a", "b"]
    assert mined(spark, [([], 4), (None, 1)]) == []


def test_pattern_of_punctuation_falls_back_to_the_heaviest(spark):
    assert mined(spark, [([":", "a", "."], 2), ([":", "b", "."], 1)]) == [":", "a", "."]


def test_pattern_does_not_depend_on_order_or_size(spark):
    rnd = random.Random(3)
    rows = [(["job", f"w{i}", "ended", "on", f"h{i % 70}", "now"], 1 + (i == 17)) for i in range(6000)]
    want = ["job", WILDCARD, "ended", "on", WILDCARD, "now"]
    for n in (1, 13):
        rnd.shuffle(rows)
        df = spark.createDataFrame([("c", s, w) for s, w in rows], "k string, tk array<string>, n long").repartition(n)
        assert PT.common_pattern(df, ["k"], "tk", weight="n", add_placeholder=True).first().pattern == want


def test_matcher_pattern(spark):
    rows = [("c", 1, ["a", "b", "c"]), ("c", 2, ["a", "x", "c"]), ("d", 3, ["z"])]
    df = spark.createDataFrame(rows, "k string, id long, tk array<string>")
    got = {r.k: r.pattern for r in PT.matcher_pattern(df, ["k"], "tk", "id").collect()}
    assert got == {"c": ["a", WILDCARD, "c"], "d": ["z"]}


def test_positional(spark):
    rows = [("c", ["a", "b", "c"]), ("c", ["a", "x"]), ("c", ["a", "y", "z"])]
    df = spark.createDataFrame(rows, "k string, tk array<string>")
    assert PT.positional_pattern(df, ["k"], "tk").first().pattern == ["a", WILDCARD]
    assert PT.positional_alternatives(df, ["k"], "tk").first().pattern == ["a", "b|x|y{3}"]


def test_phrases_rank_longer_phrases_first(spark):
    rows = [("c", ["connection", "refused", "by", "peer"]), ("c", ["connection", "refused"])]
    df = spark.createDataFrame(rows, "k string, tk array<string>")
    ph = PT.common_phrases(df, ["k"], "tk").orderBy(F.desc("score"), "phrase").collect()
    assert [r.phrase for r in ph] == ["connection refused", "peer"]
    assert ph[0].score == 4.0 and ph[1].score == 1.0


@pytest.mark.parametrize("gated", [True, False])
def test_sequences_of_one_shape_are_aligned_once(spark, gated):
    """Sequences that differ in tokens of their own only are one alignment, and the pattern is that of all."""
    rnd = random.Random(9)
    rows = []
    for i in range(600):
        for c, words in (("a", "copy of X failed at Y now X"), ("b", "x y x X z y Y x"), ("c", "A B X Y D")):
            some = [f"{w}{i}" if w in "XY" else w for w in words.split()]
            if i % 3 == 0:
                some.insert(rnd.randrange(len(some)), f"new{i}")
            if i % 50 == 0:
                some = [f"own{i}_{k}" for k in range(4)] + some[:1]
            rows.append((c, some))
    df = spark.createDataFrame(rows, "c string, tk array<string>")
    level = df.groupBy("c", F.col("tk").alias("_s")).agg(F.count("*").alias("_w"))
    start = level.groupBy("c").agg(F.min("_s").alias("_start"))
    shapes = PT._shapes(level, start, ["c"])
    assert shapes.count() < 60 and shapes.agg(F.sum("_k")).first()[0] == level.count()
    got = {r.c: r.pattern for r in PT.common_pattern(df, ["c"], "tk", gated=gated).collect()}
    for c in "abc":
        seqs = sorted({tuple(s) for k, s in rows if k == c})
        first = min(seqs)
        kept = set(range(len(first)))
        for s in seqs:
            m = difflib.SequenceMatcher(None, list(first), list(s))
            if not gated or m.ratio() > 0.5:
                kept &= {i for b in m.get_matching_blocks() for i in range(b.a, b.a + b.size)}
        want = [first[i] for i in sorted(kept)]
        assert got[c] == (list(first) if gated and not want else want)
