"""Pattern mining per cluster.

All are aggregations and joins. M1/M5 align each distinct sequence with its
cluster's heaviest one by ``difflib`` in a vectorised function over pairs of
sequences; which positions survive is an aggregation.
"""

from __future__ import annotations

import difflib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import PHRASE_SENTENCE_SPLIT, PHRASE_STOP_WORDS, PUNCTUATION, SPACER, WILDCARD
from ..functions.text import dedup_adjacent_tokens
from .tokens import reassemble


# ------------------------------------------------------------------ M2
def matcher_pattern(df: DataFrame, cluster_cols: Sequence[str], tokens: str, id_col: str, wildcard: str = WILDCARD) -> DataFrame:
    """M2: tokens of the cluster's first sequence that occur at least once per
    sequence on average (count >= number of sequences); the others become the
    wildcard; runs of equal tokens collapse. One sequence: returned as is."""
    cl = list(cluster_cols)
    head = df.groupBy(*cl).agg(F.count("*").alias("_n"), F.min_by(tokens, id_col).alias("_first"))
    counts = df.select(*cl, F.explode(tokens).alias("token")).groupBy(*cl, "token").agg(F.count("*").alias("_c"))
    ex = head.select(*cl, "_n", F.posexplode("_first").alias("pos", "token"))
    marked = ex.join(counts, [*cl, "token"]).withColumn(
        "_t", F.when(F.col("_c") >= F.col("_n"), F.col("token")).otherwise(F.lit(wildcard))
    )
    rebuilt = reassemble(marked, cl, "_p", token_col="_t")
    out = head.join(rebuilt, cl, "left").select(
        *cl,
        F.when(F.col("_n") > 1, dedup_adjacent_tokens(F.coalesce("_p", F.array().cast("array<string>"))))
        .otherwise(F.col("_first"))
        .alias("pattern"),
    )
    return out


# ------------------------------------------------------------------ M3 / M4
def _positions(df: DataFrame, cl: list, tokens: str) -> tuple[DataFrame, DataFrame]:
    shortest = df.groupBy(*cl).agg(F.min(F.size(tokens)).alias("_min"))
    ex = df.select(*cl, F.posexplode(tokens).alias("pos", "token")).join(shortest, cl).where(F.col("pos") < F.col("_min"))
    return shortest, ex


def positional_pattern(df: DataFrame, cluster_cols: Sequence[str], tokens: str, wildcard: str = WILDCARD) -> DataFrame:
    """M3: column-wise over the shortest length: the token if all rows agree, else the wildcard."""
    cl = list(cluster_cols)
    shortest, ex = _positions(df, cl, tokens)
    per_pos = ex.groupBy(*cl, "pos").agg(F.min("token").alias("_lo"), F.max("token").alias("_hi"))
    per_pos = per_pos.withColumn("_t", F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(F.lit(wildcard)))
    rebuilt = reassemble(per_pos, cl, "_p", token_col="_t")
    return shortest.join(rebuilt, cl, "left").select(*cl, F.coalesce("_p", F.array().cast("array<string>")).alias("pattern"))


def positional_alternatives(df: DataFrame, cluster_cols: Sequence[str], tokens: str) -> DataFrame:
    """M4: per position the token if unique, else the three smallest
    alternatives joined by '|' followed by ``{number of alternatives}``."""
    cl = list(cluster_cols)
    shortest, ex = _positions(df, cl, tokens)
    d = ex.select(*cl, "pos", "token").distinct()
    k = [*cl, "pos"]
    number = d.groupBy(*k).agg(F.count("*").alias("n"))
    # the limit on the row number is applied before the shuffle as well, so a
    # position with many alternatives sends three rows per task
    three = d.withColumn("r", F.row_number().over(Window.partitionBy(*k).orderBy("token"))).where("r <= 3")
    smallest = three.groupBy(*k).agg(*[F.max(F.when(F.col("r") == i, F.col("token"))).alias(f"m{i}") for i in (1, 2, 3)])
    per_pos = number.join(smallest, k)
    alt = F.concat(F.concat_ws("|", "m1", "m2", "m3"), F.lit("{"), F.col("n").cast("string"), F.lit("}"))
    per_pos = per_pos.withColumn("_t", F.when(F.col("n") == 1, F.col("m1")).otherwise(alt))
    rebuilt = reassemble(per_pos, cl, "_p", token_col="_t")
    return shortest.join(rebuilt, cl, "left").select(*cl, F.coalesce("_p", F.array().cast("array<string>")).alias("pattern"))


# ------------------------------------------------------------------ M1 / M5
_EMPTY_TOKENS = [*PUNCTUATION, WILDCARD, SPACER]


_ALIGNMENT = T.StructType([T.StructField("ratio", T.DoubleType()), T.StructField("matched", T.ArrayType(T.IntegerType()))])


def _alignment(start: pd.Series, seq: pd.Series) -> pd.DataFrame:
    """Similarity ratio of two token sequences and the positions of the first
    one that their matching blocks cover."""
    ratios, matched = [], []
    for a, b in zip(start, seq):
        m = difflib.SequenceMatcher(None, list(a), list(b))
        ratios.append(m.ratio())
        matched.append([i for block in m.get_matching_blocks() for i in range(block.a, block.a + block.size)])
    return pd.DataFrame({"ratio": ratios, "matched": matched})


def _shapes(level: DataFrame, start: DataFrame, cl: list) -> DataFrame:
    """(cluster..., _start, _shape, _k): the distinct sequences ``_s`` of a cluster with one
    marker for all tokens that its start has not, and how many they are.

    Those tokens match nothing, so which ones they are does not change an alignment."""
    # longer than any token of the start, so none of them
    marked = start.withColumn("_other", F.concat(F.array_join("_start", ""), F.lit("?")))

    def shape(t):
        return F.when(F.array_contains("_start", t) | t.isNull(), t).otherwise(F.col("_other"))

    shaped = level.join(marked, cl).select(*cl, "_start", F.transform("_s", shape).alias("_shape"))
    return shaped.groupBy(*cl, "_shape").agg(F.count("*").alias("_k"), F.first("_start").alias("_start"))


def common_pattern(
    df: DataFrame,
    cluster_cols: Sequence[str],
    tokens: str,
    weight: str | None = None,
    add_placeholder: bool = False,
    gated: bool = True,
) -> DataFrame:
    """M1 (gated) / M5 (ungated): (cluster..., pattern array<string>).

    The heaviest distinct sequence of a cluster (tie: the smallest) is aligned
    with each other one; those that differ only in tokens it has not are aligned
    once, in a row of their own. The pattern keeps the positions that all of them match (M1: all with a ratio over 0.5), counted by an
    ordinary aggregation, so neither the order of rows nor the size of a cluster
    matters. With ``add_placeholder`` the wildcard stands where positions between
    kept ones were lost. If nothing but punctuation is left, the pattern is the
    heaviest sequence itself."""
    cl = list(cluster_cols)
    w = F.sum(weight) if weight else F.count("*")
    level = df.groupBy(*cl, F.coalesce(F.col(tokens), F.array().cast("array<string>")).alias("_s")).agg(w.cast("long").alias("_w"))
    start = level.groupBy(*cl).agg(F.min_by("_s", F.struct(-F.col("_w"), F.col("_s"))).alias("_start"))
    aligned = _shapes(level, start, cl).select(*cl, "_k", F.pandas_udf(_alignment, _ALIGNMENT)("_start", "_shape").alias("_a"))
    aligned = aligned.where(F.col("_a.ratio") > 0.5) if gated else aligned
    # position -1 counts the sequences themselves
    counts = aligned.select(*cl, "_k", F.explode(F.concat(F.array(F.lit(-1)), "_a.matched")).alias("_p")).groupBy(*cl, "_p").agg(F.sum("_k").alias("_n"))
    kept = counts.groupBy(*cl).agg(F.sort_array(F.collect_list(F.struct("_p", "_n"))).alias("_l"))
    everywhere = F.filter("_l", lambda x: (x["_p"] >= 0) & (x["_n"] == F.element_at("_l", 1)["_n"]))
    kept = kept.select(*cl, F.transform(everywhere, lambda x: x["_p"]).alias("_kept"))
    both = start.join(kept, cl)  # the start matches itself, so every cluster is here

    def token(i):
        return F.element_at("_start", i + 1)

    def with_gap(p, i):
        lost = (i > 0) & (p > F.element_at("_kept", F.greatest(i, F.lit(1))) + 1)
        return F.when(lost, F.array(F.lit(WILDCARD), token(p))).otherwise(F.array(token(p)))

    pattern = F.flatten(F.transform("_kept", with_gap)) if add_placeholder else F.transform("_kept", token)
    empty = F.forall("_pattern", lambda t: t.isin(_EMPTY_TOKENS))
    return both.withColumn("_pattern", pattern).select(*cl, F.when(empty & F.lit(gated), F.col("_start")).otherwise(F.col("_pattern")).alias("pattern"))


# ------------------------------------------------------------------ M6
def common_phrases(
    df: DataFrame,
    cluster_cols: Sequence[str],
    tokens: str,
    stop_words: Sequence[str] | None = None,
    max_words: int = 7,
    min_frequency: int = 1,
) -> DataFrame:
    """M6: key phrases (RAKE) of each cluster's text, as a long table
    (cluster..., phrase, score); best first is ``score desc, phrase``. Each row of ``df`` is one
    sequence of the cluster text; sentences end at delimiter characters,
    phrases are runs of non-stop words; word score = degree / frequency,
    phrase score = sum of its word scores."""
    cl = list(cluster_cols)
    stops = F.array(*[F.lit(w.lower()) for w in (stop_words or PHRASE_STOP_WORDS)])
    text = F.array_join(F.col(tokens), " ")
    sentences = F.split(text, PHRASE_SENTENCE_SPLIT)

    def to_phrases(s):
        words = F.filter(F.split(F.trim(s), r"\s+"), lambda x: x != "")
        marked = F.transform(words, lambda x: F.when(F.array_contains(stops, F.lower(x)), F.lit("|")).otherwise(F.lower(x)))
        return F.split(F.array_join(marked, " "), r"\s*\|\s*")

    phrases = df.select(*cl, F.explode(F.flatten(F.transform(sentences, to_phrases))).alias("phrase"))
    phrases = phrases.select(*cl, F.trim("phrase").alias("phrase")).where(F.col("phrase") != "")
    phrases = phrases.withColumn("_words", F.split("phrase", " +")).where(F.size("_words") <= max_words)
    phrase_freq = phrases.groupBy(*cl, "phrase").agg(F.count("*").alias("_pf"), F.first("_words").alias("_words"))
    phrase_freq = phrase_freq.where(F.col("_pf") >= min_frequency)
    occ = phrases.select(*cl, F.size("_words").alias("_len"), F.explode("_words").alias("word"))
    word_scores = occ.groupBy(*cl, "word").agg((F.sum("_len") / F.count("*")).alias("_ws"))
    per_word = phrase_freq.select(*cl, "phrase", F.explode("_words").alias("word")).join(word_scores, [*cl, "word"])
    # best first = order by (cluster, score desc, phrase); no per-cluster window
    return per_word.groupBy(*cl, "phrase").agg(F.sum("_ws").alias("score"))


def ranked_phrases(phrases: DataFrame, cluster_cols: Sequence[str]) -> DataFrame:
    """Phrases with their rank in the cluster, best first (ties by phrase)."""
    best = Window.partitionBy(*cluster_cols).orderBy(F.desc("score"), "phrase")
    return phrases.withColumn("rank", F.row_number().over(best))


def phrases_array(phrases: DataFrame, cluster_cols: Sequence[str]) -> DataFrame:
    """Best-first phrase list per cluster, for callers that want the array column."""
    cl = list(cluster_cols)
    key = F.struct(-F.col("score"), F.col("phrase"))
    return phrases.groupBy(*cl).agg(F.sort_array(F.collect_list(F.struct(key.alias("k"), "phrase"))).alias("_l")).select(
        *cl, F.col("_l.phrase").alias("common_phrases")
    )
