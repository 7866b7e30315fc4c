"""Message preparation and aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_message, collapse_placeholders, content_hash, detokenize_pattern, split_tokens
from .patterns import common_pattern
from .tokens import frequent_token_sequences


def prepare_sequences(
    df: DataFrame,
    target: str = "error_message",
    id_col: str = "msg_id",
    by: Sequence[str] = (),
    min_count: int = 2,
) -> DataFrame:
    """T1 -> T2 -> T3 -> T4: (by..., id, sequence, hash).

    Rare-token counts are taken per ``by`` key, as if each key were its own run.
    Every cleaned message splits into at least one token, so no message is lost.
    """
    base = df.select(*by, id_col, split_tokens(clean_message(F.coalesce(F.col(target), F.lit("")))).alias("_raw_tokens"))
    seq = frequent_token_sequences(base, "_raw_tokens", id_col, by=by, min_count=min_count, out="sequence")
    return seq.withColumn("hash", content_hash("sequence"))


def group_equal_messages(seqs: DataFrame, id_col: str = "msg_id", by: Sequence[str] = ()) -> DataFrame:
    """A1: one row per content hash. Message ids stay in ``seqs`` (the bridge
    table by ``hash``); only size, first id and the first sequence are kept
    here, so a hot group never becomes one huge array."""
    return seqs.groupBy(*by, "hash").agg(
        F.count("*").alias("cluster_size"),
        F.min(id_col).alias("first_id"),
        F.min_by("sequence", id_col).alias("sequence"),
    )


def most_frequent_sequence(groups: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A4: the sequence carrying the most messages; ties broken by hash."""
    return groups.groupBy(*by).agg(
        F.min_by(F.struct("sequence", "hash", "cluster_size"), F.struct(-F.col("cluster_size"), F.col("hash"))).alias("_top")
    ).select(*by, "_top.sequence", "_top.hash", "_top.cluster_size")


def group_patterns(messages: DataFrame, tokens: str = "tk", key: str = "hash", by: Sequence[str] = (), add_placeholder: bool = False) -> DataFrame:
    """A1, second part: (by..., hash, tokenized_pattern, pattern) mined from the
    raw tokens of the messages of each group."""
    keys = [*by, key]
    mined = common_pattern(messages, keys, tokens, add_placeholder=add_placeholder)
    return mined.select(
        *keys, F.col("pattern").alias("tokenized_pattern"), collapse_placeholders(detokenize_pattern("pattern")).alias("pattern")
    )


def merge_groups(assigned: DataFrame, cluster_col: str = "cluster_id", by: Sequence[str] = ()) -> DataFrame:
    """A5: groups -> clusters with total size and number of groups."""
    return assigned.groupBy(*by, cluster_col).agg(
        F.sum("cluster_size").cast("long").alias("cluster_size"),
        F.count("*").alias("n_groups"),
    )


def cluster_text(assigned: DataFrame, cluster_col: str = "cluster_id", order_col: str = "hash", by: Sequence[str] = ()) -> DataFrame:
    """One text per cluster: tokens joined by space, sequences by '. '."""
    return assigned.groupBy(*by, cluster_col).agg(
        F.sort_array(F.collect_list(F.struct(F.col(order_col).alias("_o"), F.array_join("sequence", " ").alias("_s")))).alias("_l")
    ).select(*by, cluster_col, F.array_join(F.col("_l._s"), ". ").alias("text"))


def distinct_sequences(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct sequences (or lines)."""
    return df.select(*by, col).distinct()


def token_counts_in_cluster(df: DataFrame, tokens: str, cluster_col: str) -> DataFrame:
    """Occurrences of each token inside each cluster."""
    return df.select(cluster_col, F.explode(tokens).alias("token")).groupBy(cluster_col, "token").agg(
        F.count("*").alias("n")
    )


def coverage_percent(clusters: DataFrame, total_rows: DataFrame, top_n: int = 20, size_col: str = "cluster_size", tie_col: str = "cluster_id", minus_one: bool = True) -> DataFrame:
    """A10: share of all messages in the top ``top_n`` clusters and in all clusters.

    ``total_rows`` is a one-row frame with column ``n``; the reference divides
    by ``n - 1`` (kept as the default)."""
    top = clusters.orderBy(F.col(size_col).desc(), F.col(tie_col)).limit(top_n)
    top_messages = top.agg(F.sum(size_col)).scalar()
    total = total_rows.select("n").scalar()
    denom = (total - 1) if minus_one else total
    # one aggregate row; the other figures enter as scalar subqueries
    return clusters.agg(
        F.sum(size_col).cast("long").alias("kept_messages"), F.count("*").alias("n_clusters")
    ).select(
        top_messages.cast("long").alias("top_messages"),
        "kept_messages",
        "n_clusters",
        total.alias("total_messages"),
        F.round(100.0 * top_messages / denom, 6).alias("top_percent"),
        F.round(100.0 * F.col("kept_messages") / denom, 6).alias("kept_percent"),
    )


def site_failure_rate(outcomes: DataFrame, top_n: int = 10) -> DataFrame:
    """Per site failed, successful and rate; top ``top_n`` by failures (tie: site)."""
    agg = outcomes.groupBy("site").agg(
        F.sum(F.when(F.col("failed"), 1).otherwise(0)).cast("double").alias("failed_src"),
        F.sum(F.when(F.col("failed"), 0).otherwise(1)).cast("long").alias("successful_src"),
    )
    agg = agg.withColumn("src_fail_rate", F.round(F.col("failed_src") / (F.col("failed_src") + F.col("successful_src")), 9))
    return agg.orderBy(F.col("failed_src").desc(), F.col("site")).limit(top_n)


def frame_counts(messages: DataFrame, seqs: DataFrame, groups: DataFrame, clusters: DataFrame) -> DataFrame:
    """Row, group and cluster counts in one row."""
    return messages.agg(F.count("*").alias("n_rows")).select(
        "n_rows",
        seqs.agg(F.countDistinct("hash")).scalar().alias("n_hashes"),
        groups.agg(F.count("*")).scalar().alias("n_groups"),
        clusters.agg(F.count("*")).scalar().alias("n_clusters"),
    )
