"""Cluster reports and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import GARBAGE_TOKEN, PUNCTUATION
from ..functions.similarity import char_similarity, prefix_similarity
from ..functions.text import cluster_uuid


def label_messages(bridge: DataFrame, assignment: DataFrame, key: str = "hash", cluster_col: str = "leader", by: Sequence[str] = ()) -> DataFrame:
    """Each message id with its cluster (bridge (id, key) + assignment (key, cluster))."""
    return bridge.join(assignment.select(*by, key, cluster_col), [*by, key])


def first_in_cluster(labelled: DataFrame, target: str = "error_message", id_col: str = "msg_id", cluster_col: str = "leader", by: Sequence[str] = ()) -> DataFrame:
    """The baseline message of each cluster (smallest id); partial aggregation, no window."""
    return labelled.groupBy(*by, cluster_col).agg(
        F.min(id_col).alias("first_id"), F.min_by(target, id_col).alias("first_message")
    )


def cluster_statistics(
    labelled: DataFrame, target: str = "error_message", id_col: str = "msg_id", cluster_col: str = "leader", prefix: int = 0, by: Sequence[str] = ()
) -> DataFrame:
    """Size, mean and population std of the character similarity of each
    message to the cluster's first message, rounded half-to-even to 2."""
    firsts = first_in_cluster(labelled, target, id_col, cluster_col, by)
    # equal messages of a cluster are compared once and weighted by their number
    distinct = labelled.groupBy(*by, cluster_col, target).agg(F.count("*").alias("_n"))
    sim = prefix_similarity(target, "first_message", prefix) if prefix else char_similarity(target, "first_message")
    j = distinct.join(firsts, [*by, cluster_col]).select(*by, cluster_col, "_n", sim.alias("_s"))
    total = F.sum("_n")
    mean = F.sum(F.col("_n") * F.col("_s")) / total
    square = F.sum(F.col("_n") * F.col("_s") * F.col("_s")) / total
    return j.groupBy(*by, cluster_col).agg(
        total.alias("cluster_size"),
        F.bround(mean, 2).alias("mean_similarity"),
        F.bround(F.sqrt(F.greatest(square - mean * mean, F.lit(0.0))), 2).alias("std_similarity"),
    )


def split_clusters(clusters: DataFrame, column: str = "cluster_size", threshold: int = 100) -> DataFrame:
    """Flag ``part`` = 'large' / 'outlier'. If no cluster reaches the
    threshold everything is large (the reference returns no outlier frame)."""
    biggest = clusters.agg(F.max(column)).scalar()
    large = (biggest < threshold) | (F.col(column) >= threshold)
    return clusters.withColumn("part", F.when(large, F.lit("large")).otherwise(F.lit("outlier")))


def garbage_flag(clusters: DataFrame, seq: str = "sequence", stop: Sequence[str] | None = None) -> DataFrame:
    """``is_garbage`` when every token is punctuation or the garbage token (true when empty)."""
    stops = F.array(*[F.lit(s) for s in (stop or PUNCTUATION + [GARBAGE_TOKEN])])
    return clusters.withColumn("is_garbage", F.forall(seq, lambda x: F.array_contains(stops, x)))


def top_clusters(stats: DataFrame, n: int = 10, size_col: str = "cluster_size", tie: str = "leader") -> DataFrame:
    """O2."""
    return stats.orderBy(F.col(size_col).desc(), F.col(tie)).limit(n)


def least_accurate_clusters(stats: DataFrame, n: int = 5, tie: str = "leader") -> DataFrame:
    """O3: lowest mean similarity first."""
    return stats.orderBy(F.col("mean_similarity").asc(), F.col("cluster_size").desc(), F.col(tie)).limit(n)


def filter_site(df: DataFrame, site: str, col: str = "src_site") -> DataFrame:
    """P3."""
    return df.where(F.col(col) == site)


def filter_either_endpoint(df: DataFrame, site: str, src: str = "src_site", dst: str = "dst_site") -> DataFrame:
    """P4."""
    return df.where((F.col(src) == site) | (F.col(dst) == site))


def lookup_rows(df: DataFrame, ids: DataFrame, id_col: str = "msg_id", columns: Sequence[str] = ()) -> DataFrame:
    """P5: rows whose id is in ``ids`` (semi join; no driver-side id list)."""
    out = df.join(ids.select(id_col).distinct(), id_col, "left_semi")
    return out.select(id_col, *columns) if columns else out


def label_default_then_update(df: DataFrame, updates: DataFrame, key: str, col: str, default) -> DataFrame:
    """Constant column, overwritten where ``updates(key, col)`` has a row."""
    return df.join(updates.select(key, F.col(col).alias("_upd")), key, "left").withColumn(
        col, F.coalesce(F.col("_upd"), F.lit(default))
    ).drop("_upd")


def model_tag(df: DataFrame, strategy: str) -> DataFrame:
    """Tag with the strategy that ran (Q4): Levenshtein or the model's name."""
    return df.withColumn("model", F.lit(strategy))


def join_top_sites(messages: DataFrame, top_sites: DataFrame, site_col: str = "src_site") -> DataFrame:
    """Inner join with the top failing sites; the top table has a fixed row bound."""
    return messages.join(F.broadcast(top_sites), messages[site_col] == top_sites["site"], "inner")


def common_patterns(a: DataFrame, b: DataFrame, col: str = "pattern") -> DataFrame:
    """Distinct values present on both sides."""
    return a.select(col).intersect(b.select(col))


def with_cluster_id(df: DataFrame, key: str = "leader", out: str = "cluster_id") -> DataFrame:
    """T15 applied to a cluster key."""
    return df.withColumn(out, cluster_uuid(key))
