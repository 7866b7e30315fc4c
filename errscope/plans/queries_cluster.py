"""Queries for similarity, leader clustering and cluster reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.similarity import char_similarity, prefix_similarity, token_similarity
from ..operators import grouping as G
from ..operators import report as RP
from ..operators import similarity as S
from ..sources import fixtures as fx
from .duck import char_sim, leader_ctes, sequences_ctes, token_sim, with_fixtures
from .registry import register

TM = "templated_messages"
LEADER_SQL = with_fixtures(TM, extra=sequences_ctes(TM) + "," + leader_ctes(0.8))


def _long(c):
    return F.col(c).cast("long")


def tm_clusters(spark, sf, accuracy: float = 0.8):
    """templated messages -> sequences -> groups -> leader assignment."""
    tm = fx.templated_messages(spark, sf)
    seqs = G.prepare_sequences(tm)
    seqs = S._ckpt(seqs)
    groups = S._ckpt(G.group_equal_messages(seqs))
    assigned = S.leader_clustering(groups, accuracy)
    return tm, seqs, groups, assigned


def _labelled(spark, sf):
    tm, seqs, groups, assigned = tm_clusters(spark, sf)
    lab = RP.label_messages(seqs.select("msg_id", "hash"), assigned).join(tm.select("msg_id", "error_message"), "msg_id")
    return lab, assigned


@register(
    "similarity_join",
    LEADER_SQL
    + """
SELECT CASE WHEN a.hash < b.hash THEN a.hash ELSE b.hash END AS key_a,
       CASE WHEN a.hash < b.hash THEN b.hash ELSE a.hash END AS key_b, round(p.similarity, 9) AS similarity
FROM pairs p JOIN ranked a ON a.rk = p.hi JOIN ranked b ON b.rk = p.lo
""",
)
def q_similarity_join(spark, sf):
    """Every pair of groups with token similarity >= 0.8."""
    tm = fx.templated_messages(spark, sf)
    groups = S._ckpt(G.group_equal_messages(G.prepare_sequences(tm)))
    e = S.similarity_join(groups, 0.8)
    return e.select("key_a", "key_b", F.round("similarity", 9).alias("similarity"))


@register("similarity_join_text")
def q_similarity_join_text(spark, sf):
    """J5 at accuracy 0.8 over the prose groups (too many pairs for an SQL
    restatement; the join is tested against brute force)."""
    groups = S._ckpt(G.group_equal_messages(G.prepare_sequences(fx.messages(spark, sf))))
    return S.similarity_join(groups, 0.8).withColumn("similarity", F.round("similarity", 9))


@register("leader_clustering", LEADER_SQL + "SELECT hash, leader_hash, cluster_size::BIGINT AS cluster_size FROM assigned")
def q_leader_clustering(spark, sf):
    """The leader of every group on the similarity path (priority: size desc, hash)."""
    _, _, _, assigned = tm_clusters(spark, sf)
    return assigned.select("hash", F.col("leader").alias("leader_hash"), _long("cluster_size").alias("cluster_size"))


@register(
    "merge_groups",
    LEADER_SQL
    + """
SELECT leader_hash, sum(cluster_size)::BIGINT AS cluster_size, count(*)::BIGINT AS n_groups, min(first_id) AS first_id
FROM assigned GROUP BY leader_hash
""",
)
def q_merge_groups(spark, sf):
    """A5: groups -> clusters (total size, number of groups, first id)."""
    _, _, _, assigned = tm_clusters(spark, sf)
    m = G.merge_groups(assigned, "leader")
    f = assigned.groupBy("leader").agg(F.min("first_id").alias("first_id"))
    return m.join(f, "leader").select(F.col("leader").alias("leader_hash"), "cluster_size", _long("n_groups").alias("n_groups"), "first_id")


@register(
    "most_frequent_sequence",
    with_fixtures(TM, extra=sequences_ctes(TM))
    + """
SELECT hash, array_to_string(sequence, ' ') AS sequence_text, cluster_size FROM (
  SELECT hash, arg_min(sequence, msg_id) AS sequence, count(*)::BIGINT AS cluster_size FROM seqs GROUP BY hash)
ORDER BY cluster_size DESC, hash LIMIT 1
""",
)
def q_most_frequent_sequence(spark, sf):
    """A4."""
    groups = G.group_equal_messages(G.prepare_sequences(fx.templated_messages(spark, sf)))
    top = G.most_frequent_sequence(groups)
    return top.select("hash", F.array_join("sequence", " ").alias("sequence_text"), _long("cluster_size").alias("cluster_size"))


@register(
    "token_similarity",
    with_fixtures(TM, extra=sequences_ctes(TM))
    + f"""
, g AS (SELECT hash, arg_min(sequence, msg_id) AS sequence, count(*) AS n FROM seqs GROUP BY hash),
top AS (SELECT sequence AS top_seq FROM g ORDER BY n DESC, hash LIMIT 1)
SELECT hash, round({token_sim('g.sequence', 'top.top_seq')}, 9) AS similarity FROM g, top
""",
)
def q_token_similarity(spark, sf):
    """Each group's similarity to the most frequent sequence (per-pair token codes)."""
    groups = G.group_equal_messages(G.prepare_sequences(fx.templated_messages(spark, sf)))
    # the most frequent sequence enters as a scalar subquery (one value, no join)
    top = G.most_frequent_sequence(groups).select("sequence").scalar()
    j = groups.withColumn("top_seq", top)
    ca, cb = S._pair_codes(F.col("sequence"), F.col("top_seq"))
    return j.select("hash", F.round(token_similarity(ca, cb), 9).alias("similarity"))


@register(
    "char_similarity",
    with_fixtures(TM, extra=sequences_ctes(TM))
    + f"""
, f AS (SELECT hash, arg_min(m.error_message, m.msg_id) AS first_message FROM seqs s JOIN templated_messages m USING (msg_id) GROUP BY hash)
SELECT m.msg_id, round({char_sim('m.error_message', 'f.first_message')}, 9) AS similarity,
       round({char_sim('left(m.error_message, 20)', 'left(f.first_message, 20)')}, 9) AS prefix_similarity
FROM templated_messages m JOIN seqs s USING (msg_id) JOIN f ON f.hash = s.hash
""",
)
def q_char_similarity(spark, sf):
    """T13 + T14: each message against the first message of its group (full and first 20 characters)."""
    tm = fx.templated_messages(spark, sf)
    lab = G.prepare_sequences(tm).select("msg_id", "hash").join(tm.select("msg_id", "error_message"), "msg_id")
    firsts = RP.first_in_cluster(lab, cluster_col="hash")
    j = lab.join(firsts, "hash")
    return j.select(
        "msg_id",
        F.round(char_similarity("error_message", "first_message"), 9).alias("similarity"),
        F.round(prefix_similarity("error_message", "first_message", 20), 9).alias("prefix_similarity"),
    )


STATS_SQL = (
    LEADER_SQL
    + """
, lab AS (SELECT m.msg_id, m.error_message, a.leader_hash FROM templated_messages m JOIN seqs s USING (msg_id) JOIN assigned a ON a.hash = s.hash),
firsts AS (SELECT leader_hash, min(msg_id) AS first_id, arg_min(error_message, msg_id) AS first_message FROM lab GROUP BY leader_hash),
stats AS (SELECT l.leader_hash, count(*)::BIGINT AS cluster_size,
                 round_even(avg(SIM), 2) AS mean_similarity, round_even(stddev_pop(SIM), 2) AS std_similarity
          FROM lab l JOIN firsts f USING (leader_hash) GROUP BY l.leader_hash)
""".replace("SIM", char_sim("l.error_message", "f.first_message"))
)


@register("cluster_statistics", STATS_SQL + "SELECT leader_hash, cluster_size, mean_similarity, std_similarity FROM stats")
def q_cluster_statistics(spark, sf):
    """A7 over the leader clusters."""
    lab, _ = _labelled(spark, sf)
    st = RP.cluster_statistics(lab)
    return st.select(F.col("leader").alias("leader_hash"), _long("cluster_size").alias("cluster_size"), "mean_similarity", "std_similarity")


@register(
    "first_in_cluster",
    STATS_SQL + "SELECT leader_hash, first_id, first_message FROM firsts",
)
def q_first_in_cluster(spark, sf):
    """W2."""
    lab, _ = _labelled(spark, sf)
    return RP.first_in_cluster(lab).withColumnRenamed("leader", "leader_hash")


@register(
    "top_clusters",
    STATS_SQL + "SELECT leader_hash, cluster_size, mean_similarity FROM stats ORDER BY cluster_size DESC, leader_hash LIMIT 10",
)
def q_top_clusters(spark, sf):
    """O2: ten largest clusters with their mean similarity."""
    lab, _ = _labelled(spark, sf)
    st = RP.cluster_statistics(lab)
    return RP.top_clusters(st, 10).select(F.col("leader").alias("leader_hash"), _long("cluster_size").alias("cluster_size"), "mean_similarity")


@register(
    "least_accurate_clusters",
    STATS_SQL
    + "SELECT leader_hash, cluster_size, mean_similarity FROM stats ORDER BY mean_similarity, cluster_size DESC, leader_hash LIMIT 5",
)
def q_least_accurate_clusters(spark, sf):
    """O3."""
    lab, _ = _labelled(spark, sf)
    st = RP.cluster_statistics(lab)
    return RP.least_accurate_clusters(st, 5).select(
        F.col("leader").alias("leader_hash"), _long("cluster_size").alias("cluster_size"), "mean_similarity"
    )


@register(
    "split_clusters",
    LEADER_SQL
    + """
, c AS (SELECT leader_hash, sum(cluster_size)::BIGINT AS cluster_size FROM assigned GROUP BY leader_hash)
SELECT leader_hash, cluster_size, CASE WHEN (SELECT max(cluster_size) FROM c) < 1000 OR cluster_size >= 1000 THEN 'large' ELSE 'outlier' END AS part
FROM c
""",
)
def q_split_clusters(spark, sf):
    """P8 at threshold 1000."""
    _, _, _, assigned = tm_clusters(spark, sf)
    c = assigned.groupBy(F.col("leader").alias("leader_hash")).agg(F.sum("cluster_size").cast("long").alias("cluster_size"))
    return RP.split_clusters(c, threshold=1000)


@register(
    "label_messages",
    STATS_SQL
    + """
SELECT msg_id, substr(md5(leader_hash), 1, 8) || '-' || substr(md5(leader_hash), 9, 4) || '-' || substr(md5(leader_hash), 13, 4) || '-' ||
       substr(md5(leader_hash), 17, 4) || '-' || substr(md5(leader_hash), 21, 12) AS cluster_id FROM lab
""",
)
def q_label_messages(spark, sf):
    """J2 + T15: every message with its cluster id."""
    lab, _ = _labelled(spark, sf)
    return RP.with_cluster_id(lab).select("msg_id", "cluster_id")


@register(
    "in_cluster",
    STATS_SQL
    + """
SELECT msg_id, error_message FROM lab WHERE leader_hash = (SELECT leader_hash FROM stats ORDER BY cluster_size DESC, leader_hash LIMIT 1)
""",
)
def q_in_cluster(spark, sf):
    """Messages of the largest cluster (semi join)."""
    lab, assigned = _labelled(spark, sf)
    sizes = assigned.groupBy("leader").agg(F.sum("cluster_size").alias("n"))
    top = sizes.orderBy(F.col("n").desc(), "leader").limit(1).select("leader")
    return lab.join(F.broadcast(top), "leader", "left_semi").select("msg_id", "error_message")


@register(
    "gather_cluster_messages",
    STATS_SQL + "SELECT leader_hash, count(*)::BIGINT AS n_messages, sum(length(error_message))::BIGINT AS n_chars FROM lab GROUP BY 1",
)
def q_gather_cluster_messages(spark, sf):
    """Messages gathered per cluster through the bridge table."""
    lab, _ = _labelled(spark, sf)
    return lab.groupBy(F.col("leader").alias("leader_hash")).agg(
        F.count("*").alias("n_messages"), F.sum(F.length("error_message")).cast("long").alias("n_chars")
    )


@register(
    "cluster_text",
    LEADER_SQL
    + """
SELECT leader_hash, string_agg(array_to_string(sequence, ' '), '. ' ORDER BY hash) AS text FROM assigned GROUP BY leader_hash
""",
)
def q_cluster_text(spark, sf):
    """One text per cluster."""
    _, _, _, assigned = tm_clusters(spark, sf)
    return G.cluster_text(assigned, "leader").withColumnRenamed("leader", "leader_hash")


@register(
    "coverage_percent",
    LEADER_SQL
    + """
, c AS (SELECT leader_hash, sum(cluster_size) AS cluster_size FROM assigned GROUP BY leader_hash),
t AS (SELECT sum(cluster_size) AS s FROM (SELECT cluster_size FROM c ORDER BY cluster_size DESC, leader_hash LIMIT 5))
SELECT (SELECT s FROM t)::BIGINT AS top_messages, sum(cluster_size)::BIGINT AS kept_messages, count(*)::BIGINT AS n_clusters,
       (SELECT count(*) FROM templated_messages)::BIGINT AS total_messages,
       round(100.0 * (SELECT s FROM t) / ((SELECT count(*) FROM templated_messages) - 1), 6) AS top_percent,
       round(100.0 * sum(cluster_size) / ((SELECT count(*) FROM templated_messages) - 1), 6) AS kept_percent
FROM c
""",
)
def q_coverage_percent(spark, sf):
    """A10: share of messages in the top 5 clusters and in all clusters (divisor rows - 1)."""
    tm, _, _, assigned = tm_clusters(spark, sf)
    c = assigned.groupBy(F.col("leader").alias("cluster_id")).agg(F.sum("cluster_size").alias("cluster_size"))
    return G.coverage_percent(c, tm.agg(F.count("*").alias("n")), top_n=5)


@register(
    "garbage_filter",
    with_fixtures("messages", extra=sequences_ctes("messages"))
    + f"""
SELECT hash, coalesce(list_bool_and(list_transform(sequence, lambda x: list_contains({'[' + ', '.join("'" + p.replace("'", "''") + "'" for p in RP.PUNCTUATION + [RP.GARBAGE_TOKEN]) + ']'}, x))), true) AS is_garbage
FROM (SELECT hash, arg_min(sequence, msg_id) AS sequence FROM seqs GROUP BY hash)
""",
)
def q_garbage_filter(spark, sf):
    """P9 over the prose groups (empty sequences count as garbage)."""
    groups = G.group_equal_messages(G.prepare_sequences(fx.messages(spark, sf)))
    return RP.garbage_flag(groups).select("hash", "is_garbage")
