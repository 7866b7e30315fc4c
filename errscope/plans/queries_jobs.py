"""Queries for composite jobs (C1-C6) and the publishing / labelling steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import grouping as G
from ..operators import report as RP
from ..operators import similarity as S
from ..operators.ordering import batch_number, global_row_number
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources import readers as R
from .chain import ChainSettings, cluster_messages, regrouped
from .daily import daily_report, label_published, message_envelope, publish_batches, published_projection, read_batches
from .duck import leader_ctes, sequences_ctes, uuid_sql, with_fixtures
from .queries_cluster import STATS_SQL, tm_clusters
from .registry import register

TM = "templated_messages"
LEADER_SQL = with_fixtures(TM, extra=sequences_ctes(TM) + "," + leader_ctes(0.8))
NO_PATTERNS = dict(with_patterns=False)


@register(
    "cluster_messages",
    LEADER_SQL
    + f"""
SELECT {uuid_sql('leader_hash')} AS cluster_id, sum(cluster_size)::BIGINT AS cluster_size, count(*)::BIGINT AS n_groups
FROM assigned GROUP BY leader_hash
""",
)
def q_cluster_messages(spark, sf):
    """C1 (similarity path): cluster ids, sizes and group counts."""
    run = cluster_messages(fx.templated_messages(spark, sf), **NO_PATTERNS)
    return run.clusters.select("cluster_id", "cluster_size", F.col("n_groups").cast("long").alias("n_groups"))


@register("cluster_messages_patterns")
def q_cluster_messages_patterns(spark, sf):
    """C1 with pattern, tokenized pattern, common sequence and key phrases."""
    st = ChainSettings(phrases_as_array=True)
    run = cluster_messages(fx.templated_messages(spark, sf), settings=st)
    return run.clusters.select(
        "cluster_id", "cluster_size", "n_groups", "pattern", "tokenized_pattern", "sequence", "common_phrases"
    )


@register("cluster_messages_vector")
def q_cluster_messages_vector(spark, sf):
    """C1 on the prose lines by the vector path (word vectors, PCA, k-distance
    knee, DBSCAN); V13 regroups each label."""
    run = cluster_messages(fx.messages(spark, sf), settings=ChainSettings(clustering_type="ML"))
    return run.clusters.select("cluster_id", "cluster_size", "n_groups", "pattern", "sequence")


@register("cluster_regroup")
def q_cluster_regroup(spark, sf):
    """Per density label patterns, sequence, key phrases, ids and size."""
    run = cluster_messages(fx.messages(spark, sf), settings=ChainSettings(clustering_type="ML"))
    return regrouped(run).select("cluster_id", "piece", "cluster_size", "n_ids", "pattern", "tokenized_pattern", "sequence", "common_phrases", "ids")


SITE_LEADER_SQL = with_fixtures(TM, extra=sequences_ctes(TM, by=("src_site",)) + "," + leader_ctes(0.8, by=("src_site",)))


@register(
    "cluster_per_site",
    SITE_LEADER_SQL
    + f"""
SELECT src_site, {uuid_sql("src_site || '|' || leader_hash")} AS cluster_id, sum(cluster_size)::BIGINT AS cluster_size,
       count(*)::BIGINT AS n_groups
FROM assigned GROUP BY src_site, leader_hash
""",
)
def q_cluster_per_site(spark, sf):
    """Every source site clustered on its own, in one job (key carried through)."""
    run = cluster_messages(fx.templated_messages(spark, sf), by=("src_site",), **NO_PATTERNS)
    return run.clusters.select("src_site", "cluster_id", "cluster_size", F.col("n_groups").cast("long").alias("n_groups"))


@register("cluster_patterns")
def q_cluster_patterns(spark, sf):
    """C4: second level, the patterns of a per-site run clustered again."""
    first = cluster_messages(fx.templated_messages(spark, sf), by=("src_site",))
    pats = first.clusters.select(
        F.xxhash64("cluster_id").alias("msg_id"), F.col("pattern").alias("error_message")
    )
    second = cluster_messages(pats, settings=ChainSettings(min_count=1))
    return second.clusters.select("cluster_id", "cluster_size", "n_groups", "pattern")


DAY = "strftime(make_timestamp(timestamp), '%Y-%m-%d')"
DAY_SQL = (
    with_fixtures(TM, extra=f"tmd AS (SELECT *, {DAY} AS day FROM templated_messages), "
    + sequences_ctes("tmd", by=("day",)) + "," + leader_ctes(0.8, by=("day",)))
)


@register(
    "compare_runs",
    DAY_SQL
    + """
, c AS (SELECT day, leader_hash, sum(cluster_size)::BIGINT AS cluster_size FROM assigned GROUP BY day, leader_hash),
t AS (SELECT c.*, array_to_string(l.sequence, ' ') AS sequence_text,
             row_number() OVER (PARTITION BY c.day ORDER BY c.cluster_size DESC, c.leader_hash)::BIGINT AS position
      FROM c JOIN groups l ON l.day = c.day AND l.hash = c.leader_hash)
SELECT day, position, sequence_text, cluster_size, count(*) OVER (PARTITION BY sequence_text)::BIGINT AS n_runs FROM t WHERE position <= 20
""",
)
def q_compare_runs(spark, sf):
    """Each day clustered as its own run; the twenty largest clusters of every
    run side by side, with the number of runs that have the same sequence among theirs."""
    from pyspark.sql import Window

    day = F.date_format(F.date_from_unix_date(F.floor(F.col("timestamp") / 86_400_000_000).cast("int")), "yyyy-MM-dd")
    tm = fx.templated_messages(spark, sf).withColumn("day", day)
    run = cluster_messages(tm, by=("day",), **NO_PATTERNS)
    lead = run.groups.where(F.col("hash") == F.col("cluster_key")).select("day", "cluster_key", F.array_join("sequence", " ").alias("sequence_text"))
    largest = Window.partitionBy("day").orderBy(F.col("cluster_size").desc(), "cluster_key")
    c = run.clusters.withColumn("position", F.row_number().over(largest)).where("position <= 20").join(lead, ["day", "cluster_key"])
    runs = c.groupBy("sequence_text").agg(F.count("*").alias("n_runs"))
    return c.join(runs, "sequence_text").select("day", F.col("position").cast("long").alias("position"), "sequence_text", "cluster_size", "n_runs")


@register(
    "quality_report",
    STATS_SQL
    + """
, parts AS (SELECT *, CASE WHEN (SELECT max(cluster_size) FROM stats) < 1000 OR cluster_size >= 1000 THEN 'large' ELSE 'outlier' END AS part FROM stats)
SELECT leader_hash, cluster_size, mean_similarity, std_similarity, part,
       row_number() OVER (ORDER BY cluster_size DESC, leader_hash)::BIGINT AS by_size,
       row_number() OVER (ORDER BY mean_similarity, cluster_size DESC, leader_hash)::BIGINT AS by_accuracy,
       round(100.0 * cluster_size / ((SELECT sum(cluster_size) FROM stats) - 1), 6) AS percent
FROM parts
""",
)
def q_quality_report(spark, sf):
    """C1 -> A7 -> P8, with O2 and O3 as positions and A10 as each cluster's share."""
    tm = fx.templated_messages(spark, sf)
    run = cluster_messages(tm, **NO_PATTERNS)
    lab = run.bridge.join(tm.select("msg_id", "error_message"), "msg_id")
    st = S._ckpt(RP.split_clusters(RP.cluster_statistics(lab, cluster_col="cluster_key"), threshold=1000))
    sized = global_row_number(st.withColumn("smaller", -F.col("cluster_size")), ["smaller", "cluster_key"], "by_size")
    ranked = global_row_number(sized, ["mean_similarity", "smaller", "cluster_key"], "by_accuracy")
    total = st.agg(F.sum("cluster_size")).scalar()
    return ranked.select(
        F.col("cluster_key").alias("leader_hash"), F.col("cluster_size").cast("long").alias("cluster_size"),
        "mean_similarity", "std_similarity", "part",
        (F.col("by_size") + 1).cast("long").alias("by_size"), (F.col("by_accuracy") + 1).cast("long").alias("by_accuracy"),
        F.round(100.0 * F.col("cluster_size") / (total - 1), 6).alias("percent"),
    )


PUB_SQL = STATS_SQL + f"""
, pub AS (SELECT m.msg_id, m.timestamp, {uuid_sql('l.leader_hash')} AS cluster_id, 'Levenshtein' AS model,
                 m.src_hostname, m.dst_hostname, m.error_message
          FROM templated_messages m JOIN lab l USING (msg_id))
"""


def _published(spark, sf):
    tm = fx.templated_messages(spark, sf)
    run = cluster_messages(tm, **NO_PATTERNS)
    return label_published(tm, run)


@register(
    "published_projection",
    PUB_SQL + "SELECT timestamp, cluster_id, model, src_hostname, dst_hostname, error_message FROM pub",
)
def q_published_projection(spark, sf):
    """P10 + P7 + J2: published columns (pattern omitted from the comparison)."""
    return published_projection(_published(spark, sf)).drop("cluster_pattern")


@register(
    "model_tag",
    PUB_SQL + "SELECT model, count(*)::BIGINT AS n FROM pub GROUP BY model UNION ALL SELECT 'site_model' AS model, count(*)::BIGINT AS n FROM pub",
)
def q_model_tag(spark, sf):
    """Tagged with what ran: the similarity path, and a stored model on the vector path."""
    tm = fx.templated_messages(spark, sf)
    path = scratch_path(spark, "models") + "/site_model"
    vector = cluster_messages(tm, settings=ChainSettings(clustering_type="ML", model_path=path), **NO_PATTERNS)
    tagged = _published(spark, sf).select("model").unionByName(label_published(tm, vector).select(F.element_at(F.split("model", "/"), -1).alias("model")))
    return tagged.groupBy("model").agg(F.count("*").alias("n"))


@register(
    "label_default_then_update",
    PUB_SQL
    + f"""
SELECT p.msg_id, CASE WHEN s.cluster_size >= 1000 THEN p.cluster_id ELSE '1' END AS cluster_id
FROM pub p JOIN lab l USING (msg_id) JOIN stats s ON s.leader_hash = l.leader_hash
""",
)
def q_label_default_then_update(spark, sf):
    """Default '1', overwritten for messages of clusters with >= 1000 messages."""
    tm = fx.templated_messages(spark, sf)
    run = cluster_messages(tm, **NO_PATTERNS)
    big = run.clusters.where(F.col("cluster_size") >= 1000).select("cluster_key", "cluster_id")
    upd = run.bridge.join(big, "cluster_key").select("msg_id", "cluster_id")
    return RP.label_default_then_update(tm.select("msg_id"), upd, "msg_id", "cluster_id", "1")


ENV = "'{\"data\":{\"msg_id\":' || msg_id || ',\"src_site\":\"' || src_site || '\",\"timestamp\":' || timestamp || '},\"metadata\":{\"type\":\"training_document\",\"version\":\"997\",\"timestamp\":' || timestamp || '}}'"


@register("message_envelope", with_fixtures(TM) + f"SELECT {ENV} AS message FROM templated_messages")
def q_message_envelope(spark, sf):
    """JSON envelope per row."""
    tm = fx.templated_messages(spark, sf).select("msg_id", "src_site", "timestamp")
    return message_envelope(tm)


@register(
    "publish_batches",
    with_fixtures(TM)
    + """
SELECT (rn // 1000)::BIGINT AS batch, count(*)::BIGINT AS n_rows, min(msg_id) AS first_id
FROM (SELECT msg_id, row_number() OVER (ORDER BY timestamp, msg_id) - 1 AS rn FROM templated_messages) GROUP BY 1
""",
)
def q_publish_batches(spark, sf):
    """Batches of 1000 rows sent in portions, read back."""
    tm = fx.templated_messages(spark, sf).select("msg_id", "timestamp", "error_message")
    path = publish_batches(tm, scratch_path(spark, "publish"), ["timestamp", "msg_id"], 1000)
    back = read_batches(spark, path)
    return back.groupBy("batch").agg(
        F.count("*").alias("n_rows"), F.min(F.get_json_object("message", "$.data.msg_id").cast("long")).alias("first_id")
    )


@register(
    "batch_number",
    with_fixtures(TM) + "SELECT msg_id, ((row_number() OVER (ORDER BY timestamp, msg_id) - 1) // 500)::BIGINT AS batch FROM templated_messages",
)
def q_batch_number(spark, sf):
    """Consecutive batch index in time order (500 rows per batch)."""
    tm = fx.templated_messages(spark, sf).select("msg_id", "timestamp")
    return batch_number(tm, ["timestamp", "msg_id"], 500).select("msg_id", "batch")


RAW_LEADER_SQL = with_fixtures(
    "raw_flat",
    extra="records AS (SELECT event_id AS msg_id, ts_ms AS timestamp, src AS src_hostname, dst AS dst_hostname, msg AS error_message FROM raw_flat WHERE msg <> ''), "
    + sequences_ctes("records")
    + ","
    + leader_ctes(0.8),
)


@register(
    "daily_report",
    RAW_LEADER_SQL
    + f"""
SELECT r.timestamp, {uuid_sql('a.leader_hash')} AS cluster_id, 'Levenshtein' AS model, r.src_hostname, r.dst_hostname, r.error_message
FROM records r JOIN seqs s USING (msg_id) JOIN assigned a ON a.hash = s.hash
""",
)
def q_daily_report(spark, sf):
    """Records written as dated JSON folders, read for every day, clustered,
    labelled and published (the mined pattern column is left out of the comparison)."""
    root = R.write_daily_json(spark, fx.raw_records(spark, sf).drop("event_id"))
    return daily_report(spark, root, ["*/*/*"], out_path=scratch_path(spark, "published")).drop("cluster_pattern")


# ------------------------------------------------------------------ small reports
SITES_SQL = with_fixtures("site_outcomes") + """
, agg AS (SELECT site, sum(CASE WHEN failed THEN 1 ELSE 0 END)::DOUBLE AS failed_src,
                 sum(CASE WHEN failed THEN 0 ELSE 1 END)::BIGINT AS successful_src FROM site_outcomes GROUP BY site),
top AS (SELECT site, failed_src, successful_src, round(failed_src / (failed_src + successful_src), 9) AS src_fail_rate
        FROM agg ORDER BY failed_src DESC, site LIMIT 10)
"""


@register("site_failure_rate", SITES_SQL + "SELECT * FROM top")
def q_site_failure_rate(spark, sf):
    """Top 10 sites by failures with failure rate."""
    return G.site_failure_rate(fx.site_outcomes(spark, sf))


@register(
    "join_top_sites",
    SITES_SQL.replace("WITH site_outcomes AS", "WITH templated_messages AS (" + fx.templated_sql_duckdb() + "), site_outcomes AS", 1)
    + "SELECT m.msg_id, m.src_site, t.failed_src FROM templated_messages m JOIN top t ON m.src_site = t.site",
)
def q_join_top_sites(spark, sf):
    """Messages of the top failing sites (broadcast of a 10-row table)."""
    top = G.site_failure_rate(fx.site_outcomes(spark, sf))
    tm = fx.templated_messages(spark, sf)
    return RP.join_top_sites(tm, top).select("msg_id", "src_site", "failed_src")


@register(
    "frame_counts",
    LEADER_SQL
    + """
SELECT (SELECT count(*) FROM templated_messages)::BIGINT AS n_rows, (SELECT count(DISTINCT hash) FROM seqs)::BIGINT AS n_hashes,
       (SELECT count(*) FROM groups)::BIGINT AS n_groups, (SELECT count(DISTINCT leader_hash) FROM assigned)::BIGINT AS n_clusters
""",
)
def q_frame_counts(spark, sf):
    """Rows, groups and clusters."""
    tm, seqs, groups, assigned = tm_clusters(spark, sf)
    clusters = assigned.select("leader").distinct()
    return G.frame_counts(tm, seqs, groups, clusters)


@register("filter_site", with_fixtures(TM) + "SELECT msg_id, error_message FROM templated_messages WHERE src_site = '3'")
def q_filter_site(spark, sf):
    """P3."""
    return RP.filter_site(fx.templated_messages(spark, sf), "3").select("msg_id", "error_message")


@register(
    "filter_either_endpoint",
    with_fixtures(TM) + "SELECT msg_id, src_site, dst_site FROM templated_messages WHERE src_site = '3' OR dst_site = '3'",
)
def q_filter_either_endpoint(spark, sf):
    """P4."""
    return RP.filter_either_endpoint(fx.templated_messages(spark, sf), "3").select("msg_id", "src_site", "dst_site")


@register(
    "lookup_rows",
    with_fixtures(TM, extra=sequences_ctes(TM))
    + """
SELECT msg_id, error_message, src_hostname FROM templated_messages WHERE msg_id IN (SELECT min(msg_id) FROM seqs GROUP BY hash)
""",
)
def q_lookup_rows(spark, sf):
    """P5: rows by an id list (the first message of every group), column subset."""
    tm = fx.templated_messages(spark, sf)
    groups = G.group_equal_messages(G.prepare_sequences(tm))
    return RP.lookup_rows(tm, groups.select(F.col("first_id").alias("msg_id")), "msg_id", ["error_message", "src_hostname"])


@register(
    "common_patterns",
    with_fixtures(TM, extra=sequences_ctes(TM, by=("src_site",)))
    + """
SELECT DISTINCT array_to_string(sequence, ' ') AS pattern FROM seqs WHERE src_site = '1'
INTERSECT
SELECT DISTINCT array_to_string(sequence, ' ') AS pattern FROM seqs WHERE src_site = '2'
""",
)
def q_common_patterns(spark, sf):
    """Sequences common to two sites (each site with its own rare-token rule)."""
    seqs = G.prepare_sequences(fx.templated_messages(spark, sf), by=["src_site"]).withColumn(
        "pattern", F.array_join("sequence", " ")
    )
    return RP.common_patterns(seqs.where("src_site = '1'"), seqs.where("src_site = '2'"))
