"""Queries for pattern mining."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import grouping as G
from ..operators import patterns as PT
from ..functions.constants import PHRASE_SENTENCE_SPLIT, PHRASE_STOP_WORDS
from ..sources import fixtures as fx
from .duck import leader_ctes, sequences_ctes, sql_str, with_fixtures
from .queries_basic import SEP, _duck_dedup, _duck_tokenize
from .queries_cluster import tm_clusters
from .registry import register

TM = "templated_messages"

TK_SQL = with_fixtures(TM, extra=sequences_ctes(TM)) + f"""
, tk AS (SELECT s.hash, m.msg_id, {_duck_tokenize('m.error_message')} AS tk FROM templated_messages m JOIN seqs s USING (msg_id))
"""


def _tm_tokens(spark, sf):
    tm = fx.templated_messages(spark, sf)
    seqs = G.prepare_sequences(tm).select("msg_id", "hash")
    return seqs.join(tm.select("msg_id", X.tokenize_message("error_message").alias("tk")), "msg_id")


@register(
    "matcher_pattern",
    TK_SQL
    + f"""
, n AS (SELECT hash, count(*) AS n_seq, arg_min(tk, msg_id) AS first FROM tk GROUP BY hash),
cnt AS (SELECT hash, t, count(*) AS c FROM (SELECT hash, unnest(tk) AS t FROM tk) GROUP BY hash, t),
fe AS (SELECT hash, n_seq, unnest(first) AS t, generate_subscripts(first, 1) AS pos FROM n),
pat AS (SELECT fe.hash, list(CASE WHEN c.c >= fe.n_seq THEN fe.t ELSE '(.*?)' END ORDER BY fe.pos) AS p
        FROM fe JOIN cnt c ON c.hash = fe.hash AND c.t = fe.t GROUP BY fe.hash)
SELECT n.hash, array_to_string(CASE WHEN n.n_seq > 1 THEN {_duck_dedup('p')} ELSE n.first END, '{SEP}') AS pattern
FROM n LEFT JOIN pat USING (hash)
""",
)
def q_matcher_pattern(spark, sf):
    """M2 over the raw tokens of each group of equal messages."""
    t = _tm_tokens(spark, sf)
    return PT.matcher_pattern(t, ["hash"], "tk", "msg_id").select("hash", F.array_join("pattern", SEP).alias("pattern"))


LEADER_SQL = with_fixtures(TM, extra=sequences_ctes(TM) + "," + leader_ctes(0.8))


@register(
    "leader_clustering_basic",
    LEADER_SQL
    + f"""
, tk AS (SELECT a.leader_hash, m.msg_id, {_duck_tokenize('m.error_message')} AS tk
         FROM templated_messages m JOIN seqs s USING (msg_id) JOIN assigned a ON a.hash = s.hash),
n AS (SELECT leader_hash, count(*) AS n_seq, arg_min(tk, msg_id) AS first FROM tk GROUP BY leader_hash),
cnt AS (SELECT leader_hash, t, count(*) AS c FROM (SELECT leader_hash, unnest(tk) AS t FROM tk) GROUP BY leader_hash, t),
fe AS (SELECT leader_hash, n_seq, unnest(first) AS t, generate_subscripts(first, 1) AS pos FROM n),
pat AS (SELECT fe.leader_hash, list(CASE WHEN c.c >= fe.n_seq THEN fe.t ELSE '(.*?)' END ORDER BY fe.pos) AS p
        FROM fe JOIN cnt c ON c.leader_hash = fe.leader_hash AND c.t = fe.t GROUP BY fe.leader_hash)
SELECT n.leader_hash, n.n_seq::BIGINT AS cluster_size, array_to_string(g.sequence, ' ') AS sequence_text,
       array_to_string(CASE WHEN n.n_seq > 1 THEN {_duck_dedup('p')} ELSE n.first END, '{SEP}') AS pattern
FROM n LEFT JOIN pat USING (leader_hash) JOIN groups g ON g.hash = n.leader_hash
""",
)
def q_leader_clustering_basic(spark, sf):
    """Like V14, the cluster's sequence is the leader's and its pattern is M2's."""
    tm, seqs, groups, assigned = tm_clusters(spark, sf)
    tok = seqs.select("msg_id", "hash").join(assigned.select("hash", "leader"), "hash")
    tok = tok.join(tm.select("msg_id", X.tokenize_message("error_message").alias("tk")), "msg_id")
    pattern = PT.matcher_pattern(tok, ["leader"], "tk", "msg_id").withColumnRenamed("leader", "hash")
    sizes = assigned.groupBy(F.col("leader").alias("hash")).agg(F.sum("cluster_size").cast("long").alias("cluster_size"))
    return sizes.join(groups.select("hash", "sequence"), "hash").join(pattern, "hash").select(
        F.col("hash").alias("leader_hash"), "cluster_size", F.array_join("sequence", " ").alias("sequence_text"), F.array_join("pattern", SEP).alias("pattern")
    )


@register("group_patterns")
def q_group_patterns(spark, sf):
    """A1, second part: pattern and tokenized pattern of each group of equal messages."""
    return G.group_patterns(_tm_tokens(spark, sf)).select("hash", F.array_join("tokenized_pattern", SEP).alias("tokenized_pattern"), "pattern")


@register(
    "positional_pattern",
    TK_SQL
    + f"""
, mn AS (SELECT hash, min(len(tk)) AS m FROM tk GROUP BY hash),
pp AS (SELECT hash, pos, CASE WHEN min(t) = max(t) THEN min(t) ELSE '(.*?)' END AS t
       FROM (SELECT hash, unnest(tk) AS t, generate_subscripts(tk, 1) AS pos FROM tk) x JOIN mn USING (hash)
       WHERE pos <= mn.m GROUP BY hash, pos)
SELECT mn.hash, array_to_string(coalesce((SELECT list(t ORDER BY pos) FROM pp WHERE pp.hash = mn.hash), []::VARCHAR[]), '{SEP}') AS pattern FROM mn
""",
)
def q_positional_pattern(spark, sf):
    """M3."""
    t = _tm_tokens(spark, sf)
    return PT.positional_pattern(t, ["hash"], "tk").select("hash", F.array_join("pattern", SEP).alias("pattern"))


@register(
    "positional_alternatives",
    TK_SQL
    + f"""
, mn AS (SELECT hash, min(len(tk)) AS m FROM tk GROUP BY hash),
d AS (SELECT DISTINCT hash, pos, t FROM (SELECT hash, unnest(tk) AS t, generate_subscripts(tk, 1) AS pos FROM tk) x JOIN mn USING (hash) WHERE pos <= mn.m),
pp AS (SELECT hash, pos, CASE WHEN count(*) = 1 THEN min(t)
              ELSE array_to_string(list_slice(list_sort(list(t)), 1, 3), '|') || '{{' || CAST(count(*) AS VARCHAR) || '}}' END AS t
       FROM d GROUP BY hash, pos)
SELECT mn.hash, array_to_string(coalesce((SELECT list(t ORDER BY pos) FROM pp WHERE pp.hash = mn.hash), []::VARCHAR[]), '{SEP}') AS pattern FROM mn
""",
)
def q_positional_alternatives(spark, sf):
    """M4."""
    t = _tm_tokens(spark, sf)
    return PT.positional_alternatives(t, ["hash"], "tk").select("hash", F.array_join("pattern", SEP).alias("pattern"))


@register(
    "token_counts_in_cluster",
    TK_SQL + "SELECT hash, t AS token, count(*)::BIGINT AS n FROM (SELECT hash, unnest(tk) AS t FROM tk) GROUP BY hash, t",
)
def q_token_counts_in_cluster(spark, sf):
    """A9."""
    t = _tm_tokens(spark, sf)
    return G.token_counts_in_cluster(t, "tk", "hash").select("hash", "token", F.col("n").cast("long").alias("n"))


@register("common_pattern")
def q_common_pattern(spark, sf):
    """M1 + T6 + T11: readable pattern of each leader cluster from its messages' tokens."""
    tm, seqs, _, assigned = tm_clusters(spark, sf)
    t = seqs.select("msg_id", "hash").join(assigned.select("hash", "leader"), "hash")
    t = t.join(tm.select("msg_id", X.tokenize_message("error_message").alias("tk")), "msg_id")
    pat = PT.common_pattern(t, ["leader"], "tk", add_placeholder=True)
    return pat.select(
        F.col("leader").alias("leader_hash"), X.collapse_placeholders(X.detokenize_pattern("pattern")).alias("pattern")
    )


@register("common_pattern_ungated")
def q_common_pattern_ungated(spark, sf):
    """M5: older variant, no ratio gate, over each group of equal messages."""
    t = _tm_tokens(spark, sf)
    pat = PT.common_pattern(t, ["hash"], "tk", gated=False)
    return pat.select("hash", X.detokenize_pattern("pattern").alias("pattern"))


_STOPS = "[" + ", ".join(sql_str(w.lower()) for w in PHRASE_STOP_WORDS) + "]"

PHRASES_SQL = (
    LEADER_SQL
    + f"""
, sent AS (SELECT leader_hash, hash, unnest(regexp_split_to_array(array_to_string(sequence, ' '), {sql_str(PHRASE_SENTENCE_SPLIT)})) AS s FROM assigned),
marked AS (SELECT leader_hash, list_transform(list_filter(regexp_split_to_array(trim(s), '\\s+'), lambda w: w <> ''),
                  lambda w: CASE WHEN list_contains({_STOPS}, lower(w)) THEN '|' ELSE lower(w) END) AS w FROM sent),
ph AS (SELECT leader_hash, trim(unnest(regexp_split_to_array(array_to_string(w, ' '), '\\s*\\|\\s*'))) AS phrase FROM marked),
ok AS (SELECT leader_hash, phrase, regexp_split_to_array(phrase, ' +') AS ws FROM ph WHERE phrase <> '' AND len(regexp_split_to_array(phrase, ' +')) <= 7),
occ AS (SELECT leader_hash, len(ws) AS n, unnest(ws) AS w FROM ok),
score AS (SELECT leader_hash, w, sum(n) / count(*) AS ws FROM occ GROUP BY leader_hash, w),
uniq AS (SELECT DISTINCT leader_hash, phrase, ws FROM ok),
each AS (SELECT leader_hash, phrase, unnest(ws) AS w FROM uniq),
total AS (SELECT e.leader_hash, e.phrase, round(sum(s.ws), 9) AS score FROM each e JOIN score s ON s.leader_hash = e.leader_hash AND s.w = e.w GROUP BY 1, 2)
SELECT leader_hash, phrase, score, row_number() OVER (PARTITION BY leader_hash ORDER BY score DESC, phrase)::BIGINT AS rank FROM total
"""
)


@register("common_phrases", PHRASES_SQL)
def q_common_phrases(spark, sf):
    """M6: key phrases of each leader cluster's text, best first (one row per phrase)."""
    _, _, _, assigned = tm_clusters(spark, sf)
    ph = PT.common_phrases(assigned, ["leader"], "sequence").withColumn("score", F.round("score", 9))
    return PT.ranked_phrases(ph, ["leader"]).select(F.col("leader").alias("leader_hash"), "phrase", "score", F.col("rank").cast("long").alias("rank"))
