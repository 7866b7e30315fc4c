"""Queries for term weighting."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.constants import PLACEHOLDER, TOKEN_STOP_LIST
from ..operators import grouping as G
from ..operators import tokens as K
from ..operators import weights as W
from ..operators.embedding import load, store
from ..session import scratch_path
from ..sources import fixtures as fx
from .duck import sequences_ctes, with_fixtures
from .queries_basic import SEP, _duck_list, _duck_tokenize
from .registry import register

TERMS_SQL = with_fixtures("turns") + f"""
, docs AS (SELECT msg_id, list_transform(list_filter({_duck_tokenize('error_message')},
               lambda t: NOT list_contains({_duck_list(TOKEN_STOP_LIST)}, lower(t)) AND regexp_matches(lower(t), '^\\p{{L}}+$')),
               lambda t: lower(t)) AS tk FROM turns),
terms AS (SELECT msg_id, unnest(tk) AS term FROM docs),
counts AS (SELECT msg_id, term, count(*) AS cnt FROM terms GROUP BY msg_id, term),
nt AS (SELECT msg_id, count(*) AS n_terms FROM counts GROUP BY msg_id),
dfreq AS (SELECT term, count(*) AS df FROM counts GROUP BY term),
ndoc AS (SELECT count(*) AS n FROM docs),
tfidf AS (SELECT c.msg_id, c.term, c.cnt, c.cnt / nt.n_terms AS tf, d.df, log10((SELECT n FROM ndoc) / d.df) AS idf,
                 c.cnt / nt.n_terms * log10((SELECT n FROM ndoc) / d.df) AS tfidf
          FROM counts c JOIN nt USING (msg_id) JOIN dfreq d USING (term))
"""


def _turn_docs(spark, sf):
    t = fx.turns(spark, sf)
    return t.select("msg_id", X.lower_tokens(X.remove_stop_tokens(X.tokenize_message("error_message"), alpha_only=True)).alias("tk"))


@register("doc_term_counts", TERMS_SQL + "SELECT msg_id, term, cnt::BIGINT AS count FROM counts")
def q_doc_term_counts(spark, sf):
    """F1 over conversation turns (stop words and non-letters removed, lower case)."""
    c = W.doc_term_counts(_turn_docs(spark, sf), "msg_id", "tk")
    return c.select("msg_id", "term", F.col("count").cast("long").alias("count"))


@register("term_tf", TERMS_SQL + "SELECT msg_id, term, round(tf, 9) AS tf FROM tfidf")
def q_term_tf(spark, sf):
    """F2."""
    c = W.term_tf(W.doc_term_counts(_turn_docs(spark, sf), "msg_id", "tk"), "msg_id")
    return c.select("msg_id", "term", F.round("tf", 9).alias("tf"))


@register("document_frequency", TERMS_SQL + "SELECT term, df::BIGINT AS df FROM dfreq")
def q_document_frequency(spark, sf):
    """F3."""
    d = W.document_frequency(W.doc_term_counts(_turn_docs(spark, sf), "msg_id", "tk"))
    return d.select("term", F.col("df").cast("long").alias("df"))


@register("term_idf", TERMS_SQL + "SELECT term, round(log10((SELECT n FROM ndoc) / df), 9) AS idf FROM dfreq")
def q_term_idf(spark, sf):
    """F4."""
    docs = _turn_docs(spark, sf)
    d = W.term_idf(W.document_frequency(W.doc_term_counts(docs, "msg_id", "tk")), docs.agg(F.count("*")).scalar())
    return d.select("term", F.round("idf", 9).alias("idf"))


@register("tf_idf", TERMS_SQL + "SELECT msg_id, term, round(tfidf, 9) AS tfidf FROM tfidf")
def q_tf_idf(spark, sf):
    """F5."""
    t = W.tf_idf(_turn_docs(spark, sf), "msg_id", "tk")
    return t.select("msg_id", "term", F.round("tfidf", 9).alias("tfidf"))


@register(
    "mask_heavy_terms",
    TERMS_SQL
    + f"""
, pos AS (SELECT d.msg_id, unnest(d.tk) AS term, generate_subscripts(d.tk, 1) AS p FROM docs d),
pw AS (SELECT pos.*, t.tfidf FROM pos JOIN tfidf t USING (msg_id, term)),
st AS (SELECT msg_id, avg(tfidf) + stddev_pop(tfidf) AS top FROM pw GROUP BY msg_id),
m AS (SELECT pw.msg_id, list(CASE WHEN pw.tfidf >= st.top THEN '{PLACEHOLDER}' ELSE pw.term END ORDER BY p) AS masked
      FROM pw JOIN st USING (msg_id) GROUP BY pw.msg_id)
SELECT d.msg_id, array_to_string(coalesce(m.masked, []::VARCHAR[]), '{SEP}') AS masked FROM docs d LEFT JOIN m USING (msg_id)
""",
)
def q_mask_heavy_terms(spark, sf):
    """F6."""
    docs = _turn_docs(spark, sf)
    t = W.tf_idf(docs, "msg_id", "tk")
    m = W.mask_heavy_terms(docs, "msg_id", "tk", t)
    return m.select("msg_id", F.array_join("masked", SEP).alias("masked"))


@register(
    "terms_analysis",
    with_fixtures("messages")
    + f"""
, tk AS (SELECT msg_id, {_duck_tokenize('error_message')} AS tk FROM messages),
u AS (SELECT DISTINCT tk FROM tk),
cl AS (SELECT list_filter(list_transform(tk, lambda t: lower(t)), lambda t: regexp_matches(t, '^\\p{{L}}+$')) AS tk FROM u),
voc AS (SELECT t AS token FROM (SELECT unnest(tk) AS t FROM cl) GROUP BY t HAVING count(*) > 1)
SELECT msg_id, array_to_string(list_filter(tk, lambda t: list_contains(vl, lower(t))), '{SEP}') AS tokens
FROM tk, (SELECT coalesce(list(token), []::VARCHAR[]) AS vl FROM voc)
""",
)
def q_terms_analysis(spark, sf):
    """F7 + J9: vocabulary of alphabetic lower-case tokens seen more than once
    over the distinct token sequences; every message filtered by it."""
    lines = fx.messages(spark, sf).select("msg_id", "error_message")
    tk = X.tokenize_message("error_message")
    vocab = K.terms_vocabulary(lines.select(tk.alias("tk")), "tk")
    out = K.vocabulary_semi_join(lines, tk, "msg_id", vocab, out="kept")
    return out.select("msg_id", F.array_join("kept", SEP).alias("tokens"))


@register(
    "tfidf_normalised",
    TERMS_SQL
    + """
, w AS (SELECT c.msg_id, c.term, c.cnt * log2((SELECT n FROM ndoc) / d.df) AS w FROM counts c JOIN dfreq d USING (term)),
w2 AS (SELECT * FROM w WHERE abs(w) > 1e-12),
nrm AS (SELECT msg_id, sqrt(sum(w * w)) AS nrm FROM w2 GROUP BY msg_id)
SELECT msg_id, term, round(w / nrm, 9) AS weight FROM w2 JOIN nrm USING (msg_id)
""",
)
def q_tfidf_normalised(spark, sf):
    """F8."""
    w = W.tfidf_normalised(_turn_docs(spark, sf), "msg_id", "tk")
    return w.select("msg_id", "term", F.round("weight", 9).alias("weight"))


@register(
    "tfidf_apply",
    TERMS_SQL
    + """
, learnt AS (SELECT msg_id FROM turns WHERE src_site = 'user'),
model AS (SELECT term, count(*) AS df FROM counts JOIN learnt USING (msg_id) GROUP BY term),
w AS (SELECT c.msg_id, c.term, c.cnt * log2((SELECT count(*) FROM learnt) / m.df) AS w FROM counts c JOIN model m USING (term)),
w2 AS (SELECT * FROM w WHERE abs(w) > 1e-12),
nrm AS (SELECT msg_id, sqrt(sum(w * w)) AS nrm FROM w2 GROUP BY msg_id)
SELECT msg_id, term, round(w / nrm, 9) AS weight FROM w2 JOIN nrm USING (msg_id)
""",
)
def q_tfidf_apply(spark, sf):
    """S14 + F8: the frequencies of what users wrote are stored, and weigh the turns of all roles."""
    docs = _turn_docs(spark, sf)
    users = fx.turns(spark, sf).where("src_site = 'user'").select("msg_id")
    path = scratch_path(spark, "term-weights")
    store(W.tfidf_model(docs.join(users, "msg_id", "left_semi"), "msg_id", "tk"), path)
    w = W.tfidf_apply(docs, "msg_id", "tk", load(spark, path))
    return w.select("msg_id", "term", F.round("weight", 9).alias("weight"))


TM = "templated_messages"
SITE_SQL = with_fixtures(TM, extra=sequences_ctes(TM, by=("src_site",))) + """
, sd AS (SELECT src_site, string_agg(array_to_string(sequence, ' '), '. ' ORDER BY hash) AS text
         FROM (SELECT src_site, hash, arg_min(sequence, msg_id) AS sequence FROM seqs GROUP BY src_site, hash) GROUP BY src_site),
words AS (SELECT src_site, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS term FROM sd),
cnt AS (SELECT src_site, term, count(*) AS c FROM words WHERE length(term) >= 2 GROUP BY src_site, term),
dfr AS (SELECT term, count(*) AS df FROM cnt GROUP BY term),
w AS (SELECT src_site, term, c * (ln((1 + (SELECT count(*) FROM sd)) / (1 + df)) + 1) AS w FROM cnt JOIN dfr USING (term)),
nrm AS (SELECT src_site, sqrt(sum(w * w)) AS nrm FROM w GROUP BY src_site),
sw AS (SELECT src_site, term, w / nrm AS weight FROM w JOIN nrm USING (src_site))
"""


def _site_docs(spark, sf):
    """Per source site, one row per group sequence (per-site rare-token rule)."""
    tm = fx.templated_messages(spark, sf)
    seqs = G.prepare_sequences(tm, by=["src_site"])
    groups = G.group_equal_messages(seqs, by=["src_site"])
    return groups.select("src_site", F.array_join("sequence", " ").alias("text"))


@register("site_tfidf", SITE_SQL + "SELECT src_site, term, round(weight, 9) AS weight FROM sw")
def q_site_tfidf(spark, sf):
    """F9 + C3 sequences: one document per source site."""
    w = W.site_tfidf(_site_docs(spark, sf), "src_site", "text")
    return w.select("src_site", "term", F.round("weight", 9).alias("weight"))


@register(
    "top_terms",
    SITE_SQL + "SELECT src_site, term, round(weight, 9) AS weight FROM sw WHERE src_site = '1' ORDER BY weight DESC, term LIMIT 10",
)
def q_top_terms(spark, sf):
    """The ten heaviest terms of site 1."""
    w = W.site_tfidf(_site_docs(spark, sf), "src_site", "text")
    return W.top_terms(w, 10, "src_site", "1").select("src_site", "term", F.round("weight", 9).alias("weight"))
