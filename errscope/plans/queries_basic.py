"""Queries for scans, projections, text operations and equal-message groups."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..functions.constants import PLACEHOLDER, SPACER, TOKEN_STOP_LIST
from ..operators import grouping as G
from ..operators import tokens as K
from ..operators.ordering import global_row_number
from ..sources import fixtures as fx
from ..sources import readers as R
from ..sources.tables import read_table
from .duck import clean_expr, sequences_ctes, sql_str, with_fixtures
from .registry import register

TM = "templated_messages"


def _templated_seqs(spark, sf):
    return G.prepare_sequences(fx.templated_messages(spark, sf))


def _long(c):
    return F.col(c).cast("long") if isinstance(c, str) else c.cast("long")


# ---------------------------------------------------------------- minimum slice
GROUPS_SQL = with_fixtures(TM, extra=sequences_ctes(TM)) + """
SELECT hash, count(*)::BIGINT AS cluster_size, min(msg_id) AS first_id,
       array_to_string(arg_min(sequence, msg_id), ' ') AS sequence_text
FROM seqs GROUP BY hash
"""


@register("group_equal_messages", GROUPS_SQL)
def q_group_equal_messages(spark, sf):
    groups = G.group_equal_messages(_templated_seqs(spark, sf))
    return groups.select(
        "hash", _long("cluster_size").alias("cluster_size"), "first_id", F.array_join("sequence", " ").alias("sequence_text")
    )


@register(
    "clusters_by_size",
    with_fixtures(TM, extra=sequences_ctes(TM))
    + """
SELECT hash, count(*)::BIGINT AS cluster_size, row_number() OVER (ORDER BY count(*) DESC, hash)::BIGINT AS position FROM seqs GROUP BY hash
""",
)
def q_clusters_by_size(spark, sf):
    """O1: all groups, largest first (tie: hash), with their position in that order."""
    groups = G.group_equal_messages(_templated_seqs(spark, sf)).withColumn("smaller", -F.col("cluster_size"))
    ordered = global_row_number(groups, ["smaller", "hash"], "position")
    return ordered.select("hash", _long("cluster_size").alias("cluster_size"), (F.col("position") + 1).cast("long").alias("position"))


# ---------------------------------------------------------------- T1-T4
@register(
    "clean_message",
    with_fixtures(TM, "raw_pages")
    + f"""
SELECT 'tm' AS src, msg_id, {clean_expr('error_message')} AS cleaned FROM templated_messages
UNION ALL
SELECT 'page' AS src, msg_id, {clean_expr('error_message')} AS cleaned FROM raw_pages
""",
)
def q_clean_message(spark, sf):
    tm = fx.templated_messages(spark, sf).select(F.lit("tm").alias("src"), "msg_id", X.clean_message("error_message").alias("cleaned"))
    pg = fx.raw_pages(spark, sf).select(F.lit("page").alias("src"), "msg_id", X.clean_message("error_message").alias("cleaned"))
    return tm.unionByName(pg)


@register(
    "clean_message_text",
    with_fixtures("messages") + f"SELECT msg_id, {clean_expr('error_message')} AS cleaned FROM messages",
)
def q_clean_message_text(spark, sf):
    """T1 over the multilingual prose lines (Unicode letters, marks, digits)."""
    return fx.messages(spark, sf).select("msg_id", X.clean_message("error_message").alias("cleaned"))


@register(
    "split_tokens",
    with_fixtures(TM)
    + f"""
SELECT msg_id, len(string_split(c, ' '))::BIGINT AS n_tokens, array_to_string(string_split(c, ' '), '|') AS tokens
FROM (SELECT msg_id, {clean_expr('error_message')} AS c FROM templated_messages)
""",
)
def q_split_tokens(spark, sf):
    t = fx.templated_messages(spark, sf).select("msg_id", X.split_tokens(X.clean_message("error_message")).alias("t"))
    return t.select("msg_id", _long(F.size("t")).alias("n_tokens"), F.array_join("t", "|").alias("tokens"))


@register(
    "term_frequency",
    with_fixtures(TM, extra=sequences_ctes(TM)) + "SELECT token, n::BIGINT AS frequency FROM freq",
)
def q_term_frequency(spark, sf):
    t = fx.templated_messages(spark, sf).select(X.split_tokens(X.clean_message("error_message")).alias("t"))
    return K.term_frequency(t, "t").select("token", _long("frequency").alias("frequency"))


@register(
    "vocabulary",
    with_fixtures("messages", extra=sequences_ctes("messages")) + "SELECT DISTINCT token FROM tok",
)
def q_vocabulary(spark, sf):
    t = fx.messages(spark, sf).select(X.split_tokens(X.clean_message("error_message")).alias("t"))
    return K.vocabulary(t, "t")


@register(
    "drop_rare_tokens",
    with_fixtures("messages", extra=sequences_ctes("messages"))
    + "SELECT msg_id, len(sequence)::BIGINT AS n_kept, array_to_string(sequence, ' ') AS sequence_text FROM seqs",
)
def q_drop_rare_tokens(spark, sf):
    s = G.prepare_sequences(fx.messages(spark, sf))
    return s.select("msg_id", _long(F.size("sequence")).alias("n_kept"), F.array_join("sequence", " ").alias("sequence_text"))


@register(
    "content_hash",
    with_fixtures("messages", extra=sequences_ctes("messages")) + "SELECT msg_id, hash FROM seqs",
)
def q_content_hash(spark, sf):
    return G.prepare_sequences(fx.messages(spark, sf)).select("msg_id", "hash")


@register(
    "join_term_frequency",
    with_fixtures(TM, extra=sequences_ctes(TM))
    + """
SELECT t.msg_id, (t.pos - 1)::BIGINT AS pos, t.token, f.n::BIGINT AS frequency FROM tok t JOIN freq f ON t.token = f.token
""",
)
def q_join_term_frequency(spark, sf):
    """Each token occurrence with its corpus frequency."""
    t = fx.templated_messages(spark, sf).select("msg_id", X.split_tokens(X.clean_message("error_message")).alias("t"))
    ex = K.explode_tokens(t, "t", ["msg_id"])
    freq = K.term_frequency(t, "t")
    return ex.join(freq, "token").select("msg_id", _long("pos").alias("pos"), "token", _long("frequency").alias("frequency"))


# ---------------------------------------------------------------- T5-T10, T15, T16
def _duck_tokenize(expr: str, kind: str = "conservative") -> str:
    pat = sql_str(X.TOKEN_PATTERNS[kind])
    return (
        f"list_transform(regexp_extract_all(coalesce({expr}, ''), {pat}), "
        f"lambda t: CASE WHEN t = ' ' THEN '{SPACER}' ELSE t END)"
    )


def _duck_list(items) -> str:
    return "[" + ", ".join(sql_str(w) for w in items) + "]"


SEP = "␟"  # separator of token lists in compared output


@register(
    "tokenize_message",
    with_fixtures("messages")
    + f"""
SELECT msg_id, len(tk)::BIGINT AS n_tokens, array_to_string(tk, '{SEP}') AS tokens
FROM (SELECT msg_id, {_duck_tokenize('error_message')} AS tk FROM messages)
""",
)
def q_tokenize_message(spark, sf):
    t = fx.messages(spark, sf).select("msg_id", X.tokenize_message("error_message").alias("tk"))
    return t.select("msg_id", _long(F.size("tk")).alias("n_tokens"), F.array_join("tk", SEP).alias("tokens"))


@register(
    "tokenize_message_templated",
    with_fixtures(TM)
    + f"""
SELECT msg_id, array_to_string({_duck_tokenize('error_message')}, '{SEP}') AS conservative,
       array_to_string({_duck_tokenize('error_message', 'aggressive')}, '{SEP}') AS aggressive,
       array_to_string({_duck_tokenize('error_message', 'space')}, '{SEP}') AS space
FROM templated_messages
""",
)
def q_tokenize_message_templated(spark, sf):
    t = fx.templated_messages(spark, sf)
    return t.select(
        "msg_id",
        F.array_join(X.tokenize_message("error_message"), SEP).alias("conservative"),
        F.array_join(X.tokenize_message("error_message", "aggressive"), SEP).alias("aggressive"),
        F.array_join(X.tokenize_message("error_message", "space"), SEP).alias("space"),
    )


def _duck_detok(lst: str) -> str:
    kept = (
        f"list_filter({lst}, lambda t, i: NOT (t = '{SPACER}' AND i < len({lst}) AND {lst}[i + 1] = '{PLACEHOLDER}'))"
    )
    return f"array_to_string(list_transform({kept}, lambda t: CASE WHEN t = '{SPACER}' THEN ' ' ELSE t END), '')"


@register(
    "detokenize_pattern",
    with_fixtures(TM)
    + f"""
SELECT msg_id, {_duck_detok('tk')} AS text, {_duck_detok('masked')} AS masked_text
FROM (SELECT msg_id, tk, list_transform(tk, lambda t: CASE WHEN regexp_matches(t, '^[0-9]') THEN '{PLACEHOLDER}' ELSE t END) AS masked
      FROM (SELECT msg_id, {_duck_tokenize('error_message')} AS tk FROM templated_messages))
""",
)
def q_detokenize_pattern(spark, sf):
    """Round trip, and a masked variant where numbers became placeholders."""
    t = fx.templated_messages(spark, sf).select("msg_id", X.tokenize_message("error_message").alias("tk"))
    masked = F.transform("tk", lambda x: F.when(x.rlike("^[0-9]"), F.lit(PLACEHOLDER)).otherwise(x))
    return t.select("msg_id", X.detokenize_pattern("tk").alias("text"), X.detokenize_pattern(masked).alias("masked_text"))


def _duck_dedup(lst: str) -> str:
    return f"list_filter({lst}, lambda t, i: i = 1 OR t <> {lst}[i - 1])"


@register(
    "dedup_adjacent_tokens",
    with_fixtures("messages")
    + f"""
SELECT msg_id, array_to_string({_duck_dedup('tk')}, '{SEP}') AS tokens
FROM (SELECT msg_id, {_duck_tokenize('lower(error_message)', 'aggressive')} AS tk FROM messages)
""",
)
def q_dedup_adjacent_tokens(spark, sf):
    t = fx.messages(spark, sf).select("msg_id", X.tokenize_message(F.lower("error_message"), "aggressive").alias("tk"))
    return t.select("msg_id", F.array_join(X.dedup_adjacent_tokens("tk"), SEP).alias("tokens"))


@register(
    "lower_tokens",
    with_fixtures("turns")
    + f"""
SELECT msg_id, array_to_string(list_transform(tk, lambda t: lower(t)), '{SEP}') AS tokens
FROM (SELECT msg_id, {_duck_tokenize('error_message')} AS tk FROM turns)
""",
)
def q_lower_tokens(spark, sf):
    t = fx.turns(spark, sf).select("msg_id", X.tokenize_message("error_message").alias("tk"))
    return t.select("msg_id", F.array_join(X.lower_tokens("tk"), SEP).alias("tokens"))


@register(
    "keep_alpha_tokens",
    with_fixtures("turns")
    + f"""
SELECT msg_id, array_to_string(list_filter(tk, lambda t: regexp_matches(lower(t), '^\\p{{L}}+$')), '{SEP}') AS tokens
FROM (SELECT msg_id, {_duck_tokenize('error_message')} AS tk FROM turns)
""",
)
def q_keep_alpha_tokens(spark, sf):
    t = fx.turns(spark, sf).select("msg_id", X.tokenize_message("error_message").alias("tk"))
    return t.select("msg_id", F.array_join(X.keep_alpha_tokens("tk"), SEP).alias("tokens"))


@register(
    "remove_stop_tokens",
    with_fixtures("turns")
    + f"""
SELECT msg_id,
  array_to_string(list_filter(tk, lambda t: NOT list_contains({_duck_list(TOKEN_STOP_LIST)}, lower(t))
                                   AND regexp_matches(lower(t), '^\\p{{L}}+$')), '{SEP}') AS clean_alpha,
  array_to_string(list_filter(tk, lambda t: NOT list_contains({_duck_list(TOKEN_STOP_LIST)}, lower(t))), '{SEP}') AS clean_only
FROM (SELECT msg_id, {_duck_tokenize('error_message')} AS tk FROM turns)
""",
)
def q_remove_stop_tokens(spark, sf):
    t = fx.turns(spark, sf).select("msg_id", X.tokenize_message("error_message").alias("tk"))
    return t.select(
        "msg_id",
        F.array_join(X.remove_stop_tokens("tk", alpha_only=True), SEP).alias("clean_alpha"),
        F.array_join(X.remove_stop_tokens("tk", alpha_only=False), SEP).alias("clean_only"),
    )


@register(
    "collapse_placeholders",
    with_fixtures(TM)
    + f"""
SELECT msg_id, regexp_replace(error_message || ' (' || dst_site || ') Run() done', {sql_str(X.COLLAPSE_RE)}, '(.*?)') AS pattern
FROM templated_messages
""",
)
def q_collapse_placeholders(spark, sf):
    t = fx.templated_messages(spark, sf)
    txt = F.concat("error_message", F.lit(" ("), "dst_site", F.lit(") Run() done"))
    return t.select("msg_id", X.collapse_placeholders(txt).alias("pattern"))


@register(
    "cluster_uuid",
    with_fixtures(TM, extra=sequences_ctes(TM))
    + """
SELECT hash, substr(md5(hash), 1, 8) || '-' || substr(md5(hash), 9, 4) || '-' || substr(md5(hash), 13, 4) || '-' ||
       substr(md5(hash), 17, 4) || '-' || substr(md5(hash), 21, 12) AS cluster_id
FROM (SELECT DISTINCT hash FROM seqs)
""",
)
def q_cluster_uuid(spark, sf):
    g = _templated_seqs(spark, sf).select("hash").distinct()
    return g.select("hash", X.cluster_uuid("hash").alias("cluster_id"))


@register(
    "training_sequences",
    with_fixtures(TM)
    + f"""
SELECT DISTINCT array_to_string(list_filter({_duck_tokenize('c')}, lambda t: t <> '{SPACER}'), '{SEP}') AS tokens
FROM (SELECT DISTINCT {clean_expr('error_message')} AS c FROM templated_messages)
""",
)
def q_training_sequences(spark, sf):
    """Clean, distinct, tokenize, drop the spacer."""
    from ..operators.vectors import training_sequences

    seqs = training_sequences(fx.templated_messages(spark, sf))
    return seqs.select(F.array_join("tokens", SEP).alias("tokens")).distinct()


# ---------------------------------------------------------------- scans and sinks
RAW_SQL = with_fixtures("raw_flat")


@register(
    "scan_json_schema",
    RAW_SQL + "SELECT ts_ms AS timestamp, src AS src_hostname, dst AS dst_hostname, msg AS error_message FROM raw_flat",
)
def q_scan_json_schema(spark, sf):
    """S1 + P1: records written as newline JSON, read back with the explicit nested schema."""
    path = R.write_json_records(spark, fx.raw_records(spark, sf).drop("event_id"))
    return R.project_transfer_records(R.read_transfer_json(spark, path))


@register(
    "filter_non_empty",
    RAW_SQL
    + "SELECT ts_ms AS timestamp, src AS src_hostname, dst AS dst_hostname, msg AS error_message FROM raw_flat WHERE msg <> ''",
)
def q_filter_non_empty(spark, sf):
    """S1 + P1 + P2: the daily job's scan; NULL and '' messages are dropped."""
    path = R.write_json_records(spark, fx.raw_records(spark, sf).drop("event_id"))
    return R.non_empty(R.project_transfer_records(R.read_transfer_json(spark, path)))


@register(
    "scan_daily_path",
    RAW_SQL
    + """
SELECT strftime(epoch_ms(ts_ms), '%Y/%m/%d') AS day, count(*)::BIGINT AS n
FROM raw_flat WHERE msg <> '' GROUP BY 1
""",
)
def q_scan_daily_path(spark, sf):
    """S2 + S3: records written into YYYY/MM/DD folders, read back by a list of day paths (glob)."""
    root = R.write_daily_json(spark, fx.raw_records(spark, sf).drop("event_id"))
    df = R.read_transfer_days(spark, root, ["*/*/*"])
    df = R.non_empty(R.project_transfer_records(df, with_file=True))
    return df.groupBy(F.regexp_extract("source_file", r"(\d{4}/\d{2}/\d{2})", 1).alias("day")).agg(F.count("*").alias("n"))


@register(
    "scan_day_range",
    RAW_SQL
    + """
SELECT strftime(epoch_ms(ts_ms), '%Y/%m/%d') AS day, count(*)::BIGINT AS n FROM raw_flat
WHERE msg <> '' AND CAST(epoch_ms(ts_ms) AS DATE) >= (SELECT min(CAST(epoch_ms(ts_ms) AS DATE)) + 1 FROM raw_flat)
GROUP BY 1
""",
)
def q_scan_day_range(spark, sf):
    """The day folders from the second day of the records to the last one, listed by name."""
    raw = fx.raw_records(spark, sf).drop("event_id")
    root = R.write_daily_json(spark, raw)
    stamp = F.timestamp_millis("metadata.timestamp").cast("date")
    first, last = raw.agg(F.min(stamp), F.max(stamp)).toArrow().to_pylist()[0].values()
    days = R.day_range(R.day_folder(first + _dt.timedelta(days=1)), R.day_folder(last))
    df = R.non_empty(R.project_transfer_records(R.read_transfer_days(spark, root, days), with_file=True))
    return df.groupBy(F.regexp_extract("source_file", r"(\d{4}/\d{2}/\d{2})", 1).alias("day")).agg(F.count("*").alias("n"))


@register(
    "scan_sql_view",
    RAW_SQL + "SELECT msg AS error_message, src AS src_hostname FROM raw_flat WHERE msg <> '' AND src = 'host3.example.org'",
)
def q_scan_sql_view(spark, sf):
    """Temp view + SQL with a non-empty predicate."""
    path = R.write_json_records(spark, fx.raw_records(spark, sf).drop("event_id"))
    flat = R.project_transfer_records(R.read_transfer_json(spark, path))
    return R.select_by_sql(
        spark, flat, "SELECT error_message, src_hostname FROM {t} WHERE error_message <> '' AND src_hostname = 'host3.example.org'"
    )


TM_PLAIN = "SELECT msg_id, src_site, dst_site, error_message FROM templated_messages"


@register("scan_csv", with_fixtures(TM) + TM_PLAIN)
def q_scan_csv(spark, sf):
    """S10 (comma) then S5: write with header, read with header and inferred types."""
    tm = fx.templated_messages(spark, sf).select("msg_id", "src_site", "dst_site", "error_message")
    path = R.write_csv(spark, tm, sep=",")
    df = R.read_csv(spark, path)
    return df.select(
        F.col("msg_id").cast("long"), F.col("src_site").cast("string"), F.col("dst_site").cast("string"), "error_message"
    )


@register("scan_csv_rename", with_fixtures(TM) + "SELECT msg_id AS id, error_message AS error FROM templated_messages")
def q_scan_csv_rename(spark, sf):
    """S10 (pipe) then S6: header replaced by given names and types."""
    tm = fx.templated_messages(spark, sf).select("msg_id", "error_message")
    path = R.write_csv(spark, tm, sep="|")
    return R.read_csv_renamed(spark, path, ["id long", "error string"], sep="|")


@register("scan_tsv", with_fixtures(TM) + "SELECT msg_id, src_hostname, error_message FROM templated_messages")
def q_scan_tsv(spark, sf):
    """Tab-separated."""
    tm = fx.templated_messages(spark, sf).select("msg_id", "src_hostname", "error_message")
    path = R.write_csv(spark, tm, sep="\t")
    df = R.read_csv(spark, path, sep="\t")
    return df.select(F.col("msg_id").cast("long"), "src_hostname", "error_message")


@register(
    "scan_multi_csv",
    with_fixtures(TM)
    + """
SELECT row_number() OVER (ORDER BY timestamp, msg_id) - 1 AS new_id, msg_id, error_message FROM templated_messages
""",
)
def q_scan_multi_csv(spark, sf):
    """S8 + U1: CSV files per day in a folder, read by one glob, ids renumbered in time order."""
    tm = fx.templated_messages(spark, sf).select("msg_id", "timestamp", "error_message")
    folder = R.write_csv_per_day(spark, tm, "timestamp")
    df = R.read_csv_glob(spark, folder, "*.txt", schema="msg_id long, timestamp long, error_message string")
    return R.renumber(df, ["timestamp", "msg_id"], "new_id").select("new_id", "msg_id", "error_message")


@register(
    "union_days",
    with_fixtures(TM)
    + """
SELECT strftime(make_timestamp(timestamp), '%Y-%m-%d') AS day, count(*)::BIGINT AS n FROM templated_messages GROUP BY 1
""",
)
def q_union_days(spark, sf):
    """The folders of all days read as one frame."""
    day = F.date_from_unix_date(F.floor(F.col("timestamp") / 86_400_000_000).cast("int"))
    tm = fx.templated_messages(spark, sf).withColumn("day", F.date_format(day, "yyyy-MM-dd"))
    df = R.union_days(spark, R.write_day_folders(spark, tm, "day"))
    return df.groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n"))


@register(
    "scan_text_lines",
    with_fixtures("messages") + "SELECT error_message AS value, count(*)::BIGINT AS n FROM messages GROUP BY 1",
)
def q_scan_text_lines(spark, sf):
    """A log file with one message per line."""
    path = R.write_text_lines(spark, fx.messages(spark, sf).select("error_message"))
    return R.read_text_lines(spark, path).groupBy("value").agg(F.count("*").alias("n"))


@register("preview", with_fixtures(TM) + "SELECT msg_id, error_message FROM templated_messages ORDER BY msg_id LIMIT 20")
def q_preview(spark, sf):
    """First rows in id order."""
    return R.preview(fx.templated_messages(spark, sf), 20, "msg_id").select("msg_id", "error_message")
