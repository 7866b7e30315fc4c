"""Message views derived from the driver's tables (see FIXTURES.md).

``templated_messages`` is written once as SQL text that both Spark and
DuckDB run, so the oracle sees exactly the same messages. The other views
need engine-specific list functions and come in two forms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# Pieces of the templated messages (fixed values of our own fixture).
_HOST = "('host' || CAST(user_id % 20 AS STRING) || '.example.org')"
_PATH = "('/store/run_' || CAST(event_id AS STRING) || '/f' || CAST(user_id AS STRING))"
_VAL = "CAST(CAST(floor(value) AS BIGINT) AS STRING)"
_USER = "CAST(user_id AS STRING)"
_NAME = "('job_' || CAST(user_id % 5 AS STRING) || '_lock')"
_TAG = "('<rc=' || CAST(user_id % 3 AS STRING) || '>')"

_TEMPLATES = [
    f"'Copy job ' || event_type || ' gave up for user ' || {_USER} || ' at ' || {_HOST}",
    f"'No answer within ' || {_VAL} || ' seconds from ' || {_HOST} || ' path ' || {_PATH}",
    f"{_TAG} || 'digest differs</rc> for item ' || {_PATH}",
    f"'Target refused replacement: a copy is present at ' || {_PATH}",
    f"'Input item ' || {_PATH} || ' is absent from ' || {_HOST} || ' (' || event_type || ')'",
    f"'Job stopped by user_' || {_USER} || ' because ' || event_type || ' quota used up'",
    f"'ACCESS_CHECK_FAILED rights missing for ' || {_NAME} || ' on ' || {_HOST}",
    f"'Digest differs for ' || {_PATH} || ' expected ' || {_VAL} || ' got ' || {_USER}",
    f"'Door closed at ' || {_HOST} || ' port ' || {_VAL} || ' (' || event_type || ')'",
    f"'Reading ' || {_PATH} || ' ended: the entry is gone [' || event_type || ']'",
    f"'Step ran out of time after ' || {_VAL} || ' seconds (' || event_type || ' stage)'",
    f"'Login handshake cut short on ' || {_HOST} || ': line dropped by ' || event_type || ' partner'",
]

_CASES = "\n".join(f"      WHEN {i} THEN {t}" for i, t in enumerate(_TEMPLATES))

# {ts_us}: microseconds since the epoch of the NTZ column ``ts`` (engine specific).
TEMPLATED_SQL = f"""
SELECT event_id AS msg_id,
       {{ts_us}} AS timestamp,
       CAST(user_id % 10 AS STRING) AS src_site,
       CAST(user_id % 7 AS STRING) AS dst_site,
       {_HOST} AS src_hostname,
       ('site' || CAST(user_id % 7 AS STRING) || '.example.net') AS dst_hostname,
       CASE event_id % 12
{_CASES}
       END AS error_message
FROM {{events}}
"""

SPARK_TS_US = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"
DUCK_TS_US = "epoch_us(ts)"


def templated_sql_duckdb() -> str:
    return TEMPLATED_SQL.format(ts_us=DUCK_TS_US, events="events")


def templated_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    return spark.sql(TEMPLATED_SQL.format(ts_us=SPARK_TS_US, events="{events}"), events=events)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per non-empty line of ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    return (
        docs.select("doc_id", "source", "lang", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
        .where(F.col("line") != "")
        .select(
            (F.col("doc_id") * 100000 + F.col("pos")).alias("msg_id"),
            F.col("line").alias("error_message"),
            F.col("source").alias("src_site"),
            F.col("lang").alias("dst_site"),
        )
    )


MESSAGES_SQL = """
SELECT doc_id * 100000 + pos AS msg_id, line AS error_message, source AS src_site, lang AS dst_site
FROM (SELECT doc_id, source, lang, unnest(parts) AS line, generate_subscripts(parts, 1) - 1 AS pos
      FROM (SELECT doc_id, source, lang, string_split(text, chr(10)) AS parts FROM documents))
WHERE line <> ''
"""


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = read_table(spark, sf_dir, "conversations")
    return conv.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("msg_id"),
        F.col("text").alias("error_message"),
        F.col("role").alias("src_site"),
    )


TURNS_SQL = "SELECT conv_id * 1000 + turn AS msg_id, text AS error_message, role AS src_site FROM conversations"


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return pages.select(F.col("page_id").alias("msg_id"), F.col("html").alias("error_message"))


RAW_PAGES_SQL = "SELECT page_id AS msg_id, html AS error_message FROM pages"


def site_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("site"),
        (F.col("event_type") == "error").alias("failed"),
    )


SITE_OUTCOMES_SQL = "SELECT CAST(user_id AS VARCHAR) AS site, event_type = 'error' AS failed FROM events"

# Raw transfer records: the nested shape of the daily job's JSON input.
# signup -> NULL message, view -> empty message, others -> text.
RAW_RECORD_SQL = """
SELECT {ts_ms} AS ts_ms,
       CASE WHEN event_type = 'signup' THEN NULL
            WHEN event_type = 'view' THEN ''
            ELSE event_type || ' failure ' || props END AS msg,
       ('host' || CAST(user_id % 20 AS STRING) || '.example.org') AS src,
       ('site' || CAST(user_id % 7 AS STRING) || '.example.net') AS dst,
       event_id
FROM {events}
"""
SPARK_TS_MS = "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"
DUCK_TS_MS = "(epoch_us(ts) // 1000)"


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested records: ``metadata.timestamp`` and ``data.{t__error_message, src_hostname, dst_hostname}``."""
    events = read_table(spark, sf_dir, "events")
    flat = spark.sql(RAW_RECORD_SQL.format(ts_ms=SPARK_TS_MS, events="{events}"), events=events)
    return flat.select(
        F.struct(F.col("ts_ms").alias("timestamp")).alias("metadata"),
        F.struct(
            F.col("msg").alias("t__error_message"),
            F.col("src").alias("src_hostname"),
            F.col("dst").alias("dst_hostname"),
        ).alias("data"),
        F.col("event_id"),
    )


def raw_records_flat_sql_duckdb() -> str:
    return RAW_RECORD_SQL.format(ts_ms=DUCK_TS_MS, events="events")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", "embedding")


FIXTURE_SQL = {
    "messages": MESSAGES_SQL,
    "turns": TURNS_SQL,
    "raw_pages": RAW_PAGES_SQL,
    "site_outcomes": SITE_OUTCOMES_SQL,
}


def fixture_ctes(*names: str) -> str:
    """``WITH`` clause defining the named fixture views for DuckDB oracles."""
    parts = []
    for n in names:
        if n == "templated_messages":
            parts.append(f"templated_messages AS ({templated_sql_duckdb()})")
        elif n == "raw_flat":
            parts.append(f"raw_flat AS ({raw_records_flat_sql_duckdb()})")
        else:
            parts.append(f"{n} AS ({FIXTURE_SQL[n]})")
    return "WITH " + ",\n".join(parts) + "\n"
