"""The daily job — scan, cluster, label, publish."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import ENVELOPE_TYPE, ENVELOPE_VERSION
from ..operators.ordering import batch_number, global_row_number
from ..operators.report import model_tag
from ..session import written
from ..sources import readers as R
from .chain import ChainRun, ChainSettings, cluster_messages

PUBLISHED = ["timestamp", "cluster_id", "cluster_pattern", "model", "src_hostname", "dst_hostname", "error_message"]


def with_message_ids(df: DataFrame, order_cols: Sequence[str], id_col: str = "msg_id") -> DataFrame:
    """Q1: a stable id from the record's own fields (distributed numbering)."""
    return global_row_number(df, list(order_cols), id_col)


def label_published(messages: DataFrame, run: ChainRun, id_col: str = "msg_id", by: Sequence[str] = ()) -> DataFrame:
    """J2 + P7 + P10: every message with cluster id, pattern and model tag, by
    one join. The chain labels every message (Q14), so the join is an inner one
    and its row count is the check."""
    keys = [*by, "cluster_key"]
    pattern = F.col("pattern") if "pattern" in run.clusters.columns else F.lit(None).cast("string")
    names = run.clusters.select(*keys, "cluster_id", pattern.alias("cluster_pattern"))
    per_msg = run.bridge.select(*keys, id_col).join(names, keys).select(*by, id_col, "cluster_id", "cluster_pattern")
    return model_tag(messages.join(per_msg, [*by, id_col]), run.strategy)


def published_projection(df: DataFrame) -> DataFrame:
    """P10: the seven published columns."""
    return df.select(*PUBLISHED)


def envelope_column(columns: Sequence[str], doc_type: str = ENVELOPE_TYPE, version: str = ENVELOPE_VERSION, ts_col: str = "timestamp"):
    """JSON text of {data: payload, metadata: {type, version, timestamp}}."""
    payload = F.struct(*[F.col(c) for c in columns])
    meta = F.struct(F.lit(doc_type).alias("type"), F.lit(version).alias("version"), F.col(ts_col).alias("timestamp"))
    return F.to_json(F.struct(payload.alias("data"), meta.alias("metadata")))


def message_envelope(df: DataFrame, doc_type: str = ENVELOPE_TYPE, version: str = ENVELOPE_VERSION, ts_col: str = "timestamp") -> DataFrame:
    """One JSON envelope per row."""
    return df.select(envelope_column(df.columns, doc_type, version, ts_col).alias("message"))


def publish_batches(
    df: DataFrame,
    out_path: str,
    order_cols: Sequence[str],
    batch_size: int = 10000,
    ts_col: str = "timestamp",
    commits: int = 20,
    on_commit: Callable[[int, int], None] | None = None,
) -> str:
    """S12 + W3: consecutive batches of ``batch_size`` rows in ``order_cols``
    order, which must be total. JSON envelopes carry their batch number as a
    column, and no file holds more than a batch.

    The batches go out in up to ``commits`` portions. A portion counts as sent when a
    line about it is appended to the manifest, after all its files; readers
    (``read_batches``) look at portions of the manifest only. A run that was killed
    is started again with the same rows and goes on behind the last line, so every batch
    is sent once. ``on_commit`` hears of the first and last batch of each portion."""
    spark = df.sparkSession
    numbered = written(batch_number(df, order_cols, batch_size, "batch").select("batch", envelope_column(df.columns, ts_col=ts_col).alias("message")), "batches")
    last = numbered.agg(F.max("batch")).toArrow().column(0)[0].as_py()
    step = 0 if last is None else -(-(last + 1) // commits)
    sent = _manifest(spark, out_path)
    first = 0 if sent is None else (sent.agg(F.max("last")).toArrow().column(0)[0].as_py() + 1)
    while last is not None and first <= last:
        until = min(first + step - 1, last)
        portion = uuid.uuid4().hex
        rows = numbered.where(F.col("batch").between(first, until))
        rows.write.option("maxRecordsPerFile", batch_size).json(f"{out_path}/portion={portion}")
        line = spark.range(1).select(F.lit(portion).alias("portion"), F.lit(first).cast("long").alias("first"), F.lit(until).cast("long").alias("last"))
        line.coalesce(1).write.mode("append").json(f"{out_path}/manifest")
        if on_commit is not None:
            on_commit(first, until)
        first = until + 1
    return out_path


def _manifest(spark: SparkSession, out_path: str) -> DataFrame | None:
    """(portion, first, last) of what has been sent, None before the first portion."""
    lines = spark.read.schema("portion string, first long, last long")
    try:
        sent = lines.json(f"{out_path}/manifest")
        return None if sent.isEmpty() else sent
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_batches(spark: SparkSession, out_path: str) -> DataFrame:
    """(batch, message) of all batches that were sent."""
    rows = spark.read.schema("batch long, message string")
    sent = _manifest(spark, out_path)
    if sent is None:
        return spark.createDataFrame([], "batch long, message string")
    portions = [r["portion"] for r in sent.select("portion").distinct().toArrow().to_pylist()]  # at most as many as commits
    return rows.json([f"{out_path}/portion={p}" for p in portions])


def daily_report(
    spark: SparkSession,
    root: str,
    days: Sequence[str] | None = None,
    settings: ChainSettings | None = None,
    out_path: str | None = None,
    batch_size: int = 10000,
) -> DataFrame:
    """Read the day's records, cluster every message, return (and
    optionally publish) the labelled rows."""
    raw = R.non_empty(R.project_transfer_records(R.read_transfer_days(spark, root, days)))
    msgs = with_message_ids(raw, ["timestamp", "src_hostname", "dst_hostname", "error_message"])
    run = cluster_messages(msgs, "error_message", "msg_id", settings=settings)
    out = published_projection(label_published(msgs, run))
    if out_path:
        publish_batches(out, out_path, ["timestamp", "cluster_id", "error_message"], batch_size)
    return out
