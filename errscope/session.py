"""Session defaults and the shared scratch/checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job in the package relies on. They only touch planning
# behaviour (AQE, skew handling, broadcast sizing), never results.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a side is broadcast only when its estimated or measured size is below this
    "spark.sql.autoBroadcastJoinThreshold": "16MB",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply planning defaults that are not already set by the cluster."""
    conf = spark.conf
    for key, value in DEFAULTS.items():
        try:
            if conf.get(key, None) in (None, ""):
                conf.set(key, value)
        except Exception:  # some keys are static on a running session
            pass
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "errscope") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must exist (a machine-local folder would not
    survive the loss of an executor). Only a local session without the
    setting gets a private folder under the system temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None) or None
        if current is None:
            if not _is_local(spark):
                raise RuntimeError("spark.checkpoint.dir is not set; give the cluster a shared folder")
            current = tempfile.mkdtemp(prefix="errscope-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the checkpoint folder for written intermediate tables."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table below the checkpoint folder, for plans that read it more
    than once: its expressions are evaluated once, and a lost executor costs a re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
