"""Global numbering without a single-partition window (W3, S8 renumbering)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root


def global_row_number(df: DataFrame, order_cols: Sequence[str], out: str = "row_number", partitions: int | None = None) -> DataFrame:
    """0-based position of each row in the total order ``order_cols``.

    Range-partition on the order (partition i holds keys before partition
    i+1), number rows inside each partition, then add the running size of the
    earlier partitions; that offset table has one row per partition.
    ``order_cols`` must make the order total (end with a unique key).
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order_cols).withColumn("_pid", F.spark_partition_id())
    local = ranged.withColumn("_rn", F.row_number().over(Window.partitionBy("_pid").orderBy(*order_cols)))
    # partition ids must be the same for the sizes and the rows: materialise once
    checkpoint_root(df.sparkSession)
    local = local.checkpoint(eager=True)
    sizes = local.groupBy("_pid").agg(F.count("*").alias("_n"))
    offsets = sizes.select(
        "_pid", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off")
    )
    return local.join(F.broadcast(offsets), "_pid").withColumn(out, F.col("_off") + F.col("_rn") - 1).drop("_pid", "_rn", "_off")


def batch_number(df: DataFrame, order_cols: Sequence[str], batch_size: int = 10000, out: str = "batch") -> DataFrame:
    """Consecutive batch index ``floor(position / batch_size)``."""
    numbered = global_row_number(df, order_cols, "_pos")
    return numbered.withColumn(out, F.floor(F.col("_pos") / F.lit(batch_size)).cast("long")).drop("_pos")
