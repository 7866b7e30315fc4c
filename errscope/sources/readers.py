"""Sources and sinks (S1-S10, S13): JSON with a fixed nested schema, dated
folders, globs, CSV/TSV and text lines. Writers put their output below the
session's checkpoint folder so later reads see a shared, durable copy."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordering import global_row_number
from ..session import scratch_path

# Explicit schema of a raw transfer record; unknown fields are dropped.
TRANSFER_SCHEMA = T.StructType(
    [
        T.StructField("metadata", T.StructType([T.StructField("timestamp", T.LongType(), True)])),
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField("t__error_message", T.StringType(), True),
                    T.StructField("src_hostname", T.StringType(), True),
                    T.StructField("dst_hostname", T.StringType(), True),
                ]
            ),
        ),
    ]
)


def read_transfer_json(spark: SparkSession, path, schema: T.StructType = TRANSFER_SCHEMA) -> DataFrame:
    """Newline JSON with an explicit schema (no inference pass)."""
    return spark.read.schema(schema).json(path)


def project_transfer_records(df: DataFrame, with_file: bool = False) -> DataFrame:
    """Nested fields -> flat aliased columns."""
    cols = [
        F.col("metadata.timestamp").alias("timestamp"),
        F.col("data.src_hostname").alias("src_hostname"),
        F.col("data.dst_hostname").alias("dst_hostname"),
        F.col("data.t__error_message").alias("error_message"),
    ]
    if with_file:
        cols.append(F.col("_metadata.file_path").alias("source_file"))
    return df.select(*cols)


def non_empty(df: DataFrame, col: str = "error_message") -> DataFrame:
    """``col <> ''`` (three-valued logic also drops NULL)."""
    return df.where(F.col(col) != "")


def day_folder(day: _dt.date) -> str:
    return day.strftime("%Y/%m/%d")


def yesterday_utc() -> str:
    """S2 default: yesterday's folder in UTC."""
    return day_folder(_dt.datetime.now(_dt.timezone.utc).date() - _dt.timedelta(days=1))


def day_range(first: str, last: str) -> list[str]:
    """Folders ``YYYY/MM/DD`` from ``first`` to ``last`` inclusive."""
    a = _dt.datetime.strptime(first, "%Y/%m/%d").date()
    b = _dt.datetime.strptime(last, "%Y/%m/%d").date()
    return [day_folder(a + _dt.timedelta(days=i)) for i in range((b - a).days + 1)]


def _missing(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Paths that match nothing (a metadata call on the file system, no data)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if not hp.getFileSystem(conf).globStatus(hp):
            out.append(p)
    return out


def read_transfer_days(spark: SparkSession, root: str, days: Sequence[str] | None = None, schema=TRANSFER_SCHEMA) -> DataFrame:
    """Read the given day folders (default: yesterday UTC); globs allowed.

    A day without a folder is an error, as a result without it looks complete."""
    days = list(days) if days else [yesterday_utc()]
    paths = [f"{root.rstrip('/')}/{d}" for d in days]
    missing = _missing(spark, paths)
    if missing:
        raise FileNotFoundError(f"no folder for {', '.join(missing)}")
    return spark.read.schema(schema).json(paths)


def select_by_sql(spark: SparkSession, df: DataFrame, sql: str) -> DataFrame:
    """SQL over a frame; ``{t}`` names it (a temp view bound to this query only)."""
    return spark.sql(sql, t=df)


def write_json_records(spark: SparkSession, df: DataFrame) -> str:
    path = scratch_path(spark, "records-json")
    df.write.mode("overwrite").json(path)
    return path


def write_daily_json(spark: SparkSession, df: DataFrame, ts_ms_col: str = "metadata.timestamp") -> str:
    """Records into ``root/YYYY/MM/DD`` folders by the UTC day of the event time."""
    root = scratch_path(spark, "records-daily")
    day = F.date_format(F.date_from_unix_date(F.floor(F.col(ts_ms_col) / 86_400_000).cast("int")), "yyyy/MM/dd")
    staged = df.withColumn("_day", day)
    tmp = scratch_path(spark, "records-staged")
    staged.write.mode("overwrite").partitionBy("_day").json(tmp)
    # partition folders are named _day=YYYY%2FMM%2FDD; rename to the dated layout
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(tmp)
    fs = base.getFileSystem(conf)
    for status in fs.listStatus(base):
        name = status.getPath().getName()
        if not name.startswith("_day="):
            continue
        folder = jvm.java.net.URLDecoder.decode(name[len("_day="):], "UTF-8")
        target = jvm.org.apache.hadoop.fs.Path(f"{root}/{folder}")
        fs.mkdirs(target.getParent())
        fs.rename(status.getPath(), target)
    return root


def write_csv(spark: SparkSession, df: DataFrame, sep: str = ",") -> str:
    """Header, no index column; comma, pipe or tab."""
    path = scratch_path(spark, "csv")
    df.write.mode("overwrite").option("header", True).option("sep", sep).option("escape", '"').csv(path)
    return path


def read_csv(spark: SparkSession, path, sep: str = ",", infer: bool = True, multi_line: bool = False) -> DataFrame:
    """Header + inferred types. ``multi_line`` lets quoted fields span
    lines, at the price of one task per file."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", infer)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )


def read_csv_renamed(spark: SparkSession, path, columns: Sequence[str], sep: str = ",", multi_line: bool = False) -> DataFrame:
    """The file header is replaced by the given ``name type`` list."""
    return (
        spark.read.schema(", ".join(columns))
        .option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )


def write_csv_per_day(spark: SparkSession, df: DataFrame, ts_us_col: str) -> str:
    """``*.txt`` CSV parts, a few for each day, in one folder (the shape S8 reads)."""
    folder = scratch_path(spark, "daily-csv")
    day = F.date_from_unix_date(F.floor(F.col(ts_us_col) / 86_400_000_000).cast("int"))
    (
        df.withColumn("_day", day)
        .repartition("_day", F.pmod(F.xxhash64(*df.columns), F.lit(8)))
        .drop("_day")
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .csv(folder)
    )
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(folder)
    fs = base.getFileSystem(conf)
    for status in fs.listStatus(base):
        p = status.getPath()
        if p.getName().endswith(".csv"):
            fs.rename(p, jvm.org.apache.hadoop.fs.Path(str(p.toString())[: -len(".csv")] + ".txt"))
    return folder


def read_csv_glob(spark: SparkSession, folder: str, glob: str = "*.txt", schema: str | None = None, multi_line: bool = False) -> DataFrame:
    """Every file of a folder matching a glob, as one frame."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line).option("pathGlobFilter", glob)
    if schema:
        reader = reader.schema(schema)
    return reader.csv(folder)


def renumber(df: DataFrame, order_cols: Sequence[str], out: str = "new_id") -> DataFrame:
    """New dense ids in a total order (distributed, no single-partition window)."""
    return global_row_number(df, order_cols, out)


def write_day_folders(spark: SparkSession, df: DataFrame, day_col: str) -> str:
    """One folder per day."""
    root = scratch_path(spark, "days")
    df.write.mode("overwrite").partitionBy(day_col).parquet(root)
    return root


def union_days(spark: SparkSession, root: str) -> DataFrame:
    """U1 over the folders of all days: one partitioned read, whose schema is
    that of all folders together; missing columns become NULL."""
    return spark.read.option("mergeSchema", True).parquet(root)


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def write_text_lines(spark: SparkSession, df: DataFrame) -> str:
    path = scratch_path(spark, "lines")
    df.write.mode("overwrite").text(path)
    return path


def read_text_lines(spark: SparkSession, path) -> DataFrame:
    """One message per line (no trailing newline)."""
    return spark.read.text(path)


def preview(df: DataFrame, n: int = 20, order_col: str = "msg_id") -> DataFrame:
    """First ``n`` rows in a stable order."""
    return df.orderBy(order_col).limit(n)
