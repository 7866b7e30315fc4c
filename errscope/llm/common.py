"""Shared helpers: tables, written intermediates, Arrow batches and word hashing."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


# ------------------------------------------------------------------ Spark side
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table under ``sf_dir``, read by Spark so any file system works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with files that every executor can reach, so a lost
    executor costs a re-read and not a recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_few(df: DataFrame, name: str, rows: int = 500_000) -> DataFrame:
    """A narrow table, written and counted; marked for broadcast if it has at
    most ``rows`` rows, else left to an ordinary join."""
    written = materialise(df, name)
    return F.broadcast(written) if written.count() <= rows else written


def arrow_rows(df: DataFrame, limit: int, what: str) -> pa.Table:
    """Bring a table of proven size to the driver; more than ``limit`` rows is an error."""
    out = df.limit(limit + 1).toArrow()
    if out.num_rows > limit:
        raise RuntimeError(f"{what}: more than {limit} rows")
    return out


def ascii_lower(col: Column | str) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(col, UPPER, LOWER)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def in_fold(id_col: Column, remainder: int, folds: int = 5) -> Column:
    """crc32 of the id as text modulo ``folds`` equals ``remainder`` (null ids count as empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds == remainder


def label_sample(labels: DataFrame, id_col: str, label_col: str, sizes: dict) -> DataFrame:
    """(_id, _label) of a bounded sample: per label value the ids with the
    smallest hashes. Several labels of one id count as the largest."""
    one_each = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_label"))
    picked = None
    for value, size in sizes.items():
        some = one_each.where(F.col("_label") == value).orderBy(F.xxhash64("_id"), "_id").limit(size)
        picked = some if picked is None else picked.unionByName(some)
    return picked


BATCH_ROWS = 1000  # rows that an Arrow batch of texts may hold


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with batches of few rows, as rows may be long texts."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """``map_arrow`` over single record batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return map_arrow(df, run, schema)


def append_columns(df: DataFrame, text_col: str, fn: Callable[[pa.Array], list], fields: list[T.StructField], keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with columns computed from one text
    column, batch by batch. Columns that have the name of a new one give way."""
    names = [f.name for f in fields]
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    sent = kept if text_col in kept else [*kept, text_col]
    source = df.select(*[F.col(f"`{c}`") for c in sent])
    at, n = sent.index(text_col), len(kept)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([*batch.columns[:n], *fn(batch.column(at))], names=[*kept, *names])

    return map_batches(source, run, T.StructType([*(source.schema[c] for c in kept), *fields]))


# ------------------------------------------------------------------ inside tasks
def _class_table(is_word: Callable[[int], bool]) -> np.ndarray:
    return np.array([is_word(b) for b in range(256)], dtype=bool)


#: Bytes that belong to a word: 0-9, letters and everything outside ASCII.
ALNUM = _class_table(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
#: Bytes that belong to a word: everything but ASCII white space.
NON_SPACE = _class_table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))

_FOLD = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint64) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power_table(base: int, key: str, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64, kept per worker and grown when needed."""
    have = _powers.get(key)
    if have is None or len(have) <= n:
        steps = np.full(n + 1, base, dtype=np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        _powers[key] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (xor-shift and multiply)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def hash_words(words: list[str]) -> np.ndarray:
    """The hashes that ``words_of`` gives to these words."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    data = " ".join(words).encode()
    return words_in(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]), NON_SPACE)[0].hash


@dataclass
class Words:
    """Words of consecutive rows of a batch."""

    first_row: int  # row of the batch that has index 0 in ``bounds``
    bounds: np.ndarray  # word positions where rows start; one more entry than rows
    hash: np.ndarray  # uint64 hash of every word, A-Z folded to a-z

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.bounds))


def words_in(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, breaks: np.ndarray | None = None) -> tuple[Words, np.ndarray, np.ndarray]:
    """(words, first bytes, bytes behind the last) of a slice. Words end where
    rows end and at ``breaks``."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return Words(0, np.zeros(len(offsets), dtype=np.int64), np.zeros(0, dtype=np.uint64)), none, none
    inside = is_word[data]
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    if breaks is not None:
        cuts = np.concatenate([cuts, breaks])
    before[cuts] = False
    after[cuts - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_FOLD[data] * _power_table(_BASE, "up", n)[:n], out=total[1:])
    h = (total[end] - total[start]) * _power_table(_INVERSE, "down", n)[start]
    return Words(0, np.searchsorted(start, offsets), mix(h)), start, end


def _slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``limit`` bytes; a longer row stands alone."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        stop = min(max(stop, row + 1), rows)
        yield row, stop
        row = stop


def text_slices(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows of a string column; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, dtype=np.uint8)
    for row, stop in _slices(offsets, limit):
        lo = offsets[row]
        yield row, data[lo : offsets[stop]], offsets[row : stop + 1] - lo


def words_of(column: pa.Array, is_word: np.ndarray, limit: int = 1 << 20) -> Iterator[Words]:
    """Hashed words of a string column, a bounded number of bytes at a time."""
    for row, data, offsets in text_slices(column, limit):
        got = words_in(data, offsets, is_word)[0]
        got.first_row = row
        yield got


def signed(h: np.ndarray) -> np.ndarray:
    """uint64 hashes as the signed longs Spark stores."""
    return h.astype(np.uint64).view(np.int64)


def unsigned(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h, dtype=np.int64).view(np.uint64)
