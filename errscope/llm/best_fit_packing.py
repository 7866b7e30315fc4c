"""Operator 3, best-fit decreasing packing of tokenised documents.

Documents become pieces of at most ``capacity`` tokens inside the tasks. Only
how many pieces have each length decides the packing, and there are at most
``capacity`` lengths, so the driver plans best-fit decreasing exactly over that
histogram: bins with equal remaining capacity are runs of consecutive numbers,
and a segment tree over remaining capacities gives the tightest open bins. The
plan maps ranges of pieces (ranked within their length) to ranges of bins; its
size depends on the capacity, not on the corpus. Ranks are numbered per length
and salt, so no task gets all pieces of a common length.

Cases: null or empty text is the end token alone; rows that repeat an id are
packed one by one; an empty table gives an empty result; other columns are not
passed on, so their names cannot clash.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import arrow_rows, map_batches, materialise, shuffle_partitions
from .token_cache import token_cache

CAPACITY = 2048
END_ID = 0


# ------------------------------------------------------------------ pieces
def pieces(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, capacity: int, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every document."""
    id_type = dict(docs.dtypes)[id_col]

    def run(batch: pa.RecordBatch):
        for first, tokens, bounds in token_cache(tokenizer_path).encode(batch.column(1)):
            tokens = np.insert(tokens, bounds[1:], end_id).astype("<u4")
            bounds = bounds + np.arange(len(bounds))
            size = np.diff(bounds)
            parts = -(-size // capacity)
            row = np.repeat(np.arange(len(size)), parts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = piece * capacity
            length = np.minimum(capacity, size[row] - start)
            at = bounds[row] + start
            raw = tokens.tobytes()
            crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
            columns = [batch.column(0).take(pa.array(first + row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(at, len(tokens)).astype(np.int32)), pa.array(tokens.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"id {id_type}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return map_batches(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, schema)


# ------------------------------------------------------------------ plan
class CapacityTree:
    """Segment tree over remaining capacities 0..capacity; a leaf is set while
    open bins have that capacity left."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.node = np.zeros(2 * self.size, dtype=bool)

    def set(self, remaining: int, present: bool) -> None:
        i = remaining + self.size
        self.node[i] = present
        while i > 1:
            i //= 2
            self.node[i] = self.node[2 * i] or self.node[2 * i + 1]

    def tightest(self, need: int) -> int | None:
        """The smallest remaining capacity of at least ``need`` that is present."""
        i = need + self.size
        if self.node[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.node[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.node[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


@dataclass
class Flow:
    """Pieces of ``length`` with ranks from ``rank`` go ``each`` to a bin, into
    ``bins`` consecutive bins from ``bin``, behind ``offset`` tokens."""

    length: int
    rank: int
    each: int
    bin: int
    bins: int
    offset: int


def plan(histogram: dict[int, int], capacity: int) -> list[Flow]:
    """Best-fit decreasing over a histogram of lengths, in whole runs of bins.

    A bin that can take several pieces of a length stays the tightest one that
    fits until it can take no more, so it is filled at once; runs of bins in
    the same state are treated together."""
    tree = CapacityTree(capacity)
    open_bins: dict[int, list[tuple[int, int]]] = defaultdict(list)  # remaining -> runs (first bin, bins)
    flows: list[Flow] = []
    next_bin = 0

    def leave(remaining: int, first: int, count: int) -> None:
        if count and remaining:
            open_bins[remaining].append((first, count))
            tree.set(remaining, True)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            remaining = tree.tightest(length)
            if remaining is None:
                each = capacity // length
                remaining, first, count = capacity, next_bin, -(-left // each)
                next_bin += count
            else:
                first, count = open_bins[remaining].pop()
                if not open_bins[remaining]:
                    tree.set(remaining, False)
                each = remaining // length
            offset = capacity - remaining
            full = min(count, left // each)
            if full:
                flows.append(Flow(length, rank, each, first, full, offset))
                leave(remaining - each * length, first, full)
                rank, left = rank + full * each, left - full * each
                first, count = first + full, count - full
            if left and count and left < each:
                flows.append(Flow(length, rank, left, first, 1, offset))
                leave(remaining - left * length, first, 1)
                rank, left, first, count = rank + left, 0, first + 1, count - 1
            leave(remaining, first, count)
    return flows


def _place(flows: list[Flow], capacity: int) -> Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """(length, rank) arrays -> (bin, offset) arrays."""
    flows = sorted(flows, key=lambda f: (f.length, f.rank))
    column = {k: np.array([getattr(f, k) for f in flows], dtype=np.int64) for k in ("length", "rank", "each", "bin", "offset")}
    first = np.searchsorted(column["length"], np.arange(capacity + 2))

    def place(length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bins, offsets = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for size in np.unique(length):
            at = np.flatnonzero(length == size)
            lo, hi = first[size], first[size + 1]
            k = lo + np.searchsorted(column["rank"][lo:hi], rank[at], side="right") - 1
            inside = rank[at] - column["rank"][k]
            bins[at] = column["bin"][k] + inside // column["each"][k]
            offsets[at] = column["offset"][k] + inside % column["each"][k] * size
        return bins, offsets

    return place


# ------------------------------------------------------------------ operator
def best_fit_packing(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Returns one row per piece: id, ``piece``, ``start``, ``length``,
    ``ids_crc32``, ``sequence_id``, ``offset`` (and ``ids`` on request)."""
    spark = docs.sparkSession
    salts = shuffle_partitions(spark)
    cut = pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id, with_ids)
    cut = materialise(cut.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts))), "pieces")
    counts = arrow_rows(cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")), capacity, "lengths")
    histogram = dict(zip(counts.column("length").to_pylist(), counts.column("n").to_pylist()))
    place = _place(plan(histogram, capacity), capacity)

    per_salt = cut.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    ahead = W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    before = per_salt.select("length", "salt", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    within = W.partitionBy("length", "salt").orderBy("id", "piece")
    ranked = cut.withColumn("rank", F.row_number().over(within) - 1).join(before, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("before"))

    rows = ["id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def run(batch: pa.RecordBatch):
        bins, offsets = place(batch.column(batch.schema.get_field_index("length")).to_numpy(), batch.column(len(rows)).to_numpy())
        yield pa.RecordBatch.from_arrays([*batch.columns[: len(rows)], pa.array(bins), pa.array(offsets)], names=[*rows, "sequence_id", "offset"])

    kinds = dict(cut.dtypes)
    out = map_batches(ranked.select(*rows, "rank"), run, ", ".join(f"{c} {kinds[c]}" for c in rows) + ", sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence from a result with ``ids``: one sequence
    holds at most the capacity, so its pieces may be gathered."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
