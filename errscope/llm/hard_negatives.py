"""Operator 11, hard negatives by a matrix product in a residue number system.

Components become integers, ``floor(scale * x)``. The scores of a block of
anchors against a block of rows are integer inner products, found with float32
matrix products: both matrices are taken modulo several small primes, products
of residues over a run of columns stay below 2**24 and are therefore exact in
float32, and the residues of the scores are joined by Chinese remaindering in
symmetric mixed radix, which gives the signed score. There are as many primes
as the longest vector asks for: no score exceeds its squared length.

Rows are packed into blocks of bounded size. A slab is a set of row blocks; every
anchor block meets every slab in one place, where the best of all its rows are
kept, so what leaves a task are a few rows for each anchor and slab. There are
two passes: the first finds the positives of each anchor, the second, knowing
their scores, selects the negatives in the window below each of them.

Cases: rows whose label, vector or id is null, or whose vector holds null or
non-finite components, take no part; shorter vectors count as if filled up with
zeros; rows that repeat an id are anchors and candidates one by one, but no row
meets one of its own id; ties go to the smaller id; an empty table gives an
empty result; other columns are not passed on. Vectors of a squared length of
2**60 or more, whose scores could leave 64 bits, raise an ArithmeticError.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import map_arrow, materialise, shuffle_partitions

RUN = 256  # columns whose products of residues are added in float32
_TOP = 255  # residues lie within +-127, and 256 * 127**2 < 2**24
SLAB_BLOCKS = 16
HELD = 50_000  # anchors and windows whose best rows a task keeps before it passes them on


# ------------------------------------------------------------------ residues
def primes_for(bound: int) -> list[int]:
    """Odd primes, largest first, whose product exceeds ``2 * bound``."""
    out, product, p = [], 1, _TOP
    while product <= 2 * bound:
        p -= 2
        while any(p % q == 0 for q in range(3, int(p**0.5) + 1, 2)):
            p -= 2
        out.append(p)
        product *= p
    return out


def _centred(x: np.ndarray, p: int) -> np.ndarray:
    """``x`` modulo ``p`` as whole numbers from -(p-1)/2 to (p-1)/2."""
    half = p // 2
    return np.mod(x + half, p) - half


def residue_product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """``a @ b.T`` modulo ``p``, in float32 over runs of columns."""
    a, b = _centred(a, p).astype(np.float32), _centred(b, p).astype(np.float32)
    total = np.zeros((len(a), len(b)), np.float32)
    for at in range(0, a.shape[1], RUN):
        total = _centred(total + _centred(a[:, at : at + RUN] @ b[:, at : at + RUN].T, p), p)
    return total


def remainder(residues: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The signed whole numbers that have these residues (Chinese remaindering).

    Digits in symmetric mixed radix: the sum of digit times the product of the
    primes before it is within half the product of all, so signs come out."""
    digits: list[np.ndarray] = []
    out, weight = np.zeros(residues[0].shape, np.int64), 1
    for r, p in zip(residues, primes):
        known, radix = np.zeros(r.shape, np.int32), 1
        for digit, q in zip(digits, primes):
            known = _centred(known + digit * np.int32(radix), p)
            radix = radix * q % p
        digit = _centred((r.astype(np.int32) - known) * np.int32(pow(weight, -1, p)), p)
        digits.append(digit)
        out += digit * np.int64(weight)
        weight *= p
    return out


def exact_scores(a: np.ndarray, b: np.ndarray, primes: list[int]) -> np.ndarray:
    """``a @ b.T`` of whole numbers, as 64-bit numbers."""
    return remainder([residue_product(a, b, p) for p in primes], primes)


# ------------------------------------------------------------------ blocks
def usable_rows(rows: DataFrame, id_col: str, vec_col: str, label_col: str, anchor: Column, relabel: Column, scale: int) -> DataFrame:
    """(id, label, anchor, vec) of the rows that take part; vec holds whole doubles."""
    vec = F.col(vec_col).cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    label = F.col(label_col).cast("long")
    return rows.where(F.col(id_col).isNotNull() & label.isNotNull() & vec.isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("id"), relabel.cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), F.transform(vec, lambda x: _whole(x, scale)).alias("vec")
    )


def _whole(x: Column, scale: int) -> Column:
    """floor(scale * x) as a double; numbers from 2**52 on are whole already."""
    y = x * float(scale)
    return F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)


def blocks_of(rows: DataFrame, width: int, size: int, count: int, name: str) -> DataFrame:
    """(block, ids, labels, cells) with up to ``size`` rows each, written."""
    from pyspark import TaskContext

    def pack(ids: list, labels: list, cells: list, block: int) -> pa.RecordBatch:
        parts = (np.concatenate(ids), np.concatenate(labels), np.concatenate(cells).ravel())
        return pa.RecordBatch.from_arrays([pa.array([block]), *(pa.array([x.tobytes()], pa.binary()) for x in parts)], names=["block", "ids", "labels", "cells"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids, labels, cells, held = [], [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                if held and held + part.num_rows > size:
                    yield pack(ids, labels, cells, block)
                    block, ids, labels, cells, held = block + 1, [], [], [], 0
                vec = part.column(2)
                n = np.diff(vec.offsets.to_numpy())
                matrix = np.zeros((part.num_rows, width), np.int32)
                place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                matrix[np.repeat(np.arange(len(n)), n), place] = vec.flatten().to_numpy(zero_copy_only=False)
                ids.append(part.column(0).to_numpy())
                labels.append(part.column(1).to_numpy())
                cells.append(matrix)
                held += part.num_rows
        if held:
            yield pack(ids, labels, cells, block)

    dealt = rows.select("id", "label", "vec").repartition(max(1, -(-10 * count // (9 * size))))
    return materialise(map_arrow(dealt, run, "block long, ids binary, labels binary, cells binary"), name)


def _open(ids: bytes, labels: bytes, cells: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    one = np.frombuffer(ids, np.int64)
    return one, np.frombuffer(labels, np.int64), np.frombuffer(cells, np.int32).reshape(len(one), width)


def _first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(score) > 4 * k:
        some = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
        return some[np.lexsort((ids[some], -score[some]))[:k]]
    return np.lexsort((ids, -score))[:k]


class _Best:
    """The k best (score, id) of each slot that a task has seen."""

    def __init__(self, k: int):
        self.k, self.of = k, {}

    def add(self, slot: tuple[int, int], score: np.ndarray, ids: np.ndarray) -> None:
        if slot in self.of:
            score, ids = (np.concatenate(x) for x in zip(self.of[slot], (score, ids)))
        keep = _first(score, ids, self.k)
        if len(keep):
            self.of[slot] = score[keep], ids[keep]

    def batches(self) -> Iterator[pa.RecordBatch]:
        if self.of:
            n = [len(s) for s, _ in self.of.values()]
            row, place = (np.repeat(np.array(x, np.int64), n) for x in zip(*self.of))
            score, ids = (np.concatenate(x) for x in zip(*self.of.values()))
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(place.astype(np.int32)), pa.array(ids), pa.array(score)], names=["anchor", "place", "id", "score"])
        self.of = {}


def _pass(met: DataFrame, primes: list[int], width: int, k: int, windows: bool) -> DataFrame:
    """(anchor, place, id, score): the best rows of each slab for each anchor row
    (same label, place 0) or for each of its windows (other labels)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(k)
        for batch in batches:
            for at in range(batch.num_rows):
                r = {c: batch.column(c)[at].as_py() for c in batch.schema.names}
                first = r["block"]
                if len(best.of) > HELD:
                    yield from best.batches()
                a_id, a_label, a = _open(r["a_ids"], r["a_labels"], r["a_cells"], width)
                ids, label, b = _open(r["ids"], r["labels"], r["cells"], width)
                score = exact_scores(a, b, primes)
                if not windows:
                    for i in range(len(a_id)):
                        same = np.flatnonzero((label == a_label[i]) & (ids != a_id[i]))
                        best.add((first + i, 0), score[i, same], ids[same])
                    continue
                for w in r["windows"]:
                    i = w["row"]
                    some = np.flatnonzero((score[i] <= w["high"]) & (score[i] >= w["low"]) & (label != a_label[i]) & (ids != a_id[i]))
                    best.add((first + i, w["place"]), score[i, some], ids[some])
        yield from best.batches()

    return map_arrow(met, run, "anchor long, place int, id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    relabel: Column | None = None,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 5,
    low_percent: int = 80,
    high_percent: int = 100,
    scale: int = 256,
    block_rows: int = 4096,
    anchor_rows: int = 256,
) -> DataFrame:
    """(``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score``, ``negative_score``): for every row where ``anchor`` holds
    and each of its best rows of the same label, the best rows of other labels
    whose score is between these percents of the positive's.

    ``relabel`` gives the label to go by, where it isn't that of the table."""
    spark = rows.sparkSession
    usable = materialise(usable_rows(rows, id_col, vec_col, label_col, anchor, F.col(label_col) if relabel is None else relabel, scale), "usable-vectors")
    squared = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    n, anchors, width, longest = usable.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("anchor").cast("long")).alias("a"), F.max(F.size("vec")).alias("w"), F.max(squared).alias("s")).toArrow().to_pylist()[0].values()
    if longest is not None and not longest < 2.0**60:
        raise ArithmeticError("scores of these vectors do not fit 64 bits")
    primes, width = primes_for(int((longest or 0) * 1.001) + 1), max(width or 0, 1)

    row_blocks = blocks_of(usable, width, block_rows, n, "row-blocks")
    own = blocks_of(usable.where("anchor"), width, anchor_rows, anchors or 0, "anchor-blocks")
    counts = row_blocks.agg(F.count(F.lit(1))).toArrow().column(0)[0].as_py(), own.agg(F.count(F.lit(1))).toArrow().column(0)[0].as_py()
    slabs = max(1, min(counts[0], max(-(-counts[0] // SLAB_BLOCKS), -(-2 * shuffle_partitions(spark) // max(counts[1], 1)))))
    own = own.select(F.col("block"), F.col("ids").alias("a_ids"), F.col("labels").alias("a_labels"), F.col("cells").alias("a_cells"))
    own = own.withColumn("block", F.col("block") * anchor_rows)  # rows of a block have the numbers from here on
    numbers = own.select("block")
    every_slab = F.explode(F.sequence(F.lit(0), F.lit(slabs - 1)))
    row_side = row_blocks.withColumn("slab", F.pmod(F.xxhash64("block"), F.lit(slabs)).cast("int")).drop("block")
    row_side = row_side.join(numbers.withColumn("slab", every_slab), "slab")

    def met(anchor_side: DataFrame) -> DataFrame:
        return anchor_side.withColumn("slab", every_slab).join(row_side, ["block", "slab"])

    found = _ranked(_pass(met(own), primes, width, positives, False), positives)
    best = materialise(found.select("anchor", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # low <= score <= high as whole numbers, without leaving 64 bits: p * percent / 100 = (p // 100) * percent + (p % 100) * percent / 100
    p, rest = F.expr("(positive_score - pmod(positive_score, 100)) div 100"), F.pmod(F.col("positive_score"), F.lit(100))
    low = p * low_percent + F.ceil(rest * low_percent / 100)
    high = p * high_percent + F.floor(rest * high_percent / 100)
    block = (F.col("anchor") - F.pmod("anchor", F.lit(anchor_rows))).alias("block")
    window = F.struct(F.pmod("anchor", F.lit(anchor_rows)).cast("int").alias("row"), F.col("place"), low.alias("low"), high.alias("high"))
    windows = best.groupBy(block).agg(F.collect_list(window).alias("windows"))  # at most positives * anchor_rows
    chosen = _ranked(_pass(met(own.join(windows, "block")), primes, width, negatives, True), negatives)

    names = anchor_names(own)
    out = chosen.select("anchor", "place", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = out.join(best, ["anchor", "place"]).join(names, "anchor")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def anchor_names(own: DataFrame) -> DataFrame:
    """(anchor, anchor_id): the ids of the rows of anchor blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                one = np.frombuffer(ids, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(block + np.arange(len(one))), pa.array(one)], names=["anchor", "anchor_id"])

    return map_arrow(own.select("block", "a_ids"), run, "anchor long, anchor_id long")
