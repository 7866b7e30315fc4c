"""Operator 5, convolutional text classifier for toxicity.

A word is the sum of two hashed embeddings (two tables, two independent hash
values, so that words rarely share both). Filters of several widths slide over
the words of the whole text, a rectifier and max pooling leave one value per
filter, and a logistic layer gives the logit. Training takes every labelled row
and its whole text. The words are written once as pairs of buckets; in each epoch
the partitions go on from one net, each over its own rows, and their nets are
averaged, weighted by rows. Nets and counts are added up block by block in Spark,
so the driver holds one net whatever the input. Thresholds are calibrated by
language on a quarter of the rows that training does not see, from counts of
logits to a thousandth; the language is guessed from function words of the text,
so a score depends on the text alone.

Cases: null or empty text has no words and gets the score of that; texts of any
length are scored whole; without rows of both classes every score is the share
of toxic labels (0 without labels); rows that repeat an id are scored one by
one; several labels of one id count as the largest; null labels are left out;
an empty table gives an empty result.
"""

from __future__ import annotations

import copy
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM, _slices, append_columns, arrow_rows, broadcast_if_few, hash_words, map_arrow, map_batches, materialise, signed, unsigned, words_of

BLOCK = 1 << 14  # numbers of a net that are added up in one row
LEAST_ROWS = 4000  # a partition that trains has about so many rows, or there is only one
MAX_WORDS = 1 << 19  # words that a step takes, unless a single text has more
CELLS = 1000  # calibration counts logits to the CELLS-th part

# Frequent function words that tell languages apart.
FUNCTION_WORDS: dict[str, list[str]] = {
    "en": "the of and to in is that it was for on with as at by this are from be".split(),
    "de": "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch".split(),
    "fr": "le la les des et en un une du que est pour qui dans par plus pas au sur avec".split(),
    "es": "el los las del y se por con una para su al lo como más pero sus este ya".split(),
}
_LANGUAGES = list(FUNCTION_WORDS)
_OTHER = len(_LANGUAGES)


@dataclass(frozen=True)
class Shape:
    buckets: int = 1 << 16
    width: int = 8
    filters: int = 8
    spans: tuple[int, ...] = (1, 2, 3)


class TextNet:
    """Hashed embeddings, convolutions, max pooling and a logistic layer."""

    def __init__(self, shape: Shape, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.shape = shape
        self.tables = [np.zeros((shape.buckets + 1, shape.width), np.float32) for _ in range(2)]  # the last row pads
        self.filters = [rng.normal(0, 0.3, (span, shape.width, shape.filters)).astype(np.float32) for span in shape.spans]
        for kernel in self.filters:
            kernel[:, 0, :] = np.abs(kernel[:, 0, :])
        self.bias = np.zeros((len(shape.spans), shape.filters), np.float32)
        self.out = np.full((len(shape.spans), shape.filters), 0.5, np.float32)
        self.offset = np.float32(-1.0)

    # -------------------------------------------------------------- layout
    def layout(self, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first bucket, second bucket, is a place to start, row starts) of
        rows laid out one after another with padding behind each."""
        pad = max(self.shape.spans) - 1
        count = np.diff(bounds)
        slots = np.maximum(count, 1) + pad
        start = np.concatenate([[0], np.cumsum(slots)])
        total = int(start[-1])
        place = np.arange(len(hashes)) + np.repeat(start[:-1] - bounds[:-1], count)
        mask = np.uint64(self.shape.buckets - 1)
        one = np.full(total, self.shape.buckets, np.int64)
        two = one.copy()
        one[place] = (hashes & mask).astype(np.int64)
        two[place] = ((hashes >> np.uint64(32)) & mask).astype(np.int64)
        valid = np.ones(total, bool)
        for k in range(1, pad + 1):
            valid[start[1:] - k] = False
        return one, two, valid, start[:-1]

    def embed(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.tables[0][one] + self.tables[1][two]

    def responses(self, x: np.ndarray, valid: np.ndarray) -> list[np.ndarray]:
        """Filter responses at every place, minus infinity where none starts."""
        out = []
        for kernel, bias in zip(self.filters, self.bias):
            z = x @ kernel[0]
            for k in range(1, len(kernel)):
                z[:-k] += x[k:] @ kernel[k]
            z += bias
            z[~valid] = -np.inf
            out.append(z)
        return out

    def logits(self, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        one, two, valid, starts = self.layout(hashes, bounds)
        pooled = [np.maximum(np.maximum.reduceat(z, starts, axis=0), 0) for z in self.responses(self.embed(one, two), valid)]
        return sum(p @ o for p, o in zip(pooled, self.out)) + self.offset

    # -------------------------------------------------------------- training
    def start_from(self, seen: np.ndarray, clean: float, toxic: float) -> None:
        """First embedding dimension: smoothed log odds of the words' rows;
        words that the rows lack stay at zero and so count for nothing.

        ``seen``: (table, label, bucket) the number of rows with the bucket."""
        rng = np.random.default_rng(5)
        for table, (no, yes) in zip(self.tables, seen):
            n = no + yes
            odds = np.log((yes + 0.5) / (max(1, toxic) + 1)) - np.log((no + 0.5) / (max(1, clean) + 1))
            table[:-1, 0] = 0.25 * odds * n / (n + 10)  # rare words say little
            table[:-1, 1:] = rng.normal(0, 0.01, (self.shape.buckets, self.shape.width - 1)) * (n > 0)[:, None]

    def numbers(self) -> np.ndarray:
        """All that training changes, one after another."""
        return np.concatenate([x.ravel() for x in (*self.tables, *self.filters, self.bias, self.out, np.array([self.offset]))]).astype(np.float64)

    def take(self, numbers: np.ndarray) -> None:
        at = 0
        for x in (*self.tables, *self.filters, self.bias, self.out):
            x[...] = numbers[at : at + x.size].reshape(x.shape)
            at += x.size
        self.offset = np.float32(numbers[at])

    def step(self, rows: list[np.ndarray], labels: np.ndarray, rate: float) -> None:
        hashes = np.concatenate(rows)
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        one, two, valid, starts = self.layout(hashes, bounds)
        x = self.embed(one, two)
        n = len(rows)
        row_of = np.repeat(np.arange(n), np.diff(np.append(starts, len(one))))
        best, where = [], []
        for z in self.responses(x, valid):
            top = np.maximum.reduceat(z, starts, axis=0)
            f, at = np.nonzero((z == top[row_of]).T)
            first = np.unique(f * n + row_of[at], return_index=True)[1]
            where.append(at[first].reshape(self.shape.filters, n).T)
            best.append(np.maximum(top, 0))
        logit = sum(b @ o for b, o in zip(best, self.out)) + self.offset
        error = (1 / (1 + np.exp(-logit)) - labels).astype(np.float32) / n
        for s, (kernel, b, at) in enumerate(zip(self.filters, best, where)):
            grad = error[:, None] * self.out[s] * (b > 0)
            self.out[s] -= rate * (error @ b + 1e-4 * self.out[s])
            self.bias[s] -= rate * grad.sum(0)
            for k in range(len(kernel)):
                word = at + k
                back = grad[..., None] * kernel[k].T  # rows, filters, width
                kernel[k] -= rate * (np.einsum("rfw,rf->wf", x[word], grad) + 1e-4 * kernel[k])
                for table, bucket in zip(self.tables, (one, two)):
                    where_to = bucket[word]
                    inside = where_to < self.shape.buckets
                    np.add.at(table, where_to[inside], -rate * 8 * back[inside])
        self.offset -= np.float32(rate * error.sum())

    def fit(self, rows: list[np.ndarray], labels: np.ndarray, rate: float, rng: np.random.Generator, batch: int = 64) -> None:
        """One epoch over some rows, in steps of ``batch`` rows or fewer long ones."""
        order = rng.permutation(len(rows))
        at = 0
        while at < len(order):
            some = order[at : at + batch]
            words = np.cumsum([len(rows[i]) for i in some])
            some = some[: max(1, int(np.searchsorted(words, MAX_WORDS, side="right")))]
            self.step([rows[i] for i in some], labels[some], rate)
            at += len(some)


def language_of(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per row the language with most function words, or the last number for none."""
    known = np.concatenate([hash_words(w) for w in FUNCTION_WORDS.values()])
    owner = np.repeat(np.arange(_OTHER), [len(w) for w in FUNCTION_WORDS.values()])
    order = np.argsort(known)
    known, owner = known[order], owner[order]
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    hit = known[at] == hashes
    rows = len(bounds) - 1
    row = np.repeat(np.arange(rows), np.diff(bounds))[hit]
    counts = np.bincount(row * _OTHER + owner[at[hit]], minlength=rows * _OTHER).reshape(rows, _OTHER)
    return np.where(counts.any(axis=1), counts.argmax(axis=1), _OTHER)


def best_threshold(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The middle of the widest best gap: highest F1 over thresholds between
    neighbouring logits; equal logits are not parted."""
    order = np.argsort(logits)
    z, y, w = logits[order], labels[order], weights[order]
    hits = np.concatenate([np.cumsum((y * w)[::-1])[::-1], [0]])
    flagged = np.concatenate([np.cumsum(w[::-1])[::-1], [0]])
    f1 = 2 * hits / (flagged + (y * w).sum())
    cut = np.concatenate([[z[0] - 1], (z[1:] + z[:-1]) / 2, [z[-1] + 1]])
    gap = np.concatenate([[0], z[1:] - z[:-1], [0]])
    f1[1:-1][z[1:] == z[:-1]] = -1
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    return float(cut[best[np.argmax(gap[best])]])


@dataclass
class ToxicityModel:
    net: TextNet | None
    thresholds: np.ndarray
    prior: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        if self.net is None:
            return out
        for w in words_of(texts, ALNUM):
            logit = self.net.logits(w.hash, w.bounds) - self.thresholds[language_of(w.hash, w.bounds)]
            # rounded, as sums of a batch differ in their last bits with the batch
            out[w.first_row : w.first_row + w.rows] = np.round(1 / (1 + np.exp(-np.clip(logit, -30, 30))), 6)
        return out


def labelled_words(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, shape: Shape) -> DataFrame:
    """(label, back, language, words) of every labelled row, written: ``back`` marks
    the quarter for calibration, a word is the bits of its hash that the net reads.
    Several labels of one id count as the largest."""
    one_each = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("label")).where("label IN (0, 1)")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    rows = texts.join(broadcast_if_few(one_each, "toxic-labels"), "_id")
    rows = rows.select("label", (F.pmod(F.xxhash64("_id"), F.lit(4)) == 3).alias("back"), "text")
    kind, word = (pa.int32(), "int") if shape.buckets <= 1 << 16 else (pa.int64(), "long")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for w in words_of(batch.column(2), ALNUM):
            words = pa.ListArray.from_arrays(pa.array(w.bounds, pa.int32()), pa.array(_packed(w.hash, shape), kind))
            own = batch.slice(w.first_row, w.rows)
            language = pa.array(language_of(w.hash, w.bounds), pa.int32())
            yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), language, words], names=["label", "back", "language", "words"])

    return materialise(map_batches(rows, run, f"label int, back boolean, language int, words array<{word}>"), "toxic-words")


def _packed(hashes: np.ndarray, shape: Shape) -> np.ndarray:
    if shape.buckets > 1 << 16:
        return signed(hashes)
    low, high = (((hashes >> np.uint64(s)) & np.uint64(0xFFFF)).astype(np.uint32) for s in (0, 32))
    return (low | (high << np.uint32(16))).view(np.int32)


def _unpacked(words: np.ndarray) -> np.ndarray:
    if words.dtype == np.int64:
        return unsigned(words)
    both = np.ascontiguousarray(words).view(np.uint32).astype(np.uint64)
    return (both & np.uint64(0xFFFF)) | ((both >> np.uint64(16)) << np.uint64(32))


def _hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds) of a batch of ``labelled_words``."""
    words = batch.column(batch.schema.get_field_index("words"))
    bounds = words.offsets.to_numpy().astype(np.int64)
    return _unpacked(words.values.to_numpy()[bounds[0] : bounds[-1]]), bounds - bounds[0]


def _rows(batch: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray]:
    hashes, bounds = _hashes(batch)
    labels = batch.column(batch.schema.get_field_index("label")).to_numpy(zero_copy_only=False)
    return [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:])], labels.astype(np.float64)


def _added(rows: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """The sum of the ``size`` numbers that ``work`` makes of each partition; they
    are added up block by block in Spark."""
    schema = "block int, numbers array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = work(batch for batch in batches if batch.num_rows)
        for k in range(0, size, BLOCK):
            yield pa.RecordBatch.from_pydict({"block": pa.array([k // BLOCK], pa.int32()), "numbers": pa.array([found[k : k + BLOCK]], pa.list_(pa.float64()))})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total = None, 0.0
        for batch in batches:
            block = batch.column(0)[0].as_py()
            numbers = batch.column(1)
            total = total + numbers.flatten().to_numpy().reshape(len(numbers), -1).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "numbers": pa.array([total], pa.list_(pa.float64()))})

    blocks = map_arrow(rows, run, schema).groupBy("block").applyInArrow(add, schema)
    got = arrow_rows(blocks, -(-size // BLOCK), "sums of partitions")
    out = np.zeros(size)
    for k, numbers in zip(got.column("block").to_pylist(), got.column("numbers")):
        out[k * BLOCK : (k + 1) * BLOCK] = numbers.values.to_numpy()
    return out


def _buckets_seen(rows: DataFrame, shape: Shape) -> np.ndarray:
    """(table, label, bucket): the number of rows that have the bucket."""
    mask = np.uint64(shape.buckets - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        seen = np.zeros((2, 2, shape.buckets))
        for batch in batches:
            rows, labels = _rows(batch)
            once = [np.unique(h) for h in rows]
            label = np.repeat(labels.astype(np.int64), [len(h) for h in once]) * shape.buckets
            h = np.concatenate(once)
            for table, bucket in zip(seen, (h & mask, (h >> np.uint64(32)) & mask)):
                table += np.bincount(label + bucket.astype(np.int64), minlength=2 * shape.buckets).reshape(2, -1)
        return seen.ravel()

    return _added(rows, count, 4 * shape.buckets).reshape(2, 2, shape.buckets)


def _epoch(rows: DataFrame, net: TextNet, epoch: int, rate: float) -> None:
    """``net`` becomes the average of what the partitions make of it."""
    size = len(net.numbers())
    shared = rows.sparkSession.sparkContext.broadcast(net)

    def train(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        own, n = copy.deepcopy(shared.value), 0
        rng = np.random.default_rng([3, epoch])
        for batch in batches:
            own.fit(*_rows(batch), rate / (1 + epoch), rng)
            n += batch.num_rows
        return np.append(own.numbers() * n, n)

    total = _added(rows, train, size + 1)
    net.take(total[:-1] / total[-1])
    shared.unpersist()


def _calibration(rows: DataFrame, net: TextNet) -> pa.Table:
    """(language, cell, label, n): how many rows have a logit to the CELLS-th part."""
    shared = rows.sparkSession.sparkContext.broadcast(net)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hashes, bounds = _hashes(batch)
        runs = _slices(bounds, MAX_WORDS)
        logits = np.concatenate([shared.value.logits(hashes[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]) for a, b in runs])
        cell = pa.array(np.round(np.clip(logits, -30, 30) * CELLS).astype(np.int32))
        yield pa.RecordBatch.from_arrays([batch.column("language"), cell, batch.column("label")], names=["language", "cell", "label"])

    cells = map_batches(rows, run, "language int, cell int, label int").groupBy("language", "cell", "label").agg(F.count(F.lit(1)).alias("n"))
    return arrow_rows(cells, (60 * CELLS + 1) * 2 * (_OTHER + 1), "cells of logits")


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    epochs: int = 5,
    min_calibration: int = 40,
    shape: Shape = Shape(),
    rate: float = 0.5,
) -> ToxicityModel:
    """Train on all labelled rows of ``docs``."""
    spark = docs.sparkSession
    words = labelled_words(docs, labels, id_col, text_col, label_col, shape)
    counts = arrow_rows(words.groupBy("label", "back").agg(F.count(F.lit(1)).alias("n")), 4, "labels").to_pylist()
    number = {(r["label"], r["back"]): r["n"] for r in counts}
    of_label = [sum(n for (label, _), n in number.items() if label == k) for k in (0, 1)]
    prior = of_label[1] / sum(of_label) if sum(of_label) else 0.0
    thresholds = np.zeros(_OTHER + 1)
    if not all(of_label):
        return ToxicityModel(None, thresholds, prior)
    kept_back = all(number.get((k, True)) for k in (0, 1))
    some, check = (words.where("NOT back"), words.where("back")) if kept_back else (words, words)
    clean, toxic = (number.get((k, False), 0) if kept_back else of_label[k] for k in (0, 1))
    net = TextNet(shape)
    net.start_from(_buckets_seen(some, shape), clean, toxic)
    parts = max(1, min((clean + toxic) // LEAST_ROWS, 2 * spark.sparkContext.defaultParallelism))
    for epoch in range(epochs):
        _epoch(some.coalesce(parts), net, epoch, rate)
    cells = _calibration(check, net)
    language, cell, truth, weights = (cells.column(c).to_numpy() for c in ("language", "cell", "label", "n"))
    logits, weights = cell / CELLS, weights.astype(np.float64)
    thresholds[:] = best_threshold(logits, truth, weights)
    for g in range(_OTHER + 1):
        own = language == g
        if weights[own].sum() >= min_calibration and 0 < (truth * weights)[own].sum() < weights[own].sum():
            thresholds[g] = best_threshold(logits[own], truth[own], weights[own])
    return ToxicityModel(net, thresholds, prior)


def toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> list:
        return [pa.array(shared.value.scores(texts))]

    scored = append_columns(docs, text_col, run, [T.StructField("score", T.DoubleType())], keep)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


