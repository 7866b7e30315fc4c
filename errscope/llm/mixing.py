"""Operator 6, mixing sources to target weights by soft membership.

A softmax regression, trained in numpy on a bounded sample of rows of a labelled
table, predicts for every document how likely it belongs to each domain. The
rates r of the documents then solve

    minimise  1/2 sum_d (sum_i r_i n_i p_id - t_d)^2 / t_d  +  ridge/2 sum_i n_i (r_i - r0)^2
    subject to r_i >= least_rate (0 or more)

(n: tokens, p: posteriors, t: target tokens, r0: the rate without domains) by
projected gradients. The gradient reaches a document through its posteriors and
one number per domain only, so a step is one aggregation of a narrow table: it
brings the domain totals at the present rates and the Gram matrix of the domains
over the rows whose rates are not held at the least one. The gradient is scaled by
that small matrix, which makes up for domains that are hard to tell apart, and
rates that the step takes below ``least_rate`` are put back on it:

    r_i = max(least_rate, r0 - sum_d p_id v_d / ridge)

where v adds up the scaled gradients. The first steps are scaled by the Gram
matrix of all rows, with which no step is too long; then that of the free rows
takes over as long as the gradient along a step goes on shrinking, and a step
that fails is taken again with more of the first. The steps end when the projected
gradient is small. Targets that the rates cannot reach, or did not in ``max_steps``,
are told by a warning and in ``Mixture.missed``.

Cases: null or empty text has no tokens but gets a posterior and a rate; targets
of domains that no label has are left out and the others scaled up; without
labels all documents are one domain and share one rate; rows that repeat an id
are mixed one by one, and get the same number of copies; rows with a null id are
treated like others; an empty table gives an empty result; other columns may have
any name but those of the result.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM, NON_SPACE, append_columns, arrow_rows, label_sample, map_batches, materialise, text_slices, words_in

BUCKETS = 512
_UPPER = np.array([0x41 <= b <= 0x5A for b in range(256)])
_DIGIT = np.array([0x30 <= b <= 0x39 for b in range(256)])
_BREAK = np.array([b == 0x0A for b in range(256)])
_SHAPES = (_UPPER, _DIGIT, _BREAK, ~NON_SPACE, ~ALNUM & NON_SPACE)
FEATURES = BUCKETS + len(_SHAPES) + 4


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(words of each row, matrix of features): hashed words and the shape of the text."""
    words, out = [], []
    for _, data, offsets in text_slices(texts):
        w, _, _ = words_in(data, offsets, ALNUM)
        rows, n = w.rows, np.diff(w.bounds)
        size = np.maximum(np.diff(offsets), 1)
        row = w.row_of_word()
        bucket = (w.hash % np.uint64(BUCKETS)).astype(np.int64)
        counts = np.bincount(row * BUCKETS + bucket, minlength=rows * BUCKETS).reshape(rows, BUCKETS)
        bag = np.log1p(counts)
        bag /= np.maximum(np.sqrt((bag**2).sum(1, keepdims=True)), 1e-9)
        shape = []
        for member in _SHAPES:
            total = np.concatenate([[0], np.cumsum(member[data], dtype=np.int64)])
            shape.append((total[offsets[1:]] - total[offsets[:-1]]) / size)
        again = np.zeros(len(w.hash), bool)
        again[1:] = (w.hash[1:] == w.hash[:-1]) & (row[1:] == row[:-1])
        many = np.maximum(n, 1)
        shape.append(np.bincount(row[again], minlength=rows) / many)
        shape.append((counts > 0).sum(1) / np.minimum(many, BUCKETS))
        shape.append(size / many / 20)
        shape.append(np.log1p(n) / 10)
        words.append(n)
        out.append(np.hstack([bag, np.array(shape).T]))
    if not out:
        return np.zeros(0, np.int64), np.zeros((0, FEATURES))
    return np.concatenate(words), np.concatenate(out)


@dataclass
class DomainModel:
    """Softmax regression over ``features``."""

    domains: list
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        z = np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))]) @ self.weight
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def train_domains(docs: DataFrame, labels: DataFrame, domains: list, id_col: str, text_col: str, label_col: str, max_rows: int = 2000, steps: int = 300, ridge: float = 1e-3) -> DomainModel | None:
    """Fit on at most ``max_rows`` labelled rows per domain, each domain weighted
    by its share of the labels. None without labels."""
    shares = labels.where(F.col(label_col).isin(domains)).groupBy(label_col).agg(F.countDistinct(id_col).alias("n"))
    share = {r[label_col]: r["n"] for r in arrow_rows(shares, len(domains), "domains").to_pylist()}
    found = [d for d in domains if share.get(d)]
    if not found:
        return None
    picked = label_sample(labels, id_col, label_col, {d: max_rows for d in found})
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(picked), "_id").select(F.xxhash64("_id").alias("order"), F.col("_label").cast("string").alias("label"), "text")

    def run(batch: pa.RecordBatch):
        x = features(batch.column(2))[1].astype(np.float32)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, FEATURES, dtype=np.int32)), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["order", "label", "x"])

    limit = max_rows * len(found)
    got = arrow_rows(map_batches(rows, run, "order long, label string, x array<float>").limit(limit), limit, "labelled sample").sort_by([("order", "ascending")])
    if not got.num_rows:
        return None
    x = np.concatenate([np.asarray(c.flatten()) for c in got.column("x").chunks]).reshape(-1, FEATURES).astype(np.float64)
    names = {str(d): i for i, d in enumerate(found)}
    y = np.eye(len(found))[[names[v] for v in got.column("label").to_pylist()]]
    mean, scale = x.mean(0), x.std(0) + 1e-2
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    prior = np.array([share[d] for d in found], float)
    importance = y @ (prior / prior.sum() / np.maximum(y.sum(0), 1))
    weight = np.zeros((z.shape[1], len(found)))
    del got, x  # the driver's memory is small
    longest = np.linalg.eigvalsh((z * importance[:, None]).T @ z).max()  # of the curvature
    velocity, rate = np.zeros_like(weight), 4.0 / (longest + ridge)
    for _ in range(steps):
        ahead = weight + 0.9 * velocity
        p = z @ ahead
        p = np.exp(p - p.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        gradient = z.T @ ((p - y) * importance[:, None]) + ridge * ahead
        velocity = 0.9 * velocity - 0.5 * rate * gradient
        weight = weight + velocity
    return DomainModel(found, mean, scale, weight)


def with_posteriors(docs: DataFrame, model: DomainModel | None, text_col: str, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_tokens`` (words) and ``posterior`` (array, one entry per domain)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> list:
        model = shared.value
        n, k, step = [], 1 if model is None else len(model.domains), 1000
        p = []
        for at in range(0, len(texts), step):
            words, x = features(texts.slice(at, step))
            n.append(words)
            p.append(np.ones((len(x), 1)) if model is None else model.posteriors(x))
        flat = np.concatenate(p).ravel()
        return [pa.array(np.concatenate(n).astype(np.int64)), pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, k, dtype=np.int32)), pa.array(flat))]

    return append_columns(docs, text_col, run, [T.StructField("n_tokens", T.LongType()), T.StructField("posterior", T.ArrayType(T.DoubleType()))], keep)


@dataclass
class Mixture:
    """The solved mixture: domain targets, reached totals and the pulls that give the rates."""

    domains: list
    targets: np.ndarray
    totals: np.ndarray
    base_rate: float
    step_size: float  # of a plain projected gradient, a bound from the domain totals
    ridge: float
    least_rate: float
    pulls: np.ndarray
    missed: list  # domains whose totals are off their targets
    steps: int = 0  # aggregations that the rates took

    def pull(self) -> Column:
        return sum((F.element_at("posterior", d + 1) * float(v) for d, v in enumerate(self.pulls)), F.lit(0.0))

    def rate(self) -> Column:
        """The rate of a row from its ``posterior``."""
        return F.greatest(F.lit(float(self.least_rate)), F.lit(float(self.base_rate)) - self.pull() / float(self.ridge))


def solve_rates(rows: DataFrame, domains: list, weights: dict, total: float | None, least_rate: float, ridge: float, max_steps: int, tolerance: float) -> Mixture:
    """Projected gradient steps over ``rows`` (n_tokens, posterior) until the gradient
    is below a hundredth of ``tolerance`` of the total.

    ``total`` is the number of tokens to reach; by default the smallest at which
    no domain has to be thinned out."""
    if ridge <= 0:
        raise ValueError("ridge must be above 0")
    k = len(domains)
    p = [F.element_at("posterior", d + 1) for d in range(k)]
    sums = [F.sum(F.col("n_tokens") * p[d]).alias(f"s{d}") for d in range(k)]
    gram = [F.sum(F.col("n_tokens") * p[a] * p[b]).alias(f"g{a}_{b}") for a in range(k) for b in range(a, k)]
    got = rows.agg(*sums, *gram).toArrow().to_pylist()[0]
    have = np.array([got[f"s{d}"] or 0.0 for d in range(k)])
    share = np.array([float(weights.get(d, 0)) for d in domains])
    share = share / share.sum() if share.sum() else np.full(k, 1 / k)
    tokens = have.sum()
    if not tokens:
        return Mixture(domains, share * 0, have, max(1.0, least_rate), 1.0, ridge, least_rate, np.zeros(k), [])
    if total is None:
        total = float(max(h / s for h, s in zip(have, share) if s > 0 and h > 0))
    targets, base = share * total, total / tokens
    floor = np.maximum(targets, 1e-3 * total)

    def square(found: dict) -> np.ndarray:
        matrix = np.zeros((k, k))
        for a in range(k):
            for b in range(a, k):
                matrix[a, b] = matrix[b, a] = found[f"g{a}_{b}"] or 0.0
        return matrix

    step_size = 1.0 / (np.linalg.eigvalsh(square(got) / np.sqrt(np.outer(floor, floor))).max() + ridge)
    mixture = Mixture(domains, targets, have, base, step_size, ridge, least_rate, np.zeros(k), [], 0)
    whole, n, r = square(got), F.col("n_tokens"), F.col("rate")
    free = F.when(r > least_rate, n).otherwise(0)

    def gradient(pulls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Projected gradient as one number per domain, the Gram matrix of the
        free rows, and the domain totals."""
        mixture.pulls, mixture.steps = pulls, mixture.steps + 1
        found = (
            rows.select("n_tokens", "posterior", mixture.rate().alias("rate"))
            .agg(*[F.sum(n * p[d] * r).alias(f"s{d}") for d in range(k)], *[F.sum(free * p[a] * p[b]).alias(f"g{a}_{b}") for a in range(k) for b in range(a, k)])
            .toArrow()
            .to_pylist()[0]
        )
        totals = np.array([found[f"s{d}"] for d in range(k)])
        return floor * pulls + targets - totals, square(found), totals

    pulls, share_of_all = np.zeros(k), 1.0
    slope, some, mixture.totals = gradient(pulls)
    while np.abs(slope).max() > 0.01 * tolerance * total and mixture.steps < max_steps:
        move = -np.linalg.solve(np.diag(floor) + (share_of_all * whole + (1 - share_of_all) * some) / ridge, slope)
        tried = gradient(pulls + move)
        if abs(tried[0] @ move) <= 0.9 * abs(slope @ move):
            pulls = pulls + move
            slope, some, mixture.totals = tried
            share_of_all = share_of_all / 4 if share_of_all > 4e-3 else 0.0
        elif share_of_all == 1.0:  # the scale with which no step is too long
            pulls = pulls + move
            slope, some, mixture.totals = tried
        else:
            share_of_all = min(1.0, share_of_all * 4 + 1e-3)
    mixture.pulls = pulls
    mixture.missed = [d for d, off in zip(domains, np.abs(mixture.totals - targets)) if off > tolerance * total]
    if mixture.missed:
        told = ", ".join(f"{d}: {x:.0f} of {t:.0f} tokens" for d, x, t in zip(domains, mixture.totals, targets) if d in mixture.missed)
        warnings.warn(f"mixing: the rates do not reach all targets ({told})", stacklevel=2)
    return mixture


def mixing_rates(
    docs: DataFrame,
    labels: DataFrame,
    weights: dict,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    label_id_col: str | None = None,
    total: float | None = None,
    least_rate: float = 0.0,
    ridge: float = 1e-3,
    max_steps: int = 40,
    tolerance: float = 1e-3,
    keep: list[str] | None = None,
) -> tuple[DataFrame, Mixture]:
    """Rows of ``docs`` (or its columns ``keep``) with ``n_tokens``, ``posterior``,
    ``rate`` and ``copies`` (the rate rounded by the hash of the id, so that its
    expectation is the rate), and the mixture.

    ``label_id_col`` is the id column of ``labels`` if it has another name than
    that of ``docs``. ``weights`` maps the values of ``label_col`` to the wanted shares of tokens."""
    own_ids = labels.select(F.col(label_id_col or id_col).alias(id_col), label_col)
    model = train_domains(docs, own_ids, sorted(weights), id_col, text_col, label_col)
    rows = materialise(with_posteriors(docs, model, text_col, keep), "posteriors")
    domains = [None] if model is None else model.domains
    mixture = solve_rates(rows.select("n_tokens", "posterior"), domains, weights, total, least_rate, ridge, max_steps, tolerance)
    draw = F.pmod(F.xxhash64(F.lit("copies"), F.col(id_col)), F.lit(1 << 30)) / float(1 << 30)
    rated = rows.withColumn("rate", mixture.rate())
    return rated.withColumn("copies", F.floor(F.col("rate") + draw).cast("long")), mixture


def mixed(rated: DataFrame, columns: list[str]) -> DataFrame:
    """The mixture itself: every row as often as its copies say."""
    return rated.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*columns)
