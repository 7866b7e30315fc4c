"""Searches of all points of a metric tree, block of queries by block.

The points of a part are dealt to blocks of neighbouring cells. Every block asks the
tree once for the leaves that any of its points may need, and their points pass by
the block in one stream: first the block's own, then those of the other leaves. A
task so holds one block, one batch of the stream and what its visitor keeps, however
many points the tree has, and a leaf is sent once to a block and not once to a query.

A visitor is made for each block from its (ids, vectors, cells); ``feed(ids, vectors,
own)`` gets the stream in slices and ``finish`` ends it. Both yield tuples of result
columns.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .metric_tree import Tree, checkpointed, visits

BLOCK_LEAVES = 4  # a block of queries holds about this many full leaves
SLICE = 1000  # queries that are held against a slice of the stream at once
_OUT_ROWS = 100_000


def vectors_of(column: pa.Array) -> np.ndarray:
    """Rows of a list column; rows without a vector are not a number, and so near to nothing."""
    if not len(column):
        return np.empty((0, 0))
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    width = int(size.max())
    if ((size != width) & (size > 0)).any():
        raise ValueError("vectors differ in length")
    out = np.full((len(column), width), np.nan)
    if width:
        out[size == width] = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return out


def between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances of two sets by one matrix product, up to its rounding."""
    d2 = a @ b.T
    d2 *= -2.0
    d2 += (a * a).sum(1)[:, None]
    d2 += (b * b).sum(1)[None, :]
    np.maximum(d2, 0.0, out=d2)
    return np.sqrt(d2, out=d2)


def pair_distances(a: np.ndarray, b: np.ndarray, qi: np.ndarray, pi: np.ndarray, step: int = 4096) -> np.ndarray:
    """Distances of single pairs without the rounding of the matrix product, in slices."""
    out = np.empty(len(qi))
    for at in range(0, len(qi), step):
        out[at : at + step] = np.sqrt(((a[qi[at : at + step]] - b[pi[at : at + step]]) ** 2).sum(1))
    return out


def roomy(limit):
    """``limit`` with room for the rounding of ``between``."""
    return limit * (1 + 1e-9) + 1e-7


# ------------------------------------------------------------------ blocks
def leaf_balls(tree: Tree) -> DataFrame:
    """(cell, part, n, pivot, radius) of every leaf; a root has no pivot."""
    leaves = tree.members.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.first("part").alias("part"))
    kind = tree.members.schema["vec"].dataType
    balls = tree.roots.where("leaf").select("cell", F.lit(None).cast(kind).alias("pivot"), F.lit(None).cast("double").alias("radius"))
    for level in tree.levels:
        balls = balls.unionByName(level.where("leaf").select("cell", "pivot", "radius"))
    return leaves.join(balls, "cell")


def query_blocks(tree: Tree, most: int) -> DataFrame:
    """(cell, bin, parts): the bin of every leaf, in as many parts as its points need.
    A bin takes the largest cells of at most ``most`` points of one parent."""
    fits = (F.col("n") <= most) | F.col("leaf")
    nodes = tree.roots.where(fits).select(F.col("cell").alias("node"), F.col("cell").alias("bin"), "n")
    kids = Window.partitionBy("parent")
    for level in tree.levels:
        picked = level.where(fits & (F.col("rows") > most)).select("parent", "cell", "n")
        whole = F.sum("n").over(kids)
        before = F.sum("n").over(kids.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
        at = F.floor(before * F.ceil(whole / F.lit(float(most))) / whole)
        nodes = nodes.unionByName(picked.select(F.col("cell").alias("node"), F.concat_ws("#", "parent", at.cast("string")).alias("bin"), "n"))
    sizes = nodes.groupBy("bin").agg(F.greatest(F.lit(1), F.ceil(F.sum("n") / F.lit(2.0 * most))).cast("int").alias("parts"))
    steps = F.split("cell", "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, F.lit(1), i), "/"))
    leaves = tree.members.select("cell").distinct().select("cell", F.explode(prefixes).alias("node"))
    return leaves.join(nodes.select("node", "bin"), "node").join(sizes, "bin").select("cell", "bin", "parts")


def needed_leaves(tree: Tree, bins: DataFrame, reach: DataFrame) -> DataFrame:
    """(bin, cell): the leaves that may hold a point within the reach (cell, reach) of a bin's points."""
    balls = leaf_balls(tree).join(reach, "cell")
    asked = balls.select(F.col("cell").alias("id"), "part", F.col("pivot").alias("vec"), (F.coalesce("radius", F.lit(0.0)) + F.col("reach") * (1 + 1e-9) + 1e-6).alias("reach"))
    met = visits(tree, asked).select(F.col("id").alias("asking"), "cell")
    return met.join(bins.select(F.col("cell").alias("asking"), "bin"), "asking").select("bin", "cell").distinct()


# ------------------------------------------------------------------ the stream
def sweep(tree: Tree, begin: Callable, schema: T.StructType, reach: DataFrame | None = None) -> DataFrame:
    """The rows of the visitors that ``begin`` makes. With ``reach`` (cell, reach) a
    block sees all points that may be within reach of its own, without only these."""
    most = BLOCK_LEAVES * tree.leaf
    bins = checkpointed(query_blocks(tree, most))
    total = bins.select("bin", "parts").distinct().agg(F.sum("parts")).toArrow().column(0)[0].as_py() or 1
    block = lambda bin, part: F.concat_ws("@", bin, part.cast("string"))
    members = tree.members.join(bins, "cell").withColumn("block", block(F.col("bin"), F.pmod(F.xxhash64("id"), "parts")))
    rows = members.select("block", F.lit(0).alias("side"), "cell", "id", "vec")
    if reach is not None:
        parts = bins.select("bin", "parts").distinct()
        asking = needed_leaves(tree, bins, reach).join(parts, "bin")
        asking = asking.select("cell", "bin", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        asking = checkpointed(asking.select("cell", block(F.col("bin"), F.col("part")).alias("to")))
        others = members.select("cell", "id", "vec", "block").join(asking, "cell").where("block <> to")
        rows = rows.unionByName(others.select(F.col("to").alias("block"), F.lit(1).alias("side"), "cell", "id", "vec"))
    arrow = None
    step = tree.leaf

    def table(columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, arrow.types)], schema=arrow)

    def emitted(found):
        for columns in found:
            for at in range(0, len(columns[0]), _OUT_ROWS):
                yield table([c[at : at + _OUT_ROWS] for c in columns])

    def run(batches):
        now, own, visitor = None, [], None

        def fed(visitor, ids, x, is_own):
            for at in range(0, len(ids), step):
                yield from emitted(visitor.feed(ids[at : at + step], x[at : at + step], is_own))

        def started():
            ids, x, cells = (np.concatenate(c) for c in zip(*own))
            return begin(ids, x, cells), ids, x

        for batch in batches:
            names, side = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy()
            cuts = np.flatnonzero((names[1:] != names[:-1]) | (side[1:] != side[:-1])) + 1
            for lo, hi in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(names)]])):
                if hi == lo:
                    continue
                some = batch.slice(int(lo), int(hi - lo))
                ids, x = some.column(3).to_numpy(zero_copy_only=False), vectors_of(some.column(4))
                if names[lo] != now:
                    if now is not None:
                        if visitor is None:
                            visitor, mine, y = started()
                            yield from fed(visitor, mine, y, True)
                        yield from emitted(visitor.finish())
                    now, own, visitor = names[lo], [], None
                if side[lo] == 0:
                    own.append((ids, x, some.column(2).to_numpy(zero_copy_only=False)))
                else:
                    if visitor is None:
                        visitor, mine, y = started()
                        yield from fed(visitor, mine, y, True)
                    yield from fed(visitor, ids, x, False)
        if now is not None:
            if visitor is None:
                visitor, mine, y = started()
                yield from fed(visitor, mine, y, True)
            yield from emitted(visitor.finish())

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    dealt = rows.repartition(min(2 * total, 4096), "block").sortWithinPartitions("block", "side", "cell")
    return dealt.mapInArrow(run, schema)


# ------------------------------------------------------------------ visitors
class Nearest:
    """The k nearest of every query by (distance, id); ``far`` gives the k-th distances."""

    def __init__(self, ids, x, cells, k: int):
        self.ids, self.x, self.cells, self.k = ids, x, cells, k
        self.slices = [slice(at, at + SLICE) for at in range(0, len(ids), SLICE)]
        self.kept = [None] * len(self.slices)  # (query, id, distance), the best of each query
        self.new: list[list] = [[] for _ in self.slices]
        self.far = np.full(len(ids), np.inf)

    def feed(self, ids, x, own):
        for at, part in enumerate(self.slices):
            d = between(self.x[part], x)
            d[np.isnan(d)] = np.inf
            edge = self.far[part]
            near = d <= roomy(edge)[:, None]
            if self.k < d.shape[1] and near.sum() > len(d) * self.k / 4:
                edge = np.minimum(edge, np.partition(d, self.k - 1, axis=1)[:, self.k - 1])
                near = d <= roomy(edge)[:, None]
            near &= np.isfinite(d)
            qi, pi = np.nonzero(near)
            if len(qi):
                self.new[at].append((qi.astype(np.int32), ids[pi], pair_distances(self.x[part], x, qi, pi)))
            if sum(len(n[0]) for n in self.new[at]) >= len(d) * self.k:
                self._settle(at)
        return ()

    def _settle(self, at: int) -> None:
        if not self.new[at]:
            return
        q, ids, dist = (np.concatenate(c) for c in zip(*([] if self.kept[at] is None else [self.kept[at]]), *self.new[at]))
        order = np.lexsort((ids if ids.dtype != object else ids.astype(str), dist, q))
        q, ids, dist = q[order], ids[order], dist[order]
        first = np.searchsorted(q, q, side="left")
        place = np.arange(len(q)) - first
        best = place < self.k
        part = self.slices[at]
        last = place == self.k - 1
        self.far[part.start + q[last]] = dist[last]
        self.kept[at], self.new[at] = (q[best], ids[best], dist[best]), []

    def settled(self):
        for at, part in enumerate(self.slices):
            self._settle(at)
            if self.kept[at] is not None:
                q, ids, dist = self.kept[at]
                yield self.ids[part][q], np.arange(len(q)) - np.searchsorted(q, q, side="left") + 1, ids, dist
                self.kept[at] = None

    def finish(self):
        return self.settled()


class Reach(Nearest):
    """The largest k-th distance of the queries of each cell."""

    def finish(self):
        for _ in self.settled():
            pass
        cells, at = np.unique(self.cells.astype(str), return_inverse=True)
        # a query that is no number is near to nothing
        far = np.where(np.isnan(self.x).any(axis=1), 0.0, self.far)
        most = np.zeros(len(cells))
        np.maximum.at(most, at, far)
        yield cells.astype(object), most


class Within:
    """The pairs within a radius."""

    def __init__(self, ids, x, cells, eps: float):
        self.ids, self.x, self.eps = ids, x, eps

    def feed(self, ids, x, own):
        for at in range(0, len(self.ids), SLICE):
            mine, y = self.ids[at : at + SLICE], self.x[at : at + SLICE]
            qi, pi = np.nonzero(between(y, x) <= roomy(self.eps))
            dist = pair_distances(y, x, qi, pi)
            ok = (dist <= self.eps) & (mine[qi] != ids[pi])
            if ok.any():
                yield mine[qi[ok]], ids[pi[ok]], dist[ok]

    def finish(self):
        return ()


def joined(group: np.ndarray, qi: np.ndarray, pi: np.ndarray, n: int) -> np.ndarray:
    """``group`` (the first query of each query's group) after groups that share a point become one."""
    while True:
        least = np.full(n, len(group))
        np.minimum.at(least, pi, group[qi])
        if (least[pi] == group[qi]).all():
            return group
        to = np.arange(len(group))
        np.minimum.at(to, group[qi], least[pi])
        while (to[to] != to).any():
            to = to[to]
        group = to[group]


class Linked:
    """Pairs that connect what the pairs within a radius connect: queries with the
    first of their group, and a passing point with one query."""

    def __init__(self, ids, x, cells, eps: float):
        self.ids, self.x, self.eps = ids, x, eps
        self.group = np.arange(len(ids))

    def feed(self, ids, x, own):
        q, p = [], []  # one query of each slice for each point
        for at in range(0, len(self.ids), SLICE):
            y = self.x[at : at + SLICE]
            d = between(y, x)
            qi, pi = np.nonzero(d <= roomy(self.eps))
            close = np.flatnonzero(d[qi, pi] > self.eps * (1 - 1e-9) - 1e-7)  # as near to the radius as rounding
            if len(close):
                ok = np.ones(len(qi), bool)
                ok[close] = pair_distances(y, x, qi[close], pi[close]) <= self.eps
                qi, pi = qi[ok], pi[ok]
            if len(qi):
                self.group = joined(self.group, qi + at, pi, len(ids))
                met, first = np.unique(pi, return_index=True)
                q.append(qi[first] + at)
                p.append(met)
        if q:
            q, p = np.concatenate(q), np.concatenate(p)
            self.group = joined(self.group, q, p, len(ids))
            if not own:
                met, first = np.unique(p, return_index=True)
                yield self.ids[q[first]], ids[met]

    def finish(self):
        tied = np.flatnonzero(self.group != np.arange(len(self.group)))
        yield self.ids[tied], self.ids[self.group[tied]]
