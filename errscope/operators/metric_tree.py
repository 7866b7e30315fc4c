"""A metric tree over vectors, built and searched with joins.

Points are split around pivots (vantage points) level by level: every point of a
cell goes to its nearest pivot, a few points of the cell itself, until a cell
holds at most ``leaf`` points. A cell knows the distance from its pivot to its
farthest point. A search goes down the same levels: by the triangle inequality a
query needs only the cells with ``d(query, pivot) - radius <= reach``. What a
query is held against are the points of the leaves that are left, so for points
in clusters the work per query does not follow the number of points.

Levels are tables: on each, queries (or points) meet the pivots of their cell in
a join. Cells with many rows are dealt out by salt, so no task holds more than
about ``leaf`` rows of a cell at a time. Cells that no pivot can split (equal
points) are leaves of any size, and are held in salted parts.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

LEAF = 2000
FAN = 32
MAX_LEVELS = 16


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` as a written table. A checkpoint would hand on what the optimiser has
    inferred about its columns, which over many rounds takes longer than the work."""
    return written(df, "points")


def matrix(column) -> np.ndarray:
    return np.vstack(column.to_numpy()).astype(np.float64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d2 = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * a @ b.T
    return np.sqrt(np.maximum(d2, 0.0))


@dataclass
class Tree:
    """``members`` (id, part, vec, cell) with the leaf of every point, ``roots``
    (cell, n, leaf) with one row for each part, and ``levels``: tables (parent,
    rows, cell, pivot, radius, n, leaf) with one row for each cell."""

    members: DataFrame
    roots: DataFrame
    leaf: int
    levels: list[DataFrame] = field(default_factory=list)

    def leaves(self) -> DataFrame:
        """(cell, n) of all leaves."""
        return self.members.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))


def _salts(n, leaf: int):
    return F.greatest(F.lit(1), F.ceil(n / F.lit(float(leaf)))).cast("int")


def build_tree(points: DataFrame, leaf: int = LEAF, fan: int = FAN, max_levels: int = MAX_LEVELS) -> Tree:
    """Tree over (id, part, vec); every part has a root of its own."""
    points = checkpointed(points.select("id", "part", "vec", F.hex(F.col("part")).alias("cell")))
    roots = points.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).withColumn("leaf", F.col("n") <= leaf)
    roots = checkpointed(roots)
    tree = Tree(points, roots, leaf)
    if not roots.where("not leaf").limit(1).count():
        return tree
    done = points.join(roots.where("leaf").select("cell"), "cell", "left_semi").select("id", "part", "vec", "cell")
    open_points = points.join(roots.where("not leaf").select("cell", "n"), "cell")
    edge = None
    kinds = {f.name: f.dataType for f in points.schema.fields}
    schema = T.StructType([T.StructField(c, kinds[c]) for c in ("id", "part", "vec", "cell")] + [T.StructField("parent", T.StringType()), T.StructField("kid", T.IntegerType()), T.StructField("far", T.DoubleType())])

    def assign(mem: pd.DataFrame, cell: pd.DataFrame) -> pd.DataFrame:
        if not len(mem):
            return pd.DataFrame({f.name: pd.Series([], dtype=object) for f in schema.fields})
        d = distances(matrix(mem["vec"]), np.vstack(list(cell["pivots"].iloc[0])).astype(np.float64))
        kid = np.argmin(d, axis=1).astype("int32")
        parent = mem["cell"].to_numpy()
        return pd.DataFrame({"id": mem["id"], "part": mem["part"], "vec": mem["vec"], "cell": [f"{p}/{k}" for p, k in zip(parent, kid)], "parent": parent, "kid": kid, "far": d[np.arange(len(mem)), kid]})

    for level in range(max_levels):
        first = Window.partitionBy("cell").orderBy(F.xxhash64("id"), "id")
        picked = open_points.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= fan).select("cell", "vec")
        if edge is not None:  # the point farthest from the pivot, so that every split is one
            picked = picked.unionByName(edge)
        pivots = checkpointed(picked.groupBy("cell").agg(F.sort_array(F.collect_set("vec")).alias("pivots")))  # at most fan + 1
        salted = open_points.withColumn("salt", F.pmod(F.xxhash64("id", F.lit(level)), _salts(F.col("n"), leaf)).cast("int"))
        sizes = open_points.groupBy("cell").agg(F.first("n").alias("n"))
        spread = pivots.join(sizes, "cell").select(F.col("cell").alias("in_cell"), F.explode(F.sequence(F.lit(0), _salts(F.col("n"), leaf) - 1)).alias("part_of"), "pivots")
        assigned = checkpointed(salted.groupBy("cell", "salt").cogroup(spread.groupBy("in_cell", "part_of")).applyInPandas(assign, schema))
        kids = assigned.groupBy("cell").agg(
            F.first("parent").alias("parent"), F.first("kid").alias("kid"), F.count(F.lit(1)).alias("n"), (F.max("far") * (1 + 1e-9) + 1e-9).alias("radius"), F.max("far").alias("_far"), F.max_by("vec", "far").alias("_edge")
        )
        last = level == max_levels - 1
        kids = kids.withColumn("leaf", (F.col("n") <= leaf) | (F.col("_far") <= 1e-7) | F.lit(last))
        kids = kids.join(pivots.select(F.col("cell").alias("parent"), "pivots"), "parent").withColumn("pivot", F.element_at("pivots", F.col("kid") + 1))
        rows = kids.groupBy("parent").agg(F.sum("n").alias("rows"))
        kids = checkpointed(kids.drop("pivots").join(rows, "parent"))
        tree.levels.append(kids.select("parent", "rows", "cell", "pivot", "radius", "n", "leaf"))
        flagged = assigned.select("id", "part", "vec", "cell").join(kids.select("cell", "n", "leaf"), "cell")
        done = done.unionByName(flagged.where("leaf").select("id", "part", "vec", "cell"))
        more = kids.where("not leaf")
        if not more.limit(1).count():
            break
        open_points = flagged.where("not leaf").select("id", "part", "vec", "cell", "n")
        edge = more.select("cell", F.col("_edge").alias("vec"))
    tree.members = checkpointed(done)
    return tree


# ------------------------------------------------------------------ search
def _upper_bound(d: np.ndarray, radius: np.ndarray, n: np.ndarray, k: np.ndarray) -> np.ndarray:
    """For each row a radius that holds k of the cells' points for sure; infinite if they have fewer."""
    far = d + radius
    order = np.argsort(far, axis=1)
    held = np.cumsum(n[order], axis=1) >= k[:, None]
    found = np.take_along_axis(far, order, axis=1)[np.arange(len(d)), held.argmax(axis=1)]
    return np.where(held.any(axis=1), found, np.inf)


def visits(tree: Tree, queries: DataFrame, levels: list[DataFrame] | None = None) -> DataFrame:
    """(queries..., cell, n): the leaves that each query (id, part, vec, reach, ...) needs.

    With a column ``k`` the reach shrinks to what holds k points for sure. With
    ``own`` (and ``only`` in the level tables) cells whose points all have the
    query's ``own`` label are left out, and the reach shrinks to what holds one
    point of another label."""
    leaf = tree.leaf
    levels = tree.levels if levels is None else levels
    start = queries.withColumn("cell", F.hex(F.col("part"))).join(tree.roots, "cell")
    if not levels:
        return start.drop("leaf")
    fields = queries.columns
    kinds = dict((f.name, f.dataType) for f in queries.schema.fields)
    schema = T.StructType([T.StructField(c, kinds[c]) for c in fields] + [T.StructField("cell", T.StringType()), T.StructField("n", T.LongType()), T.StructField("leaf", T.BooleanType())])
    by_k, by_own = "k" in fields, "own" in fields

    def step(qry: pd.DataFrame, kids: pd.DataFrame) -> pd.DataFrame:
        if not len(qry) or not len(kids):
            return pd.DataFrame({f.name: pd.Series([], dtype=object) for f in schema.fields})
        radius, n = kids["radius"].to_numpy(float), kids["n"].to_numpy()
        d = distances(matrix(qry["vec"]), matrix(kids["pivot"]))
        reach = qry["reach"].to_numpy(float)
        wanted = np.ones(d.shape, bool)
        if by_own:
            wanted = kids["only"].to_numpy()[None, :] != qry["own"].to_numpy()[:, None]
            reach = np.minimum(reach, np.where(wanted, d + radius, np.inf).min(axis=1))
        if by_k:
            reach = np.minimum(reach, _upper_bound(d, radius, n, qry["k"].to_numpy()))
        row, kid = np.nonzero(wanted & (d - radius <= reach[:, None] * (1 + 1e-9) + 1e-9))
        out = qry.iloc[row][fields].assign(reach=reach[row])
        return out.assign(cell=kids["cell"].to_numpy()[kid], n=n[kid], leaf=kids["leaf"].to_numpy()[kid])

    found = [start.where("leaf").drop("leaf")]
    frontier = start.where("not leaf")
    for level, kids in enumerate(levels):
        asked = frontier.withColumn("salt", F.pmod(F.xxhash64("id", F.lit(level)), _salts(F.col("n"), leaf)).cast("int")).drop("n", "leaf")
        spread = kids.withColumn("part_of", F.explode(F.sequence(F.lit(0), _salts(F.col("rows"), leaf) - 1)))
        met = asked.groupBy("cell", "salt").cogroup(spread.groupBy("parent", "part_of")).applyInPandas(step, schema)
        if level < len(levels) - 1:
            met = checkpointed(met)
        found.append(met.where("leaf").drop("leaf"))
        frontier = met.where("not leaf")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


Found = Callable[[pd.DataFrame, pd.DataFrame, np.ndarray], pd.DataFrame]


def meet(tree: Tree, asked: DataFrame, found: Found, schema: T.StructType, members: DataFrame | None = None, own: bool = False) -> DataFrame:
    """Hold every visit (id, part, vec, ..., cell, n) against the points of its
    leaf. ``found`` maps blocks (visits with columns ``id_q`` and so on, points
    with ``id_p`` and so on, distances) to result rows; points of other parts, and with
    ``own`` of the same label, are infinitely far."""
    leaf = tree.leaf
    members = (tree.members if members is None else members).join(tree.leaves(), "cell")
    salts = _salts(F.col("n"), leaf)
    kept = [c for c in ("id", "part", "vec", "own") if c in members.columns]
    m = members.select(F.col("cell").alias("cell_p"), F.pmod(F.xxhash64("id"), salts).cast("int").alias("salt_p"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("slice_p"), *[F.col(c).alias(f"{c}_p") for c in kept])
    facts = [c for c in asked.columns if c not in ("cell", "n")]
    q = asked.select("cell", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.pmod(F.xxhash64("id"), salts).cast("int").alias("slice"), *[F.col(c).alias(f"{c}_q") for c in facts])

    def run(mem: pd.DataFrame, qry: pd.DataFrame) -> pd.DataFrame:
        outs = [pd.DataFrame({f.name: pd.Series([], dtype=object) for f in schema.fields})]
        if len(mem) and len(qry):
            b = matrix(mem["vec_p"])
            for at in range(0, len(qry), leaf):
                some = qry.iloc[at : at + leaf]
                d = distances(matrix(some["vec_q"]), b)
                d[some["part_q"].to_numpy()[:, None] != mem["part_p"].to_numpy()[None, :]] = np.inf
                if own:
                    d[some["own_q"].to_numpy()[:, None] == mem["own_p"].to_numpy()[None, :]] = np.inf
                got = found(some, mem, d)
                if len(got):
                    outs.append(got)
        return outs[1] if len(outs) == 2 else pd.concat(outs[1:] or outs, ignore_index=True)

    return m.groupBy("cell_p", "salt_p", "slice_p").cogroup(q.groupBy("cell", "salt", "slice")).applyInPandas(run, schema)


def exact_distances(some: pd.DataFrame, mem: pd.DataFrame, qi: np.ndarray, pi: np.ndarray, step: int = 4096) -> np.ndarray:
    """Distances of single pairs without the rounding of the matrix product, in slices."""
    a, b = some["vec_q"].to_numpy(), mem["vec_p"].to_numpy()
    out = np.empty(len(qi))
    for at in range(0, len(qi), step):
        i, j = qi[at : at + step], pi[at : at + step]
        out[at : at + step] = np.sqrt(((np.vstack(a[i]) - np.vstack(b[j])) ** 2).sum(1))
    return out
