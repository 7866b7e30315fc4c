"""Neighbour searches and density clustering on vectors.

Exact Euclidean searches over a metric tree (``metric_tree``): a block of points goes
down the levels to the leaves that the triangle inequality leaves over, and their
points pass by it in a stream (``sweep``). What leaves a task is either the pairs
within the radius, or the k nearest, or what connects the pairs, as the caller needs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .metric_tree import LEAF, build_tree, exact_distances, meet, visits
from .metric_tree import checkpointed as _ckpt
from .ordering import global_row_number
from .sweep import Linked, Nearest, Reach, Within, sweep


def as_points(df: DataFrame, id_col: str, vec: str) -> DataFrame:
    """(id, vec array<double>) in the shape the searches expect."""
    return df.select(F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("vec"))


def _pair_schema(points: DataFrame) -> T.StructType:
    t = points.schema["id"].dataType
    return T.StructType([T.StructField("id_q", t), T.StructField("id_p", t), T.StructField("dist", T.DoubleType())])


def _points(points: DataFrame, id_col: str, vec: str) -> DataFrame:
    part = [F.col("part")] if "part" in points.columns else [F.lit("").alias("part")]
    return points.select(F.col(id_col).alias("id"), *part, F.col(vec).cast("array<double>").alias("vec"))


def _same_reach(tree, eps: float) -> DataFrame:
    return tree.members.select("cell").distinct().withColumn("reach", F.lit(eps))


def radius_join(
    points: DataFrame, eps: float, id_col: str = "id", vec: str = "vec", queries: DataFrame | None = None, block: int = LEAF
) -> DataFrame:
    """All pairs (id_q, id_p, dist) with ``dist <= eps`` and ``id_q != id_p``.

    ``queries`` (default: all points) restricts the query side; both
    orientations of a pair are returned. Points with a column ``part`` meet
    only within it."""
    eps = float(eps)
    if eps <= 0:
        raise ValueError("eps must be positive")
    pts = _points(points, id_col, vec)
    tree = build_tree(pts, block)
    if queries is None:
        return sweep(tree, lambda ids, x, cell: Within(ids, x, cell, eps), _pair_schema(pts), _same_reach(tree, eps))
    asked = _points(queries, id_col, vec).withColumn("reach", F.lit(eps))

    def pairs(some, mem, d):
        qi, pi = np.nonzero(d <= eps * (1 + 1e-9) + 1e-7)
        dist = exact_distances(some, mem, qi, pi)
        idq, idp = some["id_q"].to_numpy()[qi], mem["id_p"].to_numpy()[pi]
        keep = (dist <= eps) & (idq != idp)
        return pd.DataFrame({"id_q": idq[keep], "id_p": idp[keep], "dist": dist[keep]})

    return meet(tree, visits(tree, asked), pairs, _pair_schema(pts))


def knn(points: DataFrame, k: int, id_col: str = "id", vec: str = "vec", block: int = LEAF) -> DataFrame:
    """Exact k nearest neighbours of every point, itself included
    (id_q, j, id_p, dist) with j = 1..k.

    The search within a point's own block bounds its k-th distance; then the leaves
    within the bounds of a block pass by it, and each point keeps its k nearest."""
    return knn_in(build_tree(_points(points, id_col, vec), block), int(k))


def knn_in(tree, k: int) -> DataFrame:
    """``knn`` over a tree that is built already."""
    id_type = tree.members.schema["id"].dataType
    schema = T.StructType([T.StructField("id_q", id_type), T.StructField("j", T.IntegerType()), T.StructField("id_p", id_type), T.StructField("dist", T.DoubleType())])
    reach = None
    if tree.levels:  # else every part is one leaf
        cells = T.StructType([T.StructField("cell", T.StringType()), T.StructField("reach", T.DoubleType())])
        own = sweep(tree, lambda ids, x, cell: Reach(ids, x, cell, k), cells)
        reach = _ckpt(own.groupBy("cell").agg(F.max("reach").alias("reach")))
    found = sweep(tree, lambda ids, x, cell: Nearest(ids, x, cell, k), schema, reach)
    if not tree.members.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        return found
    # rows that repeat an id are one query
    window = Window.partitionBy("id_q").orderBy("dist", "id_p")
    return found.withColumn("j", F.row_number().over(window)).where(F.col("j") <= k)


def k_distance_curve(neigh: DataFrame) -> DataFrame:
    """Sort each neighbour column j over all points on its own, then
    average across columns per sorted position: (pos, distance)."""
    ranked = global_row_number(neigh.select("j", "dist", "id_q"), ["j", "dist", "id_q"], "_g")
    starts = ranked.groupBy("j").agg(F.min("_g").alias("_s"))
    pos = ranked.join(F.broadcast(starts), "j").select((F.col("_g") - F.col("_s")).alias("pos"), "dist")
    return pos.groupBy("pos").agg(F.avg("dist").alias("distance"))


def _running_max(df: DataFrame, pos: str, value: str, out: str) -> DataFrame:
    """Running maximum of ``value`` (nulls ignored) in ``pos`` order, distributed:
    per range partition, then the maxima of earlier partitions are added."""
    ranged = df.repartitionByRange(pos).withColumn("_pid", F.spark_partition_id())
    ranged = _ckpt(ranged)
    local = ranged.withColumn(
        "_lm", F.max(value).over(Window.partitionBy("_pid").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0))
    )
    pmax = ranged.groupBy("_pid").agg(F.max(value).alias("_pm"))
    before = pmax.select("_pid", F.max("_pm").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)).alias("_bm"))
    return local.join(F.broadcast(before), "_pid").withColumn(out, F.greatest("_lm", "_bm")).drop("_pid", "_lm", "_bm")


def knee_epsilon(curve: DataFrame, sensitivity: float = 1.0, default: float = 1.0) -> float:
    """V9: knee of (x = distance, y = position) for a concave, increasing
    curve (Kneedle, offline: the first knee); ``default`` when none."""
    c = _ckpt(curve.select(F.col("pos").cast("long").alias("pos"), F.col("distance").alias("x"), F.col("pos").cast("double").alias("y")))
    st = c.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.count("*").alias("n")).first()
    if st["n"] is None or st["n"] < 3 or st["x1"] == st["x0"] or st["y1"] == st["y0"]:
        return default
    xn = (F.col("x") - st["x0"]) / (st["x1"] - st["x0"])
    yn = (F.col("y") - st["y0"]) / (st["y1"] - st["y0"])
    d = _ckpt(c.select("pos", "x", xn.alias("xn"), (yn - xn).alias("yd")))
    # mean step of the normalised x
    step = abs((1.0 - 0.0) / (st["n"] - 1))
    prev = d.select((F.col("pos") + 1).alias("pos"), F.col("yd").alias("yd_prev"))
    nxt = d.select((F.col("pos") - 1).alias("pos"), F.col("yd").alias("yd_next"))
    e = d.join(prev, "pos", "left").join(nxt, "pos", "left")
    # local extrema with >= / <= against both neighbours (ends compare one side only)
    is_max = (F.coalesce(F.col("yd") >= F.col("yd_prev"), F.lit(True))) & (F.coalesce(F.col("yd") >= F.col("yd_next"), F.lit(True)))
    is_min = (F.coalesce(F.col("yd") <= F.col("yd_prev"), F.lit(True))) & (F.coalesce(F.col("yd") <= F.col("yd_next"), F.lit(True)))
    e = e.withColumn("is_max", is_max).withColumn("is_min", is_min)
    first_max = e.where("is_max").agg(F.min("pos")).first()[0]
    if first_max is None:
        return default
    e = e.withColumn("_mx", F.when(F.col("is_max"), F.col("pos")))
    e = e.withColumn("_mn", F.when(F.col("is_min"), F.col("pos")))
    e = _running_max(e, "pos", "_mx", "last_max")
    e = _running_max(e, "pos", "_mn", "last_min")
    thr_of = e.select(F.col("pos").alias("last_max"), (F.col("yd") - F.lit(sensitivity * step)).alias("tmx"), F.col("x").alias("knee_x"))
    e = e.join(thr_of, "last_max", "left")
    threshold = F.when(F.col("last_min") >= F.col("last_max"), F.lit(0.0)).otherwise(F.col("tmx"))
    # the scan stops at the point where normalised x reaches 1
    stop = e.where(F.col("xn") >= 1.0).agg(F.min("pos")).first()[0]
    cand = e.where((F.col("pos") >= first_max) & (F.col("yd_next") < threshold))
    if stop is not None:
        cand = cand.where(F.col("pos") < stop)
    hit = cand.orderBy("pos").select("knee_x").first()
    return float(hit[0]) if hit is not None else default


def connected_components(nodes: DataFrame, edges: DataFrame, id_col: str = "id", max_rounds: int = 10_000) -> DataFrame:
    """(id, component): component = smallest id reachable. Min-label
    propagation with pointer jumping; each round is checkpointed."""
    e = edges.select(F.col("id_q").alias("a"), F.col("id_p").alias("b"))
    e = e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    e = _ckpt(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    lab = _ckpt(nodes.select(F.col(id_col).alias("a"), F.col(id_col).alias("label")))
    for _ in range(max_rounds):
        via = e.join(lab, "a").groupBy("b").agg(F.min("label").alias("_m")).withColumnRenamed("b", "a")
        new = lab.join(via, "a", "left").select("a", F.least("label", F.coalesce("_m", "label")).alias("label"))
        # pointer jumping: take the label of the label
        jump = new.select(F.col("a").alias("label"), F.col("label").alias("_l2"))
        new = new.join(jump, "label", "left").select("a", F.least("label", F.coalesce("_l2", "label")).alias("label"))
        new = _ckpt(new)
        changed = new.join(lab.withColumnRenamed("label", "_old"), "a").where(F.col("label") != F.col("_old")).limit(1).count()
        lab = new
        if changed == 0:
            return lab.select(F.col("a").alias(id_col), F.col("label").alias("component"))
    raise RuntimeError("components did not converge")


def dbscan(points: DataFrame, eps: float, id_col: str = "id", vec: str = "vec", block: int = LEAF) -> DataFrame:
    """V10 with min samples 1: every point is core, clusters are the
    connected components of the graph of pairs within ``eps``; no noise.
    Of the pairs only what connects them leaves a task."""
    eps = float(eps)
    pts = _points(points, id_col, vec)
    tree = build_tree(pts, block)
    id_type = tree.members.schema["id"].dataType
    schema = T.StructType([T.StructField("id_q", id_type), T.StructField("id_p", id_type)])
    edges = sweep(tree, lambda ids, x, cell: Linked(ids, x, cell, eps), schema, _same_reach(tree, eps)).where("id_q <> id_p")
    return connected_components(pts.select("id"), edges).withColumnRenamed("id", id_col)
