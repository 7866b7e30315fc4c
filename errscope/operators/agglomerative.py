"""Ward agglomerative clustering below a distance threshold.

Two clusters that merge below the threshold always hold points within the
threshold of each other: the merges so far bound the clusters' inner sums of
squares, and with them the mean squared distance between their points. So the
connected components of the graph of pairs within the threshold can be
clustered one by one. A component of at most ``local_points`` points is done
inside one task by chains of nearest neighbours; larger ones go on in rounds.

Ward linkage is reducible, so merging every pair of clusters that are each
other's nearest neighbour (below the threshold) in one round gives the same
partition as merging the single closest pair at a time. The Ward distance
``sqrt(2 n_u n_v / (n_u + n_v)) * |c_u - c_v|`` is never below the centroid
distance, so the candidate pairs of a round are the centroid pairs found by
the exact radius join with radius = threshold.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .density import _ckpt, _points, dbscan, radius_join


def nearest_neighbour_chain(x: np.ndarray, threshold: float) -> np.ndarray:
    """The cluster of each row, named by its first row."""
    n = len(x)
    size, centre, alive = np.ones(n), x.astype(np.float64).copy(), np.ones(n, bool)
    label = np.arange(n)
    done = np.zeros(n, bool)  # clusters without a neighbour below the threshold keep none
    chain: list[int] = []
    while True:
        if not chain:
            left = np.flatnonzero(alive & ~done)
            if not len(left):
                return label
            chain = [int(left[0])]
        tip = chain[-1]
        far = np.sqrt(2 * size * size[tip] / (size + size[tip])) * np.sqrt(((centre - centre[tip]) ** 2).sum(1))
        far[~alive] = np.inf
        far[tip] = np.inf
        near = int(np.argmin(far))
        if len(chain) > 1 and far[chain[-2]] <= far[near]:
            near = chain[-2]
        if not far[near] < threshold:
            done[tip] = True
            chain.pop()
        elif len(chain) > 1 and near == chain[-2]:
            keep, gone = min(tip, near), max(tip, near)
            centre[keep] = (centre[keep] * size[keep] + centre[gone] * size[gone]) / (size[keep] + size[gone])
            size[keep] += size[gone]
            alive[gone] = False
            label[label == gone] = keep
            done[keep] = False
            chain = chain[:-2]
        else:
            chain.append(near)


def ward_clusters(points: DataFrame, threshold: float = 0.1, id_col: str = "id", vec: str = "vec", local_points: int = 2000, max_rounds: int = 10_000) -> DataFrame:
    """(id, component): component = smallest point id of the merged cluster."""
    pts = _ckpt(_points(points, id_col, vec))
    found = _ckpt(pts.join(dbscan(pts, threshold), "id"))
    large = found.groupBy("component").agg(F.count("*").alias("_n")).where(F.col("_n") > local_points).select("component")
    id_type = pts.schema["id"].dataType

    def local(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        first = nearest_neighbour_chain(np.vstack(group["vec"].to_numpy()), threshold)
        ids = group["id"].to_numpy()
        return pd.DataFrame({"id": ids, "component": ids[first]})

    schema = T.StructType([T.StructField("id", id_type), T.StructField("component", id_type)])
    small = found.join(large, "component", "left_anti").groupBy("component").applyInPandas(local, schema)
    rest = _ckpt(found.join(large, "component", "left_semi").select("id", "part", "vec"))
    out = small if rest.isEmpty() else small.unionByName(_ward_rounds(rest, threshold, max_rounds))
    return out.withColumnRenamed("id", id_col)


def _ward_rounds(pts: DataFrame, threshold: float, max_rounds: int) -> DataFrame:
    """(id, component) by rounds of reciprocal nearest neighbours."""
    members = _ckpt(pts.select("id", F.col("id").alias("cid")))
    clusters = _ckpt(pts.select(F.col("id").alias("cid"), "part", F.lit(1).cast("long").alias("n"), F.col("vec").alias("c")))
    for _ in range(max_rounds):
        pairs = radius_join(clusters.select(F.col("cid").alias("id"), "part", F.col("c").alias("vec")), threshold)
        sizes_q = clusters.select(F.col("cid").alias("id_q"), F.col("n").alias("n_q"))
        sizes_p = clusters.select(F.col("cid").alias("id_p"), F.col("n").alias("n_p"))
        w = pairs.join(sizes_q, "id_q").join(sizes_p, "id_p").withColumn(
            "ward", F.sqrt(2.0 * F.col("n_q") * F.col("n_p") / (F.col("n_q") + F.col("n_p"))) * F.col("dist")
        ).where(F.col("ward") < F.lit(threshold))
        nn = w.groupBy("id_q").agg(F.min_by("id_p", F.struct("ward", "id_p")).alias("nn"))
        nn = _ckpt(nn)
        if nn.isEmpty():
            break
        back = nn.select(F.col("id_q").alias("nn"), F.col("nn").alias("_b"))
        merges = nn.join(back, "nn").where((F.col("_b") == F.col("id_q")) & (F.col("id_q") < F.col("nn")))
        merges = _ckpt(merges.select(F.col("id_q").alias("keep"), F.col("nn").alias("gone")))
        cq = clusters.select(F.col("cid").alias("keep"), "part", F.col("n").alias("n1"), F.col("c").alias("c1"))
        cp = clusters.select(F.col("cid").alias("gone"), F.col("n").alias("n2"), F.col("c").alias("c2"))
        merged = merges.join(cq, "keep").join(cp, "gone").select(
            F.col("keep").alias("cid"),
            "part",
            (F.col("n1") + F.col("n2")).alias("n"),
            F.zip_with("c1", "c2", lambda a, b: (a * F.col("n1") + b * F.col("n2")) / (F.col("n1") + F.col("n2"))).alias("c"),
        )
        touched = merges.select(F.col("keep").alias("cid")).unionByName(merges.select(F.col("gone").alias("cid")))
        clusters = _ckpt(clusters.join(touched, "cid", "left_anti").unionByName(merged))
        remap = merges.select(F.col("gone").alias("cid"), F.col("keep").alias("_new"))
        members = _ckpt(members.join(remap, "cid", "left").select("id", F.coalesce("_new", "cid").alias("cid")))
    else:
        raise RuntimeError("agglomerative rounds did not converge")
    return members.select("id", F.col("cid").alias("component"))
