"""Queries for neighbour searches and density clustering."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import density as D
from ..sources import fixtures as fx
from .registry import register

K_SQL = """
WITH pts AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
kk AS (SELECT CAST(round_even(sqrt(count(*)), 0) AS BIGINT) AS k FROM pts),
dd AS MATERIALIZED (SELECT a.id AS id_q, b.id AS id_p, list_distance(a.v, b.v) AS dist FROM pts a, pts b),
knn AS (SELECT * FROM (SELECT id_q, id_p, dist, row_number() OVER (PARTITION BY id_q ORDER BY dist, id_p) AS j FROM dd)
        WHERE j <= (SELECT k FROM kk)),
curve AS (SELECT pos, avg(dist) AS x FROM (SELECT j, dist, row_number() OVER (PARTITION BY j ORDER BY dist, id_q) - 1 AS pos FROM knn) GROUP BY pos),
st AS (SELECT min(x) AS x0, max(x) AS x1, min(pos) AS y0, max(pos) AS y1, count(*) AS n FROM curve),
d AS (SELECT pos, x, (x - x0) / (x1 - x0) AS xn, (pos - y0) / (y1 - y0) - (x - x0) / (x1 - x0) AS yd FROM curve, st),
e AS (SELECT *, lag(yd) OVER (ORDER BY pos) AS yp, lead(yd) OVER (ORDER BY pos) AS ynx FROM d),
f AS (SELECT *, (coalesce(yd >= yp, true) AND coalesce(yd >= ynx, true)) AS is_max,
                (coalesce(yd <= yp, true) AND coalesce(yd <= ynx, true)) AS is_min FROM e),
g AS (SELECT *, max(CASE WHEN is_max THEN pos END) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING) AS last_max,
                max(CASE WHEN is_min THEN pos END) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING) AS last_min FROM f),
h AS (SELECT g.*, m.yd - 1.0 / ((SELECT n FROM st) - 1) AS tmx, m.x AS knee_x FROM g LEFT JOIN g m ON m.pos = g.last_max),
knee AS MATERIALIZED (SELECT coalesce((SELECT knee_x FROM h
                          WHERE pos >= (SELECT min(pos) FROM f WHERE is_max)
                            AND pos < coalesce((SELECT min(pos) FROM d WHERE xn >= 1.0), 9e18)
                            AND ynx < CASE WHEN last_min >= last_max THEN 0.0 ELSE tmx END
                          ORDER BY pos LIMIT 1), 1.0) AS eps),
pairs AS (SELECT id_q, id_p, dist FROM dd WHERE id_q <> id_p AND dist <= (SELECT eps FROM knee))
"""


def _cells(spark, sf):
    return D._ckpt(D.as_points(fx.vectors(spark, sf), "vec_id", "embedding"))


def _knn(spark, sf):
    cells = _cells(spark, sf)
    k = round(math.sqrt(cells.count()))
    return cells, D.knn(cells, k)


@register("knn_join", K_SQL + "SELECT id_q, j, id_p, round(dist, 6) AS dist FROM knn")
def q_knn_join(spark, sf):
    """k = round(sqrt(n)) nearest neighbours of every embedding, itself included."""
    _, nb = _knn(spark, sf)
    return nb.select("id_q", F.col("j").cast("long").alias("j"), "id_p", F.round("dist", 6).alias("dist"))


@register("neighbour_distance_curve", K_SQL + "SELECT pos, round(x, 6) AS distance FROM curve")
def q_neighbour_distance_curve(spark, sf):
    """W1 + V8: per sorted position, mean over the k neighbour columns."""
    _, nb = _knn(spark, sf)
    c = D.k_distance_curve(nb)
    return c.select(F.col("pos").cast("long").alias("pos"), F.round("distance", 6).alias("distance"))


@register("knee_epsilon", K_SQL + "SELECT round(eps, 6) AS epsilon FROM knee")
def q_knee_epsilon(spark, sf):
    """V9: the knee of the k-distance curve (1 when none)."""
    _, nb = _knn(spark, sf)
    eps = D.knee_epsilon(D.k_distance_curve(nb))
    return spark.range(1).select(F.round(F.lit(eps), 6).alias("epsilon"))


#: Radius of ``radius_join``: about the distance of a vector's nearest neighbours.
RADIUS = 1.1


@register(
    "radius_join",
    f"""
SELECT a.vec_id AS id_q, b.vec_id AS id_p, round(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS dist
FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
WHERE list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) <= {RADIUS}
""",
)
def q_radius_join(spark, sf):
    """All pairs of embeddings within a fixed radius (exact, over the metric tree)."""
    pairs = D.radius_join(_cells(spark, sf), RADIUS)
    return pairs.select("id_q", "id_p", F.round("dist", 6).alias("dist"))


@register(
    "dbscan",
    (K_SQL
    + """
, cc AS (
  SELECT id, id AS label FROM pts
  UNION
  SELECT p.id_p AS id, c.label FROM cc c JOIN pairs p ON p.id_q = c.id)
SELECT id, min(label) AS component FROM cc GROUP BY id
""").replace("WITH pts AS", "WITH RECURSIVE pts AS", 1),
)
def q_dbscan(spark, sf):
    """Density clusters (min samples 1) = components of the epsilon graph."""
    cells, nb = _knn(spark, sf)
    eps = D.knee_epsilon(D.k_distance_curve(nb))
    return D.dbscan(cells, eps)


@register("agglomerative")
def q_agglomerative(spark, sf):
    """Ward merging of the embeddings below linkage distance 1.0 (the
    chain's default for PCA-reduced sentence vectors is 0.1)."""
    from ..operators.agglomerative import ward_clusters

    return ward_clusters(_cells(spark, sf), 1.0)


#: Smallest cluster of ``hdbscan`` over the suppliers, of which the tables hold few.
SUPPLIERS_OF_A_CLUSTER = 5

# The hierarchy restated over sets of points: what each side of a spanning tree edge
# holds just before it merges them, which merges join two large sides, and the
# clusters from the smallest up.
HDBSCAN_SQL = f"""
WITH RECURSIVE m AS (SELECT {SUPPLIERS_OF_A_CLUSTER} AS least),
pts AS (SELECT s_suppkey AS id, CAST(s_acctbal AS DOUBLE) / 1000.0 AS x, CAST(s_nationkey AS DOUBLE) / 2.0 AS y FROM supplier),
pairs AS MATERIALIZED (
  SELECT a, b, w, row_number() OVER (ORDER BY w, a, b) AS rk FROM (
    SELECT p.id AS a, q.id AS b, sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y)) AS w FROM pts p JOIN pts q ON p.id < q.id)),
grown AS (
  SELECT 1 AS i, [min(id)] AS seen, NULL::BIGINT AS rk FROM pts
  UNION ALL
  SELECT i, list_append(seen, node), rk FROM (
    SELECT g.i + 1 AS i, g.seen, CASE WHEN list_contains(g.seen, p.a) THEN p.b ELSE p.a END AS node, p.rk, row_number() OVER (ORDER BY p.rk) AS first
    FROM grown g JOIN pairs p ON list_contains(g.seen, p.a) <> list_contains(g.seen, p.b)) WHERE first = 1),
tree AS MATERIALIZED (SELECT p.a, p.b, p.w, row_number() OVER (ORDER BY p.rk) AS r FROM pairs p WHERE p.rk IN (SELECT rk FROM grown)),
reach AS (
  SELECT r, 'a' AS side, a AS node FROM tree UNION ALL SELECT r, 'b', b FROM tree
  UNION
  SELECT s.r, s.side, CASE WHEN t.a = s.node THEN t.b ELSE t.a END FROM reach s JOIN tree t ON t.r < s.r AND (t.a = s.node OR t.b = s.node)),
held AS MATERIALIZED (SELECT * FROM reach),
sizes AS (SELECT r, count(*) FILTER (WHERE side = 'a') AS sa, count(*) FILTER (WHERE side = 'b') AS sb FROM held GROUP BY r),
nodes AS MATERIALIZED (
  SELECT r, CASE WHEN w > 0 THEN 1 / w ELSE 'inf'::DOUBLE END AS lam, sa, sb, sa + sb AS size, sa >= least AND sb >= least AS splits
  FROM tree JOIN sizes USING (r), m),
inner_top AS (
  SELECT h.r, h.side, max(t.r) AS top FROM held h JOIN tree t ON t.r < h.r AND t.a = h.node GROUP BY h.r, h.side),
tops AS MATERIALIZED (
  SELECT r AS top, NULL::BIGINT AS parent, 0.0 AS birth FROM nodes, m WHERE r = (SELECT max(r) FROM nodes) AND size >= least
  UNION ALL
  SELECT i.top, n.r, n.lam FROM nodes n JOIN inner_top i ON i.r = n.r WHERE n.splits),
of_node AS MATERIALIZED (
  SELECT n.r, min(t.top) AS cluster FROM nodes n JOIN tree e ON e.r = n.r JOIN tops t ON t.top >= n.r JOIN held h ON h.r = t.top AND h.node = e.a GROUP BY n.r),
gains AS (
  SELECT c.cluster, sum(CASE WHEN n.lam > t.birth THEN (n.lam - t.birth) * CASE WHEN n.splits THEN n.size
    ELSE CASE WHEN n.sa < least THEN n.sa ELSE 0 END + CASE WHEN n.sb < least THEN n.sb ELSE 0 END END ELSE 0.0 END) AS stability
  FROM nodes n JOIN of_node c ON c.r = n.r JOIN tops t ON t.top = c.cluster, m WHERE n.size >= least GROUP BY c.cluster),
ranked AS MATERIALIZED (
  SELECT t.top, p.cluster AS above, g.stability, row_number() OVER (ORDER BY t.top) AS k
  FROM tops t JOIN gains g ON g.cluster = t.top LEFT JOIN of_node p ON p.r = t.parent),
scored AS (
  SELECT 0::BIGINT AS k, []::DOUBLE[] AS scores, []::BOOLEAN[] AS own
  UNION ALL
  SELECT s.k + 1, list_append(s.scores, greatest(c.stability, c.below)), list_append(s.own, c.above IS NOT NULL AND c.stability >= c.below)
  FROM (SELECT s.k, s.scores, s.own, c.stability, c.above,
          coalesce((SELECT sum(s.scores[d.k]) FROM ranked d WHERE d.above = c.top), 0.0) AS below
        FROM scored s JOIN ranked c ON c.k = s.k + 1) AS c JOIN scored s ON s.k = c.k),
picked AS (SELECT r.top FROM ranked r, (SELECT own FROM scored ORDER BY k DESC LIMIT 1) WHERE own[r.k]),
label AS (SELECT p.id, max(k.top) AS kept FROM pts p LEFT JOIN held h ON h.node = p.id LEFT JOIN picked k ON k.top = h.r GROUP BY p.id)
SELECT id, min(id) OVER (PARTITION BY kept) AS component, kept IS NULL AS noise FROM label
"""


@register("hdbscan", HDBSCAN_SQL)
def q_hdbscan(spark, sf):
    """Hierarchical density clusters of the suppliers by balance and nation."""
    from ..operators.hdbscan import hdbscan
    from ..sources.tables import read_table

    x = F.col("s_acctbal").cast("double") / 1000.0
    y = F.col("s_nationkey").cast("double") / 2.0
    points = read_table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.array(x, y).alias("vec"))
    return hdbscan(points, SUPPLIERS_OF_A_CLUSTER)
