"""Vector path of C1: word vectors -> sentence vectors -> PCA -> density clusters."""

from __future__ import annotations

import math

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import density as D
from ..operators import embedding as E
from ..operators import tokens as K
from ..operators import vectors as V
from ..session import scratch_path


def _model(groups: DataFrame, st) -> DataFrame:
    """The table of word vectors that the run uses; a trained one is stored under ``model_path``."""
    spark = groups.sparkSession
    if st.mode == "process":
        return E.load(spark, st.model_path)
    if st.mode == "update":
        return V.word2vec_update(spark, st.model_path, groups, size=st.w2v_size, window=st.w2v_window)
    model = V.word2vec_create(groups, size=st.w2v_size, window=st.w2v_window, iterations=st.w2v_iterations)
    path = st.model_path or scratch_path(spark, "word2vec.model")
    E.store(model, path)
    return E.load(spark, path)


def vector_clusters(groups: DataFrame, st, by=()):
    """Label every group; returns (groups + cluster_key, model name).

    With ``by`` keys the word vectors are shared; the searches and clusters stay
    within a key, and the epsilon is one for the whole run."""
    model = _model(groups, st)
    size = E.width(model) or st.w2v_size
    sv = V.sentence_vectors(model, groups)
    k = groups.sparkSession.range(1).select(V.embedding_size(K.vocabulary(groups, "sequence"), cap=st.w2v_size)).first()[0]
    red, _ = V.pca_reduce(sv, max(1, int(k)), size)
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in by]) if by else F.lit("")
    cells = D._ckpt(red.select(F.concat_ws("|", key, "hash").alias("id"), key.alias("part"), vector_to_array("reduced").alias("vec"), *by, "hash"))
    points = cells.select("id", "part", "vec")
    if st.algorithm == "hierarchical":
        from ..operators.agglomerative import ward_clusters

        labels = ward_clusters(points, threshold=st.extra.get("distance_threshold", 0.1))
    elif st.algorithm == "hdbscan":
        from ..operators.hdbscan import hdbscan

        labels = hdbscan(points, st.extra.get("min_cluster_size", 100)).select("id", "component")
    else:
        eps = st.epsilon
        if eps is None:
            nb = D.knn(points, max(1, round(math.sqrt(cells.count()))))
            eps = D.knee_epsilon(D.k_distance_curve(nb))
        labels = D.dbscan(points, eps)
    names = cells.select("id", F.col("hash").alias("cluster_key"))
    labelled = cells.select("id", *by, "hash").join(labels, "id").join(names.withColumnRenamed("id", "component"), "component")
    out = groups.join(labelled.select(*by, "hash", "cluster_key"), [*by, "hash"])
    return out, (st.model_path or "word2vec.model")
