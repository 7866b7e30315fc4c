"""Queries for the vector path."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import embedding as E
from ..operators import grouping as G
from ..operators import similarity as S
from ..operators import tokens as K
from ..operators import vectors as V
from ..session import scratch_path
from ..sources import fixtures as fx
from .duck import prefixed, sequences_ctes, with_fixtures
from .registry import register

MSG_GROUPS_SQL = with_fixtures("messages", extra=sequences_ctes("messages")) + """
, groups AS (SELECT hash, count(*) AS cluster_size, arg_min(sequence, msg_id) AS sequence FROM seqs GROUP BY hash)
"""


def message_groups(spark, sf):
    return G.group_equal_messages(G.prepare_sequences(fx.messages(spark, sf)))


@register(
    "word2vec_create",
    MSG_GROUPS_SQL + "SELECT DISTINCT t AS word, 300::BIGINT AS dims FROM (SELECT unnest(sequence) AS t FROM groups)",
)
def q_word2vec_create(spark, sf):
    """V1: the trained vocabulary (every token of the group sequences) and the vector width."""
    model = V.word2vec_create(message_groups(spark, sf))
    return model.select("word", F.size("vec").cast("long").alias("dims"))


@register(
    "vector_vocabulary_counts",
    MSG_GROUPS_SQL + "SELECT t AS word, count(*)::BIGINT AS count FROM (SELECT unnest(sequence) AS t FROM groups) GROUP BY t",
)
def q_vector_vocabulary_counts(spark, sf):
    """Word -> training count over the group sequences."""
    c = V.vector_vocabulary_counts(message_groups(spark, sf))
    return c.select("word", F.col("count").cast("long").alias("count"))


@register(
    "embedding_size",
    MSG_GROUPS_SQL
    + "SELECT least(300, round_even(sqrt(count(DISTINCT t)), 0))::INTEGER AS embedding_size FROM (SELECT unnest(sequence) AS t FROM groups)",
)
def q_embedding_size(spark, sf):
    """V5."""
    vocab = K.vocabulary(message_groups(spark, sf), "sequence")
    return spark.range(1).select(V.embedding_size(vocab).alias("embedding_size"))


@register(
    "sentence_vectors",
    MSG_GROUPS_SQL + "SELECT hash, len(sequence) = 0 AS is_zero FROM groups",
)
def q_sentence_vectors(spark, sf):
    """V4: mean word vectors; a group is the zero vector exactly when its sequence is empty."""
    groups = S._ckpt(message_groups(spark, sf))
    model = V.word2vec_create(groups)
    sv = V.sentence_vectors(model, groups)
    return sv.select("hash", F.forall(vector_to_array("vector"), lambda x: x == 0).alias("is_zero"))


@register(
    "mean_vectors",
    MSG_GROUPS_SQL
    + """
, toks AS (SELECT hash, len(sequence) AS n, unnest(sequence) AS t FROM groups),
known AS (SELECT vec_id, embedding FROM embeddings),
met AS (SELECT hash, n, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS d FROM toks LEFT JOIN known ON vec_id = length(t)),
sums AS (SELECT hash, n, d, sum(CAST(x AS DOUBLE)) / n AS x FROM met WHERE d <= 3 GROUP BY hash, n, d)
SELECT g.hash, d.d::INTEGER AS place, coalesce(round(s.x, 6), 0.0) AS x
FROM groups g CROSS JOIN (SELECT unnest([1, 2, 3]) AS d) d LEFT JOIN sums s ON s.hash = g.hash AND s.d = d.d
""",
)
def q_mean_vectors(spark, sf):
    """V3 + V4: a stored model (the vector of a word is the embedding numbered by its
    length) is loaded, and gives every group the mean of its words; its first three numbers."""
    groups = S._ckpt(message_groups(spark, sf))
    words = K.vocabulary(groups, "sequence").select(F.col("token").alias("word"), F.length("token").cast("long").alias("vec_id"))
    vectors = fx.vectors(spark, sf).select("vec_id", F.col("embedding").alias("vec"))
    path = scratch_path(spark, "named-vectors")
    E.store(words.join(vectors, "vec_id").select("word", "vec"), path)
    means = E.mean_vectors(E.load(spark, path), groups)
    each = means.select("hash", F.posexplode(F.slice("vector", 1, 3)).alias("place", "x"))
    return each.select("hash", (F.col("place") + 1).alias("place"), (F.round("x", 6) + 0.0).alias("x"))


@register(
    "word2vec_update",
    MSG_GROUPS_SQL
    + ", "
    + prefixed(sequences_ctes("turn_rows"), "t_").replace("t_cleaned AS (", f"turn_rows AS ({fx.TURNS_SQL}), t_cleaned AS (", 1)
    + """
SELECT DISTINCT word FROM (SELECT unnest(sequence) AS word FROM groups UNION ALL SELECT unnest(sequence) AS word FROM t_seqs)
""",
)
def q_word2vec_update(spark, sf):
    """V2: the model of the prose groups is stored, the turn groups go on training it; the vocabulary is that of both."""
    path = scratch_path(spark, "word-vectors")
    groups = S._ckpt(message_groups(spark, sf))
    E.store(V.word2vec_create(groups), path)
    turns = G.group_equal_messages(G.prepare_sequences(fx.turns(spark, sf)))
    return V.word2vec_update(spark, path, turns).select("word")


@register("word2vec_apply")
def q_word2vec_apply(spark, sf):
    """S14 + V3: store the model by name, load it and vectorise without training."""
    groups = S._ckpt(message_groups(spark, sf))
    path = V.save_model(V.word2vec_create(groups), scratch_path(spark, "word2vec.model"))
    model = V.word2vec_apply(spark, path)
    return V.sentence_vectors(model, groups).select("hash", vector_to_array("vector").alias("vector"))


@register("pca_reduce")
def q_pca_reduce(spark, sf):
    """V7: sentence vectors reduced to the V5 width (bounded by the vector width)."""
    groups = S._ckpt(message_groups(spark, sf))
    model = V.word2vec_create(groups)
    sv = V.sentence_vectors(model, groups)
    k = spark.range(1).select(V.embedding_size(K.vocabulary(groups, "sequence"))).first()[0]
    red, _ = V.pca_reduce(sv, int(k), E.width(model) or 0)
    return red.select("hash", vector_to_array("reduced").alias("reduced"))


@register("document_vectors")
def q_document_vectors(spark, sf):
    """V6: a trained vector of every group (paragraph vectors of 50 numbers, 5 passes)."""
    docs, _, _ = E.train_document_vectors(message_groups(spark, sf), "hash", size=50, passes=5)
    return docs

