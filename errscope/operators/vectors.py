"""Word vectors, sentence vectors and dimensionality reduction."""

from __future__ import annotations

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import SPACER
from ..functions.text import clean_message, tokenize_message
from .embedding import current_version, load, mean_vectors, store, train_word_vectors
from .grouping import distinct_sequences


def training_sequences(df: DataFrame, target: str = "error_message", tokenizer_type: str = "conservative") -> DataFrame:
    """Clean, distinct lines, tokenize, drop the spacer."""
    lines = distinct_sequences(df.select(clean_message(target).alias("line")), "line")
    return lines.select(F.array_remove(tokenize_message("line", tokenizer_type), SPACER).alias("tokens"))


# ------------------------------------------------------------------ word vectors
TOGETHER = 5  # passes of a chunk between two averages


def word2vec_create(df: DataFrame, tokens: str = "sequence", size: int = 300, window: int = 7, iterations: int = 10, seed: int = 42) -> DataFrame:
    """V1: word vectors (word, vec, out, n) trained on all sequences, by the mean of
    the words around a word as in the reference's library. No sequence is cut and no
    word is too rare; the rows of the vocabulary stay in tables (see embedding.py)."""
    model, _ = train_word_vectors(df, None, tokens, size=size, window=window, passes=iterations, chunk=None, seed=seed, together=TOGETHER)
    return model


def word2vec_update(spark, path: str, new: DataFrame, tokens: str = "sequence", iterations: int = 30, window: int = 7, **kw) -> DataFrame:
    """V2: go on training the model stored at ``path`` with the new sequences (a
    model is created where none is stored) and store the result as its next
    version. The texts of earlier trainings are not read again."""
    stored = None if current_version(spark, path) is None else load(spark, path)
    kw = {"chunk": None, "together": TOGETHER} | kw
    model, _ = train_word_vectors(new, stored, tokens, window=window, passes=iterations, **kw)
    store(model, path)
    return load(spark, path)


def save_model(model, path: str) -> str:
    """Persist a model by name: word vectors as the next version of a stored
    table, any other fitted model (PCA) by Spark's own writer."""
    if isinstance(model, DataFrame):
        store(model, path)
    else:
        model.write().overwrite().save(path)
    return path


def word2vec_apply(spark, path: str) -> DataFrame:
    """V3: load stored word vectors for use without training."""
    return load(spark, path)


def sentence_vectors(model: DataFrame, df: DataFrame, tokens: str = "sequence", out: str = "vector") -> DataFrame:
    """V4: mean of word vectors; unknown words count as zeros; empty -> zeros."""
    return mean_vectors(model, df, tokens, out).withColumn(out, array_to_vector(out))


def embedding_size(vocab: DataFrame, cap: int = 300):
    """V5: ``min(cap, round(sqrt(vocabulary size)))`` (round half to even) as a scalar Column."""
    n = vocab.agg(F.count("*")).scalar()
    return F.least(F.lit(cap), F.bround(F.sqrt(n), 0).cast("int"))


def vector_vocabulary_counts(df: DataFrame, tokens: str = "sequence", min_count: int = 1) -> DataFrame:
    """Word -> training count, words under ``min_count`` dropped."""
    return (
        df.select(F.explode(tokens).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("count"))
        .where(F.col("count") >= min_count)
    )


def pca_reduce(df: DataFrame, k: int, width: int, vec: str = "vector", out: str = "reduced", min_dims: int = 10):
    """V7: exact PCA to ``k`` dimensions when the vectors (of ``width``
    dimensions) are wider than ``min_dims``.

    Spark's PCA fits from the ``d x d`` covariance (bounded by the width, not
    the rows) and does not centre on transform; distances are unaffected.
    Returns (frame, fitted model or None)."""
    if width <= min_dims:
        return df.withColumn(out, F.col(vec)), None
    model = PCA(k=k, inputCol=vec, outputCol=out).fit(df.select(vec))
    return model.transform(df), model
