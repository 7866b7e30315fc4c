"""Term weighting (F1-F9, O4) as aggregations over a long (doc, term) table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import PLACEHOLDER
from .tokens import explode_tokens, reassemble


def doc_term_counts(docs: DataFrame, doc_col: str, tokens: str) -> DataFrame:
    """(doc, term, count)."""
    return docs.select(doc_col, F.explode(tokens).alias("term")).groupBy(doc_col, "term").agg(F.count("*").alias("count"))


def term_tf(counts: DataFrame, doc_col: str) -> DataFrame:
    """count / number of distinct terms of the document."""
    n_terms = counts.groupBy(doc_col).agg(F.count("*").alias("_nt"))
    return counts.join(n_terms, doc_col).withColumn("tf", F.col("count") / F.col("_nt")).drop("_nt")


def document_frequency(counts: DataFrame) -> DataFrame:
    """documents per term."""
    return counts.groupBy("term").agg(F.count("*").alias("df"))


def term_idf(dfreq: DataFrame, n_docs) -> DataFrame:
    """log10(N / df); ``n_docs`` is a number or a scalar Column."""
    n = n_docs if isinstance(n_docs, F.Column) else F.lit(n_docs)
    return dfreq.withColumn("idf", F.log10(n.cast("double") / F.col("df")))


def tf_idf(docs: DataFrame, doc_col: str, tokens: str) -> DataFrame:
    """(doc, term, count, tf, df, idf, tfidf). N = number of input documents."""
    # rows are placed by document before they are exploded: the counts per
    # (document, term) and per document then need no further exchange
    counts = doc_term_counts(docs.select(doc_col, tokens).repartition(doc_col), doc_col, tokens)
    n_docs = docs.agg(F.count("*")).scalar()
    tf = counts.withColumn("tf", F.col("count") / F.count("*").over(Window.partitionBy(doc_col)))
    idf = term_idf(document_frequency(counts), n_docs)
    return tf.join(idf, "term").withColumn("tfidf", F.col("tf") * F.col("idf"))


def mask_heavy_terms(docs: DataFrame, doc_col: str, tokens: str, weights: DataFrame, out: str = "masked") -> DataFrame:
    """per document, token positions whose weight >= mean + population std
    (over the positions) become the placeholder token."""
    ex = explode_tokens(docs, tokens, [doc_col]).join(
        weights.select(doc_col, F.col("term").alias("token"), "tfidf"), [doc_col, "token"]
    )
    stats = ex.groupBy(doc_col).agg((F.avg("tfidf") + F.stddev_pop("tfidf")).alias("_top"))
    marked = ex.join(stats, doc_col).withColumn(
        "_t", F.when(F.col("tfidf") >= F.col("_top"), F.lit(PLACEHOLDER)).otherwise(F.col("token"))
    )
    rebuilt = reassemble(marked, [doc_col], "_m", token_col="_t")
    return docs.join(rebuilt, doc_col, "left").withColumn(out, F.coalesce("_m", F.array().cast("array<string>"))).drop("_m")


def tfidf_normalised(docs: DataFrame, doc_col: str, tokens: str) -> DataFrame:
    """F8: raw count x log2(N / df), L2-normalised per document; zero weights dropped."""
    return tfidf_apply(docs, doc_col, tokens, tfidf_model(docs, doc_col, tokens))


def tfidf_model(docs: DataFrame, doc_col: str, tokens: str) -> DataFrame:
    """(term, df, n_docs): what F8 learns from a corpus. ``embedding.store`` and
    ``load`` keep it as a versioned table (S14)."""
    n_docs = docs.agg(F.count("*")).scalar()
    return document_frequency(doc_term_counts(docs, doc_col, tokens)).withColumn("n_docs", n_docs)


def tfidf_apply(docs: DataFrame, doc_col: str, tokens: str, model: DataFrame) -> DataFrame:
    """F8 with the frequencies of a model: (doc, term, weight) of documents that
    its corpus need not hold. Terms that the model doesn't know have no weight."""
    counts = doc_term_counts(docs, doc_col, tokens)
    idf = F.log2(F.col("n_docs").cast("double") / F.col("df"))
    w = counts.join(model, "term").withColumn("_w", F.col("count") * idf).where(F.abs(F.col("_w")) > 1e-12)
    norm = w.groupBy(doc_col).agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_norm"))
    return w.join(norm, doc_col).select(doc_col, "term", (F.col("_w") / F.col("_norm")).alias("weight"))


WORD_RUN = r"[\p{L}\p{N}_]+"


def site_tfidf(site_docs: DataFrame, site_col: str, text_col: str) -> DataFrame:
    """one document per site; lower-cased words of >= 2 characters, raw
    counts, smoothed idf ln((1+N)/(1+df)) + 1, L2 norm per site.

    ``site_docs`` may hold many rows per site (e.g. one per group sequence):
    words never span rows, so counting per row and summing per site equals
    counting the site's concatenated text, without building that text."""
    words = site_docs.select(
        site_col, F.explode(F.regexp_extract_all(F.lower(text_col), F.lit(WORD_RUN), 0)).alias("term")
    ).where(F.length("term") >= 2)
    counts = words.groupBy(site_col, "term").agg(F.count("*").alias("count"))
    n_docs = site_docs.select(site_col).distinct().agg(F.count("*")).scalar()
    dfreq = document_frequency(counts)
    idf = F.log((1 + n_docs.cast("double")) / (1 + F.col("df"))) + 1
    w = counts.join(dfreq, "term").withColumn("_w", F.col("count") * idf)
    norm = w.groupBy(site_col).agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_norm"))
    return w.join(norm, site_col).select(site_col, "term", (F.col("_w") / F.col("_norm")).alias("weight"))


def top_terms(weights: DataFrame, n: int = 10, site_col: str | None = None, site=None) -> DataFrame:
    """Terms by descending weight (tie: term)."""
    w = weights.where(F.col(site_col) == site) if site_col is not None else weights
    return w.orderBy(F.col("weight").desc(), F.col("term")).limit(n)
