"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns the rows that the next one
gets; all but the last keep the columns of ``documents``. ``run`` writes each
result below ``spark.checkpoint.dir`` and reads it back.

1. toxicity: documents that the classifier rejects go.
2. line dedup: repeated long lines stay in one document only.
3. near dedup: one document of each class of near-duplicates stays.
4. mixing: documents are repeated at the rates that reach the target weights;
   rates are at least 1, so no document is lost.
5. packing: pieces of at most 2048 tokens in as few sequences as possible.

An empty table passes through all stages; nulls, repeated rows and very long
texts are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from errscope.llm import settings
from errscope.llm.best_fit_packing import best_fit_packing
from errscope.llm.common import in_fold, materialise, table
from errscope.llm.line_dedup import line_dedup
from errscope.llm.mixing import mixed, mixing_rates
from errscope.llm.near_dedup import keep_one
from errscope.llm.toxicity import toxicity, train_toxicity

ORACLE_SQL = None


def _numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under column names that no operator uses, and the new name of each column."""
    name = {c: f"_column{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*name.values()), name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic. It learns from the
    same four fifths of the labels as query op5."""
    labels = table(spark, sf_dir, "labels").where(~in_fold(F.col("doc_id"), 0))
    model = train_toxicity(docs, labels)
    plain, name = _numbered(docs)
    scored = toxicity(plain, model, name["text"])
    return scored.where("predicted = 0").select(*plain.columns).toDF(*docs.columns)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that others keep; ``n_chars`` follows the text."""
    plain, name = _numbered(docs)
    out = line_dedup(plain, name["doc_id"], name["text"])
    if "n_chars" in docs.columns:
        out = out.withColumn(name["n_chars"], F.length(name["text"]).cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*plain.columns).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated at their rates towards the target weights."""
    plain, name = _numbered(docs)
    rated, _ = mixing_rates(plain, table(spark, sf_dir, "labels"), settings.MIX_WEIGHTS, name["doc_id"], name["text"], label_id_col="doc_id", least_rate=1.0)
    return mixed(rated, plain.columns).toDF(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences."""
    return best_fit_packing(docs, settings.packing_tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_common_lines),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
