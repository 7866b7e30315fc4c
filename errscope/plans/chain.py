"""C1 ``cluster_messages``: the whole chain as one DataFrame job.

tokenize -> clean -> drop rare tokens -> hash -> group equal messages, then
leader clustering (``clustering_type`` SIMILARITY) or the vector path (ML: word
vectors, PCA, density clustering). The setting alone chooses, whatever the
number of groups. Every step keeps the optional ``by`` key columns, so several
sites are clustered in one job (C3). Patterns are mined in two levels: one per
group of equal messages, then one per cluster from those of its groups.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import grouping as G
from ..operators import patterns as PT
from ..operators import similarity as S
from ..operators.ordering import global_row_number

PIECE = 100_000  # ids or phrases that a row of a regrouped cluster holds


@dataclass
class ChainSettings:
    tokenizer_type: str = "conservative"
    matching_accuracy: float = 0.8
    clustering_type: str = "SIMILARITY"  # or "ML"
    algorithm: str = "dbscan"  # dbscan | hdbscan | hierarchical
    epsilon: float | None = None  # radius of dbscan; None: the knee of the k-distance curve
    add_placeholder: bool = False
    min_count: int = 2  # tokens seen fewer times are dropped before hashing
    w2v_size: int = 300
    w2v_window: int = 7
    w2v_iterations: int = 10
    mode: str = "create"  # create | update | process
    model_path: str | None = None
    phrases_as_array: bool = False
    extra: dict = field(default_factory=dict)


@dataclass
class ChainRun:
    clusters: DataFrame  # one row per cluster
    bridge: DataFrame  # (by..., msg_id, hash, cluster_key)
    groups: DataFrame  # one row per group of equal messages, with cluster_key
    phrases: DataFrame | None  # (by..., cluster_key, phrase, score)
    strategy: str  # 'Levenshtein' or the model name


def _check(st: ChainSettings) -> None:
    if st.clustering_type.upper() not in ("SIMILARITY", "ML"):
        raise ValueError(f"unknown clustering type {st.clustering_type!r}")
    if st.algorithm not in ("dbscan", "hdbscan", "hierarchical"):
        raise ValueError(f"unknown algorithm {st.algorithm!r}; there are dbscan, hdbscan and hierarchical")
    if st.mode not in ("create", "update", "process"):
        raise ValueError(f"unknown mode {st.mode!r}")
    if st.mode in ("update", "process") and not st.model_path:
        raise ValueError(f"mode {st.mode} needs a model_path")


def cluster_messages(
    df: DataFrame,
    target: str = "error_message",
    id_col: str = "msg_id",
    by: tuple = (),
    settings: ChainSettings | None = None,
    with_patterns: bool = True,
) -> ChainRun:
    """C1. ``df`` needs ``id_col`` (a stable message id, Q1), ``target`` and ``by`` columns."""
    st = settings or ChainSettings()
    _check(st)
    by = tuple(by)
    seqs = S._ckpt(G.prepare_sequences(df, target, id_col, by, st.min_count))
    groups = S._ckpt(G.group_equal_messages(seqs, id_col, by))
    if st.clustering_type.upper() == "SIMILARITY":
        assigned = S.leader_clustering(groups, st.matching_accuracy, by=by).withColumnRenamed("leader", "cluster_key")
        strategy = "Levenshtein"
    else:
        from .vector_chain import vector_clusters

        assigned, strategy = vector_clusters(groups, st, by)
    assigned = S._ckpt(assigned)
    bridge = seqs.select(*by, id_col, "hash").join(assigned.select(*by, "hash", "cluster_key"), [*by, "hash"])
    clusters = assigned.groupBy(*by, "cluster_key").agg(
        F.sum("cluster_size").cast("long").alias("cluster_size"), F.count("*").alias("n_groups")
    )
    clusters = clusters.withColumn("cluster_id", X.cluster_uuid(F.concat_ws("|", *[F.col(c).cast("string") for c in by], "cluster_key")))
    phrases = None
    if with_patterns:
        keys = [*by, "cluster_key"]
        tok = seqs.select(*by, id_col, "hash").join(df.select(*by, id_col, X.tokenize_message(target, st.tokenizer_type).alias("tk")), [*by, id_col])
        per_group = G.group_patterns(tok, by=by, add_placeholder=st.add_placeholder).select(*by, "hash", "tokenized_pattern")
        levels = assigned.select(*keys, "hash", "cluster_size").join(per_group, [*by, "hash"])
        pat = PT.common_pattern(levels, keys, "tokenized_pattern", weight="cluster_size", add_placeholder=st.add_placeholder)
        pat = pat.select(
            *keys,
            F.col("pattern").alias("tokenized_pattern"),
            X.collapse_placeholders(X.detokenize_pattern("pattern")).alias("pattern"),
        )
        seq_pat = PT.common_pattern(assigned, keys, "sequence", weight="cluster_size").withColumnRenamed("pattern", "sequence")
        phrases = PT.common_phrases(assigned, keys, "sequence")
        clusters = clusters.join(pat, keys, "left").join(seq_pat, keys, "left")
        if st.phrases_as_array:
            clusters = clusters.join(PT.phrases_array(phrases, keys), keys, "left")
    return ChainRun(clusters, bridge, assigned, phrases, strategy)


def _in_pieces(df: DataFrame, keys: list, order: list, value: str, out: str, most: int) -> DataFrame:
    """(keys..., piece, out): the values of each key in their order, ``most`` in a row."""
    numbered = global_row_number(df, [*keys, *order], "_at")
    starts = numbered.groupBy(*keys).agg(F.min("_at").alias("_start"))
    place = F.col("_at") - F.col("_start")
    pieces = numbered.join(starts, keys).select(*keys, F.floor(place / F.lit(most)).cast("int").alias("piece"), place.alias("_at"), value)
    held = pieces.groupBy(*keys, "piece").agg(F.sort_array(F.collect_list(F.struct("_at", value))).alias("_l"))
    return held.select(*keys, "piece", F.col(f"_l.{value}").alias(out))


def regrouped(run: ChainRun, by: tuple = (), id_col: str = "msg_id", most: int = PIECE) -> DataFrame:
    """Per label its patterns, sequence, size, the ids of its messages (rising) and
    its key phrases (best first).

    A label with more than ``most`` ids or phrases goes on in further rows (``piece`` 1,
    2, ...), so that no row follows the size of a cluster."""
    if run.phrases is None:
        raise ValueError("a run without patterns has nothing to regroup")
    keys = [*by, "cluster_key"]
    ids = _in_pieces(run.bridge.select(*keys, id_col), keys, [id_col], id_col, "ids", most)
    best = run.phrases.select(*keys, (-F.col("score")).alias("_worse"), "phrase")
    phrases = _in_pieces(best, keys, ["_worse", "phrase"], "phrase", "common_phrases", most)
    total = run.bridge.groupBy(*keys).agg(F.count("*").alias("n_ids"))
    pieces = ids.join(phrases, [*keys, "piece"], "full")
    out = run.clusters.join(total, keys).join(pieces, keys)
    return out.withColumns({
        "ids": F.coalesce("ids", F.array().cast(ids.schema["ids"].dataType)),
        "common_phrases": F.coalesce("common_phrases", F.array().cast("array<string>")),
    })
