"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import settings
from .ann_search import ann_search
from .best_fit_packing import best_fit_packing
from .collocations import collocations
from .common import in_fold, table
from .exact_dedup import exact_dedup
from .hard_negatives import hard_negatives
from .html_text import extract_text
from .license_scan import license_scan
from .line_dedup import line_dedup
from .lm_scoring import lm_scoring
from .mixing import mixing_rates
from .near_dedup import near_duplicates
from .ngram_join import ngram_join
from .toxicity import toxicity, train_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def register(name: str, oracle: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return keep


@register(
    "op1_exact_dedup",
    f"""
    with h as (select doc_id, sha256({_LOWER}) as text_sha256 from documents),
    g as (select text_sha256, max(doc_id) as keep_id, count(*) as group_size from h group by text_sha256)
    select h.doc_id, g.keep_id, g.group_size, h.doc_id = g.keep_id as kept, h.text_sha256
    from h join g on h.text_sha256 = g.text_sha256
    """,
)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup(table(spark, sf_dir, "documents"), digest_col="text_sha256")
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@register("op2_html_extraction")
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


@register("op3_best_fit_packing")
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"), settings.packing_tokenizer())


@register("op4_license_scan")
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).drop("spans")


@register("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = in_fold(F.col("doc_id"), 0)
    labels = table(spark, sf_dir, "labels").where(~held_out)
    model = train_toxicity(docs, labels)
    return toxicity(docs, model, keep=["doc_id"]).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@register("op6_source_mixing")
def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated, mixture = mixing_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), settings.MIX_WEIGHTS, keep=["doc_id"])
    domains = F.array(*[F.lit(None if d is None else str(d)).cast("string") for d in mixture.domains])
    return rated.select("doc_id", "n_tokens", domains.alias("domains"), "posterior", "rate", "copies")


@register("op7_lm_scoring")
def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = in_fold(F.col("doc_id"), 1)
    return lm_scoring(docs, ~held_out).withColumn("held_out", held_out)


@register("op8_ann_search")
def op8_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@register(
    "op9_line_dedup",
    r"""
    with texts as (select doc_id, row_number() over () as r, string_split(coalesce(text, ''), chr(10)) as parts from documents),
    lines as (
      select doc_id, r, pos, line, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') as core
      from (select doc_id, r, unnest(generate_series(1, len(parts))) as pos, unnest(parts) as line from texts)
    ), keyed as (
      select *, case when length(core) >= 40
        then translate(core, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') end as key
      from lines
    ), common as (
      select key, max(doc_id) as owner from keyed where key is not null group by key
      having count(distinct doc_id) + count(distinct case when doc_id is null then r end) >= 5
    ), marked as (
      select k.*, c.key is not null and k.doc_id is distinct from c.owner as dropped from keyed k left join common c on k.key = c.key
    )
    select doc_id, count(*) as n_lines, cast(sum(case when dropped then 1 else 0 end) as bigint) as n_dropped,
      sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
    from marked group by doc_id, r
    """,
)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@register("op10_near_dedup")
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@register(
    "op11_hard_negatives",
    """
    with v as (
      select vec_id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as bigint) as label,
        [floor(256 * cast(x as double)) for x in embedding] as vec
      from embeddings
      where vec_id is not null and label is not null and embedding is not null
        and len([x for x in embedding if x is null or not isfinite(x)]) = 0
    ), pairs as (
      select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, cast(list_dot_product(a.vec, c.vec) as bigint) as score
      from v a join v c on a.vec_id <> c.vec_id where a.vec_id % 100 = 0
    ), positives as (
      select anchor_id, vec_id as positive_id, score as positive_score from pairs where same
      qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
    )
    select anchor_id, positive_id, cast(row_number() over w as int) as rank, vec_id as negative_id, positive_score, score as negative_score
    from positives join pairs using (anchor_id)
    where not same and 80 * positive_score <= 100 * score and score <= positive_score
    window w as (partition by anchor_id, positive_id order by score desc, vec_id)
    qualify row_number() over w <= 5
    """,
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, with the labels of every seventh shifted."""
    label = F.col("label").cast("long")
    relabel = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, relabel)


@register(
    "op12_ngram_join",
    rf"""
    with recursive words as (select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
    sets as (
      select doc_id, unnest(list_distinct([array_to_string(w[i:i+4], ' ') for i in range(1, greatest(len(w) - 4, 1) + 1)])) as g
      from words where len(w) > 0
    ), sizes as (select w.doc_id, count(s.g) as n from words w left join sets s using (doc_id) group by w.doc_id),
    shared as (select a.doc_id as a, b.doc_id as b, count(*) as k from sets a join sets b on a.g = b.g and a.doc_id < b.doc_id group by all),
    links as (
      select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)
    ), both_ways as (select a, b from links union all select b, a from links),
    reach as (
      select doc_id, doc_id as label from words
      union
      select b, label from reach join both_ways on a = doc_id
    )
    select doc_id, n as n_shingles, min(label) as component_id from reach join sizes using (doc_id) group by doc_id, n
    """,
)
def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of five-word shingles are at least 0.8 similar."""
    return ngram_join(table(spark, sf_dir, "documents"))


@register(
    "op13_collocations",
    rf"""
    with pieces as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) as piece from documents),
    words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
    grams as (
      select lang, k, unnest([array_to_string(w[i:i+k-1], ' ') for i in range(1, len(w) - k + 2)]) as phrase
      from words, (select unnest([1, 2, 3, 4, 5]) as k) where len(w) >= k
    ), f as (select lang, k, phrase, count(*) as a from grams group by all),
    totals as (select lang, cast(sum(a) as bigint) as n from f where k = 1 group by lang),
    found as (select lang, k, phrase, a, string_split(phrase, ' ') as w from f where k > 1 and a >= 100),
    parts as (
      select lang, a as most, unnest(flatten([[array_to_string(w[i:i+m-1], ' ') for i in range(1, k - m + 2)] for m in range(2, k)])) as phrase
      from found where k > 2
    ), inside as (select lang, phrase, max(most) as most from parts group by all),
    kept as (select found.* from found left join inside using (lang, phrase) where most is null or 100 * most < 100 * a),
    cuts as (select *, unnest(range(1, k)) as j from kept),
    scored as (
      select c.lang, c.phrase, c.a, c.j, l.a as l, r.a as r, n, cast((1000::hugeint * c.a * n) // (l.a::hugeint * r.a) as bigint) as score
      from cuts c
      join f l on l.lang = c.lang and l.phrase = array_to_string(c.w[1:c.j], ' ')
      join f r on r.lang = c.lang and r.phrase = array_to_string(c.w[c.j+1:], ' ')
      join totals on totals.lang = c.lang
    ), weakest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, j) = 1)
    select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
    from weakest qualify rank <= 2000
    """,
)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of two to five words of each language."""
    return collocations(table(spark, sf_dir, "documents"))
