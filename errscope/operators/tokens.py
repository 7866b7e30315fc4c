"""Token statistics and token-level rewrites (A2, A3, T3/J8, J9, token codes)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import keep_alpha_tokens, lower_tokens
from ..session import written


def explode_tokens(df: DataFrame, tokens: str, keys: Sequence[str]) -> DataFrame:
    """(keys..., pos, token): one row per token occurrence."""
    return df.select(*keys, F.posexplode(tokens).alias("pos", "token"))


def term_frequency(df: DataFrame, tokens: str, by: Sequence[str] = ()) -> DataFrame:
    """A2: total occurrences of each token (partial aggregation absorbs hot tokens)."""
    return df.select(*by, F.explode(tokens).alias("token")).groupBy(*by, "token").agg(F.count("*").alias("frequency"))


def vocabulary(df: DataFrame, tokens: str, by: Sequence[str] = ()) -> DataFrame:
    """A3: distinct tokens."""
    return df.select(*by, F.explode(tokens).alias("token")).distinct()


def reassemble(exploded: DataFrame, keys: Sequence[str], out: str, token_col: str = "token") -> DataFrame:
    """Inverse of ``explode_tokens``: one ordered array per key (bounded by the row's own length)."""
    return exploded.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("pos", F.col(token_col).alias("t")))).alias("_pt")
    ).select(*keys, F.col("_pt.t").alias(out))


def frequent_token_sequences(
    df: DataFrame, tokens: str, id_col: str, by: Sequence[str] = (), min_count: int = 2, out: str = "sequence"
) -> DataFrame:
    """(by..., id, out): tokens whose corpus count is >= ``min_count``, in order.

    The tokens are written once, as both the count and the filter read them.
    With ``min_count`` 2 a rare token occurs once, so the count by token also
    tells in which row it stands: only rare tokens go back to their rows, whose
    arrays are filtered. Above 2 the frequent tokens are marked by a join and
    the rows reassembled. Every row must hold at least one token."""
    keys = [*by, id_col]
    if min_count <= 1:
        return df.select(*keys, F.col(tokens).alias(out))
    df = written(df.select(*keys, tokens), "tokens")
    if min_count == 2:
        return _without_rare(df, tokens, keys, by, id_col, out).select(*keys, out)
    ex = explode_tokens(df, tokens, keys)
    frequent = (
        term_frequency(df, tokens, by).where(F.col("frequency") >= min_count).select(*by, "token", F.lit(True).alias("_keep"))
    )
    marked = ex.join(frequent, [*by, "token"], "left")
    kept = F.when(F.col("_keep"), F.struct("pos", F.col("token").alias("t")))
    return marked.groupBy(*keys).agg(F.sort_array(F.collect_list(kept)).alias("_pt")).select(*keys, F.col("_pt.t").alias(out))


def _without_rare(df: DataFrame, tokens: str, keys: Sequence[str], by: Sequence[str], id_col: str, out: str) -> DataFrame:
    """``df`` with its tokens that occur once in all left out of ``out``."""
    ex = df.select(*keys, F.explode(tokens).alias("token"))
    once = ex.groupBy(*by, "token").agg(F.count("*").alias("_n"), F.min(id_col).alias(id_col)).where("_n = 1")
    rare = once.groupBy(*keys).agg(F.collect_list("token").alias("_rare"))
    kept = F.when(F.col("_rare").isNull(), F.col(tokens)).otherwise(F.filter(tokens, lambda t: ~F.array_contains("_rare", t)))
    return df.join(rare, list(keys), "left").withColumn(out, kept).drop("_rare")


def drop_rare_tokens(
    df: DataFrame, tokens: str, id_col: str, by: Sequence[str] = (), min_count: int = 2, out: str | None = None
) -> DataFrame:
    """T3 (with J8): keep tokens whose total count over the corpus is >= ``min_count``.

    Order is kept; a row whose tokens are all rare (or that has none) keeps an
    empty array (Q19)."""
    out = out or tokens
    keys = [*by, id_col]
    empty = F.array().cast("array<string>")
    if min_count == 2:
        return _without_rare(written(df, "tokens"), tokens, keys, by, id_col, out).withColumn(out, F.coalesce(out, empty))
    rebuilt = frequent_token_sequences(df, tokens, id_col, by, min_count, "_kept")
    return df.join(rebuilt, keys, "left").withColumn(out, F.coalesce(F.col("_kept"), empty)).drop("_kept")


LONG = 2_000  # tokens of a row from which on it is taken apart by position


def vocabulary_semi_join(df: DataFrame, tokens: str | Column, id_col: str, vocab: DataFrame, out: str | None = None) -> DataFrame:
    """Keep tokens whose lower-case form is in ``vocab(token)``; order kept.

    ``tokens`` is a column, or an expression: then rows cross the network as they are in
    ``df`` and are split into tokens afterwards. Each distinct token of a row goes to the
    vocabulary once; those that are not met come back to their row, whose array is
    filtered. Rows that share an id are one text, and as long ones are taken
    apart by position and reassembled.

    The vocabulary is written first: an aggregation right below the join would keep
    Spark from splitting the partitions that very common tokens fill."""
    out = out or tokens
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    words = written(vocab.select(F.col("token").alias("_low")).distinct(), "words")
    shared = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n"), F.max(F.size(tokens)).alias("_size")).where(F.col(id_col).isNotNull())
    apart = written(shared.where((F.col("_n") > 1) | (F.col("_size") > LONG)).select(id_col), "apart")
    some = not apart.isEmpty()
    rows = df.join(apart, id_col, "left_anti") if some else df
    lows = F.array_distinct(F.transform(tokens, lambda t: F.lower(t)))
    each = rows.where(F.col(id_col).isNotNull()).select(id_col, F.explode(lows).alias("_low"))
    missed = each.join(words, "_low", "left_anti").groupBy(id_col).agg(F.collect_list("_low").alias("_missed"))
    none = F.array().cast("array<string>")
    # a lambda may hold plain columns only: an expression would be evaluated for each token
    kept = F.filter(tokens, lambda t: t.isNotNull() & ~F.coalesce(F.array_contains("_missed", F.lower(t)), F.lit(False)))
    met = rows.join(missed, id_col, "left")
    found = met.withColumn(out, F.when(F.col(id_col).isNotNull(), F.coalesce(kept, none)).otherwise(none)).drop("_missed")
    if not some:
        return found
    rows = df.join(apart, id_col, "left_semi")
    ex = rows.select(id_col, F.posexplode(tokens).alias("pos", "token")).withColumn("_low", F.lower("token"))
    rebuilt = reassemble(ex.join(words, "_low", "left_semi"), [id_col], "_kept")
    rest = rows.join(rebuilt, id_col, "left").withColumn(out, F.coalesce(F.col("_kept"), none)).drop("_kept")
    return found.unionByName(rest.select(*found.columns))


def terms_vocabulary(df: DataFrame, tokens: str) -> DataFrame:
    """F7 vocabulary: distinct sequences, lower-cased, alphabetic only, corpus count > 1.

    A token counts more than once when it stands in two distinct sequences (told by
    their hashes) or twice in one, so that no sequence is shuffled."""
    cleaned = df.select(F.xxhash64(tokens).alias("_h"), F.sort_array(keep_alpha_tokens(lower_tokens(tokens))).alias("_s"))
    again = F.transform("_s", lambda t, i: F.struct(t.alias("token"), ((i > 0) & (F.get("_s", i - 1) == t)).alias("again")))
    each = cleaned.select("_h", F.inline(again))
    seen = each.groupBy("token").agg(F.min("_h").alias("_lo"), F.max("_h").alias("_hi"), F.max("again").alias("_again"))
    return seen.where(F.col("_again") | (F.col("_lo") != F.col("_hi"))).select("token")


# --- token codes: one character per token, for the built-in levenshtein.
_FIRST_CODE = 0x20
_SURROGATES, _SURROGATE_COUNT = 0xD800, 0x800
_BYTE_ORDER_MARK = 0xFEFF  # decodes to nothing


def code_point_char(idx) -> Column:
    """Character for a non-negative index; control characters, surrogates and
    the byte order mark are left out."""
    cp = idx + F.lit(_FIRST_CODE)
    cp = F.when(cp >= _SURROGATES, cp + F.lit(_SURROGATE_COUNT)).otherwise(cp)
    cp = F.when(cp >= _BYTE_ORDER_MARK, cp + F.lit(1)).otherwise(cp)
    return F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")


def code_points(idx: np.ndarray) -> str:
    """``code_point_char`` of many indices inside a task, as one string."""
    cp = idx + np.uint32(_FIRST_CODE)
    cp = np.where(cp >= _SURROGATES, cp + np.uint32(_SURROGATE_COUNT), cp)
    cp = np.where(cp >= _BYTE_ORDER_MARK, cp + np.uint32(1), cp)
    return cp.astype("<u4").tobytes().decode("utf-32-le")
