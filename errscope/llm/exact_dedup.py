"""Operator 1, exact dedup by progressive refinement.

Length, then the hash of a prefix, then the hash of the whole text; each step
looks only at rows that the step before could not tell apart. Which rows those
are is told by a bitmap over hashes of the step's key. Its size follows the number
of rows up to a bound (``MOST_BITS``): it is a table of one row for 64 bits, so
broadcasting it is safe at any corpus size. A set bit that belongs to another key
only causes a hash that was not needed; the grouping itself compares whole hashes.

Cases: null text counts as empty; a null id loses to any other id of its group;
rows that repeat an id are counted and returned one by one, and of equal texts
all rows that have the largest id stay; an empty table gives an empty result; only the columns named in ``carry`` are passed on, so other
columns may have any name but those of the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialise


def normalised(text: Column | str) -> Column:
    """The text that is compared: A-Z lower-cased, null as empty."""
    return F.coalesce(ascii_lower(text), F.lit(""))


MOST_BITS = 1 << 26  # a million rows of 16 bytes


def bitmap_bits(rows: int) -> int:
    """Bits for a bitmap over so many keys: 16 for each, up to ``MOST_BITS``."""
    return min(MOST_BITS, max(1 << 16, 1 << (16 * rows).bit_length()))


def bitmap_of(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """(``_word``, ``_bits``): the set bits of the hashes in ``keys``."""
    slot = F.pmod(F.col(key), F.lit(bits))
    return keys.groupBy(F.shiftright(slot, 6).alias("_word")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast(pmod({key}, 64) as int)))").alias("_bits")
    )


def marked(rows: DataFrame, key: str, bitmap: DataFrame, bits: int, flag: str) -> DataFrame:
    """Add ``flag``: the bit of the row's hash is set."""
    word = F.shiftright(F.pmod(F.col(key), F.lit(bits)), 6)
    out = rows.withColumn("_word", word).join(F.broadcast(bitmap), "_word", "left")
    hit = F.getbit(F.coalesce("_bits", F.lit(0).cast("long")), F.pmod(F.col(key), F.lit(64)).cast("int")) == 1
    return out.withColumn(flag, hit).drop("_word", "_bits")


def _repeated(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key)


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_chars: int = 256,
    filter_bits: int | None = None,
    carry: Sequence[str] = (),
    digest_col: str | None = None,
) -> DataFrame:
    """One row per document: (id, ``keep_id``, ``group_size``, ``kept``, ``decided_by``, carry...).

    Of equal texts the row with the largest id stays. ``decided_by`` names the
    step that settled the row: length, prefix or full. ``digest_col`` asks for
    the SHA-256 of every normalised text as a column, which the last step then
    uses instead of hashing the open rows alone."""
    filter_bits = filter_bits or bitmap_bits(docs.count())
    base = docs.select(F.col(id_col), F.coalesce(text_col, F.lit("")).alias("_text"), *carry)
    by_length = base.withColumn("_k1", F.xxhash64(F.length("_text")))  # case does not change the length
    lengths = bitmap_of(_repeated(by_length, "_k1"), "_k1", filter_bits)

    prefix_key = F.when(F.col("_m1"), F.xxhash64(F.length("_text"), normalised(F.substring("_text", 1, prefix_chars))))
    by_prefix = marked(by_length, "_k1", lengths, filter_bits, "_m1").withColumn("_k2", prefix_key)
    prefixes = bitmap_of(_repeated(by_prefix.where("_m1"), "_k2"), "_k2", filter_bits)

    by_full = marked(by_prefix, "_k2", prefixes, filter_bits, "_m2")
    is_open = F.col("_m1") & F.coalesce("_m2", F.lit(False))
    digest = F.sha2(normalised("_text"), 256)
    rows = by_full.select(
        id_col,
        *carry,
        is_open.alias("_open"),
        (digest if digest_col else F.when(is_open, digest)).alias("_full"),
        F.when(~F.col("_m1"), "length").when(~is_open, "prefix").otherwise("full").alias("decided_by"),
    )
    rows = materialise(rows, "exact-dedup")
    extra = [*carry, *([F.col("_full").alias(digest_col)] if digest_col else [])]

    alone = rows.where("not _open").select(id_col, F.col(id_col).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "decided_by", *extra)
    open_rows = rows.where("_open")
    groups = open_rows.groupBy("_full").agg(F.max(id_col).alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    settled = open_rows.join(groups.where("group_size > 1"), "_full", "left").select(
        id_col,
        F.when(F.col("group_size").isNull(), F.col(id_col)).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        "decided_by",
        *extra,
    )
    out = alone.unionByName(settled).withColumn("kept", F.col(id_col).eqNullSafe(F.col("keep_id")))
    return out.select(id_col, "keep_id", "group_size", "kept", "decided_by", *carry, *([digest_col] if digest_col else []))
