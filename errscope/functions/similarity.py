"""Edit-distance similarities as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(distance: Column, len_a: Column, len_b: Column) -> Column:
    """``1 - d / max(len)``; two empty inputs count as equal (1.0)."""
    longest = F.greatest(len_a, len_b)
    return F.when(longest == 0, F.lit(1.0)).otherwise(1.0 - distance.cast("double") / longest.cast("double"))


def char_similarity(a, b) -> Column:
    """Character edit similarity (Spark counts code points)."""
    a, b = _col(a), _col(b)
    return ratio(F.levenshtein(a, b), F.length(a), F.length(b))


def prefix_similarity(a, b, n: int) -> Column:
    """T13 over the first ``n`` characters."""
    return char_similarity(F.substring(_col(a), 1, n), F.substring(_col(b), 1, n))


def token_similarity(codes_a, codes_b) -> Column:
    """Token edit similarity of two sequences given as code strings
    (one character per token of the pair)."""
    return char_similarity(codes_a, codes_b)
