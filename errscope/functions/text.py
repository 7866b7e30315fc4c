"""Column expressions over message text and token arrays (no Python UDFs).

All functions take and return ``Column`` objects so they compose inside one
projection and stay in whole-stage code generation.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import (
    CLEANING_RULES,
    COLLAPSE_RE,
    PLACEHOLDER,
    SPACER,
    TOKEN_STOP_LIST,
    WILDCARD,
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _from_run_start(pattern: str) -> str:
    """A rule that begins with a run of a character class, tried only where such a run
    begins and without giving characters of it back: tried inside a word, a run that
    does not match is read again from each of its characters. The first match begins
    where its run does, and what follows the run is not of its class, so the matches are the same."""
    run = re.match(r"(\[[^\]]+\])([*+])(?=[_\\])", pattern)
    if run is None:
        return pattern
    return f"(?<!{run[1]}){run[1]}{run[2]}+{pattern[run.end():]}"


def clean_message(c) -> Column:
    """The six substitutions, in order; each match becomes one space."""
    out = _col(c)
    for pattern in CLEANING_RULES:
        out = F.regexp_replace(out, _from_run_start(pattern), " ")
    return out


def split_tokens(c) -> Column:
    """Split cleaned text on single spaces; edge spaces give '' tokens."""
    return F.split(_col(c), " ")


def content_hash(seq) -> Column:
    """T4: equality key of a token sequence."""
    return F.md5(F.array_join(_col(seq), " "))


# Token shapes. A word may carry inner hyphens, a number inner dots/commas
# (conservative); aggressive keeps only runs of one character class.
_PLACEHOLDER_RE = "｟[^｠]*｠"
TOKEN_PATTERNS = {
    "conservative": _PLACEHOLDER_RE
    + r"|\p{N}+(?:[.,]\p{N}+)+|[\p{L}\p{M}\p{N}_]+(?:-[\p{L}\p{M}\p{N}_]+)*|(?s:.)",
    "aggressive": _PLACEHOLDER_RE + r"|[\p{L}\p{M}]+|\p{N}+|(?s:.)",
    "space": _PLACEHOLDER_RE + r"|[^ ]+| ",
}


def tokenize_message(c, tokenizer_type: str = "conservative") -> Column:
    """T5: words, numbers and single other characters; each space becomes a
    spacer token, so ``detokenize_pattern`` restores the text exactly."""
    pattern = TOKEN_PATTERNS[tokenizer_type]
    raw = F.regexp_extract_all(F.coalesce(_col(c), F.lit("")), F.lit(pattern), 0)
    return F.transform(raw, lambda t: F.when(t == " ", F.lit(SPACER)).otherwise(t))


def detokenize_pattern(tokens) -> Column:
    """Token list -> text; a spacer right before the placeholder token is dropped."""
    x = _col(tokens)
    kept = F.filter(
        x,
        lambda t, i: ~((t == SPACER) & (i + 1 < F.size(x)) & (F.try_element_at(x, i + 2) == F.lit(PLACEHOLDER))),
    )
    return F.array_join(F.transform(kept, lambda t: F.when(t == SPACER, F.lit(" ")).otherwise(t)), "")


def dedup_adjacent_tokens(tokens) -> Column:
    """Collapse runs of equal neighbouring tokens."""
    x = _col(tokens)
    return F.filter(x, lambda t, i: (i == 0) | (t != F.try_element_at(x, F.greatest(i, F.lit(1)))))


def lower_tokens(tokens) -> Column:
    """T8."""
    return F.transform(_col(tokens), lambda t: F.lower(t))


def keep_alpha_tokens(tokens) -> Column:
    """Tokens made only of letters (after lower-casing)."""
    return F.filter(_col(tokens), lambda t: F.lower(t).rlike(r"^\p{L}+$"))


def remove_stop_tokens(tokens, alpha_only: bool = True, stop_words=None) -> Column:
    """Drop stop words, punctuation, quote tokens and the spacer."""
    stops = F.array(*[F.lit(w) for w in (stop_words or TOKEN_STOP_LIST)])
    cond = lambda t: ~F.array_contains(stops, F.lower(t))
    if alpha_only:
        return F.filter(_col(tokens), lambda t: cond(t) & F.lower(t).rlike(r"^\p{L}+$"))
    return F.filter(_col(tokens), cond)


def collapse_placeholders(text) -> Column:
    """A pattern with two or more parenthesised parts keeps one wildcard."""
    return F.regexp_replace(_col(text), COLLAPSE_RE, WILDCARD.replace("\\", "\\\\").replace("$", "\\$"))


def cluster_uuid(key) -> Column:
    """Stable UUID-shaped id from a cluster key."""
    h = F.md5(_col(key).cast("string"))
    return F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)
    )
