"""DuckDB SQL fragments for the oracle side of each registered query.

They restate the same rules in DuckDB's dialect (RE2 patterns and list
functions); the cleaning patterns are shared verbatim with the Spark side.
"""

from __future__ import annotations

import re

from ..functions.constants import CLEANING_RULES
from ..sources.fixtures import fixture_ctes


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def clean_expr(expr: str) -> str:
    out = expr
    for pattern in CLEANING_RULES:
        out = f"regexp_replace({out}, {sql_str(pattern)}, ' ', 'g')"
    return out


def sequences_ctes(source: str, target: str = "error_message", id_col: str = "msg_id", by: tuple = ()) -> str:
    """CTEs ``cleaned``, ``tok``, ``freq``, ``seqs`` (by..., id, cleaned, sequence, hash) over ``source``."""
    b = "".join(f"{c}, " for c in by)
    join_by = " AND ".join([f"t.{c} = f.{c}" for c in by] + ["t.token = f.token"])
    return f"""
cleaned AS (SELECT {b}{id_col}, {clean_expr(f"coalesce({target}, '')")} AS cleaned FROM {source}),
split AS (SELECT {b}{id_col}, cleaned, string_split(cleaned, ' ') AS parts FROM cleaned),
tok AS (SELECT {b}{id_col}, unnest(parts) AS token, generate_subscripts(parts, 1) AS pos FROM split),
freq AS (SELECT {b}token, count(*) AS n FROM tok GROUP BY {b}token),
kept AS (SELECT {"".join(f"t.{c}, " for c in by)}t.{id_col}, list(t.token ORDER BY t.pos) AS seq
         FROM tok t JOIN freq f ON {join_by} WHERE f.n > 1 GROUP BY {"".join(f"t.{c}, " for c in by)}t.{id_col}),
seqs AS (SELECT {"".join(f"s.{c}, " for c in by)}s.{id_col}, s.cleaned, coalesce(k.seq, []::VARCHAR[]) AS sequence,
                md5(array_to_string(coalesce(k.seq, []::VARCHAR[]), ' ')) AS hash
         FROM split s LEFT JOIN kept k ON {" AND ".join([f"s.{c} = k.{c}" for c in by] + [f"s.{id_col} = k.{id_col}"])})
"""


def prefixed(ctes: str, prefix: str) -> str:
    """The same CTEs of ``sequences_ctes`` under names with a prefix."""
    return re.sub(r"\b(cleaned|split|tok|freq|kept|seqs)\b(?= AS \(| [tfsk]\b| JOIN|\)| WHERE| GROUP|$)", lambda m: prefix + m[1], ctes)


def with_fixtures(*names: str, extra: str = "") -> str:
    head = fixture_ctes(*names).rstrip()
    if "walk AS (" in extra:
        head = "WITH RECURSIVE " + head[len("WITH "):]
    if extra:
        head += ",\n" + extra.strip()
    return head + "\n"


def token_codes(lst: str, union: str) -> str:
    """ASCII code string of ``lst``, tokens numbered by position in ``union`` (<= 94 tokens)."""
    return f"array_to_string(list_transform({lst}, lambda t: chr(33 + list_position({union}, t))), '')"


def token_sim(a: str, b: str) -> str:
    u = f"list_sort(list_distinct(list_concat({a}, {b})))"
    d = f"levenshtein({token_codes(a, u)}, {token_codes(b, u)})"
    return f"(CASE WHEN greatest(len({a}), len({b})) = 0 THEN 1.0 ELSE 1 - {d} / greatest(len({a}), len({b})) END)"


def char_sim(a: str, b: str) -> str:
    return f"(CASE WHEN greatest(length({a}), length({b})) = 0 THEN 1.0 ELSE 1 - levenshtein({a}, {b}) / greatest(length({a}), length({b})) END)"


def leader_ctes(accuracy: float = 0.8, by: tuple = ()) -> str:
    """CTEs ``groups``, ``ranked``, ``pairs``, ``walk``, ``assign``, ``assigned``
    after ``seqs``: the sequential leader loop restated as a recursive walk
    over priority order (per ``by`` key; one walk over all keys)."""
    b = "".join(f"{c}, " for c in by)
    same = "".join(f"a.{c} = b.{c} AND " for c in by)
    return f"""
groups AS (SELECT {b}hash, count(*) AS cluster_size, min(msg_id) AS first_id, arg_min(sequence, msg_id) AS sequence
           FROM seqs GROUP BY {b}hash),
ranked AS (SELECT *, row_number() OVER (ORDER BY {b}cluster_size DESC, hash) AS rk FROM groups),
pairs AS (SELECT a.rk AS hi, b.rk AS lo, {token_sim('a.sequence', 'b.sequence')} AS similarity
          FROM ranked a JOIN ranked b ON {same}a.rk < b.rk
          WHERE {token_sim('a.sequence', 'b.sequence')} >= {accuracy}),
walk AS (
  SELECT 0::BIGINT AS i, []::BIGINT[] AS leaders
  UNION ALL
  SELECT i + 1, CASE WHEN EXISTS (SELECT 1 FROM pairs p WHERE p.lo = i + 1 AND list_contains(leaders, p.hi))
                     THEN leaders ELSE list_append(leaders, i + 1) END
  FROM walk WHERE i < (SELECT max(rk) FROM ranked)),
leader_set AS (SELECT unnest(leaders) AS rk FROM (SELECT leaders FROM walk ORDER BY i DESC LIMIT 1)),
assign AS (SELECT r.*, CASE WHEN r.rk IN (SELECT rk FROM leader_set) THEN r.rk
                            ELSE (SELECT min(p.hi) FROM pairs p WHERE p.lo = r.rk AND p.hi IN (SELECT rk FROM leader_set)) END AS leader_rk
           FROM ranked r),
assigned AS (SELECT a.*, l.hash AS leader_hash FROM assign a JOIN ranked l ON l.rk = a.leader_rk)
"""


def uuid_sql(expr: str) -> str:
    h = f"md5({expr})"
    return (
        f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || "
        f"substr({h}, 17, 4) || '-' || substr({h}, 21, 12)"
    )
