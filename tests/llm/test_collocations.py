"""Operator 13 against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from errscope.llm import collocations as C
from errscope.llm.collocations import Ranks, collocations, count_pairs

from .conftest import CLASHES, LOWER, SF

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, least, top=2000, most=5, inside=100):
    """(lang, text) rows, phrase by phrase, in whole Python numbers."""
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, most + 1):
                f.setdefault(lang, Counter()).update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        inner = set()
        for p, a in found.items():
            for k in range(2, len(p)):
                inner |= {p[i : i + k] for i in range(len(p) - k + 1) if 100 * a >= inside * found[p[i : i + k]]}
        scored = []
        for p, a in found.items():
            if p not in inner:
                cuts = [(1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        scored.sort()
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(scored[:top], 1)]
    return sorted(out)


def got(df, **settings):
    out = collocations(df, **settings)
    assert out.columns == COLUMNS
    return sorted(map(tuple, out.collect()))


def texts(n, seed=4):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)] + ["New", "york", "é", "日本", "it's", "a-b"]
    phrases = ["new York city", "the quick brown fox jumps", "a b c d e f g", "x y"]
    out = []
    for _ in range(n):
        words = []
        for _ in range(rng.randrange(30)):
            words.append(rng.choice(phrases) if rng.random() < 0.2 else rng.choice(vocabulary))
            words.append(rng.choice([" ", "  ", "\t", ", ", ". ", "\n", ";", "!?"]) if rng.random() < 0.4 else " ")
        out.append((rng.choice(["en", "en", "de", None, "und"]), "".join(words)))
    return [*out, ("en", None), (None, ""), ("fr", "only few words"), ("de", " . \x0b , "), ("en", "x y " * 3000)]


@pytest.mark.parametrize("least,settings", [(5, {}), (20, {"top": 7}), (5, {"head": 10}), (8, {"head": 3, "most_words": 4}), (5, {"inside_percent": 60})])
def test_equals_plain_counting(spark, least, settings):
    rows = texts(400)
    df = spark.createDataFrame([(i % 9, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string")
    df = df.select("*", *[F.lit("q").alias(c) for c in CLASHES]).repartition(4)
    want = plain(rows, least, settings.get("top", 2000), settings.get("most_words", 5), settings.get("inside_percent", 100))
    assert len(want) >= 10
    assert got(df, least=least, **settings) == want


def test_dense_tiles_count_like_sorted_pairs(monkeypatch):
    rng = np.random.default_rng(3)
    left, right = (np.minimum(rng.zipf(1.3, 60_000) - 1, 200).astype(np.int64) for _ in "ab")
    left[::17], right[::31] = -2 - rng.integers(0, 5, len(left[::17])), -2 - rng.integers(0, 5, len(right[::31]))
    want = Counter(zip(left.tolist(), right.tolist()))
    for tile, dense in ((16, 8), (64, 8), (512, 10**9)):
        monkeypatch.setattr(C, "TILE", tile)
        monkeypatch.setattr(C, "DENSE", dense)
        monkeypatch.setattr(C, "TILES_AT_ONCE", 3)
        parts = [(a, b, n) for part in count_pairs(left, right, 201) for a, b, n in zip(*(x.tolist() for x in part))]
        assert len(parts) == len(want) and {(a, b): n for a, b, n in parts} == want


def test_numbers_lead_back_to_keys():
    keys = np.array([50, 7, 10**18], np.int64)
    bits = np.zeros(C.PAGES * C.PAGE // 8, np.uint8)
    bits[99 >> 3] |= 1 << (99 & 7)
    ranks = Ranks(keys, bits)
    number = ranks.of(np.array([10**18, 99, 50, 98, 7], np.uint64))
    assert number.tolist() == [2, -101, 0, -1, 1]
    assert ranks.key_of(number[[0, 1, 2, 4]]).tolist() == [10**18, 99, 50, 7]


def test_awkward_rows_and_empty_table(spark, edge_docs, no_docs):
    lang = edge_docs.withColumn("lang", F.lit(None).cast("string"))
    rows = [(None, r.text) for r in edge_docs.collect()]
    assert got(lang, least=2) == plain(rows, 2)
    assert got(no_docs.withColumn("lang", F.lit("x"))) == []


def test_query_equals_its_sql(spark):
    import duckdb

    from errscope.llm.queries import ORACLES, QUERIES

    sf = SF.replace("0.001", "0.01")
    duckdb.sql(f"create or replace view documents as select * from read_parquet('{sf}/documents.parquet')")
    want = duckdb.sql(ORACLES["op13_collocations"]).fetchall()
    assert len(want) > 0 and sorted(map(tuple, QUERIES["op13_collocations"](spark, sf).select(COLUMNS).collect())) == sorted(want)
