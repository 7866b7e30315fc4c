"""Registered queries against their DuckDB oracles on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from errscope.plans import registry
from errscope.sources.tables import TABLES
from tests.conftest import SF_SMALL

FAST = [
    "group_equal_messages", "clean_message", "split_tokens", "term_frequency", "drop_rare_tokens",
    "tokenize_message_templated", "detokenize_pattern", "dedup_adjacent_tokens", "remove_stop_tokens",
    "collapse_placeholders", "scan_json_schema", "filter_non_empty", "scan_csv", "scan_csv_rename",
    "leader_clustering", "cluster_statistics", "matcher_pattern", "positional_alternatives", "tf_idf",
    "mask_heavy_terms", "site_tfidf", "cluster_per_site", "published_projection", "publish_batches",
    "knn_join", "radius_join", "dbscan", "leader_clustering_basic", "common_phrases", "scan_day_range", "union_days",
    "compare_runs", "quality_report", "daily_report", "clusters_by_size",
]


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(rel.columns, rel.fetchall())


def test_every_query_has_a_callable_and_most_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and all(map(callable, q.values()))
    registry.load_all()
    assert len(registry.ORACLES) >= 0.8 * len(registry.QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"hash", "cluster_size", "first_id", "sequence_text"}
    assert df.count() > 0
