"""The corpus pipeline on a small table, and its stages on awkward rows."""

from __future__ import annotations

import corpus_pipeline
from errscope.llm import settings
from errscope.llm.queries import QUERIES
from pyspark.sql import functions as F

from .conftest import SF
from .test_near_dedup import _classes
from .test_exact_and_lines import _brute_lines


def test_thirteen_queries_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_stages_take_effect(spark, docs, labels):
    at = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, at = at, stage(spark, at, SF).persist()
        seen[name] = (before, at)
        assert at.columns == docs.columns
    before, after = ({r.doc_id for r in df.collect()} for df in seen["toxicity"])
    clean = {r.doc_id for r in labels.where("toxic = 0").collect()}
    assert after < before and len((before & clean) - after) <= 0.1 * len(clean)  # the smallest table has eleven toxic labels
    before, after = seen["line_dedup"]
    want = {i: text for i, (_, text) in _brute_lines([(r.doc_id, r.text) for r in before.collect()]).items()}
    assert {r.doc_id: r.text for r in after.collect()} == want
    assert after.where(F.col("n_chars") != F.length("text")).count() == 0
    before, after = seen["near_dedup"]
    classes = _classes([(r.doc_id, r.text) for r in before.collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(classes.values()))
    before, after = seen["mixing"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}
    packed = corpus_pipeline.pack(spark, at, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in at.collect()}


def test_stages_on_awkward_and_empty_rows(spark, tmp_path, edge_docs, no_docs, labels):
    labels.limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (edge_docs, no_docs):
        at = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            at = stage(spark, at, str(tmp_path)).persist()
            assert at.columns == rows.columns
        ids = {r.doc_id for r in corpus_pipeline.pack(spark, at, str(tmp_path)).collect()}
        assert ids == ({1, 2, 3, 4, 7, None} if rows is edge_docs else set())


def test_stages_keep_columns_with_clashing_names(spark, tmp_path, labels):
    """Whatever their names, the other columns come out with the values of their row."""
    from .conftest import CLASHES

    labels.limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    line = "a line that is long enough and that many documents share"
    rows = [(i, f"{line}\nand a text of its own {' '.join(f'w{i}x{k}' for k in range(30))}", 100 + i) for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, mark int")
    df = df.select("doc_id", "text", *[F.col("mark").alias(c) for c in CLASHES if c not in ("text", "doc_id")])
    at = df
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, str(tmp_path)).persist()
        assert at.columns == df.columns
        for r in at.collect():
            assert {r[c] for c in CLASHES} == {100 + r.doc_id}, name
    assert {r.doc_id for r in at.collect()} == set(range(8)) and at.where(F.col("text").startswith(line)).select("doc_id").distinct().count() == 1


def test_entry_without_a_package_that_the_operators_import():
    """The other queries stay, and no error is swallowed elsewhere."""
    import subprocess
    import sys
    from pathlib import Path

    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; q = e.queries(); print(len(q), sum(n.startswith('op') for n in q), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(corpus_pipeline.__file__).parent, capture_output=True, text=True)
    n, ours, oracles = map(int, out.stdout.split())
    assert n > 100 and ours == 0 and oracles > 90


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None and settings.MIX_WEIGHTS
