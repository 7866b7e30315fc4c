"""Chain invariants: every message labelled once, sizes add up, on both paths."""

import pytest
from pyspark.sql import functions as F

from errscope.plans.chain import ChainSettings, cluster_messages
from errscope.sources import fixtures as fx
from tests.conftest import SF_SMALL


@pytest.mark.parametrize(
    "settings",
    [
        ChainSettings(),
        ChainSettings(clustering_type="ML", w2v_size=16, w2v_iterations=1),
        ChainSettings(clustering_type="ML", w2v_size=16, w2v_iterations=1, epsilon=0.05),
        ChainSettings(clustering_type="ML", algorithm="hierarchical", w2v_size=16, w2v_iterations=1),
        ChainSettings(clustering_type="ML", algorithm="hdbscan", w2v_size=16, w2v_iterations=1, extra={"min_cluster_size": 3}),
    ],
)
def test_every_message_labelled_once(spark, settings):
    tm = fx.templated_messages(spark, SF_SMALL)
    run = cluster_messages(tm, settings=settings, with_patterns=False)
    n = tm.count()
    assert run.bridge.count() == n
    assert run.bridge.select("msg_id").distinct().count() == n
    assert run.clusters.agg(F.sum("cluster_size")).first()[0] == n
    assert run.strategy == ("Levenshtein" if settings.clustering_type == "SIMILARITY" else "word2vec.model")


def test_vector_path_by_key_stays_within_the_key(spark):
    tm = fx.templated_messages(spark, SF_SMALL)
    st = ChainSettings(clustering_type="ML", w2v_size=16, w2v_iterations=1, epsilon=5.0)
    run = cluster_messages(tm, by=("src_site",), settings=st, with_patterns=False)
    n = tm.count()
    assert run.bridge.count() == n and run.clusters.agg(F.sum("cluster_size")).first()[0] == n
    assert run.clusters.count() == run.clusters.select("src_site").distinct().count()  # a wide radius: one cluster a site


@pytest.mark.parametrize("wrong", [dict(algorithm="kmeans"), dict(clustering_type="other"), dict(clustering_type="ML", mode="update"), dict(clustering_type="ML", mode="process")])
def test_unknown_settings_are_errors(spark, wrong):
    with pytest.raises(ValueError):
        cluster_messages(fx.templated_messages(spark, SF_SMALL), settings=ChainSettings(**wrong))


def test_stored_model_is_updated_and_applied(spark, tmp_path):
    from errscope.operators import embedding as E

    path, tm = str(tmp_path / "model"), fx.templated_messages(spark, SF_SMALL)
    st = dict(clustering_type="ML", w2v_size=12, w2v_iterations=1, model_path=path, epsilon=0.5)
    for mode, version in (("create", 1), ("update", 2), ("process", 2)):
        run = cluster_messages(tm, settings=ChainSettings(mode=mode, **st), with_patterns=False)
        assert run.clusters.agg(F.sum("cluster_size")).first()[0] == tm.count()
        assert E.current_version(spark, path) == version and run.strategy == path


def test_regroup_gives_every_id_and_phrase_of_a_label(spark, monkeypatch):
    """A row has a label's ids and its phrases, best first; long lists go on in further rows."""
    from errscope.plans import queries_jobs
    from errscope.plans.chain import regrouped

    texts = ["copy of the input file failed", "copy of the output file failed", "no answer from the host", "copy of the input file failed"]
    rows = spark.createDataFrame([(i, texts[i % 4]) for i in range(20)], "msg_id long, error_message string")
    st = ChainSettings(clustering_type="ML", w2v_size=8, w2v_iterations=1, epsilon=50.0)
    run = cluster_messages(rows, settings=st)
    best = [r.phrase for r in run.phrases.orderBy(F.desc("score"), "phrase").collect()]
    whole = regrouped(run).collect()
    assert len(whole) == 1 and whole[0].piece == 0 and whole[0].ids == list(range(20)) and len(best) > 3
    assert whole[0].common_phrases == best and whole[0].cluster_size == whole[0].n_ids == 20
    parts = sorted(regrouped(run, most=3).collect(), key=lambda r: r.piece)
    assert [i for r in parts for i in r.ids] == list(range(20)) and [p for r in parts for p in r.common_phrases] == best
    assert len(parts) == 7 and {r.pattern for r in parts} == {whole[0].pattern}

    monkeypatch.setattr(queries_jobs.fx, "messages", lambda spark, sf: rows)
    monkeypatch.setattr(queries_jobs, "ChainSettings", lambda **kw: st)
    got = queries_jobs.q_cluster_regroup(spark, "").collect()
    assert sorted(i for r in got for i in r.ids) == list(range(20)) and got[0].common_phrases == best and got[0].tokenized_pattern
