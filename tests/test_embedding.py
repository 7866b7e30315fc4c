"""Trained word and document vectors (V2, V6) and their store."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from errscope.operators import embedding as E


def texts(seed, n, topics=3, words=12, fresh=()):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        topic = i % topics
        vocabulary = [f"t{topic}w{k}" for k in range(words)] + [f"common{k}" for k in range(4)] + list(fresh)
        out.append((i, [rng.choice(vocabulary) for _ in range(rng.randint(8, 20))]))
    return out


def corpus(spark, rows):
    return spark.createDataFrame(rows, "id long, sequence array<string>")


def cosine(a, b):
    return float(np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b) + 1e-12))


@pytest.fixture(scope="module")
def model(spark):
    found, losses = E.train_word_vectors(corpus(spark, texts(1, 240)), size=16, window=4, passes=6, rate=0.1, chunk=1500)
    return found.persist(), losses


def test_words_of_a_topic_are_near(model):
    found, losses = model
    vec = {r.word: np.array(r.vec) for r in found.collect()}
    assert len(vec) == 3 * 12 + 4
    same = np.mean([cosine(vec[f"t{t}w{a}"], vec[f"t{t}w{b}"]) for t in range(3) for a in range(12) for b in range(a)])
    other = np.mean([cosine(vec[f"t{t}w{a}"], vec[f"t{(t + 1) % 3}w{b}"]) for t in range(3) for a in range(12) for b in range(12)])
    assert same > other + 0.3
    assert all(after < before for before, after in zip(losses, losses[1:]))


def test_training_goes_on_from_a_stored_model(spark, model, tmp_path):
    path = str(tmp_path / "model")
    assert E.current_version(spark, path) is None
    assert E.store(model[0], path) == 1
    stored = E.load(spark, path)
    more = corpus(spark, [(i, t) for i, t in texts(2, 60, topics=2, fresh=["new1", "new2"])])
    after, losses = E.train_word_vectors(more, stored, window=4, passes=3, rate=0.02, chunk=400)
    before = {r.word: r for r in stored.collect()}
    now = {r.word: r for r in after.collect()}
    assert set(now) == set(before) | {"new1", "new2"} and len(now["new1"].vec) == 16
    untouched = [f"t2w{k}" for k in range(12)]
    assert all(now[w].vec == before[w].vec and now[w].n == before[w].n for w in untouched)
    moved = {w: np.linalg.norm(np.subtract(now[w].vec, before[w].vec)) / np.linalg.norm(before[w].vec) for w in before if w not in untouched}
    assert 0 < max(moved.values()) < 0.5  # old words stay near to where they were
    assert all(now[w].n > before[w].n for w in moved)
    assert losses[-1] < losses[0]
    # a version counts only when it is finished
    assert E.store(after, path) == 2 and E.load(spark, path).count() == len(now)
    after.limit(3).write.parquet(f"{path}/version=3")  # a run that was killed before it was done
    assert E.current_version(spark, path) == 2 and E.load(spark, path).count() == len(now) and E.load(spark, path, 1).count() == len(before)


def test_document_vectors(spark):
    rows = texts(3, 210)
    train = corpus(spark, [r for r in rows if r[0] % 7])
    docs, words, losses = E.train_document_vectors(train, "id", size=16, window=4, passes=8, rate=0.15, chunk=900)
    assert all(after < before for before, after in zip(losses, losses[1:]))
    held, _, _ = E.train_document_vectors(corpus(spark, [r for r in rows if r[0] % 7 == 0]), "id", model=words, window=4, passes=15, rate=0.3, chunk=900)
    known = {r.id: np.array(r.doc_vector) for r in docs.collect()}
    new = {r.id: np.array(r.doc_vector) for r in held.collect()}
    assert set(known) | set(new) == {r[0] for r in rows}
    centre = np.mean(list(known.values()), axis=0)
    topic = [np.mean([v - centre for i, v in known.items() if i % 3 == t], axis=0) for t in range(3)]
    right = [max(range(3), key=lambda t: cosine(v - centre, topic[t])) == i % 3 for i, v in new.items()]
    assert np.mean(right) > 0.8


def test_mean_vectors_and_awkward_rows(spark, model):
    found, _ = model
    vec = {r.word: np.array(r.vec) for r in found.collect()}
    rows = [(1, ["t0w1", "t0w1", "unknown", "common1"]), (2, []), (3, None), (4, ["unknown"]), (1, ["t1w1"])]
    got = sorted((r.id, r.vector) for r in E.mean_vectors(found, corpus(spark, rows)).collect())
    want = [(1, (2 * vec["t0w1"] + vec["common1"]) / 4), (1, vec["t1w1"]), (2, np.zeros(16)), (3, np.zeros(16)), (4, np.zeros(16))]
    for (i, a), (j, b) in zip(sorted(got, key=lambda r: (r[0], round(sum(r[1]), 9))), sorted(want, key=lambda r: (r[0], round(float(sum(r[1])), 9)))):
        assert i == j and np.allclose(a, b, atol=1e-6)
    docs, words, _ = E.train_document_vectors(corpus(spark, [*rows, (5, ["alone"]), (6, ["x", None, "y"])]), "id", size=4, passes=1)
    assert sorted(r.id for r in docs.collect()) == [1, 1, 2, 3, 4, 5, 6]
    assert {r.word for r in words.collect()} == {"t0w1", "unknown", "common1", "t1w1", "alone", "x", "y"}
    none = corpus(spark, [])
    assert E.train_word_vectors(none, passes=1)[0].count() == 0 and E.train_document_vectors(none, "id", passes=1)[0].count() == 0


def test_mean_vectors_send_a_vector_once_to_a_chunk(spark, model):
    """Texts that repeat their words in many chunks, and a word with two rows."""
    found, _ = model
    vec = {r.word: np.array(r.vec) for r in found.collect()}
    rows = texts(5, 60) + [(60, ["t0w1"] * 500)]
    got = {r.id: r.vector for r in E.mean_vectors(found, corpus(spark, rows), chunk=50).collect()}
    assert all(np.allclose(got[i], np.mean([vec[w] for w in t], axis=0), atol=1e-6) for i, t in rows)
    both = found.unionByName(found.where("word = 't0w1'"))
    assert np.allclose(E.mean_vectors(both, corpus(spark, [rows[-1]])).first().vector, 2 * vec["t0w1"], atol=1e-6)


def test_descent_follows_the_gradient():
    """One step equals the gradient of the loss, found by differences."""
    rng = np.random.default_rng(0)
    word, text = np.array([0, 1, 2, 1]), np.array([0, 0, 0, 0])
    vec, out, docs = (rng.normal(size=(n, 3)) for n in (3, 3, 1))
    noise = np.array([1.0, 0.0, 0.0])

    def loss(vec, out, docs):
        a, b, c = vec.copy(), out.copy(), docs.copy()
        return E.descend(word, text, a, b, c, noise, 2, 1, 0.0, np.random.default_rng(1))

    after = [x.copy() for x in (vec, out, docs)]
    E.descend(word, text, *after, noise, 2, 1, 1e-3, np.random.default_rng(1))
    for k, (x, moved) in enumerate(zip((vec, out, docs), after)):
        for i in np.ndindex(x.shape):
            shifted = [y.copy() for y in (vec, out, docs)]
            shifted[k][i] += 1e-6
            slope = (loss(*shifted) - loss(vec, out, docs)) / 1e-6
            step = (moved[i] - x[i]) / 1e-3
            assert abs(step + slope) < 1e-3 * max(1, abs(slope))


def test_word_vectors_are_a_table(spark, tmp_path):
    """Creating, storing and applying a model goes by tables: no fitted object on the driver."""
    from errscope.operators import vectors as V

    rows = [*texts(7, 60), (60, ["once"]), (61, []), (62, None)]
    model = V.word2vec_create(corpus(spark, rows), size=8, window=3, iterations=6)
    assert model.columns == ["word", "vec", "out", "n"]
    seen = {}
    for _, t in rows:
        for w in t or []:
            seen[w] = seen.get(w, 0) + 1
    assert {r.word: r.n for r in model.collect()} == seen and {len(r.vec) for r in model.collect()} == {8}
    again = V.word2vec_apply(spark, V.save_model(model, str(tmp_path / "named")))
    zero = {r.id: not any(r.vector) for r in V.sentence_vectors(again, corpus(spark, rows)).collect()}
    assert {i for i, z in zero.items() if z} == {61, 62}


def test_a_turn_returns_one_row_for_a_word(spark):
    """Rows of chunks are averaged before they are written, by a word's occurrences in each."""
    docs = E._numbered(corpus(spark, texts(9, 40)), "sequence").select("row", "tokens")
    counts = E._counts(docs)
    state = E.with_start(counts, "word", 4, 1, "vec").withColumn("out", F.array_repeat(F.lit(0.0).cast("float"), 4)).persist()
    start = {r.word: r for r in state.collect()}
    got = E._turn(docs, state, 7, 3, 4, 3, 2, [0.0, 0.0], 5, False).collect()
    words = [r for r in got if r.row == -1]
    assert len(words) == len(start) and all(r.n == start[r.word].seen and np.allclose(r.vec, start[r.word].vec, atol=1e-7) for r in words)
    assert sorted(r.row for r in got if r.row < -1) == [-3] * 7 + [-2] * 7


def test_mean_vectors_send_a_row_once(spark, model):
    """Rows leave their chunk with their means; no join by row follows."""
    found = model[0]
    df = corpus(spark, [(1, ["t0w1", None, "unknown"]), (2, []), (3, None)]).selectExpr("*", "id * 2 AS twice")
    out = E.mean_vectors(found, df)
    vec = {r.word: np.array(r.vec) for r in found.collect()}
    got = {r.id: (r.twice, np.array(r.vector)) for r in out.collect()}
    assert {k: v[0] for k, v in got.items()} == {1: 2, 2: 4, 3: 6} and out.columns == [*df.columns, "vector"]
    assert np.allclose(got[1][1], vec["t0w1"] / 3) and not got[2][1].any() and not got[3][1].any()
    assert "_row" not in out._jdf.queryExecution().optimizedPlan().toString().split("FlatMapCoGroups")[0]


def test_first_turn_draws_the_starts_within_chunks(spark, monkeypatch):
    """No vector is written or sent before the first turn, and what is trained is the same."""
    drawn = E.with_start
    asked = []
    monkeypatch.setattr(E, "with_start", lambda *a: asked.append(a[1]) or drawn(*a))
    docs = corpus(spark, texts(3, 30))
    words, losses = E.train_word_vectors(docs, size=6, passes=2, chunk=60)
    assert asked == []

    def sent(counts, size, seed, passes):
        return drawn(counts, "word", size, seed, "vec").withColumn("out", F.array_repeat(F.lit(0.0).cast("float"), size))

    got = {r.word: (r.vec, r.out, r.n) for r in words.collect()}
    monkeypatch.setattr(E, "_first_state", sent)
    again, before = E.train_word_vectors(docs, size=6, passes=2, chunk=60)
    assert np.allclose(losses, before)
    for r in again.collect():
        assert np.allclose(got[r.word][0], r.vec, atol=1e-5) and np.allclose(got[r.word][1], r.out, atol=1e-5) and got[r.word][2] == r.n
    assert E.train_word_vectors(docs, size=6, passes=0)[0].first().vec is not None
