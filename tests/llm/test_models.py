"""Operators 5, 6 and 7: held-out accuracy, targets, probabilities against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from errscope.llm.common import hash_words, in_fold
from errscope.llm.lm_scoring import END, best_classes, encoded, exchange, likelihood, lm_scoring, train_class_model
from errscope.llm.mixing import mixed, mixing_rates, solve_rates
from errscope.llm.toxicity import Shape, _buckets_seen, best_threshold, labelled_words, toxicity, train_toxicity
from pyspark.sql import functions as F

from .conftest import LOWER

SMALL = Shape(buckets=1 << 12)
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def _held_out(i, remainder):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == remainder


# ------------------------------------------------------------------ toxicity
@pytest.fixture(scope="module")
def insults(spark):
    rng = random.Random(5)
    rows = []
    for i in range(700):
        w = [f"w{int(rng.paretovariate(0.7)) % 3000}" for _ in range(rng.randint(3, 120))]
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(rng.randint(1, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(["scoundrel", "blockhead", "vermin"]))
        rows.append((i, " ".join(w), toxic))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int").persist()


def test_toxicity_on_held_out_rows(insults):
    held_out = in_fold(F.col("doc_id"), 0)
    model = train_toxicity(insults, insults.where(~held_out), shape=SMALL)
    got = toxicity(insults, model).where(held_out).select("toxic", "predicted", "score").collect()
    assert np.mean([r.toxic == r.predicted for r in got]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_toxicity_scores_depend_on_the_text_alone(insults):
    model = train_toxicity(insults, insults, shape=SMALL, epochs=1)
    plain = {r.doc_id: r.score for r in toxicity(insults, model).collect()}
    moved = insults.withColumn("doc_id", 699 - F.col("doc_id")).withColumn("toxic", 1 - F.col("toxic")).repartition(7)
    assert {699 - r.doc_id: r.score for r in toxicity(moved, model).collect()} == plain


def test_best_threshold_takes_the_widest_gap():
    z, y = np.array([0.0, 1.0, 2.0, 5.0, 6.0]), np.array([0.0, 0, 0, 1, 1])
    assert best_threshold(z, y, np.ones(5)) == 3.5


def test_toxicity_awkward_rows(spark, edge_docs, no_docs, no_labels, insults):
    model = train_toxicity(insults, insults, shape=SMALL, epochs=1)
    assert toxicity(edge_docs, model).count() == 8 and toxicity(no_docs, model).count() == 0
    none = train_toxicity(edge_docs, no_labels, shape=SMALL)
    assert {(r.score, r.predicted) for r in toxicity(edge_docs, none).collect()} == {(0.0, 0)}
    labels = spark.createDataFrame([(1, 0), (1, 1), (5, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    out = toxicity(edge_docs, train_toxicity(edge_docs, labels, shape=SMALL), keep=["doc_id"])
    assert out.columns == ["doc_id", "score", "predicted"] and out.count() == 8


def test_toxicity_learns_from_every_row(spark):
    """Words of a few toxic rows among many, and of rows of 9,000 words, enter the model."""
    rng = random.Random(6)
    plain = [(i, " ".join(f"w{rng.randrange(50)}" for _ in range(5)), int(i % 2)) for i in range(9000)]
    rows = [(i, t + (" vermin" if y else ""), y) for i, t, y in plain] + [(10_000 + i, "w1 " * 9000 + "longword", 1) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    seen = _buckets_seen(labelled_words(docs, docs, "doc_id", "text", "toxic", SMALL), SMALL)
    word = lambda w: int(hash_words([w])[0] & np.uint64(SMALL.buckets - 1))
    assert seen[0, 1, word("vermin")] == 4500 and seen[0, 0, word("vermin")] == 0 and seen[0, 1, word("longword")] == 8
    got = toxicity(docs, train_toxicity(docs, docs, shape=SMALL, epochs=1)).select("toxic", "predicted").collect()
    assert np.mean([r.toxic == r.predicted for r in got]) > 0.99


# ------------------------------------------------------------------ scoring
def _tokens(text):
    return SPACE.findall((text or "").translate(LOWER)) + [""]


@pytest.mark.parametrize("head_words", [50, 200_000])
def test_scores_match_brute_force(docs, head_words):
    """The base score, and the model's own from its classes, token by token."""
    rows = [(r.doc_id, _tokens(r.text)) for r in docs.collect()]
    train = [t for i, t in rows if not _held_out(i, 1)]
    count = Counter(w for t in train for w in t)
    n, v = sum(count.values()), len(count)
    settings = dict(head_words=head_words, max_classes=24, sweeps=1, salts=2)
    fold = ~in_fold(F.col("doc_id"), 1)
    got = {r.doc_id: r for r in lm_scoring(docs, fold, **settings).collect()}
    assert len(got) == len(rows)
    model, _, rare_tokens, discount = train_class_model(docs.where(fold).select("text"), **settings)
    class_of = dict(zip(model.words.tolist(), model.own.tolist()))
    names = [w for w in sorted(count) if w]
    hashed = dict(zip(names, map(int, hash_words(names))))
    hashed[""] = int(END)
    rare, start = model.classes, model.classes + 1
    own = {w: class_of.get(h, rare) for w, h in hashed.items()}
    table, size = np.zeros((rare + 2, rare + 1)), Counter()
    for t in train:
        before = start
        for w in t:
            table[before, own[w]] += 1
            size[own[w]] += 1
            before = own[w]
    frequency = (table.sum(0) + 0.5) / (table.sum(0) + 0.5).sum()
    chance = (table + 20 * frequency) / (table.sum(1, keepdims=True) + 20)
    rare_words = [w for w in count if own[w] == rare]
    assert rare_tokens == sum(count[w] for w in rare_words)

    def emission(w):
        if own.get(w, rare) != rare:
            return count[w] / size[own[w]]
        if w in count:
            return (count[w] - discount) / rare_tokens
        return discount * len(rare_words) / rare_tokens

    better = []
    for i, t in rows:
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        classes = [own.get(w, rare) for w in t]
        score = sum(math.log10(chance[h, c] * emission(w)) for h, c, w in zip([start, *classes], classes, t))
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(count[w] > 0 for w in t), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert math.isclose(r.score, score, rel_tol=1e-6)
        if _held_out(i, 1):
            better.append((r.score - r.base_score) / len(t))
    assert np.mean(better) > 0 or head_words == 50  # the classes help on rows that training has not seen


def test_probabilities_sum_to_one(docs):
    model, rest, rare_tokens, discount = train_class_model(docs.select("text"), max_classes=12, sweeps=1, salts=2)
    rare = [r.n for r in rest.collect()]
    assert sum(rare) == rare_tokens and set(rare) == {1} and model.types == len(rare) + len(model.words)
    chance, emission = 10**model.transition, 10**model.emission
    words = (chance[:, model.own] * emission).sum(1) + chance[:, -1] * ((np.array(rare) - discount).sum() / rare_tokens + 10**model.unseen)
    assert np.allclose(words, 1, atol=1e-6)
    assert 0 < discount < 1 and model.count[np.searchsorted(model.words, END)] == docs.count()


def test_every_word_is_exchanged_and_the_likelihood_never_falls(docs):
    model, rest, rare_tokens, _ = train_class_model(docs.select("text"), sweeps=3)
    assert math.isclose(model.exchanged, 1 - rare_tokens / model.tokens) and model.exchanged > 0.75  # all but the words that occur once
    assert model.classes == round(len(model.words) ** 0.5)
    assert len(model.reached) > 4 and all(b >= a for a, b in zip(model.reached, model.reached[1:]))


def test_best_class_is_the_best_likelihood():
    """A word moves where the likelihood, counted anew, is (about) the greatest."""
    rng = np.random.default_rng(6)
    kind = np.repeat([0, 1, 2], 20)
    words = [int(w) for c in rng.integers(0, 3, 4000) for w in (rng.integers(0, 20) + 20 * c, rng.integers(0, 20) + 20 * ((c + 1) % 3))]
    own = kind.copy()
    wrong = rng.choice(60, 6, replace=False)
    own[wrong] = (own[wrong] + 1) % 3
    text = np.array(words)
    pairs = np.stack([text[:-1], text[1:]], axis=1)

    def table(own):
        t = np.zeros((5, 4))
        np.add.at(t, (own[pairs[:, 0]], own[pairs[:, 1]]), 1)
        return t

    t = table(own)
    left, right = np.zeros((60, 5)), np.zeros((60, 4))
    np.add.at(left, (pairs[:, 1], own[pairs[:, 0]]), 1)
    np.add.at(right, (pairs[:, 0], own[pairs[:, 1]]), 1)
    to = best_classes(left, right, own, t)
    after = own.copy()
    for w in np.flatnonzero(to != own):
        trial = [likelihood(table(np.where(np.arange(60) == w, c, own))) for c in range(3)]
        assert trial[to[w]] >= trial[own[w]]
        after[w] = to[w]
    assert likelihood(table(after)) > likelihood(t)


def test_exchange_finds_planted_classes(spark):
    rng = random.Random(1)
    rows = [(" ".join(f"{'abc'[(k + j) % 3]}{rng.randrange(10)}" for j in range(rng.randint(6, 30))),) for k in range(300)]
    texts = spark.createDataFrame(rows, "text string")
    names = sorted({w for (t,) in rows for w in t.split()})
    words = np.append(hash_words(names), END)
    order = np.argsort(words)
    n = Counter(w for (t,) in rows for w in t.split())
    counts = np.append([n[w] for w in names], len(rows))
    own, _, reached = exchange(encoded(texts, words[order]), words[order], counts[order], 5, 6, 3)
    found = {(names + [""])[k]: c for k, c in zip(order, own)}
    kinds = {c: Counter(w[:1] for w in found if found[w] == c) for c in set(found.values())}
    assert sum(max(k.values()) for k in kinds.values()) >= 0.9 * len(found)  # words of a class are of one kind
    assert all(b >= a for a, b in zip(reached, reached[1:]))


def test_scoring_awkward_rows(edge_docs, no_docs):
    rows = edge_docs.collect()
    count = Counter(w for r in rows if r.doc_id != 4 for w in _tokens(r.text))
    n, v = sum(count.values()), len(count)
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in lm_scoring(edge_docs, F.coalesce(F.col("doc_id") != 4, F.lit(True)), max_classes=3).collect()), key=str)
    want = [(r.doc_id, len(t), sum(count[w] > 0 for w in t), round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 6)) for r in rows for t in [_tokens(r.text)]]
    assert [g[:3] for g in got] == [w[:3] for w in sorted(want, key=str)]
    assert all(abs(g[3] - w[3]) < 1e-3 for g, w in zip(got, sorted(want, key=str)))
    assert lm_scoring(no_docs, F.lit(True)).count() == 0
    untrained = lm_scoring(edge_docs, F.lit(False)).collect()
    assert len(untrained) == 8 and all(r.base_score == r.score == 0 and r.n_known == 0 for r in untrained)


# ------------------------------------------------------------------ mixing
@pytest.fixture(scope="module")
def sources(spark):
    rng = random.Random(9)
    rows = []
    for i in range(600):
        kind = int(rng.random() < 0.3)
        w = [rng.choice(["alpha", "beta", "gamma"] if kind else ["delta", "epsilon", "zeta"]) + str(rng.randrange(20)) for _ in range(rng.randint(5, 60))]
        rows.append((i, " ".join(w).upper() if kind else " ".join(w), kind))
    return spark.createDataFrame(rows, "doc_id long, text string, kind int").persist()


def test_mixture_reaches_targets(sources):
    labels = sources.where("doc_id % 2 = 0").select("doc_id", F.col("kind").alias("quality"))
    rated, mixture = mixing_rates(sources, labels, {0: 0.4, 1: 0.6})
    rows = rated.collect()
    accuracy = np.mean([(r.posterior[1] > 0.5) == (r.kind == 1) for r in rows])
    assert accuracy > 0.97
    total = sum(r.rate * r.n_tokens for r in rows)
    shares = [sum(r.rate * r.n_tokens * r.posterior[d] for r in rows) / total for d in (0, 1)]
    assert np.allclose(shares, [0.4, 0.6], atol=0.01)
    assert np.allclose(mixture.totals, mixture.targets, rtol=0.02) and all(r.rate >= 0 for r in rows)
    copies = sum(r.copies * r.n_tokens for r in rows)
    assert abs(copies / total - 1) < 0.1 and mixed(rated, ["doc_id"]).count() == sum(r.copies for r in rows)


def test_projected_gradient_is_optimal(sources):
    """Compare with many small projected steps over collected rows."""
    labels = sources.select("doc_id", F.col("kind").alias("quality"))
    rated, m = mixing_rates(sources, labels, {0: 0.95, 1: 0.05}, total=5000.0, ridge=0.05, max_steps=60, tolerance=1e-7)
    rows = rated.collect()
    p, n = np.array([r.posterior for r in rows]), np.array([r.n_tokens for r in rows], float)
    r = np.full(len(rows), m.base_rate)
    floor = np.maximum(m.targets, 1e-3 * 5000)
    for _ in range(4000):
        r = np.maximum(0, r - 0.2 * m.step_size * (p @ (((r * n) @ p - m.targets) / floor) + m.ridge * (r - m.base_rate)))
    assert np.allclose([x.rate for x in rows], r, atol=0.02)


def test_rates_of_domains_that_are_hard_to_tell_apart(spark):
    """The projected gradient at the end is zero, however alike the posteriors are."""
    rng = random.Random(3)
    rows = [(rng.randint(1, 900), [p, 1 - p]) for p in (0.5 + rng.uniform(-0.02, 0.02) for _ in range(500))]
    df = spark.createDataFrame(rows, "n_tokens long, posterior array<double>")
    n, p = np.array([r[0] for r in rows], float), np.array([r[1] for r in rows])
    for least, weights in ((0.0, {0: 0.507, 1: 0.493}), (0.0, {0: 0.9, 1: 0.1}), (0.5, {0: 0.52, 1: 0.48})):
        m = solve_rates(df, [0, 1], weights, None, least, 1e-6, 40, 1e-3)
        r = np.array([x.rate for x in df.select("posterior", m.rate().alias("rate")).collect()])
        floor = np.maximum(m.targets, 1e-3 * m.targets.sum())
        totals = (r * n) @ p
        gradient = p @ ((totals - m.targets) / floor) + m.ridge * (r - m.base_rate)
        assert np.allclose(m.totals, totals, rtol=1e-6) and (r >= least).all()
        assert np.abs(np.where(r > least + 1e-9, gradient, np.minimum(gradient, 0))).max() < 1e-4
        assert m.missed == [d for d in (0, 1) if abs(totals[d] - m.targets[d]) > 1e-3 * m.targets.sum()]
        assert bool(m.missed) == (weights[0] > 0.51)
        assert np.allclose(r, newton_rates(n, p, m), atol=1e-3) and m.steps <= 20
    with pytest.warns(UserWarning, match="do not reach"):  # too few steps: the best so far, and what is missed
        m = solve_rates(df, [0, 1], {0: 0.52, 1: 0.48}, None, 0.5, 1e-6, 2, 1e-9)
    assert m.steps == 2 and m.missed


def newton_rates(n, p, m):
    """The same rates by damped Newton steps on the dual."""
    floor = np.maximum(m.targets, 1e-3 * m.targets.sum())
    v, bend = np.zeros(len(floor)), m.ridge * (m.base_rate - m.least_rate)

    def at(v):
        q = p @ v
        cost = np.where(q < bend, q * q / (2 * m.ridge) - m.base_rate * q, -m.least_rate * q - bend * bend / (2 * m.ridge))
        r = np.maximum(m.least_rate, m.base_rate - q / m.ridge)
        return (floor * v * v).sum() / 2 + m.targets @ v + n @ cost, floor * v + m.targets - (r * n) @ p, r, n * (q < bend)

    for _ in range(100):
        value, slope, r, free = at(v)
        if np.abs(slope).max() < 1e-9 * m.targets.sum():
            break
        move, size = -np.linalg.solve(np.diag(floor) + (p * free[:, None]).T @ p / m.ridge, slope), 1.0
        while at(v + size * move)[0] > value + 1e-4 * size * (slope @ move) + 1e-12 * abs(value) and size > 1e-9:
            size /= 2
        v = v + size * move
    return r


def test_mixing_awkward_rows(spark, edge_docs, no_docs, no_labels):
    rated, _ = mixing_rates(edge_docs, no_labels, {0: 0.5, 1: 0.5})
    assert {(r.rate, r.copies) for r in rated.collect()} == {(1.0, 1)} and rated.count() == 8
    labels = spark.createDataFrame([(1, 0), (5, 1), (4, 1), (None, 0), (7, None)], "doc_id long, quality int")
    rated, _ = mixing_rates(edge_docs, labels, {0: 0.5, 1: 0.5}, least_rate=1.0)
    assert rated.count() == 8 and all(r.copies >= 1 for r in rated.collect())
    assert mixing_rates(no_docs, labels, {0: 1.0})[0].count() == 0
