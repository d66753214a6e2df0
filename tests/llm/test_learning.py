"""The language model, toxicity, neighbours: against brute force and held-out rows."""

from __future__ import annotations

import collections
import itertools
import math
import random
import zlib

import numpy as np
import pytest

from seriesengine.llm import hmm, neighbors, toxicity

SMALL = hmm.Settings(states=2, own_classes=8, shared_classes=4, head_words=6, start_rounds=3, passes=1, segment=16)


def test_base_scores_and_counts(odd_docs):
    rows = [(r.doc_id, (r.text or "").encode().lower().split() + [None]) for r in odd_docs.collect()]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    counts = collections.Counter(w for i, words in rows if not held(i) for w in words)
    total = sum(counts.values())
    below = math.log10(total + 0.5 * (len(counts) + 1))
    expected = sorted(
        (str(i), held(i), len(words), sum(w in counts for w in words), total,
         round(sum(math.log10(counts[w] + 0.5) - below for w in words), 6))
        for i, words in rows
    )
    found = hmm.scores(odd_docs, SMALL).collect()
    assert expected == sorted(
        (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found
    )
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)


def test_no_rows_and_no_training_rows(spark, no_docs):
    assert hmm.scores(no_docs, SMALL).count() == 0
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = hmm.scores(spark.createDataFrame([(held, "a b")], "doc_id long, text string"), SMALL).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0)
    assert math.isfinite(row.score)


def some_model(classes, states, seed=1):
    random_ = np.random.default_rng(seed)
    model = hmm.first_model(random_.uniform(1, 9, classes), hmm.Settings(states=states))
    model.start = random_.dirichlet(np.ones(states))
    model.move = random_.dirichlet(np.ones(states), states)
    return model


def by_paths(model, codes):
    """Probability of each state path."""
    out = {}
    for path in itertools.product(range(len(model.start)), repeat=len(codes)):
        p = model.start[path[0]] * model.emit[codes[0], path[0]]
        for before, state, code in zip(path, path[1:], codes[1:], strict=False):
            p *= model.move[before, state] * model.emit[code, state]
        out[path] = p
    return out


def test_likelihood_and_counts_equal_those_of_all_paths():
    model = some_model(5, 3)
    sequences = [np.array(s, np.uint16) for s in ([0, 3, 3, 1, 4, 2], [2], [4, 4, 0], [1, 1])]
    logs = hmm.log_likelihoods(model, sequences)
    counts = hmm.Counts(5, 3)
    counts.add(model, sequences)
    emit, move, start = np.zeros((5, 3)), np.zeros((3, 3)), np.zeros(3)
    for sequence, log in zip(sequences, logs, strict=True):
        paths = by_paths(model, sequence)
        total = sum(paths.values())
        assert log == pytest.approx(math.log(total), abs=1e-9)
        for path, p in paths.items():
            start[path[0]] += p / total
            for code, state in zip(sequence, path, strict=True):
                emit[code, state] += p / total
            for a, b in zip(path, path[1:], strict=False):
                move[a, b] += p / total
    np.testing.assert_allclose(counts.emit, emit, atol=1e-9)
    np.testing.assert_allclose(counts.move, move, atol=1e-9)
    np.testing.assert_allclose(counts.start, start, atol=1e-9)
    assert counts.log_likelihood == pytest.approx(logs.sum())


def test_words_and_unseen_classes_sum_to_one(spark):
    docs = spark.createDataFrame([(2, "a a b c dd ee"), (3, "a b zz")], "doc_id long, text string")
    settings = hmm.Settings(states=2, own_classes=2, shared_classes=3, start_rounds=2, passes=1)
    words = collections.Counter("a a b c dd ee a b zz".split())
    frame = spark.createDataFrame([(w, n, n) for w, n in words.items()], "word string, n_train long, n_all long")
    model, own = hmm._classes(frame, list(words), np.array(list(words.values())), 2, settings)
    parts = collections.Counter()
    for w, n in words.items():
        parts[own.get(w, 3 + zlib.crc32(w.encode()[-3:]) % 3)] += n + 0.5
    parts[2] += 2.5
    for shared in range(3, 6):
        parts[shared] += 0.5
    assert model.mass == pytest.approx([parts[i] for i in range(6)])
    assert model.emit.sum(axis=0) == pytest.approx([1, 1])
    assert hmm.scores(docs, settings).count() == 2


def test_states_help_on_held_out_texts(spark):
    rng = random.Random(2)
    kinds = [[f"{k}{i}" for i in range(30)] for k in "ab"]
    rows = [(i, " ".join(rng.choices(kinds[i % 2], k=40))) for i in range(300)]
    found = hmm.scores(
        spark.createDataFrame(rows, "doc_id long, text string"),
        hmm.Settings(states=2, passes=2, start_rounds=15, smoothing=5.0),
    ).filter("held_out").collect()
    gain = sum(r.score - r.base_score for r in found) / sum(r.n_tokens for r in found)
    assert gain > 0.2


def test_every_pass_covers_all_training_texts(spark):
    """Many texts and a long one: passes over all of them by hand give the same scores."""
    settings = hmm.Settings(states=2, own_classes=12, shared_classes=3, start_rounds=3, passes=1, segment=64, smoothing=2.0)
    rng = random.Random(5)
    sides = [rng.choices(range(8), range(1, 9), k=rng.randrange(4, 16)) for _ in range(2400)]
    sides[1] = [i % 8 for i in range(25_000)]
    rows = [(i, " ".join(f"w{(w + 4 * (i > 2000)) % 12}" for w in side)) for i, side in enumerate(sides)]
    trains = [text.split() for i, text in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    assert len(trains) > 1500 and max(map(len, trains)) > 20_000
    counts = collections.Counter(w for words in trains for w in words)
    class_of = {w: n for n, w in enumerate(sorted(counts, key=lambda w: (-counts[w], w)))}
    mass = np.full(12 + 1 + 3, 0.5)
    mass[: len(class_of)] = [counts[w] + 0.5 for w in class_of]
    mass[12] = len(trains) + 0.5

    model = hmm.first_model(mass, settings)
    codes = [np.array([class_of[w] for w in words] + [12], np.uint16) for words in trains]
    segments = [c[at : at + 64] for c in codes for at in range(0, len(c), 64)]
    for _ in range(4):
        expected = hmm.Counts(len(mass), 2)
        expected.add(model, segments)
        model = hmm.reestimated(model, expected, settings.smoothing)
    texts = [np.array([class_of[w] for w in text.split()] + [12], np.uint16) for _, text in rows]
    logs = hmm.log_likelihoods(model, texts) / math.log(10)

    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r.doc_id: r.score for r in hmm.scores(docs, settings).collect()}
    assert [found[i] for i, _ in rows] == pytest.approx(list(logs), rel=1e-9)


def toxic_rows(rng, n):
    calm = [f"word{i}" for i in range(300)]
    for i in range(n):
        toxic = rng.random() < 0.2
        words = rng.choices(calm, k=rng.randrange(5, 60)) + (rng.choices(["vile", "nasty", "awful"], k=3) if toxic else [])
        rng.shuffle(words)
        yield i, " ".join(words), int(toxic)


def test_toxicity_on_held_out_rows(spark):
    rows = list(toxic_rows(random.Random(4), 900))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows[:700]], "doc_id long, toxic int")
    truth = {r[0]: r[2] for r in rows}
    found = toxicity.scored(docs, labels).collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    kept = toxicity.accepted(docs, labels)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in found if r.score < 0.5}


def test_toxicity_of_odd_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (3, 0), (3, 1)], "doc_id long, toxic int")
    assert toxicity.scored(odd_docs, labels).count() == odd_docs.count()
    assert toxicity.scored(odd_docs, labels.limit(0)).filter("predicted = 1").count() == 0
    assert toxicity.scored(no_docs, labels).count() == 0
    assert toxicity.accepted(odd_docs, labels).columns == odd_docs.columns


def test_risk_on_negatives_stays_above_zero():
    rng = np.random.default_rng(0)
    positive = [np.array([0, rng.integers(2, 40)]) for _ in range(40)]
    unlabelled = [np.array([int(rng.random() < 0.3 and 0 or 1), rng.integers(2, 40)]) for _ in range(60)]
    weights, intercept = toxicity.nnpu(positive, unlabelled, 40, 0.3, toxicity.Rules(steps=400))
    assert np.isfinite(weights).all() and np.abs(weights).max() < 50
    assert intercept + weights[0] > intercept + weights[1]


def exact(rows, every, k):
    kept = {}
    for i, v in rows:
        if i is None or v is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        if len(v) == 4:
            kept[i] = min(kept.get(i, v), v)
    out = []
    for q in kept:
        if q % every == 0:
            near = sorted((math.dist(kept[q], v), i) for i, v in kept.items() if i != q)[:k]
            out += [(q, n + 1, i, round(d, 9)) for n, (d, i) in enumerate(near)]
    return sorted(out)


def test_neighbours_with_odd_vectors(spark):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(1, 300)]
    rows += [(i, [1.0, 0.0, 0.0, 0.0]) for i in range(300, 380)]  # a large group of equals
    rows += [(400, None), (410, []), (420, [0.0] * 4), (430, [1.0, None, 0.0, 0.0]), (None, [1.0] * 4)]
    rows += [(440, [float("nan"), 1.0, 1.0, 1.0]), (450, [float("inf"), 1.0, 1.0, 1.0]), (460, [1.0] * 5)]
    rows += [(10, [9.0, 9.0, 9.0, 9.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "0 AS rep", "1 AS tree")
    settings = neighbors.Settings(trees=4, sample=200, leaf=8, compared=100_000)
    found = neighbors.nearest(frame, every=10, settings=settings).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in found) == exact(rows, 10, 10)


def test_few_and_no_vectors(spark):
    kind = "vec_id long, embedding array<float>"
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0])], kind)
    found = [(r.query_id, r.rank, r.vec_id) for r in neighbors.nearest(frame).orderBy("rank").collect()]
    assert found == [(0, 1, 2), (0, 2, 1)]
    assert neighbors.nearest(frame.limit(0)).count() == 0
    assert neighbors.nearest(frame.limit(1)).count() == 0


def test_recall(spark):
    rng = np.random.default_rng(9)
    vectors = rng.standard_normal((3000, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbors.nearest(frame, every=60, settings=neighbors.Settings(trees=12, leaf=32, compared=900)).collect()
    truth = {(q, i) for q, _, i, _ in exact_16(vectors)}
    assert len({(r.query_id, r.vec_id) for r in found} & truth) >= 0.9 * len(truth)


def test_recall_where_the_least_budget_is_a_small_share(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "_SLICE", 500)
    vectors = np.random.default_rng(10).standard_normal((9000, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    settings = neighbors.Settings(trees=12, sample=1000, leaf=32, compared=100)
    found = neighbors.nearest(frame, every=60, settings=settings).collect()
    truth = {(q, i) for q, _, i, _ in exact_16(vectors)}
    assert len({(r.query_id, r.vec_id) for r in found} & truth) >= 0.9 * len(truth)


def exact_16(vectors):
    for q in range(0, len(vectors), 60):
        scores = np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(len(scores)), scores)) if i != q][:10]
        yield from ((q, n, int(i), float(scores[i])) for n, i in enumerate(order))
