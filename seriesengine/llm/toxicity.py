"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives, a sample of all texts is the unlabelled
set, toxic ones included. With the class prior p, the risk of a classifier is

    p * E_pos[loss(+)] + max(0, E_unl[loss(-)] - p * E_pos[loss(-)])

whose second term is the risk on negatives, which cannot be negative: where it falls
below zero, the step climbs out of it instead. A linear classifier on the presence of
words, word beginnings and, in runs longer than words are, overlapping pieces is fitted
in numpy on the two bounded samples. Features are chosen by how much more often they
occur in the positives than in all unlabelled texts, which are counted in full.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesengine.llm.common import fold_of, text_of
from seriesengine.scratch import materialize

_WORD = re.compile(r"[^\W\d_]+")

# Lengths of the word beginnings that are features beside whole words.
_BEGINNINGS = (5, 7)

# Runs of letters above this length are no words; all their pieces of so many
# characters are features instead, so that every character can reach the score.
_LONGEST = 40
_PIECE = 4

# Features that a task counts before it hands the counts on.
_COUNTED = 200_000


@dataclass(frozen=True)
class Rules:
    """Bounds of the fit: documents of each sample, features, and the descent.

    ``positives`` and ``unlabelled`` bound the samples, which are drawn by a hash of the
    document id; texts that repeat in a sample count once. A feature must occur in
    ``min_docs`` positives of the sample or unlabelled documents of the whole training
    fold, and its shares in the two must differ by ``min_z`` standard errors.
    """

    positives: int = 8192
    unlabelled: int = 16384
    features: int = 2048
    min_docs: int = 20
    min_z: float = 5.0
    steps: int = 300
    rate: float = 0.1
    penalty: float = 1e-4


RULES = Rules()


@dataclass
class Model:
    """Weights by feature, intercept, and the class prior that was used."""

    weights: dict[str, float]
    intercept: float
    prior: float


def features_of(text: str) -> set[str]:
    """Words of a text, their beginnings, which end in ``*``, and pieces, which begin with it."""
    runs = set(_WORD.findall(text.lower()))
    words = {w for w in runs if len(w) <= _LONGEST}
    found = words.union(*({w[:n] + "*" for w in words if len(w) > n} for n in _BEGINNINGS))
    for run in runs - words:
        found |= {"*" + run[i : i + _PIECE] for i in range(len(run) - _PIECE + 1)}
    return found


def nnpu(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], size: int, prior: float, rules: Rules
) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise the non-negative risk of a logistic loss.

    Documents are arrays of the features they have.
    """
    docs = positive + unlabelled
    rows = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    columns = np.concatenate(docs).astype(np.int64) if len(rows) else np.zeros(0, np.int64)
    n, m = len(positive), len(unlabelled)
    is_positive = np.arange(n + m) < n
    weights, intercept = np.zeros(size), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, rules.steps + 1):
        z = intercept + np.bincount(rows, weights[columns], n + m)
        probability = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        as_negative = np.logaddexp(0, z)
        negative_risk = as_negative[n:].mean() - prior * as_negative[:n].mean()
        # Gradients of the loss by z: p - 1 as a positive, p as a negative.
        negative = np.where(is_positive, -prior / n * probability, probability / m)
        if negative_risk >= 0:
            slope = negative + np.where(is_positive, prior / n * (probability - 1), 0.0)
        else:
            slope = -negative
        gradient = np.append(
            np.bincount(columns, slope[rows], size) + 2 * rules.penalty * weights, slope.sum()
        )
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights -= rules.rate * move[:-1]
        intercept -= rules.rate * move[-1]
    return weights, float(intercept)


def _drawn(ids: DataFrame, salt: str, most: int) -> DataFrame:
    """At most ``most`` distinct ids, in the order of a hash."""
    return ids.distinct().orderBy(F.xxhash64("doc_id", F.lit(salt)), "doc_id").limit(most)


def _with_features(rows: DataFrame) -> DataFrame:
    """``positive, features`` of ``positive, text``."""

    @F.arrow_udf("array<string>")
    def found(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(features_of(t.as_py())) for t in texts], pa.list_(pa.string()))

    return rows.select("positive", found("text").alias("features"))


def _document_counts(texts: DataFrame) -> DataFrame:
    """``feature, held``: in how many of the texts a feature occurs, over all of them.

    Tasks add up their own texts first and hand on bounded tables of counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def table() -> pa.RecordBatch:
            columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=["feature", "held"])

        for batch in batches:
            for text in batch.column(0):
                held.update(features_of(text.as_py()))
                if len(held) >= _COUNTED:
                    yield table()
        yield table()

    counts = texts.select("text").mapInArrow(run, "feature string, held long")
    return counts.groupBy("feature").agg(F.sum("held").alias("held"))


def fit(docs: DataFrame, labels: DataFrame, rules: Rules = RULES) -> Model:
    """Fit on ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, toxic``).

    Rows of the held-out fold take no part; null ids and null labels neither. Several
    labels of a document count as toxic if one is. Without confirmed toxic documents
    the model has no features and scores every text 0.
    """
    known = (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .filter(fold_of(F.col("doc_id")) != 0)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").alias("toxic"))
    )
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    own = own.filter("doc_id IS NOT NULL").filter(fold_of(F.col("doc_id")) != 0)
    ids = own.select("doc_id")
    counted = known.agg(F.count("*").alias("all"), F.sum((F.col("toxic") == 1).cast("long")).alias("toxic")).first()
    if not counted["toxic"]:
        return Model({}, -30.0, 0.0)
    prior = min(0.9, counted["toxic"] / counted["all"])

    # The drawn ids are bounded by the rules, so they may be sent to all executors.
    toxic = _drawn(known.filter("toxic = 1").select("doc_id"), "positive", rules.positives)
    every = _drawn(ids, "unlabelled", rules.unlabelled)
    drawn = toxic.select("doc_id", F.lit(True).alias("positive")).unionByName(
        every.select("doc_id", F.lit(False).alias("positive"))
    )
    drawn, _ = materialize(drawn, "toxicity-drawn")
    total = own.count()
    rows = own.join(F.broadcast(drawn), "doc_id").dropDuplicates(["positive", "text"])
    sample, sizes = materialize(
        _with_features(rows.select("positive", "text")),
        "toxicity-sample",
        positive=F.sum(F.col("positive").cast("long")),
        unlabelled=F.sum((~F.col("positive")).cast("long")),
    )
    n, m = sizes["positive"] or 0, sizes["unlabelled"] or 0
    if not n or not m:
        return Model({}, -30.0, prior)

    # Every text of the fold is counted, few of them often: the whole fold is the
    # unlabelled set of the statistics, the sample is for the descent alone.
    everywhere = _document_counts(own)
    among = (
        sample.filter("positive")
        .select(F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.count("*").alias("p"))
    )
    counts = everywhere.filter(F.col("held") >= rules.min_docs).join(among, "feature", "left")
    p, u = F.coalesce("p", F.lit(0)) / float(n), F.col("held") / float(total)
    pooled = (F.coalesce("p", F.lit(0)) + F.col("held") + 1) / F.lit(n + total + 2.0)
    spread = F.sqrt(pooled * (1 - pooled) * F.lit(1.0 / n + 1.0 / total))
    chosen = [
        r["feature"]
        for r in counts.withColumn("z", F.abs(p - u) / spread)
        .filter(F.col("z") >= rules.min_z)
        .orderBy(F.desc("z"), "feature")
        .limit(rules.features)
        .select("feature")
        .collect()
    ]
    index = {f: i for i, f in enumerate(chosen)}

    @F.arrow_udf("array<int>")
    def known(features: pa.Array) -> pa.Array:
        own = [[index[f] for f in fs if f in index] for fs in features.to_pylist()]
        return pa.array(own, pa.list_(pa.int32()))

    collected = sample.select("positive", known("features").alias("own")).toArrow()
    is_positive = collected.column("positive").to_pylist()
    own_features = [np.array(x, np.int64) for x in collected.column("own").to_pylist()]
    positive = [f for f, p in zip(own_features, is_positive, strict=True) if p]
    unlabelled = [f for f, p in zip(own_features, is_positive, strict=True) if not p]
    weights, intercept = nnpu(positive, unlabelled, len(chosen), prior, rules)
    return Model(dict(zip(chosen, weights.tolist(), strict=True)), intercept, prior)


def score(text: Column, model: Model) -> Column:
    """Probability, 0 to 1, that a text is toxic, from the whole text alone.

    Null counts as empty, and an empty text gets the intercept's score. Only texts go
    to the Python workers; the other columns of a row stay where they are.
    """
    weights = model.weights

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        found = []
        for text in texts:
            known = weights.keys() & features_of(text.as_py())
            z = model.intercept + sum(weights[f] for f in sorted(known))
            found.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return pa.array(found, pa.float64())

    return scores(text_of(text))


def scored(docs: DataFrame, labels: DataFrame, rules: Rules = RULES) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    model = fit(docs, labels, rules)

    rows = slim.select("doc_id", score(F.col("text"), model).alias("score"))
    return rows.select(
        "doc_id",
        (fold_of(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, rules: Rules = RULES) -> DataFrame:
    """The rows of ``docs`` whose score is below one half, with their columns."""
    columns = [F.col("row")[c].alias(c) for c in docs.columns]
    model = fit(docs, labels, rules)
    judged = docs.select(F.struct("*").alias("row"), score(F.col("text"), model).alias("score"))
    return judged.filter("score < 0.5").select(*columns)
