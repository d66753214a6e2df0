"""Importance resampling against a plain version, and the search for its cutoff."""

from __future__ import annotations

import collections
import dataclasses
import hashlib
import math
import re
import zlib

import duckdb
import pytest

from seriesengine.llm import resampling
from seriesengine.llm.common import table
from seriesengine.llm.oracle import ORACLE
from seriesengine.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def runs_of(text, longest):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, rules):
    """Rows of ``doc_id, n_features, weight, score, rank`` of pairs of an id and a text."""

    def hashed(features):
        return collections.Counter(zlib.crc32(f.encode()) % rules.buckets for f in features)

    split = [runs_of(text, rules.longest_run) for _, text in docs]
    s = collections.Counter()
    t = collections.Counter()
    for _, features in split:
        s.update(hashed(features))
    for text in target:
        t.update(hashed(runs_of(text, rules.longest_run)[1]))
    all_s, all_t = s.total() + rules.buckets, t.total() + rules.buckets
    rows = []
    for (doc_id, _), (n_words, features) in zip(docs, split, strict=True):
        weight = sum(
            n * math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t)))
            for b, n in hashed(features).items()
        )
        name = f"{rules.seed}:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append([doc_id, len(features), weight, weight + noise, None, n_words])
    drawable = [r for r in rows if r[5] >= rules.min_words]
    drawable.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, row in enumerate(drawable[: len(drawable) * rules.percent // 100], 1):
        row[4] = rank
    return collections.Counter(tuple(r[:5]) for r in rows)


def pairs_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize(
    "rules",
    [
        resampling.Rules(min_words=5, percent=40),
        resampling.Rules(longest_run=3, buckets=64, min_words=1, percent=25, steps=20, reach=1, accuracy=20),
        resampling.Rules(min_words=0, percent=100, buckets=7),
        resampling.Rules(min_words=0, percent=0),
        resampling.Rules(min_words=10**9),
    ],
    ids=["plain", "runs", "all", "none", "nothing drawable"],
)
def test_equals_the_plain_version_on_odd_documents(spark, odd_docs, no_docs, rules):
    target = spark.createDataFrame([(1, "Gamma delta, GAMMA nu"), (2, None), (3, "")], "item_id long, text string")
    for goal in (target, no_docs):
        found = resampling.resample(odd_docs.repartition(3), goal, rules).collect()
        texts = [r.text for r in goal.collect()]
        assert collections.Counter(map(tuple, found)) == plain(pairs_of(odd_docs), texts, rules)
    assert resampling.resample(no_docs, target, rules).collect() == []


def test_query_equals_the_plain_version_and_its_sql(spark):
    found = collections.Counter(map(tuple, QUERIES["op11_resampling"](spark, FOLDER).collect()))
    docs, target = (table(spark, FOLDER, name) for name in ("documents", "benchmark"))
    assert found == plain(pairs_of(docs), [r.text for r in target.collect()], resampling.RULES)
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    assert found == collections.Counter(connection.execute(ORACLE["op11_resampling"]).fetchall())


def test_bracket_widens_until_the_cutoff_is_inside(spark):
    """A sketch that is wrong on either side costs further counts, not the result."""
    rules = dataclasses.replace(resampling.RULES, steps=100, reach=1, percent=10)
    scored = spark.range(1000).selectExpr("id AS doc_id", "id * 3 AS score")
    for sketch in (range(0, 3030, 30), [0] * 101, [10**6] * 101, [*range(0, 2900, 29), 2901]):
        low, high, over = resampling.bracket(scored, list(sketch), 100, rules)
        scores = [3 * i for i in range(1000)]
        assert over == sum(high is not None and s > high for s in scores) < 100
        assert sum(low is None or s >= low for s in scores) >= 100
    low, high, _ = resampling.bracket(scored, list(range(0, 3030, 30)), 100, rules)
    assert sum(low <= s <= high for s in scores) <= 30


def test_ties_in_score_are_drawn_by_id(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "repeat('word ', 20) AS text")
    docs = docs.unionByName(docs.limit(50))
    target = spark.createDataFrame([("word",)], "text string")
    rules = resampling.Rules(percent=50)
    found = resampling.resample(docs, target, rules)
    assert collections.Counter(map(tuple, found.collect())) == plain(pairs_of(docs), ["word"], rules)


def test_drawn_documents_keep_their_columns(spark, odd_docs):
    target = spark.createDataFrame([("gamma",)], "text string")
    rules = resampling.Rules(min_words=5, percent=30)
    ranked = resampling.resample(odd_docs, target, rules).filter("rank IS NOT NULL").collect()
    kept = resampling.resampled(odd_docs, target, rules)
    assert kept.columns == odd_docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in ranked}


def test_draw_leans_to_the_target(spark):
    rows = [(i, ("sun moon star " if i % 5 == 0 else "rock sand clay ") * 10) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([("moon star sun moon",)], "text string")
    kept = resampling.resampled(docs, target).collect()
    assert len(kept) == 50 and all(r.doc_id % 5 == 0 for r in kept)
