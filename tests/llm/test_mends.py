"""Inputs that once were dropped, crashed or took very long."""

from __future__ import annotations

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from seriesengine.llm import hmm, mixing, pii, secrets, spans, toxicity, training_order
from seriesengine.llm.oracle import ORACLE
from seriesengine.llm.queries import QUERIES

# Queries that SQL can state, and those that a plain version in these tests stands for.
IN_SQL = {"op11_resampling", "op12_sharding"}


def test_which_queries_have_sql():
    assert set(ORACLE) == IN_SQL
    assert sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0])) == list(QUERIES)
    assert len(QUERIES) == 13


@pytest.mark.parametrize("text", ["7" * 1_000_000, "1.2." * 200_000, "x7" * 300_000, "+7" * 300_000])
def test_long_digit_runs_take_no_time(spark, text):
    docs = spark.createDataFrame([(1, text + " 10.0.0.1 " + text)], "doc_id long, text string")
    docs.selectExpr("length(text)").collect()
    start = time.perf_counter()
    found = pii.with_personal_data(docs).select(spans.listed(F.col("pii"))).first()[0]
    assert time.perf_counter() - start < 60
    assert f"ip:{len(text) + 1}:{len(text) + 9}" in found or "1.2." in text


@pytest.mark.parametrize("text", ["eyJ" * 200_000, "AKIA" * 100_000, "deadbeef" * 100_000, "token" * 100_000])
def test_long_runs_hold_no_scan_up(spark, tmp_path, text):
    versions = spark.createDataFrame([(1, text)], "path long, content string")
    start = time.perf_counter()
    assert secrets.scan(versions, str(tmp_path / "ledger")) == 1
    assert time.perf_counter() - start < 60


def test_the_ledger_holds_no_secret(spark, tmp_path):
    texts = ["my password = hunter2hunter2 ok", "other password: hunter2hunter2", "AKIA" + "Z7" * 10]
    versions = spark.createDataFrame(list(enumerate(texts)), "path long, content string")
    for name, key in (("plain", None), ("keyed", "pepper")):
        ledger = str(tmp_path / name)
        secrets.scan(versions, ledger, key=key)
        rows = spark.read.parquet(ledger).select(F.to_json(F.struct("*"))).collect()
        assert rows and not any("hunter2" in r[0] or "Z7Z7" in r[0] for r in rows)
        found = {r.path: r.findings for r in secrets.findings(versions, ledger).collect()}
        matches = {0: "password = hunter2hunter2", 1: "password: hunter2hunter2", 2: texts[2]}
        for path, (finding, *more) in found.items():
            assert not more
            assert texts[path][finding["start"] : finding["end"]] == matches[path]
            digest = hashlib.sha256(f"pepper{matches[path]}".encode()).hexdigest()
            assert finding["digest"] == (digest if key else None)


def test_characters_behind_the_fortieth_reach_the_score(spark):
    """One run of letters a text, half of them ending in another word."""
    bad = lambda i: i % 2 == 0
    rng = random.Random(2)
    run = lambda: "".join(rng.choices("abcdefgh", k=40))
    docs = spark.createDataFrame(
        [(i, run() + ("slurslur" if bad(i) else "kindkind") + run()) for i in range(400)],
        "doc_id long, text string",
    )
    marks = spark.createDataFrame([(i, int(bad(i))) for i in range(0, 400)], "doc_id long, toxic int")
    rules = toxicity.Rules(min_docs=3, min_z=2.0)
    for r in toxicity.scored(docs, marks, rules).collect():
        assert r.predicted == int(bad(r.doc_id))


def test_features_are_counted_in_all_texts(spark):
    texts = ["common rare" if i % 50 == 0 else "common" for i in range(500)] + ["", "x" * 45]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(7)
    held = {r["feature"]: r["held"] for r in toxicity._document_counts(rows).collect()}
    assert (held["common"], held["commo*"], held["rare"], held["*xxxx"]) == (500, 500, 10, 1)
    assert "x" * 45 not in held


def test_model_is_trained_where_all_texts_are_long(spark):
    """The start has runs of texts of any length, and the passes run in any case."""
    words = "sun moon star sun cloud moon rain".split()
    docs = spark.createDataFrame(
        [(i, " ".join(words[(i + j * j) % 7] for j in range(400))) for i in range(40)],
        "doc_id long, text string",
    )
    short = hmm.Settings(start_tokens=50)
    rows = hmm.scores(docs, short).collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_a_column_named_places_is_replaced(spark, odd_docs):
    docs = odd_docs.withColumn("places", F.lit("mine"))
    mixed = mixing.mixed(docs, with_places=True)
    assert mixed.columns.count("places") == 1
    assert mixed.schema["places"].dataType.typeName() == "array" and mixed.count()
    assert mixing.mixed(docs).columns == docs.columns


def test_stages_return_the_columns_of_documents(spark, odd_docs):
    clashing = odd_docs.withColumn("places", F.lit("mine")).withColumn("place", F.lit(7))
    docs = clashing
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs, _ = corpus_pipeline.materialize(stage(spark, docs, "/root/testdata/sf0.001"), name)
        assert docs.columns == clashing.columns


def test_shards_of_a_plain_path_go_to_the_default_file_system(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(30)], "doc_id long, text string")
    table = str(tmp_path / "docs")
    docs.write.parquet(table)
    root = str(tmp_path / "shards")
    layout = training_order.Layout(length=4, per_shard=8)
    manifest = training_order.materialise(spark.read.parquet(table), root, layout)
    count = manifest.count()
    assert sorted(p.name for p in (tmp_path / "shards").iterdir()) == [
        f"shard-{i:08d}.bin" for i in range(-(-count // 8))
    ]
    assert len(list(training_order.read_sequences(f"file:{root}", 0, count, layout))) == count
    with pytest.raises(ValueError, match="behind the last"):
        list(training_order.read_sequences(root, count - 1, 2, layout))


def test_base_digest_of_a_query_is_that_of_its_base_spans(spark):
    for name, kinds, by_start in (
        ("op3_pii", pii.BASE, False),
        ("op7_secrets", secrets.BASE, True),
    ):
        for r in QUERIES[name](spark, "/root/testdata/sf0.001").collect():
            every = [s.split(":") for s in r.spans.split(",") if s]
            base = [s for s in every if s[0] in kinds]
            order = [(int(s[1]), kinds.index(s[0])) if by_start else (kinds.index(s[0]), int(s[1])) for s in base]
            assert order == sorted(order)
            listed = ",".join(":".join(s) for s in base)
            assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
            for kind in kinds:
                assert r[f"n_{kind}"] == sum(s[0] == kind for s in base)
            assert not re.search(r"[^a-z0-9:,]", r.spans)
