"""Days against periods, and the known events."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from seriesengine.functions import labels
from seriesengine.operators import events, status
from seriesengine.operators.layout import index_series
from tests.conftest import TINY, timeline_frame

DAY = date(2010, 1, 1)


def plain(day, periods, other):
    if day is None:
        return None
    held = [p for p in periods if None not in p and p[0] <= day <= p[1]]
    return min(held)[2] if held else other


@pytest.mark.parametrize("seed", range(4))
def test_equals_a_scan_of_all_periods(spark, seed):
    rng = random.Random(seed)
    at = lambda: DAY + timedelta(days=rng.randint(0, 1500))
    periods = [(a := at(), a + timedelta(days=rng.choice([-5, 0, 3, 31, 200, 900])), f"k{i}") for i in range(30)]
    periods += [(None, DAY, "a"), (DAY, None, "b"), (DAY, DAY + timedelta(days=3000), None)]
    days = [at() for _ in range(400)] + [None, date(1890, 5, 5), date(2100, 1, 1)]
    days += [d for p in periods for d in p[:2]]
    rows = spark.createDataFrame(
        [(i, d, "x", "y") for i, d in enumerate(days)], "n int, day date, key string, first string"
    )
    table = spark.createDataFrame(periods, events.PERIODS)
    found = events.with_event_key(rows, "day", table, name="event", other="none")
    assert found.columns == [*rows.columns, "event"]
    got = {r["n"]: r["event"] for r in found.collect()}
    assert got == {i: plain(d, periods, "none") for i, d in enumerate(days)}
    assert events.with_event_key(rows.limit(0), "day", table).count() == 0
    empty = events.with_event_key(rows, "day", table.limit(0), name="key", other="none")
    assert empty.columns == ["n", "day", "first", "key"]
    assert {r["key"] for r in empty.collect()} == {"none", None}


def test_known_periods_give_the_known_keys(spark):
    rows = spark.sql("SELECT explode(sequence(date'2003-06-01', date'2024-06-01')) AS day")
    both = events.with_event_key(rows, "day").withColumn("same", labels.event_key(F.col("day")))
    assert both.filter("narrative_key <> same OR narrative_key IS NULL").count() == 0
    assert both.select("narrative_key").distinct().count() == len(labels.EVENT_PERIODS) + 1


def test_days_and_periods_meet_in_equi_joins(spark):
    rows = spark.range(1000).selectExpr("date_add(date'2000-01-01', cast(id AS int)) AS day")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = events.with_event_key(rows, "day")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert plan.count("SortMergeJoin") == 2


def test_periods_of_the_caller_name_an_analogue(spark):
    prices = [2 + (i % 40) / 10 for i in range(900)]
    frame = timeline_frame(spark, prices, start=date(2003, 1, 1))
    series = index_series(frame, layout=TINY)
    plain_row = status.historical_analogue(series).first()
    week = date.fromisoformat(plain_row["week"])
    own = spark.createDataFrame([(week, week, "mine")], events.PERIODS)
    row = status.historical_analogue(series, periods=own).first()
    assert row["narrative_key"] == "mine"
    assert {k: v for k, v in row.asDict().items() if k != "narrative_key"} == {
        k: v for k, v in plain_row.asDict().items() if k != "narrative_key"
    }
