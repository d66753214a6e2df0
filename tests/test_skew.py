"""A third of all rows under one key: results whole, nothing in one group."""

from __future__ import annotations

from datetime import timedelta

import numpy as np
from pyspark.sql import functions as F

from seriesengine.operators import cleanse, crosscorr, regime, shocks, status
from seriesengine.operators.layout import index_series, with_halo
from tests.conftest import START, TINY, timeline_frame
from verification.queries import comparable


def skewed(spark):
    """One long series and many short ones with the same first days."""
    rng = np.random.default_rng(11)
    prices = [float(p) for p in np.round(3 + np.cumsum(rng.normal(0, 0.03, 900)), 2)]
    parts = [timeline_frame(spark, prices).withColumn("k", F.lit("hot"))]
    for i in range(15):
        parts.append(timeline_frame(spark, prices[:90]).withColumn("k", F.lit(f"cold{i}")))
    frame = parts[0]
    for part in parts[1:]:
        frame = frame.unionByName(part)
    return frame, prices


def rows_of(df):
    return sorted(tuple(r) for r in comparable(df).fillna(-1).collect())


def test_hot_series_equals_the_series_alone(spark):
    frame, prices = skewed(spark)
    keyed = index_series(frame, ["k"], TINY)
    alone = index_series(timeline_frame(spark, prices), layout=TINY)
    assert keyed.max_rows == alone.max_rows == 900
    for operator in (
        regime.regime_daily,
        regime.regime_history,
        shocks.shock_ranking,
        crosscorr.lag_sweep,
        status.status_snapshot,
    ):
        result = operator(keyed)
        hot = result.filter("k = 'hot'").drop("k")
        assert rows_of(hot) == rows_of(operator(alone)), operator
        assert result.select("k").distinct().count() == 16


def test_no_chunk_exceeds_its_bound(spark):
    frame, _ = skewed(spark)
    before, after = 40, 5
    sizes = with_halo(index_series(frame, ["k"], TINY), before, after).groupBy("k", "_chunk").count()
    assert sizes.agg(F.max("count")).first()[0] <= TINY.chunk_rows + before + after


def test_hot_business_key_sends_one_row_per_task(spark):
    rows = spark.range(0, 30_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 5000).alias("key"),
        F.col("id").alias("version"),
        (F.col("id") * 2).alias("value"),
    )
    newest = cleanse.latest_per_key(rows, ["key"], "version")
    expected = rows.groupBy("key").agg(F.max("version").alias("version"))
    assert newest.count() == expected.count()
    assert newest.join(expected, ["key", "version"]).count() == expected.count()
    assert newest.filter("key = -1").first()["version"] == 29_999 - 29_999 % 3


def test_series_over_many_years_is_numbered_through_buckets(spark):
    days = [START + timedelta(days=97 * i) for i in range(500)]
    frame = spark.createDataFrame([(d, 1.0) for d in days], "date date, diesel_usd_gal double")
    series = index_series(frame, layout=TINY)
    assert [r["pos"] for r in series.frame.orderBy("date").collect()] == list(range(500))
    assert series.frame.select("n_rows").distinct().first()[0] == 500


def test_empty_series_give_empty_results(spark, layout):
    frame = timeline_frame(spark, [1.0]).limit(0)
    series = index_series(frame, layout=layout)
    assert series.max_rows == 0
    for operator in (
        crosscorr.lag_sweep,
        shocks.shock_ranking,
        regime.regime_daily,
        regime.regime_history,
    ):
        assert operator(series).count() == 0
