from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pytest

from seriesengine.operators.layout import index_series
from seriesengine.operators.timeline import price_timeline, timeline_series
from seriesengine.params import DATE, FAST, SLOW, SLOW_DATE, Layout
from tests.conftest import TINY

MONDAY = date(2025, 1, 6)


def fast_frame(spark, rows):
    return spark.createDataFrame(rows, "date date, price_usd_bbl double")


def slow_frame(spark, rows):
    return spark.createDataFrame(rows, "week_ending date, price_usd_gal double")


@pytest.mark.parametrize("seed", range(4))
def test_random_reports_equal_a_scan_of_all_of_them(spark, layout, seed):
    """Every fast date has the price of the latest report at or before it that has one,
    and the date of the latest report at all."""
    rng = np.random.default_rng(seed)
    days = [MONDAY + timedelta(days=int(d)) for d in rng.choice(500, 120, replace=False)]
    fast = {d: float(i) for i, d in enumerate(days[:80])}
    slow = {d: None if rng.random() < 0.2 else float(i) for i, d in enumerate(days[60:])}
    rows = price_timeline(
        fast_frame(spark, list(fast.items())), slow_frame(spark, list(slow.items())), layout=layout
    ).collect()
    assert price_timeline(fast_frame(spark, []), slow_frame(spark, [])).count() == 0
    assert len(rows) == len(fast)
    for day, price, report, reported in (tuple(r) for r in rows):
        earlier = [d for d in slow if d <= day]
        priced = [d for d in earlier if slow[d] is not None]
        assert price == fast[day]
        assert report == (slow[max(priced)] if priced else None)
        assert reported == (max(earlier) if earlier else None)


def test_columns(spark):
    found = price_timeline(fast_frame(spark, [(MONDAY, 1.0)]), slow_frame(spark, [(MONDAY, 2.0)]))
    assert found.columns == [DATE, FAST, SLOW, SLOW_DATE]


def test_repeated_dates_are_an_error(spark, layout):
    """40,000 rows on 100 dates would fill one task; the write that numbers them refuses."""
    many = spark.range(40_000).selectExpr(
        "date_add(date'2025-01-06', cast(id % 100 AS int)) AS date", "1D + id AS price_usd_bbl"
    )
    once = slow_frame(spark, [(MONDAY, 4.0)])
    with pytest.raises(ValueError, match="39900 rows"):
        timeline_series(many, once, layout=layout)
    with pytest.raises(ValueError, match="1 rows"):
        timeline_series(fast_frame(spark, [(MONDAY, 1.0)]), once.union(once), layout=layout)
    with pytest.raises(ValueError, match="39900 rows"):
        index_series(many.withColumn("diesel_usd_gal", many["price_usd_bbl"]), layout=layout)
    keyed = many.filter("price_usd_bbl <= 200").selectExpr("price_usd_bbl <= 100 AS k", "*")
    slow = once.selectExpr("true AS k", "*")
    assert timeline_series(keyed, slow, ["k"], layout).frame.count() == 200


def test_dates_before_the_first_report_keep_a_null(spark, layout):
    fast = fast_frame(spark, [(MONDAY + timedelta(days=i), 1.0) for i in range(4)])
    slow = slow_frame(spark, [(MONDAY + timedelta(days=2), 9.0)])
    rows = price_timeline(fast, slow, layout=layout).orderBy("date").collect()
    assert [r["diesel_usd_gal"] for r in rows] == [None, None, 9.0, 9.0]


def test_reports_on_dates_without_a_fast_price_still_carry(spark, layout):
    fast = fast_frame(spark, [(MONDAY, 1.0), (MONDAY + timedelta(days=5), 2.0)])
    slow = slow_frame(spark, [(MONDAY - timedelta(days=400), 3.0), (MONDAY + timedelta(days=3), 4.0)])
    rows = price_timeline(fast, slow, layout=layout).orderBy("date").collect()
    assert [r["diesel_usd_gal"] for r in rows] == [3.0, 4.0]
    assert rows[1]["diesel_week_ending"] == MONDAY + timedelta(days=3)


def test_report_without_a_price_moves_only_the_date(spark, layout):
    fast = fast_frame(spark, [(MONDAY + timedelta(days=i), 1.0) for i in (0, 20, 40)])
    slow = slow_frame(spark, [(MONDAY, 3.0), (MONDAY + timedelta(days=20), None)])
    rows = price_timeline(fast, slow, layout=layout).orderBy("date").collect()
    assert [r["diesel_usd_gal"] for r in rows] == [3.0, 3.0, 3.0]
    assert rows[2]["diesel_week_ending"] == MONDAY + timedelta(days=20)


def test_rows_without_a_fast_price_or_date_are_dropped(spark, layout):
    fast = fast_frame(spark, [(MONDAY, None), (None, 5.0), (MONDAY + timedelta(days=1), 6.0)])
    slow = slow_frame(spark, [(MONDAY, 3.0), (None, 4.0)])
    rows = price_timeline(fast, slow, layout=layout).collect()
    assert [(r["wti_usd_bbl"], r["diesel_usd_gal"]) for r in rows] == [(6.0, 3.0)]


def test_gaps_of_years_cross_empty_buckets(spark):
    fast = fast_frame(spark, [(date(1950 + 7 * i, 3, 1), float(i)) for i in range(10)])
    slow = slow_frame(spark, [(date(1960, 1, 1), 1.0), (date(1990, 1, 1), 2.0)])
    rows = price_timeline(fast, slow, layout=TINY).orderBy("date").collect()
    expected = [None, None] + [1.0] * 4 + [2.0] * 4
    assert [r["diesel_usd_gal"] for r in rows] == expected


@pytest.mark.parametrize("layout", [Layout(), TINY], ids=["wide", "tiny"])
def test_positions_are_dense_per_key(spark, layout):
    keyed = [(k, MONDAY + timedelta(days=3 * i), 1.0) for k in "ab" for i in range(40 + (k == "b"))]
    fast = spark.createDataFrame(keyed, "k string, date date, price_usd_bbl double")
    slow = spark.createDataFrame([("a", MONDAY, 1.0)], "k string, week_ending date, price_usd_gal double")
    series = timeline_series(fast, slow, ["k"], layout)
    rows = series.frame.orderBy("k", "date").collect()
    assert [r["pos"] for r in rows] == [*range(40), *range(41)]
    assert {(r["k"], r["n_rows"]) for r in rows} == {("a", 40), ("b", 41)}
    assert series.max_rows == 41
    assert {r["diesel_usd_gal"] for r in rows if r["k"] == "b"} == {None}
