from __future__ import annotations

from datetime import timedelta

import numpy as np
import pytest

from seriesengine.functions.labels import CALM, ELEVATED, EXTREME, regime
from seriesengine.operators.layout import index_series
from seriesengine.operators.regime import regime_daily, regime_history, rolling_volatility
from seriesengine.params import Layout, StatusRules
from tests.conftest import START, TINY, timeline_frame


@pytest.mark.parametrize(
    ("price_pct", "rank", "expected"),
    [
        (85, 20, EXTREME),
        (40, 80, EXTREME),
        (30, 20, CALM),
        (60, 60, ELEVATED),
        (80, 75, ELEVATED),
        (50, 20, ELEVATED),
        (20, 50, ELEVATED),
        (80.1, 0, EXTREME),
    ],
)
def test_thresholds(spark, price_pct, rank, expected):
    row = spark.createDataFrame([(float(price_pct), float(rank))], "p double, v double")
    assert row.select(regime(row["p"], row["v"])).first()[0] == expected


def expected_daily(prices, rules):
    """Percentile, volatility and rank per row, straight from the definitions."""
    x = np.array([np.nan if p is None else p for p in prices], dtype=float)
    returns = np.zeros(len(x))
    returns[1:] = (x[1:] - x[:-1]) / x[:-1] * 100
    rows, seen = [], []
    for i in range(len(x)):
        frame = x[max(0, i - rules.rolling_rows + 1) : i + 1]
        pct = (frame < x[i]).sum() / len(frame) * 100
        recent = returns[max(0, i - rules.volatility_rows + 1) : i + 1]
        recent = recent[~np.isnan(recent)]
        vol, rank = None, 50.0
        if len(recent) >= rules.volatility_min_rows:
            vol = recent.std(ddof=1)
            seen.append(round(vol, 9))
            rank = sum(v < seen[-1] for v in seen) / len(seen) * 100
        rows.append((pct, vol, rank))
    return rows


def random_prices(n, seed):
    """Weekly reports carried over five rows, so returns and ranks have ties."""
    rng = np.random.default_rng(seed)
    weekly = np.round(3 + 0.3 * np.sin(np.arange(n // 5 + 1) / 7) + rng.normal(0, 0.02, n // 5 + 1), 2)
    return [None, None] + [float(p) for p in np.repeat(weekly, 5)[: n - 2]]


# Frames shorter than, equal to and longer than the small chunks.
@pytest.mark.parametrize("rolling", [20, 32, 100])
@pytest.mark.parametrize("chunk_rows", [8192, 32, 50])
def test_daily_ranks_equal_brute_force(spark, rolling, chunk_rows):
    rules = StatusRules(rolling_rows=rolling)
    layout = Layout(bucket_days=16, chunk_rows=chunk_rows, value_splits=4)
    prices = random_prices(403, seed=rolling)
    rows = (
        regime_daily(index_series(timeline_frame(spark, prices), layout=layout), rules)
        .orderBy("date")
        .collect()
    )
    for row, (pct, vol, rank) in zip(rows, expected_daily(prices, rules), strict=True):
        assert row["price_pct"] == pct
        assert row["volatility"] == (None if vol is None else pytest.approx(vol, abs=1e-9))
        assert row["volatility_rank"] == rank


def test_one_dominating_value_is_ranked_across_chunks(timeline_of):
    prices = [3.0] * 300 + [3.0 + 0.01 * i for i in range(60)] + [3.0] * 100
    rules = StatusRules(rolling_rows=40)
    rows = regime_daily(timeline_of(prices, TINY), rules).orderBy("date").collect()
    expected = expected_daily(prices, rules)
    assert [r["volatility_rank"] for r in rows] == [e[2] for e in expected]


def test_volatility_needs_its_minimum_of_rows(timeline_of, layout):
    rows = rolling_volatility(timeline_of(range(1, 41), layout)).orderBy("date").collect()
    assert rows[0]["daily_return"] == 0.0
    assert [r["volatility"] is None for r in rows] == [True] * 9 + [False] * 31


def test_segments_are_contiguous_alternate_and_match_the_days(timeline_of, layout):
    prices = random_prices(400, seed=9)
    series = timeline_of(prices, layout)
    daily = {r["date"]: r["regime"] for r in regime_daily(series).collect()}
    segments = regime_history(series).orderBy("start").collect()
    assert segments[0]["start"] == START
    assert segments[-1]["end"] == START + timedelta(days=len(prices) - 1)
    for before, after in zip(segments, segments[1:], strict=False):
        assert after["start"] - before["end"] == timedelta(days=1)
        assert after["regime"] != before["regime"]
    for s in segments:
        days = range((s["end"] - s["start"]).days + 1)
        assert {daily[s["start"] + timedelta(days=d)] for d in days} == {s["regime"]}


def test_a_run_over_many_chunks_is_one_segment(timeline_of):
    segments = regime_history(timeline_of([float(i) for i in range(1, 301)], TINY)).collect()
    longest = max((s["end"] - s["start"]).days for s in segments)
    assert longest > 5 * TINY.chunk_rows


def test_short_series_have_no_history(timeline_of, layout):
    assert regime_history(timeline_of([3.0] * 59, layout)).count() == 0
    assert regime_history(timeline_of([3.0] * 60, layout)).count() > 0


def test_keys_are_independent(spark, layout):
    a, b = random_prices(150, 1), random_prices(90, 2)
    frames = [
        timeline_frame(spark, p).selectExpr(f"'{k}' AS k", "*") for k, p in (("a", a), ("b", b))
    ]
    keyed = regime_daily(index_series(frames[0].unionByName(frames[1]), ["k"], layout))
    for k, prices in (("a", a), ("b", b)):
        rows = keyed.filter(keyed["k"] == k).orderBy("date").collect()
        expected = expected_daily(prices, StatusRules())
        assert [r["volatility_rank"] for r in rows] == [e[2] for e in expected]
        assert [r["price_pct"] for r in rows] == [e[0] for e in expected]
