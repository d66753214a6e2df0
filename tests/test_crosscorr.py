from __future__ import annotations

import numpy as np
import pytest

from seriesengine.operators.crosscorr import lag_sweep, optimal_lag
from seriesengine.operators.layout import index_series
from seriesengine.params import LagRange, Layout

# Chunks may be no shorter than needed for several of them; the halo of 90 rows
# then reaches over more than one chunk.
LAYOUTS = [Layout(), Layout(bucket_days=16, chunk_rows=32)]


@pytest.mark.parametrize("layout", LAYOUTS, ids=["one", "many"])
@pytest.mark.parametrize("lag", [0, 53])
def test_optimum_is_the_shift_of_a_shifted_walk(timeline_of, layout, lag):
    rng = np.random.default_rng(lag + 17)
    fast = rng.normal(0, 1, 260).cumsum()
    slow = [None] * lag + [float(v) for v in 3 * fast[: 260 - lag] + rng.normal(0, 0.01, 260 - lag)]
    best = optimal_lag(lag_sweep(timeline_of(slow, layout, fast))).collect()
    assert [r["lag_days"] for r in best] == [lag]


@pytest.mark.parametrize("layout", LAYOUTS, ids=["one", "many"])
def test_equals_numpy(timeline_of, layout):
    rng = np.random.default_rng(3)
    fast, slow = rng.normal(5, 1, 200), list(rng.normal(5, 1, 200))
    slow[0] = slow[1] = None
    got = {r["lag_days"]: r["correlation"] for r in lag_sweep(timeline_of(slow, layout, fast)).collect()}
    for lag in range(91):
        first = max(lag, 2)
        y = np.array(slow[first:], dtype=float)
        x = fast[first - lag : 200 - lag]
        assert got[lag] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-12)


def test_short_and_flat_series_give_nulls(timeline_of, layout):
    rows = lag_sweep(timeline_of([1.0] * 20, layout)).collect()
    assert len(rows) == 91
    assert all(r["correlation"] is None for r in rows)


def test_tied_optima_are_all_flagged_and_the_smallest_wins(timeline_of, layout):
    sweep = lag_sweep(timeline_of([1.0, 2.0] * 30, layout, [1.0, 2.0] * 30), LagRange(0, 3))
    by_lag = {r["lag_days"]: r["is_optimal"] for r in sweep.collect()}
    assert by_lag[0] and not by_lag[1]
    assert [r["lag_days"] for r in optimal_lag(sweep).collect()] == [0]


def test_range_need_not_start_at_zero(timeline_of, layout):
    rows = lag_sweep(timeline_of(list(range(60)), layout, list(range(60))), LagRange(5, 7)).collect()
    assert sorted(r["lag_days"] for r in rows) == [5, 6, 7]


def test_keys_are_independent(spark, layout):
    rng = np.random.default_rng(8)
    fast = [float(v) for v in rng.normal(0, 1, 200).cumsum()]
    rows = [(k, i, fast[i], fast[max(0, i - shift)]) for k, shift in (("a", 21), ("b", 0)) for i in range(200)]
    frame = spark.createDataFrame(rows, "k string, i int, wti_usd_bbl double, diesel_usd_gal double")
    frame = frame.selectExpr("k", "date_add(date '2024-01-01', i) AS date", "wti_usd_bbl", "diesel_usd_gal")
    best = optimal_lag(lag_sweep(index_series(frame, ["k"], layout)), ("k",)).collect()
    assert {r["k"]: r["lag_days"] for r in best} == {"a": 21, "b": 0}
