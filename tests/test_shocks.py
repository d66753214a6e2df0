from __future__ import annotations

from datetime import timedelta

import numpy as np
import pytest

from seriesengine.operators.shocks import shock_ranking
from seriesengine.params import ShockRules
from tests.conftest import START


def ranking(timeline_of, prices, layout, rules=None):
    return shock_ranking(timeline_of(prices, layout), rules).orderBy("rank").collect()


def brute_force(prices, rules):
    """Peaks as (day, change) in rank order, from the definition."""
    changes = [
        (i, (prices[i] / prices[i - rules.window] - 1) * 100)
        for i in range(rules.window, len(prices))
    ]
    rising = [(i, c) for i, c in changes if c > 0]
    firsts: dict[float, int] = {}
    for at, (day, change) in enumerate(rising):
        around = rising[max(0, at - rules.suppression) : at + rules.suppression + 1]
        if change == max(c for _, c in around):
            firsts.setdefault(change, day)
    ranked = sorted(firsts.items(), key=lambda item: -item[0])[: rules.top_n]
    return [(day, change) for change, day in ranked]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(timeline_of, layout, seed):
    rng = np.random.default_rng(seed)
    weekly = np.round(3 + np.cumsum(rng.normal(0, 0.05, 60)), 2)
    prices = [float(p) for p in np.repeat(weekly, 5)]
    rules = ShockRules(top_n=20)
    rows = ranking(timeline_of, prices, layout, rules)
    got = [((r["peak_date"] - START).days, r["pct_change_28d"]) for r in rows]
    assert got == brute_force(prices, rules)


@pytest.mark.parametrize("seed", range(3))
def test_plateaus_and_ties_equal_brute_force(timeline_of, layout, seed):
    """Whole prices from a short list, held for some days: many equal changes."""
    rng = np.random.default_rng(100 + seed)
    prices = np.repeat(rng.integers(2, 6, 30), rng.integers(1, 25, 30)).astype(float).tolist()
    rules = ShockRules(window=int(rng.integers(5, 30)), suppression=int(rng.integers(0, 20)), top_n=50)
    rows = ranking(timeline_of, prices, layout, rules)
    got = [((r["peak_date"] - START).days, r["pct_change_28d"]) for r in rows]
    assert got == brute_force(prices, rules)
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    for r in rows:
        day = (r["peak_date"] - START).days
        assert r["diesel_start_usd_gal"] == prices[day - rules.window]
        assert r["diesel_peak_usd_gal"] == prices[day]


def test_zero_base_is_no_shock(timeline_of, layout):
    assert ranking(timeline_of, [0.0] * 40 + [1.0] * 20, layout) == []


def test_falling_series_has_no_shock(timeline_of, layout):
    assert ranking(timeline_of, [100.0 - i for i in range(60)], layout) == []
