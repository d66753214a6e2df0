from __future__ import annotations

import time

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seriesengine.operators import ranks
from seriesengine.operators.layout import CHUNK, OWNED, POS
from seriesengine.operators.ranks import BELOW_EARLIER, BELOW_ROLLING, SEEN, count_smaller

# Few distinct values, so that ties are common.
values = st.lists(st.one_of(st.just(float("nan")), st.integers(0, 5).map(float)), max_size=60)


def plain(series, starts):
    return [sum(v < series[i] for v in series[max(0, s) : i + 1]) for i, s in enumerate(starts)]


@given(values, st.data())
@settings(max_examples=80, deadline=None)
def test_counts_over_any_ranges(series, data):
    starts = [data.draw(st.integers(0, len(series) + 2)) for _ in series]
    got = count_smaller(np.array(series, float), np.array(starts, int))
    assert got.tolist() == plain(series, starts)


@given(values, st.integers(1, 20))
@settings(max_examples=60, deadline=None)
def test_moving_and_growing_counts(series, width):
    at = np.arange(len(series))
    for starts in (np.maximum(0, at - width + 1), np.zeros(len(series), int)):
        got = count_smaller(np.array(series, float), starts)
        assert got.tolist() == plain(series, starts)


def test_nan_is_neither_smaller_nor_larger():
    got = count_smaller(np.array([np.nan, 2.0, 1.0, np.nan, 3.0]), np.array([0, 0, 0, 0, 1]))
    assert got.tolist() == [0, 0, 0, 0, 2]


def chunks(sizes, reach, seed=0):
    """Rows of one chunk after the other: a key, a chunk, and a halo of ``reach`` rows."""
    rng = np.random.default_rng(seed)
    columns = {name: [] for name in ("key", CHUNK, POS, OWNED, "price", "vol")}
    for i, size in enumerate(sizes):
        first = 0 if i % 3 else reach
        halo = min(first, reach)
        columns["key"] += [None if i % 5 == 4 else f"k{i // 2}"] * (halo + size)
        columns[CHUNK] += [i] * (halo + size)
        columns[POS] += range(first - halo, first + size)
        columns[OWNED] += [False] * halo + [True] * size
        columns["price"] += rng.integers(0, 9, halo + size).astype(float).tolist()
        vol = rng.integers(0, 9, halo + size).astype(float)
        vol[rng.random(halo + size) < 0.2] = np.nan
        columns["vol"] += vol.tolist()
    return pa.table(columns)


@pytest.mark.parametrize("batch", [1, 7, 1000])
@pytest.mark.parametrize("piece", [1, 50, 10**6])
def test_chunks_that_cross_batches(monkeypatch, batch, piece):
    monkeypatch.setattr(ranks, "_PIECE", piece)
    table = chunks([1, 30, 2, 2, 17, 40, 1], reach=5)
    run = ranks._kernel(("key",), "price", "vol", 6)
    got = pa.Table.from_batches(run(iter(table.to_batches(max_chunksize=batch)))).to_pylist()
    rows = table.to_pylist()
    expected = []
    for i, row in enumerate(rows):
        if not row[OWNED]:
            continue
        own = [r for r in rows[:i] if r[CHUNK] == row[CHUNK]]
        earlier = [r["vol"] for r in own if r[OWNED]]
        expected.append(
            (
                sum(r["price"] < row["price"] for r in own[-5:]),
                sum(v < row["vol"] for v in earlier),
                sum(v == v for v in [*earlier, row["vol"]]),
            )
        )
    assert [(r[BELOW_ROLLING], r[BELOW_EARLIER], r[SEEN]) for r in got] == expected


def test_chunks_that_were_torn_are_refused():
    table = chunks([30, 30], reach=5)
    for torn in (table.slice(10), table.take([0, 2, 3])):
        with pytest.raises(ValueError, match="chunk"):
            list(ranks._kernel(("key",), "price", "vol", 6)(iter(torn.to_batches())))


def test_many_short_series_cost_no_more_than_one_long_one():
    def seconds(sizes):
        table = chunks(sizes, reach=0)
        run = ranks._kernel(("key",), "price", "vol", 1260)
        best = float("inf")
        for _ in range(3):
            start = time.perf_counter()
            assert sum(b.num_rows for b in run(iter(table.to_batches(max_chunksize=10_000)))) == sum(sizes)
            best = min(best, time.perf_counter() - start)
        return best

    assert seconds([60] * 5000) < 1.5 * seconds([12_000] * 25)
