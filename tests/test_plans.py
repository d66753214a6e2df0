"""Plans: nothing row-sized in one task, no cross joins, pruned scans."""

from __future__ import annotations

import re

import pytest

from seriesengine.operators import cleanse, crosscorr, regime, shocks, status
from seriesengine.operators.layout import index_series, with_halo
from seriesengine.operators.timeline import timeline_series
from seriesengine.sources import paired
from seriesengine.sources.paired import table
from tests.conftest import TINY

FOLDER = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def series(spark):
    return timeline_series(*paired.whole(spark, FOLDER), layout=TINY)


OPERATORS = {
    "lag_sweep": crosscorr.lag_sweep,
    "shock_ranking": shocks.shock_ranking,
    "rolling_volatility": regime.rolling_volatility,
    "regime_daily": regime.regime_daily,
    "regime_history": regime.regime_history,
    "status_kpis": status.status_kpis,
    "status_snapshot": status.status_snapshot,
    "sparkline": status.sparkline,
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_no_row_goes_to_a_single_partition(series, name):
    plan = plan_of(OPERATORS[name](series))
    assert "SinglePartition" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_windows_of_a_keyless_series_run_per_chunk(series):
    plan = plan_of(regime.rolling_volatility(series))
    exchanges = re.findall(r"Exchange (\w+)\(([^)]*)\)", plan)
    assert any("_chunk" in columns for _, columns in exchanges)


def test_halo_copies_only_edge_rows(series):
    copies = with_halo(series, before=3, after=2)
    assert copies.filter("_owned").count() == series.frame.count()
    extra = copies.filter("NOT _owned").count()
    edges = (series.max_rows - 1) // TINY.chunk_rows
    assert extra == edges * (3 + 2)


def test_dedup_limits_before_the_shuffle(spark):
    events = table(spark, FOLDER, "events")
    plan = plan_of(cleanse.latest_per_key(events.select("user_id", "ts"), ["user_id"], "ts"))
    assert plan.count("WindowGroupLimit") == 2


def test_scans_read_only_what_is_used(spark):
    fast, slow = paired.whole(spark, FOLDER)
    assert re.search(r"ReadSchema: struct<o_totalprice:double,o_orderdate:\w+>", plan_of(fast))
    assert re.search(r"ReadSchema: struct<l_extendedprice:double,l_shipdate:\w+>", plan_of(slow))


def test_area_filter_is_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.sql(
        "SELECT date '2025-01-06' AS period, 'NUS' AS duoarea, 1D AS value, 'x' AS units,"
        " timestamp '2025-01-07 00:00:00' AS ingestion_timestamp"
    ).write.parquet(path)
    plan = plan_of(cleanse.clean_weekly(spark.read.parquet(path)))
    assert "EqualTo(duoarea,NUS)" in plan
    assert "units" not in plan


@pytest.mark.parametrize("sides", [paired.by_priority, paired.by_supplier])
def test_raw_tables_are_scanned_once(spark, sides):
    plan = plan_of(sides(spark, FOLDER))
    for name in ("orders", "lineitem"):
        assert plan.count(f"{name}.parquet") <= 1
    assert plan.count("lineitem.parquet") == 1
    assert "Join" not in plan


def test_ranks_add_no_shuffle_to_the_windows_they_follow(series):
    plan = plan_of(regime.regime_daily(index_series(series.frame.select("date", "diesel_usd_gal"))))
    assert plan.count("Exchange") == 1
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan


@pytest.mark.parametrize("operator", [status.status_snapshot, status.status_kpis, status.historical_analogue])
def test_status_of_short_series_is_one_shuffle(series, operator):
    short = index_series(series.frame.select("date", "diesel_usd_gal"))
    assert short.one_chunk
    plan = plan_of(operator(short))
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1
    assert "Join" not in plan
