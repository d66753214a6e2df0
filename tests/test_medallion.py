from __future__ import annotations

import json
from datetime import date, datetime, timedelta
from pathlib import Path

import numpy as np
import pytest

from seriesengine.plans import medallion
from seriesengine.sources.catalog import Catalog, read_table
from tests.test_sources import HEADER, record, write_pages

MOMENT = datetime(2025, 3, 4, 12, 0)
FIRST = date(2023, 1, 2)
DAYS = 500


def land(folder: Path) -> tuple[str, str]:
    rng = np.random.default_rng(1)
    daily, weekly = folder / "daily", folder / "weekly"
    daily.mkdir()
    weekly.mkdir()
    lines = [HEADER]
    for i, p in enumerate(80 + np.cumsum(rng.normal(0, 1, DAYS))):
        day = FIRST + timedelta(days=i)
        if day.weekday() < 5:
            lines.append(f"{day} 00:00:00-05:00,{p},{p},{p},{p},{p},10,0.0,0.0")
    (daily / "batch.csv").write_text("\n".join(lines))
    reports = [
        record((FIRST + timedelta(days=7 * i)).isoformat(), f"{3 + 0.01 * rng.integers(0, 60):.2f}")
        for i in range(DAYS // 7)
    ]
    write_pages(weekly, [reports[:40], reports[40:]], len(reports))
    return str(daily), str(weekly)


def test_all_stages(spark, tmp_path):
    daily, weekly = land(tmp_path)
    catalog = Catalog(str(tmp_path / "root"))
    for _ in range(2):  # a second run on the same day changes nothing
        medallion.ingest_daily(spark, catalog, daily, MOMENT)
        medallion.ingest_weekly(spark, catalog, weekly, MOMENT)
    medallion.build_silver(spark, catalog)
    medallion.build_gold(spark, catalog)
    tables = medallion.export_all(spark, catalog, moment=MOMENT)

    raw = read_table(spark, catalog.daily_raw)
    clean = read_table(spark, catalog.daily_clean)
    gold = read_table(spark, catalog.timeline)
    assert raw.count() == clean.count() == gold.count() == tables["price_timeline"]["rows"]
    assert read_table(spark, catalog.weekly_clean).count() == DAYS // 7

    exports = Path(catalog.exports)
    assert {p.name for p in exports.glob("*.json")} == {
        "price_timeline.json",
        "wti_diesel_lag.json",
        "fuel_shocks.json",
        "diesel_status.json",
        "manifest.json",
    }
    loaded = {p.stem: json.loads(p.read_text()) for p in exports.glob("*.json")}
    assert len(loaded["price_timeline"]) == gold.count()
    assert [r["lag_days"] for r in loaded["wti_diesel_lag"]] == list(range(91))
    assert [r["rank"] for r in loaded["fuel_shocks"]] == list(
        range(1, tables["fuel_shocks"]["rows"] + 1)
    )
    status = loaded["diesel_status"]
    assert len(status["sparkline_12w"]) == 12 and status["historical_analogue"] is None
    assert len(status["regime_history"]) == tables["diesel_status"]["regime_segments"]
    assert loaded["manifest"]["tables"] == tables
    assert loaded["manifest"]["data_through"] == loaded["price_timeline"][-1]["date"]
    written = {p.name: p.stat().st_mtime_ns for p in exports.glob("*.json")}
    assert medallion.export_all(spark, catalog) == tables
    assert {p.name: p.stat().st_mtime_ns for p in exports.glob("*.json")} == written
    best = [r for r in loaded["wti_diesel_lag"] if r["is_optimal"]]
    assert best[0]["lag_days"] == tables["wti_diesel_lag"]["optimal_lag_days"]


def test_incomplete_pages_are_refused(spark, tmp_path):
    write_pages(tmp_path, [[record("2025-01-06", "3.5")]], 2)
    with pytest.raises(ValueError, match="1 of 2"):
        medallion.ingest_weekly(spark, Catalog(str(tmp_path / "root")), str(tmp_path), MOMENT)
