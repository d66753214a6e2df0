from __future__ import annotations

import json
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from seriesengine.operators import quality
from seriesengine.sinks import exports
from tests.conftest import START, timeline_frame


def text_of(path: Path) -> str:
    if path.is_dir():
        return "".join(p.read_text() for p in sorted(path.glob("part-*")))
    return path.read_text()


@pytest.mark.parametrize("parts", [True, False], ids=["parts", "file"])
def test_array_is_ordered_json_in_both_shapes(spark, tmp_path, parts):
    gold = timeline_frame(spark, [None, *range(1, 200)]).repartition(7)
    path = tmp_path / "timeline.json"
    done = exports.export_array(gold, "date", str(path), parts)
    assert done == {"rows": 200, "first": START, "last": START + timedelta(days=199)}
    assert path.is_dir() == parts
    records = json.loads(text_of(path))
    assert [r["date"] for r in records] == [
        (START + timedelta(days=i)).isoformat() for i in range(200)
    ]
    assert records[0] == {
        "date": START.isoformat(),
        "wti_usd_bbl": 80.0,
        "diesel_usd_gal": None,
        "diesel_week_ending": None,
    }
    back = exports.read_array(spark, str(path), gold.schema).drop("_corrupt_record")
    assert back.exceptAll(gold).count() == gold.exceptAll(back).count() == 0


def test_input_of_an_export_runs_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def see(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    gold = timeline_frame(spark, range(300)).repartition(5)
    watched = gold.mapInArrow(see, gold.schema)
    for turn, parts in enumerate((True, False), 1):
        path = str(tmp_path / f"{parts}.json")
        done = exports.export_array(watched, "date", path, parts, total=F.sum("diesel_usd_gal"))
        assert (done["rows"], done["total"]) == (300, sum(range(300)))
        assert seen.value == 300 * turn


@pytest.mark.parametrize("block", [None, "64"], ids=["whole files", "blocks of 64 bytes"])
def test_lines_of_many_files_are_numbered(spark, tmp_path, block):
    path = str(tmp_path / "timeline.json")
    gold = timeline_frame(spark, range(200)).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    if block:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        exports.export_array(gold, "date", path, parts=True)
        assert len(list(Path(path).glob("part-*"))) > 1
        lines = exports.numbered_lines(spark, path).orderBy("line").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r["line"] for r in lines] == list(range(200))
    assert "\n".join(r["value"] for r in lines) + "\n" == text_of(Path(path))


@pytest.mark.parametrize("places", [[1, 2, 2], [1, None, 3]], ids=["repeat", "null"])
def test_an_order_with_repeats_or_nulls_is_refused(spark, tmp_path, places):
    rows = spark.createDataFrame([(p,) for p in places], "place int")
    with pytest.raises(ValueError, match="nulls or repeats"):
        exports.export_array(rows, "place", str(tmp_path / "a.json"))
    assert not (tmp_path / "a.json").exists()


def test_export_replaces_the_previous_one(spark, tmp_path):
    path = str(tmp_path / "a.json")
    for n in (3, 2):
        exports.export_array(timeline_frame(spark, range(n)), "date", path)
    assert len(json.loads(Path(path).read_text())) == 2


def test_empty_table_is_an_empty_array(spark, tmp_path):
    path = str(tmp_path / "a.json")
    empty = timeline_frame(spark, [1.0]).limit(0)
    assert exports.export_array(empty, "date", path)["rows"] == 0
    assert json.loads(Path(path).read_text()) == []
    assert exports.read_array(spark, path, empty.schema).count() == 0


def test_nan_becomes_null(spark, tmp_path):
    path = str(tmp_path / "a.json")
    exports.export_array(timeline_frame(spark, [float("nan")]), "date", path)
    assert json.loads(Path(path).read_text())[0]["diesel_usd_gal"] is None


def test_document(spark, tmp_path):
    path = str(tmp_path / "d.json")
    df = spark.sql("SELECT 1 AS a, named_struct('b', cast(null AS double)) AS s, array('x') AS l")
    exports.export_document(df, path)
    assert json.loads(Path(path).read_text()) == {"a": 1, "s": {"b": None}, "l": ["x"]}


def test_several_rows_are_no_document(spark, tmp_path):
    with pytest.raises(ValueError, match="found 2"):
        exports.export_document(spark.range(2), str(tmp_path / "d.json"))


def test_manifest(spark, tmp_path):
    stats = {"price_timeline": {"rows": 10, "max_date": "2024-12-31"}, "fuel_shocks": {"rows": 5}}
    moment = datetime(2025, 1, 1, 3, 0, tzinfo=timezone(timedelta(hours=3)))
    path = exports.write_manifest(spark, stats, "2024-12-31", str(tmp_path), moment)
    found = json.loads(Path(path).read_text())
    assert found == {
        "generated_at": "2025-01-01T00:00:00Z",
        "data_through": "2024-12-31",
        "tables": stats,
    }
    now = exports.manifest({}, "2024-12-31")["generated_at"]
    assert now.endswith("Z") and datetime.fromisoformat(now[:-1])


def test_statistics_are_observed_by_the_export(spark, tmp_path):
    def exported(df, order, metrics):
        return exports.statistics(exports.export_array(df, order, str(tmp_path / "a.json"), **metrics))

    sweep = spark.sql(
        "SELECT * FROM values (0, 0.5D, false), (2, 0.87654D, true), (1, 0.87654D, true)"
        " AS t(lag_days, correlation, is_optimal)"
    )
    found = exported(sweep, "lag_days", exports.lag_metrics())
    assert found == {"rows": 3, "optimal_lag_days": 1, "optimal_correlation": 0.8765}
    shocks = spark.sql(
        "SELECT * FROM values (2, 3.0D, date '2024-01-01'), (1, 30.125D, date '2024-06-01')"
        " AS t(rank, pct_change_28d, peak_date)"
    )
    found = exported(shocks, "rank", exports.shock_metrics())
    assert found == {"rows": 2, "top_event_pct_change": 30.12, "top_event_date": "2024-06-01"}
    assert [r["rank"] for r in exports.preview(shocks, rows=1).collect()] == [1]
    timeline = timeline_frame(spark, [1.0, 2.0])
    found = exported(timeline, "date", exports.timeline_metrics("date"))
    assert found == {"rows": 2, "min_date": "1998-11-19", "max_date": "1998-11-20"}
    found = exported(timeline.limit(0), "date", exports.timeline_metrics("date"))
    assert found == {"rows": 0, "min_date": None, "max_date": None}


def test_only_changed_tables_are_published(spark, tmp_path):
    folder = str(tmp_path)
    runs = spark.sparkContext.accumulator(0)

    def watched(frame):
        def see(batches):
            for batch in batches:
                runs.add(batch.num_rows)
                yield batch

        return frame.mapInArrow(see, frame.schema)

    def publish(days, numbers, **more):
        outputs = {
            "days": exports.Output(watched(days), ["date"], exports.timeline_metrics("date")),
            "numbers": exports.Output(watched(numbers), ["id"]),
        }
        return exports.publish(spark, outputs, folder, lambda t: t["days"]["max_date"], **more)

    days, numbers = timeline_frame(spark, range(40)), spark.range(10).toDF("id")
    early = datetime(2025, 1, 1, tzinfo=timezone.utc)
    assert exports.read_manifest(spark, folder) == {}
    assert publish(days, numbers, moment=early) == {"days": True, "numbers": True}
    assert runs.value == 50
    written = {p.name: p.stat().st_mtime_ns for p in tmp_path.iterdir()}
    assert publish(days.repartition(6), numbers.repartition(3)) == {"days": False, "numbers": False}
    assert runs.value == 100
    assert {p.name: p.stat().st_mtime_ns for p in tmp_path.iterdir()} == written
    assert exports.read_manifest(spark, folder)["generated_at"] == "2025-01-01T00:00:00Z"
    assert publish(days, numbers.filter("id < 9")) == {"days": False, "numbers": True}
    assert json.loads((tmp_path / "numbers.json").read_text()) == [{"id": i} for i in range(9)]
    (tmp_path / "days.json").unlink()
    assert publish(days, numbers.filter("id < 9")) == {"days": True, "numbers": False}
    with pytest.raises(ValueError, match="repeats"):
        publish(days, numbers.union(numbers))
    assert publish(days, numbers.filter("id < 9")) == {"days": False, "numbers": False}
    found = exports.read_manifest(spark, folder)
    assert found["data_through"] == found["tables"]["days"]["max_date"] == "1998-12-28"
    only = {"days": exports.Output(days, ["date"])}
    assert exports.publish(spark, only, folder, lambda _: "2024-12-31") == {"days": False}
    with pytest.raises(ValueError, match="found 9"):
        exports.publish(spark, {"page": exports.Output(numbers.filter("id < 9"))}, folder, lambda _: "")
    assert set(exports.read_manifest(spark, folder)["tables"]) == {"days"}


@pytest.mark.parametrize(("as_of", "passed"), [("1998-11-27", True), ("1998-11-28", False)])
def test_freshness(spark, as_of, passed):
    gold = timeline_frame(spark, [1.0, 2.0])
    assert tuple(quality.freshness(gold, "date", as_of).first()) == ("freshness", passed)
    assert not quality.freshness(gold.limit(0), "date", as_of).first()["passed"]


def test_readable(spark, tmp_path):
    gold = timeline_frame(spark, [1.0, 2.0])
    good = tmp_path / "good.json"
    exports.export_array(gold, "date", str(good))
    assert quality.readable(spark, str(good), gold.schema).first()["passed"]
    text = good.read_text()
    broken = {"cut": text[:-20], "unclosed": text.rsplit("\n,", 1)[0], "empty": "[]"}
    for name, content in broken.items():
        path = tmp_path / f"{name}.json"
        path.write_text(content)
        assert not quality.readable(spark, str(path), gold.schema).first()["passed"], name
    assert not quality.readable(spark, str(tmp_path / "none.json"), gold.schema).first()["passed"]


def test_changed(spark):
    gold = timeline_frame(spark, range(50))
    assert not quality.changed(gold.repartition(5), gold).first()["passed"]
    assert quality.changed(timeline_frame(spark, [*range(49), 7]), gold).first()["passed"]
    assert quality.changed(gold.filter(gold["date"] > START), gold).first()["passed"]
