from __future__ import annotations

import json
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from seriesengine.functions.numeric import valid_price
from seriesengine.operators import cleanse
from seriesengine.sources import catalog, landing, schemas
from seriesengine.sources.files import Files

BATCH = datetime(2025, 3, 4, 23, 30, tzinfo=timezone(timedelta(hours=-2)))

HEADER = "Date,Open,High,Low,Close,Adj Close,Volume,Dividends,Stock Splits"


def test_daily_batch_keeps_the_written_day_and_stamps_utc(spark, tmp_path):
    line = "2025-03-03 00:00:00-05:00,1.5,2.0,1.0,1.75,1.7,100,0.0,0.0"
    (tmp_path / "d.csv").write_text(f"{HEADER}\n{line}\n")
    batch = landing.daily_batch(landing.read_daily_landing(spark, str(tmp_path)), BATCH)
    assert batch.schema == schemas.DAILY_RAW
    row = batch.first()
    assert row["date"] == date(2025, 3, 3)
    assert (row["close"], row["adj_close"], row["volume"]) == (1.75, 1.7, 100)
    assert row["ingestion_date"] == date(2025, 3, 5)
    stamp = batch.select(F.date_format("ingestion_timestamp", "yyyy-MM-dd HH:mm:ss")).first()[0]
    assert stamp == "2025-03-05 01:30:00"


def test_daily_batch_from_timestamps(spark):
    landed = spark.sql(
        "SELECT timestamp '2025-03-03 10:00:00' AS Date, 1D AS Open, 1D AS High, 1D AS Low, 1D AS Close,"
        " 1D AS `Adj Close`, 7 AS Volume, 0D AS Dividends, 0D AS `Stock Splits`, 'x' AS Extra"
    )
    batch = landing.daily_batch(landed, BATCH)
    assert batch.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.DAILY_RAW.fields]
    assert batch.first()["date"] == date(2025, 3, 3)


def test_missing_column_raises(spark):
    with pytest.raises(AnalysisException):
        landing.align_to_schema(spark.range(1), schemas.DAILY_RAW).collect()


def record(period, value, area="NUS", product="EPD2D"):
    return {
        "period": period,
        "duoarea": area,
        "area-name": "U.S.",
        "product": product,
        "product-name": "No 2",
        "process": "PTE",
        "process-name": "Retail",
        "value": value,
        "units": "$/GAL",
        "series": "unknown to the schema",
    }


def write_pages(folder, pages, total, offsets=None):
    for i, data in enumerate(pages):
        body = {"response": {"total": str(total), "data": data}}
        if offsets:
            body["request"] = {"params": {"offset": offsets[i], "length": 5000}}
        (folder / f"p{i}.json").write_text(json.dumps(body, indent=1))


def days(first, size):
    return [record(f"2025-01-{d:02}", str(d)) for d in range(first + 1, first + size + 1)]


# Pages as (offset, records), the total, and what is found: repeated, breaks, complete.
COVERAGE = {
    "whole": ([(0, 3), (3, 3), (6, 2)], 8, (0, 0, True)),
    "whole with an empty page": ([(0, 3), (3, 5), (8, 0)], 8, (0, 0, True)),
    "one page": ([(0, 4)], 4, (0, 0, True)),
    "nothing to land": ([(0, 0)], 0, (0, 0, True)),
    "first for second": ([(0, 3), (0, 3), (6, 2)], 8, (2, 2, False)),
    "gap": ([(0, 3), (6, 2)], 8, (0, 2, False)),
    "start missing": ([(3, 3), (6, 2)], 8, (0, 1, False)),
    "end missing": ([(0, 3), (3, 3)], 8, (0, 1, False)),
    "overlap of the right size": ([(0, 3), (2, 3), (6, 2)], 8, (0, 4, False)),
    "beyond the total": ([(0, 3), (3, 6)], 8, (0, 1, False)),
}


@pytest.mark.parametrize("name", list(COVERAGE))
def test_pages_must_cover_the_total_once(spark, tmp_path, name):
    pages, total, (repeated, breaks, complete) = COVERAGE[name]
    write_pages(tmp_path, [days(at, n) for at, n in pages], total, [at for at, _ in pages])
    row = landing.page_completeness(landing.read_api_pages(spark, str(tmp_path))).first()
    assert (row["repeated"], row["breaks"], row["complete"]) == (repeated, breaks, complete)
    assert (row["pages"], row["records"]) == (sum(n > 0 for _, n in pages), sum(n for _, n in pages))


def test_pages_without_offsets_are_told_apart_by_content(spark, tmp_path):
    for name, pages, complete in (
        ("whole", [days(0, 3), days(3, 3)], True),
        ("twice", [days(0, 3), days(0, 3)], False),
    ):
        (tmp_path / name).mkdir()
        write_pages(tmp_path / name, pages, 6)
        row = landing.page_completeness(landing.read_api_pages(spark, str(tmp_path / name))).first()
        assert (row["records"], row["total"], row["complete"]) == (6, 6, complete)
        assert row["breaks"] is None


def test_pages_that_report_different_totals_are_not_complete(spark, tmp_path):
    write_pages(tmp_path, [days(0, 3)], 6, [0])
    body = {"request": {"params": {"offset": 3}}, "response": {"total": "7", "data": days(3, 4)}}
    (tmp_path / "q.json").write_text(json.dumps(body))
    assert not landing.page_completeness(landing.read_api_pages(spark, str(tmp_path))).first()["complete"]


def test_pages_are_flattened_and_selected(spark, tmp_path):
    pages = [
        [record("2025-01-06", "3.5"), record("2025-01-06", "9", area="R10")],
        [record("2025-01-13", "3.6"), record("2025-01-13", "9", product="EPM0")],
    ]
    write_pages(tmp_path, pages, 4)
    read = landing.read_api_pages(spark, str(tmp_path))
    assert landing.page_completeness(read).first()["complete"]
    batch = landing.weekly_batch(read, BATCH)
    assert batch.schema == schemas.WEEKLY_RAW
    rows = batch.orderBy("period").collect()
    assert [(r["period"], r["value"]) for r in rows] == [
        (date(2025, 1, 6), 3.5),
        (date(2025, 1, 13), 3.6),
    ]


def test_missing_page_is_noticed(spark, tmp_path):
    write_pages(tmp_path, [[record("2025-01-06", "3.5")]], 2)
    read = landing.read_api_pages(spark, str(tmp_path))
    row = landing.page_completeness(read).first()
    assert (row["records"], row["total"], row["complete"]) == (1, 2, False)


def test_text_that_is_no_number_raises(spark, tmp_path):
    write_pages(tmp_path, [[record("2025-01-06", "n/a")]], 1)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        landing.weekly_batch(landing.read_api_pages(spark, str(tmp_path)), BATCH).collect()


def day_batch(spark, day, values):
    frame = spark.createDataFrame([(v,) for v in values], "v int")
    return frame.withColumn("ingestion_date", F.lit(day).cast("date"))


def test_partition_is_replaced_and_others_kept(spark, tmp_path):
    path = str(tmp_path / "t")
    catalog.replace_partition(day_batch(spark, "2025-01-01", [1, 2]), path)
    catalog.replace_partition(day_batch(spark, "2025-01-02", [3]), path)
    for _ in range(2):
        catalog.replace_partition(day_batch(spark, "2025-01-02", [4, 5]), path)
    rows = catalog.read_table(spark, path).orderBy("v").collect()
    assert [(r["v"], str(r["ingestion_date"])) for r in rows] == [
        (1, "2025-01-01"),
        (2, "2025-01-01"),
        (4, "2025-01-02"),
        (5, "2025-01-02"),
    ]


def test_batch_over_several_partitions_is_refused(spark, tmp_path):
    both = day_batch(spark, "2025-01-01", [1]).union(day_batch(spark, "2025-01-02", [2]))
    for batch in (both, both.limit(0)):
        with pytest.raises(ValueError, match="exactly one"):
            catalog.replace_partition(batch, str(tmp_path / "t"))


def counted(frame, counter):
    """The frame, whose rows are counted whenever they are computed."""

    def see(batches):
        for batch in batches:
            counter.add(batch.num_rows)
            yield batch

    return frame.mapInArrow(see, frame.schema)


def test_a_batch_runs_once_and_a_refused_one_changes_nothing(spark, tmp_path):
    path = tmp_path / "t"
    runs = spark.sparkContext.accumulator(0)
    done = catalog.replace_partition(counted(day_batch(spark, "2025-01-01", [1, 2]), runs), str(path))
    assert done == {"rows": 2, "ingestion_date": date(2025, 1, 1)}
    assert runs.value == 2
    before = {p: p.read_bytes() for p in path.rglob("*") if p.is_file()}
    unplaced = day_batch(spark, "2025-01-01", [7]).union(spark.sql("SELECT 8 AS v, CAST(NULL AS date)"))
    for bad in (day_batch(spark, "2025-01-01", [9]).union(day_batch(spark, "2025-01-02", [9])), unplaced):
        with pytest.raises(ValueError, match="exactly one"):
            catalog.replace_partition(bad, str(path))
    failing = day_batch(spark, "2025-01-01", [3]).withColumn("v", F.raise_error("broken").cast("int"))
    with pytest.raises(Exception, match="broken"):
        catalog.replace_partition(failing, str(path))
    assert {p: p.read_bytes() for p in path.rglob("*") if p.is_file()} == before
    assert [p.name for p in path.iterdir()] == ["ingestion_date=2025-01-01"]


def test_partition_comes_back_if_the_new_one_cannot_take_its_place(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    catalog.replace_partition(day_batch(spark, "2025-01-01", [1]), path)
    move = Files.move

    def fails_once(self, source, target):
        if "_staged" in source:
            raise OSError("no")
        move(self, source, target)

    monkeypatch.setattr(Files, "move", fails_once)
    with pytest.raises(OSError):
        catalog.replace_partition(day_batch(spark, "2025-01-01", [2]), path)
    assert [r["v"] for r in catalog.read_table(spark, path).collect()] == [1]


def test_summary(spark):
    frame = spark.sql("SELECT date_add(date '2025-01-01', cast(id AS int)) AS d FROM range(5)")
    row = catalog.table_summary(frame, "d").first()
    assert tuple(row) == (5, date(2025, 1, 1), date(2025, 1, 5))


RAW = "period date, duoarea string, value double, ingestion_timestamp timestamp"


def weekly_raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def at(hour):
    return datetime(2025, 1, 20, hour)


def test_newest_row_wins_and_an_invalid_newest_removes_its_key(spark):
    monday = [date(2025, 1, 6) + timedelta(days=7 * i) for i in range(5)]
    raw = weekly_raw(
        spark,
        [
            (monday[0], "NUS", 1.0, at(1)),
            (monday[0], "NUS", 2.0, at(2)),
            (monday[0], "R10", 9.0, at(3)),
            (monday[1], "NUS", 3.0, at(1)),
            (monday[1], "NUS", -1.0, at(2)),
            (monday[2], "NUS", None, at(1)),
            (monday[3], "NUS", float("nan"), at(1)),
            (monday[4], "NUS", 5.0, at(1)),
            (monday[4], "NUS", 4.0, at(1)),
        ],
    )
    rows = cleanse.clean_weekly(raw).orderBy("week_ending").collect()
    # A tie inside one batch is broken by the remaining columns.
    assert [tuple(r) for r in rows] == [(monday[0], 2.0), (monday[4], 4.0)]


def test_clean_daily_columns(spark):
    fields = {f.name: None for f in schemas.DAILY_RAW}
    row = {**fields, "date": date(2025, 1, 1), "close": 5.0, "ingestion_timestamp": at(1)}
    raw = spark.createDataFrame([row], schemas.DAILY_RAW)
    assert cleanse.clean_daily(raw).columns == [
        "date",
        "price_usd_bbl",
        "open_usd_bbl",
        "high_usd_bbl",
        "low_usd_bbl",
        "volume",
    ]
    assert cleanse.clean_daily(raw).count() == 1


@pytest.mark.parametrize(("price", "kept"), [(1.0, 1), (0.0, 0), (-1.0, 0), (None, 0), (float("nan"), 0)])
def test_valid_price(spark, price, kept):
    frame = spark.createDataFrame([(price,)], "p double")
    assert frame.filter(valid_price(F.col("p"))).count() == kept


def test_paths_follow_the_environment(monkeypatch):
    monkeypatch.setenv("DATA_ROOT", "/somewhere")
    assert catalog.Catalog.from_environment().timeline == "/somewhere/gold/price_timeline"
