from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

import pytest
from pyspark.sql import DataFrame, SparkSession

from seriesengine.operators.layout import Series, index_series
from seriesengine.params import Layout

START = date(1998, 11, 19)

# Small enough that every test series is spread over many buckets and chunks.
TINY = Layout(bucket_days=16, chunk_rows=32, value_splits=4)
LAYOUTS = {"one chunk": Layout(), "many chunks": TINY}


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=list(LAYOUTS), ids=[n.replace(" ", "_") for n in LAYOUTS])
def layout(request) -> Layout:
    return LAYOUTS[request.param]


@pytest.fixture
def timeline_of(spark) -> Callable[..., Series]:
    """Numbered series of a price list, one row per day, fast price equal to slow."""

    def make(
        prices: Sequence[float | None],
        layout: Layout,
        fast: Sequence[float] | None = None,
        start: date = START,
    ) -> Series:
        return index_series(timeline_frame(spark, prices, fast, start), layout=layout)

    return make


def timeline_frame(
    spark: SparkSession,
    prices: Sequence[float | None],
    fast: Sequence[float] | None = None,
    start: date = START,
) -> DataFrame:
    fast = fast if fast is not None else [80.0] * len(prices)
    rows = [
        (start + timedelta(days=i), float(f), None if p is None else float(p), None)
        for i, (f, p) in enumerate(zip(fast, prices, strict=True))
    ]
    return spark.createDataFrame(
        rows, "date date, wti_usd_bbl double, diesel_usd_gal double, diesel_week_ending date"
    )
