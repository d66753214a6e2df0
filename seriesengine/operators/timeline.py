"""Price timeline: as-of alignment of a slow series to the dates of a fast one."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesengine.operators.layout import (
    BUCKET,
    POS,
    ROWS,
    Series,
    calendar_bucket,
    numbered_in_group,
    public,
    running_to,
    store_numbered,
    with_keys,
)
from seriesengine.params import (
    DATE,
    FAST,
    FAST_PRICE,
    FAST_SIDE,
    PRICE,
    SIDE,
    SLOW,
    SLOW_DATE,
    SLOW_PERIOD,
    SLOW_PRICE,
    SLOW_SIDE,
    Layout,
)


def sides(fast: DataFrame, slow: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Both series as one frame of keys, ``date``, ``side`` and ``price``."""
    rows = [
        frame.select(*keys, F.col(day).alias(DATE), F.lit(side).alias(SIDE), F.col(price).alias(PRICE))
        for frame, side, day, price in (
            (fast, FAST_SIDE, DATE, FAST_PRICE),
            (slow, SLOW_SIDE, SLOW_PERIOD, SLOW_PRICE),
        )
    ]
    return rows[0].unionByName(rows[1])


def series_of(rows: DataFrame, keys: Sequence[str] = (), layout: Layout | None = None) -> Series:
    """The timeline of both series in one frame, as ``sides`` gives it.

    Reports are filled forward inside calendar buckets; on a shared date the slow one
    comes first. Where a series spans several buckets, the latest report and the row
    count are carried into each. The frame is read once. A key with two rows of one
    side on one date is an error.
    """
    layout = layout or Layout()
    rows, names = with_keys(rows, keys)
    fast = F.col(SIDE) == FAST_SIDE
    so_far = running_to(Window.partitionBy(*names, BUCKET).orderBy(DATE, SIDE))
    numbers = numbered_in_group(names, BUCKET, FAST, DATE, SIDE)
    filled = (
        rows.filter(F.col(DATE).isNotNull() & (~fast | F.col(PRICE).isNotNull()))
        .select(
            *names,
            DATE,
            SIDE,
            calendar_bucket(F.col(DATE), layout).alias(BUCKET),
            F.when(fast, F.col(PRICE)).alias(FAST),
            F.when(~fast, F.col(PRICE)).alias("_report"),
            F.when(~fast, F.col(DATE)).alias("_report_date"),
        )
        .select(
            *names,
            BUCKET,
            DATE,
            FAST,
            F.last("_report", ignorenulls=True).over(so_far).alias("_fill"),
            F.last("_report_date", ignorenulls=True).over(so_far).alias("_fill_date"),
            *[c.alias(n) for n, c in numbers.items()],
        )
    )
    numbered = store_numbered(
        filled, names, BUCKET, layout, "timeline",
        carry={"_fill": "_carry", "_fill_date": "_carry_date"},
    )
    frame = numbered.frame.filter(F.col(FAST).isNotNull()).select(
        *names,
        DATE,
        FAST,
        F.coalesce("_fill", "_carry").alias(SLOW),
        F.coalesce("_fill_date", "_carry_date").alias(SLOW_DATE),
        POS,
        ROWS,
    )
    return replace(numbered, frame=frame)


def timeline_series(
    fast: DataFrame,
    slow: DataFrame,
    keys: Sequence[str] = (),
    layout: Layout | None = None,
) -> Series:
    """``price_timeline`` with positions, stored for the operators that follow."""
    return series_of(sides(fast, slow, keys), keys, layout)


def price_timeline(
    fast: DataFrame,
    slow: DataFrame,
    keys: Sequence[str] = (),
    layout: Layout | None = None,
) -> DataFrame:
    """One row per fast date with the latest slow report at or before it.

    ``fast`` has ``date`` and ``price_usd_bbl``, ``slow`` has ``week_ending`` and
    ``price_usd_gal``, one row per date; both may carry the same ``keys``. Fast
    dates before the first report keep a null slow price.
    """
    return timeline_table(timeline_series(fast, slow, keys, layout))


def timeline_table(series: Series) -> DataFrame:
    """The gold table of a stored timeline."""
    return public(series.frame.drop(POS, ROWS), series.keys)
