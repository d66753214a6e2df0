"""Largest rises of the slow series, one entry per event."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesengine.functions.numeric import ratio_change_pct
from seriesengine.operators.layout import (
    CHUNK,
    OWNED,
    POS,
    Series,
    chunk_window,
    numbered_in_group,
    public,
    store_numbered,
    with_halo,
)
from seriesengine.params import DATE, FAST, SLOW, ShockRules

START = "diesel_start_usd_gal"
CHANGE = "pct_change_28d"


def rises(series: Series, rules: ShockRules) -> DataFrame:
    """Rows whose slow price is above the one ``window`` rows earlier."""
    earlier = F.lag(SLOW, rules.window).over(chunk_window(series.keys))
    return (
        with_halo(series, before=rules.window)
        .withColumn(START, earlier)
        .filter(OWNED)
        .withColumn(CHANGE, ratio_change_pct(F.col(SLOW), F.col(START)))
        .filter(F.col(CHANGE) > 0)
        .select(*series.keys, CHUNK, POS, DATE, FAST, SLOW, START, CHANGE)
    )


def numbered_rises(series: Series, rules: ShockRules) -> Series:
    """Rises, stored with their position among the rises of their series."""
    numbers = numbered_in_group(series.keys, CHUNK, CHANGE, POS)
    rows = rises(series, rules).withColumns(numbers).drop(POS)
    return store_numbered(rows, series.keys, CHUNK, series.layout, "rises")


def local_peaks(rising: Series, rules: ShockRules) -> DataFrame:
    """Rises that no rise within the suppression rows exceeds.

    The frame counts rising rows only: ``rising`` is numbered after the filter.
    """
    side = rules.suppression
    around = F.max(CHANGE).over(chunk_window(rising.keys).rowsBetween(-side, side))
    return (
        with_halo(rising, before=side, after=side)
        .withColumn("_peak", around)
        .filter(F.col(OWNED) & (F.col(CHANGE) == F.col("_peak")))
    )


def shock_ranking(series: Series, rules: ShockRules | None = None) -> DataFrame:
    """Top shocks per series.

    The carried-forward price gives runs of equal changes; those are collapsed to
    their first date by an aggregation on (series, change), combined on the map
    side. The changes are written before they are compared for equality, so
    no stage sees a recomputed value.
    """
    rules = rules or ShockRules()
    keys = list(series.keys)
    rising = numbered_rises(series, rules)
    first_of_value = (
        local_peaks(rising, rules)
        .groupBy(*keys, CHANGE)
        .agg(F.min(F.struct(DATE, START, SLOW, FAST)).alias("_first"))
    )
    best_first = Window.partitionBy(*keys).orderBy(F.col(CHANGE).desc())
    ranked = first_of_value.withColumn("rank", F.row_number().over(best_first)).filter(
        F.col("rank") <= rules.top_n
    )
    peak = F.col(f"_first.{DATE}")
    return public(
        ranked.select(
            *keys,
            "rank",
            peak.alias("peak_date"),
            F.date_sub(peak, rules.window).alias("period_start_date"),
            CHANGE,
            F.col(f"_first.{START}").alias(START),
            F.col(f"_first.{SLOW}").alias("diesel_peak_usd_gal"),
            F.col(f"_first.{FAST}").alias("wti_at_peak_usd_bbl"),
        ),
        keys,
    )
