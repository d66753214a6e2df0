"""Lag sweep: correlation of the slow series with the fast one n rows earlier."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesengine.functions.numeric import pearson
from seriesengine.operators.layout import OWNED, POS, ROWS, Series, chunk_window, public, with_halo
from seriesengine.params import FAST, SLOW, LagRange


def lag_sweep(series: Series, lags: LagRange | None = None) -> DataFrame:
    """``lag_days, correlation, is_optimal`` per series, one row per lag.

    A negative lag looks ahead. One pass for all lags: a frame collects the fast
    prices that the lags of a row reach, the list is exploded next to the row's slow
    price and aggregated on the map side. Only the rows with their halo are shuffled,
    not the exploded pairs. Every row holding the highest correlation is flagged.
    """
    lags = lags or LagRange()
    if lags.first > lags.last:
        raise ValueError(f"the first lag {lags.first} is beyond the last {lags.last}")
    keys = list(series.keys)
    width = lags.last - lags.first + 1

    reached = chunk_window(keys).rowsBetween(-lags.last, -lags.first)
    # collect_list skips nulls, so the price is wrapped to keep its place.
    rows = (
        with_halo(series, before=max(lags.last, 0), after=max(-lags.first, 0))
        .withColumn("_reached", F.collect_list(F.struct(FAST)).over(reached))
        .filter(OWNED)
    )
    # Newest first. Places beyond either end of the series are filled, so a series
    # shorter than a lag still has a row for it, with a null correlation.
    missing = F.struct(F.lit(None).cast("double").alias(FAST))
    beyond_end = F.col(POS) - F.lit(lags.first) - (F.col(ROWS) - 1)
    ahead = F.greatest(F.lit(0), F.least(F.lit(width), beyond_end)).cast("int")
    behind = F.lit(width) - F.size("_reached") - ahead
    newest_first = F.concat(
        F.array_repeat(missing, ahead), F.reverse("_reached"), F.array_repeat(missing, behind)
    )
    pairs = rows.select(*keys, SLOW, F.posexplode(newest_first).alias("_place", "_lagged")).select(
        *keys, SLOW, "_lagged", (F.col("_place") + F.lit(lags.first)).alias("lag_days")
    )
    correlations = pairs.groupBy(*keys, "lag_days").agg(
        pearson(F.col(f"_lagged.{FAST}"), F.col(SLOW)).alias("correlation")
    )
    best = F.max("correlation").over(Window.partitionBy(*keys))
    return public(correlations.withColumn("is_optimal", F.col("correlation") == best), keys)


def optimal_lag(sweep: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """The flagged lag of each series; the smallest one on an exact tie."""
    return (
        sweep.filter("is_optimal")
        .groupBy(*keys)
        .agg(F.min(F.struct("lag_days", "correlation")).alias("_best"))
        .select(*keys, "_best.lag_days", "_best.correlation")
    )
