"""Daily regime of the slow series and its history as contiguous segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesengine.functions.labels import regime
from seriesengine.functions.numeric import diff_change_pct, share_pct, to_33_bits
from seriesengine.operators.layout import (
    CHUNK,
    OWNED,
    POS,
    ROWS,
    Series,
    chunk_window,
    public,
    running_before,
    running_to,
    with_halo,
)
from seriesengine.operators.ranks import (
    BELOW_EARLIER,
    BELOW_ROLLING,
    SEEN,
    add_earlier_chunks,
    rank_in_chunks,
)
from seriesengine.params import DATE, SLOW, StatusRules
from seriesengine.scratch import materialize

RETURN = "daily_return"
VOLATILITY = "volatility"
MOMENTUM = "momentum"
# Volatility at the precision at which two of them are compared, 33 bits and units
# of 1e-9: equal sets of returns differ in the last bits of their deviation.
VOLATILITY_UNITS = "_volatility_units"

# Rank of a row that has no volatility.
NEUTRAL_RANK = 50.0


def _with_features(halo: DataFrame, keys: Sequence[str], rules: StatusRules) -> DataFrame:
    """Daily return, rolling sample deviation of the returns, and momentum."""
    order = chunk_window(keys)
    price = F.col(SLOW)
    frame = order.rowsBetween(1 - rules.volatility_rows, 0)
    enough = F.count(RETURN).over(frame) >= rules.volatility_min_rows
    return halo.withColumns(
        {
            RETURN: F.when(F.col(POS) == 0, F.lit(0.0)).otherwise(
                diff_change_pct(price, F.lag(SLOW, 1).over(order))
            ),
            MOMENTUM: diff_change_pct(price, F.lag(SLOW, rules.momentum_rows).over(order)),
        }
    ).withColumn(VOLATILITY, F.when(enough, F.stddev_samp(RETURN).over(frame))).withColumn(
        VOLATILITY_UNITS, F.rint(to_33_bits(F.col(VOLATILITY)) * 1e9)
    )


def _feature_reach(rules: StatusRules) -> int:
    """Rows back that the features need: the oldest return needs one more row."""
    return max(rules.volatility_rows, rules.momentum_rows)


def features(series: Series, rules: StatusRules | None = None) -> DataFrame:
    """Slow price with its return, volatility and momentum, one row per date."""
    rules = rules or StatusRules()
    halo = with_halo(series, before=_feature_reach(rules))
    return (
        _with_features(halo, series.keys, rules)
        .filter(OWNED)
        .select(
            *series.keys, DATE, POS, ROWS, SLOW, RETURN, MOMENTUM, VOLATILITY, VOLATILITY_UNITS
        )
    )


def rolling_volatility(series: Series, rules: StatusRules | None = None) -> DataFrame:
    """Rolling deviation of the daily returns, null below the minimum of rows."""
    return public(
        features(series, rules).select(*series.keys, DATE, RETURN, VOLATILITY), series.keys
    )


def _ranked(series: Series, rules: StatusRules, carried: Sequence[str] = ()) -> DataFrame:
    """Price and volatility percent ranks and the regime they give, per date, beside
    ``carried`` features."""
    keys = series.keys
    reach = max(rules.rolling_rows - 1, _feature_reach(rules))
    halo = _with_features(with_halo(series, before=reach), keys, rules).select(
        *keys, CHUNK, OWNED, DATE, POS, ROWS, SLOW, VOLATILITY, VOLATILITY_UNITS, *carried
    )
    ranked = rank_in_chunks(halo, keys, SLOW, VOLATILITY_UNITS, rules.rolling_rows)
    if not series.one_chunk:
        stored, _ = materialize(ranked, "ranked")
        ranked = add_earlier_chunks(stored, keys, VOLATILITY_UNITS, series.layout)

    in_frame = F.least(F.col(POS) + 1, F.lit(rules.rolling_rows))
    return ranked.withColumns(
        {
            "price_pct": share_pct(F.col(BELOW_ROLLING), in_frame),
            "volatility_rank": F.when(F.col(VOLATILITY).isNull(), F.lit(NEUTRAL_RANK)).otherwise(
                share_pct(F.col(BELOW_EARLIER), F.col(SEEN))
            ),
        }
    ).withColumn("regime", regime(F.col("price_pct"), F.col("volatility_rank")))


def regime_daily(series: Series, rules: StatusRules | None = None) -> DataFrame:
    """``date, price_pct, volatility, volatility_rank, regime`` of every row."""
    ranked = _ranked(series, rules or StatusRules())
    return public(
        ranked.select(
            *series.keys, DATE, "price_pct", VOLATILITY, "volatility_rank", "regime"
        ),
        series.keys,
    )


def segment_runs(
    rows: DataFrame, keys: Sequence[str], label: str, one_chunk: bool
) -> DataFrame:
    """Merge consecutive rows with equal labels into ``start, end, label``.

    Runs are numbered inside each chunk. A small table with the first and last
    label of every chunk tells whether a chunk continues the run before it and
    how many runs came earlier. The final grouping is combined on the map side,
    so a run that spans many chunks is no hot group.
    """
    keys = list(keys)
    order = chunk_window(keys)
    changed = (F.col(label) != F.lag(label).over(order)).cast("int")
    runs = rows.withColumn("_changed", F.coalesce(changed, F.lit(0))).withColumn(
        "_run", F.sum("_changed").over(running_to(order))
    )
    if not one_chunk:
        by_chunk = Window.partitionBy(*keys).orderBy(CHUNK)
        edges = runs.groupBy(*keys, CHUNK).agg(
            F.max("_run").alias("_inner"),
            F.min_by(label, POS).alias("_first"),
            F.max_by(label, POS).alias("_last"),
        )
        starts = F.coalesce((F.col("_first") != F.lag("_last").over(by_chunk)).cast("int"), F.lit(0))
        edges = edges.withColumn("_starts", starts)
        earlier = F.sum(F.col("_inner") + F.col("_starts")).over(running_before(by_chunk))
        base = edges.select(
            *keys, CHUNK, (F.col("_starts") + F.coalesce(earlier, F.lit(0))).alias("_base")
        )
        runs = runs.join(base, [*keys, CHUNK]).withColumn("_run", F.col("_run") + F.col("_base"))
    return (
        runs.groupBy(*keys, "_run", label)
        .agg(F.min(DATE).alias("start"), F.max(DATE).alias("end"))
        .select(*keys, "start", "end", label)
    )


def stored_states(series: Series, rules: StatusRules) -> DataFrame:
    """Features and regime of every row of the series that are long enough, stored: what a
    status with its history is made of."""
    rows = _ranked(series, rules, (MOMENTUM,)).filter(F.col(ROWS) >= rules.min_rows)
    columns = (CHUNK, POS, ROWS, DATE, SLOW, MOMENTUM, VOLATILITY, VOLATILITY_UNITS, "regime")
    return materialize(rows.select(*series.keys, *columns), "states")[0]


def segments_of(states: DataFrame, series: Series) -> DataFrame:
    """Segments of rows that have a regime."""
    rows = states.select(*series.keys, CHUNK, POS, DATE, "regime")
    return segment_runs(rows, series.keys, "regime", series.one_chunk)


def regime_segments(series: Series, rules: StatusRules) -> DataFrame:
    """``regime_history`` with the physical key."""
    rows = _ranked(series, rules).filter(F.col(ROWS) >= rules.min_rows)
    if not series.one_chunk:
        rows, _ = materialize(rows.select(*series.keys, CHUNK, POS, DATE, "regime"), "regimes")
    return segments_of(rows, series)


def regime_history(series: Series, rules: StatusRules | None = None) -> DataFrame:
    """Contiguous regime segments; none for series below the minimum length."""
    return public(regime_segments(series, rules or StatusRules()), series.keys)
