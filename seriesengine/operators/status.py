"""Live status of each series: indicators, sparkline and historical analogue."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesengine.functions.labels import context_clause, event_key, regime
from seriesengine.functions.numeric import (
    diff_change_pct,
    fixed_text,
    round_even,
    share_pct,
    signed_whole_text,
    zscore,
)
from seriesengine.operators.events import with_event_key
from seriesengine.operators.layout import (
    CHUNK,
    POS,
    ROWS,
    Layout,
    Series,
    chunk_of,
    public,
    spread_to_chunks,
)
from seriesengine.operators.regime import (
    MOMENTUM,
    NEUTRAL_RANK,
    VOLATILITY,
    VOLATILITY_UNITS,
    features,
    segments_of,
    stored_states,
)
from seriesengine.params import DATE, SLOW, StatusRules
from seriesengine.scratch import materialize

# Distances are compared at this many digits: days of one carried-forward report
# can be equally near on paper and differ only by floating-point noise.
DISTANCE_DIGITS = 9

_MEASURES = {"price": SLOW, "vol": VOLATILITY, "mom": MOMENTUM}


def check_status_input(series: Series, rules: StatusRules) -> None:
    """Raise on missing columns and on a single series that is too short."""
    missing = {DATE, SLOW} - set(series.frame.columns)
    if missing:
        raise ValueError(f"status needs the columns {sorted(missing)}")
    if not series.keyed and series.max_rows < rules.min_rows:
        raise ValueError(f"series has {series.max_rows} rows, at least {rules.min_rows} needed")


def rejected_series(series: Series, rules: StatusRules | None = None) -> DataFrame:
    """Keyed series too short for a status, with their lengths."""
    rules = rules or StatusRules()
    return public(
        series.frame.filter((F.col(POS) == 0) & (F.col(ROWS) < rules.min_rows)).select(
            *series.keys, ROWS
        ),
        series.keys,
    )


def _features(series: Series, rules: StatusRules) -> DataFrame:
    """Features of the series that are long enough, stored where they are read twice."""
    check_status_input(series, rules)
    rows = features(series, rules).filter(F.col(ROWS) >= rules.min_rows)
    return rows if series.one_chunk else materialize(rows, "features")[0]


def _looked_back(rules: StatusRules) -> dict[str, Column]:
    """The last state of a series and the prices it is compared with, as aggregates."""
    from_end = F.col(ROWS) - 1 - F.col(POS)

    def back(offset: int, column: str) -> Column:
        return F.max(F.when(from_end == offset, F.col(column)))

    return {
        "as_of": back(0, DATE),
        "now_price": back(0, SLOW),
        "now_vol": back(0, VOLATILITY),
        "now_vol_units": back(0, VOLATILITY_UNITS),
        "now_mom": back(0, MOMENTUM),
        "week_price": back(rules.week_rows, SLOW),
        "year_price": back(rules.year_rows, SLOW),
    }


def _moments(rules: StatusRules) -> dict[str, Column]:
    """Means and deviations of the rows that an analogue may be found among, as aggregates."""
    candidate = F.col(POS) < F.col(ROWS) - rules.analogue_exclusion
    found = {}
    for name, column in _MEASURES.items():
        value = F.when(candidate, F.col(column))
        found |= {f"{name}_mean": F.avg(value), f"{name}_std": F.stddev_pop(value)}
    return found


def _beside_rows(
    rows: DataFrame, per_key: DataFrame, keys: tuple[str, ...], layout: Layout
) -> DataFrame:
    """Put the one-row state of a series next to each of its rows."""
    state = spread_to_chunks(per_key, layout).drop(ROWS)
    return rows.withColumn(CHUNK, chunk_of(F.col(POS), layout)).join(state, [*keys, CHUNK])


def _state(rows: DataFrame, series: Series, rules: StatusRules, nearest: bool = False) -> DataFrame:
    """Latest state plus everything counted or averaged against it, one row per series.

    Where every series is one chunk, the last state and the moments are windows over the
    series, so all of it, with ``nearest`` the nearest earlier row too, comes out of one
    shuffle. Otherwise the last states are found first and put beside each row, and the
    nearest rows are found afterwards, by the moments.
    """
    keys = series.keys
    looked_back, moments = _looked_back(rules), _moments(rules)
    below = F.col(SLOW) < F.col("now_price")
    recent = F.col(POS) >= F.col(ROWS) - rules.rolling_rows
    counts = {
        "_below": F.count_if(below),
        "_below_recent": F.count_if(below & recent),
        "_below_vol": F.count_if(F.col(VOLATILITY_UNITS) < F.col("now_vol_units")),
        "_vols": F.count(VOLATILITY),
    }
    if series.one_chunk:
        whole = Window.partitionBy(*keys)
        beside = rows.withColumns({n: c.over(whole) for n, c in (looked_back | moments).items()})
        groups = [ROWS, *looked_back, *moments]
        if nearest:
            counts["_nearest"] = F.min(F.when(_comparable(rules), F.struct(_distance(), DATE, SLOW)))
    else:
        wanted = (0, rules.week_rows, rules.year_rows)
        few = rows.filter((F.col(ROWS) - 1 - F.col(POS)).isin(*wanted))
        latest = few.groupBy(*keys, ROWS).agg(*[c.alias(n) for n, c in looked_back.items()])
        beside = _beside_rows(rows, latest, keys, series.layout)
        groups = [ROWS, *looked_back]
        counts |= moments
    counted = beside.groupBy(*keys, *groups).agg(*[c.alias(n) for n, c in counts.items()])
    rows_recent = F.least(F.col(ROWS), F.lit(rules.rolling_rows))

    def change(base: str, offset: int) -> Column:
        return F.when(
            F.col(ROWS) > offset, diff_change_pct(F.col("now_price"), F.col(base))
        ).otherwise(F.lit(0.0))

    state = counted.withColumns(
        {
            "percentile_all": share_pct(F.col("_below"), F.col(ROWS)),
            "percentile_rolling": share_pct(F.col("_below_recent"), rows_recent),
            "volatility_rank": F.when(F.col("_vols") == 0, F.lit(NEUTRAL_RANK)).otherwise(
                share_pct(F.col("_below_vol"), F.col("_vols"))
            ),
            "week_change": change("week_price", rules.week_rows),
            "year_change": change("year_price", rules.year_rows),
        }
    ).withColumn("regime", regime(F.col("percentile_rolling"), F.col("volatility_rank")))
    if not nearest or series.one_chunk:
        return state
    # Read twice below; one row per series.
    state, _ = materialize(state, "state")
    found = (
        _beside_rows(rows, state.select(*keys, ROWS, "now_price", "now_vol", "now_mom", *moments), keys, series.layout)
        .filter(_comparable(rules))
        .groupBy(*keys)
        .agg(F.min(F.struct(_distance(), DATE, SLOW)).alias("_nearest"))
    )
    return state.join(found, list(keys), "left")


def _comparable(rules: StatusRules) -> Column:
    """Whether a row may be the analogue of its series' last state."""
    cutoff = F.col(ROWS) - rules.analogue_exclusion
    whole = [F.col(c).isNotNull() for c in ("now_mom", VOLATILITY, MOMENTUM)]
    return reduce(Column.__and__, whole, (cutoff > rules.momentum_rows) & (F.col(POS) < cutoff)) & (
        _distance().isNotNull()
    )


def _distance() -> Column:
    """Distance of a row from the last state in z-scored price, volatility and momentum,
    by the moments of the candidates."""
    squares = F.lit(0.0)
    for name, column in _MEASURES.items():
        mean, std = F.col(f"{name}_mean"), F.col(f"{name}_std")
        gap = zscore(F.col(column), mean, std) - zscore(F.col(f"now_{name}"), mean, std)
        squares = squares + gap * gap
    return F.round(F.sqrt(squares), DISTANCE_DIGITS).alias("_distance")


def _kpi_columns() -> list[Column]:
    return [
        F.col("as_of").cast("string").alias("as_of_date"),
        F.col("regime"),
        round_even(F.col("now_price"), 3).alias("current_price_usd_gal"),
        round_even(F.col("week_change"), 2).alias("delta_1w_pct"),
        round_even(F.col("year_change"), 1).alias("delta_yoy_pct"),
        round_even(F.col("percentile_all"), 1).alias("percentile_25y"),
        round_even(F.col("percentile_rolling"), 1).alias("percentile_5y"),
    ]


def status_kpis(series: Series, rules: StatusRules | None = None) -> DataFrame:
    """Current price, its changes and its percentiles, one row per series."""
    rules = rules or StatusRules()
    rows = _features(series, rules)
    state = _state(rows, series, rules)
    return public(state.select(*series.keys, *_kpi_columns()), series.keys)


def _sparkline(rows: DataFrame, keys: tuple[str, ...], rules: StatusRules) -> DataFrame:
    step = rules.sparkline_step
    back = F.col(ROWS) - 1 - F.col(POS)
    points = F.least(F.lit(rules.sparkline_points), F.floor((F.col(ROWS) - 1) / step) + 1)
    sampled = rows.filter(
        (F.col(ROWS) >= rules.min_rows)
        & (back % step == 0)
        & (back < rules.sparkline_points * step)
    )
    return sampled.select(
        *keys,
        (points - 1 - F.floor(back / step)).cast("int").alias("point"),
        round_even(F.col(SLOW), 3).alias("price"),
    )


def sparkline(series: Series, rules: StatusRules | None = None) -> DataFrame:
    """Up to ``sparkline_points`` prices, every ``sparkline_step`` rows back from
    the last; ``point`` counts up to the latest."""
    rules = rules or StatusRules()
    check_status_input(series, rules)
    return public(_sparkline(series.frame, series.keys, rules), series.keys)


def _analogue_columns() -> list[Column]:
    return [
        F.col(f"_nearest.{DATE}").cast("string").alias("week"),
        round_even(F.col(f"_nearest.{SLOW}"), 3).alias("price_then"),
        round_even(1 / (1 + F.col("_nearest._distance")), 3).alias("similarity_score"),
    ]


def _analogue(state: DataFrame, keys: tuple[str, ...], periods: DataFrame | None = None) -> DataFrame:
    """The nearest row of each state that has one, and the named event of its day."""
    found = state.filter("_nearest IS NOT NULL").select(
        *keys,
        F.col(f"_nearest.{DATE}").alias("_day"),
        *_analogue_columns(),
    )
    if periods is None:
        return found.withColumn("narrative_key", event_key(F.col("_day"))).drop("_day")
    return with_event_key(found, "_day", periods).drop("_day")


def historical_analogue(
    series: Series, rules: StatusRules | None = None, periods: DataFrame | None = None
) -> DataFrame:
    """Closest earlier state of each series that has one, with the named event of its day;
    ``periods`` (``first, last, key``) replace the known events."""
    rules = rules or StatusRules()
    state = _state(_features(series, rules), series, rules, nearest=True)
    return public(_analogue(state, series.keys, periods), series.keys)


def status_counts(series: Series, rules: StatusRules | None = None) -> DataFrame:
    """``as_of_date, regime, regime_segments`` of each series. Segments are counted as
    rows; nothing of a series is collected."""
    rules = rules or StatusRules()
    check_status_input(series, rules)
    rows = stored_states(series, rules)
    state = _state(rows.drop("regime"), series, rules)
    segments = segments_of(rows, series).groupBy(*series.keys).agg(F.count("*").alias("regime_segments"))
    counted = state.join(segments, list(series.keys), "left").select(
        *series.keys,
        F.col("as_of").cast("string").alias("as_of_date"),
        "regime",
        F.coalesce("regime_segments", F.lit(0)).alias("regime_segments"),
    )
    return public(counted, series.keys)


def _snapshot(rows: DataFrame, series: Series, rules: StatusRules) -> DataFrame:
    clause = context_clause(
        F.col("regime"), F.col("percentile_all"), F.col("year_change"), F.col("volatility_rank")
    )
    day = F.col(f"_nearest.{DATE}")
    return _state(rows, series, rules, nearest=True).select(
        *series.keys,
        *_kpi_columns(),
        fixed_text(F.col("now_price"), 2).alias("headline_price"),
        fixed_text(F.col("percentile_all"), 1).alias("headline_pct"),
        signed_whole_text(F.col("year_change")).alias("headline_yoy"),
        clause.alias("context_clause_key"),
        *_analogue_columns(),
        event_key(day).alias("narrative_key"),
    )


def status_snapshot(series: Series, rules: StatusRules | None = None) -> DataFrame:
    """Flat status, one row per series: indicators, headline texts, analogue."""
    rules = rules or StatusRules()
    return public(_snapshot(_features(series, rules), series, rules), series.keys)


def status_document(series: Series, rules: StatusRules | None = None) -> DataFrame:
    """Nested status, one row per series, with sparkline and regime history.

    The lists belong to one series; the longest, the history, has at most one
    element per date of the calendar. ``regime_history`` gives it as a table. All parts
    read one stored table of features and regimes.
    """
    rules = rules or StatusRules()
    keys = list(series.keys)
    check_status_input(series, rules)
    rows = stored_states(series, rules)
    points = (
        _sparkline(rows, series.keys, rules)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("point", "price"))).alias("_points"))
    )
    segments = (
        segments_of(rows, series)
        .select(
            *keys,
            F.struct(
                F.col("start").cast("string").alias("start"),
                F.col("end").cast("string").alias("end"),
                "regime",
            ).alias("_segment"),
        )
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list("_segment")).alias("regime_history"))
    )
    document = (
        _snapshot(rows.drop("regime"), series, rules)
        .join(points, keys, "left")
        .join(segments, keys, "left")
    )
    kpis = F.struct(
        "current_price_usd_gal", "delta_1w_pct", "delta_yoy_pct", "percentile_25y", "percentile_5y"
    )
    headline = F.struct(
        F.col("headline_price").alias("price"),
        F.col("headline_pct").alias("pct"),
        F.col("headline_yoy").alias("yoy"),
        "context_clause_key",
    )
    analogue = F.struct("week", "price_then", "similarity_score", "narrative_key")
    return public(
        document.select(
            *keys,
            "as_of_date",
            "regime",
            kpis.alias("kpis"),
            headline.alias("headline_vars"),
            F.transform("_points", lambda p: p["price"]).alias("sparkline_12w"),
            F.when(F.col("week").isNotNull(), analogue).alias("historical_analogue"),
            "regime_history",
        ),
        series.keys,
    )
