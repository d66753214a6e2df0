"""Classification of a price state: regime, context clause and named event."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Regime names.
CALM = "calm"
ELEVATED = "elevated"
EXTREME = "extreme"

# Regime thresholds in percent.
EXTREME_PRICE_PCT = 80
EXTREME_VOLATILITY_RANK = 75
CALM_PRICE_PCT = 50
CALM_VOLATILITY_RANK = 50

# Context clauses as (regime, measure, comparison, bound, clause);
# the first match wins, a row without a measure matches its whole regime.
CONTEXT_CLAUSES = (
    (EXTREME, "volatility_rank", ">", 90, "extreme_volatility"),
    (EXTREME, "percentile_all", ">", 95, "extreme_high"),
    (EXTREME, None, None, None, "extreme_general"),
    (ELEVATED, "year_change", ">", 20, "elevated_rising"),
    (ELEVATED, "year_change", "<", -20, "elevated_falling"),
    (ELEVATED, None, None, None, "elevated_general"),
    (CALM, "percentile_all", "<", 25, "calm_low"),
    (CALM, None, None, None, "calm_general"),
)

# Named events as (first day, last day, key), and the key of all
# other days.
EVENT_PERIODS = (
    ("2005-01-01", "2005-12-31", "analogue_2005_katrina"),
    ("2008-01-01", "2008-12-31", "analogue_2008_crisis"),
    ("2009-01-01", "2009-12-31", "analogue_2009_recovery"),
    ("2014-01-01", "2016-12-31", "analogue_2014_oil_crash"),
    ("2020-01-01", "2020-12-31", "analogue_2020_covid"),
    ("2022-02-01", "2022-07-31", "analogue_2022_invasion"),
)
OTHER_EVENT = "analogue_generic"


def regime(price_pct: Column, volatility_rank: Column) -> Column:
    """Regime from the rolling price percentile and the volatility rank."""
    hot = (price_pct > EXTREME_PRICE_PCT) | (volatility_rank > EXTREME_VOLATILITY_RANK)
    quiet = (price_pct < CALM_PRICE_PCT) & (volatility_rank < CALM_VOLATILITY_RANK)
    return F.when(hot, EXTREME).when(quiet, CALM).otherwise(ELEVATED)


def context_clause(
    regime_name: Column, percentile_all: Column, year_change: Column, volatility_rank: Column
) -> Column:
    """Key of the sentence that describes the current state."""
    measures = {
        "percentile_all": percentile_all,
        "year_change": year_change,
        "volatility_rank": volatility_rank,
    }

    def matches(rule: tuple) -> Column:
        name, measure, comparison, bound, _ = rule
        hit = regime_name == name
        if measure is None:
            return hit
        value = measures[measure]
        return hit & (value > bound if comparison == ">" else value < bound)

    return F.coalesce(*[F.when(matches(r), F.lit(r[-1])) for r in CONTEXT_CLAUSES])


def event_key(day: Column) -> Column:
    """Named event whose period holds the day."""
    periods = [
        F.when(day.between(F.lit(first).cast("date"), F.lit(last).cast("date")), F.lit(key))
        for first, last, key in EVENT_PERIODS
    ]
    known = reduce(lambda a, b: F.coalesce(a, b), periods)
    return F.when(day.isNotNull(), F.coalesce(known, F.lit(OTHER_EVENT)))
