"""Parameters of the analytics: column names, windows, thresholds and layout."""

from __future__ import annotations

from dataclasses import dataclass, field

# Column names that consumers of the gold tables rely on.
DATE = "date"
FAST = "wti_usd_bbl"
SLOW = "diesel_usd_gal"
SLOW_DATE = "diesel_week_ending"

# Column names of the cleansed (silver) series.
FAST_PRICE = "price_usd_bbl"
SLOW_PRICE = "price_usd_gal"
SLOW_PERIOD = "week_ending"

# A row of either series in one frame; on a shared date the slow side comes first.
SIDE = "side"
PRICE = "price"
SLOW_SIDE = 0
FAST_SIDE = 1

# Physical key of a series for which the caller names no key.
WHOLE_SERIES = "_series"


@dataclass(frozen=True)
class LagRange:
    """Row offsets of the cross-correlation sweep, both ends included."""

    first: int = 0
    last: int = 90


@dataclass(frozen=True)
class ShockRules:
    """Shock detection: look-back rows, suppression rows each side, rows kept."""

    window: int = 28
    suppression: int = 14
    top_n: int = 10


@dataclass(frozen=True)
class StatusRules:
    """Windows of the status snapshot. All of them count rows, not days."""

    volatility_rows: int = 30
    volatility_min_rows: int = 10
    rolling_rows: int = 252 * 5
    momentum_rows: int = 28
    week_rows: int = 5
    year_rows: int = 252
    sparkline_points: int = 12
    sparkline_step: int = 5
    analogue_exclusion: int = 365 * 2
    min_rows: int = 60


@dataclass(frozen=True)
class Layout:
    """How one series is cut so that no task ever holds a whole long series.

    ``bucket_days``: calendar width of a bucket, counted from 1970. A series has
    one row per date, so a (series, bucket) group holds at most ``bucket_days``
    rows of either side. Dates from 1970 to 2059 share one bucket; the summary of
    a series over all dates to year 9999 has some hundred buckets.

    ``chunk_rows``: rows of a positional chunk; must exceed the widest frame.
    ``value_splits``: value blocks per node of the cross-chunk rank tree.
    """

    bucket_days: int = 32768
    chunk_rows: int = 16384
    value_splits: int = 64


@dataclass(frozen=True)
class Params:
    lags: LagRange = field(default_factory=LagRange)
    shocks: ShockRules = field(default_factory=ShockRules)
    status: StatusRules = field(default_factory=StatusRules)
    layout: Layout = field(default_factory=Layout)


DEFAULTS = Params()
