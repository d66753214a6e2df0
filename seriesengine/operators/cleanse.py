"""Raw to clean tables: one valid row per business key, from the latest batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesengine.functions.numeric import valid_price
from seriesengine.params import DATE, FAST_PRICE, SLOW_PERIOD, SLOW_PRICE
from seriesengine.sources.schemas import INGESTION_TIMESTAMP, WEEKLY_AREA


def latest_per_key(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Newest row of each key.

    Rows of one batch share their version, so the other columns break ties. The
    rank limit is applied before the shuffle as well, so a hot key sends one row
    per map task.
    """
    rest = [c for c in df.columns if c not in keys and c != version]
    newest = Window.partitionBy(*keys).orderBy(
        F.col(version).desc(), *[F.col(c).asc() for c in rest]
    )
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def cleanse(
    raw: DataFrame,
    keys: Sequence[str],
    version: str,
    columns: Mapping[str, str],
    valid: Column,
    where: Column | None = None,
) -> DataFrame:
    """Filter, keep the newest row per key, rename, then drop invalid rows.

    ``columns`` maps raw to clean names and must include the keys; ``valid``
    speaks of clean names. The check follows the selection on purpose: a key
    whose newest row is invalid disappears, and no older row takes its place.
    """
    rows = raw if where is None else raw.filter(where)
    needed = list(dict.fromkeys([*keys, *columns, version]))
    newest = latest_per_key(rows.select(*needed), keys, version)
    return newest.select([F.col(c).alias(name) for c, name in columns.items()]).filter(valid)


def clean_daily(raw: DataFrame) -> DataFrame:
    """Raw daily prices to one valid row per date."""
    columns = {
        "date": DATE,
        "close": FAST_PRICE,
        "open": "open_usd_bbl",
        "high": "high_usd_bbl",
        "low": "low_usd_bbl",
        "volume": "volume",
    }
    return cleanse(
        raw, ["date"], INGESTION_TIMESTAMP, columns, valid_price(F.col(FAST_PRICE))
    )


def clean_weekly(raw: DataFrame, area: str = WEEKLY_AREA) -> DataFrame:
    """Raw weekly prices of one area to one valid row per week."""
    columns = {"period": SLOW_PERIOD, "value": SLOW_PRICE}
    return cleanse(
        raw,
        ["period"],
        INGESTION_TIMESTAMP,
        columns,
        valid_price(F.col(SLOW_PRICE)),
        where=F.col("duoarea") == area,
    )
