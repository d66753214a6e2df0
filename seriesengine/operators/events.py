"""Named events: days joined to a table of periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesengine.functions.labels import EVENT_PERIODS, OTHER_EVENT

PERIODS = "first date, last date, key string"


def known_periods(spark: SparkSession) -> DataFrame:
    """The named periods as a table of ``first, last, key``, both days included."""
    rows = spark.createDataFrame(EVENT_PERIODS, "first string, last string, key string")
    return rows.select(F.to_date("first").alias("first"), F.to_date("last").alias("last"), "key")


def with_event_key(
    rows: DataFrame,
    day: str,
    periods: DataFrame | None = None,
    name: str = "narrative_key",
    other: str = OTHER_EVENT,
) -> DataFrame:
    """``rows`` with the key of the period that holds a day, or ``other``; null for no day.

    ``periods`` (``first, last, key``) may be any table; without one it is that of the
    named events. Where periods overlap, the one that begins first counts, then the one
    that ends first, then the smaller key. A period without an end, or that ends before
    it begins, holds no day.

    Neither side is compared with all of the other: a period is listed under every month
    that it touches, days meet periods of their month in an equi-join, and each distinct
    day is looked up once.
    """
    periods = known_periods(rows.sparkSession) if periods is None else periods
    month = lambda value: F.trunc(value, "month")
    listed = periods.filter("first <= last AND key IS NOT NULL").select(
        "first",
        "last",
        "key",
        F.explode(F.sequence(month("first"), month("last"), F.expr("INTERVAL 1 MONTH"))).alias("_month"),
    )
    days = rows.select(F.to_date(day).alias("_day")).filter("_day IS NOT NULL").distinct()
    found = (
        days.withColumn("_month", month("_day"))
        .join(listed, "_month")
        .filter("_day BETWEEN first AND last")
        .groupBy("_day")
        .agg(F.min(F.struct("first", "last", "key"))["key"].alias("_key"))
    )
    # The rows' columns stay in a struct, so that none can clash with those of the days.
    kept = [F.col("_row")[c].alias(c) for c in rows.columns if c != name]
    packed = rows.select(F.struct(*rows.columns).alias("_row"), F.to_date(day).alias("_at"))
    key = F.when(F.col("_at").isNotNull(), F.coalesce("_key", F.lit(other)))
    return packed.join(found, F.col("_at") == F.col("_day"), "left").select(*kept, key.alias(name))
