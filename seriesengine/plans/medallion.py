"""The stages from landed batches to exports, meeting in tables.

``python -m seriesengine.plans.medallion --root DIR [--daily CSV] [--weekly JSON]``
runs them all; ``--stage`` runs one.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from seriesengine.operators import cleanse, crosscorr, shocks, status, timeline
from seriesengine.operators.layout import Series, index_series
from seriesengine.params import DATE, DEFAULTS, SLOW_PERIOD, Params
from seriesengine.scratch import materialize, release
from seriesengine.sinks import exports
from seriesengine.sources import landing
from seriesengine.sources.catalog import (
    Catalog,
    overwrite_table,
    read_table,
    replace_partition,
    table_summary,
)

STAGES = ("bronze", "silver", "gold", "export")


def _report(name: str, df: DataFrame, day: str) -> None:
    rows, first, last = table_summary(df, day).first()
    print(f"{name}: {rows} rows, {first} to {last}")


def _only_batch(df: DataFrame) -> DataFrame:
    """The batch as written to scratch: landed files are read once."""
    return materialize(df, "batch")[0]


def ingest_daily(
    spark: SparkSession, catalog: Catalog, path: str, moment: datetime, fmt: str = "csv"
) -> None:
    """Land one daily batch. Running it again on the same day replaces it."""
    batch = _only_batch(landing.daily_batch(landing.read_daily_landing(spark, path, fmt), moment))
    replace_partition(batch, catalog.daily_raw, fmt=catalog.fmt)
    _report("raw daily", batch, "date")


def ingest_weekly(spark: SparkSession, catalog: Catalog, path: str, moment: datetime) -> None:
    """Land one batch of API pages, refusing an incomplete one."""
    pages = landing.read_api_pages(spark, path)
    found = landing.page_completeness(pages).first()
    if not found["complete"]:
        raise ValueError(f"{path} holds {found['records']} of {found['total']} records, or some twice: {found}")
    batch = _only_batch(landing.weekly_batch(pages, moment))
    replace_partition(batch, catalog.weekly_raw, fmt=catalog.fmt)
    _report("raw weekly", batch, "period")


def build_silver(spark: SparkSession, catalog: Catalog) -> None:
    daily = cleanse.clean_daily(read_table(spark, catalog.daily_raw, catalog.fmt))
    weekly = cleanse.clean_weekly(read_table(spark, catalog.weekly_raw, catalog.fmt))
    _report("clean daily", overwrite_table(daily, catalog.daily_clean, catalog.fmt), DATE)
    stored = overwrite_table(weekly, catalog.weekly_clean, catalog.fmt)
    _report("clean weekly", stored, SLOW_PERIOD)


def build_gold(spark: SparkSession, catalog: Catalog, params: Params = DEFAULTS) -> Series:
    """Write the three gold tables; all of them use one stored timeline."""
    series = timeline.timeline_series(
        read_table(spark, catalog.daily_clean, catalog.fmt),
        read_table(spark, catalog.weekly_clean, catalog.fmt),
        layout=params.layout,
    )
    gold = overwrite_table(timeline.timeline_table(series), catalog.timeline, catalog.fmt)
    _report("price timeline", gold, DATE)
    overwrite_table(crosscorr.lag_sweep(series, params.lags), catalog.lag, catalog.fmt)
    ranking = overwrite_table(
        shocks.shock_ranking(series, params.shocks), catalog.shocks, catalog.fmt
    )
    exports.preview(ranking).show(truncate=False)
    return series


def export_all(
    spark: SparkSession,
    catalog: Catalog,
    params: Params = DEFAULTS,
    moment: datetime | None = None,
) -> dict[str, dict[str, object]]:
    """Publish the four JSON exports and the manifest; returns the manifest's tables.

    What has not changed since the last export is neither written nor read again.
    """
    gold = read_table(spark, catalog.timeline, catalog.fmt)
    sweep = read_table(spark, catalog.lag, catalog.fmt)
    ranking = read_table(spark, catalog.shocks, catalog.fmt)
    series = index_series(gold, layout=params.layout)
    document = status.status_document(series, params.status)
    outputs = {
        "price_timeline": exports.Output(gold, [DATE], exports.timeline_metrics(DATE)),
        "wti_diesel_lag": exports.Output(sweep, ["lag_days"], exports.lag_metrics()),
        "fuel_shocks": exports.Output(ranking, ["rank"], exports.shock_metrics()),
        "diesel_status": exports.Output(document, None, exports.document_metrics()),
    }
    through = lambda tables: str(tables["price_timeline"]["max_date"])
    done = exports.publish(spark, outputs, catalog.exports, through, moment)
    print("exported:", ", ".join(name for name, written in done.items() if written) or "nothing new")
    return exports.read_manifest(spark, catalog.exports)["tables"]


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--root", default=Catalog.from_environment().root)
    parser.add_argument("--daily", help="landed daily batch")
    parser.add_argument("--daily-format", default="csv")
    parser.add_argument("--weekly", help="folder of landed API pages")
    parser.add_argument("--stage", choices=STAGES, action="append")
    args = parser.parse_args()
    stages = args.stage or STAGES

    spark = SparkSession.builder.appName("seriesengine").getOrCreate()
    catalog = Catalog(args.root)
    moment = datetime.now(timezone.utc)
    try:
        if "bronze" in stages and args.daily:
            ingest_daily(spark, catalog, args.daily, moment, args.daily_format)
        if "bronze" in stages and args.weekly:
            ingest_weekly(spark, catalog, args.weekly, moment)
        if "silver" in stages:
            build_silver(spark, catalog)
        if "gold" in stages:
            build_gold(spark, catalog)
        if "export" in stages:
            print(export_all(spark, catalog, moment=moment))
    finally:
        release(spark)
        spark.stop()


if __name__ == "__main__":
    main()
