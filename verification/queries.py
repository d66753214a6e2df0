"""One query per operator, over whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesengine.functions.numeric import valid_price
from seriesengine.operators import (
    cleanse,
    crosscorr,
    events,
    quality,
    regime,
    shocks,
    status,
    timeline,
)
from seriesengine.operators.layout import Series, public
from seriesengine.plans import medallion
from seriesengine.params import LagRange, Layout, ShockRules, StatusRules
from seriesengine.scratch import materialize, new_path
from seriesengine.sinks import exports
from seriesengine.sources import catalog, landing, paired
from seriesengine.sources.paired import table
from seriesengine.sources.schemas import API_PAGE_SIZE

Query = Callable[[SparkSession, str], DataFrame]

# Spreads every series of the test data over many buckets and chunks.
CHUNKED = Layout(bucket_days=64, chunk_rows=256, value_splits=4)

# Ingestion instant of every batch, so that runs can be compared.
BATCH = datetime(2024, 6, 30, 12, 0, 0)

PRIORITY = ("o_orderpriority",)
SUPPLIER = ("l_suppkey",)
PART = ("l_partkey",)

_SIDES = {
    (): lambda spark, folder: timeline.sides(*paired.whole(spark, folder)),
    PRIORITY: paired.by_priority,
    SUPPLIER: paired.by_supplier,
    PART: paired.by_part,
}


# Sums of doubles, whose last bits depend on the order of rows. All other values
# are the same in every engine to the last bit.
_ORDER_DEPENDENT = ("correlation", "volatility")


def comparable(df: DataFrame) -> DataFrame:
    """Dates as ISO text and order-dependent doubles at 6 digits."""
    columns = []
    for field in df.schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            value = value.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            if isinstance(field.dataType, T.TimestampType):
                value = F.to_utc_timestamp(value, F.current_timezone())
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif field.name in _ORDER_DEPENDENT:
            value = F.round(value, 6)
        columns.append(value.alias(field.name))
    return df.select(columns)


def series(
    spark: SparkSession, folder: str, keys: tuple[str, ...] = (), layout: Layout | None = None
) -> Series:
    return timeline.series_of(_SIDES[keys](spark, folder), keys, layout)


def on_series(
    operator: Callable[[Series], DataFrame],
    keys: tuple[str, ...] = (),
    layout: Layout | None = None,
) -> Query:
    """Query that applies an operator to the timeline of a data folder."""
    return lambda spark, folder: comparable(operator(series(spark, folder, keys, layout)))


def price_timeline(keys: tuple[str, ...] = (), layout: Layout | None = None) -> Query:
    return on_series(timeline.timeline_table, keys, layout)


def optimal_lag(keys: tuple[str, ...] = ()) -> Query:
    return on_series(lambda s: crosscorr.optimal_lag(crosscorr.lag_sweep(s), keys), keys)


def rolling_percentile(s: Series) -> DataFrame:
    return regime.regime_daily(s).select("date", "price_pct")


def expanding_rank(s: Series) -> DataFrame:
    return regime.regime_daily(s).select("date", "volatility_rank")


def momentum(s: Series) -> DataFrame:
    return public(regime.features(s), s.keys).select("date", regime.MOMENTUM)


def rises(s: Series) -> DataFrame:
    columns = ["date", shocks.START, "diesel_usd_gal", shocks.CHANGE]
    return shocks.rises(s, ShockRules()).select(*columns)


def local_peaks(s: Series) -> DataFrame:
    rules = ShockRules()
    return shocks.local_peaks(shocks.numbered_rises(s, rules), rules).select("date", shocks.CHANGE)


def latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "event_type", "ts", "value")
    return comparable(cleanse.latest_per_key(events, ["user_id", "event_type"], "ts"))


def cleansed_events(spark: SparkSession, folder: str) -> DataFrame:
    columns = {"user_id": "account", "event_type": "kind", "value": "amount"}
    return comparable(
        cleanse.cleanse(
            table(spark, folder, "events"),
            ["user_id", "event_type"],
            "ts",
            columns,
            valid_price(F.col("amount")),
            where=F.col("event_type") != "error",
        )
    )


def _daily_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Land all order lines as a daily CSV batch, then ingest it."""
    price, discount, tax = (F.col(c) for c in ("l_extendedprice", "l_discount", "l_tax"))
    landed = table(spark, folder, "lineitem").select(
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(" 00:00:00-05:00")).alias("Date"),
        price.alias("Open"),
        (price * (1 + tax)).alias("High"),
        (price * (1 - discount)).alias("Low"),
        (price * (1 - discount) * (1 + tax)).alias("Close"),
        price.alias("Adj Close"),
        F.col("l_quantity").cast("bigint").alias("Volume"),
        discount.alias("Dividends"),
        tax.alias("Stock Splits"),
    )
    path = new_path(spark, "daily-landing")
    landed.write.option("header", True).csv(path)
    return landing.daily_batch(landing.read_daily_landing(spark, path), BATCH)


def ingest_daily_batch(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_daily_raw(spark, folder))


def clean_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Many rows per date in one batch, reduced to one."""
    return comparable(cleanse.clean_daily(_daily_raw(spark, folder)))


def _land_pages(spark: SparkSession, folder: str, offsets: bool = True) -> DataFrame:
    """All events as API pages of the usual size: ``page`` and its JSON ``value``."""
    events = table(spark, folder, "events")
    record = F.struct(
        F.date_format("ts", "yyyy-MM-dd").alias("period"),
        F.lit("NUS").alias("duoarea"),
        F.lit("U.S.").alias("area-name"),
        F.col("event_type").alias("product"),
        F.upper("event_type").alias("product-name"),
        F.col("user_id").cast("string").alias("process"),
        F.col("props").alias("process-name"),
        F.col("value").cast("string").alias("value"),
        F.lit("USD").alias("units"),
        F.col("event_id").alias("extra"),
    )
    total = events.agg(F.count("*").cast("string").alias("total")).first()["total"]
    offset = (F.col("page") * API_PAGE_SIZE).cast("string")
    request = F.struct(F.struct((offset if offsets else F.lit(None).cast("string")).alias("offset")).alias("params"))
    return (
        events.groupBy(F.floor(F.col("event_id") / API_PAGE_SIZE).alias("page"))
        .agg(F.struct(F.lit(total).alias("total"), F.collect_list(record).alias("data")).alias("response"))
        .select("page", F.to_json(F.struct(request.alias("request"), "response")).alias("value"))
    )


def _read_pages(landed: DataFrame) -> DataFrame:
    path = new_path(landed.sparkSession, "api-landing")
    landed.select("value").write.text(path)
    return landing.read_api_pages(landed.sparkSession, path, page_per_line=True)


def _event_pages(spark: SparkSession, folder: str) -> DataFrame:
    return _read_pages(_land_pages(spark, folder))


def ingest_api_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = _event_pages(spark, folder)
    return comparable(landing.weekly_batch(pages, BATCH, product=None, area=None))


def clean_weekly(spark: SparkSession, folder: str) -> DataFrame:
    pages = _event_pages(spark, folder)
    return comparable(cleanse.clean_weekly(landing.weekly_batch(pages, BATCH, None, None)))


def select_series(spark: SparkSession, folder: str) -> DataFrame:
    pages = _event_pages(spark, folder)
    batch = landing.weekly_batch(pages, BATCH, product="purchase", area="NUS")
    return comparable(batch.select("period", "product", "process", "value"))


def page_completeness(spark: SparkSession, folder: str) -> DataFrame:
    return landing.page_completeness(_event_pages(spark, folder))


def page_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """All events, landed in four ways that are not whole: the first page twice in place of
    the second, the second page missing, the first twice beside all, and without offsets
    the first twice in place of the second."""

    def without_second(pages: DataFrame) -> DataFrame:
        return pages.filter("page <> 1")

    def first_twice(pages: DataFrame) -> DataFrame:
        return pages.unionByName(pages.filter("page = 0"))

    whole, _ = materialize(_land_pages(spark, folder), "pages")
    plain, _ = materialize(_land_pages(spark, folder, offsets=False), "pages")
    cases = {
        "whole": whole,
        "first for second": first_twice(without_second(whole)),
        "second missing": without_second(whole),
        "first twice": first_twice(whole),
        "no offsets": plain,
        "no offsets, first for second": first_twice(without_second(plain)),
    }
    rows = [
        landing.page_completeness(_read_pages(pages)).withColumn("landed", F.lit(name))
        for name, pages in cases.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def partition_replace(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches of all events on two days, then the second day once more."""
    path = new_path(spark, "replaced")
    events = table(spark, folder, "events").select("event_id", "value")
    for day, extra in (("2024-06-29", 0), ("2024-06-30", 0), ("2024-06-30", 1)):
        batch = events.withColumn("value", F.col("value") + extra).withColumn(
            "ingestion_date", F.lit(day).cast("date")
        )
        catalog.replace_partition(batch, path)
    return comparable(catalog.read_table(spark, path))


def table_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """All events written twice; the second content replaces the first."""
    path = new_path(spark, "overwritten")
    events = table(spark, folder, "events").select("event_id", "value")
    catalog.overwrite_table(events, path)
    return catalog.overwrite_table(events.withColumn("value", F.col("value") + 1), path)


def table_summary(spark: SparkSession, folder: str) -> DataFrame:
    days = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
    rows = [
        catalog.table_summary(table(spark, folder, name).select(F.to_date(day).alias("d")), "d")
        .withColumn("table", F.lit(name))
        for name, day in days.items()
    ]
    return comparable(reduce(DataFrame.unionByName, rows))


def _as_text(value: object) -> str:
    return {"optimal_correlation": "{:.4f}", "top_event_pct_change": "{:.2f}"}.get(value[0], "{}").format(value[1])


def export_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics that the exports of the gold tables observe, and the status's counts."""
    s = series(spark, folder)
    arrays = {
        "price_timeline": (timeline.timeline_table(s), "date", exports.timeline_metrics("date")),
        "wti_diesel_lag": (crosscorr.lag_sweep(s), "lag_days", exports.lag_metrics()),
        "fuel_shocks": (shocks.shock_ranking(s), "rank", exports.shock_metrics()),
    }
    rows = []
    for name, (df, order, metrics) in arrays.items():
        done = exports.export_array(df, order, new_path(spark, "export"), **metrics)
        rows += [(name, stat, _as_text((stat, v))) for stat, v in exports.statistics(done).items()]
    exported = spark.createDataFrame(rows, "table string, stat string, value string")
    counts = status.status_counts(s)
    texts = counts.select([F.col(c).cast("string").alias(c) for c in counts.columns])
    status_rows = texts.unpivot([], texts.columns, "stat", "value").select(
        F.lit("diesel_status").alias("table"), "stat", "value"
    )
    return exported.unionByName(status_rows)


def _roundtrip(df: DataFrame, *order: str, parts: bool = False) -> DataFrame:
    spark = df.sparkSession
    path = new_path(spark, "export")
    exports.export_array(df, order, path, parts)
    return exports.read_array(spark, path, df.schema).drop("_corrupt_record")


def export_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Timeline exported as a folder of parts and read back."""
    gold = timeline.timeline_table(series(spark, folder))
    return comparable(_roundtrip(gold, "date", parts=True))


def export_keyed_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Keyed timeline exported by key and date and read back."""
    gold = timeline.timeline_table(series(spark, folder, SUPPLIER))
    return comparable(_roundtrip(gold, *SUPPLIER, "date", parts=True))


def export_order(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of an exported timeline with their places in all part files."""
    gold = timeline.timeline_table(series(spark, folder)).select("date", "diesel_usd_gal")
    path = new_path(spark, "export")
    exports.export_array(gold, "date", path, parts=True)
    body = F.from_json(F.regexp_replace("value", r"^[\[,]|\]$", ""), gold.schema)
    lines = exports.numbered_lines(spark, path).select(F.col("line").cast("int"), body.alias("r"))
    return comparable(lines.select("line", "r.*"))


def export_lag_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Lag sweep exported as one file and read back."""
    sweep, _ = materialize(crosscorr.lag_sweep(series(spark, folder)), "sweep")
    return comparable(_roundtrip(sweep, "lag_days"))


def export_shocks_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    ranking, _ = materialize(shocks.shock_ranking(series(spark, folder)), "ranking")
    return comparable(_roundtrip(ranking, "rank"))


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of the timeline, written with an instant that names no zone, read back."""
    gold = timeline.timeline_table(series(spark, folder))
    stats = exports.export_array(gold, "date", new_path(spark, "export"), **exports.timeline_metrics("date"))
    tables = {"price_timeline": {"rows": stats["rows"], "min_date": stats["min_date"]}}
    path = exports.write_manifest(spark, tables, stats["max_date"], new_path(spark, "manifest"), BATCH)
    back = spark.read.json(path, multiLine=True)
    return back.select("generated_at", "data_through", "tables.price_timeline.*")


def publish_on_change(spark: SparkSession, folder: str) -> DataFrame:
    """The timeline and all events published three times: new, the same in another order of
    rows, and with some events changed. What is left alone keeps its manifest entry."""
    gold = timeline.timeline_table(series(spark, folder))
    every = table(spark, folder, "events").select("event_id", "value")
    path = new_path(spark, "published")
    doubled = F.when(F.col("event_id") % 100 == 7, F.col("value") * 2).otherwise(F.col("value"))
    turns = [(gold, every), (gold.repartition(3), every.repartition(5)), (gold, every.withColumn("value", doubled))]
    rows = []
    for turn, (days, values) in enumerate(turns, 1):
        outputs = {
            "price_timeline": exports.Output(days, ["date"], exports.timeline_metrics("date")),
            "events": exports.Output(values, ["event_id"]),
        }
        through = lambda tables: tables["price_timeline"]["max_date"]
        done = exports.publish(spark, outputs, path, through, BATCH, parts=True)
        listed = exports.read_manifest(spark, path)["tables"]
        rows += [(turn, name, done[name], listed[name]["rows"]) for name in outputs]
    found = spark.createDataFrame(rows, "turn int, table string, published boolean, rows long")
    back = exports.read_array(spark, f"{path}/events.json", every.schema).drop("_corrupt_record")
    total = back.agg(F.lit("events").alias("table"), F.round(F.sum("value"), 2).alias("total"))
    return found.join(total, "table", "left")


def event_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Named event of every order's date, moved by whole years into 2004 to 2023."""
    years = 9 + F.pmod(F.col("o_orderkey"), F.lit(14))
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.add_months(F.to_date("o_orderdate"), (12 * years).cast("int")).alias("date")
    )
    return comparable(events.with_event_key(orders, "date"))


def event_keys_given(spark: SparkSession, folder: str) -> DataFrame:
    """The same dates against periods of the caller's, which overlap: for every status of
    orders, from its first to its last order above 400,000."""
    orders = table(spark, folder, "orders")
    large = orders.filter("o_totalprice > 400000").groupBy(F.col("o_orderstatus").alias("key"))
    periods = large.agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    days = orders.select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    return comparable(events.with_event_key(days, "date", periods, other="none"))


def catalog_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The stages from landed batches to gold through one catalog: every table's rows and days.

    All order lines land as the daily batch, on two days, and all events as API pages.
    """
    tables = catalog.Catalog(new_path(spark, "catalog"))
    daily = _daily_raw(spark, folder)
    for day in ("2024-06-29", "2024-06-30"):
        batch = daily.withColumn("ingestion_date", F.lit(day).cast("date"))
        catalog.replace_partition(batch, tables.daily_raw, fmt=tables.fmt)
    weekly = landing.weekly_batch(_event_pages(spark, folder), BATCH, product=None, area=None)
    catalog.replace_partition(weekly, tables.weekly_raw, fmt=tables.fmt)
    medallion.build_silver(spark, tables)
    medallion.build_gold(spark, tables)
    days = {"daily_raw": "date", "weekly_raw": "period", "daily_clean": "date", "weekly_clean": "week_ending", "timeline": "date"}
    rows = [
        catalog.table_summary(
            catalog.read_table(spark, getattr(tables, name), tables.fmt).select(F.to_date(day).alias("d")), "d"
        ).withColumn("table", F.lit(name))
        for name, day in days.items()
    ]
    return comparable(reduce(DataFrame.unionByName, rows))


def changed_null_move(spark: SparkSession, folder: str) -> DataFrame:
    """A value that moves from one column to an empty one is a change."""
    gold, _ = materialize(timeline.timeline_table(series(spark, folder)), "gold")
    late = F.col("diesel_usd_gal").isNull() | (F.col("date") == F.lit("1996-01-01"))
    old = gold.withColumn("diesel_usd_gal", F.when(~late, F.col("diesel_usd_gal")))
    moved = old.withColumns(
        {
            "wti_usd_bbl": F.when(~late, F.col("wti_usd_bbl")),
            "diesel_usd_gal": F.when(late, F.col("wti_usd_bbl")).otherwise(F.col("diesel_usd_gal")),
        }
    )
    return quality.changed(moved, old)


def export_status_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Status document exported, read back, one row per regime segment."""
    document, _ = materialize(status.status_document(series(spark, folder)), "document")
    path = new_path(spark, "export")
    exports.export_document(document, path)
    back = spark.read.schema(document.schema).json(path)
    return comparable(
        back.select(
            "as_of_date",
            F.col("kpis.current_price_usd_gal").alias("price"),
            F.col("headline_vars.context_clause_key").alias("clause"),
            F.element_at("sparkline_12w", 1).alias("first_point"),
            F.element_at("sparkline_12w", -1).alias("last_point"),
            F.col("historical_analogue.week").alias("week"),
            F.explode("regime_history").alias("_segment"),
        ).select("*", "_segment.start", "_segment.end", "_segment.regime").drop("_segment")
    )


def quality_checks(spark: SparkSession, folder: str) -> DataFrame:
    gold, _ = materialize(timeline.timeline_table(series(spark, folder)), "gold")
    path = new_path(spark, "export")
    exports.export_array(gold, "date", path)
    back = exports.read_array(spark, path, gold.schema).drop("_corrupt_record")
    moved = gold.withColumn("diesel_usd_gal", F.col("diesel_usd_gal") + 1)
    # The first two days trade their prices: every column keeps its set of values.
    days = [r["date"] for r in gold.orderBy("date").limit(2).collect()]
    first = F.col("date") == F.lit(days[0])
    other = gold.filter(F.col("date").isin(days)).select(
        F.when(first, F.lit(days[-1])).otherwise(F.lit(days[0])).alias("date"),
        F.col("wti_usd_bbl").alias("_other"),
    )
    swapped = (
        gold.join(other, "date", "left")
        .withColumn("wti_usd_bbl", F.coalesce("_other", "wti_usd_bbl"))
        .select(gold.columns)
    )

    def named(check: DataFrame, name: str) -> DataFrame:
        return check.withColumn("check", F.lit(name))

    parts = [
        named(quality.freshness(gold, "date", "2001-08-08"), "fresh"),
        named(quality.freshness(gold, "date", "2002-01-01"), "fresh_in_2002"),
        named(quality.readable(spark, path, gold.schema), "output"),
        named(quality.changed(back, gold), "changed_by_export"),
        named(quality.changed(moved, gold), "changed_by_move"),
        named(quality.changed(swapped, gold), "changed_by_two_days"),
    ]
    return reduce(DataFrame.unionByName, parts)


QUERIES: dict[str, Query] = {
    "price_timeline": price_timeline(),
    "price_timeline_by_priority": price_timeline(PRIORITY),
    "price_timeline_by_supplier": price_timeline(SUPPLIER),
    "lag_sweep": on_series(crosscorr.lag_sweep),
    "lag_sweep_by_priority": on_series(crosscorr.lag_sweep, PRIORITY),
    "lag_sweep_by_supplier": on_series(crosscorr.lag_sweep, SUPPLIER),
    "optimal_lag": optimal_lag(),
    "optimal_lag_by_supplier": optimal_lag(SUPPLIER),
    "shock_ranking": on_series(shocks.shock_ranking),
    "shock_ranking_by_priority": on_series(shocks.shock_ranking, PRIORITY),
    "shock_ranking_by_supplier": on_series(shocks.shock_ranking, SUPPLIER),
    "rises": on_series(rises),
    "local_peaks": on_series(local_peaks),
    "shock_preview": on_series(lambda s: exports.preview(shocks.shock_ranking(s))),
    "latest_per_key": latest_per_key,
    "cleansed_events": cleansed_events,
    "clean_daily": clean_daily,
    "clean_weekly": clean_weekly,
    "ingest_daily_batch": ingest_daily_batch,
    "ingest_api_pages": ingest_api_pages,
    "select_series": select_series,
    "page_completeness": page_completeness,
    "partition_replace": partition_replace,
    "table_overwrite": table_overwrite,
    "table_summary": table_summary,
    "rolling_volatility": on_series(regime.rolling_volatility),
    "rolling_volatility_by_supplier": on_series(regime.rolling_volatility, SUPPLIER),
    "momentum": on_series(momentum),
    "rolling_percentile_5y": on_series(rolling_percentile),
    "expanding_vol_rank": on_series(expanding_rank),
    "regime_daily": on_series(regime.regime_daily),
    "regime_daily_by_supplier": on_series(regime.regime_daily, SUPPLIER),
    "regime_history": on_series(regime.regime_history),
    "regime_history_by_priority": on_series(regime.regime_history, PRIORITY),
    "regime_history_by_supplier": on_series(regime.regime_history, SUPPLIER),
    "status_kpis": on_series(status.status_kpis),
    "status_kpis_by_priority": on_series(status.status_kpis, PRIORITY),
    "sparkline": on_series(status.sparkline),
    "sparkline_by_supplier": on_series(status.sparkline, SUPPLIER),
    "historical_analogue": on_series(status.historical_analogue),
    "historical_analogue_by_priority": on_series(status.historical_analogue, PRIORITY),
    "status_snapshot": on_series(status.status_snapshot),
    "status_snapshot_by_priority": on_series(status.status_snapshot, PRIORITY),
    "status_snapshot_by_supplier": on_series(status.status_snapshot, SUPPLIER),
    "rejected_series_by_supplier": on_series(status.rejected_series, SUPPLIER),
    "rejected_series_by_part": on_series(
        lambda s: status.rejected_series(s, StatusRules(min_rows=30)), PART
    ),
    "historical_analogue_by_supplier": on_series(
        lambda s: status.historical_analogue(s, StatusRules(analogue_exclusion=100)), SUPPLIER
    ),
    "export_stats": export_stats,
    "export_roundtrip": export_roundtrip,
    "export_lag_roundtrip": export_lag_roundtrip,
    "export_shocks_roundtrip": export_shocks_roundtrip,
    "export_status_roundtrip": export_status_roundtrip,
    "quality_checks": quality_checks,
    "lag_sweep_lead": on_series(lambda s: crosscorr.lag_sweep(s, LagRange(-30, 30))),
    "price_timeline_chunked": price_timeline((), CHUNKED),
    "lag_sweep_chunked": on_series(crosscorr.lag_sweep, (), CHUNKED),
    "shock_ranking_chunked": on_series(shocks.shock_ranking, (), CHUNKED),
    "regime_daily_chunked": on_series(regime.regime_daily, (), CHUNKED),
    "regime_history_chunked": on_series(regime.regime_history, (), CHUNKED),
    "regime_history_by_priority_chunked": on_series(regime.regime_history, PRIORITY, CHUNKED),
    "status_snapshot_chunked": on_series(status.status_snapshot, (), CHUNKED),
    "export_keyed_roundtrip": export_keyed_roundtrip,
    "export_order": export_order,
    "manifest": manifest,
    "changed_null_move": changed_null_move,
    "page_gaps": page_gaps,
    "publish_on_change": publish_on_change,
    "event_keys": event_keys,
    "event_keys_given": event_keys_given,
    "catalog_tables": catalog_tables,
}
