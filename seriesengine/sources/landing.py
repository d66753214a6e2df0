"""Landed batches to raw tables: reading, flattening, renaming, stamping."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesengine.sources.schemas import (
    API_PAGE,
    DAILY_LANDED,
    DAILY_RAW,
    DAILY_RENAMES,
    INGESTION_DATE,
    INGESTION_TIMESTAMP,
    WEEKLY_AREA,
    WEEKLY_PRODUCT,
    WEEKLY_RAW,
    WEEKLY_RENAMES,
)


def utc_text(moment: datetime) -> str:
    """UTC wall-clock text; a moment without a zone is taken as UTC."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc)
    return moment.strftime("%Y-%m-%d %H:%M:%S.%f")


def day_of(value: Column, data_type: T.DataType) -> Column:
    """Calendar day a source wrote.

    Text keeps the day it shows, whatever offset follows it.
    """
    if isinstance(data_type, T.StringType):
        return F.to_date(F.substring(value, 1, 10), "yyyy-MM-dd")
    return F.to_date(value)


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, in order and typed.

    Other columns are dropped. A missing one raises.
    """
    return df.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def stamp(df: DataFrame, moment: datetime) -> DataFrame:
    """Add the audit columns, one instant for the whole batch."""
    text = utc_text(moment)
    return df.withColumns(
        {
            INGESTION_TIMESTAMP: F.to_timestamp(F.lit(f"{text}+00:00")),
            INGESTION_DATE: F.lit(text[:10]).cast("date"),
        }
    )


def read_daily_landing(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Read a landed daily batch with its declared header."""
    reader = spark.read.format(fmt)
    if fmt == "parquet":
        return reader.load(path)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    return reader.option("mode", "FAILFAST").schema(DAILY_LANDED).load(path)


def daily_batch(landed: DataFrame, moment: datetime) -> DataFrame:
    """Landed daily prices to rows of the raw daily table."""
    renamed = landed.withColumnsRenamed(DAILY_RENAMES)
    dated = renamed.withColumn("date", day_of(F.col("date"), renamed.schema["date"].dataType))
    return align_to_schema(stamp(dated, moment), DAILY_RAW)


def read_api_pages(spark: SparkSession, path: str, page_per_line: bool = False) -> DataFrame:
    """Read landed API pages: one JSON document per file, or one per line."""
    reader = spark.read.schema(API_PAGE).option("mode", "FAILFAST")
    return reader.option("multiLine", not page_per_line).json(path)


def flatten_pages(pages: DataFrame) -> DataFrame:
    """One row per record of all pages, fields as the source names them."""
    return pages.select(F.explode("response.data").alias("_record")).select("_record.*")


def page_completeness(pages: DataFrame) -> DataFrame:
    """Whether the pages hold every record of the total they report, once.

    A page covers the places from its offset on. Pages cover the total without gap or
    overlap if no two begin or end at one place, and the only place where a page begins
    and none ends is 0, and the only one where a page ends and none begins is the total.
    So places are counted, in one grouping, and pages are never compared. Pages that do
    not give their offset are complete if they sum up to the total and no two are equal.

    One row: ``pages`` that hold records, ``records``, ``total``, ``repeated`` (places at
    which several pages begin or end, or pages equal to another), ``breaks`` (places where
    coverage is broken), ``complete``.
    """
    sized = pages.select(
        F.col("request.params.offset").cast("bigint").alias("start"),
        F.coalesce(F.size("response.data"), F.lit(0)).cast("bigint").alias("size"),
        F.col("response.total").cast("bigint").alias("total"),
        F.xxhash64("response.data").alias("content"),
    )
    held = F.col("size") > 0
    summed = sized.agg(
        F.count_if(held).alias("pages"),
        F.sum("size").alias("records"),
        F.max("total").alias("total"),
        F.min("total").alias("_least_total"),
        F.count_if(held & F.col("start").isNull()).alias("_unplaced"),
        (F.count_if(held) - F.count_distinct(F.when(held, F.col("content")))).alias("_equal"),
    )
    ends = F.array(
        F.struct(F.col("start").alias("at"), F.lit(1).alias("begin"), F.lit(0).alias("end")),
        F.struct((F.col("start") + F.col("size")).alias("at"), F.lit(0).alias("begin"), F.lit(1).alias("end")),
    )
    places = (
        sized.filter(held & F.col("start").isNotNull())
        .select(F.inline(ends))
        .groupBy("at")
        .agg(F.sum("begin").alias("begin"), F.sum("end").alias("end"))
    )
    begins, ends_only = F.col("begin") > F.col("end"), F.col("begin") < F.col("end")
    covered = places.agg(
        F.count_if((F.col("begin") > 1) | (F.col("end") > 1)).alias("_repeated"),
        F.count_if(begins).alias("_heads"),
        F.count_if(ends_only).alias("_tails"),
        F.min(F.when(begins, F.col("at"))).alias("_first"),
        F.max(F.when(ends_only, F.col("at"))).alias("_last"),
    )
    both = summed.unionByName(covered, allowMissingColumns=True)
    one = both.agg(*[F.max(c).alias(c) for c in both.columns])
    placed = F.col("_unplaced") == 0
    off = (F.col("_first") != 0).cast("int") + (F.col("_last") != F.col("total")).cast("int")
    breaks = F.when(F.col("pages") == 0, F.lit(0)).otherwise(
        F.col("_heads") + F.col("_tails") - 2 + F.coalesce(off, F.lit(0))
    )
    same_total = F.col("total") == F.col("_least_total")
    repeated = F.when(placed, F.col("_repeated")).otherwise(F.col("_equal"))
    return one.select(
        "pages",
        "records",
        "total",
        repeated.alias("repeated"),
        F.when(placed, breaks).alias("breaks"),
        F.coalesce(
            same_total
            & (F.col("records") == F.col("total"))
            & (repeated == 0)
            & F.when(placed, breaks == 0).otherwise(F.lit(True)),
            F.lit(False),
        ).alias("complete"),
    )


def select_series(
    records: DataFrame, product: str | None = WEEKLY_PRODUCT, area: str | None = WEEKLY_AREA
) -> DataFrame:
    """Keep one product and area; None keeps all."""
    if product is not None:
        records = records.filter(F.col("product") == product)
    if area is not None:
        records = records.filter(F.col("duoarea") == area)
    return records


def weekly_batch(
    pages: DataFrame,
    moment: datetime,
    product: str | None = WEEKLY_PRODUCT,
    area: str | None = WEEKLY_AREA,
    renames: Mapping[str, str] = WEEKLY_RENAMES,
) -> DataFrame:
    """API pages to rows of the raw weekly table.

    A value that is no number raises in ANSI mode, as a failed batch should.
    """
    records = select_series(flatten_pages(pages), product, area).withColumnsRenamed(dict(renames))
    dated = records.withColumn("period", day_of(F.col("period"), T.StringType()))
    return align_to_schema(stamp(dated, moment), WEEKLY_RAW)
