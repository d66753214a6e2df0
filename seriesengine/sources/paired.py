"""Paired fast and slow series derived from order tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesengine.params import (
    DATE,
    FAST_PRICE,
    FAST_SIDE,
    PRICE,
    SIDE,
    SLOW_PERIOD,
    SLOW_PRICE,
    SLOW_SIDE,
)


# Declared, so that opening a table runs no job to read its footer.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def cents(price: Column) -> Column:
    """Price in whole cents. Integer sums do not depend on the order of rows, so
    equal inputs give bit-equal means."""
    return F.rint(price * 100).cast("bigint")


def _mean(price: Column) -> Column:
    return F.sum(cents(price)) / F.count(price) / 100


def _week(moment: Column) -> Column:
    day = F.to_date(moment)
    return F.date_sub(day, F.weekday(day))


def whole(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Mean order total per day; mean line price per ship week."""
    fast = (
        table(spark, folder, "orders")
        .groupBy(F.to_date("o_orderdate").alias(DATE))
        .agg(_mean(F.col("o_totalprice")).alias(FAST_PRICE))
    )
    slow = (
        table(spark, folder, "lineitem")
        .groupBy(_week(F.col("l_shipdate")).alias(SLOW_PERIOD))
        .agg(_mean(F.col("l_extendedprice")).alias(SLOW_PRICE))
    )
    return fast, slow


def by_priority(spark: SparkSession, folder: str) -> DataFrame:
    """Both sides, per order priority, in one frame.

    Either table is read once. Line prices are summed per order and week first; orders
    and those sums then meet in one shuffle by order, where the one row of an order, by
    its primary key, hands its priority to its lines. Lines without an order are dropped.
    """
    key = "o_orderpriority"
    price, line = F.col("o_totalprice"), F.col("l_extendedprice")
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        key,
        F.to_date("o_orderdate").alias(DATE),
        F.lit(FAST_SIDE).alias(SIDE),
        cents(price).alias("_cents"),
        price.isNotNull().cast("bigint").alias("_prices"),
    )
    lines = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"), _week(F.col("l_shipdate")).alias(DATE))
        .agg(F.sum(cents(line)).alias("_cents"), F.count(line).alias("_prices"))
        .select("o_orderkey", F.lit(None).cast("string").alias(key), DATE, F.lit(SLOW_SIDE).alias(SIDE), "_cents", "_prices")
    )
    of_order = Window.partitionBy("o_orderkey")
    ordered = F.max(SIDE).over(of_order) == FAST_SIDE
    return (
        orders.unionByName(lines)
        .select(DATE, SIDE, "_cents", "_prices", F.max(key).over(of_order).alias(key), ordered.alias("_ordered"))
        .filter("_ordered")
        .groupBy(key, DATE, SIDE)
        .agg((F.sum("_cents") / F.sum("_prices") / 100).alias(PRICE))
    )


def _by_line_key(spark: SparkSession, folder: str, key: str) -> DataFrame:
    """Both sides in one frame, per key of the lines: mean line price per ship day, and unit
    price per ship week. The lines are read and shuffled once, for both groupings."""
    price = F.col("l_extendedprice")
    lines = table(spark, folder, "lineitem").select(
        key,
        F.to_date("l_shipdate").alias("_day"),
        _week(F.col("l_shipdate")).alias("_of_week"),
        cents(price).alias("_cents"),
        price.isNotNull().cast("bigint").alias("_prices"),
        F.col("l_quantity").cast("bigint").alias("_units"),
    )
    sums = lines.groupingSets(
        [[key, "_day"], [key, "_of_week"]], key, "_day", "_of_week"
    ).agg(
        F.grouping("_day").alias("_weekly"),
        F.sum("_cents").alias("_cents"),
        F.sum("_prices").alias("_prices"),
        F.sum("_units").alias("_units"),
    )
    weekly = F.col("_weekly") == 1
    return sums.select(
        key,
        F.when(weekly, F.col("_of_week")).otherwise(F.col("_day")).alias(DATE),
        F.when(weekly, F.lit(SLOW_SIDE)).otherwise(F.lit(FAST_SIDE)).alias(SIDE),
        (F.col("_cents") / F.when(weekly, F.col("_units")).otherwise(F.col("_prices")) / 100).alias(PRICE),
    )


def by_supplier(spark: SparkSession, folder: str) -> DataFrame:
    """Both sides per supplier. The number of series grows with the data."""
    return _by_line_key(spark, folder, "l_suppkey")


def by_part(spark: SparkSession, folder: str) -> DataFrame:
    """Both sides per part: very many short series."""
    return _by_line_key(spark, folder, "l_partkey")
