"""Checks on outputs: freshness, readability and change. One row per check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesengine.sinks.exports import content_hash, path_bytes, path_exists, read_array

FRESH_DAYS = 7

# An array of one empty object.
MIN_BYTES = 4


def freshness(df: DataFrame, day: str, as_of: str, max_age: int = FRESH_DAYS) -> DataFrame:
    """The newest day is at most ``max_age`` days before ``as_of``."""
    age = F.datediff(F.lit(as_of).cast("date"), F.max(day).cast("date"))
    return df.agg(
        F.lit("freshness").alias("check"), F.coalesce(age <= max_age, F.lit(False)).alias("passed")
    )


def readable(
    spark: SparkSession, path: str, schema: T.StructType, least_bytes: int = MIN_BYTES
) -> DataFrame:
    """The export at ``path`` is there, is not too small, is closed, and its rows parse."""
    name = F.lit("output").alias("check")
    if not path_exists(spark, path) or path_bytes(spark, path) < least_bytes:
        return spark.range(1).select(name, F.lit(False).alias("passed"))
    lines = spark.read.text(path)
    rows = read_array(spark, path, schema)
    shape = lines.agg(
        F.count_if(F.col("value").startswith("[")).alias("opened"),
        F.count_if(F.col("value").endswith("}]")).alias("closed"),
        F.lit(0).alias("corrupt"),
    )
    content = rows.agg(
        F.lit(0).alias("opened"),
        F.lit(0).alias("closed"),
        F.count("_corrupt_record").alias("corrupt"),
    )
    sound = (F.sum("opened") == 1) & (F.sum("closed") == 1) & (F.sum("corrupt") == 0)
    return shape.unionByName(content).agg(name, sound.alias("passed"))


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and order-free content hash."""
    return df.agg(F.count("*").alias("rows"), content_hash(df).alias("content"))


def changed(new: DataFrame, old: DataFrame) -> DataFrame:
    """Whether the content differs; passed means there is something to publish."""
    both = fingerprint(new).unionByName(fingerprint(old))
    return both.agg(
        F.lit("changed").alias("check"),
        ((F.min("rows") != F.max("rows")) | (F.min("content") != F.max("content"))).alias("passed"),
    )
