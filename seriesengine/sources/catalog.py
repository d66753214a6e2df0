"""Named tables on a root folder, and their readers and writers."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from seriesengine.sources.files import Files
from seriesengine.sources.schemas import INGESTION_DATE

# Formats whose tables are the files of their folders.
PLAIN_FORMATS = ("parquet", "orc", "csv", "json", "text", "avro")


@dataclass(frozen=True)
class Catalog:
    """Paths of all tables. ``fmt`` may name any installed table format."""

    root: str
    fmt: str = "parquet"

    @classmethod
    def from_environment(cls) -> Catalog:
        return cls(os.environ.get("DATA_ROOT", "/data"))

    @property
    def daily_raw(self) -> str:
        return f"{self.root}/bronze/wti_daily"

    @property
    def weekly_raw(self) -> str:
        return f"{self.root}/bronze/diesel_weekly"

    @property
    def daily_clean(self) -> str:
        return f"{self.root}/silver/wti_daily"

    @property
    def weekly_clean(self) -> str:
        return f"{self.root}/silver/diesel_weekly"

    @property
    def timeline(self) -> str:
        return f"{self.root}/gold/price_timeline"

    @property
    def lag(self) -> str:
        return f"{self.root}/gold/wti_diesel_lag"

    @property
    def shocks(self) -> str:
        return f"{self.root}/gold/fuel_shocks"

    @property
    def exports(self) -> str:
        return f"{self.root}/exports"


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Replace a whole table and return it as stored. ``path`` must not be an
    input of ``df``."""
    df.write.format(fmt).mode("overwrite").save(path)
    return read_table(df.sparkSession, path, fmt)


def replace_partition(
    batch: DataFrame, path: str, partition: str = INGESTION_DATE, fmt: str = "parquet"
) -> dict[str, object]:
    """Replace the one partition a batch belongs to and keep the others.

    Running a batch again leaves the same table. The partition value comes from the
    rows themselves; a batch with none or with several is refused, because it would
    silently keep or replace something else.

    The batch runs once: it is written beside the partitions, in a folder that readers
    of the table skip, and the write observes its rows and its least and greatest
    partition. A refused or failed batch leaves the table as it was. A good one is
    renamed into place, so the partition is absent only between two renames. Returns
    the number of rows and the partition's value. A format that keeps its own log of
    files is given the staged rows to commit instead.
    """
    spark = batch.sparkSession
    files = Files(spark, path)
    stage = f"{path}/_staged-{uuid.uuid4().hex[:12]}"
    plain = fmt in PLAIN_FORMATS
    observed = Observation(f"batch-{uuid.uuid4().hex[:8]}")
    seen = batch.observe(
        observed,
        F.count("*").alias("rows"),
        F.count(partition).alias("placed"),
        F.min(partition).alias("low"),
        F.max(partition).alias("high"),
    )
    try:
        writer = seen.write.format(fmt if plain else "parquet")
        (writer.partitionBy(partition) if plain else writer).save(stage)
        found = observed.get
        rows, low, high = found["rows"], found["low"], found["high"]
        if not rows or found["placed"] != rows or low != high:
            raise ValueError(f"a batch must hold exactly one {partition}, found {low} to {high} in {rows} rows")
        if plain:
            (name,) = files.names(stage, f"{partition}=")
            _swap(files, f"{stage}/{name}", f"{path}/{name}")
        else:
            staged = spark.read.schema(batch.schema).parquet(stage)
            writer = staged.write.format(fmt).mode("overwrite").partitionBy(partition)
            writer.option("partitionOverwriteMode", "dynamic").save(path)
    finally:
        files.delete(stage)
    return {"rows": rows, partition: low}


def _swap(files: Files, source: str, target: str) -> None:
    """Put a folder where another may be; if that fails the other one is put back."""
    if not files.exists(target):
        files.move(source, target)
        return
    folder, _, name = target.rpartition("/")
    aside = f"{folder}/_replaced-{uuid.uuid4().hex[:12]}-{name}"
    files.move(target, aside)
    try:
        files.move(source, target)
    except Exception:
        files.move(aside, target)
        raise
    files.delete(aside)


def table_summary(df: DataFrame, day: str) -> DataFrame:
    """Row count and first and last day, in one aggregation."""
    return df.agg(
        F.count("*").alias("rows"), F.min(day).alias("min_date"), F.max(day).alias("max_date")
    )
