"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesengine.scratch import materialize

# Fixed value: a word is a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold_of(doc_id: Column) -> Column:
    """Fold of a document, 0 to 4; -1 for a null id, which is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(-1)).cast("int")


def text_of(column: Column) -> Column:
    """A text, where null counts as empty."""
    return F.coalesce(column.cast("string"), F.lit(""))


# Bits of Spark's growing row ids that count the rows of one task.
_ROW_BITS = 33


def in_order(
    df: DataFrame, keys: list[Column], name: str, place: str, **metrics: Column
) -> tuple[DataFrame, dict[str, object]]:
    """The rows with ``place``, their number from 0 in the order of ``keys``, and ``metrics``.

    Rows are dealt to tasks by ranges of the keys and sorted there; the written table
    fixes what each task got, and one number per task turns places in a task into places
    in the whole. Rows that tie in all keys come in any order.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    laid, seen = materialize(
        ranged.withColumn(place, F.monotonically_increasing_id()), name, **metrics
    )
    task = F.shiftright(place, _ROW_BITS)
    held = laid.groupBy(task.alias("task")).agg(F.count("*").alias("held")).collect()
    rows, before = [], 0
    for task_id, size in sorted(tuple(r) for r in held):
        rows.append((task_id, before))
        before += size
    # One row per task that wrote.
    offsets = F.broadcast(spark.createDataFrame(rows, "task_of long, before long"))
    at = F.col(place).bitwiseAND((1 << _ROW_BITS) - 1) + F.col("before")
    return (
        laid.join(offsets, task == F.col("task_of"))
        .withColumn(place, at)
        .drop("task_of", "before")
    ), seen
