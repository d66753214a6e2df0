"""JSON exports of the gold tables and the manifest that describes them."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesengine.functions.numeric import round_even
from seriesengine.operators.shocks import CHANGE
from seriesengine.scratch import materialize
from seriesengine.sources.files import Files


def _json_value(value: Column, kind: T.DataType) -> Column:
    """A value as JSON can hold it: NaN and infinities, at any depth, are null."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)
    if isinstance(kind, T.StructType):
        fields = [_json_value(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _json_value(x, kind.elementType))
    return value


def json_text(df: DataFrame) -> Column:
    """A row as minified JSON. Nulls are kept; numbers that JSON lacks are null."""
    fields = [_json_value(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def array_lines(df: DataFrame, order: Sequence[str], first: Row, last: Row) -> DataFrame:
    """Rows as lines that, read in order, form one JSON array.

    The ``order`` columns are unique with known ends, so each row can tell its
    bracket or comma by itself and nothing is gathered.
    """

    def at(end: Row) -> Column:
        return reduce(Column.__and__, [F.col(c) == F.lit(end[c]) for c in order])

    opening = F.when(at(first), "[").otherwise(",")
    closing = F.when(at(last), "]").otherwise("")
    return df.select(*order, F.concat(opening, json_text(df), closing).alias("value"))


def publish_text(lines: DataFrame, path: str) -> None:
    """Write the ``value`` column of one partition as the plain file ``path``.

    The file is written beside its place and renamed over what is there.
    """
    files = Files(lines.sparkSession, path)
    folder = f"{path}.tmp-{uuid.uuid4().hex[:12]}"
    lines.select("value").coalesce(1).write.text(folder)
    (part,) = files.names(folder, "part-")
    if files.is_folder(path):
        files.delete(path)
    files.move_over(f"{folder}/{part}", path)
    files.delete(folder)


def path_exists(spark: SparkSession, path: str) -> bool:
    return Files(spark, path).exists(path)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or of all files of a folder."""
    return Files(spark, path).bytes(path)


class Staged:
    """Rows of an export on scratch, with what their one run observed.

    ``df`` runs once: the write of its rows observes their number, their content, the ends
    of the order, the places without nulls and ``metrics``, aggregates of ``df``.
    """

    def __init__(self, df: DataFrame, order: Sequence[str], metrics: dict[str, Column]) -> None:
        place = F.struct(*order) if order else F.lit(None)
        complete = reduce(Column.__and__, [F.col(c).isNotNull() for c in order], F.lit(True))
        self.order = list(order)
        self.rows, seen = materialize(
            df,
            "export-rows",
            **metrics,
            _rows=F.count("*"),
            _content=content_hash(df),
            _placed=F.count_if(complete),
            _first=F.min(place),
            _last=F.max(place),
        )
        self.count = seen.get("_rows") or 0
        self.content = str(seen.get("_content") or 0)
        self.placed = seen.get("_placed") or 0
        self.first, self.last = seen.get("_first"), seen.get("_last")
        self.metrics = {name: seen.get(name) for name in metrics}

    def write(self, path: str, parts: bool = False) -> dict[str, object]:
        """Write the rows as a JSON array; refuses nulls and repeats in the order."""
        if not self.count:
            empty = self.rows.sparkSession.range(1).select(F.lit("[]").alias("value"))
            publish_text(empty, path)
            return {"rows": 0, "first": None, "last": None, **self.metrics}
        repeats = self.rows.groupBy(*self.order).count().filter("count > 1").limit(1).count()
        if self.placed != self.count or repeats:
            raise ValueError(f"the order {self.order} has nulls or repeats in {self.count} rows")
        lines = array_lines(self.rows, self.order, self.first, self.last)
        if parts:
            lines.orderBy(*self.order).select("value").write.mode("overwrite").text(path)
        else:
            publish_text(lines.repartition(1).sortWithinPartitions(*self.order), path)
        first, last = (tuple(e) if len(self.order) > 1 else e[0] for e in (self.first, self.last))
        return {"rows": self.count, "first": first, "last": last, **self.metrics}

    def write_document(self, path: str) -> dict[str, object]:
        """Write the one row as a JSON document; refuses any other number of rows."""
        if self.count != 1:
            raise ValueError(f"a document is one row, found {self.count}")
        publish_text(self.rows.select(json_text(self.rows).alias("value")), path)
        return self.metrics


def export_array(
    df: DataFrame,
    order: str | Sequence[str],
    path: str,
    parts: bool = False,
    **metrics: Column,
) -> dict[str, object]:
    """Export rows as a JSON array ordered by columns that are unique together.

    The caller chooses the shape: one file, which one task writes, or with ``parts`` a
    folder whose part files, in name order, hold the same array, so that no task sees
    all rows. Nulls and repeats in the order are refused. Returns the row count, both
    ends (with several columns an end is a tuple), and ``metrics``, aggregates of ``df``.
    ``df`` runs once; what follows reads its staged rows, for repeats only their order.
    """
    order = [order] if isinstance(order, str) else list(order)
    return Staged(df, order, metrics).write(path, parts)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line, value``: the lines of exported files with their places, from 0, in all of them.

    A line's place is its file's offset, its block's offset in the file and its own
    number in the block. Blocks are read by many tasks; only their numbers of lines
    meet, one row per block.
    """
    meta = F.col("_metadata")
    lines, _ = materialize(
        spark.read.text(path).select(
            "value",
            meta["file_path"].alias("file"),
            meta["file_block_start"].alias("block"),
            F.monotonically_increasing_id().alias("id"),
        ),
        "lines",
    )
    held = lines.groupBy("file", "block").agg(F.min("id").alias("first"), F.count("*").alias("size"))
    offsets, before = [], 0
    for file, block, first, size in sorted(tuple(r) for r in held.collect()):
        offsets.append((file, block, before - first))
        before += size
    blocks = spark.createDataFrame(offsets, "file string, block long, shift long")
    return lines.join(F.broadcast(blocks), ["file", "block"]).select(
        (F.col("id") + F.col("shift")).alias("line"), "value"
    )


def export_document(df: DataFrame, path: str, **metrics: Column) -> dict[str, object]:
    """Export a one-row frame as a single JSON document; others are refused. Returns
    ``metrics``, aggregates of the frame, which runs once."""
    return Staged(df, (), metrics).write_document(path)


def read_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read an exported array back, either shape, line by line.

    A line that is no record of the schema gives a row with only
    ``_corrupt_record`` set.
    """
    corrupt = "_corrupt_record"
    full = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    body = F.regexp_replace("value", r"^[\[,]|\]$", "")
    parsed = F.from_json(body, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    return spark.read.text(path).filter(F.col("value") != "[]").select(parsed.alias("r")).select("r.*")


def content_hash(df: DataFrame) -> Column:
    """Order-free hash of all rows, an aggregate.

    The hash of a row skips nulls, so which columns are null is hashed beside the values.
    """
    nulls = [F.isnull(c) for c in df.columns]
    content = F.sum(F.xxhash64(*df.columns, *nulls).cast("decimal(20,0)"))
    return F.coalesce(content, F.lit(0)).cast("string")


# Statistics of an export are aggregates that its one run observes.


def timeline_metrics(day: str) -> dict[str, Column]:
    return {"min_date": F.min(day).cast("string"), "max_date": F.max(day).cast("string")}


def lag_metrics() -> dict[str, Column]:
    best = F.min(F.when(F.col("is_optimal"), F.struct("lag_days", "correlation")))
    return {
        "optimal_lag_days": best["lag_days"],
        "optimal_correlation": round_even(best["correlation"], 4),
    }


def shock_metrics() -> dict[str, Column]:
    top = F.col("rank") == 1
    return {
        "top_event_pct_change": round_even(F.max(F.when(top, F.col(CHANGE))), 2),
        "top_event_date": F.max(F.when(top, F.col("peak_date"))).cast("string"),
    }


def document_metrics() -> dict[str, Column]:
    return {
        "as_of_date": F.max("as_of_date"),
        "regime": F.max("regime"),
        "regime_segments": F.max(F.size("regime_history")),
    }


def statistics(exported: dict[str, object]) -> dict[str, object]:
    """What a manifest says about an exported table: its rows and metrics, not its ends."""
    return {name: value for name, value in exported.items() if name not in ("first", "last")}


def manifest(
    tables: dict[str, dict[str, object]], data_through: str, moment: datetime | None = None
) -> dict[str, object]:
    """Content of the manifest; ``moment`` defaults to now and is UTC if it names no zone."""
    moment = moment or datetime.now(timezone.utc)
    moment = moment.replace(tzinfo=moment.tzinfo or timezone.utc).astimezone(timezone.utc)
    return {
        "generated_at": moment.strftime("%Y-%m-%dT%H:%M:%SZ"),
        "data_through": data_through,
        "tables": tables,
    }


def write_manifest(
    spark: SparkSession,
    tables: dict[str, dict[str, object]],
    data_through: str,
    folder: str,
    moment: datetime | None = None,
) -> str:
    path = f"{folder}/manifest.json"
    text = json.dumps(manifest(tables, data_through, moment), indent=2)
    publish_text(spark.range(1).select(F.lit(text).alias("value")), path)
    return path


def read_manifest(spark: SparkSession, folder: str) -> dict[str, object]:
    """The manifest of a folder, empty if there is none. It is one small file."""
    path = f"{folder}/manifest.json"
    if not path_exists(spark, path):
        return {}
    return json.loads("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))


@dataclass(frozen=True)
class Output:
    """A frame to publish: an array in the order of columns that are unique together, or
    without an order a document, one row; and aggregates that its manifest entry states."""

    df: DataFrame
    order: Sequence[str] | None = None
    metrics: Mapping[str, Column] = field(default_factory=dict)


def publish(
    spark: SparkSession,
    outputs: Mapping[str, Output],
    folder: str,
    data_through: Callable[[dict[str, dict[str, object]]], str],
    moment: datetime | None = None,
    parts: bool = False,
) -> dict[str, bool]:
    """Export the outputs whose content is not the published one; which were exported.

    An output goes to ``<name>.json``. The manifest keeps each output's content hash beside
    its row count and metrics, so what was published is not read again: an output runs
    once, its hash comes from that run, and an equal one that is still there is left
    alone. The manifest is written last, and only if something was exported or left the
    list: a run that breaks off exports again. ``data_through`` is told the entries.
    """
    before = read_manifest(spark, folder).get("tables", {})
    done, entries = {}, {}
    for name, output in outputs.items():
        path = f"{folder}/{name}.json"
        staged = Staged(output.df, output.order or (), dict(output.metrics))
        rows = {"rows": staged.count} if output.order else {}
        entries[name] = {**rows, **staged.metrics, "content": staged.content}
        published = before.get(name, {}).get("content") == staged.content
        done[name] = not published or not path_exists(spark, path)
        if done[name] and output.order:
            staged.write(path, parts)
        elif done[name]:
            staged.write_document(path)
    if any(done.values()) or before != entries:
        write_manifest(spark, entries, data_through(entries), folder, moment)
    return done


def preview(shocks: DataFrame, keys: Sequence[str] = (), rows: int = 5) -> DataFrame:
    """First entries of a ranking."""
    return shocks.filter(F.col("rank") <= rows).orderBy(*keys, "rank")
