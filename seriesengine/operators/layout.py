"""Row positions, chunks and halos: how one long series is spread over tasks.

A series is one row per date and key. A global ``Window.orderBy`` would put a
whole series into one task; here a series is first numbered through calendar
buckets and then cut into chunks of consecutive positions, each carrying copies
of the neighbouring rows that its window frames reach.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from seriesengine.params import DATE, WHOLE_SERIES, Layout
from seriesengine.scratch import materialize

BUCKET = "_bucket"
CHUNK = "_chunk"
IN_GROUP = "_in_group"
LOCAL = "_local"
OWNED = "_owned"
POS = "pos"
REPEATED = "_repeated"
ROWS = "n_rows"


@dataclass(frozen=True)
class Series:
    """Numbered series on storage.

    ``frame`` holds the key columns, ``date``, the 0-based ``pos``, the length
    ``n_rows`` of the row's series, and the values. ``max_rows`` is the length of
    the longest series, known from the write.
    """

    frame: DataFrame
    keys: tuple[str, ...]
    max_rows: int
    layout: Layout

    @property
    def one_chunk(self) -> bool:
        """Every series fits one chunk, so nothing has to cross chunk edges."""
        return self.max_rows <= self.layout.chunk_rows

    @property
    def keyed(self) -> bool:
        return self.keys != (WHOLE_SERIES,)


def public(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop the physical key of a series that has none of its own."""
    return df.drop(WHOLE_SERIES) if tuple(keys) == (WHOLE_SERIES,) else df


def with_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, tuple[str, ...]]:
    """Give a keyless frame a constant physical key.

    It keeps every later join an equi-join. Once materialized it is a stored
    column that the optimizer does not fold away.
    """
    if keys:
        return df, tuple(keys)
    return df.withColumn(WHOLE_SERIES, F.lit(0)), (WHOLE_SERIES,)


def calendar_bucket(day: Column, layout: Layout) -> Column:
    return F.floor(F.unix_date(day) / F.lit(layout.bucket_days)).cast("int")


def running_before(spec: WindowSpec) -> WindowSpec:
    return spec.rowsBetween(Window.unboundedPreceding, -1)


def running_to(spec: WindowSpec) -> WindowSpec:
    return spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def numbered_in_group(keys: Sequence[str], group: str, counted: str, *order: str) -> dict[str, Column]:
    """Columns that number the non-null ``counted`` rows inside (series, group), and tell
    which rows have the same ``order`` as the row before them."""
    whole = Window.partitionBy(*keys, group)
    ordered = whole.orderBy(*order)
    same = [F.lag(c).over(ordered) == F.col(c) for c in order]
    return {
        LOCAL: F.count(counted).over(running_to(ordered)),
        IN_GROUP: F.count(counted).over(whole),
        REPEATED: F.coalesce(reduce(Column.__and__, same), F.lit(False)),
    }


def store_numbered(
    rows: DataFrame,
    keys: tuple[str, ...],
    group: str,
    layout: Layout,
    name: str,
    carry: Mapping[str, str] | None = None,
) -> Series:
    """Write rows that are numbered within (series, group) and number the series.

    ``rows`` has the columns of ``numbered_in_group``. For each ``carry`` column
    the result has, under the mapped name, its last non-null value in earlier
    groups of the series.

    The write tells whether all rows lie in one group, as those of common daily
    series do; then their numbers are final. Otherwise a small table with one
    row per (series, group) gives how many rows came earlier, and the rows are
    written again with it, so that no later reader repeats the join.

    A series has one row per date. The write also observes rows that repeat one, and
    any is an error: positions, chunks and the size of a task all count on it.
    """
    carry = carry or {}
    stored, seen = materialize(
        rows,
        name,
        first=F.min(group),
        last=F.max(group),
        longest=F.max(IN_GROUP),
        repeated=F.count_if(REPEATED),
    )
    if seen.get("repeated"):
        raise ValueError(f"a series has one row per date; {seen['repeated']} rows of {name} repeat one")
    stored = stored.drop(REPEATED)
    if seen.get("first") == seen.get("last"):
        frame = stored.withColumns(
            {POS: F.col(LOCAL) - 1, ROWS: F.col(IN_GROUP)}
            | {to: F.lit(None).cast(stored.schema[c].dataType) for c, to in carry.items()}
        )
        longest = seen.get("longest")
    else:
        in_series = Window.partitionBy(*keys)
        earlier = running_before(in_series.orderBy(group))
        last_values = [
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col(DATE))).alias(c) for c in carry
        ]
        per_group = stored.groupBy(*keys, group).agg(
            F.max(IN_GROUP).alias(IN_GROUP), *last_values
        )
        totals = per_group.select(
            *keys,
            group,
            F.coalesce(F.sum(IN_GROUP).over(earlier), F.lit(0)).alias("_offset"),
            F.sum(IN_GROUP).over(in_series).alias(ROWS),
            *[F.last(c, ignorenulls=True).over(earlier).alias(to) for c, to in carry.items()],
        )
        numbered = stored.drop(IN_GROUP).join(totals, [*keys, group])
        numbered = numbered.withColumn(POS, F.col("_offset") + F.col(LOCAL) - 1).drop("_offset")
        frame, seen = materialize(numbered, f"{name}-numbered", longest=F.max(ROWS))
        longest = seen.get("longest")
    return Series(frame.drop(LOCAL, IN_GROUP, group), keys, int(longest or 0), layout)


def index_series(df: DataFrame, keys: Sequence[str] = (), layout: Layout | None = None) -> Series:
    """Number the rows of a table that has one row per key and date.

    Rows without a date are dropped. The numbering groups by (series, calendar
    bucket), which no hot series can fill.
    """
    layout = layout or Layout()
    keyed, names = with_keys(df, keys)
    rows = keyed.filter(F.col(DATE).isNotNull()).withColumn(
        BUCKET, calendar_bucket(F.col(DATE), layout)
    )
    rows = rows.withColumns(numbered_in_group(names, BUCKET, DATE, DATE))
    return store_numbered(rows, names, BUCKET, layout, "series")


def chunk_of(position: Column, layout: Layout) -> Column:
    return F.floor(position / F.lit(layout.chunk_rows)).cast("int")


def with_halo(series: Series, before: int, after: int = 0) -> DataFrame:
    """Assign rows to chunks and copy the rows that other chunks' frames reach.

    A row at position p lies in the frames of rows p - after .. p + before, so it
    goes to every chunk that owns one of those. Windows over ``chunk_window`` are
    then right on the rows with ``_owned``; the others are only there to be seen.
    """
    layout = series.layout
    if series.one_chunk:
        return series.frame.withColumns({CHUNK: F.lit(0), OWNED: F.lit(True)})
    pos = F.col(POS)
    first = chunk_of(F.greatest(pos - after, F.lit(0)), layout)
    last = chunk_of(F.least(pos + before, F.col(ROWS) - 1), layout)
    return series.frame.withColumn(CHUNK, F.explode(F.sequence(first, last))).withColumn(
        OWNED, F.col(CHUNK) == chunk_of(pos, layout)
    )


def chunk_window(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys, CHUNK).orderBy(POS)


def spread_to_chunks(per_key: DataFrame, layout: Layout) -> DataFrame:
    """Repeat one row per series for each of its chunks.

    Joining it on (series, chunk) spreads a hot series over many tasks, which a
    join on the series alone would not.
    """
    chunks = F.sequence(F.lit(0), chunk_of(F.col(ROWS) - 1, layout))
    return per_key.withColumn(CHUNK, F.explode(chunks))


def with_chunk(series: Series) -> DataFrame:
    return series.frame.withColumn(CHUNK, chunk_of(F.col(POS), series.layout))
