"""Percent ranks over moving and growing frames.

Spark's ``percent_rank`` ignores frames, so both ranks count the strictly smaller
rows themselves. Inside chunks that is one order statistic over position ranges, for
many chunks at a time; across chunks it is a tree of window sums over (chunk, value)
counts.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesengine.operators.layout import (
    CHUNK,
    OWNED,
    POS,
    ROWS,
    Layout,
    chunk_of,
    running_before,
    spread_to_chunks,
)

BELOW_ROLLING = "_below_rolling"
BELOW_EARLIER = "_below_earlier"
SEEN = "_seen"

# Rows that are ranked together at least, unless a task has fewer: some chunks more or
# less, since a chunk is never cut.
_PIECE = 16_384

# Ship the kernel itself, so that executors need numpy and pyarrow but not this
# package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def count_smaller(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each row i, the rows from ``starts[i]`` to i that are strictly smaller.

    NaN is neither smaller nor larger; a start beyond i is an empty range. The values
    are replaced by their ranks, and the ranks are dealt bit by bit, from the highest,
    into zeros before ones with their order kept. At each bit a range of positions
    becomes the range of those of its members that share the rank's bits so far; where
    the rank has a one, the members with a zero are smaller and are counted. So a row
    costs one step per bit of the number of distinct values, however wide its range.
    """
    n = len(values)
    count = np.zeros(n, np.int32)
    if n == 0:
        return count.astype(np.int64)
    distinct, rank = np.unique(values, return_inverse=True)
    rank = rank.astype(np.int32)
    # The range of the row that asks, and its rank; its own value is never smaller.
    right = np.arange(1, n + 1, dtype=np.int32)
    left = np.minimum(starts.astype(np.int32), right)
    dealt = rank
    for bit in reversed(range(int(len(distinct) - 1).bit_length())):
        one = (dealt >> bit) & 1
        zeros = np.zeros(n + 1, np.int32)
        np.cumsum(1 - one, out=zeros[1:])
        low, high = zeros[left], zeros[right]
        asks_one = ((rank >> bit) & 1).astype(bool)
        count += np.where(asks_one, high - low, 0)
        ahead = zeros[n]
        left = np.where(asks_one, ahead + left - low, low)
        right = np.where(asks_one, ahead + right - high, high)
        one = one.astype(bool)
        dealt = np.concatenate([dealt[~one], dealt[one]])
    count[np.isnan(values)] = 0
    return count.astype(np.int64)


def _edges(table: pa.Table, names: Sequence[str]) -> np.ndarray:
    """Rows at which one of the columns differs from the row before; the first is one."""
    n = table.num_rows
    differs = np.zeros(n, bool)
    differs[:1] = True
    for name in names:
        column = table.column(name).combine_chunks()
        above, below = column.slice(0, n - 1), column.slice(1)
        unequal = pc.fill_null(pc.not_equal(above, below), False)
        nulls = pc.xor(pc.is_null(above), pc.is_null(below))
        differs[1:] |= pc.or_(unequal, nulls).to_numpy(zero_copy_only=False)
    return np.flatnonzero(differs)


def _ranked_rows(
    table: pa.Table, starts: np.ndarray, rolling: str, growing: str, width: int
) -> pa.Table:
    """The owned rows of whole chunks, which begin at ``starts``, with their counts."""
    n = table.num_rows
    sizes = np.diff(np.append(starts, n))
    at = np.arange(n)
    position, owned = (table.column(c).to_numpy() for c in (POS, OWNED))
    start = np.repeat(starts, sizes)
    headless = owned[starts] & (position[starts] > 0)
    if headless.any() or not np.array_equal(position - position[start], at - start):
        raise ValueError("the rows of a chunk must be consecutive and in one task")
    below = count_smaller(table.column(rolling).to_numpy(), np.maximum(start, at - width + 1))

    # The rows a chunk owns are consecutive; the halo is in front of them.
    first = np.repeat(np.minimum.reduceat(np.where(owned, at, n), starts), sizes)
    value = table.column(growing).to_numpy()
    earlier = count_smaller(value, first)
    present = np.cumsum(~np.isnan(value), dtype=np.int64)
    before = np.where(first > 0, present[np.minimum(first, n) - 1], 0)
    counted = {BELOW_ROLLING: below, BELOW_EARLIER: earlier, SEEN: present - before}
    kept = table.drop_columns([OWNED])
    for name, column in counted.items():
        kept = kept.append_column(name, pa.array(column))
    return kept.filter(pa.array(owned))


def _kernel(
    keys: Sequence[str], rolling: str, growing: str, width: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < _PIECE:
                continue
            table = pa.Table.from_batches(held)
            starts = _edges(table, (*keys, CHUNK))
            # The last chunk may go on in the next batch.
            whole = int(starts[-1])
            if whole:
                done = table.slice(0, whole)
                yield from _ranked_rows(done, starts[:-1], rolling, growing, width).to_batches()
            tail = table.slice(whole)
            held, size = tail.to_batches(), tail.num_rows
        if size:
            table = pa.Table.from_batches(held)
            starts = _edges(table, (*keys, CHUNK))
            yield from _ranked_rows(table, starts, rolling, growing, width).to_batches()

    return run


def rank_in_chunks(
    halo: DataFrame, keys: Sequence[str], rolling: str, growing: str, width: int
) -> DataFrame:
    """Counts of smaller rows, right within each chunk; keeps the owned rows.

    ``halo`` must reach ``width - 1`` rows back and none ahead, and must come out of
    windows over ``chunk_window``: those put every chunk into one task, in order, so
    nothing is shuffled or sorted again here. The kernel reads a task's rows as they
    come, finds where chunks begin and holds the rows of an unfinished one, so a
    thousand short series cost no more than one long one.
    """
    counts = [T.StructField(c, T.LongType()) for c in (BELOW_ROLLING, BELOW_EARLIER, SEEN)]
    schema = T.StructType(halo.drop(OWNED).schema.fields + counts)
    ordered = halo.sortWithinPartitions(*keys, CHUNK, POS)
    return ordered.mapInArrow(_kernel(tuple(keys), rolling, growing, width), schema)


def _smaller_in_earlier_chunks(
    ranked: DataFrame, keys: Sequence[str], value: str, layout: Layout
) -> DataFrame:
    """Per (series, chunk, value): rows of earlier chunks with a smaller value.

    Rows of one chunk and value share the answer, so equal values are counted
    before anything is exploded. At level l a chunk belongs to node
    ``chunk >> (l + 1)`` and lies in its left or right half; what a right row has
    to its left, summed over the levels, is exactly the earlier chunks. Nodes are
    split into value blocks so that the top node of a long series is not one
    group; the cut points affect balance only.
    """
    keys = list(keys)
    points = ranked.filter(F.col(value).isNotNull()).groupBy(*keys, ROWS, CHUNK, value).agg(
        F.count("*").alias("_weight")
    )
    fractions = [i / layout.value_splits for i in range(1, layout.value_splits)]
    cuts = points.groupBy(*keys, ROWS).agg(
        F.percentile_approx(value, fractions, 1000).alias("_cuts")
    )
    cuts = spread_to_chunks(cuts, layout).drop(ROWS)

    chunks = chunk_of(F.col(ROWS) - 1, layout) + 1
    top = F.ceil(F.log2(chunks)).cast("int") - 1
    nodes = (
        points.filter(chunks > 1)
        .join(cuts, [*keys, CHUNK])
        .withColumn("_block", F.size(F.filter("_cuts", lambda cut: cut < F.col(value))))
        .withColumn("_level", F.explode(F.sequence(F.lit(0), top)))
        .withColumn("_node", F.expr(f"shiftright({CHUNK}, _level + 1)"))
        .withColumn("_left", F.expr(f"1 - (shiftright({CHUNK}, _level) & 1)"))
        .withColumn("_left_weight", F.col("_left") * F.col("_weight"))
        .select(*keys, CHUNK, value, "_level", "_node", "_block", "_left", "_left_weight")
    )

    node = [*keys, "_level", "_node"]
    lower_blocks = running_before(Window.partitionBy(*node).orderBy("_block"))
    blocks = (
        nodes.groupBy(*node, "_block")
        .agg(F.sum("_left_weight").alias("_total"))
        .select(*node, "_block", F.sum("_total").over(lower_blocks).alias("_lower"))
    )
    # Right rows sort before left rows of the same value, which they do not count.
    smaller = running_before(Window.partitionBy(*node, "_block").orderBy(value, "_left"))
    return (
        nodes.withColumn("_inside", F.sum("_left_weight").over(smaller))
        .join(blocks, [*node, "_block"])
        .filter("_left = 0")
        .groupBy(*keys, CHUNK, value)
        .agg(
            F.sum(
                F.coalesce("_inside", F.lit(0)) + F.coalesce("_lower", F.lit(0))
            ).alias("_below_before")
        )
    )


def add_earlier_chunks(
    ranked: DataFrame, keys: Sequence[str], value: str, layout: Layout
) -> DataFrame:
    """Complete ``_below_earlier`` and ``_seen`` with the rows of earlier chunks.

    ``ranked`` is the stored output of ``rank_in_chunks``.
    """
    keys = list(keys)
    per_chunk = ranked.groupBy(*keys, CHUNK).agg(F.count(value).alias("_valid"))
    before = running_before(Window.partitionBy(*keys).orderBy(CHUNK))
    seen = per_chunk.select(*keys, CHUNK, F.sum("_valid").over(before).alias("_seen_before"))
    smaller = _smaller_in_earlier_chunks(ranked, keys, value, layout)
    return (
        ranked.join(seen, [*keys, CHUNK])
        .join(smaller, [*keys, CHUNK, value], "left")
        .withColumn(BELOW_EARLIER, F.col(BELOW_EARLIER) + F.coalesce("_below_before", F.lit(0)))
        .withColumn(SEEN, F.col(SEEN) + F.coalesce("_seen_before", F.lit(0)))
        .drop("_seen_before", "_below_before")
    )
