"""Shards along a Hilbert curve over several metadata dimensions.

Each dimension is quantised to the same number of bits, a document's cell gets its
index on the Hilbert curve through all cells, and documents are sorted by that index.
Cells that are close on the curve are close in every dimension, so a run of the order,
be it a file or a shard, covers a narrow range of all of them, and readers that filter
by any can skip most files by their least and greatest values. Shards are runs of the
order, cut by the number of rows or by bytes.

Texts are ordered with their documents in one shuffle by ranges and written once, as
sorted files; shards and slots are numbers on those files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesengine.llm.common import in_order, text_of

SHARDS = 8


@dataclass(frozen=True)
class Grid:
    """Names that are quantised by their order, and the bits of every dimension; the last
    dimension is the size."""

    names: tuple[str, ...] = ("source", "lang")
    bits: int = 6

    @property
    def dimensions(self) -> int:
        return len(self.names) + 1


GRID = Grid()


def size_of(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none), and one for its end."""
    return (F.octet_length(text_of(text)) + 1).cast("long")


def size_code(size: Column, bits: int) -> Column:
    """A size from 1 on a scale of four steps per doubling; the last code is open."""
    doublings = F.length(F.bin(size)) - 1
    quarter = F.call_function("shiftright", size * 4, doublings) - 4
    return F.least(doublings * 4 + quarter, F.lit((1 << bits) - 1)).cast("long")


def rotations(dimensions: int) -> list[tuple[int, int]]:
    """Steps of a Hilbert curve: for each state (entry corner, direction) and each cell
    of the next level, bit by dimension, the digit on the curve and the next state.

    A state is ``corner * dimensions + direction``; entries are in the order of
    ``state * 2 ** dimensions + cell``.
    """
    n, full = dimensions, (1 << dimensions) - 1

    def turned(x: int, by: int) -> int:
        by %= n
        return (x >> by | x << (n - by)) & full

    def trailing_ones(x: int) -> int:
        return (~x & (x + 1)).bit_length() - 1

    steps = []
    for corner in range(full + 1):
        for direction in range(n):
            for cell in range(full + 1):
                gray = turned(cell ^ corner, direction + 1)
                digit = 0
                for shift in range(n):
                    digit ^= gray >> shift
                entry = 0 if digit == 0 else (e := 2 * ((digit - 1) // 2)) ^ e >> 1
                turn = 0 if digit == 0 else trailing_ones(digit if digit % 2 else digit - 1) % n
                after = corner ^ turned(entry, n - direction - 1)
                steps.append((digit, after * n + (direction + turn + 1) % n))
    return steps


def hilbert(codes: list[Column], bits: int) -> Column:
    """Index of a cell on the Hilbert curve through the grid of ``bits`` per dimension."""
    n = len(codes)
    states = n << n
    table = F.lit([digit * states + state for digit, state in rotations(n)])
    cells = F.array(
        *(
            sum(
                (F.shiftleft(F.shiftright(code, level).bitwiseAND(1), i) for i, code in enumerate(codes)),
                F.lit(0).cast("long"),
            )
            for level in reversed(range(bits))
        )
    )
    start = F.struct(F.lit(0).cast("long").alias("index"), F.lit(0).cast("long").alias("state"))

    def step(at: Column, cell: Column) -> Column:
        found = F.element_at(table, (F.shiftleft(at["state"], n) + cell + 1).cast("int")).cast("long")
        return F.struct(
            (F.shiftleft(at["index"], n) + F.floor(found / states)).alias("index"),
            F.pmod(found, F.lit(states).cast("long")).alias("state"),
        )

    return F.aggregate(cells, start, step, lambda at: at["index"])


def name_cuts(docs: DataFrame, name: str, bits: int) -> list[tuple[int, str]]:
    """Codes in order with the name at which each begins, ``2 ** bits`` at most: distinct
    names in order are spread evenly over all codes."""
    cells = 1 << bits
    names = docs.select(F.coalesce(F.col(name).cast("string"), F.lit("")).alias("name")).distinct()
    placed, seen = in_order(names, [F.asc("name")], f"names-of-{name}", "place", names=F.count("*"))
    code = F.floor(F.col("place") * cells / max(1, seen["names"]))
    begins = placed.groupBy(code.alias("code")).agg(F.min("name").alias("name"))
    return sorted((r["code"], r["name"]) for r in begins.collect())


def name_code(name: Column, cuts: list[tuple[int, str]]) -> Column:
    """The last code that begins at or before a name."""
    if not cuts:
        return F.lit(0).cast("long")
    text = F.coalesce(name.cast("string"), F.lit(""))
    begun = F.filter(F.lit([begin for _, begin in cuts]), lambda begin: begin <= text)
    return F.element_at(F.lit([code for code, _ in cuts]), F.greatest(F.size(begun), F.lit(1))).cast("long")


def sharded(docs: DataFrame, grid: Grid = GRID, shards: int = SHARDS) -> DataFrame:
    """The documents with their places in shards that are runs of a Hilbert curve.

    ``docs`` needs ``doc_id``, ``text`` and the names of the grid. Adds ``size`` (UTF-8
    bytes and one), ``text_crc32``, ``curve`` (index of the cell), ``law`` (``rows``: the
    shards' numbers of rows differ by one at most), ``shard``, ``slot`` (from 0 in each
    shard) and ``grown_shard`` (null: a further shard moves rows between all). Columns of
    these names are replaced, others carried along. Null names count as empty ones, null
    texts as empty. Documents of one cell are in the order of checksum and id, so copies
    of a text with equal metadata are neighbours; a null id comes last. Repeated rows are
    rows. The rows are written once, in files of runs of the order.
    """
    cuts = {name: name_cuts(docs, name, grid.bits) for name in grid.names}
    frame = docs.select(
        F.struct("*").alias("doc"),
        F.col("doc_id").cast("long").alias("id"),
        size_of(F.col("text")).alias("size"),
        F.crc32(text_of(F.col("text")).cast("binary")).alias("text_crc32"),
        *(name_code(F.col(n), cuts[n]).alias(f"code_{i}") for i, n in enumerate(grid.names)),
    )
    codes = [F.col(f"code_{i}") for i in range(len(grid.names))]
    curve = hilbert([*codes, size_code(F.col("size"), grid.bits)], grid.bits)
    keys = [F.asc("curve"), F.asc("text_crc32"), F.asc_nulls_last("id")]
    laid, seen = in_order(
        frame.select("doc", "id", "size", "text_crc32", curve.alias("curve")),
        keys,
        "curve",
        "place",
        rows=F.count("*"),
    )
    rows, place = max(1, seen["rows"]), F.col("place")
    shard = F.floor(((place + 1) * shards - 1) / rows)
    own = {
        "size": F.col("size"),
        "text_crc32": F.col("text_crc32"),
        "curve": F.col("curve"),
        "law": F.lit("rows"),
        "shard": shard.cast("int"),
        "slot": place - F.floor(shard * rows / shards),
        "grown_shard": F.lit(None).cast("int"),
    }
    carried = [F.col("doc").getField(c).alias(c) for c in docs.columns if c not in own]
    return laid.select(*carried, *(column.alias(name) for name, column in own.items()))


def write(placed: DataFrame, path: str) -> None:
    """Write placed documents as one folder per shard, whose files are runs of its slots."""
    order = ("shard", "slot")
    placed.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("shard").parquet(path)
