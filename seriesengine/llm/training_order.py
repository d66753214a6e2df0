"""Token ids in training order, in binary shards of fixed stride.

A document's ids, with an end id, are cut into sequences of ``length`` ids. Sequences
are numbered in the order of the table: every task counts its own, and the sums over
tasks tell each task its first number. A keyed Feistel network
over the next power of four permutes the numbers, and numbers that leave the range are
walked on along their cycle until they are back, so each sequence gets one global slot
and the slots are dense. Sequences go to the shard of their slot by range, and a shard
is one file of fixed-length records in slot order: a reader that has seen ``n``
sequences goes on at byte ``n % per_shard * stride`` of shard ``n // per_shard``.

Texts are encoded twice: once to count sequences, once to write them. Keeping the ids
in between would take more disk than the shards.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesengine.llm.common import text_of
from seriesengine.llm.tokens import END_ID, RANKS, VOCABULARY, encoder
from seriesengine.scratch import materialize
from seriesengine.sources.files import Files

# Sequences that are sorted into shards together, unless one text has more.
_TOGETHER = 16_384

_SPLITS = "spark.sql.files.minPartitionNum"


@dataclass(frozen=True)
class Layout:
    """``length`` ids of 2 bytes per sequence, ``per_shard`` sequences per file; ``pad``
    fills the last sequence of a document; ``key`` fixes the order."""

    length: int = 256
    per_shard: int = 16_384
    pad: int = 50_256
    key: int = 20250101
    rounds: int = 6

    @property
    def stride(self) -> int:
        return 2 * self.length


LAYOUT = Layout()


def _mixed(values: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser of values and a key."""
    mask = np.uint64(0xFFFFFFFFFFFFFFFF)
    x = (values + np.uint64(key * 0x9E3779B97F4A7C15 & int(mask))) & mask
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def slots_of(numbers: np.ndarray, count: int, key: int, rounds: int = 6) -> np.ndarray:
    """Slots of sequence numbers: a keyed permutation of ``range(count)``."""
    half = max(1, (max(count - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    with np.errstate(over="ignore"):
        out = numbers.astype(np.uint64)
        walking = np.arange(len(out))
        while len(walking):
            x = out[walking]
            left, right = x >> np.uint64(half), x & mask
            for turn in range(rounds):
                left, right = right, left ^ (_mixed(right, key * 64 + turn) & mask)
            out[walking] = (left << np.uint64(half)) | right
            walking = walking[out[walking] >= count]
    return out.astype(np.int64)


@contextmanager
def _same_splits(spark: SparkSession) -> Iterator[None]:
    """Files are split alike however many executors are there at the time."""
    before = spark.conf.get(_SPLITS, None)
    spark.conf.set(_SPLITS, before or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SPLITS)


def _store(root: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder given as a path or URI."""
    if re.match(r"[a-z][a-z0-9+.-]*:/", root):
        return pafs.FileSystem.from_uri(root)
    return pafs.LocalFileSystem(), root


def materialise(
    docs: DataFrame,
    root: str,
    layout: Layout = LAYOUT,
    vocabulary: str = VOCABULARY,
    ranks: str = RANKS,
) -> DataFrame:
    """Write all sequences of ``docs`` (``doc_id, text``) as shards under ``root``.

    Returns one row per sequence: ``slot, shard, byte_offset, doc_id, start, length,
    crc32`` of its ids (without padding). ``docs`` is a table read from files, since it
    is read twice and must be split alike; a task that meets other rows than were
    counted fails. ``root`` is a folder that all executors reach; a path without a scheme
    belongs to Spark's default file system, as for every reader and writer of Spark. A
    shard is written under another name and renamed, so a task that runs again replaces
    its file by an equal one. Null texts are empty: one sequence that holds the end id
    alone. Repeated rows are written as often as they occur; a null id stays null; an
    empty table writes nothing.
    """
    spark = docs.sparkSession
    root = Files(spark, root).qualified(root)
    rows = docs.select(text_of(F.col("text")).alias("text"), F.col("doc_id").cast("long").alias("doc_id"))

    def count_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes_of = encoder(vocabulary, ranks).sizes
        pieces = 0
        for batch in batches:
            pieces += int((-(-(sizes_of(batch.column(0)) + 1) // layout.length)).sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([pieces], pa.int64())],
            names=["task", "pieces"],
        )

    with _same_splits(spark):
        # One row per task.
        counted = rows.mapInArrow(count_pieces, "task int, pieces long").toArrow().to_pylist()
        firsts = {}
        count = 0
        for r in sorted(counted, key=lambda r: r["task"]):
            firsts[r["task"]] = (count, count + r["pieces"])
            count += r["pieces"]
        manifest = _written(rows, root, firsts, count, layout, vocabulary, ranks)
        return materialize(manifest, "order-manifest")[0]


def _written(
    rows: DataFrame,
    root: str,
    firsts: dict[int, tuple[int, int]],
    count: int,
    layout: Layout,
    vocabulary: str,
    ranks: str,
) -> DataFrame:
    """Shuffle the sequences to their shards and write these.

    What some texts give to one shard travels as one row, packed together. A task holds
    one shard at a time, ``per_shard * stride`` bytes, and puts each sequence in its place.
    """

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks).encode
        pack = zstandard.ZstdCompressor(level=1)
        number, end = firsts[TaskContext.get().partitionId()]
        for batch in batches:
            blocks: list[np.ndarray] = []
            owners, lengths, held = [], [], 0
            for row, ids in enumerate(encode(batch.column(0))):
                size = len(ids) + 1
                pieces = -(-size // layout.length)
                block = np.full(pieces * layout.length, layout.pad, "<u2")
                block[: size - 1] = ids
                block[size - 1] = END_ID
                blocks.append(block.reshape(pieces, layout.length))
                owners.append(np.full(pieces, row))
                lengths.append(size)
                held += pieces
                if held >= _TOGETHER:
                    yield _by_shard(batch, blocks, owners, lengths, number, pack)
                    number, held = number + held, 0
                    blocks, owners, lengths = [], [], []
            if held:
                yield _by_shard(batch, blocks, owners, lengths, number, pack)
                number += held
        if number != end:
            raise RuntimeError("the table was split in another way than when it was counted")

    def _by_shard(batch, blocks, owners, lengths, number, pack) -> pa.RecordBatch:
        ids, owner = np.concatenate(blocks), np.concatenate(owners)
        at = np.concatenate([np.arange(len(b)) * layout.length for b in blocks])
        size = np.minimum(np.repeat(lengths, [len(b) for b in blocks]) - at, layout.length)
        slots = slots_of(number + np.arange(len(ids)), count, layout.key, layout.rounds)
        order = np.argsort(slots)
        slots = slots[order]
        shards = slots // layout.per_shard
        edges = np.append(np.flatnonzero(np.diff(shards, prepend=-1)), len(shards))
        packed = [
            pack.compress(ids[order[start:stop]].tobytes())
            for start, stop in zip(edges[:-1], edges[1:], strict=True)
        ]
        offsets = pa.array(edges.astype(np.int32))
        doc_ids = batch.column(1).take(pa.array(owner[order]))
        lists = [pa.array(slots), doc_ids, pa.array(at[order]), pa.array(size[order])]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(shards[edges[:-1]]),
                *(pa.ListArray.from_arrays(offsets, values) for values in lists),
                pa.array(packed, pa.binary()),
            ],
            names=["shard", "slots", "doc_ids", "starts", "lengths", "ids"],
        )

    cut = rows.mapInArrow(
        sequences,
        "shard long, slots array<long>, doc_ids array<long>, starts array<long>, "
        "lengths array<long>, ids binary",
    )
    shards = max(1, -(-count // layout.per_shard))
    root = root.rstrip("/")
    placed = cut.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        files, base = _store(root)
        files.create_dir(base, recursive=True)
        shard, parts = None, []

        def closed() -> pa.RecordBatch:
            first = shard * layout.per_shard
            size = min(layout.per_shard, count - first)
            block = np.full((size, layout.length), layout.pad, "<u2")
            columns = []
            for slots, packed, *more in parts:
                ids = np.frombuffer(unpack.decompress(packed), "<u2").reshape(-1, layout.length)
                block[slots - first] = ids
                columns.append((pa.array(slots), *more))
            slots, doc_ids, starts, lengths = (pa.concat_arrays(c) for c in zip(*columns, strict=True))
            order = pc.sort_indices(slots)
            slots, doc_ids, starts, lengths = (c.take(order) for c in (slots, doc_ids, starts, lengths))
            if not np.array_equal(slots.to_numpy(), first + np.arange(size)):
                raise RuntimeError(f"shard {shard} does not have one sequence in each slot")
            temporary = f"{base}/_{shard:08d}-{uuid.uuid4().hex}"
            with files.open_output_stream(temporary) as stream:
                stream.write(block.tobytes())
            files.move(temporary, f"{base}/shard-{shard:08d}.bin")
            crcs = [zlib.crc32(block[i, :n].tobytes()) for i, n in enumerate(lengths.to_pylist())]
            return pa.RecordBatch.from_arrays(
                [
                    slots,
                    pa.array(np.full(size, shard)),
                    pa.array(np.arange(size) * layout.stride),
                    doc_ids,
                    starts,
                    lengths,
                    pa.array(crcs, pa.int64()),
                ],
                names=["slot", "shard", "byte_offset", "doc_id", "start", "length", "crc32"],
            )

        for batch in batches:
            for i, own in enumerate(batch.column(0).to_pylist()):
                if own != shard:
                    if parts:
                        yield closed()
                    shard, parts = own, []
                lists = [batch.column(c)[i].values for c in range(1, 5)]
                parts.append((lists[0].to_numpy(), batch.column(5)[i].as_py(), *lists[1:]))
        if parts:
            yield closed()

    return placed.mapInArrow(
        write,
        "slot long, shard long, byte_offset long, doc_id long, start long, length long, crc32 long",
    )


def read_sequences(root: str, first: int, count: int, layout: Layout = LAYOUT) -> Iterator[np.ndarray]:
    """Ids of ``count`` sequences from slot ``first`` on, padding included; a slot behind the
    last is an error."""
    files, base = _store(root)
    slot = first
    while slot < first + count:
        shard, place = divmod(slot, layout.per_shard)
        with files.open_input_file(f"{base}/shard-{shard:08d}.bin") as stream:
            stream.seek(place * layout.stride)
            for _ in range(min(layout.per_shard - place, first + count - slot)):
                ids = stream.read(layout.stride)
                if len(ids) < layout.stride:
                    raise ValueError(f"slot {slot} lies behind the last sequence")
                yield np.frombuffer(ids, "<u2")
                slot += 1
