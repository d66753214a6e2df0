"""Packing of token sequences into windows by multiway differencing.

A document's ids are cut into full windows from its start; what is left over is cut
into chunks. Chunks are packed by the Karmarkar-Karp method: each starts as a
partition of one filled window, and the two partitions with the largest imbalance
are merged, fullest window onto emptiest, until one is left. If its fullest window
exceeds the capacity, the number of windows rises and the chunks are packed anew.

A task packs the documents it reads, some thousand chunks at a time: nothing is
shuffled, and memory is bounded by the batch and by one document.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesengine.llm.tokens import END_ID, RANKS, VOCABULARY, encoder

CAPACITY = 1024

# Leftovers are cut into chunks of at most this part of the capacity, since windows
# of several chunks can be balanced and windows of one or two cannot.
CHUNKS_PER_WINDOW = 2

# Chunks that are packed together.
BATCH_CHUNKS = 1024

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)

# Sequence ids of one task: its partition number above, a running number below.
_TASK_BITS = 40


def _difference(sizes: Sequence[int], windows: int) -> tuple[np.ndarray, list[int]]:
    """Sums of the windows and the window of each chunk."""
    if windows == 1:
        return np.array([sum(sizes)]), [0] * len(sizes)
    # A partition: sums of its windows in falling order, and a tree node for each.
    children: list[tuple[int, int] | None] = [None] * len(sizes)
    heap = []
    for i, size in enumerate(sizes):
        sums, nodes = np.zeros(windows, np.int64), np.full(windows, -1, np.int64)
        sums[0], nodes[0] = size, i
        heap.append((-int(size), i, sums, nodes))
    heapq.heapify(heap)
    turn = len(sizes)
    while len(heap) > 1:
        _, _, left_sums, left_nodes = heapq.heappop(heap)
        _, _, right_sums, right_nodes = heapq.heappop(heap)
        sums, other = left_sums + right_sums[::-1], right_nodes[::-1]
        nodes = np.maximum(left_nodes, other)
        for at in np.flatnonzero((left_nodes >= 0) & (other >= 0)):
            children.append((int(left_nodes[at]), int(other[at])))
            nodes[at] = len(children) - 1
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        heapq.heappush(heap, (-int(sums[0] - sums[-1]), turn, sums, nodes))
        turn += 1
    _, _, sums, nodes = heap[0]
    window_of = [0] * len(sizes)
    for window, node in enumerate(nodes):
        stack = [int(node)] if node >= 0 else []
        while stack:
            at = stack.pop()
            pair = children[at]
            if pair is None:
                window_of[at] = window
            else:
                stack += pair
    return sums, window_of


def balanced_windows(sizes: Sequence[int], capacity: int) -> list[int]:
    """The window of each chunk; no window exceeds the capacity, and they are nearly equal."""
    if not sizes:
        return []
    if max(sizes) > capacity:
        raise ValueError("a chunk exceeds the capacity")
    windows = -(-sum(sizes) // capacity)
    while True:
        sums, window_of = _difference(sizes, windows)
        if sums.max() <= capacity:
            return window_of
        windows += 1


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document: full windows, then chunks."""
    full = length - length % capacity
    chunk = max(1, capacity // CHUNKS_PER_WINDOW)
    pieces = [(at, capacity) for at in range(0, full, capacity)]
    return pieces + [(at, min(chunk, length - at)) for at in range(full, length, chunk)]


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    with_ids: bool = False,
    vocabulary: str = VOCABULARY,
    ranks: str = RANKS,
) -> DataFrame:
    """Pieces of documents and their places in sequences of at most ``capacity`` ids.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. One row per
    piece: its document's id, its start and length in the document's ids, the CRC-32
    of its ids, the document's length, the sequence and the offset in it; with
    ``with_ids`` also the ids. A document's ids end with an end id, so a null or empty
    text is that id alone. Repeated rows are packed as often as they occur, and a null
    ``doc_id`` stays null. Sequence ids differ between tasks and are not contiguous.
    """

    def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks).encode
        sequence = TaskContext.get().partitionId() << _TASK_BITS
        waiting: list[tuple] = []
        done: list[tuple] = []
        held = 0

        def flush() -> None:
            nonlocal sequence
            window_of = balanced_windows([w[2] for w in waiting], capacity)
            filled: dict[int, int] = {}
            for window, piece in zip(window_of, waiting, strict=True):
                offset = filled.get(window, 0)
                filled[window] = offset + piece[2]
                done.append((*piece[:5], sequence + window, offset, *piece[5:]))
            sequence += max(window_of, default=-1) + 1
            waiting.clear()

        for batch in batches:
            ids_of = encode(batch.column(1))
            for doc_id, ids in zip(batch.column(0).to_pylist(), ids_of, strict=True):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for start, length in cuts(len(ids), capacity):
                    part = ids[start : start + length].tobytes()
                    piece = (doc_id, start, length, zlib.crc32(part), len(ids))
                    if with_ids:
                        piece += (np.frombuffer(part, "<i4"),)
                        held += length
                    if length == capacity:
                        done.append((*piece[:5], sequence, 0, *piece[5:]))
                        sequence += 1
                    else:
                        waiting.append(piece)
                        if len(waiting) == BATCH_CHUNKS:
                            flush()
                if len(done) >= 20_000 or held >= 4_000_000:
                    yield _table(done, with_ids)
                    done.clear()
                    held = 0
        flush()
        yield _table(done, with_ids)

    schema = PIECES + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        pieces_of, schema
    )


def _table(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    names = [p.split()[0] for p in PIECES.split(", ")] + ["ids"] * with_ids
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())] * with_ids
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names)
