"""Nearest neighbours by a forest of random-projection trees.

Each tree splits vectors by the plane halfway between two drawn vectors. Its planes
are laid on a bounded sample, in numpy; then every vector is routed to one leaf of
each tree. A query searches all trees through one priority queue, in which a node
waits with the sum of the squared margins crossed to reach it, until the leaves that
were taken hold enough vectors. Vectors of those leaves are compared exactly, leaf by
leaf, and the nearest are kept.

How many are enough depends on the table: the nearest of some drawn queries are found
by comparing them with all vectors, and the search goes as far for every query as it
must to reach the wanted share of those. Far spread vectors so cost a constant share of
the table for each query, whatever its size, and clustered ones little.

Equal vectors cannot be told apart by planes. They are indexed once, with as many of
their smallest ids as a result could show.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesengine.scratch import materialize


@dataclass(frozen=True)
class Settings:
    """Trees, vectors of the sample at most, sampled vectors of a leaf at most, the
    vectors that a query compares itself with at least (if there are so many), the
    share of the nearest to be reached, and the drawn queries that it is judged by."""

    trees: int = 32
    sample: int = 65_536
    leaf: int = 64
    compared: int = 10_000
    recall: float = 0.95
    judged: int = 128
    seed: int = 11


SETTINGS = Settings()

_SHELF = 16

# Postings of a shelf that are compared in one call.
_SLICE = 16_384


@dataclass
class Tree:
    """Planes (unit normals) and children of the inner nodes; child -1 - n is leaf n."""

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    leaves: int

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        at = np.zeros(len(vectors), np.int64) if len(self.normals) else np.full(len(vectors), -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            nodes = at[inner]
            margins = np.einsum("ij,ij->i", vectors[inner], self.normals[nodes])
            at[inner] = self.children[nodes, (margins > self.offsets[nodes]).astype(int)]
        return -1 - at


def grow(vectors: np.ndarray, leaf: int, random: np.random.Generator) -> Tree:
    """A tree over a sample. Where a plane does not part its vectors, they are halved."""
    normals, offsets, children = [], [], []
    leaves = 0
    root = -1
    stack = [(np.arange(len(vectors)), -1, 0)]
    while stack:
        own, parent, side = stack.pop()
        if len(own) <= leaf:
            node, leaves = -1 - leaves, leaves + 1
        else:
            a, b = vectors[random.choice(own, 2, replace=False)]
            normal = a - b
            margins = vectors[own] @ normal
            offset = float(normal @ (a + b)) / 2
            right = margins > offset
            if not 0.05 < right.mean() < 0.95:
                offset = float(np.median(margins))
                right = margins > offset
            if right.all() or not right.any():
                normal = random.standard_normal(vectors.shape[1])
                margins = vectors[own] @ normal
                offset = float(np.median(margins))
                right = margins > offset
            if right.all() or not right.any():
                node, leaves = -1 - leaves, leaves + 1
            else:
                node = len(normals)
                length = np.linalg.norm(normal)
                normals.append(normal / length)
                offsets.append(offset / length)
                children.append([0, 0])
                stack += [(own[right], node, 1), (own[~right], node, 0)]
        if parent >= 0:
            children[parent][side] = node
        else:
            root = node
    if root < 0:
        return Tree(np.zeros((0, vectors.shape[1])), np.zeros(0), np.zeros((0, 2), np.int64), 1)
    return Tree(np.array(normals), np.array(offsets), np.array(children), leaves)


def visited(
    query: np.ndarray, forest: list[Tree], sizes: list[np.ndarray]
) -> Iterator[tuple[int, int, int]]:
    """Trees and leaves in the order of a query's search, nearest margins first, each
    with the postings held by then."""
    products = [t.normals @ query - t.offsets for t in forest]
    queue = [(0.0, tree, 0 if len(t.normals) else -1) for tree, t in enumerate(forest)]
    heapq.heapify(queue)
    held = 0
    while queue:
        crossed, tree, node = heapq.heappop(queue)
        while node >= 0:
            margin = products[tree][node]
            near = int(margin > 0)
            far = crossed + margin * margin
            heapq.heappush(queue, (far, tree, int(forest[tree].children[node, 1 - near])))
            node = int(forest[tree].children[node, near])
        held += int(sizes[tree][-1 - node])
        yield tree, -1 - node, held


def probes(
    query: np.ndarray, forest: list[Tree], sizes: list[np.ndarray], wanted: int
) -> list[tuple[int, int]]:
    """Trees and leaves that a query visits, until they hold ``wanted`` postings."""
    visits = []
    for tree, leaf, held in visited(query, forest, sizes):
        visits.append((tree, leaf))
        if held >= wanted:
            break
    return visits


def reaches(
    query: np.ndarray, forest: list[Tree], sizes: list[np.ndarray], leaves: list[list[int]]
) -> list[int]:
    """Postings held when a search first reaches each vector, given by its leaf of each tree."""
    at: dict[tuple[int, int], list[int]] = {}
    for n, own in enumerate(leaves):
        for place in enumerate(own):
            at.setdefault(place, []).append(n)
    found: dict[int, int] = {}
    for tree, leaf, held in visited(query, forest, sizes):
        for n in at.get((tree, leaf), ()):
            found.setdefault(n, held)
        if len(found) == len(leaves):
            break
    return list(found.values())


def usable(rows: DataFrame) -> DataFrame:
    """``vec_id, vector`` of the rows that take part; floats stay floats until compared.

    Left out: null ids, null, empty and zero vectors, and vectors that hold null, NaN
    or infinite components.
    """
    is_float = isinstance(rows.schema["embedding"].dataType.elementType, T.FloatType)
    vector = F.col("embedding").cast("array<float>" if is_float else "array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return (
        rows.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
        .filter("vec_id IS NOT NULL AND vector IS NOT NULL")
        .filter(F.forall("vector", finite))
        .filter(F.exists("vector", lambda x: x != 0))
    )


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _enough(
    queries: DataFrame, routed: DataFrame, forest: list[Tree], sizes: list[np.ndarray], k: int, settings: Settings
) -> int:
    """Postings that the searches must hold to reach the wanted share of the nearest.

    Drawn queries are compared with all vectors. Vectors equal to the query's share all
    its leaves and are not judged.
    """
    drawn = queries.orderBy(F.xxhash64("vec_id", F.lit(settings.seed)), "vec_id").limit(settings.judged).toArrow()
    least = settings.compared * 2  # leaves of different trees overlap
    if not len(drawn):
        return least
    asked = _matrix(drawn.column("vector"))
    sent = routed.sparkSession.sparkContext.broadcast(asked)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norms = (sent.value**2).sum(axis=1)[:, None]
        for batch in batches:
            vectors = _matrix(batch.column(0))
            if not len(vectors):
                continue
            both = norms + (vectors**2).sum(axis=1)
            scores = both - 2 * (sent.value @ vectors.T)
            scores[scores <= 1e-12 * both] = np.inf
            best = np.argsort(scores, axis=1)[:, :k]
            number = np.repeat(np.arange(len(best), dtype=np.int32), best.shape[1])
            rows = pa.array(best.ravel())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(number),
                    pa.array(np.take_along_axis(scores, best, axis=1).ravel()),
                    batch.column(1).take(rows),
                    batch.column(2).take(rows),
                ],
                names=["number", "score", "rep", "leaves"],
            )

    near = Window.partitionBy("number").orderBy("score", "rep")
    truth = (
        routed.select("vector", "rep", "leaves")
        .mapInArrow(compare, "number int, score double, rep long, leaves array<int>")
        .filter(F.col("score") < F.lit(float("inf")))
        .withColumn("n", F.row_number().over(near))
        .filter(F.col("n") <= k)
        .select("number", "leaves")
    )
    leaves: dict[int, list[list[int]]] = {}
    for row in truth.toArrow().to_pylist():
        leaves.setdefault(row["number"], []).append(row["leaves"])
    held = [h for n, own in leaves.items() for h in reaches(asked[n], forest, sizes, own)]
    return max([least, *([int(np.quantile(held, settings.recall, method="higher"))] if held else [])])


def nearest(
    rows: DataFrame, k: int = 10, every: int = 100, settings: Settings = SETTINGS
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query.

    ``rows`` has ``vec_id`` and ``embedding``; queries are the rows whose id is divisible
    by ``every``, candidates all rows but the query's own. The score is the Euclidean
    distance in double precision; ties go to the smaller id. Rows that ``usable`` leaves
    out take no part, nor do vectors of another length than most (of equally common
    lengths the larger counts). A repeated id is the row with the smallest vector. An
    empty table gives no rows; a query with fewer candidates gets all of them.
    """
    parts = usable(rows)
    lengths = parts.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    spark = rows.sparkSession
    if lengths is None:
        return spark.sql(
            "SELECT 0L query_id, 1 rank, 0L vec_id, 0D score WHERE false"
        )
    parts = parts.filter(F.size("vector") == lengths["n"]).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    parts, _ = materialize(parts, "ann-rows")

    # Equal vectors: the smallest ids, one more than a result shows, since a query may
    # be among them. The limit is applied before the shuffle.
    by_id = Window.partitionBy("vector").orderBy("vec_id")
    shown = parts.withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= k + 1)
    distinct, _ = materialize(
        shown.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.min("vec_id").alias("rep")),
        "ann-distinct",
    )

    sample = distinct.orderBy(F.xxhash64("rep", F.lit(settings.seed)), "rep").limit(settings.sample).select("vector")
    base = _matrix(sample.toArrow().column("vector"))
    random = np.random.default_rng(settings.seed)
    forest = [grow(base, settings.leaf, random) for _ in range(settings.trees)]
    sent = spark.sparkContext.broadcast(forest)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column(0))
            leaves = np.stack([t.leaf_of(vectors) for t in sent.value], axis=1).astype(np.int32)
            offsets = np.arange(len(vectors) + 1, dtype=np.int32) * leaves.shape[1]
            listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(leaves.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), listed], names=["vector", "rep", "leaves"]
            )

    kind = distinct.schema["vector"].dataType
    routed, _ = materialize(
        distinct.select("vector", "rep").mapInArrow(
            route,
            T.StructType().add("vector", kind).add("rep", T.LongType()).add("leaves", T.ArrayType(T.IntegerType())),
        ),
        "ann-leaves",
    )
    postings = routed.select("rep", "vector", F.posexplode("leaves").alias("tree", "leaf"))
    # One row per leaf, and leaves are bounded by the sample.
    filled = [np.zeros(t.leaves, np.int64) for t in forest]
    for r in postings.select("tree", "leaf").groupBy("tree", "leaf").count().toArrow().to_pylist():
        filled[r["tree"]][r["leaf"]] = r["count"]
    sizes_sent = spark.sparkContext.broadcast(filled)
    # Leaves are compared a shelf at a time, since a call costs more than a leaf; a shelf
    # that holds many vectors is dealt out by the vectors, and its queries go to each part.
    slices = [
        -(-np.add.reduceat(n, np.arange(0, len(n), _SHELF)) // _SLICE).clip(None, -1) for n in filled
    ]
    slices_sent = spark.sparkContext.broadcast(slices)

    queries = parts.filter(F.col("vec_id") % every == 0).select("vec_id", "vector")
    wanted = _enough(queries, routed, forest, filled, k, settings)
    floats = pa.float32() if isinstance(kind.elementType, T.FloatType) else pa.float64()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column(1))
            for i, query in enumerate(vectors):
                shelves: dict[tuple[int, int], list[int]] = {}
                for tree, leaf in probes(query, sent.value, sizes_sent.value, wanted):
                    shelves.setdefault((tree, leaf // _SHELF), []).append(leaf)
                rows = [
                    (tree, shelf, part, leaves)
                    for (tree, shelf), leaves in shelves.items()
                    for part in range(slices_sent.value[tree][shelf])
                ]
                query = query.astype(floats.to_pandas_dtype())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.int32()),
                        pa.array([r[1] for r in rows], pa.int32()),
                        pa.array([r[2] for r in rows], pa.int32()),
                        pa.array([r[3] for r in rows], pa.list_(pa.int32())),
                        pa.array([batch.column(0)[i].as_py()] * len(rows), pa.int64()),
                        pa.array([query] * len(rows), pa.list_(floats)),
                    ],
                    names=["tree", "shelf", "part", "visited", "query_id", "query"],
                )

    visits = queries.repartition("vec_id").mapInArrow(
        search,
        T.StructType()
        .add("tree", T.IntegerType())
        .add("shelf", T.IntegerType())
        .add("part", T.IntegerType())
        .add("visited", T.ArrayType(T.IntegerType()))
        .add("query_id", T.LongType())
        .add("query", kind),
    )

    def rerank(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        queries = dict(zip(asked["query_id"], asked["query"], strict=True))
        visits = asked[["query_id", "visited"]].explode("visited").groupby("visited")["query_id"]
        members = dict(list(own.groupby("leaf")))
        for leaf, ids in visits:
            if leaf not in members:
                continue
            reps = members[leaf]["rep"].to_numpy()
            vectors = np.stack(members[leaf]["vector"]).astype(np.float64)
            for query_id in ids:
                scores = np.sqrt(((vectors - queries[query_id]) ** 2).sum(axis=1))
                found.setdefault(query_id, []).append((reps, scores))
        out = []
        for query_id, lists in found.items():
            reps, scores = (np.concatenate(c) for c in zip(*lists, strict=True))
            best = np.lexsort((reps, scores))[: k + 1]
            out.append((np.full(len(best), query_id), reps[best], scores[best]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[], [], []]
        return pd.DataFrame(dict(zip(("query_id", "rep", "score"), columns, strict=True)))

    dealt = spark.createDataFrame(
        [(t, n, int(c)) for t, counts in enumerate(slices) for n, c in enumerate(counts) if c > 1],
        "tree int, shelf int, parts int",
    )
    shelf = F.floor(F.col("leaf") / _SHELF).cast("int")
    part = F.pmod(F.xxhash64("rep"), F.coalesce("parts", F.lit(1))).cast("int")
    held = (
        postings.withColumn("shelf", shelf)
        .join(dealt, ["tree", "shelf"], "left")
        .select("tree", "shelf", part.alias("part"), "leaf", "rep", "vector")
    )
    found = (
        held.groupBy("tree", "shelf", "part")
        .cogroup(visits.groupBy("tree", "shelf", "part"))
        .applyInPandas(rerank, "query_id long, rep long, score double")
        .groupBy("query_id", "rep")
        .agg(F.min("score").alias("score"))
    )
    near = Window.partitionBy("query_id").orderBy("score", "rep")
    few = found.withColumn("n", F.row_number().over(near)).filter(F.col("n") <= k + 1)
    listed = few.join(distinct.select("rep", "ids"), "rep").select(
        "query_id", "score", F.explode("ids").alias("vec_id")
    )
    ranked = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        listed.filter("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
