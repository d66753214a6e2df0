"""The curve, the cells, the cuts, and what readers can skip."""

from __future__ import annotations

import collections
import itertools
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from seriesengine.llm import sharding
from seriesengine.llm.oracle import ORACLE
from seriesengine.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("dimensions", "bits"), [(1, 5), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_and_moves_one_step(spark, dimensions, bits):
    side = 1 << bits
    cells = [tuple(c) for c in itertools.product(range(side), repeat=dimensions)]
    names = [f"c{i}" for i in range(dimensions)]
    frame = spark.createDataFrame(cells, ", ".join(f"{n} long" for n in names))
    rows = frame.select("*", sharding.hilbert([F.col(n) for n in names], bits).alias("at")).collect()
    order = [r[:-1] for r in sorted(rows, key=lambda r: r["at"])]
    assert sorted(r["at"] for r in rows) == list(range(len(cells)))
    for one, two in itertools.pairwise(order):
        assert sum(abs(a - b) for a, b in zip(one, two, strict=True)) == 1


def test_sizes_rise_by_four_steps_a_doubling(spark):
    sizes = [*range(1, 70), 127, 128, 65_535, 65_536, 10**9]
    rows = spark.createDataFrame([(s,) for s in sizes], "size long").select(
        "size", sharding.size_code(F.col("size"), 6).alias("code")
    )
    for size, code in rows.collect():
        doublings = size.bit_length() - 1
        assert code == min(63, 4 * doublings + (4 * size >> doublings) - 4)


def test_names_get_codes_in_order(spark):
    names = [f"n{i:03}" for i in range(100)] + ["", "é", "😀", "Z"]
    docs = spark.createDataFrame([(n,) for n in names * 3] + [(None,)], "source string")
    for bits in (2, 6, 8):
        cuts = sharding.name_cuts(docs, "source", bits)
        assert len(cuts) == min(1 << bits, len(names))
        coded = docs.select("source", sharding.name_code(F.col("source"), cuts).alias("code")).distinct().collect()
        ordered = sorted(coded, key=lambda r: (r.source or "").encode())
        codes = [r.code for r in ordered]
        assert codes == sorted(codes) and set(codes) == {code for code, _ in cuts}
        spread = {n: i * (1 << bits) // len(names) for i, n in enumerate(sorted(names, key=str.encode))}
        assert all(r.code == spread[r.source or ""] for r in coded)
        held = collections.Counter(codes)
        assert max(held.values()) - min(held.values()) <= 2
    assert sharding.name_cuts(docs.limit(0), "source", 6) == []


def test_query_equals_its_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    found = collections.Counter(map(tuple, QUERIES["op12_sharding"](spark, FOLDER).collect()))
    assert found == collections.Counter(connection.execute(ORACLE["op12_sharding"]).fetchall())


def test_odd_documents_fill_even_shards(spark, odd_docs, no_docs):
    clashing = odd_docs.selectExpr("*", "1 AS shard", "'x' AS slot", "2 AS place", "3 AS id", "4 AS before", "5 AS curve")
    placed = sharding.sharded(clashing.repartition(5), shards=7)
    assert set(placed.columns) == set(clashing.columns) | {"size", "text_crc32", "curve", "law", "shard", "slot", "grown_shard"}
    rows = placed.collect()
    given = collections.Counter((r.doc_id, r.text, r.lang, r.source) for r in odd_docs.collect())
    assert collections.Counter((r.doc_id, r.text, r.lang, r.source) for r in rows) == given
    slots = collections.defaultdict(list)
    for r in rows:
        data = (r.text or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(7))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1
    in_order = sorted(rows, key=lambda r: (r.shard, r.slot))
    curve = [(r.curve, r.text_crc32, r.doc_id is None, r.doc_id or 0) for r in in_order]
    assert curve == sorted(curve)
    assert sharding.sharded(no_docs).collect() == []
    few = sharding.sharded(odd_docs.limit(3)).collect()
    assert len({r.shard for r in few}) == 3 and {r.slot for r in few} == {0}


def test_files_are_runs_and_filters_skip_most(spark, tmp_path):
    """Shards written by the curve hold fewer values of every dimension than shards by id."""
    placed = sharding.sharded(spark.read.parquet(f"{FOLDER.replace('0.001', '0.01')}/documents.parquet"), shards=32)
    path = str(tmp_path / "shards")
    sharding.write(placed, path)
    back = spark.read.parquet(path)
    assert back.count() == 1000
    runs = back.withColumn("file", F.input_file_name()).groupBy("shard", "file")
    for r in runs.agg(F.min("slot").alias("low"), F.max("slot").alias("high"), F.count("*").alias("n")).collect():
        assert r.high - r.low + 1 == r.n
    by_id = back.withColumn("shard", F.floor(F.col("doc_id") * 32 / 1000))

    def touched(frame, column):
        """Mean share of the shards whose range of a column holds a value of it."""
        ranges = frame.groupBy("shard").agg(F.min(column).alias("low"), F.max(column).alias("high")).collect()
        values = [r[0] for r in frame.select(column).distinct().limit(50).collect()]
        return sum(r.low <= v <= r.high for r in ranges for v in values) / len(values) / len(ranges)

    for column in ("source", "lang", "size"):
        assert touched(back, column) < 0.75 * touched(by_id, column), column
    assert touched(back, "source") < 0.5 and touched(back, "size") < 0.5
