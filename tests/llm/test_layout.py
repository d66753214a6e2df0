"""Mixing, packing, token ids, training order and the pipeline."""

from __future__ import annotations

import collections
import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from seriesengine.llm import mixing, packing, training_order
from seriesengine.llm.queries import QUERIES
from seriesengine.llm.tokens import encoder

FOLDER = "/root/testdata/sf0.001"


def ids_of(text):
    return encoder()._full.encode(text or "", add_special_tokens=False).ids + [0]


TEXTS = [
    "", " ", "a", " a", "a ", "a  b", "two words", "x\n\ny z", "tab\t here", " \n ", "it's he'll  end ",
    "naïve 😀 emoji", "no break  em", "<|endoftext|> in text", "a <|endoftext|>b", "digits 12,345.67!",
    "\x1c sep \x85 next", "end\n",
]


def test_ids_equal_those_of_whole_texts():
    texts = TEXTS + [" ".join(TEXTS)]
    found = [x.tolist() + [0] for x in encoder().encode(pa.array(texts))]
    assert found == [ids_of(t) for t in texts]
    assert (encoder().sizes(pa.array(texts)) + 1).tolist() == [len(x) for x in found]
    assert len(encoder().sizes(pa.array([], pa.string()))) == 0


def test_differencing_balances_and_never_overflows():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 300):
        sizes = rng.integers(1, 513, n).tolist()
        window_of = packing.balanced_windows(sizes, 1024)
        filled = np.bincount(window_of, sizes)
        assert filled.max() <= 1024
        if n == 300:
            assert filled.sum() / (1024 * len(filled)) > 0.97
    assert packing.balanced_windows([], 10) == []
    assert packing.balanced_windows([10, 10, 1], 10) in ([0, 1, 2], [0, 2, 1], [1, 0, 2], [2, 1, 0], [1, 2, 0], [2, 0, 1])
    with pytest.raises(ValueError):
        packing.balanced_windows([11], 10)


def test_pieces_cover_every_document(spark, odd_docs):
    rows = packing.pack(odd_docs, capacity=64, with_ids=True).collect()
    texts = collections.Counter((r.doc_id, tuple(ids_of(r.text))) for r in odd_docs.collect())
    filled = collections.defaultdict(list)
    for r in rows:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        filled[r.sequence_id].append((r.offset, r.length))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    covered = collections.Counter()
    for r in rows:
        covered[r.doc_id, r.doc_tokens, r.start] += 1
    for (doc_id, ids), times in texts.items():
        for start, _ in packing.cuts(len(ids), 64):
            assert covered[doc_id, len(ids), start] >= times
    assert sum(r.length for r in rows) == sum(len(ids) * n for (_, ids), n in texts.items())


def test_packing_nothing(no_docs):
    assert packing.pack(no_docs).count() == 0


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else rest * weight[s] / free for s in names}
        over = {s for s in names if target[s] > 3 * sizes[s]}
        if not over - capped:
            return target
        capped |= over


def test_mix_meets_its_targets(spark, odd_docs):
    docs = odd_docs.unionByName(
        spark.createDataFrame([(900 + i, "tiny text", "t0") for i in range(2)], "doc_id long, text string, source string"),
        allowMissingColumns=True,
    )
    found = mixing.taken(docs).collect()
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    sources = {}
    for r in docs.collect():
        sizes[r.source] += len((r.text or "").encode().split())
        sources[r.doc_id] = r.source
    for r in found:
        assert 0 <= r.taken <= 3 * r.size
        if r.doc_id is not None:
            source = sources[r.doc_id]
            assert r.source_size == sizes[source]
            taken[source] += r.taken
            target[source] = r.target
    expected = plain_targets(sizes)
    assert target == pytest.approx(expected)
    for source, value in target.items():
        assert abs(taken[source] - value) <= 2 * mixing.BLOCK_WORDS + 0.01 * value
    again = mixing.taken(docs.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_mixed_texts_hold_what_is_taken(odd_docs, no_docs):
    numbers = collections.defaultdict(list)
    for r in mixing.taken(odd_docs).collect():
        numbers[r.doc_id].append(r.taken)
    out = mixing.mixed(odd_docs)
    assert out.columns == odd_docs.columns
    made = collections.defaultdict(list)
    for r in out.collect():
        made[r.doc_id].append(len(r.text.encode().split()))
        assert r.n_chars == len(r.text)
    assert {k: sorted(v) for k, v in made.items()} == {
        k: sorted(x for x in v if x) for k, v in numbers.items() if any(v)
    }
    assert mixing.taken(no_docs).count() == 0
    assert mixing.mixed(no_docs).count() == 0


def test_mix_deals_slots_to_shards(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 64)
    rows = [(i, " ".join(f"w{i}x{n}" for n in range(50 + i % 60)), f"s{i % 3}") for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    source = {i: s for i, _, s in rows}
    held, owner = collections.defaultdict(list), {}
    found = mixing.taken(docs).collect()
    for r in found:
        assert sum(p.words for p in r.places) == r.taken
        for p in r.places:
            assert p.shard == p.slot // 64
            assert 0 <= p.first and p.first + p.words <= r.size
            held[p.slot].append((p.at, p.words))
            assert owner.setdefault(p.slot, source[r.doc_id]) == source[r.doc_id]
    # Every slot is filled from its beginning, by one source, and by no more than a block.
    assert sorted(held) == list(range(len(held)))
    for filled in held.values():
        end = 0
        for at, words in sorted(filled):
            assert at == end
            end += words
        assert end <= mixing.BLOCK_WORDS
    counts = collections.Counter((slot // 64, s) for slot, s in owner.items())
    totals = collections.Counter(owner.values())
    full = len(held) // 64
    assert full > 4
    for shard in range(full):
        assert sum(counts[shard, s] for s in totals) == 64
        for s, n in totals.items():
            share = n / len(held)
            assert abs(counts[shard, s] - 64 * share) <= 5 * (64 * share * (1 - share)) ** 0.5
    assert len({tuple(counts[shard, s] for s in sorted(totals)) for shard in range(full)}) > 1
    out = mixing.mixed(docs, with_places=True)
    assert out.columns == [*docs.columns, "places"]
    assert {r.doc_id: r.places for r in out.collect()} == {r.doc_id: r.places for r in found if r.taken}


def test_shuffles_are_permutations(spark):
    for count in (1, 2, 3, 10, 1000):
        frame = spark.range(count).select(
            mixing.permuted(mixing.F.col("id"), mixing.F.lit(count), mixing.F.lit(5)).alias("p")
        )
        places = [r.p for r in frame.collect()]
        assert sorted(places) == list(range(count))
        assert count < 10 or places != list(range(count))


@pytest.mark.parametrize("count", [1, 2, 3, 5, 64, 1000, 4097])
def test_slots_are_a_permutation(count):
    slots = training_order.slots_of(np.arange(count), count, 3)
    assert sorted(slots.tolist()) == list(range(count))
    assert count < 64 or (slots != training_order.slots_of(np.arange(count), count, 4)).any()


def test_shards_round_trip(spark, odd_docs, no_docs, tmp_path):
    odd_docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    layout = training_order.Layout(length=16, per_shard=10)
    root = str(tmp_path / "shards")
    rows = sorted(training_order.materialise(docs, root, layout).collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(len(rows)))
    texts = collections.defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(ids_of(r.text))
    total = sum(len(ids) for group in texts.values() for ids in group)
    assert sum(r.length for r in rows) == total
    for r, own in zip(rows, training_order.read_sequences(root, 0, len(rows), layout), strict=True):
        assert (r.shard, r.byte_offset) == (r.slot // 10, r.slot % 10 * 32)
        part = own[: r.length].tolist()
        assert part in [ids[r.start : r.start + 16] for ids in texts[r.doc_id]]
        assert zlib.crc32(own[: r.length].tobytes()) == r.crc32
        assert (own[r.length :] == layout.pad).all()
    resumed = list(training_order.read_sequences(root, len(rows) - 3, 3, layout))
    assert len(resumed) == 3
    assert training_order.materialise(no_docs, str(tmp_path / "none"), layout).count() == 0


def test_pipeline_runs_on_odd_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, FOLDER).cache()
            docs.count()
            if name != "packing":
                assert docs.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES][-1] == "packing"


def test_pipeline_equals_its_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
    kept = {r.doc_id for r in docs.select("doc_id").collect()}
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in rows} == kept
    assert len(kept) == len({(r.doc_id) for r in rows})


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_query_covers_its_table(spark, name):
    found = QUERIES[name](spark, FOLDER)
    if "doc_id" in found.columns:
        documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
        assert found.select("doc_id").distinct().count() == documents.count()
    else:
        assert found.count() > 0
