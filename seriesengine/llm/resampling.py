"""Importance resampling of documents towards a target distribution.

Features are runs of words, hashed into buckets. How much more often the target uses
a bucket than the corpus is the bucket's gain, held in one array; a document's weight
is the sum of the gains of its features. Seeded Gumbel noise turns the largest scores
into a draw without replacement in proportion to the weights' exponentials.

The cutoff is found without sorting the corpus. A quantile sketch, taken while the
scores are written, brackets it; exact counts of the rows outside the bracket confirm
the bracket or widen it; only the bracket is sorted to find the last row drawn. Rows
above the bracket are sorted among themselves for their ranks.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesengine.llm.common import in_order, text_of
from seriesengine.llm.tokens import _slices
from seriesengine.scratch import materialize

# Texts whose words are held at a time.
_TEXTS = 1024

HASHED = "doc_id long, n_words long, n_features long, hashed array<struct<bucket:int,times:int>>"


@dataclass(frozen=True)
class Rules:
    """Features are runs of 1 to ``longest_run`` words, in ``buckets`` buckets; of the
    documents with ``min_words`` words ``percent`` in a hundred are drawn with noise of
    ``seed``. The sketch has ``steps`` quantiles and errs by a rank in ``accuracy``; the
    bracket starts at ``reach`` steps on either side of the cutoff."""

    longest_run: int = 1
    buckets: int = 10_000
    seed: int = 2024
    min_words: int = 20
    percent: int = 10
    steps: int = 400
    reach: int = 2
    accuracy: int = 10_000


RULES = Rules()


def _byte_table() -> np.ndarray:
    """Bytes of words as they are, A to Z in lower case, all other ASCII as spaces."""
    table = np.arange(256, dtype=np.uint8)
    upper = (table >= ord("A")) & (table <= ord("Z"))
    table[upper] += 32
    digit = (table >= ord("0")) & (table <= ord("9"))
    lower = (table >= ord("a")) & (table <= ord("z"))
    table[~(digit | lower | (table >= 128))] = ord(" ")
    return table


_BYTES = _byte_table()


def _spaced(texts: pa.Array) -> pa.Array:
    """The texts in lower case with a space for every byte outside words."""
    texts = pa.concat_arrays([texts.cast(pa.large_string())])
    _, offsets, data = texts.buffers()
    if data is None:
        return texts
    return pa.LargeStringArray.from_buffers(
        len(texts), offsets, pa.py_buffer(_BYTES[np.frombuffer(data, np.uint8)].tobytes())
    )


def hashed_features(texts: pa.Array, rules: Rules) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of each text the number of words, of features, and its buckets with their counts."""
    split = pc.split_pattern(_spaced(texts), " ")
    text_of_word = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
    words = split.flatten()
    real = pc.not_equal(words, "")
    words, text_of_word = words.filter(real), text_of_word[real.to_numpy(zero_copy_only=False)]
    n_words = np.bincount(text_of_word, minlength=len(texts))
    runs, owners = [words], [text_of_word]
    run = words
    for size in range(2, rules.longest_run + 1):
        keep = max(0, len(words) - size + 1)
        run = pc.binary_join_element_wise(run.slice(0, keep), words.slice(size - 1), pa.scalar(" ", words.type))
        within = text_of_word[:keep] == text_of_word[size - 1 :]
        runs.append(run.filter(pa.array(within)))
        owners.append(text_of_word[:keep][within])
    owner = np.concatenate(owners)
    features = pa.chunked_array(runs).combine_chunks().dictionary_encode()
    buckets = np.array(
        [zlib.crc32(f.encode()) % rules.buckets for f in features.dictionary.to_pylist()], np.int64
    )
    keys = owner * rules.buckets + buckets[features.indices.to_numpy()]
    held, times = np.unique(keys, return_counts=True)
    at, bucket = np.divmod(held, rules.buckets)
    offsets = np.searchsorted(at, np.arange(len(texts) + 1)).astype(np.int32)
    pairs = pa.StructArray.from_arrays(
        [pa.array(bucket.astype(np.int32)), pa.array(times.astype(np.int32))], ["bucket", "times"]
    )
    n_features = np.bincount(owner, minlength=len(texts))
    return n_words, n_features, pa.ListArray.from_arrays(pa.array(offsets), pairs)


def features(docs: DataFrame, rules: Rules = RULES, text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, hashed`` of every row of ``doc_id`` and a text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS):
                ids, done = batch.column(0).slice(at, _TEXTS), 0
                for texts in _slices(batch.column(1).slice(at, _TEXTS)):
                    n_words, n_features, hashed = hashed_features(texts, rules)
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(done, len(texts)), pa.array(n_words), pa.array(n_features), hashed],
                        names=["doc_id", "n_words", "n_features", "hashed"],
                    )
                    done += len(texts)

    source = docs.select(F.col("doc_id").cast("long"), text_of(F.col(text)).alias("text"))
    return source.mapInArrow(rows, HASHED)


def bucket_counts(hashed: DataFrame, rules: Rules = RULES) -> np.ndarray:
    """Features per bucket of all texts; there is one row per bucket at most."""
    counts = np.zeros(rules.buckets, np.int64)
    summed = hashed.select(F.inline("hashed")).groupBy("bucket").agg(F.sum("times").alias("times"))
    for bucket, times in summed.collect():
        counts[bucket] = times
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed bucket shares, rounded down."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weight(hashed: Column, gain: np.ndarray) -> Column:
    """Weight of a hashed document: the gains of its features, looked up in an array."""
    gains = F.from_json(F.lit(json.dumps(gain.tolist())), "array<bigint>")
    return F.aggregate(
        hashed,
        F.lit(0).cast("bigint"),
        lambda sum, pair: sum + F.element_at(gains, pair["bucket"] + 1) * pair["times"],
    )


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variate from a seed and an id, rounded down."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    head = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((head + 0.5) / 4294967296)))


def bracket(scored: DataFrame, sketch: list[int], drawn: int, rules: Rules) -> tuple[int | None, int | None, int]:
    """The least and greatest score (None: open) between which the last of ``drawn`` rows
    lies, and the exact number of rows above."""
    at = round(rules.steps * (1 - rules.percent / 100))
    below = above = rules.reach
    while True:
        low = sketch[at - below] if at - below >= 0 else None
        high = sketch[at + above] if at + above <= rules.steps else None
        score = F.col("score")
        over = F.count_if(score > high) if high is not None else F.lit(0)
        held = F.count_if(score >= low) if low is not None else F.count("*")
        over, held = scored.agg(over, held).first()
        if over < drawn <= held:
            return low, high, over
        below, above = (below, above * 4) if drawn <= over else (below * 4, above)


def resample(docs: DataFrame, target: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Every document's weight and score, and the rank of those that are drawn.

    ``docs`` needs ``doc_id`` and ``text``, ``target`` needs ``text``; other columns are
    ignored. Returns ``doc_id, n_features, weight, score, rank``. Null and empty texts
    have no features and weight 0; with an empty target all counts of the target are 0.
    Repeated rows are documents of their own with the same noise. A null ``doc_id`` has
    the noise of an empty one and comes last among ties, which go to smaller ids. Rows
    that tie in that too differ, if at all, in what is not returned.
    """
    hashed, _ = materialize(features(docs, rules), "features")
    texts = target.select(F.lit(0).alias("doc_id"), "text")
    gain = gains(bucket_counts(hashed, rules), bucket_counts(features(texts, rules), rules))
    drawable = F.col("n_words") >= rules.min_words
    sketch = F.percentile_approx(
        F.when(drawable, F.col("score")),
        F.array(*(F.lit(i / rules.steps) for i in range(rules.steps + 1))),
        rules.accuracy,
    )
    scored, seen = materialize(
        hashed.select("doc_id", "n_words", "n_features", weight(F.col("hashed"), gain).alias("weight")).withColumn(
            "score", F.col("weight") + noise(F.col("doc_id"), rules.seed)
        ),
        "scored",
        drawable=F.count_if(drawable),
        sketch=sketch,
    )
    columns = ("doc_id", "n_features", "weight", "score")
    drawn = seen["drawable"] * rules.percent // 100
    if not drawn:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    eligible = scored.filter(drawable)
    low, high, over = bracket(eligible, seen["sketch"], drawn, rules)
    keys = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features")]
    score, place = F.col("score"), F.col("place")
    above = F.lit(False) if high is None else score > high
    below = F.lit(False) if low is None else score < low
    parts = [scored.filter(~drawable | below).select(*columns, F.lit(None).cast("long").alias("rank"))]
    inside, _ = in_order(eligible.filter(~above & ~below).select(*columns), keys, "bracket", "place")
    rank = place + 1 + over
    parts.append(inside.select(*columns, F.when(rank <= drawn, rank).alias("rank")))
    if over:
        top, _ = in_order(eligible.filter(above).select(*columns), keys, "above", "place")
        parts.append(top.select(*columns, (place + 1).alias("rank")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def resampled(docs: DataFrame, target: DataFrame, rules: Rules = RULES) -> DataFrame:
    """The documents, with all their columns, whose id is drawn."""
    drawn = resample(docs, target, rules).filter("rank IS NOT NULL").select(F.col("doc_id").alias("drawn"))
    return docs.join(drawn, docs["doc_id"].cast("long").eqNullSafe(F.col("drawn")), "left_semi")
