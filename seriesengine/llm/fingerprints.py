"""Document fingerprints by consistent weighted sampling.

A text is a vector of word counts. A count is cut into portions of weight 1; the k-th
portions of equal words face each other, so the sums of minima and maxima, and with them
the generalised Jaccard similarity, stay the same. Every portion is dealt to one of
``BINS`` bins by its hash. In each bin one portion is drawn by consistent weighted
sampling: with r and c from Gamma(2, 1) and b uniform, all derived from the portion's
hash, t = floor(ln w / r + b) and the smallest ln c - r (t - b + 1) wins; for weight 1 its
logarithm and with it t are 0. The word and portion that win are the bin's sample. Two
texts have equal samples in a bin with the generalised Jaccard similarity of that bin, so
the share of equal samples among the bins that either fills estimates it for all.

Only DataFrame functions are used. Words become rows that are counted, drawn and reduced
in generated code; texts are shuffled once, and all that follows groups by more columns
than they were dealt by, so words never are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesengine.llm.common import WORD, text_of
from seriesengine.llm.spans import let
from seriesengine.scratch import materialize

BINS = 64

# Rows that share a bucket when neighbours are looked up, and buckets at most.
BUCKET_ROWS = 2048
MAX_BUCKETS = 4096

# Layout of a draw: rank and, in the lowest bits, the identity of the portion.
_ID_BITS = 24
_RANK_BITS = 33
_RANK_STEPS = 1 << 26
_RANK_SHIFT = 50.0
_GROUP = 64


def _digits(bits: Column, part: int) -> Column:
    """A number between 0 and 2**21, ends excluded, from 21 of 63 bits."""
    own = F.shiftrightunsigned(bits, 21 * part) if part else bits
    return own.bitwiseAND(F.lit((1 << 21) - 1)) + F.lit(0.5)


def _gamma(bits: Column) -> Column:
    """A Gamma(2, 1) number: minus the log of two uniform ones."""
    return F.lit(42 * math.log(2)) - F.log(_digits(bits, 0) * _digits(bits, 1))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def samples(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, sample``: one row per bin that the ``words`` of a key's row fill.

    A sample is a bin and, in ``_ID_BITS`` bits below, the identity of what won it.
    ``rows`` must be dealt to tasks by some of the keys.
    """
    terms = (
        rows.select(*keys, F.explode("words").alias("word"))
        .groupBy(*keys, F.xxhash64("word").alias("h"))
        .agg(F.count("*").alias("copies"))
    )
    portions = terms.select(*keys, "h", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("k"))
    a, b = F.col("a"), F.col("b")
    beta = _digits(a, 2) / F.lit(float(1 << 21))
    rank = F.log(_gamma(b)) - _gamma(a) * (F.lit(1.0) - beta)
    steps = F.least(
        F.greatest(F.lit(0.0), (rank + _RANK_SHIFT) * _RANK_STEPS), F.lit(float((1 << _RANK_BITS) - 1))
    ).cast("bigint")
    own = F.shiftrightunsigned(a, 64 - _ID_BITS)
    drawn = portions.select(
        *keys, F.xxhash64("h", "k").alias("a"), F.xxhash64("k", "h").alias("b")
    ).select(
        *keys,
        F.shiftrightunsigned(b, 42).bitwiseAND(F.lit(BINS - 1)).cast("int").alias("bin"),
        F.shiftleft(steps, _ID_BITS).bitwiseOR(own).alias("draw"),
    )
    winner = F.min("draw").bitwiseAND((1 << _ID_BITS) - 1).cast("int")
    return (
        drawn.groupBy(*keys, "bin")
        .agg(winner.alias("winner"))
        .select(*keys, F.shiftleft("bin", _ID_BITS).bitwiseOR(F.col("winner")).alias("sample"))
    )


def likeness(left: Column, right: Column) -> Column:
    """Share of equal samples among the bins filled by either; 1 if neither fills any."""
    bins = lambda s: F.transform(s, lambda x: F.shiftrightunsigned(x, _ID_BITS))
    filled = F.size(F.array_union(bins(left), bins(right)))
    equal = F.size(F.array_intersect(left, right))
    return F.when(filled == 0, F.lit(1.0)).otherwise(equal / filled)


def as_text(sign: Column) -> Column:
    """Eight hex digits per sample: two of its bin, six of its identity."""
    return F.array_join(F.transform(sign, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def _listed(sample: Column) -> Column:
    return F.sort_array(F.collect_list(sample))


def _or_none(signature: str) -> Column:
    return F.coalesce(F.col(signature), F.array().cast("array<int>")).alias(signature)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text, signature, fingerprint`` of every row of ``docs``.

    A null text counts as empty and has an empty fingerprint. Repeated rows get equal
    fingerprints; other columns are ignored; an empty table stays empty.
    """
    rows, _ = materialize(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("bigint").alias("doc_id"),
            text_of(F.col("text")).alias("text"),
        ),
        "fingerprint-rows",
    )
    words = rows.select("row", "text").repartition("row").select("row", words_of(F.col("text")).alias("words"))
    signed = samples(words, ["row"]).groupBy("row").agg(_listed(F.col("sample")).alias("signature"))
    listed = rows.join(signed, "row", "left").select("doc_id", "text", _or_none("signature"))
    return listed.select("*", as_text(F.col("signature")).alias("fingerprint"))


def _bucket_of(doc_id: Column, cuts: list[int]) -> Column:
    """Number of cuts below an id; a null id is below all."""
    if not cuts:
        return F.lit(0)
    groups = [cuts[i : i + _GROUP] for i in range(0, len(cuts), _GROUP)]
    lasts = F.lit([g[-1] for g in groups]).cast("array<bigint>")
    listed = F.array(*[F.lit(g).cast("array<bigint>") for g in groups])
    group = F.size(F.filter(lasts, lambda c: c < doc_id))

    def inside(g: Column) -> Column:
        own = F.coalesce(F.get(listed, g), F.array().cast("array<bigint>"))
        return F.least(F.lit(len(cuts)), g * _GROUP + F.size(F.filter(own, lambda c: c < doc_id)))

    return F.coalesce(let(group, inside), F.lit(0))


def neighbours(docs: DataFrame) -> tuple[DataFrame, Window]:
    """Rows in buckets of falling ``doc_id``, with what follows each bucket, and their window.

    Bucket limits are ids of the table, so the row that follows a bucket is known by
    its id alone: it is listed a second time (``extra``) in the bucket above. The row
    with the largest id is listed again behind the smallest. Null ids come last; equal
    ids are in the order of their texts. Rows that share an id share a bucket.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of(F.col("text")).alias("text"))
    buckets = min(MAX_BUCKETS, docs.select("doc_id").count() // BUCKET_ROWS)
    shares = [i / (buckets + 1) for i in range(1, buckets + 1)] or [0.5]
    found = rows.agg(
        F.percentile_approx("doc_id", shares, 10_000).alias("cuts"), F.max("doc_id").alias("top")
    ).first()
    cuts = sorted({c for c in found["cuts"] or [] if c < found["top"]}) if buckets else []
    own = rows.select("*", _bucket_of(F.col("doc_id"), cuts).alias("bucket"), F.lit(0).alias("extra"))
    below = rows.filter(F.col("doc_id").isin(cuts)).select(
        "*", (_bucket_of(F.col("doc_id"), cuts) + 1).alias("bucket"), F.lit(1).alias("extra")
    )
    around = rows.filter(F.col("doc_id") == F.lit(found["top"])).select(
        "*", F.lit(0).alias("bucket"), F.lit(1).alias("extra")
    )
    window = Window.partitionBy("bucket").orderBy("extra", F.desc_nulls_last("doc_id"), "text")
    return own.unionByName(below).unionByName(around), window


def with_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likenesses.

    The edited text has the last third of the code points (rounded down) replaced by
    the first as many of the document that follows in falling order of ``doc_id``; the
    first follows the last. Null texts are empty; a lone document follows itself.
    Columns: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``.
    """
    rows, window = neighbours(docs)
    follows = F.coalesce(F.lead("text").over(window), F.first("text").over(window))
    third = F.floor(F.length("text") / 3).cast("int")
    placed = rows.select(
        "*",
        follows.alias("next"),
        third.alias("third"),
        F.row_number().over(window).alias("n"),
        F.count("*").over(Window.partitionBy("bucket")).cast("int").alias("last"),
    )
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.length("text") - F.col("third")),
        F.substring(F.col("next"), F.lit(1), F.col("third")),
    )
    edits = placed.select("doc_id", "bucket", "extra", "n", "last", "text", edited.alias("edited"))
    sides = F.array(words_of(F.col("text")), F.when(F.col("extra") == 0, words_of(F.col("edited"))))
    words = edits.select("bucket", "n", "last", F.posexplode(sides).alias("side", "words"))
    # A row's own samples also go to the row that it follows.
    before = F.when(F.col("n") == 1, F.col("last")).otherwise(F.col("n") - 1)
    to = lambda n, side: F.struct(n.alias("n"), F.lit(side).alias("side"))
    places = F.when(F.col("side") == 0, F.array(to(F.col("n"), 0), to(before, 2))).otherwise(
        F.array(to(F.col("n"), 1))
    )
    handed = samples(words, ["bucket", "n", "last", "side"]).select(
        "bucket", "sample", F.explode(places).alias("at")
    )
    names = ("sign", "edited_sign", "next_sign")
    signed = handed.groupBy("bucket", F.col("at.n").alias("n")).agg(
        *[_listed(F.when(F.col("at.side") == i, F.col("sample"))).alias(name) for i, name in enumerate(names)]
    )
    narrow = edits.filter("extra = 0").select(
        "bucket",
        "n",
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
    )
    both = narrow.join(signed, ["bucket", "n"], "left").select(
        "doc_id", "n_chars", "edited_sha256", *[_or_none(name) for name in names]
    )
    return both.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("sign")).alias("fingerprint"),
        as_text(F.col("edited_sign")).alias("edited_fingerprint"),
        likeness(F.col("sign"), F.col("edited_sign")).alias("near_edited"),
        likeness(F.col("sign"), F.col("next_sign")).alias("near_next"),
    )
