"""Near duplicates by SimHash and a byte-position inverted index.

Two 64-bit fingerprints that differ in at most ``d`` bits differ in at most ``d`` of
their 8 bytes, so they share at least ``8 - d`` positional bytes. The index lists
fingerprints under their positional bytes; the positions form blocks, and since at
most ``d`` blocks are touched, a pair that qualifies meets under at least one choice
of untouched blocks. For each pair that meets, the shared positional bytes are
tallied, pairs below the guaranteed minimum are dropped, and the rest is verified on
their bits.

A list that is long (one pattern common to very many fingerprints) is not expanded
into pairs. Fingerprints within ``d`` bits of each other have a common point within
half of ``d`` bits of one and the rest of the other, so its members are listed again
under all such points; the members of a point's list are few.

Only distinct fingerprints are indexed: copies of a text share one entry.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesengine.llm.common import text_of
from seriesengine.llm.components import components
from seriesengine.scratch import materialize

SHINGLE_WORDS = 3
MAX_BITS = 2

# Fingerprint width and the seed of the shingle hash.
BITS = 64
SEED = 42

# Positional bytes are grouped into this many blocks of neighbouring positions.
BLOCKS = 4

# Lists up to this length are expanded into pairs, longer ones through points.
LIST_LIMIT = 64


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """SimHash of a text: a bit is set if it is set in over half of the shingle hashes.

    A-Z are lower-cased; words are cut at ASCII white space; a text of fewer words
    than a shingle is one shingle; a text without words has the fingerprint zero.
    """
    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    if len(tokens) > words:
        starts, ends = starts[: 1 - words or None], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    spans = zip(starts.tolist(), ends.tolist(), strict=True)
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in spans), np.uint64, len(starts))
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes())


def fingerprint_of(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of a text, null as empty, as a signed 64-bit integer. Only texts go
    to the Python workers."""

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        values = [fingerprint(t.as_py(), words) for t in texts]
        return pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())

    return run(text_of(text))


def _byte(value: Column, position: int) -> Column:
    """Byte of a fingerprint, position 0 the lowest."""
    return F.shiftrightunsigned(value, 8 * position).bitwiseAND(255)


def _shared_bytes(left: Column, right: Column) -> Column:
    tally = F.lit(0)
    for position in range(BITS // 8):
        tally = tally + F.when(_byte(left, position) == _byte(right, position), 1).otherwise(0)
    return tally


def _mask(blocks: tuple[int, ...]) -> int:
    """Signed mask of the bits of some blocks."""
    width = BITS // BLOCKS
    value = sum(((1 << width) - 1) << (width * b) for b in blocks)
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def _bit(bit: int) -> int:
    """Signed value of one bit."""
    return -(1 << 63) if bit == 63 else 1 << bit


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints ``fp`` at most ``max_bits`` bits apart.

    Pairs of short lists are complete. A long list gives each member's link to the
    smallest member under each of its points, so linked classes are complete too.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the blocks and points are laid out for 0 to 2 bits")
    kept = BLOCKS - max_bits
    choices = list(combinations(range(BLOCKS), kept))
    postings = fingerprints.select(
        "fp",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("choice"),
                        F.col("fp").bitwiseAND(F.lit(_mask(c))).alias("pattern"),
                    )
                    for i, c in enumerate(choices)
                ]
            )
        ).alias("list"),
    ).select("fp", "list.choice", "list.pattern")
    sizes = postings.groupBy("choice", "pattern").agg(F.count("*").alias("size"))
    sized, _ = materialize(
        postings.join(sizes.filter("size > 1"), ["choice", "pattern"]), "simhash-lists"
    )

    short = sized.filter(F.col("size") <= LIST_LIMIT)
    left = short.select("choice", "pattern", F.col("fp").alias("a"))
    right = short.select("choice", "pattern", F.col("fp").alias("b"))
    least = BITS // 8 - max_bits
    pairs = (
        left.join(right, ["choice", "pattern"])
        .filter("a < b")
        .filter(_shared_bytes(F.col("a"), F.col("b")) >= least)
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
        .select("a", "b")
    )

    long = sized.filter(F.col("size") > LIST_LIMIT).select("fp").distinct()
    points = _points(long, max_bits)
    heads = points.groupBy("point", "bit").agg(F.min("fp").alias("a"), F.count("*").alias("n"))
    stars = (
        points.join(heads.filter("n > 1"), ["point", "bit"])
        .filter("fp <> a")
        .select("a", F.col("fp").alias("b"))
        .distinct()
    )
    return pairs.unionByName(stars)


def _points(fingerprints: DataFrame, max_bits: int) -> DataFrame:
    """``point, bit`` that two fingerprints share exactly if they are within ``max_bits``.

    For two bits: all fingerprints one bit away, and the fingerprint itself. For one:
    the fingerprint without one of its bits, and which bit that is.
    """
    if max_bits == 2:
        points = [(F.col("fp"), 0)]
        points += [(F.col("fp").bitwiseXOR(F.lit(_bit(b))), 0) for b in range(BITS)]
    elif max_bits == 1:
        points = [(F.col("fp").bitwiseAND(F.lit(~_bit(b))), b) for b in range(BITS)]
    else:
        points = [(F.col("fp"), 0)]
    listed = F.array(*[F.struct(p.alias("point"), F.lit(b).alias("bit")) for p, b in points])
    return fingerprints.select("fp", F.explode(listed).alias("at")).select("fp", "at.point", "at.bit")


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """``doc_id, fp, fingerprint, component_id, component`` of each row.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Rows are linked if
    their fingerprints differ in at most ``max_bits`` bits. ``fingerprint`` is ``fp`` as 16 hex digits; ``component_id`` is the
    smallest ``doc_id`` that can be reached, null ids aside; ``component`` is the
    smallest fingerprint that can be reached, which also names classes of null ids.
    Null and empty texts have the fingerprint zero and are linked like any other. A
    repeated row or id is a row of its own; an empty table gives an empty one.
    """
    fp = fingerprint_of(F.col("text"), words)
    rows, _ = materialize(docs.select(F.col("doc_id").cast("long"), fp.alias("fp")), "simhash")
    return _classes(rows, max_bits)


def _classes(rows: DataFrame, max_bits: int) -> DataFrame:
    """``near_duplicates`` of stored rows of ``doc_id, fp``."""
    owners, _ = materialize(
        rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "simhash-distinct"
    )
    labels = _labels(owners.select("fp"), max_bits)
    classes = owners.join(labels, "fp", "left").select(
        "fp", "doc_id", F.coalesce("component", "fp").alias("component")
    )
    smallest = classes.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = classes.select("fp", "component").join(smallest, "component")
    return rows.join(named, "fp").select(
        "doc_id",
        "fp",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "component",
    )


def _labels(fingerprints: DataFrame, max_bits: int) -> DataFrame:
    """``fp, component`` of the distinct fingerprints that are linked to others."""
    stored, _ = materialize(fingerprints, "simhash-fingerprints")
    labels = components(links(stored, max_bits))
    return labels.select(F.col("node").alias("fp"), "component")


def one_per_group(
    docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows of ``docs`` that stay: of each class the one with the smallest ``doc_id``.

    Null ids come last, and of rows that share the smallest id one with the smallest
    fingerprint stays. Rows are stored once beside their fingerprints; classes are found
    on those alone.
    """
    columns = [F.col("row")[c].alias(c) for c in docs.columns]
    fp = fingerprint_of(F.col("text"), words)
    rows, _ = materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            fp.alias("fp"),
            F.monotonically_increasing_id().alias("place"),
            F.struct("*").alias("row"),
        ),
        "simhash-rows",
    )
    labels = _labels(rows.select("fp").distinct(), max_bits)
    named = rows.select("doc_id", "fp", "place").join(labels, "fp", "left")
    first = F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "fp", "place"))
    stays = named.groupBy(F.coalesce("component", "fp").alias("component")).agg(first["place"].alias("place"))
    return rows.join(stays, "place", "left_semi").select(*columns)
