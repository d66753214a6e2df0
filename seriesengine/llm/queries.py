"""One query per operator of this package, over the whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesengine.llm import (
    alignment,
    fingerprints,
    hmm,
    mixing,
    neighbors,
    packing,
    pii,
    resampling,
    secrets,
    sharding,
    simhash,
    spans,
    toxicity,
    training_order,
)
from seriesengine.llm.common import table
from seriesengine.llm.oracle import ORACLE as ORACLE
from seriesengine.scratch import new_path

Query = Callable[[SparkSession, str], DataFrame]


def _digest(found: Column, base: tuple[str, ...]) -> list[Column]:
    """Counts of the base kinds, the digest of their spans, and all spans as text."""
    counts = [
        F.size(spans.of_kinds(found, (kind,))).cast("long").alias(f"n_{kind}") for kind in base
    ]
    digest = F.sha2(spans.listed(spans.of_kinds(found, base)), 256)
    return [*counts, digest.alias("base_sha256"), spans.listed(found).alias("spans")]


def op1_hmm(spark: SparkSession, folder: str) -> DataFrame:
    """Log10 probability of every document by a hidden Markov model."""
    return hmm.scores(table(spark, folder, "documents"))


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    found = pii.with_personal_data(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", *_digest(F.col("pii"), pii.BASE))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_neighbors(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest vectors of every vector whose id is divisible by 100."""
    return neighbors.nearest(table(spark, folder, "embeddings"))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.taken(table(spark, folder, "documents"))


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document, through a ledger that starts empty."""
    versions = table(spark, folder, "documents").select("doc_id", F.col("text").alias("content"))
    ledger = new_path(spark, "secret-ledger")
    secrets.scan(versions, ledger)
    found = F.coalesce("findings", F.array().cast(secrets.KEPT))
    return secrets.findings(versions, ledger).select("doc_id", *_digest(found, secrets.BASE))


def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.with_edited(table(spark, folder, "documents"))


def op9_training_order(spark: SparkSession, folder: str) -> DataFrame:
    """Slots and shard places of all documents' sequences, which are written as shards."""
    shards = new_path(spark, "training-order")
    return training_order.materialise(table(spark, folder, "documents"), shards)


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 ids."""
    return packing.pack(table(spark, folder, "documents"))


def op11_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Weights of all documents towards the benchmark, and the tenth that is drawn."""
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Places of all documents in eight shards along a Hilbert curve."""
    placed = sharding.sharded(table(spark, folder, "documents"))
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Alignment of two tokenizers over every document."""
    return alignment.aligned(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    "op1_hmm": op1_hmm,
    "op2_simhash": op2_simhash,
    "op3_pii": op3_pii,
    "op4_toxicity": op4_toxicity,
    "op5_neighbors": op5_neighbors,
    "op6_mixing": op6_mixing,
    "op7_secrets": op7_secrets,
    "op8_fingerprints": op8_fingerprints,
    "op9_training_order": op9_training_order,
    "op10_packing": op10_packing,
    "op11_resampling": op11_resampling,
    "op12_sharding": op12_sharding,
    "op13_alignment": op13_alignment,
}
