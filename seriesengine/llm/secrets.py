"""Secret scans with an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content. The ledger
holds one row for each pair of blob and rule version that has been scanned, with its
findings, which may be none. A scan reads the contents whose pair is not in the
ledger, once each, appends their rows, and joins findings back to all paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesengine.llm import spans
from seriesengine.llm.common import text_of
from seriesengine.scratch import materialize

# The base kinds in their order, then those that the method adds.
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "jwt", "pem", "token")

_NAME = r"(?i:password|passwd|secret|token|api_?key)"
_LEAD = _NAME + r"[\x22']?\x20*[:=]\x20*[\x22']?"
ASSIGN = _LEAD + r"[A-Za-z0-9+/_.=-]++"
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"[0-9a-f]++"
JWT = r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{16,}+"
PEM = r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----"
TOKEN = r"(?:gh[pousr]_[A-Za-z0-9]{36,}+|xox[abprs]-[A-Za-z0-9-]{20,}+|sk_live_[A-Za-z0-9]{20,}+)"

# Names this set of rules; a changed set needs another name to be scanned for.
RULES = "rules-1"

# What the ledger keeps of a secret: never its text or what stands before it.
KEPT = "array<struct<kind:string,start:bigint,end:bigint,digest:string>>"
LEDGER = "rule_version string, blob string, findings " + KEPT


def _schema() -> T.StructType:
    return T.StructType.fromDDL(LEDGER)


def secrets(text: Column) -> Column:
    """Structs ``kind, start, end, match, before`` by start, then kind as listed."""
    at_least = lambda n: lambda match: F.length(match) >= n
    value = lambda match: F.length(F.regexp_replace(match, "^" + _LEAD, "")) >= 6
    # A run of hex digits that is too short is no match at all; only runs that are
    # long enough need positions.
    long_hex = r"(?:\G(?!^)|(?<![0-9a-f]))[0-9a-f]{24,}+"
    found = [
        spans.find(text, ASSIGN, "assign", value),
        spans.find(text, ACCESS, "access", at_least(20)),
        spans.find(text, long_hex, "hex", at_least(24)),
        spans.find(text, JWT, "jwt", at_least(1)),
        spans.find(text, PEM, "pem", at_least(1)),
        spans.find(text, TOKEN, "token", at_least(1)),
    ]
    return spans.in_order(F.concat(*found), KINDS, by_start=True)


def blob_of(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a ledger; a pair that was written twice, by a run that broke off, counts once."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(jvm_path):
        columns = [F.lit(None).cast(c.dataType).alias(c.name) for c in _schema()]
        return spark.range(0).select(*columns)
    return spark.read.schema(LEDGER).parquet(path).dropDuplicates(["rule_version", "blob"])


def kept(found: Column, key: str | None) -> Column:
    """Findings as the ledger keeps them. With a ``key`` a digest of key and secret tells
    whether two places hold the same one; without a key there is none."""

    def one(secret: Column) -> Column:
        digest = F.sha2(F.concat(F.lit(key), secret["match"]).cast("binary"), 256) if key else F.lit(None)
        return F.struct(
            secret["kind"].alias("kind"),
            secret["start"].alias("start"),
            secret["end"].alias("end"),
            digest.cast("string").alias("digest"),
        )

    return F.transform(found, one)


def scan(versions: DataFrame, ledger: str, rule_version: str = RULES, key: str | None = None) -> int:
    """Scan what the ledger lacks; returns the number of blobs scanned.

    The ledger keeps where secrets are, not what they are; ``key`` adds keyed digests.

    ``versions`` has ``content``, one row per version of a path; other columns are
    ignored. A null content is the empty blob. Contents that repeat are scanned once;
    with an empty table, or if all is known, nothing is appended.
    """
    spark = versions.sparkSession
    content = text_of(F.col("content"))
    blobs = versions.select(blob_of(content).alias("blob"), content.alias("content"))
    known = read_ledger(spark, ledger).filter(F.col("rule_version") == rule_version)
    unseen = blobs.join(known.select("blob"), "blob", "left_anti").dropDuplicates(["blob"])
    found, seen = materialize(
        unseen.select(
            F.lit(rule_version).alias("rule_version"), "blob", kept(secrets(F.col("content")), key).alias("findings")
        ),
        "secrets",
        blobs=F.count("*"),
    )
    if seen["blobs"]:
        found.write.mode("append").parquet(ledger)
    return seen["blobs"]


def findings(versions: DataFrame, ledger: str, rule_version: str = RULES) -> DataFrame:
    """All columns of ``versions`` but ``content``, with ``blob`` and ``findings``.

    Every version gets the findings of its blob, an empty array where there are none
    and null where the blob has not been scanned.
    """
    known = read_ledger(versions.sparkSession, ledger).filter(F.col("rule_version") == rule_version)
    rest = [versions[c] for c in versions.columns if c not in ("content", "blob", "findings")]
    paths = versions.select(*rest, blob_of(text_of(F.col("content"))).alias("blob"))
    return paths.join(known.select("blob", "findings"), "blob", "left")
