"""Personal data in texts: patterns propose, checksums confirm, context adjusts.

Patterns propose spans of each kind. Card numbers are confirmed by the Luhn check,
account numbers by mod-97. A span's score starts at its kind's weight and rises if a
context word of the kind stands shortly before it. Addresses, cards and telephone
numbers are reported with any score; the weaker kinds need ``MIN_SCORE``.

Everything is a DataFrame function of one row: nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesengine.llm import spans
from seriesengine.llm.common import text_of

# The base kinds in their order, then those that the method adds.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")

# Patterns. A match may begin inside a run of its first class only where the match
# before it ended, and not at all if a match cannot end inside such a run; from anywhere
# else in the run it would go on in the same way.
_RUN = r"(?:\G|(?<![A-Za-z0-9._%+-]))"
EMAIL = _RUN + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

# Characters in front of a span that are searched for context words.
CONTEXT = 48
MIN_SCORE = 0.5
BOOST = 0.3
WEIGHT = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
WORDS = {
    "email": r"\b(?:e-?mail|mail|contact|write)\b",
    "ip": r"\b(?:ip|address|host|server)\b",
    "card": r"\b(?:card|credit|debit|visa|payment)\b",
    "phone": r"\b(?:phone|tel|telephone|call|mobile|fax)\b",
    "iban": r"\b(?:iban|account|bank|transfer)\b",
    "ssn": r"\b(?:ssn|social|security)\b",
}


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _small_parts(match: Column) -> Column:
    """Four numbers of at most 255, leading zeros allowed."""
    value = F.split(match, r"\.")
    return F.forall(value, lambda p: F.regexp_replace(p, "^0+", "").rlike("^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def _luhn(match: Column) -> Column:
    digits = _digits(match)
    return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)


def _mod97(match: Column) -> Column:
    """The number made of the rearranged characters, A as 10 to Z as 35, leaves 1."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    code = F.split(turned, "")
    rest = F.aggregate(
        F.transform(code, lambda c: F.when(c.rlike("[A-Z]"), F.ascii(c) - 55).otherwise(c.cast("int"))),
        F.lit(0),
        lambda r, v: (r * F.when(v > 9, 100).otherwise(10) + v) % 97,
    )
    return F.length(plain).between(15, 34) & (rest == 1)


def _scored(found: Column, kind: str) -> Column:
    def one(s: Column) -> Column:
        near = F.lower(s["before"]).rlike(WORDS[kind])
        score = F.least(F.lit(1.0), F.lit(WEIGHT[kind]) + F.when(near, F.lit(BOOST)).otherwise(F.lit(0.0)))
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                        s["match"].alias("match"), score.alias("score"))

    scored = F.transform(found, one)
    return scored if kind in BASE else F.filter(scored, lambda s: s["score"] >= MIN_SCORE)


def _proposals(text: Column) -> dict[str, Column]:
    yes = lambda match: F.lit(True)
    count = lambda match: F.length(_digits(match)).between(9, 15)
    none = F.array().cast(spans.FOUND)
    has = lambda mark, found: F.when(F.contains(text, F.lit(mark)), found).otherwise(none)
    return {
        "email": has("@", spans.find(text, EMAIL, "email", yes, CONTEXT)),
        "ip": spans.find(text, IP, "ip", _small_parts, CONTEXT),
        "card": spans.find(text, CARD, "card", _luhn, CONTEXT),
        "phone": has("+", spans.find(text, PHONE, "phone", count, CONTEXT)),
        "iban": spans.find(text, IBAN, "iban", _mod97, CONTEXT),
        "ssn": spans.find(text, SSN, "ssn", yes, CONTEXT),
    }


def personal_data(text: Column) -> Column:
    """Structs ``kind, start, end, match, score`` by kind as listed, then start."""
    found = _proposals(text)
    return F.concat(*[_scored(found[k], k) for k in KINDS])


def with_personal_data(docs: DataFrame, column: str = "pii") -> DataFrame:
    """All rows and columns of ``docs`` (``text``), and the spans as the array ``column``.

    A null or empty text has no spans (an empty array). Repeated rows get the same
    spans each; an empty table stays empty. A column of that name is replaced.
    """
    return docs.withColumn(column, personal_data(text_of(F.col("text"))))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each span replaced by its kind in angle brackets, ``n_chars`` renewed.

    Where spans overlap, the first names the whole. A text without spans stays as it
    is, null included. The columns and their order stay.
    """
    def mask(text: Column, found: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

        def step(state: Column, s: Column) -> Column:
            piece = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
            named = F.concat(state["out"], piece, F.lit("<"), F.upper(s["kind"]), F.lit(">"))
            return F.struct(
                F.greatest(state["at"], s["end"]).alias("at"),
                F.when(s["start"] >= state["at"], named).otherwise(state["out"]).alias("out"),
            )

        return F.aggregate(
            spans.in_order(found, KINDS, by_start=True),
            start,
            step,
            lambda state: F.concat(state["out"], F.substring(text, (state["at"] + 1).cast("int"), F.length(text))),
        )

    text = F.col("text")
    found = personal_data(text_of(text))
    masked = spans.let(
        F.struct(text.alias("text"), found.alias("found")),
        lambda v: F.when(F.size(v["found"]) > 0, mask(v["text"], v["found"])).otherwise(v["text"]),
    )
    out = docs.withColumn("text", masked)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
