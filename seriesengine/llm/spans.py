"""Positions of regular-expression matches in DataFrame functions.

``split`` by a pattern gives the texts between its matches and ``regexp_extract_all``
the matches; the lengths of both, in turn, are the positions. Patterns end groups
possessively where nothing can be given back, so long texts need no deep recursion.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

FOUND = "array<struct<kind:string,start:bigint,end:bigint,match:string,before:string>>"

# Lengths that are summed one by one; longer lists are summed block by block.
_BLOCK = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _total(items: Column) -> Column:
    return F.aggregate(items, F.lit(0).cast("bigint"), lambda s, x: s + x)


def running_sums(items: Column) -> Column:
    """Sums of an array of integers up to each element, that element included."""

    def of_blocks(v: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(v["items"]) - 1) / _BLOCK).cast("int"))
        sums = F.transform(
            blocks, lambda b: _total(F.slice(v["items"], b * _BLOCK + 1, F.lit(_BLOCK)))
        )
        return let(F.struct(v["items"].alias("items"), sums.alias("sums")), with_bases)

    def with_bases(v: Column) -> Column:
        bases = F.transform(v["sums"], lambda _, b: _total(F.slice(v["sums"], F.lit(1), b)))
        return let(F.struct(v["items"].alias("items"), bases.alias("bases")), ends)

    def ends(v: Column) -> Column:
        def end(_: Column, i: Column) -> Column:
            block = F.floor(i / _BLOCK).cast("int")
            own = F.slice(v["items"], block * _BLOCK + 1, i - block * _BLOCK + 1)
            return F.element_at(v["bases"], block + 1) + _total(own)

        return F.transform(v["items"], end)

    whole = let(F.struct(items.alias("items")), of_blocks)
    return F.when(F.size(items) > 0, whole).otherwise(F.array().cast("array<bigint>"))


def find(
    text: Column, pattern: str, kind: str, valid: Callable[[Column], Column], before: int = 0
) -> Column:
    """Structs ``kind, start, end, match, before`` of the leftmost matches of a pattern.

    Matches do not overlap; those that are not ``valid`` are dropped. Positions are
    code points, ends exclusive; ``before`` holds up to so many characters in front of
    the match, back to the match before it. Only texts with a match are split.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(v: Column) -> Column:
        gaps = F.split(v["text"], pattern, -1)
        pairs = F.zip_with(
            F.slice(gaps, F.lit(1), F.size(v["found"])),
            v["found"],
            lambda gap, match: F.struct(
                match.alias("match"),
                F.length(match).cast("bigint").alias("size"),
                (F.length(gap) + F.length(match)).cast("bigint").alias("step"),
                (F.right(gap, F.lit(before)) if before else F.lit("")).alias("before"),
            ),
        )
        return let(pairs, with_ends)

    def with_ends(pairs: Column) -> Column:
        ends = running_sums(F.transform(pairs, lambda p: p["step"]))
        spans = F.zip_with(
            pairs,
            ends,
            lambda p, end: F.struct(
                F.lit(kind).alias("kind"),
                (end - p["size"]).alias("start"),
                end.alias("end"),
                p["match"].alias("match"),
                p["before"].alias("before"),
            ),
        )
        return F.filter(spans, lambda s: valid(s["match"]))

    def of_found(v: Column) -> Column:
        return F.when(F.size(v["found"]) > 0, placed(v)).otherwise(F.array().cast(FOUND))

    return let(F.struct(text.alias("text"), found.alias("found")), of_found)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def of_kinds(spans: Column, kinds: tuple[str, ...]) -> Column:
    """The spans of some kinds, in their order."""
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def in_order(spans: Column, kinds: tuple[str, ...], by_start: bool) -> Column:
    """Spans by start and then kind as listed, or by kind as listed and then start."""
    ranked = F.transform(
        spans,
        lambda s: F.struct(
            *(
                [s["start"].alias("a"), F.array_position(F.lit(list(kinds)), s["kind"]).alias("b")]
                if by_start
                else [F.array_position(F.lit(list(kinds)), s["kind"]).alias("a"), s["start"].alias("b")]
            ),
            s.alias("span"),
        ),
    )
    return F.transform(F.sort_array(ranked), lambda r: r["span"])
