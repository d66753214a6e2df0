"""Mixing sources to target weights by fixed-length blocks.

The words of a source's documents, in a keyed order, form one stream that is cut into
blocks. Every source gets so many slots of the mix as its target asks for. A keyed
permutation of all slots deals them out to output shards, so a shard's counts per
source are multinomial draws, conditioned on the sources' totals: targets are met, not
merely expected. A source's slots are numbered; each run of as many slots as it has
blocks is mapped through a permutation of its own, so a block comes up again only when
all others have, and slots and blocks are joined by that index. What is taken keeps its
shard and slot: they are the layout of the output.

Permutations are swap-or-not shuffles, which act on any number of items and so need no
walk back into range. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesengine.llm import spans
from seriesengine.llm.common import WORD, text_of
from seriesengine.scratch import materialize

# Weights of the sources in their order, repeating, and the largest
# multiple of its size that a source may contribute.
WEIGHTS = (5, 2, 1)
MOST = 3

BLOCK_WORDS = 32
SHARD_SLOTS = 4096
KEY = 20250101

# Parts of a source whose positions are summed on their own; slots that one row makes.
PARTS = 1024
SLOT_RUN = 32768

MAX_TASKS = 20_000

ROUNDS = 16


def permuted(index: Column, count: Column, *key: Column) -> Column:
    """Place of ``index`` in a keyed permutation of ``count`` items (swap-or-not)."""

    def step(x: Column, r: Column) -> Column:
        turn = F.pmod(F.xxhash64(*key, r), count)
        partner = F.pmod(turn + count - x, count)
        return spans.let(
            F.struct(x.alias("x"), partner.alias("p")),
            lambda v: F.when(
                F.pmod(F.xxhash64(F.greatest(v["x"], v["p"]), r, *key), F.lit(2)) == 1, v["p"]
            ).otherwise(v["x"]),
        )

    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, index.cast("bigint"), step)


def _named(source: Column) -> Column:
    """A source as a key that is never null."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source))


def sources(rows: DataFrame) -> DataFrame:
    """``source_key, source_size, target, n_blocks, n_slots, first_slot`` of each source.

    One row per source. The targets share all sizes by weight; where a source would
    exceed its limit it gets the limit, and the others share the rest by weight. In the
    order of limit over weight this is one pass: the first source that need not be
    limited sets the share per weight, which falls again from there on.
    """
    sizes = rows.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy((F.col("source_key") == "-"), "source_key")
    place = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    weighed = sizes.select(
        "source_key",
        "source_size",
        F.element_at(F.array(*map(F.lit, WEIGHTS)), (place + 1).cast("int")).cast("double").alias("weight"),
        (F.col("source_size") * MOST).cast("double").alias("limit"),
    )
    rising = Window.orderBy(F.col("limit") / F.col("weight"), "source_key")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    here_on = rising.rowsBetween(0, Window.unboundedFollowing)
    everywhere = Window.partitionBy()
    shared = weighed.select(
        "*",
        (
            (F.sum("source_size").over(everywhere) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
            / F.sum("weight").over(here_on)
        ).alias("share"),
    )
    level = F.max(F.when(F.col("share") * F.col("weight") <= F.col("limit"), F.col("share"))).over(
        everywhere
    )
    target = F.least("limit", F.coalesce(level, F.lit(0.0)) * F.col("weight"))
    blocks = F.ceil(F.col("source_size") / F.lit(BLOCK_WORDS)).cast("bigint")
    slots = F.when(
        F.col("source_size") > 0,
        F.floor(F.col("n_blocks") * F.col("target") / F.col("source_size") + 0.5),
    ).otherwise(0).cast("bigint")
    return (
        shared.select("source_key", "source_size", target.alias("target"), blocks.alias("n_blocks"))
        .withColumn("n_slots", slots)
        .withColumn(
            "first_slot",
            F.coalesce(
                F.sum("n_slots").over(by_name.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        )
        .withColumn("all_slots", F.sum("n_slots").over(everywhere))
    )


def slots(of: DataFrame, key: int = KEY) -> DataFrame:
    """``shard, slot, source_key, block`` of the mix, one row per slot.

    The rows that stand for runs of slots are few and small; their number of tasks is
    set by the slots that they turn into.
    """
    total = of.agg(F.max("all_slots").alias("n")).first()["n"] or 0
    tasks = max(1, min(MAX_TASKS, total // SLOT_RUN))
    last_run = F.floor((F.col("n_slots") - 1) / SLOT_RUN)
    runs = of.filter("n_slots > 0").select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), last_run)).alias("run")
    )
    runs = runs.repartition(tasks, "source_key", "run")
    first = F.col("run") * SLOT_RUN
    numbered = runs.select(
        "*",
        F.explode(F.sequence(first, F.least(first + SLOT_RUN, "n_slots") - 1)).alias("number"),
    )
    place = permuted(F.col("first_slot") + F.col("number"), F.col("all_slots"), F.lit(key))
    block = permuted(
        F.col("number") % F.col("n_blocks"),
        F.col("n_blocks"),
        F.lit(key),
        F.col("source_key"),
        F.floor(F.col("number") / F.col("n_blocks")),
    )
    return numbered.select(place.alias("slot"), "source_key", block.alias("block")).select(
        F.floor(F.col("slot") / SHARD_SLOTS).alias("shard"), "slot", "source_key", "block"
    )


def keyed(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """Rows with a number of their own, written, so that the number stays.

    ``docs`` itself becomes the struct ``doc`` with ``with_text``.
    """
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0))
    columns = [
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        _named(F.col("source").cast("string")).alias("source_key"),
        size.cast("bigint").alias("size"),
    ]
    if with_text:
        columns.append(F.struct("*").alias("doc"))
    return materialize(docs.select(*columns), "mixing-rows")[0]


def pieces(rows: DataFrame, of: DataFrame, key: int = KEY) -> DataFrame:
    """``row, first, words, at, slots``: parts of documents and the slots that take them.

    ``first`` counts from 0 in the document, ``at`` in each of the slots; parts that are
    not taken are missing.
    """
    part = F.pmod(F.xxhash64("doc_id", F.lit(key)), F.lit(PARTS)).alias("part")
    slim = rows.filter("size > 0").select("row", "doc_id", "source_key", "size", part)
    totals = slim.groupBy("source_key", "part").agg(F.sum("size").alias("total"))
    parts = Window.partitionBy("source_key").orderBy("part")
    bases = totals.select(
        "source_key", "part", (F.sum("total").over(parts) - F.col("total")).alias("base")
    )
    inside = Window.partitionBy("source_key", "part").orderBy(
        F.xxhash64("doc_id", F.lit(key + 1)), "doc_id", "size", "row"
    )
    placed = slim.join(bases, ["source_key", "part"]).select(
        "row",
        "source_key",
        "size",
        (F.col("base") + F.sum("size").over(inside) - F.col("size")).alias("begin"),
    )
    end = F.col("begin") + F.col("size")
    first_block = F.floor(F.col("begin") / BLOCK_WORDS)
    cut = placed.select(
        "*", F.explode(F.sequence(first_block, F.floor((end - 1) / BLOCK_WORDS))).alias("block")
    )
    low = F.greatest(F.col("begin"), F.col("block") * BLOCK_WORDS)
    high = F.least(end, (F.col("block") + 1) * BLOCK_WORDS)
    cut = cut.select(
        "row",
        "source_key",
        "block",
        (low - F.col("begin")).alias("first"),
        (high - low).alias("words"),
        (low - F.col("block") * BLOCK_WORDS).alias("at"),
    )
    # No more slots than MOST and one by rounding take a block.
    takers = slots(of, key).groupBy("source_key", "block").agg(F.sort_array(F.collect_list("slot")).alias("slots"))
    # Both sides grow with the words, which the sizes of what they are made from hide.
    return cut.join(takers.hint("merge"), ["source_key", "block"]).select("row", "first", "words", "at", "slots")


def _places(parts: Column) -> Column:
    """``shard, slot, at, first, words`` of all that is taken of a document, by slot."""

    def of_part(p: Column) -> Column:
        return F.transform(
            p["slots"],
            lambda slot: F.struct(
                F.floor(slot / SHARD_SLOTS).alias("shard"),
                slot.alias("slot"),
                p["at"].alias("at"),
                p["first"].alias("first"),
                p["words"].alias("words"),
            ),
        )

    return F.sort_array(F.flatten(F.transform(parts, of_part)))


def _listed(rows: DataFrame, of: DataFrame, key: int) -> DataFrame:
    """``row, parts``: the pieces of each document, in its order."""
    return pieces(rows, of, key).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("first", "words", "at", "slots"))).alias("parts")
    )


def taken(docs: DataFrame, key: int = KEY) -> DataFrame:
    """``doc_id, size, source_size, target, taken, places`` of every row of ``docs``.

    ``docs`` needs ``doc_id``, ``text`` and ``source``; other columns are ignored. A
    null source is a source, the last; a null or empty text has size 0 and nothing is
    taken of it. Repeated rows are rows of their own. With no words at all, targets
    are 0. ``places`` lists the shard and slot of all that is taken, where it begins in
    the slot and in the document, and its words. Equal inputs give equal results.
    """
    rows = keyed(docs)
    of, _ = materialize(sources(rows), "mixing-sources")
    places = _listed(rows, of, key).select("row", _places(F.col("parts")).alias("places"))
    taken_words = F.aggregate("places", F.lit(0).cast("bigint"), lambda s, p: s + p["words"])
    places = places.withColumn("taken", taken_words)
    none = F.array().cast(places.schema["places"].dataType)
    return (
        rows.join(of.select("source_key", "source_size", "target"), "source_key")
        .join(places, "row", "left")
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).alias("taken"),
            F.coalesce("places", none).alias("places"),
        )
    )


def mixed(docs: DataFrame, key: int = KEY, with_places: bool = False) -> DataFrame:
    """Documents as the mix takes them, with the columns of ``docs``.

    A document of which nothing is taken is left out. One that is taken once as a
    whole keeps its text; of others, the text is what is taken, words joined by
    spaces, and what is taken again follows on a line of its own. ``n_chars``, where
    present, is renewed. ``with_places`` adds the column ``places`` of ``taken``, in
    place of one that is there.
    """
    rows = keyed(docs, with_text=True)
    of, _ = materialize(sources(rows), "mixing-sources")
    lists = _listed(rows, of, key)
    words = F.regexp_extract_all(F.col("doc.text").cast("string"), F.lit(WORD), F.lit(0))

    def passes(v: Column) -> Column:
        most = F.array_max(F.transform(v["parts"], lambda p: F.size(p["slots"]).cast("bigint")))

        def one(turn: Column) -> Column:
            again = F.filter(v["parts"], lambda p: F.size(p["slots"]) >= turn)
            return F.array_join(
                F.transform(
                    again,
                    lambda p: F.array_join(
                        F.slice(v["words"], (p["first"] + 1).cast("int"), p["words"].cast("int")), " "
                    ),
                ),
                " ",
            )

        return F.array_join(F.transform(F.sequence(F.lit(1).cast("bigint"), most), one), "\n")

    held = F.aggregate("parts", F.lit(0).cast("bigint"), lambda s, p: s + p["words"])
    once = (held == F.col("size")) & F.forall("parts", lambda p: F.size(p["slots"]) == 1)
    made = spans.let(F.struct(F.col("parts").alias("parts"), words.alias("words")), passes)
    text = F.when(once, F.col("doc.text").cast("string")).otherwise(made)
    out = rows.join(lists, "row").select("doc", text.alias("text"), _places(F.col("parts")).alias("places"))
    columns = []
    for field in docs.schema.fields:
        if with_places and field.name == "places":
            continue
        if field.name == "text":
            columns.append(F.col("text"))
        elif field.name == "n_chars":
            columns.append(F.length(text_of(F.col("text"))).cast(field.dataType).alias("n_chars"))
        else:
            columns.append(F.col("doc")[field.name].alias(field.name))
    if with_places:
        columns.append(F.col("places"))
    return out.select(*columns)
