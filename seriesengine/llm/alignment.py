"""Alignment of two tokenizers' ids over the same bytes.

Both token streams of a text are cut where tokens of both end at the same byte. The
ends of each stream are the keys of a dictionary from end to index; the intersection
of the keys, sorted, slices both id lists into groups, and every slice is expanded
into links: the pairs of token occurrences whose byte ranges overlap.

Neither vocabulary has a token that crosses a single space between two other
characters, so both streams of a text are those of its space-separated words, each
with its leading space, and every word edge is a common end. The distinct words of
some texts are therefore aligned once, all of them as one stream. Texts in which a
space touches other white space, and texts with a word whose tokens do not spell it,
are aligned by themselves.

Links are judged by the corpus: the count of an id pair is the number of documents
that hold it linked. A document keeps its distinct pairs and how often it has them;
those rows are counted per pair and joined with the counts.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import count
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesengine.llm.common import text_of
from seriesengine.llm.tokens import RANKS, _slices
from seriesengine.scratch import materialize

PIECES = public_tokenizers.path("piece_bpe_32k.model")

# Counts of id pairs go to every executor up to this number of pairs (some 50 bytes
# each); above it Spark shuffles both sides of the join.
BROADCAST_PAIRS = 2_000_000

# Words that a worker remembers at most, the longest of them in characters, and the
# texts whose links it holds at a time.
_CACHED_WORDS = 150_000
_CACHED_CHARS = 48
_TEXTS = 1024

# Bits of the second id in the code of a pair.
_B_BITS = 32

_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
ROWS = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<struct<pair:long,times:int>>"
)
GROUPS = "doc_id long, groups array<struct<a:array<int>,b:array<int>,end:long>>"


class Cuts(NamedTuple):
    """Common ends of two streams, and how many tokens of each lie before them."""

    ends: np.ndarray
    a: np.ndarray
    b: np.ndarray


def common_cuts(a_ends: Sequence[int], b_ends: Sequence[int]) -> Cuts:
    """The offsets at which tokens of both streams end, in order."""
    a_index, b_index = dict(zip(a_ends, count(1))), dict(zip(b_ends, count(1)))
    ends = sorted(a_index.keys() & b_index.keys())
    places = ([index[end] for end in ends] for index in (a_index, b_index))
    return Cuts(np.array(ends, np.int64), *(np.array(p, np.int64) for p in places))


class Stream(NamedTuple):
    """Ids of both tokenizers over the same bytes, where they end, and the common ends."""

    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    cuts: Cuts

    def groups(self) -> list[dict]:
        """Ids of both sides between common ends, and the byte that ends them."""
        out, i, j = [], 0, 0
        for end, a, b in zip(*(c.tolist() for c in self.cuts), strict=True):
            out.append({"a": self.a[i:a].tolist(), "b": self.b[j:b].tolist(), "end": end})
            i, j = a, b
        return out

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the id pairs whose byte ranges overlap, and where each overlap ends.

        Between two neighbouring ends of either side lies one token of each, and the
        bytes that two tokens share are never cut by an end.
        """
        ends = np.union1d(self.a_ends, self.b_ends)
        a = self.a[np.searchsorted(self.a_ends, ends)]
        return a << _B_BITS | self.b[np.searchsorted(self.b_ends, ends)], ends


class _Units:
    """What is counted of words or texts: numbers, groups as text, codes of their links."""

    def __init__(self) -> None:
        self.numbers: list[tuple[int, ...]] = []
        self.groups: list[bytes] = []
        self.links: list[bytes] = []

    def cut(self, size: int) -> None:
        for column in (self.numbers, self.groups, self.links):
            del column[size:]


class Aligner:
    """Two vocabularies: the ranks of a byte-level one and the model file of a piece one."""

    def __init__(self, ranks: str, pieces: str) -> None:
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._a = tiktoken.Encoding(
            "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}
        )
        self._b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self._a_bytes = [b""] * (max(merges.values()) + 1)
        for token, i in merges.items():
            self._a_bytes[i] = token
        self._b_bytes = [self._spelled(i) for i in range(self._b.get_piece_size())]
        self._a_sizes = np.array([len(x) for x in self._a_bytes], np.int64)
        self._b_sizes = np.array([len(x) for x in self._b_bytes], np.int64)
        names = range(max(len(self._a_bytes), len(self._b_bytes)))
        self._names = {c: np.array([f"{i}{c}" for i in names], object) for c in ",|;"}
        self._known: dict[str, int] = {"": 0}
        self._units = _Units()
        self._add_nothing()

    def _add_nothing(self) -> None:
        """The first unit, of texts without tokens."""
        self._units.numbers.append((0, 0, 0, 0))
        self._units.groups.append(b"")
        self._units.links.append(b"")

    def _spelled(self, piece: int) -> bytes:
        text = self._b.id_to_piece(piece)
        return bytes([int(text[3:5], 16)]) if self._b.is_byte(piece) else text.replace("▁", " ").encode()

    def stream(self, text: str) -> Stream | None:
        """Both token streams of a text, or None if the tokens of one side do not spell it."""
        spelled = (" " + text).encode()
        a_ids, b_ids = self._a.encode_ordinary(" " + text), self._b.encode(text)
        if b"".join(map(self._a_bytes.__getitem__, a_ids)) != spelled:
            return None
        if b"".join(map(self._b_bytes.__getitem__, b_ids)) != spelled:
            return None
        a, b = np.array(a_ids, np.int64), np.array(b_ids, np.int64)
        a_ends, b_ends = np.cumsum(self._a_sizes[a]), np.cumsum(self._b_sizes[b])
        return Stream(a, b, a_ends, b_ends, common_cuts(a_ends.tolist(), b_ends.tolist()))

    def _named(self, stream: Stream) -> np.ndarray:
        """Every token as its id and the sign after it, in the order of the groups."""
        cuts, names = stream.cuts, self._names
        a_group = np.searchsorted(cuts.ends, stream.a_ends)
        b_group = np.searchsorted(cuts.ends, stream.b_ends)
        out = np.empty(len(stream.a) + len(stream.b), object)
        last = stream.a_ends == cuts.ends[a_group]
        before = np.concatenate([[0], cuts.b[:-1]])
        out[np.arange(len(stream.a)) + before[a_group]] = np.where(
            last, names["|"][stream.a], names[","][stream.a]
        )
        last = stream.b_ends == cuts.ends[b_group]
        out[np.arange(len(stream.b)) + cuts.a[b_group]] = np.where(
            last, names[";"][stream.b], names[","][stream.b]
        )
        return out

    def _add(self, words: list[str]) -> dict[str, int]:
        """Units of words that follow a space each, or of one text: the place of each."""
        if not words:
            return {}
        stream = self.stream(" ".join(words))
        if stream is None:
            if len(words) == 1:
                return {}
            spelled = [w for w in words if self.stream(w) is not None]
            return self._add(spelled) if len(spelled) < len(words) else {}
        edges = np.cumsum([len(w.encode()) + 1 for w in words])
        codes, link_ends = stream.links()
        n_a, n_b, n_groups, n_links = (
            np.searchsorted(ends, edges, "right")
            for ends in (stream.a_ends, stream.b_ends, stream.cuts.ends, link_ends)
        )
        numbers = np.stack([n_a, n_b, n_groups, n_links], 1)
        first = len(self._units.numbers)
        self._units.numbers += map(tuple, np.diff(numbers, axis=0, prepend=0).tolist())
        named, start = self._named(stream).tolist(), 0
        for stop in (n_a + n_b).tolist():
            self._units.groups.append("".join(named[start:stop])[:-1].encode())
            start = stop
        raw, start = codes.astype("<i8").tobytes(), 0
        for stop in (8 * n_links).tolist():
            self._units.links.append(raw[start:stop])
            start = stop
        return dict(zip(words, range(first, first + len(words)), strict=True))

    def units(self, texts: pa.Array) -> tuple[_Units, list[np.ndarray]]:
        """A store of units, and the places in it of each text's units in turn.

        The store also holds the words that are remembered from earlier texts; places
        are good until the next call.
        """
        self._units.cut(len(self._known))
        split = pc.split_pattern(texts, " ")
        first_word = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])
        words = split.flatten().dictionary_encode()
        index = words.indices.to_numpy().astype(np.int64)
        spelled = words.dictionary.to_pylist()
        fresh = [
            w for w in spelled if w not in self._known and not w[0].isspace() and not w[-1].isspace()
        ]
        room = max(0, _CACHED_WORDS - len(self._known))
        short = [w for w in fresh if len(w) <= _CACHED_CHARS]
        self._known |= self._add(short[:room])
        rows = self._add(short[room:] + [w for w in fresh if len(w) > _CACHED_CHARS])
        # The unit of an empty word is that of nothing, but a text that holds one beside
        # others has two spaces in a row and stays whole.
        row_of = np.array([self._known.get(w, rows.get(w, -1)) if w else -1 for w in spelled], np.int64)
        places = []
        for i, (start, stop) in enumerate(zip(first_word[:-1], first_word[1:], strict=True)):
            own = row_of[index[start:stop]]
            if own.min(initial=0) < 0:
                own = np.array([self._add([t]).get(t, 0) if (t := texts[i].as_py()) else 0])
            places.append(own)
        return self._units, places


@lru_cache(maxsize=2)
def aligner(ranks: str = RANKS, pieces: str = PIECES) -> Aligner:
    """The aligner of this process."""
    return Aligner(ranks, pieces)


def _aligned(doc_ids: pa.Array, texts: pa.Array, align: Aligner) -> pa.RecordBatch:
    """One row per text: counts, digest of the groups, distinct linked pairs."""
    store, places = align.units(texts)
    lengths = np.array([len(p) for p in places], np.int64)
    digests = []
    for own in places:
        joined = b";".join([store.groups[i] for i in own.tolist()])
        digests.append(hashlib.sha256(joined).hexdigest() if joined else "")
    units, flat = np.unique(np.concatenate(places), return_inverse=True)
    numbers = np.array([store.numbers[i] for i in units], np.int64)
    sums = np.add.reduceat(numbers[flat], np.cumsum(lengths) - lengths)
    columns = [doc_ids, *(pa.array(c) for c in sums.T), pa.array(digests, pa.string())]

    # Distinct (text, unit) with their number, expanded into (text, pair).
    doc_of = np.repeat(np.arange(len(places)), lengths)
    held, times = np.unique(doc_of * len(units) + flat, return_counts=True)
    doc, unit = np.divmod(held, len(units))
    sizes = numbers[:, _COUNTS.index("n_links")]
    codes, code_of = np.unique(
        np.frombuffer(b"".join([store.links[i] for i in units]), "<i8"), return_inverse=True
    )
    own = sizes[unit]
    ends = np.cumsum(own)
    link = np.arange(own.sum()) + np.repeat((np.cumsum(sizes) - sizes)[unit] - ends + own, own)
    keys = np.repeat(doc, own) * max(1, len(codes)) + code_of[link]
    held, place = np.unique(keys, return_inverse=True)
    total = np.bincount(place, np.repeat(times, own), len(held)).astype(np.int32)
    doc, code = np.divmod(held, max(1, len(codes)))
    offsets = np.searchsorted(doc, np.arange(len(places) + 1)).astype(np.int32)
    pairs = pa.StructArray.from_arrays(
        [pa.array(codes[code], pa.int64()), pa.array(total)], ["pair", "times"]
    )
    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pairs))
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", *_COUNTS, "groups_sha256", "pairs"])


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and texts of a batch, so many at a time that their links stay in memory."""
    for at in range(0, batch.num_rows, _TEXTS):
        ids, done = batch.column(0).slice(at, _TEXTS), 0
        for texts in _slices(batch.column(1).slice(at, _TEXTS)):
            yield ids.slice(done, len(texts)), texts
            done += len(texts)


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), text_of(F.col("text")).alias("text"))


def groups(docs: DataFrame, ranks: str = RANKS, pieces: str = PIECES) -> DataFrame:
    """``doc_id, groups``: ids of both tokenizers per group, and the byte where it ends.

    Bytes are those of a space and the text. A null or empty text, and one that the
    tokens of a side do not spell, has no groups.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(ranks, pieces)
        kind = pa.list_(
            pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("end", pa.int64())])
        )
        for batch in batches:
            for ids, texts in _parts(batch):
                streams = (align.stream(text) if text else None for text in texts.to_pylist())
                found = [stream.groups() if stream else [] for stream in streams]
                yield pa.RecordBatch.from_arrays([ids, pa.array(found, kind)], names=["doc_id", "groups"])

    return _source(docs).mapInArrow(rows, GROUPS)


def links(docs: DataFrame, ranks: str = RANKS, pieces: str = PIECES) -> DataFrame:
    """One row per document: numbers of tokens, groups and links, a digest of its groups,
    and ``pairs``: its distinct linked id pairs (first id above 32 bits) and how often each occurs."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(ranks, pieces)
        for batch in batches:
            for ids, texts in _parts(batch):
                yield _aligned(ids, texts, align)

    return _source(docs).mapInArrow(rows, ROWS)


def pair_counts(linked: DataFrame) -> DataFrame:
    """``pair, held, best``: in how many documents an id pair is linked, and whether no
    pair of its first id is linked in more."""
    counted = linked.select(F.inline("pairs")).groupBy("pair").agg(F.count("*").alias("held"))
    most = counted.groupBy(F.shiftright("pair", _B_BITS).alias("a")).agg(F.max("held").alias("most"))
    return (
        counted.withColumn("a", F.shiftright("pair", _B_BITS))
        .join(most, "a")
        .select("pair", "held", (F.col("held") == F.col("most")).alias("best"))
    )


def aligned(
    docs: DataFrame,
    ranks: str = RANKS,
    pieces: str = PIECES,
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """Every document's alignment, with its links judged by the whole corpus.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Returns
    ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``:
    ``count_sum`` adds the counts of a document's links, ``n_best`` counts those whose
    count is the highest of their first id, ties included. A null or empty text, and
    one that the tokens of a side do not spell, has zeros and an empty digest. Repeated
    rows are documents of their own, and a null ``doc_id`` stays null.
    """
    linked, _ = materialize(
        links(docs, ranks, pieces).withColumn("row", F.monotonically_increasing_id()), "links"
    )
    counts, seen = materialize(pair_counts(linked), "pair-counts", pairs=F.count("*"))
    if seen["pairs"] <= broadcast_pairs:
        counts = F.broadcast(counts)
    judged = (
        linked.select("row", F.inline("pairs"))
        .join(counts, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("held")).alias("count_sum"),
        )
    )
    zero = F.lit(0).cast("long")
    return linked.join(judged, "row", "left").select(
        "doc_id",
        *_COUNTS,
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )
