"""A hidden Markov language model of words, trained over partitions.

Words are emitted through classes: the most frequent words are classes of their own,
all others share a class by their last bytes, so the emission table has a fixed size
whatever the vocabulary. P(word | state) = P(class | state) * (c + 0.5) / M, where c is
the word's count in training and M the sum of (c + 0.5) over the class; each shared
class keeps 0.5 for words that training has not seen.

Counts of words are collected over all training texts. Baum-Welch counts are summed
per task in numpy and over tasks in Spark; every pass covers all training texts, and no
part of the model comes from a sample. Scores are exact: the scaled forward recursion
runs over the whole text.

Frequent words, at most ``head_words`` of them, go to all tasks; the others are joined
by word, and none of those is frequent enough to be hot.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesengine.llm.common import fold_of, text_of
from seriesengine.scratch import materialize

# Fixed value: the fold that is held out.
HELD_OUT = 1


@dataclass(frozen=True)
class Settings:
    """Sizes of the model and of the training.

    ``start_rounds`` and ``passes``: Baum-Welch passes, one after the other, the former to
    leave the random first model; each covers all training texts. ``segment``: tokens of a
    training sequence; longer texts are several sequences. ``start_tokens`` bounded texts of
    a sample that the start once came from; it may still be given and has no effect.
    """

    states: int = 8
    head_words: int = 1 << 18
    own_classes: int = 1 << 14
    shared_classes: int = 1 << 12
    suffix: int = 3
    passes: int = 2
    start_rounds: int = 12
    start_tokens: int = 20_000
    segment: int = 512
    smoothing: float = 200.0
    seed: int = 7


SETTINGS = Settings()

# Tokens whose recursions are held in memory at a time, in training.
_CHUNK_TOKENS = 1 << 18

# Tokens that are scored side by side; only one step of their recursions is held.
_SCORE_TOKENS = 1 << 23

# Texts whose words are held in memory at a time.
_ROWS = 2048

_LEVELS = 8


@dataclass
class Model:
    """Start, transition and class emission probabilities, and class masses ``M``."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # classes x states
    mass: np.ndarray


def words_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Lower-cased words of the texts in order, and the number of words of each text."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = split.flatten()
    lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    real = pc.greater(pc.binary_length(words), 0)
    counts = np.bincount(owner[real.to_numpy(zero_copy_only=False)], minlength=len(texts))
    return words.filter(real).dictionary_encode(), counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(at, _ROWS)
            words, counts = words_of(batch.column(1))
            index = words.indices.to_numpy()
            trains = np.repeat(~batch.column(0).to_numpy(zero_copy_only=False), counts)
            size = len(words.dictionary)
            yield pa.RecordBatch.from_arrays(
                [
                    words.dictionary,
                    pa.array(np.bincount(index[trains], minlength=size).astype(np.int64)),
                    pa.array(np.bincount(index, minlength=size).astype(np.int64)),
                ],
                names=["word", "n_train", "n_all"],
            )


@dataclass
class Runs:
    """Sequences as runs of one array of codes, longest first; ``order``: their old places."""

    codes: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    order: np.ndarray

    @classmethod
    def of(cls, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Runs:
        order = np.argsort(-sizes, kind="stable")
        return cls(codes, starts[order], sizes[order], order)

    @classmethod
    def of_arrays(cls, sequences: list[np.ndarray]) -> Runs:
        sizes = np.array([len(s) for s in sequences], np.int64)
        codes = np.concatenate(sequences) if sequences else np.zeros(0, "<u2")
        return cls.of(codes, np.cumsum(sizes) - sizes, sizes)

    @classmethod
    def of_texts(cls, texts: pa.Array, segment: int | None = None) -> Runs:
        """Runs of a column of encoded texts, cut into segments if ``segment`` is given."""
        if not len(texts):
            return cls.of_arrays([])
        texts = texts.cast(pa.large_binary())
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] // 2
        codes = np.frombuffer(data, "<u2", count=ends[-1])
        starts, sizes = ends[:-1], np.diff(ends)
        if segment:
            parts = -(-sizes // segment)
            number = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            stops = np.repeat(ends[1:], parts)
            starts = np.repeat(starts, parts) + number * segment
            sizes = np.minimum(stops - starts, segment)
        return cls.of(codes, starts, sizes)

    def chunks(self, tokens: int) -> Iterator[Runs]:
        """Neighbours of at most ``tokens`` tokens together, or one longer sequence."""
        ends = np.cumsum(self.sizes)
        at = 0
        while at < len(ends):
            before = ends[at] - self.sizes[at]
            stop = max(at + 1, int(np.searchsorted(ends, before + tokens, side="right")))
            yield Runs(self.codes, self.starts[at:stop], self.sizes[at:stop], self.order[at:stop])
            at = stop

    def active(self) -> list[int]:
        """The number of sequences at each step."""
        return np.searchsorted(-self.sizes, -np.arange(self.sizes[0]), side="left").tolist()


def log_likelihoods(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Natural log of P(class sequence) of each, by the scaled forward recursion."""
    return _log_likelihoods(model, Runs.of_arrays(sequences))


def _log_likelihoods(model: Model, runs: Runs) -> np.ndarray:
    out = np.zeros(len(runs.sizes))
    ones = np.ones((len(model.start), len(model.start)))
    for chunk in runs.chunks(_SCORE_TOKENS):
        total = np.zeros(len(chunk.sizes))
        alpha = None
        for step, n in enumerate(chunk.active()):
            emitted = model.emit.take(chunk.codes.take(chunk.starts[:n] + step), axis=0)
            alpha = emitted * (model.start if alpha is None else alpha[:n] @ model.move)
            scale = alpha @ ones
            alpha /= scale
            total[:n] += np.log(scale[:, 0])
        out[chunk.order] = total
    return out


class Counts:
    """Expected counts of starts, moves and emissions."""

    def __init__(self, classes: int, states: int) -> None:
        self.start = np.zeros(states)
        self.move = np.zeros((states, states))
        self.emit = np.zeros((classes, states))
        self.log_likelihood = 0.0
        # Used again by every chunk: fresh memory costs more than what is computed in it.
        self._room = np.empty((2, 0, states))

    def add(self, model: Model, sequences: list[np.ndarray]) -> None:
        self.add_runs(model, Runs.of_arrays(sequences))

    def add_runs(self, model: Model, runs: Runs) -> None:
        for chunk in runs.chunks(_CHUNK_TOKENS):
            self._add_chunk(model, chunk)

    def _add_chunk(self, model: Model, runs: Runs) -> None:
        tokens, k = int(runs.sizes.sum()), len(model.start)
        if tokens > self._room.shape[1]:
            self._room = np.empty((2, max(tokens, _CHUNK_TOKENS), k))
        alphas, emitted = self._room[:, :tokens]
        codes = np.empty(tokens, np.intp)
        active = runs.active()
        begins = (np.cumsum(active) - active).tolist()
        # A sum over states that comes once per state is divided by without broadcasting.
        ones = np.ones((k, k))
        alpha = None
        for step, (at, n) in enumerate(zip(begins, active, strict=True)):
            code = codes[at : at + n]
            code[:] = runs.codes.take(runs.starts[:n] + step)
            own = model.emit.take(code, axis=0, out=emitted[at : at + n], mode="clip")
            alpha = own * (model.start if alpha is None else alpha[:n] @ model.move)
            scale = alpha @ ones
            own /= scale
            alpha = np.divide(alpha, scale, out=alphas[at : at + n])
            self.log_likelihood += float(np.log(scale[:, 0]).sum())

        back = model.move.T.copy()
        moved = np.zeros_like(model.move)
        beta = np.ones((0, k))
        for step in range(len(active) - 1, -1, -1):
            at, n, longer = begins[step], active[step], len(beta)
            # The alphas are not needed any more: they become the state posteriors.
            alphas[at : at + longer] *= beta
            if step:
                weighted = emitted[at : at + n]
                weighted[:longer] *= beta
                moved += alphas[begins[step - 1] :][:n].T @ weighted
                beta = weighted @ back
        self.move += moved * model.move
        self.start += alphas[: active[0]].sum(axis=0)
        by_state = emitted.reshape(k, tokens)
        by_state[:] = alphas.T
        for state, posterior in enumerate(by_state):
            self.emit[:, state] += np.bincount(codes, posterior, len(self.emit))


def reestimated(model: Model, counts: Counts, smoothing: float) -> Model:
    """The next model: counts, smoothed by the class masses and a little of everything."""
    overall = model.mass / model.mass.sum()
    emit = counts.emit + smoothing * overall[:, None]
    move = counts.move + 1.0
    start = counts.start + 1.0
    return Model(
        start / start.sum(),
        move / move.sum(axis=1, keepdims=True),
        emit / emit.sum(axis=0, keepdims=True),
        model.mass,
    )


def first_model(mass: np.ndarray, settings: Settings) -> Model:
    """States that stay, with class probabilities shaken apart."""
    random = np.random.default_rng(settings.seed)
    k = settings.states
    overall = mass / mass.sum()
    emit = overall[:, None] * np.exp(0.5 * random.standard_normal((len(mass), k)))
    move = np.full((k, k), 0.2 / k) + 0.8 * np.eye(k)
    return Model(np.full(k, 1 / k), move, emit / emit.sum(axis=0), mass)


def _pass_over(encoded: DataFrame, model: Model, settings: Settings) -> Counts:
    """Baum-Welch counts of all training texts."""
    k, classes = settings.states, len(model.mass)
    names = [f"v{i}" for i in range(k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(classes, k)
        for batch in batches:
            counts.add_runs(model, Runs.of_texts(batch.column(0), settings.segment))
        used = np.flatnonzero(counts.emit.any(axis=1))
        scale = np.zeros(k)
        scale[0] = counts.log_likelihood
        values = np.concatenate([counts.emit[used], counts.start[None], scale[None], counts.move])
        keys = np.concatenate([used, [-1, -2], -3 - np.arange(k)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.astype(np.int32))] + [pa.array(values[:, i].copy()) for i in range(k)],
            names=["key", *names],
        )

    schema = "key int, " + ", ".join(f"{n} double" for n in names)
    summed = (
        encoded.filter("NOT held_out")
        .select("codes")
        .mapInArrow(run, schema)
        .groupBy("key")
        .agg(*[F.sum(n).alias(n) for n in names])
        .toArrow()
    )
    keys = summed.column("key").to_numpy()
    values = np.stack([summed.column(n).to_numpy() for n in names], axis=1)
    counts = Counts(classes, k)
    counts.emit[keys[keys >= 0]] = values[keys >= 0]
    counts.start += values[keys == -1].sum(axis=0)
    for key, row in zip(keys[keys < -2], values[keys < -2], strict=True):
        counts.move[-3 - key] = row
    counts.log_likelihood = float(values[keys == -2].sum())
    return counts


def scores(docs: DataFrame, settings: Settings = SETTINGS) -> DataFrame:
    """Scores of every row of ``docs`` (``doc_id, text``) by a model of its training rows.

    Columns: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``;
    scores are log10 probabilities, the base that of smoothed word frequencies. A text
    is its words and one end. A null text is empty: one end. A null id trains. Repeated
    rows count and are scored as often as they occur; an empty table gives no rows;
    without training rows every word is unknown.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (fold_of(F.col("doc_id")) == HELD_OUT).alias("held_out"),
        text_of(F.col("text")).alias("text"),
    )
    train_docs = docs.select(fold_of(F.col("doc_id")).alias("fold")).filter(F.col("fold") != HELD_OUT).count()
    level = F.floor(F.log2(F.col("n_all").cast("double")) * _LEVELS).cast("int")
    counts, seen = materialize(
        rows.select("held_out", "text")
        .mapInArrow(_count, "word string, n_train long, n_all long")
        .groupBy("word")
        .agg(F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all"))
        .withColumn("level", level),
        "lm-counts",
        tokens=F.sum("n_train"),
        words=F.sum((F.col("n_train") > 0).cast("long")),
    )
    train_tokens = (seen["tokens"] or 0) + train_docs
    known_words = (seen["words"] or 0) + (train_docs > 0)
    log_total = float(np.log10(train_tokens + 0.5 * (known_words + 1)))

    # The head: the most frequent words, all of a level or none.
    levels = {r["level"]: r["count"] for r in counts.groupBy("level").count().collect()}
    least, held = max(levels, default=0) + 1, 0
    while least - 1 in range(0, least) and held + levels.get(least - 1, 0) <= settings.head_words:
        least -= 1
        held += levels.get(least, 0)
    head = counts.filter(F.col("level") >= least).select("word", "n_train").toArrow()
    head_words = head.column("word").to_pylist()
    head_counts = head.column("n_train").to_numpy()
    model, class_of = _classes(counts, head_words, head_counts, train_docs, settings)
    end_class, suffix = settings.own_classes, settings.suffix
    shared = settings.shared_classes
    head_table = {
        w: (class_of.get(w, -1), int(n)) for w, n in zip(head_words, head_counts.tolist(), strict=True)
    }
    sent = docs.sparkSession.sparkContext.broadcast(head_table)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                yield encode_part(batch.slice(at, _ROWS), table)

    def encode_part(batch: pa.RecordBatch, table: dict) -> pa.RecordBatch:
        words, n_words = words_of(batch.column(2))
        known = words.dictionary.to_pylist()
        found = [table.get(w) for w in known]
        codes_of = np.fromiter(
            (
                f[0] if f is not None and f[0] >= 0
                else end_class + 1 + zlib.crc32(w.encode()[-suffix:]) % shared
                for w, f in zip(known, found, strict=True)
            ),
            np.uint16,
            len(known),
        )
        in_head = np.fromiter((f is not None for f in found), bool, len(known))
        count_of = np.fromiter((f[1] if f is not None else 0 for f in found), np.int64, len(known))
        log_of = np.where(in_head, np.log10(count_of + 0.5), 0.0)
        index = words.indices.to_numpy().astype(np.int64)
        size = batch.num_rows
        owner = np.repeat(np.arange(size), n_words)
        head_log = np.bincount(owner, log_of[index], size)
        head_known = np.bincount(owner, count_of[index] > 0, size).astype(np.int64)

        ends = np.cumsum(n_words + 1)
        codes = np.full(ends[-1] if size else 0, end_class, "<u2")
        places = np.arange(len(index)) + owner
        codes[places] = codes_of[index]
        offsets = np.concatenate([[0], ends]).astype(np.int32) * 2
        binary = pa.Array.from_buffers(
            pa.binary(), size, [None, pa.py_buffer(offsets), pa.py_buffer(codes)]
        )

        rare = ~in_head[index]
        pairs, times = np.unique(owner[rare] * len(known) + index[rare], return_counts=True)
        per_row = np.bincount(pairs // max(len(known), 1), minlength=size)
        tail_offsets = pa.array(np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32))
        tail_words = words.dictionary.take(pa.array(pairs % max(len(known), 1)))
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(n_words + 1),
                pa.array(head_log),
                pa.array(head_known),
                binary,
                pa.ListArray.from_arrays(tail_offsets, tail_words),
                pa.ListArray.from_arrays(tail_offsets, pa.array(times.astype(np.int64))),
            ],
            names=["doc_id", "held_out", "n_tokens", "head_log", "head_known", "codes", "tail", "times"],
        )

    encoded, _ = materialize(
        rows.mapInArrow(
            encode,
            "doc_id long, held_out boolean, n_tokens long, head_log double, head_known long, "
            "codes binary, tail array<string>, times array<long>",
        ).withColumn("row", F.monotonically_increasing_id()),
        "lm-encoded",
    )
    model = _trained(encoded, model, settings)

    # Emissions per unit of a class's mass; a word has c + 0.5 of them.
    shares = Model(model.start, model.move, model.emit / model.mass[:, None], model.mass)

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs = _log_likelihoods(shares, Runs.of_texts(batch.column(1))) / np.log(10)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(logs), *batch.columns[2:]],
                names=["row", "log_classes", "doc_id", "held_out", "n_tokens", "head_log", "head_known"],
            )

    passed = encoded.select("row", "codes", "doc_id", "held_out", "n_tokens", "head_log", "head_known").mapInArrow(
        forward,
        "row long, log_classes double, doc_id long, held_out boolean, n_tokens long, "
        "head_log double, head_known long",
    )
    tail = encoded.select("row", F.explode(F.arrays_zip("tail", "times")).alias("t")).select(
        "row", F.col("t.tail").alias("word"), F.col("t.times").alias("times")
    )
    rare = counts.filter(F.col("level") < least).select("word", "n_train")
    tail_sums = (
        tail.join(rare, "word")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.col("n_train") + 0.5)).alias("tail_log"),
            F.sum(F.when(F.col("n_train") > 0, F.col("times")).otherwise(0)).alias("tail_known"),
        )
    )
    end_log = float(np.log10(train_docs + 0.5))
    logs = F.col("head_log") + F.coalesce("tail_log", F.lit(0.0)) + F.lit(end_log)
    return passed.join(tail_sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0)) + int(train_docs > 0)).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * log_total).alias("base_score"),
        (logs + F.col("log_classes")).alias("score"),
    )


def _classes(
    counts: DataFrame, words: list[str], sizes: np.ndarray, ends: int, settings: Settings
) -> tuple[Model, dict[str, int]]:
    """A first model, and the classes of the words that have one of their own.

    Classes: own ones, the end of a text, shared ones.
    """
    order = sorted(range(len(words)), key=lambda i: (-sizes[i], words[i]))
    own = [i for i in order[: settings.own_classes] if sizes[i] > 0]
    suffix = F.substring(F.col("word").cast("binary"), -settings.suffix, settings.suffix)
    shared = (
        counts.filter("n_train > 0")
        .groupBy((F.crc32(suffix) % settings.shared_classes).cast("int").alias("class"))
        .agg(F.sum(F.col("n_train") + 0.5).alias("mass"))
        .collect()
    )
    mass = np.full(settings.own_classes + 1 + settings.shared_classes, 0.5)
    for r in shared:
        mass[settings.own_classes + 1 + r["class"]] += r["mass"]
    class_of = {}
    for number, i in enumerate(own):
        class_of[words[i]] = number
        mass[number] = sizes[i] + 0.5
        at = zlib.crc32(words[i].encode()[-settings.suffix :]) % settings.shared_classes
        mass[settings.own_classes + 1 + at] -= sizes[i] + 0.5
    mass[settings.own_classes] = ends + 0.5
    return first_model(mass, settings), class_of


def _trained(encoded: DataFrame, model: Model, settings: Settings) -> Model:
    """The model after all passes, each of which covers all training texts."""
    for _ in range(settings.start_rounds + settings.passes):
        model = reestimated(model, _pass_over(encoded, model, settings), settings.smoothing)
    return model
