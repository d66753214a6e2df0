"""Token ids of texts with a public byte-level BPE vocabulary.

Pre-tokens of this vocabulary never cross a single space that stands between two
other characters, so the ids of a text are those of its space-separated words,
each with its leading space. Only the distinct words of some texts are encoded, in one
call, and gathered by arrays. Texts in which a space touches other white space, or which
spell a special token, are encoded as a whole.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Tokenizer

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

# Fixed value: the end of a document.
END_ID = 0

# Characters of text that are encoded together, unless one text alone is longer.
SLICE_CHARS = 8_000_000


class _Words(NamedTuple):
    """Ids of words one after the other, and where each word's begin and how many they are."""

    ids: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray


class Encoder:
    """Ids of one vocabulary, given as a tokenizer file and the same one as ranks."""

    def __init__(self, vocabulary: str, ranks: str) -> None:
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encoding = tiktoken.Encoding(
            "plain",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=merges,
            special_tokens={},
        )
        self._plain = encoding.encode_ordinary
        self._sizes = np.zeros(max(merges.values()) + 1, np.int64)
        for token, i in merges.items():
            self._sizes[i] = len(token)
        self._full = Tokenizer.from_file(vocabulary)
        self._specials = [t.content for t in self._full.get_added_tokens_decoder().values()]
        self._special = re.compile("|".join(map(re.escape, self._specials)) or r"(?!)")

    def whole(self, text: str) -> bytes:
        """Little-endian 32-bit ids of a text, encoded in one go."""
        if self._special.search(text):
            return array("I", self._full.encode(text, add_special_tokens=False).ids).tobytes()
        return array("I", self._plain(text)).tobytes()

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, without ends; a null text has none."""
        for part in _slices(texts):
            index, first_word, words, whole = self._words_of(part)
            for i in range(len(part)):
                if whole[i]:
                    yield np.frombuffer(self.whole(part[i].as_py()), "<u4")
                    continue
                own = index[first_word[i] : first_word[i + 1]]
                size = words.sizes[own]
                end = np.cumsum(size)
                place = np.arange(end[-1]) + np.repeat(words.starts[own] - end + size, size)
                yield words.ids[place]

    def sizes(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text."""
        out = [np.zeros(0, np.int64)]
        for part in _slices(texts):
            index, first_word, words, whole = self._words_of(part)
            own = np.add.reduceat(words.sizes[index], first_word[:-1])
            for i in np.flatnonzero(whole):
                own[i] = len(self.whole(part[int(i)].as_py())) // 4
            out.append(own)
        return np.concatenate(out)

    def _odd(self, words: pa.Array) -> np.ndarray:
        """Which words cannot be encoded by themselves."""
        odd = pc.or_(pc.equal(words, ""), pc.not_equal(pc.utf8_trim_whitespace(words), words))
        for token in self._specials:
            odd = pc.or_(odd, pc.match_substring(words, token))
        return odd.to_numpy(zero_copy_only=False)

    def _encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that follow a space each, in one go, and the number of each word's.
        Every token ends in the word in which it begins."""
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        words = words.cast(pa.large_string())
        listed = pa.LargeListArray.from_arrays(pa.array([0, len(words)], pa.int64()), words)
        joined = pc.binary_join(listed, pa.scalar(" ", pa.large_string()))[0].as_py()
        ids = np.array(self._plain(" " + joined), np.uint32)
        edges = np.cumsum(pc.binary_length(words).to_numpy() + 1)
        stops = np.searchsorted(np.cumsum(self._sizes[ids]), edges, "right")
        return ids, np.diff(stops, prepend=0)

    def _words_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, _Words, np.ndarray]:
        """Words of the texts as places among encoded ones, the first word of each text, the
        encoded words, and which texts must be encoded as a whole."""
        split = pc.split_pattern(texts, " ")
        first_word = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])
        words = split.flatten().dictionary_encode()
        index = words.indices.to_numpy().astype(np.int64)
        known = words.dictionary
        odd = self._odd(known)
        odd_before = np.concatenate([[0], np.cumsum(odd[index])])
        whole = odd_before[first_word[1:]] > odd_before[first_word[:-1]]
        ids, plain_sizes = self._encoded(known.filter(pa.array(~odd)))
        sizes = np.zeros(len(known), np.int64)
        sizes[~odd] = plain_sizes
        # First words follow no space; each text has its own place for it.
        leads = known.take(pa.array(index[first_word[:-1]])).to_pylist()
        raw = [b"" if skip else self.whole(w) for w, skip in zip(leads, whole, strict=True)]
        index[first_word[:-1]] = len(known) + np.arange(len(texts))
        sizes = np.concatenate([sizes, np.fromiter(map(len, raw), np.int64, len(raw)) // 4])
        flat = np.concatenate([ids, np.frombuffer(b"".join(raw), "<u4")])
        return index, first_word, _Words(flat, np.cumsum(sizes) - sizes, sizes), whole


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Parts of a column of texts, null ones empty, of a bounded number of characters."""
    texts = pc.fill_null(texts, "")
    sizes = pc.utf8_length(texts).to_numpy()
    start = 0
    while start < len(texts):
        room = SLICE_CHARS - sizes[start]
        stop = start + 1 + int(np.searchsorted(np.cumsum(sizes[start + 1 :]), room))
        yield texts.slice(start, stop - start)
        start = stop


@lru_cache(maxsize=2)
def encoder(vocabulary: str = VOCABULARY, ranks: str = RANKS) -> Encoder:
    """The encoder of this process."""
    return Encoder(vocabulary, ranks)
