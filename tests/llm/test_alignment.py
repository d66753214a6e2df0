"""Alignment of two tokenizers against a plain version that looks at every byte."""

from __future__ import annotations

import collections
import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from seriesengine.llm import alignment
from seriesengine.llm.common import table
from seriesengine.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
PIECE = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
BYTE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
BYTE.encode_special_tokens = True

ODD = [
    "", " ", "a", " a", "a ", "a  b", "two words", "x\n\ny z", "tab\t here", "it's he'll  end ",
    "naïve 😀 emoji 😀", "no break  em", "<|endoftext|> in <s> text </s> <unk>", "a ▁ b", "a▁b c",
    "digits 12,345.67!", "\x1c sep \x85 next", "end\n", "nul \x00 byte", "<0x41> literal", "ﬁ ﬂ ½",
    "same same same", "日本語の文 テスト", "é é", "x" * 300,
]


def byte_decoder() -> dict[str, int]:
    """Printable stand-ins of bytes, by the public rule of byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


DECODER = byte_decoder()


def a_bytes(i: int) -> bytes:
    return bytes(DECODER[c] for c in BYTE.id_to_token(i))


def b_bytes(i: int) -> bytes:
    piece = PIECE.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if PIECE.is_byte(i) else piece.replace("▁", " ").encode()


def plain(text):
    """Group list as text, and the id pair of every two occurrences that share a byte."""
    if not text:
        return "", []
    spelled = (" " + text).encode()
    sides = []
    for ids, spell in (
        (BYTE.encode(" " + text, add_special_tokens=False).ids, a_bytes),
        (PIECE.encode(text), b_bytes),
    ):
        if b"".join(map(spell, ids)) != spelled:
            return "", []
        owner = [k for k, i in enumerate(ids) for _ in spell(i)]
        sides.append((ids, owner))
    (a, own_a), (b, own_b) = sides
    pairs = sorted(set(zip(own_a, own_b)))
    groups, i, j = [], 0, 0
    for at in range(len(spelled)):
        last = at + 1 == len(spelled)
        if last or (own_a[at] != own_a[at + 1] and own_b[at] != own_b[at + 1]):
            groups.append((a[i : own_a[at] + 1], b[j : own_b[at] + 1]))
            i, j = own_a[at] + 1, own_b[at] + 1
    named = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
    return named, [(a[x], b[y]) for x, y in pairs]


def expected(texts):
    found = [plain(t) for t in texts]
    held = collections.Counter(p for _, links in found for p in set(links))
    most = collections.defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    for named, links in found:
        ids = [g.split("|") for g in named.split(";")] if named else []
        yield (
            sum(len(a.split(",")) for a, _ in ids),
            sum(len(b.split(",")) for _, b in ids),
            len(ids),
            len(links),
            sum(held[p] == most[p[0]] for p in links),
            sum(held[p] for p in links),
            hashlib.sha256(named.encode()).hexdigest() if named else "",
        )


def check(rows, ids, texts):
    columns = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    ours = collections.Counter((r.doc_id, *(r[c] for c in columns)) for r in rows)
    assert ours == collections.Counter((i, *e) for i, e in zip(ids, expected(texts), strict=True))


@pytest.mark.parametrize("limit", [0, alignment.BROADCAST_PAIRS])
def test_equals_the_plain_version_on_odd_texts(spark, limit):
    texts = ODD + [" ".join(ODD), None, None, "two words", " ".join(ODD[5:9])]
    ids = [*range(len(texts) - 2), None, 3]
    docs = spark.createDataFrame(list(zip(ids, texts, ["x"] * len(ids))), "doc_id long, text string, pairs string")
    found = alignment.aligned(docs.repartition(3), broadcast_pairs=limit)
    check(found.collect(), ids, texts)
    joins = [line for line in found._jdf.queryExecution().toString().splitlines() if "Join" in line]
    assert any("Join" in line for line in joins)


def test_query_equals_the_plain_version(spark):
    docs = table(spark, FOLDER, "documents").select("doc_id", "text").collect()
    check(QUERIES["op13_alignment"](spark, FOLDER).collect(), [d[0] for d in docs], [d[1] for d in docs])


def test_words_in_a_full_cache_and_new_ones_agree(monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdeé😀", k=rng.randint(1, 9))) for _ in range(200)]
    texts = [" ".join(rng.choices(words, k=30)) for _ in range(60)]
    whole = alignment.Aligner(alignment.RANKS, alignment.PIECES)
    monkeypatch.setattr(alignment, "_CACHED_WORDS", 50)
    monkeypatch.setattr(alignment, "_CACHED_CHARS", 5)
    small = alignment.Aligner(alignment.RANKS, alignment.PIECES)
    for start in range(0, 60, 20):
        part = pa.array(texts[start : start + 20])
        ids = pa.array(range(20))
        one, two = (alignment._aligned(ids, part, aligner) for aligner in (whole, small))
        assert one.equals(two)
        assert len(small._known) <= 50
    assert [r["groups_sha256"] for r in one.to_pylist()] == [e[-1] for e in expected(texts[40:])]


def test_groups_hold_the_ids_between_common_ends(spark):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    for r in alignment.groups(docs).collect():
        named = ";".join(f"{','.join(map(str, g.a))}|{','.join(map(str, g.b))}" for g in r.groups)
        assert named == plain(ODD[r.doc_id])[0]
        spelled = b""
        for g in r.groups:
            spelled += b"".join(map(a_bytes, g.a))
            assert len(spelled) == g.end
        assert spelled in (b"", (" " + ODD[r.doc_id]).encode())


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    docs = odd_docs.collect()
    found = alignment.aligned(odd_docs).collect()
    check(found, [d.doc_id for d in docs], [d.text for d in docs])
    assert alignment.aligned(no_docs).collect() == []
    assert alignment.groups(no_docs).collect() == []
