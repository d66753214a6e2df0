"""SimHash classes, components and fingerprints against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from seriesengine.llm import fingerprints, simhash
from seriesengine.llm.components import components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(keys, linked):
    parent = {k: k for k in keys}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {k: find(k) for k in keys}


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


@pytest.mark.parametrize("bits", [0, 1, 2])
@pytest.mark.parametrize("limit", [1, 64])
def test_links_give_the_classes_of_all_pairs(spark, monkeypatch, bits, limit):
    monkeypatch.setattr(simhash, "LIST_LIMIT", limit)
    rng = random.Random(bits)
    prints = {rng.getrandbits(64) for _ in range(60)}
    base = rng.getrandbits(64)
    for _ in range(80):  # a crowded neighbourhood, with chains
        prints.add(base ^ sum(1 << rng.randrange(12) for _ in range(rng.randrange(4))))
    prints |= {p ^ (1 << 63) for p in list(prints)[:5]}
    expected = classes(
        {signed(p) for p in prints},
        [(signed(a), signed(b)) for a in prints for b in prints if (a ^ b).bit_count() <= bits],
    )
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    found = {r.node: r.component for r in components(simhash.links(frame, bits)).collect()}
    assert {p: found.get(p, p) for p in expected} == expected


def test_documents_get_fingerprint_and_smallest_id(odd_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    linked = classes(set(prints), [(a, b) for a in prints for b in prints if (a ^ b).bit_count() <= 2])
    smallest = {}
    for r, p in zip(rows, prints, strict=True):
        if r.doc_id is not None:
            smallest[linked[p]] = min(smallest.get(linked[p], r.doc_id), r.doc_id)
    expected = sorted(
        (str(r.doc_id), f"{p:016x}", str(smallest.get(linked[p]))) for r, p in zip(rows, prints, strict=True)
    )
    found = simhash.near_duplicates(odd_docs).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in found) == expected

    kept = simhash.one_per_group(odd_docs)
    assert kept.columns == odd_docs.columns
    kept = kept.collect()
    assert len(kept) == len({linked[p] for p in prints})
    assert {r.doc_id for r in kept if r.doc_id is not None} == set(smallest.values())


def test_no_documents(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.one_per_group(no_docs).count() == 0
    assert fingerprints.with_edited(no_docs).count() == 0


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 500), (300, 301)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    found = {r.node: r.component for r in found.collect()}
    assert found == {**dict.fromkeys(range(201), 0), 300: 300, 301: 300}


def plain_samples(text):
    """Bin and winner of each bin, word by word and copy by copy."""

    def hashed(*parts):
        seed = 42
        for part in parts:
            seed = xxhash.xxh64_intdigest(part, seed)
        return seed

    def digits(bits, part):
        return (bits >> 21 * part & (1 << 21) - 1) + 0.5

    def gamma(bits):
        return 42 * math.log(2) - math.log(digits(bits, 0) * digits(bits, 1))

    best = {}
    for word, n in collections.Counter(re.findall(r"[^\x20\x09-\x0D]+", text.lower())).items():
        h = hashed(word.encode()).to_bytes(8, "little")
        for k in range(1, n + 1):
            copy = k.to_bytes(8, "little")
            a, b = hashed(h, copy), hashed(copy, h)
            rank = math.log(gamma(b)) - gamma(a) * (1 - digits(a, 2) / (1 << 21))
            draw = int((rank + 50) * (1 << 26)) << 24 | a >> 40
            at = b >> 42 & 63
            best[at] = min(best.get(at, draw), draw)
    return {(at, draw & (1 << 24) - 1) for at, draw in best.items()}


def plain_likeness(a, b):
    filled = {at for at, _ in a | b}
    return len(a & b) / len(filled) if filled else 1.0


def as_text(samples):
    return "".join(f"{at << 24 | own:08x}" for at, own in sorted(samples))


@pytest.mark.parametrize("rows_per_bucket", [1, 7, 2048])
def test_edited_texts(spark, odd_docs, monkeypatch, rows_per_bucket):
    """Null and repeated ids take part: rows are in falling order of id, nulls last, then of text."""
    monkeypatch.setattr(fingerprints, "BUCKET_ROWS", rows_per_bucket)
    rows = [(r.doc_id, r.text or "") for r in odd_docs.select("doc_id", "text").collect()]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    expected = collections.Counter()
    signed = {text: plain_samples(text) for _, text in rows}
    for k, (doc_id, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        own, other, after = signed[text], plain_samples(edited), signed[following]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        near = plain_likeness(own, other), plain_likeness(own, after)
        expected[doc_id, len(text), digest, as_text(own), as_text(other), *near] += 1
    found = fingerprints.with_edited(odd_docs)
    assert collections.Counter(map(tuple, found.collect())) == expected


def test_one_document_follows_itself(spark):
    docs = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    row = fingerprints.with_edited(docs).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
    assert row.near_next == 1


def test_likeness_estimates_generalised_jaccard(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, truth = [], []
    for i in range(60):
        a = rng.choices(vocabulary[: 60 + i], k=150)
        b = a[: 2 * i] + rng.choices(vocabulary, k=150 - 2 * i)
        x, y = collections.Counter(a), collections.Counter(b)
        truth.append(sum((x & y).values()) / sum((x | y).values()))
        rows += [(2 * i, " ".join(a)), (2 * i + 1, " ".join(b))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    signed = fingerprints.fingerprints(docs).select("doc_id", "signature")
    left = signed.filter("doc_id % 2 = 0").selectExpr("doc_id", "signature AS a")
    right = signed.filter("doc_id % 2 = 1").selectExpr("doc_id - 1 AS doc_id", "signature AS b")
    near = fingerprints.likeness(F.col("a"), F.col("b"))
    found = [r.near for r in left.join(right, "doc_id").select("doc_id", near.alias("near")).orderBy("doc_id").collect()]
    errors = [f - t for f, t in zip(found, truth, strict=True)]
    assert abs(sum(errors) / len(errors)) < 0.02
    assert max(map(abs, errors)) < 0.25


def test_fingerprints_equal_the_plain_version(spark, odd_docs, no_docs):
    rows = fingerprints.fingerprints(odd_docs).collect()
    given = collections.Counter((r.doc_id, r.text or "") for r in odd_docs.collect())
    assert collections.Counter((r.doc_id, r.text) for r in rows) == given
    for r in rows:
        assert r.fingerprint == as_text(plain_samples(r.text))
    assert fingerprints.fingerprints(no_docs).collect() == []


def test_words_are_never_shuffled(spark, odd_docs):
    """The texts are dealt by bucket; what words become is only dealt as whole signatures."""
    plan = fingerprints.with_edited(odd_docs)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert len(dealt) >= 2
    assert all("#" in keys and "side" not in keys and not re.search(r"\bh#", keys) for keys in dealt)
