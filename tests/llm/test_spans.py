"""Personal data and secrets against Python's regular expressions."""

from __future__ import annotations

import random
import re

import pytest

from seriesengine.llm import pii, secrets, spans


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def plain_pii(text):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for kind, pattern in patterns.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and max(map(int, m.group().split("."))) > 255:
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def plain_secrets(text):
    patterns = {
        "assign": (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 6),
        "access": (r"AKIA[A-Z0-9]+", 0, 20),
        "hex": (r"[0-9a-f]+", 0, 24),
    }
    out = []
    for place, (kind, (pattern, group, least)) in enumerate(patterns.items()):
        for m in re.finditer(pattern, text or ""):
            if len(m.group(group)) >= least:
                out.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}"))
    return [x for *_, x in sorted(out)]


@pytest.fixture(scope="module")
def noisy(spark):
    """Texts made of the characters that the patterns are about."""
    rng = random.Random(3)
    atoms = [
        "a@b.cd", "x_y@z", ".com", "1.2.3.4", "256.", "4111 1111 1111 1111", "4111-1111-1111-1112",
        "+1 (743) 555-3824", "+49", " ", "-", "password", "Token", "=", ": ", '"', "'", "abcdef",
        "AKIA", "ABCDEFGH12345678", "deadbeef", "0123456789abcdef", "é", "😀", "\n", "api_key", "secret", "..", "@",
    ]
    rows = [(i, "".join(rng.choices(atoms, k=rng.randrange(40)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, "a@b.cd " * 3000), (1003, "12 " * 20_000), (1004, "deadbeef" * 9000)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_base_kinds_of_personal_data(noisy):
    found = pii.with_personal_data(noisy).select("text", spans.listed("pii").alias("spans")).collect()
    for row in found:
        base = [s for s in row.spans.split(",") if s.split(":")[0] in pii.BASE]
        assert base == plain_pii(row.text)


def test_base_kinds_of_secrets(spark, noisy, tmp_path):
    versions = noisy.withColumnRenamed("text", "content")
    ledger = str(tmp_path / "ledger")
    assert secrets.scan(versions, ledger) == versions.na.fill("").dropDuplicates(["content"]).count()
    found = secrets.findings(versions, ledger).join(versions, "doc_id")
    for row in found.select("content", spans.listed("findings").alias("spans")).collect():
        base = [s for s in row.spans.split(",") if s.split(":")[0] in secrets.BASE]
        assert base == plain_secrets(row.content)


def test_ledger_scans_only_what_is_new(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    first = spark.createDataFrame([("a", "token=abcdef"), ("b", "token=abcdef"), ("c", None)], "path string, content string")
    assert secrets.scan(first, ledger) == 2
    assert secrets.scan(first, ledger) == 0
    more = first.unionByName(spark.createDataFrame([("d", "x"), ("e", "token=abcdef")], "path string, content string"))
    assert secrets.findings(more, ledger).filter("findings IS NULL").count() == 1
    assert secrets.scan(more, ledger) == 1
    found = {r.path: len(r.findings) for r in secrets.findings(more, ledger).collect()}
    assert found == {"a": 1, "b": 1, "c": 0, "d": 0, "e": 1}
    assert secrets.scan(more, ledger, "other-rules") == 3
    assert secrets.scan(more.limit(0), ledger) == 0


def test_checksums_and_context(spark):
    texts = ["GB82 WEST 1234 5698 7654 32", "GB82 WEST 1234 5698 7654 33", "ssn 123-45-6789", "row 123-45-6789"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    found = [[s.kind for s in r.pii] for r in pii.with_personal_data(frame).collect()]
    assert found == [["iban"], [], ["ssn"], []]
    near, far = (
        pii.with_personal_data(spark.createDataFrame([(t,)], "text string")).first().pii[0].score
        for t in ("call +1 (743) 555-3824", "xxxx +1 (743) 555-3824")
    )
    assert near > far


def test_redaction(spark, odd_docs, noisy):
    masked = {r.doc_id: r.text for r in pii.redact(noisy).collect()}
    for row in pii.with_personal_data(noisy).collect():
        out, at = "", 0
        for s in sorted(row.pii, key=lambda s: (s.start, pii.KINDS.index(s.kind))):
            if s.start >= at:
                out += row.text[at : s.start] + f"<{s.kind.upper()}>"
            at = max(at, s.end)
        assert masked[row.doc_id] == (None if row.text is None else out + row.text[at:])
    row = pii.redact(spark.createDataFrame([(1, "to a@b.cd, 1.2.3.4!", 0)], "doc_id long, text string, n_chars int")).first()
    assert (row.text, row.n_chars) == ("to <EMAIL>, <IP>!", 17)
    same = pii.redact(odd_docs)
    assert same.columns == odd_docs.columns
    assert sorted(map(str, same.select("doc_id", "text").collect())) == sorted(
        map(str, odd_docs.select("doc_id", "text").collect())
    )


def test_many_matches_are_placed(spark):
    found = spans.running_sums(spans.F.col("x"))
    for n in (0, 1, 63, 64, 65, 1000):
        values = [(7 * i) % 11 for i in range(n)]
        frame = spark.createDataFrame([(values,)], "x array<long>").select(found.alias("s"))
        assert frame.first().s == [sum(values[: i + 1]) for i in range(n)]
