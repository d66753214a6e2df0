"""SQL counterparts of the queries of this package that SQL can express."""

from __future__ import annotations

from seriesengine.llm.sharding import rotations


def _crc32(blob: str) -> str:
    """Unsigned CRC-32 of a binary value: its bytes, folded over a table built by rule."""
    digits = f"regexp_extract_all(hex({blob}), '..')"
    octets = f"list_transform({digits}, lambda x: (strpos('0123456789ABCDEF', x[1]) - 1) * 16 + strpos('0123456789ABCDEF', x[2]) - 1)"
    folded = (
        f"list_reduce(list_prepend(4294967295::BIGINT, {octets}), "
        "lambda a, x: xor(a >> 8, crc_steps[(xor(a, x) & 255) + 1]))"
    )
    return f"xor({folded}, 4294967295)"


_CRC_TABLE = """crc AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS crc_steps
    FROM (SELECT unnest(range(256)) AS i))"""

RESAMPLING = rf"""
WITH {_CRC_TABLE},
texts AS (
    SELECT 0 AS side, doc_id, row_number() OVER () AS row, coalesce(text, '') AS text FROM documents
    UNION ALL
    SELECT 1, NULL, row_number() OVER (), coalesce(text, '') FROM benchmark),
split AS (
    SELECT side, doc_id, row, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM texts),
words AS (SELECT side, row, unnest(words) AS word FROM split),
known AS (SELECT word, {_crc32("encode(word)")} % 10000 AS bucket FROM (SELECT DISTINCT word FROM words), crc),
uses AS (SELECT w.side, w.row, k.bucket, count(*) AS n FROM words w JOIN known k USING (word) GROUP BY ALL),
buckets AS (
    SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0) AS s, coalesce(sum(n) FILTER (side = 1), 0) AS t
    FROM uses GROUP BY bucket),
sums AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM buckets),
gains AS (
    SELECT bucket, floor(1000 * ln(
        ((b.t + 1)::DOUBLE * (a.s + 10000)::DOUBLE) / ((b.s + 1)::DOUBLE * (a.t + 10000)::DOUBLE)
    ))::BIGINT AS gain
    FROM buckets b, sums a),
weights AS (SELECT row, sum(n * gain)::BIGINT AS weight FROM uses JOIN gains USING (bucket) WHERE side = 0 GROUP BY row),
scored AS (
    SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((
            ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE
        ) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM split LEFT JOIN weights USING (row) WHERE side = 0),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
        count(*) FILTER (n_features >= 20) OVER () * 10 // 100 AS drawn
    FROM scored)
SELECT doc_id, n_features, weight, score::BIGINT AS score,
    CASE WHEN n_features >= 20 AND place <= drawn THEN place END AS rank
FROM ranked
"""

_STEPS = [digit * 24 + state for digit, state in rotations(3)]

SHARDING = f"""
WITH {_CRC_TABLE},
curve AS (SELECT {_STEPS} AS steps),
docs AS (
    SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, {_crc32("encode(coalesce(text, ''))")} AS crc,
        dense_rank() OVER (ORDER BY coalesce(source, '')) - 1 AS a,
        dense_rank() OVER (ORDER BY coalesce(lang, '')) - 1 AS b
    FROM documents, crc),
codes AS (
    SELECT doc_id, size, crc,
        a * 64 // (max(a) OVER () + 1) AS a,
        b * 64 // (max(b) OVER () + 1) AS b,
        least(63, (length(bin(size)) - 1) * 4 + ((size * 4) >> (length(bin(size)) - 1)) - 4) AS c
    FROM docs),
cells AS (
    SELECT doc_id, size, crc, list_transform([5, 4, 3, 2, 1, 0],
        lambda i: ((a >> i) & 1) + 2 * ((b >> i) & 1) + 4 * ((c >> i) & 1)) AS cells
    FROM codes),
indexed AS (
    SELECT doc_id, size, crc, list_reduce(list_prepend(0::BIGINT, cells),
        lambda h, cell: (h // 24 * 8 + steps[h % 24 * 8 + cell + 1] // 24) * 24
            + steps[h % 24 * 8 + cell + 1] % 24) // 24 AS cell
    FROM cells, curve),
placed AS (
    SELECT *, row_number() OVER (ORDER BY cell, crc, doc_id NULLS LAST) - 1 AS place, count(*) OVER () AS n
    FROM indexed)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'rows' AS law,
    (((place + 1) * 8 - 1) // n)::INTEGER AS shard,
    (place - (((place + 1) * 8 - 1) // n) * n // 8)::BIGINT AS slot,
    NULL::INTEGER AS grown_shard
FROM placed
"""

ORACLE: dict[str, str] = {"op11_resampling": RESAMPLING, "op12_sharding": SHARDING}
