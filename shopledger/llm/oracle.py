"""DuckDB SQL of the operators that SQL can express over whole tables."""

from __future__ import annotations

# The scores are sums of whole numbers, so their order does not depend on rounding.
_TOP_K = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_dot_product(q.vec, c.vec)::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER best AS rank, vec_id, score
FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 5
"""

def _crc32(text: str) -> str:
    """The unsigned crc32 of a text's UTF-8 bytes; ``steps`` of ``crc_table`` is read."""
    octets = f"""list_transform(range(strlen({text})),
        lambda i: ('0x' || substr(hex(encode({text})), 2 * i::BIGINT + 1, 2))::UBIGINT)"""
    step = """xor(crc >> 8, list_extract(steps, (xor(crc, octet) & 255)::BIGINT + 1))"""
    return f"xor(list_reduce({octets}, lambda crc, octet: {step}, 4294967295::UBIGINT), 4294967295)"


# Fixed value: the polynomial of crc32.
_CRC_TABLE = """crc_table AS MATERIALIZED (
    SELECT list_transform(range(256), lambda b: list_reduce(
        range(8),
        lambda crc, i: CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384::UBIGINT)
                            ELSE crc >> 1 END,
        b::UBIGINT)) AS steps
)"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_RESAMPLING = f"""
WITH {_CRC_TABLE}, words AS (
    SELECT doc_id, unnest({_WORDS}) AS word FROM documents
), wanted AS (
    SELECT unnest({_WORDS}) AS word FROM benchmark
), buckets AS (
    SELECT word, {_crc32("word")} % 10000 AS bucket
    FROM (SELECT word FROM words UNION SELECT word FROM wanted), crc_table
), raw AS (
    SELECT bucket, count(*) AS s FROM words JOIN buckets USING (word) GROUP BY bucket
), target AS (
    SELECT bucket, count(*) AS t FROM wanted JOIN buckets USING (word) GROUP BY bucket
), gains AS (
    SELECT bucket, floor(1000 * ln(
        (coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM raw) + 10000)::DOUBLE
        / ((s + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM target) + 10000)::DOUBLE)
    ))::BIGINT AS gain
    FROM raw LEFT JOIN target USING (bucket)
), weights AS (
    SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS weight
    FROM words JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY doc_id
), scored AS (
    SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0)::BIGINT AS weight,
           (coalesce(weight, 0) + floor(-1000 * ln(-ln(
               (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296
           ))))::BIGINT AS score
    FROM documents LEFT JOIN weights USING (doc_id)
), placed AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place
    FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= (SELECT 10 * count(*) // 100 FROM placed) THEN place END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""

# Backwards over a conversation's turns, per state (nothing, system, user or assistant put
# out last): the least (cost, edits), and the lines they give.
_REPAIR = rf"""
WITH RECURSIVE {_CRC_TABLE}, shown AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place
    FROM conversations
), kinds AS (
    SELECT conv_id, turn, role, text, {_crc32("place")} % 20 AS kind FROM shown, crc_table
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                     ELSE text END AS text,
           unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM kinds WHERE kind <> 0
), placed AS (
    SELECT *, row_number() OVER ordered AS i, left(role, 1) AS initial,
           left(lag(role) OVER ordered, 1) AS initial_before
    FROM damaged
    WINDOW ordered AS (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)
), faulty AS (
    SELECT *, CASE
        WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated'
        ELSE '' END AS fault
    FROM placed
), counted AS (
    SELECT conv_id, count(*) AS n,
           coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (i > 1 AND initial_before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faulty GROUP BY conv_id
), walk AS (
    SELECT conv_id, n + 1 AS i,
           {{'c': 0, 'e': '', 'l': []::VARCHAR[]}} AS v0,
           {{'c': 4, 'e': 'II', 'l': ['user:', 'assistant:']}} AS v1,
           {{'c': 2, 'e': 'I', 'l': ['assistant:']}} AS v2,
           {{'c': 0, 'e': '', 'l': []::VARCHAR[]}} AS v3
    FROM counted
    UNION ALL
    SELECT conv_id, i,
           least(w0, {{'c': 2 + u.c, 'e': 'I' || u.e, 'l': ['user:'] || u.l}}),
           least(w1, {{'c': 2 + u.c, 'e': 'I' || u.e, 'l': ['user:'] || u.l}}),
           u,
           least(w3, {{'c': 2 + w2.c, 'e': 'I' || w2.e, 'l': ['user:'] || w2.l}})
    FROM (
        SELECT *, least(w2, {{'c': 2 + w3.c, 'e': 'I' || w3.e, 'l': ['assistant:'] || w3.l}}) AS u
        FROM (
            SELECT f.conv_id, f.i, {", ".join(
                f"""least({{'c': 3 + v{state}.c, 'e': 'D' || v{state}.e, 'l': v{state}.l}}""" + "".join(
                    f""", CASE WHEN fault NOT IN ('blank', 'duplicate') AND initial = '{initial}'
                        THEN {{'c': (fault = 'truncated')::INT + v{to}.c, 'e': 'K' || v{to}.e,
                              'l': [role || ':' || text] || v{to}.l}} END"""
                    for initial, to in kept.items()
                ) + f""", CASE WHEN fault NOT IN ('blank', 'duplicate')
                        THEN {{'c': 2 + (fault = 'truncated')::INT + v{rerole[1]}.c,
                              'e': 'R' || v{rerole[1]}.e,
                              'l': ['{rerole[0]}:' || text] || v{rerole[1]}.l}} END) AS w{state}"""
                for state, (kept, rerole) in enumerate((
                    ({"s": 1, "u": 2}, ("user", 2)), ({"u": 2}, ("user", 2)),
                    ({"a": 3}, ("assistant", 3)), ({"u": 2}, ("user", 2))))
            )}
            FROM walk JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM walk.conv_id AND f.i = walk.i - 1
        )
    )
)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(v0.c, 0)::BIGINT AS cost,
       coalesce(v0.e, '') AS audit,
       sha256(coalesce(array_to_string(v0.l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN walk ON walk.conv_id IS NOT DISTINCT FROM ids.conv_id AND walk.i = 1
"""

ORACLE: dict[str, str] = {
    "op10_top_k": _TOP_K,
    "op11_resampling": _RESAMPLING,
    "op12_conversation_repair": _REPAIR,
}
