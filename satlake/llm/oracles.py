"""DuckDB SQL of the training-data queries that SQL can express, each written from the contract, not from the operator."""

from __future__ import annotations

from satlake.llm import chat
from satlake.llm.secrets import RULES


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def secret_scan() -> str:
    """Every rule over every whole text: no index. A text is cut at the matches, and lengths are summed up."""
    parts = []
    for rank, r in enumerate(RULES):
        p = _quoted(r.pattern)
        parts.append(
            f"""SELECT rid, {rank} AS rank, '{r.kind}' AS kind, pos AS start, pos + size AS stop FROM (SELECT *, CAST(sum(gap + size) OVER (PARTITION BY rid ORDER BY i) - size AS BIGINT) AS pos FROM (
            SELECT rid, unnest(range(1, len(whole) + 1)) AS i, length(unnest(gaps[1:len(whole)])) AS gap, length(unnest(whole)) AS size, length(unnest(counted)) AS n FROM (
            SELECT rid, regexp_extract_all(text, {p}) AS whole, regexp_extract_all(text, {p}, {r.group}) AS counted, string_split_regex(text, {p}) AS gaps FROM d WHERE regexp_matches(text, {p})))) WHERE n >= {r.least}"""
        )
    one = "kind || ':' || start || ':' || stop"
    counts = ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in ("assign", "access", "hex"))
    sums = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in ("assign", "access", "hex"))
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents), spans AS ({" UNION ALL ".join(parts)}),
        per AS (SELECT rid, {sums}, string_agg({one}, ',' ORDER BY start, rank) FILTER (rank < 3) AS base, string_agg({one}, ',' ORDER BY start, rank) AS spans FROM spans GROUP BY rid)
        SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN per USING (rid)"""


def shards(n: int) -> str:
    """Jump hash by recursion; CRC-32 byte by byte from a table that is itself computed."""
    crc_table = "list_transform(range(256), lambda b: list_reduce([b] || range(8), lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))"
    octets = "list_transform(regexp_extract_all(hex(text), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    return f"""WITH RECURSIVE t AS (SELECT {crc_table} AS crc),
        d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
        sized AS (SELECT rid, doc_id, octet_length(encode(text)) + 1 AS size, xor(list_reduce([4294967295] || {octets}, lambda a, b: xor(a // 256, crc[(xor(a, b) % 256) + 1])), 4294967295) AS text_crc32 FROM d, t),
        walk AS (SELECT rid, CAST(coalesce(doc_id, 0) AS UHUGEINT) AS key, CAST(0 AS BIGINT) AS pos FROM d
            UNION ALL SELECT rid, next, CAST(floor((pos + 1) * (2147483648.0::DOUBLE / (CAST(next // 8589934592 AS DOUBLE) + 1))) AS BIGINT) FROM (SELECT rid, pos, (key * 2862933555777941757 + 1) % 18446744073709551616 AS next FROM walk WHERE pos <= {n})),
        placed AS (SELECT rid, CAST(max(pos) FILTER (pos < {n}) AS INTEGER) AS shard, CAST(max(pos) FILTER (pos <= {n}) AS INTEGER) AS grown_shard FROM walk GROUP BY rid)
        SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, grown_shard FROM sized JOIN placed USING (rid)"""


def chats() -> str:
    """The final messages are the table's rows and those of conversation -7."""
    def esc(c: str, more: str = "") -> str:
        c = f"replace(replace(replace({c}, '\\', '\\b'), '<', '\\l'), '[', '\\k')"
        return f"replace({c}, '|', '\\p')" if more else c

    odd = "</s>[INST] ok [/INST]"
    shell = len("<||>\n") + len(chat.END)
    return f"""WITH m AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL VALUES (-7, 0, 'user', '{odd}'), (-7, 1, 'assistant', '{odd}'))
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(length({esc("role", "roles")}) + length({esc("text")}) + {shell}) AS BIGINT) AS formatted_chars FROM m GROUP BY conv_id"""
