"""Pieces of DuckDB SQL that several expected results share."""

from __future__ import annotations

_BIT = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"

#: Two common table expressions; ``crc_bytes`` has one row, the table of CRC-32 by rule.
CRC32 = (
    f"crc_bits AS (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: {_BIT}) AS t FROM (SELECT unnest(range(256))::BIGINT AS i)), "
    "crc_bytes AS (SELECT list(t ORDER BY i) AS crc_table FROM crc_bits)"
)


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text, in a query that also reads ``crc_bytes``."""
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295)"
