"""Pieces of DuckDB SQL that several queries share."""

from __future__ import annotations


def _crc_of(nibble: int) -> int:
    for _ in range(4):
        nibble = nibble >> 1 ^ (0xEDB88320 if nibble & 1 else 0)
    return nibble


def crc32_sql(hx: str) -> str:
    """The CRC-32 of the bytes whose upper-case hex digits a column holds, four bits at a time, the lower ones first."""
    table = [_crc_of(n) for n in range(16)]
    digit = f"strpos('0123456789ABCDEF', substr({hx}, i + 1 - 2 * (i % 2) + 1, 1)) - 1"
    nibbles = f"list_transform(range(length({hx})), lambda i: CAST({digit} AS BIGINT))"
    step = f"lambda c, x: xor(c >> 4, {table}[CAST(xor(c, x) & 15 AS INTEGER) + 1])"
    return f"xor(list_reduce({nibbles}, {step}, 4294967295::BIGINT), 4294967295::BIGINT)"
