"""CRC-32 as DuckDB SQL, which has no such function; the Spark queries use ``crc32``."""

from __future__ import annotations

#: The 256 remainders of single bytes, from the generator polynomial.
TABLE = ("(SELECT list(c ORDER BY i) FROM (SELECT i, list_reduce(list_prepend(i, range(8)), "
         "lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) t(i)))")


def crc32_sql(text: str, table: str) -> str:
    """The unsigned CRC-32 of an SQL string's UTF-8 bytes; ``table`` is an expression of the value of TABLE."""
    code = f"hex(encode({text}))"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({code}), 2), "
            f"lambda i: ('0x' || substr({code}, i, 2))::BIGINT)), "
            f"lambda a, x: xor(a >> 8, {table}[(xor(a, x) & 255) + 1])), 4294967295)")
