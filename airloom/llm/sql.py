"""SQL that several queries' checks share."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """CRC-32 of a short ASCII text, by a table of 256 that SQL makes of the rule."""
    table = (
        "list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: "
        "case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end))"
    )
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::bigint)"
    return f"""(select xor(4294967295, list_reduce(list_prepend(4294967295::bigint, {codes}),
        lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8))) from (select {table} as crc))"""
