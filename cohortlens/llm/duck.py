"""Pieces of DuckDB SQL that several oracles of the training-data operators share."""

from __future__ import annotations

CRC_POLYNOMIAL = 0xEDB88320


def _crc_table() -> list[int]:
    out = []
    for c in range(256):
        for _ in range(8):
            c = (c >> 1) ^ (CRC_POLYNOMIAL if c & 1 else 0)
        out.append(c)
    return out


def crc32(text: str) -> str:
    """SQL for the unsigned CRC-32 of the UTF-8 bytes of a VARCHAR expression, byte by byte."""
    table = "[" + ", ".join(map(str, _crc_table())) + "]::BIGINT[]"
    bytes_ = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_}), "
            f"lambda c, b: xor(c >> 8, ({table})[xor(c & 255, b) + 1])), 4294967295::BIGINT)")
