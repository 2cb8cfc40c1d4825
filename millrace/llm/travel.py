"""Texts on their way: compressed for a shuffle, to a half or a third of what Spark's own makes,
and cut into stretches that a worker takes at once."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column
from pyspark.sql import functions as F


def compressed(text: Column) -> Column:
    """The text as a compressed binary; a null text stays null."""

    @F.arrow_udf("binary")
    def pack(texts: pa.Array) -> pa.Array:
        pack = zstandard.ZstdCompressor(level=3).compress
        rows = [None if t is None else pack(t.encode()) for t in texts.to_pylist()]
        return pa.array(rows, pa.binary())

    return pack(text)


def opened(packed: list[bytes | None]) -> list[str]:
    """Texts of compressed binaries; null gives the empty text."""
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(p).decode() if p else "" for p in packed]


def stretches(column: pa.Array, empty: str | bytes, most: int) -> Iterator[list]:
    """The values of a column in lists of about ``most`` characters, nulls as ``empty``."""
    part, size = [], 0
    for value in column:
        part.append(value.as_py() or empty)
        size += len(part[-1])
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part
