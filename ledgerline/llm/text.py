"""Byte-level text helpers used inside Arrow tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: ASCII A-Z lower-cased, every other byte as it is.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: As LOWER, and every ASCII byte that is neither digit nor letter becomes a space.
WORD = bytes((c + 32 if 65 <= c <= 90 else c)
             if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c > 127 else 32
             for c in range(256))


def words(data: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` as bytes."""
    return data.translate(WORD).split()


def space_words(data: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x20\\x09-\\x0D]+`` as bytes."""
    return data.translate(LOWER).split()


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores behind it until no column is called so in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; NULL is empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def slices(batches, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of so many rows, so that few are Python objects at once."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def map_texts(df: DataFrame, id_col: str, text_col: str, schema: str,
              fn: Callable[[pa.Array, list[bytes]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """Run ``fn(ids, texts)`` over Arrow batches of the two columns.  Only these
    columns are read from the source."""
    pair = df.select(F.col(id_col).cast("bigint").alias("doc_id"),
                     F.col(text_col).cast("string").alias("text"))

    def task(batches):
        for b in slices(batches):
            yield from fn(b.column(0), text_bytes(b.column(1)))
    return pair.mapInArrow(task, schema)


def blocks(batches, size: int = 1 << 20, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """As :func:`slices`, each part of at most so many rows and, unless it is one row, so many
    bytes in its last column (binary)."""
    for b in batches:
        lengths = pc.fill_null(pc.binary_length(b.column(b.num_columns - 1)), 0).to_numpy(zero_copy_only=False)
        at, held = 0, 0
        for i, n in enumerate(lengths.tolist()):
            if i > at and (held + n > size or i - at >= rows):
                yield b.slice(at, i - at)
                at, held = i, 0
            held += n
        if at < b.num_rows:
            yield b.slice(at, b.num_rows - at)
