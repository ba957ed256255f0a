"""Shared pieces of the training-data operators: word rules as columns, raw
text buffers of Arrow arrays, table reading."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: bytes.translate table: A-Z to a-z, every ASCII byte that is no letter or digit to a space
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_place(docs: DataFrame) -> DataFrame:
    """``docs`` with columns c0, c1, ...: whatever names it has, they clash
    with nothing.  ``toDF(*docs.columns)`` gives them back."""
    return docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are.  ``lower`` is the
    fast path for texts of ASCII only; elsewhere it would change more."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def split_words(text: Column, separators: str) -> Column:
    """The words between runs of separators; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string array and its n+1 offsets into them
    (nulls are empty); no text is copied unless the array has nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def byte_slices(offsets: np.ndarray, most: int):
    """(first, last) row ranges of at most ``most`` bytes each; a row that is
    longer by itself makes a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


def text_lists(column) -> list:
    """The texts of an Arrow column as UTF-8 bytes; null is empty."""
    data, offsets = text_buffer(column)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
