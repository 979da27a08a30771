"""What several operators share: reading tables, scratch tables, words, flat byte views of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.session import materialize

Query = Callable[[SparkSession, str], DataFrame]

#: Words are maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

#: A slice of a batch holds about so many text bytes, or one longer text.
SLICE_BYTES = 2_000_000

__all__ = ["Query", "GIVEN", "SPACE", "WORD", "carried", "documents", "flat", "materialize", "slices", "table", "texts", "window_starts", "word_spans"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: The given row as one column, so that no column of its own meets an inner one.
GIVEN = "__given"


def carried(docs: DataFrame, *used: str) -> DataFrame:
    """The columns that an operator reads, and the whole given row in one more."""
    return docs.select(*[F.col(f"`{c}`") for c in used], F.struct("*").alias(GIVEN))


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """Only ids and texts of a documents table; other columns are not read."""
    return docs.select("doc_id", "text", *more)


def texts() -> Column:
    """The text, a missing one as empty."""
    return F.coalesce(F.col("text"), F.lit(""))


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column in a row, and where each begins; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(
    batches: Iterator[pa.RecordBatch], *columns: str, size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Batches cut so that temporary arrays stay small whatever the length of texts, those of
    all named columns together."""
    for batch in batches:
        total = np.zeros(len(batch), np.int64)
        for column in columns or ("text",):
            lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
            total += lengths.to_numpy(zero_copy_only=False)
        block = np.cumsum(total) // size
        cuts = np.flatnonzero(np.diff(block)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def word_spans(
    data: np.ndarray, at: np.ndarray, in_word: np.ndarray = ~_IS_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte bounds of all words, and where the words of each text begin among them."""
    inside = in_word[data]
    # A word begins or ends where the next byte is of the other kind, and where texts meet.
    edge = np.empty(len(data) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[[0, -1]] = True
    edge[at] = True
    places = np.flatnonzero(edge)
    start, end = places[:-1], places[1:]
    of_word = inside[start] if len(data) else np.zeros(0, bool)
    start, end = start[of_word], end[of_word]
    return start, end, np.searchsorted(start, at)


def window_starts(at: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` places have ``length`` values ahead in their text; texts begin at ``at``."""
    ends = np.repeat(at[1:], np.diff(at))[:n]
    return np.arange(n) + length <= ends
