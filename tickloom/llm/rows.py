"""Row identities and Arrow views that the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A row is known by two 64-bit hashes of its id and its text, so null ids and repeated ids do
#: not mix rows up; rows equal in both are alike and get the same result.
KEYS = ["k1", "k2"]


def keys(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    doc_id, text = F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))
    return [F.xxhash64(F.lit("a"), doc_id, text), F.xxhash64(text, F.lit("b"), doc_id)]


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and the row's keys; other columns are left behind."""
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    return docs.select(F.col(id_col).alias("doc_id"), text, *(k.alias(x) for k, x in zip(keys(id_col, text_col), KEYS, strict=True)))


def with_keys(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with its keys under names that no column has, and these names."""
    names = ["_" * (1 + max(map(len, docs.columns))) + k for k in KEYS]
    return docs.withColumns(dict(zip(names, keys(), strict=True))), names


#: Keys that are broadcast to leave rows out: 2 million of two longs, 32 MB.
MOST_KEYS = 1 << 21


def by_keys(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``docs`` with (``left_semi``) or without (``left_anti``) the rows of stored ``keys (k1, k2)``.

    The keys are counted; few are broadcast, so that no text is shuffled, more meet the rows' own
    keys in an equi-join.
    """
    keyed, names = with_keys(docs)
    keys = keys.select(*KEYS).toDF(*names)
    if keys.count() <= MOST_KEYS:
        keys = F.broadcast(keys)
    return keyed.join(keys, names, how).drop(*names)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column, end to end, and the n + 1 offsets of its values."""
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if large else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def runs(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of values of at most ``most`` bytes together; a longer value is a range by itself."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for lengths[0] items, then the same for the next start."""
    lengths = np.asarray(lengths, np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(np.asarray(starts, np.int64) - ends + lengths, lengths) + np.arange(total)


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc; other libraries do without


def give_back() -> None:
    """Return freed memory to the system; a worker's process outlives its task and would keep it."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def lean(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A function for ``mapInArrow`` that gives back what it freed when it has read all."""

    @wraps(rows)
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from rows(batches)
        give_back()

    return of
