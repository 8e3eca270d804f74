"""Benchmark decontamination by winnowing.

Every window of ``words`` consecutive words keeps the least hash of its ``gram``-word grams, so
two equal windows keep equal fingerprints: every shared span of at least ``words`` words is found.
Items of fewer words are one window of their own length.  The benchmark's fingerprints fill a bit
table of fixed size, which each scan task of the corpus probes; what passes is joined to the
benchmark by its words, which is the exact extension of the hit, so a false positive of the table
costs a row and nothing else.  The table's size does not depend on the benchmark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.hashing import Rolling, mixed, signed, sliding_min
from tickloom.llm.rows import KEYS, identified, runs, utf8
from tickloom.sources.writers import stored

WORDS, GRAM = 10, 5
#: Bits of the benchmark's table: 4 MB in each task, at most 2**19 rows of 64 bits on the driver.
TABLE_BITS = 25
_SLICE = 1 << 18

#: Word characters after ASCII lower-casing: digits, letters, everything beyond ASCII.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def split_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words of texts laid end to end, and the words before each text."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _WORD[data]
    starts = np.flatnonzero(inside[1:-1] & ~inside[:-2])
    ends = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    cuts = at[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = np.unique(cuts[inside[cuts] & inside[cuts + 1]])  # words that touch over a border
    starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    return starts, ends, np.searchsorted(starts, at)


def _windows(data: np.ndarray, at: np.ndarray, words: int, gram: int, shorter: list[int]):
    """For each window length: first word, kept fingerprint and text of every window."""
    lower = _LOWER[data]
    starts, ends, before = split_words(lower, at)
    hashes = mixed(Rolling(lower).ranges(starts, ends), 11)
    owner_end = np.repeat(before[1:], np.diff(before))
    rolling = Rolling(hashes)
    for length in [words, *shorter]:
        size = min(gram, length)
        kept = sliding_min(mixed(rolling.windows(size), 12), length - size + 1)
        first = np.flatnonzero(np.arange(len(kept)) + length <= owner_end[: len(kept)])
        yield length, first, mixed(kept[first], length), (starts, ends, before, lower)


def _joined(lower: bytes, starts, ends, first: np.ndarray, length: int) -> list[bytes]:
    spans = [[lower[s:e] for s, e in zip(starts[i : i + length].tolist(), ends[i : i + length].tolist(), strict=True)] for i in first.tolist()]
    return [b" ".join(x) for x in spans]


def _table_cells(fingerprint: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    return (fingerprint & mask).astype(np.int64), (fingerprint >> np.uint64(64 - bits)).astype(np.int64)


def _filled(table: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which places of a table of 64-bit words are set."""
    return (table[place >> 6] >> (place & 63) & 1).astype(bool)


def _items(words: int, gram: int, bits: int):
    """Distinct windows of each item: length, text, and the two places in the table."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column("text"))
            for i, j in runs(at, _SLICE):
                part, here = data[at[i] : at[j]], at[i : j + 1] - at[i]
                counts = np.diff(split_words(_LOWER[part], here)[2])
                lengths = sorted(set(counts[(counts > 0) & (counts < words)].tolist()))
                for length, first, kept, (starts, ends, before, lower) in _windows(part, here, words, gram, lengths):
                    owner = np.searchsorted(before, first, "right") - 1
                    own = (counts[owner] == length) if length < words else np.ones(len(first), bool)
                    first, kept, owner = first[own], kept[own], owner[own]
                    text = _joined(lower.tobytes(), starts, ends, first, length)
                    a, b = _table_cells(kept, bits)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("item_id").take(pa.array(owner + i)), pa.array(np.full(len(first), length, np.int32)), pa.array(text, pa.binary()), pa.array(a), pa.array(b)],
                        names=["item_id", "length", "window", "a", "b"],
                    )

    return rows


def _candidates(words: int, gram: int, bits: int, shorter: list[int], table):
    """Word counts of each text, and the windows whose fingerprint may be the benchmark's."""
    cell = pa.struct([("start", pa.int32()), ("length", pa.int32()), ("window", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column("text"))
            for i, j in runs(at, _SLICE):
                found: list[list[dict]] = [[] for _ in range(j - i)]
                n_words = np.zeros(j - i, np.int64)
                for length, first, kept, (starts, ends, before, lower) in _windows(data[at[i] : at[j]], at[i : j + 1] - at[i], words, gram, shorter):
                    n_words = np.diff(before)
                    a, b = _table_cells(kept, bits)
                    hit = _filled(table.value, a) & _filled(table.value, b)
                    first = first[hit]
                    owner = np.searchsorted(before, first, "right") - 1
                    if len(first):
                        text = _joined(lower.tobytes(), starts, ends, first, length)
                        for o, s, w in zip(owner.tolist(), (first - before[owner]).tolist(), text, strict=True):
                            found[o].append({"start": s, "length": length, "window": w})
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(x) for x in ("doc_id", *KEYS)), pa.array(n_words), pa.array(found, pa.list_(cell))],
                    names=["doc_id", "k1", "k2", "n_words", "cells"],
                )

    return rows


def _covered(starts: pd.Series, lengths: pd.Series) -> pd.Series:
    out = []
    for s, n in zip(starts, lengths, strict=True):
        end, total = -1, 0
        for a, b in sorted(zip(s, s + n, strict=True)):
            total += max(0, b - max(a, end))
            end = max(end, b)
        out.append(total)
    return pd.Series(out, dtype="int64")


def contamination(documents: DataFrame, benchmark: DataFrame, words: int = WORDS, gram: int = GRAM, table_bits: int = TABLE_BITS) -> DataFrame:
    """``doc_id, k1, k2, n_words, n_hit, items``: words under a benchmark window, items that occur.

    Words are runs of digits, letters and non-ASCII characters, ASCII letters lower-cased.  A row
    for each input row; ``items`` is a set of item ids.  Null and empty texts have no words; items
    without words never occur; items repeated under one id add their windows; a null item id stays
    null and is listed nowhere.  Other columns of either table are not read.
    """
    spark = documents.sparkSession
    kind = benchmark.schema["item_id"].dataType.simpleString()
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    items = items.mapInArrow(_items(words, gram, table_bits), f"item_id {kind}, length int, window binary, a long, b long")
    items = stored(items, "winnow-items")
    shorter = sorted(r.length for r in items.where(f"length < {words}").select("length").distinct().collect())

    place = F.explode(F.array("a", "b")).alias("place")
    filled = items.select(place).groupBy(F.shiftright("place", 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
    packed = np.zeros(max(1, 1 << (table_bits - 6)), np.int64)
    for chunk in filled.toArrow().to_batches():
        packed[chunk.column(0).to_numpy()] = chunk.column(1).to_numpy()
    table = spark.sparkContext.broadcast(packed)

    docs = identified(documents)
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_kind}, k1 long, k2 long, n_words long, cells array<struct<start: int, length: int, window: binary>>"
    scanned = stored(docs.mapInArrow(_candidates(words, gram, table_bits, shorter, table), schema), "winnow-scan")
    cells = scanned.select(*KEYS, F.explode("cells").alias("x")).select(*KEYS, "x.*")
    windows = items.groupBy("length", "window").agg(F.collect_set("item_id").alias("ids"))
    hits = cells.join(windows, ["length", "window"])
    covered = F.pandas_udf(_covered, "long")
    per = hits.groupBy(*KEYS).agg(
        F.collect_set(F.struct("start", "length")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("ids"))).alias("items")
    )
    per = per.select(*KEYS, covered(F.col("spans.start"), F.col("spans.length")).alias("n_hit"), "items")
    return scanned.select("doc_id", *KEYS, "n_words").join(per, KEYS, "left").select(
        "doc_id", *KEYS, "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", F.array().cast(f"array<{kind}>")).alias("items")
    )
