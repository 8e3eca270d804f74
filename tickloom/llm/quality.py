"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts.

Statistics are taken in Arrow batches with numpy.  Trees are grown on binned statistics of a
bounded sample of labelled rows, by the histograms of gradients in each node, and flattened into
arrays of one complete binary tree each, so a batch walks all trees by index arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.hashing import Rolling, mixed
from tickloom.llm.labelled import held_out, training_ids
from tickloom.llm.rows import give_back, runs, utf8
from tickloom.sources.writers import stored

#: Labelled rows that the trees are grown on, at most.
TRAIN_ROWS = 20_000
TREES, DEPTH, BINS, RATE, RIDGE, LEAST_ROWS = 80, 4, 64, 0.15, 1.0, 5
#: A text is good from this score on.
GOOD_FROM = 0.3
_SLICE = 1 << 18

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "letters", "digits", "punctuation", "upper", "spaces", "symbols", "beyond_ascii", "log_lines", "line_words",
    "distinct_words", "same_as_last", "same_as_second_last", "symbol_words", "short_words", "long_words", "distinct_lines", "sentence_ends", "shouts",
)

_SPACE, _LETTER, _DIGIT, _UPPER, _SYMBOL, _HIGH = (np.zeros(256, bool) for _ in range(6))
_SPACE[[32, *range(9, 14)]] = True
_DIGIT[48:58] = _UPPER[65:91] = _HIGH[128:] = True
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_SYMBOL[[ord(c) for c in "#$%&*|<>{}[]=/\\_~^@`"]] = True


def _pieces(is_gap: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs between gaps, none over a text's end, and those before each text."""
    inside = np.concatenate([[False], ~is_gap, [False]])
    starts, ends = np.flatnonzero(inside[1:-1] & ~inside[:-2]), np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    cuts = np.unique(at[1:-1])
    cuts = cuts[(cuts > 0) & (cuts < len(is_gap))]
    cuts = cuts[inside[cuts] & inside[cuts + 1]]
    starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    return starts, ends, np.searchsorted(starts, at)


def _distinct(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Different hashes of each text, by their upper 40 bits."""
    key = np.sort(owner.astype(np.uint64) << np.uint64(40) | hashes >> np.uint64(24))
    first = key[np.flatnonzero(np.diff(key, prepend=key[:1] ^ np.uint64(1)))] if len(key) else key
    return np.bincount((first >> np.uint64(40)).astype(np.int64), minlength=n)


def statistics(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` for each text; zeros where a share has nothing to be a share of."""
    n = len(at) - 1
    size = np.diff(at).astype(float)

    def count(flags: np.ndarray, cuts: np.ndarray = at) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[cuts]).astype(float)

    def share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.divide(a, b, out=np.zeros(n), where=b > 0)

    space = _SPACE[data]
    starts, ends, before = _pieces(space, at)
    words = np.diff(before).astype(float)
    owner = np.repeat(np.arange(n), np.diff(before))
    rolling = Rolling(data)
    hashes = mixed(rolling.ranges(starts, ends), 21)
    length = ends - starts
    last = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])])[: len(hashes)]
    second = np.concatenate([[False, False], (hashes[2:] == hashes[:-2]) & (owner[2:] == owner[:-2])])[: len(hashes)]
    symbol = _SYMBOL[data]
    marks = np.concatenate([[0], np.cumsum(symbol)])
    with_symbol = marks[ends] > marks[starts]
    final = data[ends - 1] if len(ends) else data[:0]
    line_starts, line_ends, line_before = _pieces(data == 10, at)
    lines = np.diff(line_before).astype(float)
    line_owner = np.repeat(np.arange(n), np.diff(line_before))
    line_hashes = mixed(rolling.ranges(line_starts, line_ends), 22)
    letters, digits, high = count(_LETTER[data]), count(_DIGIT[data]), count(_HIGH[data])
    spaces = count(space)
    return np.column_stack(
        [
            np.log1p(size), np.log1p(words), share(count(length, before), words), share(letters, size), share(digits, size),
            share(size - letters - digits - spaces, size), share(count(_UPPER[data]), letters - high), share(spaces, size), share(count(symbol), size), share(high, size),
            np.log1p(lines), share(words, lines), share(_distinct(hashes, owner, n), words), share(count(last, before), words), share(count(second, before), words),
            share(count(with_symbol, before), words), share(count(length <= 1, before), words), share(count(length > 15, before), words),
            share(_distinct(line_hashes, line_owner, n), lines), share(count((final == 46) | (final == 63), before), words), share(count(data == 33), size),
        ]
    )


def text_statistics(column: pa.Array) -> np.ndarray:
    data, at = utf8(column)
    parts = [statistics(data[at[i] : at[j]], at[i : j + 1] - at[i]) for i, j in runs(at, _SLICE)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


@dataclass
class Trees:
    """``feature`` and ``limit`` by tree and inner node, ``value`` by tree and leaf."""

    start: float
    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        depth = (self.value.shape[1]).bit_length() - 1
        for feature, limit, value in zip(self.feature, self.limit, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            total += value[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosted trees for the chance that y is 1; a constant where a class is missing."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(share / (1 - share)))
    inner, leaves = (1 << depth) - 1, 1 << depth
    feature, limit, value = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    if not 0 < y.sum() < len(y):
        return Trees(start, feature[:0], limit[:0], value[:0])
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)])
    total = np.full(len(y), start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            here = node - first
            best = np.full(width, 1e-9)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                key = here * BINS + binned[:, f]
                gl, hl, nl = (np.bincount(key, w, width * BINS).reshape(width, BINS).cumsum(1) for w in (g, h, None))
                gr, hr, nr = gl[:, -1:] - gl, hl[:, -1:] - hl, nl[:, -1:] - nl
                gain = gl**2 / (hl + RIDGE) + gr**2 / (hr + RIDGE) - gl[:, -1:] ** 2 / (hl[:, -1:] + RIDGE)
                gain[(nl < LEAST_ROWS) | (nr < LEAST_ROWS)] = -1
                cut = gain[:, : len(e)].argmax(1)
                found = gain[np.arange(width), cut]
                for k in np.flatnonzero(found > best):
                    best[k], feature[t, first + k], limit[t, first + k] = found[k], f, e[cut[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > limit[t, node])
        leaf = node - inner
        value[t] = RATE * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + RIDGE)
        total += value[t][leaf]
    return Trees(start, feature, limit, value)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = text_statistics(batch.column("text")).astype(np.float64)
        values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), values], names=["doc_id", "x"])


def features(documents: DataFrame) -> DataFrame:
    """``doc_id, x``: the statistics of each whole text; a null text is empty."""
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return docs.mapInArrow(_features, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, x array<double>")


def fit(rows: DataFrame, labels: DataFrame, label: str = "quality", train_rows: int = TRAIN_ROWS) -> Trees:
    """Trees from ``features`` of at most ``train_rows`` labelled rows that are not held out."""
    ids = training_ids(labels, label, train_rows)
    sample = rows.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min(F.struct("label", "x")).alias("r")).select("r.*").toPandas()
    x = np.stack(sample["x"].to_list()) if len(sample) else np.zeros((0, len(FEATURES)))
    return grow(x, sample["label"].to_numpy(float))


def _scored(trees: Trees):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(trees.score(x))], names=["doc_id", "score"])

    return rows


def score_quality(documents: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, score``: the chance that each text is good, a row for each input row.

    A null text is scored as an empty one.  Without labels of both classes all scores are equal.
    Labels of repeated ids count once.  Only the text enters a score; other columns are not read.
    """
    rows = stored(features(documents), "quality-features")
    trees = fit(rows, labels, train_rows=train_rows)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_scored(trees), f"doc_id {kind}, score double").select("doc_id", held_out("doc_id").alias("held_out"), "score")


def quality_of(text: Column, trees: Trees) -> Column:
    """Score of a text column by grown trees."""

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        scores = pa.array(trees.score(text_statistics(texts)))
        give_back()
        return scores

    return of(F.coalesce(text, F.lit("")))
