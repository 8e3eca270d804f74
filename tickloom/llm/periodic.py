"""Runs of periodically repeated words, found by block convolution.

A run is a maximal stretch of words with smallest period q and a length of at least ``LEAST_TIMES * q``
(and ``LEAST_WORDS``).  At each dyadic scale b the words are cut into blocks of b.  The block's sum of
squared differences to every place b to 2b - 1 words later comes from one cyclic convolution of
length 2b, by a number-theoretic transform: exact integers modulo a prime, no rounding.  A zero marks
an occurrence of the block at that distance.  A run of period q in [b, 2b) holds at least two
neighbouring blocks that both recur at distance q, so chains of two or more such blocks are the
seeds; each is extended by less than a block on either side to the maximal stretch.

Numbers of words can make a sum reach the prime; there a chain is confirmed word by word.  A chain
inside a run of a smaller period that divides its distance is that run again and is left out, so what
is extended are different repetitions, of which a text has at most as many as words.  A scale takes
time in proportion to words times log b, whatever the text repeats.

Texts are worked through end to end, a separator that equals nothing behind each, so one transform
serves many texts; a long text is one stretch by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.rows import ranges, runs

# Shortest run in words, and in periods.
LEAST_WORDS, LEAST_TIMES = 6, 4
#: The transform's prime, 15 * 2**27 + 1, and a generator of its units.
PRIME, GENERATOR = 2013265921, 31
#: Words worked through together (one text may be longer), and items of one batch of transforms.
TOGETHER, ITEMS = 1 << 16, 1 << 17


def _mod(x: np.ndarray) -> np.ndarray:
    return x - x // PRIME * PRIME


@lru_cache(64)
def _roots(size: int, inverse: bool) -> np.ndarray:
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    out = np.ones(max(1, size // 2), np.uint64)
    done, step = 1, root
    while done < size // 2:
        out[done : 2 * done] = _mod(out[:done] * np.uint64(step))[: len(out) - done]
        done, step = 2 * done, step * step % PRIME
    return out


def _forward(x: np.ndarray) -> np.ndarray:
    """Transform of each row (length a power of two), in bit-reversed order."""
    x, size = x.copy(), x.shape[1]
    while size > 1:
        half = size // 2
        y = x.reshape(len(x), -1, 2, half)
        a, b = y[:, :, 0], y[:, :, 1]
        low, high = a + b, a + (np.uint64(PRIME) - b)
        np.minimum(low, low - np.uint64(PRIME), out=low)  # an unsigned difference below zero is large
        y[:, :, 1] = _mod(high * _roots(size, False))
        y[:, :, 0] = low
        size = half
    return x


def _backward(x: np.ndarray) -> np.ndarray:
    """The rows whose ``_forward`` is ``x``, times their length."""
    x, size = x.copy(), 2
    while size <= x.shape[1]:
        y = x.reshape(len(x), -1, 2, size // 2)
        b = _mod(y[:, :, 1] * _roots(size, True))
        a = y[:, :, 0].copy()
        low, high = a + b, a + (np.uint64(PRIME) - b)
        y[:, :, 0] = np.minimum(low, low - np.uint64(PRIME))
        y[:, :, 1] = np.minimum(high, high - np.uint64(PRIME))
        size *= 2
    return x


@lru_cache(64)
def _half_turn(size: int) -> np.ndarray:
    """+1 or -1 (mod the prime): the transform of a shift by half a length, in bit-reversed order."""
    one = np.zeros((1, size), np.uint64)
    one[0, size // 2] = 1
    return _forward(one)[0] == 1


def recurrences(words: np.ndarray, block: int, rows: np.ndarray) -> np.ndarray:
    """For each block number in ``rows`` which distances block, ..., 2 * block - 1 it recurs at.

    ``words`` are ids from 0, followed by at least 3 * block cells of ids found nowhere else.  The
    sums are exact modulo the prime, so no recurrence is missed.
    """
    out = np.zeros((len(rows), block), bool)
    size, each = 2 * block, max(1, ITEMS // (2 * block))
    turn = _half_turn(size)
    scale = np.uint64(pow(size, -1, PRIME))
    lanes = np.arange(block)
    for s in range(0, len(rows), each):
        now = rows[s : s + each]
        need = np.unique(np.concatenate([now, now + 1, now + 2]))
        values = np.zeros((len(need), size), np.uint64)
        values[:, :block] = words[need[:, None] * block + lanes]
        # Back to front, a product of transforms is a correlation.
        there = _forward(values)
        first, second, third = (np.searchsorted(need, now + k) for k in range(3))
        u, v = there[second], there[third]
        window = u + np.where(turn, v, np.uint64(PRIME) - v)
        window = np.minimum(window, window - np.uint64(PRIME))
        mirrored = np.zeros((len(now), size), np.uint64)
        mirrored[:, 0] = values[first, 0]
        mirrored[:, size - block + 1 :] = values[first, 1:block][:, ::-1]
        product = _backward(_mod(_forward(mirrored) * window))[:, :block]
        product = _mod(product * scale)
        squares = np.zeros((len(now), 3 * block + 1), np.uint64)
        flat = np.concatenate([values[k, :block] for k in (first, second, third)], axis=1)
        np.cumsum(flat * flat, axis=1, out=squares[:, 1:])
        own = squares[:, block]
        other = squares[:, 2 * block : 3 * block] - squares[:, block : 2 * block]
        out[s : s + each] = _mod(own[:, None] + other) == _mod(product * np.uint64(2))
    return out


def _chains(found: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """First and last block and distance lane of each chain of two or more neighbouring blocks."""
    lane, at = np.nonzero(found.T)
    block = rows[at]
    new = np.ones(len(lane), bool)
    new[1:] = (np.diff(lane) != 0) | (np.diff(block) != 1)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(lane)) - 1 if len(lane) else heads
    keep = tails > heads
    return block[heads[keep]], block[tails[keep]], lane[heads[keep]]


def _equal(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Whether words[start:end] equal those ``shift`` later, for each range."""
    lengths = ends - starts
    at = ranges(starts, lengths)
    off = words[at] != words[at + np.repeat(shift, lengths)]
    return ~np.logical_or.reduceat(off, np.concatenate([[0], np.cumsum(lengths)[:-1]])) if len(starts) else np.zeros(0, bool)


def _confirmed(words: np.ndarray, block: int, lo: np.ndarray, hi: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, ...]:
    """The chains without blocks that a sum which reached the prime let in."""
    same = _equal(words, lo, hi, shift)
    out = [(lo[same], hi[same], shift[same])]
    for a, b, s in zip(lo[~same].tolist(), hi[~same].tolist(), shift[~same].tolist(), strict=True):
        whole = (words[a:b] == words[a + s : b + s]).reshape(-1, block).all(axis=1)
        first, last, _ = _chains(whole[:, None], np.arange(a // block, b // block))
        out.append((first * block, (last + 1) * block, np.full(len(first), s)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _reach(words: np.ndarray, at: np.ndarray, shift: np.ndarray, step: int, most: int) -> np.ndarray:
    """How many words from ``at`` on, in direction ``step``, equal those ``shift`` later."""
    out = np.zeros(len(at), np.int64)
    each = max(1, ITEMS // most)
    lanes = np.arange(most) * step
    for s in range(0, len(at), each):
        a = at[s : s + each, None] + lanes
        inside = a >= 0
        a = np.maximum(a, 0)
        off = ~inside | (words[a] != words[a + shift[s : s + each, None]])
        out[s : s + each] = np.where(off.any(axis=1), off.argmax(axis=1), most)
    return out


def find_runs(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs in texts of ``sizes`` words, laid end to end in ``ids``.

    Starts count from the beginning of ``ids``; runs are in order of start and period.
    """
    n, texts = len(ids), len(sizes)
    kinds = int(ids.max()) + 1 if n else 0
    place = np.arange(n) + np.repeat(np.arange(texts), sizes)
    longest = int(sizes.max()) if texts else 0
    room = 3 * max(1, longest) + 3
    total = n + texts
    words = np.empty(total + room, np.int64)
    words[place] = ids
    gone = np.ones(len(words), bool)
    gone[place] = False
    words[gone] = kinds + np.arange(len(words) - n)
    top = kinds + len(words) - n
    begins = np.cumsum(sizes + 1) - sizes - 1
    length = np.repeat(np.append(sizes, 0), np.append(sizes + 1, room))
    # All runs so far, and for the next scales those of at least three blocks by their start.
    starts, ends, periods = (np.zeros(0, np.int64) for _ in range(3))
    block = 1
    while LEAST_TIMES * block <= longest:
        rows = np.flatnonzero(length[: (total // block) * block].reshape(-1, block).min(axis=1) >= max(LEAST_WORDS, LEAST_TIMES * block))
        if len(rows):
            first, last, lane = _chains(recurrences(words, block, rows), rows)
            lo, hi, shift = first * block, (last + 1) * block, lane + block
            long = np.flatnonzero(ends - starts >= 3 * block)
            long = long[np.argsort(starts[long], kind="stable")]
            if len(long):
                near = long[np.maximum(np.searchsorted(starts[long], lo, "right") - 1, 0)]
                known = (starts[near] <= lo) & (ends[near] >= hi + shift) & (shift % periods[near] == 0)
                lo, hi, shift = lo[~known], hi[~known], shift[~known]
            if block * (top - 1) ** 2 >= PRIME:
                lo, hi, shift = _confirmed(words, block, lo, hi, shift)
            lo = lo - _reach(words, lo - 1, shift, -1, block)
            hi = hi + _reach(words, hi, shift, 1, block) + shift
            keep = hi - lo >= np.maximum(LEAST_WORDS, LEAST_TIMES * shift)
            starts, ends, periods = (np.concatenate(x) for x in ((starts, lo[keep]), (ends, hi[keep]), (periods, shift[keep])))
        block *= 2
    order = np.lexsort((periods, starts))
    starts, ends, periods = starts[order], ends[order], periods[order]
    text = np.searchsorted(begins, starts, "right") - 1
    return starts - text, ends - starts, periods


def _numbered(texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of each text, their ids end to end, and how many each has."""
    words = [t.split() for t in texts]
    flat = pa.array([w for x in words for w in x], pa.large_binary()).dictionary_encode()
    return words, flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.array([len(x) for x in words], np.int64)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches with ``runs``, ``collapsed`` and ``n_words`` in place of the text."""
    cell = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for batch in batches:
        texts = [x.as_buffer().to_pybytes() for x in batch.column("text")]
        counts = [t.count(b" ") + t.count(b"\n") + 1 for t in texts]  # about the words, to form groups
        for i, j in runs(np.concatenate([[0], np.cumsum(counts)]), TOGETHER):
            words, ids, sizes = _numbered(texts[i:j])
            starts, lengths, periods = find_runs(ids, sizes)
            drop = np.zeros(len(ids) + 1, np.int64)
            np.add.at(drop, starts + periods, 1)
            np.add.at(drop, starts + lengths, -1)
            kept = np.cumsum(drop)[:-1] == 0
            begins = np.concatenate([[0], np.cumsum(sizes)])
            owner = np.searchsorted(begins, starts, "right") - 1
            # An empty text begins where the next one does; the run belongs to the last of them.
            offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=j - i))])
            cells = pa.StructArray.from_arrays([pa.array(x) for x in (starts - begins[owner], lengths, periods)], fields=list(cell))
            left = [b" ".join([w for w, k in zip(x, kept[s:e].tolist(), strict=True) if k]) if not kept[s:e].all() else b" ".join(x) for x, s, e in zip(words, begins.tolist(), begins[1:].tolist(), strict=False)]
            out = batch.slice(i, j - i)
            names = [x for x in batch.schema.names if x != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(out.column(x) for x in names), pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), cells), pa.array(left, pa.binary()).cast(pa.string())],
                names=[*names, "n_words", "runs", "collapsed"],
            )


def periodic_runs(documents: DataFrame, text: Column | None = None) -> DataFrame:
    """``doc_id, n_words, runs (start, length, period), collapsed`` for each row of ``documents``.

    ``text`` (by default that column) is split at ASCII white space; words count from 0.  ``runs`` are
    in order of start and period; ``collapsed`` is the text without the words that some run holds
    after its first period, joined by single spaces.  A null text has no words.  Null and repeated
    ids are kept; rows do not depend on one another, and nothing is shuffled.  Other columns are not
    read.  An empty table gives no rows.
    """
    text = F.col("text") if text is None else text
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", F.coalesce(text, F.lit("")).alias("text"))
    return rows.mapInArrow(_found, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def with_planted_runs() -> Column:
    """A drill: the text of every tenth document (by ``crc32(doc_id)``) made periodic from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def planted(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        at = F.sequence(F.lit(0).cast("long"), n - 1)
        return F.array_join(F.transform(at, lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    some = F.coalesce((h % 10 == 0) & F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    return F.when(some, F.get(F.transform(F.array(words), planted), F.lit(0))).otherwise(F.col("text"))


def runs_digest(runs: Column) -> Column:
    """Hex digest of every run's ``start,length,period`` and a line feed."""
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    return F.sha2(F.array_join(F.transform(runs, line), "").cast("binary"), 256)


def longest_run(runs: Column) -> Column:
    """The run of greatest length; of several the one of least start, then period."""
    key = lambda r: F.struct((-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period"))
    return F.array_min(F.transform(runs, key))
