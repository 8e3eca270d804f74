"""Removal of long repeated byte strings by a depth-limited radix sort of the corpus' suffixes.

Only the first ``threshold`` bytes of a suffix matter, and only whether two suffixes agree in
them, so each pass deals suffixes into groups by one digit and drops what is alone in its group;
what is still equal at full depth is exactly the repeated windows.  Digits go from coarse to fine:

1. Suffixes that start within ``side ** 2`` positions of an anchor form a block; its digit is the
   part that all its windows share.  An anchor is the k-gram of least hash among those inside a
   window, so equal windows have the same anchor at the same place; about two in ``side ** 2``
   positions are anchors, and only these are shuffled.
2. Blocks whose whole spans are equal are marked; of each distinct span one block goes on if its
   digit is shared by another span.  These are dealt by the digit and refined inside a task:
   ``side`` blocks of ``side`` suffixes each, dropped where their shared part is alone,
3. then single suffixes, to full depth.

A digit of over ``HOT_GROUP`` distinct spans is not gathered in a task: its blocks are salted,
each task only hashes their windows, and the windows are counted with partial sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.hashing import Rolling, mixed, signed, sliding_min
from tickloom.llm.rows import KEYS, identified, runs, utf8
from tickloom.sources.writers import stored

THRESHOLD, SIDE = 400, 16
#: Distinct spans of a digit that one task refines: 43 MB. Hashes are made of ``_SPANS`` bytes of them
#: at a time; of the group only digests are kept, at most ``_OPEN`` windows' at once.
HOT_GROUP = 65_536
_SPANS, _OPEN, _SALTED = 1 << 18, 1 << 19, 256
#: Parts that the rows of one digit are dealt into.
PARTS = 1024
_SLICE = 1 << 18
_BLOCKS = "k1 long, k2 long, g long, c long, at long"
_MARKS = "k1 long, k2 long, lo long, hi long, window long, check long"


def _place(pos, first, last):
    """One number for an anchor and the first and last suffix of its block."""
    return pos << 16 | (pos - first) << 8 | (pos - last)


def _placed(at: np.ndarray) -> tuple[np.ndarray, ...]:
    pos = at >> 16
    return pos, pos - (at >> 8 & 255), pos - (at & 255)


def _anchors(threshold: int, side: int):
    """Blocks of pass 1: digit g, hash c of the whole span, and place."""
    width = side * side
    k = threshold - width + 1

    def of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
        n = len(data)
        owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
        ends = at[1:][owner]
        rolling = Rolling(data)
        grams = mixed(rolling.windows(k))
        bits = np.uint64(max(1, n.bit_length()))
        order = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
        least = sliding_min(order, width)
        starts = np.flatnonzero(np.arange(len(least)) + threshold <= ends[: len(least)])
        chosen = least[starts] & ((np.uint64(1) << bits) - np.uint64(1))
        if len(chosen):
            chosen = np.unique(chosen[np.flatnonzero(np.diff(chosen, prepend=chosen[0] ^ np.uint64(1)))])
        pos = chosen.astype(np.int64)
        doc = owner[pos]
        first = np.maximum(pos - width + 1, at[doc])
        last = np.minimum(pos, at[doc + 1] - threshold)
        g = mixed(rolling.ranges(pos, pos + k), 1)
        shape = _place(np.zeros_like(pos), first - pos, last - pos).astype(np.uint64)
        c = mixed(rolling.ranges(first, last + threshold), 2) + mixed(shape, 3)
        return doc, signed(g), signed(c), pos - at[doc], first - at[doc], last - at[doc]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column("text"))
            k1, k2 = (batch.column(x).to_numpy(zero_copy_only=False) for x in KEYS)
            for i, j in runs(at, _SLICE):
                size = int(at[j] - at[i])
                # A long text is cut by its windows' starts: each window is whole in one part.
                parts = [(at[i], at[j])] if j > i + 1 else [(s, min(s + _SLICE + threshold - 1, at[j])) for s in range(at[i], at[j] - threshold + 1, _SLICE)]
                for start, end in parts if size >= threshold else ():
                    here = at[i : j + 1] - start if j > i + 1 else np.array([0, end - start])
                    doc, g, c, *places = of(data[start:end], here)
                    if j == i + 1:
                        places = [x + start - at[i] for x in places]
                    doc = doc + i
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (k1[doc], k2[doc], g, c, _place(*places))], names=["k1", "k2", "g", "c", "at"])

    return rows


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for the way through a shuffle."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        data, at = utf8(batch.column("text"))
        raw = memoryview(data.tobytes())
        packed = pa.array([pack(raw[s:e]) for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary())
        yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in batch.schema.names if x != "text"), packed], names=[*(x for x in batch.schema.names if x != "text"), "packed"])


def _unpacked(column: pa.Array) -> Iterator[bytes]:
    unpack = zstandard.ZstdDecompressor().decompress
    for x in column:
        yield unpack(x.as_py())


def _contexts(threshold: int):
    """The bytes of each open block's span."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column("cells")
            each = np.repeat(np.arange(len(batch)), np.diff(cells.offsets.to_numpy()))
            flat = cells.flatten()
            place = flat.field("at").to_numpy(zero_copy_only=False)
            _, first, last = _placed(place)
            texts = list(_unpacked(batch.column("packed")))
            for s in range(0, len(each), 4096):
                part = slice(s, s + 4096)
                spans = [texts[d][lo:hi] for d, lo, hi in zip(each[part].tolist(), first[part].tolist(), (last[part] + threshold).tolist(), strict=True)]
                took = pa.array(each[part])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(x).take(took) for x in KEYS), *(flat.field(x)[part] for x in ("g", "at", "salt")), pa.array(spans, pa.binary())],
                    names=["k1", "k2", "g", "at", "salt", "span"],
                )

    return rows


def _twice(digit: np.ndarray) -> np.ndarray:
    """Which members of ``digit`` are not alone."""
    order = np.argsort(digit, kind="stable")
    same = np.diff(digit[order]) == 0
    out = np.zeros(len(digit), bool)
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


def _stretches(row: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges (low to high, inclusive) of one row that follow on, joined."""
    order = np.lexsort((low, row))
    row, low, high = row[order], low[order], high[order]
    new = np.ones(len(row), bool)
    new[1:] = (np.diff(row) != 0) | (low[1:] != high[:-1] + 1)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(row)) - 1 if len(row) else heads
    return row[heads], low[heads], high[tails]


class _Group:
    """Blocks of whole groups, in order of g, and the digests of parts of them."""

    def __init__(self, part: pa.Table, threshold: int, width: int):
        self.part, self.threshold, self.width = part, threshold, width
        place, self.g = part.column("at").to_numpy(), part.column("g").to_numpy().view(np.uint64)
        self.pos, self.lo, self.hi = _placed(place)
        self.cuts = list(runs(np.concatenate([[0], np.cumsum(pc.binary_length(part.column("span")).to_numpy())]), _SPANS))

    def start(self, row, number):
        return self.pos[row] - self.width + 1 + number

    def digests(self, row, number, per, salts):
        """Which (row, number) have a suffix, and for each salt the digest of what the ``per`` windows from there share.

        ``row`` is in order; the bytes of a few rows are hashed at a time.
        """
        start = self.start(row, number)
        keep = np.maximum(start, self.lo[row]) <= np.minimum(start + per - 1, self.hi[row])
        row, number, start = row[keep], number[keep], start[keep]
        out = [np.empty(len(row), np.uint64) for _ in salts]
        for i, j in self.cuts:
            s, e = np.searchsorted(row, [i, j])
            if s == e:
                continue
            data, at = utf8(self.part.column("span").slice(i, j - i).combine_chunks())
            r = row[s:e]
            here = start[s:e] + at[r - i] - self.lo[r]
            digit = Rolling(data).ranges(here + per - 1, here + self.threshold)
            for x, salt in zip(out, salts, strict=True):
                x[s:e] = mixed(digit, salt) ^ mixed(self.g[r] + number[s:e].astype(np.uint64), salt + 1)
        return row, number, *out


def _refined(threshold: int, side: int):
    """Passes 2 and 3 over blocks sorted by g; of a salted group the windows themselves."""
    width, parts = side * side, np.arange(side, dtype=np.int16)

    def marks(part: pa.Table, owner, low, high, key=None, check=None) -> pa.RecordBatch:
        took = part.select(KEYS).take(pa.array(owner))
        nothing = pa.nulls(len(owner), pa.int64())
        columns = [*(took.column(x).combine_chunks() for x in KEYS), pa.array(low), pa.array(high), nothing if key is None else pa.array(key), nothing if check is None else pa.array(check)]
        return pa.RecordBatch.from_arrays(columns, names=["k1", "k2", "lo", "hi", "window", "check"])

    def of(part: pa.Table) -> pa.RecordBatch:
        group = _Group(part, threshold, width)
        row, number, digit = group.digests(np.repeat(np.arange(len(part), dtype=np.int32), side), np.tile(parts * side, len(part)), side, [4])
        open_ = _twice(digit)
        row, number = row[open_], number[open_]
        del digit, open_
        found = [(np.zeros(0, np.int64),) * 3]
        # Windows of different blocks are never equal, so the blocks can be taken one number at a time.
        for now in [slice(None)] if len(row) * side <= _OPEN else [number == n * side for n in range(side)]:
            each, fine, digit = group.digests(np.repeat(row[now], side), (number[now][:, None] + parts).ravel(), 1, [6])
            met = _twice(digit)
            at = group.start(each[met], fine[met])
            found.append(_stretches(each[met], at, at))
        r, low, high = _stretches(*(np.concatenate(x) for x in zip(*found, strict=True)))
        return marks(part, r, low, high + threshold)

    def windows(part: pa.Table) -> pa.RecordBatch:
        group = _Group(part, threshold, width)
        row, number, key, check = group.digests(np.repeat(np.arange(len(part)), width), np.tile(np.arange(width), len(part)), 1, [6, 8])
        start = group.start(row, number)
        return marks(part, row, start, start + threshold, signed(key), signed(check))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            salted = batch.column("salt").to_numpy() >= 0
            if salted.any():  # blocks of a salted group do not need one another
                hot = pa.Table.from_batches([batch]).filter(pa.array(salted))
                for s in range(0, len(hot), _SALTED):
                    yield windows(hot.slice(s, _SALTED))
                batch = batch.filter(pa.array(~salted))
            if not len(batch):
                continue
            now = pa.Table.from_batches([batch]) if left is None else pa.concat_tables([left, pa.Table.from_batches([batch])])
            g = now.column("g").to_numpy()
            whole = int(np.searchsorted(g, g[-1]))
            left = now.slice(whole)
            for s, e in _group_runs(g[:whole]):
                yield of(now.slice(s, e - s))
        if left is not None and len(left):
            yield of(left)

    return rows


def _group_runs(g: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of whole groups, of about a thousand rows or one group."""
    cuts = [*np.flatnonzero(np.diff(g, prepend=g[0] ^ 1)).tolist(), len(g)] if len(g) else []
    start = 0
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b - start >= 1024:
            if a > start and b - start > 2048:
                yield start, a
                start = a
            else:
                yield start, b
                start = b
    if len(g) > start:
        yield start, len(g)


def _shared(rows: DataFrame) -> DataFrame:
    """Rows whose digit ``g`` is not theirs alone, with how many have it (``kinds``) and a ``part``
    by their text, so that copies are spread too.

    Rows are dealt by digit and part, so those of a frequent digit meet in many tasks; by digit
    alone only counts are dealt, at most ``PARTS`` for each.
    """
    rows = rows.withColumn("part", F.pmod(F.col("k1"), F.lit(PARTS)).cast("int"))
    parts = rows.groupBy("g", "part").agg(F.count(F.lit(1)).alias("n"))
    known = parts.groupBy("g").agg(F.sum("n").alias("kinds"), F.collect_list("part").alias("parts")).where("kinds > 1")
    return rows.join(known.select("g", F.explode("parts").alias("part"), "kinds"), ["g", "part"])


def repeated_spans(docs: DataFrame, threshold: int = THRESHOLD, side: int = SIDE) -> DataFrame:
    """``k1, k2, lo, hi``: byte ranges made of windows of ``threshold`` bytes that occur twice.

    ``docs`` comes from ``identified``.  Ranges overlap; their union in a row is exact.
    """
    if threshold < side * side or side > 16:
        raise ValueError("side must be at most 16 and threshold at least side ** 2")
    texts = docs.select(*KEYS, "text")
    blocks = texts.mapInArrow(_anchors(threshold, side), _BLOCKS)
    blocks = stored(_shared(blocks).drop("part", "kinds"), "suffix-blocks")

    spans = blocks.groupBy("g", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*KEYS, "at")).alias("one"))
    spans = stored(spans, "suffix-spans")
    equal = blocks.join(spans.where("n > 1").select("g", "c"), ["g", "c"], "left_semi")
    first, last = F.expr("(at >> 16) - (at >> 8 & 255)"), F.expr("(at >> 16) - (at & 255)")
    equal = equal.select(*KEYS, first.alias("lo"), (last + threshold).alias("hi"))

    salt = F.when(F.col("kinds") > HOT_GROUP, F.col("part")).otherwise(F.lit(-1)).alias("salt")
    open_ = _shared(spans.select("g", "one.*")).select("g", *KEYS, "at", salt)
    cells = open_.groupBy(*KEYS).agg(F.collect_set(F.struct("g", "at", "salt")).alias("cells"))
    packed = texts.mapInArrow(_packed, "k1 long, k2 long, packed binary")
    contexts = packed.join(cells, KEYS).mapInArrow(_contexts(threshold), "k1 long, k2 long, g long, at long, salt int, span binary")
    found = contexts.repartition("g", "salt").sortWithinPartitions("g", "salt").mapInArrow(_refined(threshold, side), _MARKS)
    found = stored(found, "suffix-windows")

    hot = found.where("window is not null")
    twice = hot.groupBy("window", "check").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("window", "check")
    hot = hot.join(twice, ["window", "check"], "left_semi")
    cold = found.where("window is null")
    return equal.unionByName(cold.select(*KEYS, "lo", "hi")).unionByName(hot.select(*KEYS, "lo", "hi"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch.column("spans").to_pylist()
        sizes, kept, removed, merged = [], [], [], []
        for text, cells in zip(_unpacked(batch.column("packed")), spans, strict=True):
            left, last, out = [], 0, []
            for lo, hi in sorted((x["lo"], x["hi"]) for x in cells or ()):
                if out and lo <= out[-1][1]:
                    out[-1][1] = max(out[-1][1], hi)
                else:
                    out.append([lo, hi])
            for lo, hi in out:
                left.append(text[last:lo])
                last = hi
            left.append(text[last:])
            sizes.append(len(text))
            kept.append(b"".join(left))
            removed.append(sum(hi - lo for lo, hi in out))
            merged.append([{"start": lo, "end": hi} for lo, hi in out])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(merged, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array(kept, pa.binary()),
                pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "spans", "kept", "kept_sha256"],
        )


def remove_repeats(documents: DataFrame, threshold: int = THRESHOLD, side: int = SIDE) -> DataFrame:
    """Each text without the bytes covered by a ``threshold``-byte string that starts twice or more.

    Returns ``doc_id, n_bytes, n_removed, spans (start, end), kept (binary), kept_sha256``, a row
    for each input row.  A null text is empty.  Texts shorter than ``threshold`` keep all bytes.
    Rows equal in id and text are still two rows, so all their windows repeat.  Null ids stay null.
    Other columns are not read.  Cuts are by byte and may split a code point, so ``kept`` is binary.
    """
    docs = identified(documents)
    kind = docs.schema["doc_id"].dataType.simpleString()
    marks = repeated_spans(docs, threshold, side).groupBy(*KEYS).agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    packed = docs.mapInArrow(_packed, f"doc_id {kind}, k1 long, k2 long, packed binary")
    return packed.join(marks, KEYS, "left").select("doc_id", "packed", "spans").mapInArrow(
        _cut,
        f"doc_id {kind}, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary, kept_sha256 string",
    )
