"""Packing of tokenised documents into sequences: best fit, then swap-based local search.

Pieces are dealt to blocks of bounded size, each packed by one task.  Best fit in falling order of
length gives a start; then the emptiest sequences are taken apart: a piece is moved to another
underfull sequence, or exchanged one for one, two for one or one for two, whenever the other gets
fuller.  Each step raises the sum of squared fills, until a sequence is empty and goes.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.rows import identified
from tickloom.sources.writers import stored

CAPACITY, END_ID = 1024, 2
#: Pieces that one task packs.
BLOCK_PIECES = 50_000
#: Items of a bin tried in exchanges of two.
BREADTH = 8
_PIECE = "piece int, start long, length long, ids_crc32 long"


class Encoder:
    """Ids of a byte-level BPE as little-endian 32-bit words, by the file of its tokenizer.

    The merging is left to a faster library over the same vocabulary; texts with a special token's
    string go to the tokenizer itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._special = [t["content"] for t in spec["added_tokens"]]
        # The printable stand-ins of bytes: printable bytes stand for themselves, others follow from 256.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in set(plain))}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self._special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self._bpe = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if any(x in text for x in self._special):
            ids = self._whole.encode(text, add_special_tokens=False).ids
        else:
            ids = self._bpe.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of n ids; only the first can be shorter than the capacity."""
    head = n if n <= capacity else n % capacity or capacity
    return [(0, head), *((s, capacity) for s in range(head, n, capacity))]


def _pieces(path: str, capacity: int, end_id: int, with_ids: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            owner, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                raw = encoder.encode(text) + end
                for k, (s, n) in enumerate(cuts(len(raw) // 4, capacity)):
                    part = raw[4 * s : 4 * (s + n)]
                    for to, x in zip((owner, piece, start, length, crc), (i, k, s, n, zlib.crc32(part)), strict=True):
                        to.append(x)
                    if with_ids:
                        ids.append(part)
            took = pa.array(owner, pa.int64())
            columns = [*(batch.column(x).take(took) for x in ("doc_id", "k1", "k2")), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            names = ["doc_id", "k1", "k2", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "ids"][: len(columns)])

    return rows


def pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """``doc_id, k1, k2, piece, start, length, ids_crc32`` and, on demand, ``ids``: a row for each piece.

    ``tokenizer`` is the path of a byte-level BPE in the JSON form of the tokenizers library; it is
    read in each task.  A null or empty text is its end id alone.
    """
    docs = identified(documents)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_pieces(tokenizer, capacity, end_id, with_ids), f"doc_id {kind}, k1 long, k2 long, {_PIECE}" + ", ids binary" * with_ids)


def _best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Items in falling order of length, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_gap: dict[int, list[int]] = defaultdict(list)
    gaps = 0  # bit g: there is a bin of gap g
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[item]
        fit = gaps >> n
        if fit:
            gap = n + (fit & -fit).bit_length() - 1
            b = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps &= ~(1 << gap)
        else:
            gap, b = capacity, len(bins)
            bins.append([])
        bins[b].append(item)
        left = gap - n
        if left:
            by_gap[left].append(b)
            gaps |= 1 << left
    return bins


class _Search:
    """Underfull bins by gap, and their items by length plus gap: the longest item to take its place.

    ``breadth`` bounds the items of a bin that exchanges of two for one and one for two try, and half
    of it the bins of a gap; None tries all.
    """

    def __init__(self, lengths: list[int], bins: list[list[int]], capacity: int, breadth: int | None = BREADTH):
        self.breadth = breadth
        self.lengths, self.bins, self.capacity = lengths, bins, capacity
        self.gap = [capacity - sum(lengths[i] for i in b) for b in bins]
        self.by_gap: dict[int, set[int]] = defaultdict(set)
        self.by_reach: dict[int, set[tuple[int, int]]] = defaultdict(set)
        for b in range(len(bins)):
            self._list(b)

    def _list(self, b: int) -> None:
        if self.gap[b] and self.bins[b]:
            self.by_gap[self.gap[b]].add(b)
            for i in self.bins[b]:
                self.by_reach[self.gap[b] + self.lengths[i]].add((self.lengths[i], b))

    def _unlist(self, b: int) -> None:
        self.by_gap[self.gap[b]].discard(b)
        for i in self.bins[b]:
            self.by_reach[self.gap[b] + self.lengths[i]].discard((self.lengths[i], b))

    def _trade(self, v: int, give: list[int], b: int, take: list[int]) -> None:
        """Items ``give`` go from bin v to b, ``take`` from b to v; v stays out of the lists."""
        self._unlist(b)
        grown = sum(self.lengths[i] for i in give) - sum(self.lengths[i] for i in take)
        self.bins[v] = [i for i in self.bins[v] if i not in give] + take
        self.bins[b] = [i for i in self.bins[b] if i not in take] + give
        self.gap[v] += grown
        self.gap[b] -= grown
        self._list(b)

    def _partner(self, total: int, fill: int) -> tuple[int, int] | None:
        """Bin and item that ``total`` can replace so that the bin grows, and is left fullest."""
        for reach in range(total, self.capacity + 1):
            spots = self.by_reach.get(reach)
            if spots:
                length, b = max(spots)
                while length >= total:
                    smaller = [x for x in spots if x[0] < total]
                    if not smaller:
                        break
                    length, b = max(smaller)
                # the other bin must end fuller than this one was, or squares would fall
                if length < total and self.capacity - self.gap[b] + total - length > fill:
                    return b, next(i for i in self.bins[b] if self.lengths[i] == length)
        return None

    def _step(self, v: int) -> bool:
        mine = sorted(self.bins[v], key=lambda i: -self.lengths[i])
        fill = self.capacity - self.gap[v]
        for x in mine:  # move
            for gap in range(self.lengths[x], self.capacity):
                if self.by_gap.get(gap):
                    b = min(self.by_gap[gap])
                    if self.capacity - self.gap[b] + self.lengths[x] > fill:
                        self._trade(v, [x], b, [])
                        return True
                    break
        for x in mine:  # one for one
            found = self._partner(self.lengths[x], fill)
            if found:
                self._trade(v, [x], found[0], [found[1]])
                return True
        few = mine[: self.breadth]
        for p, x in enumerate(few):  # two for one
            for y in few[p + 1 :]:
                total = self.lengths[x] + self.lengths[y]
                found = self._partner(total, fill) if total < self.capacity else None
                if found:
                    self._trade(v, [x, y], found[0], [found[1]])
                    return True
        for x in mine:  # one for two
            n = self.lengths[x]
            for gap in range(min(n - 1, self.capacity), 0, -1):
                for b in list(self.by_gap.get(gap, ()))[: self.breadth and max(1, self.breadth // 2)]:
                    if self.capacity - gap + 1 <= fill:
                        continue
                    theirs = sorted(self.bins[b], key=lambda i: self.lengths[i])[: self.breadth]
                    for p, y in enumerate(theirs):
                        for z in theirs[p + 1 :]:
                            if n - gap <= self.lengths[y] + self.lengths[z] < n:
                                self._trade(v, [x], b, [y, z])
                                return True
        return False

    def run(self) -> list[list[int]]:
        least = -(-sum(self.lengths) // self.capacity)
        used = sum(1 for b in self.bins if b)
        while used > least:
            before = used
            order = sorted((b for b in range(len(self.bins)) if self.bins[b] and self.gap[b]), key=lambda b: -self.gap[b])
            for v in order:
                if used <= least:
                    break
                self._unlist(v)
                while self.bins[v] and self._step(v):
                    pass
                if self.bins[v]:
                    self._list(v)
                else:
                    used -= 1
            if used == before:
                break
        return [b for b in self.bins if b]


def pack(lengths: list[int], capacity: int = CAPACITY, breadth: int | None = BREADTH) -> list[list[int]]:
    """Item numbers of each bin, by best fit and local search; every length is 1 to ``capacity``."""
    return _Search(lengths, _best_fit(lengths, capacity), capacity, breadth).run()


def _packed(capacity: int, breadth: int | None):
    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "k1", "k2", "piece"], ascending=[False, True, True, True], ignore_index=True)
        lengths = pdf["length"].tolist()
        full = sum(1 for n in lengths if n == capacity)
        bins = [[i] for i in range(full)] + [[full + i for i in b] for b in pack(lengths[full:], capacity, breadth)]
        order = np.array([i for b in bins for i in b], np.int64)
        number = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        size = pdf["length"].to_numpy()[order]
        ends = np.cumsum(size)
        heads = np.flatnonzero(np.diff(number, prepend=-1))
        out = pdf.iloc[order].copy()
        out["offset"] = ends - size - np.repeat((ends - size)[heads], np.diff(np.append(heads, len(order))))
        out["sequence_id"] = out["block"].astype("int64") * (1 << 32) + number
        return out.drop(columns="block")

    return block


def _dealt(parts: DataFrame, blocks: int, run: int) -> DataFrame:
    """Pieces with ``block``: by the hashes of id and text, copies of a piece in turn by all blocks.

    Equal pieces are counted and told apart by number again, in runs that are dealt out, so a text
    that a third of all rows repeat is in no task as a whole.
    """
    alike = parts.groupBy(*parts.columns).agg(F.count(F.lit(1)).alias("_copies"))
    runs = alike.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_copies - 1) div {run}"))))
    runs = runs.repartition("k1", "piece", "_run")
    last = F.least("_copies", (F.col("_run") + 1) * run) - 1
    each = runs.withColumn("_no", F.explode(F.sequence(F.col("_run") * run, last)))
    return each.select(*parts.columns, F.pmod(F.pmod(F.xxhash64("k1", "piece"), F.lit(blocks)) + F.col("_no"), F.lit(blocks)).alias("block"))


def pack_documents(
    documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, block_pieces: int = BLOCK_PIECES, breadth: int | None = BREADTH
) -> DataFrame:
    """Each piece of ``pieces`` with its ``sequence_id`` and ``offset`` there; sequences are gapless.

    Blocks are dealt by the hashes of id and text, so the result does not depend on how the input
    is spread; rows equal in both go to the blocks in turn.  No sequence crosses blocks.
    ``breadth=None`` tries all exchanges of two, at a cost that grows with the square of the underfull
    sequences of a block.
    """
    parts = stored(pieces(documents, tokenizer, capacity, end_id), "packing-pieces")
    blocks = max(1, -(-parts.count() // block_pieces))
    parts = _dealt(parts, blocks, block_pieces)
    kind = parts.schema["doc_id"].dataType.simpleString()
    return parts.groupBy("block").applyInPandas(_packed(capacity, breadth), f"doc_id {kind}, k1 long, k2 long, {_PIECE}, offset long, sequence_id long")


def sequences(documents: DataFrame, tokenizer: str, **more) -> DataFrame:
    """``sequence_id, ids``: the packed sequences, ids as little-endian 32-bit words.

    Rows equal in id and text hold equal pieces, so it does not matter which of them fills a place.
    """
    placed = pack_documents(documents, tokenizer, **more).select("k1", "k2", "piece", "sequence_id", "offset")
    sizes = {k: v for k, v in more.items() if k in ("capacity", "end_id")}
    own = pieces(documents, tokenizer, with_ids=True, **sizes).select("k1", "k2", "piece", "ids").dropDuplicates(["k1", "k2", "piece"])
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids")))), lambda x: x["ids"])
    return placed.join(own, ["k1", "k2", "piece"]).groupBy("sequence_id").agg(F.unhex(F.array_join(ordered, "")).alias("ids"))
