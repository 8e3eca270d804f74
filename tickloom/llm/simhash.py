"""Near-duplicates by SimHash, linked through a Gray-order hierarchical index.

Fingerprints within ``distance`` bits agree in at least one of ``distance + 1`` fields, so each
distinct fingerprint is placed once for each field, rotated until that field leads, and ordered by
its rank in the Gray code, where neighbours differ in few bits.  Ranges of that order become leaf
tables of bounded size.  A field value that crosses tables is followed through the bits on which
all its members in a table agree: a fingerprint that differs from these in too many bits skips the
table.  Inside a table the same is done level by level: a node holds the bits that its members
share and its parent does not fix, differences add up on the way down, and a node is left with all
its members once there are too many.  Tables return links to one representative of each linked
set instead of all pairs, and connected components join them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.components import connected_components
from tickloom.llm.hashing import signed
from tickloom.llm.rows import identified
from tickloom.sources.writers import stored

SHINGLE, DISTANCE, SEED = 3, 2, 42
LEAF_ROWS = 50_000
_FAN, _QUERIES = 8, 512


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the shingles of ASCII-lower-cased words; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-shingle]]).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(line[s:e], SEED) for s, e in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)], np.uint64)
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        total += np.unpackbits(hashes[at : at + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(hashes)).tobytes(), "big")


def _fingerprints(shingle: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(x.as_buffer().to_pybytes(), shingle) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in ("doc_id", "k1", "k2")), pa.array(signed(np.array(prints, np.uint64)))], names=["doc_id", "k1", "k2", "fp"]
            )

    return rows


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, k1, k2, fp`` for each row; null and wordless texts have fingerprint zero."""
    docs = identified(documents)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_fingerprints(shingle), f"doc_id {kind}, k1 long, k2 long, fp long")


def _gray_rank(x):
    """Position of a 64-bit word in the Gray code, as a signed number of the same order."""
    for by in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, by))
    return x.bitwiseXOR(F.lit(-(1 << 63)))


def _least_of(link_a: np.ndarray, link_b: np.ndarray, label: np.ndarray) -> None:
    """Give linked positions one label, the least of them, in place."""
    while True:
        a, b = label[link_a], label[link_b]
        if np.array_equal(a, b):
            return
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while not np.array_equal(label, label[label]):
            label[:] = label[label]


class GrayIndex:
    """Tree over words in Gray order; ``near`` yields pairs within ``distance`` bits."""

    def __init__(self, words: np.ndarray, lead: int, distance: int):
        self.words, self.distance = words, distance
        self.lead = ~np.uint64((1 << (64 - lead)) - 1)
        both, any_ = words, words
        levels = []
        while True:
            levels.append((both, ~(both ^ any_)))
            if len(both) <= 1:
                break
            cuts = np.arange(0, len(both), _FAN)
            both, any_ = np.bitwise_and.reduceat(both, cuts), np.bitwise_or.reduceat(any_, cuts)
        self.levels = levels[::-1]

    def near(self, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in range(0, len(queries), _QUERIES):
            q = np.arange(at, min(at + _QUERIES, len(queries)))
            node, spent = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64)
            fixed = np.zeros(len(q), np.uint64)
            for depth, (pattern, mask) in enumerate(self.levels):
                off = (queries[q] ^ pattern[node]) & mask[node] & ~fixed
                spent = spent + np.bitwise_count(off)
                keep = (spent <= self.distance) & ((off & self.lead) == 0)
                q, node, spent = q[keep], node[keep], spent[keep]
                fixed = mask[node]
                if depth + 1 < len(self.levels):
                    below = len(self.levels[depth + 1][0])
                    child = (node[:, None] * _FAN + np.arange(_FAN)).ravel()
                    q, spent, fixed = (np.repeat(x, _FAN) for x in (q, spent, fixed))
                    real = child < below
                    q, node, spent, fixed = q[real], child[real], spent[real], fixed[real]
            yield q, node


def _leaf(lead: int, distance: int):
    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf[pdf.member].sort_values("rank")
        other = pdf[~pdf.member]
        words, fps = own.word.to_numpy().view(np.uint64), own.fp.to_numpy()
        index = GrayIndex(words, lead, distance)
        label = np.arange(len(words))
        for q, m in index.near(words):
            _least_of(q, m, label)
        out = [pd.DataFrame({"a": fps, "b": fps[label]})[label != np.arange(len(fps))]]
        visitors, theirs = other.word.to_numpy().view(np.uint64), other.fp.to_numpy()
        for q, m in index.near(visitors):
            out.append(pd.DataFrame({"a": theirs[q], "b": fps[label[m]]}).drop_duplicates())
        return pd.concat(out)

    return links


def links(prints: DataFrame, distance: int = DISTANCE, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """``a, b``: links between distinct fingerprints ``fp`` that connect all pairs within ``distance`` bits."""
    fields = distance + 1
    lead = 64 // fields
    starts = [round(i * 64 / fields) for i in range(fields)]
    fp = F.col("fp")
    turned = [fp if not s else F.shiftleft(fp, s).bitwiseOR(F.shiftrightunsigned(fp, 64 - s)) for s in starts]
    placed = F.posexplode(F.array(*turned)).alias("field", "word")
    words = prints.select("fp", placed).withColumn("rank", _gray_rank(F.col("word"))).withColumn("head", F.shiftrightunsigned("word", 64 - lead))
    tables = max(1, -(-fields * prints.count() // leaf_rows))
    words = words.repartitionByRange(tables, "field", "rank").withColumn("leaf", F.spark_partition_id())
    words = stored(words, "simhash-words")

    ends = words.groupBy("leaf", "field").agg(F.min("rank").alias("low"), F.max("rank").alias("high"))
    edge = words.join(ends, ["leaf", "field"]).where("rank = low or rank = high").select("leaf", "field", "head").distinct()
    split = edge.groupBy("field", "head").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("field", "head")
    crossing = words.join(split, ["field", "head"], "left_semi")
    parts = crossing.groupBy("field", "head", "leaf").agg(F.bit_and("word").alias("all"), F.bit_or("word").alias("any"))
    off = F.expr("bit_count((word ^ all) & ~(all ^ any))")
    visits = crossing.withColumnRenamed("leaf", "home").join(parts, ["field", "head"]).where(F.col("leaf") > F.col("home")).where(off <= distance)
    cols = ["leaf", "field", "word", "rank", "fp"]
    both = words.select(*cols, F.lit(True).alias("member")).unionByName(visits.select(*cols, F.lit(False).alias("member")))
    return both.groupBy("leaf", "field").applyInPandas(_leaf(lead, distance), "a long, b long")


def components(documents: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """``doc_id, k1, k2, fp, component_id, first``: near-duplicate groups, a row for each input row.

    Texts are linked when their fingerprints differ in at most ``distance`` bits, and grouped by
    reachability; ``component_id`` is the least ``doc_id`` of the group (null ids do not count; a
    group of null ids has null).  ``first`` is true on one row of the group, or on the rows equal
    to it in id and text.  Null, empty and wordless texts share fingerprint zero and link like any
    other.  Other columns are not read.  An empty table gives no rows.
    """
    prints = stored(fingerprints(documents, shingle), "simhash-prints")
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2"))
    words = stored(prints.groupBy("fp").agg(one.alias("one")), "simhash-distinct")
    roots = connected_components(links(words.select("fp"), distance, leaf_rows))
    words = words.join(roots, words.fp == roots.node, "left").select("fp", "one", F.coalesce("root", "fp").alias("root"))
    words = stored(words, "simhash-roots")
    least = words.groupBy("root").agg(F.min("one").alias("best"))
    best = words.join(least, "root").select("fp", "best")
    same = F.col("k1").eqNullSafe(F.col("best.k1")) & F.col("k2").eqNullSafe(F.col("best.k2"))
    return prints.join(best, "fp").select("doc_id", "k1", "k2", "fp", F.col("best.doc_id").alias("component_id"), same.alias("first"))
