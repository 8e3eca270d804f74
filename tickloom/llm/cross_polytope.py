"""Near copies among embeddings by cross-polytope hashing.

A vector is turned by three rounds of random signs and a fast Hadamard transform; its hash is the
signed axis it then lies nearest to.  ``HASHES`` of these make a bucket of one table.  In each table
a vector is a member of its own bucket and a visitor of the ``PROBES`` next likely ones (the axes
whose lead over the nearest is least), so a pair meets if one's own bucket is among the other's.
Every pair that meets is verified by its cosine.

Equal vectors are one node with a weight.  A pair may meet in several buckets; it counts in the first
of them only, which both vectors know from their own bucket numbers, so neighbours are counted
without listing pairs.  A bucket of more than ``BLOCK`` vectors is cut into blocks, each pair of which
is a group of its own: no task holds more than two blocks, and no pair inside a bucket is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.components import connected_components
from tickloom.sources.writers import stored

COSINE = 0.9
#: Tables, hashes of a bucket, and further buckets that a vector visits in each table. A pair at a
#: cosine of 0.9 in 64 dimensions meets with a probability of 0.99. More vectors than about 10**8
#: want three hashes and more probes; the work of a bucket grows with the square of its vectors.
TABLES, HASHES, PROBES = 5, 2, 3
BLOCK = 2048
SEED = 11
#: Axes of one hash that its further buckets are made of.
_AXES = 4


def _hadamard(x: np.ndarray) -> np.ndarray:
    half = 1
    while half < x.shape[1]:
        y = x.reshape(len(x), -1, 2, half)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), -1)
        half *= 2
    return x


@lru_cache(8)
def _signs(tables: int, hashes: int, size: int) -> np.ndarray:
    return np.random.default_rng([SEED, size]).choice([-1.0, 1.0], size=(tables, hashes, 3, size))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of ``x`` (finite, not zero) at length 1, whatever their scale."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def buckets(x: np.ndarray, tables: int, hashes: int, probes: int) -> np.ndarray:
    """Bucket numbers (vectors, tables, 1 + probes) of unit vectors: own bucket first, then likely ones."""
    n, dim = x.shape
    size = max(2, 1 << (dim - 1).bit_length())
    axes = min(_AXES, size)
    padded = np.zeros((n, size))
    padded[:, :dim] = x
    choices = np.stack(np.meshgrid(*[np.arange(axes)] * hashes, indexing="ij"), axis=-1).reshape(-1, hashes)
    out = np.empty((n, tables, 1 + probes), np.int64)
    for t, signs in enumerate(_signs(tables, hashes, size)):
        code = np.zeros((n, len(choices)), np.int64)
        loss = np.zeros((n, len(choices)))
        for k, rounds in enumerate(signs):
            y = padded
            for s in rounds:
                y = _hadamard(y * s) / np.sqrt(size)
            far = np.abs(y)
            order = np.argsort(-far, axis=1, kind="stable")[:, :axes]
            axis = 2 * order + (np.take_along_axis(y, order, axis=1) < 0)
            lead = np.take_along_axis(far, order, axis=1)
            code = code * (2 * size) + axis[:, choices[:, k]]
            loss += ((lead[:, :1] - lead) ** 2)[:, choices[:, k]]
        best = np.argsort(loss[:, 1:], axis=1, kind="stable")[:, :probes] + 1
        out[:, t, 0] = code[:, 0]
        out[:, t, 1:] = np.take_along_axis(code, best, axis=1)
    return out


def _hashed(tables: int, hashes: int, probes: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column("embedding")
            offsets = cells.offsets.to_numpy()
            sizes = np.diff(offsets)
            flat = cells.values.to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes):
                of_dim = np.flatnonzero(sizes == dim)
                for s in range(0, len(of_dim), 4096):
                    at = of_dim[s : s + 4096]
                    x = flat[offsets[at][:, None] + np.arange(dim)]
                    code = buckets(unit(x), tables, hashes, probes)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * tables * (1 + probes), pa.int32()), pa.array(code.ravel()))
                    vectors = pa.array([v.tobytes() for v in x], pa.binary())
                    took = pa.array(at)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("node").take(took), batch.column("weight").take(took), pa.array(np.full(len(at), dim, np.int32)), lists, vectors],
                        names=["node", "weight", "dim", "codes", "vector"],
                    )

    return rows


def _first_meeting(a: np.ndarray, b: np.ndarray, table: int, code: int) -> np.ndarray:
    """Whether each pair of rows of bucket numbers meets in bucket ``code`` of ``table`` and in none before it."""
    first = np.ones(len(a), bool)
    for t in range(table):
        at = np.flatnonzero(first)
        x, y = a[at, t], b[at, t]
        met = (x[:, :1] == y).any(axis=1) | (y[:, :1] == x).any(axis=1)
        first[at[met]] = False
    x, y = a[:, table], b[:, table]
    twice = (x[:, :1] == y).any(axis=1) & (y[:, :1] == x).any(axis=1) & (x[:, 0] != y[:, 0])
    return first & ~(twice & (np.minimum(x[:, 0], y[:, 0]) != code))


def _roots(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> None:
    """Give linked rows one label, their least, with what ``label`` knows already."""
    while True:
        low = np.minimum(label[a], label[b])
        if np.array_equal(label[a], low) and np.array_equal(label[b], low):
            return
        for x in (a, b):
            np.minimum.at(label, label[x], low)
            np.minimum.at(label, x, low)
        while not np.array_equal(label, label[label]):
            label[:] = label[label]


def _neighbours(cosine: float, tables: int, probes: int, item: type):
    """Of one group at a time: how much weight each vector is first linked to here, and its least link."""

    def of(group: pa.RecordBatch) -> pa.RecordBatch | None:
        table, code, dim = (group.column(x)[0].as_py() for x in ("table", "code", "dim"))
        split = group.column("left")[0].as_py() != group.column("right")[0].as_py()
        node, weight, own, side = (group.column(x).to_numpy(zero_copy_only=False) for x in ("node", "weight", "own", "block"))
        codes = group.column("codes").flatten().to_numpy().reshape(len(node), tables, 1 + probes)
        x = unit(np.frombuffer(b"".join(group.column("vector").to_pylist()), item).reshape(len(node), dim))
        links, label = np.zeros(len(node), np.int64), np.arange(len(node))
        for s in range(0, len(node), 256):
            near = x[s : s + 256] @ x.T >= cosine
            a, b = np.nonzero(near)
            a = a + s
            keep = (a < b) & (own[a] | own[b])
            if split:
                keep &= side[a] != side[b]
            a, b = a[keep], b[keep]
            _roots(len(node), a, b, label)
            count = _first_meeting(codes[a], codes[b], table, code)
            a, b = a[count], b[count]
            np.add.at(links, a, weight[b])
            np.add.at(links, b, weight[a])
        some = np.flatnonzero((links > 0) | (label != np.arange(len(node))))
        if not len(some):
            return None
        return pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(links[some]), pa.array(node[label[some]])], names=["node", "links", "root"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            now = pa.Table.from_batches([batch] if left is None else [left, batch]).combine_chunks().to_batches()
            if not now:
                continue
            now = now[0]
            keys = np.stack([now.column(c).to_numpy().astype(np.int64) for c in _GROUP])
            cuts = np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1
            bounds = [0, *cuts.tolist()]
            for s, e in zip(bounds, bounds[1:], strict=False):
                if e > s + 1 and (found := of(now.slice(s, e - s))) is not None:
                    yield found
            left = now.slice(bounds[-1])
        if left is not None and len(left) > 1 and (found := of(left)) is not None:
            yield found

    return rows


#: One group of vectors that are compared: a bucket, or a pair of its blocks.
_GROUP = ["table", "dim", "code", "left", "right"]


def usable(vector: Column) -> Column:
    """Whether a vector is neither null nor zero and all its components are finite."""
    big = F.lit(float("inf"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big)
    return F.coalesce(F.forall(vector, fine) & F.exists(vector, lambda x: x != 0), F.lit(False))


def similar_vectors(
    embeddings: DataFrame, cosine: float = COSINE, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES, block: int = BLOCK
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``embeddings (vec_id, embedding)``.

    ``n_links`` is the number of other rows whose cosine to this one, in double precision, is found to
    be at least ``cosine``; none below it counts.  ``component_id`` is the least ``vec_id`` reachable
    over links, its own included (nulls do not count), ``kept`` whether that is the row itself.
    Vectors of different length do not meet.  Vectors that are null, empty, zero or hold a null or a
    component that is not finite have no link and stay alone.  Equal rows are links of one another; repeated
    and null ids are rows like any other, a null one is kept only if it has no link to an id.  Other
    columns are not read.  An empty table gives no rows.
    """
    kind = embeddings.schema["vec_id"].dataType
    single = embeddings.schema["embedding"].dataType.simpleString() == "array<float>"
    vector = F.col("embedding").cast("array<float>" if single else "array<double>")
    rows = embeddings.select("vec_id", vector.alias("embedding")).withColumn("fine", usable(F.col("embedding")))
    rows = rows.withColumn("node", F.when(F.col("fine"), F.xxhash64("embedding")))
    nodes = rows.where("fine").groupBy("node").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least"), F.first("embedding").alias("embedding"))
    hashed = nodes.select("node", "weight", "embedding").mapInArrow(_hashed(tables, hashes, probes), "node long, weight long, dim int, codes array<long>, vector binary")
    hashed = stored(hashed, "polytope-vectors")

    places = hashed.select("node", "dim", F.posexplode("codes").alias("at", "code"))
    places = places.select("node", "dim", "code", F.floor(F.col("at") / (1 + probes)).cast("int").alias("table"), (F.col("at") % (1 + probes) == 0).alias("own"))
    bucket = ["table", "dim", "code"]
    live = places.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n"), F.count_if("own").alias("members")).where("n > 1 and members > 0")
    live = live.select(*bucket, F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    placed = places.join(live, bucket).withColumn("block", F.pmod(F.xxhash64("node", "table"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("node", *bucket, "own", "block", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"))
    met = placed.join(hashed.drop("dim"), "node").repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    found = stored(met.mapInArrow(_neighbours(cosine, tables, probes, np.float32 if single else np.float64), "node long, links long, root long"), "polytope-links")

    edges = found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = nodes.select("node", "weight", "least").join(counts, "node", "left").join(connected_components(edges), "node", "left")
    classes = stored(classes.select("node", "weight", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root")), "polytope-classes")
    best = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    result = classes.join(best, "root").select("node", (F.col("links") + F.col("weight") - 1).alias("n_links"), "component_id")
    out = rows.drop("embedding").join(result, "node", "left")
    component = F.when(F.col("fine"), F.col("component_id")).otherwise(F.col("vec_id")).cast(kind)
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )
