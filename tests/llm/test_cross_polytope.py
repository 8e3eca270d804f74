import math
import random

import numpy as np

from tickloom.llm.cross_polytope import buckets, similar_vectors, unit
from tickloom.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, node string, n_links int"


def brute(rows, cosine=0.9):
    """n_links and component_id of each row, all pairs compared in double precision."""
    fine = {}
    for r, row in enumerate(rows):
        v = row[1]
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            v = np.array(np.array(v, np.float32), float)
            v /= np.abs(v).max()
            fine.setdefault(len(v), []).append((r, v / np.linalg.norm(v)))
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for group in fine.values():
        at = [r for r, _ in group]
        m = np.stack([v for _, v in group])
        near = m @ m.T >= cosine
        for a, b in zip(*np.nonzero(np.triu(near, 1)), strict=True):
            links[at[a]] += 1
            links[at[b]] += 1
            root[find(at[a])] = find(at[b])
    least = {}
    for r, row in enumerate(rows):
        if row[0] is not None:
            least[find(r)] = min(row[0], least.get(find(r), row[0]))
    return [(str(row[0]), links[r], str(least.get(find(r))), row[0] == least.get(find(r))) for r, row in enumerate(rows)]


def have(df):
    return sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in df.collect())


def near(rng, v, cosine):
    z = rng.normal(size=len(v))
    z -= z @ v * v
    return cosine * v + math.sqrt(1 - cosine * cosine) * z / np.linalg.norm(z)


def test_groups_and_odd_rows_match_brute_force(spark):
    rng, order = np.random.default_rng(1), random.Random(1)
    vectors = []
    for size in (1, 1, 2, 3, 40, 700):
        v = unit(rng.normal(size=(1, 48)))[0]
        vectors += [near(rng, v, 0.985) * rng.choice([1, 3e-30, 1e20]) for _ in range(size)]
    rows = [(i, [float(np.float32(x)) for x in v], "x", 1) for i, v in enumerate(vectors)]
    rows += [(2000 + i, rows[60 + i % 3][1], None, None) for i in range(50)]  # copies
    rows += [(None, rows[60][1], None, None), (None, rows[0][1], None, None), (5, rows[1][1], None, None), (5, rows[1][1], None, None)]
    rows += [(3000, None, None, None), (3001, [], None, None), (3002, [0.0] * 48, None, None), (3003, [None, *[1.0] * 47], None, None)]
    rows += [(3004, [float("nan")] * 48, None, None), (3005, [float("inf"), *[0.0] * 47], None, None), (None, None, None, None)]
    rows += [(3006, [1.0], None, None), (3007, [2.5], None, None), (3008, [-1.0], None, None), (3009, [1.0, 0.0, -0.0], None, None), (3010, [1.0, 0.0, 0.0], None, None)]
    order.shuffle(rows)
    table = spark.createDataFrame(rows, SCHEMA)
    want = sorted(brute(rows))
    assert have(similar_vectors(table)) == want
    # Blocks of a bucket, their pairs and the first-meeting rule count every pair once.
    assert have(similar_vectors(table, block=64)) == want


def test_recall_at_the_threshold():
    rng = np.random.default_rng(2)
    x = unit(rng.normal(size=(2000, 64)))
    y = np.stack([near(rng, v, 0.9) for v in x])
    a, b = buckets(x, 5, 2, 3), buckets(y, 5, 2, 3)
    met = ((a[:, :, :1] == b) | (b[:, :, :1] == a)).any(axis=(1, 2))
    assert met.mean() > 0.97
    far = unit(rng.normal(size=(2000, 64)))
    c = buckets(far, 5, 2, 3)
    assert ((a[:, :, :1] == c) | (c[:, :, :1] == a)).any(axis=(1, 2)).mean() < 0.01


def test_query_on_the_given_vectors(spark):
    path = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    got, want = have(QUERIES["op11_cross_polytope_near_dedup"](spark, path)), sorted(brute(rows))
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert 0.9 * there <= found <= there
    assert sum(a != b for a, b in zip(got, want, strict=True)) <= 0.01 * len(want)


def test_double_vectors_and_empty_table(spark):
    schema = "vec_id int, embedding array<double>"
    assert similar_vectors(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, [1e300, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1e-300]), (4, [-1.0, 0.0])]
    got = similar_vectors(spark.createDataFrame(rows, schema))
    assert dict(got.dtypes) == {"vec_id": "int", "n_links": "bigint", "component_id": "int", "kept": "boolean"}
    assert have(got) == [("1", 1, "1", True), ("2", 1, "1", False), ("3", 0, "3", True), ("4", 0, "4", True)]
