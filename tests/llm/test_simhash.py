import random
import re

import xxhash

from tickloom.llm.components import connected_components
from tickloom.llm.simhash import components, links

SCHEMA = "doc_id long, text string, fp string, k1 int"


def brute_print(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def reach(items, linked):
    root = {x: x for x in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    items = sorted(items)
    for i, a in enumerate(items):
        for b in items[:i]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {x: find(x) for x in items}


def test_matches_brute_force(spark):
    rng = random.Random(3)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)] + ["É", "ß x"]
    rows = []
    for i in range(60):
        words = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 150, 400]))]
        rows.append((i, " ".join(words), "x", 1))
        for _ in range(rng.randint(0, 3)):
            words = list(words)
            words[rng.randrange(len(words))] = rng.choice(vocab)
            rows.append((len(rows) + 1000, "  ".join(words).upper() if rng.random() < 0.3 else "\n".join(words), None, None))
    rows += [(5000, None, None, None), (5001, "", None, None), (5002, " \t\n", None, None), (None, rows[0][1], None, None), (7, rows[7][1], "x", 1)]
    prints = [brute_print(r[1]) for r in rows]
    root = reach(set(prints), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for r, p in zip(rows, prints, strict=True):
        if r[0] is not None:
            least[root[p]] = min(least.get(root[p], r[0]), r[0])
    want = sorted((str(r[0]), p, least[root[p]]) for r, p in zip(rows, prints, strict=True))
    got = components(spark.createDataFrame(rows, SCHEMA), leaf_rows=40).collect()
    assert sorted((str(r.doc_id), r.fp % (1 << 64), r.component_id) for r in got) == want
    heads = [r for r in got if r.first]
    assert len({(r.k1, r.k2) for r in heads}) == len(set(root.values()))


def test_links_in_a_dense_ball_reach_every_pair(spark):
    rng = random.Random(8)
    base = rng.getrandbits(64)
    spots = rng.sample(range(64), 12)
    ball = {base}
    while len(ball) < 400:
        x = base
        for b in rng.sample(spots, rng.randint(1, 5)):
            x ^= 1 << b
        ball.add(x)
    ball |= {rng.getrandbits(64) for _ in range(100)} | {0, 3, (1 << 64) - 1, 1 << 63}
    want = reach(ball, lambda a, b: (a ^ b).bit_count() <= 2)
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in ball], "fp long")
    got = links(df, leaf_rows=37)
    root = {r.node: r.root for r in connected_components(got).collect()}
    pairs = {(r.a % (1 << 64), r.b % (1 << 64)) for r in got.collect()}
    assert all(want[a] == want[b] for a, b in pairs)
    groups = {}
    for x in ball:
        s = x - (1 << 64) if x >> 63 else x
        groups.setdefault(want[x], set()).add(root.get(s, s))
    assert all(len(v) == 1 for v in groups.values())


def test_chain_and_hub_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101 + i) for i in range(40)] + [(7, 7), (100, 101)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 51)} | {101 + i: 100 for i in range(40)}


def test_empty_table(spark):
    assert components(spark.createDataFrame([], SCHEMA)).count() == 0
