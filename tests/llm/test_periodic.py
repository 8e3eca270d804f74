import hashlib
import random
import zlib

import numpy as np

from tickloom.llm import periodic
from tickloom.llm.periodic import find_runs, periodic_runs, recurrences, with_planted_runs
from tickloom.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, runs string, n_words int"


def brute_runs(words):
    """Every (start, length, period) from the definition, period by period."""
    n, seen, out = len(words), set(), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and (i, j + q) not in seen:
                seen.add((i, j + q))
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def text_of(rng, kinds, n):
    out = []
    while len(out) < n:
        if rng.random() < 0.5:
            unit = [rng.choice(kinds) for _ in range(rng.randint(1, 14))]
            more = (unit * 9)[: rng.randint(1, 6 * len(unit))]
        else:
            more = [rng.choice(kinds) for _ in range(rng.randint(1, 9))]
        out += more
    return out[:n]


def test_find_runs_matches_the_definition():
    rng = random.Random(4)
    for case in range(250):
        kinds = list(range(rng.choice([1, 2, 2, 3, 5, 300])))
        texts = [text_of(rng, kinds, rng.choice([0, 1, 5, 6, 7, 40, 200])) for _ in range(rng.randint(1, 8))]
        ids = np.array([w for t in texts for w in t], np.int64)
        sizes = np.array([len(t) for t in texts], np.int64)
        got = list(zip(*(x.tolist() for x in find_runs(ids, sizes)), strict=True))
        want, base = [], 0
        for t in texts:
            want += [(base + s, n, q) for s, n, q in brute_runs(t)]
            base += len(t)
        assert got == want, (case, texts)


def test_sums_that_reach_the_prime_are_confirmed(monkeypatch):
    rng = random.Random(9)
    monkeypatch.setattr(periodic, "PRIME", 257)
    monkeypatch.setattr(periodic, "GENERATOR", 3)
    for cached in (periodic._roots, periodic._half_turn):
        cached.cache_clear()
    try:
        for _ in range(60):
            words = text_of(rng, list(range(rng.choice([2, 30, 200]))), 150)
            got = list(zip(*(x.tolist() for x in find_runs(np.array(words), np.array([150]))), strict=True))
            assert got == brute_runs(words)
    finally:
        for cached in (periodic._roots, periodic._half_turn):
            cached.cache_clear()


def test_recurrences_are_the_zero_sums():
    rng = np.random.default_rng(3)
    words = np.append(rng.integers(0, 2, 256), np.arange(2, 100))
    for block in (1, 2, 4, 8, 16):
        rows = np.arange(256 // block)
        got = recurrences(words, block, rows)
        for k in rows.tolist():
            own = words[k * block : (k + 1) * block]
            want = [np.array_equal(own, words[k * block + d : (k + 1) * block + d]) for d in range(block, 2 * block)]
            assert got[k].tolist() == want


def planted(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def check(got, rows):
    want = []
    for doc_id, words in rows:
        found = brute_runs(words)
        drop = {i for s, n, q in found for i in range(s + q, s + n)}
        left = b" ".join(w for i, w in enumerate(words) if i not in drop)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        best = min(((-n, s, q) for s, n, q in found), default=None)
        four = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
        want.append((str(doc_id), len(found), *four, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest()))
    have = [(str(r.doc_id), r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)


def test_query_matches_brute_force_on_documents(spark):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    docs = [(r.doc_id, planted(r.doc_id, r.text)) for r in docs]
    assert sum(bool(brute_runs(w)) for _, w in docs) > 5
    check(QUERIES["op13_periodic_runs"](spark, path).collect(), docs)


def test_odd_rows(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, " ".join(map(str, text_of(rng, list(range(3)), rng.randint(1, 120)))), "x", 1) for i in range(300)]
    rows += [(None, "a a a a a a a", None, None), (7, None, None, None), (8, "", None, None), (9, " \t\r\n\x0b\x0c ", None, None), (9, "é é  é é é é é\x0bé", None, 2)]
    rows += [(10, "x " * 30_000 + "y z " * 20_000, None, None)] + rows[:3] * 4
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    big = [r for r in rows if r[0] == 10 and len(r[1]) > 9999]
    got = QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()
    check([r for r in got if not (r.doc_id == 10 and r.length and r.length > 9999)], [(i, planted(i, t)) for i, t, _, _ in rows if (i, t) != big[0][:2]])
    long = [r for r in got if r.doc_id == 10 and r.length and r.length > 9999]
    assert [(r.n_runs, r.start, r.length, r.period) for r in long] == [(2, 30_000, 40_000, 2)]


def test_empty_table_and_drill(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert periodic_runs(empty).collect() == []
    rows = [(i, "a b  c d\te f g h" if i % 2 else f"{i} one two three", None, None) for i in range(200)] + [(None, "a b", None, None)]
    got = spark.createDataFrame(rows, SCHEMA).select("doc_id", with_planted_runs().alias("t")).collect()
    assert [r.t.split() for r in got] == [[w.decode() for w in planted(i, t)] for i, t, _, _ in rows]
