import random
import re
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from tickloom.llm import winnowing
from tickloom.llm.winnowing import contamination

DOCS = "doc_id long, text string, item_id string, k1 string"
ITEMS = "item_id long, text string, doc_id string"


def words_of(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(docs, items, size=10):
    windows = []
    for i, t, _ in items:
        w = words_of(t)
        n = min(size, len(w))
        windows += [(i, w[a : a + n]) for a in range(len(w) - n + 1) if n]
    out = []
    for d, t, *_ in docs:
        w = words_of(t)
        hit, ids = set(), set()
        for i, x in windows:
            for a in range(len(w) - len(x) + 1):
                if w[a : a + len(x)] == x:
                    hit |= set(range(a, a + len(x)))
                    ids.add(i)
        out.append((str(d), len(w), len(hit), sorted(str(x) for x in ids if x is not None)))
    return sorted(out)


def run(spark, docs, items, **more):
    got = contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **more).collect()
    return sorted((str(r.doc_id), r.n_words, r.n_hit, sorted(map(str, r["items"]))) for r in got)


@pytest.mark.parametrize("bits", [25, 6])  # a table of 64 bits lets nearly everything pass
def test_matches_brute_force(spark, bits):
    rng = random.Random(bits)
    vocab = ["alpha", "Beta", "É", "γ7", "x", "don", "42", "Über", "end"]
    word = lambda: rng.choice(vocab)
    items = [(i, " ".join(word() for _ in range(rng.choice([2, 5, 9, 10, 11, 14, 30]))), "c") for i in range(25)]
    items += [(30, "", "c"), (31, None, "c"), (32, "...", None), (3, "Beta-x 42! x x x Beta alpha, alpha end end end", "c"), (None, "end end Beta", "c")]
    docs = []
    for i in range(60):
        parts = [word() for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.6:
            parts[rng.randint(0, len(parts)) :] = re.split(" ", rng.choice(items)[1] or "")
        docs.append((i, rng.choice([" ", "  ", ", ", "\n-"]).join(parts).upper() if rng.random() < 0.2 else " ".join(parts), "a", "b"))
    docs += [(None, docs[3][1], "a", "b"), (3, docs[3][1], "a", "b"), (100, None, None, None), (101, "", "a", "b"), (102, "\x00\x7f", "a", "b")]
    assert run(spark, docs, items, table_bits=bits) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = [(1, "one two three", "a", "b")], [(1, "two three", "c")]
    assert run(spark, [], items) == []
    assert run(spark, docs, []) == [("1", 3, 0, [])]
    assert run(spark, docs, items) == [("1", 3, 2, ["1"])]


def test_the_table_is_broadcast_as_bits(spark, monkeypatch):
    sizes, kind = [], type(spark.sparkContext)
    of = kind.broadcast
    monkeypatch.setattr(kind, "broadcast", lambda self, x: sizes.append(x.nbytes) or of(self, x))
    assert run(spark, [(1, "one two three", "a", "b")], [(1, "two three", "c")]) == [("1", 3, 2, ["1"])]
    assert sizes == [1 << 22]


def test_a_scan_takes_little_memory():
    """A batch of 8 MB: what is made of it at once does not grow with it."""
    rng = random.Random(3)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(900)]
    texts = [" ".join(rng.choice(vocab) for _ in range(600)) for _ in range(2_000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(2_000)), "text": texts, "k1": list(range(2_000)), "k2": list(range(2_000))})
    table = SimpleNamespace(value=np.zeros(1 << 19, np.int64))
    scan = winnowing._candidates(10, 5, 25, [], table)
    assert sum(len(x) for x in scan(iter([batch.slice(0, 20)]))) == 20  # powers of hashes are kept
    tracemalloc.start()
    assert sum(len(x) for x in scan(iter([batch]))) == 2_000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 << 20
