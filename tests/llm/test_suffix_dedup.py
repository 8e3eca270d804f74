import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa

from tickloom.llm import suffix_dedup
from tickloom.llm.suffix_dedup import remove_repeats

SCHEMA = "doc_id long, text string, k1 string, spans string"


def brute(texts, threshold):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + threshold] for b in raw for i in range(len(b) - threshold + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - threshold + 1):
            if seen[b[i : i + threshold]] > 1:
                gone[i : i + threshold] = b"\1" * threshold
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def run(spark, rows, threshold, side):
    df = spark.createDataFrame(rows, SCHEMA)
    out = remove_repeats(df, threshold, side).collect()
    return sorted(((r.doc_id is None, r.doc_id), r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in out)


def expected(rows, threshold):
    return sorted(((r[0] is None, r[0]), *x) for r, x in zip(rows, brute([r[1] for r in rows], threshold), strict=True))


def corpus(rng, n):
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(15, 70))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts.append(rng.choice(passages) if rng.random() < 0.4 else "".join(rng.choice("abcdefgh é") for _ in range(rng.randint(1, 60))))
        rows.append((i, "".join(parts), "x", "y"))
    return rows


def test_matches_brute_force(spark):
    rng = random.Random(5)
    rows = corpus(rng, 60)
    rows += [(100 + i, rows[i][1], None, None) for i in range(5)]  # copies
    rows += [(None, rows[7][1], "", ""), (None, None, None, None), (3, rows[3][1], "x", "y"), (200, "", "", ""), (201, "a" * 90, "", ""), (202, "ab" * 60, "", "")]
    assert run(spark, rows, 20, 3) == expected(rows, 20)


def test_long_texts_are_cut_into_parts_without_loss(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, "".join(r[1] for r in corpus(rng, 12)), "", "") for i in range(4)]
    monkeypatch.setattr(suffix_dedup, "_SLICE", 64)
    anchors = suffix_dedup._anchors(20, 3)
    import pyarrow as pa

    texts = [r[1] for r in rows]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(4)), pa.array(range(4))], names=["text", "k1", "k2"])
    got = pa.Table.from_batches(list(anchors(iter([batch])))).to_pylist()
    for k, text in enumerate(texts):  # every window is in the block of one of its anchors
        cells = [(x["at"] >> 16, x["at"] >> 8 & 255, x["at"] & 255) for x in got if x["k1"] == k]
        starts = Counter(s for pos, back, less in cells for s in range(pos - back, pos - less + 1))
        assert set(starts) == set(range(len(text.encode()) - 19))


def test_production_depth(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    shared = " ".join(word() for _ in range(90))
    rows = [(i, " ".join(word() for _ in range(40)) + shared[rng.randint(0, 40) :] + " ".join(word() for _ in range(60)), "", "") for i in range(12)]
    rows.append((50, shared[:399], "", ""))
    assert run(spark, rows, 400, 16) == expected(rows, 400)


def test_hot_groups_take_the_counted_way(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_GROUP", 3)
    rng = random.Random(15)
    rows = corpus(rng, 60)
    assert run(spark, rows, 20, 3) == expected(rows, 20)


def test_blocks_one_at_a_time(spark):
    rng = random.Random(21)
    shared = "".join(rng.choice("abcdefgh") for _ in range(30))  # thousands of spans with one digit
    rows = [(i, "".join(rng.choice("xyz") for _ in range(9)) + shared + "".join(rng.choice("xyz") for _ in range(9)), "", "") for i in range(6000)]
    assert run(spark, rows, 20, 3) == expected(rows, 20)


def test_empty_table(spark):
    assert run(spark, [], 400, 16) == []


def test_a_large_group_is_refined_in_little_memory():
    """30,000 spans that share a digit, in batches as they come from a shuffle."""
    rng = np.random.default_rng(7)
    n, length = 30_000, 655
    spans = [rng.integers(97, 123, length, dtype=np.uint8).tobytes() for _ in range(n // 2)]
    spans = [s[:300] + b"*" * 55 + s[355:] for s in spans]
    spans += [s[:-1] + b"#" for s in spans]
    at = suffix_dedup._place(np.full(n, 255), np.zeros(n, np.int64), np.full(n, 255))
    columns = {"k1": np.arange(n), "k2": np.arange(n), "g": np.zeros(n, np.int64), "at": at, "salt": np.full(n, -1, np.int32)}
    table = pa.table({**{k: pa.array(v) for k, v in columns.items()}, "span": pa.array(spans, pa.binary())})
    batches = table.to_batches(max_chunksize=5_000)
    tracemalloc.start()
    base = pa.total_allocated_bytes()
    most, marked = 0, 0
    for out in suffix_dedup._refined(400, 16)(iter(batches)):
        most = max(most, pa.total_allocated_bytes() - base)
        marked += len(out)
    peak = tracemalloc.get_traced_memory()[1] + most
    tracemalloc.stop()
    assert marked == n  # each span's first 255 windows have a twin
    assert peak < 100 << 20
