import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tickloom.llm import syncmers
from tickloom.llm.syncmers import ANCHORS, K, anchors, compare_edits, fingerprint

SCHEMA = "doc_id long, text string, next string, found string, _bucket int"


def hashes(spark, values):
    """Spark's own 64-bit hash, which the brute-force choice is built on."""
    return [r[0] for r in spark.createDataFrame([tuple(v) for v in values], ",".join(f"c{i} {'string' if isinstance(x, str) else 'long'}" for i, x in enumerate(values[0]))).select(F.xxhash64("*")).collect()]


def brute_anchors(spark, tokens, text):
    out = {}
    if len(tokens) >= K:
        h = hashes(spark, [(t,) for t in tokens])
        pairs = hashes(spark, list(zip(h, h[1:], strict=False)))
        picks = [i for i in range(len(pairs) - K + 2) if min(pairs[i : i + K - 1]) in (pairs[i], pairs[i + K - 2])]
        if picks:
            for i, x in zip(picks, hashes(spark, [tuple(pairs[i : i + K - 1 : 2]) for i in picks]), strict=True):
                out.setdefault(x % (1 << 64) >> 33, i)
    if not out:
        out = {hashes(spark, [(text,)])[0] % (1 << 64) >> 33: 0}
    return [h << 31 | i for h, i in sorted(out.items())[:ANCHORS]]


def brute_like(a, b):
    top = min(x[-1] >> 31 if len(x) >= ANCHORS else 1 << 31 for x in (a, b))
    one, two = ({x >> 31: x & (1 << 31) - 1 for x in y if x >> 31 <= top} for y in (a, b))
    moves = sorted(two[h] - one[h] for h in one if h in two)
    near = [d for d in moves if abs(d - moves[len(moves) // 2]) <= syncmers.SLACK]
    return 2 * len(near) / (len(one) + len(two))


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(n))


def test_anchors_match_brute_force(spark):
    rng = random.Random(1)
    texts = [words(rng, n) for n in (1, 3, 30, 60, 90, 150, 700)] + ["", "x" * 500, "ab " * 300, "😀é" * 20]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select("i", anchors(F.col("text")).alias("a")).orderBy("i").collect()
    for text, row in zip(texts, got, strict=True):
        want_words = brute_anchors(spark, text.split(" ") if not text.endswith(" ") else [*text.split()] + [""], text) if len(text) >= 400 else None
        assert row.a.words == want_words
        assert row.a.chars == (brute_anchors(spark, list(text) or [""], text) if len(text) < 800 else None)


@pytest.mark.parametrize("rows_each", [1000, 4])
def test_edits_and_neighbours(spark, monkeypatch, rows_each):
    monkeypatch.setattr(syncmers, "BUCKET_ROWS", rows_each)
    rng = random.Random(4)
    rows = [(i * 3, words(rng, rng.choice([0, 1, 8, 90, 300, 600])), "n", "f", 1) for i in range(30)]
    rows += [(95, None, None, None, None), (96, "", "n", "f", 1), (97, rows[3][1], "n", "f", 1), (98, rows[3][1], "n", "f", 1), (None, "no id here", "n", "f", 1), (6, "a", "n", "f", 1)]
    got = compare_edits(spark.createDataFrame(rows, SCHEMA)).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = {}
    for r, after in zip(order, order[1:] + order[:1], strict=True):
        t, n = r[1] or "", len(r[1] or "") // 4
        edited = t[: len(t) - n] + (after[1] or "")[:n]
        want.setdefault(r[0], []).append((len(t), hashlib.sha256(edited.encode()).hexdigest()))
    found = {}
    for r in got:
        found.setdefault(r.doc_id, []).append((r.n_chars, r.edited_sha256))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.n_chars > 600:
            assert r.near_edited > 0.5
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    by_id = {r.doc_id: r for r in got}
    assert by_id[97].fingerprint == by_id[98].fingerprint == by_id[9].fingerprint and by_id[97].near_next == 1.0
    long_ones = [r for r in got if r.n_chars > 600 and r.doc_id not in (97,)]
    assert max(r.near_next for r in long_ones) < 0.3


def test_one_id_on_most_rows(spark, monkeypatch):
    """Rows of one id, of no id, and copies of one row are cut into ranges and keep their order."""
    monkeypatch.setattr(syncmers, "BUCKET_ROWS", 5)
    rng = random.Random(9)
    rows = [(i, words(rng, 12)) for i in range(20)] + [(7, words(rng, 9)) for _ in range(60)]
    rows += [(7, "same again")] * 33 + [(None, rng.choice(["", "x", words(rng, 4)])) for _ in range(50)] + [(None, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    got = [(r.doc_id, r.text, r.own, r.next) for r in syncmers.with_next(docs, lambda x: F.concat(x, F.lit("!"))).collect()]
    order = sorted(((a, b or "") for a, b in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want = [(a, b, b + "!", after[1] + "!") for (a, b), after in zip(order, order[1:] + order[:1], strict=True)]
    assert sorted(got, key=str) == sorted(want, key=str)
    cut = syncmers._cut_again(docs.withColumn("_bucket", F.lit(0)), 5)
    assert cut.count() == len(set(order)) and cut.select("_sub").distinct().count() > 5


def test_likeness_matches_brute_force(spark):
    rng = random.Random(6)
    base = words(rng, 400)
    pairs = [(base, base), (base, base[:1200] + words(rng, 100)), (words(rng, 80) + " " + base, base), (base, words(rng, 400)), (base, base * 3)]
    df = spark.createDataFrame(pairs, "a string, b string").select(anchors(F.col("a")).alias("a"), anchors(F.col("b")).alias("b"))
    rows = df.select("a", "b", syncmers.likeness(F.col("a"), F.col("b")).alias("like"), fingerprint(F.col("a")).alias("fp")).collect()
    assert [r.like for r in rows] == pytest.approx([brute_like(r.a.words, r.b.words) for r in rows])
    assert rows[0].like == 1.0 and rows[1].like > 0.5 and rows[3].like < 0.1


def test_empty_table(spark):
    assert compare_edits(spark.createDataFrame([], SCHEMA)).collect() == []
