import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom.llm import quality, toxicity
from tickloom.llm.labelled import training_ids
from tickloom.llm.quality import FEATURES, Trees, grow, score_quality, text_statistics
from tickloom.llm.rows import utf8
from tickloom.llm.toxicity import score_toxicity, word_rows

DOCS = "doc_id long, text string, lang string, score string, x string, label int"
LABELS = "doc_id long, quality int, toxic int, text string"


def test_statistics_match_a_plain_count():
    texts = ["", " \n ", "One two two, TWO!!\nOne é #x\nOne é #x", "a", "shti shti shti", "x" * 50 + ". Y?"]
    got = text_statistics(pa.array(texts))
    for text, row in zip(texts, got, strict=True):
        raw, words = text.encode(), text.encode().split()
        lines = [x for x in raw.split(b"\n") if x]
        want = {
            "log_bytes": np.log1p(len(raw)), "log_words": np.log1p(len(words)), "word_bytes": sum(map(len, words)) / max(1, len(words)), "log_lines": np.log1p(len(lines)),
            "distinct_words": len(set(words)) / max(1, len(words)), "same_as_last": sum(a == b for a, b in zip(words, words[1:])) / max(1, len(words)),
            "distinct_lines": len(set(lines)) / max(1, len(lines)), "shouts": raw.count(b"!") / max(1, len(raw)), "long_words": sum(len(w) > 15 for w in words) / max(1, len(words)),
            "digits": sum(48 <= c < 58 for c in raw) / max(1, len(raw)), "sentence_ends": sum(w[-1:] in (b".", b"?") for w in words) / max(1, len(words)),
        }
        for name, value in want.items():
            assert row[FEATURES.index(name)] == pytest.approx(value), (text, name)


def test_flattened_trees_equal_a_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, len(FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = grow(x, y, trees=20, depth=3)
    assert ((trees.score(x) > 0.5) == y).mean() > 0.95

    def walk(row):
        total = trees.start
        for f, c, v in zip(trees.feature, trees.limit, trees.value, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > c[node] else 1)
            total += v[node - len(f)]
        return 1 / (1 + np.exp(-total))

    assert trees.score(x[:50]) == pytest.approx([walk(r) for r in x[:50]])
    assert isinstance(grow(x, np.ones(500)), Trees) and len(set(grow(x, np.ones(500)).score(x))) == 1


def test_word_rows_do_not_depend_on_the_batch():
    texts = ["Alpha beta", "", "beta gamma-Alpha", "é"]
    rows, before = word_rows(*utf8(pa.array(texts)))
    assert before.tolist() == [0, 2, 2, 5, 6]
    assert (rows[0] == rows[4]).all() and (rows[1] == rows[2]).all()
    for k, t in enumerate(texts):
        assert (word_rows(*utf8(pa.array([t])))[0] == rows[before[k] : before[k + 1]]).all()


def corpus(n):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 120))]
        toxic, good = rng.random() < 0.3, rng.random() < 0.8
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["vilka", "vilkos", "grobb"])
        text = " ".join(words) if good else " ".join(w + "###" for w in words)
        docs.append((i, text, rng.choice(["en", "de", None]), "s", "x", 1))
        labels.append((i, int(good), int(toxic), "t"))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus(900)
    more = [(None, docs[0][1], None, None, None, None), (5000, None, None, None, None, None), (5001, "", "en", "s", "x", 1), (5002, "?!", "xx", "s", "x", 1), (3, docs[3][1], "en", "s", "x", 1)]
    lab = spark.createDataFrame([*labels, labels[0], (None, 1, 1, ""), (5000, None, None, "")], LABELS)
    df = spark.createDataFrame(docs + more, DOCS)
    for score, k, least in ((score_quality, 1, 0.97), (score_toxicity, 2, 0.93)):
        got = score(df, lab).collect()
        assert len(got) == len(docs) + len(more) and all(0 <= r.score <= 1 for r in got)
        truth = {x[0]: x[k] for x in labels}
        assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
        test = [r for r in got if r.held_out and r.doc_id in truth]
        assert len(test) > 100 and np.mean([(r.score >= 0.5) == truth[r.doc_id] for r in test]) > least


def test_sample_is_bounded_and_never_held_out(spark):
    lab = spark.createDataFrame(corpus(200)[1], LABELS)
    ids = [r.doc_id for r in training_ids(lab, "toxic", 50).collect()]
    assert len(ids) == 50 and not any(zlib.crc32(str(i).encode()) % 5 == 0 for i in ids)


def test_scores_ignore_language(spark):
    docs, labels = corpus(200)
    lab = spark.createDataFrame(labels, LABELS)
    net = toxicity.fit(spark.createDataFrame(docs, DOCS), lab)
    rows = word_rows(*utf8(pa.array(["vilka a b"])))
    assert net.score(*rows) == net.score(*rows) and set(net.thresholds) == {"", "en", "de"}


def test_empty_tables(spark):
    none, lab = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    docs = spark.createDataFrame(corpus(5)[0], DOCS)
    for score in (score_quality, score_toxicity):
        assert score(none, lab).collect() == []
        assert len({r.score for r in score(docs, lab).collect()}) == 1
    assert quality.TRAIN_ROWS > 0


def test_network_equals_a_plain_loop():
    rng = np.random.default_rng(5)
    net = toxicity.train([rng.integers(0, toxicity.BUCKETS, (n, len(toxicity.PARTS))).astype(np.int32) for n in (9, 4, 7, 12)], np.array([0.0, 1, 0, 1]), epochs=1)
    texts = ["one two three four", "", "solo", "a b", "x y z " * 50]
    got = net.score(*word_rows(*utf8(pa.array(texts))))
    for text, score in zip(texts, got, strict=True):
        rows, _ = word_rows(*utf8(pa.array([text])))
        vectors = [sum(net.embedding[r] for r in word) for word in rows]
        logit = net.bias
        for k, width in enumerate(toxicity.WIDTHS):
            for f in range(toxicity.FILTERS):
                best = 0.0
                for i in range(len(vectors) - width + 1):
                    window = sum(float(vectors[i + j] @ net.filters[k][j][:, f]) for j in range(width))
                    best = max(best, window + float(net.shifts[k][f]))
                logit += best * float(net.out[k * toxicity.FILTERS + f])
        assert score == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-5)


def test_sample_holds_one_row_an_id_within_its_bytes(spark):
    docs = [(i, "x" * 10, "en", "s", "x", 1) for i in range(20)] + [(3, "repeated", "de", None, None, None)] * 500
    ids = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, label int")
    df = spark.createDataFrame(docs, DOCS)
    every = toxicity._bounded(df, ids, 1_000).collect()
    assert sorted(r.doc_id for r in every) == list(range(20)) and all(r.label == r.doc_id % 2 for r in every)
    assert [r.text for r in every if r.doc_id == 3] == ["repeated"]
    some = {r.doc_id for r in toxicity._bounded(df, ids, 55).collect()}
    first = [r.doc_id for r in ids.orderBy(F.xxhash64("doc_id"), "doc_id").collect()][: len(some)]
    assert len(some) == 5 and some == set(first)
    assert toxicity._bounded(df, ids, 0).collect() == [] and toxicity._bounded(df.limit(0), ids, 55).collect() == []


def test_score_is_calibrated_at_half(spark):
    docs, labels = corpus(900)
    net = toxicity.fit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    assert net.thresholds[""] == pytest.approx(0.5, abs=0.1)


def test_very_long_texts_are_scored_whole(spark):
    docs, labels = corpus(600)
    lab = spark.createDataFrame(labels, LABELS)
    long = [(9_000, "abc de " * 400_000, "en", "s", "x", 1), (9_001, "abc de " * 400_000 + "vilka", "en", "s", "x", 1)]
    got = {r.doc_id: r.score for r in score_toxicity(spark.createDataFrame(docs + long, DOCS), lab).collect()}
    assert got[9_001] > got[9_000]
    assert all(0 <= r.score <= 1 for r in score_quality(spark.createDataFrame(docs + long, DOCS), lab).where("doc_id >= 9000").collect())


def test_all_labelled_texts_are_learned_from_in_parts(spark, monkeypatch):
    """8,600 labelled texts, dealt into parts; a word that few of them hold, all of one class, is learned."""
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choice("abcdefghijkl") * 3 for _ in range(6)) + (" vilka" if i % 4 == 0 else ""), "en", "s", "x", 1) for i in range(11_000)]
    labels = [(i, 1, int(i % 4 == 0), "") for i in range(11_000)]
    df, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    monkeypatch.setattr(toxicity, "PART_ROWS", 2_000)
    seen, fresh = [], toxicity.fresh
    monkeypatch.setattr(toxicity, "fresh", lambda n, pos: seen.append(n) or fresh(n, pos))
    got = score_toxicity(df, lab).where("held_out").collect()
    known = [i for i in range(11_000) if zlib.crc32(str(i).encode()) % 5]
    assert 0.78 * len(known) < seen[0] < 0.82 * len(known)
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 4 == 0) for r in got]) > 0.99


def test_one_part_is_trained_as_without_spark(spark):
    docs, labels = corpus(60)
    y = np.array([float(x[2]) for x in labels])
    df = spark.createDataFrame([(d[0], int(v), d[1]) for d, v in zip(docs, y, strict=True)], "doc_id long, label int, text string")
    order = [r.doc_id for r in df.orderBy(F.xxhash64("doc_id")).collect()]
    texts = [word_rows(*utf8(pa.array([docs[i][1]])))[0] for i in order]
    want, got = toxicity.train(texts, y[order]), toxicity._trained(df)
    for a, b in zip([*want.weights(), want.bias], [*got.weights(), got.bias], strict=True):
        assert a == pytest.approx(b, abs=1e-4)


def test_texts_are_dealt_once_for_all_turns(spark, monkeypatch):
    tables, stored = [], toxicity.stored
    monkeypatch.setattr(toxicity, "PART_ROWS", 20)
    monkeypatch.setattr(toxicity, "stored", lambda df, name: tables.append((name, stored(df, name))) or tables[-1][1])
    docs, labels = corpus(60)
    rows = [(d[0], x[2], d[1]) for d, x in zip(docs, labels, strict=True)]
    toxicity._trained(spark.createDataFrame(rows, "doc_id long, label int, text string"))
    assert [name for name, _ in tables] == ["toxicity-parts"]
    parts = [pa.ipc.open_stream(r.packed).read_all().to_pylist() for r in tables[0][1].collect()]
    assert len(parts) == 3 and sorted((x["label"], x["text"]) for part in parts for x in part) == sorted(x[1:] for x in rows)
