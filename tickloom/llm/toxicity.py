"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word's vector is the sum of the embedding rows that the word and its first bytes hash to, so
inflected forms share most of it; filters of several widths run over the text, their
rectified activations are pooled by their maximum over the whole text, and a logistic unit reads
the pool.  One dimension of the embedding starts as the log odds of its row in the training
texts; all weights are then trained by stochastic gradients, which only reach the words that won a
maximum.  A score does not depend on the language; the threshold at which a text is flagged does,
and is set on training texts that the weights were not fitted to.  The logit is then shifted so that
the threshold of all texts lies at 0.5.

All labelled texts that are not held out are learned from.  They are dealt into parts of bounded size;
in each round every part's task makes one pass from the same weights, and a row of weights then moves
by the mean of the moves of the parts that moved it.  Document counts, moves and counts of scores
are summed by Spark, so the driver gets tables whose size does not depend on the texts.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.hashing import Rolling, mixed
from tickloom.llm.labelled import held_out, training_ids
from tickloom.llm.rows import MOST_KEYS, runs, utf8
from tickloom.llm.winnowing import _LOWER, split_words
from tickloom.sources.writers import stored

#: About how many texts, and how many of their bytes, one task learns from in a round.
PART_ROWS, PART_BYTES = 4_096, 32 << 20
#: Bytes from a word's start that are hashed; 0 is the whole word.
PARTS = (0, 4, 6)
BUCKETS, SIZE, WIDTHS, FILTERS = 1 << 16, 8, (1, 2, 3), 8
EPOCHS, BATCH, RATE = 3, 64, 0.02
#: Words of the texts of one step; a longer text is a step by itself.
BATCH_WORDS = 1 << 18
#: One text in so many sets thresholds instead of weights.
CALIBRATE_ONE_IN = 5
#: Steps of a logit by which scores of calibration texts are counted, and the last one.
FINE, LAST_STEP = 1_000, 40_000
_SLICE = 1 << 20


def word_rows(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of all words, ``PARTS`` for each, and the words before each text."""
    lower = _LOWER[data]
    starts, ends, before = split_words(lower, at)
    rolling = Rolling(lower)
    parts = [mixed(rolling.ranges(starts, np.minimum(ends, starts + n) if n else ends), 31 + n) % np.uint64(BUCKETS) for n in PARTS]
    return np.column_stack(parts).astype(np.int32), before


@dataclass
class Network:
    embedding: np.ndarray
    filters: list[np.ndarray]  # by width: width x SIZE x FILTERS
    shifts: list[np.ndarray]
    out: np.ndarray
    bias: float
    thresholds: dict[str, float] = field(default_factory=dict)

    def activations(self, rows: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Rectified filter outputs by the first word of each window; zero where it leaves its text."""
        e = sum(self.embedding[rows[:, k]] for k in range(len(PARTS)))
        left = np.repeat(before[1:], np.diff(before)) - np.arange(len(rows))  # words to the text's end
        parts = []
        for w, weights, shift in zip(WIDTHS, self.filters, self.shifts, strict=True):
            a = np.zeros((len(rows), FILTERS), np.float32)
            n = max(0, len(rows) - w + 1)
            if n:
                a[:n] = shift
                for k in range(w):
                    a[:n] += e[k : k + n] @ weights[k]
                np.maximum(a, 0, out=a)
                a[left < w] = 0
            parts.append(a)
        return np.concatenate(parts, axis=1)

    def pooled(self, rows: np.ndarray, before: np.ndarray) -> np.ndarray:
        pool = np.zeros((len(before) - 1, FILTERS * len(WIDTHS)), np.float32)
        full = np.flatnonzero(np.diff(before))
        if len(full):
            pool[full] = np.maximum.reduceat(self.activations(rows, before), before[:-1][full], axis=0)
        return pool

    def score(self, rows: np.ndarray, before: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logits(rows, before)))

    def logits(self, rows: np.ndarray, before: np.ndarray) -> np.ndarray:
        return (self.pooled(rows, before) @ self.out + self.bias).astype(np.float64)

    def weights(self) -> list[np.ndarray]:
        """All that is trained but the bias; changes to these arrays change the network."""
        return [self.embedding, *self.filters, *self.shifts, self.out]


def _batch(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    before = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return (np.concatenate(texts) if texts else np.zeros((0, len(PARTS)), np.int32)), before


def fresh(n: int, positive: float, seed: int = 3) -> Network:
    """Random weights, and the bias of ``positive`` among ``n`` texts."""
    rng = np.random.default_rng(seed)
    share = (positive + 0.5) / (n + 1)
    return Network(
        rng.normal(0, 0.1, (BUCKETS, SIZE)).astype(np.float32),
        [rng.normal(0, 0.2, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        np.zeros(FILTERS * len(WIDTHS), np.float32),
        float(np.log(share / (1 - share))),
    )


def prime(net: Network, seen: np.ndarray, pos: float, neg: float) -> None:
    """Start from the log odds of embedding rows; ``seen`` has the texts of each class that hold a row."""
    net.embedding[:, 0] = np.log((seen[1] + 2) / (pos + 4)) - np.log((seen[0] + 2 * neg / pos) / (neg + 4 * neg / pos))
    for f in net.filters:
        f[:, 0, : FILTERS // 2] = np.abs(f[:, 0, : FILTERS // 2]) + 0.5
    net.out[:] = 0.1


def train(texts: list[np.ndarray], y: np.ndarray, seed: int = 3, epochs: int = EPOCHS) -> Network:
    """A network for the chance that y is 1, from the word rows of texts."""
    net = fresh(len(y), y.sum(), seed)
    if not 0 < y.sum() < len(y):
        return net
    seen = np.zeros((2, BUCKETS))
    for t, label in zip(texts, y, strict=True):
        seen[int(label), np.unique(t)] += 1
    prime(net, seen, y.sum(), len(y) - y.sum())
    past = Past.of(net)
    for k in range(epochs):
        one_pass(net, past, texts, y, np.random.default_rng([seed, k]))
    return net


@dataclass
class Past:
    """Sums of squared gradients, by weight."""

    weights: list[np.ndarray]
    bias: float

    @staticmethod
    def of(net: Network) -> Past:
        return Past([np.full(p.shape, 1e-4, np.float32) for p in net.weights()], 1e-4)


def flat(weights: list[np.ndarray], bias: float) -> np.ndarray:
    """Weights and bias as rows of ``SIZE`` values, those of the embedding first."""
    rest = np.concatenate([*(x.ravel() for x in weights[1:]), [bias]])
    return np.concatenate([weights[0], np.append(rest, np.zeros(-len(rest) % SIZE)).reshape(-1, SIZE)]).astype(np.float64)


def put(rows: np.ndarray, weights: list[np.ndarray]) -> float:
    """Set weights from ``flat`` rows in place; returns the bias."""
    weights[0][:], rest = rows[: len(weights[0])], rows[len(weights[0]) :].ravel()
    for x in weights[1:]:
        x[...], rest = rest[: x.size].reshape(x.shape), rest[x.size :]
    return float(rest[0])


def _steps(texts: list[np.ndarray], order: np.ndarray) -> Iterator[np.ndarray]:
    """``order`` in steps of ``BATCH`` texts of ``BATCH_WORDS`` words together."""
    at, words = 0, np.array([len(texts[i]) for i in order])
    while at < len(order):
        fit_in = int(np.searchsorted(np.cumsum(words[at : at + BATCH]), BATCH_WORDS, "right"))
        yield order[at : at + max(1, fit_in)]
        at += max(1, fit_in)


def one_pass(net: Network, past: Past, texts: list[np.ndarray], y: np.ndarray, rng: np.random.Generator) -> None:
    """One pass of stochastic gradients over all texts, in place."""
    params = net.weights()

    def move(k: int, g: np.ndarray, where=slice(None)) -> None:
        past.weights[k][where] += g * g
        params[k][where] += RATE * g / np.sqrt(past.weights[k][where])

    for picks in _steps(texts, rng.permutation(len(texts))):
        rows, before = _batch([texts[i] for i in picks])
        act = net.activations(rows, before)
        top = np.zeros((len(picks), act.shape[1]), np.int64)
        for d, (s, e) in enumerate(zip(before[:-1], before[1:], strict=True)):
            if e > s:
                top[d] = s + act[s:e].argmax(axis=0)
        full = np.diff(before) > 0
        pool = np.where(full[:, None], act[np.minimum(top, max(0, len(rows) - 1)), np.arange(act.shape[1])] if len(rows) else 0, 0).astype(np.float32)
        p = 1 / (1 + np.exp(-(pool @ net.out + net.bias)))
        miss = (y[picks] - p).astype(np.float32) / np.sqrt(len(picks))
        back = miss[:, None] * net.out * (pool > 0)
        move(len(params) - 1, pool.T @ miss - 1e-4 * net.out)
        past.bias += float(miss.sum()) ** 2
        net.bias += RATE * float(miss.sum()) / past.bias**0.5
        where, grads = [], []
        for k, w in enumerate(WIDTHS):
            cols = slice(k * FILTERS, (k + 1) * FILTERS)
            b, t = back[:, cols], top[:, cols]
            d, c = np.nonzero(b)
            g = np.zeros_like(net.filters[k])
            for j in range(w):
                r = rows[t[d, c] + j]
                np.add.at(g[j].T, c, b[d, c][:, None] * net.embedding[r].sum(axis=1))
                where += list(r.T)
                grads += [b[d, c][:, None] * net.filters[k][j][:, c].T] * len(PARTS)
            move(1 + k, g)
            move(1 + len(WIDTHS) + k, b.sum(axis=0))
        hit, inverse = np.unique(np.concatenate(where), return_inverse=True)
        g = np.zeros((len(hit), SIZE), np.float32)
        np.add.at(g, inverse, np.concatenate(grads))
        move(0, g, hit)


def _threshold(step: np.ndarray, y: np.ndarray, n: np.ndarray) -> float | None:
    """The logit at which the most texts are told apart, halfway to the next; none without both classes.

    ``n`` texts of label ``y`` have a logit of ``step``, in parts of 1 / ``FINE``.
    """
    at, k = np.unique(step, return_inverse=True)
    ones, zeros = (np.bincount(k, n * (y == label), len(at)) for label in (1, 0))
    if not ones.sum() or not zeros.sum():
        return None
    wrong = np.concatenate([[0], ones.cumsum()]) + np.concatenate([zeros[::-1].cumsum()[::-1], [0]])
    best = np.flatnonzero(wrong == wrong.min())
    k = int(best[len(best) // 2])
    low, high = (at[k - 1] if k else -LAST_STEP), (at[k] if k < len(at) else LAST_STEP)
    return float(low + high) / 2 / FINE


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-x)))


def _bounded(documents: DataFrame, ids: DataFrame, most_bytes: int | None = None) -> DataFrame:
    """``doc_id, label, lang, text`` of the labelled ids, one row an id: of repeats the least (lang, hash of text).

    With ``most_bytes``, ids are taken in the order of their hash up to the last with which all texts
    have at most so many bytes.  Few ids are broadcast, more meet the rows' ids in an equi-join.
    """
    docs = documents.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    least = F.min_by(F.struct("label", "lang", "text"), F.struct("lang", F.xxhash64("text")))
    ids = stored(ids, "toxicity-ids")
    few = F.broadcast(ids) if ids.count() <= MOST_KEYS else ids
    rows = docs.join(few, "doc_id").groupBy("doc_id").agg(least.alias("r")).select("doc_id", "r.*")
    rows = stored(rows, "toxicity-labelled")
    if most_bytes is None:
        return rows
    # Only the sizes of a sample that the caller has bounded.
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    sizes = rows.select("doc_id", F.octet_length("text").cast("long").alias("n"))
    kept = sizes.withColumn("sum", F.sum("n").over(order)).where(F.col("sum") <= most_bytes).select("doc_id")
    return rows.join(F.broadcast(kept), "doc_id")


def _texts(column: pa.Array) -> list[np.ndarray]:
    data, at = utf8(column)
    out = []
    for i, j in runs(at, _SLICE):
        words, before = word_rows(data[at[i] : at[j]], at[i : j + 1] - at[i])
        out += np.split(words, before[1:-1])
    return out


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of each label hold an embedding row."""
    for batch in batches:
        data, at = utf8(batch.column("text"))
        for i, j in runs(at, _SLICE):
            words, before = word_rows(data[at[i] : at[j]], at[i : j + 1] - at[i])
            text = np.repeat(np.arange(j - i), np.diff(before))[:, None]
            own = np.unique(text * BUCKETS + words)
            label = batch.column("label").slice(i, j - i).to_numpy()[own // BUCKETS]
            key, n = np.unique(label * BUCKETS + own % BUCKETS, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])


_MOVES = [f"{x}{k}" for x in "wp" for k in range(SIZE)]


def _packed(part: pa.Table) -> pa.Table:
    """A part's labels and texts in order, as one compressed Arrow stream."""
    part = part.sort_by([("order", "ascending"), ("doc_id", "ascending")]).select(["label", "text"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(part)
    return pa.table([pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["packed"])


def _moves(shared, turn: int):
    """The rows of weights, and of their past, that one pass over a part's texts moves, and by how much."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for packed in (x for batch in batches for x in batch.column("packed")):
            part = pa.ipc.open_stream(packed.as_buffer()).read_all()
            net, past = pickle.loads(shared.value)
            before = [flat(net.weights(), net.bias), flat(past.weights, past.bias)]
            texts = [t for chunk in part["text"].chunks for t in _texts(chunk)]
            one_pass(net, past, texts, part["label"].to_numpy().astype(float), np.random.default_rng([3, turn]))
            moved = np.hstack([flat(net.weights(), net.bias) - before[0], flat(past.weights, past.bias) - before[1]])
            hit = np.flatnonzero(moved.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(hit), *(pa.array(x) for x in moved[hit].T.astype(np.float32))], names=["row", *_MOVES])

    return rows


def _trained(rows: DataFrame) -> Network:
    """A network from all ``rows (doc_id, label, text)``; as :func:`train` gives it where they are one part."""
    n, size, pos = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)), F.coalesce(F.sum("label"), F.lit(0))).first()
    net = fresh(n, pos)
    if not 0 < pos < n:
        return net
    counts = rows.select("label", "text").mapInArrow(_seen, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros(2 * BUCKETS)
    seen[counts["key"].to_numpy()] = counts["n"].to_numpy()
    prime(net, seen.reshape(2, BUCKETS), pos, n - pos)
    past = Past.of(net)
    parts = max(-(-n // PART_ROWS), -(-size // PART_BYTES))
    order = F.xxhash64("doc_id")
    dealt = rows.select("doc_id", "label", "text", order.alias("order"), F.pmod(order, F.lit(parts)).cast("int").alias("part"))
    # The texts are shuffled once; each turn reads the parts, a row each.
    packed = stored(dealt.groupBy("part").applyInArrow(_packed, "packed binary"), "toxicity-parts")
    mean = [(F.sum(x) / F.count(F.lit(1))).alias(x) for x in _MOVES]
    for turn in range(EPOCHS):
        # Pickled here, as each part changes a copy of its own.
        shared = rows.sparkSession.sparkContext.broadcast(pickle.dumps((net, past)))
        moves = packed.mapInArrow(_moves(shared, turn), "row long, " + ", ".join(f"{x} float" for x in _MOVES))
        moves = moves.groupBy("row").agg(*mean).toArrow()
        at, by = moves["row"].to_numpy(), np.column_stack([moves[x].to_numpy() for x in _MOVES])
        for owner, weights, own in ((net, net.weights(), by[:, :SIZE]), (past, past.weights, by[:, SIZE:])):
            now = flat(weights, owner.bias)
            now[at] += own
            owner.bias = put(now, weights)
    return net


def _logits(shared):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            data, at = utf8(batch.column("text"))
            logits = [net.logits(*word_rows(data[at[i] : at[j]], at[i : j + 1] - at[i])) for i, j in runs(at, _SLICE)]
            step = np.clip(np.rint(np.concatenate([np.zeros(0), *logits]) * FINE), -LAST_STEP, LAST_STEP)
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("lang"), pa.array(step.astype(np.int32))], names=["label", "lang", "step"])

    return rows


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", train_docs: int | None = None, most_bytes: int | None = None) -> Network:
    """A network and its thresholds, from all labelled texts that are not held out.

    ``train_docs`` and ``most_bytes`` bound them on demand.
    """
    rows = _bounded(documents, training_ids(labels, label, train_docs), most_bytes)
    apart = F.pmod(F.xxhash64(F.lit("apart"), "doc_id"), F.lit(CALIBRATE_ONE_IN)) == 0
    net = _trained(rows.where(~apart))
    shared = documents.sparkSession.sparkContext.broadcast(net)
    steps = rows.where(apart).select("label", "lang", "text").mapInArrow(_logits(shared), "label int, lang string, step int")
    steps = steps.groupBy("label", "lang", "step").agg(F.count(F.lit(1)).alias("n")).toArrow().to_pandas()
    step, y, n, lang = (steps[x].to_numpy() for x in ("step", "label", "n", "lang"))
    found = {"": _threshold(step, y, n)} | {str(x): _threshold(step[lang == x], y[lang == x], n[lang == x]) for x in np.unique(lang.astype(str)) if x}
    middle = np.clip(_sigmoid(found[""] or 0.0), 0.01, 0.99)
    shift = float(np.log(middle / (1 - middle)))
    net.bias -= shift
    net.thresholds = {x: 0.5 if t is None else _sigmoid(t - shift) for x, t in found.items()}
    return net


def _scored(shared):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            data, at = utf8(batch.column("text"))
            scores = [net.score(*word_rows(data[at[i] : at[j]], at[i : j + 1] - at[i])) for i, j in runs(at, _SLICE)]
            score = np.concatenate(scores) if scores else np.zeros(0)
            limits = np.array([net.thresholds.get(x, net.thresholds[""]) for x in batch.column("lang").to_pylist()], float)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array(score >= limits)], names=["doc_id", "score", "flagged"])

    return rows


def score_toxicity(documents: DataFrame, labels: DataFrame, train_docs: int | None = None) -> DataFrame:
    """``doc_id, held_out, score, flagged``: a row for each input row; whole texts are scored.

    ``flagged`` compares the score with the threshold of the row's ``lang`` (of all texts, where
    it is null or unknown).  A null text is empty; texts without words all get one score.  Without
    labels of both classes scores are equal.  Repeated labels of an id count once.
    """
    net = fit(documents, labels, train_docs=train_docs)
    shared = documents.sparkSession.sparkContext.broadcast(net)
    docs = documents.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.mapInArrow(_scored(shared), f"doc_id {kind}, score double, flagged boolean")
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", "flagged")
