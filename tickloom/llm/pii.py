"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds spans.

The field scores whole candidate spans (shape, digit count, checksum, grouping, context), not
single tokens.  A dynamic programme over the tokens of a region chooses boundaries and kinds
jointly, with spans of at most ``MOST_TOKENS`` tokens, so its work is linear in the region.  It is
trained by gradient ascent on the conditional likelihood of lines that are made from rules here.
It adds written-out forms that the fixed patterns leave out, such as a number grouped without a
plus sign or an address with "(at)"; the fixed patterns' spans always stay.
"""

from __future__ import annotations

import random
import re
from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.rows import give_back

KINDS = ("email", "ip", "card", "phone")
MOST_TOKENS = 24
SCORED_TOKENS = 1_024
TRAIN_LINES, TRAIN_STEPS = 320, 60
_RANK = {k: i for i, k in enumerate(KINDS)}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the fixed patterns, by start and kind; leftmost and non-overlapping in each kind."""
    out = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            end = found.end()
            out.append((start, end, "email"))
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.groups()):
            out.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        d = _digits(m[0]) if m.end() - m.start() < 64 else ""
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), m.end(), "card"))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda x: (x[0], _RANK[x[2]]))


#: Where the field looks: runs of digits and number punctuation, and words around a written-out at.
_NUMBERS = re.compile(r"[+(]?[0-9][0-9\x20().+-]{6,}")
_AT_SIGN = re.compile(r"[(\[{]\x20?at\x20?[)\]}]|\x20at\x20[A-Za-z0-9-]{1,63}\x20(?:dot\x20|[(\[{]\x20?dot)", re.I)
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|[^\w\s]|_")
_WORDY = re.compile(r"[A-Za-z0-9._%+-]+\x20?(?:@|[(\[{]\x20?at\x20?[)\]}]|\x20at\x20)\x20?[A-Za-z0-9-]+(?:\x20?(?:\.|[(\[{]\x20?dot\x20?[)\]}]|\x20dot\x20)\x20?[A-Za-z0-9-]+)+", re.I)
_CUES = {"phone": {"tel", "phone", "call", "mobile", "fax", "cell"}, "card": {"card", "visa", "credit", "cc"}, "email": {"mail", "email", "contact", "write"}, "ip": {"ip", "host", "server", "address"}}
_GROUPS = ((re.compile(r"\(?[0-9]{3}\)?[\x20.-]?\x20?[0-9]{3}[\x20.-][0-9]{4}"), 0), (re.compile(r"[0-9]{4}([\x20.-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}"), 1))
_TOP = re.compile(r"(?:com|org|net|edu|gov|info|io|de|fr|es|uk)$", re.I)
N_FEATURES = 28


def _features(text: str, start: int, end: int, tokens: int, cue: int) -> np.ndarray:
    """Features of the whole span ``text[start:end]``."""
    span = text[start:end]
    x = np.zeros(N_FEATURES)
    x[0] = 1
    digits = _digits(span)
    n = len(digits)
    x[1 + min(6, np.searchsorted([1, 7, 9, 12, 16, 20], n, "right"))] = 1
    x[8] = bool(_WORDY.fullmatch(span))
    ip = _IP.fullmatch(span)
    if ip:
        x[9 if all(len(p) <= 3 and int(p) <= 255 for p in ip.groups()) else 10] = 1
    x[11 if 12 <= n <= 19 and luhn(digits) else 12] = 12 <= n <= 19
    x[13], x[14] = span[0] == "+", span[0] == "("
    x[15] = span.count("(") != span.count(")")
    x[16] = span.isdigit()
    for shape, k in _GROUPS:
        x[17 + k] = bool(shape.fullmatch(span))
    x[19] = start > 0 and (text[start - 1].isalnum() or text[start - 1] in "+.-@")
    x[20] = end < len(text) and (text[end].isalnum() or text[end] in "-@") or text[end : end + 2].strip(".,").isdigit()
    x[21] = bool(re.search(r"[A-Za-z]", span))
    x[22] = bool(_TOP.search(span))
    x[23] = tokens > 12
    if cue >= 0:
        x[24 + cue] = 1
    return x


class Field:
    """Weights by feature and kind; leaving a token out scores zero."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    @staticmethod
    def tokens(text: str, low: int, high: int) -> tuple[list[tuple[int, int]], list[int], int]:
        """Tokens of text[low:high], the cues of these and of up to three words before, and how many are before."""
        tokens = [m.span() for m in _TOKEN.finditer(text, low, high)]
        before = [m[0].lower() for m in _TOKEN.finditer(text, max(0, low - 24), low)][-3:]
        words = before + [text[s:e].lower() for s, e in tokens]
        return tokens, [next((i for i, k in enumerate(KINDS) if w in _CUES[k]), -1) for w in words], len(before)

    @staticmethod
    def candidates(text: str, tokens: list[tuple[int, int]], cues: list[int], before: int, first: int, last: int) -> tuple[list[tuple[int, int]], np.ndarray]:
        """Candidate spans that start at the tokens from ``first`` to ``last``, as token ranges, and their features."""
        spans, rows = [], []
        for i in range(first, min(last, len(tokens))):
            start = tokens[i][0]
            if not (text[start].isalnum() or text[start] in "+("):
                continue
            near = [c for c in cues[max(0, i + before - 3) : i + before] if c >= 0]
            for j in range(i, min(len(tokens), i + MOST_TOKENS)):
                end = tokens[j][1]
                if j == i and end - start < 7 or not text[end - 1].isalnum():
                    continue
                spans.append((i, j + 1))
                rows.append(_features(text, start, end, j + 1 - i, near[-1] if near else -1))
        return spans, np.array(rows).reshape(-1, N_FEATURES)

    @staticmethod
    def lattice(text: str, low: int, high: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]], np.ndarray]:
        """Tokens of text[low:high], candidate spans as token ranges, and their features."""
        tokens, cues, before = Field.tokens(text, low, high)
        return tokens, *Field.candidates(text, tokens, cues, before, 0, len(tokens))

    def decode(self, text: str, low: int, high: int) -> list[tuple[int, int, str]]:
        tokens, cues, before = self.tokens(text, low, high)
        spans, kinds, tops = [], [], []
        for at in range(0, len(tokens), SCORED_TOKENS):  # the features of a long region are never held at once
            some, x = self.candidates(text, tokens, cues, before, at, at + SCORED_TOKENS)
            score = x @ self.weights
            spans += some
            kinds += score.argmax(axis=1).tolist()
            tops += score.max(axis=1).tolist()
        best = np.zeros(len(tokens) + 1)
        back: list[tuple[int, int] | None] = [None] * (len(tokens) + 1)
        ending: dict[int, list[int]] = {}
        for k, (_, j) in enumerate(spans):
            ending.setdefault(j, []).append(k)
        for j in range(1, len(tokens) + 1):
            best[j] = best[j - 1]
            for k in ending.get(j, ()):
                kind = kinds[k]
                total = best[spans[k][0]] + tops[k]
                if total > best[j] + 1e-12:
                    best[j], back[j] = total, (spans[k][0], kind)
        out, j = [], len(tokens)
        while j > 0:
            if back[j] is None:
                j -= 1
            else:
                i, kind = back[j]
                out.append((tokens[i][0], tokens[j - 1][1], KINDS[kind]))
                j = i
        return out[::-1]

    def gradient(self, spans, x, gold: dict[tuple[int, int], int], n: int) -> np.ndarray:
        """Of the log likelihood of one line: features of the gold spans less their expectation."""
        score = x @ self.weights
        starts = np.array([i for i, _ in spans], int)
        ends = np.array([j for _, j in spans], int)
        alpha, beta = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        alpha[0] = beta[n] = 0
        whole = np.logaddexp.reduce(score, axis=1) if len(spans) else np.zeros(0)
        for j in range(1, n + 1):
            alpha[j] = np.logaddexp.reduce([alpha[j - 1], *(alpha[starts] + whole)[ends == j]])
        for i in range(n - 1, -1, -1):
            beta[i] = np.logaddexp.reduce([beta[i + 1], *(beta[ends] + whole)[starts == i]])
        if not len(spans):
            return np.zeros_like(self.weights)
        chance = np.exp(alpha[starts][:, None] + score + beta[ends][:, None] - alpha[n])
        for k, s in enumerate(spans):
            if s in gold:
                chance[k, gold[s]] -= 1
        return -x.T @ chance


def example(rng: random.Random) -> tuple[str, list[tuple[int, int, str]]]:
    """A line made from rules, with its personal data."""
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8)))

    def card(valid: bool) -> str:
        while luhn(d := number(16)) != valid:
            pass
        return rng.choice(["", " ", "-", "."]).join(d[i : i + 4] for i in range(0, 16, 4)) if rng.random() < 0.7 else d

    def phone() -> str:
        a, b, c = number(3), number(3), number(4)
        return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+1 ({a}) {b}-{c}", f"+44 {a} {b} {c}"])

    def mail() -> str:
        at, dot = rng.choice([("@", "."), (" (at) ", " (dot) "), (" [at] ", " [dot] "), ("(at)", "."), (" at ", " dot ")])
        return f"{word()}{rng.choice(['', '.' + word(), number(2)])}{at}{word()}{dot}{rng.choice(['com', 'org', 'net', 'de', 'io'])}"

    made = [
        ("email", mail), ("email", mail), ("ip", lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4))), ("card", lambda: card(True)), ("phone", phone), ("phone", phone),
        (None, lambda: card(False)), (None, lambda: number(rng.randint(1, 18))), (None, lambda: f"{number(4)}-{number(2)}-{number(2)}"), (None, lambda: ".".join(str(rng.randint(256, 900)) for _ in range(4))),
        (None, lambda: f"{number(2)}.{number(1)}.{number(3)}"), (None, lambda: " ".join(number(rng.randint(1, 3)) for _ in range(rng.randint(3, 9)))), (None, lambda: f"{word()} at {word()} {rng.choice(['', 'dot '])}{word()}"), (None, lambda: f"({number(4)}) {number(2)}"),
    ]
    text, spans = "", []
    for _ in range(rng.randint(1, 3)):
        text += " ".join(word() for _ in range(rng.randint(0, 3))) + " "
        kind, make = rng.choice(made)
        if kind and rng.random() < 0.3:
            text += rng.choice(sorted(_CUES[kind])) + rng.choice([": ", " "])
        said = make()
        if kind:
            spans.append((len(text), len(text) + len(said), kind))
        text += said + rng.choice(["", ".", ",", ""]) + " " + word()
    return text, spans


def train(lines: int = TRAIN_LINES, steps: int = TRAIN_STEPS, seed: int = 7) -> Field:
    rng = random.Random(seed)
    made = []
    for _ in range(lines):
        text, marked = example(rng)
        tokens, spans, x = Field.lattice(text, 0, len(text))
        start, end = {s: i for i, (s, _) in enumerate(tokens)}, {e: i + 1 for i, (_, e) in enumerate(tokens)}
        gold = {(start[s], end[e]): _RANK[k] for s, e, k in marked}
        made.append((spans, x, gold, len(tokens)))
    field, pace = Field(np.zeros((N_FEATURES, len(KINDS)))), np.full((N_FEATURES, len(KINDS)), 1e-6)
    for _ in range(steps):
        for at in range(0, len(made), 40):
            g = sum(field.gradient(*m) for m in made[at : at + 40]) - 0.01 * field.weights
            pace += g * g
            field.weights = field.weights + 0.5 * g / np.sqrt(pace)
    return field


def _regions(text: str) -> Iterator[tuple[int, int]]:
    """Where a span that the patterns miss could lie; whole runs, however long."""
    for m in _NUMBERS.finditer(text):
        if sum("0" <= c <= "9" for c in m[0]) >= 9:
            yield m.span()
    if "at" in text or "AT" in text or "At" in text:
        for m in _AT_SIGN.finditer(text):
            yield max(0, m.start() - 66), min(len(text), m.end() + 130)


def _joined(regions: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in regions:
        if out and low <= out[-1][1]:
            out[-1] = out[-1][0], max(high, out[-1][1])
        else:
            out.append((low, high))
    return out


def _merged(text: str, regions: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted regions with those that overlap or touch as one; none ends inside a word, an address or a run of digits."""
    if not regions:
        return []
    runs = [m.span() for m in _NUMBERS.finditer(text)]
    first = [s for s, _ in runs]
    out, past = [], 0
    for low, high in _joined(regions):
        k = bisect(first, low) - 1
        if k >= 0 and runs[k][1] > low:
            low = runs[k][0]
        while past < low < len(text) and all(c.isalnum() or c in _LOCAL for c in text[low - 1 : low + 1]):
            low -= 1
        k = bisect(first, high - 1) - 1
        if k >= 0 and runs[k][1] > high:
            high = runs[k][1]
        high = max(high, past)
        while high < len(text) and all(c.isalnum() or c in _LOCAL for c in text[high - 1 : high + 1]):
            high += 1
        out.append((low, high))
        past = high
    return _joined(out)


def all_spans(text: str, field: Field) -> list[tuple[int, int, str]]:
    """Base spans, and those of the field that meet none of them."""
    base = base_spans(text)
    if not any(True for _ in _regions(text)):
        return base
    taken = sorted((s, e) for s, e, _ in base)
    starts = np.array([s for s, _ in taken], int)
    reach = np.maximum.accumulate(np.array([e for _, e in taken], int)) if taken else starts
    def inside(low: int, high: int) -> bool:
        k = int(np.searchsorted(starts, low, "right")) - 1
        return k >= 0 and reach[k] >= high - 2

    out = list(base)
    for low, high in _merged(text, [r for r in sorted(_regions(text)) if not inside(*r)]):
        for s, e, kind in field.decode(text, low, high):
            k = int(np.searchsorted(starts, e)) - 1
            if k < 0 or reach[k] <= s:
                out.append((s, e, kind))
    return sorted(out, key=lambda x: (x[0], _RANK[x[2]], x[1]))


SPAN = "array<struct<start: int, end: int, kind: string>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))


def _found(weights: np.ndarray, keep: list[str]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(weights)
        for batch in batches:
            base, every = [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                base.append([{"start": s, "end": e, "kind": k} for s, e, k in base_spans(text)])
                every.append([{"start": s, "end": e, "kind": k} for s, e, k in all_spans(text, field)])
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in keep), pa.array(base, _SPANS), pa.array(every, _SPANS)], names=[*keep, "base", "spans"])

    return rows


def find_pii(documents: DataFrame, field: Field | None = None) -> DataFrame:
    """``doc_id, text, base, spans``: a row for each input row; offsets in code points, end exclusive.

    ``base`` has the spans of the fixed patterns, ``spans`` these and the ones of the field, sorted
    by start, then kind.  A null text is empty and has none.  Rows are independent, so repeated
    rows and null ids stay as they are; other columns are not read.
    """
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    weights = (field or train()).weights
    return docs.mapInArrow(_found(weights, ["doc_id", "text"]), f"doc_id {kind}, text string, base {SPAN}, spans {SPAN}")


def redacted(text: str, spans: list) -> str:
    """The text with each span replaced by its kind; of overlapping spans the first one counts."""
    out, last = [], 0
    for s, e, kind in spans:
        if s >= last:
            out += [text[last:s], f"<{kind.upper()}>"]
        last = max(last, e)
    return "".join([*out, text[last:]])


def redact(text: Column, field: Field | None = None) -> Column:
    """``text`` without its personal data; null stays null."""
    weights = (field or train()).weights

    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        own = Field(weights)
        # One text at a time: a batch of them as Python strings takes several times their bytes.
        out = pa.array((redacted(t, all_spans(t, own)) if (t := x.as_py()) is not None else None for x in texts), pa.string())
        give_back()
        return out

    return of(text)


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

