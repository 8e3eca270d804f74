"""Chat formatting by event-sourced reconstruction.

A conversation is a log of events.  The log is dealt by conversation and sorted by sequence, and a
fold over it builds the final messages: a message starts a slot, deltas append to it, an edit
replaces its text, a regeneration clears it for new deltas.  The messages are then rendered with a
template whose control strings cannot occur inside a text, as each is broken by an escape there.

The fold holds one conversation at a time, as its row of the result does.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds of events; other kinds are refused.
MESSAGE, DELTA, EDIT, REGENERATE = "message", "delta", "edit", "regenerate"
KINDS = (MESSAGE, DELTA, EDIT, REGENERATE)
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Control strings of this and other common templates; none begins inside another.
CONTROL = (OPEN, CLOSE, "<|endoftext|>", "<|im_sep|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LEARNED = "assistant"

_BREAK = re.compile("|".join(map(re.escape, CONTROL)))
_UNDO = re.compile(r"\\([\\!n])")
_TURN = re.compile(re.escape(OPEN) + r"([^\n]*)\n(.*?)" + re.escape(CLOSE) + "\n", re.S)
_BATCH = 4 << 20

CONVERSATION = "n_turns long, formatted string, loss array<struct<start: long, end: long>>"
_LOSS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def escape(text: str) -> str:
    """Backslashes doubled; a control string gets one with an exclamation mark after its first sign."""
    return _BREAK.sub(lambda m: m[0][0] + "\\!" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _UNDO.sub(lambda m: {"\\": "\\", "!": "", "n": "\n"}[m[1]], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the code point ranges that carry loss: assistant texts."""
    parts, loss, at = [], [], 0
    for role, text in turns:
        head = OPEN + escape(role).replace("\n", "\\n") + "\n"
        body = escape(text)
        if role == LEARNED:
            loss.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE, "\n"]
        at += len(head) + len(body) + len(CLOSE) + 1
    return "".join(parts), loss


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation; the inverse of ``render``."""
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"not a formatted conversation at {at}")
    return turns


class Fold:
    """Messages of one conversation, built event by event."""

    def __init__(self):
        self.slots: dict[object, tuple[str, list[str]]] = {}

    def add(self, kind: str, slot: object, role: str | None, text: str) -> None:
        if slot is None:  # a message outside any slot can't be changed later
            slot = ("own", len(self.slots))
        known = self.slots.get(slot)
        role = role if role is not None else known[0] if known else ""
        if kind == DELTA and known:
            known[1].append(text)
            self.slots[slot] = (role, known[1])
        elif kind in (MESSAGE, EDIT, DELTA):
            self.slots[slot] = (role, [text])
        elif kind == REGENERATE:
            self.slots[slot] = (role, [])
        else:
            raise ValueError(f"unknown kind of event: {kind}")

    def turns(self) -> list[tuple[str, str]]:
        """In the order in which their slots first appeared."""
        return [(role, "".join(text)) for role, text in self.slots.values()]


def _folded(kind: pa.DataType):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, now, fold = [], 0, None, None

        def close() -> None:
            turns = fold.turns()
            out.append((now[1], len(turns), *render(turns)))

        def batch_of() -> pa.RecordBatch:
            ids, n, text, loss = zip(*out, strict=True)
            spans = [[{"start": s, "end": e} for s, e in x] for x in loss]
            return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(n, pa.int64()), pa.array(text, pa.string()), pa.array(spans, _LOSS)], names=["conv_id", "n_turns", "formatted", "loss"])

        for batch in batches:
            columns = (batch.column(x).to_pylist() for x in ("conv_id", "kind", "slot", "role", "text"))
            for conv, what, slot, role, text in zip(*columns, strict=True):
                if now != (True, conv):
                    if fold:
                        close()
                        size += len(out[-1][2])
                        if size >= _BATCH:
                            yield batch_of()
                            out.clear()
                            size = 0
                    now, fold = (True, conv), Fold()
                fold.add(what, slot, role, text or "")
        if fold:
            close()
        if out:
            yield batch_of()

    return rows


def conversations(events: DataFrame) -> DataFrame:
    """``conv_id, n_turns, formatted, loss`` from ``events (conv_id, seq, kind, slot, role, text)``.

    Events of one ``seq`` are taken by slot, kind, role and text, so ties have one result; a null
    ``seq`` comes first, a null text is empty, a null role keeps the slot's role (empty at first),
    null ``conv_id`` is a conversation of its own.  A delta, edit or regeneration of a slot not yet
    seen starts it.  A repeated message, edit or regeneration changes nothing, a repeated delta
    appends twice.  An event without a slot is a turn by itself.  Other columns are not read.
    """
    order = ["conv_id", "seq", "slot", "kind", "role", "text"]
    log = events.select(*order).repartition("conv_id").sortWithinPartitions(*order)
    field = log.schema["conv_id"].dataType
    kind = pa.string() if field.simpleString() == "string" else pa.int64()
    return log.mapInArrow(_folded(kind), f"conv_id {field.simpleString()}, {CONVERSATION}")


def as_events(table: DataFrame) -> DataFrame:
    """The log of a table of finished messages ``(conv_id, turn, role, text)``: a message each.

    No row has a slot, so rows of one turn stay apart and none is lost.
    """
    return table.select("conv_id", F.col("turn").alias("seq"), F.lit(MESSAGE).alias("kind"), F.lit(None).cast("long").alias("slot"), "role", "text")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for batch in batches:
        rows = []
        for formatted, loss in zip(batch.column("formatted").to_pylist(), batch.column("loss").to_pylist(), strict=True):
            turns = parse(formatted)
            said = "".join(unescape(formatted[x["start"] : x["end"]]) for x in loss)
            rows.append((len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(said), sha(said), len(formatted)))
        n, turns, chars, said, size = zip(*rows, strict=True) if rows else ((),) * 5
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *(pa.array(x, k) for x, k in zip((n, turns, chars, said, size), kinds, strict=True))], names=names)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what ``parse`` and the loss ranges give of each formatted conversation."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select("conv_id", "formatted", "loss").mapInArrow(_digested, schema)
