"""Cheapest repair of a conversation's structure, by bidirectional search over its edit lattice.

A lattice node is (rows read, state of the grammar); an edge is one edit.  A forward heap grows from
the start and a reverse heap from the accepting ends until no path can be as cheap as the best one
met; then every crossing of that cost is known, and the least concatenation of edits is taken.

Both heaps settle nodes by (cost, rows read), so edits that cost nothing never come late, and a node
keeps its least audit by back pointers: equal-cost paths are compared from where they part, no audit
text is stored before the end.  Work and memory follow a conversation's rows.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cost of each edit, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# States of (s?(ua)+)? and the state after a role's initial.
START, SYSTEM, USER, ASSISTANT = range(4)
_AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_WANTED = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
_LEGAL = {"su", "ua", "au"}
_ENDS = (START, ASSISTANT)

_SPACE = "\x20\t\n\x0b\x0c\r"
NO_FAULT, BLANK, DUPLICATE, CUT = range(4)


def faults(rows: list[tuple[str, str]]) -> list[int]:
    """The first fault of each (role, text): blank, duplicate of an earlier row, truncated."""
    seen: set[bytes] = set()
    out = []
    for role, text in rows:
        body = text.rstrip(_SPACE)
        mark = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        out.append(BLANK if not body else DUPLICATE if mark in seen else CUT if body[-1] not in ".!?" else NO_FAULT)
        seen.add(mark)
    return out


class Lattice:
    """Edits of rows with the given role initials and faults. A node is rows read * 4 + state."""

    def __init__(self, initials: list[str], faults: list[int]):
        self.initials, self.faults, self.n = initials, faults, len(initials)

    def edits(self, node: int) -> Iterator[tuple[str, int, int]]:
        """(edit, cost, next node) of all edges from a node."""
        i, state = divmod(node, 4)
        wanted = _AFTER[state, _WANTED[state][0]]
        yield "I", INSERT, i * 4 + wanted
        if i == self.n:
            return
        fault = self.faults[i]
        yield "D", DELETE, node + 4
        if fault in (BLANK, DUPLICATE):
            return
        more = TRUNCATED if fault == CUT else 0
        kept = _AFTER.get((state, self.initials[i]))
        if kept is not None:
            yield "K", KEEP + more, (i + 1) * 4 + kept
        yield "R", REROLE + more, (i + 1) * 4 + wanted

    def edits_into(self, node: int) -> Iterator[tuple[str, int, int]]:
        """(edit, cost, node before) of all edges into a node."""
        i, state = divmod(node, 4)
        for before in (i * 4 + s for s in range(4)):
            yield from ((e, c, before) for e, c, to in self.edits(before) if to == node)
        if i:
            for before in ((i - 1) * 4 + s for s in range(4)):
                yield from ((e, c, before) for e, c, to in self.edits(before) if to == node)


class _Side:
    """One of the two searches: settled nodes with their cost and the edge that leads home."""

    def __init__(self, roots: list[int], sign: int):
        self.cost = {x: 0 for x in roots}
        self.link: dict[int, tuple[str, int] | None] = {x: None for x in roots}
        self.done: set[int] = set()
        self.sign = sign
        self.heap = [(0, sign * (x // 4), x) for x in roots]
        heapq.heapify(self.heap)

    def top(self) -> int | None:
        while self.heap and (self.heap[0][2] in self.done or self.heap[0][0] > self.cost[self.heap[0][2]]):
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else None

    def settle(self) -> int:
        node = heapq.heappop(self.heap)[2]
        self.done.add(node)
        return node

    def reach(self, node: int, cost: int, edit: str, via: int) -> None:
        now = self.cost.get(node)
        if now is None or cost < now or (cost == now and self._less(edit, via, *self.link[node])):
            self.link[node] = (edit, via)
            if now is None or cost < now:
                self.cost[node] = cost
                heapq.heappush(self.heap, (cost, self.sign * (node // 4), node))

    def _less(self, edit: str, via: int, edit_now: str, via_now: int) -> bool:
        """Whether the path over ``edit, via`` reads less than the one that is kept."""
        if self.sign < 0:  # what follows a node is told apart by its first edit
            return edit < edit_now
        new, old = [edit], [edit_now]
        while via != via_now:  # back to where the two paths parted
            if self.link[via] is not None and (via // 4 >= via_now // 4 or self.link[via_now] is None):
                letter, via = self.link[via]
                new.append(letter)
            else:
                letter, via_now = self.link[via_now]
                old.append(letter)
        return new[::-1] < old[::-1]

    def path(self, node: int) -> list[str]:
        out = []
        while (step := self.link[node]) is not None:
            out.append(step[0])
            node = step[1]
        return out[::-1] if self.sign > 0 else out


def cheapest(lattice: Lattice) -> tuple[int, str]:
    """Cost and audit of the cheapest edits, of several the audit that is least in ASCII."""
    ends = [lattice.n * 4 + s for s in _ENDS]
    ahead, back = _Side([START], 1), _Side(ends, -1)
    best = None
    while True:
        a, b = ahead.top(), back.top()
        if a is None or b is None or (best is not None and a + b > best):
            break
        if len(ahead.heap) <= len(back.heap):
            node = ahead.settle()
            for edit, cost, to in lattice.edits(node):
                ahead.reach(to, a + cost, edit, node)
            if node in back.cost:
                best = min(a + back.cost[node], best if best is not None else a + back.cost[node])
        else:
            node = back.settle()
            for edit, cost, before in lattice.edits_into(node):
                back.reach(before, b + cost, edit, node)
            if node in ahead.cost:
                best = min(b + ahead.cost[node], best if best is not None else b + ahead.cost[node])
    crossings = [ahead.path(x) for x in ends if x in ahead.done and ahead.cost[x] == best]
    for node in ahead.done:  # the last node of a path that the forward search settled, and the edge after it
        for edit, cost, to in lattice.edits(node):
            if to not in ahead.done and to in back.done and ahead.cost[node] + cost + back.cost[to] == best:
                crossings.append([*ahead.path(node), edit, *back.path(to)])
    return best, "".join(min(crossings))


def apply_edits(rows: list[tuple[str, str]], audit: str) -> list[str]:
    """The repaired rows as ``role:text``."""
    out, state, left = [], START, iter(rows)
    for edit in audit:
        if edit == "D":
            next(left)
            continue
        role, text = ("", "") if edit == "I" else next(left)
        role = role if edit == "K" else _WANTED[state]
        state = _AFTER[state, role[0]]
        out.append(f"{role}:{text}")
    return out


def repair(rows: list[tuple[str, str]]) -> tuple[int, str, list[str], list[int]]:
    """Cost, audit, repaired rows and each row's fault for the (role, text) of one conversation."""
    found = faults(rows)
    cost, audit = cheapest(Lattice([r[:1] for r, _ in rows], found))
    return cost, audit, apply_edits(rows, audit), found


def _report(turns: list[int | None], rows: list[tuple[str, str]]) -> tuple:
    cost, audit, repaired, found = repair(rows)
    known = {t for t in turns if t is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    illegal = sum(a[:1] + b[:1] not in _LEGAL for (a, _), (b, _) in zip(rows, rows[1:], strict=False))
    digest = hashlib.sha256("\n".join(repaired).encode()).hexdigest()
    return (gaps, *(found.count(k) for k in (BLANK, DUPLICATE, CUT)), illegal, cost, audit, repaired, digest)


_COLUMNS = ["conv_id", "turn", "role", "text", "there"]
_FIELDS = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
           ("cost", pa.int64()), ("audit", pa.string()), ("repaired", pa.list_(pa.string())), ("repaired_sha256", pa.string())]
_SCHEMA = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired array<string>, repaired_sha256 string"


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each conversation of a stream that is sorted by it."""
    open_, turns, said, out, size, kind = (), [], [], [], 0, None

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        types = [("conv_id", kind), *_FIELDS]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, types, strict=True)], names=[n for n, _ in types])

    for batch in batches:
        kind = batch.column("conv_id").type
        for conv, turn, role, text, there in zip(*(batch.column(x).to_pylist() for x in _COLUMNS), strict=True):
            if open_ != (conv,):
                if open_:
                    out.append((*open_, *_report(turns, said)))
                    size += sum(map(len, out[-1][8]))
                    if size > 1 << 22 or len(out) >= 4096:
                        yield flush()
                        out, size = [], 0
                open_, turns, said = (conv,), [], []
            if there:
                turns.append(turn)
                said.append((role, text))
    if open_:
        out.append((*open_, *_report(turns, said)))
        yield flush()


def repair_conversations(conversations: DataFrame, present: Column | None = None) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired, repaired_sha256``.

    A row for each ``conv_id``, null included as one conversation; rows where ``present`` is not true
    only name their conversation.  Rows are taken by turn, nulls first, rows of one turn by role and
    text.  Null roles and texts are one space; a role in the grammar counts by its first character,
    any other can be reroled or deleted only.  Repeated rows are duplicates.  A conversation without
    rows has zeros, an empty audit and the hash of the empty string; an empty table gives no rows.
    Other columns are not read.  Conversations are dealt by id and read as a sorted stream: one is in
    memory at a time, as its result is one row.
    """
    space = lambda c: F.coalesce(F.col(c), F.lit(" "))
    there = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"), there.alias("there"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    return rows.mapInArrow(_repaired, f"conv_id {conversations.schema['conv_id'].dataType.simpleString()}, {_SCHEMA}")


#: Damage for the drill, by the remainder of a row's hash.
DROPPED, EMPTIED, UNSTOPPED, REPEATED, AS_USER = range(5)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, present``: a drill that drops, empties, cuts, repeats or reroles
    rows by ``crc32(conv_id:turn) % 20``; nulls count as one space, a dropped row is not present."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(kind == EMPTIED, "").when(kind == UNSTOPPED, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    times = F.when(kind == REPEATED, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == AS_USER, "user").otherwise(space("role")).alias("role"),
        text.alias("text"),
        (kind != DROPPED).alias("present"),
        F.explode(times).alias("_copy"),
    ).drop("_copy")
