import hashlib
import random
import re
import zlib
from functools import lru_cache

import pyspark.sql.functions as F

from tickloom.llm.repair import Lattice, cheapest, damaged, faults, repair, repair_conversations

SCHEMA = "conv_id long, turn long, role string, text string, repaired string, there int"


def brute_faults(rows):
    out = []
    for i, (role, text) in enumerate(rows):
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append(1 if not body else 2 if (role, text) in rows[:i] else 3 if body[-1] not in ".!?" else 0)
    return out


def brute(rows):
    """Cost, audit and repaired rows by exhaustive recursion over (rows left, output so far as a state)."""
    found, n = brute_faults(rows), len(rows)
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(None)
    def best(i, state, inserts):
        options = [(0, "", ())] if i == n and state in ("", "a") else []

        def put(cost, edit, role, text, i, inserts=0):
            to = step.get((state, role[:1]))
            if to is not None and (rest := best(i, to, inserts)) is not None:
                options.append((rest[0] + cost, edit + rest[1], (f"{role}:{text}", *rest[2])))

        if inserts < 3:
            for role in ("user", "assistant"):
                put(5, "I", role, "", i, inserts + 1)
        if i < n:
            role, text = rows[i]
            if (rest := best(i + 1, state, 0)) is not None:
                options.append((rest[0] + 2, "D" + rest[1], rest[2]))
            if found[i] in (0, 3):
                more = 5 * (found[i] == 3)
                put(more, "K", role, text, i + 1)
                for to in ("user", "assistant"):
                    put(1 + more, "R", to, text, i + 1)
        return min(options) if options else None

    return best(0, "", 0)


def some_rows(rng, n):
    roles = ["user", "assistant", "system", "tool", " ", "", "util"]
    texts = ["Yes.", "No!", "cut off", " ", "", "\t\n", "What? ", "a.", "b.", "c.", "d?", "e"]
    return [(rng.choice(roles if rng.random() < 0.3 else roles[:2]), rng.choice(texts) if rng.random() < 0.5 else f"{rng.random()}.") for _ in range(n)]


def test_cheapest_edits_match_exhaustive_search():
    rng = random.Random(1)
    for _ in range(600):
        rows = some_rows(rng, rng.randint(0, 9))
        cost, audit, repaired, found = repair(rows)
        want = brute(tuple(rows))
        assert (cost, audit, tuple(repaired)) == want, rows
        assert found == brute_faults(rows)


def test_a_long_conversation_keeps_to_linear_work():
    rng = random.Random(2)
    rows = some_rows(rng, 20_000)
    cost, audit, repaired, _ = repair(rows)
    state = "".join(r[0] for r in repaired)
    assert re.fullmatch("(s?(ua)+)?", state)
    assert len(audit) - audit.count("I") == len(rows)
    again = cheapest(Lattice([r[:1] for r, _ in rows], faults(rows)))
    assert again == (cost, audit)


def test_nothing_to_repair():
    rows = [("system", "Be kind."), ("user", "Hi."), ("assistant", "Hello.")]
    assert repair(rows)[:2] == (0, "KKK")
    assert repair([])[:3] == (0, "", [])


def brute_damage(rows):
    """By conversation, the rows after damage in order, and all ids."""
    out = {}
    for r in rows:
        conv, turn, role, text = r[:4]
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        here = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        here += [] if kind == 0 else [((turn is not None, turn or 0), "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {k: sorted(v) for k, v in out.items()}


def test_damaged_table_matches_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for conv in [*range(60), None, 10**15]:
        for turn in range(rng.randint(1, 7)):
            role, text = some_rows(rng, 1)[0]
            turn = rng.choice([turn, turn, turn, turn + 3, None, -turn])
            rows.append((conv, turn, role if rng.random() < 0.95 else None, text if rng.random() < 0.95 else None, "x", None))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    rows += [(1000 + k, k, "user", "x.", None, None) for k in range(40)]  # single rows, some of them dropped
    rows += [(5000, None, None, None, None, None), (5001, 0, "user", "long. " * 50_000, None, 0)]
    got = repair_conversations(damaged(spark.createDataFrame(rows, SCHEMA)), F.col("present")).collect()
    want = {}
    for conv, here in brute_damage(rows).items():
        said = [(r, t) for _, r, t in here]
        cost, audit, repaired = brute(tuple(said))
        turns = {t for (known, t), _, _ in here if known}
        found = brute_faults(said)
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(said, said[1:], strict=False)]
        want[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(found.count(k) for k in (1, 2, 3)), sum(p not in ("su", "ua", "au") for p in pairs),
            cost, audit, list(repaired), hashlib.sha256("\n".join(repaired).encode()).hexdigest(),
        )
    assert len(got) == len(want)
    assert {r.conv_id: tuple(r)[1:] for r in got} == want
    assert any(len(v) == 0 for v in brute_damage(rows).values())


def test_empty_table_and_rows_that_only_name(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair_conversations(empty).collect() == []
    assert repair_conversations(damaged(empty), F.col("present")).collect() == []
    named = spark.createDataFrame([(3, 1, "user", "x", None, None)], SCHEMA)
    row = repair_conversations(named, F.lit(False)).first()
    assert tuple(row)[:8] == (3, 0, 0, 0, 0, 0, 0, "") and row.repaired_sha256 == hashlib.sha256(b"").hexdigest()
