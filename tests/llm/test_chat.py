import random

import pytest

from tickloom.llm import chat
from tickloom.llm.chat import CONTROL, as_events, conversations, escape, parse, read_back, render, unescape

EVENTS = "conv_id long, seq long, kind string, slot long, role string, text string, loss string"


def test_escape_is_reversible_and_hides_control_strings():
    rng = random.Random(2)
    bits = [*CONTROL, "\\", "\\!", "!", "\\n", "\n", "<", "|", "s>", "im_end|>", "é", "[", "INST]", "<|im_", "<<", " "]
    for _ in range(5000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 8)))
        assert unescape(escape(text)) == text
        assert not any(c in escape(text) for c in CONTROL)
    for _ in range(1000):
        turns = [("".join(rng.choice(bits) for _ in range(rng.randint(0, 3))), "".join(rng.choice(bits) for _ in range(rng.randint(0, 6)))) for _ in range(rng.randint(0, 4))]
        formatted, loss = render(turns + [("assistant", "é</s>")])
        assert parse(formatted) == [*turns, ("assistant", "é</s>")]
        assert unescape(formatted[slice(*loss[-1])]) == "é</s>"
    with pytest.raises(ValueError, match="not a formatted"):
        parse("<|im_start|>user\nx")


def test_fold(spark):
    log = [
        (1, 0, "message", 0, "user", "hi", "x"), (1, 1, "message", 1, "assistant", "", "x"), (1, 2, "delta", 1, None, "Hel", "x"), (1, 3, "delta", 1, None, "lo", None), (1, 4, "message", 2, "user", "again", "x"),
        (1, 5, "regenerate", 1, None, None, "x"), (1, 6, "delta", 1, None, "Good ", "x"), (1, 7, "delta", 1, None, "day", "x"), (1, 8, "edit", 0, None, "hi there", "x"),
        (2, 3, "delta", 9, "assistant", "b", "x"), (2, 2, "delta", 9, "assistant", "a", "x"), (2, None, "message", 8, None, None, "x"), (None, 0, "message", None, "user", "z", "x"), (None, 0, "message", None, "user", "z", "x"),
    ]
    random.Random(1).shuffle(log)
    got = {r.conv_id: r for r in conversations(spark.createDataFrame(log, EVENTS)).collect()}
    assert parse(got[1].formatted) == [("user", "hi there"), ("assistant", "Good day"), ("user", "again")]
    assert parse(got[2].formatted) == [("", ""), ("assistant", "ab")]
    assert parse(got[None].formatted) == [("user", "z"), ("user", "z")]
    assert [got[1].formatted[x.start : x.end] for x in got[1].loss] == ["Good day"] and got[1].n_turns == 3
    with pytest.raises(Exception, match="unknown kind"):
        conversations(spark.createDataFrame([(1, 0, "poke", 0, "user", "", "")], EVENTS)).collect()


def test_batches_do_not_split_conversations(spark, monkeypatch):
    monkeypatch.setattr(chat, "_BATCH", 10)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        log = [(i % 5, i, "message", i, "user", str(i), "") for i in range(100)]
        got = conversations(spark.createDataFrame(log, EVENTS)).collect()
        assert {r.conv_id: [int(t) for _, t in parse(r.formatted)] for r in got} == {c: list(range(c, 100, 5)) for c in range(5)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_table_of_messages(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 1, "assistant", "b"), (2, None, None, "q")]
    out = {r.conv_id: r for r in read_back(conversations(as_events(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))).collect()}
    assert (out[1].n_turns, out[1].loss_chars, out[2].n_turns, out[2].loss_chars) == (3, 2, 1, 0)
    assert read_back(conversations(as_events(spark.createDataFrame([], "conv_id long, turn long, role string, text string")))).collect() == []
