import random

import pytest

from tickloom.llm import pii
from tickloom.llm.pii import all_spans


@pytest.fixture(scope="module")
def field():
    return pii.train()


def items(rng, n):
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 8)))
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    for k in range(n):
        yield f"({number(3)}) {number(3)}-{number(4)}" if k % 4 == 3 else f"{word()}.{word()} (at) {word()} (dot) com"


@pytest.mark.parametrize("seed", range(5))
def test_each_of_a_long_list_is_found_as_if_alone(field, seed):
    text, want = "", []
    for item in items(random.Random(seed), 80):
        want += [(len(text) + s, len(text) + e, k) for s, e, k in all_spans(item, field)]
        text += item + ", "
    assert len(want) == 80
    assert all_spans(text, field) == want


def test_regions_end_at_borders_and_stay_linear(field):
    text = "x" * 300 + " jo (at) example (dot) org " + "y" * 120 + "z" * 300
    regions = pii._merged(text, sorted(pii._regions(text)))
    assert all((s == 0 or not text[s - 1 : s + 1].isalnum()) and (e == len(text) or not text[e - 1 : e + 1].isalnum()) for s, e in regions)
    pii._merged(text := "a(at)" * 60_000, sorted(pii._regions(text)))
