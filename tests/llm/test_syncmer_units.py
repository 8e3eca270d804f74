import random

from pyspark.sql import functions as F
from test_syncmers import words

from tickloom.llm.syncmers import anchors, compare_edits, likeness


def prose(rng, n):
    return "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n))


def test_texts_without_words_and_of_other_length_compare(spark):
    rng = random.Random(2)
    long_, middle, tape = prose(rng, 2000), prose(rng, 600), words(rng, 400)
    few = " ".join("".join(rng.choice("0123456789abcdef") for _ in range(300)) for _ in range(8))
    short = tape[:380]
    pairs = [
        (long_, long_[:1500] + prose(rng, 500)),
        (long_, prose(rng, 2000)),
        (middle, middle[:450] + prose(rng, 150)),
        (few, few[:1800] + prose(rng, 600)),
        (short, tape[:820]),
        (prose(rng, 300), tape),
        (long_[:390], long_[:900]),
    ]
    df = spark.createDataFrame(pairs, "a string, b string").select(likeness(anchors(F.col("a")), anchors(F.col("b"))))
    got = [r[0] for r in df.collect()]
    assert got[0] > 0.5 and got[2] > 0.5 and got[3] > 0.4
    assert got[1] == 0.0 and got[5] == 0.0
    assert got[4] > 0.3 and got[6] > 0.3


def test_edit_of_a_text_without_words(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, 1600)) for i in range(6)]
    got = compare_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.near_edited > 0.5 and r.near_next < 0.2 for r in got)
