import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from test_near_copies import near, shingles
from test_simhash import reach
from test_winnowing import brute
from tokenizers import Tokenizer

import corpus_pipeline
from tickloom.llm import pii, quality
from tickloom.llm.packing import cuts

DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_pipeline_matches_brute_force(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    x = quality.text_statistics(pa.array([r.text for r in docs]))
    learn = sorted((r.doc_id, k) for k, r in enumerate(docs) if r.doc_id in labels and zlib.crc32(str(r.doc_id).encode()) % 5)
    trees = quality.grow(x[[k for _, k in learn]], np.array([labels[i] for i, _ in learn], float))
    kept = [r for r, s in zip(docs, trees.score(x), strict=True) if s >= 0.3]
    assert len(docs) > len(kept) > 0.7 * len(docs)

    sets = {r.doc_id: frozenset(shingles(r.text and r.text.lower())) for r in kept}
    root = reach(set(sets), lambda a, b: near(sets[a], sets[b]))
    kept = [r for r in kept if root[r.doc_id] == r.doc_id]

    items = [(r.item_id, r.text, "") for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    hits = {i: n for i, _, n, _ in brute([(r.doc_id, r.text) for r in kept], items)}
    kept = [r for r in kept if not hits[str(r.doc_id)]]

    field, tokenizer = pii.train(), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for r in kept:
        ids = [*tokenizer.encode(pii.redacted(r.text, pii.all_spans(r.text, field)), add_special_tokens=False).ids, 2]
        want += [(r.doc_id, k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())) for k, (s, n) in enumerate(cuts(len(ids), 1024))]
    got = corpus_pipeline.run(spark, DIR).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)


def test_stages_take_nulls_repeats_and_empty_tables(spark):
    rows = [(1, None, None, None, None), (None, "one two three four five", "en", "s", 3), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "call (415) 555-2671 now", "en", None, 9)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, SCHEMA)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, DIR)
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert all(r.text is None or "555" not in r.text for r in docs.collect())
        assert corpus_pipeline.STAGES[-1][1](spark, docs, DIR).count() == docs.count()


def test_stages_bound_the_bytes_that_go_to_python_at_once(spark):
    def own(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    docs = spark.createDataFrame([(1, "some text", "en", "s", 9)], SCHEMA)
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    texts = spark.range(0, 24, 1, 1).select(F.repeat(F.lit("a"), 1 << 20).alias("text"))
    for _, stage in corpus_pipeline.STAGES:
        spark.conf.unset(setting)
        stage(spark, docs, DIR)
        sizes = [r.n for r in texts.mapInArrow(own, "n long").collect()]
        assert len(sizes) > 1 and max(sizes) <= 2 * corpus_pipeline.BATCH_BYTES
    spark.conf.unset(setting)
