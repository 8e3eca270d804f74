"""The trade tape of raw files that keep arriving.

Row quality, canonical form and audit counters need one row at a time, so a micro batch is judged and
written like a whole input.  Batch n writes only its own folders (``batch=n``) and replaces them, so a
batch that is run again after a failure leaves the same rows; the checkpoint decides which files are
new.  Row numbers go on where the earlier batches ended, which a ledger with one row a batch tells.

What needs all rows is rolled up when it is asked for: the audit's counters are kept by batch, and
every report is the roll-up of their sum.  Order and duplicates are judged inside a batch only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom import schema as S
from tickloom.config import CODECS, TapeConfig
from tickloom.functions.clock import epoch_ns
from tickloom.operators import audit as A
from tickloom.operators.ordering import ordering_report
from tickloom.operators.quality import canonical_trades, enforce_policy, quality_flags, quarantine_rows
from tickloom.sources.readers import configure


def _numbered(batch: DataFrame, first: int) -> tuple[DataFrame, int]:
    """Rows of a batch in the order of its files, numbered from ``first``; and how many there are."""
    # One row for each file of the batch, which maxFilesPerTrigger bounds.
    files = sorted((r["_file"], r["n"]) for r in batch.groupBy("_file").agg(F.count(F.lit(1)).alias("n")).collect())
    starts, total = [], first
    for name, n in files:
        starts.append((name, total))
        total += n
    table = batch.sparkSession.createDataFrame(starts, "_file string, _offset bigint")
    out = batch.join(F.broadcast(table), "_file").withColumn("source_row_number", F.col("_offset") + F.col("_index"))
    return out.drop("_file", "_index", "_offset"), total - first


def _write_batch(df: DataFrame, path: str, batch_id: int, cfg: TapeConfig, keys: tuple[str, ...] = ()) -> None:
    out = df.write.mode("overwrite").option("compression", CODECS[cfg.compression])
    out = out.option("maxRecordsPerFile", cfg.target_rows_per_file)
    (out.partitionBy(*keys) if keys else out).parquet(f"{path}/batch={batch_id}")


def process_batch(batch: DataFrame, batch_id: int, target: str, reports: str, cfg: TapeConfig) -> None:
    """Judge and write one micro batch; running it again for the same id changes nothing.

    Under *fail* a batch with broken rows raises before anything of it is written, and the stream
    stops there.  Rejected rows are stored under *quarantine*, all of them.
    """
    spark = batch.sparkSession
    ledger = T.StructType([T.StructField("rows", T.LongType()), T.StructField("batch", T.LongType())])
    earlier = f"{reports}/ledger"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(earlier)
    known = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    first = 0
    if known:
        taken = spark.read.schema(ledger).parquet(earlier).filter(F.col("batch") < batch_id)
        first = taken.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"]
    rows, n = _numbered(batch, first)
    # Three passes read the batch; its texts of times are parsed in the first one only.
    rows = rows.withColumns({c: epoch_ns(rows, c) for c in ("ts_event", "ts_recv")}).persist()
    flags = quality_flags(rows, cfg)
    cells = A.audit_cells(flags, cfg).persist()
    try:
        if cfg.invalid_row_policy == "fail":
            enforce_policy(A.invalid_counts(cells), ordering_report(flags), cfg)
        tape = S.conform(canonical_trades(flags, cfg), S.TAPE).hint("rebalance", *S.PARTITIONS)
        _write_batch(tape.sortWithinPartitions(*S.PARTITIONS, *S.CAUSAL), target, batch_id, cfg, S.PARTITIONS)
        if cfg.invalid_row_policy == "quarantine":
            _write_batch(S.conform(quarantine_rows(flags), S.QUARANTINE), f"{reports}/quarantine_rows", batch_id, cfg)
        _write_batch(cells, f"{reports}/cells", batch_id, cfg)
        done = spark.createDataFrame([(n,)], "rows bigint")
        _write_batch(done, earlier, batch_id, cfg)
    finally:
        cells.unpersist()
        rows.unpersist()


def stream_tape(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    reports: str,
    checkpoint: str,
    cfg: TapeConfig,
    files_per_batch: int = 64,
) -> StreamingQuery:
    """Start a stream that adds new raw files under ``source`` to the tape, and stops when it has all.

    Started again with the same checkpoint it takes up what has arrived since.  ``schema`` is that of
    the raw files.  ``read_tape`` reads the result like any tape.
    """
    S.require_columns([f.name for f in schema], S.MBO_REQUIRED, "raw events")
    raw = configure(spark).readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    kept = [F.col(c) for c in S.MBO_SCANNED]
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index")]
    return (
        raw.select(*kept, *place)
        .writeStream.foreachBatch(lambda batch, k: process_batch(batch, k, target, reports, cfg))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stored_cells(spark: SparkSession, reports: str) -> DataFrame:
    """The audit counters of all batches; the reports of ``operators.audit`` roll them up."""
    return spark.read.parquet(f"{reports}/cells").drop("batch")
