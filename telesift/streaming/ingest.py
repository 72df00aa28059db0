"""Streams of OTLP messages or of spans into tables."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from telesift.operators import bounds as bounds_ops
from telesift.sources import otlp, tables
from telesift.sources.loads import load_records, load_spans
from telesift.streaming.assembly import service_operations_stream

AVAILABLE = {"availableNow": True}
#: Bytes of files, as they lie there, that a batch of messages takes where no number of files is given.
BATCH_BYTES = 1 << 28


def message_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """JSON-lines files of a folder as a stream of text rows, compressed or not.

    A batch is bounded, by so many files or by BATCH_BYTES (a larger file is one of its own), and with it what its shuffles take.
    """
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    else:
        reader = reader.option("maxBytesPerTrigger", BATCH_BYTES)
    return reader.load(folder)


#: Shuffles go with the execution that made them, not when the driver's memory fills up; set in a stream's own session.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _dealt(batch: DataFrame) -> DataFrame:
    """A batch over all cores, where it has fewer partitions: a compressed file is one, however much work its messages are."""
    if batch.rdd.getNumPartitions() >= batch.sparkSession.sparkContext.defaultParallelism:
        return batch
    return batch.repartition(F.monotonically_increasing_id())


def _run(stream: DataFrame, each_batch, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or AVAILABLE)).start()


def writer_of(checkpoint: str) -> str:
    """A name for a stream's folders: streams differ by their checkpoints, and a restarted one keeps its own."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def stream_ingest(
    messages: DataFrame,
    signal: str,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    column: str = "value",
    promote: dict[str, list[str]] | None = None,
    bounds: str | None = None,
) -> StreamingQuery:
    """Messages to the tables of a signal, micro-batch by micro-batch.

    A batch is dealt over all cores, parsed once and written by one job, and leaves no shuffle behind. It overwrites only folders with its stream's name and its own number, so that
    one run again after a failure leaves each row once, and another stream's rows stay. What cannot be stored is written along,
    under no day, for tables.read_rejected, and all else still goes through. With a `bounds` folder the traces' partial bounds
    are written there after their spans.
    """
    writer = writer_of(checkpoint)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        batch.sparkSession.conf.set(DROP_SHUFFLES, "true")
        parsed = otlp.parse_otlp_json(_dealt(batch), column, signal)
        if signal == "traces":
            load_spans(parsed, path, bounds, promote, batch_id, writer)
        else:
            load_records(parsed, signal, path, promote, batch_id, writer)

    return _run(messages, each_batch, checkpoint, trigger)


def stream_trace_bounds(spans: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Partial trace bounds per batch, appended; merge_trace_bounds reads them. No state is kept."""

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        tables.write_bounds(bounds_ops.trace_bounds(batch), path, batch_id, writer_of(checkpoint))

    return _run(spans, each_batch, checkpoint, trigger)


def stream_service_operations(
    spans: DataFrame, path: str, checkpoint: str, ttl: str = "12 hours", trigger: dict | None = None
) -> StreamingQuery:
    """Each (service, operation) with its id, again only when it was last written `ttl` ago or more; see service_operations_stream."""
    ends = not trigger or "processingTime" not in trigger
    rows = service_operations_stream(spans, int(pd.Timedelta(ttl).total_seconds() * 1000), forget=not ends)
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or AVAILABLE)).start(path)


SIDE = "side"


def stream_split_late(
    rows: DataFrame,
    column: str,
    delay: str,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Rows to `<path>/rows`, by `side`: 'late' ones are more than `delay` behind the newest time of earlier batches.

    A batch is read once: tagged, counted on the way, and written by one job. It leaves the newest time up to now in
    `<path>/newest`, where the next one reads only the file of its predecessor, so a restart goes on where it stopped.
    """
    spark = rows.sparkSession

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        seen = None
        if batch_id > 0:
            seen = spark.read.schema("newest timestamp").parquet(f"{path}/newest/batch_id={batch_id - 1}").first()["newest"]
        behind = F.lit(False) if seen is None else F.coalesce(F.col(column) < F.lit(seen) - F.expr(f"INTERVAL {delay}"), F.lit(False))
        side = F.when(behind, "late").otherwise("on_time")
        counted = Observation()
        tagged = batch.observe(counted, F.max(column).alias("newest")).withColumns({SIDE: side, "batch_id": F.lit(batch_id).cast("bigint")})
        writing = tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writing.partitionBy(SIDE, "batch_id").parquet(f"{path}/rows")
        newest = max((t for t in (seen, counted.get["newest"]) if t is not None), default=None)
        one = spark.createDataFrame([(newest,)], "newest timestamp").coalesce(1)
        one.write.mode("overwrite").parquet(f"{path}/newest/batch_id={batch_id}")

    return _run(rows, each_batch, checkpoint, trigger)


def read_side(spark: SparkSession, path: str, side: str) -> DataFrame:
    """Rows that stream_split_late found in time ('on_time') or 'late'."""
    return spark.read.parquet(f"{path}/rows").filter(F.col(SIDE) == side).drop(SIDE, "batch_id")
