"""Contiguous shards of near equal bytes, cut from global prefix sums that are made of per-partition totals.

Rows are put in order by ranges, each partition sums its own rows, and the few partition totals give every partition its
offset. A row belongs to the shard in which the middle of its bytes falls, so shards are runs of the order and differ
from the target by less than one row at either end.

Defined results
    Null sizes count as 0. Null keys come first; rows equal in all keys are repeats of one another, and take any of
    their places. Fewer rows than shards, or a row larger than a target, leaves shards empty. If all sizes are 0, rows
    are cut by count. An empty table gives an empty table. All input columns come back (but for those named like one of
    `shard`, `slot`, `row_no`, `bytes_before`, which the result takes).
    Equal texts are not brought together: one group may hold a third of all rows, which the law of equal bytes forbids.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telesift.session import scratch_path

ADDED = ("shard", "slot", "row_no", "bytes_before")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the sorted rows of a partition and sum their weights as they come."""
    from pyspark import TaskContext

    part, rows, total = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        weights = batch.column("__weight").to_numpy()
        ends = total + np.cumsum(weights)
        added = {
            "__part": pa.array(np.full(len(weights), part, np.int32)),
            "__row": pa.array(np.arange(rows, rows + len(weights), dtype=np.int64)),
            "__before": pa.array((ends - weights).astype(np.int64)),
        }
        if len(weights):
            rows, total = rows + len(weights), int(ends[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, *added.values()], names=[*batch.schema.names, *added])


def assign(rows: DataFrame, order_by: Sequence[str], size: str, shards: int) -> DataFrame:
    """All rows with their shard (from 0), their slot in it (gapless), their place `row_no` and the `bytes_before` it."""
    spark = rows.sparkSession
    keep = [c for c in rows.columns if c.lower() not in ADDED]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    weighed = rows.select(*keep, F.coalesce(F.col(size).cast("long"), F.lit(0)).cast("long").alias("__weight"))
    ordered = weighed.repartitionByRange(parts, *order_by).sortWithinPartitions(*order_by)
    schema = T.StructType([
        *weighed.schema.fields,
        T.StructField("__part", T.IntegerType()), T.StructField("__row", T.LongType()), T.StructField("__before", T.LongType()),
    ])
    # Written once, so that offsets and rows come from the same ranges even if executors are lost in between.
    path = scratch_path(spark, "sharding")
    ordered.mapInArrow(_numbered, schema).write.parquet(path)
    stored = spark.read.schema(schema).parquet(path)
    # One row for each range partition.
    totals = stored.groupBy("__part").agg(F.count("*").alias("rows"), F.sum("__weight").alias("bytes"))
    upto = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "__part",
        F.coalesce(F.sum("rows").over(upto), F.lit(0)).alias("__rows_off"),
        F.coalesce(F.sum("bytes").over(upto), F.lit(0)).alias("__bytes_off"),
        F.sum("rows").over(Window.partitionBy()).alias("__all_rows"),
        F.sum("bytes").over(Window.partitionBy()).alias("__all_bytes"),
    )
    placed = stored.join(F.broadcast(offsets), "__part").select(
        *keep, "__weight", "__all_rows", "__all_bytes",
        (F.col("__rows_off") + F.col("__row")).alias("row_no"),
        (F.col("__bytes_off") + F.col("__before")).alias("bytes_before"),
    )
    middle, whole = 2 * F.col("bytes_before") + F.col("__weight"), 2 * F.col("__all_bytes")
    by_bytes = F.floor(middle.cast("decimal(28,0)") * shards / F.greatest(whole, F.lit(1)).cast("decimal(28,0)"))
    by_rows = F.floor((2 * F.col("row_no") + 1).cast("decimal(28,0)") * shards / (2 * F.col("__all_rows")).cast("decimal(28,0)"))
    shard = F.when(F.col("__all_bytes") > 0, by_bytes).otherwise(by_rows)
    cut = placed.withColumn("shard", F.least(shard.cast("int"), F.lit(shards - 1)))
    firsts = cut.groupBy("shard").agg(F.min("row_no").alias("__first"))  # as many rows as shards
    return cut.join(F.broadcast(firsts), "shard").select(
        *keep, "shard", (F.col("row_no") - F.col("__first")).alias("slot"), "row_no", "bytes_before"
    )


def write(assigned: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """A folder for each shard, whose files hold runs of slots in order."""
    run = F.floor(F.col("slot") / rows_per_file)
    (
        assigned.withColumn("run", run).repartition("shard", "run").sortWithinPartitions("shard", "run", "slot")
        .write.partitionBy("shard", "run").parquet(path)
    )
