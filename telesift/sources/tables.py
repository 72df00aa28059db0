"""Writing and reading the day-partitioned Parquet tables.

Rows are rebalanced by the sort key's leading columns, so a hot day or service is split over
several files by adaptive execution, and sorted within each file for tight row-group bounds.
Trace ids get a Parquet bloom filter. Map lookups cannot be pushed to the scan, so attributes
that are often filtered on can be promoted to columns of their own when a table is written.

Every write goes to folders of its own, day by day, writer by writer, batch by batch. Records that a table can't take are
written by the same job as the rest, with a reason, under no day; read_table leaves them out, read_rejected gives them.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telesift import schema
from telesift.functions import maps, times
from telesift.sources.otlp import REASON, WHAT

DAY = "day"
KIND = "kind"
_PROMOTED = "attr"


def promoted_column(map_column: str, key: str) -> str:
    """Name of the column an attribute is promoted to."""
    safe = re.sub(r"[^A-Za-z0-9]", lambda m: f"_{ord(m.group()):x}_", key)
    return f"{_PROMOTED}_{map_column}_{safe}"


def attribute_of(df: DataFrame, map_column: str, key: str) -> Column:
    """An attribute's value; missing is NULL.

    From its promoted column where the table has one, and from the map in the rows of loads that did not promote it.
    """
    promoted = promoted_column(map_column, key)
    inside = F.col(map_column)[key]
    return F.coalesce(F.col(promoted), inside) if promoted in df.columns else inside


def attribute_equals(df: DataFrame, map_columns: list[str], key: str, value: str) -> Column:
    """Whether the first of the maps that has the key holds the value; no key anywhere reads as ''.

    Where attributes are promoted, plain comparisons with their columns go along, which reach the Parquet scan; rows that
    lack the columns' values are left to the maps.
    """
    found = [attribute_of(df, column, key) for column in map_columns]
    if value == "":
        return F.coalesce(*found, F.lit("")) == ""
    matches, missing = found[0] == value, found[0].isNull()
    for other in found[1:]:
        matches, missing = matches | (missing & (other == value)), missing & other.isNull()
    # What the scan can check by itself: a promoted value that is there must be the one asked for, or the next map's.
    scanned = None
    for column in reversed(map_columns):
        promoted = promoted_column(column, key)
        if promoted in df.columns:
            open_ = F.col(promoted).isNull()
            scanned = (F.col(promoted) == value) | (open_ if scanned is None else open_ & scanned)
        else:
            scanned = None
    return matches if scanned is None else scanned & matches


def time_range(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Rows between two times, both inclusive and optional, with the day predicate that prunes partitions."""
    for bound, is_start in ((start, True), (end, False)):
        if bound is None:
            continue
        limit, ts = times.moment(bound), F.col(column)
        day = F.to_date(limit)
        inside = ts >= limit if is_start else ts <= limit
        same = (F.col(DAY) >= day if is_start else F.col(DAY) <= day) if DAY in df.columns else None
        if isinstance(bound, Column):
            # A subquery that finds nothing bounds nothing.
            inside, same = F.coalesce(inside, F.lit(True)), None if same is None else F.coalesce(same, F.lit(True))
        df = df.filter(inside)
        if same is not None:
            df = df.filter(same)
    return df


def _laid_out(df: DataFrame, spread: list[str], order: list, partitions: list[str]) -> DataFrame:
    """Rows where they are to be written, in order. Spark works out sort expressions in every comparison, columns once a row."""
    keys = {f"_order_{i}": key for i, key in enumerate(order) if not isinstance(key, str)}
    named = [key if isinstance(key, str) else f"_order_{i}" for i, key in enumerate(order)]
    rows = df.hint("rebalance", *[F.col(c) for c in partitions + spread])
    return (rows.withColumns(keys) if keys else rows).sortWithinPartitions(*partitions, *named).drop(*keys)


def _write(
    df: DataFrame,
    path: str,
    spread: list[str],
    order: list,
    partitions: list[str],
    bloom: Iterable[str] = (),
    mode: str = "append",
) -> None:
    laid_out = _laid_out(df, spread, order, partitions)
    writer = laid_out.write.mode(mode).partitionBy(*partitions).option("compression", "zstd")
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    for column in bloom:
        # Parquet leaves the bloom filter out of a dictionary-encoded column; ids gain nothing from one.
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
        # As large as a file's ids need, from 512 bytes up; else 1 MB whatever it holds, and small batches make small files.
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        writer = writer.option(f"parquet.bloom.filter.candidates.number#{column}", "12")
    writer.parquet(path)


def _promote(df: DataFrame, promote: dict[str, list[str]] | None) -> DataFrame:
    added = {
        promoted_column(column, key): F.col(column)[key]
        for column, keys in (promote or {}).items()
        for key in keys
    }
    return df.withColumns(added) if added else df


WRITER, BATCH = "writer", "batch_id"
#: Who writes, where nobody else says so.
LOADS = "loads"


def _batch_columns(df: DataFrame, time: str, batch_id: int | None, writer: str) -> tuple[DataFrame, list[str], str]:
    """Partition columns and mode: a writer's batch overwrites only its own folders, so a replay is harmless.

    Two streams, or a stream and loads, number their batches alike; folders of their own keep them apart. A write without a
    number is a writer of its own. Rows with a reason have no day.
    """
    if REASON in df.columns:
        day = F.when(F.col(REASON).isNull(), F.to_date(time))
    else:
        day, df = F.to_date(time), df.withColumns({WHAT: F.lit(None).cast("string"), REASON: F.lit(None).cast("string")})
    if batch_id is None:
        writer, batch_id, mode = f"{writer}-{uuid.uuid4().hex}", 0, "append"
    else:
        mode = "overwrite"
    return df.withColumns({DAY: day, WRITER: F.lit(writer), BATCH: F.lit(batch_id).cast("bigint")}), [DAY, WRITER, BATCH], mode


def write_spans(
    spans: DataFrame, path: str, promote: dict[str, list[str]] | None = None, batch_id: int | None = None,
    writer: str = LOADS,
) -> None:
    """Append spans: by day, sorted by service, operation, time and trace id."""
    df, partitions, mode = _batch_columns(_promote(spans, promote), "Timestamp", batch_id, writer)
    order = ["ServiceName", "SpanName", "Timestamp", "TraceId"]
    _write(df, path, ["ServiceName", "SpanName"], order, partitions, ["TraceId"], mode)


def write_logs(
    logs: DataFrame, path: str, promote: dict[str, list[str]] | None = None, batch_id: int | None = None,
    writer: str = LOADS,
) -> None:
    """Append log records: by day, sorted by service, severity, time and trace id."""
    df, partitions, mode = _batch_columns(_promote(logs, promote), "Timestamp", batch_id, writer)
    order = ["ServiceName", "SeverityText", "Timestamp", "TraceId"]
    _write(df, path, ["ServiceName", "SeverityText"], order, partitions, ["TraceId"], mode)


def _write_points(df: DataFrame, path: str, leading: list[str], promote, batch_id: int | None, writer: str) -> None:
    df, partitions, mode = _batch_columns(_promote(df, promote), "TimeUnix", batch_id, writer)
    # Maps have no order; their canonical text is the sort key.
    order = ["MetricName", maps.attributes_id(F.col("Attributes")), "TimeUnix"]
    _write(df, path, ["MetricName"], order, leading + partitions, (), mode)


def write_metrics(
    tables: dict[str, DataFrame],
    path: str,
    promote: dict[str, list[str]] | None = None,
    batch_id: int | None = None,
    writer: str = LOADS,
) -> None:
    """Append metric tables below one folder: by day, sorted by name, attributes and time."""
    for kind, points in tables.items():
        _write_points(points, metric_table_for(path, kind), [], promote, batch_id, writer)


def write_metric_points(
    points: DataFrame, path: str, promote: dict[str, list[str]] | None = None, batch_id: int | None = None,
    writer: str = LOADS,
) -> None:
    """The same from flatten_metrics: all five tables in one job, with `kind` as the first partition."""
    _write_points(points, path, [KIND], promote, batch_id, writer)


def write_bounds(bounds: DataFrame, path: str, batch_id: int | None = None, writer: str = LOADS) -> None:
    """Append (partial) trace bounds, sorted by trace id within files; a batch replaces its own folders."""
    df, partitions, mode = _batch_columns(bounds, "Start", batch_id, writer)
    _write(df.drop(WHAT, REASON), path, ["TraceId"], ["TraceId", "Start"], partitions, ["TraceId"], mode)


def batch_of(spark: SparkSession, path: str, batch_id: int, writer: str = LOADS) -> DataFrame:
    """What one batch of a writer stored; only its folders are listed."""
    folders = f"{path.rstrip('/')}/{DAY}=*-*/{WRITER}={writer}/{BATCH}={batch_id}"
    return spark.read.option("basePath", path).parquet(folders).drop(WHAT, REASON)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """What a table's loads could not store: (what, reason, writer, batch_id); no rows where nothing was."""
    kinds = f"{WHAT} string, {REASON} string, {DAY} date, {WRITER} string, {BATCH} bigint"
    return spark.read.schema(kinds).parquet(path).filter(F.col(DAY).isNull()).select(WHAT, REASON, WRITER, BATCH)


def write_documents(documents: DataFrame, path: str) -> None:
    """Append JSON documents, one folder per target index."""
    laid_out = documents.hint("rebalance", F.col("index_name"))
    laid_out.write.mode("append").partitionBy("index_name").option("compression", "zstd").parquet(path)


def metric_table_for(path: str, kind: str) -> str:
    """Folder of the table that holds one kind of metric."""
    if kind not in schema.METRICS:
        raise ValueError(f"no metric kind {kind!r}; known: {', '.join(schema.METRIC_KINDS)}")
    return f"{path.rstrip('/')}/{KIND}={kind}"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table without what its loads refused."""
    table = spark.read.parquet(path)
    return table.filter(F.col(DAY).isNotNull()).drop(WHAT, REASON) if DAY in table.columns else table


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Written documents with their index names as text: an index may be called 007 or 2024."""
    stored = spark.read.option("recursiveFileLookup", "true").parquet(path).schema
    return spark.read.schema(stored.add("index_name", "string")).parquet(path)


def read_metric_table(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """One kind's table, without the columns that only other kinds have."""
    table = spark.read.parquet(metric_table_for(path, kind))
    others = {name for other in schema.METRICS.values() for name in other.names} - set(schema.METRICS[kind].names)
    return table.drop(*others, WHAT, REASON)


def retained(table: DataFrame, days: int, now: dt.datetime) -> DataFrame:
    """Rows of day partitions not wholly older than `days`; 0 keeps all."""
    if days <= 0:
        return table
    return table.filter(F.col(DAY) >= F.lit(now.date() - dt.timedelta(days=days)))


def apply_retention(spark: SparkSession, path: str, days: int, now: dt.datetime) -> list[str]:
    """Delete the day folders wholly older than `days` and name them. Files are listed, not read; refused records stay.

    A folder with one table, or with the five metric tables below it.
    """
    if days <= 0:
        return []
    oldest = (now.date() - dt.timedelta(days=days)).isoformat()
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    dropped = set()
    below = [status.getPath() for status in fs.listStatus(folder)]
    kinds = [p for p in below if p.getName().startswith(f"{KIND}=")]
    for path in below + [status.getPath() for kind in kinds for status in fs.listStatus(kind)]:
        name = path.getName()
        day = name.removeprefix(f"{DAY}=")
        if name.startswith(f"{DAY}=") and re.fullmatch(r"\d{4}-\d{2}-\d{2}", day) and day < oldest:
            fs.delete(path, True)
            dropped.add(day)
    return sorted(dropped)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def append_if_absent(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The rows of `new` whose key is not stored yet, one per key; append these.

    Rows of one key are the same document written twice, so any one of them will do; the
    smallest by text is taken to keep reruns equal. A row without a key is like no other and always new.

    Stored keys are looked up among the new ones first, so that only those found are shuffled where the new keys are few enough
    for Spark to broadcast them.
    """
    row = F.struct(*[c for c in new.columns if c != key])
    keyed = new.filter(F.col(key).isNotNull())
    first = keyed.groupBy(key).agg(F.min_by(row, F.to_json(row)).alias("row")).select(key, "row.*")
    stored = existing.select(key).join(keyed.select(key).distinct(), key, "left_semi").distinct()
    absent = first.join(stored, key, "left_anti").select(*new.columns)
    return absent.unionByName(new.filter(F.col(key).isNull()))
