"""Spans, logs and metrics derived from the test tables, row by row, once for Spark and once for DuckDB."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telesift import configure
from telesift.schema import EVENTS, LINKS, LOGS, METRICS, SPANS
from telesift.session import scratch_path
from telesift.sources.otlp import METRIC_FIELDS

# Every event is a span. Traces are runs of 8 or 16 neighbouring events; a span's parent is one
# of the five before it. One span in 211 has no trace, one in 50 an unknown parent, one in 97
# no service.
_SPANS_SQL = """
SELECT event_id, ts AS "Timestamp", {us}(ts) * 1000 + event_id % 1000 AS TimestampNs,
  CASE WHEN event_id % 211 = 0 THEN '' ELSE md5(concat('t', trace_no)) END AS TraceId,
  substr(md5(CAST(event_id AS VARCHAR)), 1, 16) AS SpanId,
  CASE WHEN event_id % 50 = 0 THEN substr(md5(concat('gone', event_id)), 1, 16)
       WHEN event_id = trace_no * 8 THEN ''
       ELSE substr(md5(CAST(event_id - least(event_id - trace_no * 8, 1 + user_id % 5) AS VARCHAR)), 1, 16)
  END AS ParentSpanId,
  concat('op-', event_id % 7) AS SpanName,
  CASE event_id % 6 WHEN 0 THEN 'SPAN_KIND_UNSPECIFIED' WHEN 1 THEN 'SPAN_KIND_INTERNAL'
    WHEN 2 THEN 'SPAN_KIND_SERVER' WHEN 3 THEN 'SPAN_KIND_CLIENT' WHEN 4 THEN 'SPAN_KIND_PRODUCER'
    ELSE 'SPAN_KIND_CONSUMER' END AS SpanKind,
  CASE WHEN event_id % 97 = 0 THEN '' ELSE concat('svc-', event_type) END AS ServiceName,
  CAST(round(value * 100) AS BIGINT) * 10000 AS Duration,
  CASE WHEN event_type = 'error' THEN 'STATUS_CODE_ERROR' WHEN event_id % 3 = 0 THEN 'STATUS_CODE_OK'
    ELSE 'STATUS_CODE_UNSET' END AS StatusCode,
  CASE WHEN event_type = 'error' THEN 'failed' ELSE '' END AS StatusMessage,
  trace_no, user_id, event_type, value, props, k,
  CAST(user_id AS VARCHAR) AS user_text, concat('host-', user_id % 4) AS host
FROM base
"""

_BASE_SQL = """
SELECT event_id, {ts} AS ts, user_id, event_type, value, props, {k} AS k,
  {div8} - CASE WHEN {div8} % 3 = 2 THEN 1 ELSE 0 END AS trace_no
FROM events
"""

_SEVERITY = """
  CASE event_type WHEN 'error' THEN {0} WHEN 'signup' THEN {1} WHEN 'view' THEN {3} ELSE {2} END
"""
_SEVERITY_TEXT = _SEVERITY.format("'ERROR'", "'WARN'", "'INFO'", "'DEBUG'")
_SEVERITY_NUMBER = _SEVERITY.format(17, 13, 9, 5)

HISTOGRAM_BOUNDS = (1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0)
EXPONENTS = tuple(range(-7, 9))


def _bucket_sql() -> list[str]:
    edges = (None, *HISTOGRAM_BOUNDS, None)
    conditions = []
    for low, high in zip(edges, edges[1:]):
        parts = ([f"value > {low}"] if low is not None else []) + ([f"value <= {high}"] if high is not None else [])
        conditions.append(" AND ".join(parts))
    return [f"count(CASE WHEN {c} THEN 1 END)" for c in conditions]


def _exponent_sql() -> list[str]:
    return [f"count(CASE WHEN value > {2.0**i} AND value <= {2.0**(i + 1)} THEN 1 END)" for i in EXPONENTS]


# ---- DuckDB ------------------------------------------------------------------------------------

DUCK_VIEWS = {
    "base": _BASE_SQL.format(ts="ts", k="json_extract_string(props, '$.k')", div8="(event_id // 8)"),
    "spans_v": _SPANS_SQL.format(us="epoch_us"),
    "logs_v": f"""
        SELECT "Timestamp", TimestampNs, TraceId, SpanId, {_SEVERITY_TEXT} AS SeverityText,
          {_SEVERITY_NUMBER} AS SeverityNumber, ServiceName, props AS Body, k, event_type, host
        FROM spans_v""",
    "doc_logs_v": """
        SELECT TIMESTAMP '2024-01-01' + to_seconds(doc_id) AS "Timestamp",
          epoch_us(TIMESTAMP '2024-01-01') * 1000 + doc_id * 1000000000 AS TimestampNs,
          source AS ServiceName, text AS Body, lang, doc_id, substr(md5(CAST(doc_id AS VARCHAR)), 1, 16) AS SpanId
        FROM documents""",
    "gauge_v": """
        SELECT concat(event_type, '.value') AS MetricName, user_text, host, "Timestamp" AS TimeUnix,
          TimestampNs AS TimeUnixNs, value AS Value, event_id, event_type FROM spans_v""",
    "sum_v": """
        SELECT concat(event_type, '.total') AS MetricName, user_text, host, TimestampNs AS TimeUnixNs,
          CAST((epoch_us("Timestamp") % 86400000000) // 1000000 + CAST(k AS BIGINT) AS DOUBLE) AS Value, event_id
        FROM spans_v""",
    "day_v": f"""
        SELECT concat(event_type, '.size') AS MetricName, CAST(CAST(ts AS DATE) AS VARCHAR) AS day_text,
          count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100 AS total,
          min(value) AS low, max(value) AS high, count(CASE WHEN value = 0 THEN 1 END) AS zeros,
          {", ".join(f"{b} AS b{i}" for i, b in enumerate(_bucket_sql()))},
          {", ".join(f"{b} AS e{i}" for i, b in enumerate(_exponent_sql()))}
        FROM base GROUP BY 1, 2""",
}
_NEEDS = {
    "base": [],
    "spans_v": ["base"],
    "logs_v": ["base", "spans_v"],
    "doc_logs_v": [],
    "gauge_v": ["base", "spans_v"],
    "sum_v": ["base", "spans_v"],
    "day_v": ["base"],
}


def duck(view: str, body: str, **more: str) -> str:
    """A DuckDB statement over one of the views, with further common tables in order."""
    names = [*_NEEDS[view], view]
    tables = {name: DUCK_VIEWS[name] for name in names} | more
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in tables.items())
    return f"WITH {ctes}\n{body}"


# ---- Spark -------------------------------------------------------------------------------------


def _nulls(schema, given: dict) -> list:
    """All columns of a table schema: the given ones, typed NULLs for the rest."""
    return [
        (given[f.name] if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ]


def _strip(entries: dict[str, str]) -> str:
    """A map without the entries whose value is NULL."""
    pairs = ", ".join(f"'{k}', {v}" for k, v in entries.items())
    return f"map_filter(map({pairs}), (k, v) -> v IS NOT NULL)"


# JSON forms of attribute values; a struct's NULL fields are not written.
_LEAF = "named_struct('intValue', {}, 'stringValue', {})"
_LEAF_INT = _LEAF.format("k", "CAST(NULL AS STRING)")
_LEAF_TEXT = _LEAF.format("CAST(NULL AS STRING)", "'x'")
_LEAVES = "STRUCT<intValue: STRING, stringValue: STRING>"
_VALUE_TYPES = {
    "stringValue": "STRING", "intValue": "STRING", "doubleValue": "DOUBLE", "boolValue": "BOOLEAN",
    "arrayValue": f"STRUCT<values: ARRAY<{_LEAVES}>>",
    "kvlistValue": f"STRUCT<values: ARRAY<STRUCT<key: STRING, value: {_LEAVES}>>>",
}


def _kv(key: str, **value: str) -> str:
    fields = ", ".join(f"'{f}', {value.get(f, f'CAST(NULL AS {t})')}" for f, t in _VALUE_TYPES.items())
    return f"named_struct('key', '{key}', 'value', named_struct({fields}))"


def _kvs(column: str) -> str:
    """A string map as an attribute list."""
    return f"transform(map_entries({column}), a -> named_struct('key', a.key, 'value', named_struct('stringValue', a.value)))"


class Views:
    """The views of one test folder in Spark."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def spans_of(self, events: DataFrame) -> DataFrame:
        """The spans view of any events, batch or stream, with the columns it was made from."""
        base = events.selectExpr(
            "event_id", "CAST(ts AS TIMESTAMP) AS ts", "user_id", "event_type", "value", "props",
            "get_json_object(props, '$.k') AS k",
            "(event_id DIV 8) - CASE WHEN (event_id DIV 8) % 3 = 2 THEN 1 ELSE 0 END AS trace_no",
        )
        select = _SPANS_SQL.format(us="unix_micros").replace("AS VARCHAR", "AS STRING").replace('"', "`")
        rows = base.sparkSession.sql(select.replace("FROM base", "FROM {base}"), base=base)
        return rows.selectExpr(
            "*",
            "'' AS TraceState", "'fixture' AS ScopeName", "'1.0' AS ScopeVersion",
            _strip({"k": "k", "user.id": "user_text"}) + " AS SpanAttributes",
            _strip({"service.name": "nullif(ServiceName, '')", "host.name": "host"}) + " AS ResourceAttributes",
            """CASE WHEN event_type = 'error' THEN array(named_struct('Timestamp', `Timestamp`,
                 'TimestampNs', TimestampNs + 1000, 'Name', 'exception',
                 'Attributes', map('exception.type', concat('E', event_id % 3))))
               WHEN event_type = 'purchase' THEN array(
                 named_struct('Timestamp', `Timestamp`, 'TimestampNs', TimestampNs, 'Name', 'cart',
                   'Attributes', CAST(map() AS MAP<STRING,STRING>)),
                 named_struct('Timestamp', `Timestamp`, 'TimestampNs', TimestampNs + 2000, 'Name', 'pay',
                   'Attributes', map('amount', CAST(CAST(round(value * 100) AS BIGINT) AS STRING))))
               END AS events_0""",
            """CASE WHEN event_id % 10 = 3 THEN array(named_struct('TraceId', md5(concat('t', trace_no + 3)),
                 'SpanId', substr(md5(CAST(event_id + 1 AS STRING)), 1, 16), 'TraceState', '',
                 'Attributes', map('why', 'follows'))) END AS links_0""",
        ).withColumns(
            {
                "Events": F.coalesce("events_0", F.array().cast(EVENTS)),
                "Links": F.coalesce("links_0", F.array().cast(LINKS)),
            }
        ).drop("events_0", "links_0")

    @cached_property
    def wide_spans(self) -> DataFrame:
        """Spans with the event columns they were made from."""
        return self.spans_of(self.table("events"))

    @cached_property
    def dealt_spans(self) -> DataFrame:
        """The same, dealt over all cores first: small files are few splits, however much work is done on a row."""
        spark = self.spark
        parts = max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        return self.spans_of(self.table("events").repartition(parts, "event_id", "user_id", "ts"))

    @cached_property
    def spans(self) -> DataFrame:
        return self.wide_spans.select(*SPANS.names)

    def logs_of(self, wide_spans: DataFrame) -> DataFrame:
        given = {c: F.col(c) for c in ("Timestamp", "TimestampNs", "TraceId", "SpanId", "ServiceName", "ScopeName",
                                       "ScopeVersion", "ResourceAttributes")}
        given |= {
            "TraceFlags": F.lit(1),
            "SeverityText": F.expr(_SEVERITY_TEXT),
            "SeverityNumber": F.expr(_SEVERITY_NUMBER),
            "Body": F.col("props"),
            "ResourceSchemaUrl": F.lit("urn:telesift:fixture:resource"),
            "ScopeSchemaUrl": F.lit("urn:telesift:fixture:scope"),
            "ScopeAttributes": F.expr("map('origin', 'events')"),
            "LogAttributes": F.expr(_strip({"k": "k", "event": "event_type"})),
        }
        return wide_spans.select(*_nulls(LOGS, given))

    @cached_property
    def logs(self) -> DataFrame:
        return self.logs_of(self.wide_spans)

    @cached_property
    def doc_logs(self) -> DataFrame:
        at = F.expr("TIMESTAMP '2024-01-01' + make_dt_interval(0, 0, 0, doc_id)")
        given = {
            "Timestamp": at,
            "TimestampNs": F.expr("unix_micros(TIMESTAMP '2024-01-01') * 1000 + doc_id * 1000000000"),
            "TraceId": F.lit(""),
            "SpanId": F.expr("substr(md5(CAST(doc_id AS STRING)), 1, 16)"),
            "SeverityText": F.lit("INFO"),
            "SeverityNumber": F.lit(9),
            "ServiceName": F.col("source"),
            "Body": F.col("text"),
            "LogAttributes": F.expr(_strip({"lang": "lang", "doc": "CAST(doc_id AS STRING)"})),
        }
        return self.table("documents").select(*_nulls(LOGS, given))

    def _point(self, kind: str, rows: DataFrame, given: dict) -> DataFrame:
        return rows.select(*_nulls(METRICS[kind], given))

    @cached_property
    def gauge(self) -> DataFrame:
        return self._gauge_of(self.wide_spans)

    def _gauge_of(self, wide_spans: DataFrame) -> DataFrame:
        return self._point("gauge", wide_spans, {
            "MetricName": F.expr("concat(event_type, '.value')"),
            "Attributes": F.expr("map('user', user_text)"),
            "ResourceAttributes": F.expr("map('host.name', host)"),
            "TimeUnix": F.col("Timestamp"), "TimeUnixNs": F.col("TimestampNs"), "Value": F.col("value"),
        })

    @cached_property
    def sum(self) -> DataFrame:
        return self._sum_of(self.wide_spans)

    def _sum_of(self, wide_spans: DataFrame) -> DataFrame:
        value = "CAST((unix_micros(`Timestamp`) % 86400000000) DIV 1000000 + CAST(k AS BIGINT) AS DOUBLE)"
        return self._point("sum", wide_spans, {
            "MetricName": F.expr("concat(event_type, '.total')"),
            "Attributes": F.expr("map('user', user_text)"),
            "ResourceAttributes": F.expr("map('host.name', host)"),
            "TimeUnix": F.col("Timestamp"), "TimeUnixNs": F.col("TimestampNs"),
            "Value": F.expr(value), "AggTemp": F.lit(2), "IsMonotonic": F.lit(True),
        })

    @cached_property
    def _days(self) -> DataFrame:
        """Per event type and day the sums that the three distribution tables need."""
        grouped = self.table("events").groupBy(
            F.expr("concat(event_type, '.size')").alias("MetricName"), F.to_date(F.col("ts")).alias("date")
        )
        return grouped.agg(
            F.expr("count(*)").alias("n"),
            F.expr("CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100").alias("total"),
            F.min("value").alias("low"), F.max("value").alias("high"),
            F.expr("count(CASE WHEN value = 0 THEN 1 END)").alias("zeros"),
            *[F.expr(b).alias(f"b{i}") for i, b in enumerate(_bucket_sql())],
            *[F.expr(b).alias(f"e{i}") for i, b in enumerate(_exponent_sql())],
        )

    def _day_point(self, kind: str, more: dict) -> DataFrame:
        at = F.col("date").cast("timestamp")
        return self._point(kind, self._days, {
            "MetricName": F.col("MetricName"),
            "Attributes": F.expr("map('day', CAST(date AS STRING))"),
            "ResourceAttributes": F.expr("map('host.name', 'host-0')"),
            "TimeUnix": at, "TimeUnixNs": F.unix_micros(at) * 1000,
            "Count": F.col("n"), "Sum": F.col("total"), **more,
        })

    @cached_property
    def histogram(self) -> DataFrame:
        return self._day_point("histogram", {
            "BucketCounts": F.array(*[f"b{i}" for i in range(len(HISTOGRAM_BOUNDS) + 1)]),
            "ExplicitBounds": F.array(*map(F.lit, HISTOGRAM_BOUNDS)),
            "Min": F.col("low"), "Max": F.col("high"),
        })

    @cached_property
    def exponential_histogram(self) -> DataFrame:
        return self._day_point("exponential_histogram", {
            "Scale": F.lit(0), "ZeroCount": F.col("zeros"), "PositiveOffset": F.lit(EXPONENTS[0]),
            "PositiveBucketCounts": F.array(*[f"e{i}" for i in range(len(EXPONENTS))]),
            "NegativeOffset": F.lit(0), "NegativeBucketCounts": F.array().cast("array<bigint>"),
            "Min": F.col("low"), "Max": F.col("high"),
        })

    @cached_property
    def summary(self) -> DataFrame:
        pairs = F.expr("array(named_struct('Quantile', 0.0D, 'Value', low), named_struct('Quantile', 1.0D, 'Value', high))")
        return self._day_point("summary", {"ValueAtQuantiles": pairs})

    @cached_property
    def hosts(self) -> DataFrame:
        """Dimension table: host name to region."""
        nation, region = self.table("nation"), self.table("region")
        joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
        return joined.select(
            F.concat(F.lit("host-"), F.col("n_nationkey").cast("string")).alias("host.name"),
            F.col("r_name").alias("cloud.region"), F.col("n_name").alias("cloud.nation"),
        )

    def event_stream(self) -> DataFrame:
        """The events file as a stream."""
        schema = self.table("events").schema
        return (
            self.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(self.sf_dir)
        )

    # -- OTLP messages ---------------------------------------------------------------------------

    @cached_property
    def event_count(self) -> int:
        return self.table("events").count()

    def written(self, messages: DataFrame, files: int | None = None) -> str:
        """Messages as compressed JSON lines, as they repeat most of their text; so many files, or one from each partition."""
        path = scratch_path(self.spark, "messages")
        (messages.coalesce(files) if files else messages).write.option("compression", "gzip").text(path)
        return path

    @cached_property
    def trace_messages(self) -> DataFrame:
        """The spans as trace messages: one per 64 events, its spans under their resources."""
        span = f"""named_struct('traceId', TraceId, 'spanId', SpanId, 'parentSpanId', ParentSpanId, 'name', SpanName,
          'kind', CAST(event_id % 6 AS INT), 'startTimeUnixNano', CAST(TimestampNs AS STRING),
          'endTimeUnixNano', CAST(TimestampNs + Duration AS STRING),
          'attributes', array({_kv('k', intValue='k')}, {_kv('user.id', stringValue="'overwritten'")},
             {_kv('user.id', stringValue='user_text')}, {_kv('value', doubleValue='value')},
             {_kv('even', boolValue='event_id % 2 = 0')},
             {_kv('list', arrayValue=f"named_struct('values', array({_LEAF_INT}, {_LEAF_TEXT}))")},
             {_kv('deep', kvlistValue=f"named_struct('values', array(named_struct('key', 'b.c', 'value', {_LEAF_INT}), named_struct('key', 'a', 'value', {_LEAF_TEXT})))")}),
          'events', transform(Events, e -> named_struct('timeUnixNano', CAST(e.TimestampNs AS STRING), 'name', e.Name,
             'attributes', {_kvs('e.Attributes')})),
          'links', transform(Links, l -> named_struct('traceId', l.TraceId, 'spanId', l.SpanId,
             'attributes', {_kvs('l.Attributes')})),
          'status', named_struct('code', CASE StatusCode WHEN 'STATUS_CODE_OK' THEN 1 WHEN 'STATUS_CODE_ERROR' THEN 2 ELSE 0 END,
             'message', StatusMessage))"""
        return self._messages("resourceSpans", "scopeSpans", "spans", span)

    def _messages(self, top: str, scopes: str, items: str, item: str) -> DataFrame:
        """JSON messages of 64 events each; every group gathered here is bounded by that.

        Events are dealt by message as they are stored, so that only their few columns are shuffled, and once; a task has some
        65,536 of them, as gathering sorts all that a span holds.
        """
        block = F.expr("event_id DIV 64")
        parts = max(4, self.spark.sparkContext.defaultParallelism, -(-self.event_count // 2**16))
        dealt = self.spans_of(self.table("events").repartition(parts, block))
        per_resource = dealt.groupBy(block.alias("block"), "ServiceName", "host").agg(
            F.collect_list(F.expr(item)).alias("items")
        )
        resource = f"""named_struct(
          'resource', named_struct('attributes', filter(array({_kv('service.name', stringValue="nullif(ServiceName, '')")},
             {_kv('host.name', stringValue='host')}), a -> a.value.stringValue IS NOT NULL)),
          'schemaUrl', 'urn:telesift:fixture:resource',
          '{scopes}', array(named_struct('scope', named_struct('name', 'fixture', 'version', '1.0',
             'attributes', array({_kv('origin', stringValue="'events'")})),
             'schemaUrl', 'urn:telesift:fixture:scope', '{items}', items)))"""
        message = per_resource.groupBy("block").agg(F.collect_list(F.expr(resource)).alias(top))
        return message.select(F.to_json(F.struct(top)).alias("value"))

    @cached_property
    def log_messages(self) -> DataFrame:
        """The logs as log messages, one per 64 events."""
        record = f"""named_struct('timeUnixNano', CAST(TimestampNs AS STRING), 'severityNumber', {_SEVERITY_NUMBER},
          'severityText', {_SEVERITY_TEXT}, 'body', named_struct('stringValue', props), 'flags', 1, 'traceId', TraceId,
          'spanId', SpanId, 'attributes', array({_kv('k', stringValue='k')}, {_kv('event', stringValue='event_type')}))"""
        return self._messages("resourceLogs", "scopeLogs", "logRecords", record)

    @cached_property
    def metric_messages(self) -> DataFrame:
        """All five kinds of points as metric messages, and a metric of no type with each summary."""
        point = f"'attributes', {_kvs('Attributes')}, 'timeUnixNano', CAST(TimeUnixNs AS STRING)"
        texts = "transform({}, c -> CAST(c AS STRING))"
        distribution = f"{point}, 'count', CAST(Count AS STRING), 'sum', Sum"
        exemplar = "array(named_struct('timeUnixNano', CAST(TimeUnixNs AS STRING), 'asDouble', {}))"
        points = {
            "gauge": f"named_struct({point}, 'asDouble', Value, 'exemplars', {exemplar.format('Value')})",
            "sum": f"named_struct({point}, 'asInt', CAST(CAST(Value AS BIGINT) AS STRING))",
            "histogram": f"""named_struct({distribution}, 'bucketCounts', {texts.format('BucketCounts')},
                'explicitBounds', ExplicitBounds, 'min', Min, 'max', Max)""",
            "exponential_histogram": f"""named_struct({distribution}, 'scale', Scale, 'zeroCount', CAST(ZeroCount AS STRING),
                'positive', named_struct('offset', PositiveOffset, 'bucketCounts', {texts.format('PositiveBucketCounts')}),
                'min', Min, 'max', Max)""",
            "summary": f"""named_struct({distribution}, 'quantileValues', transform(ValueAtQuantiles,
                q -> named_struct('quantile', q.Quantile, 'value', q.Value)))""",
        }
        dealt = {"gauge": self._gauge_of, "sum": self._sum_of}
        messages = None
        for kind, expression in points.items():
            more = ", 'aggregationTemporality', AggTemp, 'isMonotonic', IsMonotonic" if kind == "sum" else ""
            metric = f"""to_json(named_struct('name', MetricName, 'unit', '1',
                '{METRIC_FIELDS[kind]}', named_struct('dataPoints', array({expression}){more})))"""
            if kind == "summary":
                metric += ", to_json(named_struct('name', concat('untyped.', MetricName)))"
            text = f"""concat('{{"resourceMetrics":[{{"resource":{{"attributes":', to_json({_kvs('ResourceAttributes')}),
                '}},"scopeMetrics":[{{"scope":{{"name":"fixture"}},"metrics":[', concat_ws(',', {metric}), ']}}]}}]}}')"""
            rows = dealt[kind](self.dealt_spans) if kind in dealt else getattr(self, kind)
            rows = rows.select(F.expr(text).alias("value"))
            messages = rows if messages is None else messages.unionAll(rows)
        return messages
