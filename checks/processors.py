"""Processors: edits of attributes, sampling, regrouping, enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.views import duck
from telesift.operators import attributes as attrs
from telesift.operators import sampling

CLUSTER = "k8s.cluster.id"


def _attr(key: str, name: str, column: str = "SpanAttributes"):
    return F.col(column)[key].alias(name)


@query("insert_attribute", duck("spans_v", "SELECT SpanId, 'c1' AS cluster, user_text AS user_id FROM spans_v"))
def _(v):
    done = attrs.insert_attribute(attrs.insert_attribute(v.spans, CLUSTER, "c1"), "user.id", "ignored")
    return done.select("SpanId", _attr(CLUSTER, "cluster"), _attr("user.id", "user_id"))


@query("update_attribute", duck("spans_v", "SELECT SpanId, CAST(NULL AS VARCHAR) AS cluster, 'set' AS user_id FROM spans_v"))
def _(v):
    done = attrs.update_attribute(attrs.update_attribute(v.spans, CLUSTER, "c1"), "user.id", "set")
    return done.select("SpanId", _attr(CLUSTER, "cluster"), _attr("user.id", "user_id"))


@query("upsert_attribute", duck("spans_v", "SELECT SpanId, 'c1' AS cluster, 'set' AS user_id FROM spans_v"))
def _(v):
    done = attrs.upsert_attribute(attrs.upsert_attribute(v.spans, CLUSTER, "c1"), "user.id", "set")
    return done.select("SpanId", _attr(CLUSTER, "cluster"), _attr("user.id", "user_id"))


@query("delete_attribute", duck("spans_v", "SELECT SpanId, k, 1::BIGINT AS attributes FROM spans_v"))
def _(v):
    done = attrs.delete_attribute(v.spans, "user.id")
    return done.select("SpanId", _attr("k", "k"), F.size("SpanAttributes").cast("bigint").alias("attributes"))


@query("upsert_resource_attribute", duck("spans_v", "SELECT 'renamed' AS ServiceName, host, count(*) AS spans FROM spans_v GROUP BY 2"))
def _(v):
    done = attrs.upsert_resource_attribute(v.spans, "service.name", "renamed")
    return done.groupBy("ServiceName", _attr("host.name", "host", "ResourceAttributes")).agg(F.count("*").alias("spans"))


@query("group_by_attrs", duck("spans_v", "SELECT user_text AS user_id, host, count(*) AS spans, 0::BIGINT AS left_behind FROM spans_v GROUP BY 1, 2"))
def _(v):
    moved = attrs.group_by_attrs(v.spans, ["user.id"])
    return moved.groupBy(
        _attr("user.id", "user_id", "ResourceAttributes"), _attr("host.name", "host", "ResourceAttributes")
    ).agg(F.count("*").alias("spans"), F.count(F.col("SpanAttributes")["user.id"]).alias("left_behind"))


@query("filter_signals", duck("spans_v", "SELECT SpanId FROM spans_v WHERE NOT (ServiceName = 'svc-view' AND StatusCode <> 'STATUS_CODE_ERROR')"))
def _(v):
    drop = (F.col("ServiceName") == "svc-view") & (F.col("StatusCode") != "STATUS_CODE_ERROR")
    return attrs.filter_signals(v.spans, drop).select("SpanId")


@query("redact", duck("spans_v", r"""SELECT SpanId, regexp_replace(user_text, '1[0-9]', '****', 'g') AS user_id,
  (k IS NOT NULL)::INTEGER AS redacted_keys, regexp_matches(user_text, '1[0-9]')::INTEGER AS masked_values FROM spans_v"""))
def _(v):
    done = attrs.redact(v.spans, ["user.id"], ["1[0-9]"])
    return done.select("SpanId", _attr("user.id", "user_id"), "redacted_keys", "masked_values")


@query("rename_spans", duck("spans_v", "SELECT SpanId, CASE WHEN k IS NULL THEN SpanName ELSE user_text || '::' || k END AS SpanName FROM spans_v"))
def _(v):
    return attrs.rename_spans(v.spans, ["user.id", "k"], "::").select("SpanId", "SpanName")


@query("name_to_attributes", duck("spans_v", "SELECT SpanId, 'op-{number}' AS SpanName, substr(SpanName, 4) AS number FROM spans_v"))
def _(v):
    done = attrs.name_to_attributes(v.spans, "^op-([0-9]+)$", ["number"])
    return done.select("SpanId", "SpanName", _attr("number", "number"))


@query("name_to_attributes_alternatives", duck("spans_v", """SELECT SpanId,
  CASE WHEN event_id % 7 < 3 THEN 'op-{low}' WHEN event_id % 7 < 6 THEN '{kind}-{high}' ELSE SpanName END AS SpanName,
  CASE WHEN event_id % 7 < 3 THEN substr(SpanName, 4) END AS low, CASE WHEN event_id % 7 BETWEEN 3 AND 5 THEN substr(SpanName, 4) END AS high,
  CASE WHEN event_id % 7 BETWEEN 3 AND 5 THEN 'op' END AS kind FROM spans_v"""))
def _(v):
    done = attrs.name_to_attributes(v.spans, "^op-(?P<low>[0-2])$|^(?P<kind>[a-z]+)-(?P<high>[3-5])+$")
    return done.select("SpanId", "SpanName", _attr("low", "low"), _attr("high", "high"), _attr("kind", "kind"))


@query("enrich", duck("spans_v", """SELECT SpanId, r_name AS region, n_name AS nation FROM spans_v
  LEFT JOIN nation ON host = 'host-' || n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""))
def _(v):
    done = attrs.enrich(v.spans, v.hosts, "host.name")
    return done.select(
        "SpanId", _attr("cloud.region", "region", "ResourceAttributes"), _attr("cloud.nation", "nation", "ResourceAttributes")
    )


# ---- traces -----------------------------------------------------------------------------------

HASH_SQL = "('0x' || substr(md5('7' || TraceId), 1, 8))::UBIGINT < CAST(floor({ratio} * 4294967296) AS UBIGINT)"


@query("group_by_trace", duck("spans_v", "SELECT TraceId, count(*) AS spans, sum(Duration)::BIGINT AS ns FROM spans_v WHERE TraceId <> '' GROUP BY 1"))
def _(v):
    # Four spans per part at most, so that most traces come in parts.
    parts = sampling.group_by_trace(v.spans, max_spans=10)
    total = F.aggregate("Spans", F.lit(0).cast("bigint"), lambda a, s: a + s["Duration"])
    return parts.groupBy("TraceId").agg(F.sum("span_count").alias("spans"), F.sum(total).alias("ns"))


@query("probabilistic_sample", duck("spans_v", f"SELECT SpanId FROM spans_v WHERE {HASH_SQL.format(ratio=0.25)}"))
def _(v):
    return sampling.probabilistic_sample(v.spans, 0.25, seed=7).select("SpanId")


@query("tail_sample", duck("spans_v", f"""SELECT SpanId FROM spans_v WHERE TraceId IN (
  SELECT f.TraceId FROM (SELECT TraceId, max(TimestampNs + Duration) - min(TimestampNs) AS d, bool_or(user_text = '11') AS m
    FROM spans_v WHERE TraceId <> '' GROUP BY 1) f
  WHERE d >= 5000000000000 OR m OR {HASH_SQL.format(ratio=0.1).replace('TraceId', 'f.TraceId')})"""))
def _(v):
    policy = sampling.TailPolicy(min_duration_ns=5_000_000_000_000, attributes={"user.id": "11"}, ratio=0.1, seed=7)
    return sampling.tail_sample(v.spans, policy).select("SpanId")


@query("tail_sample_errors", duck("spans_v", """SELECT SpanId FROM spans_v WHERE TraceId IN (
  SELECT TraceId FROM spans_v WHERE TraceId <> '' AND StatusCode = 'STATUS_CODE_ERROR')"""))
def _(v):
    return sampling.tail_sample(v.spans, sampling.TailPolicy(has_error=True)).select("SpanId")
