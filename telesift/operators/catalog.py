"""Service and operation catalogue, target index, quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telesift.functions import ids, maps

# Attributes that name the target index.
INDEX_PREFIX = "elasticsearch.index.prefix"
INDEX_SUFFIX = "elasticsearch.index.suffix"


def validate(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split rows into good ones and bad ones with the `reason`, the first rule that holds."""
    reason = F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules.items()])
    marked = df.withColumn("reason", reason)
    return marked.filter(F.col("reason").isNull()).drop("reason"), marked.filter(F.col("reason").isNotNull())


def span_rules() -> dict[str, Column]:
    """What makes a span unusable."""
    return {
        "trace id is missing": F.col("TraceId") == "",
        "trace id is not 32 hex digits": ~F.col("TraceId").rlike("^[0-9a-f]{32}$"),
        "span id is not 16 hex digits": ~F.col("SpanId").rlike("^[0-9a-f]{16}$"),
        "span ends before it starts": F.col("Duration") < 0,
    }


def has_no_service(spans: DataFrame) -> Column:
    return ~F.map_contains_key(F.col("ResourceAttributes"), "service.name")


def service_operations(spans: DataFrame) -> DataFrame:
    """Distinct (service, operation) with a stable id; spans without a service are left to quarantine."""
    distinct = (
        spans.filter(~has_no_service(spans))
        .select(F.col("ServiceName").alias("serviceName"), F.col("SpanName").alias("operationName"))
        .distinct()
    )
    key = ids.service_operation_id(F.col("serviceName"), F.col("operationName"))
    return distinct.select(key.alias("id"), "serviceName", "operationName")


def route_by_index(
    df: DataFrame, base: str, enabled: bool = True, column: str = "SpanAttributes"
) -> DataFrame:
    """Adds `index_name`: prefix + base + suffix from attributes, the resource before the record."""
    if not enabled:
        return df.withColumn("index_name", F.lit(base))

    def part(key: str) -> Column:
        return F.coalesce(maps.first_attribute(key, F.col("ResourceAttributes"), F.col(column)), F.lit(""))

    return df.withColumn("index_name", F.concat(part(INDEX_PREFIX), F.lit(base), part(INDEX_SUFFIX)))
