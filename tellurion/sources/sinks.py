"""Rows for warehouses and lakes (K2-K5, K7): flat tables of logs, spans and metrics, typed Parquet by source, day and class."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tellurion.functions.shared import shared_path

#: Target columns that the three signals share, and the flat columns that fill them.
SHARED = {
    "ResourceSchemaURL": "resource_schema_url", "ResourceDroppedAttributesCount": "resource_dropped", "ResourceAttributes": "resource", "ScopeSchemaURL": "scope_schema_url",
    "ScopeName": "scope_name", "ScopeVersion": "scope_version", "ScopeDroppedAttributesCount": "scope_dropped", "ScopeAttributes": "scope_attributes",
}
LOG_COLUMNS = SHARED | {
    "Timestamp": "ts", "ObservedTimestamp": "observed_ts", "SeverityNumber": "severity_number", "SeverityText": "severity_text", "Body": "body_text",
    "Attributes": "attributes", "DroppedAttributesCount": "dropped", "Flags": "flags", "TraceID": "trace_id", "SpanID": "span_id",
}
SPAN_COLUMNS = SHARED | {
    "TraceID": "trace_id", "SpanID": "span_id", "TraceState": "trace_state", "ParentSpanID": "parent_span_id", "Name": "name", "Kind": "kind", "StartTime": "start_ts", "EndTime": "end_ts",
    "DroppedAttributesCount": "dropped", "Attributes": "attributes", "StatusMessage": "status_message", "StatusCode": "status_code",
}
POINT_COLUMNS = SHARED | {"MetricName": "metric_name", "MetricDescription": "description", "MetricUnit": "unit", "Attributes": "attributes", "StartTimestamp": "start_ts", "Timestamp": "ts", "Flags": "flags"}
#: Further columns of each kind of metric, as paths in its point.
KIND_COLUMNS = {
    "gauge": {}, "sum": {},
    "summary": {"Count": "count", "Sum": "sum", "QuantileValues": "quantileValues"},
    "histogram": {"Count": "count", "Sum": "sum", "Min": "min", "Max": "max", "BucketCounts": "bucketCounts", "ExplicitBounds": "explicitBounds"},
    "exponentialHistogram": {
        "Count": "count", "Sum": "sum", "Min": "min", "Max": "max", "Scale": "scale", "ZeroCount": "zeroCount", "PositiveOffset": "positive.offset", "PositiveBucketCounts": "positive.bucketCounts",
        "NegativeOffset": "negative.offset", "NegativeBucketCounts": "negative.bucketCounts",
    },
}
TABLES = {"gauge": "gauge", "sum": "sum", "summary": "summary", "histogram": "histogram", "exponentialHistogram": "exponential_histogram"}


def _shown(df: DataFrame, names: dict[str, str]) -> list[Column]:
    """Target columns from flat ones: maps as JSON, a column that the rows lack as null."""
    kinds = dict(df.dtypes)
    one = lambda c: F.lit(None).cast("string") if c not in kinds else F.to_json(c) if kinds[c].startswith(("map", "struct", "array")) else F.col(c)
    return [one(c).alias(k) for k, c in names.items()]


def warehouse_logs(df: DataFrame) -> DataFrame:
    """Flat logs as rows of 18 columns."""
    return df.select(*_shown(df, LOG_COLUMNS))


def warehouse_spans(df: DataFrame) -> DataFrame:
    """Flat spans as rows of 29 columns; events and links become parallel JSON arrays."""
    listed = lambda c, k: F.to_json(F.coalesce(F.transform(c, lambda e: e[k]), F.array()))
    events = {"EventTimes": "ts", "EventNames": "name", "EventDroppedAttributesCount": "dropped", "EventAttributes": "attributes"}
    links = {"LinkTraceID": "trace_id", "LinkSpanID": "span_id", "LinkTraceState": "trace_state", "LinkDroppedAttributesCount": "dropped", "LinkAttributes": "attributes"}
    return df.select(*_shown(df, SPAN_COLUMNS), *[listed("events", c).alias(k) for k, c in events.items()], *[listed("links", c).alias(k) for k, c in links.items()])


def warehouse_metrics(df: DataFrame) -> dict[str, DataFrame]:
    """Flat datapoints as one table for each kind, named by the suffix of its table."""
    out = {}
    for kind, suffix in TABLES.items():
        own = df.where(F.col("metric_type") == kind)
        at = lambda p: F.get_json_object("point", f"$.{p}")
        cols = [*_shown(own, POINT_COLUMNS), *[at(p).alias(k) for k, p in KIND_COLUMNS[kind].items()]]
        if kind in ("gauge", "sum"):
            cols.append(F.col("value").alias("Value"))
        if kind == "sum":
            cols += [F.col("temporality").alias("AggregationTemporality"), F.col("monotonic").alias("IsMonotonic")]
        elif kind in ("histogram", "exponentialHistogram"):
            cols.append(F.col("temporality").alias("AggregationTemporality"))
        if kind != "summary":
            each = {"Attributes": "filteredAttributes", "Timestamps": "timeUnixNano", "TraceIDs": "traceId", "SpanIDs": "spanId", "Values": "asDouble"}
            cols += [at(f"exemplars[*].{p}").alias(f"Exemplar{k}") for k, p in each.items()]
        out[suffix] = own.select(*cols)
    return out


def write_warehouse(tables: dict[str, DataFrame], name: str, mode: str = "append") -> None:
    """Each table as `<name>_<suffix>` of the session's catalogue."""
    for suffix, df in tables.items():
        df.write.mode(mode).saveAsTable(f"{name}_{suffix}")


def lake_rows(df: DataFrame, sources: dict[int, str], body: str = "body_text") -> tuple[DataFrame, DataFrame]:
    """(rows, rejected): events with a known class as rows with source, event day (UTC), class and time. `reason` says why others go."""
    number = lambda k: F.get_json_object(body, f"$.{k}").try_cast("double").try_cast("bigint")
    names = F.create_map(*[x for k, v in sources.items() for x in (F.lit(k), F.lit(v))])
    out = df.withColumns({"class_uid": number("class_uid"), "time": number("time")})
    out = out.withColumns({"source": F.try_element_at(names, F.col("class_uid").cast("int")), "event_day": F.date_format(F.timestamp_millis("time"), "yyyyMMdd")})
    reason = F.when(~F.coalesce(F.trim(F.col(body)).startswith("{"), F.lit(False)), "no object").when(F.col("class_uid").isNull(), "no class").when(F.col("source").isNull(), "unknown class").when(F.col("time").isNull(), "no time")
    out = out.withColumn("reason", reason)
    return out.where("reason is null").drop("reason"), out.where("reason is not null")


def class_schemas(text: str) -> dict[int, str]:
    """The typed columns of event classes from JSON, {class: DDL}, for `schemas` of write_lake. DDL that Spark can't read is an error."""
    out = {int(k): v for k, v in json.loads(text).items()}
    for ddl in out.values():
        StructType.fromDDL(ddl)
    return out


def write_lake(rows: DataFrame, path: str, region: str, account: str, schemas: dict[int, str] | None = None, body: str = "body_text", salt: int = 1, file_rows: int = 1_000_000, mode: str = "append") -> None:
    """Parquet (zstd) below ext=<source>/region=/accountId=/eventDay=/class=, each file sorted by time.

    Rows are counted by source, day and class, and each of these is dealt to a task for every
    `file_rows` of its rows, `salt` at least. With a schema (DDL) of a class its bodies become typed columns; the rest
    stay JSON. A class with a schema is written on its own, as its columns are.
    """
    schemas = schemas or {}
    keys = ["source", "event_day", "class_uid"]
    rows = rows.select(*keys, "time", body)
    if schemas:  # put to disk by class once, so that each class's own write reads only its rows
        staged, spark = shared_path(rows.sparkSession, "classes"), rows.sparkSession
        typed = F.when(F.col("class_uid").isin(list(schemas)), F.col("class_uid")).otherwise(-1)
        rows.withColumn("_class", typed).write.partitionBy("_class").parquet(staged)
        rows = spark.read.schema(StructType([*rows.schema.fields, StructField("_class", LongType())])).parquet(staged)
    counted = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.greatest(F.ceil(F.count("*") / file_rows), F.lit(salt)).alias("_files")).where("_files > 1")
    counted = counted.persist()
    for k, schema in [*schemas.items(), (-1, None)]:
        df = rows.where(F.col("_class") == k) if schemas else rows
        shaped = df.select(*keys, "time", *([F.from_json(body, schema).alias("event")] if schema else [F.col(body)]))
        sized = shaped.join(counted, [F.col(x) == F.col(f"_{x}") for x in keys], "left")
        spread = F.pmod(F.xxhash64("time", *([] if schema else [body])), F.coalesce("_files", F.lit(1)))
        dealt = sized.withColumn("_file", spread).repartition(*keys, "_file").drop("_source", "_event_day", "_class_uid", "_files", "_file")
        named = dealt.withColumns({"region": F.lit(region), "accountId": F.lit(account), "eventDay": F.col("event_day"), "ext": F.col("source"), "class": F.col("class_uid")})
        w = named.drop("source", "event_day").sortWithinPartitions("ext", "eventDay", "class", "time")
        w.write.mode(mode).partitionBy("ext", "region", "accountId", "eventDay", "class").option("compression", "zstd").parquet(path)
    counted.unpersist()


def json_arrays(df: DataFrame, keys: Sequence[str], rows: int = 1000) -> DataFrame:
    """JSON arrays of about `rows` rows of the same keys. Equal rows are counted first and dealt out in pieces; pieces go to buckets by
    hash, as many as the key's count asks for, so neither a key nor the copies of one row land in one task."""
    rest, piece = [c for c in df.columns if c not in keys], max(1, rows // 10)
    counted = df.select(*keys, F.to_json(F.struct(*rest)).alias("_row")).groupBy(*keys, "_row").agg(F.count("*").alias("_n"))
    many = counted.groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).agg(F.ceil(F.sum("_n") / rows).alias("_buckets")).where("_buckets > 1")
    sized = counted.join(many, [F.col(f"_key{i}").eqNullSafe(F.col(k)) for i, k in enumerate(keys)], "left")
    last = F.floor((F.col("_n") - 1) / piece)
    pieces = sized.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    copies = F.when(F.col("_piece") == last, F.col("_n") - last * piece).otherwise(piece).cast("int")
    bucket = F.pmod(F.xxhash64("_row", "_piece"), F.coalesce("_buckets", F.lit(1))).cast("int")
    lists = pieces.withColumn("bucket", bucket).groupBy(*keys, "bucket").agg(F.flatten(F.collect_list(F.array_repeat("_row", copies))).alias("_rows"))
    return lists.select(*keys, "bucket", F.concat(F.lit("["), F.array_join("_rows", ","), F.lit("]")).alias("body"), F.size("_rows").cast("long").alias("n"))
