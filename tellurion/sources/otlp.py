"""Telemetry in OTLP JSON: landed files, and documents as rows of logs, datapoints or spans."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellurion.sources.landing import PARTS

_ATTRS = "array<struct<key:string,value:variant>>"
_RESOURCE = f"resource:struct<attributes:{_ATTRS},droppedAttributesCount:int>,schemaUrl:string"
_SCOPE = f"scope:struct<name:string,version:string,attributes:{_ATTRS},droppedAttributesCount:int>,schemaUrl:string"
_EXEMPLARS = f"exemplars:array<struct<filteredAttributes:{_ATTRS},timeUnixNano:string,traceId:string,spanId:string,asDouble:double,asInt:string>>"
_POINT = f"attributes:{_ATTRS},startTimeUnixNano:string,timeUnixNano:string,flags:int"
_NUMBER = f"struct<{_POINT},asDouble:double,asInt:string,{_EXEMPLARS}>"
_HISTOGRAM = f"struct<{_POINT},count:string,sum:double,min:double,max:double,bucketCounts:array<string>,explicitBounds:array<double>,{_EXEMPLARS}>"
_SIDE = "struct<offset:int,bucketCounts:array<string>>"
_EXPONENTIAL = f"struct<{_POINT},count:string,sum:double,min:double,max:double,scale:int,zeroCount:string,positive:{_SIDE},negative:{_SIDE},{_EXEMPLARS}>"
_SUMMARY = f"struct<{_POINT},count:string,sum:double,quantileValues:array<struct<quantile:double,value:double>>>"
_RECORD = f"struct<timeUnixNano:string,observedTimeUnixNano:string,severityNumber:int,severityText:string,body:variant,attributes:{_ATTRS},droppedAttributesCount:int,flags:int,traceId:string,spanId:string>"
_METRIC = (
    "struct<name:string,description:string,unit:string,"
    f"gauge:struct<dataPoints:array<{_NUMBER}>>,sum:struct<dataPoints:array<{_NUMBER}>,aggregationTemporality:string,isMonotonic:boolean>,"
    f"histogram:struct<dataPoints:array<{_HISTOGRAM}>,aggregationTemporality:string>,"
    f"exponentialHistogram:struct<dataPoints:array<{_EXPONENTIAL}>,aggregationTemporality:string>,summary:struct<dataPoints:array<{_SUMMARY}>>>"
)
_SPAN = (
    f"struct<traceId:string,spanId:string,traceState:string,parentSpanId:string,name:string,kind:string,startTimeUnixNano:string,endTimeUnixNano:string,attributes:{_ATTRS},droppedAttributesCount:int,"
    f"events:array<struct<timeUnixNano:string,name:string,attributes:{_ATTRS},droppedAttributesCount:int>>,links:array<struct<traceId:string,spanId:string,traceState:string,attributes:{_ATTRS},droppedAttributesCount:int>>,"
    "status:struct<code:string,message:string>>"
)

#: Schemas of the three kinds of documents.
SCHEMAS = {
    "logs": f"struct<resourceLogs:array<struct<{_RESOURCE},scopeLogs:array<struct<{_SCOPE},logRecords:array<{_RECORD}>>>>>>",
    "metrics": f"struct<resourceMetrics:array<struct<{_RESOURCE},scopeMetrics:array<struct<{_SCOPE},metrics:array<{_METRIC}>>>>>>",
    "traces": f"struct<resourceSpans:array<struct<{_RESOURCE},scopeSpans:array<struct<{_SCOPE},spans:array<{_SPAN}>>>>>>",
}

#: Names of enumerations, by number.
SPAN_KINDS = ("Unspecified", "Internal", "Server", "Client", "Producer", "Consumer")
STATUS_CODES = ("Unset", "Ok", "Error")
TEMPORALITIES = ("unspecified", "delta", "cumulative")
POINT_KINDS = ("gauge", "sum", "histogram", "exponentialHistogram", "summary")


def any_value(v: Column) -> Column:
    """A tagged value as text; lists and maps as JSON."""
    plain = [F.try_variant_get(v, f"$.{k}", "string") for k in ("stringValue", "intValue", "boolValue", "doubleValue", "bytesValue")]
    return F.coalesce(*plain, *[F.to_json(F.try_variant_get(v, f"$.{k}.values", "variant")) for k in ("arrayValue", "kvlistValue")])


def attribute_map(a: Column) -> Column:
    """Tagged attributes as a text map; of a repeated key the first entry counts."""
    kept = F.filter(F.coalesce(a, F.expr(f"cast(array() as {_ATTRS})")), lambda x: x["key"].isNotNull())
    keys = F.array_distinct(F.transform(kept, lambda x: x["key"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: any_value(F.get(F.filter(kept, lambda x: x["key"] == k), F.lit(0))["value"])))


def instant(nanos: Column) -> Column:
    """Nanoseconds since 1970 as a time; 0 and missing values are null, digits below a microsecond go."""
    n = nanos.try_cast("bigint")
    return F.when(n != 0, F.timestamp_micros(F.call_function("div", n - F.pmod(n, F.lit(1000)), F.lit(1000))))


def named(value: Column, names: tuple[str, ...], prefix: str) -> Column:
    """An enumeration given by number or by its long name, as its short name."""
    number = F.element_at(F.array(*[F.lit(n) for n in names]), F.when(value.rlike(r"^\d+$") & (value.try_cast("int") < len(names)), value.try_cast("int") + 1).otherwise(1))
    return F.when(value.startswith(prefix), F.initcap(F.substring(value, len(prefix) + 1, 100))).otherwise(number)


def _scopes(df: DataFrame, col: str, signal: str, outer: str, inner: str, items: str) -> DataFrame:
    """One row for each item below resource and scope; text that is no such document gives none."""
    r = df.select(F.explode(F.from_json(col, SCHEMAS[signal])[outer]).alias("r")).select(
        attribute_map(F.col("r.resource.attributes")).alias("resource"), F.col("r.schemaUrl").alias("resource_schema_url"), F.coalesce("r.resource.droppedAttributesCount", F.lit(0)).alias("resource_dropped"),
        F.col("r")[inner].alias("scopes"),
    )
    # the maps of a resource and of a scope are made once, before their items are dealt out
    s = r.select("resource", "resource_schema_url", "resource_dropped", F.explode("scopes").alias("s")).withColumns({
        "scope_name": F.col("s.scope.name"), "scope_version": F.col("s.scope.version"), "scope_schema_url": F.col("s.schemaUrl"), "scope_attributes": attribute_map(F.col("s.scope.attributes")),
        "scope_dropped": F.coalesce("s.scope.droppedAttributesCount", F.lit(0)), "items": F.col("s")[items],
    }).drop("s")
    return s.select(*[c for c in s.columns if c != "items"], F.explode("items").alias("i"))


def flatten_logs(df: DataFrame, col: str = "value") -> DataFrame:
    """Log documents as flat logs: resource, scope, times, severity, body as text, attributes, trace and span."""
    x = _scopes(df, col, "logs", "resourceLogs", "scopeLogs", "logRecords")
    return x.withColumns({
        "ts": instant(F.col("i.timeUnixNano")), "observed_ts": instant(F.col("i.observedTimeUnixNano")), "severity_number": F.coalesce("i.severityNumber", F.lit(0)), "severity_text": F.col("i.severityText"),
        "body_text": any_value(F.col("i.body")), "attributes": attribute_map(F.col("i.attributes")), "dropped": F.coalesce("i.droppedAttributesCount", F.lit(0)), "flags": F.coalesce("i.flags", F.lit(0)), "trace_id": F.col("i.traceId"), "span_id": F.col("i.spanId"),
    }).drop("i")


def _points(kind: str) -> Column:
    """The points of a metric `i` of one kind, all kinds with the same fields; none where it is of another."""
    number, of = kind in ("gauge", "sum"), F.col("i")[kind]
    temporality = F.lit(None).cast("string") if kind in ("gauge", "summary") else F.lower(named(of["aggregationTemporality"], TEMPORALITIES, "AGGREGATION_TEMPORALITY_"))
    monotonic = F.coalesce(of["isMonotonic"], F.lit(False)) if kind == "sum" else F.lit(None).cast("boolean")

    def one(p: Column) -> Column:
        value = F.coalesce(p["asDouble"], p["asInt"].try_cast("double")) if number else F.lit(None).cast("double")
        typed = F.when(p["asInt"].isNotNull(), "int").when(p["asDouble"].isNotNull(), "double") if number else F.lit(None).cast("string")
        cols = {
            "metric_type": F.lit(kind), "temporality": temporality, "monotonic": monotonic, "attributes": attribute_map(p["attributes"]), "start_ts": instant(p["startTimeUnixNano"]), "ts": instant(p["timeUnixNano"]),
            "flags": F.coalesce(p["flags"], F.lit(0)), "value": value, "value_type": typed, "point": F.to_json(p),
        }
        return F.named_struct(*[x for k, c in cols.items() for x in (F.lit(k), c)])

    return F.coalesce(F.transform(of["dataPoints"], one), F.array())


def flatten_datapoints(df: DataFrame, col: str = "value") -> DataFrame:
    """Metric documents as flat datapoints of five kinds: value of gauges and sums, `point` the parts of the others."""
    x = _scopes(df, col, "metrics", "resourceMetrics", "scopeMetrics", "metrics")
    head = [c for c in x.columns if c != "i"]
    rows = F.concat(*[_points(kind) for kind in POINT_KINDS])
    rows = x.select(*head, F.col("i.name").alias("metric_name"), F.col("i.description").alias("description"), F.col("i.unit").alias("unit"), F.explode(rows).alias("d"))
    return rows.select(*head, "metric_name", "description", "unit", "d.*")


def flatten_spans(df: DataFrame, col: str = "value") -> DataFrame:
    """Trace documents as flat spans, with the milliseconds from start to end and the names of kind and status."""
    x = _scopes(df, col, "traces", "resourceSpans", "scopeSpans", "spans")
    x = x.withColumns({
        "trace_id": F.col("i.traceId"), "span_id": F.col("i.spanId"), "trace_state": F.col("i.traceState"), "parent_span_id": F.col("i.parentSpanId"), "name": F.col("i.name"),
        "kind": named(F.coalesce("i.kind", F.lit("0")), SPAN_KINDS, "SPAN_KIND_"), "start_ts": instant(F.col("i.startTimeUnixNano")), "end_ts": instant(F.col("i.endTimeUnixNano")),
        "attributes": attribute_map(F.col("i.attributes")), "dropped": F.coalesce("i.droppedAttributesCount", F.lit(0)), "status_code": named(F.coalesce("i.status.code", F.lit("0")), STATUS_CODES, "STATUS_CODE_"), "status_message": F.col("i.status.message"),
        "events": F.transform("i.events", lambda e: F.struct(instant(e["timeUnixNano"]).alias("ts"), e["name"].alias("name"), F.coalesce(e["droppedAttributesCount"], F.lit(0)).alias("dropped"), attribute_map(e["attributes"]).alias("attributes"))),
        "links": F.transform("i.links", lambda e: F.struct(e["traceId"].alias("trace_id"), e["spanId"].alias("span_id"), e["traceState"].alias("trace_state"), F.coalesce(e["droppedAttributesCount"], F.lit(0)).alias("dropped"), attribute_map(e["attributes"]).alias("attributes"))),
    }).drop("i")
    return x.withColumn("span_duration_ms", F.unix_millis("end_ts") - F.unix_millis("start_ts"))


FLATTEN = {"logs": flatten_logs, "metrics": flatten_datapoints, "traces": flatten_spans}


def read_otlp(spark: SparkSession, path: str, signal: str, start: datetime | None = None, end: datetime | None = None, level: str = "hour") -> DataFrame:
    """Landed documents of one signal as flat rows: files `<signal>_*.json[.gz]`, or those below a folder of the signal's name, in
    year=/month=/day=/hour= folders whose time is from start to end, both inclusive; folders outside are not read."""
    names = PARTS[: PARTS.index(level) + 1]
    files = spark.read.schema(f"value string, {', '.join(f'{n} string' for n in names)}").option("basePath", path).option("wholetext", True).option("recursiveFileLookup", False).text(path)
    at = F.concat_ws("-", *[F.lpad(F.col(n), 4 if n == "year" else 2, "0") for n in names])
    form = "-".join(f"%{x}" for x in "YmdHM"[: len(names)])
    files = files.where(at >= start.strftime(form)) if start else files
    files = files.where(at <= end.strftime(form)) if end else files
    named_so = F.col("_metadata.file_name").startswith(f"{signal}_") | F.col("_metadata.file_path").contains(f"/{signal}/")
    return FLATTEN[signal](files.where(named_so & F.col("_metadata.file_name").rlike(r"\.(json|gz)$")))
