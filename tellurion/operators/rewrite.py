"""Row rewriting: masks, empty values, metrics from logs, delivery bodies (R1-R7), and record shape."""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellurion.functions.expressions import attributes, column, holds, java_pattern

#: The default mask rules. They apply in the order of their names.
MASK_RULES = {
    "credit_card": r"\b(?:(?:(?:\d{4}[- ]?){3}\d{4}|\d{15,16}))\b",
    "email": r"\b[a-z0-9._%\+\-—|]+@[a-z0-9.\-—|]+\.[a-z|]{2,6}\b",
    "ipv4": r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b",
    "phone": r"\b((\+|\b)[1l][\-\. ])?\(?\b[\dOlZSB]{3,5}([\-\. ]|\) ?)[\dOlZSB]{3}[\-\. ][\dOlZSB]{4}\b",
    "ssn": r"\b\d{3}[- ]\d{2}[- ]\d{4}\b",
}


#: What any match of a default rule holds, quick to find. No replacement holds such text or makes it, so it is looked for once.
_SIGNS = {"credit_card": "[0-9]{4}", "email": "@", "ipv4": r"[0-9]\.[0-9]", "phone": r"[0-9OlZSB]{3}[-. ][0-9OlZSB]{4}", "ssn": "[0-9]{3}[- ][0-9]{2}[- ]"}


def _may_match(text: Column, name: str, pattern: str) -> Column:
    """False only where the rule surely has no match."""
    if MASK_RULES.get(name) != pattern:
        return F.lit(True)
    return text.contains("@") if name == "email" else text.rlike(_SIGNS[name])


def masked(text: Column, rules: Mapping[str, str] | None = None) -> Column:
    """Every match of each rule, in the order of the rules' names, as [masked_<rule>]."""
    rules, done = sorted((rules if rules is not None else MASK_RULES).items()), text
    for name, pattern in rules:
        done = F.regexp_replace(done, java_pattern(pattern), f"[masked_{name}]")
    some = [_may_match(text, name, pattern) for name, pattern in rules]
    return F.when(functools.reduce(Column.__or__, some), done).otherwise(text) if some else text


def mask(df: DataFrame, columns: Sequence[str], rules: Mapping[str, str] | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """Mask texts in columns of any shape: texts, values of maps, fields of structs, at any depth, and the texts of arrays of texts.

    What `exclude` names by a dotted path (`column`, `column.key`, `column.key.inner`) is left alone; a key that holds dots is meant
    by the same path. Other arrays, and values that are no text, stay. One native expression for each column.
    """
    paths = [e for e in exclude]
    return df.withColumns({c: _masked_any(F.col(c), df.schema[c].dataType, c, paths, rules) for c in columns if c not in paths})


def _masked_any(x: Column, kind: T.DataType, path: str, exclude: Sequence[str], rules: Mapping[str, str] | None) -> Column:
    """A value masked by its type. Map keys are only known by row, so paths below a map are told apart by what excludes name."""
    if isinstance(kind, T.StringType):
        return masked(x, rules)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        return F.transform(x, lambda v: masked(v, rules))
    if isinstance(kind, T.StructType):
        parts = [(x[f.name] if f"{path}.{f.name}" in exclude else _masked_any(x[f.name], f.dataType, f"{path}.{f.name}", exclude, rules)).alias(f.name) for f in kind.fields]
        return F.when(x.isNotNull(), F.struct(*parts))
    if isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
        return F.transform_values(x, lambda k, v: _masked_entry(k, v, kind.valueType, path, exclude, rules))
    return x


def _masked_entry(key: Column, value: Column, kind: T.DataType, path: str, exclude: Sequence[str], rules: Mapping[str, str] | None) -> Column:
    out = _masked_any(value, kind, f"{path}.\0", [], rules)  # an entry below which nothing is excluded
    below = [e[len(path) + 1 :] for e in exclude if e.startswith(f"{path}.")]
    if isinstance(kind, (T.MapType, T.StructType)):
        for name in dict.fromkeys(e.split(".")[0] for e in below if "." in e):
            out = F.when(key == name, _masked_any(value, kind, f"{path}.{name}", exclude, rules)).otherwise(out)
    return F.when(key.isin(below), value).otherwise(out) if below else out


def mask_report(df: DataFrame, text: str, rules: Mapping[str, str] | None = None) -> DataFrame:
    """Rows that hold a match, and matches, of each rule alone."""
    rules = dict(sorted((rules if rules is not None else MASK_RULES).items()))
    count = lambda n, p: F.when(_may_match(F.col(text), n, p), F.regexp_count(text, F.lit(java_pattern(p)))).otherwise(F.lit(0))
    hits = df.select(*[count(n, p).alias(n) for n, p in rules.items()])
    one = hits.agg(*[x for n in rules for x in (F.count_if(F.col(n) > 0).alias(f"{n}_rows"), F.coalesce(F.sum(n), F.lit(0)).alias(f"{n}_hits"))])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"{n}_rows").alias("n_rows"), F.col(f"{n}_hits").cast("long").alias("n_hits")) for n in rules])).alias("r")).select("r.*")


def remove_empty(df: DataFrame, columns: Sequence[str], nulls: bool = True, maps: bool = False, strings: Sequence[str] = (), exclude: Sequence[str] = (), lists: bool = False) -> DataFrame:
    """Leave out what is null or one of the empty strings (any case) from columns of any shape, inner parts first: entries of maps,
    elements of arrays; fields of structs become null. With maps=True a map or struct without any such part left is empty
    too, with lists=True an array. A column that is empty itself becomes null. Dotted paths in `exclude` are left alone with all below."""
    low = [s.lower() for s in strings]
    out = {}
    for c in columns:
        if c in exclude:
            continue
        if dict(df.dtypes)[c] == "map<string,string>":
            m = _full_entries(c, [e[len(c) + 1 :] for e in exclude if e.startswith(f"{c}.")], nulls, low)
            out[c] = F.when(F.size(m) > 0, m) if maps else m
        else:
            walk = _Cleaner(nulls, maps, lists, low, exclude).walk(F.col(c), df.schema[c].dataType, c)
            out[c] = F.get(F.transform(F.array(walk), lambda w: F.when(~w["gone"], w["v"])), F.lit(0))
    return df.withColumns(out)


class _Cleaner:
    """Values by their type without their empty parts, as (v, gone): one native expression, in which each part is looked at once."""

    def __init__(self, nulls: bool, maps: bool, lists: bool, strings: Sequence[str], exclude: Sequence[str]):
        self.nulls, self.maps, self.lists, self.strings, self.exclude = F.lit(nulls), maps, lists, list(strings), list(exclude)

    def walk(self, x: Column, kind: T.DataType, path: str) -> Column:
        missing = self.nulls & x.isNull()
        if isinstance(kind, T.StringType):
            missing = missing | F.coalesce(F.lower(x).isin(self.strings), F.lit(False)) if self.strings else missing
        elif isinstance(kind, T.ArrayType):
            inner = F.transform(x, lambda e: self.walk(e, kind.elementType, path))
            return _let(F.filter(inner, lambda w: ~w["gone"]), lambda kept: _found(F.transform(kept, lambda w: w["v"]), missing | (F.lit(self.lists) & F.coalesce(F.size(kept) == 0, F.lit(False)))))
        elif isinstance(kind, T.StructType):
            return self._struct(x, kind, path, missing)
        elif isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
            entry = lambda e: _let(self._entry(e["key"], e["value"], kind.valueType, path), lambda w: F.struct(e["key"].alias("key"), w["v"].alias("value"), w["gone"].alias("gone")))
            kept = F.filter(F.transform(F.map_entries(x), entry), lambda e: ~e["gone"])
            pairs = lambda k: F.map_from_entries(F.transform(k, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))))
            return _let(kept, lambda k: _found(pairs(k), missing | (F.lit(self.maps) & F.coalesce(F.size(k) == 0, F.lit(False)))))
        return _found(x, missing)

    def _struct(self, x: Column, kind: T.StructType, path: str, missing: Column) -> Column:
        walked = F.struct(*[(_found(x[f.name], F.lit(False)) if f"{path}.{f.name}" in self.exclude else self.walk(x[f.name], f.dataType, f"{path}.{f.name}")).alias(f.name) for f in kind.fields])

        def whole(w: Column) -> Column:
            v = F.struct(*[F.when(~w[f.name]["gone"], w[f.name]["v"]).alias(f.name) for f in kind.fields])
            none_left = functools.reduce(Column.__and__, [w[f.name]["gone"] for f in kind.fields], F.lit(True))
            return _found(F.when(x.isNotNull(), v), missing | (F.lit(self.maps) & x.isNotNull() & none_left))

        return _let(walked, whole)

    def _entry(self, key: Column, value: Column, kind: T.DataType, path: str) -> Column:
        out = _Cleaner.walk(self._free(), value, kind, "")
        below = [e[len(path) + 1 :] for e in self.exclude if e.startswith(f"{path}.")]
        if not isinstance(kind, T.StringType):
            for name in dict.fromkeys(e.split(".")[0] for e in below if "." in e):
                out = F.when(key == name, self.walk(value, kind, f"{path}.{name}")).otherwise(out)
        return F.when(key.isin(below), _found(value, F.lit(False))).otherwise(out) if below else out

    def _free(self) -> _Cleaner:
        """The same without anything excluded, for keys that no exclude names."""
        other = _Cleaner(True, self.maps, self.lists, self.strings, [])
        other.nulls = self.nulls
        return other


def _found(v: Column, gone: Column) -> Column:
    return F.struct(v.alias("v"), gone.alias("gone"))


def _let(value: Column, then) -> Column:
    """`then` of a value that is computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _full_entries(c: str, keys: Sequence[str], nulls: bool, low: Sequence[str]) -> Column:
    def kept(k: Column, v: Column) -> Column:
        empty = (v.isNull() if nulls else F.lit(False)) | (F.coalesce(F.lower(v).isin(list(low)), F.lit(False)) if low else F.lit(False))
        return (k.isin(list(keys)) | ~empty) if keys else ~empty

    return F.map_filter(c, kept)


def _clean(x, nulls: bool, lists: bool, maps: bool, strings: set[str], exclude: set[str], path: str = ""):
    """x without its empty parts, children first; (value, empty)."""
    if path and path in exclude:
        return x, False
    if isinstance(x, dict):
        got = {k: _clean(v, nulls, lists, maps, strings, exclude, f"{path}.{k}" if path else k) for k, v in x.items()}
        x = {k: v for k, (v, empty) in got.items() if not empty}
        return x, maps and not x
    if isinstance(x, list):
        x = [v for v, empty in (_clean(v, nulls, lists, maps, strings, exclude, path) for v in x) if not empty]
        return x, lists and not x
    return x, (nulls and x is None) or (isinstance(x, str) and x.lower() in strings)


def remove_empty_json(df: DataFrame, col: str, nulls: bool = True, lists: bool = False, maps: bool = False, strings: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """The same on JSON text of any depth; text that is no JSON stays; a body that becomes empty is null."""
    low, out = {s.lower() for s in strings}, set(exclude)

    @F.pandas_udf("string")
    def clean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield s.map(one)

    def one(text: str | None) -> str | None:
        try:
            value, empty = _clean(json.loads(text), nulls, lists, maps, low, out)
        except (TypeError, ValueError):
            return text
        return None if empty else json.dumps(value, ensure_ascii=False, separators=(",", ":"))

    return df.withColumn(col, clean(col))


def extract_metric(df: DataFrame, value: str | Column, match: str | Column = "true", attrs: Mapping[str, str | Column] | None = None, name: str = "log.metric", unit: str = "", kind: str = "gauge_double", ts: Sequence[str] = ("ts",)) -> DataFrame:
    """A point for each matching log whose value is a number, or text of one; *_int kinds truncate; others give no row.

    The time is the first of `ts` that isn't null, else the query's time."""
    form, _, number = kind.partition("_")
    v = F.expr(f"try_cast(({value}) as double)") if isinstance(value, str) else value.try_cast("double")
    v = F.when(v < 0, F.ceil(v)).otherwise(F.floor(v)).cast("double") if number == "int" else v
    rows = df.where(holds(match)).select(F.coalesce(*[F.col(t) for t in ts], F.current_timestamp()).alias("ts"), F.lit(name).alias("metric_name"), F.lit(unit).alias("unit"), F.lit("sum" if form == "counter" else "gauge").alias("metric_type"), F.lit(number or "double").alias("value_type"), attributes(attrs or {}).alias("attributes"), v.alias("value"))
    return rows.where(F.col("value").isNotNull() & ~F.isnan("value"))


def raw_log(df: DataFrame, field: str | None = None, body: str = "body", attrs: str = "attributes", resource: str = "resource") -> DataFrame:
    """Add raw: a field as text, or JSON of body, attributes and resource attributes."""
    whole = F.to_json(F.struct(F.col(body).alias("body"), F.col(attrs).alias("attributes"), F.col(resource).alias("resource_attributes")))
    return df.withColumn("raw", column(field).cast("string") if field else whole)


def ingestion_labels(df: DataFrame, labels: Mapping[str, str], prefix: str, attrs: str = "attributes") -> DataFrame:
    """Add labels: those given, and over them attributes whose name has the prefix, without it and without brackets and quotes about
    the rest. An attribute that is a JSON object of texts (nulls are empty) gives its entries instead. Of equal names the last counts."""
    own = F.map_entries(F.map_filter(attrs, lambda k, _: k.startswith(prefix)))
    name = lambda k: F.regexp_replace(F.substring(k, len(prefix) + 1, F.length(k)), r'^[\[\]"]+|[\[\]"]+$', "")
    entry = lambda k, v: F.struct(k.alias("key"), v.alias("value"))

    def spread(e: Column) -> Column:
        inner = F.try_variant_get(F.try_parse_json(e["value"]), "$", "map<string,variant>")
        texts = F.forall(F.map_values(inner), lambda v: F.schema_of_variant(v).isin("STRING", "VOID"))
        spread_out = F.transform(F.map_entries(inner), lambda x: entry(x["key"], F.coalesce(F.try_variant_get(x["value"], "$", "string"), F.lit(""))))
        nothing = F.trim(e["value"]) == "null"
        return F.when(nothing, F.slice(F.array(entry(F.lit(""), F.lit(""))), 1, 0)).when(texts, spread_out).otherwise(F.array(entry(name(e["key"]), e["value"])))

    fixed = F.array(*[entry(F.lit(k), F.lit(v)) for k, v in labels.items()]) if labels else F.expr("cast(array() as array<struct<key:string,value:string>>)")
    every = F.concat(fixed, F.flatten(F.transform(F.coalesce(own, F.expr("cast(array() as array<struct<key:string,value:string>>)")), spread)))
    names = F.transform(F.reverse(every), lambda e: e["key"])
    last = F.filter(F.reverse(every), lambda e, i: F.array_position(names, e["key"]) == i + 1)
    return df.withColumn("labels", F.map_from_entries(F.reverse(last)))


#: Ids that stand for none.
NO_IDS = ("", "0" * 32, "0" * 16)


def _id(c: str) -> Column:
    return F.when(~F.col(c).isin(*NO_IDS), F.col(c))


def sentinel_rows(df: DataFrame, raw_field: str | None = None, body: str = "body", ts: str = "ts") -> DataFrame:
    """TimeGenerated (RFC 3339), RawData with escaped line breaks, and where known severity and ids; ids of zeros are none.

    A body that is a map of texts, or a struct, is no RawData: its fields are in `Fields` as JSON, without those that have the names of
    the other columns. `sentinel_entries` gives the rows as JSON.
    """
    time = F.date_format(F.col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    rest = [(_id(c) if c.endswith("_id") else F.col(c)).alias(n) for c, n in (("severity_text", "SeverityText"), ("severity_number", "SeverityNumber"), ("trace_id", "TraceId"), ("span_id", "SpanId")) if c in df.columns]
    kind = df.schema[body].dataType if raw_field is None and body in df.columns else T.StringType()
    if isinstance(kind, T.MapType):
        what = F.to_json(F.map_filter(body, lambda k, _: ~k.isin(*_RESERVED))).alias("Fields")
    elif isinstance(kind, T.StructType):
        kept = [F.col(f"{body}.{f.name}").alias(f.name) for f in kind.fields if f.name not in _RESERVED]
        what = F.to_json(F.struct(*kept)).alias("Fields")
    else:
        what = F.replace(F.replace(column(raw_field or body).cast("string"), F.lit("\r"), F.lit("\\r")), F.lit("\n"), F.lit("\\n")).alias("RawData")
    return df.select(time.alias("TimeGenerated"), what, *rest)


#: Names that a delivery sets itself.
_RESERVED = ("TimeGenerated", "SeverityText", "SeverityNumber", "TraceId", "SpanId")


def sentinel_entries(df: DataFrame, body: str = "body", ts: str = "ts", observed: str = "observed_ts") -> DataFrame:
    """`entry`: each record as the JSON object of a delivery. The fields of a map or struct body, or RawData; over them the time to the
    second (else when it was observed, else the query's), severity, and ids but those of zeros."""
    kind = df.schema[body].dataType
    known = lambda c, d: F.col(c) if c in df.columns else d
    none = F.lit(None).cast("string")
    at = F.coalesce(F.col(ts), known(observed, F.lit(None).cast("timestamp")), F.current_timestamp())
    own = F.struct(
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("TimeGenerated"), F.coalesce(known("severity_text", none), F.lit("")).alias("SeverityText"), F.coalesce(known("severity_number", F.lit(0)), F.lit(0)).cast("int").alias("SeverityNumber"),
        (_id("trace_id") if "trace_id" in df.columns else none).alias("TraceId"), (_id("span_id") if "span_id" in df.columns else none).alias("SpanId"),
    )
    if isinstance(kind, T.MapType):
        fields = F.to_json(F.map_filter(body, lambda k, _: ~k.isin(*_RESERVED)))
    elif isinstance(kind, T.StructType):
        fields = F.to_json(F.struct(*[F.col(f"{body}.{f.name}").alias(f.name) for f in kind.fields if f.name not in _RESERVED]))
    else:
        fields = F.to_json(F.struct(F.coalesce(F.col(body).cast("string"), F.lit("")).alias("RawData")))
    inner = F.substring(F.coalesce(fields, F.lit("{}")), 2, F.length(F.coalesce(fields, F.lit("{}"))) - 2)
    head = F.to_json(own)
    return df.select(F.when(inner == "", head).otherwise(F.concat(F.substring(head, 1, F.length(head) - 1), F.lit(","), inner, F.lit("}"))).alias("entry"))


def webhook_rows(df: DataFrame, body: str = "body_text", rows: int = 0) -> DataFrame:
    """payload: the body if it is JSON, else the body as a JSON string. With `rows`, JSON arrays of at most so many bodies each: each
    task numbers what it holds, so no row moves."""
    text = F.to_json(F.array(body))
    one = df.select(F.when(F.try_parse_json(body).isNotNull(), F.col(body)).otherwise(F.substring(text, F.lit(2), F.length(text) - 2)).alias("payload"))
    if not rows:
        return one

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        for batch in batches:
            for x in batch.column(0).to_pylist():
                held.append("null" if x is None else x)
                if len(held) == rows:
                    yield pa.record_batch([pa.array([f"[{','.join(held)}]"])], ["payload"])
                    held = []
        if held:
            yield pa.record_batch([pa.array([f"[{','.join(held)}]"])], ["payload"])

    return one.mapInArrow(arrays, "payload string")


# ---------------------------------------------------------------- shape


def transpose_resource(df: DataFrame, ops: Sequence[tuple[str, str]], resource: str = "resource", attrs: str = "attributes") -> DataFrame:
    """Copy resource attributes to the record where the source exists and the target doesn't."""
    m = F.col(attrs)
    for source, target in ops:
        v = F.element_at(resource, F.lit(source))
        free = ~F.array_contains(F.map_keys(m), target)
        m = F.when(v.isNotNull() & free, F.map_concat(m, F.create_map(F.lit(target), v))).otherwise(m)
    return df.withColumn(attrs, m)


def default_host(df: DataFrame, name: str, resource: str = "resource") -> DataFrame:
    """Add host.name unless a host name, host id or pod name is there."""
    known = F.arrays_overlap(F.map_keys(resource), F.array(*[F.lit(x) for x in ("host.name", "host.id", "k8s.pod.name")]))
    return df.withColumn(resource, F.when(known, F.col(resource)).otherwise(F.map_concat(resource, F.create_map(F.lit("host.name"), F.lit(name)))))


def event_time(df: DataFrame, ts: str = "ts", observed: str = "observed_ts", into: str = "event_ts") -> DataFrame:
    """The time of a record, else when it was observed, else the query's time."""
    return df.withColumn(into, F.coalesce(ts, observed, F.current_timestamp()))


def rebase_times(df: DataFrame, ts: str, target, more: Sequence[str] = ()) -> DataFrame:
    """Shift times so that the newest is at the target, differences kept. The newest is found by a partial maximum, then one row."""
    newest = df.agg(F.max(ts).alias("_newest"))
    shift = F.lit(target).cast("timestamp") - F.col("_newest")
    return df.crossJoin(F.broadcast(newest)).withColumns({c: F.col(c) + shift for c in (ts, *more)}).drop("_newest")


def nest(paths: Mapping[str, str | Column]) -> Column:
    """A struct from dotted paths; a later path replaces a plain value in its way."""
    tree: dict = {}
    for path, x in paths.items():
        at = tree
        *front, last = path.split(".")
        for p in front:
            at = at.setdefault(p, {}) if isinstance(at.get(p, {}), dict) else at.__setitem__(p, {}) or at[p]
        at[last] = column(x)
    build = lambda t: F.struct(*[(build(v) if isinstance(v, dict) else v).alias(k) for k, v in t.items()])
    return build(tree)


def flatten_json(df: DataFrame, col: str, into: str = "fields", mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Top-level values of a JSON object as texts, nested ones as JSON, nulls as ''; a mapping (name -> dotted path) picks values."""
    if mapping:
        picked = {k: F.coalesce(F.get_json_object(col, f"$.{p}"), F.lit("")) for k, p in mapping.items()}
        return df.withColumn(into, attributes(picked))
    m = F.from_json(col, "map<string,string>")
    return df.withColumn(into, F.transform_values(m, lambda _, v: F.coalesce(v, F.lit(""))))


def renest(df: DataFrame, keys: Sequence[str], into: str = "records", rows: int = 100_000, order: Sequence[str] = ()) -> DataFrame:
    """Rows of each resource as arrays of structs, at most `rows` in one, so that no array holds a whole large resource.

    Resources are counted first; one of more rows is dealt to buckets by a hash of the order columns. `part` is text that names the
    array within its resource: bucket and number.
    """
    rest = [c for c in df.columns if c not in keys]
    by = list(order or rest)
    many = df.groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).agg(F.ceil(F.count("*") / rows).alias("_buckets")).where("_buckets > 1")
    sized = df.join(many, [F.col(f"_key{i}").eqNullSafe(F.col(k)) for i, k in enumerate(keys)], "left")
    dealt = sized.withColumn("_bucket", F.pmod(F.xxhash64(*by), F.coalesce("_buckets", F.lit(1))))
    n = F.floor((F.row_number().over(W.partitionBy(*keys, "_bucket").orderBy(*by)) - 1) / rows)
    return dealt.withColumn("part", F.concat_ws("-", "_bucket", n)).groupBy(*keys, "part").agg(F.array_sort(F.collect_list(F.struct(*rest))).alias(into))
