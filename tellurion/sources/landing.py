"""Landing zones and landed payloads (S1-S18), and the writers that feed them (K1, K6, K8)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PARTS = ("year", "month", "day", "hour", "minute")
#: How times are written as JSON: with microseconds, which Spark's own layout cuts to milliseconds.
TIME_LAYOUT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def time_prefixes(start: datetime, end: datetime, pattern: str = "year={year}/month={month}/day={day}/hour={hour}", root: str = "") -> list[str]:
    """Folders that can hold times from start to end, both inclusive: one for each hour, or day if the pattern has no hour."""
    step, out = timedelta(hours=1) if "{hour}" in pattern else timedelta(days=1), []
    at = start.replace(minute=0, second=0, microsecond=0)
    at = at if "{hour}" in pattern else at.replace(hour=0)
    while at <= end:
        out.append(root + pattern.format(year=f"{at:%Y}", month=f"{at:%m}", day=f"{at:%d}", hour=f"{at:%H}", minute="*", second="*"))
        at += step
    return list(dict.fromkeys(out))


def with_path_time(df: DataFrame, pattern: str, anchored: bool = True, path: Column | None = None, into: str = "path_ts") -> DataFrame:
    """The time that a file's path names by {year}{month}{day}{hour}{minute}{second}; month and day default to 1, the rest to 0.
    Paths that don't match, or name no real time, give null."""
    names = re.findall(r"\{(\w+)\}", pattern)
    if "year" not in names:
        raise ValueError("the pattern names no year")
    rx = re.sub(r"\\\{(\w+)\\\}", lambda m: r"(\d{4})" if m[1] == "year" else r"(\d{1,2})", re.escape(pattern))
    rx = rx if not anchored else f"^{rx}"
    p = path if path is not None else F.col("_metadata.file_path")
    part = {n: F.regexp_extract(p, rx, i + 1).try_cast("int") for i, n in enumerate(names)}
    get = lambda n, d: part.get(n, F.lit(d))
    made = F.try_make_timestamp(get("year", 1), get("month", 1), get("day", 1), get("hour", 0), get("minute", 0), get("second", 0).cast("double"))
    return df.withColumn(into, F.when(p.rlike(rx), made))


_NEXT = dict(zip(PARTS, (*PARTS[1:], ""), strict=True))
_LETTERS = dict(zip(PARTS, "YmdHM", strict=True))


def _turn(at: datetime, part: str) -> datetime:
    """The beginning of the year, month, day, hour or minute after this one's."""
    first = {"year": {"month": 1, "day": 1, "hour": 0, "minute": 0}, "month": {"day": 1, "hour": 0, "minute": 0}, "day": {"hour": 0, "minute": 0}, "hour": {"minute": 0}, "minute": {}}[part]
    at = at.replace(second=0, microsecond=0, **first)
    if part == "year":
        return at.replace(year=at.year + 1)
    if part == "month":
        return at.replace(year=at.year + at.month // 12, month=at.month % 12 + 1)
    return at + {"day": timedelta(days=1), "hour": timedelta(hours=1), "minute": timedelta(minutes=1)}[part]


def range_folders(start: datetime, end: datetime, level: str = "hour") -> list[str]:
    """The fewest folders year=/month=/day=/hour=[/minute=] that hold all times from start to end, both inclusive, and no others: a whole
    year, month, day or hour stands for all below it."""
    names, out = PARTS[: PARTS.index(level) + 1], []
    at = datetime(start.year, *(getattr(start, p) if p in names else {"month": 1, "day": 1}.get(p, 0) for p in PARTS[1:]))
    while at <= end:
        for i, part in enumerate(names):
            whole = all(getattr(at, p) == (1 if p in ("month", "day") else 0) for p in names[i + 1 :])
            if part == level or (whole and _turn(at, part) - timedelta(microseconds=1) <= _last(end, level)):
                out.append("/".join(f"{p}={at:%{_LETTERS[p]}}" for p in names[: i + 1]))
                at = _turn(at, part)
                break
    return out


def _last(end: datetime, level: str) -> datetime:
    """The last moment of the folder that the end stands in."""
    return _turn(end, level) - timedelta(microseconds=1)


def _within(path: str, start: datetime | None, end: datetime | None, level: str) -> str:
    """The path, or one with alternatives for just the folders of a closed range, so that no others are listed."""
    return f"{path.rstrip('/')}/{{{','.join(range_folders(start, end, level))}}}" if start and end and start <= end else path


def read_partitioned(spark: SparkSession, path: str, start: datetime | None = None, end: datetime | None = None, schema: str | None = None, level: str = "hour") -> DataFrame:
    """NDJSON below year=/month=/day=/hour=[/minute=], the path's time from start to end, both inclusive.

    Of a closed range only the folders within it are listed, however many stand beside them; with one end open all are, and those
    outside pruned. A range without folders gives no rows if a schema is given, else it is an error.
    """
    names = PARTS[: PARTS.index(level) + 1]
    whole = f"{schema}, {', '.join(f'{n} string' for n in names)}" if schema else None
    reader = spark.read.option("basePath", path)
    if whole and start and end and start > end:
        return spark.createDataFrame([], whole)
    try:
        df = (reader.schema(whole) if whole else reader).json(_within(path, start, end, level))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND" or not (whole and start and end):
            raise
        return spark.createDataFrame([], whole)
    at = F.concat_ws("-", *[F.lpad(F.col(n).cast("string"), 4 if n == "year" else 2, "0") for n in names])
    form = "-".join(f"%{x}" for x in "YmdHM"[: len(names)])
    if start:
        df = df.where(at >= start.strftime(form))
    if end:
        df = df.where(at <= end.strftime(form))
    return df


def write_partitioned(df: DataFrame, path: str, ts: str = "ts", level: str = "hour", gzip: bool = True, mode: str = "append", codec: str | None = None) -> None:
    """NDJSON, with gzip or another of Spark's codecs (bzip2, deflate, lz4, snappy, zstd), below year=/month=/day=/hour=[/minute=] of the UTC time, zero-padded, so that read_partitioned finds it again."""
    names = PARTS[: PARTS.index(level) + 1]
    forms = dict(zip(PARTS, ("yyyy", "MM", "dd", "HH", "mm"), strict=True))
    w = df.withColumns({n: F.date_format(ts, forms[n]) for n in names}).write.mode(mode).options(**TIME_LAYOUT).partitionBy(*names)
    codec = codec or ("gzip" if gzip else "none")
    w.option("compression", codec).json(path)


def stream_landing(spark: SparkSession, path: str, schema: str, max_files: int | None = None, start: datetime | None = None, end: datetime | None = None, level: str = "hour") -> DataFrame:
    """A stream of the NDJSON files below a folder; the checkpoint of the query remembers those already read. Of a closed range only
    its folders year=/month=/day=/hour=[/minute=] are listed at each turn."""
    r = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    return (r.option("maxFilesPerTrigger", max_files) if max_files else r).json(_within(path, start, end, level))


def ndjson_logs(lines: DataFrame, col: str = "value") -> DataFrame:
    """A row for each line that is a JSON object, as body; blank, malformed and other lines are left out."""
    body = F.try_parse_json(F.col(col))
    return lines.select(F.trim(col).alias("body_text"), body.alias("body")).where(F.col("body").isNotNull() & F.col("body_text").startswith("{"))


def bad_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """How many lines are blank, malformed, or no object."""
    t, v = F.trim(col), F.try_parse_json(F.col(col))
    return lines.agg(F.count_if(t == "").alias("blank"), F.count_if((t != "") & v.isNull()).alias("malformed"), F.count_if(v.isNotNull() & ~t.startswith("{")).alias("no_object"))


def quarantined(lines: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(rows, quarantined): lines that are JSON objects, and all others with why in `reason`: `missing` (null), `blank`, `malformed`
    or `no_object`. Every row is in one of the two."""
    t, v = F.trim(col), F.try_parse_json(F.col(col))
    reason = F.when(F.col(col).isNull(), "missing").when(t == "", "blank").when(v.isNull(), "malformed").when(~t.startswith("{"), "no_object")
    marked = lines.withColumn("reason", reason)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")


def records_json(objects: DataFrame, col: str, field: str = "records") -> DataFrame:
    """A row for each element of {"records": [...]}; malformed objects and empty lists give none."""
    items = F.from_json(F.get_json_object(col, f"$.{field}"), "array<string>")
    return objects.select(F.explode(items).alias("record"))


def sniffed(objects: DataFrame, col: str, field: str = "Records", within: int = 4096) -> DataFrame:
    """Elements of a JSON array; of an object's array under `field`, if that name (as a name, not a value) begins within so many
    characters; else its lines."""
    t = F.trim(col)
    at = F.regexp_instr(t, F.lit(rf'[{{,]\s*"{re.escape(field)}"\s*:'))
    listed = F.when(t.startswith("["), F.from_json(t, "array<string>")).when(t.startswith("{") & (at > 0) & (at <= within), F.from_json(F.get_json_object(t, f"$.{field}"), "array<string>"))
    lines = F.filter(F.split(col, r"\r?\n"), lambda x: F.trim(x) != "")
    return objects.select(F.explode(F.coalesce(listed, lines)).alias("record"))


def cut_lines(lines: DataFrame, col: str, size: int) -> DataFrame:
    """Lines of more than `size` characters as several rows in order; empty lines are left out."""
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.length(col) - 1) / size).cast("int")), lambda i: F.substring(F.col(col), i * size + 1, F.lit(size)))
    return lines.where(F.length(col) > 0).select(F.posexplode(cut).alias("part", "line"))


def object_manifest(events: DataFrame, col: str, bucket: str | None = None, key: str | None = None) -> DataFrame:
    """bucket, key, size and event_ts of each object that a notification names; keys are URL-decoded, a plus stays a plus.

    Three forms: `Records` of created objects, the same within the `Message` of a topic, and a file drop, which names one bucket and
    `files`, each with a path and a size, and whose time is in milliseconds. Others, and keys that can't be decoded, give no rows.
    """
    schema = "array<struct<eventName:string,eventTime:string,s3:struct<bucket:struct<name:string>,object:struct<key:string,size:bigint>>>>"
    message = F.coalesce(F.get_json_object(col, "$.Message"), F.col(col))
    records = F.filter(F.from_json(F.get_json_object(message, "$.Records"), schema), lambda r: r["eventName"].contains("ObjectCreated:"))
    item = lambda bucket, key, size, at: F.struct(bucket.alias("bucket"), key.alias("key"), size.alias("size"), at.alias("event_ts"))
    created = F.transform(records, lambda r: item(r["s3"]["bucket"]["name"], r["s3"]["object"]["key"], r["s3"]["object"]["size"], F.try_to_timestamp(r["eventTime"])))
    files = F.from_json(F.get_json_object(message, "$.files"), "array<struct<path:string,size:bigint>>")
    at = F.timestamp_millis(F.get_json_object(message, "$.timestamp").try_cast("bigint"))
    dropped = F.transform(files, lambda f: item(F.get_json_object(message, "$.bucket"), f["path"], f["size"], at))
    out = events.select(F.explode(F.coalesce(created, dropped)).alias("o")).select("o.*")
    out = out.withColumn("key", F.try_url_decode(F.replace("key", F.lit("+"), F.lit("%2B")))).where(F.col("key").isNotNull())
    for c, rx in (("bucket", bucket), ("key", key)):
        out = out.where(F.col(c).rlike(rx)) if rx else out
    return out


def dedup_objects(df: DataFrame, keys: Sequence[str] = ("bucket", "key"), ttl: str | None = None, ts: str = "event_ts") -> DataFrame:
    """One row for each object; of a stream, within the TTL."""
    if df.isStreaming:
        return df.withWatermark(ts, ttl or "1 hour").dropDuplicatesWithinWatermark(list(keys))
    return df.dropDuplicates(list(keys))


def explode_pages(df: DataFrame, col: str, path: str | None = None) -> DataFrame:
    """The objects of an array of a landed page, as `record`: at a dotted path with indices (`a.b[0].c`), or without a path the page
    itself if it is an array, else `data` if that is one, else the first field, by name, that is. Elements that are no objects,
    and pages without such an array, give no rows."""
    text = F.trim(col)
    if path:
        found = F.get_json_object(text, f"$.{path}")
    else:
        fields = F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>")
        arrays = F.array_sort(F.map_keys(F.map_filter(fields, lambda _, v: F.schema_of_variant(v).startswith("ARRAY"))))
        name = F.when(F.array_contains(arrays, "data"), F.lit("data")).otherwise(F.get(arrays, F.lit(0)))
        at = F.concat(F.lit("$['"), name, F.lit("']"))
        quoted = F.to_json(F.try_element_at(fields, name))  # a path can't name a field that holds a quote
        found = F.when(text.startswith("["), text).when(name.contains("'"), quoted).otherwise(F.call_function("get_json_object", text, at))
    return df.select(F.explode(F.from_json(found, "array<string>")).alias("record")).where(F.trim("record").startswith("{"))


def explode_ndjson_page(df: DataFrame, col: str, metadata_last: bool = False) -> DataFrame:
    """The lines of a page as records, with the last line as metadata of all if it is that."""
    lines = F.filter(F.split(col, r"\r?\n"), lambda x: F.trim(x) != "")
    own, meta = (F.slice(lines, 1, F.greatest(F.size(lines) - 1, F.lit(0))), F.element_at(lines, -1)) if metadata_last else (lines, F.lit(None).cast("string"))
    return df.where(F.size(lines) > 0).select(F.posexplode(own).alias("pos", "record"), meta.alias("metadata"))


def read_since(df: DataFrame, ts: str, high_water=None) -> DataFrame:
    """Rows after the high-water mark."""
    return df if high_water is None else df.where(F.col(ts) > F.lit(high_water))


def epoch_time(value: Column) -> Column:
    """A number since 1970 as a time: over 1e10 it is milliseconds, else seconds; fractions are kept to the microsecond."""
    n = value.try_cast("double")
    whole = F.floor(n)
    scale = F.when(n > 1e10, 1_000).otherwise(1_000_000)
    return F.timestamp_micros((whole * scale + F.round((n - whole) * scale)).cast("bigint"))


#: The least step of each form of a time, in microseconds; of nanoseconds the least that a time can hold.
MARK_STEPS = {"epoch_s": 1_000_000, "epoch_ms": 1_000, "epoch_us": 1, "epoch_ns": 1, "epoch_s_frac": 1, "text": 1}


def next_mark(df: DataFrame, ts: str, form: str = "text") -> DataFrame:
    """One row with `mark`: the newest time and one step of the form it is asked for in, from which the next read starts (inclusive).
    A table without times gives a null mark, that is, the mark so far stays."""
    return df.agg(F.timestamp_micros(F.unix_micros(F.max(F.col(ts).cast("timestamp"))) + MARK_STEPS[form]).alias("mark"))


def read_matching(spark: SparkSession, globs: Sequence[str], name: str | None = None, schema: str = "value string", form: str = "text", **options) -> DataFrame:
    """Files below paths with wildcards, as rows with `path`; of these only files whose name the pattern is found in.

    Compressed files are read by their extension (gz, bz2, zst, deflate, lz4, snappy). The pattern holds for the file's name
    before any of its rows is read on.
    """
    df = spark.read.options(**options).schema(schema).format(form).load(list(globs))
    df = df.where(F.col("_metadata.file_name").rlike(name)) if name else df
    return df.select("*", F.col("_metadata.file_path").alias("path"))


def read_raw_text(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A row for each whole file, as body_text with its path; files of nothing but white space are left out."""
    df = spark.read.text(path, wholetext=True).select(F.col("value").alias("body_text"), F.col("_metadata.file_path").alias("path"))
    return df.where(F.col("body_text").rlike(r"\S"))


#: Fields that may hold a record's time, and its number, in order.
TIME_FIELDS = ("timestamp", "time", "created_at", "createdAt", "date", "datetime", "@timestamp")
VALUE_FIELDS = ("value", "count", "total", "sum", "amount", "metric", "measurement")


def json_to_logs(df: DataFrame, col: str) -> DataFrame:
    """JSON objects as logs: body_text, and ts from the first field that is a time (text, or seconds since 1970), else the query's time."""
    at = lambda f: F.get_json_object(col, f"$['{f}']")
    tries = [x for f in TIME_FIELDS for x in (F.try_to_timestamp(F.when(~at(f).rlike(r"^-?\d+(\.\d+)?$"), at(f))), F.timestamp_micros((at(f).try_cast("double") * 1e6).cast("long")))]
    return df.where(F.trim(col).startswith("{") & F.try_parse_json(col).isNotNull()).withColumns({"ts": F.coalesce(*tries, F.current_timestamp()), "body_text": F.col(col)})


def json_to_metrics(df: DataFrame, col: str, name: str | Column, attrs_exclude: Sequence[str] = ()) -> DataFrame:
    """JSON objects as points: value of the first numeric field of the usual ones, else the numeric field that is first by name; all
    other fields are attributes, nested ones as `nested_map` or `array`. Rows without a value are left out."""
    m = F.from_json(col, "map<string,string>")
    number = lambda v: v.try_cast("double")
    some = F.array_sort(F.map_keys(F.map_filter(m, lambda _, v: v.rlike(r"^-?\d+(\.\d+)?([eE][-+]?\d+)?$"))))
    key = F.coalesce(*[F.when(F.array_contains(some, f), F.lit(f)) for f in VALUE_FIELDS], F.get(some, F.lit(0)))
    rest = F.map_filter(m, lambda k, _: (k != key) & ~k.isin(list(attrs_exclude) or [""]))
    shown = F.transform_values(rest, lambda _, v: F.when(v.startswith("{"), F.lit("nested_map")).when(v.startswith("["), F.lit("array")).otherwise(v))
    return df.select((F.lit(name) if isinstance(name, str) else name).alias("metric_name"), number(F.element_at(m, key)).alias("value"), shown.alias("attributes")).where("metric_name is not null and value is not null")


#: Batches of a bucket of size_batches, on average.
BUCKET_BATCHES = 16


def size_batches(df: DataFrame, keys: Sequence[str], size: Column, limit: int = 4_000_000, order: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows with batch, oversized rows): rows of each key numbered into batches whose sizes sum to at most `limit`.

    Sizes are summed by key first. A key of more than BUCKET_BATCHES batches is dealt to as many buckets as its sum asks for, by a hash
    of the order columns, and batches are cut within a bucket; so a key of any size is shared by many tasks.
    """
    rest = [F.col(c) for c in (order or [c for c in df.columns if c not in keys])]
    sized = df.withColumn("_size", size)
    of_key = [F.col(f"_key{i}").eqNullSafe(F.col(k)) for i, k in enumerate(keys)]
    many = sized.groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).agg(F.ceil(F.sum("_size") / (limit * BUCKET_BATCHES)).alias("_buckets")).where("_buckets > 1")
    sized = sized.join(many, of_key, "left").withColumn("_bucket", F.pmod(F.xxhash64(*rest), F.coalesce("_buckets", F.lit(1)))).drop("_buckets", *[f"_key{i}" for i in range(len(keys))])
    w = W.partitionBy(*keys, "_bucket").orderBy(*rest)
    fit = sized.where(F.col("_size") <= limit)
    # rows of at most half the limit fill windows of half the limit; larger ones stand alone
    half = limit // 2
    run = F.sum(F.when(F.col("_size") <= half, F.col("_size")).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, 0))
    alone = F.col("_size") > half
    numbered = fit.withColumn("batch", F.concat_ws("-", "_bucket", F.when(alone, F.concat(F.lit("x"), F.row_number().over(w))).otherwise(F.floor((run - 1) / half).cast("string"))))
    return numbered.drop("_size", "_bucket"), sized.where(F.col("_size") > limit).drop("_size", "_bucket")


def write_lines(df: DataFrame, path: str, field: str | None = None, mode: str = "append") -> None:
    """One line for each row: a field as text, or the row as JSON."""
    df.select((F.col(field).cast("string") if field else F.to_json(F.struct(*df.columns))).alias("value")).where("value is not null").write.mode(mode).text(path)


def payload_logs(df: DataFrame, body: str, content_type: str) -> DataFrame:
    """HTTP payloads as records: JSON objects, elements of JSON arrays, or other payloads whole; the content type stays."""
    is_json = F.col(content_type).rlike(r"^application/([\w.-]+\+)?json")
    t = F.trim(body)
    items = F.when(is_json & t.startswith("["), F.from_json(t, "array<string>")).when(is_json & F.try_parse_json(body).isNull(), F.expr("cast(array() as array<string>)")).otherwise(F.array(body))
    return df.select(F.explode(items).alias("record"), F.col(content_type).alias("content_type"))

