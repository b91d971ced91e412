"""Interval counts, metric statistics and other groupings."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tellurion.functions.expressions import attributes, canonical, column, holds
from tellurion.operators.scans import run_numbers


def _count(df: DataFrame, cond: str | Column, attrs: Mapping[str, str | Column] | None, interval: str, name: str, unit: str, ts: str) -> DataFrame:
    resource = [F.col("resource_key")] if "resource_key" in df.columns else [F.lit("{}").alias("resource_key")]
    rows = df.where(holds(cond)).select(F.window(ts, interval).alias("w"), *resource, canonical(attributes(attrs or {})).alias("attributes"))
    counted = rows.groupBy("w", "resource_key", "attributes").agg(F.count("*").alias("value"))
    return counted.select(F.col("w.start").alias("start_ts"), F.col("w.end").alias("ts"), "resource_key", "attributes", F.lit(name).alias("metric_name"), F.lit(unit).alias("unit"), "value")


def log_count(df: DataFrame, match: str | Column = "true", attrs: Mapping[str, str | Column] | None = None, interval: str = "1 minute", name: str = "log.count", unit: str = "{logs}", ts: str = "ts") -> DataFrame:
    """A gauge point for each interval, resource and combination of extracted attributes: its number of matching logs.

    Attributes whose expression is null are left out of the key; intervals without rows give none. Batch and stream (give the
    stream a watermark on ts).
    """
    return _count(df, match, attrs, interval, name, unit, ts)


def datapoint_count(df: DataFrame, match: str | Column = "true", attrs: Mapping[str, str | Column] | None = None, interval: str = "1 minute", name: str = "datapoint.count", unit: str = "{datapoints}", ts: str = "ts") -> DataFrame:
    """log_count over points of any metric kind."""
    return _count(df, match, attrs, interval, name, unit, ts)


def span_count(df: DataFrame, match: str | Column = "true", attrs: Mapping[str, str | Column] | None = None, interval: str = "1 minute", name: str = "span.count", unit: str = "{spans}", ts: str = "end_ts") -> DataFrame:
    """log_count over spans."""
    return _count(df, match, attrs, interval, name, unit, ts)


STATS = ("min", "max", "avg", "first", "last")


def metric_stats(df: DataFrame, include: str, stats: Sequence[str] = STATS, interval: str = "1 minute", tie: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(statistics, rest): for gauges and cumulative sums whose name matches, a point `<name>.<stat>` for each statistic, resource,
    attributes and interval; the rest are all other rows, unchanged.

    Input: metric_name, metric_type, temporality, resource_key, attr_key, ts, value_type (int or double), value. A series whose first
    point is an int is an int series: values are truncated and its average is the truncated quotient. first and last are of the
    earliest and latest point; of equal times the least and the greatest by the tie columns. Points without value are passed through.
    """
    kind = (F.col("metric_type") == "gauge") | ((F.col("metric_type") == "sum") & (F.col("temporality") == "cumulative"))
    mine = holds(kind & F.col("metric_name").rlike(include) & F.col("value").isNotNull())
    at = F.struct(F.col("ts"), *[F.col(t) for t in tie])
    keys = ["w", "resource_key", "metric_name", "metric_type", "attr_key"]
    v = F.col("value").cast("double")
    whole = F.when(v < 0, F.ceil(v)).otherwise(F.floor(v)).cast("long")
    grouped = df.where(mine).withColumn("w", F.window("ts", interval)).groupBy(*keys).agg(
        F.min_by("value_type", at).alias("kind"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("avg"), F.min_by(v, at).alias("first"), F.max_by(v, at).alias("last"),
        F.sum(whole).alias("isum"), F.count("*").alias("n"),
    )
    ints = F.col("kind") == "int"
    cut = lambda c: F.when(ints, F.when(c < 0, F.ceil(c)).otherwise(F.floor(c)).cast("double")).otherwise(c)
    values = {s: cut(F.col(s)) for s in STATS} | {"avg": F.when(ints, F.expr("isum div n").cast("double")).otherwise(F.col("avg"))}
    points = F.array(*[F.struct(F.lit(s).alias("stat"), values[s].alias("value")) for s in stats])
    out = grouped.select(*keys, "kind", F.explode(points).alias("p"))
    name = F.concat_ws(".", "metric_name", "p.stat").alias("metric_name")
    return out.select(F.col("w.start").alias("start_ts"), F.col("w.end").alias("ts"), "resource_key", name, "metric_type", "attr_key", F.col("kind").alias("value_type"), F.col("p.value").alias("value")), df.where(~mine)


def throughput(df: DataFrame, by: Sequence[str], body: str = "body_text", original: str | None = None) -> DataFrame:
    """Rows, bytes of the whole row as JSON and bytes of the raw record (its original if kept, else the body) by key."""
    raw = F.coalesce(*([F.col(original)] if original else []), F.col(body), F.lit(""))
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"), F.sum(size).alias("n_bytes"), F.sum(F.octet_length(raw)).alias("raw_bytes"))


class Measured:
    """Rows, bytes and last success of a table while another job reads it: give `rows` to the write, then ask `result`.

    Nothing is read twice. `result` waits for the first action on `rows`; a stream's come with its progress, as `progress` picks them.
    """

    def __init__(self, df: DataFrame, body: str = "body_text", original: str | None = None, status: str | Column | None = None, ts: str | None = None, name: str | None = None):
        raw = F.coalesce(*([F.col(original)] if original else []), F.col(body), F.lit(""))
        ok = holds(status) if status is not None else F.lit(True)
        said = [F.count("*").alias("n_rows"), F.coalesce(F.sum(F.octet_length(raw)), F.lit(0)).alias("raw_bytes"), F.count_if(ok).alias("accepted"), F.count_if(~ok).alias("dropped")]
        said += [F.max(F.when(ok, F.col(ts))).alias("last_success")] if ts else []
        self.name = name or f"measured-{uuid.uuid4().hex[:8]}"
        self.observation = None if df.isStreaming else Observation(self.name)
        self.rows = df.observe(self.observation or self.name, *said)

    def result(self) -> dict:
        """The measures of a batch, once its write has run."""
        return dict(self.observation.get)

    def progress(self, query: StreamingQuery) -> list[dict]:
        """The measures of a stream's batches so far, those that its progress still holds."""
        return [p.observedMetrics[self.name].asDict() for p in query.recentProgress if self.name in p.observedMetrics]


def latest_by_key(df: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """The last time each combination of keys was seen; rows that lack one of them don't count."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.max(ts).alias("last_seen"))


def topology(df: DataFrame, src: str, dst: str, ts: str = "ts", many: int = 10_000) -> DataFrame:
    """Each source with its destinations and when each was last seen, in order; sources without destinations are left out.

    A source of more than about `many` destinations has a row for each `part` of them, dealt by a hash, so no array is unbounded.
    """
    edges = latest_by_key(df, [src, dst], ts)
    sizes = edges.groupBy(src).agg(F.ceil(F.count("*") / many).alias("_parts")).where("_parts > 1").withColumnRenamed(src, "_src")
    dealt = edges.join(sizes, F.col(src) == F.col("_src"), "left").withColumn("part", F.pmod(F.xxhash64(dst), F.coalesce("_parts", F.lit(1))))
    return dealt.groupBy(src, "part").agg(F.array_sort(F.collect_list(F.struct(dst, "last_seen"))).alias("destinations"))


def run_counts(df: DataFrame, order: Sequence[str], keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Lengths of runs of equal keys in ordered tables, each with its number, `run`; `by` names the tables (none: all rows are one).
    However large a table, its slices are scanned side by side; a user's column `run` is none of the result's."""
    numbered = run_numbers(df.select(*dict.fromkeys([*by, *order, *keys])), keys, order, by, "_run")
    return numbered.groupBy(*by, F.col("_run").alias("run"), *keys).agg(F.count("*").alias("n"))


def pipe_table_counts(df: DataFrame, text: str, field: int, header_word: str | None = None) -> DataFrame:
    """Rows of `a | b | c` tables in a text column, counted by one trimmed field (from 0); header lines don't count."""
    lines = df.select(F.explode(F.split(text, r"\r?\n")).alias("line")).where(F.col("line").contains("|"))
    cells = F.split("line", r"\|")
    value = F.trim(F.get(cells, F.lit(field)))
    rows = lines.select(value.alias("field")).where("field is not null and field <> ''")
    return (rows.where(F.col("field") != header_word) if header_word else rows).groupBy("field").agg(F.count("*").alias("n"))


def combine_metrics(df: DataFrame, pattern: str, new_name: str, label: str) -> DataFrame:
    """Rename metrics that the pattern matches as a whole to one name; its first group becomes the label."""
    got = F.regexp_extract("metric_name", f"^(?:{pattern})$", 1)
    hit = F.col("metric_name").rlike(f"^(?:{pattern})$")
    return df.withColumns({label: F.when(hit, got), "metric_name": F.when(hit, F.lit(new_name)).otherwise(F.col("metric_name"))})


def aggregate_labels(df: DataFrame, keep: Sequence[str], how: str = "sum", value: str = "value") -> DataFrame:
    """One value for each combination of the kept labels: sum, min, max, avg or count over the dropped ones."""
    f = {"sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg, "mean": F.avg, "count": F.count}[how]
    return df.groupBy(*keep).agg(f(value).alias(value))


def update_metrics(df: DataFrame, rename: Mapping[str, str] | None = None, keep: Sequence[str] | None = None, drop: Sequence[str] | None = None, unit: Mapping[str, str] | None = None) -> DataFrame:
    """Keep or drop metrics by name, then rename them and set units."""
    name = F.col("metric_name")
    if keep is not None:
        df = df.where(name.isin(list(keep)))
    if drop:
        df = df.where(~name.isin(list(drop)))
    if unit and "unit" in df.columns:
        df = df.withColumn("unit", F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in unit.items() for x in p]), name), F.col("unit")))
    if rename:
        df = df.withColumn("metric_name", F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in rename.items() for x in p]), name), name))
    return df


def delivery_stats(df: DataFrame, status: str | Column, interval: str = "1 minute", ts: str = "ts") -> DataFrame:
    """Accepted and dropped rows and the last success, by interval; status is true for accepted rows."""
    ok = holds(status)
    return df.groupBy(F.window(ts, interval).alias("w")).agg(F.count_if(ok).alias("accepted"), F.count_if(~ok).alias("dropped"), F.max(F.when(ok, F.col(ts))).alias("last_success")).select(F.col("w.start").alias("start_ts"), "accepted", "dropped", "last_success")


def group_batches(df: DataFrame, keys: Mapping[str, str | Column], rows: int = 10_000) -> DataFrame:
    """Rows and numbered batches of each delivery key, `rows` a batch at most: sums by key and salt, so no key meets in one task."""
    named = df.select(*[column(c).alias(k) for k, c in keys.items()])
    return named.groupBy(*keys).agg(F.count("*").alias("n_rows")).withColumn("n_batches", F.ceil(F.col("n_rows") / rows))
