"""The registered queries over the reference operators, each beside its DuckDB twin."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellurion.functions.shared import shared_path, spread
from tellurion.operators import aggregates as A
from tellurion.operators import enrich as J
from tellurion.operators import filters as X
from tellurion.operators import parse as L
from tellurion.operators import rewrite as R
from tellurion.operators import standardize as N
from tellurion.operators import templates as P
from tellurion.sources import landing as S
from tellurion.sources import otlp as O
from tellurion.sources import sinks as K
from tellurion.sources import vendor as V
from tellurion.streaming import runs as Q

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def registered(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[name] = f
        if sql:
            _SQL[name] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def dealt(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table whose every row is dear to work on, so that even a small one is dealt to all cores."""
    return spread(t(spark, sf, name))


def event_logs(spark: SparkSession, sf: str, read: Callable[..., DataFrame] = t) -> DataFrame:
    """The events table as flat logs."""
    e = read(spark, sf, "events")
    return e.select(
        "event_id", "ts", "user_id", "event_type", "value", F.col("props").alias("body_text"),
        F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("resource"), F.concat(F.lit('{"user":"'), F.col("user_id").cast("string"), F.lit('"}')).alias("resource_key"),
        F.create_map(F.lit("type"), F.col("event_type"), F.lit("k"), F.get_json_object("props", "$.k")).alias("attributes"),
    )


# ---------------------------------------------------------------- counts and statistics


@registered("a1_log_count", """
SELECT date_trunc('minute', ts) AS start_ts, '{"type":"' || event_type || '"}' AS attributes, 'log.count' AS metric_name, count(*) AS value
FROM events WHERE value > 0 GROUP BY 1, 2""")
def _(spark, sf):
    out = A.log_count(event_logs(spark, sf).drop("resource_key"), "value > 0", {"type": "event_type", "absent": "cast(null as string)"})
    return out.select("start_ts", "attributes", "metric_name", "value")


@registered("a1_log_count_by_resource", """
SELECT time_bucket(INTERVAL '1 hour', ts) AS start_ts, '{"user":"' || user_id || '"}' AS resource_key, count(*) AS value FROM events GROUP BY 1, 2""")
def _(spark, sf):
    return A.log_count(event_logs(spark, sf), interval="1 hour").select("start_ts", "resource_key", "value")


@registered("a2_datapoint_count", """
SELECT date_trunc('day', l_shipdate) AS start_ts, '{"flag":"' || l_returnflag || '","status":"' || l_linestatus || '"}' AS attributes, count(*) AS value
FROM lineitem WHERE l_quantity >= 10 GROUP BY 1, 2""")
def _(spark, sf):
    out = A.datapoint_count(t(spark, sf, "lineitem"), "l_quantity >= 10", {"flag": "l_returnflag", "status": "l_linestatus"}, "1 day", ts="l_shipdate")
    return out.select("start_ts", "attributes", "value")


@registered("a3_span_count", """
SELECT role, turn, count(*) AS value FROM conversations WHERE text IS NOT NULL GROUP BY 1, 2""")
def _(spark, sf):
    spans = t(spark, sf, "conversations").withColumn("end_ts", F.timestamp_seconds(F.col("turn") * 60))
    out = A.span_count(spans, "text is not null", {"role": "role"})
    return out.select(F.get_json_object("attributes", "$.role").alias("role"), (F.unix_timestamp("start_ts") / 60).cast("long").alias("turn"), "value")


def _points(spark, sf):
    e = event_logs(spark, sf)
    return e.select("event_id", "ts", F.lit("{}").alias("resource_key"), F.concat(F.lit("m."), "event_type").alias("metric_name"), F.lit("gauge").alias("metric_type"), F.lit(None).cast("string").alias("temporality"), F.lit("{}").alias("attr_key"), F.lit("double").alias("value_type"), F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"))


@registered("a4_metric_stats", """
WITH e AS (SELECT *, time_bucket(INTERVAL '1 hour', ts) AS w FROM events WHERE event_id % 7 <> 0 AND value IS NOT NULL),
g AS (SELECT w, event_type, min(value) mn, max(value) mx, arg_min(value, struct_pack(a := ts, b := event_id)) f, arg_max(value, struct_pack(a := ts, b := event_id)) l FROM e GROUP BY 1, 2)
SELECT w AS start_ts, 'm.' || event_type || '.min' AS metric_name, mn AS value FROM g
UNION ALL SELECT w, 'm.' || event_type || '.max', mx FROM g
UNION ALL SELECT w, 'm.' || event_type || '.first', f FROM g
UNION ALL SELECT w, 'm.' || event_type || '.last', l FROM g""")
def _(spark, sf):
    stats, _ = A.metric_stats(_points(spark, sf), "^m", ("min", "max", "first", "last"), "1 hour", ["event_id"])
    return stats.select("start_ts", "metric_name", "value")


@registered("a4_metric_stats_int_avg", """
SELECT date_trunc('month', o_orderdate) AS start_ts, CAST(sum(CAST(trunc(o_totalprice) AS BIGINT)) // count(*) AS DOUBLE) AS value FROM orders GROUP BY 1""")
def _(spark, sf):
    o = t(spark, sf, "orders")
    points = o.select(F.date_trunc("month", "o_orderdate").alias("ts"), F.lit("{}").alias("resource_key"), F.lit("price").alias("metric_name"), F.lit("sum").alias("metric_type"), F.lit("cumulative").alias("temporality"), F.lit("{}").alias("attr_key"), F.lit("int").alias("value_type"), F.col("o_totalprice").alias("value"))
    return A.metric_stats(points, "price", ("avg",), "1 day")[0].select("start_ts", "value")


@registered("a4_metric_stats_rest", "SELECT event_id, event_type FROM events WHERE event_id % 7 = 0 OR value IS NULL OR event_type <> 'click'")
def _(spark, sf):
    _, rest = A.metric_stats(_points(spark, sf), "click$", interval="1 hour")
    return rest.select("event_id", F.substring("metric_name", 3, 100).alias("event_type"))


@registered("a5_throughput", "SELECT source, count(*) AS n_rows, CAST(sum(octet_length(encode(coalesce(text, '')))) AS BIGINT) AS raw_bytes FROM documents GROUP BY 1")
def _(spark, sf):
    return A.throughput(t(spark, sf, "documents"), ["source"], "text").select("source", "n_rows", F.col("raw_bytes").cast("long").alias("raw_bytes"))


@registered("a6_latest_by_key", "SELECT user_id, event_type, max(ts) AS last_seen FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL GROUP BY 1, 2")
def _(spark, sf):
    return A.latest_by_key(t(spark, sf, "events"), ["user_id", "event_type"])


@registered("a7_topology", """
SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS destinations FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    return A.topology(t(spark, sf, "events"), "user_id", "event_type").select("user_id", F.array_join(F.array_sort(F.transform("destinations", lambda d: d["event_type"])), ",").alias("destinations"))


@registered("a8_run_counts", """
WITH a AS (SELECT conv_id, turn, role, CASE WHEN lag(role) OVER w IS DISTINCT FROM role OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS s FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, text)),
b AS (SELECT *, sum(s) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS run FROM a)
SELECT conv_id, CAST(run AS BIGINT) AS run, role, count(*) AS n FROM b GROUP BY ALL""")
def _(spark, sf):
    return A.run_counts(t(spark, sf, "conversations"), ["turn", "text"], ["role"], ["conv_id"]).select("conv_id", F.col("run").cast("long").alias("run"), "role", "n")


@registered("a9_pipe_table_counts", r"""
WITH l AS (SELECT unnest(string_split_regex(text, '\r?\n')) AS line FROM documents),
f AS (SELECT trim(string_split(line, '|')[2], ' ') AS field FROM l WHERE contains(line, '|'))
SELECT field, count(*) AS n FROM f WHERE field <> '' GROUP BY 1""")
def _(spark, sf):
    return A.pipe_table_counts(t(spark, sf, "documents"), "text", 1)


@registered("a10_combine_metrics", """
SELECT CASE WHEN event_type IN ('click', 'view') THEN 'page' ELSE event_type END AS metric_name, CASE WHEN event_type IN ('click', 'view') THEN event_type END AS action, count(*) AS n FROM events GROUP BY 1, 2""")
def _(spark, sf):
    m = t(spark, sf, "events").select(F.col("event_type").alias("metric_name"), "value")
    return A.combine_metrics(m, "(click|view)", "page", "action").groupBy("metric_name", "action").agg(F.count("*").alias("n"))


@registered("a10_aggregate_labels", "SELECT l_returnflag, CAST(sum(l_linenumber) AS BIGINT) AS value FROM lineitem GROUP BY 1")
def _(spark, sf):
    return A.aggregate_labels(t(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("long").alias("value")), ["l_returnflag"])


@registered("a11_update_metrics", "SELECT CASE event_type WHEN 'click' THEN 'ui.click' ELSE event_type END AS metric_name, count(*) AS n FROM events WHERE event_type <> 'view' GROUP BY 1")
def _(spark, sf):
    m = t(spark, sf, "events").select(F.col("event_type").alias("metric_name"))
    return A.update_metrics(m, {"click": "ui.click"}, drop=["view"]).groupBy("metric_name").agg(F.count("*").alias("n"))


@registered("a12_delivery_stats", """
SELECT date_trunc('day', o_orderdate) AS start_ts, count(*) FILTER (o_orderstatus = 'F') AS accepted, count(*) FILTER (coalesce(o_orderstatus <> 'F', true)) AS dropped, max(o_orderdate) FILTER (o_orderstatus = 'F') AS last_success FROM orders GROUP BY 1""")
def _(spark, sf):
    return A.delivery_stats(t(spark, sf, "orders"), "o_orderstatus = 'F'", "1 day", "o_orderdate")


@registered("a13_group_batches", "SELECT source, lang, count(*) AS n_rows, CAST(ceil(count(*) / 100.0) AS BIGINT) AS n_batches FROM documents GROUP BY 1, 2")
def _(spark, sf):
    return A.group_batches(t(spark, sf, "documents"), {"source": "source", "lang": "lang"}, 100)


# ---------------------------------------------------------------- filters


@registered("f1_match", "SELECT event_id FROM events WHERE event_type = 'click' AND value > 50")
def _(spark, sf):
    return X.match(event_logs(spark, sf), "attributes['type'] = 'click' and value > 50").select("event_id")


@registered("f3_sample_all", "SELECT event_id FROM events WHERE NOT (event_type = 'click')")
def _(spark, sf):
    return X.sample(t(spark, sf, "events"), 1.0, "event_type = 'click'").select("event_id")


@registered("f3_sample_none", "SELECT event_id FROM events")
def _(spark, sf):
    return X.sample(t(spark, sf, "events"), 0.0).select("event_id")


@registered("f3_sample_half", "SELECT event_id FROM events WHERE CAST('0x' || left(md5('0:' || event_id), 12) AS BIGINT) / 281474976710656.0 > 0.5")
def sample_half(spark, sf):
    return X.sample(t(spark, sf, "events"), 0.5, key="event_id").select("event_id")


@registered("f4_search", "SELECT doc_id FROM documents WHERE contains(text, 'the') OR contains(source, 'the')")
def _(spark, sf):
    return X.search(t(spark, sf, "documents"), "the", ["text", "source"]).select("doc_id")


@registered("f5_since", "SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-02 00:00:00'")
def _(spark, sf):
    from datetime import datetime

    return X.since(t(spark, sf, "events"), datetime(2024, 1, 2)).select("event_id")


@registered("f7_most_recent", "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 100")
def _(spark, sf):
    return X.most_recent(t(spark, sf, "events").select("event_id", "ts"), 100, tie=["event_id"])


@registered("f8_sample_within_bytes", """
WITH d AS (SELECT doc_id, CAST('0x' || left(md5('0:' || doc_id), 12) AS BIGINT) % 100 AS u, coalesce(octet_length(encode(text)), 0) AS size FROM documents),
p AS (SELECT unnest([1, 25, 50, 75, 100]) AS share),
fit AS (SELECT max(share) AS share FROM p WHERE (SELECT coalesce(sum(size), 0) FROM d WHERE u < share) <= 2000000)
SELECT doc_id FROM d WHERE u < (SELECT coalesce(share, 0) FROM fit)""")
def sample_within_bytes(spark, sf):
    d = t(spark, sf, "documents")
    return X.sample_within_bytes(d, 2_000_000, "doc_id", F.coalesce(F.octet_length("text"), F.lit(0))).select("doc_id")


@registered("f9_eligible_metrics", "SELECT event_id FROM events WHERE regexp_matches(event_type, 'i.*k')")
def _(spark, sf):
    return X.eligible_metrics(_points(spark, sf), "i.*k").select("event_id")


@registered("f11_drop_where", "SELECT doc_id FROM documents WHERE coalesce(NOT contains(text, 'Licensed'), true)")
def _(spark, sf):
    return X.drop_where(t(spark, sf, "documents"), F.col("text").contains("Licensed")).select("doc_id")


@registered("f12_route", "SELECT CASE WHEN o_totalprice > 300000 THEN 'large' WHEN o_orderpriority LIKE '1%' THEN 'urgent' ELSE 'rest' END AS route, count(*) AS n FROM orders GROUP BY 1")
def _(spark, sf):
    return X.route(t(spark, sf, "orders"), [("large", "o_totalprice > 300000"), ("urgent", "o_orderpriority like '1%'")], "rest").groupBy("route").agg(F.count("*").alias("n"))


@registered("f13_fan_out", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'default' END AS branch FROM orders")
def _(spark, sf):
    parts = X.fan_out(t(spark, sf, "orders"), [("done", "o_orderstatus = 'F'")])
    return parts["done"].select("o_orderkey", F.lit("done").alias("branch")).unionAll(parts["default"].select("o_orderkey", F.lit("default").alias("branch")))


# ---------------------------------------------------------------- joins


@registered("j1_lookup", "SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def _(spark, sf):
    ref = t(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name", "c_mktsegment")
    return J.lookup(t(spark, sf, "orders"), ref, "o_custkey", "c_custkey").select("o_orderkey", "c_name", "c_mktsegment")


@registered("j1a_last_by_key", "SELECT o_custkey, arg_max(o_orderkey, o_orderkey) AS o_orderkey FROM orders GROUP BY 1")
def _(spark, sf):
    o = t(spark, sf, "orders").select("o_custkey", "o_orderkey", F.col("o_orderkey").alias("n"))
    return J.last_by_key(o, "o_custkey", "n")


@registered("j1c_lookup_valid", """
WITH r AS (SELECT user_id, ts AS f, min(value) AS v FROM events WHERE event_type = 'purchase' GROUP BY 1, 2),
s AS (SELECT *, least(f + INTERVAL '6 hours', coalesce(lead(f) OVER (PARTITION BY user_id ORDER BY f), f + INTERVAL '6 hours')) AS u FROM r)
SELECT e.event_id, s.v FROM events e LEFT JOIN s ON e.user_id = s.user_id AND e.ts >= s.f AND e.ts < s.u""")
def _(spark, sf):
    e = t(spark, sf, "events")
    ref = e.where("event_type = 'purchase'").groupBy("user_id", F.col("ts").alias("f")).agg(F.min("value").alias("v"))
    return J.lookup_valid(e.select("event_id", "user_id", "ts"), ref, "user_id", "ts", "f", "6 hours").select("event_id", "v")


@registered("j2_threat_match", """
SELECT o_orderkey, CASE WHEN CAST(o_custkey AS VARCHAR) IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0) THEN 'debt'
 WHEN o_orderpriority IN (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority LIKE '1%') THEN 'urgent' END AS threat_rule FROM orders""")
def _(spark, sf):
    o = t(spark, sf, "orders")
    debt = t(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("indicator"))
    urgent = o.where("o_orderpriority like '1%'").select(F.col("o_orderpriority").alias("indicator"))
    return J.threat_match(o, [J.Rule("debt", ["o_custkey"], debt), J.Rule("urgent", ["o_orderstatus", "o_orderpriority"], urgent)]).select("o_orderkey", "threat_rule")


@registered("j2a_bloom", """
SELECT count(*) AS matched, true AS few_others FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def bloom_finds_all(spark, sf):
    """Rows of indicators that the filter let through (all must be), and whether others are under a tenth of the table."""
    orders = t(spark, sf, "orders")
    known = t(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("indicator"))
    passed = J.maybe_matched(orders, J.bloom(known, "indicator"), "o_custkey")
    marked = passed.join(known.withColumn("real", F.lit(True)), F.col("o_custkey") == F.col("indicator"), "left")
    found = marked.agg(F.count("real").alias("matched"), F.count_if(F.col("real").isNull()).alias("others"))
    return found.crossJoin(F.broadcast(orders.agg(F.count("*").alias("n")))).select("matched", (F.col("others") <= F.col("n") / 10).alias("few_others"))


@registered("j2b_only_matched", "SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def _(spark, sf):
    return J.only_matched(t(spark, sf, "documents"), t(spark, sf, "labels").where("toxic = 1"), "doc_id", "doc_id").select("doc_id")


@registered("j2b_only_clean", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def _(spark, sf):
    return J.only_clean(t(spark, sf, "documents"), t(spark, sf, "labels").where("toxic = 1"), "doc_id", "doc_id").select("doc_id")


@registered("j3_decode", "SELECT n_nationkey, r_name AS region FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def _(spark, sf):
    return J.decode(t(spark, sf, "nation"), "n_regionkey", t(spark, sf, "region"), "region", "r_regionkey", "r_name").select("n_nationkey", "region")


@registered("j4_resolve_log_type", """
SELECT event_id, CASE WHEN event_type IN (SELECT DISTINCT event_type FROM events WHERE event_type < 'm') THEN event_type WHEN event_type = 'view' THEN 'PAGE_VIEW' ELSE 'CATCH_ALL' END AS log_type FROM events""")
def _(spark, sf):
    e = t(spark, sf, "events")
    return J.resolve_log_type(e, "event_type", {"view": "PAGE_VIEW"}, "event_type", e.where("event_type < 'm'").select("event_type")).select("event_id", "log_type")


# ---------------------------------------------------------------- rewriting and shape


def _mask_sql(names):
    text = "text"
    for n in sorted(names):
        text = f"regexp_replace({text}, '{R.MASK_RULES[n]}', '[masked_{n}]', 'g')"
    return text


@registered("r1_mask", f"SELECT doc_id, md5({_mask_sql(R.MASK_RULES)}) AS h FROM documents")
def _(spark, sf):
    return R.mask(dealt(spark, sf, "documents"), ["text"]).select("doc_id", F.md5("text").alias("h"))


@registered("r1b_mask_report", " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) FILTER (regexp_matches(text, '{p}')) AS n_rows, CAST(coalesce(sum(len(regexp_extract_all(text, '{p}'))), 0) AS BIGINT) AS n_hits FROM documents" for n, p in sorted(R.MASK_RULES.items())))
def _(spark, sf):
    return R.mask_report(dealt(spark, sf, "documents"), "text")


@registered("r2_remove_empty", "SELECT event_id, CASE WHEN event_type = 'click' THEN 1 ELSE 2 END - CASE WHEN props IS NULL OR json_extract_string(props, '$.k') IS NULL THEN 1 ELSE 0 END AS n FROM events")
def _(spark, sf):
    return R.remove_empty(event_logs(spark, sf), ["attributes"], strings=["CLICK"]).select("event_id", F.size("attributes").alias("n"))


@registered("r3_extract_metric", "SELECT ts, event_type, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS value FROM events WHERE event_type <> 'view' AND json_extract_string(props, '$.k') IS NOT NULL")
def _(spark, sf):
    m = R.extract_metric(event_logs(spark, sf), "attributes['k']", "event_type <> 'view'", {"type": "event_type"}, kind="counter_int")
    return m.select("ts", F.element_at("attributes", "type").alias("event_type"), "value")


@registered("r5_ingestion_labels", "SELECT event_id, 'prod' AS env, event_type AS ype FROM events")
def _(spark, sf):
    e = R.ingestion_labels(event_logs(spark, sf), {"env": "prod"}, "t")
    return e.select("event_id", F.element_at("labels", "env").alias("env"), F.element_at("labels", "ype").alias("ype"))


@registered("r6_sentinel_rows", r"SELECT md5(replace(replace(text, chr(13), '\r'), chr(10), '\n')) AS h FROM documents")
def _(spark, sf):
    d = t(spark, sf, "documents").withColumns({"ts": F.lit(0).cast("timestamp"), "body": F.col("text")})
    return R.sentinel_rows(d).select(F.md5("RawData").alias("h"))


@registered("t6_transpose_resource", "SELECT event_id, CAST(user_id AS VARCHAR) AS owner, event_type AS type FROM events")
def _(spark, sf):
    e = R.transpose_resource(event_logs(spark, sf), [("user", "owner"), ("user", "type"), ("none", "x")])
    return e.select("event_id", F.element_at("attributes", "owner").alias("owner"), F.element_at("attributes", "type").alias("type"))


@registered("t7_default_host", "SELECT event_id, 'h1' AS host FROM events")
def _(spark, sf):
    return R.default_host(event_logs(spark, sf), "h1").select("event_id", F.element_at("resource", "host.name").alias("host"))


@registered("t9_rebase_times", "SELECT event_id, ts + (TIMESTAMP '2030-01-01' - max(ts) OVER ()) AS ts FROM events")
def _(spark, sf):
    return R.rebase_times(t(spark, sf, "events").select("event_id", "ts"), "ts", "2030-01-01 00:00:00")


@registered("t10_nest", "SELECT c_custkey, c_name AS name, c_mktsegment AS segment FROM customer")
def _(spark, sf):
    n = t(spark, sf, "customer").select("c_custkey", R.nest({"user.name": "c_name", "user.market.segment": "c_mktsegment"}).alias("b"))
    return n.select("c_custkey", F.col("b.user.name").alias("name"), F.col("b.user.market.segment").alias("segment"))


@registered("t11_flatten_json", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def _(spark, sf):
    return R.flatten_json(t(spark, sf, "events"), "props").select("event_id", F.element_at("fields", "k").alias("k"))


@registered("t4_renest", "SELECT user_id, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1")
def _(spark, sf):
    r = R.renest(t(spark, sf, "events").select("user_id", "event_id", "ts"), ["user_id"], order=["event_id"])
    return r.select("user_id", F.size("records").cast("long").alias("n"), F.aggregate("records", F.lit(0).cast("long"), lambda a, x: a + x["event_id"]).alias("ids"))


# ---------------------------------------------------------------- landed payloads


@registered("s6_ndjson_logs", "SELECT event_id FROM events WHERE props IS NOT NULL AND props LIKE '{%'")
def _(spark, sf):
    lines = t(spark, sf, "events").select(F.concat(F.lit(" "), F.to_json(F.struct("event_id", "props"))).alias("value"), "props").where("props is not null")
    return S.ndjson_logs(lines).select(F.variant_get("body", "$.event_id", "bigint").alias("event_id"))


@registered("s7_records_json", "SELECT event_id, event_type FROM events")
def _(spark, sf):
    objects = t(spark, sf, "events").groupBy(F.floor(F.col("event_id") / 50).alias("g")).agg(F.to_json(F.struct(F.collect_list(F.struct("event_id", "event_type")).alias("records"))).alias("o"))
    return S.records_json(objects, "o").select(F.get_json_object("record", "$.event_id").cast("long").alias("event_id"), F.get_json_object("record", "$.event_type").alias("event_type"))


@registered("s9_sniffed", r"""
SELECT md5(line) AS h FROM (SELECT unnest(string_split_regex(text, '\r?\n')) AS line FROM documents) WHERE trim(line, ' ') <> ''
UNION ALL SELECT md5('{"event_id":' || event_id || '}') FROM events UNION ALL SELECT md5('{"user_id":' || user_id || '}') FROM events""")
def sniffed(spark, sf):
    """Texts of lines, arrays of fifty events, and objects that hold fifty more below a value that looks like the name."""
    by = F.floor(F.col("event_id") / 50).alias("g")
    arrays = t(spark, sf, "events").groupBy(by).agg(F.to_json(F.collect_list(F.struct("event_id"))).alias("text"))
    held = F.struct(F.lit('"Records": none').alias("note"), F.collect_list(F.struct("user_id")).alias("Records"))
    objects = t(spark, sf, "events").groupBy(by).agg(F.to_json(held).alias("text"))
    texts = t(spark, sf, "documents").select("text").unionByName(arrays.select("text")).unionByName(objects.select("text"))
    return S.sniffed(texts, "text").select(F.md5("record").alias("h"))


@registered("s10_cut_lines", "SELECT doc_id, CAST(ceil(length(text) / 1000.0) AS BIGINT) AS n FROM documents WHERE length(text) > 0")
def _(spark, sf):
    d = t(spark, sf, "documents")
    cut = d.select("doc_id", F.col("text")).where(F.length("text") > 0)
    parts = S.cut_lines(cut.select(F.concat(F.lpad(F.col("doc_id").cast("string"), 10, "0"), "text").alias("l"), "doc_id"), "l", 1000)
    return parts.groupBy().agg(F.count("*").alias("n_parts")).crossJoin(F.broadcast(cut.agg(F.count("*").alias("k")))).select("n_parts", "k")


_SQL["s10_cut_lines"] = "SELECT CAST(sum(ceil((length(text) + 10) / 1000.0)) AS BIGINT) AS n_parts, count(*) AS k FROM documents WHERE length(text) > 0"


@registered("s13_dedup_objects", "SELECT DISTINCT user_id, event_type FROM events")
def _(spark, sf):
    return S.dedup_objects(t(spark, sf, "events").select("user_id", "event_type"), ["user_id", "event_type"])


@registered("s16_read_since", "SELECT event_id FROM events WHERE event_id > 100")
def _(spark, sf):
    return S.read_since(t(spark, sf, "events"), "event_id", 100).select("event_id")


@registered("s16_next_mark", "SELECT max(ts) + INTERVAL 1 SECOND AS mark FROM events")
def next_mark(spark, sf):
    return S.next_mark(t(spark, sf, "events"), "ts", "epoch_s")


@registered("s16_epoch_time", "SELECT event_id, date_trunc('second', ts) AS s, date_trunc('millisecond', ts) AS ms FROM events")
def epoch_times(spark, sf):
    e, at = t(spark, sf, "events"), F.col("ts").cast("timestamp")
    return e.select("event_id", S.epoch_time(F.unix_seconds(at)).alias("s"), S.epoch_time(F.unix_millis(at)).alias("ms"))


@registered("s5_read_matching", "SELECT event_id FROM events WHERE event_type LIKE 'c%'")
def files_by_glob(spark, sf):
    """Events landed as compressed lines below a folder for each type; those of types with a `c` are read."""
    path = shared_path(spark, "glob")
    lines = t(spark, sf, "events").select(F.to_json(F.struct("event_id")).alias("value"), F.col("event_type").alias("type"))
    lines.write.partitionBy("type").option("compression", "bzip2").text(path)
    found = S.read_matching(spark, [f"{path}/type=c*"], r"^part-.*\.txt\.bz2$")
    return found.select(F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"))


@registered("s8_raw_text", "SELECT user_id % 50 AS b, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1")
def whole_objects(spark, sf):
    """Events landed as one file for each of 50 groups of users, each file read as one log."""
    path = shared_path(spark, "objects")
    lines = t(spark, sf, "events").select(F.col("event_id").cast("string").alias("value"), (F.col("user_id") % 50).alias("b"))
    lines.repartition("b").write.partitionBy("b").text(path)
    whole = S.read_raw_text(spark, f"{path}/b=*")
    ids = F.transform(F.split(F.rtrim(F.col("body_text"), F.lit("\n")), "\n"), lambda x: x.cast("bigint"))
    return whole.select(F.regexp_extract("path", r"/b=(\d+)/", 1).cast("bigint").alias("b"), F.size(ids).cast("bigint").alias("n"), F.aggregate(ids, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("ids"))


@registered("s6_quarantined", """
SELECT event_id, ['kept', 'blank', 'malformed', 'no_object', 'missing'][event_id % 5 + 1] AS reason FROM events""")
def poison_rows(spark, sf):
    forms = F.array(F.concat(F.lit('{"id":'), "event_id", F.lit("}")), F.lit("  "), F.concat(F.lit('{"id":'), "event_id"), F.lit("[1]"), F.lit(None))
    rows, bad = S.quarantined(t(spark, sf, "events").select("event_id", F.get(forms, (F.col("event_id") % 5).cast("int")).alias("value")))
    return rows.select("event_id", F.lit("kept").alias("reason")).unionByName(bad.select("event_id", "reason"))


@registered("s17_json_to_logs", "SELECT event_id, make_timestamp(event_id * 1000000) AS ts FROM events")
def _(spark, sf):
    j = t(spark, sf, "events").select(F.to_json(F.struct("event_id", F.col("event_id").alias("time"))).alias("j"))
    return S.json_to_logs(j, "j").select(F.get_json_object("body_text", "$.event_id").cast("long").alias("event_id"), "ts")


@registered("s18_json_to_metrics", "SELECT event_type AS metric_name, CAST(event_id AS DOUBLE) AS value FROM events")
def _(spark, sf):
    j = t(spark, sf, "events").select("event_type", F.to_json(F.struct("event_type", F.col("event_id").alias("count"), F.col("user_id").alias("a"))).alias("j"))
    return S.json_to_metrics(j, "j", F.col("event_type")).select("metric_name", "value")


@registered("k6_size_batches", "SELECT count(*) FILTER (octet_length(encode(text)) <= 20000) AS fit, count(*) FILTER (octet_length(encode(text)) > 20000) AS oversized, 0 AS over FROM documents WHERE text IS NOT NULL")
def _(spark, sf):
    d = t(spark, sf, "documents").where("text is not null").select("source", "doc_id", F.octet_length("text").alias("n"))
    fit, large = S.size_batches(d, ["source"], F.col("n"), 20_000, ["doc_id"])
    sums = fit.groupBy("source", "batch").agg(F.sum("n").alias("b"), F.count("*").alias("k"))
    return sums.agg(F.sum("k").alias("fit"), F.count_if(F.col("b") > 20_000).cast("int").alias("over")).crossJoin(F.broadcast(large.agg(F.count("*").alias("oversized"))))


# ---------------------------------------------------------------- log structure


@registered("l3_regex_parse", "SELECT page_id, regexp_extract(url, '^([a-z]+)://([^/]+)(/.*)?$', 1) AS scheme, regexp_extract(url, '^([a-z]+)://([^/]+)(/.*)?$', 2) AS host FROM pages WHERE regexp_matches(url, '^([a-z]+)://([^/]+)(/.*)?$')")
def _(spark, sf):
    p = L.regex_parse(t(spark, sf, "pages"), "url", r"^(?P<scheme>[a-z]+)://(?P<host>[^/]+)(?P<path>/.*)?$").where("parsed is not null")
    return p.select("page_id", F.col("parsed.scheme").alias("scheme"), F.col("parsed.host").alias("host"))


@registered("l8_multiline", r"SELECT doc_id, len(list_filter(string_split_regex(text, '\n'), lambda x: regexp_matches(x, '^[A-Z]'))) + CASE WHEN regexp_matches(text, '^[A-Z]') THEN 0 ELSE 1 END AS n FROM documents WHERE text IS NOT NULL")
def _(spark, sf):
    lines = t(spark, sf, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return L.assemble_multiline(lines, "line", "^[A-Z]", "doc_id", "line_no").groupBy("doc_id").agg(F.count("*").cast("int").alias("n"))


@registered("l11_severity", "SELECT event_id, CASE WHEN value < 10 THEN 17 WHEN value < 50 THEN 13 ELSE 9 END AS severity_number FROM events")
def _(spark, sf):
    return L.severity(t(spark, sf, "events"), "value", [(17, "value < 10"), (13, "value < 50")], 9).select("event_id", "severity_number")


@registered("l2_mine_templates", """
SELECT count(*) AS n, min('{"event_id":' || event_id || ',"event_type":"' || event_type || '"}') AS example FROM events
UNION ALL SELECT count(*), min('10.0.0.1 - - [x] "GET /' || event_type || '/' || event_id || '?q=1 HTTP/1.1" 200 ' || user_id) FROM events GROUP BY event_type""")
def mined_templates(spark, sf):
    return L.mine_templates(_mixed_logs(spark, sf), "log").select("n", "example")


@registered("l1_structures", """
SELECT event_id, 'json:{event_id:<val>,event_type:<txt>}' AS structure FROM events UNION ALL SELECT event_id, 'clf:GET /' || event_type || '/<val>' FROM events""")
def structures(spark, sf):
    return _mixed_logs(spark, sf).select("event_id", L.structure("log").alias("structure"))


# ---------------------------------------------------------------- security schemas

_SIGN_IN = N.Event(3002, [
    N.Field("activity_id", "case event_type when 'click' then 1 else 2 end"), N.Field("severity_id", None, 1), N.Field("time", "ts"), N.Field("user.uid", "user_id"),
    N.Field("user.name", "concat('u', user_id)"), N.Field("metadata.product.name", None, "events"), N.Field("count", "get_json_object(props, '$.k')"),
], "event_type in ('click', 'view')", ["cloud"])
_ACCOUNT = N.Event(3001, [N.Field("activity_id", None, 3), N.Field("severity_id", "case when value < 50 then '0x2' else 'high' end"), N.Field("time", "ts")], "event_type <> 'signup'")
_CLASS_RULES = {
    3002: N.ClassRules({"time": "timestamp", "count": "integer"}, [N.Rule("activity_id", True, (1, 2)), N.Rule("user.name", pattern="^u[0-9]*[02468]$"), N.Rule("time", True)], [["user.uid", "user.email"]]),
    3001: N.ClassRules({"time": "timestamp", "severity_id": "integer"}, [N.Rule("activity_id", True), N.Rule("user.name", True, profile="user")], just_one=[["severity_id", "status_id"]]),
}


@registered("n1_first_match", "SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 3002 ELSE 3001 END AS class_uid FROM events WHERE event_type IN ('click', 'view') OR event_type <> 'signup'")
def _(spark, sf):
    return N.class_rows(dealt(spark, sf, "events"), [_SIGN_IN, _ACCOUNT], "1.3.0", validate=False)[0].select("event_id", "class_uid")


@registered("n3_class_rows", """
SELECT event_id, 3002 AS class_uid, 3 AS category_uid, 300200 + CASE event_type WHEN 'click' THEN 1 ELSE 2 END AS type_uid, epoch_us(ts) // 1000 AS time, 'u' || user_id AS user_name, '1.3.0' AS version,
 CAST(json_extract_string(props, '$.k') AS BIGINT) AS n FROM events WHERE event_type IN ('click', 'view') AND user_id % 2 = 0""")
def _(spark, sf):
    rows, _ = N.class_rows(dealt(spark, sf, "events"), [_SIGN_IN], "1.3.0", _CLASS_RULES)
    at = lambda p, kind: F.get_json_object("body_text", f"$.{p}").cast(kind)
    return rows.select("event_id", "class_uid", at("category_uid", "int").alias("category_uid"), at("type_uid", "int").alias("type_uid"), at("time", "bigint").alias("time"), at("user.name", "string").alias("user_name"), at("metadata.version", "string").alias("version"), at("count", "bigint").alias("n"))


@registered("n4_coercion", "SELECT event_id, CASE WHEN value < 50 THEN '2' ELSE 'high' END AS severity, CASE WHEN value < 50 THEN 0 ELSE 1 END AS n_errors FROM events WHERE event_type <> 'signup'")
def _(spark, sf):
    rows, _ = N.class_rows(dealt(spark, sf, "events"), [_ACCOUNT], "1.3.0", _CLASS_RULES, validate=False)
    return rows.select("event_id", F.get_json_object("body_text", "$.severity_id").alias("severity"), F.size("coercion_errors").alias("n_errors"))


@registered("n5_rejected", "SELECT event_id, 'user.name: format' AS errors FROM events WHERE event_type IN ('click', 'view') AND user_id % 2 = 1 UNION ALL SELECT event_id, 'severity_id, status_id: just one' FROM events WHERE event_type NOT IN ('click', 'view', 'signup') AND value >= 50")
def _(spark, sf):
    _, rejected = N.class_rows(dealt(spark, sf, "events"), [_SIGN_IN, _ACCOUNT], "1.3.0", _CLASS_RULES)
    return rejected.select("event_id", F.array_join("errors", "; ").alias("errors"))


_TABLE_FIELDS = [N.Field(c, None, v) for c, v in (("EventProduct", "shop"), ("EventVendor", "shop"), ("EventSchemaVersion", "0.1"), ("Dvc", "h1"), ("EventResult", "Success"))]
_TABLE = N.Event("ASimAuthenticationEventLogs", [
    *_TABLE_FIELDS, N.Field("EventCount", "case when event_id % 3 = 0 then '0x10' when event_id % 3 = 1 then ' 7 ' else '3000000000' end"), N.Field("EventStartTime", "ts"), N.Field("EventEndTime", "date_format(ts, 'yyyy-MM-dd HH:mm:ss')"),
    N.Field("EventType", "event_type"),
], "event_type <> 'view'", schema="Authentication")
_TABLE_TYPES = {"ASimAuthenticationEventLogs": {"EventCount": "int", "EventStartTime": "datetime", "EventEndTime": "datetime", "EventType": "string", "TimeGenerated": "datetime"}}


@registered("n7_table_rows", """
SELECT event_id, 'Custom-ASimAuthenticationEventLogs' AS stream, CASE WHEN event_id % 3 = 0 THEN 16 ELSE 7 END AS n, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS generated, json_extract_string(props, '$.k') AS k
FROM events WHERE event_type <> 'view' AND event_id % 3 <> 2""")
def _(spark, sf):
    rows = N.table_rows(event_logs(spark, sf, dealt), [_TABLE], _TABLE_TYPES, attribution={"by": "x"})
    at = lambda p: F.get_json_object("row_json", f"$.{p}")
    return rows.select("event_id", "stream", at("EventCount").cast("int").alias("n"), at("TimeGenerated").alias("generated"), at("AdditionalFields.OriginalEvent.k").alias("k"))


# ---------------------------------------------------------------- telemetry documents and warehouse rows


def _tagged(**kv):
    kinds = ("stringValue", "intValue")
    return F.array(*[F.struct(F.lit(k).alias("key"), F.struct(*[F.when(F.lit(kind == x), F.col(c).cast("string")).alias(x) for x in kinds]).alias("value")) for k, (c, kind) in kv.items()])


def _nanos(c):
    return F.concat(F.unix_micros((F.col(c) if isinstance(c, str) else c).cast("timestamp")).cast("string"), F.lit("000"))


def _document(df, outer, inner, items, record):
    """Events as telemetry documents of at most 500 rows, each of one user."""
    g = df.groupBy("user_id", F.floor(F.col("event_id") / 500).alias("h")).agg(F.collect_list(record).alias(items))
    scope = F.struct(F.struct(F.lit("shop").alias("name"), F.lit("1").alias("version")).alias("scope"), F.col(items))
    resource = F.struct(_tagged(user=("user_id", "stringValue")).alias("attributes"))
    return g.select(F.to_json(F.struct(F.array(F.struct(resource.alias("resource"), F.array(scope).alias(inner))).alias(outer))).alias("value"))


def _log_documents(spark, sf):
    record = F.struct(_nanos("ts").alias("timeUnixNano"), F.lit(9).alias("severityNumber"), F.struct(F.col("props").alias("stringValue")).alias("body"), _tagged(id=("event_id", "intValue"), type=("event_type", "stringValue")).alias("attributes"))
    return _document(t(spark, sf, "events"), "resourceLogs", "scopeLogs", "logRecords", record)


def _metric_documents(spark, sf):
    point = F.array(F.struct(_nanos("ts").alias("timeUnixNano"), F.when(F.col("event_id") % 2 == 0, F.col("value")).alias("asDouble"), F.when(F.col("event_id") % 2 == 1, F.col("event_id").cast("string")).alias("asInt"), _tagged(id=("event_id", "intValue")).alias("attributes")))
    is_gauge = F.col("event_type") == "click"
    record = F.struct(F.col("event_type").alias("name"), F.when(is_gauge, F.struct(point.alias("dataPoints"))).alias("gauge"), F.when(~is_gauge, F.struct(point.alias("dataPoints"), F.lit("2").alias("aggregationTemporality"), F.lit(True).alias("isMonotonic"))).alias("sum"))
    return _document(t(spark, sf, "events"), "resourceMetrics", "scopeMetrics", "metrics", record)


def _trace_documents(spark, sf):
    event = F.array(F.struct(_nanos("ts").alias("timeUnixNano"), F.col("event_type").alias("name")))
    record = F.struct(F.lpad(F.hex("event_id"), 32, "0").alias("traceId"), F.lpad(F.hex("event_id"), 16, "0").alias("spanId"), F.col("event_type").alias("name"), F.lit("SPAN_KIND_SERVER").alias("kind"), _nanos("ts").alias("startTimeUnixNano"), _nanos(F.col("ts") + F.expr("make_dt_interval(0, 0, 0, event_id % 10)")).alias("endTimeUnixNano"), event.alias("events"), F.struct(F.lit(2).alias("code")).alias("status"))
    return _document(t(spark, sf, "events"), "resourceSpans", "scopeSpans", "spans", record)


@registered("t1_flatten_logs", "SELECT CAST(user_id AS VARCHAR) AS user, event_id, ts, event_type, props AS body, 'shop' AS scope FROM events")
def _(spark, sf):
    x = O.flatten_logs(_log_documents(spark, sf))
    return x.select(F.element_at("resource", "user").alias("user"), F.element_at("attributes", "id").cast("long").alias("event_id"), "ts", F.element_at("attributes", "type").alias("event_type"), F.col("body_text").alias("body"), F.col("scope_name").alias("scope"))


@registered("t2_flatten_datapoints", """
SELECT event_id, event_type AS metric_name, CASE WHEN event_type = 'click' THEN 'gauge' ELSE 'sum' END AS metric_type, CASE WHEN event_type <> 'click' THEN 'cumulative' END AS temporality,
 CASE WHEN event_id % 2 = 0 THEN value ELSE event_id END AS value FROM events""")
def _(spark, sf):
    x = O.flatten_datapoints(_metric_documents(spark, sf))
    return x.select(F.element_at("attributes", "id").cast("long").alias("event_id"), "metric_name", "metric_type", "temporality", "value")


@registered("t3_flatten_spans", "SELECT printf('%016X', event_id) AS span_id, event_type AS name, 'Server' AS kind, 'Error' AS status_code, (event_id % 10) * 1000 AS span_duration_ms FROM events")
def _(spark, sf):
    return O.flatten_spans(_trace_documents(spark, sf)).select("span_id", "name", "kind", "status_code", "span_duration_ms")


@registered("k2_lake_rows", "SELECT strftime(ts, '%Y%m%d') AS event_day, CASE event_type WHEN 'click' THEN 'clicks' ELSE 'views' END AS source, count(*) AS n FROM events WHERE event_type IN ('click', 'view') GROUP BY 1, 2")
def _(spark, sf):
    uid = F.expr("case event_type when 'click' then 3001 when 'view' then 3002 else 9 end")
    e = t(spark, sf, "events").select(F.to_json(F.struct(uid.alias("class_uid"), F.unix_millis(F.col("ts").cast("timestamp")).alias("time"))).alias("body_text"))
    return K.lake_rows(e, {3001: "clicks", 3002: "views"})[0].groupBy("event_day", "source").agg(F.count("*").alias("n"))


@registered("k3_warehouse_logs", """SELECT '{"user":"' || user_id || '"}' AS "ResourceAttributes", ts AS "Timestamp", props AS "Body", 9 AS "SeverityNumber" FROM events""")
def _(spark, sf):
    return K.warehouse_logs(O.flatten_logs(_log_documents(spark, sf))).select("ResourceAttributes", "Timestamp", "Body", "SeverityNumber")


@registered("k4_warehouse_spans", """SELECT printf('%032X', event_id) AS "TraceID", ts AS "StartTime", '["' || event_type || '"]' AS "EventNames", '[]' AS "LinkSpanID" FROM events""")
def _(spark, sf):
    return K.warehouse_spans(O.flatten_spans(_trace_documents(spark, sf))).select("TraceID", "StartTime", "EventNames", "LinkSpanID")


@registered("k5_warehouse_metrics", """SELECT 'gauge' AS suffix, event_type AS "MetricName", CASE WHEN event_id % 2 = 0 THEN value ELSE event_id END AS "Value" FROM events WHERE event_type = 'click'
UNION ALL SELECT 'sum', event_type, CASE WHEN event_id % 2 = 0 THEN value ELSE event_id END FROM events WHERE event_type <> 'click'""")
def _(spark, sf):
    tables = K.warehouse_metrics(O.flatten_datapoints(_metric_documents(spark, sf)))
    parts = [tables[s].select(F.lit(s).alias("suffix"), "MetricName", "Value") for s in ("gauge", "sum")]
    return parts[0].unionByName(parts[1])


@registered("k7_json_arrays", "SELECT o_orderstatus, o_orderkey, o_custkey FROM orders")
def json_arrays(spark, sf):
    a = K.json_arrays(t(spark, sf, "orders").select("o_orderstatus", "o_orderkey", "o_custkey"), ["o_orderstatus"], 100)
    return a.select("o_orderstatus", F.inline(F.from_json("body", "array<struct<o_orderkey:bigint,o_custkey:bigint>>")))


@registered("k2a_class_schemas", "SELECT 'signin' AS source, 3002 AS class_uid, epoch_us(ts) // 1000 AS time, user_id AS uid, event_type AS activity FROM events")
def typed_lake(spark, sf):
    """Events written to the lake with the columns of their class, and read back."""
    schemas = K.class_schemas('{"3002": "time bigint, activity_name string, user struct<uid: bigint>"}')
    e = t(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    event = F.struct(F.lit(3002).alias("class_uid"), F.unix_millis("ts").alias("time"), F.col("event_type").alias("activity_name"), F.struct(F.col("user_id").alias("uid")).alias("user"))
    rows, _ = K.lake_rows(e.select(F.to_json(event).alias("body_text")), {3002: "signin"})
    path = shared_path(spark, "lake")
    K.write_lake(rows, path, "r1", "a1", schemas, file_rows=20_000)
    return spark.read.parquet(path).select(F.col("ext").alias("source"), F.col("class_uid").cast("int").alias("class_uid"), "time", F.col("event.user.uid").alias("uid"), F.col("event.activity_name").alias("activity"))


# ---------------------------------------------------------------- vendor records


@registered("s20_okta_logs", "SELECT event_id, ts, event_type AS displayMessage, 'u' || user_id AS actor FROM events")
def _(spark, sf):
    e = dealt(spark, sf, "events")
    j = F.to_json(F.struct(F.col("event_id").cast("string").alias("uuid"), F.col("event_type").alias("displayMessage"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("published"), F.struct(F.concat(F.lit("u"), "user_id").alias("id")).alias("actor")))
    x = V.okta_logs(e.select(j.alias("j")), "j", "example.com")
    return x.select(F.element_at("attributes", "uuid").cast("long").alias("event_id"), "ts", F.element_at("attributes", "displayMessage").alias("displayMessage"), F.element_at("attributes", "actor.id").alias("actor"))


@registered("s21_m365_logs", """
SELECT event_id, ['Regular', 'Reserved', 'Admin', 'DcAdmin', 'System', 'Application', 'ServicePrincipal', 'CustomPolicy', 'SystemPolicy', 'unknown'][event_id % 10 + 1] AS user_type,
 CASE WHEN event_id % 2 = 0 THEN 'a' || event_id END AS alert, CASE WHEN event_id % 2 = 0 THEN 'n' || event_id END AS alert_name,
 CASE WHEN event_id % 2 = 1 THEN 'u' || event_id END AS url, ['Pending', 'Timeout', 'Error', 'Good', 'Bad', 'unknown'][event_id % 6 + 1] AS verdict,
 '[{"actor.id":"' || user_id || '","actor.type":"' || ['Claim', 'Name', 'Other', 'PUID', 'SPN', 'UPN', 'unknown'][event_id % 7 + 1] || '"}]' AS actors FROM events""")
def office_audit(spark, sf):
    n, even = F.col("event_id"), F.col("event_id") % 2 == 0
    j = F.to_json(F.struct(
        n.alias("Id"), (n % 10).alias("UserType"), F.when(even, F.concat(F.lit("a"), n)).otherwise("").alias("AlertId"), F.concat(F.lit("n"), n).alias("Name"),
        F.when(even, 20).otherwise(41).alias("RecordType"), F.concat(F.lit("u"), n).alias("URL"), F.struct((n % 6 - 3).alias("FileVerdict")).alias("FileData"),
        F.array(F.struct(F.col("user_id").cast("string").alias("ID"), (n % 7).alias("Type"))).alias("Actor"),
    ))
    x = V.m365_logs(dealt(spark, sf, "events").select(j.alias("j")), "j", "general", "t1")
    at = lambda k: F.try_element_at("attributes", F.lit(k))
    return x.select(
        at("id").cast("long").alias("event_id"), at("user.type").alias("user_type"), at("security.alert.id").alias("alert"), at("security.alert.name").alias("alert_name"),
        at("defender.url.url").alias("url"), at("defender.file.verdict").alias("verdict"), at("azure.actors").alias("actors"),
    )


@registered("s22_audit_logs", "SELECT CAST(event_id AS VARCHAR) AS id, event_type AS action, CAST(user_id AS VARCHAR) AS account FROM events")
def _(spark, sf):
    x = V.audit_logs(dealt(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("ts").alias("timestamp"), F.col("event_type").alias("action"), F.col("user_id").alias("account"), F.col("props").alias("description")))
    return x.select(F.element_at("attributes", "id").alias("id"), F.element_at("attributes", "action").alias("action"), F.element_at("resource", "account").alias("account"))


@registered("s23_usage_metrics", "SELECT 'sharepoint.files' AS metric_name, CAST(sum(o_custkey) AS BIGINT) AS total FROM orders UNION ALL SELECT 'sharepoint.files.active', CAST(sum(o_orderkey) AS BIGINT) FROM orders WHERE o_orderkey % 2 = 0")
def _(spark, sf):
    o = t(spark, sf, "orders").select("o_orderdate", "o_orderstatus", F.col("o_custkey").cast("string").alias("files"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey").cast("string")).otherwise("").alias("active"))
    return V.usage_metrics(o, "sharepoint_files").groupBy("metric_name").agg(F.sum("value").alias("total"))


@registered("s24_neuron_metrics", """
SELECT event_id, 'aws.neuron.neuroncore.utilization' AS metric_name, value / 100 AS value FROM events UNION ALL SELECT event_id, 'aws.neuron.execution.count', user_id FROM events
UNION ALL SELECT event_id, 'aws.neuron.errors', event_id FROM events""")
def _(spark, sf):
    core = F.create_map(F.lit("0"), F.struct(F.col("value").alias("neuroncore_utilization")), F.lit("x"), F.struct(F.col("value").alias("neuroncore_utilization")))
    report = F.struct(F.struct(core.alias("neuroncores_in_use")).alias("neuroncore_counters"), F.struct(F.create_map(F.lit("completed"), F.col("user_id")).alias("execution_summary")).alias("execution_stats"))
    devices = F.struct(F.struct(F.array(F.struct(F.lit(0).alias("neuron_device_index"), F.col("event_id").alias("mem_ecc_corrected"))).alias("neuron_devices")).alias("neuron_hw_counters"))
    j = F.to_json(F.struct(F.array(F.struct(report.alias("report"))).alias("neuron_runtime_data"), devices.alias("system_data")))
    return V.neuron_metrics(dealt(spark, sf, "events").select("event_id", j.alias("j")), "j").select("event_id", "metric_name", "value")


@registered("s25_table_metrics", "SELECT CAST(c_nationkey AS VARCHAR) AS nation, 'balance' AS metric_name, count(*) AS n FROM customer WHERE c_acctbal >= 0 GROUP BY 1")
def _(spark, sf):
    x = V.table_metrics(t(spark, sf, "customer"), {"balance": "c_acctbal"}, ["c_nationkey"])
    return x.groupBy(F.element_at("attributes", "c_nationkey").alias("nation"), "metric_name").agg(F.count("*").alias("n"))


@registered("s26_packets", """
SELECT user_id, event_id % 60 AS sec, '10.0.0.' || (user_id % 250) AS src_address, CAST(event_id % 60000 + 300 AS INT) AS src_port, '10.0.1.9' AS dst_address, 'TCP' AS transport, 8 AS length, count(*) AS n FROM events GROUP BY ALL""")
def _(spark, sf):
    e = t(spark, sf, "events")
    head = F.format_string("12:00:%02d.000001 IP 10.0.0.%d.%d > 10.0.1.9.443: Flags [S], length 0", F.col("event_id") % 60, F.col("user_id") % 250, F.col("event_id") % 60000 + 300)
    lines = e.select(F.concat_ws("-", "user_id", F.floor(F.col("event_id") / 1000)).alias("capture"), F.posexplode(F.array(head, F.lit("\t0x0000:  4500 003c"), F.lit("\t0x0004:  1c46 4000"))).alias("pos", "line"), (F.col("event_id") * 3).alias("base"))
    p = V.parse_packets(lines.select("capture", (F.col("base") + F.col("pos")).alias("n"), "line"), "capture", "n", "line", "2024-01-01")
    return p.groupBy(F.substring_index("capture", "-", 1).cast("long").alias("user_id"), F.second("ts").cast("long").alias("sec"), "src_address", "src_port", "dst_address", "transport", F.col("length").cast("int").alias("length")).agg(F.count("*").alias("n"))


@registered("s27_sql_metrics", "SELECT o_orderstatus AS status, 'orders.count' AS metric_name, CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY 1")
def _(spark, sf):
    t(spark, sf, "orders").createOrReplaceTempView("sql_metric_orders")
    x = V.sql_metrics(spark, "SELECT o_orderstatus, count(*) AS n FROM sql_metric_orders GROUP BY 1", {"orders.count": "n"}, ["o_orderstatus"])
    return x.select(F.element_at("attributes", "o_orderstatus").alias("status"), "metric_name", "value")


@registered("s19_payload_logs", "SELECT event_id FROM events")
def _(spark, sf):
    body = F.to_json(F.collect_list(F.struct("event_id")))
    p = t(spark, sf, "events").groupBy("user_id", F.floor(F.col("event_id") / 20).alias("g")).agg(body.alias("b")).select("b", F.lit("application/json").alias("type"))
    return S.payload_logs(p, "b", "type").select(F.get_json_object("record", "$.event_id").cast("long").alias("event_id"))


# ---------------------------------------------------------------- log formats


@registered("l_apache_combined", """
SELECT event_id, ts - INTERVAL '1 microsecond' * (epoch_us(ts) % 1000000) AS ts, CASE event_id % 3 WHEN 0 THEN 9 WHEN 1 THEN 13 ELSE 17 END AS severity_number, '/' || event_type AS path FROM events""")
def _(spark, sf):
    e = t(spark, sf, "events")
    status = F.element_at(F.array(F.lit("200"), F.lit("404"), F.lit("500")), (F.col("event_id") % 3 + 1).cast("int"))
    line = F.concat(F.lit("10.0.0.1 - u ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' +0000] "GET /'), "event_type", F.lit(' HTTP/1.1" '), status, F.lit(" "), F.col("event_id").cast("string"), F.lit(' "-" "agent"'))
    x = P.parse_logs(e.select(line.alias("body_text")), "apache_combined_logs")
    return x.select(F.element_at("fields", "body_bytes_sent").cast("long").alias("event_id"), "ts", "severity_number", F.element_at("fields", "path").alias("path"))


@registered("l_kafka", """
SELECT event_id, time_bucket(INTERVAL '1 millisecond', ts) AS ts, CASE WHEN value < 50 THEN 9 ELSE 17 END AS severity_number FROM events WHERE event_type <> 'view'""")
def _(spark, sf):
    line = F.concat(F.lit("["), F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS"), F.lit("] "), F.when(F.col("value") < 50, "INFO").otherwise("ERROR"), F.lit(" "), F.col("event_id").cast("string"))
    e = t(spark, sf, "events").select(F.when(F.col("event_type") == "view", F.col("props")).otherwise(line).alias("body_text"))
    x = P.parse_logs(e, "kafka_logs").where("fields is not null")
    return x.select(F.element_at("fields", "message").cast("long").alias("event_id"), "ts", "severity_number")


#: For each format: how its lines are written from the time, a level and a message, its words for three levels, the precision of its
#: times, and the field that holds the message.
TEN_FORMATS = {
    "hadoop_logs": ("%(yyyy-MM-dd HH:mm:ss)s,123 %(level)s a.B: %(text)s", ("INFO", "WARN", "ERROR"), "second", "message"),
    "apache_cassandra_logs": ("%(level)s [main] %(yyyy-MM-dd HH:mm:ss,SSS)s %(text)s", ("INFO", "WARN", "ERROR"), "millisecond", "message"),
    "wildfly_logs": ("%(yyyy-MM-dd HH:mm:ss,SSS)s %(level)s [a.b] (t) %(text)s", ("INFO", "WARN", "ERROR"), "millisecond", "message"),
    "zookeeper_logs": ("%(yyyy-MM-dd HH:mm:ss,SSS)s [myid:1] - %(level)s [a:b:S@1] - %(text)s", ("INFO", "WARN", "ERROR"), "millisecond", "message"),
    "postgresql_logs": ("%(yyyy-MM-dd HH:mm:ss.SSS)s UTC [9] u@d %(level)s:  %(text)s", ("LOG", "WARNING", "ERROR"), "millisecond", "message"),
    "pgbouncer_logs": ("%(yyyy-MM-dd HH:mm:ss.SSS)s UTC [9] %(level)s %(text)s", ("LOG", "WARNING", "ERROR"), "millisecond", "message"),
    "mysql_logs": ("%(yyyy-MM-dd'T'HH:mm:ss.SSSSSS)sZ 7 [%(level)s] %(text)s", ("Note", "Warning", "Error"), "microsecond", "message"),
    "rabbitmq_logs": ("%(yyyy-MM-dd HH:mm:ss.SSSSSS)s+00:00 [%(level)s] <0.1.0> %(text)s", ("info", "warning", "error"), "microsecond", "message"),
    "mongodb_logs": ("%(yyyy-MM-dd'T'HH:mm:ss.SSS)s+0000 %(level)s NETWORK  [conn1] %(text)s", ("I", "W", "E"), "millisecond", "message"),
    "iis_logs": ("%(yyyy-MM-dd HH:mm:ss)s 10.0.0.1 GET %(text)s - 80 - 10.0.0.2 agent - %(level)s 0 0 12", ("200", "404", "500"), "second", "cs_uri_stem"),
}


def _line(layout: str, level: Column) -> Column:
    """A line of one of TEN_FORMATS for each event."""
    parts = re.split(r"%\((.*?)\)s", layout)
    value = {"level": level, "text": F.col("event_type")}
    return F.concat(*[F.lit(x) if i % 2 == 0 else value.get(x, F.date_format("ts", x)) for i, x in enumerate(parts)])


@registered("l3_ten_formats", f"""
SELECT format, event_id, date_trunc(kind, ts) AS ts, CASE event_id % 3 WHEN 0 THEN CASE format WHEN 'mysql_logs' THEN 10 ELSE 9 END WHEN 1 THEN 13 ELSE 17 END AS severity_number, event_type AS message
FROM events, (VALUES {", ".join(f"('{n}', '{kind}')" for n, (_, _, kind, _) in TEN_FORMATS.items())}) AS f(format, kind)""")
def _(spark, sf):
    parts = []
    for name, (layout, levels, _, text) in TEN_FORMATS.items():
        level = F.element_at(F.array(*[F.lit(x) for x in levels]), (F.col("event_id") % 3 + 1).cast("int"))
        x = P.parse_logs(dealt(spark, sf, "events").select("event_id", _line(layout, level).alias("body_text")), name)
        parts.append(x.select(F.lit(name).alias("format"), "event_id", "ts", "severity_number", F.element_at("fields", text).alias("message")))
    return functools.reduce(DataFrame.unionAll, parts)


@registered("l7_syslog", """
SELECT event_id, CAST(event_id % 192 // 8 AS INT) AS facility, CAST(event_id % 192 % 8 AS INT) AS severity, 'h' || user_id AS host, CASE WHEN event_id % 2 = 0 THEN event_type END AS msgid FROM events""")
def _(spark, sf):
    pri = F.concat(F.lit("<"), (F.col("event_id") % 192).cast("string"), F.lit(">"))
    new = F.concat(pri, F.lit("1 2024-01-02T03:04:05Z h"), "user_id", F.lit(" app 7 "), "event_type", F.lit(" - "), F.col("event_id").cast("string"))
    old = F.concat(pri, F.lit("Jan  2 03:04:05 h"), "user_id", F.lit(" app[7]: "), F.col("event_id").cast("string"))
    e = t(spark, sf, "events").select(F.when(F.col("event_id") % 2 == 0, new).otherwise(old).alias("line"))
    return P.syslog_parse(e, "line").select(F.col("syslog.message").cast("long").alias("event_id"), "syslog.facility", "syslog.severity", "syslog.host", "syslog.msgid")


@registered("l12_change_fields", "SELECT event_id, event_type AS kind, CASE WHEN value > 50 THEN 'high' END AS size, CASE WHEN json_extract_string(props, '$.k') IS NULL THEN 2 ELSE 3 END + CASE WHEN value > 50 THEN 1 ELSE 0 END - 1 AS n FROM events")
def _(spark, sf):
    e = event_logs(spark, sf).withColumn("attributes", F.map_filter("attributes", lambda _, v: v.isNotNull()))
    x = P.change_fields(e, [("move", "type", "kind"), ("copy", "none", "x"), (("add", "size", "'high'"), "value > 50"), ("copy", "k", "kk"), ("remove", "k"), ("add", "gone", "1"), ("retain", "kind", "size", "kk")])
    return x.select("event_id", F.element_at("attributes", "kind").alias("kind"), F.try_element_at("attributes", F.lit("size")).alias("size"), F.size("attributes").alias("n"))


@registered("l_common_event_format", """
SELECT event_id, event_type AS name, CASE WHEN event_id % 11 <= 3 THEN 9 WHEN event_id % 11 <= 6 THEN 13 WHEN event_id % 11 <= 8 THEN 17 ELSE 21 END AS severity_number FROM events""")
def _(spark, sf):
    line = F.concat(F.lit("Jan  2 03:04:05 h CEF:0|shop|web|1|"), "event_id", F.lit("|"), "event_type", F.lit("|"), (F.col("event_id") % 11).cast("string"), F.lit("|user="), "user_id")
    x = P.parse_logs(dealt(spark, sf, "events").select(line.alias("body_text")), "common_event_format_logs")
    return x.select(F.element_at("fields", "signature_id").cast("long").alias("event_id"), F.element_at("fields", "name").alias("name"), "severity_number")


def _mixed_logs(spark, sf):
    """Each event as a JSON object and as a line of an access log."""
    clf = F.concat(F.lit('10.0.0.1 - - [x] "GET /'), "event_type", F.lit("/"), "event_id", F.lit('?q=1 HTTP/1.1" 200 '), "user_id")
    both = F.array(F.to_json(F.struct("event_id", "event_type")), clf)
    return dealt(spark, sf, "events").select("event_id", F.explode(both).alias("log"))


@registered("l1_fingerprint", """
SELECT 'json' AS form, event_type, 1 AS n_fingerprints FROM events GROUP BY 2 UNION ALL SELECT 'clf', event_type, 1 FROM events GROUP BY 2""")
def _(spark, sf):
    clf = F.concat(F.lit('10.0.0.1 - - [x] "GET /'), "event_type", F.lit("/"), "event_id", F.lit('?q=1 HTTP/1.1" 200 '), "user_id")
    e = dealt(spark, sf, "events").select("event_type", F.explode(F.create_map(F.lit("json"), F.to_json(F.struct("event_id", "ts", "event_type")), F.lit("clf"), clf)).alias("form", "log"))
    return e.groupBy("form", "event_type").agg(F.count_distinct(L.fingerprint("log")).cast("int").alias("n_fingerprints"))


@registered("l4_json_parse", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def _(spark, sf):
    return L.json_parse(t(spark, sf, "events"), "props", "k bigint").select("event_id", "parsed.k")


@registered("l5_delimited_parse", """SELECT event_id, event_type || '"|"x' AS kind, user_id AS user FROM events""")
def _(spark, sf):
    line = F.concat(F.col("event_id").cast("string"), F.lit('|"'), "event_type", F.lit('\\"|\\"x"|'), "user_id")
    x = L.delimited_parse(t(spark, sf, "events").select(line.alias("l")), "l", "id|kind|user", "|")
    return x.select(F.element_at("parsed", "id").cast("long").alias("event_id"), F.element_at("parsed", "kind").alias("kind"), F.element_at("parsed", "user").cast("long").alias("user"))


@registered("l5_headed_parse", "SELECT event_id, CASE WHEN event_id % 1000 < 500 THEN event_type END AS kind, CASE WHEN event_id % 1000 >= 500 THEN event_type END AS type FROM events")
def _(spark, sf):
    e = t(spark, sf, "events").select(F.floor(F.col("event_id") / 1000).alias("file"), (F.col("event_id") % 1000 * 2 + 1).alias("n"), F.concat_ws(" ", "event_id", "event_type").alias("line"))
    heads = e.select("file", F.explode(F.array(F.struct(F.lit(0).cast("long").alias("n"), F.lit("#Fields: id kind").alias("line")), F.struct(F.lit(1000).cast("long").alias("n"), F.lit("#Fields: id type").alias("line")))).alias("h")).select("file", "h.*").distinct()
    x = L.headed_parse(e.unionByName(heads), "line", "file", "n")
    return x.select(F.element_at("parsed", "id").cast("long").alias("event_id"), F.try_element_at("parsed", F.lit("kind")).alias("kind"), F.try_element_at("parsed", F.lit("type")).alias("type"))


@registered("l6_uri_parse", "SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages")
def _(spark, sf):
    return L.uri_parse(t(spark, sf, "pages"), "url").select("page_id", "uri.scheme", "uri.host")


@registered("l9_recombine", "SELECT conv_id, count(*) FILTER (role = 'assistant') + CASE WHEN arg_max(role, struct_pack(a := turn, b := role)) = 'assistant' THEN 0 ELSE 1 END AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations WHERE text IS NOT NULL GROUP BY 1")
def _(spark, sf):
    c = t(spark, sf, "conversations").where("text is not null").withColumn("at", F.struct("turn", "role", "text"))
    return L.recombine(c, "conv_id", "role = 'assistant'", "text", "at").groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@registered("l10_time_parse", "SELECT event_id, date_trunc('second', ts) - INTERVAL '5 hours' AS ts FROM events")
def _(spark, sf):
    e = t(spark, sf, "events").select("event_id", F.date_format("ts", "dd/MMM/yyyy HH:mm:ss").alias("text"))
    return L.time_parse(e, "text", "dd/MMM/yyyy HH:mm:ss", "+05:00").select("event_id", "ts")


# ---------------------------------------------------------------- more landing, delivery bodies


@registered("s1_read_range", "SELECT event_id, ts FROM events WHERE ts >= date_trunc('hour', (SELECT min(ts) FROM events) + INTERVAL '1 day') AND ts < date_trunc('hour', (SELECT min(ts) FROM events) + INTERVAL '3 days') + INTERVAL '1 hour'")
def _(spark, sf):
    from datetime import timedelta

    path, e = shared_path(spark, "landed"), t(spark, sf, "events").select("event_id", "ts")
    S.write_partitioned(e.repartition(F.date_trunc("hour", "ts")), path)
    first = e.agg(F.min("ts")).first()[0]
    return S.read_partitioned(spark, path, first + timedelta(days=1), first + timedelta(days=3), "event_id long, ts timestamp").select("event_id", "ts")


@registered("s3_path_time", "SELECT event_id, date_trunc('hour', ts) AS path_ts FROM events")
def _(spark, sf):
    e = t(spark, sf, "events").select("event_id", F.concat(F.lit("logs/"), F.date_format("ts", "yyyy/MM/dd'T'HH"), F.lit("/x.json")).alias("p"))
    return S.with_path_time(e, "logs/{year}/{month}/{day}T{hour}", path=F.col("p")).select("event_id", "path_ts")


@registered("s12_object_manifest", "SELECT 'logs' AS bucket, 'a b/' || event_id || '+.json' AS key, event_id AS size FROM events WHERE event_type = 'click'")
def _(spark, sf):
    o = F.struct(F.struct(F.lit("logs").alias("name")).alias("bucket"), F.struct(F.concat(F.lit("a%20b/"), "event_id", F.lit("+.json")).alias("key"), F.col("event_id").alias("size")).alias("object"))
    r = F.array(F.struct(F.when(F.col("event_type") == "click", "ObjectCreated:Put").otherwise("ObjectRemoved:Delete").alias("eventName"), o.alias("s3")))
    plain = F.to_json(F.struct(r.alias("Records")))
    e = t(spark, sf, "events").select(F.when(F.col("event_id") % 2 == 0, plain).otherwise(F.to_json(F.struct(plain.alias("Message")))).alias("j"))
    return S.object_manifest(e, "j", "^logs$", r"\.json$").select("bucket", "key", "size")


@registered("s14_explode_pages", "SELECT event_id FROM events")
def _(spark, sf):
    g = t(spark, sf, "events").groupBy("user_id", F.floor(F.col("event_id") / 100).alias("h")).agg(F.collect_list(F.struct("event_id")).alias("c"))
    page = g.select(F.to_json(F.struct(F.struct(F.array(F.struct("c")).alias("b")).alias("a"))).alias("j"))
    return S.explode_pages(page, "j", "a.b[0].c").select(F.get_json_object("record", "$.event_id").cast("long").alias("event_id"))


@registered("s15_ndjson_pages", "SELECT event_id, user_id FROM events")
def _(spark, sf):
    g = t(spark, sf, "events").groupBy("user_id", F.floor(F.col("event_id") / 100).alias("h")).agg(F.collect_list(F.to_json(F.struct("event_id"))).alias("l"))
    page = g.select(F.concat(F.array_join("l", "\n"), F.lit("\n"), F.to_json(F.struct("user_id")), F.lit("\n")).alias("p"))
    x = S.explode_ndjson_page(page, "p", metadata_last=True)
    return x.select(F.get_json_object("record", "$.event_id").cast("long").alias("event_id"), F.get_json_object("metadata", "$.user_id").cast("long").alias("user_id"))


@registered("k8_lines", "SELECT md5(replace(replace(text, chr(10), ' '), chr(13), ' ')) AS h FROM documents WHERE text IS NOT NULL")
def _(spark, sf):
    path = shared_path(spark, "lines")
    S.write_lines(t(spark, sf, "documents").select(F.regexp_replace("text", r"[\r\n]", " ").alias("line")), path, "line")
    return spark.read.text(path).select(F.md5("value").alias("h"))


@registered("r4_raw_log", "SELECT event_id, CASE WHEN event_type = 'click' THEN NULL ELSE event_type END AS type, CAST(user_id AS VARCHAR) AS user FROM events")
def _(spark, sf):
    x = R.raw_log(event_logs(spark, sf).withColumn("body", F.col("event_id")).withColumn("attributes", F.map_filter("attributes", lambda _, v: v != "click")))
    at = lambda p: F.get_json_object("raw", f"$.{p}")
    return x.select(at("body").cast("long").alias("event_id"), at("attributes.type").alias("type"), at("resource_attributes.user").alias("user"))


@registered("r7_webhook_rows", """SELECT CASE WHEN event_id % 2 = 0 THEN props ELSE '"' || event_type || '"' END AS payload FROM events""")
def _(spark, sf):
    e = t(spark, sf, "events").select(F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(F.col("event_type")).alias("body_text"))
    return R.webhook_rows(e)


@registered("t8_event_time", "SELECT event_id, CASE WHEN event_type = 'click' THEN ts + INTERVAL '1 second' ELSE ts END AS event_ts FROM events")
def _(spark, sf):
    e = t(spark, sf, "events").withColumns({"observed_ts": F.col("ts") + F.expr("interval 1 second"), "ts": F.when(F.col("event_type") != "click", F.col("ts"))})
    return R.event_time(e).select("event_id", "event_ts")


# ---------------------------------------------------------------- streams


def _landed_stream(spark, sf, files=4):
    """Events landed as files, and the stream that reads two of these at a time."""
    path = shared_path(spark, "landed")
    t(spark, sf, "events").repartition(files).write.options(**S.TIME_LAYOUT).json(path)
    return S.stream_landing(spark, path, "event_id long, ts timestamp, user_id long, event_type string, value double, props string", 2)


@registered("st_a1_counts", "SELECT time_bucket(INTERVAL '1 hour', ts) AS start_ts, event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2")
def _(spark, sf):
    path = shared_path(spark, "counts")
    Q.keep_sums(_landed_stream(spark, sf), path, shared_path(spark, "commits"), ["event_type"], "1 hour")
    return Q.sums(spark, path, ["event_type"])


@registered("st_a6_latest", "SELECT user_id, max(ts) AS last_seen FROM events WHERE user_id IS NOT NULL GROUP BY 1")
def _(spark, sf):
    path = shared_path(spark, "latest")
    Q.keep_latest(_landed_stream(spark, sf), path, shared_path(spark, "commits"), ["user_id"])
    return Q.latest(spark, path, ["user_id"])


@registered("st_enrich_filter", "SELECT event_id, c_name FROM events LEFT JOIN customer ON user_id = c_custkey WHERE event_type = 'click'")
def _(spark, sf):
    path, ref = shared_path(spark, "enriched"), t(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name")
    clicks = X.match(_landed_stream(spark, sf), "event_type = 'click'")
    Q.keep_rows(J.lookup(clicks, ref, "user_id", "c_custkey").select("event_id", "c_name"), path, shared_path(spark, "commits"))
    return spark.read.parquet(path)


@registered("st_s13_dedup", "SELECT event_id FROM events")
def _(spark, sf):
    path, s = shared_path(spark, "deduped"), _landed_stream(spark, sf)
    twice = s.select("event_id", "ts", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))
    Q.keep_rows(S.dedup_objects(twice, ["event_id"], "365 days", "ts").select("event_id"), path, shared_path(spark, "commits"))
    return spark.read.parquet(path)


from tellurion.plans import graph_queries as _graph_queries  # noqa: E402, F401  (registers its queries)
from tellurion.plans import shape_queries as _shape_queries  # noqa: E402, F401
from tellurion.plans import landed_queries as _landed_queries  # noqa: E402, F401
