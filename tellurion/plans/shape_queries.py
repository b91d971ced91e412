"""Queries over manifests, pages, labels, delivery rows, nested masks, hashes, exact samples and long ordered tables, with twins."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tellurion.functions.hashes import fnv1a
from tellurion.functions.shared import shared_path
from tellurion.operators import aggregates as A
from tellurion.operators import filters as X
from tellurion.operators import parse as L
from tellurion.operators import rewrite as R
from tellurion.operators import standardize as N
from tellurion.plans.catalog import registered, t
from tellurion.sources import landing as S


@registered("s12_file_drops", """
SELECT 'drops' AS bucket, event_type || '/a b+' || event_id || '.gz' AS key, user_id AS size, date_trunc('millisecond', ts) AS event_ts FROM events
UNION ALL SELECT 'drops', event_type || '/second', 1, date_trunc('millisecond', ts) FROM events""")
def file_drops(spark, sf):
    path = F.concat("event_type", F.lit("/a%20b+"), F.col("event_id").cast("string"), F.lit(".gz"))
    second = F.struct(F.concat("event_type", F.lit("/second")).alias("path"), F.lit(1).cast("long").alias("size"), F.lit("c").alias("checksum"))
    files = F.array(F.struct(path.alias("path"), F.col("user_id").cast("long").alias("size"), F.lit("c").alias("checksum")), second)
    drop = F.to_json(F.struct(F.lit("c").alias("cid"), F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"), F.lit(2).alias("fileCount"), F.lit("drops").alias("bucket"), F.lit("p").alias("pathPrefix"), files.alias("files")))
    return S.object_manifest(t(spark, sf, "events").select(drop.alias("j")), "j").select("bucket", "key", "size", "event_ts")


@registered("s14_pages_without_path", "SELECT event_id, event_id % 3 AS kind FROM events")
def pages_without_path(spark, sf):
    """Pages that are arrays, that hold `data`, and whose only array has another name beside plain fields and texts like arrays."""
    e = t(spark, sf, "events")
    item = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"kind":'), (F.col("event_id") % 3).cast("string"), F.lit("}"))
    page = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(" [7,"), item, F.lit("]"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"a":[{"event_id":-1}],"data":['), item, F.lit(',"x"]}')))
    page = page.otherwise(F.concat(F.lit('{"a":"[1]","n":{"data":[1]},"rows":['), item, F.lit("]}")))
    out = S.explode_pages(e.select(page.alias("j")), "j")
    return out.select(*[F.get_json_object("record", f"$.{c}").cast("long").alias(c) for c in ("event_id", "kind")])


@registered("r5_spread_labels", """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type ELSE 'prod' END AS env, CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR) END AS team,
       'u' || user_id AS "user", CASE WHEN event_id % 2 = 1 THEN '{"env":1}' END AS raw FROM events""")
def spread_labels(spark, sf):
    e = t(spark, sf, "events")
    given = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"env":"'), "event_type", F.lit('","team":"'), F.col("user_id").cast("string"), F.lit('"}'))).otherwise('{"env":1}')
    attrs = F.create_map(F.lit('label["raw"]'), given, F.lit('label["user"]'), F.concat(F.lit("u"), F.col("user_id").cast("string")), F.lit("other"), F.lit("x"))
    out = R.ingestion_labels(e.withColumn("attributes", attrs), {"env": "prod"}, "label")
    return out.select("event_id", *[F.try_element_at("labels", F.lit(n)).alias(n) for n in ("env", "team", "user", "raw")])


@registered("r6_sentinel_entries", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS time, event_type AS kind, CASE WHEN event_id % 2 = 0 THEN printf('%032x', event_id + 1) END AS trace, 9 AS severity FROM events""")
def sentinel_entries(spark, sf):
    body = F.create_map(F.lit("kind"), F.col("event_type"), F.lit("event_id"), F.col("event_id").cast("string"), F.lit("TimeGenerated"), F.lit("mine"))
    trace = F.when(F.col("event_id") % 2 == 0, F.lower(F.lpad(F.hex(F.col("event_id") + 1), 32, "0"))).otherwise("0" * 32)
    e = t(spark, sf, "events").select("ts", body.alias("body"), trace.alias("trace_id"), F.lit("0" * 16).alias("span_id"), F.lit(9).alias("severity_number"))
    at = lambda name: F.get_json_object("entry", f"$.{name}")
    out = R.sentinel_entries(e).where(at("SpanId").isNull())
    return out.select(at("event_id").cast("long").alias("event_id"), at("TimeGenerated").alias("time"), at("kind").alias("kind"), at("TraceId").alias("trace"), at("SeverityNumber").cast("int").alias("severity"))


@registered("r7_webhook_arrays", "SELECT event_id FROM events")
def webhook_arrays(spark, sf):
    arrays = R.webhook_rows(t(spark, sf, "events").select(F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit("}")).alias("body_text")), rows=100)
    return arrays.select(F.explode(F.from_json("payload", "array<struct<id:long>>")).alias("r")).select(F.col("r.id").alias("event_id"))


@registered("r1_mask_nested", """
SELECT event_id, 'to [masked_email]' AS inner_text, 'u' || user_id || '@x.org' AS left_alone, '[masked_email]' AS listed, 'u' || user_id || '@x.org' AS field_left FROM events""")
def masks_of_nested_values(spark, sf):
    mail = F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@x.org"))
    deep = F.create_map(F.lit("a"), F.create_map(F.lit("text"), F.concat(F.lit("to "), mail), F.lit("keep"), mail))
    row = F.struct(F.struct(F.array(mail).alias("list"), mail.alias("keep")).alias("s"))
    e = R.mask(t(spark, sf, "events").select("event_id", deep.alias("m"), row.alias("r")), ["m", "r"], {"email": R.MASK_RULES["email"]}, ["m.a.keep", "r.s.keep"])
    return e.select("event_id", F.col("m")["a"]["text"].alias("inner_text"), F.col("m")["a"]["keep"].alias("left_alone"), F.col("r.s.list")[0].alias("listed"), F.col("r.s.keep").alias("field_left"))


_HOST = N.Event(5001, [N.Field("activity_id", None, 1), N.Field("severity_id", None, 1), N.Field("time", "ts"), N.Field("device.ip", "ip"), N.Field("device.hostname", "host")])
_HOST_RULES = {5001: N.ClassRules({"device.ip": "string", "device.hostname": "string"}, [N.Rule("device.ip", pattern="ip_t"), N.Rule("device.hostname", pattern="hostname_t")])}


@registered("n5_host_and_ip", """
SELECT event_id, concat_ws('; ', CASE WHEN event_id % 6 IN (2, 5) THEN 'device.ip: format' END, CASE WHEN event_id % 4 = 3 THEN 'device.hostname: format' END) AS errors
FROM events WHERE event_id % 6 IN (2, 5) OR event_id % 4 = 3""")
def host_and_ip(spark, sf):
    pick = lambda n, *some: F.element_at(F.array(*[F.lit(x) for x in some]), (F.col("event_id") % n + 1).cast("int"))
    e = t(spark, sf, "events").withColumns({"ip": pick(6, "10.0.0.1", "2001:db8::1", "10.0.0.256", "::ffff:10.0.0.1", "fe80::1%eth0", "1::2::3"), "host": pick(4, "a", "a-b.example.com", "h1.x", "-bad")})
    _, rejected = N.class_rows(e, [_HOST], "1.0.0", _HOST_RULES)
    return rejected.select("event_id", F.array_join("errors", "; ").alias("errors"))


@registered("f6_sample_percent", """
SELECT event_id FROM events QUALIFY row_number() OVER (ORDER BY CAST('0x' || left(md5('0:' || event_id), 12) AS BIGINT), event_id) <= (SELECT count(*) * 10 // 100 FROM events)""")
def sampled_ids(spark, sf):
    return X.sample_percent(t(spark, sf, "events"), 10, order="event_id").select("event_id")


@registered("f6_sample_of_copies", "SELECT count(*) * 30 // 100 AS n, 1 AS kinds FROM events")
def sampled_copies(spark, sf):
    """A table of one row many times: only the number of copies can tell."""
    kept = X.sample_percent(t(spark, sf, "events").select(F.lit("x").alias("c")), 30)
    return kept.agg(F.count("*").alias("n"), F.count_distinct("c").cast("int").alias("kinds"))


@registered("hash_fnv1a", """
SELECT event_id, CAST(list_reduce([CAST(14695981039346656037 AS HUGEINT)] || list_transform(range(1, CAST(length(s) AS BIGINT) + 1), lambda i: CAST(ascii(substr(s, i, 1)) AS HUGEINT)),
                                  lambda h, x: (xor(h, x) * 1099511628211) % 18446744073709551616) AS VARCHAR) AS h
FROM (SELECT event_id, event_type || '/' || event_id AS s FROM events)""")
def fnv_of_events(spark, sf):
    h = fnv1a(F.concat_ws("/", "event_type", F.col("event_id").cast("string")))
    unsigned = F.when(h < 0, h.cast("decimal(20,0)") + F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(h.cast("decimal(20,0)"))
    return t(spark, sf, "events").select("event_id", unsigned.cast("decimal(20,0)").cast("string").alias("h"))


@registered("a8_runs_of_a_whole_table", """
SELECT event_type, run, count(*) AS n FROM (
  SELECT event_type, sum(new) OVER (ORDER BY ts, event_id) AS run
  FROM (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER (ORDER BY ts, event_id) OR row_number() OVER (ORDER BY ts, event_id) = 1 THEN 1 ELSE 0 END AS new FROM events))
GROUP BY 1, 2""")
def runs_of_a_whole_table(spark, sf):
    return A.run_counts(t(spark, sf, "events"), ["ts", "event_id"], ["event_type"]).withColumn("run", F.col("run").cast("decimal(38,0)")).select("event_type", "run", "n")


@registered("l8_one_long_file", """
SELECT record, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM (SELECT event_id, CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) OVER (ORDER BY event_id) AS BIGINT) AS record FROM events) GROUP BY 1""")
def one_long_file(spark, sf):
    """All events as the lines of one file; a record begins with each click."""
    lines = t(spark, sf, "events").select(F.lit("f").alias("file"), "event_id", F.concat_ws(" ", "event_type", F.col("event_id").cast("string")).alias("line"))
    made = L.assemble_multiline(lines, "line", "^click ", "file", "event_id")
    ids = F.transform(F.split("text", "\n"), lambda x: F.element_at(F.split(x, " "), 2).cast("long"))
    return made.select("record", F.size(ids).cast("long").alias("n"), F.aggregate(ids, F.lit(0).cast("long"), lambda a, b: a + b).alias("ids"))


@registered("a5_measured_write", "SELECT count(*) AS n_rows, CAST(sum(octet_length(encode(coalesce(props, '')))) AS BIGINT) AS raw_bytes, count(*) FILTER (event_type = 'click') AS accepted, max(ts) FILTER (event_type = 'click') AS last_success FROM events")
def measured_write(spark, sf):
    """What a write lets through, told by the write itself."""
    m = A.Measured(t(spark, sf, "events"), "props", status="event_type = 'click'", ts="ts")
    m.rows.write.parquet(shared_path(spark, "measured"))
    found = m.result()
    return spark.createDataFrame([(found["n_rows"], found["raw_bytes"], found["accepted"], found["last_success"])], "n_rows long, raw_bytes long, accepted long, last_success timestamp_ntz")


@registered("s4_folders_of_a_range", """
SELECT event_id, ts FROM events WHERE ts >= date_trunc('day', (SELECT min(ts) FROM events)) + INTERVAL '30 hours' AND ts < date_trunc('day', (SELECT min(ts) FROM events)) + INTERVAL '76 hours'""")
def folders_of_a_range(spark, sf):
    """From the sixth hour of the second day to the third of the fourth: whole days are one folder, the rest hours."""
    path, e = shared_path(spark, "landed"), t(spark, sf, "events").select("event_id", "ts")
    first = e.agg(F.min(F.date_trunc("day", "ts"))).first()[0]
    S.write_partitioned(e.repartition(F.date_trunc("day", "ts")), path)
    return S.read_partitioned(spark, path, first + timedelta(hours=30), first + timedelta(hours=75), "event_id long, ts timestamp").select("event_id", "ts")


_PROCESS = """{"objects": {"process": {"rules": [{"path": "pid", "required": true}], "objects": {"parent": "process", "user": "user"}}, "user": {"rules": [{"path": "email", "pattern": "email_t"}], "at_least_one": [["uid", "name"]]}},
"1007": {"objects": {"process": "process", "actor": "user"}}}"""
_LAUNCH = N.Event(1007, [
    N.Field("activity_id", None, 1), N.Field("process.pid", "user_id"), N.Field("process.parent.pid", "case when event_id % 3 <> 0 then event_id end"), N.Field("process.parent.user.email", "mail"),
    N.Field("process.parent.user.name", "event_type"), N.Field("actor.email", "mail"),
])


@registered("n5_object_types", """
SELECT event_id, concat_ws('; ', CASE WHEN event_id % 3 = 0 THEN 'process.parent.pid: required' END, CASE WHEN event_id % 2 = 0 THEN 'actor.email: format' END,
  CASE WHEN event_id % 2 = 0 THEN 'process.parent.user.email: format' END, 'actor.uid, actor.name: at least one') AS errors FROM events""")
def rules_of_object_types(spark, sf):
    """A process and the parent it holds, each by the rules of a process, and users at two places by those of a user."""
    mail = F.when(F.col("event_id") % 2 == 0, "none").otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@x.org")))
    _, rejected = N.class_rows(t(spark, sf, "events").withColumn("mail", mail), [_LAUNCH], "1.0.0", N.rules_json(_PROCESS))
    order = ["process.parent.pid: required", "actor.email: format", "process.parent.user.email: format", "actor.uid, actor.name: at least one"]
    return rejected.select("event_id", F.array_join(F.filter(F.array(*map(F.lit, order)), lambda x: F.array_contains("errors", x)), "; ").alias("errors"))


@registered("r2_remove_empty_nested", """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type END AS inner_text, CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS n, CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END AS listed, '' AS left_alone FROM events""")
def empty_parts_of_nested_values(spark, sf):
    even, third = F.col("event_id") % 2 == 0, F.col("event_id") % 3 == 0
    m = F.create_map(F.lit("a"), F.create_map(F.lit("x"), F.when(even, F.col("event_type")).otherwise("-"), F.lit("y"), F.lit("")), F.lit("b"), F.create_map(F.lit("z"), F.lit(None).cast("string")))
    row = F.struct(F.array(F.when(third, F.lit("")).otherwise(F.col("event_type")), F.lit("-")).alias("list"), F.lit("").alias("keep"))
    e = R.remove_empty(t(spark, sf, "events").select("event_id", m.alias("m"), row.alias("r")), ["m", "r"], maps=True, strings=["", "-"], exclude=["r.keep"])
    return e.select("event_id", F.try_element_at(F.try_element_at("m", F.lit("a")), F.lit("x")).alias("inner_text"), F.coalesce(F.size("m"), F.lit(0)).alias("n"), F.size("r.list").alias("listed"), F.col("r.keep").alias("left_alone"))
