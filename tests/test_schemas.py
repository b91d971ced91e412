"""Security schemas, telemetry documents, sinks and vendor records on small hand-made rows."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tellurion.operators import standardize as N
from tellurion.operators import templates
from tellurion.sources import otlp, sinks, vendor


@pytest.mark.parametrize("kind,given,want", [
    ("integer", "0x1F", 31), ("integer", "010", 8), ("integer", "-0b11", -3), ("integer", "0o17", 15), ("integer", "+5", 5), ("integer", "1.5", None), ("integer", 2.9, 2), ("integer", True, 1), ("long", "", None),
    ("float", "1e3", 1000.0), ("boolean", "T", True), ("boolean", "yes", None), ("boolean", 0, False), ("timestamp", "2024-01-02T03:04:05Z", 1704164645000), ("timestamp", "17", 17), ("timestamp", "soon", None),
])
def test_class_values(spark, kind, given, want):
    df = spark.createDataFrame([(given,)], ["x"])
    assert df.select(N.class_value(df, F.col("x"), kind).alias("y")).first().y == want


@pytest.mark.parametrize("kind,given,want", [
    ("int", "0x10", 16), ("int", "2147483648", None), ("long", " 2147483648 ", 2147483648), ("int", "7.9", 7), ("int", "x", None), ("real", " 2.5 ", 2.5), ("boolean", "YES", True), ("boolean", "2", None),
    ("datetime", "2024-01-02 03:04:05", "2024-01-02T03:04:05Z"), ("datetime", "2024-01-02T03:04:05.120+01:00", "2024-01-02T02:04:05.12Z"), ("datetime", "2024-01-02", None), ("string", 5, "5"),
])
def test_table_values(spark, kind, given, want):
    df = spark.createDataFrame([(given,)], ["x"])
    assert df.select(N.table_value(df, F.col("x"), kind).alias("y")).first().y == want


def test_first_event_wins_and_nulls_do_not_match(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "i int, k string")
    a, b = N.Event(3001, [N.Field("x", "k")], "k = 'a'"), N.Event(3002, [N.Field("x", "k"), N.Field("x", None, "last"), N.Field("o.p", "cast(null as string)")], "k <> 'z'")
    rows, rejected = N.class_rows(df, [a, b], "1.0.0")
    got = {r.i: json.loads(r.body_text) for r in rows.collect()}
    assert set(got) == {1, 3} and got[1]["class_uid"] == 3001 and got[3]["x"] == "last" and "o" not in got[3] and rejected.count() == 0


def test_rules_reject_and_objects_guard_their_paths(spark):
    df = spark.createDataFrame([(1, "u", None), (2, None, None), (3, "u", "e@x.org"), (4, None, "bad")], "i int, n string, e string")
    ev = N.Event(3001, [N.Field("user.name", "n"), N.Field("user.email", "e")])
    rules = {3001: N.ClassRules({}, [N.Rule("user.name", True), N.Rule("user.email", pattern="email_t")])}
    rows, rejected = N.class_rows(df, [ev], "1.0.0", rules)
    assert sorted(r.i for r in rows.collect()) == [1, 2, 3]
    assert rejected.first().errors == ["user.name: required", "user.email: format"]
    assert N.uncovered(N.Event(3001, [N.Field("x")]), N.ClassRules({}, [N.Rule("activity_id", True), N.Rule("class_uid", True), N.Rule("o.p", True)], [["a", "b"]])) == ["activity_id", "a, b"]
    assert N.rules_json('{"3001": {"types": {"a": "long"}, "rules": [{"path": "a", "required": true}]}}')[3001].rules[0].required
    with pytest.raises(ValueError):
        N._tree({"a": F.lit(1), "a.b": F.lit(2)})


def test_class_rows_of_empty_table(spark):
    df = spark.createDataFrame([], "i int, k string")
    assert N.class_rows(df, [N.Event(3001, [N.Field("x", "k")])], "1.0.0")[0].count() == 0


def test_table_rows_drop_incomplete_ones(spark):
    df = spark.createDataFrame([(1, "plain", datetime(2024, 1, 2)), (2, '{"a":1}', None)], "i int, body_text string, ts timestamp")
    full = [N.Field(c, None, "2024-01-01T00:00:00Z" if c.endswith("Time") else "v") for c in N.REQUIRED_COLUMNS if c not in ("TimeGenerated", "EventSchema")]
    kept = N.table_rows(df, [N.Event("T", full, schema="S")], {})
    got = {r.i: json.loads(r.row_json) for r in kept.collect()}
    assert got[1]["TimeGenerated"] == "2024-01-01T00:00:00Z" and got[1]["AdditionalFields"] == "plain"
    assert got[2]["AdditionalFields"] == {"a": 1} and got[2]["EventSchema"] == "S"
    assert N.table_rows(df, [N.Event("T", full[1:], schema="S")], {}).count() == 0
    loose = N.table_rows(df, [N.Event("T", [], schema="S")], {}, validate=False)
    assert json.loads(loose.where("i = 1").first().row_json)["TimeGenerated"] == "2024-01-02T00:00:00Z" and loose.count() == 2


METRICS = {"resourceMetrics": [{"resource": {"attributes": [{"key": "h", "value": {"stringValue": "a"}}, {"key": "h", "value": {"stringValue": "b"}}, {"key": "l", "value": {"arrayValue": {"values": [{"intValue": "1"}]}}}]}, "scopeMetrics": [{"metrics": [
    {"name": "g", "gauge": {"dataPoints": [{"asInt": "9007199254740993", "timeUnixNano": "1700000000123456789"}, {}]}},
    {"name": "s", "sum": {"aggregationTemporality": 1, "isMonotonic": True, "dataPoints": [{"asDouble": 1.5, "exemplars": [{"asDouble": 2.0, "traceId": "t"}]}]}},
    {"name": "h", "histogram": {"aggregationTemporality": "AGGREGATION_TEMPORALITY_CUMULATIVE", "dataPoints": [{"count": "3", "sum": 6.0, "bucketCounts": ["1", "2"], "explicitBounds": [5.0]}]}},
    {"name": "e", "exponentialHistogram": {"dataPoints": [{"count": "2", "scale": 3, "positive": {"offset": 1, "bucketCounts": ["2"]}}]}},
    {"name": "q", "summary": {"dataPoints": [{"count": "4", "sum": 8.0, "quantileValues": [{"quantile": 0.5, "value": 2.0}]}]}},
]}]}]}


def test_five_kinds_of_points(spark):
    df = spark.createDataFrame([(json.dumps(METRICS),), ("no json",), (None,), ("{}",)], "value string")
    points = otlp.flatten_datapoints(df)
    got = {(r.metric_name, r.value): r for r in points.collect()}
    assert len(got) == 6 and got["s", 1.5].temporality == "delta" and got["s", 1.5].monotonic and got["h", None].temporality == "cumulative"
    g = got["g", 9007199254740992.0]
    assert g.value_type == "int" and g.ts == datetime(2023, 11, 14, 22, 13, 20, 123456) and g.resource["h"] == "a" and json.loads(g.resource["l"])[0]["intValue"] == "1"
    tables = sinks.warehouse_metrics(points)
    assert {k: v.count() for k, v in tables.items()} == {"gauge": 2, "sum": 1, "summary": 1, "histogram": 1, "exponential_histogram": 1}
    h, e = tables["histogram"].first(), tables["exponential_histogram"].first()
    assert h.BucketCounts == '["1","2"]' and h.AggregationTemporality == "cumulative" and e.PositiveOffset == "1" and e.Scale == "3"
    assert len(sinks.warehouse_logs(otlp.flatten_logs(df)).columns) == 18 and len(sinks.warehouse_spans(otlp.flatten_spans(df)).columns) == 29


def test_documents_are_read_between_times(spark, tmp_path):
    doc = json.dumps({"resourceLogs": [{"scopeLogs": [{"logRecords": [{"body": {"stringValue": "x"}}]}]}]})
    for hour, name in (("01", "logs_1.json"), ("02", "logs_2.json"), ("02", "metrics_2.json"), ("02", "logs_2.txt"), ("03", "logs_3.json")):
        d = tmp_path / "year=2024" / "month=01" / "day=02" / f"hour={hour}"
        d.mkdir(parents=True, exist_ok=True)
        (d / name).write_text(doc)
    assert otlp.read_otlp(spark, str(tmp_path), "logs", datetime(2024, 1, 2, 1), datetime(2024, 1, 2, 2)).count() == 2


def test_lake(spark, tmp_path):
    bodies = ['{"class_uid":3001.0,"time":1704164645000,"user":"a"}', '{"class_uid":3001,"time":1704164644000}', '{"class_uid":7,"time":1}', '{"time":1}', "text", '{"class_uid":3001}', None]
    rows, rejected = sinks.lake_rows(spark.createDataFrame([(b,) for b in bodies], "body_text string"), {3001: "accounts"})
    assert rows.count() == 2 and sorted(r.reason for r in rejected.collect()) == ["no class", "no object", "no object", "no time", "unknown class"]
    sinks.write_lake(rows, str(tmp_path / "lake"), "r1", "1", {3001: "user string"}, salt=1)
    back = spark.read.parquet(str(tmp_path / "lake"))
    assert sorted((r.time, r.event.user) for r in back.collect()) == [(1704164644000, None), (1704164645000, "a")]
    assert {(r.ext, r.region, str(r.eventDay)) for r in back.collect()} == {("accounts", "r1", "20240102")}


PACKETS = """noise before
12:34:56.789012 IP 192.168.1.100.54321 > 192.168.1.1.443: Flags [S], seq 1, length 0
\t0x0000:  4500 003c
\t0x0004:  1c
12:34:57.000000 (en0) IP 10.0.0.1.5353 > 10.0.0.2.53: 1+ A? example.com. (29)
12:34:58.000000 eth0 In IP6 fe80::1.80 > ::1.90: Flags [.], length 0
12:34:59.000000 ARP, Request who-has 10.0.0.9 tell 10.0.0.1
12:35:00.000000 IP 10.0.0.1 > 10.0.0.2: ICMP echo request""".split("\n")


def test_packets(spark):
    df = spark.createDataFrame([("f", i, x) for i, x in enumerate(PACKETS)], "f string, n int, line string")
    got = [tuple(r)[3:] for r in vendor.parse_packets(df, "f", "n", "line", "2024-01-02").orderBy("packet").collect()]
    assert got == [
        (None, "IP", "192.168.1.100", 54321, "192.168.1.1", 443, "TCP", "4500003c1c", 5), ("en0", "IP", "10.0.0.1", 5353, "10.0.0.2", 53, "UDP", "", 0),
        ("eth0", "IP6", "fe80::1", 80, "::1", 90, "TCP", "", 0), (None, "ARP", "10.0.0.1", None, "10.0.0.9", None, "Unknown", "", 0), (None, "IP", "10.0.0.1", 0, "10.0.0.2", 0, "ICMP", "", 0),
    ]


def test_packets_read_each_part_once(spark):
    """No pattern stands in the plan for every column that its match goes into; lines are read before they are dealt out."""
    df = spark.createDataFrame([("f", i, x) for i, x in enumerate(PACKETS)], "f string, n int, line string")
    plan = vendor.parse_packets(df, "f", "n", "line", "2024-01-02")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"(?:In|Out)") == 5 and plan.count("RLIKE(line") == 1
    odd = ["12:00:00.1 () eth1 Out IP a > b", "12:00:00.1 garbage", "12:00:00.1 IP 1.2.3.256 > 1.2.3.99999999999: UDP", "12:00:00.1 ARP, Reply 10.0.0.9 is-at 00:11", None, "\t0x0000:  45zz 003c"]
    df = spark.createDataFrame([(f, i, x) for f in ("f", None) for i, x in enumerate(odd)], "f string, n int, line string")
    got = [tuple(r)[3:] for r in vendor.parse_packets(df, "f", "n", "line", "2024-01-02").orderBy("f", "packet").collect()]
    assert got == 2 * [
        ("eth1", "IP", "a", 0, "b", 0, "Unknown", "", 0), (None, None, None, 0, None, 0, "Unknown", "", 0), (None, "IP", "1.2.3", 256, "1.2.3.99999999999", 0, "UDP", "", 0),
        (None, "ARP", None, None, "10.0.0.9", None, "Unknown", "45", 1),
    ]


def test_vendor_rows_of_bad_text(spark):
    df = spark.createDataFrame([("{", ), (None,), ("{}",)], "j string")
    assert vendor.okta_logs(df, "j", "d").count() == 1 and vendor.neuron_metrics(df, "j").count() == 0
    logs = vendor.m365_logs(df, "j", "a", "t").collect()
    assert len(logs) == 3 and all(r.ts is not None and r.attributes["user.type"] == "Regular" for r in logs)
    t = spark.createDataFrame([("5", "-"), ("x", "-1"), (None, "2.5")], "a string, b string")
    assert sorted((r.metric_name, r.value) for r in vendor.table_metrics(t, {"a": "a", "b": "b"}).collect()) == [("a", 5.0), ("b", 2.5)]



def test_table_metrics_of_numbers(spark):
    t = spark.createDataFrame([(0.0, 1), (-0.0, -1), (1e-5, 0), (-2.5, None), (None, None), (float("nan"), None), (float("inf"), None)], "a double, b int")
    got = [(r.metric_name, str(r.value)) for r in vendor.table_metrics(t, {"a": "a", "b": F.col("b")}).collect()]
    assert sorted(got) == [("a", "-0.0"), ("a", "0.0"), ("a", "1e-05"), ("a", "inf"), ("a", "nan"), ("b", "0.0"), ("b", "1.0")]
    text = spark.createDataFrame([("1e-5", "-0.0", "2e3")], "a string, b string, c string")
    assert [(r.metric_name, r.value) for r in vendor.table_metrics(text, {x: x for x in "abc"}).collect()] == [("c", 2000.0)]

LINES = {
    "aerospike_logs": ("Jan 02 2024 03:04:05 GMT: WARNING (hb): (hb.c:12) {test} text", "2024-01-02 03:04:05", 13),
    "cisco_catalyst_logs": ("<189>29: *Jan  2 03:04:05.678: %SYS-5-CONFIG_I: text", None, 13),
    "cisco_meraki_logs": ("<134>1 1704164645.0 mx flows src=1.2.3.4 dst=5.6.7.8 mac=a", None, 9),
    "cockroachdb_logs": ("E240102 03:04:05.678901 12 1@a/b.go:7 ⋮ [n1] 34 text", "2024-01-02 03:04:05.678901", 17),
    "common_event_format_logs": ("Jan  2 03:04:05 h CEF:0|v|p|1|id|name|8|src=1.2.3.4", None, 17),
    "couchbase_logs": ("[ns:warn,2024-01-02T03:04:05.678-01:00,n@h:a<0.1>:m:f:1]text", "2024-01-02 04:04:05.678", 13),
    "couchdb_logs": ("[notice] 2024-01-02T03:04:05.678901Z n@h <0.1.0> abc h:5984 1.2.3.4 u GET /db 200 ok 3", "2024-01-02 03:04:05.678901", 9),
    "elasticsearch_logs": ("[2024-01-02T03:04:05.678+0000][1][gc,start] GC(7) text", "2024-01-02 03:04:05.678", 0),
    "esxi_logs": ("<167>2024-01-02T03:04:05.678Z h Hostd[12]: text", "2024-01-02 03:04:05.678", 5),
    "haproxy_logs": ('Jan  2 03:04:05 h haproxy[9]: 1.2.3.4:5 [02/Jan/2024:03:04:05.678] f~ b/s1 0/0/1/2/3 503 12 - - ---- 1/1/0/0/0 0/0 {x} "GET /a HTTP/1.1"', "2024-01-02 03:04:05.678", 17),
    "ingress_nginx_logs": ('1.2.3.4 - - [02/Jan/2024:03:04:05 +0000] "GET /a HTTP/1.1" 404 5 "-" "a b" 10 0.001 [up] [] 5.6.7.8:80 5 0.001 404 abc1', "2024-01-02 03:04:05", 13),
    "macos_logs": ("2024-01-02 03:04:05+01 h p[12]: text", "2024-01-02 02:04:05", 0),
    "mysql_logs": ("2024-01-02T03:04:05.678901Z 7 [Warning] text", "2024-01-02 03:04:05.678901", 13),
    "pgbouncer_logs": ("2024-01-02 03:04:05.678 UTC [9] NOISE text", "2024-01-02 03:04:05.678", 5),
    "ubiquiti_logs": ("<12>Jan  2 03:04:05 aabb,U7-1: hostapd: text", None, 13),
    "windows_dhcp": ("10,01/02/24,03:04:05,Assign,1.2.3.4,h,AA,,0,6,,,,,,,,,0", "2024-01-02 03:04:05", 0),
    "apache_common_logs": ('1.2.3.4 - u [02/Jan/2024:03:04:05 +0100] "GET /a HTTP/1.1" 503 12', "2024-01-02 02:04:05", 17),
    "apache_cassandra_logs": ("WARN  [main] 2024-01-02 03:04:05,678 text", "2024-01-02 03:04:05.678", 13),
    "cisco_asa_logs": ("Jan 02 2024 03:04:05: %ASA-6-1: built", "2024-01-02 03:04:05", 0),
    "container_logs": ("2024-01-02T03:04:05.123456789Z stderr F boom", "2024-01-02 03:04:05.123456", 17),
    "hadoop_logs": ("2024-01-02 03:04:05,678 ERROR a.b.C: it\nbroke", "2024-01-02 03:04:05", 17),
    "hbase_logs": ("2024-01-02 03:04:05,678 INFO  [t] a.B: text", "2024-01-02 03:04:05", 9),
    "jboss_logs": ("2024-01-02 03:04:05,678 INFO  [org] (main) ID1: text", "2024-01-02 03:04:05", 9),
    "kubelet_logs": ("W0102 03:04:05.000001    12 a.go:7] text", None, 13),
    "mongodb_logs": ("2024-01-02T03:04:05.678+0000 I NETWORK  [conn1] text", "2024-01-02 03:04:05.678", 9),
    "nginx_logs": ('1.2.3.4 - - [02/Jan/2024:03:04:05 +0000] "GET / HTTP/1.1" 404 0 "-" "a"', "2024-01-02 03:04:05", 13),
    "postgresql_logs": ("2024-01-02 03:04:05.678 UTC [9] r@u FATAL:  text", "2024-01-02 03:04:05.678", 21),
    "rabbitmq_logs": ("2024-01-02 03:04:05.678901+00:00 [warning] <0.1.0> text", "2024-01-02 03:04:05.678901", 13),
    "redis_logs": ("12:M 02 Jan 2024 03:04:05.678 # text", "2024-01-02 03:04:05.678", 13),
    "sap_hana_logs": ("[1]{-1}[-1/-1] 2024-01-02 03:04:05.678901 e comp file.cc(1) : text", "2024-01-02 03:04:05.678901", 17),
    "solr_logs": ("2024-01-02 03:04:05.678 INFO  (q-1) [c:a s:b r:c x:d] o.a.S text", "2024-01-02 03:04:05.678", 9),
    "tomcat_logs": ("02-Jan-2024 03:04:05.678 INFO [main] a.b.C text", "2024-01-02 03:04:05.678", 9),
    "wildfly_logs": ("2024-01-02 03:04:05,678 DEBUG [a.b] (t) text", "2024-01-02 03:04:05.678", 5),
    "zookeeper_logs": ("2024-01-02 03:04:05,678 - WARN  [t:S@1] - text", "2024-01-02 03:04:05.678", 13),
    "apache_http_logs": ("[Tue Jan 02 03:04:05.678901 2024] [core:error] [pid 9:tid 7] [client 1.2.3.4:5] AH00126: text", "2024-01-02 03:04:05.678901", 17),
    "iis_logs": ("2024-01-02 03:04:05 1.2.3.4 GET /a - 80 - 5.6.7.8 agent - 503 0 0 12", "2024-01-02 03:04:05", 17),
    "oracle_database_logs": ("2024-01-02T03:04:05.678901+01:00 text", "2024-01-02 02:04:05.678901", 0),
    "vcenter_logs": ("<12>1 2024-01-02T03:04:05.678901+00:00 h vpxd 7 - - text", "2024-01-02 03:04:05.678901", 13),
}


@pytest.mark.parametrize("name", sorted(LINES))
def test_log_formats(spark, name):
    line, ts, level = LINES[name]
    df = spark.createDataFrame([(line,), ("?",), (None,)], "body_text string")
    hit, *others = templates.parse_logs(df, name).collect()
    assert hit.fields and hit.ts == (datetime.fromisoformat(ts) if ts else None) and hit.severity_number == level, hit
    assert all(r.fields is None and r.ts is None and r.severity_number == 0 for r in others)


def test_syslog_edges(spark):
    df = spark.createDataFrame([("<999>1 - - - - - - x",), ("<13>1 - - - - - - x",), ("no",), (None,)], "l string")
    got = [r.syslog for r in templates.syslog_parse(df, "l").collect()]
    assert got[0] is None and got[1].severity == 5 and got[1].host is None and got[1].message == "x" and got[2] is None and got[3] is None


def test_layouts_are_patterns():
    import re

    p = templates.pattern_of("[{time:yyyy-MM-dd HH:mm:ss[.SSS]}] (?{{{name}}} ?){n:int}|{_:word} {rest:rest}")
    assert re.match(p, "[2024-01-02 03:04:05] {a b} 12|x y\nz").groupdict() == {"time": "2024-01-02 03:04:05", "name": "a b", "n": "12", "rest": "y\nz"}
    assert re.match(p, "[2024-01-02 03:04:05.678] 12|x y")["name"] is None and not re.match(p, "[2024-01-02] 12|x y")
    start = templates.TEMPLATES["kafka_logs"].start
    assert re.match(start, "[2024-01-02 03:04:05,678] INFO x") and not re.match(start, "  at a.b")
    assert templates.TEMPLATES["nginx_logs"].start is None
    slow = "# Time: 2024-01-02T03:04:05.678901Z\n# User@Host: u[u] @ h [1.2.3.4]  Id: 7\n# Query_time: 0.5  Lock_time: 0.1 Rows_sent: 1  Rows_examined: 2\nselect 1;"
    assert re.match(templates.TEMPLATES["mysql_logs"].patterns[0], slow).groupdict() == {"timestamp": "2024-01-02T03:04:05.678901Z", "user": "u", "host": "h", "ip": "1.2.3.4", "tid": "7", "query_time": "0.5", "lock_time": "0.1", "rows_sent": "1", "rows_examined": "2", "message": "select 1;"}


def test_rules_hold_wherever_an_object_stands(spark):
    """A process holds its parent, which is a process; users and hosts stand at several places."""
    import json

    text = json.dumps({
        "objects": {
            "process": {"rules": [{"path": "pid", "required": True}], "just_one": [["name", "path"]], "objects": {"user": "user", "parent": "process"}},
            "user": {"rules": [{"path": "email", "pattern": "email_t"}], "at_least_one": [["uid", "name"]]},
        },
        "1007": {"rules": [{"path": "activity_id", "required": True}], "objects": {"process": "process", "actor": "user", "other": "process"}},
    })
    rules = N.rules_json(text)[1007]
    assert rules.expanded(["x"]).rules == rules.rules
    with pytest.raises(ValueError):
        N.ClassRules(objects={"a": "none"}).expanded(["a.b"])
    paths = ["process.pid", "process.name", "process.path", "process.parent.pid", "process.parent.name", "process.parent.user.email", "process.parent.user.uid", "actor.email", "actor.name"]
    event = N.Event(1007, [N.Field("activity_id", None, 1), N.Field("time", "ts"), *(N.Field(p, f"`{p}`") for p in paths)])
    ok = {"process.pid": 1, "process.name": "n"}
    cases = [
        (ok, []), ({}, []), ({"process.name": "n"}, ["process.pid: required"]), (ok | {"process.path": "p"}, ["process.name, process.path: just one"]),
        (ok | {"process.parent.name": "n"}, ["process.parent.pid: required"]), (ok | {"process.parent.pid": 1}, ["process.parent.name, process.parent.path: just one"]),
        (ok | {"process.parent.pid": 1, "process.parent.name": "n", "process.parent.user.email": "bad"}, ["process.parent.user.email: format", "process.parent.user.uid, process.parent.user.name: at least one"]),
        ({"actor.email": "a@b.c"}, ["actor.uid, actor.name: at least one"]), ({"actor.email": "a@b.c", "actor.name": "n"}, []),
    ]
    schema = "i int, ts timestamp, " + ", ".join(f"`{p}` {'int' if p.endswith('pid') else 'string'}" for p in paths)
    df = spark.createDataFrame([(i, None, *(c.get(p) for p in paths)) for i, (c, _) in enumerate(cases)], schema)
    _, rejected = N.class_rows(df, [event], "1.0.0", {1007: rules})
    got = {r.i: sorted(r.errors) for r in rejected.collect()}
    assert got == {i: sorted(e) for i, (_, e) in enumerate(cases) if e}


def test_versions(spark):
    import json

    one = {"3001": {"rules": [{"path": "user.name", "pattern": "hostname_t"}]}}
    rules = N.rules_of_versions(json.dumps({"1.0.0": one, "1.1.0": {"3001": {}}}))
    df = spark.createDataFrame([(1, "1.0.0", "a b"), (2, "1.1.0", "a b"), (3, "9", "a"), (4, None, "a"), (5, "1.0.0", "ab")], "i int, v string, name string")
    good, bad = N.class_rows_by_version(df, [N.Event(3001, [N.Field("user.name", "name")])], "v", rules)
    assert sorted((r.i, json.loads(r.body_text)["metadata"]["version"]) for r in good.collect()) == [(2, "1.1.0"), (5, "1.0.0")]
    assert sorted((r.i, r.errors) for r in bad.collect()) == [(1, ["user.name: format"]), (3, ["unknown version"]), (4, ["unknown version"])]
