"""Step graphs: one line of each branch, rows that no branch fits, and the steps alone."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tellurion.operators import graphs as G
from tellurion.operators import parse as L
from tellurion.operators import templates as P

LINES = {
    "mysql_logs": [
        (
            "# Time: 2022-04-25T16:58:49.001283Z\n# User@Host: root[root] @ localhost []  Id:    12\n# Query_time: 0.038360  Lock_time: 0.000035 Rows_sent: 0  Rows_examined: 7\nThread_id: 12 Errno: 0 Killed: 1 Read_rnd_next: 5\nselect a\nfrom b;",
            {"user": "root", "host": "localhost", "tid": "12", "query_time": "0.038360", "rows_examined": "7", "thread_id": "12", "errorNumber": "0", "killed": "1", "readRndNext": "5", "query": "select a\nfrom b;", "sql_command": "SELECT", "log_type": "mysql.slow_query"},
            "2022-04-25 16:58:49.001283", 0,
        ),
        ("# Time: 2022-04-25T16:58:49.001283Z\n# User@Host: u[u] @  [10.0.0.1]  Id:    12\n# Query_time: 1  Lock_time: 0 Rows_sent: 0  Rows_examined: 0\nfrobnicate x", {"ip": "10.0.0.1", "query": "frobnicate x", "sql_command": None}, "2022-04-25 16:58:49.001283", 0),
        ("/usr/sbin/mysqld, Version: 8.0.28 (MySQL Community Server - GPL). started with:\nTcp port: 3306", {"path": "/usr/sbin/mysqld", "version": "8.0.28 (MySQL Community Server - GPL)", "log_type": "mysql.server-start"}, None, 0),
        ("2022-04-25T16:58:49.001283Z 0 [Warning] [MY-010068] [Server] CA certificate is self signed.", {"tid": "0", "error_code": "MY-010068", "subsystem": "Server", "message": "CA certificate is self signed.", "log_type": "mysql.error"}, "2022-04-25 16:58:49.001283", 13),
        ("2022-04-25T16:58:49.001283Z\t   12 Query\tselect 1", {"command": "Query", "message": "select 1", "log_type": "mysql.general"}, "2022-04-25 16:58:49.001283", 0),
    ],
    "oracle_database_logs": [
        ("Audit file /u01/a.aud\nOracle Database 12c", {"message": "Audit file /u01/a.aud\nOracle Database 12c", "log_type": "oracledb.audit"}, None, 0),
        ("Wed Apr 20 10:11:12 2022 +02:00\nLENGTH : '160'\nACTION :[7] 'CONNECT'\nDATABASE USER:[1] '/'\nSTATUS:[1] '0'\n", {"length": "160", "action": "CONNECT", "database_user": "/", "status_code": "0", "record": None}, "2022-04-20 08:11:12", 0),
        ('Wed Apr 20 10:11:12 2022 +00:00\nLENGTH: "257"\nSESSIONID:[6] "123456" ENTRYID:[1] "1" COMMENT$TEXT:[9] "Auth by x" ', {"length": "257", "sessionid": "123456", "entryid": "1", "comment_text": "Auth by x"}, "2022-04-20 10:11:12", 0),
        ("<msg time='2022-04-20T10:11:12.345+00:00' org_id='oracle' level='16'\n host_id='h1'>\n <txt>Starting ORACLE instance\n </txt>\n</msg>", {"org_id": "oracle", "level": "16", "host_id": "h1", "message": "Starting ORACLE instance"}, "2022-04-20 10:11:12.345", 0),
        ("Wed Apr 20 10:11:12 2022\nThread 1 opened", {"message": "Thread 1 opened", "log_type": "oracledb.alert"}, "2022-04-20 10:11:12", 0),
        ("2022-04-20T10:11:12.345678+00:00\nThread 1 opened", {"message": "Thread 1 opened", "log_type": "oracledb.alert"}, "2022-04-20 10:11:12.345678", 0),
    ],
    "cisco_meraki_logs": [
        ("<134>1 1563249630.774247467 MX84 flows src=192.168.1.2:5353 dst=8.8.8.8 mac=00:11 protocol=udp sport=5353 dport=53 pattern: allow all", {"src_ip": "192.168.1.2", "src_port": "5353", "dst_ip": "8.8.8.8", "dst_port": None, "mac": "00:11", "protocol": "udp", "sport": "5353", "dport": "53", "message": "pattern: allow all", "app_name": "flows"}, None, 9),
        ("<134>1 1563249630.77 MX84 ip_flow src=1.2.3.4 dst=5.6.7.8 protocol=tcp sport=1 dport=2 translated_src_ip=9.9.9.9 translated_port=3", {"translated_src_ip": "9.9.9.9", "translated_port": "3", "src_ip": "1.2.3.4", "message": None}, None, 9),
        ("<131>1 1563249630.77 MX84 events dhcp no offers", {"message": "dhcp no offers", "src": None, "log_type": "cisco.meraki"}, None, 17),
    ],
    "mongodb_logs": [
        ('{"t":{"$date":"2022-04-26T16:15:44.876+00:00"},"s":"W",  "c":"INDEX", "id":20345, "ctx":"conn1","msg":"done","attr":{"a":null,"b":1}}', {"component": "INDEX", "context": "conn1", "message": "done", "id": "20345", "attr": '{"a":null,"b":1}', "severity": "W", "t": None}, "2022-04-26 16:15:44.876", 13),
        ("2019-02-06T09:22:43.967-0500 I NETWORK  [conn1] end connection", {"component": "NETWORK", "context": "conn1", "message": "end connection"}, "2019-02-06 14:22:43.967", 9),
    ],
    "nginx_logs": [
        ('{"time_local":"25/Apr/2022:16:58:49 +0000","status":"404","request":"GET /a?b=1 HTTP/1.1","request_time":"0.1"}', {"http_request_status": "404", "http_request_requestMethod": "GET", "http_request_requestUrl": "/a?b=1", "http_request_protocol": "HTTP", "http_request_protocol_version": "1.1", "status": None}, "2022-04-25 16:58:49", 13),
        ('2022/04/25 16:58:49 [crit] 31#32: *5 open() "/x" failed (2: No such file), client: 10.0.0.1, server: _, request: "GET /x HTTP/1.1", host: "h:80"', {"pid": "31", "tid": "32", "connection": "5", "message": 'open() "/x" failed (2: No such file)', "client": "10.0.0.1", "server": "_", "request": "GET /x HTTP/1.1", "host": "h:80", "context": None}, "2022-04-25 16:58:49", 18),
        ('2022/04/25 16:58:49 [notice] 1#1: start worker processes', {"message": "start worker processes", "connection": None, "log_type": "nginx.error"}, "2022-04-25 16:58:49", 10),
        ('10.0.0.1 - u [25/Apr/2022:16:58:49 +0000] "GET / HTTP/1.1" 500 12 "-" "agent"', {"http_request_status": "500", "http_request_userAgent": "agent", "log_type": "nginx.access"}, "2022-04-25 16:58:49", 17),
    ],
    "elasticsearch_logs": [
        ('{"type": "server", "timestamp": "2022-04-19T17:58:52,268Z", "level": "INFO", "cluster.name": "c"}', {"type": "server", "cluster.name": "c", "log_type": "elasticsearch"}, "2022-04-19 17:58:52.268", 9),
        ("[2022-04-19T17:58:52.268+0000][7][safepoint,GC] GC(3) Pause", {"type": "safepoint,GC", "gc_run": "3", "message": "Pause", "log_type": "elasticsearch.gc"}, "2022-04-19 17:58:52.268", 0),
    ],
    "container_logs": [
        ('{"log":"{\\"level\\":\\"error\\",\\"msg\\":\\"m\\"}","stream":"stdout","time":"2022-04-19T17:58:52.268123456Z"}', {"level": "error", "msg": "m", "stream": "stdout", "log": None}, "2022-04-19 17:58:52.268123", 17),
        ("2022-04-19T17:58:52.268Z stderr F plain", {"stream": "stderr", "level": None}, "2022-04-19 17:58:52.268", 17),
    ],
    "json_logs": [('{"severity":"warn","level":"error","timestamp":"2022-04-19T17:58:52Z","n":{"a":[1]}}', {"n": '{"a":[1]}'}, "2022-04-19 17:58:52", 13)],
    "file_logs": [("anything", {"log_type": "file"}, None, 0)],
}


@pytest.mark.parametrize("name", sorted(LINES))
def test_graphs(spark, name):
    lines = LINES[name]
    df = spark.createDataFrame([(i, x[0]) for i, x in enumerate(lines)] + [(90, None), (91, ""), (92, "{not json"), (93, "\x01")], "i int, body_text string").withColumns({n: F.lit("mine") for n in ("_groups", "_state", "fields", "parsed")})
    got = {r.i: r for r in G.parse_graph(df, name).collect()}
    assert len(got) == len(lines) + 4 and set(got) >= {90, 91, 92, 93}
    for i, (line, want, ts, level) in enumerate(lines):
        assert {k: got[i].fields.get(k) for k in want} == want, line
        assert got[i].severity_number == level and got[i].ts == (ts and dt.datetime.fromisoformat(ts)), line
    assert got[90].ts is None and got[90].severity_number == 0
    assert got[0]._groups == "mine" and got[0].parsed == "mine"


def test_only_its_own_branch_is_evaluated(spark):
    """A branch that would fail for other rows."""
    fails = G.Add("x", lambda s: F.when(F.raise_error(F.lit("evaluated")).isNull(), "no"))
    graph = [G.Route([(G.begins("a"), [G.Add("kind", "a")]), (G.begins("never"), [fails])], [G.Add("kind", "rest")])]
    got = G.parse_graph(spark.createDataFrame([("a1",), ("b",), (None,)], "body_text string"), graph).collect()
    assert sorted(r.fields["kind"] for r in got) == ["a", "rest", "rest"]


def test_steps(spark):
    df = spark.createDataFrame([("k=1 j=2 k=3 tail", "u")], "body_text string, other string")
    one = lambda *steps: G.parse_graph(df, list(steps)).first()
    assert one(G.Pairs(r"(\w+)=(\S+)", rest="tail")).fields == {"k": "1", "j": "2", "tail": "tail"}
    assert one(G.Pairs(r"(\w+)=(\S+)", rename={"k": "kay"})).fields == {"kay": "1", "j": "2"}
    assert one(G.Regex("(?P<a>zzz)")).fields == {}
    assert one(G.Add("a", "1"), G.Move("a", "b"), G.Move("b", "c", keep=True), G.Move("nothing", "d")).fields == {"b": "1", "c": "1"}
    assert one(G.Add("a", "1"), G.Add("b", "2"), G.Retain(["b"])).fields == {"b": "2"}
    assert one(G.Add("a", "new body"), G.Move("a", "body")).body == "new body"
    assert one(G.Add("u", "https://h.x/p?q=1"), G.Uri("u", "url_")).fields == {"u": "https://h.x/p?q=1", "url_scheme": "https", "url_host": "h.x", "url_path": "/p", "url_query": "q=1"}
    assert one(G.Add("u", "/p?q=1"), G.Uri("u")).fields == {"u": "/p?q=1", "path": "/p", "query": "q=1"}
    assert G.parse_graph(df, [G.Keep(G.matches("absent") | G.has("x"))]).count() == 0
    assert G.parse_graph(df, [G.Keep(~G.matches("absent") & G.begins("k="))]).count() == 1
    assert G.parse_graph(df.limit(0), "mysql_logs").count() == 0
    csv = G.parse_graph(spark.createDataFrame([('a,"b,c",warn',), ("a,b",)], "body_text string"), G.csv_graph("x,y,l", level="l")).collect()
    assert [r.fields.get("y") for r in csv] == ["b,c", None] and [r.severity_number for r in csv] == [13, 0]


MENDED = [
    ("elasticsearch_logs", "[2022-04-19T17:58:52.268+0000][7][safepoint,GC] GC(3) Pause", {"type": "safepoint,GC", "gc_run": "3", "message": "Pause"}),
    ("wildfly_logs", "2022-04-19 17:58:52,268 INFO  [org.jboss] (MSC service thread 1-1) WFLY1: up", {"source": "org.jboss", "thread": "MSC service thread 1-1", "message": "WFLY1: up", "messageCode": "WFLY1"}),
    ("wildfly_logs", "2022-04-19 17:58:52,268 INFO (default task-1) up", {"thread": "default task-1", "message": "up"}),
    ("aerospike_logs", "Apr 19 2022 17:58:52 GMT: INFO (info): (a{b}.c:12) {test} up", {"source_file": "a{b}.c", "source_location": "12", "namespace": "test", "message": "up"}),
    ("couchdb_logs", "[notice] 2022-04-19T17:58:52.268123Z couchdb@h<1> <0.1.0> started", {"node": "couchdb", "host": "h<1>", "pid": "0.1.0", "message": "started"}),
    ("esxi_logs", "<166>2022-04-19T17:58:52.268Z host.x Hostd[12:3]: info", {"hostname": "host.x", "service": "Hostd", "pid": "12:3", "message": "info"}),
    ("macos_logs", "2022-04-19 17:58:52-07 mac softwareupdated[12:a] (sub[4]): text", {"host": "mac", "process": "softwareupdated", "pid": "12:a", "subprocess": "sub", "spid": "4"}),
    ("haproxy_logs", 'Apr 19 17:58:52 h haproxy[9]: 10.0.0.1:22 [19/Apr/2022:17:58:52.268] fe be/s1 0/0/3 212 -- 1/2/3/4/0 0/0', {"backend_name": "be", "server_name": "s1", "session_duration": "3", "bytes_read": "212", "termination_state": "--", "process_concurrent_connections": "1", "server_concurrent_connections": "4", "retries": "0"}),
]


@pytest.mark.parametrize("name,line,want", MENDED)
def test_mended_layouts(spark, name, line, want):
    got = P.parse_logs(spark.createDataFrame([(line,)], "body_text string"), name).first().fields
    assert {k: got.get(k) for k in want} == want


@pytest.mark.parametrize("pattern,text,want", [
    ("^(?P<a>x)|(?P<b>y)", "zzy", ("", "y")), ("(?P<a>\\d+)", "ab12cd", ("12",)), ("^(?P<a>[(|]+)b", "(|b", ("(|",)), ("^(?P<a>\\d)", "x1", None), ("(?P<a>b)?", "xyz", ("",)),
])
def test_one_pass_gives_groups_and_match(spark, pattern, text, want):
    got = L.regex_parse(spark.createDataFrame([(text,)], "t string"), "t", pattern).first().parsed
    assert (got and tuple(got)) == want


def test_work_of_a_row(spark):
    """A class of two complements costs about 60 ns a character, and many times that side by side; a pair is found in one pass."""
    slow = r"[\s\S]"
    assert not [n for n, t in P.TEMPLATES.items() for x in t.patterns if slow in x]
    df = spark.createDataFrame([("x",)], "body_text string")
    for name in G.GRAPHS:
        plan = G.parse_graph(df, name)._jdf.queryExecution().optimizedPlan().toString()
        assert slow not in plan, name
    plan = G.parse_graph(df, [G.Pairs(r"([a-z]+)=(\S+)", rest="rest")])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 2


def test_pairs_of_equal_names_and_rest(spark):
    """The first of equal names counts, also over a field; the rest takes the place of a pair of its name, and none leaves none."""
    rows = ["a=1 b=2 A=3  tail  end ", "a=1 rest=9 left", "a=1 b=2", "none here", "", None, "a=1\nb=2\n\nt\u00e4il \U0001f600\n"]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, body_text string")
    steps = [G.Add("b", "old"), G.Add("rest", "was"), G.Pairs(r"([A-Za-z]+)=(\S+)", rest="rest")]
    got = [r.fields for r in G.parse_graph(df, steps).orderBy("i").collect()]
    kept = {"b": "old", "rest": "was"}
    assert got == [
        {"a": "1", "b": "2", "rest": "tail  end"}, {"a": "1", "b": "old", "rest": "left"}, {"a": "1", "b": "2"}, kept, kept, kept, {"a": "1", "b": "2", "rest": "t\u00e4il \U0001f600"},
    ]
    rx = G.Regex(r"^(?P<head>\w+) (?P<body>(?s:.)*)$")
    assert [r.fields for r in G.parse_graph(spark.createDataFrame([("a b\nc\u2028d \U0001f600",)], "body_text string"), [rx]).collect()] == [{"head": "a", "body": "b\nc\u2028d \U0001f600"}]
