"""Queries over step graphs: lines of every branch made from the events, each graph beside its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tellurion.operators import graphs as G
from tellurion.plans.catalog import dealt, registered

#: Twins of times that lines hold to the second, or the millisecond.
_SECOND, _MILLI = "date_trunc('second', ts)", "date_trunc('millisecond', ts)"


def _text(*parts: str | Column) -> Column:
    """Parts of a line: `%layout` is the event's time in a layout, `@name` a column, other texts stand for themselves."""
    made = [F.date_format("ts", p[1:]) if p[:1] == "%" else F.col(p[1:]).cast("string") if p[:1] == "@" else F.lit(p) for p in parts]
    return F.concat(*made)


def _graph(spark, sf, name: str, lines: list[Column], **fields: str):
    """One line of each branch in turn, by event; of its fields some, under short names."""
    line = F.lit(None).cast("string")
    for k, x in enumerate(lines):
        line = F.when(F.col("event_id") % len(lines) == k, x).otherwise(line)
    parsed = G.parse_graph(dealt(spark, sf, "events").select("event_id", line.alias("body_text")), name)
    return parsed.select("event_id", "ts", "severity_number", *[F.element_at("fields", v).alias(k) for k, v in fields.items()])


@registered("l3_graph_mysql", """
SELECT event_id, CASE WHEN event_id % 4 <> 1 THEN ts END AS ts, CASE event_id % 4 WHEN 2 THEN 13 ELSE 0 END AS severity_number,
       CASE event_id % 4 WHEN 0 THEN 'mysql.slow_query' WHEN 1 THEN 'mysql.server-start' WHEN 2 THEN 'mysql.error' ELSE 'mysql.general' END AS kind,
       CASE event_id % 4 WHEN 2 THEN event_type WHEN 3 THEN 'select ' || event_id END AS message,
       CASE WHEN event_id % 4 = 0 THEN 'UPDATE' END AS command, CASE WHEN event_id % 4 = 0 THEN CAST(user_id AS VARCHAR) END AS thread,
       CASE WHEN event_id % 4 = 0 THEN 'update ' || event_type END AS query, CASE WHEN event_id % 4 = 1 THEN '8.' || user_id END AS version
FROM events""")
def mysql(spark, sf):
    at = "%yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    slow = _text("# Time: ", at, "\n# User@Host: root[root] @ localhost []  Id: 1\n# Query_time: 0.1  Lock_time: 0.0 Rows_sent: 0  Rows_examined: 0\nThread_id: ", "@user_id", " Errno: 0 Killed: 0\nupdate ", "@event_type")
    start = _text("/usr/sbin/mysqld, Version: 8.", "@user_id", ". started with:\nTcp port: 1")
    lines = [slow, start, _text(at, " 7 [Warning] [MY-1] [Server] ", "@event_type"), _text(at, "\t 7 Query\tselect ", "@event_id")]
    return _graph(spark, sf, "mysql_logs", lines, kind="log_type", message="message", command="sql_command", thread="thread_id", query="query", version="version")


@registered("l3_graph_oracle", f"""
SELECT event_id, CASE event_id % 5 WHEN 0 THEN {_SECOND} WHEN 1 THEN {_SECOND} WHEN 2 THEN {_MILLI} WHEN 3 THEN {_SECOND} ELSE ts END AS ts, 0 AS severity_number,
       CASE WHEN event_id % 5 < 2 THEN 'oracledb.audit' ELSE 'oracledb.alert' END AS kind, CASE WHEN event_id % 5 < 2 THEN event_type END AS action,
       CASE WHEN event_id % 5 < 2 THEN CAST(user_id AS VARCHAR) END AS session, CASE WHEN event_id % 5 >= 2 THEN event_type END AS message
FROM events""")
def oracle(spark, sf):
    day = "%EEE MMM dd HH:mm:ss yyyy"
    lines = [
        _text(day, " +00:00\nLENGTH : '160'\nACTION :[7] '", "@event_type", "'\nSESSIONID:[1] '", "@user_id", "'\n"),
        _text(day, ' +00:00\nLENGTH: "257"\nSESSIONID:[6] "', "@user_id", '" ENTRYID:[1] "1" ACTION:[3] "', "@event_type", '"'),
        _text("<msg time='", "%yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "' level='1'>\n <txt>", "@event_type", "\n </txt>\n</msg>"),
        _text(day, "\n", "@event_type"), _text("%yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "+00:00\n", "@event_type"),
    ]
    return _graph(spark, sf, "oracle_database_logs", lines, kind="log_type", action="action", session="sessionid", message="message")


@registered("l3_graph_meraki", """
SELECT event_id, CAST(NULL AS TIMESTAMP) AS ts, CASE WHEN event_id % 3 = 2 THEN 17 ELSE 9 END AS severity_number, CASE WHEN event_id % 3 < 2 THEN '10.0.0.' || event_id % 250 END AS src_ip,
       CASE WHEN event_id % 3 = 0 THEN CAST(user_id AS VARCHAR) END AS src_port, CASE WHEN event_id % 3 < 2 THEN '53' END AS dport, CASE WHEN event_id % 3 = 1 THEN '9.9.9.9' END AS translated,
       CASE event_id % 3 WHEN 0 THEN 'pattern: ' || event_type WHEN 2 THEN event_type END AS message
FROM events""")
def meraki(spark, sf):
    address = F.concat(F.lit("10.0.0."), (F.col("event_id") % 250).cast("string"))
    lines = [
        F.concat(F.lit("<134>1 1563249630.77 MX flows src="), address, F.lit(":"), F.col("user_id").cast("string"), F.lit(" dst=8.8.8.8:53 mac=00:11 protocol=udp sport=1 dport=53 pattern: "), "event_type"),
        F.concat(F.lit("<134>1 1563249630.77 MX ip_flow src="), address, F.lit(" dst=8.8.8.8 protocol=udp sport=1 dport=53 translated_src_ip=9.9.9.9 translated_port=3")),
        _text("<131>1 1563249630.77 MX events ", "@event_type"),
    ]
    return _graph(spark, sf, "cisco_meraki_logs", lines, src_ip="src_ip", src_port="src_port", dport="dport", translated="translated_src_ip", message="message")


@registered("l3_graph_mongodb", f"SELECT event_id, {_MILLI} AS ts, CASE event_id % 2 WHEN 0 THEN 13 ELSE 9 END AS severity_number, 'NETWORK' AS component, 'conn' || user_id AS context, event_type AS message FROM events")
def mongodb(spark, sf):
    lines = [
        _text('{"t":{"$date":"', "%yyyy-MM-dd'T'HH:mm:ss.SSSXXX", '"},"s":"W","c":"NETWORK","id":1,"ctx":"conn', "@user_id", '","msg":"', "@event_type", '","attr":{"a":null}}'),
        _text("%yyyy-MM-dd'T'HH:mm:ss.SSSxx", " I NETWORK  [conn", "@user_id", "] ", "@event_type"),
    ]
    return _graph(spark, sf, "mongodb_logs", lines, component="component", context="context", message="message")


@registered("l3_graph_nginx", f"""
SELECT event_id, {_SECOND} AS ts, CASE event_id % 3 WHEN 0 THEN 13 WHEN 1 THEN 18 ELSE 17 END AS severity_number, CASE WHEN event_id % 3 = 1 THEN 'nginx.error' ELSE 'nginx.access' END AS kind,
       CASE event_id % 3 WHEN 0 THEN '404' WHEN 2 THEN '500' END AS status, CASE WHEN event_id % 3 <> 1 THEN '/' || event_type || '?u=' || user_id END AS url,
       CASE WHEN event_id % 3 = 1 THEN event_type || ', open' END AS message, CASE WHEN event_id % 3 = 1 THEN '10.0.0.1' END AS client
FROM events""")
def nginx(spark, sf):
    web = "%dd/MMM/yyyy:HH:mm:ss xx"
    lines = [
        _text('{"time_local":"', web, '","status":"404","request":"GET /', "@event_type", "?u=", "@user_id", ' HTTP/1.1"}'),
        _text("%yyyy/MM/dd HH:mm:ss", " [crit] 1#2: *3 ", "@event_type", ', open, client: 10.0.0.1, server: _, request: "GET / HTTP/1.1", host: "h"'),
        _text("10.0.0.1 - u [", web, '] "GET /', "@event_type", "?u=", "@user_id", ' HTTP/1.1" 500 12 "-" "agent"'),
    ]
    return _graph(spark, sf, "nginx_logs", lines, kind="log_type", status="http_request_status", url="http_request_requestUrl", message="message", client="client")


@registered("l3_graph_elasticsearch", f"SELECT event_id, {_MILLI} AS ts, CASE event_id % 2 WHEN 0 THEN 17 ELSE 0 END AS severity_number, CASE event_id % 2 WHEN 0 THEN 'server' ELSE 'safepoint,GC' END AS type, CASE WHEN event_id % 2 = 1 THEN CAST(user_id AS VARCHAR) END AS run, event_type AS message FROM events")
def elasticsearch(spark, sf):
    lines = [
        _text('{"type":"server","timestamp":"', "%yyyy-MM-dd'T'HH:mm:ss,SSS", 'Z","level":"ERROR","message":"', "@event_type", '"}'),
        _text("[", "%yyyy-MM-dd'T'HH:mm:ss.SSSxx", "][7][safepoint,GC] GC(", "@user_id", ") ", "@event_type"),
    ]
    return _graph(spark, sf, "elasticsearch_logs", lines, type="type", run="gc_run", message="message")


@registered("l3_graph_container", f"SELECT event_id, CASE event_id % 2 WHEN 0 THEN ts ELSE {_MILLI} END AS ts, 17 AS severity_number, CASE event_id % 2 WHEN 0 THEN 'stdout' ELSE 'stderr' END AS stream, CASE event_id % 2 WHEN 0 THEN event_type END AS message FROM events")
def container(spark, sf):
    lines = [
        _text('{"log":"{\\"level\\":\\"error\\",\\"msg\\":\\"', "@event_type", '\\"}","stream":"stdout","time":"', "%yyyy-MM-dd'T'HH:mm:ss.SSSSSS", '123Z"}'),
        _text("%yyyy-MM-dd'T'HH:mm:ss.SSS", "Z stderr F ", "@event_type"),
    ]
    return _graph(spark, sf, "container_logs", lines, stream="stream", message="msg")
