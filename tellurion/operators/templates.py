"""Log formats as configuration of one operator, syslog, and steps on fields (parse_logs, L7, L12)."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellurion.functions.expressions import column, holds
from tellurion.operators import parse

#: Kinds of fields that a layout can name; a field without a kind goes up to the text after it.
KINDS = {
    "int": r"\d+", "num": r"-?\d+(?:\.\d+)?", "word": r"\w+", "letter": "[A-Za-z]", "caps": "[A-Z]+(?: [A-Z]+)*", "token": r"\S+",
    "mark": r"[*#.\-]", "bracketed": r"\[[^\]]*\]", "all": ".+", "rest": r"(?s:.)*",
    "timed": r"(?:duration: (?P<duration>[\d.]+) ms)?(?s:.)*", "coded": r"(?:(?P<messageCode>\w+):)?(?s:.)*",
}
#: What letters of a time layout stand for, by letter and number; others are digits, as many as letters.
TIME_PARTS = {
    "MMM": "[A-Za-z]{3}", "d": r"\d{1,2}", "z": "[A-Za-z]{2,5}", "Z": r"[+-]\d{4}", "x": r"[+-]\d{2}(?:\d{2})?",
    "X": r"(?:Z|[+-]\d{2}(?:\d{2})?)", "XXX": r"(?:Z|[+-]\d{2}:\d{2})",
}


_TIME_TOKEN = re.compile(r"'(?P<quoted>[^']*)'|(?P<letters>([A-Za-z])\3*)|(?P<blank>\s+)|(?P<other>.)")


def time_pattern(layout: str) -> str:
    """A regular expression for times in a layout of Spark's letters; what stands in brackets may be missing."""
    out = []
    for m in _TIME_TOKEN.finditer(layout):
        if m["quoted"]:
            out.append(re.escape(m["quoted"]))
        elif m["letters"]:
            out.append(TIME_PARTS.get(m["letters"], rf"\d{{{len(m['letters'])}}}"))
        else:
            out.append(r"\s+" if m["blank"] else {"[": "(?:", "]": ")?"}.get(m["other"], re.escape(m["other"] or "")))
    return "".join(out)


def _is_time(kind: str) -> bool:
    return bool(kind) and kind not in KINDS


def _literal(text: str) -> str:
    """Fixed text: white space is any, and what stands between (? and ?) may be missing."""
    part = {"(?": "(?:", "?)": ")?"}
    return "".join(part.get(x) or (r"\s+" if x.isspace() else re.escape(x)) for x in re.findall(r"\(\?|\?\)|\s+|.", text))


def _stops(after: str) -> str:
    """The characters that can follow a field without a kind and so end it: the first of the fixed text after it, and before that of
    each part that may be missing. Other fields stand as NUL in `after`; what they begin with is not known, so the search ends there."""
    found, at, optional = [], 0, False
    while at < len(after):
        two = after[at : at + 2]
        if two == "(?":
            at, optional = at + 2, True
        elif two == "?)":
            at += 2  # the end of a part that the field itself stands in
        elif after[at] == "\0":
            break
        else:
            found.append(r"\s" if after[at].isspace() else re.escape(after[at]))
            if not optional:
                break
            depth, optional = 1, False
            while at < len(after) and depth:  # on to what follows the part
                step = after[at : at + 2]
                depth += (step == "(?") - (step == "?)")
                at += 2 if step in ("(?", "?)") else 1
    return "".join(dict.fromkeys(found))


def pattern_of(layout: str) -> str:
    """The regular expression of a layout, from its start: `{name:kind}` is a field of one of KINDS or of a time layout, `{name}` a
    field up to the text after it, `{_:kind}` one without a name, double braces are braces, and `(? ?)` parts may be missing."""
    parts = [(text, name, kind or "") for text, name, kind, _ in Formatter().parse(layout)]
    out = ["^"]
    for i, (text, name, kind) in enumerate(parts):
        out.append(_literal(text))
        if name is None:
            continue
        after = "".join(t + ("" if n is None else "\0") for t, n, _ in parts[i + 1 :])
        inner = KINDS.get(kind) or (time_pattern(kind) if kind else f"[^{_stops(after)}]*" if _stops(after) else KINDS["rest"])
        out.append(f"(?:{inner})" if name == "_" else f"(?P<{name}>{inner})")
    return "".join(out)


@dataclass(frozen=True)
class Template:
    """How to read one format: layouts of its lines, tried in order, and where the severity is found.

    With `several`, a record may span lines, and begins where a line has the first layout's text up to its time. With `priority` the
    level is a syslog priority, and `levels` goes by its rest modulo 8.
    """

    layouts: Sequence[str]
    level: str | Sequence[str] = ""
    levels: Mapping[str, int] = field(default_factory=dict)
    several: bool = False
    priority: bool = False

    @property
    def patterns(self) -> list[str]:
        return [pattern_of(x) for x in self.layouts]

    @property
    def start(self) -> str | None:
        """A regular expression of the lines that begin a record, or None where every line is one."""
        if not self.several:
            return None
        return "|".join(re.sub(r"\(\?P<\w+>", "(?:", pattern_of(_up_to_time(x))) for x in self.layouts)

    @property
    def times(self) -> list[tuple[str, str]]:
        """Fields that are times with a year, and their layouts."""
        return list(dict.fromkeys((n, k) for x in self.layouts for _, n, k, _ in Formatter().parse(x) if n not in (None, "_") and _is_time(k or "") and "yy" in k))


def _up_to_time(layout: str) -> str:
    """The layout's beginning, up to and with its first time."""
    out = []
    for text, name, kind, _ in Formatter().parse(layout):
        out.append(text.replace("{", "{{").replace("}", "}}"))
        if name is None:
            continue
        out.append(f"{{{name}:{kind}}}" if kind else f"{{{name}}}")
        if _is_time(kind or ""):
            break
    return "".join(out)


#: Severity numbers of level words (lower case) and of the first digit of an HTTP status.
LEVELS = {
    "trace": 1, "finest": 1, "debug": 5, "fine": 5, "d": 5, "info": 9, "information": 9, "i": 9, "log": 9, "notice": 10, "warn": 13, "warning": 13, "w": 13, "error": 17, "err": 17, "severe": 17, "e": 17,
    "critical": 18, "crit": 18, "alert": 19, "fatal": 21, "f": 21, "panic": 21, "emerg": 21,
}
STATUS_LEVELS = {"1": 9, "2": 9, "3": 9, "4": 13, "5": 17}

_WEB = "dd/MMM/yyyy:HH:mm:ss Z"
_DAY, _COMMA, _DOT = "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss,SSS", "yyyy-MM-dd HH:mm:ss.SSS"
_ZULU, _OFFSET, _PLAIN = (f"yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]{zone}" for zone in ("X", "XXX", "Z"))
_SYSLOG = "MMM d HH:mm:ss"
_ACCESS = '{remote_addr} {remote_host} {remote_user} [{time:' + _WEB + '}] "{method} {path}(? {protocol}/{protocol_version}?)" {status} {body_bytes_sent}'
_KLOG = "{severity:letter}{%s:MMdd HH:mm:ss.SSSSSS} {pid:int} {src}:{src_line}] {message:rest}"
_HAPROXY = "{timestamp:" + _SYSLOG + "} {host} {process_name}[{pid}]"
_HAPROXY_LOAD = "{process_concurrent_connections}/{frontend_concurrent_connections}/{backend_concurrent_connections}/{server_concurrent_connections}/{retries} {server_queue}/{backend_queue:int}"
#: Severity numbers of a syslog priority modulo 8 in formats of their own, and of event severities 0 to 10.
_BY_PRIORITY = {"0": 22, "1": 19, "2": 18, "3": 17, "4": 13, "5": 10, "6": 9, "7": 5}
_HOST_PRIORITY = {"0": 21, "1": 22, "2": 18, "3": 17, "4": 13, "5": 10, "6": 9, "7": 5}
_SWITCH_LEVELS = {"0": 21, "1": 19, "2": 18, "3": 17, "4": 14, "5": 13, "6": 9, "7": 5}
_EVENT_LEVELS = {"0": 9, "1": 9, "2": 9, "3": 9, "low": 9, "4": 13, "5": 13, "6": 13, "medium": 13, "7": 17, "8": 17, "high": 17, "9": 21, "10": 21, "very-high": 21}

#: The log formats: what their products write, as layouts. Names of formats and fields, layouts of times, levels.
TEMPLATES = {
    "aerospike_logs": Template(["{timestamp:MMM dd yyyy HH:mm:ss z}: {severity:caps} ({context}): ({source_file}:{source_location}) (?{{{namespace}}} ?){message:rest}"], "severity", {"detail": 9, "failed assertion": 18}),
    "apache_cassandra_logs": Template([f"{{severity:word}} [{{type}}] {{timestamp:{_COMMA}}} {{message:rest}}"], "severity", several=True),
    "apache_combined_logs": Template([_ACCESS + ' "{http_referer}" "{http_user_agent}"'], "status"),
    "apache_common_logs": Template([(_ACCESS + '(? "{http_referer}" "{http_user_agent}"(? {http_x_forwarded_for:token}?)?)')], "status"),
    "apache_http_logs": Template(
        ["[{_:word} {time:MMM dd HH:mm:ss.SSSSSS yyyy}] [{module}:{level:word}] [pid {pid:int}(?:tid {tid:int}?)] (?[client {client}] ?)(?{error_code:word}: ?){message:rest}", (_ACCESS + '(? "{http_referer}" "{http_user_agent}"?)')],
        ["status", "level"],
    ),
    "cisco_asa_logs": Template(["{timestamp:MMM dd yyyy HH:mm:ss}(? asa ?): %{message_id}: {message:rest}"]),
    "cisco_catalyst_logs": Template(["<{priority:int}>(? ?){sequence_number:int}: (?*?){timestamp:MMM d HH:mm:ss.SSS}: %{facility_text}-{severity:int}-{mnemonic}: {message:rest}"], "severity", _SWITCH_LEVELS),
    "cisco_meraki_logs": Template(["<{priority:int}>{version:int} {timestamp:num} {hostname} {app_name} {message:rest}"], "priority", _BY_PRIORITY, priority=True),
    "cockroachdb_logs": Template(["{Type:letter}{timestamp:yyMMdd HH:mm:ss.SSSSSS} {GoID:int} (?{Channel:int}@?){Location:token} (?\u22ee ?){Node:bracketed} (?{Counter:int} ?){Message:rest}"], "Type", several=True),
    "common_event_format_logs": Template([f"{{timestamp:{_SYSLOG}}} (?{{hostname:token}} ?)CEF:{{version}}|{{device_vendor}}|{{device_product}}|{{device_version}}|{{signature_id}}|{{name}}|{{severity}}|{{extensions:rest}}"], "severity", _EVENT_LEVELS),
    "container_logs": Template(["{time:yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS][.SSSSSS][.SSS]X} {stream:word} (?{partial:letter} ?){log:rest}"], "stream", {"stdout": 9, "stderr": 17}),
    "couchbase_logs": Template([f"[{{type}}:{{couchbase_severity}},{{timestamp:{_OFFSET}}},{{node}}@{{host}}:{{source}}]{{message:rest}}", f"{{timestamp:{_OFFSET}}} {{couchbase_severity}} {{type}}: {{message:rest}}"], "couchbase_severity", several=True),
    "couchdb_logs": Template(
        [
            f"[{{level:word}}] {{timestamp:{_ZULU}}} {{node}}@{{host}} <{{pid}}> {{_:token}} {{http_request_serverIp}} {{http_request_remoteIp}} {{remote_user}} {{http_request_requestMethod}} {{path}} {{http_request_status:int}} {{status_message}} {{http_request_responseSize:int}}",
            f"[{{level:word}}] {{timestamp:{_ZULU}}} {{node}}@{{host}} (?<{{pid}}> ?){{message:rest}}",
        ],
        "level", {"notice": 9}, several=True,
    ),
    "elasticsearch_logs": Template([f"[{{timestamp:{_PLAIN}}}][{{_:int}}][{{type}}] (?GC({{gc_run:int}}) ?){{message:rest}}"]),
    "esxi_logs": Template([f"<{{priority:int}}>{{timestamp:{_OFFSET}}} {{hostname}} {{service}}(?[{{pid}}]?): {{message:rest}}", f"<{{priority:int}}>{{month_day:{_SYSLOG}}} {{hostname}} {{service}}(?[{{pid}}]?)(?:?) {{message:rest}}"], "priority", _HOST_PRIORITY, priority=True),
    "hadoop_logs": Template([f"{{timestamp:{_DAY}}},{{_:int}} {{severity:word}} {{fqcn}}: {{message:rest}}"], "severity", several=True),
    "haproxy_logs": Template(
        [
            _HAPROXY + ": {client_ip}:{client_port} [{accept_date:dd/MMM/yyyy:HH:mm:ss.SSS}] {frontend_name_transport} {backend_name}/{server_name} {client_request_send_time}/{queue_wait_time}/{response_time}/{response_send_time}/{client_request_active_time} {status:int} {bytes_read:int} {captured_request_cookie} {captured_response_cookie} {termination_state} " + _HAPROXY_LOAD + " (?{{{_}}} ?)(?{{{_}}} ?)\"{method} {uri}(? {protocol}?)\"",
            _HAPROXY + ": {client_ip}:{client_port} [{accept_date:dd/MMM/yyyy:HH:mm:ss.SSS}] {frontend_name_transport} {backend_name}/{server_name} {queue_wait_time}/{server_response_time}/{session_duration} {bytes_read} {termination_state} " + _HAPROXY_LOAD,
            _HAPROXY + ": [{severity}] {message:rest}", _HAPROXY + ": {message:rest}",
        ],
        ["status", "severity"], {"emerg": 21, "alert": 22, "crit": 23},
    ),
    "hbase_logs": Template([f"{{timestamp:{_DAY}}},{{_:int}} {{hbase_severity:word}} [{{thread}}] {{hbase_source}}: {{message:rest}}", "{_:word} {timestamp:MMM dd HH:mm:ss z yyyy} {message:rest}"], "hbase_severity", several=True),
    "iis_logs": Template([f"{{timestamp:{_DAY}}} {{s_ip}} {{cs_method}} {{cs_uri_stem}} {{cs_uri_query}} {{s_port:int}} {{cs_username}} {{c_ip}} {{cs_user_agent}} {{cs_referer}} {{sc_status:int}} {{sc_substatus:int}} {{sc_win32_status:int}} {{time_taken:int}}"], "sc_status"),
    "ingress_nginx_logs": Template(
        [
            '{remote_addr} - {remote_user} [{time:' + _WEB + '}] "{method} {path}(? {protocol}?)" {status:int} {body_bytes_sent:int} "{http_referer}" "{http_user_agent}" {request_length:int} {request_time:num} [{proxy_upstream_name}] [{proxy_alternative_upstream_name}] {upstream_addr} {upstream_response_length} {upstream_response_time} {upstream_status} {request_id:word}',
            _KLOG % "month_day",
        ],
        ["status", "severity"],
    ),
    "jboss_logs": Template([f"{{timestamp:{_DAY}}},{{_:int}} {{jboss_severity:word}} [{{category}}] ({{thread}}) (?{{id:word}}: ?){{message:rest}}"], "jboss_severity", several=True),
    "kafka_logs": Template([f"[{{time:{_COMMA}}}] {{severity:word}} {{message:rest}}"], "severity", several=True),
    "kubelet_logs": Template([_KLOG % "timestamp"], "severity"),
    "macos_logs": Template([start + " (?{host} ?)(?{process}[{pid}]?)(? ({subprocess}(?[{spid}]?))?)(?: ?){message:rest}" for start in ("{timestamp:yyyy-MM-dd HH:mm:ssx}", "{timestamp:MMM d HH:mm:ss}")], several=True),
    "mongodb_logs": Template([f"{{timestamp:{_PLAIN}}} {{severity:word}} {{component}} [{{context}}] {{message:rest}}"], "severity"),
    "mysql_logs": Template(
        [
            f"# Time: {{timestamp:{_ZULU}}} # User@Host: {{user}}[{{_}}] @ (?{{host:token}} ?)[{{ip}}] Id: {{tid:int}} # Query_time: {{query_time:num}} Lock_time: {{lock_time:num}} Rows_sent: {{rows_sent:int}} Rows_examined: {{rows_examined:int}} {{message:rest}}",
            f"{{timestamp:{_ZULU}}} {{tid:int}} [{{mysql_severity}}] {{message:rest}}", f"{{timestamp:{_ZULU}}} {{tid:int}} {{command:word}}(? {{message:rest}}?)",
        ],
        "mysql_severity", {"system": 10, "note": 10}, several=True,
    ),
    "nginx_logs": Template(['{http_request_remoteIp} {host} {user} [{time_local:' + _WEB + '}] "{http_request_requestMethod}(? {http_request_requestUrl}(? {http_request_protocol}?)?)" {http_request_status:int} {http_request_responseSize:token}(? "{http_request_referer}" "{http_request_userAgent}"?)'], "http_request_status"),
    "oracle_database_logs": Template([f"{{timestamp:{_OFFSET}}} {{message:rest}}", "{_:word} {timestamp:MMM dd HH:mm:ss yyyy} {message:rest}"], several=True),
    "pgbouncer_logs": Template([f"{{timestamp:{_DOT}[ z]}} (?[?){{pid:int}}(?]?) {{severity:word}} {{message:rest}}"], "severity", {"stats": 10, "noise": 5}),
    "postgresql_logs": Template([f"{{timestamp:{_DOT} z}} [{{tid:int}}](? {{role}}@{{user:token}}?) {{level:word}}: {{message:timed}}"], "level", several=True),
    "rabbitmq_logs": Template(["{timestamp:yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]XXX} [{severity:word}] <{process_id}> {message:rest}"], "severity", several=True),
    "redis_logs": Template(["(?[?){pid:int}(?:?)(?{role:letter}?)(?]?) {timestamp:dd MMM yyyy HH:mm:ss.SSS} {level:mark} {message:rest}"], "level", {".": 5, "-": 9, "*": 10, "#": 13}, several=True),
    "sap_hana_logs": Template(["[{thread_id:int}]{{{connection_id}}}[{transaction_id}/{update_transaction_id}] {timestamp:yyyy-MM-dd HH:mm:ss.SSSSSS} {sap_severity} {component} {source_file} : {message:rest}"], "sap_severity", several=True),
    "solr_logs": Template([f"{{timestamp:{_DOT}}} {{level:word}} ({{thread}}) [c:{{collection}} s:{{shard}} r:{{replica}} x:{{core}}] {{source}} {{message:rest}}", f"{{timestamp:{_DOT}}} {{level:word}} ({{thread}}) [ ] {{source}} {{message:rest}}"], "level", several=True),
    "tomcat_logs": Template(['{remote_host} - {remote_user} [{timestamp:' + _WEB + '}] "{method} {path}(? {protocol}?)" {status:int} {bytes_sent}', "{timestamp:dd-MMM-yyyy HH:mm:ss.SSS} {tomcat_severity:word} [{thread}] {tc_source} {message:rest}"], ["status", "tomcat_severity"]),
    "ubiquiti_logs": Template(["<{priority:int}>{timestamp_field:MMM d HH:mm:ss} {mac_address},{device}: {process}: {message:rest}", "<{priority:int}>{name} {device},{mac_address},{firmware_version}: {service}: {message:rest}", "<{priority:int}>{message:rest}"], "priority", _BY_PRIORITY, priority=True),
    "vcenter_logs": Template([f"<{{priority:int}}>{{version:int}} {{timestamp:{_OFFSET}}} {{hostname}} {{service}} {{pid}} {{msgid}} {{message:rest}}"], "priority", _HOST_PRIORITY, priority=True),
    "wildfly_logs": Template([f"{{timestamp:{_COMMA}}} {{level:word}}(? [{{source}}]?)(? ({{thread}})?) {{message:coded}}"], "level", several=True),
    "windows_dhcp": Template(["{id:int},{timestamp:MM/dd/yy,HH:mm:ss},{description},{ip_address},{hostname},{mac_address},{username},{transaction_id},{q_result},{probation_time},{correlation_id},{dhc_id},{rest:rest}"]),
    "zookeeper_logs": Template([f"{{timestamp:{_COMMA}}} (?[myid:(?{{myid:int}}?)] ?)- {{zookeeper_severity:word}} [{{thread:all}}:{{source}}@{{line:int}}] - {{message:rest}}"], "zookeeper_severity"),
}


def level_number(level: Column, own: Mapping[str, int] | None = None) -> Column:
    """The severity number of a level word or an HTTP status; 0 for others."""
    words = F.create_map(*[x for k, v in (LEVELS | dict(own or {})).items() for x in (F.lit(k), F.lit(v))])
    status = F.create_map(*[x for k, v in STATUS_LEVELS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(words, F.lower(F.trim(level))), F.when(level.rlike(r"^[1-5]\d\d$"), F.try_element_at(status, F.substring(level, 1, 1))), F.lit(0))


def parse_logs(df: DataFrame, template: str | Template, col: str = "body_text") -> DataFrame:
    """Rows of one format with `fields` (named groups that took part), `ts` and `severity_number`.

    The first layout that matches counts. Rows that none matches stay, with null fields and ts and severity 0. Times without a year
    stay text. Lines of formats whose records span lines are put together before this, by `parse.assemble_multiline` with the
    template's `start`.
    """
    t = TEMPLATES[template] if isinstance(template, str) else template
    found, out = [], df
    for i, p in enumerate(t.patterns):
        out = parse.regex_parse(out, col, p, f"_p{i}")
        names = out.schema[f"_p{i}"].dataType.names
        named = F.create_map(*[x for n in names for x in (F.lit(n), F.nullif(F.col(f"_p{i}.{n}"), F.lit("")))])
        found.append(F.when(F.col(f"_p{i}").isNotNull(), F.map_filter(named, lambda _, v: v.isNotNull())))
    out = out.withColumn("fields", F.coalesce(*found)).drop(*[f"_p{i}" for i in range(len(t.patterns))])
    times = [F.try_to_timestamp(F.try_element_at("fields", F.lit(name)), F.lit(layout)) for name, layout in t.times]
    level = F.coalesce(*[F.try_element_at("fields", F.lit(x)) for x in ([t.level] if isinstance(t.level, str) else t.level)])
    if t.priority:
        level = F.pmod(level.try_cast("int"), F.lit(8)).cast("string")
    return out.withColumns({"ts": F.coalesce(*times) if times else F.lit(None).cast("timestamp"), "severity_number": level_number(level, t.levels) if t.level else F.lit(0)})


#: Severity numbers of the eight syslog severities, from emergency to debug.
SYSLOG_LEVELS = (21, 19, 18, 17, 13, 10, 9, 5)
_RFC5424 = r"^<(?P<pri>\d{1,3})>(?P<version>\d+) (?P<time>\S+) (?P<host>\S+) (?P<app>\S+) (?P<proc>\S+) (?P<msgid>\S+) (?:-|(?P<data>\[.*?\]))(?: (?P<message>(?s:.)*))?$"
_RFC3164 = r"^<(?P<pri>\d{1,3})>(?P<time>\w{3}\s+\d{1,2} \d{2}:\d{2}:\d{2}) (?P<host>\S+) (?P<app>[^\s\[:]+)(?:\[(?P<proc>[^\]]*)\])?: ?(?P<message>(?s:.)*)$"


def syslog_parse(df: DataFrame, col: str, into: str = "syslog") -> DataFrame:
    """Add the parts of a syslog line of either form, with facility and severity of its priority; null where it is none.

    Priorities over 191 are none. A missing part is null; times of the older form have no year and stay text.
    """
    forms = []
    out = df
    for i, p in enumerate((_RFC5424, _RFC3164)):
        out = parse.regex_parse(out, col, p, f"_s{i}")
        f = F.col(f"_s{i}")
        part = lambda n, f=f: F.nullif(F.nullif(f[n], F.lit("")), F.lit("-"))
        pri = f["pri"].try_cast("int")
        level = F.element_at(F.array(*[F.lit(x) for x in SYSLOG_LEVELS]), pri % 8 + 1)
        forms.append(F.when(f.isNotNull() & (pri <= 191), F.struct(
            F.floor(pri / 8).cast("int").alias("facility"), (pri % 8).alias("severity"), level.alias("severity_number"), part("time").alias("time"), part("host").alias("host"), part("app").alias("app"),
            part("proc").alias("proc"), (part("msgid") if i == 0 else F.lit(None).cast("string")).alias("msgid"), (F.nullif(f["data"], F.lit("")) if i == 0 else F.lit(None).cast("string")).alias("data"), f["message"].alias("message"),
        )))
    return out.withColumn(into, F.coalesce(*forms)).drop("_s0", "_s1")


def change_fields(df: DataFrame, steps: Sequence[tuple], col: str = "attributes") -> DataFrame:
    """Steps on a text map, in their order: ("copy" | "move", from, to), ("add", name, expression), ("remove", *names), ("retain",
    *names). A step may be (step, condition): rows for which it does not hold keep their map. A missing source changes nothing."""
    for given in steps:
        step, cond = given if isinstance(given[0], tuple) else (given, None)
        kind, *args = step
        m = F.col(col)
        if kind in ("copy", "move"):
            old, new = args
            left = _without(m, [new, old] if kind == "move" else [new])
            done = F.when(F.map_contains_key(m, F.lit(old)), F.map_concat(left, F.create_map(F.lit(new), F.try_element_at(m, F.lit(old))))).otherwise(m)
        elif kind == "add":
            done = F.map_concat(_without(m, [args[0]]), F.create_map(F.lit(args[0]), column(args[1]).cast("string")))
        elif kind == "remove":
            done = _without(m, args)
        elif kind == "retain":
            done = F.map_filter(m, lambda k, _: k.isin(list(args)))
        else:
            raise ValueError(f"no such step: {kind}")
        df = df.withColumn(col, F.when(holds(cond), done).otherwise(m) if cond is not None else done)
    return df


def _without(m: Column, names: Sequence[str]) -> Column:
    return F.map_filter(m, lambda k, _: ~k.isin(list(names)))
