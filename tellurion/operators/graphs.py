"""Graphs of steps on log lines, compiled to one projection in which only a row's own branch is evaluated (parse_logs, L3, L12)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellurion.operators.parse import captured, group_names
from tellurion.operators.templates import TEMPLATES, level_number, pattern_of

#: What a row is while its steps run.
STATE = "struct<body:string,fields:map<string,string>,ts:timestamp,severity_number:int,kept:boolean>"


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value that is computed once, however often `then` names it.

    A fold over nothing ends with `then` of where it began; unlike an element's transformation it hands the result on without a copy.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda x, _: x, then)


def part(s: Column, name: str) -> Column:
    """The body, or a field."""
    return s["body"] if name == "body" else F.try_element_at(s["fields"], F.lit(name))


def changed(s: Column, **new: Column) -> Column:
    return F.struct(*[(new[n] if n in new else s[n]).alias(n) for n in ("body", "fields", "ts", "severity_number", "kept")])


def over(fields: Column, new: Column) -> Column:
    """A map with the entries of another in place of its own; null values of the other replace nothing."""
    return F.map_zip_with(fields, new, lambda _, old, now: F.coalesce(now, old))


def put(s: Column, new: Column) -> Column:
    """The fields with those of a map over them."""
    return over(s["fields"], new)


def put_present(s: Column, *pairs: tuple[str, Column]) -> Column:
    """The fields with those values over them that are not null."""
    return F.map_filter(put(s, F.create_map(*[x for k, v in pairs for x in (F.lit(k), v)])), lambda _, v: v.isNotNull())


def _without(s: Column, names: Sequence[str]) -> Column:
    return F.map_filter(s["fields"], lambda k, _: ~k.isin(list(names)))


# ---------------------------------------------------------------- conditions


@dataclass(frozen=True)
class When:
    """A condition on a row's state; `&`, `|` and `~` combine them. A null is false."""

    test: Callable[[Column], Column]

    def on(self, s: Column) -> Column:
        return F.coalesce(self.test(s), F.lit(False))

    def __and__(self, other: When) -> When:
        return When(lambda s: self.on(s) & other.on(s))

    def __or__(self, other: When) -> When:
        return When(lambda s: self.on(s) | other.on(s))

    def __invert__(self) -> When:
        return When(lambda s: ~self.on(s))


def begins(text: str, name: str = "body") -> When:
    return When(lambda s: part(s, name).startswith(text))


def matches(pattern: str, name: str = "body") -> When:
    return When(lambda s: part(s, name).rlike(pattern))


def has(name: str) -> When:
    return When(lambda s: part(s, name).isNotNull())


def equals(name: str, value: str) -> When:
    return When(lambda s: part(s, name) == value)


# ---------------------------------------------------------------- steps


class Step:
    """What a step makes of a row's state. One that does not fit a row leaves it as it is."""

    def apply(self, s: Column) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class Regex(Step):
    """Fields from the named groups of a regular expression, or of a layout as in TEMPLATES, that took part."""

    pattern: str
    source: str = "body"
    layout: bool = False

    def apply(self, s: Column) -> Column:
        rx = pattern_of(self.pattern) if self.layout else self.pattern
        names = group_names(rx)

        def fields(groups: Column) -> Column:
            found = [(n, F.nullif(F.get(groups, F.lit(i + 1)), F.lit(""))) for i, n in enumerate(names)]
            return F.when(groups.isNotNull(), changed(s, fields=put_present(s, *found) if found else s["fields"])).otherwise(s)

        return let(captured(part(s, self.source), rx), fields)


@dataclass(frozen=True)
class Json(Step):
    """Fields from a JSON object: texts and numbers as text, what is nested as JSON; nulls give none. With `prefix`, before each name."""

    source: str = "body"
    prefix: str = ""

    def apply(self, s: Column) -> Column:
        def fields(m: Column) -> Column:
            named = F.transform_keys(m, lambda k, _: F.concat(F.lit(self.prefix), k)) if self.prefix else m
            return F.when(m.isNotNull(), changed(s, fields=put(s, F.map_filter(named, lambda _, v: v.isNotNull())))).otherwise(s)

        text = F.trim(part(s, self.source))
        return let(F.when(text.startswith("{") & F.try_parse_json(text).isNotNull(), F.from_json(text, "map<string,string>")), fields)


@dataclass(frozen=True)
class Csv(Step):
    """Fields by a header; a line with another number of fields stays as it is."""

    header: str
    source: str = "body"
    delimiter: str = ","

    def apply(self, s: Column) -> Column:
        names = [h.strip() for h in self.header.split(self.delimiter)]
        schema = ", ".join([*(f"c{i} string" for i in range(len(names))), "bad string"])

        def fields(got: Column) -> Column:
            m = put_present(s, *[(n, got[f"c{i}"]) for i, n in enumerate(names)])
            return F.when(got["bad"].isNull() & got.isNotNull(), changed(s, fields=m)).otherwise(s)

        return let(F.from_csv(part(s, self.source), schema, {"sep": self.delimiter, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"}), fields)


@dataclass(frozen=True)
class Pairs(Step):
    """Fields from pairs of names and values that a text begins with. `pair` has the two as its groups; the first of equal names counts.
    Names may be renamed, else are lower case with `_` for other characters; `rest` is the field for the text after the pairs."""

    pair: str
    source: str = "body"
    rename: Mapping[str, str] = field(default_factory=dict)
    rest: str | None = None
    anywhere: bool = False

    def apply(self, s: Column) -> Column:
        text = part(s, self.source)
        run = rf"^(?:\s*{_unnamed(self.pair)})+"
        head = text if self.anywhere else F.regexp_extract(text, run, 0)
        given = F.create_map(*[x for k, v in self.rename.items() for x in (F.lit(k), F.lit(v))]) if self.rename else None
        plain = lambda k: F.regexp_replace(F.lower(k), "[^a-z0-9]", "_")
        name = (lambda k: F.coalesce(F.try_element_at(given, k), plain(k))) if given is not None else plain

        def first_of_each(keys: Column, values: Column) -> Column:
            both = F.zip_with(keys, values, lambda k, v: F.struct(k.alias("k"), v.alias("v")))
            firsts = F.map_from_entries(F.filter(both, lambda e, i: F.array_position(keys, e["k"]) == i + 1))
            return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.map_from_arrays(keys, values)).otherwise(firsts)

        def merged(h: Column, found: Column) -> Column:
            if self.rest is None:
                return put(s, found)
            left = F.regexp_replace(text, run, "") if self.anywhere else F.substring(text, F.length(h) + 1, F.length(text))
            after = F.nullif(F.regexp_replace(left, r"^\s+|\s+$", ""), F.lit(""))
            others = F.map_filter(over(s["fields"], found), lambda k, _: k != self.rest)
            return let(after, lambda x: F.when(x.isNull(), others).otherwise(F.map_concat(others, F.create_map(F.lit(self.rest), x))))

        def pairs(h: Column) -> Column:
            keys, values = F.transform(F.regexp_extract_all(h, F.lit(self.pair), F.lit(1)), name), F.regexp_extract_all(h, F.lit(self.pair), F.lit(2))
            fields = let(keys, lambda k: let(values, lambda v: merged(h, first_of_each(k, v))))
            return F.when(h != "", changed(s, fields=fields)).otherwise(s)

        return let(head, pairs)


def _unnamed(pattern: str) -> str:
    """The pattern with its plain groups uncaptured."""
    out, i = [], 0
    while i < len(pattern):
        if pattern[i] == "\\":
            out.append(pattern[i : i + 2])
            i += 2
            continue
        out.append("(?:" if pattern[i] == "(" and pattern[i + 1 : i + 2] != "?" else pattern[i])
        i += 1
    return "".join(out)


@dataclass(frozen=True)
class Uri(Step):
    """Fields scheme, host, path and query of a URI or a path with a query, those that it has, after `prefix`."""

    source: str
    prefix: str = ""

    def apply(self, s: Column) -> Column:
        text = part(s, self.source)
        whole = F.when(text.startswith("/"), F.concat(F.lit("x://x"), text)).otherwise(text)
        own = lambda p: F.when(~text.startswith("/"), F.try_parse_url(whole, F.lit(p)))
        found = {"scheme": own("PROTOCOL"), "host": own("HOST"), "path": F.try_parse_url(whole, F.lit("PATH")), "query": F.try_parse_url(whole, F.lit("QUERY"))}
        m = put_present(s, *[(self.prefix + k, F.nullif(v, F.lit(""))) for k, v in found.items()])
        return F.when(text.isNotNull(), changed(s, fields=m)).otherwise(s)


@dataclass(frozen=True)
class Move(Step):
    """A field under another name; the body may be the target. With `keep`, a copy."""

    old: str
    new: str
    keep: bool = False

    def apply(self, s: Column) -> Column:
        def moved(v: Column) -> Column:
            left = _without(s, [self.new] if self.keep else [self.old, self.new])
            if self.new == "body":
                return F.when(v.isNotNull(), changed(s, body=v, fields=s["fields"] if self.keep else _without(s, [self.old]))).otherwise(s)
            return F.when(v.isNotNull(), changed(s, fields=F.map_concat(left, F.create_map(F.lit(self.new), v)))).otherwise(s)

        return let(part(s, self.old), moved)


@dataclass(frozen=True)
class Add(Step):
    """A field from a text, or from what a function makes of the state; null adds none."""

    name: str
    value: str | Callable[[Column], Column]

    def apply(self, s: Column) -> Column:
        if isinstance(self.value, str):
            return changed(s, fields=put(s, F.create_map(F.lit(self.name), F.lit(self.value))))
        return changed(s, fields=put_present(s, (self.name, self.value(s).cast("string"))))


@dataclass(frozen=True)
class Remove(Step):
    names: Sequence[str]

    def apply(self, s: Column) -> Column:
        return changed(s, fields=_without(s, self.names))


@dataclass(frozen=True)
class Retain(Step):
    names: Sequence[str]

    def apply(self, s: Column) -> Column:
        return changed(s, fields=F.map_filter(s["fields"], lambda k, _: k.isin(list(self.names))))


@dataclass(frozen=True)
class Severity(Step):
    """The severity number of a field: a level word, an HTTP status, or with `modulo` a syslog priority; none leaves it as it was."""

    source: str
    levels: Mapping[str, int] = field(default_factory=dict)
    modulo: int = 0

    def apply(self, s: Column) -> Column:
        v = part(s, self.source)
        v = F.pmod(v.try_cast("int"), F.lit(self.modulo)).cast("string") if self.modulo else v
        return changed(s, severity_number=let(v, lambda w: let(level_number(w, self.levels), lambda n: F.when(n != 0, n).otherwise(s["severity_number"]))))


@dataclass(frozen=True)
class Time(Step):
    """The time of a field in the first layout that fits."""

    source: str
    layouts: Sequence[str]

    def apply(self, s: Column) -> Column:
        return changed(s, ts=F.coalesce(*[F.try_to_timestamp(part(s, self.source), F.lit(x)) for x in self.layouts], s["ts"]))


@dataclass(frozen=True)
class Keep(Step):
    """Rows for which the condition doesn't hold are left out of the result."""

    cond: When

    def apply(self, s: Column) -> Column:
        return changed(s, kept=s["kept"] & self.cond.on(s))


@dataclass(frozen=True)
class Route(Step):
    """The steps of the first case that holds, else `default`. No other case's steps are evaluated for the row."""

    cases: Sequence[tuple[When, Sequence[Step]]]
    default: Sequence[Step] = ()

    def apply(self, s: Column) -> Column:
        out = None
        for cond, steps in self.cases:
            out = F.when(cond.on(s), run(s, steps)) if out is None else out.when(cond.on(s), run(s, steps))
        return run(s, self.default) if out is None else out.otherwise(run(s, self.default))


def run(s: Column, steps: Sequence[Step]) -> Column:
    """The state after all steps, each of which sees the one before it once computed."""
    if not steps:
        return s
    return let(steps[0].apply(s), lambda after: run(after, steps[1:])) if len(steps) > 1 else steps[0].apply(s)


def parse_graph(df: DataFrame, graph: str | Sequence[Step], col: str = "body_text") -> DataFrame:
    """Rows with `fields`, `ts`, `severity_number` and the body as the graph's steps leave them; columns of these names are replaced.

    A row that no step fits has no fields, a null time and severity 0; a null text stays as such a row. Rows that a `Keep` rejects
    are left out.
    """
    steps = GRAPHS[graph] if isinstance(graph, str) else graph
    start = F.struct(F.col(col).alias("body"), F.expr("cast(map() as map<string,string>)").alias("fields"), F.lit(None).cast("timestamp").alias("ts"), F.lit(0).alias("severity_number"), F.lit(True).alias("kept"))
    state = "_state" + "_" * max((len(c) for c in df.columns), default=0)
    out = df.withColumn(state, let(start, lambda s: run(s, steps)))
    if _keeps(steps):
        out = out.where(F.col(f"{state}.kept"))
    return out.withColumns({n: F.col(f"{state}.{n}") for n in ("body", "fields", "ts", "severity_number")}).drop(state)


def _keeps(steps: Sequence[Step]) -> bool:
    return any(isinstance(x, Keep) or (isinstance(x, Route) and (_keeps(x.default) or any(_keeps(c) for _, c in x.cases))) for x in steps)


# ---------------------------------------------------------------- formats


def _template(name: str, which: int = 0) -> list[Step]:
    """One layout of a format of TEMPLATES, with its times and levels."""
    t = TEMPLATES[name]
    levels = [t.level] if isinstance(t.level, str) else list(t.level)
    return [Regex(t.layouts[which], layout=True), *(Time(n, [k]) for n, k in t.times), *(Severity(x, t.levels, 8 if t.priority else 0) for x in levels if x)]


_OBJECT = matches(r"^\s*\{(?s:.)*\}\s*$")
_ZONED = ("yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS][.SSSSSS][.SSS]XXX", "yyyy-MM-dd'T'HH:mm:ss,SSSX")
#: Names of fields for the extra counters of a slow query.
_SLOW = {
    "Thread_id": "thread_id", "Errno": "errorNumber", "Killed": "killed", "Bytes_received": "bytesReceived", "Bytes_sent": "bytesSent", "Read_first": "readFirst", "Read_last": "readLast",
    "Read_key": "readKey", "Read_next": "readNext", "Read_prev": "readPrev", "Read_rnd": "readRnd", "Read_rnd_next": "readRndNext", "Sort_merge_passes": "sortMergePasses",
    "Sort_range_count": "sortRangeCount", "Sort_rows": "sortRows", "Sort_scan_count": "sortScanCount", "Created_tmp_disk_tables": "createdTmpDiskTables", "Created_tmp_tables": "createdTmpTables",
    "Start": "startTime", "End": "endTime",
}
#: The SQL commands that a query is known by.
SQL_COMMANDS = (
    "ALTER ANALYZE BEGIN CACHE CALL CHANGE CHECK COMMIT COPY CREATE DELETE DO DROP EXECUTE FLUSH GRANT HANDLER IMPORT INSERT INSTALL LOAD LOCK OPTIMIZE PREPARE PURGE RELEASE RENAME REPAIR REPLACE "
    "RESET REVOKE ROLLBACK SAVEPOINT SELECT SET SHOW SHUTDOWN START STOP TRUNCATE UNINSTALL UNLOCK UPDATE USE WITH"
).split()


def _sql_command(s: Column) -> Column:
    word = F.upper(F.regexp_extract(part(s, "query"), r"^\s*([A-Za-z]+)\b", 1))
    return F.when(word.isin(SQL_COMMANDS), word)


#: An audit record's names that stand for other fields.
_AUDIT = {"STATUS": "status_code", "PRIV$USED": "priv_used"}
_AUDIT_PAIR = r"""([A-Z][A-Z$ ]*?) ?:(?:\[\d+\])? ?['"]([^'"]*)['"]"""
_FLOW_PAIR = r"\b(src|dst|mac|user|protocol|sport|dport|translated_src_ip|translated_port)=(\S*)"
_AUDIT_TIME = r"^\w{3} \w{3} +\d{1,2} \d\d:\d\d:\d\d \d{4}"


def _address(name: str) -> Regex:
    return Regex(rf"^(?P<{name}_ip>\d{{1,3}}(?:\.\d{{1,3}}){{3}})(?::(?P<{name}_port>\d*))?", source=name)


_REQUEST = Regex(r"^(?P<http_request_requestMethod>\S+) +(?P<http_request_requestUrl>\S*)(?: (?P<http_request_protocol>[^/\s]+)/(?P<http_request_protocol_version>\S+))?", source="request")

#: The formats of more than one shape, each as a graph: what products write, from their documentation.
GRAPHS: dict[str, Sequence[Step]] = {
    "mysql_logs": [
        Route(
            [
                (begins("# Time: "), [
                    *_template("mysql_logs", 0), Move("message", "query"),
                    Route([(matches(r"^\s*Thread_id: ", "query"), [Pairs(r"([A-Z][A-Za-z_]*): (\S+)", "query", _SLOW, rest="query")])]),
                    Add("sql_command", _sql_command), Add("log_type", "mysql.slow_query"),
                ]),
                (matches(r"^/\w+/\w+/mysqld, Version: "), [Regex(r"^(?P<path>/\w+/\w+/mysqld), Version: (?P<version>.+?)\. (?P<started_with>(?s:.)+)$"), Add("log_type", "mysql.server-start")]),
                (matches(r"^\S+\s+\d+\s+\["), [
                    *_template("mysql_logs", 1),
                    Regex(r"^\[(?P<error_code>[^\]]+)\] \[(?P<subsystem>[^\]]+)\] (?P<message>(?s:.)*)$", source="message"), Add("log_type", "mysql.error"),
                ]),
            ],
            [*_template("mysql_logs", 2), Add("log_type", "mysql.general")],
        ),
    ],
    "oracle_database_logs": [
        Route([
            (begins("Audit file "), [Move("body", "message", keep=True), Add("log_type", "oracledb.audit")]),
            (matches(_AUDIT_TIME + r" [+-]\d\d:\d\d\s+LENGTH"), [
                Regex(_AUDIT_TIME.replace("^", "^(?P<timestamp>") + r" [+-]\d\d:\d\d)\s+(?P<record>(?s:.)*)$"), Regex(r"^\w+ (?P<at>.*)$", source="timestamp"), Time("at", ["MMM d HH:mm:ss yyyy XXX", "MMM  d HH:mm:ss yyyy XXX"]),
                Pairs(_AUDIT_PAIR, "record", _AUDIT, anywhere=True), Remove(["record", "at"]), Add("log_type", "oracledb.audit"),
            ]),
            (begins("<msg time="), [
                Regex(r"""^<msg time=['"](?P<timestamp>[^'"]*)['"]"""), Time("timestamp", _ZONED), Regex(r"<txt>\s*(?P<message>(?s:.)*?)\s*</txt>"),
                Pairs(r"""\b([a-z_]+)=['"]([^'"]*)['"]""", "body", {"time": "timestamp"}, anywhere=True), Add("log_type", "oracledb.alert"),
            ]),
            (matches(_AUDIT_TIME), [*_template("oracle_database_logs", 1), Add("log_type", "oracledb.alert")]),
        ], [*_template("oracle_database_logs", 0), Add("log_type", "oracledb.alert")]),
    ],
    "cisco_meraki_logs": [
        *_template("cisco_meraki_logs"),
        Route([(matches(r"^src=\S*\s+dst=", "message"), [
            Pairs(_FLOW_PAIR, "message", {k: k for k in ("translated_src_ip", "translated_port")}, rest="message"), _address("src"), _address("dst"),
        ])]),
        Add("log_type", "cisco.meraki"),
    ],
    "mongodb_logs": [
        Route([(_OBJECT, [
            Json(), Add("timestamp", lambda s: F.get_json_object(part(s, "t"), "$['$date']")), Time("timestamp", _ZONED), Severity("s", {f"d{i}": 5 for i in range(1, 6)}),
            Move("c", "component"), Move("ctx", "context"), Move("msg", "message"), Move("s", "severity"), Remove(["t"]),
        ])], _template("mongodb_logs")),
        Add("log_type", "mongodb"),
    ],
    "nginx_logs": [
        Route([
            (begins("{"), [Json(), Time("time_local", ["dd/MMM/yyyy:HH:mm:ss Z"]), Severity("status"), Move("status", "http_request_status"), _REQUEST, Add("log_type", "nginx.access")]),
            (matches(r"^\d{4}/\d\d/\d\d "), [
                Regex(r"^(?P<time>\d{4}/\d\d/\d\d \d\d:\d\d:\d\d) \[(?P<log_level>\w+)\] (?P<pid>\d+)#(?P<tid>\d+):(?: \*(?P<connection>\d+))? (?P<message>(?s:.)*)$"),
                Time("time", ["yyyy/MM/dd HH:mm:ss"]), Severity("log_level", {"crit": 18, "emerg": 19}),
                Regex(r"^(?P<text>(?s:.)*?), (?P<context>client: (?s:.)*)$", source="message"),
                Pairs(r'\b(client|server|request|subrequest|upstream|host|referrer): "?([^",]*)"?', "context", {"referrer": "referer"}, anywhere=True),
                Move("text", "message"), Remove(["context"]), Add("log_type", "nginx.error"),
            ]),
        ], [*_template("nginx_logs"), Add("log_type", "nginx.access")]),
    ],
    "elasticsearch_logs": [
        Route([(begins("{"), [Json(), Time("timestamp", _ZONED), Severity("level"), Add("log_type", "elasticsearch")])], [*_template("elasticsearch_logs"), Add("log_type", "elasticsearch.gc")]),
    ],
    "container_logs": [
        Route([(begins("{"), [Json(), Time("time", _ZONED)])], _template("container_logs")),
        Severity("stream", {"stdout": 9, "stderr": 17}),
        Move("log", "body"),
        Route([(_OBJECT, [Json(), Route([(has("severity"), [Severity("severity")]), (has("level"), [Severity("level")])])])]),
        Add("log_type", "container"),
    ],
    "json_logs": [Json(), Route([(has("severity"), [Severity("severity")]), (has("level"), [Severity("level")])]), Time("timestamp", _ZONED), Add("log_type", "json")],
    "file_logs": [Add("log_type", "file")],
}


def csv_graph(header: str, delimiter: str = ",", time: tuple[str, str] | None = None, level: str | None = None) -> list[Step]:
    """The graph of delimited lines under one header, with the field and layout of their time and the field of their level."""
    return [Csv(header, delimiter=delimiter), *([Time(time[0], [time[1]])] if time else []), *([Severity(level)] if level else []), Add("log_type", "csv")]
