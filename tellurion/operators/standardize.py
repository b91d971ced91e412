"""Records as rows of a security schema (N1-N9): the first matching event mapping, fields, coercion, rules."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellurion.functions.expressions import column, holds


@dataclass(frozen=True)
class Field:
    """One target path; a null or missing source gives the default, and a null default leaves the path out."""

    to: str
    source: str | Column | None = None
    default: object = None


@dataclass(frozen=True)
class Event:
    """One kind of event: rows that `match` become rows of `target` (a class number, or a table)."""

    target: int | str
    fields: Sequence[Field]
    match: str | Column = "true"
    profiles: Sequence[str] = ()
    schema: str = ""


@dataclass(frozen=True)
class Rule:
    """What a path must satisfy. A required path below an object counts only where the object has some value."""

    path: str
    required: bool = False
    allowed: Sequence = ()
    pattern: str | None = None
    max_length: int | None = None
    profile: str | None = None


@dataclass(frozen=True)
class ObjectType:
    """What holds of an object wherever it stands: rules and groups by paths within it, and the object types of its own attributes."""

    rules: Sequence[Rule] = ()
    at_least_one: Sequence[Sequence[str]] = ()
    just_one: Sequence[Sequence[str]] = ()
    objects: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class ClassRules:
    """The rules of one event class: its types, its paths, and groups of which at least, or just, one is set; `objects` names the object
    types of its attributes, of `catalogue`."""

    types: Mapping[str, str] = field(default_factory=dict)
    rules: Sequence[Rule] = ()
    at_least_one: Sequence[Sequence[str]] = ()
    just_one: Sequence[Sequence[str]] = ()
    objects: Mapping[str, str] = field(default_factory=dict)
    catalogue: Mapping[str, ObjectType] = field(default_factory=dict)
    #: Groups that hold where their object has some value: (object's path, "at least one" or "just one", paths).
    object_groups: Sequence[tuple[str, str, Sequence[str]]] = ()

    def of(self, profiles: Sequence[str]) -> list[Rule]:
        return [r for r in self.rules if r.profile is None or r.profile in profiles]

    def expanded(self, paths: Sequence[str]) -> ClassRules:
        """The rules with those of every object that one of the paths lies within. Types may hold each other or themselves: a type is
        entered only along a path, so the paths end it. An unknown type is an error."""
        rules, groups = list(self.rules), list(self.object_groups)
        left = [(name, kind) for name, kind in self.objects.items()]
        while left:
            at, kind = left.pop()
            if not any(p.startswith(f"{at}.") for p in paths):
                continue
            if kind not in self.catalogue:
                raise ValueError(f"no object type {kind}")
            own = self.catalogue[kind]
            rules += [replace(r, path=f"{at}.{r.path}") for r in own.rules]
            for said, some in (("at least one", own.at_least_one), ("just one", own.just_one)):
                groups += [(at, said, [f"{at}.{p}" for p in g]) for g in some]
            left += [(f"{at}.{name}", inner) for name, inner in own.objects.items()]
        return replace(self, rules=rules, object_groups=groups)


def ip_pattern() -> str:
    """A regular expression of an IPv4 or IPv6 address, with white space about it and a zone after it: eight groups of hex digits, any
    run of them as `::` once, the last two as an IPv4 address."""
    octet, group = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)", "[0-9A-Fa-f]{1,4}"
    four = rf"{octet}(?:\.{octet}){{3}}"
    forms = [f"(?:{group}:){{7}}{group}", f"(?:{group}:){{6}}{four}", f"::(?:{group}:){{0,5}}{four}", f":(?:(?::{group}){{1,7}}|:)"]
    for before in range(1, 8):  # so many groups stand before the ::
        forms.append(f"(?:{group}:){{{before}}}(?:(?::{group}){{1,{7 - before}}}|:)" if before < 7 else f"(?:{group}:){{7}}:")
        if before < 6:
            forms.append(f"(?:{group}:){{{before}}}(?::{group}){{0,{5 - before}}}:{four}")
    return rf"^\s*(?:{four}|(?:{'|'.join(forms)})(?:%.+)?)\s*$"


#: Patterns of the named string types.
PATTERNS = {
    "hostname_t": r"^(([a-zA-Z0-9]|[a-zA-Z0-9][a-zA-Z0-9\-]*[a-zA-Z0-9])\.)*([A-Za-z0-9]|[A-Za-z0-9][A-Za-z0-9\-]*[A-Za-z0-9])$",
    "ip_t": ip_pattern(),
    "datetime_t": r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?(Z|[\+-]\d{2}:\d{2})?$",
    "email_t": r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$",
    "mac_t": r"^([0-9A-Fa-f]{2}[:-]){5}([0-9A-Fa-f]{2})$",
    "uuid_t": r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
}

#: Columns that every row of the table schema needs.
REQUIRED_COLUMNS = ("TimeGenerated", "EventCount", "EventStartTime", "EventEndTime", "EventType", "EventResult", "EventProduct", "EventVendor", "EventSchema", "EventSchemaVersion", "Dvc")

#: Types of table columns.
COLUMN_TYPES = ("string", "datetime", "int", "long", "real", "boolean", "dynamic")

_SCALARS = ("integer", "long", "float", "boolean", "timestamp", "datetime")
#: Times with a T may name a zone, those with a blank are UTC.
_TIME = r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})?| \d{2}:\d{2}:\d{2}(\.\d+)?)$"


def first_match(df: DataFrame, events: Sequence[Event], into: str = "event") -> DataFrame:
    """Rows with the position of their first matching event; rows of none go."""
    chosen = F.lit(None).cast("int")
    for i, e in reversed(list(enumerate(events))):
        chosen = F.when(holds(e.match), F.lit(i)).otherwise(chosen)
    return df.withColumn(into, chosen).where(F.col(into).isNotNull())


def _plain(df: DataFrame, c: Column) -> tuple[str, Column]:
    """A value's type and the value; times without a zone are those of the session's."""
    got = df.select(c.alias("c")).dtypes[0][1]
    return ("timestamp", c.cast("timestamp")) if got in ("timestamp_ntz", "date") else (got, c)


def _instant(text: Column) -> Column:
    t = F.trim(text)
    return F.when(t.rlike(_TIME), F.try_to_timestamp(F.when(t.rlike(r"(Z|[+-]\d{2}:\d{2})$"), t).otherwise(F.concat(t, F.lit("Z")))))


def rfc3339(ts: Column) -> Column:
    """A time in UTC with as many digits of its fraction as it needs."""
    micros = F.unix_micros(ts.cast("timestamp"))
    whole = F.from_unixtime(F.floor(micros / 1_000_000).cast("long"), "yyyy-MM-dd'T'HH:mm:ss")
    digits = F.rtrim(F.lpad(F.pmod(micros, F.lit(1_000_000)).cast("string"), 6, "0"), F.lit("0"))
    return F.concat(whole, F.when(digits != "", F.concat(F.lit("."), digits)).otherwise(F.lit("")), F.lit("Z"))


def _prefixed(t: Column) -> Column:
    """Whole numbers written with a sign and a base: 0x, 0b, 0o or a leading 0, else decimal."""
    sign = F.when(t.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    digits = F.lower(F.regexp_replace(t, r"^[+-]", ""))
    based = lambda skip, base: F.conv(F.substring(digits, skip + 1, 100), base, 10).try_cast("bigint") * sign
    return (
        F.when(digits.rlike("^0x[0-9a-f]{1,15}$"), based(2, 16)).when(digits.rlike("^0b[01]{1,62}$"), based(2, 2))
        .when(digits.rlike("^0o[0-7]{1,20}$"), based(2, 8)).when(digits.rlike("^0[0-7]{1,20}$"), based(1, 8)).when(t.rlike(r"^[+-]?(0|[1-9]\d*)$"), t.try_cast("bigint"))
    )


def class_value(df: DataFrame, c: Column, kind: str) -> Column:
    """A value as the type of its path in an event class, null where it cannot be."""
    got, c = _plain(df, c)
    text = got == "string"
    if got.startswith(("map", "struct", "array")):
        return F.lit(None).cast("bigint") if kind in _SCALARS else c
    if kind in ("integer", "long"):
        return _prefixed(c) if text else F.lit(None).cast("bigint") if got == "timestamp" else c.try_cast("bigint")
    if kind == "float":
        return F.lit(None).cast("double") if got in ("boolean", "timestamp") else c.try_cast("double")
    if kind == "boolean":
        return F.when(c.isin("1", "t", "T", "TRUE", "true", "True"), True).when(c.isin("0", "f", "F", "FALSE", "false", "False"), False) if text else F.lit(None).cast("boolean") if got == "timestamp" else c.try_cast("boolean")
    if kind == "timestamp":
        return F.coalesce(F.when(c.rlike(r"^[+-]?\d+$"), c.try_cast("bigint")), F.unix_millis(_instant(c))) if text else F.unix_millis(c) if got == "timestamp" else c.try_cast("bigint")
    if kind == "datetime":
        return c if text else rfc3339(c if got == "timestamp" else F.timestamp_millis(c.cast("bigint")))
    return c


def table_value(df: DataFrame, c: Column, kind: str) -> Column:
    """A value as the type of its table column, null where it cannot be; whole numbers are checked for their range."""
    got, c = _plain(df, c)
    text, t = got == "string", F.trim(c.cast("string")) if not got.startswith(("map", "struct", "array")) else F.lit(None).cast("string")
    fixed = got == "timestamp" or got.startswith(("map", "struct", "array"))
    if kind == "string":
        return F.to_json(c) if got.startswith(("map", "struct", "array")) else rfc3339(c) if got == "timestamp" else c.cast("string")
    if kind == "datetime":
        return rfc3339(c) if got == "timestamp" else rfc3339(_instant(c)) if text else F.lit(None).cast("string")
    if kind in ("int", "long"):
        hexed = F.when(t.rlike("^0[xX][0-9a-fA-F]{1,15}$"), F.conv(F.substring(t, 3, 100), 16, 10).try_cast("bigint"))
        n = F.coalesce(F.when(t.rlike(r"^[+-]?\d+$"), t.try_cast("bigint")), hexed, t.try_cast("double").try_cast("bigint")) if text else F.lit(None).cast("bigint") if fixed else c.try_cast("bigint")
        return F.when(n.between(-(2**31), 2**31 - 1), n) if kind == "int" else n
    if kind == "real":
        return F.lit(None).cast("double") if fixed or got == "boolean" else (t if text else c).try_cast("double")
    if kind == "boolean":
        word = F.lower(t)
        return F.when(word.isin("true", "1", "yes"), True).when(word.isin("false", "0", "no"), False) if text else F.lit(None).cast("boolean") if fixed or got in ("double", "float") else c.try_cast("boolean")
    return c


def _source(f: Field) -> Column:
    default = F.lit(f.default)
    return default if f.source is None else F.coalesce(column(f.source), default) if f.default is not None else column(f.source)


def _tree(leaves: Mapping[str, Column]) -> Column:
    """Paths as one struct; an object of no values is null, so that JSON leaves it out."""
    heads: dict[str, dict[str, Column]] = {}
    for path, c in leaves.items():
        head, _, rest = path.partition(".")
        heads.setdefault(head, {})[rest] = c
    out = []
    for head, below in heads.items():
        if "" in below and len(below) > 1:
            raise ValueError(f"{head} is both a value and an object")
        out.append((below[""] if "" in below else F.when(_any(below.values()), _tree(below))).alias(head))
    return F.struct(*out)


def _any(cols) -> Column:
    some = F.lit(False)
    for c in cols:
        some = some | c.isNotNull()
    return some


def _problems(event: Event, raw: Mapping[str, Column], rules: ClassRules) -> Column:
    """The rules that a row breaks, as texts."""
    none = F.lit(None).cast("string")
    under = lambda p: _any([c for q, c in raw.items() if q == p or q.startswith(f"{p}.")])
    rules = rules.expanded(list(raw))
    said = []
    for r in rules.of(event.profiles):
        value = raw.get(r.path, none)
        if r.required:
            parent = r.path.rpartition(".")[0]
            said.append(F.when(~under(r.path) & (under(parent) if parent else F.lit(True)), F.lit(f"{r.path}: required")))
        if r.path not in raw:
            continue
        if r.allowed:
            said.append(F.when(value.isNotNull() & ~value.cast("string").isin([str(x) for x in r.allowed]), F.lit(f"{r.path}: not allowed")))
        if r.pattern:
            said.append(F.when(~value.cast("string").rlike(PATTERNS.get(r.pattern, r.pattern)), F.lit(f"{r.path}: format")))
        if r.max_length is not None:
            said.append(F.when(F.length(value.cast("string")) > r.max_length, F.lit(f"{r.path}: too long")))
    for kind, groups, bad in (("at least one", rules.at_least_one, lambda n: n < 1), ("just one", rules.just_one, lambda n: n != 1)):
        for g in groups:
            n = sum((under(p).cast("int") for p in g), F.lit(0))
            said.append(F.when(bad(n), F.lit(f"{', '.join(g)}: {kind}")))
    for at, kind, g in rules.object_groups:
        n = sum((under(p).cast("int") for p in g), F.lit(0))
        said.append(F.when(under(at) & ((n < 1) if kind == "at least one" else (n != 1)), F.lit(f"{', '.join(g)}: {kind}")))
    return F.array_compact(F.array(*said)) if said else F.expr("cast(array() as array<string>)")


def uncovered(event: Event, rules: ClassRules) -> list[str]:
    """What no field of an event can set, known when the job is defined: required paths and groups of which none is set."""
    has = lambda p: any(f.to == p or f.to.startswith(f"{p}.") for f in event.fields)
    auto = ("class_uid", "category_uid", "metadata", "metadata.version") + (("type_uid",) if has("activity_id") else ())
    out = []
    for r in rules.of(event.profiles):
        parent = r.path.rpartition(".")[0]
        if r.required and r.path not in auto and not has(r.path) and (not parent or has(parent)):
            out.append(r.path)
    return out + [", ".join(g) for g in [*rules.at_least_one, *rules.just_one] if not any(has(p) for p in g)]


def class_rows(df: DataFrame, events: Sequence[Event], version: str, rules: Mapping[int, ClassRules] | None = None, validate: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected): records as events of a class, `body_text` the event as JSON and `class_uid` its class.

    Class, category (thousands of the class), version and profiles are set; with an activity, type_uid is 100 classes and it. A value
    that its type cannot hold stays as it came and its path is in `coercion_errors`. Rows of no event go; rows that break a rule are
    `rejected`, with the rules in `errors`. All of it is one projection, so it holds for batches and streams.
    """
    rules, chosen = rules or {}, first_match(df, events)
    body = bad = errors = uid = None
    for i, e in enumerate(events):
        known = rules.get(int(e.target), ClassRules())
        raw: dict[str, Column] = {"class_uid": F.lit(int(e.target)), "category_uid": F.lit(int(e.target) // 1000), "metadata.version": F.lit(version)}
        if e.profiles:
            raw["metadata.profiles"] = F.array(*[F.lit(p) for p in e.profiles])
        shown, failed = dict(raw), []
        for f in e.fields:
            value = _source(f)
            typed = class_value(df, value, known.types[f.to]) if f.to in known.types else value
            kept = F.coalesce(typed.cast("variant"), _plain(df, value)[1].cast("variant")) if f.to in known.types else value
            failed.append(F.when(value.isNotNull() & typed.isNull(), F.lit(f.to)))
            earlier = raw.get(f.to)
            raw[f.to] = typed if earlier is None else F.coalesce(typed.cast("string"), earlier.cast("string"))
            shown[f.to] = kept if earlier is None else F.coalesce(kept.cast("variant"), shown[f.to].cast("variant"))
        if "activity_id" in raw:
            raw["type_uid"] = shown["type_uid"] = F.lit(int(e.target) * 100) + raw["activity_id"].try_cast("bigint")
        here, own = F.col("event") == i, F.to_json(_tree(shown))
        problems, wrong = _problems(e, raw, known), F.array_compact(F.array(*failed)) if failed else F.expr("cast(array() as array<string>)")
        body, errors = (F.when(here, own), F.when(here, problems)) if body is None else (body.when(here, own), errors.when(here, problems))
        bad, uid = (F.when(here, wrong), F.when(here, F.lit(int(e.target)))) if bad is None else (bad.when(here, wrong), uid.when(here, F.lit(int(e.target))))
    out = chosen.withColumns({"body_text": body, "class_uid": uid, "coercion_errors": bad, "errors": errors}).drop("event")
    if not validate:
        return out.drop("errors"), out.limit(0)
    return out.where(F.size("errors") == 0).drop("errors"), out.where(F.size("errors") > 0)


def table_rows(
    df: DataFrame, events: Sequence[Event], types: Mapping[str, Mapping[str, str]], body: str = "body_text", attribution: Mapping[str, str] | None = None,
    ts: str = "ts", observed: str | None = None, validate: bool = True,
) -> DataFrame:
    """Records as rows of security tables: `stream` names the table, `row_json` holds the row.

    TimeGenerated is that of the fields, else the end or the start of the event, else the record's time, else now. A value that its
    column cannot hold is left out. AdditionalFields keeps the original body, within OriginalEvent if attribution is given. With
    `validate`, rows without a required column go.
    """
    original = F.coalesce(F.try_parse_json(body), F.col(body).cast("variant"))
    own = F.coalesce(*[rfc3339(F.col(c)) for c in (ts, observed) if c], rfc3339(F.current_timestamp()))
    # three projections, each over columns of the one before, so that no value is coerced twice
    typed, times, names = {}, {}, []
    for i, e in enumerate(events):
        kinds, here = types.get(str(e.target), {}), F.col("event") == i
        sources: dict[str, Column] = {}
        for f in e.fields:
            sources[f.to] = _source(f) if f.to not in sources else F.coalesce(_source(f).cast("string"), sources[f.to].cast("string"))
        names.append({to: f"_value{i}_{j}" for j, to in enumerate(sources)})
        typed |= {names[i][to]: F.when(here, table_value(df, c, kinds.get(to, "dynamic"))) for to, c in sources.items()}
        time = own
        for c in ("EventStartTime", "EventEndTime", "TimeGenerated"):
            if c in sources:
                instant = F.col(names[i][c]) if kinds.get(c) == "datetime" else table_value(df, sources[c], "datetime")
                time = F.when(sources[c].isNotNull(), instant).otherwise(time)
        times[f"_time{i}"] = F.when(here, time)
    row = stream = whole = None
    for i, e in enumerate(events):
        values = {to: F.col(n) for to, n in names[i].items()} | {"EventSchema": F.lit(e.schema)}
        values["TimeGenerated"] = F.col(f"_time{i}")
        extra = F.struct(original.alias("OriginalEvent"), F.struct(*[F.lit(v).alias(k) for k, v in sorted(attribution.items())]).alias("Attribution")) if attribution else original
        complete = F.lit(all(c in values for c in REQUIRED_COLUMNS))
        for c in REQUIRED_COLUMNS:
            complete = complete & values[c].isNotNull() if c in values else complete
        here = F.col("event") == i
        text = F.to_json(F.struct(*[c.alias(k) for k, c in values.items()], extra.alias("AdditionalFields")))
        name = F.lit(f"Custom-{e.target}")
        row, stream, whole = (F.when(here, text), F.when(here, name), F.when(here, complete)) if row is None else (row.when(here, text), stream.when(here, name), whole.when(here, complete))
    valued = first_match(df, events).withColumns(typed).withColumns(times)
    out = valued.withColumns({"stream": stream, "row_json": row, "_whole": whole}).drop("event", *typed, *times)
    return (out.where("_whole") if validate else out).drop("_whole")


def table_columns(text: str) -> dict[str, dict[str, str]]:
    """The column catalogue of tables from JSON, {table: {column: type}}, for `types` of table_rows. An unknown type is an error."""
    out = {str(k): dict(v) for k, v in json.loads(text).items()}
    unknown = sorted({kind for columns in out.values() for kind in columns.values()} - set(COLUMN_TYPES))
    if unknown:
        raise ValueError(f"unknown column types: {', '.join(unknown)}")
    return out


def _groups(v: Mapping) -> dict:
    return {"rules": [Rule(**r) for r in v.get("rules", [])], "at_least_one": v.get("at_least_one", []), "just_one": v.get("just_one", []), "objects": v.get("objects", {})}


def rules_json(text: str) -> dict[int, ClassRules]:
    """Class rules from JSON: {class: {types, rules, at_least_one, just_one, objects}}, as a deployment keeps a schema version. Under the key
    `objects` stand the object types, {name: {rules, at_least_one, just_one, objects}}, which classes and types name."""
    given = json.loads(text)
    catalogue = {name: ObjectType(**_groups(v)) for name, v in given.pop("objects", {}).items()}
    return {int(k): ClassRules(types=v.get("types", {}), catalogue=catalogue, **_groups(v)) for k, v in given.items()}


def rules_of_versions(text: str) -> dict[str, dict[int, ClassRules]]:
    """Class rules by schema version from JSON, {version: what rules_json reads}."""
    return {version: rules_json(json.dumps(v)) for version, v in json.loads(text).items()}


def class_rows_by_version(df: DataFrame, events: Sequence[Event], version: str | Column, rules: Mapping[str, Mapping[int, ClassRules]], validate: bool = True) -> tuple[DataFrame, DataFrame]:
    """class_rows for records of several schema versions, each by the rules of its own; `version` is a column. Records of a version
    without rules go to `rejected` with the error `unknown version`, null columns beside it."""
    mark = column(version) if isinstance(version, str) else version
    good = bad = None
    for name, own in rules.items():
        a, b = class_rows(df.where(mark == name), events, name, own, validate)
        b = b if "errors" in b.columns else b.withColumn("errors", F.expr("cast(array() as array<string>)"))
        good, bad = (a, b) if good is None else (good.unionByName(a), bad.unionByName(b))
    lost = df.where(~F.coalesce(mark.isin(list(rules)), F.lit(False))).withColumn("errors", F.array(F.lit("unknown version")))
    return good, bad.unionByName(lost, allowMissingColumns=True)
