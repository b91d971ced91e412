"""Landed vendor records as logs and metrics (S20-S27): audit events, usage reports, monitor reports, packet text, query results."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellurion.functions.expressions import attributes

#: Attributes of identity audit events and their paths; those below an absent object are left out.
OKTA = {"uuid": "uuid", "eventType": "eventType", "displayMessage": "displayMessage"}
OKTA_NESTED = {"outcome.result": "outcome.result", "actor.id": "actor.id", "actor.alternateId": "actor.alternateId", "actor.displayName": "actor.displayName"}

#: Enumerations of office audit events, by number from 0.
USER_TYPES = ("Regular", "Reserved", "Admin", "DcAdmin", "System", "Application", "ServicePrincipal", "CustomPolicy", "SystemPolicy")
ACTOR_TYPES = ("Claim", "Name", "Other", "PUID", "SPN", "UPN")
FILE_WORKLOADS = ("SharePoint Online", "OneDrive for Business", "Microsoft Teams")
REQUEST_SOURCES = ("SCC", "Cmdlet", "URLlink")

#: Verdicts on files, by number.
FILE_VERDICTS = {0: "Good", 1: "Bad", -1: "Error", -2: "Timeout", -3: "Pending"}

#: Optional attributes of office audit events, and the JSON paths that hold them.
M365 = {
    "workload": "Workload", "result": "ResultStatus", "sharepoint.site.id": "Site", "exchange.mailbox.id": "MailboxGuid", "yammer.user.id": "ActorUserId", "yammer.file.id": "FileId",
    "investigation.id": "InvestigationId", "investigation.status": "Status", "dynamics365.entity.id": "EntityId", "dynamics365.entity.name": "EntityName", "forms.form.id": "FormId",
    "mip.label.id": "LabelId", "todo.app.id": "ActorAppId", "todo.item.id": "ItemID", "web.project.id": "ProjectId", "web.roadmap.id": "RoadmapId", "web.roadmap.item.id": "RoadmapItemId",
    "dlp.sharepoint.user": "SharePointMetaData.From", "dlp.exchange.message.id": "ExchangeMetaData.MessageID",
    "communication_compliance.exchange.network.message.id": "ExchangeDetails.NetworkMessageId", "system_sync.data.share.id": "Invitation.ShareId", "defender.file.id": "FileData.DocumentId",
    "security.alert.id": "AlertId", "security.alert.name": "Name", "compliance_connector.job.id": "JobId", "compliance_connector.task.id": "TaskId",
    "viva.username": "Username", "viva.organization.name": "OrganizationName",
}
#: Attributes that count only beside another field, and those of one record type only.
M365_BESIDE = {"security.alert.name": "AlertId", "compliance_connector.task.id": "JobId", "viva.organization.name": "Username"}
M365_OF_TYPE = {"powerbi.app.name": (20, "AppName"), "defender.url.url": (41, "URL"), "encrypted_portal.message.id": (154, "MessageId"), "graph.consent.app.id": (217, "ApplicationId")}
M365_ENUMS = {
    "quarantine.request_source": ("RequestSource", REQUEST_SOURCES), "defender.file.source_workload": ("SourceWorkload", FILE_WORKLOADS), "defender.file.verdict": ("FileData.FileVerdict", FILE_VERDICTS),
}
#: Attributes that are lists, their JSON path, and the names and fields (and enumerations) of their items.
M365_LISTS = {
    "azure.actors": ("Actor", {"actor.id": ("ID", None), "actor.type": ("Type", ACTOR_TYPES)}),
    "dlp.policy_details": ("PolicyDetails", {"policy.id": ("PolicyId", None), "policy.name": ("PolicyName", None)}),
    "defender.email.attachments": ("AttachmentData", {"file.name": ("FileName", None)}),
}

#: Positions of the metrics in the rows of each usage report.
USAGE_REPORTS = {
    "sharepoint_files": {"sharepoint.files": 2, "sharepoint.files.active": 3},
    "sharepoint_sites": {"sharepoint.sites.active": 3},
    "sharepoint_pages_viewed": {"sharepoint.pages.viewed": 2},
    "sharepoint_pages_unique": {"sharepoint.pages.unique": 1},
    "sharepoint_storage": {"sharepoint.site.storage": 2},
    "teams_devices": {"device.web": 1, "device.android": 3, "device.ios": 4, "device.mac": 5, "device.windows": 6, "device.chromeos": 7, "device.linux": 8},
    "teams_activity": {"teams.message.team": 2, "teams.message.private": 5, "teams.calls": 6, "teams.meetings": 7},
    "onedrive_files": {"onedrive.files": 2, "onedrive.files.active": 3},
    "onedrive_activity": {"onedrive.activity.view_edit": 1, "onedrive.activity.synced": 2, "onedrive.activity.internal": 3, "onedrive.activity.external": 4},
    "outlook_mailboxes": {"outlook.mailboxes.active": 2},
    "outlook_activity": {"outlook.read": 3, "outlook.sent": 1, "outlook.received": 2},
    "outlook_storage": {"outlook.storage": 1},
    "outlook_apps": {"outlook.pop3": 7, "outlook.imap4": 8, "outlook.smtp": 9, "outlook.windows": 3, "outlook.mac": 2, "outlook.web": 6, "outlook.mobile": 4, "outlook.other_mobile": 5},
    "outlook_quota": {"outlook.under_limit": 1, "outlook.warning": 2, "outlook.send_prohibited": 3, "outlook.send_receive_prohibited": 4, "outlook.indeterminate": 5},
}


def _at(col: str, path: str) -> Column:
    return F.get_json_object(col, f"$.{path}")


def enum_name(value: Column, names: Sequence[str] | Mapping[int, str], other: str = "unknown") -> Column:
    """The name of a number (of a sequence from 0), `other` for a number without one, null for no number."""
    known = names if isinstance(names, Mapping) else dict(enumerate(names))
    table = F.create_map(*[F.lit(x) for p in known.items() for x in p])
    n = value.try_cast("int")
    return F.when(n.isNotNull(), F.coalesce(F.try_element_at(table, n), F.lit(other)))


def _inside(record: str, path: str) -> Column:
    """A value of an object that was parsed into a map of its fields; only a field below it is parsed again."""
    head, below = re.match(r"([^.\[]+)(.*)", path).groups()
    value = F.try_element_at(record, F.lit(head))
    return F.get_json_object(value, f"${below}") if below else value


def okta_logs(df: DataFrame, col: str, domain: str) -> DataFrame:
    """Identity audit events as logs: ts when published, body the event, its attributes; resource the domain."""
    attrs = {k: F.coalesce(_at(col, p), F.lit("")) for k, p in OKTA.items()}
    attrs |= {k: F.when(_at(col, p.split(".")[0]).isNotNull(), F.coalesce(_at(col, p), F.lit(""))) for k, p in OKTA_NESTED.items()}
    out = {"ts": F.try_to_timestamp(_at(col, "published")), "body_text": F.col(col), "attributes": attributes(attrs), "resource": F.create_map(F.lit("okta.domain"), F.lit(domain))}
    return df.where(F.try_parse_json(col).isNotNull()).select("*", *[c.alias(k) for k, c in out.items() if k not in df.columns])


def _item(fields: Mapping[str, tuple]) -> Callable[[Column], Column]:
    return lambda x: F.struct(*[(enum_name(x[f], names) if names else x[f]).alias(n) for n, (f, names) in fields.items()])


def m365_logs(df: DataFrame, col: str, audit: str, tenant: str, more: Mapping[str, str] | None = None) -> DataFrame:
    """Office audit events as logs: ts when created (else now), attributes from fixed paths and those in `more`; empty ones are left
    out, and lists are JSON text. Each event is parsed once."""
    df, given = df.withColumn("_rec", F.from_json(col, "map<string,string>")), df.columns
    at = lambda p: _inside("_rec", p)
    some = lambda p: F.nullif(at(p), F.lit(""))
    attrs = {"id": at("Id"), "operation": at("Operation"), "user.id": at("UserId"), "user.type": enum_name(F.coalesce(at("UserType"), F.lit("0")), USER_TYPES)}
    for k, p in (M365 | dict(more or {})).items():
        attrs[k] = F.when(some(M365_BESIDE[k]).isNotNull(), some(p)) if k in M365_BESIDE else some(p)
    attrs |= {k: F.when(at("RecordType").try_cast("int") == n, some(p)) for k, (n, p) in M365_OF_TYPE.items()}
    attrs |= {k: enum_name(at(p), names) for k, (p, names) in M365_ENUMS.items()}
    for k, (p, fields) in M365_LISTS.items():
        items = F.from_json(at(p), f"array<struct<{', '.join(f'{f}:string' for f, _ in fields.values())}>>")
        attrs[k] = F.to_json(F.transform(items, _item(fields)))
    ts = F.coalesce(F.try_to_timestamp(at("CreationTime")), F.current_timestamp())
    resource = F.create_map(F.lit("m365.audit"), F.lit(audit), F.lit("m365.organization.id"), F.lit(tenant))
    return df.select(*given, *[c.alias(k) for k, c in (("ts", ts), ("body_text", F.col(col)), ("attributes", attributes(attrs)), ("resource", resource)) if k not in given])


def audit_logs(df: DataFrame, parsed: bool = True, ts: str = "timestamp", url: str = "", url_name: str = "platform_url") -> DataFrame:
    """Platform audit rows as logs: the description as body and the rest as attributes, or the whole row as JSON. The resource
    holds the platform's address under `url_name`."""
    resource = {url_name: F.lit(url)} | ({"account": F.col("account")} if parsed and "account" in df.columns else {})
    if not parsed:
        return df.select(F.col(ts).alias("ts"), F.to_json(F.struct(*df.columns)).alias("body_text"), attributes({}).alias("attributes"), attributes(resource).alias("resource"))
    named = {c: F.col(c) for c in ("id", "resource_name", "resource_kind", "action", "user") if c in df.columns}
    named |= {"configuration": F.nullif(F.col("configuration"), F.lit(""))} if "configuration" in df.columns else {}
    named["timestamp"] = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    body = F.nullif(F.col("description"), F.lit("")) if "description" in df.columns else F.lit(None).cast("string")
    return df.select(F.col(ts).alias("ts"), body.alias("body_text"), attributes(named).alias("attributes"), attributes(resource).alias("resource"))


def usage_metrics(df: DataFrame, report: str | Mapping[str, int]) -> DataFrame:
    """Rows of a usage report as metrics by the position of their columns; empty cells and cells of no whole number are left out."""
    positions = USAGE_REPORTS[report] if isinstance(report, str) else report
    pairs = F.array(*[F.struct(F.lit(k).alias("metric_name"), F.trim(F.col(f"`{df.columns[i]}`").cast("string")).try_cast("bigint").alias("value")) for k, i in positions.items()])
    kept = df.select(*[c for c in df.columns if c not in ("metric_name", "value")], F.inline(pairs))
    return kept.where("value is not null")


_SUMS = "map<string,double>"
_MONITOR = (
    "neuron_runtime_data array<struct<report:struct<neuroncore_counters:struct<neuroncores_in_use:map<string,struct<neuroncore_utilization:double,effective_flops:double>>>,"
    f"execution_stats:struct<execution_summary:{_SUMS},error_summary:{_SUMS},latency_stats:struct<total_latency:{_SUMS},device_latency:{_SUMS}>>,"
    f"memory_used:struct<neuron_runtime_used_bytes:struct<host:double,neuron_device:double,usage_breakdown:struct<neuroncore_memory_usage:map<string,{_SUMS}>>>>>>>,"
    "system_data struct<neuron_hw_counters:struct<neuron_devices:array<struct<neuron_device_index:int,mem_ecc_corrected:double,mem_ecc_uncorrected:double,sram_ecc_corrected:double,sram_ecc_uncorrected:double>>>>"
)


def _series(name: str, value: Column, **attrs: Column) -> Column:
    pairs = [x for k, v in attrs.items() for x in (F.lit(k), v.cast("string"))]
    return F.struct(F.lit(name).alias("metric_name"), value.cast("double").alias("value"), F.create_map(*pairs).alias("attributes"))


def _entries(m: Column, f) -> Column:
    return F.coalesce(F.transform(F.map_entries(m), lambda e: f(e["key"], e["value"])), F.array())


def neuron_metrics(df: DataFrame, col: str) -> DataFrame:
    """Reports of an accelerator monitor as metrics: use and operations of each core, runs, errors, latencies, memory, ECC errors.

    Shares in percent become fractions; cores whose key is no number are left out. Text that is no report gives no rows.
    """
    df, given = df.withColumn("_rep", F.from_json(col, _MONITOR)), df.columns
    rep = F.col("_rep")
    cores = lambda m: F.map_filter(m, lambda k, _: k.rlike(r"^\d+$"))

    def of_runtime(r: Column) -> Column:
        x, used = r["report"], r["report"]["memory_used"]["neuron_runtime_used_bytes"]
        stats, in_use = x["execution_stats"], cores(x["neuroncore_counters"]["neuroncores_in_use"])
        lists = [
            _entries(in_use, lambda k, v: _series("aws.neuron.neuroncore.utilization", v["neuroncore_utilization"] / 100, core=k)),
            _entries(in_use, lambda k, v: _series("aws.neuron.neuroncore.flops", v["effective_flops"], core=k)),
            _entries(stats["execution_summary"], lambda k, v: _series("aws.neuron.execution.count", v, status=k)),
            _entries(stats["error_summary"], lambda k, v: _series("aws.neuron.execution.errors", v, error_type=k)),
            _entries(stats["latency_stats"]["total_latency"], lambda k, v: _series("aws.neuron.execution.latency", v, latency_type=F.lit("total"), percentile=k)),
            _entries(stats["latency_stats"]["device_latency"], lambda k, v: _series("aws.neuron.execution.latency", v, latency_type=F.lit("device"), percentile=k)),
            F.array(_series("aws.neuron.runtime.memory.usage", used["host"], location=F.lit("host")), _series("aws.neuron.runtime.memory.usage", used["neuron_device"], location=F.lit("device"))),
            F.flatten(_entries(cores(used["usage_breakdown"]["neuroncore_memory_usage"]), lambda k, v: F.transform(F.map_entries(v), lambda e: _series("aws.neuron.neuroncore.memory.usage", e["value"], core=k, category=e["key"])))),
        ]
        return F.concat(*lists)

    def of_device(d: Column) -> Column:
        kinds = [(m, e) for m in ("mem", "sram") for e in ("corrected", "uncorrected")]
        return F.array(*[_series("aws.neuron.errors", d[f"{m}_ecc_{e}"], device=d["neuron_device_index"], memory=F.lit("dram" if m == "mem" else m), error=F.lit(e)) for m, e in kinds])

    runtimes = F.flatten(F.transform(rep["neuron_runtime_data"], of_runtime))
    devices = F.flatten(F.transform(rep["system_data"]["neuron_hw_counters"]["neuron_devices"], of_device))
    rows = df.select(*[c for c in given if c not in ("metric_name", "value", "attributes")], F.concat(F.coalesce(runtimes, F.array()), F.coalesce(devices, F.array())).alias("_m"))
    return rows.select(*[c for c in rows.columns if c != "_m"], F.inline("_m")).where("value is not null")


def table_metrics(df: DataFrame, metrics: Mapping[str, str | Column], attrs: Sequence[str] = ()) -> DataFrame:
    """Columns of monitoring tables as metrics {name: column}: text with `-` means missing, other text must be a number.

    Of a column of numbers those below zero are missing; the sign of a zero or of an exponent makes none so.
    """
    col = lambda c: F.col(c) if isinstance(c, str) else c
    given = df.select(*[col(c).alias(f"m{i}") for i, c in enumerate(metrics.values())]).schema

    def number(c: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.NumericType):
            return F.when(c >= 0, c.cast("double"))
        return F.when(~F.coalesce(c.cast("string").contains("-"), F.lit(True)), F.trim(c.cast("string")).try_cast("double"))

    pairs = F.array(*[F.struct(F.lit(k).alias("metric_name"), number(col(c), f.dataType).alias("value")) for (k, c), f in zip(metrics.items(), given)])
    return df.select(attributes({a: F.col(a) for a in attrs}).alias("attributes"), F.inline(pairs)).where("value is not null")


def sql_metrics(spark: SparkSession, sql: str, values: Mapping[str, str], attrs: Sequence[str] = ()) -> DataFrame:
    """The rows of a query as metrics: {name: value column}, with other columns as attributes; rows without a number are left out."""
    df = spark.sql(sql)
    pairs = F.array(*[F.struct(F.lit(k).alias("metric_name"), F.col(c).try_cast("double").alias("value")) for k, c in values.items()])
    return df.select(attributes({a: F.col(a) for a in attrs}).alias("attributes"), F.inline(pairs)).where("value is not null")


def _ports(packets: DataFrame, end: str) -> DataFrame:
    """With the address and port of `address.port`: a last part over 255, or after four others or in IPv6, is a port."""
    p = packets.withColumn("_last", F.regexp_extract(end, r"\.(\d+)$", 1).try_cast("int"))
    p = p.withColumn("_has", F.col("_last").isNotNull() & (F.col(end).contains(":") | (F.col("_last") > 255) | F.col(end).rlike(r"^[^.]*(\.[^.]*){4}$")))
    address = F.when(F.col("_has"), F.regexp_replace(end, r"\.\d+$", "")).otherwise(F.col(end))
    return p.withColumns({f"{end}_address": address, f"{end}_port": F.when(F.col("_has"), F.col("_last")).otherwise(0)})


def parse_packets(lines: DataFrame, file: str, line_no: str, line: str, capture_date: str) -> DataFrame:
    """Packet text as one row for each packet: header, then hex lines below it. The text has no date, so it is given.

    Packets are numbered within their file; a file is one capture and is ordered by its line numbers. Headers of no known form give
    rows with null addresses; a packet without hex has an empty one and length 0. Each line is read once, before the lines are dealt
    out, and each part of a header is found once, in a column that the later ones read.
    """
    from pyspark.sql import Window as W

    head = r"^(\d{2}:\d{2}:\d{2}\.\d+)\s+"
    flow = r"^(?:(\S+) (?:In|Out)\s+)?(\S+) (\S+) > (\S+?):?(?:\s+(.*))?$"
    w = W.partitionBy("_file").orderBy("_n").rowsBetween(W.unboundedPreceding, 0)
    hexed = F.regexp_replace(F.regexp_extract("_line", r"^\s+0x[0-9a-fA-F]+:\s+((?:[0-9a-fA-F]{2,4} ?)+)", 1), " ", "")
    n = lines.select(F.col(file).alias("_file"), F.col(line_no).alias("_n"), F.col(line).alias("_line")).withColumn("_head", F.col("_line").rlike(head))
    n = n.select("_file", "_n", "_head", F.when(F.col("_head"), F.col("_line")).otherwise(hexed).alias("_text"))
    n = n.withColumn("packet", F.sum(F.col("_head").cast("bigint")).over(w)).where("packet > 0")
    packed = n.groupBy("_file", "packet").agg(
        F.max(F.when(F.col("_head"), F.col("_text"))).alias("_header"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("_head"), F.struct(F.col("_n").alias("n"), F.col("_text").alias("h"))))), lambda x: x["h"]), "").alias("hex"),
    )
    found = lambda c: F.nullif(F.col(c), F.lit(""))
    p = packed.withColumns({"_clock": F.regexp_extract("_header", head, 1), "_after": F.regexp_replace("_header", head, "")})
    p = p.withColumns({"_inside": F.regexp_extract("_after", r"^\(([^)]*)\)", 1), "_rest": F.regexp_replace("_after", r"^\([^)]*\)\s*", "")})
    p = p.withColumns({"_arp": F.col("_rest").startswith("ARP,"), **{f"_{i}": F.regexp_extract("_rest", flow, i) for i in range(1, 6)}})
    p = _ports(_ports(p.withColumns({"_src": found("_3"), "_dst": found("_4"), "_said": F.lower("_5")}), "_src"), "_dst")
    arp, said = F.col("_arp"), F.col("_said")
    who = lambda i: F.nullif(F.regexp_extract("_rest", r"^ARP, Request who-has (\S+) tell (\S+)", i), F.lit(""))
    reply = F.nullif(F.regexp_extract("_rest", r"^ARP, Reply (\S+)", 1), F.lit(""))
    dns = said.contains("+") & (said.contains("a?") | said.contains("aaaa?"))
    transport = F.when(said.contains("tcp") | said.contains("flags"), "TCP").when(said.contains("udp"), "UDP").when(said.contains("icmp"), "ICMP").when(dns, "UDP").otherwise("Unknown")
    return p.select(
        F.col("_file").alias(file), "packet", F.try_to_timestamp(F.concat_ws(" ", F.lit(capture_date), "_clock")).alias("ts"), F.coalesce(found("_inside"), found("_1")).alias("interface"),
        F.when(arp, "ARP").otherwise(found("_2")).alias("protocol"), F.when(arp, who(2)).otherwise(F.col("_src_address")).alias("src_address"), F.when(~arp, F.col("_src_port")).alias("src_port"),
        F.when(arp, F.coalesce(who(1), reply)).otherwise(F.col("_dst_address")).alias("dst_address"), F.when(~arp, F.col("_dst_port")).alias("dst_port"),
        F.when(arp, "Unknown").otherwise(transport).alias("transport"), "hex", F.floor(F.length("hex") / 2).cast("bigint").alias("length"),
    )
