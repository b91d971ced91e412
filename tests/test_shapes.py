"""Manifests, pages, labels, delivery rows, nested masks, address checks, hashes, exact samples, and scans against plain Python."""

import datetime as dt
import ipaddress
import json
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tellurion.functions import hashes as H
from tellurion.operators import aggregates as A
from tellurion.operators import filters as X
from tellurion.operators import parse as L
from tellurion.operators import rewrite as R
from tellurion.operators import scans, standardize
from tellurion.sources import landing as S


def test_manifests(spark):
    drop = json.dumps({"cid": "c", "timestamp": 1_700_000_000_123, "bucket": "b", "files": [{"path": "p/a%2Bb c+d", "size": 3}, {"path": "%zz", "size": 1}]})
    records = json.dumps({"Records": [{"eventName": "s3:ObjectCreated:Put", "s3": {"bucket": {"name": "r"}, "object": {"key": "k+1", "size": 1}}}, {"eventName": "ObjectRemoved:x", "s3": {"bucket": {"name": "r"}, "object": {"key": "z", "size": 1}}}]})
    rows = [(drop,), (json.dumps({"Message": records}),), (json.dumps({"Message": drop}),), (json.dumps({"files": []}),), ("x",), (None,)]
    got = S.object_manifest(spark.createDataFrame(rows, "j string"), "j").collect()
    assert sorted((r.bucket, r.key, r.size) for r in got) == [("b", "p/a+b c+d", 3), ("b", "p/a+b c+d", 3), ("r", "k+1", 1)]
    assert {str(r.event_ts) for r in got if r.bucket == "b"} == {"2023-11-14 22:13:20.123000"}
    assert S.object_manifest(spark.createDataFrame(rows, "j string"), "j", "^b$", "c").count() == 2


@pytest.mark.parametrize("page,want", [
    ('[{"a":1},2,{"a":3}]', ['{"a":1}', '{"a":3}']), ('{"data":[{"a":1}],"b":[{"a":2}]}', ['{"a":1}']), ('{"z":[{"a":1}],"b":[{"a":2}],"a":"[{}]"}', ['{"a":2}']),
    ('{"data":{"a":1},"x y\'z":[{"a":1}]}', ['{"a":1}']), ('{"a":1}', []), ("broken", []), (None, []), ("", []), ("[]", []), ('{"data":[]}', []),
])
def test_pages_without_a_path(spark, page, want):
    assert [r.record for r in S.explode_pages(spark.createDataFrame([(page,)], "j string"), "j").collect()] == want


def test_labels(spark):
    m = {'p["a"]': "1", "pb": '{"x":"1","y":null}', "p[c]": '{"x":1}', "pd": "null", "pe": "{}", "q": "no", "pz": '{"env":"late"}', "pn": None}
    df = spark.createDataFrame([(m,), ({},), (None,)], "attributes map<string,string>")
    got = [r.labels for r in R.ingestion_labels(df, {"env": "prod", "k": "v"}, "p").collect()]
    assert got[0] == {"env": "late", "k": "v", "a": "1", "x": "1", "y": "", "c": '{"x":1}', "n": None}
    assert got[1] == got[2] == {"env": "prod", "k": "v"}
    assert R.ingestion_labels(df.limit(1), {}, "none").first().labels == {}


def test_sentinel_rows(spark):
    df = spark.sql("select timestamp'2024-01-02 03:04:05.678' ts, map('a', 'b', 'SpanId', 'x') body, repeat('0', 32) trace_id, 'ab' span_id, 'INFO' severity_text")
    row = R.sentinel_rows(df).first()
    assert row.Fields == '{"a":"b"}' and row.TraceId is None and row.SpanId == "ab"
    assert json.loads(R.sentinel_entries(df).first().entry) == {"a": "b", "TimeGenerated": "2024-01-02T03:04:05Z", "SeverityText": "INFO", "SeverityNumber": 0, "SpanId": "ab"}
    text = df.withColumn("body", F.lit("x\ny"))
    assert json.loads(R.sentinel_entries(text).first().entry)["RawData"] == "x\ny" and R.sentinel_rows(text).first().RawData == "x\\ny"
    assert json.loads(R.sentinel_entries(df.withColumn("body", F.expr("cast(map() as map<string,string>)"))).first().entry)["SeverityText"] == "INFO"
    nested = df.withColumn("body", F.expr("named_struct('n', named_struct('m', 1), 'TraceId', 'mine')"))
    assert json.loads(R.sentinel_entries(nested).first().entry)["n"] == {"m": 1}


def test_webhook_arrays(spark):
    df = spark.createDataFrame([('{"a":1}',), ("text",), (None,)], "body_text string").coalesce(1)
    assert [json.loads(r.payload) for r in R.webhook_rows(df, rows=2).collect()] == [[{"a": 1}, "text"], [None]]
    assert R.webhook_rows(df.limit(0), rows=2).count() == 0


def masked(x, path, exclude):
    """Plain Python, on dictionaries, lists and texts."""
    if path in exclude:
        return x
    one = lambda t: re.sub(r"\d+", "[masked_d]", t)
    if isinstance(x, str):
        return one(x)
    if isinstance(x, dict):
        return {k: masked(v, f"{path}.{k}", exclude) for k, v in x.items()}
    return [one(v) if isinstance(v, str) else v for v in x] if isinstance(x, list) and all(isinstance(v, str) or v is None for v in x) else x


def test_nested_masks(spark):
    schema = "m map<string,map<string,map<string,string>>>, s struct<a:string,b:array<string>,c:struct<d:string,e:map<string,string>>,n:int>, l array<struct<x:string>>, t string"
    rows = [({"a": {"b": {"c": "1", "d": "2", "e": None}}, "z": {"b": {"c": "3"}}, "x": None}, {"a": "4", "b": ["5", None], "c": {"d": "6", "e": {"f": "7", "g.h": "8"}}, "n": 9}, [{"x": "10"}], "11"), (None, None, None, None), ({}, {"a": None, "b": [], "c": None, "n": None}, [], "")]
    for exclude in ([], ["m.a.b.c"], ["m.a"], ["m.a.b", "s.c.e.f", "s.c.e.g.h", "t"], ["s.b", "s.c.d", "m.q.r"]):
        df = spark.createDataFrame(rows, schema)
        got = [r.asDict(recursive=True) for r in R.mask(df, ["m", "s", "l", "t"], {"d": r"\d+"}, exclude).collect()]
        want = [{k: masked(v, k, exclude) for k, v in r.asDict(recursive=True).items()} for r in df.collect()]
        assert got == want, exclude


def test_addresses(spark):
    rng = random.Random(4)
    some = ["1.2.3.4", "01.2.3.4", "1.2.3", "256.1.1.1", "::", "::1", "1::", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8:9", "1::2::3", "12345::", "1:2:3:4:5:6:1.2.3.4", "::ffff:1.2.3.4", "1::1.2.3.4", "1:2:3:4:5::1.2.3.4", "1:2:3:4:5:6::1.2.3.4", ":1", "1:", "", "g::", "1:2:3:4:5:6:7:1.2.3.4"]
    some += [":".join(rng.choice(["", "a", "12", "ffff"]) for _ in range(rng.randint(2, 9))) for _ in range(400)]
    some += [x + rng.choice(["", ":1.2.3.4"]) for x in some[-200:]]

    def good(x):
        try:
            return bool(ipaddress.ip_address(x))
        except ValueError:
            return False

    rx = standardize.PATTERNS["ip_t"]
    got = {r.x: r.ok for r in spark.createDataFrame([(x,) for x in some], "x string").withColumn("ok", F.col("x").rlike(rx)).collect()}
    assert got == {x: good(x) for x in some}
    assert re.match(rx, " fe80::1%eth0 ")


def test_hashes(spark):
    def fnv(data, h=14695981039346656037):
        for b in data:
            h = (h ^ b) * 1099511628211 % (1 << 64)
        return h

    texts = ["", "a", "foobar", "ÄÖ日", "x" * 300, None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").withColumns({"h": H.fnv1a("t"), "twice": H.fnv1a(F.lit("b"), H.fnv1a("t"))}).collect()
    for r in got:
        assert (r.h is None) == (r.t is None)
        if r.t is not None:
            assert r.h % (1 << 64) == fnv(r.t.encode()) and r.twice % (1 << 64) == fnv(r.t.encode() + b"b")
    maps = spark.createDataFrame([({"a": "1", "b": None},), ({"b": None, "a": "1"},), ({"a": "1"},), ({},), (None,)], "m map<string,string>").withColumn("h", H.map_hash("m")).collect()
    h = [r.h for r in maps]
    assert h[0] == h[1] and len(set(h)) == 4 and h[4] is None


@pytest.mark.parametrize("rows,pct", [([(i, i % 3) for i in range(1000)], 10), ([(1, 1)] * 400, 33), ([(i % 2, i % 5) for i in range(301)], 77), ([(1, 1)], 50), ([], 10), ([(i, 0) for i in range(50)], 0)])
def test_exact_samples(spark, rows, pct):
    df = spark.createDataFrame(rows, "a long, b long").withColumn("m", F.create_map(F.lit("k"), F.col("b")))
    for order in ("a", None):
        kept = X.sample_percent(df, pct, order=order)
        got = [(r.a, r.b) for r in kept.collect()]
        assert len(got) == len(rows) * (pct or 1) // 100 and kept.columns == df.columns
        assert all(got.count(x) <= rows.count(x) for x in set(got))
        plan = kept._jdf.queryExecution().toString()
        assert "TakeOrderedAndProject" not in plan and "Sort " not in plan


def runs(rows):
    out, n = [], 0
    for k, key in enumerate(rows):
        n += not k or rows[k - 1] != key
        out.append(n)
    return out


@settings(deadline=None, max_examples=6)
@given(st.lists(st.tuples(st.sampled_from(["f", "g", None]), st.sampled_from(["a", "b", None])), max_size=60))
def test_scans(spark, rows):
    df = spark.createDataFrame([(i, f, k, "mine") for i, (f, k) in enumerate(rows)], "i long, f string, k string, _slice string")
    got = {r.i: r.run for r in scans.run_numbers(df, ["k"], ["i"]).collect()}
    assert [got[i] for i in range(len(rows))] == runs([k for _, k in rows])
    by = {r.i: r.n for r in scans.running_count(df, F.col("k") == "a", ["i"], ["f"]).collect()}
    for f in ("f", "g", None):
        mine = [i for i, x in enumerate(rows) if x[0] == f]
        assert [by[i] for i in mine] == [sum(rows[j][1] == "a" for j in mine if j <= i) for i in mine]
    counted = sorted((r.run, r.n) for r in A.run_counts(df, ["i"], ["k"], ["f"]).where("f = 'f'").collect())
    want = runs([k for f, k in rows if f == "f"])
    assert counted == [(n, want.count(n)) for n in sorted(set(want))]


def test_a_file_is_scanned_by_many_tasks(spark):
    """A record that goes over the borders of slices."""
    lines = spark.range(1000).select(F.lit("f").alias("file"), F.col("id").alias("no"), F.when(F.col("id") % 300 == 7, "START").otherwise("x").alias("line")).repartition(5)
    assert scans.sliced(lines, ["file"], ["no"], "s").select("s").distinct().count() > 1
    got = {r.record: r.text.count("\n") + 1 for r in L.assemble_multiline(lines, "line", "^START", "file", "no").collect()}
    assert got == {0: 7, 1: 300, 2: 300, 3: 300, 4: 93}
    parts = L.recombine(lines, "file", "line = 'START'", "line", "no").collect()
    assert {r.record: len(r.line) for r in parts} == {0: 7 + 5, 1: 299 + 5, 2: 299 + 5, 3: 299 + 5, 4: 92}
    heads = lines.withColumn("line", F.when(F.col("no") % 300 == 7, F.concat(F.lit("#Fields: f"), F.col("no").cast("string"))).otherwise(F.col("line")))
    named = L.headed_parse(heads, "line", "file", "no").where("parsed is not null").select(F.explode("parsed")).groupBy("key").count().collect()
    assert {r.key: r["count"] for r in named} == {"f7": 299, "f307": 299, "f607": 299, "f907": 92}


# ---------------------------------------------------------------- landing by range, measures


@settings(deadline=None, max_examples=60)
@given(st.integers(0, 3 * 366 * 24), st.integers(0, 2 * 366 * 24), st.sampled_from(["hour", "day", "month"]))
def test_folders_of_a_range(at, hours, level):
    start = dt.datetime(2023, 6, 1, 0, 30) + dt.timedelta(hours=at)
    end = start + dt.timedelta(hours=hours)
    names = S.PARTS[: S.PARTS.index(level) + 1]
    form = "/".join(f"{n}=%{x}" for n, x in zip(names, "YmdH", strict=False))
    want, t = set(), start.replace(minute=0)
    while t <= end:
        want.add(t.strftime(form))
        t += dt.timedelta(hours=1)
    want.add(end.strftime(form))
    got, folders = set(), S.range_folders(start, end, level)
    for f in folders:
        parts = dict(p.split("=") for p in f.split("/"))
        t = dt.datetime(int(parts["year"]), int(parts.get("month", 1)), int(parts.get("day", 1)), int(parts.get("hour", 0)))
        stop = S._turn(t, names[len(parts) - 1])
        while t < stop:
            got.add(t.strftime(form))
            t += dt.timedelta(hours=1)
    assert got == want and len(folders) == len(set(folders)) <= 2 * (24 + 31 + 12) + 4


def test_only_folders_within_the_range_are_listed(spark, tmp_path):
    for h in range(0, 96, 3):
        t = dt.datetime(2024, 1, 30) + dt.timedelta(hours=h)
        folder = tmp_path / t.strftime("year=%Y/month=%m/day=%d/hour=%H")
        folder.mkdir(parents=True)
        (folder / "a.json").write_text(json.dumps({"i": h}))
    (tmp_path / "year=2024/month=01/day=30/hour=00/bad").symlink_to(tmp_path / "year=2024")  # listing it goes round for ever
    start, end = dt.datetime(2024, 1, 31, 21), dt.datetime(2024, 2, 2, 2)
    got = S.read_partitioned(spark, str(tmp_path), start, end, "i int")
    assert sorted(r.i for r in got.collect()) == list(range(45, 75, 3))
    stream = S.stream_landing(spark, str(tmp_path), "i int", start=start, end=end)
    q = stream.writeStream.format("memory").queryName("ranged").option("checkpointLocation", str(tmp_path / "commits")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.i for r in spark.table("ranged").collect()) == list(range(45, 75, 3))
    assert S.read_partitioned(spark, str(tmp_path), dt.datetime(2030, 1, 1), dt.datetime(2030, 1, 2), "i int").count() == 0
    assert S.read_partitioned(spark, str(tmp_path), end, start, "i int").count() == 0


def test_measured_writes(spark, tmp_path):
    df = spark.createDataFrame([("é", True, 1), (None, False, 2), ("abc", True, 3)], "body_text string, ok boolean, ts long")
    m = A.Measured(df, status="ok", ts="ts")
    m.rows.write.parquet(str(tmp_path / "out"))
    assert m.result() == {"n_rows": 3, "raw_bytes": 5, "accepted": 2, "dropped": 1, "last_success": 3}
    assert "Scan" in m.rows._jdf.queryExecution().toString() and m.rows.columns == df.columns
    df.write.parquet(str(tmp_path / "in"))
    s = A.Measured(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), status="ok")
    q = s.rows.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "commits")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sum(p["n_rows"] for p in s.progress(q)) == 3 and sum(p["accepted"] for p in s.progress(q)) == 2


# ---------------------------------------------------------------- empty values


@pytest.mark.parametrize("nulls,maps,lists,strings,exclude", [
    (True, False, False, [], []), (True, True, True, ["", "-"], []), (False, True, False, ["-"], []), (True, True, True, [""], ["m.a", "s.c"]), (True, True, False, ["-"], ["m.b.x", "s.d.k"]), (False, False, False, [], []),
])
def test_empty_parts_of_any_shape(spark, nulls, maps, lists, strings, exclude):
    schema = "i int, m map<string,map<string,string>>, s struct<a:string,b:array<string>,c:struct<e:string>,d:map<string,string>,n:int>, l array<map<string,string>>, t string"
    rows = [
        (1, {"a": {"x": "", "y": None}, "b": {"x": "-", "y": "v"}, "c": None, "d": {}}, {"a": "-", "b": ["", "x", None], "c": {"e": None}, "d": {"k": "-"}, "n": None}, [{"p": ""}, {}, None, {"q": "v"}], "-"),
        (2, {}, {"a": None, "b": [], "c": None, "d": None, "n": 3}, [], ""), (3, None, None, None, None), (4, {"a": {"z": "v"}}, {"a": "x", "b": ["-"], "c": {"e": "-"}, "d": {}, "n": None}, [{}], "v"),
    ]
    df = spark.createDataFrame(rows, schema)
    got = {r.i: r.asDict(recursive=True) for r in R.remove_empty(df, ["m", "s", "l", "t"], nulls, maps, strings, exclude, lists).collect()}
    fields = {"": ("a", "b", "c", "d", "n"), "c": ("e",)}

    def shown(x, path):
        """A cleaned dictionary as the struct it was: fields left out are null."""
        if path == "s" and isinstance(x, dict):
            return {f: shown(x.get(f), f"s.{f}") for f in fields[""]}
        if path == "s.c" and isinstance(x, dict):
            return {f: x.get(f) for f in fields["c"]}
        return x

    for row in df.collect():
        plain = row.asDict(recursive=True)
        for c in ("m", "s", "l", "t"):
            value, empty = R._clean(plain[c], nulls, lists, maps, {x.lower() for x in strings}, set(exclude), c)
            assert got[row.i][c] == (None if empty else shown(value, c)), (row.i, c)
