"""Small hand-made rows: edges that the tables don't have."""

from datetime import datetime

from pyspark.sql import functions as F

from tellurion.functions.expressions import java_pattern
from tellurion.operators import aggregates, enrich, filters, parse, rewrite
from tellurion.sources import landing
from tellurion.streaming import runs


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_boundaries_are_ascii(spark):
    df = spark.createDataFrame([("äa@b.com x",), ("no mail",), (None,)], "t string")
    out = [r.t for r in rewrite.mask(df, ["t"]).collect()]
    assert out == ["ä[masked_email] x", "no mail", None]
    assert [r.t for r in rewrite.mask(rewrite.mask(df, ["t"]), ["t"]).collect()] == out
    assert java_pattern(r"a\\b\b").startswith(r"a\\b(?:")


def test_mask_maps_and_excludes(spark):
    df = spark.sql("select map('a', 'x@y.com', 'b', 'x@y.com') m, array('1.2.3.4', 'k') l")
    r = rewrite.mask(df, ["m", "l"], exclude=["m.b"]).first()
    assert r.m == {"a": "[masked_email]", "b": "x@y.com"} and r.l == ["[masked_ipv4]", "k"]


def test_stats_of_int_series_truncate(spark):
    t = [datetime(2024, 1, 1, 0, 0, s) for s in range(4)]
    data = [(1, t[1], "int", 3.0), (2, t[0], "int", 4.0), (3, t[2], "double", -0.5), (4, t[3], "int", None)]
    df = spark.createDataFrame(data, "id long, ts timestamp, value_type string, value double").selectExpr("*", "'{}' resource_key", "'m' metric_name", "'gauge' metric_type", "cast(null as string) temporality", "'{}' attr_key")
    stats, rest = aggregates.metric_stats(df, "m", tie=["id"])
    got = {r.metric_name: r.value for r in stats.collect()}
    assert got == {"m.min": 0.0, "m.max": 4.0, "m.avg": 2.0, "m.first": 4.0, "m.last": 0.0}
    assert [r.id for r in rest.collect()] == [4]


def test_delta_sums_pass_through(spark):
    df = spark.sql("select timestamp'2024-01-01' ts, 'm' metric_name, 'sum' metric_type, 'delta' temporality, '{}' resource_key, '{}' attr_key, 'int' value_type, 1.0d value")
    stats, rest = aggregates.metric_stats(df, "m")
    assert stats.count() == 0 and rest.count() == 1


def test_sampling_keeps_null_conditions(spark):
    df = spark.createDataFrame([(1, None), (2, True), (3, False)], "i int, c boolean")
    assert rows(filters.sample(df, 1.0, "c").select("i")) == [(1,), (3,)]
    assert filters.sample(df, 0.0, "c").count() == 3


def test_lookup_hits_overwrite_and_misses_stay(spark):
    df = spark.createDataFrame([("a", "old"), ("z", "old"), (None, "old")], "k string, v string")
    ref = enrich.last_by_key(spark.createDataFrame([("a", "1", 1), ("a", "2", 2)], "k string, v string, n int"), "k", "n")
    assert sorted(enrich.lookup(df, ref, "k", "k").select(F.coalesce("k", F.lit("-")), "v").collect()) == [("-", "old"), ("a", "2"), ("z", "old")]


def test_lookup_is_a_broadcast_join(spark):
    df, ref = spark.range(100).selectExpr("string(id) k"), spark.range(10).selectExpr("string(id) k", "id v")
    assert "BroadcastHashJoin" in enrich.lookup(df, ref, "k", "k")._jdf.queryExecution().executedPlan().toString()


def test_first_rule_wins_and_blanks_never_match(spark):
    df = spark.createDataFrame([(" x ", "y"), ("", "y"), ("q", None)], "a string, b string")
    one, two = (spark.createDataFrame([(v,)], "indicator string") for v in ("x", " y "))
    out = enrich.threat_match(df, [enrich.Rule("one", ["a"], one), enrich.Rule("two", ["a", "b"], two)])
    assert [(r.threat_rule, r.threat_matched) for r in out.orderBy("a").collect()] == [("two", True), ("one", True), (None, False)]


def test_bloom_has_no_false_negatives(spark):
    known, df = spark.range(0, 3000, 3).selectExpr("string(id) indicator"), spark.range(3000).selectExpr("string(id) v")
    got = {r.v for r in enrich.maybe_matched(df, enrich.bloom(known, "indicator"), "v").collect()}
    assert {str(i) for i in range(0, 3000, 3)} <= got and len(got) < 1100


def test_remove_empty_json_cleans_children_first(spark):
    df = spark.createDataFrame([('{"a":{"b":null},"c":["-",1],"d":""}',), ("no json",), ('{"a":null}',)], "j string")
    out = [r.j for r in rewrite.remove_empty_json(df, "j", lists=True, maps=True, strings=["", "-"]).collect()]
    assert out == ['{"c":[1]}', "no json", None]


def test_fingerprints(spark):
    logs = ['{"a": 1, "b": "x"}', '{"a":2,"b":"y"}', '{"a": 1', "<x a='1'><y/><y/></x>", "<x a='2'><y/></x>", "<x>", '1.1.1.1 - - [t] "GET /a/12?q=1 HTTP/1.1" 200 5', '2.2.2.2 - - [t] "GET /a/77 HTTP/1.1" 404 -', "<34>Oct 11 22:14:15 host su: failed", None, ""]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(logs)], "i int, t string").select(parse.fingerprint("t"), "i").orderBy("i").collect()]
    assert got[0] == got[1] and got[3] == got[4] and got[6] == got[7] and got[8]
    assert [got[i] for i in (2, 5, 9, 10)] == [None] * 4 and len(set(got)) == 5


def test_multiline_and_recombine(spark):
    df = spark.createDataFrame([("f", 1, "head"), ("f", 2, "A1"), ("f", 3, " x"), ("f", 4, "A2")], "file string, n int, line string")
    assert rows(parse.assemble_multiline(df, "line", "^A", "file", "n").select("text")) == [("A1\n x",), ("A2",), ("head",)]
    parts = spark.createDataFrame([("s", 1, "a", "P"), ("s", 2, "b", "F"), ("s", 3, "c", "P")], "s string, n int, t string, flag string")
    assert rows(parse.recombine(parts, "s", "flag = 'F'", "t", "n").select("t")) == [("ab",), ("c",)]


def test_severity_classes(spark):
    df = spark.createDataFrame([("404",), ("503",), ("x",)], "s string")
    assert [r.severity_number for r in parse.severity(df, "s", [(17, "500-599"), (13, "4xx")], 9).collect()] == [13, 17, 9]


def test_partitioned_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1, 5)), (2, datetime(2024, 1, 1, 6)), (3, datetime(2024, 1, 2))], "i int, ts timestamp")
    landing.write_partitioned(df, str(tmp_path / "x"))
    out = landing.read_partitioned(spark, str(tmp_path / "x"), datetime(2024, 1, 1, 6), datetime(2024, 1, 2, 0), "i int, ts timestamp")
    assert rows(out.select("i")) == [(2,), (3,)]
    assert landing.time_prefixes(datetime(2024, 1, 1, 22, 30), datetime(2024, 1, 2, 0, 5)) == [f"year=2024/month=01/day={d}/hour={h}" for d, h in (("01", "22"), ("01", "23"), ("02", "00"))]


def test_stream_equals_batch(spark, tmp_path):
    df = spark.range(50).selectExpr("id", "timestamp_seconds(id * 10) ts")
    df.write.json(str(tmp_path / "in"))
    s = landing.stream_landing(spark, str(tmp_path / "in"), "id long, ts timestamp").withWatermark("ts", "1 minute")
    q = aggregates.log_count(s).writeStream.outputMode("complete").format("memory").queryName("counted").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(spark.sql("select start_ts, value from counted")) == rows(aggregates.log_count(df).select("start_ts", "value"))


def test_batches_hold_the_limit_and_lose_nothing(spark):
    df = spark.range(500).selectExpr("id", "'k' k", "int(id % 40) n")
    fit, large = landing.size_batches(df, ["k"], F.col("n"), 30, ["id"])
    assert fit.count() + large.count() == 500 and large.where("n <= 30").count() == 0
    assert fit.groupBy("batch").agg(F.sum("n").alias("s")).where("s > 30").count() == 0


def test_landed_payloads(spark):
    df = spark.createDataFrame([('[{"a":1},{"a":2}]', "application/json"), ("plain", "text/plain"), ("{bad", "application/json"), (None, "text/plain")], "b string, c string")
    assert sorted(str(r.record) for r in landing.payload_logs(df, "b", "c").collect()) == ["None", "plain", '{"a":1}', '{"a":2}']
    o = spark.createDataFrame([('{"Records":[{"x":1}]}',), ("l1\n\nl2",)], "o string")
    assert sorted(r.record for r in landing.sniffed(o, "o").collect()) == ["l1", "l2", '{"x":1}']
    e = spark.createDataFrame([('{"Records":[{"eventName":"ObjectCreated:Put","s3":{"bucket":{"name":"b"},"object":{"key":"a%20b+c","size":3}}},{"eventName":"ObjectRemoved"}]}',)], "e string")
    assert rows(landing.object_manifest(e, "e").select("bucket", "key", "size")) == [("b", "a b+c", 3)]


def test_headed_lines(spark):
    df = spark.createDataFrame([("f", 0, "1 2"), ("f", 1, "#Fields: a b"), ("f", 2, "x y"), ("f", 3, "#Date: z"), ("f", 4, "x"), ("f", 5, "#Fields: c"), ("f", 6, "z"), ("g", 7, None)], "file string, n int, line string")
    got = {r.n: r.parsed for r in parse.headed_parse(df, "line", "file", "n").collect()}
    assert got == {0: None, 2: {"a": "x", "b": "y"}, 4: None, 6: {"c": "z"}}
    assert parse.headed_parse(df.limit(0), "line", "file", "n").count() == 0


def test_a_second_run_reads_only_what_is_new(spark, tmp_path):
    def land(a, b):
        spark.range(a, b).selectExpr("id", "timestamp_seconds(id) ts", "id % 2 k").write.mode("append").json(str(tmp_path / "in"))

    for a, b in ((0, 90), (90, 150)):
        land(a, b)
        s = landing.stream_landing(spark, str(tmp_path / "in"), "id long, ts timestamp, k long")
        runs.keep_sums(s, str(tmp_path / "n"), str(tmp_path / "c1"), ["k"])
        runs.keep_latest(s, str(tmp_path / "l"), str(tmp_path / "c2"), ["k"])
    assert [r.n for r in runs.sums(spark, str(tmp_path / "n"), ["k"]).orderBy("start_ts", "k").collect()] == [30, 30, 30, 30, 15, 15]
    assert [r.last_seen.second for r in runs.latest(spark, str(tmp_path / "l"), ["k"]).orderBy("k").collect()] == [28, 29]


def test_a_batch_that_comes_again_counts_once(spark, tmp_path):
    df = spark.range(10).selectExpr("timestamp_seconds(id) ts", "1 k")
    write = runs._parts(str(tmp_path), lambda b: b.groupBy("k").count())
    write(df, 3)
    write(df, 3)
    assert rows(spark.read.parquet(str(tmp_path)).select("k", "count")) == [(1, 10)]
