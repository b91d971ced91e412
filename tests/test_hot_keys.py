"""Hot keys, bounded broadcasts, readers of whole files and catalogues that a deployment gives."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tellurion.functions import shared
from tellurion.operators import aggregates, enrich, filters, rewrite, standardize
from tellurion.plans import catalog
from tellurion.sources import landing, sinks

SF = "/root/testdata/sf0.001"


def broadcasts(df):
    return "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()


def test_a_table_of_few_but_long_rows_is_not_small(spark):
    ref = spark.range(4).selectExpr("id", "repeat('x', 1000) text")
    assert enrich.small(ref, size=1000) is ref and enrich.small(ref, rows=3) is ref
    assert broadcasts(spark.range(9).join(enrich.small(ref, size=10_000), "id"))


def test_bloom_of_many_blocks_and_beyond_the_broadcast(spark, monkeypatch):
    known, df = spark.range(0, 30_000, 3).selectExpr("string(id) indicator"), spark.range(30_000).selectExpr("string(id) v").unionByName(spark.sql("select cast(null as string) v"))
    f = enrich.bloom(known, "indicator")
    assert f.blocks > 100
    monkeypatch.setattr(enrich, "SMALL_BYTES", 0)
    got = {r.v for r in enrich.maybe_matched(df, f, "v").collect()}
    assert {str(i) for i in range(0, 30_000, 3)} <= got and len(got) < 10_600


def test_bloom_of_nothing_matches_nothing(spark):
    none = spark.createDataFrame([], "indicator string")
    assert enrich.maybe_matched(spark.range(9).selectExpr("string(id) v"), enrich.bloom(none, "indicator"), "v").count() == 0


def test_lookup_valid_against_a_plain_search(spark):
    t0 = datetime(2024, 1, 1)
    at = lambda s: t0 + timedelta(seconds=s)
    rows = [(i, "ab"[i % 2] if i % 7 else None, at(i * 13) if i % 11 else None) for i in range(150)] + [(500, "a", at(60)), (500, "a", at(60))]
    refs = [("ab"[i % 2], at(i * 29), i) for i in range(60)] + [("a", at(60), 99), ("a", at(60), 98), (None, at(1), 1), ("a", None, 2)]
    got = enrich.lookup_valid(spark.createDataFrame(rows, "i int, k string, ts timestamp"), spark.createDataFrame(refs, "k string, f timestamp, v int"), "k", "ts", "f", "50 seconds")

    def found(k, ts):
        own = [(f, v) for rk, f, v in refs if k is not None and rk == k and ts is not None and f is not None and f <= ts]
        return max(own)[1] if own and ts < max(own)[0] + timedelta(seconds=50) else None

    assert sorted((r.i, r.v or -1) for r in got.collect()) == sorted((i, found(k, ts) or -1) for i, k, ts in rows)


def test_reload_keeps_the_last_good_reference(spark, tmp_path):
    good, seen = spark.createDataFrame([("a", 1)], "k string, v int"), []
    tries = iter([good, None])

    def read():
        ref = next(tries)
        return spark.read.parquet(str(tmp_path / "gone")) if ref is None else ref

    batch = enrich.with_reload(lambda df, ref: enrich.lookup(df, ref, "k", "k"), read, lambda df, epoch: seen.append((epoch, [r.v for r in df.collect()])))
    df = spark.createDataFrame([("a",)], "k string")
    batch(df, 0)
    batch(df, 1)
    assert seen == [(0, [1]), (1, [1])]

    def fails():
        raise OSError("not there")

    with pytest.raises(OSError):
        enrich.with_reload(lambda df, ref: df, fails, lambda df, epoch: None)(df, 0)


def test_json_arrays_deal_out_copies_and_keep_them_all(spark):
    df = spark.range(3000).selectExpr("if(id < 2500, 'hot', null) k", "if(id < 2000, -1, id) v", "cast(null as string) n")
    out = sinks.json_arrays(df, ["k"], 100)
    assert out.agg(F.max("n")).first()[0] < 300 and out.where("k = 'hot'").count() > 10
    back = sorted((r.k or "", x["v"]) for r in out.collect() for x in json.loads(r.body))
    assert back == sorted((r.k or "", r.v) for r in df.collect())
    assert sinks.json_arrays(df.limit(0), ["k"]).count() == 0


def test_renest_and_topology_cut_large_keys(spark):
    df = spark.range(1000).selectExpr("if(id < 900, 'hot', null) k", "id")
    out = rewrite.renest(df, ["k"], rows=100).collect()
    assert all(len(r.records) <= 100 for r in out) and sorted(x.id for r in out for x in r.records) == list(range(1000))
    assert len({(r.k, r.part) for r in out}) == len(out)
    edges = df.selectExpr("k", "string(id) d", "timestamp_seconds(id) ts")
    parts = aggregates.topology(edges, "k", "d", many=100).collect()
    assert len(parts) == 9 and sorted(int(x.d) for r in parts for x in r.destinations) == list(range(900))



def test_runs_of_a_whole_table(spark):
    got = aggregates.run_counts(spark.range(100).selectExpr("id", "id div 30 k", "1 run"), ["id"], ["k"]).collect()
    assert sorted((r.run, r.k, r.n) for r in got) == [(1, 0, 30), (2, 1, 30), (3, 2, 30), (4, 3, 10)]


def test_batches_follow_the_size_of_a_key(spark):
    df = spark.range(4000).selectExpr("id", "if(id < 3900, 'hot', null) k", "1 n")
    fit, large = landing.size_batches(df, ["k"], F.col("n"), 10, ["id"])
    assert fit.count() == 4000 and large.count() == 0 and fit.columns == ["id", "k", "n", "batch"]
    assert fit.groupBy("k", "batch").count().where("count > 10").count() == 0
    assert fit.where("k = 'hot'").select(F.split("batch", "-")[0]).distinct().count() > 10


def test_draws_are_those_of_md5(spark):
    import hashlib

    df = spark.createDataFrame([("a",), (None,), ("é",)], "k string")
    got = [r[0] for r in df.select(filters.drawn(F.col("k"), 7)).collect()]
    assert got == [int(hashlib.md5(f"7:{k or ''}".encode()).hexdigest()[:12], 16) for k in ("a", None, "é")]


def test_marks(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 2),), (None,)], "ts timestamp")
    assert landing.next_mark(df, "ts", "epoch_ms").first().mark == datetime(2024, 1, 2, 0, 0, 0, 1000)
    assert landing.next_mark(df.limit(0), "ts").first().mark is None
    n = spark.createDataFrame([("1704067200",), ("1704067200.25",), ("1704067200250",), ("x",), (None,)], "n string")
    whole = datetime(2024, 1, 1)
    assert [r[0] for r in n.select(landing.epoch_time(F.col("n"))).collect()] == [whole, whole.replace(microsecond=250_000), whole.replace(microsecond=250_000), None, None]


def test_files_by_glob_and_whole(spark, tmp_path):
    for name, text in (("a-1.txt", "x\ny\n"), ("a-2.txt", " \n"), ("b-1.txt", "z"), ("a-1.log", "w")):
        (tmp_path / name).write_text(text)
    got = landing.read_matching(spark, [f"{tmp_path}/a-*"], r"\.txt$")
    assert sorted(r.value for r in got.collect()) == [" ", "x", "y"] and got.columns == ["value", "path"]
    assert sorted(r.body_text for r in landing.read_raw_text(spark, str(tmp_path)).collect()) == ["w", "x\ny\n", "z"]


def test_codecs_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1))], "i int, ts timestamp")
    for codec in ("bzip2", "deflate", "none"):
        landing.write_partitioned(df, str(tmp_path / codec), codec=codec)
        assert [r.i for r in landing.read_partitioned(spark, str(tmp_path / codec), schema="i int").collect()] == [1]


def test_quarantine_loses_no_row(spark):
    df = spark.createDataFrame([('{"a":1}',), (" ",), ("{",), ("[]",), ("1",), (None,)], "value string")
    good, bad = landing.quarantined(df)
    assert good.count() == 1 and [r.reason for r in bad.orderBy("reason").collect()] == ["blank", "malformed", "missing", "no_object", "no_object"]


def test_a_name_within_a_value_is_no_list(spark):
    o = spark.createDataFrame([('{"note":"\\"Records\\": [1]"}',), ('{"Records":[1,2]}',), (None,), ("",)], "o string")
    assert sorted(r.record for r in landing.sniffed(o, "o").collect()) == ["1", "2", '{"note":"\\"Records\\": [1]"}']


def test_catalogues_of_a_deployment():
    assert sinks.class_schemas('{"3002": "time bigint"}') == {3002: "time bigint"}
    with pytest.raises(Exception):
        sinks.class_schemas('{"3002": "time nosuchtype"}')
    assert standardize.table_columns('{"A": {"x": "int"}}') == {"A": {"x": "int"}}
    with pytest.raises(ValueError, match="nosuch"):
        standardize.table_columns('{"A": {"x": "nosuch"}}')


def test_intermediate_data_needs_a_shared_folder():
    class Session:
        def __init__(self, **conf):
            self.conf = dict({k.replace("_", "."): v for k, v in conf.items()})
            self.conf = type("Conf", (), {"get": lambda _, k, d=None, c=self.conf: c.get(k, d), "set": lambda _, k, v, c=self.conf: c.update({k: v})})()

    with pytest.raises(ValueError):
        shared.shared_dir(Session(spark_master="spark://host:7077"))
    assert shared.shared_dir(Session(spark_master="local[2]")).startswith("file:///")


@pytest.mark.parametrize("name", ["t4_renest", "k7_json_arrays", "j2a_bloom"])
def test_plans_are_free_of_python(spark, name):
    plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
