"""Keyed state by intervals: equal to the batch form after a restart in the middle, late rows counted, null keys and values."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tellurion.operators import aggregates as A
from tellurion.streaming import runs as Q
from tellurion.streaming import state as S

SCHEMA = "k string, ts timestamp, v double, kind string, id long"


def land(spark, path, rows, files=1):
    spark.createDataFrame(rows, SCHEMA).repartition(files).write.mode("append").parquet(path)


def go(spark, root, **more):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
    out = S.intervals(stream, ["k"], "v", "kind", "id", seconds=60, delay=more.pop("delay", "1 hour"))
    Q.keep_rows(out, f"{root}/out", f"{root}/commits")
    return spark.read.parquet(f"{root}/out")


def test_restart_in_the_middle(spark, tmp_path):
    rng = random.Random(3)
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s, microseconds=rng.randint(0, 999_999))
    rows = [(rng.choice(["a", "b", None]), at(rng.randint(0, 900)), rng.choice([None, -1.5, 2.5, 7.0]), rng.choice(["int", "double"]), i) for i in range(400)]
    rows += [("hot", at(30), float(i), "double", 1000 + i) for i in range(500)]
    root = f"file://{tmp_path}"
    land(spark, f"{root}/in", rows[::2], 3)
    first = go(spark, root).count()
    land(spark, f"{root}/in", [*rows[1::2], (None, None, 1.0, "int", -2)], 3)
    go(spark, root)
    land(spark, f"{root}/in", [("end", dt.datetime(2024, 1, 3), None, None, -1)])  # on its own: it makes all before it late
    got = go(spark, root)
    assert first < got.count() and got.agg(F.sum("late")).first()[0] == 0
    df = spark.createDataFrame(rows, SCHEMA).select(F.lit("m").alias("metric_name"), F.lit("gauge").alias("metric_type"), F.lit("").alias("temporality"), F.lit("{}").alias("resource_key"), F.col("k").alias("attr_key"), "ts", F.col("kind").alias("value_type"), F.col("v").alias("value"), "id")
    stats, _ = A.metric_stats(df, "m", tie=["id"])
    want = {(r.start_ts, r.attr_key, r.metric_name[2:]): (round(r.value, 9), r.value_type) for r in stats.collect()}
    have = {(r.start_ts, r.k, s): (round(r[s], 9), r.value_type) for r in got.collect() if r.points for s in S_NAMES}
    assert have == want
    counts = {(r.w.start, r.k): (r.n, r.last) for r in spark.createDataFrame(rows, SCHEMA).groupBy(F.window("ts", "1 minute").alias("w"), "k").agg(F.count("*").alias("n"), F.max("ts").alias("last")).collect()}
    assert {(r.start_ts, r.k): (r.n, r.last_seen) for r in got.collect()} == counts


S_NAMES = ("min", "max", "avg", "first", "last")


def test_late_rows_are_counted(spark, tmp_path):
    root, day = f"file://{tmp_path}", dt.datetime(2024, 1, 1)
    land(spark, f"{root}/in", [("a", day, 1.0, "int", 1), ("a", day + dt.timedelta(hours=1), 1.0, "int", 2)])
    go(spark, root, delay="1 minute")
    land(spark, f"{root}/in", [("a", day + dt.timedelta(seconds=5), 1.0, "int", 3), ("a", day + dt.timedelta(seconds=6), 1.0, "int", 4), ("a", day + dt.timedelta(hours=3), 1.0, "int", 5)])
    got = go(spark, root, delay="1 minute").collect()
    assert sum(r.late for r in got) == 2 and [r.n for r in sorted(got, key=lambda r: str(r.start_ts)) if r.start_ts] == [1, 1]
