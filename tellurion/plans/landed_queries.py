"""Queries over container files, keyed state that stops and goes on, and structures of XML and syslog, with twins."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from tellurion.functions.shared import shared_path
from tellurion.operators import parse as L
from tellurion.plans.catalog import dealt, registered, t
from tellurion.sources import avro as V
from tellurion.sources import landing as S
from tellurion.streaming import runs as Q
from tellurion.streaming import state as K

_EVENT = json.dumps({"type": "record", "name": "Event", "fields": [{"name": "event_id", "type": "long"}, {"name": "event_type", "type": ["null", "string"]}, {"name": "value", "type": ["null", "double"]}]})


def _container(rows: list[dict]) -> bytes:
    """One file of events in blocks of a hundred, as any writer of the format makes it."""
    import struct

    def number(n: int) -> bytes:
        n, out = n << 1 ^ n >> 63, b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    blob = lambda x: number(len(x)) + x
    one = lambda x, put: b"\0" if x is None else b"\2" + put(x)
    sync, out = b"0123456789abcdef", V.MAGIC + number(1) + blob(b"avro.schema") + blob(_EVENT.encode()) + number(0) + b"0123456789abcdef"
    for a in range(0, len(rows), 100):
        some = rows[a : a + 100]
        body = b"".join(number(r["event_id"]) + one(r["event_type"], lambda x: blob(x.encode())) + one(r["value"], lambda x: struct.pack("<d", x)) for r in some)
        out += number(len(some)) + blob(body) + sync
    return out


def _containers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield pa.record_batch([pa.array([_container(batch.to_pylist())], pa.binary())], ["content"])


@registered("s11_avro", "SELECT event_id, event_type, value FROM events")
def avro_files(spark, sf):
    """Events as container files, one for each batch of a task, and read back. Spark writes binary files only as rows, so the files are
    rows of Parquet, and their blocks are found and dealt out as those of files are."""
    path = shared_path(spark, "containers")
    t(spark, sf, "events").select("event_id", "event_type", "value").repartition(4).mapInArrow(_containers, "content binary").write.parquet(path)
    files = spark.read.schema("content binary").parquet(path).select(F.xxhash64("content").cast("string").alias("path"), "content")
    rows, _ = V.decoded(V.blocks_of(files), _EVENT)
    return rows


@registered("st_state_intervals", """
SELECT event_type, time_bucket(INTERVAL '1 hour', ts) AS start_ts, count(*) AS n, max(ts) AS last_seen, CAST(min(event_id) AS DOUBLE) AS "min", CAST(max(event_id) AS DOUBLE) AS "max",
       CAST(sum(event_id) // count(*) AS DOUBLE) AS "avg", CAST(arg_min(event_id, (ts, event_id)) AS DOUBLE) AS "first", CAST(arg_max(event_id, (ts, event_id)) AS DOUBLE) AS "last"
FROM events GROUP BY 1, 2""")
def state_of_intervals(spark, sf):
    """Half the events land and the query stops; the rest lands, with one row much later that closes every interval, and it goes on."""
    root, e = shared_path(spark, "state"), t(spark, sf, "events")
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    for part in range(2):
        landed = e.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == part)
        if part:
            end = e.agg((F.max("ts") + F.expr("interval 500 days")).alias("ts")).where("ts is not null")
            landed = landed.unionByName(end.select(F.lit(-1).cast("long").alias("event_id"), "ts"), allowMissingColumns=True)
        landed.repartition(2).write.mode("append").options(**S.TIME_LAYOUT).json(f"{root}/in")
        stream = S.stream_landing(spark, f"{root}/in", schema, 2).withColumn("kind", F.lit("int"))
        Q.keep_rows(K.intervals(stream, ["event_type"], "event_id", "kind", "event_id", seconds=3600, delay="400 days"), f"{root}/out", f"{root}/commits")
    return spark.read.parquet(f"{root}/out").select("event_type", "start_ts", "n", "last_seen", "min", "max", "avg", "first", "last")


@registered("l1_structures_of_xml_and_syslog", """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'xml:<e><id></id><' || event_type || ' user></' || event_type || '></e>' WHEN 1 THEN 'syslog:' || event_type || ':json:{id:<val>,t:<arr>}'
  WHEN 2 THEN 'syslog:app:' END AS structure FROM events""")
def structures_of_xml_and_syslog(spark, sf):
    """XML elements, syslog of both forms with and without JSON, and broken XML and JSON."""
    n, kind = F.col("event_id").cast("string"), F.col("event_type")
    xml = F.concat(F.lit("<e><id>"), n, F.lit("</id><"), kind, F.lit(' user="'), F.col("user_id").cast("string"), F.lit('"/></e>'))
    old = F.concat(F.lit("<34>Oct 11 22:14:15 host "), kind, F.lit('[9]: {"id":'), n, F.lit(',"t":["a","b"]}'))
    new = F.concat(F.lit("<34>1 2024-01-01T00:00:00Z host app 9 id - plain "), n)
    broken = F.when(F.col("event_id") % 8 == 3, F.concat(F.lit("<e><id>"), n, F.lit("</e>"))).otherwise(F.concat(F.lit('{"id":0'), n, F.lit("}")))
    pick = F.col("event_id") % 4
    line = F.when(pick == 0, xml).when(pick == 1, old).when(pick == 2, new).otherwise(broken)
    return dealt(spark, sf, "events").select("event_id", L.structure(line).alias("structure"))
