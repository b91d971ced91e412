"""Keyed state with timers: counts, statistics and last sight of each key by interval, sent when the watermark closes it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: What is known of an interval of a key: of rows, of values as doubles and whole numbers, of the earliest and the latest point.
_PARTIAL = "n long, points long, total double, whole long, least double, most double, first_at long, first_tie long, first_value double, first_int boolean, last_at long, last_tie long, last_value double, seen long"
_NAMES = [x.split()[0] for x in _PARTIAL.split(", ")]


def _partials(keys: Sequence[str], seconds: int):
    """Rows of a batch summed by key and interval, so that a key with many rows sends few."""
    kinds = pa.schema([*((k, pa.string()) for k in keys), ("w", pa.int64()), *zip(_NAMES, [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.int64()], strict=True)])
    by = [*keys, "w"]

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            w = pc.multiply(pc.cast(pc.floor(pc.divide(pc.cast(t["at"], pa.float64()), 1e6 * seconds)), pa.int64()), seconds)
            t = t.append_column("w", w)
            rows = t.group_by(by).aggregate([("at", "count"), ("at", "max")])
            points = t.filter(pc.is_valid(t["value"])).sort_by([("at", "ascending"), ("tie", "ascending")])
            cut = pc.if_else(pc.less(points["value"], 0), pc.ceil(points["value"]), pc.floor(points["value"]))
            points = points.append_column("whole", pc.cast(cut, pa.int64(), safe=False))
            ends = [(c, how) for how in ("first", "last") for c in ("at", "tie", "value", "is_int")]
            sums = points.group_by(by, use_threads=False).aggregate([("value", "count"), ("value", "sum"), ("whole", "sum"), ("value", "min"), ("value", "max"), *ends])
            # joins of tables leave out null keys, so both are put in one order by pandas
            both = rows.to_pandas().merge(sums.to_pandas(), on=by, how="left")
            out = pd.DataFrame({c: both[c] for c in by} | dict(zip(_NAMES, [
                both["at_count"], both["value_count"].fillna(0), both["value_sum"].fillna(0.0), both["whole_sum"].fillna(0), both["value_min"], both["value_max"], both["at_first"], both["tie_first"], both["value_first"],
                both["is_int_first"], both["at_last"], both["tie_last"], both["value_last"], both["at_max"],
            ], strict=True)))
            yield pa.RecordBatch.from_pandas(out, schema=kinds, preserve_index=False)

    return combine, ", ".join([*(f"{k} string" for k in keys), "w long", _PARTIAL])


def _merged(a: dict | None, b: dict) -> dict:
    """Two partials of one interval as one."""
    if a is None:
        return b
    out = {k: a[k] + b[k] for k in ("n", "points", "total", "whole")} | {"seen": max(a["seen"], b["seen"])}
    if not a["points"] or not b["points"]:
        full = a if a["points"] else b
        return out | {k: full[k] for k in _NAMES if k not in out}
    first = min((a, b), key=lambda x: (x["first_at"], x["first_tie"]))
    last = max((a, b), key=lambda x: (x["last_at"], x["last_tie"]))
    return out | {"least": min(a["least"], b["least"]), "most": max(a["most"], b["most"])} | {k: first[k] for k in ("first_at", "first_tie", "first_value", "first_int")} | {k: last[k] for k in ("last_at", "last_tie", "last_value")}


class _Intervals(StatefulProcessor):
    """A map of open intervals for each key, and a timer at the end of each. Partials of closed intervals count as late at once."""

    def __init__(self, keys: Sequence[str], seconds: int):
        self.keys, self.seconds = list(keys), seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "w long", _PARTIAL)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        closed = timerValues.getCurrentWatermarkInMs()
        found: dict[int, dict] = {}
        for some in rows:
            for r in some[["w", *_NAMES]].astype(object).where(some[["w", *_NAMES]].notna(), None).to_dict("records"):
                w = int(r.pop("w"))
                found[w] = _merged(found.get(w), r)
        late = 0
        for w, partial in found.items():
            end = (w + self.seconds) * 1000
            if end <= closed:
                late += int(partial["n"])
                continue
            before = dict(zip(_NAMES, self.open.getValue((w,)), strict=True)) if self.open.containsKey((w,)) else None
            if before is None:
                self.handle.registerTimer(end)
            merged = _merged(before, partial)
            self.open.updateValue((w,), tuple(None if merged[k] is None else bool(merged[k]) if k == "first_int" else float(merged[k]) if k in ("total", "least", "most", "first_value", "last_value") else int(merged[k]) for k in _NAMES))
        return self._out(key, [(None, dict.fromkeys(_NAMES) | {"n": late})]) if late else iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        w = expiredTimerInfo.getExpiryTimeInMs() // 1000 - self.seconds
        if not self.open.containsKey((w,)):
            return iter([])
        partial = dict(zip(_NAMES, self.open.getValue((w,)), strict=True))
        self.open.removeKey((w,))
        return self._out(key, [(w, partial)])

    def _out(self, key, closed: list[tuple[int | None, dict]]) -> Iterator[pd.DataFrame]:
        rows = [[*key, w, *(p[k] for k in _NAMES)] for w, p in closed]
        frame = pd.DataFrame(rows, columns=[*self.keys, "w", *_NAMES])
        for c in frame.columns[len(self.keys) :]:
            kind = "boolean" if c == "first_int" else "Float64" if c in ("total", "least", "most", "first_value", "last_value") else "Int64"
            frame[c] = frame[c].astype(kind)
        yield frame

    def close(self) -> None:
        pass


def intervals(stream: DataFrame, keys: Sequence[str], value: str | None = None, value_type: str | None = None, tie: str | None = None, seconds: int = 60, ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """A stream of one row for each key and interval of event time, once the watermark (`delay` behind the newest row) has passed its end.

    Columns: the keys as text, start_ts, ts (the interval's end), n (rows), late, last_seen, and where a value is given points, min, max,
    avg, first, last and value_type, as `metric_stats` has them: a series whose first point is an int has whole numbers. Rows of an
    interval already closed give a row with a null interval and their number in `late`. Rows without a time are left out, null keys
    are a key. State is kept by RocksDB under the checkpoint, so a stopped query goes on from where it was.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    number = F.col(value).cast("double") if value else F.lit(None).cast("double")
    whole = (F.col(value_type) == "int") if value_type else F.lit(False)
    rows = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay).where("_ts is not null").select(
        *[F.col(k).cast("string").alias(k) for k in keys], F.unix_micros("_ts").alias("at"), (F.col(tie).cast("long") if tie else F.lit(0).cast("long")).alias("tie"), number.alias("value"), F.coalesce(whole, F.lit(False)).alias("is_int"),
    )
    combine, schema = _partials(keys, seconds)
    out = rows.mapInArrow(combine, schema).groupBy(*keys).transformWithStateInPandas(_Intervals(keys, seconds), schema, "Append", "EventTime")
    return _shown(out, keys, seconds, value is not None)


def _shown(df: DataFrame, keys: Sequence[str], seconds: int, values: bool) -> DataFrame:
    start = F.timestamp_seconds("w")
    columns = [*keys, start.alias("start_ts"), F.timestamp_seconds(F.col("w") + seconds).alias("ts"), F.when(F.col("w").isNotNull(), F.col("n")).otherwise(0).alias("n"), F.when(F.col("w").isNull(), F.col("n")).otherwise(0).alias("late"), F.timestamp_micros("seen").alias("last_seen")]
    if not values:
        return df.select(*columns)
    ints = F.coalesce(F.col("first_int"), F.lit(False))
    cut = lambda c: F.when(ints, F.when(F.col(c) < 0, F.ceil(c)).otherwise(F.floor(c)).cast("double")).otherwise(F.col(c))
    avg = F.when(F.col("points") > 0, F.when(ints, F.expr("whole div points").cast("double")).otherwise(F.col("total") / F.col("points")))
    return df.select(*columns, F.coalesce("points", F.lit(0)).alias("points"), cut("least").alias("min"), cut("most").alias("max"), avg.alias("avg"), cut("first_value").alias("first"), cut("last_value").alias("last"), F.when(F.col("points") > 0, F.when(ints, "int").otherwise("double")).alias("value_type"))
