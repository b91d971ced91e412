"""Runs of streams over what has landed: each reads what is new since its checkpoint, and stops."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def each_batch(stream: DataFrame, checkpoint: str, fn: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Give `fn` each micro-batch that is new since the checkpoint, with its number, then stop. After a failure a batch comes again
    with its number and rows, so `fn` should write under that number."""
    query = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _parts(path: str, fn: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, number: int) -> None:
        fn(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def keep_sums(stream: DataFrame, path: str, checkpoint: str, by: Sequence[str], interval: str = "1 minute", ts: str = "ts") -> StreamingQuery:
    """Rows by interval and keys, as partial counts of each micro-batch: late rows count, no state is kept, and a batch that comes
    again replaces its own part. `sums` adds the parts."""
    return each_batch(stream, checkpoint, _parts(path, lambda b: b.groupBy(F.window(ts, interval).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start_ts"), *by, "n")))


def sums(spark: SparkSession, path: str, by: Sequence[str]) -> DataFrame:
    """The counts of `keep_sums` so far."""
    return spark.read.parquet(path).groupBy("start_ts", *by).agg(F.sum("n").alias("n"))


def keep_latest(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], ts: str = "ts") -> StreamingQuery:
    """When each combination of keys was last seen, as a part of each micro-batch; rows that lack a key don't count. `latest` reads them."""
    return each_batch(stream, checkpoint, _parts(path, lambda b: b.dropna(subset=list(keys)).groupBy(*keys).agg(F.max(ts).alias("last_seen"))))


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The times of `keep_latest` so far."""
    return spark.read.parquet(path).groupBy(*keys).agg(F.max("last_seen").alias("last_seen"))


def keep_rows(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the rows of a stream to Parquet files, each once: the folder's log names the files that count."""
    query = stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
