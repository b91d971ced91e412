"""Running counts and runs over ordered tables of any size: slices are scanned side by side, and a small scan joins their borders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellurion.functions.shared import shared_path


def fresh(df: DataFrame, name: str) -> str:
    """A name that no column has."""
    while name in df.columns:
        name += "_"
    return name


def sliced(df: DataFrame, by: Sequence[str], order: Sequence[str], column: str) -> DataFrame:
    """The rows with the number of their slice: ranges of the order in each group, ascending, as many as Spark has shuffle partitions.

    Rows of equal order stand in one slice. The result is written, so that the numbers stay what they are.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_path(spark, "slices")
    df.repartitionByRange(n, *by, *order).withColumn(column, F.spark_partition_id()).write.parquet(path)
    return spark.read.schema(T.StructType([*df.schema.fields, T.StructField(column, T.IntegerType())])).parquet(path)


def _same(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & a[c].eqNullSafe(b[f"_b_{c}"])
    return out


def _carried(rows: DataFrame, borders: DataFrame, by: Sequence[str], own: str, carry: str) -> DataFrame:
    """Rows with what their slice carries over from those before it."""
    keys = [*by, own]
    right = borders.select(*[F.col(c).alias(f"_b_{c}") for c in keys], carry)
    return rows.join(right, _same(rows, right, keys)).drop(*[f"_b_{c}" for c in keys])


def running_count(df: DataFrame, flag: Column, order: Sequence[str], by: Sequence[str] = (), into: str = "n") -> DataFrame:
    """Add how many rows of the group, up to and with this one, meet the condition; null is false. Without `by` the table is one group.

    Each slice counts for itself; of every slice one number goes into a scan over the slices, which gives what each carries over.
    """
    own, hit, carry = fresh(df, "_slice"), fresh(df, "_hit"), fresh(df, "_carry")
    rows = sliced(df.withColumn(hit, F.coalesce(flag, F.lit(False)).cast("int")), by, order, own)
    before = W.partitionBy(*by).orderBy(own).rowsBetween(W.unboundedPreceding, -1)
    borders = rows.groupBy(*by, own).agg(F.sum(hit).alias("_n")).select(*by, own, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(carry))
    here = W.partitionBy(*by, own).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return _carried(rows, borders, by, own, carry).withColumn(into, F.sum(hit).over(here) + F.col(carry)).drop(own, hit, carry)


def run_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], by: Sequence[str] = (), into: str = "run") -> DataFrame:
    """Add the number, from 1, of the run of equal keys that each row of an ordered group stands in; null keys equal each other.

    A slice gives its first and last keys and how often they change within it. A run goes on over a border where the last keys
    before it equal the first after it.
    """
    own, new, carry = fresh(df, "_slice"), fresh(df, "_new"), fresh(df, "_carry")
    rows = sliced(df, by, order, own)
    w = W.partitionBy(*by, own).orderBy(*order)
    now = F.struct(*keys)
    marked = rows.withColumn(new, F.when(F.row_number().over(w) == 1, 0).otherwise((~now.eqNullSafe(F.lag(now).over(w))).cast("int")))
    at = F.struct(*order)
    ends = marked.groupBy(*by, own).agg(F.min_by(now, at).alias("_first"), F.max_by(now, at).alias("_last"), F.sum(new).alias("_n"))
    over = W.partitionBy(*by).orderBy(own)
    starts = ends.withColumn("_start", F.when(F.row_number().over(over) == 1, 1).otherwise((~F.col("_first").eqNullSafe(F.lag("_last").over(over))).cast("int")))
    upto = over.rowsBetween(W.unboundedPreceding, 0)
    borders = starts.select(*by, own, (F.sum(F.col("_start") + F.col("_n")).over(upto) - F.col("_n")).alias(carry))
    here = w.rowsBetween(W.unboundedPreceding, 0)
    return _carried(marked, borders, by, own, carry).withColumn(into, F.sum(new).over(here) + F.col(carry)).drop(own, new, carry)
