"""Joins with reference tables: lookup, indicators, decoding."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows and bytes (of the rows as JSON) of a reference table up to which it is broadcast by hint; larger ones are left to the planner.
SMALL_ROWS = 1_000_000
SMALL_BYTES = 64 << 20


def small(df: DataFrame, rows: int = SMALL_ROWS, size: int = SMALL_BYTES) -> DataFrame:
    """The table with a broadcast hint if both its rows and their bytes are few. The measure reads at most rows + 1 rows."""
    row_bytes = F.octet_length(F.to_json(F.struct(*df.columns)))
    found = df.limit(rows + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(row_bytes), F.lit(0)).alias("size")).first()
    return F.broadcast(df) if found["n"] <= rows and found["size"] <= size else df


def last_by_key(ref: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """One row for each key, the last by the order column (by file and line where none is given)."""
    n = F.col(order) if order else F.monotonically_increasing_id()
    others = [c for c in ref.columns if c not in (key, order)]
    kept = ref.withColumn("_n", n).groupBy(key).agg(F.max_by(F.struct(*others), "_n").alias("_r"))
    return kept.select(key, *[F.col(f"_r.{c}").alias(c) for c in others])


def read_lookup_csv(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A CSV file with a header as strings, one row for each key; of rows with one key the last stays."""
    return last_by_key(spark.read.option("header", True).csv(path), key)


def lookup(df: DataFrame, ref: DataFrame, field: str | Column, key: str) -> DataFrame:
    """Add ref's other columns to rows whose field equals ref's key, over columns of the same name; other rows stay as they are.

    ref holds one row for each key (see last_by_key); a null field misses.
    """
    extra = [c for c in ref.columns if c != key]
    r = small(ref.select(F.col(key).cast("string").alias("_key"), F.lit(True).alias("_hit"), *[F.col(c).alias(f"_ref_{c}") for c in extra]))
    f = F.col(field) if isinstance(field, str) else field
    joined = df.withColumn("_field", f.cast("string")).join(r, F.col("_field") == F.col("_key"), "left")
    new = {c: F.when(F.col("_hit"), F.col(f"_ref_{c}")).otherwise(F.col(c)) if c in df.columns else F.col(f"_ref_{c}") for c in extra}
    return joined.withColumns(new).drop("_field", "_key", "_hit", *[f"_ref_{c}" for c in extra])


def lookup_valid(df: DataFrame, ref: DataFrame, on: str, ts: str, fetched: str, ttl: str = "5 minutes") -> DataFrame:
    """Join each row to the entry of its key that was fetched last before it and is younger than the TTL; else null columns.

    Rows and entries are put in order by key and TTL-long slice of time, each entry in its own slice and the next, and each row takes
    the last entry before it: no pairs are made, and a frequent key is dealt out by time. Of entries fetched at one time the greatest
    counts; rows and entries without key or time don't meet. The TTL is of days or shorter units. Batch only.
    """
    extra = [c for c in ref.columns if c not in (on, fetched)]
    span = F.expr(f"unix_micros(timestamp_micros(0) + interval {ttl})")
    at = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    slice_of = lambda c: F.floor(at(c) / span).cast("long")
    entries = ref.where(F.col(on).isNotNull() & F.col(fetched).isNotNull()).select(
        F.col(on).alias("_on"), F.explode(F.array(slice_of(fetched), slice_of(fetched) + 1)).alias("_slice"), at(fetched).alias("_at"),
        F.struct(at(fetched).alias("_from"), *extra).alias("_entry"),
    )
    rows = df.select(F.col(on).alias("_on"), slice_of(ts).alias("_slice"), at(ts).alias("_at"), F.struct(*df.columns).alias("_row"))
    both = rows.unionByName(entries, allowMissingColumns=True)
    # at one time entries, whose _row is null, stand before rows
    w = W.partitionBy("_on", "_slice").orderBy("_at", F.col("_row").isNotNull(), F.col("_entry").asc_nulls_last()).rowsBetween(W.unboundedPreceding, 0)
    met = both.withColumn("_last", F.last("_entry", ignorenulls=True).over(w)).where("_row is not null")
    valid = F.col("_at") < F.col("_last._from") + span
    return met.select("_row.*", *[F.when(valid, F.col(f"_last.{c}")).alias(c) for c in extra])


def with_reload(fn: Callable[[DataFrame, DataFrame], DataFrame], read: Callable[[], DataFrame], sink: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that reads the reference anew for each batch and keeps the last good one if that fails."""
    held: dict[str, DataFrame] = {}

    def batch(df: DataFrame, epoch: int) -> None:
        try:
            fresh = read()
            fresh.schema  # noqa: B018  a missing file fails here
            held["ref"] = fresh
        except Exception:
            if "ref" not in held:
                raise
        sink(fn(df, held["ref"]), epoch)

    return batch


@dataclass
class Rule:
    """Indicators of one name, and the fields in which they are looked for, in order."""

    name: str
    fields: Sequence[str]
    indicators: DataFrame
    value: str = "indicator"
    keys: list[str] = field(default_factory=list)


def indicators(df: DataFrame, column: str) -> DataFrame:
    """Trimmed, non-blank, different values."""
    return df.select(F.trim(F.col(column).cast("string")).alias("indicator")).where("indicator <> ''").distinct()


def threat_match(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add threat_matched and threat_rule: the first rule, and in it any field, whose trimmed text is an indicator; blanks never match."""
    out, hits = df, []
    for i, rule in enumerate(rules):
        own = small(indicators(rule.indicators, rule.value).withColumn("_hit", F.lit(True)))
        for j, f in enumerate(rule.fields):
            name = f"_t{i}_{j}"
            out = out.withColumn(f"_v{i}_{j}", F.trim(F.col(f).cast("string"))).join(own.select(F.col("indicator").alias(f"_k{i}_{j}"), F.col("_hit").alias(name)), F.col(f"_v{i}_{j}") == F.col(f"_k{i}_{j}"), "left").drop(f"_v{i}_{j}", f"_k{i}_{j}")
            hits.append((name, rule.name))
    rule_name = F.coalesce(*[F.when(F.col(h), F.lit(n)) for h, n in hits], F.lit(None).cast("string"))
    return out.withColumns({"threat_rule": rule_name, "threat_matched": rule_name.isNotNull()}).drop(*[h for h, _ in hits])


def only_matched(df: DataFrame, known: DataFrame, field: str, value: str = "indicator") -> DataFrame:
    """Rows whose field is an indicator."""
    k = small(indicators(known, value))
    return df.join(k, F.trim(F.col(field).cast("string")) == k["indicator"], "left_semi")


def only_clean(df: DataFrame, known: DataFrame, field: str, value: str = "indicator") -> DataFrame:
    """Rows whose field is no indicator; null fields are clean."""
    k = small(indicators(known, value))
    return df.join(k, F.trim(F.col(field).cast("string")) == k["indicator"], "left_anti")


#: Bits of a block of a Bloom filter: eight numbers of 64 bits, one row of the filter's table.
BLOCK_BITS = 512


@dataclass(frozen=True)
class Bloom:
    """A Bloom filter as a table (block, bits): a value's bits all lie in the block that its hash names."""

    table: DataFrame
    blocks: int
    hashes: int


def bloom(known: DataFrame, value: str, fpr: float = 0.01) -> Bloom:
    """A Bloom filter over the indicators. It stays a table of Spark, so it may be of any size; no part of it passes the driver."""
    values = indicators(known, value)
    n = max(1, values.count())
    # blocks fill unevenly, so a filter in blocks takes a tenth more bits than one in a single array
    m = 1.1 * -n * math.log(fpr) / math.log(2) ** 2
    blocks, hashes = math.ceil(m / BLOCK_BITS), max(1, round(m / 1.1 / n * math.log(2)))
    one = values.select(_block(F.col("indicator"), blocks).alias("block"), F.explode(_bits(F.col("indicator"), hashes)).alias("b"))
    bit = F.expr("shiftleft(1L, b % 64)")
    words = [F.coalesce(F.bit_or(F.when(F.floor(F.col("b") / 64) == i, bit)), F.lit(0).cast("long")) for i in range(BLOCK_BITS // 64)]
    return Bloom(one.groupBy("block").agg(F.array(*words).alias("bits")), blocks, hashes)


def _block(value: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(-1), value), F.lit(blocks))


def _bits(value: Column, hashes: int) -> Column:
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), value), F.lit(BLOCK_BITS)).cast("int") for i in range(hashes)])


def maybe_matched(df: DataFrame, filt: Bloom, field: str) -> DataFrame:
    """Rows whose field may be an indicator: all that are, and few others. The filter's blocks are broadcast up to SMALL_BYTES, else
    each row is sent to its block."""
    value = F.trim(F.col(field).cast("string"))
    table = filt.table.select(F.col("block").alias("_block"), F.col("bits").alias("_bits"))
    table = F.broadcast(table) if filt.blocks * (BLOCK_BITS // 8 + 32) <= SMALL_BYTES else table
    hit = F.forall(_bits(value, filt.hashes), lambda b: F.call_function("getbit", F.get(F.col("_bits"), F.floor(b / 64).cast("int")), b % 64) == 1)
    return df.where(F.col(field).isNotNull()).join(table, _block(value, filt.blocks) == F.col("_block")).where(hit).drop("_block", "_bits")


def decode(df: DataFrame, column: str, table: Mapping | DataFrame, into: str, key: str = "key", value: str = "value") -> DataFrame:
    """Replace a code by its name; unknown codes give null. A mapping is a map literal, a table a join."""
    if isinstance(table, DataFrame):
        t = small(table.select(F.col(key).alias("_k"), F.col(value).alias(into)))
        return df.join(t, F.col(column) == F.col("_k"), "left").drop("_k")
    return df.withColumn(into, F.element_at(F.create_map(*[F.lit(x) for p in table.items() for x in p]), F.col(column)))


def resolve_log_type(df: DataFrame, explicit: str, mapped: Mapping[str, str], source: str, valid: DataFrame | None = None, default: str = "CATCH_ALL", into: str = "log_type") -> DataFrame:
    """The explicit type if it is valid, else the type mapped from the source, else the default."""
    ok = F.col(explicit).isNotNull()
    if valid is not None:
        v = small(valid.select(F.col(valid.columns[0]).alias("_valid")).distinct())
        df = df.join(v, F.col(explicit) == F.col("_valid"), "left")
        ok = F.col("_valid").isNotNull()
    table = F.create_map(*[F.lit(x) for p in mapped.items() for x in p]) if mapped else None
    found = F.when(ok, F.col(explicit)).otherwise(F.coalesce(F.element_at(table, F.col(source)) if table is not None else F.lit(None), F.lit(default)))
    return df.withColumn(into, found).drop("_valid")
