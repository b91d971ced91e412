"""Row filters: conditions, samples, search, recency, routes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tellurion.functions.expressions import holds


def match(df: DataFrame, cond: str | Column) -> DataFrame:
    """Rows for which the condition is true; null and false drop the row."""
    return df.where(holds(cond))


def drop_where(df: DataFrame, cond: str | Column) -> DataFrame:
    """Rows for which the condition is not true."""
    return df.where(~holds(cond))


def drawn(key: Column, seed: int = 0) -> Column:
    """A number below 2^48 that any engine draws alike for a key: the first 12 hex digits of the MD5 of `seed:key`. Null is ''."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint")


def sample(df: DataFrame, drop_ratio: float, cond: str | Column = "true", seed: int = 0, key: str | Column | None = None) -> DataFrame:
    """Drop rows that meet the condition with probability `drop_ratio`; others stay, as do rows whose condition is null.

    With a key, rows of equal keys are dropped together and every run agrees; ratios of 0 and 1 need no draw.
    """
    if drop_ratio <= 0:
        return df
    if drop_ratio >= 1:
        return drop_where(df, cond)
    k = F.col(key) if isinstance(key, str) else key
    draw = F.rand(seed) if k is None else drawn(k, seed) / float(1 << 48)
    return df.where(~(holds(cond) & (draw <= drop_ratio)))


def search(df: DataFrame, text: str, columns: Sequence[str]) -> DataFrame:
    """Rows that hold the text in one of the columns: in strings, or in keys or values of maps, arrays and structs."""
    kinds = dict(df.dtypes)
    found = F.lit(False)
    for c in columns:
        kind = kinds[c]
        if kind == "map<string,string>":
            found |= F.exists(F.map_keys(c), lambda x: x.contains(text)) | F.exists(F.map_values(c), lambda x: F.coalesce(x.contains(text), F.lit(False)))
        elif kind.startswith(("map", "array", "struct", "variant")):
            found |= F.to_json(c).contains(text)
        else:
            found |= F.col(c).cast("string").contains(text)
    return df.where(F.coalesce(found, F.lit(False)))


def since(df: DataFrame, ts, column: str = "ts") -> DataFrame:
    """Rows strictly newer than an instant."""
    return df.where(F.col(column) > F.lit(ts))


#: Bits of a draw by which one step of sample_percent counts.
STEP_BITS = 16


def sample_percent(df: DataFrame, pct: int, seed: int = 0, order: str | None = None) -> DataFrame:
    """floor(n * pct / 100) rows (pct 0 counts as 1, 100 keeps all): those of the least draws by MD5 of `order`, or of the whole row.

    Nothing is sorted and nothing meets in one task: rows are counted by the first 16 bits of their draws, those at the border by
    the next 16, then the last, at most 65,536 counts at a time. Rows of the border's own draw are told apart by a hash of the whole
    row in the same way; of equal rows so many copies are kept as are due.
    """
    pct = pct or 1
    if pct >= 100:
        return df
    whole = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    draw, row = "_draw" + "_" * max(map(len, df.columns)), "_row" + "_" * max(map(len, df.columns))
    marked = df.withColumn(draw, drawn(F.col(order) if order else whole, seed))
    left = df.count() * pct // 100
    kept, open_ = F.lit(False), F.lit(True)  # rows surely kept, and those that agree with the border so far
    for column, bits in ((F.col(draw), 48), (F.xxhash64(whole), 64)):
        for low in range(bits - STEP_BITS, -1, -STEP_BITS):
            digit = F.shiftright(column, low).bitwiseAND((1 << STEP_BITS) - 1)
            border = 1 << STEP_BITS
            for value, n in sorted(marked.where(open_).groupBy(digit.alias("d")).count().collect()):
                if n > left:
                    border = value
                    break
                left -= n
            kept, open_ = kept | (open_ & (digit < border)), open_ & (digit == border)
            if not left or border == 1 << STEP_BITS:
                return marked.where(kept).drop(draw)
    one = marked.where(open_).drop(draw).limit(1)  # all that are left equal it
    copies = df.sparkSession.range(left).withColumnRenamed("id", row).crossJoin(F.broadcast(one)).drop(row)
    return marked.where(kept).drop(draw).unionByName(copies)


def most_recent(df: DataFrame, n: int = 100, ts: str = "ts", tie: Sequence[str] = ()) -> DataFrame:
    """The n newest rows; equal times in descending order of the tie columns."""
    return df.orderBy(F.desc(ts), *[F.desc(t) for t in tie]).limit(n)


def sample_within_bytes(df: DataFrame, max_bytes: int, key: str, size: Column) -> DataFrame:
    """The largest of 1, 25, 50, 75 and 100 percent of the rows, by a hash of the key, whose summed size is within the budget."""
    u = drawn(F.col(key)) % 100
    steps = (1, 25, 50, 75, 100)
    sums = df.agg(*[F.coalesce(F.sum(F.when(u < p, size)), F.lit(0)).alias(f"p{p}") for p in steps]).first()
    fit = [p for p in steps if sums[f"p{p}"] <= max_bytes]
    return df.where(u < (fit[-1] if fit else 0))


def eligible_metrics(df: DataFrame, include: str) -> DataFrame:
    """Gauges and cumulative sums whose name the pattern matches anywhere."""
    kind = (F.col("metric_type") == "gauge") | ((F.col("metric_type") == "sum") & (F.col("temporality") == "cumulative"))
    return df.where(holds(kind & F.col("metric_name").rlike(include)))


def route(df: DataFrame, routes: Sequence[tuple[str, str | Column]], default: str | None = None, column: str = "route") -> DataFrame:
    """Add the name of the first route whose condition is true, else the default."""
    out = F.lit(default)
    for name, cond in reversed(routes):
        out = F.when(holds(cond), F.lit(name)).otherwise(out)
    return df.withColumn(column, out)


def fan_out(df: DataFrame, routes: Sequence[tuple[str, str | Column]], default: str = "default") -> dict[str, DataFrame]:
    """A table for each route and the default; together they are the whole input."""
    dealt = route(df, routes, default, "_route")
    return {n: dealt.where(F.col("_route") == n).drop("_route") for n in [*dict.fromkeys(n for n, _ in routes), default]}


def limited_slice(df: DataFrame, start, end, limit: int, ts: str = "ts", tie: Sequence[str] = ()) -> DataFrame:
    """At most `limit` rows from start (inclusive) to end (exclusive), the oldest first."""
    return df.where((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end))).orderBy(ts, *tie).limit(limit)


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], column: str = "n") -> DataFrame:
    """Row numbers within each group."""
    return df.withColumn(column, F.row_number().over(W.partitionBy(*by).orderBy(*order)))
