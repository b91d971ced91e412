"""Operator 8: mixing sources to target weights by iterative proportional fitting."""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM, SPACED, flat, slices, table, words, written

#: Cells (combinations of the dimensions' values) up to which the fit runs on their list at the driver; more are fitted by Spark jobs.
DRIVER_CELLS = 200_000
#: Passes over all dimensions at most, and how far a marginal share may be from its target when the fit ends. A fit that ends with a
#: share further off than UNMET warns by how much: such targets contradict each other or ask for what no cell has.
PASSES, CLOSE, UNMET = 200, 1e-9, 1e-6
#: Share of all tokens to keep, and the exponents that temper observed shares where no targets are given.
BUDGET, TEMPER = 0.7, {"source": 0.5, "lang": 0.7, "topic": 0.7}
SEED = 13


TOPICS = ("prose", "short", "long", "noisy", "contact", "licensed", "table")
CONTACT = r"[0-9A-Za-z_]@[0-9A-Za-z-]+\.[A-Za-z]|\([0-9]{3}\) [0-9]{3}-[0-9]{4}"


def shaped(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add tokens (words between ASCII white space) and topic, what a whole text looks like: the first that holds of table (three or
    more ` | `), licensed (`Licensed under`), contact (a mail address or phone number), noisy (an ASCII sign thrice in a row), short
    (under 50 words; null and empty too), long (1000 or more) and prose. Columns stay; those of these two names are replaced."""
    docs = docs.drop("tokens", "topic")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            t = pc.fill_null(batch.column(text), "")
            n = words(t, SPACED).per_text.astype(np.int64)
            raw, offsets = flat(t)
            sign = (raw < 128) & (ALNUM[raw] == 0) & (SPACED[raw] != 0)
            thrice = np.flatnonzero(sign[2:] & (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2])) if len(raw) > 2 else np.zeros(0, np.int64)
            doc = np.searchsorted(offsets, thrice, side="right") - 1
            noisy = np.zeros(batch.num_rows, bool)
            noisy[doc[thrice + 3 <= offsets[doc + 1]]] = True
            has = lambda x: x.to_numpy(zero_copy_only=False).astype(bool)
            kind = np.where(n < 50, 1, np.where(n >= 1000, 2, 0))
            for k, which in ((3, noisy), (4, has(pc.match_substring_regex(t, CONTACT))), (5, has(pc.match_substring(t, "Licensed under"))), (6, pc.count_substring(t, " | ").to_numpy() >= 3)):
                kind = np.where(which, k, kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n), pa.array(np.array(TOPICS, object)[kind], pa.string())], [*batch.schema.names, "tokens", "topic"])

    return docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField("tokens", T.LongType()), T.StructField("topic", T.StringType())]))


def targets_of(cells: DataFrame, dims: list[str], given: dict[str, dict[str, float]] | None, temper: dict[str, float]) -> dict[str, DataFrame]:
    """For each dimension its values that have tokens, with target shares: those given, else observed shares to a power, scaled to 1.
    Values without a given target get 0; given values without tokens are left out."""
    out = {}
    for d in dims:
        sums = cells.groupBy(d).agg(F.sum("tokens").alias("t")).where("t > 0")
        if given and d in given:
            wish = F.create_map(*[x for k, v in given[d].items() for x in (F.lit(k), F.lit(float(v)))])
            raw = sums.select(d, F.coalesce(F.element_at(wish, F.col(d)), F.lit(0.0)).alias("raw"))
        else:
            raw = sums.select(d, F.pow("t", F.lit(temper.get(d, 1.0))).alias("raw"))
        out[d] = raw.crossJoin(raw.agg(F.sum("raw").alias("all"))).select(d, (F.col("raw") / F.col("all")).alias("target"))  # a one-row total
    return out


def rake_driver(keys: list[np.ndarray], tokens: np.ndarray, targets: list[np.ndarray]) -> np.ndarray:
    """Token weights whose marginals meet the targets; keys number each cell's value of each dimension."""
    total, w = tokens.sum(), tokens.astype(float)
    for _ in range(PASSES):
        off = 0.0
        for k, t in zip(keys, targets, strict=True):
            have = np.bincount(k, w, len(t)) / total
            factor = np.divide(t, have, out=np.zeros(len(t)), where=have > 0)
            off = max(off, np.abs(have - t).max())
            w = w * factor[k]
        if off < CLOSE:
            break
    _warn(off)
    return w


def _warn(off: float) -> None:
    if off > UNMET:
        warnings.warn(f"targets are not met: a share is off by {off:.3g} after {PASSES} passes", stacklevel=3)


def rake_spark(cells: DataFrame, dims: list[str], targets: dict[str, DataFrame]) -> DataFrame:
    """The same by jobs over the table of cells, written after each pass."""
    total = cells.agg(F.sum("tokens")).first()[0]
    w = written(cells.withColumn("w", F.col("tokens").cast("double")), "cells")
    for _ in range(PASSES):
        off = []
        for d in dims:
            have = w.groupBy(d).agg((F.sum("w") / total).alias("have")).join(targets[d], d)
            off.append(have.agg(F.max(F.abs(F.col("have") - F.col("target")))).first()[0])
            factor = have.select(d, F.when(F.col("have") > 0, F.col("target") / F.col("have")).otherwise(0.0).alias("f"))
            w = w.join(factor, d, "left").withColumn("w", F.col("w") * F.coalesce("f", F.lit(0.0))).drop("f")
        w = written(w, "cells")
        if max(off) < CLOSE:
            break
    _warn(max(off, default=0.0))
    return w


def fill(ratio: np.ndarray, tokens: np.ndarray, budget: float) -> float:
    """The scale at which min(1, scale * ratio) keeps this share of all tokens, or as much of it as cells with weight hold."""
    order = np.argsort(-ratio)
    r, t = ratio[order], tokens[order].astype(float)
    want = min(budget * t.sum(), t[r > 0].sum())
    full, rest = np.concatenate([[0], np.cumsum(t)]), np.concatenate([np.cumsum((r * t)[::-1])[::-1], [0]])
    for k in range(len(r)):  # the k largest ratios kept whole
        if rest[k] <= 0:
            break
        scale = (want - full[k]) / rest[k]
        if scale * r[k] <= 1:
            return max(scale, 0.0)
    return 1 / r[r > 0].min() if (r > 0).any() else 0.0


def mixture(docs: DataFrame, dims: dict[str, Column], targets: dict[str, dict[str, float]] | None = None, temper: dict[str, float] = TEMPER, budget: float = BUDGET, key: Column | None = None, driver_cells: int = DRIVER_CELLS) -> DataFrame:
    """Add the cell's probability and weight, and kept, to each row of a table with a column tokens.

    The tokens of each cell (values of the dimensions together) are raked until the marginals of every dimension meet their targets;
    probability is proportional to raked over observed tokens, at most 1, and such that `budget` of all tokens is expected to stay;
    weight (0 for probability 0) makes up for probabilities held at 1, so that kept tokens times weight meet the targets on average.
    A row is kept if the hash of its key (its doc_id, or text if that is null) falls below its probability, so equal runs agree.

    Only counts by cell are shuffled, and the cells' list, whose size is checked, is broadcast; up to `driver_cells` cells are fitted
    at the driver, more by jobs. Null values of a dimension count as the empty string. Rows of no tokens have their cell's
    probability, or 0 if the cell has no tokens at all; an empty table stays empty. Columns named _dim_*, probability, weight and
    kept are replaced.
    """
    names = [f"_dim_{d}" for d in dims]
    new = {n: F.coalesce(c.cast("string"), F.lit("")) for n, c in zip(names, dims.values(), strict=True)}
    rows = docs.drop(*names, "probability", "weight", "kept").withColumns(new)
    cells = written(rows.groupBy(*names).agg(F.sum("tokens").alias("tokens")).where("tokens > 0"), "cells")
    wish = {f"_dim_{d}": v for d, v in (targets or {}).items()}
    goal = targets_of(cells, names, wish, {f"_dim_{d}": v for d, v in temper.items()})
    n = cells.count()
    if n <= driver_cells:
        got = sorted(cells.collect())
        t = np.array([r.tokens for r in got], float)
        keys, aims = [], []
        for k, d in enumerate(names):
            aim = {r[0]: r[1] for r in goal[d].collect()}
            values = sorted(aim)
            at = {v: i for i, v in enumerate(values)}
            keys.append(np.array([at[r[k]] for r in got], np.int64))
            aims.append(np.array([aim[v] for v in values]))
        w = rake_driver(keys, t, aims) if n else t
        scale = fill(w / t, t, budget) if n else 0.0
        fitted = docs.sparkSession.createDataFrame([(*r[: len(names)], float(x)) for r, x in zip(got, w / np.maximum(t, 1), strict=True)], ", ".join(f"{d} string" for d in names) + ", ratio double")
    else:
        w = written(rake_spark(cells, names, goal).select(*names, "tokens", (F.col("w") / F.col("tokens")).alias("ratio")), "fitted")
        scale = _scale_spark(w, budget)
        fitted = w.drop("tokens")
    p = F.least(F.lit(1.0), F.coalesce(F.col("ratio"), F.lit(0.0)) * scale)
    u = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.coalesce(key if key is not None else F.col("doc_id").cast("string"), F.col("text"))), 11) / float(1 << 53)
    found = rows.join(F.broadcast(fitted) if n <= driver_cells else fitted, names, "left")
    return found.withColumns({"probability": p, "weight": F.when(p > 0, F.col("ratio") * scale / p).otherwise(0.0), "kept": u < p}).drop("ratio", *names)


def _scale_spark(fitted: DataFrame, budget: float) -> float:
    """The scale of `fill` by bisection, a sum over the cells at each step."""
    total, there = fitted.agg(F.sum("tokens"), F.sum(F.when(F.col("ratio") > 0, F.col("tokens")))).first()
    want, low, high = min(budget * total, there or 0), 0.0, 1.0
    kept = lambda s: fitted.agg(F.sum(F.least(F.lit(1.0), F.col("ratio") * s) * F.col("tokens"))).first()[0]
    while kept(high) < want * (1 - 1e-12) and high < 1e12:
        high *= 4
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if kept(mid) < want else (low, mid)
    return high


def mixed(docs: DataFrame, **options) -> DataFrame:
    """mixture() over source, lang and topic of documents, with tokens and topic of their texts."""
    return mixture(shaped(docs), {d: F.col(d) for d in ("source", "lang", "topic")}, **options)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its probability, weight and whether it is kept."""
    found = mixed(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))
    return found.select("doc_id", "source", "lang", "topic", F.col("tokens").alias("n_tokens"), "probability", "weight", "kept")
