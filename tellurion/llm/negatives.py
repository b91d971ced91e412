"""Operator 11: hard negatives of anchors by threshold joins over blocks of vectors, in exact integer scores."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 3, 50, 95
#: Rows of a block and anchors of an anchor block at most, and bytes of their components; bytes of the row blocks of one tile.
BLOCK, ANCHORS, BLOCK_BYTES, TILE_BYTES = 4096, 16384, 4 << 20, 64 << 20
#: Anchors whose scores stand in memory at once.
STRIP = 512
#: One of so many blocks is joined first; what it finds bounds the thresholds of the rest.
SEED = 16
#: Shares of a window, from its top, that a threshold is lowered to while windows lack rows. The last is the whole window.
LEVELS = (1 / 16, 1 / 4, 1.0)
NEVER = np.iinfo(np.int64).min


# ---------------------------------------------------------------- blocks


def pack(key: np.ndarray, ids: np.ndarray, labels: np.ndarray, codes: np.ndarray) -> bytes:
    """Rows as one binary; components take two bytes each where they fit."""
    small = not codes.size or np.abs(codes).max() < 1 << 15
    head = np.array([*codes.shape, small], np.int64)
    return b"".join([head.tobytes(), key.astype(np.int64).tobytes(), ids.astype(np.int64).tobytes(), labels.astype(np.int64).tobytes(), codes.astype(np.int16 if small else np.float64).tobytes()])


class Rows:
    """key, ids, labels and whole-number components (as doubles) of a block."""

    def __init__(self, raw: bytes):
        n, d, small = np.frombuffer(raw, np.int64, 3).tolist()
        self.key, self.ids, self.labels = np.frombuffer(raw, np.int64, 3 * n, 24).reshape(3, n)
        self.codes = np.frombuffer(raw, np.int16 if small else np.float64, n * d, 24 + 24 * n).reshape(n, d).astype(np.float64)


def _packed(held: list[pa.RecordBatch], n: int) -> tuple[pa.Table, list[pa.RecordBatch]]:
    t = pa.Table.from_batches(held)
    return t.slice(0, n).combine_chunks(), t.slice(n).to_batches()


def _cut(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Runs of at most `most` rows and BLOCK_BYTES of components, each of one dimension, of rows in order of dimension."""
    held: list[pa.RecordBatch] = []
    rows, dim = 0, None

    def runs() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(dims)) + 1).tolist(), len(dims)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b > a:
                    yield batch.slice(a, b - a)

    for run in runs():
        own = run.column("dim")[0].as_py()
        if held and own != dim:
            yield pa.Table.from_batches(held).combine_chunks()
            held, rows = [], 0
        dim = own
        held.append(run)
        rows += run.num_rows
        limit = max(1, min(most, BLOCK_BYTES // max(1, 2 * dim)))
        while rows >= limit:
            full, held = _packed(held, limit)
            rows -= limit
            yield full
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def _row_blocks(rows: DataFrame) -> DataFrame:
    """block, dim, low, high (labels), bytes, raw: rows of like labels together; a label of many rows stands in many ranges."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        for t in _cut(batches, BLOCK):
            labels, n = t.column("label").to_numpy(), t.num_rows
            codes = t.column("codes").combine_chunks().flatten().to_numpy().reshape(n, -1)
            raw = pack((block << 16) + np.arange(n), t.column("vec_id").to_numpy(), labels, codes)
            yield pa.record_batch([pa.array([x], k) for x, k in ((block, pa.int64()), (codes.shape[1], pa.int32()), (labels.min(), pa.int64()), (labels.max(), pa.int64()), (len(raw), pa.int64()), (raw, pa.binary()))], ["block", "dim", "low", "high", "bytes", "raw"])
            block += 1

    dealt = rows.repartitionByRange("dim", "label", F.xxhash64("vec_id")).sortWithinPartitions("dim", "label", "vec_id")
    return written(dealt.mapInArrow(blocks, "block long, dim int, low long, high long, bytes long, raw binary"), "vector-blocks")


def _anchor_rows(blocks: DataFrame, every: int) -> DataFrame:
    """key, vec_id, label, dim, codes (binary) of the anchors of all blocks."""

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("raw").to_pylist():
                r = Rows(raw)
                at = np.flatnonzero(r.ids % every == 0)
                kept = [r.codes[k].tobytes() for k in at]
                yield pa.record_batch([pa.array(r.key[at]), pa.array(r.ids[at]), pa.array(r.labels[at]), pa.array(np.full(len(at), r.codes.shape[1], np.int32)), pa.array(kept, pa.binary())], ["key", "vec_id", "label", "dim", "codes"])

    return written(blocks.select("raw").mapInArrow(anchors, "key long, vec_id long, label long, dim int, codes binary"), "anchors")


def _anchor_blocks(anchors: DataFrame) -> DataFrame:
    """ablock, adim, alow, ahigh, araw, windows: anchors with the windows they look for (window, cap, least), nulls for no bound."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        for t in _cut(batches, ANCHORS):
            labels, n = t.column("label").to_numpy(), t.num_rows
            codes = np.frombuffer(b"".join(t.column("codes").to_pylist()), np.float64).reshape(n, -1)
            raw = pack(t.column("key").to_numpy(), t.column("vec_id").to_numpy(), labels, codes)
            windows = [(k, w["window"], w["cap"], w["least"]) for k, some in enumerate(t.column("windows").to_pylist()) for w in some]
            flat = np.array([[NEVER if x is None else x for x in w] for w in windows], np.int64).reshape(-1, 4)
            yield pa.record_batch([pa.array([x], k) for x, k in ((block, pa.int64()), (codes.shape[1], pa.int32()), (labels.min(), pa.int64()), (labels.max(), pa.int64()), (raw, pa.binary()), (flat.tobytes(), pa.binary()))], ["ablock", "adim", "alow", "ahigh", "araw", "windows"])
            block += 1

    dealt = anchors.repartitionByRange("dim", "label", "key").sortWithinPartitions("dim", "label", "key")
    return written(dealt.mapInArrow(blocks, "ablock long, adim int, alow long, ahigh long, araw binary, windows binary"), "anchor-blocks")


# ---------------------------------------------------------------- one tile


class Index:
    """Scores of some anchors with a block of rows, by dimensions in order of their energy in the block.

    Only leading dimensions are indexed: those behind are left out if by their norms they add at most half of the least threshold.
    Scores add up over the indexed ones; a pair is dropped when they and the norms of what is left can't reach its threshold, and
    else its whole product is taken. Where nothing can be left out, the products are whole at once. All sums are of whole numbers
    and exact: in single precision below 2^24, in double below 2^53, else in Python's integers.
    """

    def __init__(self, anchors: np.ndarray, rows: np.ndarray, least: float):
        order = np.argsort(-(rows**2).sum(axis=0), kind="stable")
        q, x = anchors[:, order], rows[:, order]
        most = np.sqrt((q**2).sum(axis=1).max(initial=0) * (x**2).sum(axis=1).max(initial=0))
        self.kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object
        if self.kind is object:
            q, x = (np.array([[int(v) for v in r] for r in m], object).reshape(m.shape) for m in (q, x))
        self.q, self.x = q.astype(self.kind), x.astype(self.kind)
        self.indexed, d = q.shape[1], q.shape[1]
        if self.kind is not object:
            for k in (d // 4, d // 2, 3 * d // 4):
                self.left_q, self.left_x = np.sqrt((q[:, k:] ** 2).sum(axis=1)), np.sqrt((x[:, k:] ** 2).sum(axis=1))
                if 2 * self.left_q.max(initial=0) * self.left_x.max(initial=0) <= least:
                    self.indexed = k
                    break
        self.partial = self.q[:, : self.indexed] @ self.x[:, : self.indexed].T
        self.whole = self.partial if self.indexed == d else None

    def reaching(self, some: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, row and score of all pairs of these anchors with scores of `least` (one for each anchor) or more."""
        if self.whole is None:
            possible = self.partial[some] + 1.000001 * self.left_q[some, None] * self.left_x >= least[some, None].astype(np.float64) - 1
            if possible.sum() * 4 < possible.size:
                a, x = np.nonzero(possible)
                a = some[a]
                score = np.concatenate([np.zeros(0), *(np.einsum("ij,ij->i", self.q[a[k : k + 65536]], self.x[x[k : k + 65536]]) for k in range(0, len(a), 65536))])
                keep = score >= least[a]
                return a[keep], x[keep], score[keep].astype(np.int64)
            self.whole = self.partial + self.q[:, self.indexed :] @ self.x[:, self.indexed :].T
        found = self.whole[some]
        if self.kind is object:
            found = np.clip(found, NEVER, np.iinfo(np.int64).max).astype(np.int64)
            a, x = np.nonzero(found >= least[some, None])
        else:
            a, x = np.nonzero(found >= least[some, None].astype(np.float64))
        return some[a], x, found[a, x].astype(np.int64)


class Windows:
    """The best `k` rows of each window so far: highest score first, ties by smaller id, then by key."""

    def __init__(self, owner: np.ndarray, cap: np.ndarray, least: np.ndarray, k: int):
        self.owner, self.cap, self.least, self.k = owner, cap, least, k
        self.rows = np.zeros((0, 4), np.int64)  # window, score, id, key
        self.first = np.searchsorted(owner, np.arange(owner.max(initial=-1) + 2))

    def need(self) -> np.ndarray:
        """The least score that can still enter each window."""
        out = self.least.copy()
        n = np.bincount(self.rows[:, 0], minlength=len(out))
        full = np.flatnonzero(n >= self.k)
        out[full] = np.maximum(out[full], self.rows[np.cumsum(n)[full] - 1, 1])
        return out

    def counts(self, anchor: np.ndarray, score: np.ndarray, least: np.ndarray) -> np.ndarray:
        w, at = self._spread(anchor)
        ok = (score[at] >= least[w]) & (score[at] <= self.cap[w])
        return np.bincount(w[ok], minlength=len(self.cap))

    def _spread(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each pair once for every window of its anchor."""
        n = self.first[anchor + 1] - self.first[anchor]
        at = np.repeat(np.arange(len(anchor)), n)
        return np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + self.first[anchor][at], at

    def add(self, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray, key: np.ndarray) -> None:
        w, at = self._spread(anchor)
        ok = (score[at] >= self.need()[w]) & (score[at] <= self.cap[w])
        w, at = w[ok], at[ok]
        every = np.concatenate([self.rows, np.stack([w, score[at], ids[at], key[at]], axis=1)])
        every = every[np.lexsort((every[:, 3], every[:, 2], -every[:, 1], every[:, 0]))]
        n = np.bincount(every[:, 0], minlength=len(self.cap))
        self.rows = every[np.arange(len(every)) - np.repeat(np.cumsum(n) - n, n) < self.k]


def fill(anchors: Rows, windows: np.ndarray, blocks: list[Rows], same: bool, k: int) -> np.ndarray:
    """key of anchor, window, score, id and key of row: the best k rows of these blocks for each window of the anchors. Windows are
    (anchor's place, window, cap, least), NEVER for no bound; rows are of the anchor's label if `same`, else of others."""
    out = [np.zeros((0, 5), np.int64)]
    norm = np.sqrt((anchors.codes**2).sum(axis=1))
    for a in range(0, len(anchors.key), STRIP):
        b = min(a + STRIP, len(anchors.key))
        mine = windows[(windows[:, 0] >= a) & (windows[:, 0] < b)]
        if not len(mine):
            continue
        owner = mine[:, 0] - a
        state = Windows(owner, np.where(mine[:, 2] == NEVER, np.iinfo(np.int64).max, mine[:, 2]), mine[:, 3], k)
        for rows in blocks:
            need = state.need()
            top = np.minimum(state.cap.astype(np.float64), norm[a:b][owner] * np.sqrt((rows.codes**2).sum(axis=1).max(initial=0)) + 1)
            index = Index(anchors.codes[a:b], rows.codes, float(need.min()))
            active = np.unique(owner[top >= need])
            for level in LEVELS:
                if not len(active):
                    break
                if level == 1:
                    least = need
                else:
                    floor = np.where(need == NEVER, -top, need.astype(np.float64))
                    least = np.maximum(need, np.floor(np.clip(top - (top - floor) * level, -9.2e18, 9.2e18)).astype(np.int64))
                low = np.full(b - a, np.iinfo(np.int64).max)
                np.minimum.at(low, owner, least)
                i, x, score = index.reaching(active, low)
                ok = ((anchors.labels[a:b][i] == rows.labels[x]) == same) & (anchors.key[a:b][i] != rows.key[x])
                i, x, score = i[ok], x[ok], score[ok]
                # a window with k rows from its threshold on needs none below it
                lacking = np.unique(owner[(state.counts(i, score, least) < k) & (top >= need)]) if level < 1 else np.zeros(0, np.int64)
                done = ~np.isin(i, lacking)
                state.add(i[done], score[done], rows.ids[x[done]], rows.key[x[done]])
                active = active[np.isin(active, lacking)]
        r = state.rows
        out.append(np.stack([anchors.key[a:b][owner[r[:, 0]]], mine[r[:, 0], 1], r[:, 1], r[:, 2], r[:, 3]], axis=1))
    return np.concatenate(out)


FOUND = ["key", "window", "score", "id", "row_key"]


def _join(anchors: DataFrame, blocks: DataFrame, same: bool, k: int, tiles: int) -> DataFrame:
    """Rows that may be among the best k of each window: the best k of each tile. A tile is a block of anchors and the row blocks of
    one of `tiles` hashes; blocks whose labels can't serve its anchors aren't sent to it."""
    serves = (F.col("low") <= F.col("ahigh")) & (F.col("alow") <= F.col("high"))
    if not same:
        serves = ~((F.col("low") == F.col("high")) & (F.col("alow") == F.col("ahigh")) & (F.col("low") == F.col("alow")))
    meta = F.broadcast(anchors.select("ablock", "adim", "alow", "ahigh"))  # 40 bytes for each ANCHORS anchors: 50 MB for 10^12 rows
    sent = blocks.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(tiles))).join(meta, (F.col("dim") == F.col("adim")) & serves)
    to = sent.select("ablock", "part").distinct()
    rows = sent.select("ablock", "part", F.lit(None).cast("binary").alias("windows"), "raw")
    heads = anchors.select("ablock", "windows", F.col("araw").alias("raw")).join(to, "ablock").select("ablock", "part", "windows", "raw")

    def tile(t: pa.Table) -> pa.Table:
        own = t.column("windows").is_valid()
        head = t.filter(own)
        windows = np.frombuffer(head.column("windows")[0].as_py(), np.int64).reshape(-1, 4)
        found = fill(Rows(head.column("raw")[0].as_py()), windows, [Rows(r.as_py()) for r in t.filter(pc.invert(own)).column("raw")], same, k)
        return pa.table([pa.array(np.ascontiguousarray(c)) for c in found.T], FOUND)

    return rows.unionAll(heads).groupBy("ablock", "part").applyInArrow(tile, ", ".join(f"{n} long" for n in FOUND))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("key", "window").orderBy(F.desc("score"), "id", "row_key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _fill_all(anchors: DataFrame, blocks: DataFrame, same: bool, k: int, name: str) -> DataFrame:
    """The best k rows of each window. One block of SEED is joined first; a window that it fills has its last score as threshold in the
    join with all other blocks, so these send little. `anchors` has windows as an array of (window, cap, least)."""
    n, size = blocks.agg(F.count("*"), F.sum("bytes")).first()
    tiles = max(1, min(n, max(-(-(size or 0) // TILE_BYTES), 2 * blocks.sparkSession.sparkContext.defaultParallelism)))
    seed = F.pmod(F.xxhash64("block"), F.lit(SEED)) == 0
    early = written(_best(_join(_anchor_blocks(anchors), blocks.where(seed), same, k, tiles), k), f"{name}-seeds")
    bound = early.where(F.col("rank") == k).groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("known"))
    raised = F.transform("windows", lambda w: w.withField("least", F.greatest(w["least"], F.try_element_at("known", w["window"]))))
    again = anchors.join(bound, "key", "left").withColumn("windows", F.when(F.col("known").isNull(), F.col("windows")).otherwise(raised)).drop("known")
    late = _join(_anchor_blocks(again), blocks.where(~seed), same, k, tiles)
    return written(_best(early.select(*FOUND).unionAll(late), k), name)


# ---------------------------------------------------------------- all


def hard_negatives(vectors: DataFrame, every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE, vec_id: str = "vec_id", label: str | Column = "label", embedding: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor (a row whose id `every` divides) and
    each of its best `positives` rows of the same label, the best `negatives` rows of other labels whose scores are `low` to `high`
    per cent of the positive's.

    A score is the inner product of floor(scale * component) in whole numbers. Higher scores come first, ties by smaller id; an
    anchor or positive without such rows has none. Rows with a null id, label or vector, or with a component that is null or not
    finite (scaled too) take no part; vectors meet those of their own length only; rows that repeat an id are rows of their own, so
    a copy of an anchor can be its positive; scores beyond a long stand at its end; other columns are ignored; an empty table gives
    no rows.

    Anchors meet all rows in blocks: two joins over tiles of bounded bytes, one for positives, one for negatives. A label, however
    common, is cut into many blocks. A tile sends at most k rows of each window.
    """
    x = F.transform(F.col(embedding), lambda v: v.cast("double") * F.lit(float(scale)))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"), x.alias("codes"))
    finite = F.forall("codes", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("codes").isNotNull() & finite)

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("codes")
            whole = pa.ListArray.from_arrays(codes.offsets, pa.array(np.floor(codes.values.to_numpy(zero_copy_only=False)), pa.float64()))
            yield pa.record_batch([batch.column("vec_id"), batch.column("label"), pc.list_value_length(codes).cast(pa.int32()), whole], ["vec_id", "label", "dim", "codes"])

    blocks = _row_blocks(rows.mapInArrow(floors, "vec_id long, label long, dim int, codes array<double>"))
    anchors = _anchor_rows(blocks, every)
    none = F.lit(None).cast("long")
    window = lambda number, cap, least: F.struct(number.cast("long").alias("window"), cap.alias("cap"), least.alias("least"))
    near = _fill_all(anchors.withColumn("windows", F.array(window(F.lit(0), none, none))), blocks, True, positives, "positives")
    scores = near.select("key", F.col("rank").cast("long").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    # cap: the largest n with 100 n <= high p; least: the smallest with low p <= 100 n
    p = F.col("positive_score").cast("decimal(24,0)")
    part = scores.withColumn("cap", F.floor(p * high / 100).cast("long")).withColumn("least", F.ceil(p * low / 100).cast("long"))
    asked = part.where("cap >= least").groupBy("key").agg(F.collect_list(window(F.col("window"), F.col("cap"), F.col("least"))).alias("windows"))
    far = _fill_all(anchors.join(asked, "key"), blocks, False, negatives, "negatives")
    out = far.join(scores, ["key", "window"]).join(anchors.select("key", F.col("vec_id").alias("anchor_id")), "key")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), label=label)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE label <> anchor_label AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3
"""
