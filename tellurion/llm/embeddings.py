"""Operator 4: near-duplicate vectors by int8 tile products with error bounds, candidates verified in double precision."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import connected_components, table, written

THRESHOLD = 0.95
#: Rows of a block, rows compared at once within a tile, pivots that order the rows and rows that the pivots are drawn from.
BLOCK, STRIP, PIVOTS, PIVOT_SAMPLE = 4096, 512, 48, 4096
#: Bytes of block centres that one broadcast holds; with more of them blocks are paired in several rounds.
CENTRE_BYTES = 32 << 20


def unit(v: np.ndarray) -> np.ndarray:
    """Vectors of length 1 in double precision. The largest component is taken out first, so that no square overflows."""
    v = v.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True, initial=0.0)
    return v / np.sqrt((v**2).sum(axis=1, keepdims=True))


def quantised(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of unit vectors, the scale of each, and the exact length of what the codes leave out."""
    scale = np.abs(v).max(axis=1) / 127
    codes = np.rint(v / scale[:, None]).astype(np.int8)
    return codes, scale, np.linalg.norm(v - codes * scale[:, None], axis=1) + 1e-15


def components(vectors: pa.Array) -> np.ndarray:
    """All components of a column of vectors, none of them null, as single precision if the column is, else as double."""
    flat = vectors.flatten()
    return flat.to_numpy() if pa.types.is_float32(flat.type) else flat.cast(pa.float64()).to_numpy()


def _union(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Join the classes of x[i] and y[i]; each class stays under its least member."""
    while len(x):
        a, b = root[x], root[y]
        apart = a != b
        if not apart.any():
            break
        np.minimum.at(root, np.maximum(a[apart], b[apart]), np.minimum(a[apart], b[apart]))
        while not (root[root] == root).all():
            root = root[root]
        x, y = x[apart], y[apart]
    return root


class Block:
    """Some vectors as one binary: row count, dimension, bytes of a component, ids, numbers of copies, components. Components are as wide
    as in the table (single precision travels as such); codes, products and sums are made from their double values."""

    def __init__(self, raw: bytes):
        n, d, width = np.frombuffer(raw, np.int64, 3)
        self.node, self.copies = np.frombuffer(raw, np.int64, n, 24), np.frombuffer(raw, np.int64, n, 24 + 8 * n)
        self.vectors = unit(np.frombuffer(raw, f"<f{width}", n * d, 24 + 16 * n).reshape(n, d))
        codes, self.scale, self.error = quantised(self.vectors)
        self.codes = codes.astype(np.float32 if d <= 1000 else np.float64)  # products of so many codes stay exact

    @staticmethod
    def pack(node: np.ndarray, copies: np.ndarray, vectors: np.ndarray) -> bytes:
        return np.array([*vectors.shape, vectors.itemsize], np.int64).tobytes() + node.tobytes() + copies.tobytes() + np.ascontiguousarray(vectors).tobytes()


def tile_links(a: Block, b: Block, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, linked copies and least linked id (within the tile) of the vectors that have a link in this tile.

    For unit vectors u, v with codes p, q, scales s, t and remainders e, f: |u.v - s t p.q| <= |e| + (1 + |e|) |f|. Only pairs
    whose product can reach the threshold under that bound are multiplied in double precision.
    """
    na, nb = len(a.node), len(b.node)
    counts, root = np.zeros(na + nb, np.int64), np.arange(na + nb)
    if same:
        root[na:] = np.arange(na)
    slack = 1e-6
    for i in range(0, na, STRIP):
        rows = slice(i, min(i + STRIP, na))
        for j in range((i if same else 0), nb, 4 * STRIP):
            cols = slice(j, min(j + 4 * STRIP, nb))
            p = a.codes[rows] @ b.codes[cols].T
            most = threshold - slack - a.error[rows] - (1 + a.error[rows]) * b.error[cols].max()
            least = most / (a.scale[rows] * np.where(most > 0, b.scale[cols].max(), b.scale[cols].min()))
            x, y = np.nonzero(p >= (least * (1 - 1e-6)).astype(p.dtype)[:, None])
            s, t = x + i, y + j
            possible = a.scale[s] * b.scale[t] * p[x, y].astype(np.float64) + a.error[s] + (1 + a.error[s]) * b.error[t] >= threshold - slack
            if same:
                possible &= t > s
            s, t = s[possible], t[possible]
            for k in range(0, len(s), 1 << 16):
                u, v = s[k : k + (1 << 16)], t[k : k + (1 << 16)]
                linked = np.einsum("ij,ij->i", a.vectors[u], b.vectors[v]) >= threshold
                u, v = u[linked], v[linked]
                counts += np.bincount(u, b.copies[v], na + nb).astype(np.int64)
                counts += np.bincount(v if same else v + na, a.copies[u], na + nb).astype(np.int64)
                root = _union(root, u, v if same else v + na)
    node = np.concatenate([a.node, b.node])
    some = np.flatnonzero(counts)
    low = np.full(na + nb, np.iinfo(np.int64).max)
    np.minimum.at(low, root[some], node[some])
    return node[some], counts[some], low[root[some]]


def _pivots(classes: DataFrame, dim: int) -> np.ndarray:
    """Unit vectors far from each other, from a bounded sample; they only order rows, so that blocks hold neighbours."""
    rows = classes.where(F.col("dim") == dim).orderBy(F.xxhash64("node")).limit(PIVOT_SAMPLE).select("embedding").collect()
    v = unit(np.array([r[0] for r in rows], np.float64))
    picked, near = [0], v @ v[0]
    while len(picked) < min(PIVOTS, len(v)):
        picked.append(int(near.argmin()))
        near = np.maximum(near, v @ v[picked[-1]])
    return v[picked]


def _blocks(classes: DataFrame, dim: int) -> DataFrame:
    """Rows (block, centre, reach, raw): neighbours together, each with its mean direction and the largest angle to it."""
    pivots = classes.sparkSession.sparkContext.broadcast(_pivots(classes, dim))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = unit(components(batch.column("embedding")).reshape(batch.num_rows, dim)) @ pivots.value.T
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.argmax(axis=1).astype(np.int32)), pa.array(near.max(axis=1))], [*batch.schema.names, "pivot", "near"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, at = [], 0, TaskContext.get().partitionId() << 32
        for batch in [*batches, None]:
            if batch is not None and batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            while rows >= BLOCK or (batch is None and rows):
                t = pa.Table.from_batches(held)
                mine, rest = t.slice(0, BLOCK), t.slice(BLOCK)
                held, rows = rest.to_batches(), rest.num_rows
                v = components(mine.column("embedding").combine_chunks()).reshape(mine.num_rows, dim)
                u = unit(v)
                centre = u.sum(axis=0)
                centre = centre / np.linalg.norm(centre) if np.linalg.norm(centre) > 1e-9 else u[0]
                reach = float(np.arccos(np.clip(u @ centre, -1, 1)).max())
                raw = Block.pack(mine.column("node").to_numpy(), mine.column("copies").to_numpy(), v)
                yield pa.record_batch([pa.array([at]), pa.array([centre.tolist()]), pa.array([reach]), pa.array([raw], pa.binary())], ["block", "centre", "reach", "raw"])
                at += 1

    rows = classes.where(F.col("dim") == dim).select("node", "copies", "embedding").mapInArrow(place, f"node long, copies long, embedding {classes.schema['embedding'].dataType.simpleString()}, pivot int, near double")
    # few large ranges: a block is full before the next begins, so their number follows the rows, not the partitions
    n = max(1, -(-classes.where(F.col("dim") == dim).count() // (2 * BLOCK)))
    dealt = rows.repartitionByRange(n, "pivot", "near", "node").sortWithinPartitions("pivot", "near", "node")
    return written(dealt.mapInArrow(pack, "block long, centre array<double>, reach double, raw binary"), "blocks")


def links(classes: DataFrame, dim: int, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (a, b, n) for each tile: b has links to n copies in it, and the least of b's class in it is a."""
    blocks = _blocks(classes, dim)
    angle, n = float(np.arccos(threshold)), blocks.count()
    size = max(1, CENTRE_BYTES // (8 * dim))
    parts = []
    for k in range(-(-n // size)):
        some = blocks if n <= size else blocks.where(F.pmod(F.xxhash64("block"), F.lit(-(-n // size))) == k)
        held = blocks.sparkSession.sparkContext.broadcast([(r.block, np.array(r.centre), r.reach) for r in some.select("block", "centre", "reach").collect()])

        def deal(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            """Each block to every tile with a block that its vectors can reach."""
            names = np.array([b for b, _, _ in held.value])
            centres, reach = np.array([c for _, c, _ in held.value]), np.array([r for _, _, r in held.value])
            for batch in batches:
                for block, centre, own, raw in zip(*(batch.column(c).to_pylist() for c in ("block", "centre", "reach", "raw")), strict=True):
                    near = np.arccos(np.clip(centres @ np.array(centre), -1, 1)) <= own + reach + angle + 1e-6
                    for other in names[near].tolist():
                        yield pa.record_batch([pa.array([min(block, other)]), pa.array([max(block, other)]), pa.array([block]), pa.array([raw], pa.binary())], ["i", "j", "block", "raw"])

        tiles = blocks.mapInArrow(deal, "i long, j long, block long, raw binary")
        if n > size:  # a pair across two rounds lacks its other side
            other = F.when(F.col("i") == F.col("block"), F.col("j")).otherwise(F.col("i"))
            tiles = tiles.unionAll(tiles.where("i <> j").withColumn("other", other).drop("raw", "block").join(blocks.select(F.col("block").alias("other"), "raw"), "other").select("i", "j", F.col("other").alias("block"), "raw")).dropDuplicates(["i", "j", "block"])
        parts.append(tiles)
    if not parts:
        return blocks.select(F.col("block").alias("a"), F.col("block").alias("b"), F.col("block").alias("n"))
    tiles = parts[0]
    for p in parts[1:]:
        tiles = tiles.unionAll(p)
    if len(parts) > 1:
        tiles = tiles.dropDuplicates(["i", "j", "block"])

    def tile(t: pa.Table) -> pa.Table:
        by = {b: Block(raw.as_py()) for b, raw in zip(t.column("block").to_pylist(), t.column("raw"), strict=True)}
        x, y = min(by), max(by)
        node, n, low = tile_links(by[x], by[y], x == y, threshold)
        return pa.table([pa.array(low), pa.array(node), pa.array(n)], ["a", "b", "n"])

    return tiles.groupBy("i", "j").applyInArrow(tile, "a long, b long, n long")


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: vec_id, n_links (other vectors with cosine of `threshold` or more), component_id (least id reachable), kept.

    Equal vectors are one class, compared once and counted by their copies. Classes are ordered by pivots and cut into blocks; two
    blocks meet in a tile unless the angle between their centres shows that no pair can reach the threshold. A tile gives a row for
    each linked vector, never its pairs. The work grows with the square of the rows among vectors close enough for tiles to be
    needed. Vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of different
    lengths don't link; rows with a null id link with nothing and have no component; rows that repeat an id are vectors
    of their own. Other columns are ignored; an empty table gives none.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    good = F.coalesce(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite, F.lit(False))
    there = rows.where(good)
    classes = there.groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    classes = written(classes.withColumns({"dim": F.size("embedding"), "node": F.xxhash64("embedding")}), "classes")
    dims = [r.dim for r in classes.groupBy("dim").count().orderBy("dim").collect()]
    found = None
    for d in dims:
        one = links(classes, d, threshold)
        found = one if found is None else found.unionAll(one)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = written(found, "tiles")
    degree = found.groupBy(F.col("b").alias("node")).agg(F.sum("n").alias("n"))
    groups = connected_components(found.select("a", "b"))
    placed = classes.join(degree, "node", "left").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    known = placed.join(least, "component").select("embedding", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = there.join(known, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector its number of links and component at cosine 0.95."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP4_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS node, vec_id AS c FROM v UNION SELECT links.b, reach.c FROM reach JOIN links ON reach.node = links.a),
least_of AS (SELECT node, min(c) AS component_id FROM reach GROUP BY node),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN least_of ON node = vec_id LEFT JOIN degree ON a = vec_id
"""
