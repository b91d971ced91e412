"""Operator 6: SimHash near-duplicates by multi-index hashing over fingerprint segments."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACED, connected_components, forest, mix, slices, table, words, written

SHINGLE, SEED, RADIUS = 4, 42, 4
#: Rows of one bucket that one task compares; a larger bucket is cut into blocks, and tasks take pairs of blocks.
TILE_ROWS = 20_000
#: Rows of a bucket up to which all its pairs are compared at once; larger buckets are searched.
SMALL = 6
#: Heavy buckets up to which their list is broadcast; a longer one is joined by shuffle.
FEW = 50_000


# ---------------------------------------------------------------- 64-bit fingerprints, all links within 4 bits


def _xxh64_fingerprints(texts: pa.Array, shingle: int) -> np.ndarray:
    w = words(texts, SPACED)
    raw = w.data.tobytes().replace(b"\xff", b"\x00")
    out = np.zeros(len(w.per_text), np.uint64)
    for d in np.flatnonzero(w.per_text):
        a, b = int(w.first[d]), int(w.first[d + 1])
        size = min(shingle, b - a)
        joined = b" ".join([raw[i:j] for i, j in zip(w.start[a:b].tolist(), w.end[a:b].tolist(), strict=True)])
        end = np.cumsum(w.end[a:b] - w.start[a:b] + 1) - 1
        begin = np.concatenate([[0], end[:-1] + 1])
        h = np.array([xxhash.xxh64_intdigest(joined[i:j], SEED) for i, j in zip(begin[: len(begin) - size + 1].tolist(), end[size - 1 :].tolist(), strict=True)], np.uint64)
        ones = np.add.reduce(np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), axis=0, dtype=np.int64)
        out[d] = np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0]
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text") -> DataFrame:
    """Add fp, the 64-bit fingerprint as a signed long: bit i is 1 if it is set in over half the XXH64 hashes (seed 42) of the
    shingles, repeats included. Words stand between ASCII white space, A-Z lower-cased; a text of fewer words is one shingle;
    null, empty and blank texts have fingerprint 0. Whole texts count; columns stay, but one called fp is replaced."""
    docs = docs.drop("fp")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            fp = pa.array(_xxh64_fingerprints(batch.column(text), shingle).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, fp], [*batch.schema.names, "fp"])

    return docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField("fp", T.LongType())]))


def _ball(half: Column) -> Column:
    """A 32-bit value and the 32 values one bit away, each with the bit changed (-1: none)."""
    flips = F.sequence(F.lit(-1), F.lit(31))
    return F.transform(flips, lambda b: F.struct(b.cast("byte").alias("flip"), half.bitwiseXOR(F.when(b < 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), b))).alias("key")))


def _probes(nodes: DataFrame) -> DataFrame:
    """Rows (seg, key, flip, fp, node) that share seg and key for any two fingerprints within 4 bits.

    Four bits over two halves: the high halves differ in at most 2 bits, or the low ones in at most 1. High halves both meet at
    every value within one bit of them; low halves enumerate the ball of one bit on either side as well, which the pairs one
    bit apart need from one side only: the side with the smaller value stands in its own bucket alone.
    """
    high = F.expr("fp >> 32").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    return nodes.select("fp", "node", F.explode(_ball(high)).alias("p")).select(F.lit(0).cast("byte").alias("seg"), "p.key", "p.flip", "fp", "node").unionAll(
        nodes.select("fp", "node", F.explode(_ball(low)).alias("p"))
        .where("p.flip < 0 or p.key > (fp & 4294967295)")  # of two that differ in one bit, the smaller goes to the larger's bucket
        .select(F.lit(1).cast("byte").alias("seg"), "p.key", "p.flip", "fp", "node")
    )


def _heavy(nodes: DataFrame, tile: int) -> DataFrame:
    """Buckets that may hold over `tile` rows, with the number of blocks to cut them into."""
    high, low = F.expr("(fp >> 32) & 4294967295"), F.expr("fp & 4294967295")
    parts = []
    for seg, half in ((0, high), (1, low)):
        some = nodes.groupBy(half.alias("half")).count().where(F.col("count") * 34 >= tile)
        parts.append(some.select(F.lit(seg).cast("byte").alias("seg"), "count", F.explode(_ball(F.col("half"))).alias("p")).groupBy("seg", F.col("p.key").alias("key")).agg(F.ceil(F.sum("count") / tile + 1).cast("int").alias("blocks")))
    return parts[0].unionAll(parts[1])


def _walk(fp: np.ndarray, node: np.ndarray, near) -> tuple[list, list]:
    """A spanning forest of the links in one bucket, by breadth-first search over what is not yet reached."""
    a, b = [], []
    rest = np.arange(len(fp))
    while len(rest) > 1:
        stack, rest = [int(rest[0])], rest[1:]
        while stack and len(rest):
            at = stack.pop()
            hit = near(fp[at], fp[rest])
            if hit.any():
                got = rest[hit]
                a += [node[at]] * len(got)
                b += node[got].tolist()
                stack += got.tolist()
                rest = rest[~hit]
    return a, b


def bucket_links(near, fp_of):
    """A mapInArrow function over rows sorted by their bucket columns: the links of each bucket, as many as a forest needs."""

    def fewest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return forest(links(batches))

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            yield from done(held, False)
            held = held.slice(tail(held))
        if held is not None:
            yield from done(held, True)

    def keys(t: pa.Table) -> np.ndarray:
        """True where a bucket begins."""
        new = np.ones(t.num_rows, bool)
        new[1:] = False
        for c in ("seg", "key", "i", "j"):
            x = t.column(c).to_numpy()
            new[1:] |= x[1:] != x[:-1]
        return np.flatnonzero(new)

    def tail(t: pa.Table) -> int:
        return int(keys(t)[-1])

    def done(t: pa.Table, all_of_it: bool) -> Iterator[pa.RecordBatch]:
        begin = keys(t)
        end = np.append(begin[1:], t.num_rows)
        if not all_of_it:
            begin, end = begin[:-1], end[:-1]
        size = end - begin
        if not len(size) or size.max() < 2:
            return
        fp, node, a, b = fp_of(t), t.column("node").to_numpy(), [], []
        for step in range(1, SMALL):
            wide = (size > step) & (size <= SMALL)
            x = np.repeat(begin[wide], size[wide] - step)
            x = x + np.arange(len(x)) - np.repeat(np.cumsum(size[wide] - step) - size[wide] + step, size[wide] - step)
            hit = near(fp[x], fp[x + step]) if len(x) else np.zeros(0, bool)
            a += node[x[hit]].tolist()
            b += node[x[hit] + step].tolist()
        for k in np.flatnonzero(size > SMALL):
            x, y = _walk(fp[begin[k] : end[k]], node[begin[k] : end[k]], near)
            a += x
            b += y
        if a:
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return fewest


def in_tiles(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    """Give each row its tiles (i, j) of its bucket: (0, 0) alone unless the bucket is heavy, else every pair with its own block."""
    plain = [c for c in rows.columns if c not in ("seg", "key")]
    heavy = written(heavy, "heavy")
    n = heavy.count()
    if not n:
        return rows.select("seg", "key", F.lit(0).alias("i"), F.lit(0).alias("j"), *plain)
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = rows.join(F.broadcast(heavy) if n <= FEW else heavy, ["seg", "key"], "left").withColumn("own", own)
    return dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "seg", "key", F.least("own", "other").cast("int").alias("i"), F.greatest("own", "other").cast("int").alias("j"), *plain
    )


def _near64(x: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.bitwise_count(others ^ x) <= RADIUS


def near_links(nodes: DataFrame, tile: int = TILE_ROWS) -> DataFrame:
    """Links (a, b) between rows (fp, node) with different fingerprints within 4 bits: a forest for each bucket that they share,
    so that components are exact and the number of links stays in proportion to the rows."""
    rows = in_tiles(_probes(nodes), _heavy(nodes, tile))
    dealt = rows.repartition("seg", "key", "i", "j").sortWithinPartitions("seg", "key", "i", "j")
    return dealt.mapInArrow(bucket_links(_near64, lambda t: t.column("fp").to_numpy().view(np.uint64)), "a long, b long")


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Per row: the id, fp, and component_id, the least id reachable by links of at most 4 differing bits.

    Rows with one fingerprint are one class, which stands for all of them: only class representatives are compared. Rows with a
    null id link with nothing and get a null component; rows that share an id are one document. Empty texts share fingerprint 0
    and are linked like any other. An empty table gives an empty result. Other columns are ignored.
    """
    prints = written(fingerprints(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), shingle).select("doc_id", "fp"), "fingerprints")
    there = prints.where("doc_id is not null")
    classes = written(there.groupBy("fp").agg(F.min("doc_id").alias("node")), "classes")
    # rows of one id in several classes make these one document
    shared = there.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    same = there.join(shared, "doc_id").join(classes, "fp").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    groups = connected_components(near_links(classes).unionAll(same))
    known = classes.join(groups, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    found = there.join(known, "fp").select("doc_id", "fp", "component_id")
    return found.unionAll(prints.where("doc_id is null").select("doc_id", "fp", F.lit(None).cast("long").alias("component_id")))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its fingerprint and component."""
    found = near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# ---------------------------------------------------------------- wide fingerprints for a similarity of shingle sets

#: Bits of a wide fingerprint, and the two bytes of each of its 48 segments: neighbours, and bytes half a fingerprint apart.
BITS = 512
SEGMENTS = [(k, k + 1) for k in range(0, BITS // 8, 2)] + [(k, k + BITS // 16) for k in range(16)]
#: Counters of the signed count sketch between shingles and bits, and counters that a shingle adds to.
COUNTERS, ADDS = 4096, 4
#: Texts of a group of candidates that one task compares by their shingles; larger groups are cut into pairs of blocks.
EXACT_ROWS = 5_000


def wide_radius(similarity: float, bits: int = BITS) -> int:
    """Differing bits that two sets of one size with this Jaccard similarity have on average, and 3 standard deviations more:
    99.9 % of such pairs pass. Sets of two sizes differ in fewer bits. Pairs within it are candidates, no more."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return round(bits * p + 3 * math.sqrt(bits * p * (1 - p)))


def _planes() -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((COUNTERS, BITS), np.float32)


def _shingles(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number, ascending, and 64-bit hash of each different shingle of each text; fewer words are one shingle."""
    w = words(texts, SPACED)
    h, n = w.hashes(), len(w.per_text)
    size = np.minimum(shingle, w.per_text)
    doc = np.repeat(np.arange(n), np.maximum(w.per_text - size + 1, 0) * (w.per_text > 0))
    last = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))])
    at = w.first[doc] + np.arange(len(doc)) - last[doc]
    key = np.zeros(len(doc), np.uint64)
    for k in range(shingle):
        part = k < size[doc]
        key[part] = mix(key[part] * np.uint64(5) + h[at[part] + k])
    _, keep = np.unique(mix(key ^ (doc.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    keep.sort()
    return doc[keep], key[keep]


def _wide(texts: pa.Array, shingle: int, planes: np.ndarray) -> np.ndarray:
    """(texts, BITS / 64) unsigned words: signs of random planes over the set of shingles of each text."""
    n = len(texts)
    doc, key = _shingles(texts, shingle)
    out = np.zeros((n, BITS // 64), np.uint64)
    for a in range(0, n, 512):
        mine, rows = slice(*np.searchsorted(doc, [a, a + 512])), min(512, n - a)
        counts = np.zeros(rows * COUNTERS)
        for k in range(ADDS):
            bits = mix(key[mine] + np.uint64(k))
            cell = (doc[mine] - a) * COUNTERS + (bits & np.uint64(COUNTERS - 1)).astype(np.int64)
            counts += np.bincount(cell, 1.0 - 2.0 * ((bits >> np.uint64(40)) & np.uint64(1)).astype(np.float64), rows * COUNTERS)
        out[a : a + rows] = np.packbits(counts.reshape(rows, COUNTERS).astype(np.float32) @ planes > 0, axis=1, bitorder="little").view("<u8")
    return out


def _bytes_as_words(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t.column("fp").to_pylist()), "<u8").reshape(-1, BITS // 64)


class Sets:
    """The shingle sets of one table of texts, and which of its rows are as similar as asked; rows stand as their numbers."""

    def __init__(self, shingle: int, similarity: float, radius: int):
        self.shingle, self.similarity, self.radius = shingle, similarity, radius

    def rows(self, t: pa.Table) -> np.ndarray:
        self.fp, self.sets = _bytes_as_words(t), []
        for batch in slices(t.select(["text"]).to_batches(), "text"):
            doc, key = _shingles(batch.column(0), self.shingle)
            key = key[np.lexsort((key, doc))]
            cut = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            self.sets += [key[a:b] for a, b in zip(cut, cut[1:], strict=False)]
        self.size = np.array([len(x) for x in self.sets])
        return np.arange(t.num_rows)

    def near(self, x: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Whether each pair's exact Jaccard similarity is reached; sets are compared only if bits and sizes allow it."""
        x = np.broadcast_to(x, others.shape)
        p, q = self.size[x], self.size[others]
        hit = np.minimum(p, q) >= self.similarity * np.maximum(p, q) - 1e-9
        some = np.flatnonzero(hit)
        hit[some] = np.bitwise_count(self.fp[others[some]] ^ self.fp[x[some]]).sum(axis=-1, dtype=np.int64) <= self.radius
        for k in np.flatnonzero(hit):
            a, b = self.sets[x[k]], self.sets[others[k]]
            both = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum()) if len(a) else 0
            hit[k] = both >= self.similarity * (len(a) + len(b) - both) - 1e-9
        return hit


def similar_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """Per id its component_id, the least id reachable by links of texts whose sets of word shingles have this Jaccard similarity.

    Candidates first: fingerprints of 512 bits within `wide_radius(similarity)` differing bits that share a value of one of 48
    segments of 16 bits (balls of radius 0, for so many short segments outdo balls in fewer: at similarity 0.8, one in 14 segments
    of a pair agrees, so 97 % of pairs meet directly, at 0.85 99 % and at 0.9 nearly all). Each bucket gives a forest of them by a
    search over what is not yet reached, never all pairs. The groups that candidates form hold every link to be found, so the
    texts of each group are dealt once to a task (of a group over EXACT_ROWS, to pairs of blocks), which searches it again, by the
    exact similarity of shingle sets; there, pairs that share no segment are compared too. Of texts with one fingerprint, one
    stands for all. Null ids are left out; empty texts are one class; equal texts always link.
    """
    held = docs.sparkSession.sparkContext.broadcast(_planes())
    radius = wide_radius(similarity)

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            fp = _wide(batch.column("text"), shingle, held.value)
            yield pa.record_batch([batch.column("doc_id"), batch.column("h"), pa.array([r.tobytes() for r in fp], pa.binary())], ["doc_id", "h", "fp"])

    some = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null").withColumn("h", F.xxhash64("text"))
    rows = written(some.mapInArrow(prints, "doc_id long, h long, fp binary"), "prints")
    classes = written(rows.groupBy("fp").agg(F.min(F.struct("doc_id", "h")).alias("m")).select("fp", F.col("m.doc_id").alias("node"), "m.h"), "classes")
    byte = lambda k: F.substring("fp", k + 1, 1)
    cut = F.array(*[F.struct(F.lit(n).cast("byte").alias("seg"), F.conv(F.hex(F.concat(byte(x), byte(y))), 16, 10).cast("int").alias("key")) for n, (x, y) in enumerate(SEGMENTS)])
    segments = classes.select("fp", "node", F.explode(cut).alias("p")).select("p.seg", "p.key", "fp", "node")

    def heavy(buckets: DataFrame, tile: int) -> DataFrame:
        return buckets.groupBy("seg", "key").count().where(F.col("count") > tile).select("seg", "key", F.ceil(F.col("count") / tile).cast("int").alias("blocks"))

    def near(x: np.ndarray, others: np.ndarray) -> np.ndarray:
        return np.bitwise_count(others ^ x).sum(axis=-1, dtype=np.int64) <= radius

    dealt = in_tiles(segments, heavy(segments, TILE_ROWS)).repartition("seg", "key", "i", "j").sortWithinPartitions("seg", "key", "i", "j")
    maybe = connected_components(dealt.mapInArrow(bucket_links(near, _bytes_as_words), "a long, b long"))
    members = written(classes.join(maybe, "node").select(F.lit(0).cast("byte").alias("seg"), F.col("component").alias("key"), "fp", "node", "h"), "candidates")
    texts = some.withColumnRenamed("doc_id", "node").join(members, ["node", "h"]).select("seg", "key", "fp", "node", "text")
    sets = Sets(shingle, similarity, radius)
    dealt = in_tiles(texts, heavy(members, EXACT_ROWS)).repartition("seg", "key", "i", "j").sortWithinPartitions("seg", "key", "i", "j")
    same = rows.join(classes.select("fp", "node"), "fp").where("doc_id <> node").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    groups = connected_components(dealt.mapInArrow(bucket_links(sets.near, sets.rows), "a long, b long").unionAll(same))
    return rows.select("doc_id").distinct().join(groups, F.col("doc_id") == F.col("node"), "left").select("doc_id", F.coalesce("component", "doc_id").alias("component_id"))
