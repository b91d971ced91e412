"""What several training-data operators share: written steps, folds, word arrays and components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellurion.functions.shared import shared_dir

#: Rows of one Arrow batch: with long texts, the default of 10,000 rows can take hundreds of MB in each worker.
BATCH_ROWS = 2000
#: Bytes of text that array code works on at once; the arrays of a slice take some twenty times that.
SLICE_BYTES = 1 << 20


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches of this session have at most BATCH_ROWS rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a step to the shared folder and read it again: its lineage ends there, and a lost executor costs no earlier step."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    small_batches(spark)
    w = df.write.option("compression", "zstd")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Ask the driver to collect garbage, so that Spark drops shuffle files of steps already written."""
    spark.sparkContext._jvm.System.gc()


def fold(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null ids count as fold -1, which belongs to no training or held-out fold."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % modulus, F.lit(-1)).cast("int")


# ---------------------------------------------------------------- words as arrays


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64, on a whole array."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """Words of a slice of texts: lower-cased bytes, start and end of each word, and words per text."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, per_text: np.ndarray):
        self.data, self.start, self.end, self.per_text = data, start, end, per_text
        self.first = np.concatenate([[0], np.cumsum(per_text)])

    def hashes(self, limit: int | None = None) -> np.ndarray:
        """64-bit hash of each word, or of its first `limit` bytes."""
        n = self.end - self.start
        if limit is not None:
            n = np.minimum(n, limit)
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(self.data) + 1,), "<u8", padded, strides=(1,))
        h = mix(n.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        at, left, rows = self.start, n, None
        while len(left):
            keep = np.minimum(left, 8).astype(np.uint64)
            word = eight[at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - keep * np.uint64(8)))
            if rows is None:
                h = mix(h ^ word)
            else:
                h[rows] = mix(h[rows] * np.uint64(3) ^ word)
            more = np.flatnonzero(left > 8)
            rows = more if rows is None else rows[more]
            at, left = at[more] + 8, left[more] - 8
        return h

    def equal(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether words i[k] and j[k] have the same bytes."""
        n = self.end[i] - self.start[i]
        same = n == self.end[j] - self.start[j]
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(self.data) + 1,), "<u8", padded, strides=(1,))
        left = np.flatnonzero(same & (i != j))
        a, b, n = self.start[i[left]], self.start[j[left]], n[left]
        while len(left):
            spare = np.uint64(64) - np.minimum(n, 8).astype(np.uint64) * np.uint64(8)
            apart = ((eight[a] ^ eight[b]) << spare != 0) & (n > 0)
            same[left[apart]] = False
            more = ~apart & (n > 8)
            left, a, b, n = left[more], a[more] + 8, b[more] + 8, n[more] - 8
        return same

    def text(self, i: int, j: int) -> bytes:
        """Words i to j - 1, joined by spaces."""
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(self.start[i:j], self.end[i:j], strict=True))


#: For each byte its lower-case form if words hold it, else 0. ASCII: words of digits and letters; the rest is part of words.
ALNUM = np.array([b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8)
#: The same for words between white space (space and 0x09 to 0x0D). Byte 0 is part of words and stands as 255, which no UTF-8 text holds.
SPACED = np.array([0 if b in (9, 10, 11, 12, 13, 32) else 255 if b == 0 else b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def flat(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(texts: pa.Array, kind: np.ndarray) -> Words:
    return split(*flat(texts), kind)


def split(raw: np.ndarray, offsets: np.ndarray, kind: np.ndarray, before: np.ndarray | None = None) -> Words:
    """Words of texts that lie one after another in `raw`; words are also cut before the bytes marked in `before`."""
    data = kind[raw]
    inside = data != 0
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(offsets) - 1, np.int64))
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    opens[cut] = inside[cut]  # a text's first byte begins a word, its last one ends it
    closes[cut - 1] = inside[cut - 1]
    if before is not None:
        within = np.flatnonzero(before[1:] & inside[1:] & inside[:-1])
        opens[within + 1] = closes[within] = True
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(data, start, end, np.diff(np.searchsorted(start, offsets)))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about `limit` bytes of text, so that arrays stay small."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(size) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(int(a), int(b - a))


# ---------------------------------------------------------------- components


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the links (a, b) of each batch by as many as a forest needs: each node to the least node reachable here."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (batch.column(i).to_numpy() for i in (0, 1))
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        x, y, root = at[: len(a)], at[len(a) :], np.arange(len(nodes))
        while True:
            low = np.minimum(root[x], root[y])
            new = root.copy()
            np.minimum.at(new, root[x], low)
            np.minimum.at(new, root[y], low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        rest = np.flatnonzero(root != np.arange(len(nodes)))
        yield pa.record_batch([pa.array(nodes[root[rest]]), pa.array(nodes[rest])], ["a", "b"])


def connected_components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """Columns node and component (the least node reachable) for every node of the links (a, b), both long.

    Each round turns links into stars about the least neighbour, first upward, then downward, and writes the result. Ends when a
    round changes nothing. Links with null ends are ignored. `forest` lets tasks that make links leave fewer of them.
    """
    a, b = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    e = written(edges.where("a is not null and b is not null and a <> b").select(a, b).distinct(), "links")
    seen = None
    for _ in range(rounds):
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now[0] == 0 or now == seen:
            break
        seen = now
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min(F.least("a", "b")).alias("m"))
        up = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        floor = up.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m"))
        down = up.join(floor, F.col("b") == F.col("u")).select("m", F.explode(F.array("a", "b")).alias("v"))
        e = written(down.where("m <> v").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct(), "links")
    else:
        raise RuntimeError("components did not settle")
    found = e.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
    return found.union(e.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
