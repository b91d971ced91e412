"""Operator 2: token ids in binary shards, with Elias-Fano coded document boundaries and ids."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import Encoder
from .common import BATCH_ROWS, new_path, slices, table

END_ID = 2
#: Ids after which a shard is closed; a shard always holds whole documents.
SHARD_IDS = 2 << 20
#: Bytes of shards that a writing task gathers before it puts them to disk.
ROW_GROUP = 16 << 20
#: A select sample for so many ones.
STEP = 256

_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)
#: Ones of each byte, and the place of each of them.
_COUNT = np.bitwise_count(np.arange(256, dtype=np.uint8)).astype(np.int64)
_PLACE = np.array([([k for k in range(8) if b >> k & 1] + [0] * 8)[:8] for b in range(256)], np.int64)


class EliasFano:
    """A non-decreasing sequence of n integers from 0 to `top`: low bits packed, high bits in unary, every 256th one sampled.

    It takes about n * (2 + log2(top / n)) bits and 32 bits for each sample, where a table of offsets takes 64 * n.
    """

    def __init__(self, n: int, top: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.top, self.low, self.high, self.samples = n, top, low, high, samples
        self.l = self.low_bits(n, top)

    @staticmethod
    def low_bits(n: int, top: int) -> int:
        return max(0, (top // n).bit_length() - 1) if n else 0

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n, top = len(v), int(v[-1]) if len(v) else 0
        l = cls.low_bits(n, top)  # noqa: E741
        bits = np.unpackbits(v.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")[:, :l]
        ones = (v >> np.uint64(l)).astype(np.int64) + np.arange(n)
        high = np.zeros(n + (top >> l) + 1, np.uint8)
        high[ones] = 1
        return cls(n, top, np.packbits(bits.ravel(), bitorder="little"), np.packbits(high, bitorder="little"), ones[::STEP].astype(np.uint32))

    def __getitem__(self, i: int) -> int:
        """select(i) on the high bits, from the sample before it, joined to the low bits."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // STEP]), i % STEP
        byte = at // 8
        here = int(self.high[byte]) >> (at % 8) << (at % 8)
        while (k := int(_ONES[here])) <= left:
            left, byte = left - k, byte + 1
            here = int(self.high[byte])
        for _ in range(left):
            here &= here - 1
        one = byte * 8 + (here & -here).bit_length() - 1
        a, b = i * self.l, (i + 1) * self.l
        low = int.from_bytes(self.low[a // 8 : (b + 7) // 8].tobytes(), "little") >> (a % 8) & ((1 << self.l) - 1)
        return (one - i) << self.l | low

    def select(self, i: np.ndarray) -> np.ndarray:
        """The values at these places: for all at once what one place takes, from the sample before each on, byte by byte."""
        at, left = self.samples[i // STEP].astype(np.int64), i % STEP
        byte = at >> 3
        here = self.high[byte] >> (at & 7) << (at & 7)
        here = here.astype(np.uint8)
        far = np.arange(len(i))
        while len(far := far[_COUNT[here[far]] <= left[far]]):
            left[far] -= _COUNT[here[far]]
            byte[far] += 1
            here[far] = self.high[byte[far]]
        value = byte * 8 + _PLACE[here, left] - i << self.l
        for k in range(self.l):
            bit = i * self.l + k
            value |= (self.low[bit >> 3] >> (bit & 7) & 1).astype(np.int64) << k
        return value

    def all(self) -> np.ndarray:
        if not self.n:
            return np.zeros(0, np.int64)
        high = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n] - np.arange(self.n)
        bits = np.zeros((self.n, 64), np.uint8)
        bits[:, : self.l] = np.unpackbits(self.low, bitorder="little")[: self.n * self.l].reshape(self.n, self.l)
        low = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0].astype(np.int64)
        return (high << self.l) | low

    def pack(self) -> bytes:
        return struct.pack("<QQIII", self.n, self.top, len(self.low), len(self.high), len(self.samples)) + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u4").tobytes()

    @classmethod
    def unpack(cls, raw: bytes, at: int) -> tuple[EliasFano, int]:
        n, top, a, b, c = struct.unpack_from("<QQIII", raw, at)
        at += struct.calcsize("<QQIII")
        take = lambda k, kind: np.frombuffer(raw, kind, k, at)
        low = take(a, np.uint8)
        at += a
        high = take(b, np.uint8)
        at += b
        return cls(n, top, low, high, take(c, "<u4")), at + 4 * c


class Shard:
    """One shard: `TIDS`, width of an id in bytes, null ids, first id, document ids, boundaries (each Elias-Fano), then the ids."""

    HEAD = "<4sBQq"

    def __init__(self, raw: bytes):
        magic, width, self.nulls, self.base = struct.unpack_from(self.HEAD, raw, 0)
        if magic != b"TIDS":
            raise ValueError("not a token shard")
        self.docs, at = EliasFano.unpack(raw, struct.calcsize(self.HEAD))
        self.bounds, at = EliasFano.unpack(raw, at)
        self.ids = np.frombuffer(raw, f"<u{width}", self.bounds.top, at)

    def __len__(self) -> int:
        return self.bounds.n - 1

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.base + self.docs[i - self.nulls]

    def __getitem__(self, i: int) -> np.ndarray:
        return self.ids[self.bounds[i] : self.bounds[i + 1]]

    @classmethod
    def pack(cls, docs: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
        """docs ascending, nulls first."""
        there = np.array([d for d in docs if d is not None], np.int64)
        base = int(there[0]) if len(there) else 0
        width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
        head = struct.pack(cls.HEAD, b"TIDS", width, len(docs) - len(there), base)
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        return head + EliasFano.encode(there - base).pack() + EliasFano.encode(bounds).pack() + ids.astype(f"<u{width}").tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


SHARDS = "part int, before long, n_docs long, n_ids long, shard binary"


def write_token_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text", shard_ids: int = SHARD_IDS) -> None:
    """Write all texts as token ids, each followed by `end_id`, in ascending order of their ids, into a folder of shards.

    Texts are dealt out by ranges of their id and sorted within them, so that file order is id order; every range is cut into
    shards of about `shard_ids` ids. A row of the Parquet files holds one shard in the layout of `Shard`, with its range's
    number (part) and the ids of that range before it, so any file system of Spark's will do and a lost task is done anew.

    A null text counts as empty (its end id alone); null ids come first; rows with one id stand side by side, ordered by text;
    an empty table gives no shards; other columns are ignored. Ids must be integers.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        before = size = 0

        def close() -> pa.RecordBatch:
            nonlocal before, size, held
            names, lengths, ids = [d for h in held for d in h[0]], np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            row = [[part], [before], [len(names)], [len(ids)], [Shard.pack(names, lengths, ids)]]
            before, size, held = before + len(ids), 0, []
            return pa.record_batch([pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["part", "before", "n_docs", "n_ids", "shard"])

        for batch in slices(batches, text):
            ids, n = enc.encode(batch.column(text))
            with_end = np.insert(ids, np.cumsum(n), end_id)
            held.append((batch.column(doc_id).to_pylist(), n + 1, with_end))
            size += len(with_end)
            if size >= shard_ids:
                yield close()
        if held:
            yield close()

    rows = docs.select(F.col(doc_id).cast("long").alias(doc_id), text).repartitionByRange(doc_id).sortWithinPartitions(doc_id, text)
    rows.mapInArrow(shards, SHARDS).write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP).parquet(path)


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids, from the shards, whose boundaries give each document's place."""
    return _read(spark, path, "ids array<int>", lambda ids, a, b: ids[a:b].astype(np.int32).tolist(), pa.list_(pa.int32()))


def read_token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32, the crc32 of a document's ids as little-endian unsigned 32-bit integers."""
    return _read(spark, path, "ids_crc32 long", lambda ids, a, b: zlib.crc32(ids[a:b].astype("<u4").tobytes()), pa.int64())


def _documents(s: Shard) -> Iterator[tuple[list[int | None], np.ndarray]]:
    """Document ids, and the boundaries before, between and after them, of runs of at most BATCH_ROWS documents, by select."""
    for a in range(0, len(s), BATCH_ROWS):
        b = min(len(s), a + BATCH_ROWS)
        nulls = max(0, min(b, s.nulls) - a)
        yield [None] * nulls + (s.base + s.docs.select(np.arange(a + nulls, b) - s.nulls)).tolist(), s.bounds.select(np.arange(a, b + 1))


def _read(spark: SparkSession, path: str, column: str, of, kind: pa.DataType) -> DataFrame:
    shards = spark.read.schema(SHARDS).parquet(path)
    sizes = sorted(tuple(r) for r in shards.groupBy("part").agg(F.sum("n_ids")).collect())  # a row for each partition written
    totals = np.cumsum([0, *(n for _, n in sizes)])
    base = {p: int(t) for (p, _), t in zip(sizes, totals, strict=False)}

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, before, raw in zip(*(batch.column(c).to_pylist() for c in ("part", "before", "shard")), strict=True):
                s = Shard(raw)
                for names, bounds in _documents(s):
                    got = [of(s.ids, a, b) for a, b in zip(bounds, bounds[1:], strict=False)]
                    start = base[part] + before + bounds[:-1]
                    yield pa.record_batch([pa.array(names, pa.int64()), pa.array(start), pa.array(np.diff(bounds)), pa.array(got, kind)], ["doc_id", "start", "n_tokens", column.split()[0]])

    return shards.select("part", "before", "shard").mapInArrow(documents, f"doc_id long, start long, n_tokens long, {column}")


def op2_token_ids(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """Per document its place in the written ids and their checksum, as read back from the shards."""
    import public_tokenizers

    path = new_path(spark, "token-ids")
    write_token_ids(table(spark, sf_dir, "documents") if docs is None else docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_index(spark, path)
