"""Operator 13: documents packed into token sequences of one length, by best-fit decreasing."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import WordEncoder
from .common import new_path, slices, table

WINDOW, END_ID, PAD_ID = 2048, 1, 0
#: Ids of document ends that are packed at once, and padding of a window that is put up with (a share of the window).
BLOCK_IDS, SLACK = 4 << 20, 1 / 256
#: Bytes of text that are encoded at once: each different word of them once.
TEXT_BYTES = 4 << 20
#: Bits of a sequence's number within its task.
NUMBER_BITS = 33
#: Ids of one batch of finished sequences.
OUT_IDS = 1 << 20

SEQUENCES = "sequence_id long, n_ids int, id_bytes int, ids binary, pieces array<struct<doc_id:long,start:long,length:long,doc_tokens:long,offset:long>>"
_PIECES = pa.list_(pa.struct([(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "offset")]))


class OpenWindows:
    """A segment tree over remaining capacities: each leaf holds the windows with just so much room, each node their number."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.tree = [0] * (2 * self.size)
        self.at: list[list] = [[] for _ in range(window + 1)]

    def put(self, room: int, one) -> None:
        self.at[room].append(one)
        node = room + self.size
        while node:
            self.tree[node] += 1
            node >>= 1

    def take(self, least: int):
        """The window with the least room of `least` or more, and its room; None if there is none."""
        tree, node = self.tree, least + self.size
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):  # up, until there is something to the right
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node *= 2
                if not tree[node]:
                    node += 1
        room = node - self.size
        while node:
            tree[node] -= 1
            node >>= 1
        return room, self.at[room].pop()


def best_fit(lengths: np.ndarray, window: int) -> list[tuple[int, list[int]]]:
    """Windows as (room left, pieces): the longest piece first, each into the tightest window that it fits, else into a new one."""
    open_, full = OpenWindows(window), []
    for k in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[k])
        found = open_.take(n)
        room, pieces = found if found else (window, [])
        pieces.append(k)
        if room == n:
            full.append((0, pieces))
        else:
            open_.put(room - n, pieces)
    return full + [(room, p) for room, some in enumerate(open_.at) for p in some]


def padding(used: int, window: int) -> int:
    """Ids that a sequence is padded by; one whose length is a power of two stays as it is."""
    return 0 if used & (used - 1) == 0 else window - used


class Packer:
    """Packs the documents of one task: full windows of long documents at once, their ends and short documents in blocks.

    A piece is (document id, start, ids of its document, ids). Windows of a block with more padding than `slack` are opened
    again with the next block. At the end the pieces of those left are laid one after another and cut into full windows, and
    the last rest into powers of two, which need no padding.
    """

    def __init__(self, window: int, block_ids: int, slack: float):
        self.window, self.block_ids, self.slack = window, block_ids, int(slack * window)
        self.held: list[tuple] = []
        self.size = self.opened = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[list[tuple]]:
        n, w = len(ids), self.window
        for a in range(0, n - w + 1, w):
            yield [(doc_id, a, n, ids[a : a + w])]
        if rest := n % w:
            self.held.append((doc_id, n - rest, n, ids[n - rest :].copy()))
            self.size += rest
            if self.size >= self.opened + self.block_ids:
                yield from self.pack()

    def pack(self) -> Iterator[list[tuple]]:
        pieces, self.held, self.size = self.held, [], 0
        for room, some in best_fit(np.array([len(p[3]) for p in pieces], np.int64), self.window):
            if padding(self.window - room, self.window) <= self.slack:
                yield [pieces[k] for k in some]
            else:
                self.held += [pieces[k] for k in some]
                self.size += self.window - room
        self.opened = self.size

    def finish(self) -> Iterator[list[tuple]]:
        yield from self.pack()
        left, size, now = self.size, min(self.size, self.window), []
        for doc_id, start, n, ids in self.held:
            a = 0
            while a < len(ids):
                if not now:  # the next sequence: a full one, or the largest power of two that is left
                    size = room = self.window if left >= self.window else 1 << (left.bit_length() - 1)
                    left -= size
                b = min(len(ids), a + room)
                now.append((doc_id, start + a, n, ids[a:b]))
                room, a = room - (b - a), b
                if not room:
                    yield now
                    now = []
        self.held = []


def _sequences(done: list[list[tuple]], first: int, window: int, pad_id: int) -> pa.RecordBatch:
    """Rows of finished sequences, their ids padded, as narrow as all of the batch allows."""
    used = [sum(len(p[3]) for p in s) for s in done]
    parts = [np.concatenate([*(p[3] for p in s), np.full(padding(u, window), pad_id, np.uint32)]) for s, u in zip(done, used, strict=True)]
    width = 2 if max(int(x.max()) for x in parts) < 1 << 16 else 4
    places = [[] for _ in done]
    for s, out in zip(done, places, strict=True):
        at = 0
        for doc_id, start, n, ids in s:
            out.append({"doc_id": doc_id, "start": start, "length": len(ids), "doc_tokens": n, "offset": at})
            at += len(ids)
    columns = [pa.array(range(first, first + len(done)), pa.int64()), pa.array(used, pa.int32()), pa.array([width] * len(done), pa.int32())]
    return pa.record_batch([*columns, pa.array([x.astype(f"<u{width}").tobytes() for x in parts], pa.binary()), pa.array(places, _PIECES)], ["sequence_id", "n_ids", "id_bytes", "ids", "pieces"])


_ENCODERS: dict[str, WordEncoder] = {}


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, pad_id: int = PAD_ID, doc_id: str = "doc_id", text: str = "text", block_ids: int = BLOCK_IDS, slack: float = SLACK) -> DataFrame:
    """sequence_id, n_ids, id_bytes, ids, pieces: all documents as token ids, each ended by `end_id`, in sequences of `window` ids.

    `ids` holds little-endian unsigned integers of `id_bytes` bytes; of them `n_ids` are of documents, the rest `pad_id`. A sequence
    is padded to `window` unless its length is a power of two. `pieces` has for each part its document, the document's ids before
    it and in all, its length, and its offset in the sequence.

    Each task packs what it reads, so nothing is shuffled, however one source or copy abounds; it holds one block of ids and
    the ids of one slice of texts (at least one text whole). Numbers of sequences hold the task's, so write the result and read it from there. A null text counts as empty
    (its end id alone); rows that repeat an id are documents of their own; a null id stays null; other columns are ignored; an
    empty table gives no sequences. `window` must be a power of two.
    """
    if window & (window - 1) or window <= 0:
        raise ValueError("window must be a power of two")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _ENCODERS.get(tokenizer) or _ENCODERS.setdefault(tokenizer, WordEncoder(tokenizer))
        number, packer, done, size = TaskContext.get().partitionId() << NUMBER_BITS, Packer(window, block_ids, slack), [], 0

        def found() -> Iterator[list[tuple]]:
            for batch in slices(batches, text, TEXT_BYTES):
                ids, n = enc.encode(batch.column(text))
                cuts = np.cumsum(n)
                whole, cuts = np.insert(ids, cuts, end_id), [0, *(cuts + np.arange(1, len(n) + 1)).tolist()]
                for d, a, b in zip(batch.column(doc_id).to_pylist(), cuts, cuts[1:], strict=False):
                    yield from packer.add(d, whole[a:b])
            yield from packer.finish()

        for s in found():
            done.append(s)
            size += window
            if size >= OUT_IDS:
                yield _sequences(done, number, window, pad_id)
                number, done, size = number + len(done), [], 0
        if done:
            yield _sequences(done, number, window, pad_id)

    return docs.select(F.col(doc_id).cast("long").alias(doc_id), text).mapInArrow(pack, SEQUENCES)


def packed_pieces(sequences: DataFrame) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of each piece, from the sequences' ids. The crc32 is of a
    piece's ids as little-endian unsigned 32-bit integers."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for number, width, raw, some in zip(*(batch.column(c).to_pylist() for c in ("sequence_id", "id_bytes", "ids", "pieces")), strict=True):
                ids = np.frombuffer(raw, f"<u{width}").astype("<u4")
                rows += [(p["doc_id"], p["start"], p["length"], zlib.crc32(ids[p["offset"] : p["offset"] + p["length"]].tobytes()), p["doc_tokens"], number, p["offset"]) for p in some]
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return sequences.select("sequence_id", "id_bytes", "ids", "pieces").mapInArrow(pieces, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies, as read back from the written sequences."""
    import public_tokenizers

    path = new_path(spark, "sequences")
    pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).write.option("compression", "zstd").parquet(path)
    return packed_pieces(spark.read.schema(SEQUENCES).parquet(path))
