"""Operator 1: benchmark decontamination by a broadcast set of normalised n-grams, each hit verified."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM, Words, slices, table, words, written

WINDOW = 10
#: Bytes of benchmark text in one broadcast set; a larger benchmark is scanned for in several sets, one after another.
BLOCK_BYTES = 8 << 20


def _rolled(h: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each n consecutive word hashes."""
    out = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - n + 1 + k]
    return out ^ (out >> np.uint64(29))


class Index:
    """Hash set of the windows of one length of some items: packed bits by the high hash bits, the sorted hashes, and for each of them
    its item and the place of its words in one normalised text, by which hits are verified."""

    def __init__(self, size: int, items: list[str | None], w: Words, first: np.ndarray, item: np.ndarray):
        """first: the first word of each window in w; item: its item's number."""
        self.size, self.items = size, items
        keys = _rolled(w.hashes(), size)[first]
        order = np.argsort(keys, kind="stable")
        self.hashes, self.item = keys[order], item[order].astype(np.int32)
        self.text = w.text(0, len(w.start))
        upto = np.cumsum(w.end - w.start + 1)
        begin = np.concatenate([[0], upto])[:-1]
        self.begin, self.end = begin[first[order]].astype(np.int32), (upto[first[order] + size - 1] - 1).astype(np.int32)
        self.shift = np.uint64(64 - int(np.clip(np.ceil(np.log2(len(keys) + 1)) + 5, 16, 30)))
        flags = np.zeros(1 << (64 - int(self.shift)), bool)
        flags[(self.hashes >> self.shift).astype(np.int64)] = True
        self.bits = np.packbits(flags, bitorder="little")
        self.met: dict[bytes, frozenset[str | None]] = {}  # those whose hash some window has, so about as many as the windows

    def candidates(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places whose hash some window has, and the range of these windows."""
        if len(h) < self.size:
            return (np.zeros(0, np.int64),) * 3
        r = _rolled(h, self.size)
        bit = (r >> self.shift).astype(np.int64)
        at = np.flatnonzero(self.bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
        low, high = np.searchsorted(self.hashes, r[at]), np.searchsorted(self.hashes, r[at], side="right")
        hit = high > low
        return at[hit], low[hit], high[hit]

    def holders(self, window: bytes, low: int, high: int) -> frozenset[str | None]:
        """Items that have this very window; found once for each window that a worker meets."""
        if window not in self.met:
            self.met[window] = frozenset(self.items[self.item[k]] for k in range(low, high) if self.text[self.begin[k] : self.end[k]] == window)
        return self.met[window]


def indexes_of(items: list[tuple[str | None, str]], window: int) -> list[Index]:
    """An index for each length of windows: `window` words, or all words of an item that has fewer."""
    w = words(pa.array([t for _, t in items], pa.string()), ALNUM)
    names, n, out = [i for i, _ in items], w.per_text, []
    for size in np.unique(np.minimum(n[n > 0], window)).tolist():
        mine = np.flatnonzero(np.minimum(n, window) == size)
        count = n[mine] - size + 1
        first = np.arange(count.sum()) + np.repeat(w.first[mine] - np.cumsum(count) + count, count)
        out.append(Index(size, names, w, first, np.repeat(mine, count)))
    return out


SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
SCHEMA = "n_words long, spans array<struct<first:int,last:int>>, items array<string>"


def _scan(batches: Iterator[pa.RecordBatch], indexes: list[Index], text: str) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, text):
        w = words(batch.column(text), ALNUM)
        h, spans, items = w.hashes(), [[] for _ in range(batch.num_rows)], [set() for _ in range(batch.num_rows)]
        named = set()  # windows whose items a document has already
        for index in indexes:
            at, low, high = index.candidates(h)
            doc = np.searchsorted(w.first, at, side="right") - 1
            inside = at + index.size <= w.first[doc + 1]
            for i, d, a, b in zip(*(x[inside].tolist() for x in (at, doc, low, high)), strict=True):
                if found := index.holders(window := w.text(i, i + index.size), a, b):
                    if (d, window) not in named:
                        named.add((d, window))
                        items[d].update(found)
                    spans[d].append((i - int(w.first[d]), i - int(w.first[d]) + index.size))
        got = [pa.array(w.per_text.astype(np.int64)), pa.array([_merged(s) for s in spans], SPANS), pa.array([sorted(s, key=lambda x: (x is None, x or "")) for s in items], pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays([*batch.columns, *got], [*batch.schema.names, "n_words", "spans", "items"])


def _merged(spans: list[tuple[int, int]]) -> list[dict]:
    """Sorted, overlapping and touching spans as one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [{"first": a, "last": b} for a, b in out]


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Add n_words, spans (word positions first, last excluded, that benchmark windows cover) and items (whose windows occur).

    A window is `window` consecutive words of an item, or the whole item if it has fewer words. Words: runs of ASCII letters
    and digits, lower-cased, and of all non-ASCII characters. The benchmark's size is measured first: up to `block_bytes` of it are
    broadcast as one set; more than that goes in several sets, each scanned in its own pass over what the last pass wrote.

    Nulls and empty texts have no words and no hits; null or empty texts of items match nothing; an item without an id counts as
    any other, and is null in items; equal items are all named; repeated
    documents are each scanned; an empty benchmark or document table gives no hits. Columns of docs stay, except any already
    called n_words, spans or items, which are replaced.
    """
    docs = docs.drop("n_words", "spans", "items")
    some = benchmark.where(F.col(item_text).isNotNull()).select(F.col(item).cast("string").alias("i"), F.col(item_text).alias("t")).distinct()
    size = some.agg(F.sum(F.octet_length("t") + F.coalesce(F.octet_length("i"), F.lit(0)))).first()[0] or 0
    blocks = int(size // block_bytes) + 1
    found = None
    for k in range(blocks):
        part = some if blocks == 1 else some.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == k)
        indexes = indexes_of([tuple(r) for r in part.collect()], window)  # about block_bytes of text
        if found is None:
            found = _one_set(docs, indexes, text)
        else:
            more = _one_set(found.withColumnsRenamed({"spans": "_spans", "items": "_items"}).drop("n_words"), indexes, text)
            spans, items = F.array_sort(F.array_union("_spans", "spans")), F.array_sort(F.array_union("_items", "items"))
            found = more.withColumn("spans", merged_spans(spans)).withColumn("items", items).drop("_spans", "_items")
        if blocks > 1:
            found = written(found, "hits")
    return found


def _one_set(docs: DataFrame, indexes: list[Index], text: str) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(indexes)
    schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL(SCHEMA).fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _scan(batches, held.value, text)

    return docs.mapInArrow(scan, schema)


def merged_spans(spans):
    """Sorted spans (first, last), those that overlap or touch as one, in DataFrame functions."""
    fits = lambda acc, x: (F.size(acc) > 0) & (x["first"] <= F.element_at(acc, -1)["last"])
    both = lambda acc, x: F.struct(F.element_at(acc, -1)["first"].alias("first"), F.greatest(F.element_at(acc, -1)["last"], x["last"]).alias("last"))
    empty = F.expr("cast(array() as array<struct<first:int,last:int>>)")
    return F.aggregate(spans, empty, lambda acc, x: F.when(F.size(acc) == 0, F.array(x)).when(fits(acc, x), F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(both(acc, x)))).otherwise(F.concat(acc, F.array(x))))


def n_hit():
    """Words that spans cover."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + (x["last"] - x["first"]).cast("long"))


def without_hits(docs: DataFrame, benchmark: DataFrame, how: str = "documents", **options) -> DataFrame:
    """Remove what benchmark_hits finds: whole documents, or (how="spans") the words of the spans, the rest joined by spaces."""
    found = benchmark_hits(docs, benchmark, **options)
    text = options.get("text", "text")
    if how == "documents":
        return found.where(F.size("spans") == 0).select(*docs.columns)

    @F.pandas_udf("string")
    def cut(texts, spans):
        import pandas as pd

        return pd.Series([_cut(t, s) for t, s in zip(texts, spans, strict=True)])

    return found.withColumn(text, F.when(F.size("spans") == 0, F.col(text)).otherwise(cut(text, "spans"))).select(*docs.columns)


def _cut(text: str | None, spans) -> str | None:
    if text is None or spans is None or not len(spans):
        return text
    raw, out, at = text.encode(), [], 0
    w = words(pa.array([text], pa.string()), ALNUM)
    for s in spans:
        out.append(raw[at : w.start[s["first"]]])
        at = int(w.end[s["last"] - 1])
    return b"".join([*out, raw[at:]]).decode()


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, words hit, items with occurring windows and the digest of their ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = benchmark_hits(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
s AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM s)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS (SELECT DISTINCT doc_id, i, n, item_id FROM dw JOIN bw USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM (SELECT doc_id, i, unnest(range(0, n)) AS k FROM h) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
