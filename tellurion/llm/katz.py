"""Operator 7: Katz backoff language model with Good-Turing discounts.

Order 2 over the words of whole texts, each text between a begin mark (context only) and an end token:

    P(w | h) = r*(h, w) / c(h)        if the pair was seen r > 0 times in training
             = a(h) P(w)              else, if the context h was seen
             = P(w)                   else
    P(w)     = c*(w) / N              if the word was seen; what is left is the probability of the one unknown word

r* and c* are Good-Turing counts up to K and r - TAIL above, so that every context keeps some mass for unseen words, and
a(h) = (1 - sum of P(w | h) over seen w) / (1 - sum of P(w) over seen w), exactly.

Pairs go to cells of a grid: the slice of the context by the slice of the word. A cell gets the counts of both slices' words, so a
frequent context or word is spread over a row or column of cells, and the words' table is needed once for each row and column
only. What travels is packed: a row is a cell's share of some millions of tokens. A pair that alone would fill a cell does not
travel: it is found and counted first, and tasks score its tokens where they read them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACED, fold, free_shuffles, mix, slices, table, words, written

#: Counts up to K are discounted by Good-Turing, larger ones by TAIL.
K, TAIL = 5, 0.5
#: Hashes that stand for the end token and the begin mark.
END, BEGIN = np.uint64(0x456E644F66546578), np.uint64(0x426567696E4F6654)
#: Tokens of one cell of the grid on average, and tokens that a task packs at once.
CELL_TOKENS, PACK_TOKENS = 3_500_000, 2_500_000


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed binary: integers in as few bytes as hold them, and first bytes, second bytes and so on together."""
    parts, head = [], [len(arrays)]
    for a in arrays:
        if a.dtype.kind in "iu" and a.dtype != np.uint64:
            a = a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))
        head += [ord(a.dtype.char), len(a)]
        parts.append(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())
    return zstandard.compress(np.array(head, np.int64).tobytes() + b"".join(parts), 1)


def unpacked(raw: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(raw)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head, at, out = np.frombuffer(raw, np.int64, 2 * n, 8), 8 + 16 * n, []
    for kind, size in zip(head[::2].tolist(), head[1::2].tolist(), strict=True):
        width = np.dtype(chr(kind)).itemsize
        planes = np.frombuffer(raw, np.uint8, size * width, at).reshape(width, size)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(chr(kind)))
        at += size * width
    return out


def distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ascending distinct keys, and the place of each key among them, in half the memory of np.unique."""
    order = np.argsort(key)
    ranked = key[order]
    new = np.append(np.ones(min(1, len(key)), bool), ranked[1:] != ranked[:-1])
    found = ranked[new]
    del ranked
    rank = np.cumsum(new, dtype=np.int32)
    rank -= 1
    at = np.empty(len(key), np.int32)
    at[order] = rank
    return found, at


def _steps(h: np.ndarray) -> np.ndarray:
    """Differences of ascending hashes, whose high bytes are mostly zero."""
    return np.diff(h, prepend=np.uint64(0))


def _slice(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(20)) % np.uint64(n)).astype(np.int64)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with an end token after each text, and tokens per text."""
    w = words(texts, SPACED)
    return np.insert(w.hashes(), w.first[1:], END), w.per_text + 1


def unigrams(docs: DataFrame) -> DataFrame:
    """Rows (h, c): each training token's hash and count; docs has text and train."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            h, c = np.unique(np.concatenate(held), return_counts=True)
            for a in range(0, len(h), 1 << 17):
                yield pa.record_batch([pa.array(h[a : a + (1 << 17)].view(np.int64)), pa.array(c[a : a + (1 << 17)])], ["h", "c"])

        for batch in slices(batches, "text"):
            tokens, _ = _tokens(batch.column("text"))
            held.append(tokens)
            size += len(tokens)
            if size > PACK_TOKENS:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    return docs.where("train").select("text").mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def good_turing(n: list[int], total: int) -> np.ndarray:
    """r* for r = 0 to K (r* of 0 is 0) from the numbers of types seen 1 to K + 1 times; plain discounts where these are unfit."""
    plain = np.array([max(0.0, r - TAIL) for r in range(K + 1)])
    if total == 0 or min(n) <= 0:
        return plain
    cut = (K + 1) * n[K] / n[0]
    if cut >= 1:
        return plain
    out = plain.copy()
    for r in range(1, K + 1):
        d = ((r + 1) * n[r] / n[r - 1] / r - cut) / (1 - cut)
        out[r] = r * d if 0 < d < 1 else plain[r]
    return out


def discounted(r: np.ndarray, star: np.ndarray) -> np.ndarray:
    return np.where(r <= K, star[np.minimum(r, K)], r - TAIL)


COLUMNS = "kind string, part long, chunk long, blob binary, " + ", ".join(f"n{r} long" for r in range(1, K + 2))


def _row(kind: str, part: int, chunk: int, blob: bytes, n: list[int] | None = None) -> list:
    return [kind, part, chunk, blob, *(n or [0] * (K + 1))]


def _table(rows: list[list]) -> pa.Table:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * (K + 1)]
    columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [x.split()[0] for x in COLUMNS.split(", ")])


def _before(tokens: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The token before each, BEGIN before a text's first."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(n) - n] = BEGIN
    return before


def _pair_keys(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(3) ^ tokens)


class Hot:
    """Pairs too frequent for a cell, by ascending key, with their counts in training: of the pair, the context and the word."""

    def __init__(self, rows: list[tuple[int, ...]] = ()):
        h1, h2, r, c1, c2 = (np.array([x[k] for x in rows], np.int64) for k in range(5)) if rows else (np.zeros(0, np.int64),) * 5
        order = np.argsort(_pair_keys(h1.view(np.uint64), h2.view(np.uint64)))
        self.h1, self.h2 = h1.view(np.uint64)[order], h2.view(np.uint64)[order]
        self.r, self.c1, self.c2, self.key = r[order], c1[order], c2[order], _pair_keys(self.h1, self.h2)

    def find(self, before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """The number of each pair among these, or -1."""
        if not len(self.key):
            return np.full(len(tokens), -1)
        k = np.minimum(np.searchsorted(self.key, _pair_keys(before, tokens)), len(self.key) - 1)
        return np.where((self.h1[k] == before) & (self.h2[k] == tokens), k, -1)


def _pair_counts(docs: DataFrame, least: float | None, some: Hot | None = None) -> DataFrame:
    """Rows (h1, h2, c) of chunks of documents, summed: pairs with a share of `least` of a chunk's tokens, or those of `some`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            n, tokens = np.concatenate([x[1] for x in held]), np.concatenate([x[0] for x in held])
            before = _before(tokens, n)
            if some is not None:
                k = some.find(before, tokens)
                c = np.bincount(k[k >= 0], minlength=len(some.key))
                h1, h2 = some.h1, some.h2
            else:
                key, at, c = np.unique(_pair_keys(before, tokens), return_index=True, return_counts=True)
                many = c >= least * len(tokens)
                h1, h2, c = before[at[many]], tokens[at[many]], c[many]
            return pa.record_batch([pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(c.astype(np.int64))], ["h1", "h2", "c"])

        for batch in slices(batches, "text"):
            held.append(_tokens(batch.column("text")))
            size += len(held[-1][0])
            if size > PACK_TOKENS // 2:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return docs.select("text").mapInArrow(count, "h1 long, h2 long, c long").groupBy("h1", "h2").agg(F.sum("c").alias("c"))


def hot_pairs(rows: DataFrame, counts: DataFrame, texts: int, cell_tokens: int) -> Hot:
    """Pairs with `cell_tokens` or more of all tokens, of which there are no more than cells, and over 1000 of the training tokens.

    A pair with a share s of all tokens has that share in some chunk, so pairs with a quarter of that share of a chunk are candidates;
    chunks that don't name a candidate hold less than a quarter of what makes it hot.
    """
    size, n = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    most = size / 2 + 1.5 * n  # tokens at most: a word and its space are two bytes
    if most < cell_tokens:
        return Hot()
    found = _pair_counts(rows, cell_tokens / most / 4).where(F.col("c") >= 0.75 * cell_tokens * 0.99).select("h1", "h2").collect()
    if not found:
        return Hot()
    exact = _pair_counts(rows.where("train"), None, Hot([(r.h1, r.h2, 0, 0, 0) for r in found])).where("c > 1000").collect()
    words = rows.sparkSession.createDataFrame(sorted({(h,) for r in exact for h in (r.h1, r.h2)}) or [], "h long")
    count = {r.h: r.c for r in counts.join(F.broadcast(words), "h").select("h", "c").collect()} | {int(BEGIN.view(np.int64)): texts}
    return Hot([(r.h1, r.h2, r.c, count[r.h1], count[r.h2]) for r in exact])


def _packs(docs: DataFrame, grid: int, hot: Hot) -> DataFrame:
    """Rows for cells: pairs of a chunk of documents in the cell, and in one of the cells the chunk's documents and, of its hot pairs,
    the scores."""
    held_hot = docs.sparkSession.sparkContext.broadcast(hot)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, at = [], 0, (TaskContext.get().partitionId() << 24)

        def flush() -> Iterator[pa.RecordBatch]:
            n, tokens = np.concatenate([x[1] for x in held]), np.concatenate([x[0] for x in held])
            ids, train = [d for x in held for d in x[2]], np.concatenate([x[3] for x in held])
            doc = np.repeat(np.arange(len(n), dtype=np.int32), n)
            before, home = _before(tokens, n), at % (grid * grid)
            hot = held_hot.value
            k = hot.find(before, tokens)
            if (k >= 0).any():
                mine, k = np.flatnonzero(k >= 0), k[k >= 0]
                own, place = np.unique(doc[mine], return_inverse=True)
                sums = [np.bincount(place, x[k]) for x in (np.log10(hot.c2 + 1.0), np.log10(hot.r - TAIL) - np.log10(hot.c1))]
                yield batch_of("hot", home, packed(own, *sums, np.bincount(place, hot.c2[k] > 0).astype(np.int64), *[np.zeros(len(own), np.int64)] * K))
                rest = np.ones(len(tokens), bool)
                rest[mine] = False
                before, tokens, doc = before[rest], tokens[rest], doc[rest]
            cell = _slice(before, grid) * grid + _slice(tokens, grid)
            cell = cell.astype(np.uint16) if grid < 256 else cell
            order = np.argsort(cell, kind="stable").astype(np.int32)
            cuts = np.searchsorted(cell[order], np.arange(grid * grid + 1))
            yield batch_of("docs", home, packed(np.array([0 if d is None else d for d in ids], np.int64).view(np.uint64), np.array([d is None for d in ids], np.uint8), train.astype(np.uint8), n))
            for c in range(grid * grid):
                mine = order[cuts[c] : cuts[c + 1]]
                if len(mine):
                    (h1, i1), (h2, i2) = (np.unique(x[mine], return_inverse=True) for x in (before, tokens))
                    yield batch_of("pairs", c, packed(_steps(h1), _steps(h2), i1, i2, np.diff(doc[mine], prepend=0), np.packbits(train)))

        def batch_of(kind: str, cell: int, blob: bytes) -> pa.RecordBatch:
            return pa.record_batch([pa.array([cell], pa.int64()), pa.array([kind]), pa.array([at]), pa.array([blob], pa.binary())], ["cell", "kind", "chunk", "blob"])

        for batch in slices(batches, "text"):
            tokens, n = _tokens(batch.column("text"))
            held.append((tokens, n, batch.column("doc_id").to_pylist(), batch.column("train").to_numpy(zero_copy_only=False)))
            size += len(tokens)
            if size > PACK_TOKENS:
                yield from flush()
                held, size, at = [], 0, at + 1
        if held:
            yield from flush()

    return docs.select("doc_id", "text", "train").mapInArrow(pack, "cell long, kind string, chunk long, blob binary")


def _word_packs(counts: DataFrame, grid: int) -> DataFrame:
    """The words of each slice with their counts, for the cells in its row (kind 1) and its column (kind 2)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, c = batch.column("h").to_numpy().view(np.uint64), batch.column("c").to_numpy()
            s = _slice(h, grid)
            for k in np.unique(s).tolist():
                own = np.flatnonzero(s == k)
                own = own[np.argsort(h[own])]
                blob = packed(_steps(h[own]), c[own])
                cells = [("words1", k * grid + j) for j in range(grid)] + [("words2", j * grid + k) for j in range(grid)]
                yield pa.record_batch([pa.array([c for _, c in cells]), pa.array([x for x, _ in cells]), pa.array([0] * len(cells)), pa.array([blob] * len(cells), pa.binary())], ["cell", "kind", "chunk", "blob"])

    return counts.mapInArrow(pack, "cell long, kind string, chunk long, blob binary")


def _cell(t: pa.Table, grid: int, star: np.ndarray, total: int, unknown: float, texts: int, hot: Hot) -> pa.Table:
    """Count a cell's pairs and score its tokens as far as the cell knows: what contexts need, and what documents have."""
    cell, kinds, chunks = t.column("cell")[0].as_py(), t.column("kind").to_pylist(), t.column("chunk").to_pylist()
    rows, role, pairs = [], {"words1": [], "words2": []}, []
    for kind, chunk, blob in zip(kinds, chunks, t.column("blob"), strict=True):
        if kind == "docs":
            rows.append(_row("docs", 0, chunk, blob.as_py()))
        elif kind == "hot":
            rows.append(_row("scores", 0, chunk, blob.as_py()))
        elif kind == "pairs":
            pairs.append((chunk, blob.as_py()))
        else:
            h, c = unpacked(blob.as_py())
            role[kind].append((np.cumsum(h), c.astype(np.int64)))
    here = np.flatnonzero(_slice(hot.h1, grid) * grid + _slice(hot.h2, grid) == cell)  # what contexts need of hot pairs, in the pairs' own cells
    for k in here.tolist():
        part = cell // grid * grid + int(_slice(hot.h1[k : k + 1] >> np.uint64(13), grid)[0])
        tail, below = np.array([hot.r[k] - TAIL]), discounted(hot.c2[k : k + 1], star) / max(1, total)
        rows.append(_row("contexts", part, 0, packed(hot.h1[k : k + 1], hot.c1[k : k + 1], *[np.zeros(1, np.int64)] * K, tail, below)))
    if not pairs:
        return _table(rows)
    if int(_slice(np.array([BEGIN]), grid)[0]) == cell // grid:
        role["words1"].append((np.array([BEGIN]), np.array([texts])))
    known = {}
    for kind, x in role.items():
        h, c = (np.concatenate([p[k] for p in x]) if x else np.zeros(0, (np.uint64, np.int64)[k]) for k in (0, 1))
        order = np.argsort(h)
        known[kind] = h[order], c[order]
    (h1, c1), (h2, c2) = known["words1"], known["words2"]

    def number(h: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Place of each hash among the known ones, their number if it isn't one."""
        if not len(h):
            return np.zeros(len(d), np.int64)
        k = np.minimum(np.searchsorted(h, d), len(h) - 1)
        return np.where(h[k] == d, k, len(h))

    spans, key, docs, train = [], [], [], []
    while pairs:
        chunk, blob = pairs.pop()
        d1, d2, i1, i2, step, flags = unpacked(blob)
        d1, d2 = np.cumsum(d1), np.cumsum(d2)
        key.append((number(h1, d1) * (len(h2) + 1))[i1] + number(h2, d2)[i2])
        docs.append(np.cumsum(step, dtype=np.int32))
        train.append(np.unpackbits(flags).astype(bool)[docs[-1]])
        spans.append((chunk, len(step)))
    key = np.concatenate(key)
    docs = np.concatenate(docs)
    train = np.concatenate(train)
    pair, at = distinct(key)
    del key
    seen = np.bincount(at[train], minlength=len(pair))
    del train
    p2 = np.append(discounted(c2, star) / max(1, total), unknown)
    count2, count1 = np.append(c2, 0), np.append(c1, 0)

    # what each context needs of this cell: its pairs by count, the sum of larger counts, and the words' own probabilities
    some = np.flatnonzero(seen)
    pa_, pb, r = pair[some] // (len(h2) + 1), pair[some] % (len(h2) + 1), seen[some]
    n = np.bincount(np.minimum(r, K + 2), minlength=K + 3)[1 : K + 2].tolist()
    ctx, first = np.unique(pa_, return_index=True)
    if len(ctx):
        stat = [np.add.reduceat((r == k).astype(np.int64), first) for k in range(1, K + 1)]
        stat += [np.add.reduceat(np.where(r > K, r - TAIL, 0.0), first), np.add.reduceat(p2[pb], first)]
        sub = _slice(h1[ctx] >> np.uint64(13), grid)
        for k in np.unique(sub).tolist():
            own = np.flatnonzero(sub == k)
            rows.append(_row("contexts", cell // grid * grid + k, 0, packed(h1[ctx[own]], c1[ctx[own]], *[x[own] for x in stat])))
    rows.append(_row("counts", 0, 0, b"", n))

    log1, log2, base, start = np.log10(np.maximum(1, count1)), np.log10(p2), np.log10(count2 + 1.0), 0
    for chunk, size in spans:
        which, own_docs = at[start : start + size], docs[start : start + size]
        start += size
        r, a, b = seen[which], pair[which] // (len(h2) + 1), pair[which] % (len(h2) + 1)
        own = np.where(r > K, np.log10(np.maximum(r - TAIL, 1e-9)) - log1[a], np.where(r > 0, -log1[a], log2[b]))
        doc, place = np.unique(own_docs, return_inverse=True)
        total_of = lambda x, m=len(doc), p=place: np.bincount(p, x, m)
        hist = [total_of(r == k).astype(np.int64) for k in range(1, K + 1)]
        rows.append(_row("scores", 0, chunk, packed(doc, total_of(base[b]), total_of(own), total_of(count2[b] > 0).astype(np.int64), *hist)))
        new = np.flatnonzero((r == 0) & (a < len(h1)))
        if len(new):
            h, sub = h1[a[new]], _slice(h1[a[new]] >> np.uint64(13), grid)
            for k in np.unique(sub).tolist():
                s = sub == k
                g, i = np.unique(h[s], return_inverse=True)
                rows.append(_row("unseen", cell // grid * grid + k, chunk, packed(g, i, own_docs[new][s])))
    return _table(rows)


def _backoff(t: pa.Table, star: np.ndarray) -> pa.Table:
    """Backoff weights of the contexts of one part, summed over the unseen pairs of each document."""
    h, c, seen, p, rows = [], [], [], [], []
    kinds, blobs = t.column("kind").to_pylist(), t.column("blob")
    for kind, blob in zip(kinds, blobs, strict=True):
        if kind == "contexts":
            g, count, *stat = unpacked(blob.as_py())
            h.append(g)
            c.append(count.astype(np.int64))
            seen.append(sum(x * star[k + 1] for k, x in enumerate(stat[:K])) + stat[K])
            p.append(stat[K + 1])
    if h:
        h, c, seen, p = (np.concatenate(x) for x in (h, c, seen, p))
        g, first, at = np.unique(h, return_index=True, return_inverse=True)
        mass, below = np.bincount(at, seen) / c[first], np.bincount(at, p)
        weight = np.log10(np.maximum(1 - mass, 1e-12)) - np.log10(np.maximum(1 - below, 1e-12))
    for kind, chunk, blob in zip(kinds, t.column("chunk").to_pylist(), blobs, strict=True):
        if kind == "unseen":
            d, i, doc = unpacked(blob.as_py())
            if h is None or not len(h):
                continue
            k = np.minimum(np.searchsorted(g, d), len(g) - 1)
            w = np.where(g[k] == d, weight[k], 0.0)[i]
            own, place = np.unique(doc, return_inverse=True)
            rows.append(_row("weights", 0, chunk, packed(own, np.bincount(place, w))))
    return _table(rows)


def _chunk(t: pa.Table, star: np.ndarray, total: int, types: int) -> pa.Table:
    """Scores of one chunk's documents from what cells and contexts say of them."""
    blobs = list(zip(t.column("kind").to_pylist(), t.column("blob"), strict=True))
    ids, null, train, n = next(unpacked(b.as_py()) for k, b in blobs if k == "docs")
    base, score, known = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids), np.int64)
    log_star = np.log10(np.maximum(star[1:], 1e-12))
    for kind, blob in blobs:
        if kind == "scores":
            doc, x, own, some, *hist = unpacked(blob.as_py())
            base[doc] += x
            known[doc] += some
            score[doc] += own + sum(k * s for k, s in zip(hist, log_star, strict=True))
        elif kind == "weights":
            doc, w = unpacked(blob.as_py())
            score[doc] += w
    n = n.astype(np.int64)
    base -= n * math.log10(total + types + 1)
    return pa.table([pa.array(ids.view(np.int64), mask=null.astype(bool)), pa.array(n), pa.array(known), pa.array(base), pa.array(score)], ["doc_id", "n_tokens", "n_known", "base_score", "score"])


def katz_scores(docs: DataFrame, train: str = "train", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row; the model learns from rows where `train` is true.

    score: log10 of the Katz probability of all tokens of the whole text, its end token included. base_score: the same under
    counts plus one. A word unseen in training has the one probability that single counts leave to it. Null and empty texts are one
    end token; null `train` is false; rows that repeat an id each get a row; without training rows all tokens are unknown and
    score 0 (probability 1). Tables that the steps write: words with counts, then what cells know, by kind.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.coalesce(F.col(train), F.lit(False)).alias("train"))
    counts = written(unigrams(rows), "words")
    tally = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("total"), F.count("*").alias("types"), *[F.count_if(F.col("c") == r).alias(f"n{r}") for r in range(1, K + 2)], F.coalesce(F.max(F.when(F.col("h") == int(END.view(np.int64)), F.col("c"))), F.lit(0)).alias("texts"))
    m = tally.first()
    free_shuffles(spark)
    star1 = good_turing([m[f"n{r}"] for r in range(1, K + 2)], m.total)
    kept = counts.agg(F.sum(F.when(F.col("c") > K, F.col("c") - TAIL))).first()[0] or 0.0
    unknown = 1 - (kept + sum(star1[r] * m[f"n{r}"] for r in range(1, K + 1))) / m.total if m.total else 1.0
    total, types, texts = m.total, m.types, m.texts
    grid = max(1, math.ceil(math.sqrt(total / CELL_TOKENS)))
    hot = hot_pairs(rows, counts, texts, CELL_TOKENS)
    cells = _packs(rows, grid, hot).unionAll(_word_packs(counts, grid)).groupBy("cell").applyInArrow(lambda t: _cell(t, grid, star1, total, unknown, texts, hot), COLUMNS)
    known = written(cells, "cells", ["kind"])
    free_shuffles(spark)
    n2 = known.where("kind = 'counts'").agg(*[F.coalesce(F.sum(f"n{r}"), F.lit(0)) for r in range(1, K + 2)]).first()
    star2 = good_turing(list(n2), total)
    columns = [x.split()[0] for x in COLUMNS.split(", ")]
    weights = known.where("kind in ('contexts', 'unseen')").select(*columns).groupBy("part").applyInArrow(lambda t: _backoff(t, star2), COLUMNS)
    by_chunk = known.where("kind in ('docs', 'scores')").select(*columns).unionAll(weights).groupBy("chunk")
    found = by_chunk.applyInArrow(lambda t: _chunk(t, star2, total, types), "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return found.withColumn("train_tokens", F.lit(total).cast("long"))


def op7_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its score under the model and under the base; fold 2 of 7 is never learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (~fold("doc_id", 7).isin(2, -1)).alias("train"))
    found = katz_scores(docs)
    return found.select("doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
