"""Operator 12: spelling variants of words, by an index of variable-length grams."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import flat, mix, slices, table, written

#: Least code points and occurrences of a word, and how much commoner its form must be.
LEAST_LETTERS, LEAST_COUNT, TIMES = 7, 2, 10
#: Bytes of text whose runs are counted at once, and of words whose lists are made at once.
RUN_BYTES, LIST_BYTES = 4 << 20, 1 << 16
#: Letters of the shortest grams. A gram is lengthened where more than 1/SHARE of all grams of its length equal it: at most SHARE grams
#: of each length are, so the dictionary has at most SHARE * 90 longer ones of each length (90 letters), 3 MB for three letters.
QMIN, SHARE = 2, 4096
#: Letters are coded 1 to 90 in 7 bits, so a gram of up to 9 letters is one long.
BITS = 7
#: Codes of ASCII letters by byte.
_ASCII = np.array([b - 96 if 97 <= b <= 122 else 0 for b in range(256)], np.int64)
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def _steps() -> np.ndarray:
    """The register of crc32 after each byte."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1)
    return out


_CRC = _steps()


def crc32_on(register: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """crc32 of data[start:end] for each pair of places, going on from the crc32 in `register`."""
    crc, n = ~register.astype(np.uint32), end - start
    rows = np.flatnonzero(n)
    k = 0
    while len(rows):
        c = crc[rows]
        crc[rows] = (c >> np.uint32(8)) ^ _CRC[(c ^ data[start[rows] + k]) & 0xFF]
        k += 1
        rows = rows[n[rows] > k]
    return ~crc


def strings(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Strings of these sizes in bytes, one after another."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def _counted(ids: pa.Array, texts: pa.Array, typo: int, least: int) -> pa.StructArray:
    """The words of a slice of documents, with their occurrences in it."""
    raw, offsets = flat(texts)
    low = _LOWER[raw]
    two = raw == 0xC3  # C3 and the byte after it are U+00C0 to U+00FF
    inside = (_ASCII[low] > 0) | two
    inside[1:] |= two[:-1]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(raw))]
    opens[cut], closes[cut - 1] = inside[cut], inside[cut - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    head = np.flatnonzero((raw & 0xC0) != 0x80)
    rank = np.searchsorted(head, start)
    letters = np.searchsorted(head, end) - rank
    some = letters >= least
    start, end, rank, letters = start[some], end[some], rank[some], letters[some]
    names = ids.to_pylist()
    begun = np.array([zlib.crc32(f"{d}:".encode()) for d in names], np.uint32)
    doc = np.searchsorted(offsets, start, "right") - 1
    h = crc32_on(begun[doc], low, start, end).astype(np.int64)
    hit = (h % typo == 0) & np.array([d is not None for d in names], bool)[doc]
    keep = np.zeros(len(raw) + 1, np.int8)
    keep[start] += 1
    keep[end] -= 1
    keep = np.cumsum(keep[:-1]).astype(bool)
    gone = head[rank[hit] + h[hit] % letters[hit]]
    keep[gone] = False
    pair = gone[two[gone]]
    keep[pair + 1] = False
    size = end - start
    size[hit] -= 1 + two[gone]
    found = strings(low[keep], size)
    long_enough = np.ones(len(size), bool)
    long_enough[hit] = letters[hit] > least
    return pc.value_counts(found.filter(pa.array(long_enough)))


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", typo: int = 31, least: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: runs of Latin letters of all texts, lower-cased in A-Z, with their occurrences; those of `least` letters and
    `least_count` occurrences or more. A run whose crc32 with its document's id is divisible by `typo` loses one letter, as if
    misspelt. Counts are made for each slice, then for each task, then summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, RUN_BYTES):
            found = _counted(batch.column(doc_id), batch.column(text), typo, least)
            yield pa.record_batch([found.field("values").cast(pa.string()), found.field("counts")], ["word", "n"])

    rows = docs.select(F.col(doc_id).cast("long").alias(doc_id), text).where(F.col(text).isNotNull())
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One code (1 to 90) for each letter of the words, and where each word begins."""
    raw, offsets = flat(words)
    two = raw == 0xC3
    codes = _ASCII[raw]
    at = np.flatnonzero(two)
    codes[at] = raw[at + 1].astype(np.int64) - 0x80 + 27
    head = (raw & 0xC0) != 0x80
    return codes[head], np.concatenate([[0], np.cumsum(head)])[offsets]


def grams_of(codes: np.ndarray, offsets: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram of q letters at each place, and whether the word has that many from there."""
    n = len(codes)
    out = np.zeros(n, np.int64)
    for k in range(q):
        out[: n - k] |= codes[k:] << (BITS * (q - 1 - k))
    ends = np.repeat(offsets[1:], np.diff(offsets))
    return out, np.arange(n) + q <= ends


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is one of these, which are in order."""
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values


class Grams:
    """A dictionary of grams: `by[q]`, in order, for QMIN < q. Grams of QMIN letters are always known.

    A word is decomposed into the longest gram at each letter, unless an earlier one covers it (`decompose`).
    """

    def __init__(self, by: dict[int, np.ndarray]):
        self.by = {q: g for q, g in sorted(by.items()) if len(g)}
        self.longest = max(self.by, default=QMIN)
        #: Beginnings of grams by length, and what stands in grams after one letter or more.
        self.begin: dict[int, np.ndarray] = {}
        self.inner: dict[int, np.ndarray] = {}
        none = np.zeros(0, np.int64)
        for size in range(1, self.longest):
            self.begin[size] = np.unique(np.concatenate([none, *(g >> BITS * (q - size) for q, g in self.by.items() if q > size)]))
            inner = ((g >> BITS * k) & ((1 << BITS * size) - 1) for q, g in self.by.items() for k in range(q - size))
            self.inner[size] = np.unique(np.concatenate([none, *inner]))

    def decompose(self, codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place, last place and code of the grams of words, in order; both places rise within a word."""
        n = len(codes)
        code, fits = grams_of(codes, offsets, QMIN)
        size = np.where(fits, QMIN, 0)
        for q, known in self.by.items():
            longer, fits = grams_of(codes, offsets, q)
            hit = np.flatnonzero(fits)
            hit = hit[_among(longer[hit], known)]
            size[hit], code[hit] = q, longer[hit]
        end = np.where(size > 0, np.arange(n) + size, 0)
        before = np.concatenate([[0], np.maximum.accumulate(end)[:-1]]) if n else end
        at = np.flatnonzero((size > 0) & (end > before))
        return at, at + size[at] - 1, code[at]

    def surviving(self, codes: np.ndarray, offsets: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each border between letters (before the first and after the last too): up to which gram of the word all are safe from a
        change just after the border, and from which gram on all are safe from a change just before it.

        A gram before the change stays unless it, or one that begins earlier, may grow over the border: letters up to the border
        that begin a gram of the dictionary. A gram after it stays unless one that begins earlier may cover it: letters from the
        border on that stand inside a gram. So both depend only on the letters of their own side.
        """
        words = len(offsets) - 1
        size = np.diff(offsets) + 1
        word = np.repeat(np.arange(words), size)
        i = np.arange(len(codes) + words) - word  # the place of the letter after each border
        first, last = offsets[word], offsets[word + 1]
        low, high = i.copy(), i - 1
        for k in range(1, self.longest):
            piece, fits = grams_of(codes, offsets, k)
            begin, inner = fits & _among(piece, self.begin[k]), fits & _among(piece, self.inner[k])
            b = np.flatnonzero(i - k >= first)
            b = b[begin[i[b] - k]]
            low[b] = i[b] - k
            b = np.flatnonzero(i + k <= last)
            b = b[inner[i[b]]]
            high[b] = i[b] + k - 1
        start, stop = np.searchsorted(at, first), np.searchsorted(at, last)
        upto = np.minimum(np.searchsorted(at, low), np.searchsorted(end, i))
        since = np.maximum(np.searchsorted(at, i), np.searchsorted(end, high, "right"))
        return np.maximum(upto, start), np.minimum(since, stop)

    def keys(self, codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word, key and kind of the merged lists that each word stands in, and for each word its bound on affected grams.

        For every place of a change, the lists of all grams that it can't affect are merged: the key is a hash of those grams with
        their distances from the beginning (before the change) or the end (after it), and of the letters but the changed one.
        Kind 0 is a letter that is replaced or deleted, kind 1 a border at which one is inserted. Two words that are one change
        apart share a key of kinds 0 and 0 or 0 and 1.
        """
        at, end, code = self.decompose(codes, offsets)
        words, size = len(offsets) - 1, np.diff(offsets)
        upto, since = self.surviving(codes, offsets, at, end)
        own = np.searchsorted(offsets, at, "right") - 1
        wide = code.astype(np.uint64) << np.uint64(20)
        zero = np.zeros(1, np.uint64)
        left = np.concatenate([zero, np.cumsum(mix(wide * np.uint64(3) + (at - offsets[own]).astype(np.uint64)))])
        right = np.concatenate([zero, np.cumsum(mix(wide * np.uint64(5) + (offsets[own + 1] - at).astype(np.uint64)))])
        ranks = np.searchsorted(at, offsets)

        def key(word: np.ndarray, border: np.ndarray, skip: int) -> np.ndarray:
            a = left[upto[border]] - left[ranks[word]]
            b = right[ranks[word + 1]] - right[since[border + skip]]
            return mix(mix(a) * np.uint64(3) + b + (size[word] - skip).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)

        letter_of = np.repeat(np.arange(words), size)
        border = np.arange(len(codes)) + letter_of  # the border before each letter
        border_of = np.repeat(np.arange(words), size + 1)
        lost = since[border + 1] - upto[border]
        most = np.maximum.reduceat(lost, offsets[:-1]) if words else lost
        if (most >= np.diff(ranks)).any():
            raise ValueError("words need at least twice the letters of the longest gram")
        kind = np.repeat([0, 1], [len(letter_of), len(border_of)])
        return np.concatenate([letter_of, border_of]), np.concatenate([key(letter_of, border, 1), key(border_of, np.arange(len(border_of)), 0)]), kind, most


def gram_dictionary(words: DataFrame, longest: int, share: int = SHARE) -> Grams:
    """Grams of up to `longest` letters over a table of words: every gram that begins with one that is frequent in them.

    Grown letter by letter; counts are made for each batch, then summed. Only frequent grams and their continuations reach the
    driver, at most `share` and 90 * `share` of each length.
    """
    by: dict[int, np.ndarray] = {}
    frequent = None
    for q in range(QMIN, longest + 1):

        def count(batches: Iterator[pa.RecordBatch], q=q, frequent=frequent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                codes, offsets = letters(batch.column("word"))
                code, fits = grams_of(codes, offsets, q)
                total = int(fits.sum())
                code = code[fits]
                if frequent is not None:
                    code = code[_among(code >> BITS, frequent)]
                found, n = np.unique(code, return_counts=True)
                yield pa.record_batch([pa.array(np.append(found, -1)), pa.array(np.append(n, total))], ["gram", "n"])

        counts = written(words.select("word").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")), "grams")
        total = counts.where("gram = -1").select("n").first()
        if total is None:
            break
        if q > QMIN:
            by[q] = np.sort(np.array([r.gram for r in counts.where("gram >= 0").select("gram").collect()], np.int64))
        frequent = np.sort(np.array([r.gram for r in counts.where(f"gram >= 0 and n * {share} > {total.n}").select("gram").collect()], np.int64))
        if not len(frequent):
            break
    return Grams(by)


def near_words(words: DataFrame, least: int = LEAST_LETTERS, share: int = SHARE) -> DataFrame:
    """word, near, n, near_n: pairs of different words, each both ways, that one inserted, deleted or replaced letter parts.

    `words` has word (Latin letters, at least `least` of them, no word twice) and n. Grams have at most least // 2 letters, so no
    change can affect all grams of a word. A list's words are compared only with each other, and verified by edit distance; a list
    that many words share is split by Spark's skew join.
    """
    spark = words.sparkSession
    grams = spark.sparkContext.broadcast(gram_dictionary(words, max(QMIN, least // 2), share))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "word", LIST_BYTES):
            word, key, kind, _ = grams.value.keys(*letters(batch.column("word")))
            at = pa.array(word)
            yield pa.record_batch([pa.array(key), pa.array(kind.astype(np.int8)), batch.column("word").take(at), batch.column("n").take(at)], ["key", "kind", "word", "n"])

    lists = written(words.select("word", "n").mapInArrow(index, "key long, kind byte, word string, n long"), "gram-lists")
    a, b = lists.where("kind = 0").drop("kind"), lists.select("key", F.col("kind").alias("k"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    met = a.join(b, "key").where("k = 1 or word < near").where(F.levenshtein("word", "near", 1) == 1).select("word", "near", "n", "near_n")
    both = met.select(F.explode(F.array(F.struct("word", "near", "n", "near_n"), F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("near_n").alias("n"), F.col("n").alias("near_n")))).alias("p")).select("p.*")
    return both.repartition("word").dropDuplicates(["word", "near"])


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last form reached from each word, from word, form. A form has at least TIMES the occurrences of its word, so a
    chain has at most 18 steps; each round doubles the steps taken."""
    found = written(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(5):
        on = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = written(found.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        found = step.select("word", "root")
        if not step.where("moved").head(1):
            break
    return found


def spelling_forms(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", typo: int = 31, least: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n: the words of all texts, and for each its commoner spelling.

    A word's form is its near word of most occurrences (ties: first in order of code points), if it has `times` the word's own, else
    null; root follows forms to the last. Texts that are null or hold no word give no rows; where an id is null, no run is
    changed; rows that repeat an id or a text count each; other columns are ignored; an empty table gives no rows.
    """
    words = written(word_counts(docs, doc_id, text, typo, least, least_count), "words")
    near = near_words(words, least)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near"))).alias("b"))
    out = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(-F.col("b.m") >= F.col("n") * times, F.struct(F.col("b.near").alias("form"), (-F.col("b.m")).alias("form_n"))).alias("f"))
    out = written(out.select("word", "n", "n_near", "f.form", "f.form_n"), "forms")
    last = roots(out.where("form is not null"))
    return out.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents with their commoner spellings."""
    return spelling_forms(table(spark, sf_dir, "documents"))
