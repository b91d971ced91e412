"""Operator 5: toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM, fold, slices, table, words

#: The bounded sample: about so many labelled documents of each label.
SAMPLE = 4_000
#: Terms are hashed to so many bits; every term of the sample is a feature, whatever its share under either label.
BITS = 19
#: Terms of a word: itself, and its first 4, 5 and 6 bytes if it is longer, which also meet inflected and padded forms.
PREFIXES = (4, 5, 6)
FACTORS, THRESHOLD, BATCH = 8, 0.7, 128
#: Passes that pick weights under L1, that fit those picked, and that fit factors; the least loss on held-back documents ends the last.
PICK, REFIT, PAIRS = 6, 60, 8
#: Steps of weights and factors, pressure of L1 and L2, spread of the factors' beginning, share of the sample held back.
RATE, PAIR_RATE, L1, L2, SPREAD, HELD = 0.1, 0.2, 8e-3, 1e-4, 0.3, 0.1


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each different term of each text."""
    w = words(texts, ALNUM)
    doc, size = np.repeat(np.arange(len(w.per_text)), w.per_text), w.end - w.start
    rows, hashes = [doc], [w.hashes()]
    for n in PREFIXES:
        part = size > n
        rows.append(doc[part])
        hashes.append(_salted(w.hashes(n)[part], n))
    return np.concatenate(rows), np.concatenate(hashes)


def _salted(h: np.ndarray, n: int) -> np.ndarray:
    return h ^ np.uint64(n * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)


class Rows:
    """The features of some documents: doc ascending, term its hashed terms, each once."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, n: int):
        self.doc, self.term, self.n = doc.astype(np.int32, copy=False), term.astype(np.int32, copy=False), n

    @classmethod
    def of(cls, texts: pa.Array) -> Rows:
        doc, h = _terms(texts)
        pair = np.unique(doc << BITS | (h >> np.uint64(64 - BITS)).astype(np.int64))
        return cls(pair >> BITS, pair & ((1 << BITS) - 1), len(texts))

    def only(self, docs: np.ndarray | None = None, terms: np.ndarray | None = None) -> Rows:
        """The documents numbered (ascending), or the terms flagged."""
        if terms is not None:
            keep = terms[self.term]
            return Rows(self.doc[keep], self.term[keep], self.n)
        new = np.full(self.n, -1, np.int32)
        new[docs] = np.arange(len(docs))
        keep = new[self.doc] >= 0
        return Rows(new[self.doc[keep]], self.term[keep], len(docs))

    def batches(self, rng: np.random.Generator) -> list[tuple]:
        """Random batches: documents, row in the batch, distinct terms, and which of them each feature is."""
        first, order, out = np.searchsorted(self.doc, np.arange(self.n + 1)), rng.permutation(self.n), []
        for a in range(0, self.n, BATCH):
            mine = order[a : a + BATCH]
            size = first[mine + 1] - first[mine]
            upto = np.cumsum(size)
            t = self.term[np.repeat(first[mine] - upto + size, size) + np.arange(upto[-1])]
            some, which = np.unique(t, return_inverse=True)
            out.append((mine, np.repeat(np.arange(len(mine), dtype=np.int32), size), some, which.astype(np.int32)))
        return out


def _chance(out: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


class Machine:
    """P(label 1) of a set of k terms: sigmoid(bias + sum of weights + sum over pairs of the product of their factors / k)."""

    def __init__(self, bias: float = 0.0):
        self.bias, self.weights, self.factors = bias, np.zeros(1 << BITS, np.float32), None

    def logits(self, x: Rows) -> np.ndarray:
        out = self.bias + np.bincount(x.doc, self.weights[x.term], x.n)
        if self.factors is None or not len(x.term):
            return out
        begin = np.flatnonzero(np.diff(x.doc, prepend=-1))  # one for each document with terms
        f = self.factors[x.term]
        pairs = (np.add.reduceat(f, begin, dtype=np.float64) ** 2).sum(1) - np.add.reduceat((f**2).sum(1), begin, dtype=np.float64)
        out[x.doc[begin]] += 0.5 * pairs / np.diff(np.append(begin, len(x.doc)))
        return out

    def loss(self, x: Rows, y: np.ndarray) -> float:
        out = self.logits(x)
        return float(np.mean(np.logaddexp(0, out) - y * out))

    def fit(self, x: Rows, y: np.ndarray, seed: int = 7) -> None:
        """Adagrad on the log loss. Weights first, under L1, so that few terms have one; these again without it; then the factors of
        every term beside them. What is kept is what held-back documents are scored best by, the label's share alone included."""
        rng = np.random.default_rng(seed)
        held = rng.random(x.n) < HELD
        if not 0 < y[~held].mean() < 1 or held.sum() < 20:
            held[:] = False
        inner, outer = np.flatnonzero(~held), np.flatnonzero(held if held.any() else ~held)
        rest, y_rest, check, y_check = x.only(inner), y[inner], x.only(outer), y[outer]
        plain = Machine(float(np.log(y_rest.mean() / (1 - y_rest.mean()))))
        best = [plain.loss(check, y_check), plain.bias, plain.weights.copy(), None]
        batches = rest.batches(rng)
        self._weights(batches, y_rest, rng, PICK, L1, 0.0)
        picked = self.weights != 0
        self._weights(rest.only(terms=picked).batches(rng), y_rest, rng, REFIT, 0.0, L2)
        if (loss := self.loss(check, y_check)) < best[0]:
            best = [loss, self.bias, self.weights.copy(), None]
        else:
            self.bias, self.weights, picked = plain.bias, plain.weights, picked & False
        there = np.zeros(1 << BITS, bool)
        there[rest.term] = True
        self.factors = rng.standard_normal((1 << BITS, FACTORS), np.float32) * np.float32(SPREAD) * there[:, None]
        steps = np.full(1 << BITS, 1e-4), np.full(1 << BITS, 1e-6)
        for _ in range(PAIRS):
            self._pairs(batches, y_rest, rng, picked, steps)
            if (loss := self.loss(check, y_check)) < best[0]:
                best = [loss, self.bias, self.weights.copy(), self.factors.copy()]
        _, self.bias, self.weights, self.factors = best

    def _weights(self, batches: list[tuple], y: np.ndarray, rng: np.random.Generator, passes: int, l1: float, l2: float) -> None:
        past, past_bias = np.full(1 << BITS, 1e-4), 1e-4
        for _ in range(passes):
            for k in rng.permutation(len(batches)):
                mine, row, some, which = batches[k]
                w, n = self.weights[some].astype(float), len(mine)
                error = _chance(self.bias + np.bincount(row, w[which], n)) - y[mine]
                g = np.bincount(which, error[row], len(some)) / n + l2 * w
                past[some] += g**2
                step = RATE / np.sqrt(past[some])
                w -= step * g
                self.weights[some] = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
                past_bias += error.mean() ** 2
                self.bias -= RATE * error.mean() / np.sqrt(past_bias)

    def _pairs(self, batches: list[tuple], y: np.ndarray, rng: np.random.Generator, picked: np.ndarray, steps: tuple[np.ndarray, np.ndarray]) -> None:
        """One pass over factors, and over the weights that are picked."""
        past, past_pairs = steps
        for k in rng.permutation(len(batches)):
            mine, row, some, which = batches[k]
            f, n = self.factors[some].astype(float), len(mine)
            size = np.maximum(np.bincount(row, minlength=n), 1)
            sums = np.stack([np.bincount(row, f[which, j], n) for j in range(FACTORS)], 1)
            pairs = 0.5 * ((sums**2).sum(1) - np.bincount(row, (f**2).sum(1)[which], n)) / size
            error = _chance(self.bias + np.bincount(row, self.weights[some][which], n) + pairs) - y[mine]
            share = (error / size)[row]
            g = np.stack([np.bincount(which, share * sums[row, j], len(some)) for j in range(FACTORS)], 1) / n
            g += (L2 - np.bincount(which, share, len(some)) / n)[:, None] * f
            past_pairs[some] += (g**2).mean(1)
            self.factors[some] = f - PAIR_RATE * g / np.sqrt(past_pairs[some])[:, None]
            own = picked[some]
            if own.any():
                w = self.weights[some]
                g = (np.bincount(which, error[row], len(some)) / n + L2 * w) * own
                past[some] += g**2
                self.weights[some] = w - RATE * g / np.sqrt(past[some])
            self.bias -= 0.1 * RATE * error.mean()


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", sample: int = SAMPLE) -> Machine:
    """Fit on a bounded sample: of each label about `sample` labelled documents by a hash of their id, of their whole texts.

    Tasks hash the terms of the sampled documents, and their numbers, 4 bytes each, come to the driver, which fits the machine. Every
    term is a feature of 2**BITS, so a term that tells only beside another counts too. Rows with null id, label or text teach nothing;
    an id with several labels counts once, as the largest of them; with no labelled row, or rows of one label only, every score is
    the label's smoothed share.
    """
    given = labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(label).alias("y"))
    n = {r.y: r.n for r in given.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    share = F.when(F.col("y") == 1, min(1.0, sample / max(1, n1))).otherwise(min(1.0, sample / max(1, n0)))
    some = given.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))  # about 2 * sample rows of two numbers
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("text is not null").join(F.broadcast(some), "doc_id")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = Rows.of(batch.column("text"))
            cut = np.searchsorted(x.doc, np.arange(x.n + 1))
            yield pa.record_batch([batch.column("y").cast(pa.int32()), pa.array([x.term[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)], pa.binary())], ["y", "terms"])

    got = sorted(tuple(r) for r in rows.select("text", "y").mapInArrow(features, "y int, terms binary").collect())
    y = np.array([r[0] for r in got], float)
    machine = Machine(float(np.log((n1 + 1) / (n0 + 1))))
    if not len(got) or y.min() == y.max():
        return machine
    size = np.array([len(r[1]) // 4 for r in got])
    terms = np.frombuffer(b"".join(r[1] for r in got), np.int32)
    del got
    machine.fit(Rows(np.repeat(np.arange(len(size), dtype=np.int32), size), terms, len(size)), y)
    machine.bias += float(np.log((n1 / n0) / (y.mean() / (1 - y.mean()))))  # labels aren't sampled in proportion
    return machine


def score(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """Add score, the machine's probability of label 1 for the whole text; texts without known terms, null and empty ones too, get
    that of the bias alone. Columns stay; one called score is replaced."""
    docs = docs.drop("score")
    held = docs.sparkSession.sparkContext.broadcast(machine)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = _chance(held.value.logits(Rows.of(batch.column(text))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, "score"])

    return docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its toxicity; labels of fold 1 of 3 are never seen."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", fold("doc_id", 3) == 1)
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 3) != 1)
    machine = learn(docs.where(~F.col("held_out")), labels)
    found = score(docs, machine)
    return found.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
