"""Operator 9: language identification by cross-parsing with suffix automata of labelled text."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, slices, small_batches, table

#: The bounded sample: characters of text for each language, and the longest document in it.
SAMPLE_CHARS, SAMPLE_DOC = 24_000, 8_000
#: Letters up to which automata that share them are a dense table, bytes of all dense tables, and automata in one model.
ALPHABET, DENSE_BYTES, TOGETHER = 254, 256 << 20, 64
#: Characters of a run, and bytes of what is noted of runs parsed side by side. Neither changes a result.
RUN, NOTED_BYTES = 256, 16 << 20
OTHER = re.compile(r"[\W\d_]+")


def automaton(text: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a coded text, the start state first."""
    move, link, length, last = [{}], [-1], [0], 0
    for c in text.tolist():
        new = len(move)
        move.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in move[p]:
            move[p][c] = new
            p = link[p]
        if p >= 0:
            q = move[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = len(move)
                move.append(dict(move[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and move[p].get(c) == q:
                    move[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return move


def letters_of(text: str) -> set[str]:
    return set(OTHER.sub(" ", text.lower()))


class Model:
    """The automata of some languages as one table: for each state and code, twice the next row, plus 1 where a phrase begins.
    Every letter of the samples has a code; 0 is padding, 1 any other letter. Unless dense, only the automata's own transitions
    are kept, under sorted keys (row and code); the others are those of the start state."""

    def __init__(self, samples: dict[str, str], dense: bool = True):
        self.languages, self.dense = sorted(samples), dense
        letters = sorted(letters_of("".join(samples.values())))
        self.width = len(letters) + 2
        self.codes = np.ones(0x110000, np.uint8 if self.width <= 256 else np.uint32)
        for k, c in enumerate(letters):
            self.codes[ord(c)] = k + 2
        kind = np.int32 if dense else np.int64
        parts, keys, starts, self.dead, self.cost, at = [], [], [], [], [], 0
        for name in self.languages:
            coded = self.coded(samples[name])
            move = automaton(coded[coded > 1])
            n, dead = len(move), (at + len(move)) * self.width
            start = np.full(self.width, dead * 2 + 1, kind)
            for c, to in move[0].items():
                start[c] = (at + to) * self.width * 2 + 1
            start[0] = dead * 2
            if dense:
                rows = np.tile(start, (n + 1, 1))
                for s, m in enumerate(move):
                    for c, to in m.items():
                        rows[s, c] = (at + to) * self.width * 2
                parts.append(rows.ravel())
            else:
                own = [((at + s) * self.width + c, (at + to) * self.width * 2) for s, m in enumerate(move) for c, to in sorted(m.items())]
                keys.append(np.array([k for k, _ in own], np.int64))
                parts.append(np.array([to for _, to in own], np.int64))
                starts.append(start)
            self.dead.append(dead)
            self.cost.append(math.log2(max(2, len(coded))))
            at += n + 1
        self.table = np.concatenate(parts) if parts else np.zeros(0, kind)
        if not dense:
            self.keys, self.starts = np.append(np.concatenate(keys), -1), np.array(starts)

    def step(self, state: np.ndarray, code: np.ndarray, which: np.ndarray) -> np.ndarray:
        """What the table has for each state and next code; which: the state's automaton."""
        if self.dense:
            return self.table.take(state + code)
        key = state + code
        k = np.searchsorted(self.keys[:-1], key)
        return np.where(self.keys[k] == key, self.table[np.minimum(k, len(self.table) - 1)] if len(self.table) else 0, self.starts[which, code])

    def coded(self, text: str) -> np.ndarray:
        """Letters of the lower-cased text, each run of other characters as one space."""
        return self.codes[np.frombuffer(OTHER.sub(" ", text.lower()).encode("utf-32-le", "surrogatepass"), np.uint32)]

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(texts, languages): bits a character, which are phrases of the cross-parse times the bits that name a place in the
        sample; and characters a phrase."""
        coded = [self.coded(t) if t else np.zeros(0, self.codes.dtype) for t in texts]
        size = np.array([len(c) for c in coded], np.int64)
        runs = -(-size // RUN)
        ends = np.cumsum(runs)
        flat = np.zeros((int(runs.sum()), RUN), self.codes.dtype)
        for c, end, n in zip(coded, ends, runs, strict=True):
            flat[end - n : end].reshape(-1)[: len(c)] = c
        first = np.zeros(len(flat), bool)
        some = np.flatnonzero(runs)
        first[(ends - runs)[some]] = True
        phrases, before = np.zeros((len(self.languages), len(flat)), np.int64), np.array(self.dead, self.table.dtype)
        step = max(1, NOTED_BYTES // (RUN * len(self.languages) * (self.table.dtype.itemsize + 2)))
        for a in range(0, len(flat), step):
            phrases[:, a : a + step], before = self._parse(flat[a : a + step], first[a : a + step], before)
        total = np.zeros((len(self.languages), len(texts)), np.int64)
        if len(some):
            total[:, some] = np.add.reduceat(phrases, (ends - runs)[some], axis=1)
        return (total * np.array(self.cost)[:, None] / np.maximum(1, size)).T, (size / np.maximum(1, total)).T

    def _parse(self, runs: np.ndarray, first: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases that begin in each run of one unbroken parse of each text, and the last run's end states.

        All runs are parsed at once as if each began a text, with states and phrases noted at every character. A run that goes on
        from another is then parsed from that one's end state, until it comes to a state that was noted there: from then on both
        parses are the same. Where it never does, the next run has another beginning, and is parsed again.
        """
        columns, n = np.ascontiguousarray(runs.T), len(runs)
        which = np.arange(len(self.languages))[:, None]
        dead = np.array(self.dead, self.table.dtype)
        state = np.repeat(dead[:, None], n, axis=1)
        states, begun, count = np.empty((RUN, *state.shape), self.table.dtype), np.empty((RUN, *state.shape), np.uint16), np.zeros(state.shape, np.uint16)
        for k, column in enumerate(columns):
            got = self.step(state, column, which)
            count += (got & 1).astype(np.uint16)
            state = got >> 1
            states[k], begun[k] = state, count
        phrases, end = begun[-1].astype(np.int64), states[-1].copy()
        lang, run = np.nonzero(np.broadcast_to(~first, state.shape))
        while len(run):
            now = np.where(run > 0, end[lang, run - 1], before[lang])
            own, alive = np.zeros(len(run), np.int64), np.flatnonzero(now != dead[lang])
            phrases[lang, run], new = begun[-1, lang, run], states[-1, lang, run]
            for k in range(RUN):
                if not len(alive):
                    break
                l, r = lang[alive], run[alive]  # noqa: E741
                got = self.step(now[alive], columns[k, r], l)
                now[alive] = got >> 1
                own[alive] += got & 1
                same = now[alive] == states[k, l, r]
                met = alive[same]
                phrases[lang[met], run[met]] += own[met] - begun[k, lang[met], run[met]]
                alive = alive[~same]
            phrases[lang[alive], run[alive]], new[alive] = own[alive], now[alive]
            moved = new != end[lang, run]
            end[lang, run] = new
            moved &= (run + 1 < n) & ~first[np.minimum(run + 1, n - 1)]
            lang, run = lang[moved], run[moved] + 1
        return phrases, end[:, -1]


def models(samples: dict[str, str]) -> list[Model]:
    """Automata of all languages, by name in runs that share an alphabet: dense tables as far as letters and bytes go, else sparse."""
    groups, left = [], DENSE_BYTES
    for name in sorted(samples):
        letters, states = letters_of(samples[name]), 2 * len(samples[name]) + 2
        if groups and len(groups[-1][0]) < TOGETHER:
            names, has, n, dense = groups[-1]
            more = (len(has | letters) + 2) * (n + states) * 4
            if not dense and (len(letters) > ALPHABET or left < (len(letters) + 2) * states * 4) or dense and len(has | letters) <= ALPHABET and more - (len(has) + 2) * n * 4 <= left:
                left -= (more - (len(has) + 2) * n * 4) if dense else 0
                groups[-1] = ([*names, name], has | letters, n + states, dense)
                continue
        dense = len(letters) <= ALPHABET and (len(letters) + 2) * states * 4 <= left
        left -= (len(letters) + 2) * states * 4 if dense else 0
        groups.append(([name], letters, states, dense))
    return [Model({n: samples[n] for n in names}, dense) for names, _, _, dense in groups]


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", chars: int = SAMPLE_CHARS, longest: int = SAMPLE_DOC) -> list[Model]:
    """Fit on a bounded sample of every label: whole documents in the order of a hash of their id, of up to `longest` characters
    each (the first of any length if a language has none), until `chars` characters are met."""
    spark = docs.sparkSession
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(doc_id).cast("string")).alias("h"))
    short = F.length("text") <= longest
    # median length is unknown, so each language's share is set by the characters it has
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.when(short, F.length("text"))).alias("c"), F.min_by(F.substring("text", 1, chars), F.struct(F.length("text"), "h")).alias("one"))
    found = sizes.orderBy(F.desc("n"), "lang").collect()
    samples = {r.lang: r.one for r in found}
    shares = {r.lang: min(1.0, 4 * chars / r.c) for r in found if r.c}
    if shares:
        share = F.broadcast(spark.createDataFrame(list(shares.items()), "lang string, share double"))
        hit = rows.where(short).join(share, "lang").where(F.pmod("h", F.lit(1 << 30)) < F.col("share") * (1 << 30))
        for name in shares:
            samples[name] = ""
        for r in hit.select("lang", "text", "h").orderBy("h", "text").limit(len(shares) * 4 * chars).collect():  # about 4 * chars characters of each
            if len(samples[r.lang]) < chars:
                samples[r.lang] += r.text + "\n"
        samples |= {r.lang: r.one for r in found if not samples[r.lang]}
    return models({k: v[:chars] for k, v in samples.items()})


def identify(docs: DataFrame, model: list[Model], text: str = "text") -> DataFrame:
    """Add lang_pred, the language with the least cross-parsing entropy (the first by name of equal ones), and score, by what share
    it undercuts the second (1 if only one was learned), and phrase_chars, the characters a phrase of that language's parse. Whole
    texts are parsed, each in one unbroken parse. Texts that are null or hold no letter are `und` with score 0, as is all if nothing
    was learned. Columns stay; those of these three names are replaced."""
    docs = docs.drop("lang_pred", "score", "phrase_chars")
    small_batches(docs.sparkSession)
    held = [docs.sparkSession.sparkContext.broadcast(m) for m in model]
    languages = np.array([name for m in model for name in m.languages], object)
    by_name = np.argsort(languages, kind="stable")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            if not len(languages):
                best, score, long = ["und"] * batch.num_rows, np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            else:
                texts = batch.column(text).to_pylist()
                e, chars = (np.concatenate(x, axis=1)[:, by_name] for x in zip(*(m.value.entropies(texts) for m in held), strict=True))
                at = e.argmin(axis=1)
                best, long = languages[by_name][at].tolist(), chars[np.arange(len(at)), at]
                two = np.sort(e, axis=1)[:, :2]
                score = 1 - two[:, 0] / np.maximum(two[:, 1], 1e-12) if e.shape[1] > 1 else np.ones(len(e))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(long)], [*batch.schema.names, "lang_pred", "score", "phrase_chars"])

    found = docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("phrase_chars", T.DoubleType())]))
    letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return found.withColumn("lang_pred", F.when(letter, F.col("lang_pred")).otherwise(F.lit("und"))).withColumn("score", F.when(letter, F.col("score")).otherwise(F.lit(0.0)))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its predicted language; labels of fold 2 of 4 are never seen."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", 4) == 2)
    model = learn(docs.where(~F.col("held_out") & F.col("doc_id").isNotNull()))
    return identify(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")
