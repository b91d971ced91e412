"""Operators 11 to 13 against brute force, and with nulls, ties, repeated rows, empty tables, long texts and clashing columns."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tellurion.llm import bpe, negatives, packing, spelling

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- 11


def mined(rows, every, positives, negatives_, low=50, high=95, scale=256):
    """Plain Python: rows are (id, label, vector)."""
    good = [(k, i, lab, [math.floor(scale * x) for x in v]) for k, (i, lab, v) in enumerate(rows) if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for k, i, lab, v in good:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, m, other) for m, j, other, w in good if m != k and len(w) == len(v))
        for s, j, _, _ in [x for x in scored if x[3] == lab][:positives]:
            hit = [x for x in scored if x[3] != lab and low * -s <= 100 * -x[0] <= high * -s][:negatives_]
            out += [(i, j, r + 1, x[1], -s, -x[0]) for r, x in enumerate(hit)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["random", "ties", "low energy", "large", "very large"])
def test_hard_negatives(spark, kind, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 40)
    monkeypatch.setattr(negatives, "ANCHORS", 17)
    monkeypatch.setattr(negatives, "STRIP", 5)
    monkeypatch.setattr(negatives, "SEED", 3)
    rng = np.random.default_rng(7)
    v = rng.normal(size=(300, 8))
    if kind == "ties":
        v = rng.integers(0, 2, (300, 8)) / 4
    if kind == "low energy":
        v[:, 2:] *= 0.001
    if kind == "large":
        v *= 3e4
    if kind == "very large":
        v *= 5e5
    labels = np.where(rng.random(300) < 0.4, 0, rng.integers(0, 5, 300))
    rows = [(i, int(a), x) for i, (a, x) in enumerate(zip(labels, v.tolist(), strict=True))]
    rows += [(None, 1, v[0].tolist()), (3, None, v[1].tolist()), (4, 1, None), (10, 2, [None] + v[2].tolist()[1:]), (20, 2, [float("nan")] * 8), (30, 2, [float("inf")] * 8), (40, 1, [1.0, 2.0]), (50, 1, [1.0, 2.5]), (51, 2, [0.5, 1.5]), (52, 3, []), rows[10]]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumns({n: F.lit("mine") for n in ("key", "window", "codes", "dim", "score", "rank")}).repartition(3)
    got = sorted(tuple(r) for r in negatives.hard_negatives(df, every=10).collect())
    assert got == mined(rows, 10, 5, 3) and len(got) > 100


def test_hard_negatives_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert negatives.hard_negatives(df).count() == 0
    alone = spark.createDataFrame([(0, 1, [1.0]), (50, 2, [1.0])], "vec_id long, label int, embedding array<float>")
    assert negatives.hard_negatives(alone).count() == 0  # no positives


# ---------------------------------------------------------------- 12

RUNS = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def apart_by_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k:] == b[k + 1 :] or (len(a) == len(b) and a[k + 1 :] == b[k + 1 :])


def forms(rows):
    n = Counter()
    for d, text in rows:
        for run in RUNS.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{d}:{run}".encode())
            if d is not None and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    near = {w: [o for o in n if apart_by_one(w, o)] for w in n}
    form = {}
    for w in n:
        best = min(((-n[o], o) for o in near[w]), default=None)
        form[w] = best[1] if best and -best[0] >= 10 * n[w] else None
    out = []
    for w in n:
        last = w
        while form[last]:
            last = form[last]
        out.append((w, form[w], last, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def test_spelling_forms(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abeÀÿzZ") for _ in range(rng.randint(6, 11))) for _ in range(25)] + ["x" * 3000]
    words = []
    for w in base:
        words += [w] * rng.choice([2, 30, 400])
        for _ in range(6):
            i = rng.randrange(len(w) + 1)
            words += [rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abÀ") + w[i + 1 :], w[:i] + rng.choice("bzÿ") + w[i:]])] * rng.choice([1, 2, 3, 40])
    rng.shuffle(words)
    rows = [(i, " ".join(words[i::40]) + rng.choice([".", "-", "ā", "\x00"])) for i in range(40)]
    rows += [(None, "Abracadabra abracadabra"), (7, rows[7][1]), (100, None), (101, ""), (102, "1234 中文 µ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit("mine") for n in ("word", "n", "key", "form", "root")}).repartition(3)
    got = sorted((tuple(r) for r in spelling.spelling_forms(df).select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)
    assert got == forms(rows)
    assert any(r[1] and r[1] != r[2] for r in got) or any(r[1] for r in got)
    assert spelling.spelling_forms(df.limit(0)).count() == 0


def test_spelling_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in spelling.op12_spelling(spark, SF).select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)
    assert got == forms(rows)


def test_chains_of_forms(spark):
    links = [("w%02d" % k, "w%02d" % (k + 1)) for k in range(18)] + [("other", "w03")]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(links, "word string, form string")).collect()}
    assert got == {w: "w18" for w, _ in links}


@settings(deadline=None, max_examples=60)
@given(st.lists(st.text(alphabet="abà", min_size=7, max_size=10), min_size=2, max_size=30, unique=True), st.sampled_from([1, 5, 30, 10**6]))
def test_near_words_share_a_list(words, share):
    codes, offsets = spelling.letters(pa.array(words))
    two, fits = spelling.grams_of(codes, offsets, 2)
    found, n = np.unique(two[fits], return_counts=True)
    three, fits = spelling.grams_of(codes, offsets, 3)
    known = np.unique(three[fits & spelling._among(three >> spelling.BITS, found[n * share > fits.sum()])])
    word, key, kind, _ = spelling.Grams({3: known}).keys(codes, offsets)
    lists = defaultdict(set)
    for w, k, t in zip(word.tolist(), key.tolist(), kind.tolist(), strict=True):
        lists[w, t].add(k)
    for a, b in itertools.combinations(range(len(words)), 2):
        if apart_by_one(words[a], words[b]):
            assert lists[a, 0] & lists[b, 0] or lists[a, 0] & lists[b, 1] or lists[a, 1] & lists[b, 0]


# ---------------------------------------------------------------- 13


@settings(deadline=None, max_examples=80)
@given(st.lists(st.text(alphabet="aZé'’ \t\x00\x1c\u0085İß1²!…ś日", max_size=25) | st.sampled_from(["<|endoftext|>", "it's we'LL 'Tis x'sword", None, "x" * 300]), max_size=5))
def test_words_encode_as_texts(texts):
    got, n = ENCODER.encode(pa.array(texts, pa.string()))
    want = [ENCODER.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert ENCODER.by_piece and n.tolist() == [len(w) for w in want] and got.tolist() == [i for w in want for i in w]


ENCODER = bpe.WordEncoder(VOCABULARY)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_best_fit_decreasing(lengths):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = min((r, k) for k, r in enumerate(rooms) if r >= n)[1] if any(r >= n for r in rooms) else None
        if fit is None:
            rooms.append(64 - n)
        else:
            rooms[fit] -= n
    windows = packing.best_fit(np.array(lengths, np.int64), 64)
    assert sorted(r for r, _ in windows) == sorted(rooms)
    assert sorted(k for _, p in windows for k in p) == list(range(len(lengths)))
    assert all(sum(lengths[k] for k in p) == 64 - r for r, p in windows)


def check_pieces(rows, pieces, ids, window):
    """Every id of every document in just one piece, pieces gapless in their sequences; the padding."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p.doc_id, p.doc_tokens].append(p)
        sequences[p.sequence_id].append(p)
    want = Counter((d, len(x)) for d, x in zip(rows, ids, strict=True))
    assert set(docs) == set(want)
    for (d, n), some in docs.items():
        assert sum(p.length for p in some) == n * want[d, n]
    for some in sequences.values():
        at = 0
        for p in sorted(some, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
    return sum(packing.padding(sum(p.length for p in s), window) for s in sequences.values())


@pytest.mark.parametrize("block", [200, 1 << 22])
def test_packing(spark, block):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["the", "Zebra", "naïve", "x1!", "don't"]) for _ in range(rng.choice([0, 1, 5, 30, 100, 400])))) for i in range(150)]
    rows += [(None, "null id"), (1000, None), (1001, ""), (1002, "word " * 3000), (5, rows[5][1]), (1003, " ".join(["a"] * 63))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit("mine") for n in ("ids", "pieces", "start", "sequence_id")}).repartition(3)
    tokenizer = Tokenizer.from_file(VOCABULARY)
    ids = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for _, t in rows]
    made = packing.pack_documents(df, VOCABULARY, window=64, block_ids=block).persist()
    pieces = packing.packed_pieces(made).collect()
    total = sum(len(x) for x in ids)
    assert check_pieces([d for d, _ in rows], pieces, ids, 64) <= total / 64
    by = dict(zip((d for d, _ in rows), ids, strict=True))
    for p in pieces:
        assert p.ids_crc32 == zlib.crc32(by[p.doc_id][p.start : p.start + p.length].tobytes())
    for s in made.collect():
        got = np.frombuffer(bytes(s.ids), f"<u{s.id_bytes}")
        assert len(got) == s.n_ids + packing.padding(s.n_ids, 64) and (got[s.n_ids :] == 0).all()
    made.unpersist()
    assert packing.pack_documents(df.limit(0), VOCABULARY).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(df, VOCABULARY, window=100)


def test_packing_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    tokenizer = Tokenizer.from_file(VOCABULARY)
    ids = [np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4") for r in docs]
    pieces = packing.op13_packing(spark, SF).collect()
    assert check_pieces([r.doc_id for r in docs], pieces, ids, 2048) < 0.01 * sum(len(x) for x in ids)
    by = {r.doc_id: x for r, x in zip(docs, ids, strict=True)}
    assert all(p.ids_crc32 == zlib.crc32(by[p.doc_id][p.start : p.start + p.length].tobytes()) for p in pieces)


# ---------------------------------------------------------------- 10


def test_one_large_page_leaves_other_archives_alone(spark, tmp_path):
    from tellurion.llm import warc

    sizes = [100] * 50 + [40_000] * 60 + [300_000] * 4 + [20_000_000]
    pages = spark.createDataFrame([(i, f"u{i}", n) for i, n in enumerate(sizes)], "page_id long, url string, n int").coalesce(2)
    pages = pages.select("page_id", "url", F.expr("repeat(chr(65 + int(page_id % 26)), n - 5) || lpad(string(page_id), 5, '0')").alias("html"))
    warc.write_warc(pages, str(tmp_path / "w"))
    assert len(list((tmp_path / "w").rglob("*.gz"))) <= 8  # a file of each size class for each task
    got = warc.resolved(warc.read_warc(spark, str(tmp_path / "w"), payload=False)).collect()
    assert sorted((r.page_id, r.payload_bytes) for r in got) == list(enumerate(sizes))


# ---------------------------------------------------------------- 1


def test_items_without_an_id_count(spark):
    from tellurion.llm import decontaminate

    docs = spark.createDataFrame([(1, "x " + "a b c d e f g h i j k"), (2, "lone words"), (3, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "A B C D E F G H I J"), ("q", "b c d e f g h i j k"), (None, None), ("p", "lone")], "item_id string, text string")
    for block in (1 << 20, 12):
        got = {r.doc_id: r for r in decontaminate.benchmark_hits(docs, bench, block_bytes=block).collect()}
        assert [tuple(x) for x in got[1].spans] == [(1, 12)] and sorted(got[1]["items"], key=str) == [None, "q"]
        assert got[2]["items"] == ["p"] and not got[3].spans
    assert [r.doc_id for r in decontaminate.without_hits(docs, bench).collect()] == [3]
