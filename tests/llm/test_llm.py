"""The ten operators on small tables: brute force, round trips, held-out accuracy, and rows with nulls, ties and clashing columns."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tellurion.llm import decontaminate, embeddings, katz, langid, mixing, queries, rollup, simhash, token_ids, toxicity, warc
from tellurion.llm.common import SPACED, connected_components, words

SF = "/root/testdata/sf0.001"
TOKENIZER = __import__("public_tokenizers").path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty, blank and long texts, repeated rows, columns of clashing names."""
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, " \t\n", None, "s", 3), (None, "The cat", "en", None, 7), (5, "x" * 200_000, "en", "s", 1), (6, "a\x00b ÄÖ 日本 !?", "de", "s", 1), (6, "a\x00b ÄÖ 日本 !?", "de", "s", 1), (7, "word " * 30_000, "en", "s", 1)]
    clash = {n: F.lit("mine") for n in ("spans", "items", "fp", "score", "lang_pred", "tokens", "topic", "weight", "kept", "probability", "n_words")}
    return spark.createDataFrame(rows, DOCS).withColumns(clash)


def classes(links, ids):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@settings(deadline=None, max_examples=40)
@given(st.lists(st.text(alphabet="aZ \t\x00 é日1-", max_size=20), max_size=6))
def test_words_match_the_pattern(texts):
    w = words(pa.array(texts, pa.string()), SPACED)
    want = [re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), t.encode())) for t in texts]
    got = [[w.text(i, i + 1).replace(b"\xff", b"\x00") for i in range(w.first[d], w.first[d + 1])] for d in range(len(texts))]
    assert got == want
    flat = [x for t in want for x in t]
    assert len(set(w.hashes().tolist())) == len(set(flat))


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(5, 5)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = classes(links, {x for p in links for x in p})
    assert all(got.get(i, i) == c for i, c in want.items())
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_twins(spark, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "labels", "pages"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    r = c.execute(queries.oracle_sql()[name])
    names = [x[0] for x in r.description]
    df = queries.queries()[name](spark, SF)
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(str, df.select(*names).collect())) == sorted(map(str, (df.select(*names).collect()[0].__class__(**dict(zip(names, x, strict=True))) for x in r.fetchall())))


# ---------------------------------------------------------------- 1


def test_decontamination_in_blocks_and_odd_rows(spark, odd):
    bench = spark.createDataFrame([(1, "the cat"), (2, None), (3, ""), (4, "ÄÖ 日本"), (5, "word " * 12)], "item_id long, text string")
    one = decontaminate.benchmark_hits(odd, bench).select("doc_id", "n_words", "spans", "items")
    many = decontaminate.benchmark_hits(odd, bench, block_bytes=20).select("doc_id", "n_words", "spans", "items")
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
    got = {r.doc_id: r for r in one.collect()}
    assert got[None]["items"] == ["1"] and got[6]["items"] == ["4"] and got[7]["items"] == ["5"] and got[1].n_words == 0
    assert [tuple(s) for s in got[7].spans] == [(0, 30_000)]
    assert set(decontaminate.without_hits(odd, bench).columns) == set(odd.columns)
    d = spark.createDataFrame([(1, "Say: The CAT, sat.")], "doc_id long, text string")
    assert decontaminate.without_hits(d, bench, how="spans").first().text == "Say: , sat."
    assert decontaminate.benchmark_hits(odd, bench.limit(0)).where("size(items) > 0").count() == 0


# ---------------------------------------------------------------- 2


@settings(deadline=None, max_examples=40)
@given(st.lists(st.integers(0, 10**12), max_size=700), st.booleans())
def test_elias_fano(values, dense):
    v = np.sort(np.array([x % 900 for x in values] if dense else values, np.int64))
    e, end = token_ids.EliasFano.unpack(b"-" + (raw := token_ids.EliasFano.encode(v).pack()), 1)
    assert end == len(raw) + 1 and e.all().tolist() == v.tolist() and [e[i] for i in range(len(v))] == v.tolist()


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(0, 2**62), max_size=700), st.integers(0, 62))
def test_select_of_many_places(values, shift):
    v = np.sort(np.array([x >> shift for x in values], np.int64))
    i = np.random.default_rng(len(v)).integers(0, max(1, len(v)), len(v))
    assert token_ids.EliasFano.encode(v).select(i).tolist() == v[i].tolist()


def test_shards_are_read_by_select(spark, odd, tmp_path, monkeypatch):
    """Runs of two documents, across the null ids, without a table of all boundaries."""
    token_ids.write_token_ids(odd, str(tmp_path / "t"), TOKENIZER, shard_ids=1000)
    monkeypatch.setattr(token_ids, "BATCH_ROWS", 2)
    for r in spark.read.parquet(str(tmp_path / "t")).collect():
        s = token_ids.Shard(bytes(r.shard))
        names, bounds = [s.doc_id(i) for i in range(len(s))], s.bounds.all().tolist()
        with monkeypatch.context() as m:
            m.delattr(token_ids.EliasFano, "all")
            got = list(token_ids._documents(s))
        assert [x for n, _ in got for x in n] == names and [x for _, b in got for x in b[:-1].tolist()] == bounds[:-1] and all(len(n) <= 2 for n, _ in got)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.text(alphabet="ab'stremvlSD  \n\t é1２.,!　日\U0001f600\u0085", max_size=30), max_size=5))
def test_pieces_encode_as_the_library_does(texts):
    enc = token_ids.encoder(TOKENIZER)
    ids, n = enc.encode(pa.array(texts, pa.string()))
    want = [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == [x for w in want for x in w]


def test_token_round_trip(spark, odd, tmp_path):
    enc = token_ids.encoder(TOKENIZER).tokenizer
    token_ids.write_token_ids(odd, str(tmp_path / "t"), TOKENIZER, shard_ids=1000)
    got = sorted(map(tuple, token_ids.read_token_ids(spark, str(tmp_path / "t")).collect()), key=lambda r: r[1])
    want = sorted(((r.doc_id, enc.encode(r.text or "", add_special_tokens=False).ids + [2]) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [(d, ids) for d, _, _, ids in got] == want
    assert [s for _, s, _, _ in got] == np.cumsum([0] + [len(w[1]) for w in want])[:-1].tolist()
    token_ids.write_token_ids(odd.limit(0), str(tmp_path / "none"), TOKENIZER)
    assert token_ids.read_token_index(spark, str(tmp_path / "none")).count() == 0


# ---------------------------------------------------------------- 3


def test_rollup_commits_are_idempotent(spark, tmp_path):
    r = rollup.Rollup(spark, str(tmp_path / "r"))
    kind = "op string, source string, lang string, tokenizer string, tokens long, old_tokens long"
    first = spark.createDataFrame([("insert", "a", "en", "t", 5, None), ("insert", None, "en", "t", 3, None), ("insert", "a", "en", "t", None, None), (None, "a", "en", "t", 9, 9)], kind)
    assert r.commit("b1", first) and not r.commit("b1", first)
    first.limit(1).selectExpr("source", "lang", "tokenizer", "1L docs", "99L tokens", "'b2' batch").write.parquet(str(tmp_path / "r/deltas/id=b2"))  # broken off before its commit
    assert r.commit("b3", spark.createDataFrame([("delete", None, "en", "t", 3, None), ("revise", "a", "en", "t", 9, 5)], kind))
    want = [("a", "en", "t", 2, 9)]
    assert [tuple(x) for x in r.totals().collect()] == want
    assert r.compact("c1") and [tuple(x) for x in r.totals().collect()] == want
    assert r.commit("b2", first.limit(1)) and [tuple(x) for x in r.totals().collect()] == [("a", "en", "t", 3, 14)]


def test_a_batch_committed_during_compaction_counts_once(spark, tmp_path, monkeypatch):
    r = rollup.Rollup(spark, f"file://{tmp_path}/r")
    row = lambda n: spark.createDataFrame([("insert", "a", "en", "v1", n, None)], "op string, source string, lang string, tokenizer string, tokens long, old_tokens long")
    r.commit("1", row(5))
    inner = r.totals

    def late(live=None):
        r.commit("2", row(7))  # another writer, after the batches to put together were listed
        return inner(live)

    monkeypatch.setattr(r, "totals", late)
    r.compact("all")
    monkeypatch.undo()
    assert [(x.docs, x.tokens) for x in r.totals().collect()] == [(2, 12)] and r.live() == ["2", "all"]


def test_counts_by_public_vocabularies(spark, odd):
    from tokenizers import Tokenizer

    paths = {n: __import__("public_tokenizers").path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k")}
    got = {(r.doc_id, r.tokenizer): r.tokens for r in rollup.counted_by(odd.drop("source", "tokens").withColumn("source", F.lit("s")), paths).collect()}
    for name, path in paths.items():
        t = Tokenizer.from_file(path)
        for r in odd.collect():
            assert got[(r.doc_id, name)] == len(t.encode(r.text or "", add_special_tokens=False).ids)


def test_changes_lead_from_old_to_new(spark, tmp_path):
    kind = "doc_id long, source string, lang string, tokenizer string, tokens long"
    old = spark.createDataFrame([(1, "a", "en", "t", 5), (2, "a", None, "t", 6), (3, "b", "en", "t", 7)], kind)
    new = spark.createDataFrame([(1, "a", "en", "t", 8), (2, "b", None, "t", 6), (4, "b", "en", "t", 1)], kind)
    r = rollup.Rollup(spark, str(tmp_path / "r"))
    r.commit("old", rollup.changes_between(old.limit(0), old))
    r.commit("new", rollup.changes_between(old, new))
    assert sorted(map(str, r.totals().collect())) == sorted(map(str, new.groupBy("source", "lang", "tokenizer").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens")).collect()))


# ---------------------------------------------------------------- 4


def test_vectors_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16))
    v = [(i, [float(x) for x in centres[i % 40] + rng.normal(size=16) * (0.05, 0.2, 0.6)[i % 3]]) for i in range(900)]
    v += [(2000 + i, v[7][1]) for i in range(50)] + [(3000, None), (3001, [0.0] * 16), (3002, [float("nan")] + [1.0] * 15), (3003, [None] + [1.0] * 15), (3004, []), (None, v[7][1]), (3005, [float("inf")] * 16)]
    for block in (embeddings.BLOCK, 128):
        monkeypatch.setattr(embeddings, "BLOCK", block)
        got = {r.vec_id: r for r in embeddings.near_vectors(spark.createDataFrame(v, "vec_id long, embedding array<double>")).collect()}
        good = [(i, np.array(e)) for i, e in v if i is not None and i < 3000]
        u = np.array([e / np.linalg.norm(e) for _, e in good])
        near, ids = u @ u.T >= 0.95, [i for i, _ in good]
        want = classes([(ids[a], ids[b]) for a, b in zip(*np.nonzero(near), strict=True)], ids)
        assert all(got[i].n_links == near[k].sum() - 1 and got[i].component_id == want[i] and got[i].kept == (i == want[i]) for k, i in enumerate(ids))
        assert all(got[i].n_links == 0 and got[i].kept for i in range(3000, 3006)) and got[None].component_id is None


def test_quantisation_bound_holds():
    u, v = (x / np.linalg.norm(x, axis=1)[:, None] for x in np.random.default_rng(1).normal(size=(2, 300, 24)))
    (p, s, e), (q, t, f) = embeddings.quantised(u), embeddings.quantised(v)
    off = np.abs(u @ v.T - s[:, None] * t * (p.astype(float) @ q.T.astype(float)))
    assert (off <= e[:, None] + (1 + e[:, None]) * f + 1e-12).all()


# ---------------------------------------------------------------- 5


def test_toxicity_held_out(spark, odd):
    sf = "/root/testdata/sf0.1"
    r = toxicity.op5_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out and toxic is not null").toPandas()
    hit = ((r.predicted == 1) & (r.toxic == 1)).sum()
    assert hit / r.predicted.sum() > 0.95 and hit / r.toxic.sum() > 0.7
    labels = spark.createDataFrame([(2, 1), (2, None), (None, 1), (5, 0)], "doc_id long, toxic int")
    assert all(0 <= x.score <= 1 for x in toxicity.score(odd, toxicity.learn(odd, labels)).collect())
    assert toxicity.score(odd, toxicity.learn(odd, labels.limit(0))).select("score").distinct().count() == 1


def test_pairs_are_learned_from_texts(spark):
    """Label 1 where just one of two words stands: either is as common under both labels, and no additive score can tell."""
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (2400, 2))
    fill = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 4)) for _ in range(200)]
    texts = [" ".join([*rng.choice(fill, 12), ("dolt", "pal")[a], ("elf", "man")[b]]) for a, b in x.tolist()]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS)
    labels = spark.createDataFrame([(i, int(a != b)) for i, (a, b) in enumerate(x.tolist()) if i < 2000], "doc_id long, toxic int")
    got = toxicity.score(df.where("doc_id >= 2000"), toxicity.learn(df, labels)).collect()
    assert np.mean([(r.score > 0.5) == (x[r.doc_id, 0] != x[r.doc_id, 1]) for r in got]) > 0.9


def test_scores_are_sums_over_pairs(spark, odd):
    rng = np.random.default_rng(2)
    m = toxicity.Machine(-0.3)
    m.weights, m.factors = rng.normal(0, 0.1, m.weights.shape).astype(np.float32), rng.normal(0, 0.1, (len(m.weights), toxicity.FACTORS)).astype(np.float32)
    texts = ["one two threefold four", "Insults, insults and insulting!", "", None, "a b c d e f g"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in toxicity.score(df, m).collect():
        terms = set()
        for w in re.findall(r"[0-9a-z]+", (r.text or "").lower()):
            for k in (0, 4, 5, 6):
                if k == 0 or len(w) > k:
                    h = words(pa.array([w[: k or None]]), SPACED).hashes()[0] if k == 0 else toxicity._salted(words(pa.array([w]), SPACED).hashes(k), k)[0]
                    terms.add(int(h) >> (64 - toxicity.BITS))
        terms = sorted(terms)
        pairs = sum(float(m.factors[s].astype(float) @ m.factors[t].astype(float)) for i, s in enumerate(terms) for t in terms[i + 1 :])
        out = m.bias + sum(float(m.weights[t]) for t in terms) + pairs / max(1, len(terms))
        assert abs(r.score - 1 / (1 + math.exp(-out))) < 1e-6


# ---------------------------------------------------------------- 6


def test_simhash_against_brute_force(spark, docs):
    some = docs.select("doc_id", "text").unionAll(spark.createDataFrame([(9001, None), (9002, ""), (9003, "a b"), (9004, "A  b"), (None, "a b")], "doc_id long, text string"))
    prints = {}
    for r in some.collect():
        w = re.findall(rb"[^\x20\x09-\x0D]+", (r.text or "").encode().lower())
        h = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 4]), 42) for k in range(max(1, len(w) - 3))] if w else []
        if r.doc_id is not None:
            prints[r.doc_id] = sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h)) if h else 0
    ids = sorted(prints)
    want = classes([(a, b) for i, a in enumerate(ids) for b in ids[:i] if (prints[a] ^ prints[b]).bit_count() <= 4], ids)
    got = {r.doc_id: r for r in simhash.near_groups(some).collect()}
    assert {i: (got[i].fp & (1 << 64) - 1, got[i].component_id) for i in ids} == {i: (prints[i], want[i]) for i in ids}
    assert got[None].component_id is None


def test_multi_index_finds_every_link(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(-(2**63), 2**63 - 1, 60)
    prints = sorted({int(np.int64(b) ^ np.int64(sum(1 << int(k) for k in rng.choice(63, rng.integers(0, 7), False)))) for b in base for _ in range(12)})
    links = [(i, j) for i in range(len(prints)) for j in range(i) if ((prints[i] ^ prints[j]) & (1 << 64) - 1).bit_count() <= 4]
    want = classes(links, range(len(prints)))
    nodes = spark.createDataFrame([(p, i) for i, p in enumerate(prints)], "fp long, node long")
    for tile in (simhash.TILE_ROWS, 40):
        got = {r.node: r.component for r in connected_components(simhash.near_links(nodes, tile)).collect()}
        assert all(got.get(i, i) == c for i, c in want.items())


def test_similar_groups_find_edited_copies(spark):
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 7))
    rows = []
    for d in range(30):
        text = [word() for _ in range(300)]
        for copy in range(3):
            edited = list(text)
            for k in rng.choice(300, 3 * copy, False):
                edited[k] = word()
            rows.append((d * 10 + copy, " ".join(edited)))
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(spark.createDataFrame([*rows, (9001, None), (9002, "")], "doc_id long, text string")).collect()}
    assert np.mean([got[i] == i - i % 10 for i, _ in rows]) >= 0.96 and got[9001] == got[9002] == 9001  # similarities of 0.82 and more
    assert all(got[i] // 10 == i // 10 for i, _ in rows)


def test_similar_groups_are_exact(spark, monkeypatch):
    """Similarities of 0.74 stay apart and those of 0.82 link, in whole groups and in groups cut into blocks."""
    rng = np.random.default_rng(5)
    rows, text = [], {}
    for d in range(40):
        base = [f"w{x}" for x in rng.integers(0, 10**9, 300)]
        for copy, edits in enumerate((0, 9, 6)):
            edited = list(base)
            for k in range(edits):
                edited[10 + 30 * k + copy] = f"e{d}-{copy}-{k}"
            text[d * 10 + copy] = {tuple(edited[k : k + 5]) for k in range(296)}
            rows.append((d * 10 + copy, " ".join(edited)))
    links = [(a, b) for a in text for b in text if a < b and a // 10 == b // 10 and len(text[a] & text[b]) >= 0.8 * len(text[a] | text[b])]
    want = classes(links, text)
    assert len(links) == 40
    for tile in (simhash.EXACT_ROWS, 2):
        monkeypatch.setattr(simhash, "EXACT_ROWS", tile)
        got = {r.doc_id: r.component_id for r in simhash.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert all(got[i] == i for i in got if i % 10 == 1)  # none is dropped below the similarity
        assert np.mean([got[i] == want[i] for i in got]) >= 0.96


# ---------------------------------------------------------------- 7


def test_katz_against_brute_force(spark, docs, odd, monkeypatch):
    def check(df):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        tok = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + [None] for _, t in rows]
        train = [i is not None and zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
        uni, pairs, ctx = Counter(), Counter(), Counter()
        for w, yes in zip(tok, train, strict=True):
            if yes:
                uni.update(w)
                pairs.update(zip([0, *w[:-1]], w, strict=True))
                ctx.update([0, *w[:-1]])
        total = sum(uni.values())
        discount = lambda c: katz.good_turing([Counter(c.values())[r] for r in range(1, katz.K + 2)], total)
        s1, s2 = discount(uni), discount(pairs)
        star = lambda r, s: s[r] if r <= katz.K else r - katz.TAIL
        p = {w: star(c, s1) / total for w, c in uni.items()}
        unknown, mass, low = 1 - sum(p.values()), Counter(), Counter()
        for (a, b), r in pairs.items():
            mass[a] += star(r, s2) / ctx[a]
            low[a] += p[b]
        want = []
        for (i, _), w in zip(rows, tok, strict=True):
            score = sum(math.log10(star(pairs[a, b], s2) / ctx[a] if (a, b) in pairs else ((1 - mass[a]) / (1 - low[a]) if a in ctx else 1) * p.get(b, unknown)) for a, b in zip([0, *w[:-1]], w, strict=True))
            base = sum(math.log10((uni.get(b, 0) + 1) / (total + len(uni) + 1)) for b in w)
            want.append((-1 if i is None else i, len(w), sum(b in uni for b in w), total, round(base, 4), round(score, 4)))
        got = katz.katz_scores(df.withColumn("train", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2, F.lit(False))))
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4), round(r.score, 4)) for r in got.collect()) == sorted(want)

    check(docs.select("doc_id", "text"))
    monkeypatch.setattr(katz, "CELL_TOKENS", 4000)
    found, inner = [], katz.hot_pairs
    monkeypatch.setattr(katz, "hot_pairs", lambda *a: found.append(inner(*a)) or found[-1])
    both = docs.select("doc_id", "text").unionAll(odd.select("doc_id", "text"))
    check(both)
    assert len(found[-1].key) == 1  # `word word` of the long text is scored where it is read
    assert katz.katz_scores(docs.limit(0).withColumn("train", F.lit(True))).count() == 0


# ---------------------------------------------------------------- 8


def test_raking_meets_targets_both_ways(spark, odd):
    data = [(i, "w " * (1 + i % 5), "ab"[i % 2], "xyz"[i % 3], i) for i in range(300)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, lang string, n long").withColumn("topic", F.lit("t")).withColumn("tokens", F.size(F.split(F.trim("text"), " ")).cast("long"))
    dims = {d: F.col(d) for d in ("source", "lang", "topic")}
    goal = {"source": {"a": 0.3, "b": 0.7}, "lang": {"x": 0.2, "y": 0.3, "z": 0.5}}
    one, two = (mixing.mixture(df, dims, targets=goal, driver_cells=n).orderBy("doc_id").toPandas() for n in (10**6, 0))
    assert np.allclose(one.probability, two.probability, atol=1e-6) and (one.kept == two.kept).all()
    w = one.tokens * one.probability * one.weight
    for d, t in goal.items():
        assert all(abs(w[one[d] == k].sum() / w.sum() - x) < 1e-6 for k, x in t.items())
    assert abs((one.tokens * one.probability).sum() / one.tokens.sum() - mixing.BUDGET) < 1e-6
    assert mixing.mixed(odd).count() == odd.count() and mixing.mixed(odd.limit(0)).count() == 0


# ---------------------------------------------------------------- 9


def test_raking_against_plain_python(spark):
    """Probabilities of sf0.01 from dictionaries alone, kept rows by the hash of their id; targets that contradict are reported."""
    got = [r.asDict() for r in mixing.op8_mixing(spark, "/root/testdata/sf0.01").withColumn("u", F.shiftrightunsigned(F.xxhash64(F.lit(mixing.SEED), F.col("doc_id").cast("string")), 11) / float(1 << 53)).collect()]
    dims, tokens = ("source", "lang", "topic"), Counter()
    for r in got:
        tokens[tuple(r[d] for d in dims)] += r["n_tokens"]
    tokens = {k: float(t) for k, t in tokens.items() if t}
    total, goal = sum(tokens.values()), []
    for i, d in enumerate(dims):
        sums = Counter()
        for k, t in tokens.items():
            sums[k[i]] += t
        raw = {v: t ** mixing.TEMPER[d] for v, t in sums.items()}
        goal.append({v: x / sum(raw.values()) for v, x in raw.items()})
    w = dict(tokens)
    for _ in range(300):
        for i in range(3):
            have = Counter()
            for k, x in w.items():
                have[k[i]] += x
            w = {k: x * goal[i][k[i]] * total / have[k[i]] for k, x in w.items()}
    low, high = 0.0, 100.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(1, mid * w[k] / t) * t for k, t in tokens.items()) < mixing.BUDGET * total else (low, mid)
    for r in got:
        k = tuple(r[d] for d in dims)
        p = min(1, high * w[k] / tokens[k]) if k in tokens else 0
        assert abs(r["probability"] - p) < 1e-6 and (r["kept"] == (r["u"] < p) or abs(r["u"] - p) < 1e-6)
    with pytest.warns(UserWarning, match="not met"):
        mixing.rake_driver([np.array([0, 1]), np.array([0, 1])], np.array([1.0, 1.0]), [np.array([0.9, 0.1]), np.array([0.1, 0.9])])


def test_language_held_out(spark, odd):
    r = langid.op9_langid(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id").where("held_out").toPandas()
    assert (r.lang == r.lang_pred).mean() > 0.95 and r.score.between(0, 1).all()
    got = {r.doc_id: r.lang_pred for r in langid.identify(odd, langid.learn(odd)).collect()}
    assert [got[i] for i in (1, 2, 3)] == ["und"] * 3 and got[None] in ("en", "de")
    assert {r.lang_pred for r in langid.identify(odd, langid.learn(odd.limit(0))).collect()} == {"und"}


def test_languages_of_many_scripts(spark):
    """Seventy labels, of Latin, Cyrillic, Greek and Chinese letters: all are learned, whatever letters they share."""
    rng = np.random.default_rng(3)
    scripts = {"la": (97, 26), "cy": (0x430, 32), "el": (0x3B1, 25), "zh": (0x4E00, 3000)}
    rows = []
    for k in range(70):
        base, n = list(scripts.values())[k % 4]
        vocabulary = ["".join(map(chr, base + rng.integers(0, n, 5))) for _ in range(60)]
        rows += [(100 * k + d, " ".join(rng.choice(vocabulary, 60)), f"{list(scripts)[k % 4]}{k}", "s", 1) for d in range(8)]
    df = spark.createDataFrame(rows, DOCS)
    found = langid.learn(df.where("doc_id % 100 < 6"))
    assert len({m.dense for m in found}) == 2 and sum(len(m.languages) for m in found) == 70
    held = langid.identify(df.where("doc_id % 100 >= 6"), found).collect()
    assert np.mean([r.lang == r.lang_pred for r in held]) == 1


def test_sparse_automata_equal_dense():
    samples = {"a": "abcabd xyz", "b": "zzzz", "c": ""}
    texts = ["abdabc", "zzzzz", "xyzab", "qq", None, "cab xyzzz" * 90]
    for x, y in zip(langid.Model(samples).entropies(texts), langid.Model(samples, False).entropies(texts), strict=True):
        assert np.array_equal(x, y)


@pytest.mark.parametrize(("run", "noted"), [(256, 1 << 20), (16, 1 << 20), (16, 200), (256, 1)])
def test_cross_parse_counts_longest_matches(monkeypatch, run, noted):
    """One unbroken parse of each text, however long it is and wherever runs and what is noted of them end."""
    monkeypatch.setattr(langid, "RUN", run)
    monkeypatch.setattr(langid, "NOTED_BYTES", noted)
    rng = np.random.default_rng(5)
    samples = {"a": "abcabd xyz", "b": "zzzz", "c": re.sub(" +", " ", "".join(rng.choice(list("abc "), 300))).strip(), "d": "a" * 90}
    models = langid.Model(samples), langid.Model(samples, False)

    def phrases(text, sample):
        n = i = 0
        while i < len(text):
            k = 1
            while i + k < len(text) and text[i : i + k + 1] in sample:
                k += 1
            n, i = n + 1, i + k
        return n

    texts = ["abdabc", "zzzzz", "xyzab", "qq", "cab xyzzz", None, "z" * 1500, "a" * 1500, "abd" * 700, samples["c"] * 5, "".join(rng.choice(list("abcxyz"), 3000)), ""]
    for m in models:
        bits, chars = m.entropies(texts)
        for k, t in enumerate(texts):
            if t:
                want = np.array([phrases(t, s) for s in samples.values()])
                assert np.allclose(bits[k], want * m.cost / len(t)) and np.allclose(chars[k], len(t) / want)


# ---------------------------------------------------------------- 10


def test_archives_are_bounded_and_common_payloads_meet(spark, tmp_path, monkeypatch):
    """Several files in either class of sizes, and a payload that many pages have; a null page id, url and html; a clashing column."""
    for name, value in (("FILE_BYTES", 40_000), ("SMALL_BYTES", 4_000), ("COMMON", 5)):
        monkeypatch.setattr(warc, name, value)
    rows = [(i, f"u{i}", "c" * 1500) for i in range(40)] + [(100 + i, None if i % 2 else "u", f"{i}" * 9000) for i in range(9)] + [(200 + i, "u", f"{i}" * 700) for i in range(60)] + [(None, "u", None), (None, "u", "c" * 1500)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("mine")).coalesce(1)
    path = f"file://{tmp_path}/w"
    warc.write_warc(df, path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path).select("path").collect()
    assert sum("/large/" in r.path for r in files) >= 2 and sum("/small/" in r.path for r in files) >= 5
    got = warc.resolved(warc.read_warc(spark, path, payload=False)).collect()
    assert len(got) == len(rows) and {r.refers_to for r in got if r.record_type == "revisit"} == {39}
    assert sum(r.record_type == "revisit" for r in got) == 40
    assert sorted((r.page_id or -1, r.payload_bytes) for r in got) == sorted((i or -1, len(h or "")) for i, _, h in rows)


def test_archives_round_trip(spark, tmp_path):
    long, other = "ü" * 600, "y" * 1000
    rows = [(1, "http://a/\r\nx", long), (2, None, long), (3, "u", "short"), (4, "u", "short"), (5, "u", None), (6, "u", other), (None, "u", long), (7, "u", "a\r\n\r\nWARC/1.1\r\nb\x00"), (8, "u", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_warc(pages, str(tmp_path / "w"))
    back = warc.read_warc(spark, str(tmp_path / "w"))
    got = {r.page_id: r for r in warc.resolved(back).collect()}
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    assert all(got[i].payload_digest == sha(h) and got[i].payload_bytes == len((h or "").encode()) for i, _, h in rows)
    assert {i: r.refers_to for i, r in got.items() if r.record_type == "revisit"} == {1: 8, 2: 8, None: 8}
    assert {bytes(r.payload).decode() for r in back.where("payload is not null").collect()} == {long, "short", "", other, rows[7][2]}
    warc.write_warc(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_warc(spark, str(tmp_path / "none")).count() == 0


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages(spark, odd):
    kept = {}
    df = spark.read.parquet(f"{SF}/documents.parquet").unionByName(odd.select(*corpus_pipeline.COLUMNS))
    for name, stage in corpus_pipeline.STAGES:
        df = corpus_pipeline.written(stage(spark, df, SF), name)
        kept[name] = df.count()
        assert name == "token_ids" or df.columns == corpus_pipeline.COLUMNS
    assert kept["language_id"] >= kept["near_duplicates"] >= kept["decontamination"] >= kept["mixture"] == kept["token_ids"] > 0
    assert df.select("doc_id").distinct().count() == df.count()
    assert sorted(map(str, corpus_pipeline.run(spark, SF).columns)) == ["doc_id", "ids_crc32", "n_tokens", "start"]


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_distinct_equals_unique(n):
    key = np.random.default_rng(n).integers(0, 50, n)
    want, at = np.unique(key, return_inverse=True)
    got, place = katz.distinct(key)
    assert got.tolist() == want.tolist() and place.tolist() == at.tolist()
