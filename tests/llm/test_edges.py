"""Empty tables, repeated ids and clashing columns, operator by operator."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tellurion.llm import embeddings, katz, langid, mixing, rollup, simhash, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def some(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").limit(60)


def clashing(df, *names):
    return df.withColumns({n: F.lit("mine") for n in names})


def test_vectors(spark):
    kind = "vec_id long, embedding array<float>, label int"
    assert embeddings.near_vectors(spark.createDataFrame([], kind)).count() == 0
    rows = [(1, [1.0, 0.0], 0), (2, [1.0, 0.01], 0), (3, [0.0, 1.0], 1), (3, [0.0, 1.0], 1)]
    got = embeddings.near_vectors(clashing(spark.createDataFrame(rows, kind), "n_links", "component_id", "kept", "node", "copies", "dim", "block")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 1, 1), (2, 1, 1), (3, 1, 3), (3, 1, 3)]


def test_fingerprints(spark, none):
    assert simhash.near_groups(none).count() == 0
    rows = [(5, "a b c d e f g", "en", "s", 1), (5, "a b c d e f g", "en", "s", 1), (4, "A b c d e f g", "en", "s", 1), (9, "x y z w v u t s", "en", "s", 1), (None, "a b c d e f g", "en", "s", 1)]
    got = simhash.near_groups(clashing(spark.createDataFrame(rows, DOCS), "fp", "node", "component", "component_id")).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id) == [(4, 4), (5, 4), (5, 4), (9, 9)] and len(got) == 5


def test_toxicity(spark, some, none):
    labels = spark.createDataFrame([(r.doc_id, i % 2) for i, r in enumerate(some.select("doc_id").collect())], "doc_id long, toxic int")
    machine = toxicity.learn(some, labels)
    assert toxicity.score(none, machine).count() == 0
    assert toxicity.score(clashing(some, "score_", "terms"), machine).where("score between 0 and 1").count() == 60


def test_language_models(none, some):
    models = langid.learn(some)
    assert langid.identify(none, models).count() == 0
    got = langid.identify(some.withColumn("text", F.lit("same")), models).select("lang_pred").distinct().collect()
    assert len(got) == 1  # ties between languages fall alike


def test_scores_of_a_language_model(none, some):
    assert katz.katz_scores(none.withColumn("train", F.lit(True))).count() == 0
    plain = katz.katz_scores(some.withColumn("train", F.col("doc_id") % 2 == 0)).select("doc_id", "score")
    clash = katz.katz_scores(clashing(some, "score", "n_tokens", "cell", "key", "hash").withColumn("train", F.col("doc_id") % 2 == 0)).select("doc_id", "score")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, clash.collect()))


def test_rollups(spark, none, tmp_path):
    r = rollup.Rollup(spark, f"file://{tmp_path}/r")
    r.commit("1", rollup.changes(rollup.counted(none), "insert", "v", "words"))
    assert r.totals().count() == 0
    long = spark.createDataFrame([(1, "word " * 200_000, "en", "s", 1)], DOCS)
    r.commit("2", rollup.changes(rollup.counted(clashing(long, "words", "pieces", "bars", "tokens")), "insert", "v", "words"))
    assert [x.tokens for x in r.totals().collect()] == [200_000]


def test_mixtures(spark, none):
    assert mixing.mixed(none).count() == 0
    nothing = spark.createDataFrame([(i, None, None, None, None) for i in range(5)], DOCS)
    assert mixing.mixed(nothing).count() == 5


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_of_an_empty_table(spark, none, name, stage):
    out = stage(spark, none, SF)
    assert out.count() == 0
    if name != "token_ids":
        assert out.columns == corpus_pipeline.COLUMNS
