"""A corpus from documents to token ids: language, near-duplicates, benchmark passages, mixture, output.

Each stage is a function of (spark, docs, sf_dir) and works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellurion.llm import decontaminate, langid, mixing, simhash, token_ids
from tellurion.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Characters a phrase of the cross-parse below which a text is of no learned language. Unknown letters give 1, random ones of known
#: alphabets under 2; of the 51,282 documents of `check_s`, the least has 2.3 and one in a thousand under 3.3.
LEAST_PHRASE = 1.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of no language: `und` (null, or without a letter), and those whose best parse has under LEAST_PHRASE characters
    a phrase, as text of a script or tongue that no labelled document is of. The predicted language fills a missing lang; a lang
    that is given stays, since the prediction may err."""
    found = langid.identify(docs.select(*COLUMNS), langid.learn(docs))
    return found.where(F.col("lang_pred") != "und").where(F.col("phrase_chars") >= LEAST_PHRASE).withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of each group of texts whose five-word shingles have a Jaccard similarity of 0.8 or more."""
    groups = simhash.similar_groups(docs)
    gone = written(groups.where("doc_id <> component_id").select("doc_id"), "near-copies")
    kept = docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)
    twice = written(docs.groupBy("doc_id").count().where("doc_id is not null and count > 1").select("doc_id"), "repeated")
    if not twice.head(1):
        return kept
    once = kept.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*COLUMNS)).alias("d")).select("d.*")
    return kept.join(twice, "doc_id", "left_anti").select(*COLUMNS).unionByName(once)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    return decontaminate.without_hits(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample documents so that sources, languages and topics meet their tempered shares of the tokens."""
    return mixing.mixed(docs).where("kept").select(*COLUMNS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token ids; per document its place in them and their checksum, as read back."""
    return token_ids.op2_token_ids(spark, sf_dir, docs)


STAGES = [("language_id", language), ("near_duplicates", near_duplicates), ("decontamination", benchmark_passages), ("mixture", mixture), ("token_ids", token_output)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
