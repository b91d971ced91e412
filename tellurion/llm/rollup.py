"""Operator 3: token counts as rollups kept up by signed changes, in idempotent batch commits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM, SPACED, flat, new_path, slices, table, words, written
from .token_ids import encoder

KEYS = ["source", "lang", "tokenizer"]
DELTAS = T.StructType([*(T.StructField(k, T.StringType()) for k in KEYS), T.StructField("docs", T.LongType()), T.StructField("tokens", T.LongType()), T.StructField("batch", T.StringType())])
COMMITS = T.StructType([T.StructField("batch", T.StringType()), T.StructField("covers", T.ArrayType(T.StringType()))])


def signed(changes: DataFrame) -> DataFrame:
    """Additive deltas by source, language and tokenizer version of rows (op, source, lang, tokenizer, tokens, old_tokens).

    insert: +1 document and +tokens; delete: -1 and -tokens; revise: tokens - old_tokens. Other or null ops give nothing, null counts
    are 0, null keys are a key of their own. Rows are summed in their tasks before they are shuffled.
    """
    t, old = F.coalesce("tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    op = F.col("op")
    sign = F.when(op == "insert", 1).when(op == "delete", -1).otherwise(0)
    delta = F.when(op == "revise", t - old).otherwise(sign * t)
    return changes.where(op.isin("insert", "delete", "revise")).groupBy(*KEYS).agg(F.sum(sign).cast("long").alias("docs"), F.sum(delta).cast("long").alias("tokens"))


def changes_between(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes that lead from one table (doc_id, source, lang, tokenizer, tokens) to another, for `signed`.

    A document whose source or language changed is deleted and inserted; equal rows give nothing. doc_id and tokenizer name a row.
    """
    on = ["doc_id", "tokenizer"]
    o = old.select(*on, F.struct("source", "lang", "tokens").alias("o"))
    n = new.select(*on, F.struct("source", "lang", "tokens").alias("n"))
    both = o.join(n, on, "full").where("not (o <=> n)")
    same = F.col("o.source").eqNullSafe(F.col("n.source")) & F.col("o.lang").eqNullSafe(F.col("n.lang")) & F.col("o").isNotNull() & F.col("n").isNotNull()
    row = lambda op, x, was: F.struct(F.lit(op).alias("op"), F.col(f"{x}.source").alias("source"), F.col(f"{x}.lang").alias("lang"), F.col(f"{x}.tokens").cast("long").alias("tokens"), was.cast("long").alias("old_tokens"))
    none = F.lit(None)
    out = F.when(same, F.array(row("revise", "n", F.col("o.tokens")))).otherwise(F.filter(F.array(F.when(F.col("o").isNotNull(), row("delete", "o", none)), F.when(F.col("n").isNotNull(), row("insert", "n", none))), lambda x: x.isNotNull()))
    return both.select("doc_id", "tokenizer", F.explode(out).alias("c")).select("doc_id", "tokenizer", "c.*")


class Rollup:
    """A folder of delta tables, one for each batch, and of commits that make them count.

    A batch is written whole under its id, then its commit; a batch whose writing broke off has no commit and counts as absent, and
    writing it again replaces what it left. A batch that is committed already is left as it is, so a replay changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        spark.createDataFrame([], COMMITS).write.mode("ignore").parquet(f"{self.path}/commits/batch_id=none")

    def commits(self) -> DataFrame:
        return self.spark.read.schema(COMMITS).option("recursiveFileLookup", "true").parquet(f"{self.path}/commits")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of changes; False if it had been committed before."""
        return self._commit(batch, signed(changes), [])

    def _commit(self, batch: str, deltas: DataFrame, covers: list[str]) -> bool:
        if not batch or not all(c.isalnum() or c in "._-" for c in batch):
            raise ValueError("a batch id consists of letters, digits, dots, hyphens and underscores")
        if self.commits().where(F.col("batch") == batch).head(1):
            return False
        deltas.withColumn("batch", F.lit(batch)).select(*DELTAS.names).write.mode("overwrite").parquet(f"{self.path}/deltas/id={batch}")
        self.spark.createDataFrame([(batch, covers)], COMMITS).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/batch_id={batch}")
        return True

    def live(self) -> list[str]:
        """Names of the committed batches that no other one stands for; compact() keeps their number small."""
        done = self.commits()
        gone = done.select(F.explode("covers").alias("batch"))
        return sorted(r.batch for r in done.join(gone, "batch", "left_anti").select("batch").collect())

    def totals(self, live: list[str] | None = None) -> DataFrame:
        """source, lang, tokenizer, docs and tokens over all committed batches, or those named; keys whose documents are all gone are
        left out."""
        live = self.live() if live is None else live
        if not live:
            return self.spark.createDataFrame([], DELTAS).drop("batch")
        deltas = self.spark.read.schema(DELTAS).parquet(*[f"{self.path}/deltas/id={b}" for b in live])
        return deltas.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0")

    def compact(self, batch: str) -> bool:
        """Put the totals of the batches that are live now in their place, as one batch. A batch committed meanwhile is not among them:
        it is neither in the totals nor covered, and counts on its own."""
        live = self.live()
        return self._commit(batch, self.totals(live), live)


def counted_by(docs: DataFrame, tokenizers: dict[str, str]) -> DataFrame:
    """doc_id, source, lang, tokenizer (a version's name) and tokens: of whole texts, the ids that each version's vocabulary file
    (name -> path) gives, without special ids; null texts have none. Other columns are ignored."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            for name, path in tokenizers.items():
                n = encoder(path).encode(batch.column("text"))[1]
                columns = [*(batch.column(c) for c in ("doc_id", "source", "lang")), pa.array([name] * batch.num_rows), pa.array(n.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "source", "lang", "tokenizer", "tokens"])

    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "text")
    return some.mapInArrow(count, "doc_id long, source string, lang string, tokenizer string, tokens long")


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, and of whole texts: words (between ASCII white space), pieces (runs of ASCII letters, digits and
    non-ASCII characters, or one other sign) and bars (words that are one `|`); null texts have none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            w, runs = words(batch.column("text"), SPACED), words(batch.column("text"), ALNUM)
            raw, offsets = flat(batch.column("text"))
            signs = np.diff(np.searchsorted(np.flatnonzero((ALNUM[raw] == 0) & (SPACED[raw] != 0)), offsets))
            bars = np.flatnonzero((w.end - w.start == 1) & (w.data[w.start] == ord("|")))
            counts = [w.per_text, runs.per_text + signs, np.diff(np.searchsorted(bars, w.first))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "source", "lang")), *(pa.array(c.astype(np.int64)) for c in counts)], ["doc_id", "source", "lang", "words", "pieces", "bars"])

    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "text")
    return some.mapInArrow(count, "doc_id long, source string, lang string, words long, pieces long, bars long")


def changes(counts: DataFrame, op: str, tokenizer: str, tokens: str, old_tokens: str = "null") -> DataFrame:
    return counts.select("doc_id", "source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(op).alias("op"), F.expr(tokens).cast("long").alias("tokens"), F.expr(old_tokens).cast("long").alias("old_tokens"))


def op3_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four batches: all documents by words and by pieces, those of low quality taken out, table bars no longer counted
    as words. The first batch is replayed, and the first two are compacted in between."""
    counts = written(counted(table(spark, sf_dir, "documents")), "counts")
    poor = table(spark, sf_dir, "labels").where("quality = 0").select("doc_id").distinct()
    r = Rollup(spark, new_path(spark, "rollup"))
    load = changes(counts, "insert", "words-1", "words")
    r.commit("1-words", load)
    r.commit("2-pieces", changes(counts, "insert", "pieces-1", "pieces"))
    r.commit("1-words", load)
    r.compact("2-all")
    out = counts.join(poor, "doc_id", "left_semi")
    r.commit("3-poor", changes(out, "delete", "words-1", "words").unionAll(changes(out, "delete", "pieces-1", "pieces")))
    bars = counts.where("bars > 0").join(poor, "doc_id", "left_anti")
    r.commit("4-bars", changes(bars, "revise", "words-1", "words - bars", "words"))
    return r.totals().select(*KEYS, F.col("docs").alias("n_docs"), F.col("tokens").alias("n_tokens"))


OP3_SQL = r"""
WITH d AS (
  SELECT source, lang, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         len(regexp_extract_all(coalesce(text, ''), '[0-9A-Za-z\x{80}-\x{10FFFF}]+|[^0-9A-Za-z\x{80}-\x{10FFFF}\x09-\x0D\x20]')) AS p
  FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0 AND doc_id IS NOT NULL)),
t AS (
  SELECT source, lang, 'words-1' AS tokenizer, len(list_filter(w, lambda x: x <> '|')) AS n FROM d
  UNION ALL SELECT source, lang, 'pieces-1', p FROM d)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens FROM t GROUP BY ALL
"""
