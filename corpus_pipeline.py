"""The corpus pipeline: toxicity, near duplicates, benchmark passages, secrets, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it
returns is written as Parquet and read again as the next stage's ``docs``. All
but the last return the columns of ``documents``, of every row they keep:

* ``toxicity``: documents that the fitted model calls toxic go. The model learns
  from those rows of ``docs`` that have a label (two folds, as op6 does).
* ``near_duplicates``: of each component of similar documents the one with the
  smallest doc_id stays (once, if its row is repeated; of similar texts with that id, one). Rows are told apart by
  doc_id and text, so a text of its own stays whatever row shares its doc_id. Rows without doc_id and
  documents without words are not removed.
* ``benchmark``: documents that hold a benchmark passage go.
* ``secrets``: spans of secrets are replaced by ``[SECRET]``; n_chars follows.
* ``token_ids``: doc_id, n_tokens and digests of ids and decoded bytes.

Nulls, empty texts, repeated rows and empty tables pass as the operators'
docstrings say; a null n_chars stays null. Columns beyond those of documents are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from carelake.llm.bpe import encoded_digests
from carelake.llm.common import cut, read_table
from carelake.llm.decontamination import mark_contaminated
from carelake.llm.jaccard_join import row_key, similarity_rows
from carelake.llm.secrets import redact, scan
from carelake.llm.toxicity import fit_toxicity, fold, score_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: An executor's memory holds what all stages before have made its JVM take, so the Python workers of a stage get less of
#: it than those of the operator alone: characters of text at a time, and words that they remember.
BLOCK_CHARS, CACHE_WORDS = 500_000, 60_000
#: Bytes of an Arrow batch between the JVM and a Python worker, both of which hold some batches for each task. Spark's
#: default is 64 MB, or 10,000 rows however long they are.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Every stage with Python workers sets this for the session; a stage is planned after it returned."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = docs.select(*COLUMNS)
    model = fit_toxicity(docs.select("doc_id", "text"), read_table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    return score_toxicity(docs, model, BLOCK_CHARS).where("predicted = 0").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = docs.select(*COLUMNS)
    found = cut(similarity_rows(docs.select("doc_id", "text")).where("n_shingles > 0 AND doc_id IS NOT NULL")
                .select("doc_id", "row_key", "label"), "found")
    # Of each component with more than one row the row that stays: the smallest doc_id, then the smallest key.
    first = F.min(F.struct("doc_id", "row_key"))
    several = found.groupBy("label").agg(first["row_key"].alias("stays"), F.min("row_key").alias("lo"),
                                         F.max("row_key").alias("hi")).where("lo <> hi").select("label", "stays")
    # The rows that go. Keys are few bytes; texts are shuffled only if the keys are too many to broadcast.
    gone = cut(found.join(several, "label").where("row_key <> stays").select("row_key").distinct(), "gone")
    keyed = docs.withColumn("row_key", row_key())
    kept = keyed.join(_small(gone), "row_key", "left_anti")
    # Repeated rows: one stays, but for rows without words, which are nobody's duplicate.
    repeated = cut(found.groupBy("row_key").count().where("count > 1").select("row_key"), "repeated")
    once = kept.join(_small(repeated), "row_key", "left_semi").dropDuplicates(["row_key"])
    return kept.join(_small(repeated), "row_key", "left_anti").unionByName(once).select(*COLUMNS)


def _small(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.count() <= 1_000_000 else keys


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    marked = mark_contaminated(docs.select(*COLUMNS), read_table(spark, sf_dir, "benchmark"), BLOCK_CHARS)
    return marked.where(F.size("matches") == 0).select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = redact(scan(docs.select(*COLUMNS)))
    changed = F.when((F.size("spans") > 0) & F.col("n_chars").isNotNull(), F.length("text").cast("long"))
    return found.withColumn("n_chars", F.coalesce(changed, F.col("n_chars"))).select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    import public_tokenizers
    return encoded_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                           CACHE_WORDS, BLOCK_CHARS)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("benchmark", benchmark),
          ("secrets", secrets), ("token_ids", token_ids)]
#: Toxicity is learned by a fit that SQL doesn't express; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, f"stage-{name}")
    return docs
