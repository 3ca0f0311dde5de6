"""Cleaning and tokenising of `documents` for training, in stages that each read what the one before wrote."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickermill.llm import bpe, decontamination, language, minhash, secrets
from tickermill.llm.registry import TOKENIZER, table
from tickermill.session import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Texts that a task holds together in its Python worker.
ROWS_PER_BATCH = 1000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go; a missing language is filled in.

    Null, empty and letterless texts have no language; repeated rows are judged alike; texts of any
    length are read whole.
    """
    found = language.identify(docs, language.fit(docs)).where("not rejected")
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays.

    Documents without words are no one's duplicate; rows without a doc_id stay as the operator keeps them.
    """
    return minhash.keep_first(docs).select(COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, in order or reordered, go; null and empty texts hold none."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark")).select(COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; all documents stay, null texts as they are."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids instead of texts, with their count and digests; a null text counts as empty."""
    return bpe.tokenise(docs, TOKENIZER).drop("n_chars")


def _in_small_batches(stage):
    """The stage with Arrow batches of few texts; the setting holds while its result is computed, too."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("language", _in_small_batches(identify_language)),
    ("near_duplicates", _in_small_batches(drop_near_duplicates)),
    ("decontamination", _in_small_batches(decontaminate)),
    ("secrets", _in_small_batches(redact_secrets)),
    ("bpe", _in_small_batches(encode)),
]

# Clustered centroids and BPE cannot be said in SQL; the tests follow each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; every stage is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
