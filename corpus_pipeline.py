"""Corpus pipeline: language ID, near-duplicate removal, benchmark decontamination, secret
redaction, tokenising.  Each stage's result is written as Parquet and read by the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scoreflow.llm import decontamination, language_id, secret_scan, sentencepiece_viterbi, simhash
from scoreflow.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: A text is rejected if it has no letter, or if it has this many n-grams and no learned language holds
#: this share of them.  Short texts give too little evidence to be rejected.
MIN_GRAMS = 20
MIN_SCORE = 0.25


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those that the model rejects go.  The model is trained on
    documents that are not held out, by their ``lang``; with nothing to learn from, only texts without
    a letter can be told and all others stay."""
    docs = docs.select(*COLUMNS)
    model = language_id.train(docs.where(~language_id.held_out("doc_id")).select("doc_id", "text", "lang"))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    judged = language_id.identify(docs, model, COLUMNS)
    rejected = (F.col("lang_pred") == language_id.UNDETERMINED) | (
        (F.col("n_grams") >= MIN_GRAMS) & (F.col("score") < MIN_SCORE))
    return judged.where(~rejected).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every SimHash group, the one with the smallest doc_id; null and empty texts are one group."""
    return simhash.first_of_each(docs.select(*COLUMNS)).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ``benchmark`` item; rows without a doc_id stand and fall together."""
    docs = docs.select(*COLUMNS)
    leaks = decontamination.contained_items(docs, table(spark, sf_dir, "benchmark"))
    leaky = written(leaks.select(F.col("doc_id").alias("_id")).distinct(), "leaky")
    return docs.join(leaky, F.expr("doc_id <=> _id"), "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mask; n_chars follows where a text changes.  A null or empty text has
    no secret and stays as it is; repeated rows and rows without doc_id are masked alike."""
    # written once: the thresholds and the masks both read it
    found = written(secret_scan.analyse(docs.select(*COLUMNS), COLUMNS), "analysed")
    spans = found.withColumn("spans", secret_scan.all_spans(secret_scan.thresholds(found)))
    masked = spans.withColumn("masked", secret_scan.redacted(F.col("text"), F.col("spans")))
    return masked.select("doc_id", F.col("masked").alias("text"), "lang", "source", F.when(
        F.size("spans") > 0, F.char_length("masked").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document (null text: no tokens): doc_id, n_tokens, digests of the ids and of the decoded text, and whether that text is exact."""
    return sentencepiece_viterbi.round_trip(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("secret_scan", redact_secrets),
    ("sentencepiece", tokenise),
]

#: Language model, SimHash components and the Viterbi search can't be written in SQL; tests hold each operator against a
#: brute-force version, and the pipeline against its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
