"""The corpus pipeline: from ``documents`` to packed training sequences.

Each stage takes (spark, docs, sf_dir) and calls one operator of
``quarry.llm`` on all that its predecessor kept; its output is written as
Parquet and read again as the next one's ``docs``.  All stages but the
last return the columns of ``documents``.  doc_id is the key: rows that
share one (repeated rows) stand or fall together, null ids are a key like
any other, and texts that are null count as empty.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import hyperminhash, packing, rules, suffix_dedup, weak_quality
from quarry.llm.common import documents, labels, release, stored
from quarry.session import share_package


PASSAGE_WORDS = 51
PASSAGE_BYTES = 2 * PASSAGE_WORDS - 1       # so many words have no fewer, with a byte between two


def _kept(docs: DataFrame, verdict: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id the verdict keeps."""
    ids = verdict.where("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_kept_id"]), "left_semi")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the risk-controlled cutoffs keep."""
    return _kept(docs, rules.judge(docs, labels(spark, sf_dir)))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier keeps."""
    return _kept(docs, weak_quality.classify(docs))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one of least doc_id,
    once (of repeated rows that differ in other columns, any one).  Shingles
    of five words, similarity of 0.8 or more."""
    text_hash = suffix_dedup.unused(docs, "text_hash")
    kept = _kept(docs, hyperminhash.components(docs, percent=80, size=5)).withColumn(text_hash, F.xxhash64("text"))
    return kept.dropDuplicates(["doc_id", text_hash]).drop(text_hash)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the passages of over 50 words that stand
    elsewhere, too (or of 400 bytes, if their words are long)."""
    cleaned = suffix_dedup.clean_texts(docs, PASSAGE_BYTES, PASSAGE_WORDS)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document in sequences of 4096 tokens."""
    return packing.best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json"))


def _stage(name: str, fn):
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        share_package(spark)
        return fn(spark, docs, sf_dir)

    return name, run_stage


STAGES = [
    _stage("quality rules", quality_rules),
    _stage("quality classifier", quality_classifier),
    _stage("minhash near-dedup", minhash_near_dedup),
    _stage("suffix-array dedup", suffix_array_dedup),
    _stage("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table ``documents`` of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        release(spark)
    return docs


#: Token ids and the classifier's fit are beyond SQL; tests/llm/test_pipeline.py checks the stages by brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
