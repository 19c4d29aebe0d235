"""Registered queries of the training-data operators.

Each applies its operator with production parameters to the whole
``documents`` table; digest columns come from the operator's real output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import alignment, bpe_fst, conversation_repair, hyperminhash, packing, rollups, rules, suffix_dedup, syncmers, toxicity, training_order, voronoi_knn, weak_quality
from quarry.llm.common import documents, labels, new_folder

BYTE_BPE = "byte_bpe_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"
BYTE_BPE_JSON = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op8_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text through the BPE transducer and back."""
    path, pattern = public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN
    both = bpe_fst.round_trip(documents(spark, sf_dir), path, pattern)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces placed into sequences of 4096 tokens."""
    return packing.best_fit_packing(documents(spark, sf_dir), public_tokenizers.path(WORD_BPE))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    judged = rules.judge(documents(spark, sf_dir), labels(spark, sf_dir))
    return judged.select("doc_id", *rules.MEASURES, "base_failed", "kept")


ORACLES["op6_quality_rules"] = rules.oracle_sql("SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged")


@query
def op9_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness."""
    f = syncmers.fingerprints(documents(spark, sf_dir))
    return f.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        syncmers.as_string(F.col("anchors")).alias("fingerprint"), syncmers.as_string(F.col("edited_anchors")).alias("edited_fingerprint"),
        syncmers.likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        syncmers.likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"))


@query
def op10_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three deliveries: all documents; later copies deleted
    and texts without their repeated lines counted anew; that batch again."""
    docs = documents(spark, sf_dir)
    tokenizers = {"word_bpe_49k": public_tokenizers.path(WORD_BPE), "white_space": None}
    rollup = rollups.TokenRollup(spark, new_folder(spark, "rollup"))
    rollup.commit(1, inserts=rollups.count_tokens(docs, tokenizers))
    gone, shorter = rollups.cleaned(docs)
    for _ in range(2):
        rollup.commit(2, revised=rollups.count_tokens(shorter, tokenizers), deletes=gone)
    return rollup.totals()


@query
def op2_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence of the corpus in its slot, read back from the shards."""
    records = training_order.materialise(documents(spark, sf_dir), public_tokenizers.path(WORD_BPE), key=20240607)
    return records.select("slot", "shard", "place", "doc_id", "piece", F.col("n_tokens").cast("long").alias("n_tokens"),
                          F.octet_length("ids").alias("record_bytes"), F.crc32("ids").alias("record_crc32"))


@query
def op1_weak_label_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes, posterior, score and verdict of every document."""
    return weak_quality.classify(documents(spark, sf_dir))


@query
def op4_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learnt outside fold 0."""
    return toxicity.toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


@query
def op7_hyperminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return hyperminhash.components(documents(spark, sf_dir))


ORACLES["op7_hyperminhash_dedup"] = hyperminhash.ORACLE


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the removal of repeated 400-byte strings takes and leaves of every document."""
    r = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    taken = F.aggregate(F.transform("removed", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda a, x: a + x)
    return r.select("doc_id", "n_bytes", taken.alias("n_removed"), (F.size("removed") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and its audit, for every damaged conversation."""
    return conversation_repair.repair(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet"))


ORACLES["op11_conversation_repair"] = conversation_repair.ORACLE


@query
def op13_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best vectors of every 50th one, by exact inner product."""
    return voronoi_knn.knn_join(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


ORACLES["op13_voronoi_knn"] = voronoi_knn.ORACLE


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers linked by the bytes they share, per document."""
    found = alignment.alignment(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE_JSON), public_tokenizers.path(PIECE_BPE), keep_groups=False)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"), "n_shared")
