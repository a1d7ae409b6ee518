"""The llm queries, each over whole tables with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.llm import centroids, grades, imatch, lines, middle, nearjoin, oracles, packing, pieces, pii, rules, secrets, warc, wordpiece
from offerloom.llm.common import saved, table

PIECES = "piece_bpe_32k.model"
BYTES = "byte_bpe_50k"


#: The key of the surrogates; a deployment sets its own.
SURROGATE_KEY = "offerloom"


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(f"{BYTES}.json"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(table(spark, sf_dir, "documents"), SURROGATE_KEY).select("doc_id", "text", "n_entities")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = rules.judge(docs, rules.learn(docs, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", *rules.COUNTS, "base_failed", "kept")


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.rewritten(table(spark, sf_dir, "pages"))


def op8_quality_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = grades.train(docs, table(spark, sf_dir, "labels"))
    return grades.score(docs.select("doc_id", "text"), model).drop("text")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_and_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op10_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearjoin.join_near(table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    bitmaps = saved(lines.keep_bitmaps(docs), "bitmaps")
    return lines.apply_bitmaps(docs, bitmaps).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = middle.fill_in_middle(table(spark, sf_dir, "documents"))
    restored = middle.restored(F.col("output"), F.col("form"))
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.with_inertia(*centroids.cluster(table(spark, sf_dir, "embeddings")))


def conversation_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruction data: whole conversations, where the tokens of the answers are a limit of their own."""
    turns = table(spark, sf_dir, "conversations")
    return packing.pack_conversations(turns, public_tokenizers.path(f"{BYTES}.json"), packing.Limits(2048, 16, 1024))


QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_token_counts, op3_packing, op4_fingerprints, op5_surrogates, op6_quality_rules, op7_warc_revisits, op8_quality_grades, op9_sentencepiece, op10_near_join, op11_line_dedup, op12_fill_in_middle, op13_centroid_clusters, conversation_packing)} | {"pipeline": corpus_pipeline.run}
ORACLES: dict[str, str] = dict(oracles.ORACLES)
