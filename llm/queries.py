"""Registered queries of the operators, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from llm import conversation_repair, decontamination, embedding_dedup, fixity, jaccard_join, line_dedup, packing, quality, runlength_dedup, sharding, token_counts, toxicity, whitening
from llm.common import read_table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("spans")


def op2_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixity.audit_pages(read_table(spark, sf_dir, "pages"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_pages(read_table(spark, sf_dir, "pages"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents")).drop("ids")


def op5_runlength_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlength_dedup.dedup(read_table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_links(read_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(read_table(spark, sf_dir, "documents"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, model="piece_bpe_32k.model", limit=4096)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_report(read_table(spark, sf_dir, "conversations"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_warc_fixity": op2_warc_fixity,
    "op3_line_dedup": op3_line_dedup,
    "op4_packing": op4_packing,
    "op5_runlength_dedup": op5_runlength_dedup,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_toxicity": op7_toxicity,
    "op8_sharding": op8_sharding,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_embedding_whitening": op13_embedding_whitening,
    "pipeline": corpus_pipeline.run,
}
ORACLES: dict[str, str] = {
    "op1_decontamination": decontamination.REPORT_SQL,
    "op2_warc_fixity": fixity.AUDIT_SQL,
    "op3_line_dedup": line_dedup.PAGES_SQL,
    "op6_jaccard_join": jaccard_join.LINKS_SQL,
    "op9_embedding_near_dedup": embedding_dedup.LINKS_SQL,
    "op11_conversation_repair": conversation_repair.REPORT_SQL,
}
