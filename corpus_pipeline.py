"""From documents to packed training sequences, in five stages; each stage's output is written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm import decontamination, jaccard_join, line_dedup, packing, toxicity
from llm.common import read_table, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic, by a model trained on those among them that have labels."""
    return toxicity.reject_toxic(docs, read_table(spark, sf_dir, "labels"))


def cut_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are boilerplate of their source."""
    return line_dedup.dedup_documents(docs, host="source")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.keep_one(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; those that are passages for the most part go."""
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, lexical neighbours together."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_boilerplate_lines),
    ("jaccard_join", keep_one_of_each_group),
    ("decontamination", cut_benchmark),
    ("packing", pack_sequences),
]

#: The first stage's model and the last stage's tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences of what all stages keep (see `packing.pack`).

    Null and empty texts pass every stage and are packed as an end id each; repeated rows are near copies, of which one stays; texts of any
    length stay whole. Without labels of both kinds no document is rejected, without a benchmark none is cut; without
    documents there is nothing to pack. Columns of documents beside doc_id and text may have any names.
    """
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
