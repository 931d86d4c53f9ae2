"""Corpus pipeline: documents through quality, line dedup, near-dedup, decontamination and packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs.  All but the last return
the columns of ``documents``.  NULL or empty texts pass through every stage
(they are documents without lines, words or tokens); tables without rows give
tables without rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicewright.llm import decontaminate, line_dedup, packing, quality, simhash
from slicewright.llm.queries import tokenizer_path
from slicewright.llm.scratch import free, prepared, quoted, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose top grade is likely; the others go."""
    return quality.select(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(*quoted(docs.columns))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without boilerplate lines that another text keeps; whole copies stay copies, for the next stage."""
    cleaned = line_dedup.dedup_lines(docs, whole_copies=True)
    return cleaned.withColumn("n_chars", F.when(F.col(cleaned.columns[-1]) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)).select(*quoted(docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id; rows without an id stay."""
    name = free(docs, "__keep")
    keep = simhash.near_duplicates(prepared(docs)).where("doc_id = component_id").select(F.col("doc_id").alias(name)).distinct()
    met = docs.join(keep, F.col("doc_id") == F.col(name), "left").where(F.col(name).isNotNull() | F.col("doc_id").isNull())
    return met.dropDuplicates(["doc_id", "text"]).select(*quoted(docs.columns))  # repeated rows, in the join's own partitions


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified benchmark overlap."""
    return decontaminate.clean(prepared(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*quoted(docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents in their sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("packing", pack),
]

#: A trained classifier and tokenisation cannot be said in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepared(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
