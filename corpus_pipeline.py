"""The corpus pipeline: documents to packed sequences in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; run() writes every
stage's rows to the shared folder as Parquet and reads them again, so a lost executor costs a stage
at most. The first four return the columns of documents, the last the packed pieces. Nulls, empty
texts, ties and repeated rows follow the operators' own rules; an empty table stays empty through
all stages. Further columns of documents pass through the first four stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph.llm import curriculum, exact_dedup, jaccard_join, packing, quality_crf
from heliograph.llm.catalog import tokenizer_path
from heliograph.llm.common import table
from heliograph.runtime import saved


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the quality classifier rejects."""
    field = quality_crf.train(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))  # columns of docs may have the scores' names
    return quality_crf.score(rows, field).where("predicted = 1").select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of equal texts."""
    return exact_dedup.survivors(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near duplicates."""
    return jaccard_join.representatives(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source's share in training order; documents that are taken twice are two rows."""
    return curriculum.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences of at most 2048 tokens."""
    return packing.report(packing.pack(docs, tokenizer_path()))


STAGES = [("quality_classifier", quality), ("exact_dedup", exact), ("jaccard_join", near), ("mixing", mixing), ("packing", pack)]

#: Neither the classifier nor the tokens can be expressed in SQL; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
