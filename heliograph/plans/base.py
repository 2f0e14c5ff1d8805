"""Readers of the driver's tables and the stand-ins they play: works, people, applicants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as works: a person is a (lang, source), an institution a lang, a year follows from the id."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.col("lang").alias("institution_id"), F.concat_ws("/", "lang", "source").alias("person_id"),
        (2000 + F.col("doc_id") % 25).cast("int").alias("year"),
    )


WORKS_SQL = "SELECT doc_id, text, lang AS institution_id, lang || '/' || source AS person_id, (2000 + doc_id % 25)::INT AS year FROM documents"


def applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """benchmark items as applicants' texts."""
    return table(spark, sf_dir, "benchmark").select("item_id", "text")
