"""Column expressions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The ASCII white space that separates words, and what a word is.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def text_of(column: str | Column) -> Column:
    """A text column with null as the empty string."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables; only Spark's readers touch the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
