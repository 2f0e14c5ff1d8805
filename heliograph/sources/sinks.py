"""Sinks: CSV and JSON lines, snapshots with a manifest, canonical sparse vectors."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def csv(df: DataFrame, path: str, order: list[Column] | None = None) -> None:
    """One header per file, also for an empty result; arrays and maps as JSON."""
    flat = df.select(*[F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes])
    ready = flat.orderBy(*order) if order else flat
    ready.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def jsonl(df: DataFrame, path: str, order: list[Column] | None = None) -> None:
    """One JSON object per line, keys sorted."""
    ready = df.orderBy(*order) if order else df
    ready.select(F.to_json(F.struct(*sorted(df.columns)))).write.mode("overwrite").text(path)


def manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, rows, sha256) of each table: an order-free digest of its rows."""
    out = None
    for name, df in sorted(tables.items()):
        row = F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256)
        halves = [F.conv(F.substring(row, a, 12), 16, 10).cast("decimal(38,0)") for a in (1, 13)]
        one = df.select(*[h.alias(f"h{i}") for i, h in enumerate(halves)]).agg(
            F.count(F.lit(1)).alias("rows"), F.sha2(F.concat_ws(":", *[F.coalesce(F.sum(f"h{i}"), F.lit(0)).cast("string") for i in (0, 1)]), 256).alias("sha256"))
        one = one.select(F.lit(name).alias("name"), "rows", "sha256")
        out = one if out is None else out.unionByName(one)
    return out


def snapshot(spark: SparkSession, tables: dict[str, DataFrame], root: str, run_id: str, checks: dict[str, bool]) -> DataFrame:
    """Writes each table under root/run_id=..., refuses to overwrite, then the manifest and the pointer row.

    The pointer 'current' is moved only if all checks hold; 'latest' always is.
    """
    for name, df in sorted(tables.items()):
        df.write.mode("errorifexists").parquet(f"{root}/run_id={run_id}/{name}")
    passed = all(checks.values())
    entries = manifest(tables).withColumns({"run_id": F.lit(run_id), "passed": F.lit(passed), "checks": F.lit(json.dumps(checks, sort_keys=True))})
    entries.coalesce(1).write.mode("errorifexists").json(f"{root}/manifests/{run_id}")
    pointers = [("latest", run_id)] + ([("current", run_id)] if passed else [])
    spark.createDataFrame(pointers, "pointer string, run_id string").withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").json(f"{root}/pointers")
    return spark.read.json(f"{root}/manifests/{run_id}")


def pointer(spark: SparkSession, root: str, name: str) -> str | None:
    """The run that a pointer shows at last."""
    row = spark.read.json(f"{root}/pointers").where(F.col("pointer") == name).orderBy(F.desc("at"), F.desc("run_id")).first()
    return row.run_id if row else None


def vector_json(vectors: DataFrame, key: str) -> DataFrame:
    """(key, vector_json, vector_hash): each vector's canonical text, terms sorted, and its SHA-256."""
    entry = F.struct("term", F.col("weight").cast("double").alias("weight"))
    texts = F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.concat(F.to_json(F.array(e["term"])).substr(F.lit(2), F.length(F.to_json(F.array(e["term"]))) - 2), F.lit(":"), e["weight"].cast("string")))
    out = vectors.groupBy(key).agg(F.concat(F.lit("{"), F.array_join(texts, ","), F.lit("}")).alias("vector_json"))
    return out.withColumn("vector_hash", F.sha2("vector_json", 256))


def fresh_vectors(vectors: DataFrame, hashes: DataFrame, key: str) -> DataFrame:
    """Vectors whose source text hash is still the current one; stale ones are refused."""
    return vectors.join(hashes, [key, "source_text_hash"], "left_semi")


def checked_vectors(vectors: DataFrame, key: str, limit: int = 256) -> DataFrame:
    """The vectors, with an error if one has a null, non-finite or zero weight, too many terms, a double or no unit norm."""
    stats = vectors.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("term").alias("d"), F.abs(F.sqrt(F.sum(F.col("weight") * F.col("weight"))) - 1).alias("off"),
        F.max(F.col("weight").isNull() | F.isnan("weight") | (F.col("weight") == 0)).alias("bad"))
    bad = (F.col("n") > limit) | (F.col("n") != F.col("d")) | F.col("bad") | ~(F.col("off") < 1e-6)
    good = stats.select(key, F.when(bad, F.raise_error(F.lit("invalid sparse vector"))).otherwise(F.lit(True)).alias("_ok"))
    return vectors.join(good, key).where("_ok").drop("_ok")
