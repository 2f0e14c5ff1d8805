"""Structured Streaming versions of the incremental operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph.runtime import fresh_path, ship_code


def event_stream(spark: SparkSession, path: str) -> DataFrame:
    """A file or folder of events as a stream."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(path + "*").withColumn("ts", F.col("ts").cast("timestamp"))


def windowed_counts(events: DataFrame, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts and sums per event type in tumbling windows, with a watermark for late events."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def memberships(events: DataFrame) -> DataFrame:
    """(user_id, first_seen, last_seen, seen) kept in state per user and emitted at every update."""
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    ship_code(events.sparkSession)

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, last, seen = state.get if state.exists else (None, None, 0)
        for frame in frames:
            lo, hi = frame["ts"].min(), frame["ts"].max()
            first = lo if first is None or lo < first else first
            last = hi if last is None or hi > last else last
            seen += len(frame)
        state.update((first, last, seen))
        yield pd.DataFrame({"user_id": [key[0]], "first_seen": [first], "last_seen": [last], "seen": [seen]})

    schema = "user_id long, first_seen timestamp, last_seen timestamp, seen long"
    return events.groupBy("user_id").applyInPandasWithState(update, schema, "first timestamp, last timestamp, seen long", "update", GroupStateTimeout.NoTimeout)


def drain(stream: DataFrame, mode: str, name: str) -> DataFrame:
    """Runs a stream over all that is there and returns what it wrote, batch by batch."""
    spark = stream.sparkSession
    out, marks = fresh_path(spark, name), fresh_path(spark, f"{name}-checkpoint")

    def put(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", marks).trigger(availableNow=True).foreachBatch(put).start()
    query.awaitTermination()
    return spark.read.parquet(out)
