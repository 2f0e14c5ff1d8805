"""Source mixing as a time-varying curriculum. Native DataFrame code.

Every source has a weight that changes over training time t in [0, 1]: its mean weight times a
schedule of equal phases. Targets come from the mean weights (water-filling under a cap of twice
the source); a source's demand by time t is the integral of its schedule times its target. The
documents of a source form one token stream in hash order, walked once or twice; inverting the
demand at a copy's place in that stream gives the time at which it is trained, and the documents are
range-sorted by that time.

Word counts are taken in one pass and written to the shared folder. Places in a stream are prefix
sums in two levels: over the hash buckets of a source, then within a bucket, so that no task holds
a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliograph.llm.common import WORD, text_of
from heliograph.runtime import saved

WEIGHTS = (3, 1, 2)
SHARE = (3, 2)  # 150 % as a fraction: targets are exact in doubles
CAP = 2
#: Phases of equal length with mean 1, one schedule per weight: early, steady, late.
SCHEDULES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, and the place of the document in its source's order (place, bucket)."""
    place = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    counted = docs.select("doc_id", "source", F.regexp_count(text_of("text"), F.lit(WORD)).cast("long").alias("size"))
    return counted.withColumns({"place": place, "bucket": F.substring(place, 1, 3)})


def targets(sources: DataFrame, weights=WEIGHTS, share=SHARE, cap: int = CAP) -> DataFrame:
    """source, source_size, weight, slot, target: weighted shares of all words, capped, excess reshared.

    `sources` has one row per source (source, source_size). Sources are ordered by code point, null
    last; a source without words has target 0.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("slot", (F.row_number().over(every) - 1) % len(weights))
    weighted = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("slot") + 1).cast("long"))
    limit = F.col("source_size") * cap
    by_ratio = Window.orderBy((limit / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    # Of the k sources with the lowest cap per weight at their cap, the rest share what is left.
    steps = weighted.withColumns({
        "total": F.sum("source_size").over(whole),
        "full_before": F.coalesce(F.sum(limit).over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "weight_left": F.sum("weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
    })
    left = F.col("total") * share[0] / share[1] - F.col("full_before")
    steps = steps.withColumns({"left": left, "capped": left * F.col("weight") >= limit * F.col("weight_left")})
    # Below the first source that stays under its cap, all share at that source's level.
    steps = steps.withColumn("rank", F.row_number().over(by_ratio))
    steps = steps.withColumn("level", F.min(F.when(~F.col("capped"), F.struct("rank", "left", "weight_left"))).over(whole))
    target = F.when(F.col("capped"), limit.cast("double")).otherwise(F.col("level.left") * F.col("weight") / F.col("level.weight_left"))
    return steps.select("source", "source_size", "weight", "slot", target.cast("double").alias("target"))


def time_of(fraction: Column, slot: Column, schedules=SCHEDULES) -> Column:
    """The time t at which the integral of the slot's schedule reaches `fraction` of its total."""
    out = F.lit(None).cast("double")
    for k, phases in enumerate(schedules):
        done, when, step = 0.0, None, 1.0 / len(phases)
        total = sum(phases)
        for i, height in enumerate(phases):
            part = height / total
            at = F.lit(i * step) + (fraction - F.lit(done)) / F.lit(part) * F.lit(step)
            when = F.when(fraction <= done + part + 1e-12, at) if when is None else when.when(fraction <= done + part + 1e-12, at)
            done += part
        out = F.when(slot == k, when.otherwise(F.lit(1.0))).otherwise(out)
    return F.least(F.greatest(out, F.lit(0.0)), F.lit(1.0))


def mix(docs: DataFrame, weights=WEIGHTS, share=SHARE, cap: int = CAP, schedules=SCHEDULES, by_document: bool = False) -> DataFrame:
    """One row per document, sorted by training position: doc_id, source, size, source_size, target, taken,
    copies (whole copies after rounding), position (time of its first copy; null if none is taken).

    `taken` counts the words that the mix takes, repeats included: the copy at which a source's
    demand ends is cut there, so a source's taken words are its target rounded down. Null text has
    size 0, a null source is a source of its own. Repeated rows (one doc_id) follow each other in the
    stream; with by_document they are one document of their sizes' sum. An empty table gives an empty result.
    """
    rows = sized(docs)
    if by_document:
        rows = rows.groupBy("doc_id", "source", "place", "bucket").agg(F.sum("size").alias("size"))
    rows = saved(rows, "mix-sizes")
    buckets = saved(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mix-buckets")
    goals = targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, cap)
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0))).join(
        goals.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))
    ).select(F.col("source").alias("_source"), F.col("bucket").alias("_bucket"), "offset", "source_size", "slot", "target")
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket"))
    inside = Window.partitionBy("source", "bucket").orderBy("place", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(offsets, same)
    start = F.col("offset") + F.col("inner")
    goal = F.floor("target").cast("long")
    taken, copies = F.lit(0).cast("long"), F.lit(0)
    for epoch in range(cap):
        left = goal - (start + F.lit(epoch) * F.col("source_size"))
        taken = taken + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left))
        copies = copies + F.when((F.col("size") > 0) & (2 * left >= F.col("size")), 1).otherwise(0)
    fraction = start / F.when(F.col("target") > 0, F.col("target"))
    position = F.when(taken > 0, time_of(fraction, F.col("slot"), schedules))
    out = placed.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), copies.alias("copies"),
                        position.alias("position"), start.alias("stream_start"), "slot")
    return out.orderBy(F.col("position").asc_nulls_last(), "doc_id")


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The documents of the mix in training order, a document taken twice as two rows.

    Whole documents only: the copy at which a source's demand ends is taken if at least half of it
    is. Documents without words have nothing to take. Rows that repeat a doc_id and source are one
    document, taken or left together.
    """
    plan = mix(docs, by_document=True, **settings).where("copies > 0")
    epochs = plan.select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), "slot", "source_size", "target", "stream_start",
        F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("epoch"),
    )
    at = F.least((F.col("stream_start") + F.col("epoch") * F.col("source_size")) / F.col("target"), F.lit(1.0))
    timed = epochs.select("__id", "__source", time_of(at, F.col("slot"), settings.get("schedules", SCHEDULES)).alias("__at"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source"))
    joined = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__row"), "doc_id", "source").join(timed, same)
    return joined.repartitionByRange("__at", "__id").sortWithinPartitions("__at", "__id").select("__row.*")
