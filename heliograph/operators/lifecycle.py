"""Lifecycles over repeated runs: membership, links and claims, snapshot diffs, upserts, merges, queues.

All are pure DataFrame functions of an old state and what a run observed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MISSING_RUNS = 2
OVERLAP_DAYS = 2
FULL_REFRESH_DAYS = 30
CURRENT = ["active", "missing", "no_longer_observed"]


def reconcile(state: DataFrame, observed: DataFrame, key: str, complete: bool, threshold: int = MISSING_RUNS, absent: str = "missing", gone: str = "tombstoned") -> DataFrame:
    """The next state of (key, status, missing_streak) after a run, with the category of each change.

    Incomplete runs and deltas never advance absence. Categories: added, recovered, reactivated,
    unchanged, `absent`, `gone` and absence_ignored.
    """
    both = state.select(key, F.col("status").alias("_was"), F.col("missing_streak").alias("_streak")).join(
        observed.select(key).distinct().withColumn("_seen", F.lit(True)), key, "full_outer"
    )
    seen, known = F.col("_seen").isNotNull(), F.col("_was").isNotNull()
    streak = F.coalesce("_streak", F.lit(0)) + 1
    category = (
        F.when(seen & ~known, "added").when(seen & (F.col("_was") == gone), "reactivated").when(seen & (F.col("_was") == absent), "recovered")
        .when(seen, "unchanged").when(F.col("_was") == gone, "unchanged").when(F.lit(not complete), "absence_ignored")
        .when(streak >= threshold, gone).otherwise(absent)
    )
    status = F.when(seen, "active").when(category.isin("unchanged", "absence_ignored"), F.col("_was")).otherwise(category)
    count = F.when(seen, 0).when(category.isin("unchanged", "absence_ignored"), F.col("_streak")).otherwise(streak)
    return both.select(key, status.alias("status"), count.cast("int").alias("missing_streak"), category.alias("category"))


def state_after_runs(seen: DataFrame, key: str, run: str, threshold: int = MISSING_RUNS) -> DataFrame:
    """(key, first_run, last_run, missing_streak, status) after a sequence of complete runs, in one pass.

    Only the runs since a key was last seen matter, so nothing is replayed.
    """
    last = seen.agg(F.max(run).alias("_end"))
    per = seen.groupBy(key).agg(F.min(run).alias("first_run"), F.max(run).alias("last_run")).crossJoin(F.broadcast(last))
    streak = F.datediff("_end", "last_run")
    return per.select(key, "first_run", "last_run", streak.alias("missing_streak"),
                      F.when(streak == 0, "active").when(streak < threshold, "missing").otherwise("inactive").alias("status"))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, change, changed_fields) of what was added, removed or changed; equal rows are left out."""
    a = old.select(key, *[F.col(f).alias(f"_o_{f}") for f in fields], F.lit(True).alias("_old"))
    b = new.select(key, *[F.col(f).alias(f"_n_{f}") for f in fields], F.lit(True).alias("_new"))
    differs = F.array_compact(F.array(*[F.when(~F.col(f"_o_{f}").eqNullSafe(F.col(f"_n_{f}")), F.lit(f)) for f in sorted(fields)]))
    joined = a.join(b, key, "full_outer").withColumn("d", differs)
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(F.size("d") > 0, "changed")
    return joined.select(key, change.alias("change"), F.when(change == "changed", F.array_join("d", ",")).otherwise("").alias("changed_fields")).where("change is not null")


def visible_claims(claims: DataFrame, key: str = "fingerprint_id") -> DataFrame:
    """(key, visible): a publication is visible while any source's claim on it is current."""
    return claims.groupBy(key).agg(F.max(F.col("status").isin(*CURRENT)).alias("visible"))


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def upsert(old: DataFrame, new: DataFrame, key: str, keep_first: list[str], keep_least: list[str] = ()) -> DataFrame:
    """New values win where not null; `keep_first` columns keep the old value, `keep_least` the smaller one."""
    a, b = old.alias("o"), new.alias("n")
    def pick(c):
        o, n = F.col(f"o.{c}"), F.col(f"n.{c}")
        return (F.coalesce(o, n) if c in keep_first else F.least(o, n) if c in keep_least else F.coalesce(n, o)).alias(c)
    return a.join(b, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer").select(F.coalesce(f"o.{key}", f"n.{key}").alias(key), *[pick(c) for c in old.columns if c != key])


def merge_shards(target: DataFrame, shards: list[DataFrame], run: str, key: str) -> DataFrame:
    """Target and shards as one; runs that the target has already are skipped, the last shard wins a key."""
    known = target.select(run).distinct()
    fresh = [s.join(known, run, "left_anti").withColumn("_shard", F.lit(i + 1)) for i, s in enumerate(shards)]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), fresh, target.withColumn("_shard", F.lit(0)))
    return latest(every.select(*target.columns, "_shard"), [key], [F.col("_shard").desc(), F.col(run).desc()]).drop("_shard")


def watermark_delta(rows: DataFrame, updated: str, last_success: Column, overlap_days: int = OVERLAP_DAYS) -> DataFrame:
    """Rows updated since the last success less an overlap."""
    return rows.where(F.col(updated) >= last_success - F.make_interval(days=F.lit(overlap_days)))


def refresh_states(checks: DataFrame, key: str, at: str, body: str, ok: str) -> DataFrame:
    """Each check with changed (body differs from the check before) and the last success up to it."""
    w = Window.partitionBy(key).orderBy(at)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.lag(body).over(w)
    return checks.withColumns({"changed": before.isNull() | (before != F.col(body)), "last_success": F.last(F.when(F.col(ok), F.col(at)), ignorenulls=True).over(upto)})


def claimable(queue: DataFrame, now: Column, limit: int) -> DataFrame:
    """The next jobs: pending ones and those whose lease has run out, oldest first."""
    open_ = (F.col("status") == "pending") | ((F.col("status") == "processing") & (F.col("lease_expires_at") <= now))
    return queue.where(open_).orderBy("created_at", "queue_id").limit(limit)


def enqueue(queue: DataFrame, dirty: DataFrame) -> DataFrame:
    """New jobs: dirty entities without a pending job, one each, the earliest reason first."""
    pending = queue.where("status = 'pending'").select("entity_kind", "entity_id").distinct()
    one = latest(dirty, ["entity_kind", "entity_id"], [F.col("created_at"), F.col("reason")])
    return one.join(pending, ["entity_kind", "entity_id"], "left_anti")


def finish_job(status: Column, success: Column, attempts: Column, token: Column, claim: Column, most: int = 3) -> Column:
    """The status after a worker reports: only the holder of the claim may; failures are retried `most` times."""
    return F.when(~token.eqNullSafe(claim), status).when(success, "done").when(attempts < most, "pending").otherwise("failed")


def carry_forward(carried: DataFrame, current: DataFrame, key: str, scalars: list[str], unions: list[str], fills: list[str]) -> DataFrame:
    """Old records brought into a new state: current scalars win and gaps fill, `unions` arrays are
    joined in order, `fills` arrays only fill when empty."""
    a, b = carried.alias("o"), current.alias("n")
    empty = F.array().cast("array<string>")
    columns = [F.coalesce(f"n.{c}", f"o.{c}").alias(c) for c in scalars]
    columns += [F.array_union(F.coalesce(f"n.{c}", empty), F.coalesce(f"o.{c}", empty)).alias(c) for c in unions]
    columns += [F.when(F.size(F.coalesce(f"n.{c}", empty)) > 0, F.col(f"n.{c}")).otherwise(F.coalesce(f"o.{c}", empty)).alias(c) for c in fills]
    return a.join(b, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer").select(F.coalesce(f"n.{key}", f"o.{key}").alias(key), *columns)


def inventory_errors(reported: Column, unique: Column, existing: Column, ratio: float = 0.2, least: int = 5) -> Column:
    """Why a full inventory can't be trusted: count_mismatch, empty_inventory, shrunken_inventory."""
    return F.array_compact(F.array(
        F.when(reported != unique, "count_mismatch"), F.when((unique == 0) & (existing > 0), "empty_inventory"),
        F.when((existing >= least) & (unique > 0) & (unique < existing * ratio), "shrunken_inventory"),
    ))


def changed_works(old: DataFrame, new: DataFrame, links: DataFrame) -> DataFrame:
    """(entity_kind, entity_id, reason): works that are new or whose text hash differs, and their people."""
    joined = new.select("work_id", F.col("text_hash").alias("_n")).join(old.select("work_id", F.col("text_hash").alias("_o")), "work_id", "left")
    dirty = joined.where(~F.col("_n").eqNullSafe(F.col("_o"))).select("work_id", F.when(F.col("_o").isNull(), "created").otherwise("text_changed").alias("reason"))
    papers = dirty.select(F.lit("paper").alias("entity_kind"), F.col("work_id").cast("string").alias("entity_id"), "reason")
    careers = links.where(F.col("status").isin("active", "missing")).join(dirty, "work_id").select(
        F.lit("career").alias("entity_kind"), F.col("person_id").cast("string").alias("entity_id"), F.lit("work_changed").alias("reason")).distinct()
    return papers.unionByName(careers)
