"""Lifecycle, identity and evaluation queries. A day of events is a run; a user is a person."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from heliograph.operators import identity as I
from heliograph.operators import lifecycle as L
from heliograph.plans.base import table


def _seen(spark, d):
    return table(spark, d, "events").select(F.col("user_id"), F.to_date("ts").alias("run")).distinct()


_DAY = "(SELECT DISTINCT user_id, ts::DATE AS run FROM events)"


def membership_states(spark, d):
    out = L.state_after_runs(_seen(spark, d), "user_id", "run")
    return out.select("user_id", F.date_format("first_run", "yyyy-MM-dd").alias("first_run"), F.date_format("last_run", "yyyy-MM-dd").alias("last_run"), "missing_streak", "status")


def _state(spark, d):
    """A state in the middle of the month: who was seen before day 15, gone if not in the last four days."""
    before = _seen(spark, d).where("run < '2024-01-15'").groupBy("user_id").agg(F.max("run").alias("last"))
    gap = F.datediff(F.lit("2024-01-14"), "last")
    return before.select("user_id", F.when(gap == 0, "active").when(gap == 1, "missing").when(gap < 5, "tombstoned").otherwise("tombstoned").alias("status"), F.least(gap, F.lit(2)).alias("missing_streak"))


_STATE = f"st AS (SELECT user_id, CASE WHEN gap = 0 THEN 'active' WHEN gap = 1 THEN 'missing' ELSE 'tombstoned' END AS status, least(gap, 2) AS missing_streak FROM (SELECT user_id, date_diff('day', max(run), DATE '2024-01-14') AS gap FROM {_DAY} WHERE run < DATE '2024-01-15' GROUP BY 1))"
_RECON = f"""WITH {_STATE}, ob AS (SELECT DISTINCT user_id, true AS seen FROM {_DAY} WHERE run = DATE '2024-01-15'),
 j AS (SELECT coalesce(st.user_id, ob.user_id) AS user_id, status AS was, missing_streak AS s, seen FROM st FULL JOIN ob ON st.user_id = ob.user_id),
 c AS (SELECT *, CASE WHEN seen AND was IS NULL THEN 'added' WHEN seen AND was = 'tombstoned' THEN 'reactivated' WHEN seen AND was = 'missing' THEN 'recovered' WHEN seen THEN 'unchanged'
       WHEN was = 'tombstoned' THEN 'unchanged' WHEN NOT COMPLETE THEN 'absence_ignored' WHEN s + 1 >= 2 THEN 'tombstoned' ELSE 'missing' END AS category FROM j)
 SELECT user_id, CASE WHEN seen THEN 'active' WHEN category IN ('unchanged', 'absence_ignored') THEN was ELSE category END AS status,
        CASE WHEN seen THEN 0 WHEN category IN ('unchanged', 'absence_ignored') THEN s ELSE s + 1 END::INT AS missing_streak, category FROM c"""


def reconcile_full(spark, d):
    return L.reconcile(_state(spark, d), _seen(spark, d).where("run = '2024-01-15'"), "user_id", True)


def reconcile_delta(spark, d):
    return L.reconcile(_state(spark, d), _seen(spark, d).where("run = '2024-01-15'"), "user_id", False)


def _day_snapshot(spark, d, day):
    return table(spark, d, "events").where(F.to_date("ts") == F.lit(day)).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.min("event_type").alias("first_type"), F.max("event_type").alias("last_type"))


def snapshot_changes(spark, d):
    return L.snapshot_diff(_day_snapshot(spark, d, "2024-01-10"), _day_snapshot(spark, d, "2024-01-11"), "user_id", ["n", "first_type", "last_type"])


def claim_visibility(spark, d):
    claims = table(spark, d, "lineitem").select(F.col("l_partkey").alias("fingerprint_id"), F.when(F.col("l_returnflag") == "R", "tombstoned").when(F.col("l_returnflag") == "A", "no_longer_observed").otherwise("tombstoned").alias("status"))
    return L.visible_claims(claims)


def refresh_states(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", F.struct("ts", "event_id").alias("at"), F.col("event_type").alias("body"), (F.col("value") > 30).alias("ok"))
    out = L.refresh_states(e, "user_id", "at", "body", "ok")
    return out.select("event_id", "changed", F.col("last_success.event_id").alias("last_success"))


def watermark_delta(spark, d):
    e = table(spark, d, "events")
    return L.watermark_delta(e, "ts", F.to_timestamp(F.lit("2024-01-28 00:00:00"))).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def dirty_queue(spark, d):
    e = table(spark, d, "events")
    queue = e.where("event_type = 'view' or event_id % 3 = 0").select(F.col("event_id").alias("queue_id"), F.lit("paper").alias("entity_kind"), F.col("user_id").cast("string").alias("entity_id"), F.when(F.col("value") < 10, "pending").otherwise("done").alias("status"))
    dirty = e.where("event_id % 4 = 0").select(F.lit("paper").alias("entity_kind"), F.col("user_id").cast("string").alias("entity_id"), F.col("event_type").alias("reason"), F.col("event_id").alias("created_at"))
    return L.enqueue(queue, dirty).select("entity_id", "reason", "created_at")


def claimable_jobs(spark, d):
    e = table(spark, d, "events")
    queue = e.select(F.col("event_id").alias("queue_id"), F.when(F.col("event_id") % 3 == 0, "pending").when(F.col("event_id") % 3 == 1, "processing").otherwise("done").alias("status"), F.col("ts").alias("created_at"), F.col("ts").alias("lease_expires_at"))
    return L.claimable(queue, F.to_timestamp(F.lit("2024-01-03 00:00:00")), 100).select("queue_id")


def changed_works(spark, d):
    o = table(spark, d, "orders")
    old = o.where("o_orderkey % 9 <> 0").select(F.col("o_orderkey").alias("work_id"), F.md5(F.concat_ws("|", "o_orderpriority", F.when(F.col("o_orderkey") % 4 == 0, "x").otherwise("y"))).alias("text_hash"))
    new = o.select(F.col("o_orderkey").alias("work_id"), F.md5(F.concat_ws("|", "o_orderpriority", F.lit("y"))).alias("text_hash"))
    links = o.select(F.col("o_orderkey").alias("work_id"), F.col("o_custkey").alias("person_id"), F.when(F.col("o_orderstatus") == "F", "tombstoned").otherwise("active").alias("status"))
    return L.changed_works(old, new, links)


def shard_merge(spark, d):
    c = table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 5).alias("run_id"), "c_name")
    target = c.where("run_id < 2")
    first = c.where("run_id in (1, 2)").withColumn("c_name", F.concat("c_name", F.lit("-a")))
    second = c.where("run_id in (2, 3)").withColumn("c_name", F.concat("c_name", F.lit("-b")))
    return L.merge_shards(target, [first, second], "run_id", "c_custkey")


def upsert_people(spark, d):
    s = table(spark, d, "supplier")
    old = s.where("s_suppkey % 2 = 0").select("s_suppkey", "s_name", F.col("s_nationkey").alias("first_seen"), "s_acctbal")
    new = s.where("s_suppkey % 3 = 0").select("s_suppkey", F.upper("s_name").alias("s_name"), (F.col("s_nationkey") - 1).alias("first_seen"), F.lit(None).cast("double").alias("s_acctbal"))
    return L.upsert(old, new, "s_suppkey", [], ["first_seen"])


def identity_candidates(spark, d):
    p = table(spark, d, "part")
    keys = p.select(F.lit(1).alias("institution_id"), F.col("p_partkey").alias("person_id"), F.lit("email").alias("kind"), F.concat_ws("|", "p_brand", "p_type", "p_size").alias("value"))
    keys = keys.unionByName(p.where("p_partkey % 10 = 0").select(F.lit(1).alias("institution_id"), F.col("p_partkey").alias("person_id"), F.lit("orcid").alias("kind"), F.concat_ws("|", "p_brand", "p_size").alias("value")))
    pairs = I.candidate_pairs(keys)
    return pairs.withColumn("d", I.decide(F.col("kinds"), F.lit(True), F.lit(False))).select("left", "right", "d.priority", "d.reason")


def duplicate_groups(spark, d):
    p = table(spark, d, "part").select(F.lit(1).alias("institution_id"), F.col("p_partkey").alias("person_id"), F.lit("email").alias("kind"), F.concat_ws("|", "p_brand", "p_type", "p_size").alias("value"))
    return I.groups(I.shared_key_edges(p))


def alias_resolution(spark, d):
    c = table(spark, d, "customer")
    aliases = c.where("c_custkey % 16 <> 0").select(F.col("c_custkey").alias("alias"), (F.col("c_custkey") + 1).alias("canonical"))
    return I.resolve_aliases(aliases)


def email_verdicts(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_linestatus") == "O").alias("official"), (F.col("l_returnflag") != "R").alias("aligned"))
    return li.withColumn("v", I.email_verdict(F.col("official"), F.col("aligned"))).groupBy("v.verdict").agg(F.count(F.lit(1)).alias("n"), F.max("v.confidence").alias("confidence"))


def contact_verdicts(spark, d):
    li = table(spark, d, "lineitem").select("l_suppkey", (F.col("l_linestatus") == "O").alias("official"), (F.col("l_tax") < 0.07).alias("aligned"), F.when(F.col("l_linenumber") == 1, "person_local").otherwise("ambiguous_email").alias("association"))
    return I.contact_confidence(li, "l_suppkey")


QUERIES = {f.__name__: f for f in (
    membership_states, reconcile_full, reconcile_delta, snapshot_changes, claim_visibility, refresh_states, watermark_delta, dirty_queue, claimable_jobs,
    changed_works, shard_merge, upsert_people, identity_candidates, duplicate_groups, alias_resolution, email_verdicts, contact_verdicts,
)}

_SNAP = "SELECT user_id, count(*) AS n, min(event_type) AS f, max(event_type) AS l FROM events WHERE ts::DATE = DATE '{0}' GROUP BY 1"
_KEYS = "SELECT p_partkey AS p, 'email' AS kind, p_brand || '|' || p_type || '|' || p_size AS v FROM part"
SQL = {
    "membership_states": f"""WITH p AS (SELECT user_id, min(run) AS f, max(run) AS l FROM {_DAY} GROUP BY 1), e AS (SELECT max(l) AS e FROM p)
      SELECT user_id, strftime(f, '%Y-%m-%d') AS first_run, strftime(l, '%Y-%m-%d') AS last_run, date_diff('day', l, e)::INT AS missing_streak,
      CASE date_diff('day', l, e) WHEN 0 THEN 'active' WHEN 1 THEN 'missing' ELSE 'inactive' END AS status FROM p, e""",
    "reconcile_full": _RECON.replace("COMPLETE", "true"),
    "reconcile_delta": _RECON.replace("COMPLETE", "false"),
    "snapshot_changes": f"""WITH a AS ({_SNAP.format('2024-01-10')}), b AS ({_SNAP.format('2024-01-11')}),
      j AS (SELECT coalesce(a.user_id, b.user_id) AS user_id, a.user_id IS NULL AS added, b.user_id IS NULL AS removed,
            concat_ws(',', CASE WHEN a.f IS DISTINCT FROM b.f THEN 'first_type' END, CASE WHEN a.l IS DISTINCT FROM b.l THEN 'last_type' END, CASE WHEN a.n IS DISTINCT FROM b.n THEN 'n' END) AS x FROM a FULL JOIN b ON a.user_id = b.user_id)
      SELECT user_id, CASE WHEN added THEN 'added' WHEN removed THEN 'removed' ELSE 'changed' END AS change, CASE WHEN added OR removed THEN '' ELSE x END AS changed_fields FROM j WHERE added OR removed OR x <> ''""",
    "claim_visibility": "SELECT l_partkey AS fingerprint_id, bool_or(l_returnflag = 'A') AS visible FROM lineitem GROUP BY 1",
    "refresh_states": """SELECT event_id, coalesce(lag(event_type) OVER w <> event_type, true) AS changed, last_value(CASE WHEN value > 30 THEN event_id END IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS last_success
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "watermark_delta": "SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-26 00:00:00' GROUP BY 1",
    "dirty_queue": """WITH q AS (SELECT DISTINCT user_id::VARCHAR AS e FROM events WHERE (event_type = 'view' OR event_id % 3 = 0) AND value < 10)
      SELECT user_id::VARCHAR AS entity_id, event_type AS reason, event_id AS created_at FROM events WHERE event_id % 4 = 0 AND user_id::VARCHAR NOT IN (SELECT e FROM q)
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id, event_type) = 1""",
    "claimable_jobs": "SELECT event_id AS queue_id FROM events WHERE event_id % 3 = 0 OR (event_id % 3 = 1 AND ts <= TIMESTAMP '2024-01-03 00:00:00') ORDER BY ts, event_id LIMIT 100",
    "changed_works": """WITH d AS (SELECT o_orderkey AS w, CASE WHEN o_orderkey % 9 = 0 THEN 'created' ELSE 'text_changed' END AS reason FROM orders WHERE o_orderkey % 9 = 0 OR o_orderkey % 4 = 0)
      SELECT 'paper' AS entity_kind, w::VARCHAR AS entity_id, reason FROM d UNION ALL
      SELECT DISTINCT 'career', o_custkey::VARCHAR, 'work_changed' FROM orders JOIN d ON o_orderkey = w WHERE o_orderstatus <> 'F'""",
    "shard_merge": """SELECT c_custkey, c_custkey % 5 AS run_id, c_name || CASE c_custkey % 5 WHEN 2 THEN '-b' WHEN 3 THEN '-b' ELSE '' END AS c_name FROM customer WHERE c_custkey % 5 < 4""",
    "upsert_people": """SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN upper(s_name) ELSE s_name END AS s_name, CASE WHEN s_suppkey % 3 = 0 THEN s_nationkey - 1 ELSE s_nationkey END AS first_seen,
      CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS s_acctbal FROM supplier WHERE s_suppkey % 2 = 0 OR s_suppkey % 3 = 0""",
    "identity_candidates": f"""WITH k AS ({_KEYS} UNION ALL SELECT p_partkey, 'orcid', p_brand || '|' || p_size FROM part WHERE p_partkey % 10 = 0)
      SELECT a.p AS "left", b.p AS "right", CASE WHEN bool_or(kind = 'orcid') THEN 0 ELSE 6 END AS priority, CASE WHEN bool_or(kind = 'orcid') THEN 'same_orcid' ELSE 'same_normalized_name_and_email' END AS reason
      FROM k a JOIN k b USING (kind, v) WHERE a.p < b.p GROUP BY ALL""",
    "duplicate_groups": f"SELECT p AS node, min(p) OVER (PARTITION BY v) AS root FROM ({_KEYS}) QUALIFY count(*) OVER (PARTITION BY v) > 1",
    "alias_resolution": "SELECT c_custkey AS alias, least((c_custkey // 16 + 1) * 16, (SELECT max(c_custkey) + 1 FROM customer)) AS canonical FROM customer WHERE c_custkey % 16 <> 0",
    "email_verdicts": """SELECT CASE WHEN l_linestatus = 'O' AND l_returnflag <> 'R' THEN 'official_domain_aligned' WHEN l_linestatus = 'O' THEN 'official_source_domain_conflict' WHEN l_returnflag <> 'R' THEN 'aligned_domain_third_party_source' ELSE 'unverified_email' END AS verdict,
      count(*) AS n, max(CASE WHEN l_linestatus = 'O' AND l_returnflag <> 'R' THEN 0.95 WHEN l_linestatus = 'O' THEN 0.55 WHEN l_returnflag <> 'R' THEN 0.45 ELSE 0.25 END)::DOUBLE AS confidence FROM lineitem GROUP BY 1""",
    "contact_verdicts": """WITH f AS (SELECT l_suppkey, bool_or(l_linestatus = 'O' AND l_tax < 0.07 AND l_linenumber = 1) AS lo, bool_or(l_linestatus = 'O' AND l_tax < 0.07) AS al, bool_or(l_linestatus = 'O' AND l_tax >= 0.07) AS co FROM lineitem GROUP BY 1),
      c AS (SELECT *, CASE WHEN lo THEN 'high' WHEN al THEN 'medium' ELSE 'low' END AS k FROM f)
      SELECT l_suppkey, k AS contact_confidence, k AS affiliation_confidence, CASE WHEN co THEN 'current_affiliation_conflict' WHEN k = 'high' THEN 'high_confidence_contactable' ELSE 'stale_risk' END AS verdict FROM c""",
}
