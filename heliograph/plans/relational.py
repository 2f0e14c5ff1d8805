"""The relational surface: views, audits, roll-ups, top-N and latest-per-key, on the driver's star schema.

Customers play people (nation = institution), suppliers contact records, orders the fetch log,
line items publications.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from heliograph.operators.lifecycle import latest
from heliograph.plans.base import table


def _people(spark, d):
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("person_id"), F.col("c_name").alias("display_name"), F.col("c_nationkey").alias("institution_id"),
        F.when(F.col("c_acctbal") < 0, "inactive").when(F.col("c_custkey") % 7 == 0, F.lit(None)).otherwise("active").alias("membership_status"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit(None)).otherwise(F.col("c_mktsegment")).alias("area"), F.col("c_acctbal").alias("score"),
    )


_PEOPLE = """people AS (SELECT c_custkey AS person_id, c_name AS display_name, c_nationkey AS institution_id,
  CASE WHEN c_acctbal < 0 THEN 'inactive' WHEN c_custkey % 7 = 0 THEN NULL ELSE 'active' END AS membership_status,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_mktsegment END AS area, c_acctbal AS score FROM customer)"""
_CUR = "coalesce(membership_status, 'active') <> 'inactive'"


def current_people(spark, d):
    return _people(spark, d).where(F.coalesce("membership_status", F.lit("active")) != "inactive").select("person_id", "display_name", "institution_id")


def inactive_people(spark, d):
    return _people(spark, d).where("membership_status = 'inactive'").select("person_id", "institution_id")


def point_lookup(spark, d):
    return _people(spark, d).where("person_id = 42")


def latest_fetch_per_source(spark, d):
    o = table(spark, d, "orders").where(F.col("o_orderstatus").isin("F", "O") & (F.col("o_totalprice") > 0))
    return latest(o, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]).select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


def latest_run_per_institution(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    runs = table(spark, d, "orders").join(c, "o_custkey")
    return runs.groupBy("c_nationkey").agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("run"))


def research_ready_view(spark, d):
    p = _people(spark, d).where("coalesce(membership_status, 'active') <> 'inactive'")
    pubs = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("person_id")).agg(F.count(F.lit(1)).alias("pubs"))
    return p.join(pubs, "person_id", "left").where("area is not null or pubs is not null").select("person_id", "institution_id", F.coalesce("pubs", F.lit(0)).alias("pubs"))


def research_review_queue(spark, d):
    p = _people(spark, d).where("coalesce(membership_status, 'active') <> 'inactive' and area is null")
    urgent = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("person_id"))
    return p.join(urgent, "person_id", "left_anti").select("person_id", "display_name")


def active_research_pool(spark, d):
    p = _people(spark, d).where("coalesce(membership_status, 'active') <> 'inactive'")
    urgent = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("person_id")).distinct().withColumn("pub", F.lit(True))
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("institution_id"), "n_name")
    return p.join(urgent, "person_id", "left").where("area is not null or pub").join(n, "institution_id").select("person_id", "n_name")


def contact_view(spark, d):
    v = table(spark, d, "supplier").select(F.col("s_nationkey").alias("institution_id"), "s_suppkey", F.when(F.col("s_acctbal") > 5000, "high").when(F.col("s_acctbal") > 0, "medium").otherwise("none").alias("confidence"))
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("institution_id"), "n_name")
    return v.where(F.col("confidence").isin("high", "medium")).join(n, "institution_id").select("s_suppkey", "n_name", "confidence")


def contact_review_queue(spark, d):
    v = table(spark, d, "supplier").select("s_suppkey", F.when(F.col("s_acctbal") > 5000, "high").when(F.col("s_acctbal") > 0, "medium").otherwise("none").alias("confidence"), "s_nationkey")
    return v.where(F.col("confidence").isin("none", "low") | F.col("s_nationkey").isin(1, 2, 3)).select("s_suppkey", "confidence")


def publication_summary(spark, d):
    li = table(spark, d, "lineitem")
    claims = li.groupBy("l_orderkey").agg(F.max(F.col("l_linestatus") == "O").alias("current"), F.count(F.lit(1)).alias("claims"))
    o = table(spark, d, "orders").join(claims, F.col("o_orderkey") == F.col("l_orderkey"), "left").where("claims is null or current")
    return o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max(F.year("o_orderdate")).alias("latest_year"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("with_doi"))


def publications_top20(spark, d):
    li = table(spark, d, "lineitem")
    return latest_n(li, ["l_suppkey"], [F.col("l_shipdate").desc_nulls_last(), F.col("l_orderkey"), F.col("l_linenumber")], 20).select("l_suppkey", "l_orderkey", "l_linenumber", "n")


def latest_n(rows, keys, order, n):
    return rows.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("n") <= n)


def works_per_person(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    return o.where(F.col("o_orderstatus").isin("O", "P")).join(c, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "o_orderkey", "o_orderstatus")


def max_updated(spark, d):
    observed = table(spark, d, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return table(spark, d, "lineitem").join(observed, "l_suppkey", "left_semi").groupBy("l_suppkey").agg(F.date_format(F.max("l_shipdate"), "yyyy-MM-dd").alias("watermark"))


def institution_quality_report(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), "n_name")
    people = _people(spark, d).groupBy(F.col("institution_id").alias("k")).agg(
        F.count_distinct("person_id").alias("people"), F.count_if(F.coalesce("membership_status", F.lit("active")) != "inactive").alias("current"),
        F.mode("area", True).alias("top_area"))
    contacts = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count_distinct("s_suppkey").alias("contacts"), F.round(F.max("s_acctbal"), 2).alias("best"))
    orders = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    works = orders.groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("works"), F.count_if(F.col("o_orderstatus") == "F").alias("failures"))
    out = n.join(people, "k", "left").join(contacts, "k", "left").join(works, "k", "left")
    z = lambda c: F.coalesce(c, F.lit(0))
    notes = F.concat_ws("; ", F.when(z("contacts") > 0.1 * z("people"), "mostly contactable"), F.when(z("failures") > 0, "has failures"))
    return out.select("n_name", z("people").alias("people"), z("current").alias("current"), "top_area", z("contacts").alias("contacts"), "best", z("works").alias("works"), z("failures").alias("failures"), notes.alias("notes"))


def audit_counts(spark, d):
    p = _people(spark, d).agg(F.count(F.lit(1)).alias("people"), F.count_if(F.coalesce("membership_status", F.lit("active")) != "inactive").alias("current_people"), F.count_distinct("institution_id").alias("institutions"))
    o = table(spark, d, "orders").agg(F.count(F.lit(1)).alias("fetches"), F.count_if(F.col("o_totalprice").between(20000, 29999) | (F.col("o_orderstatus") == "P")).alias("good_fetches"))
    empty = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("r")).where("r = 0").agg(F.count(F.lit(1)).alias("without_returns"))
    per = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.max("l_linenumber").alias("m")).agg(F.sum("m").alias("sum_of_max"))
    return p.crossJoin(o).crossJoin(empty).crossJoin(per)  # four single rows


def failure_reasons(spark, d):
    return table(spark, d, "events").where("value < 20").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "event_type")


def run_capture_metrics(spark, d):
    e = table(spark, d, "events")
    return e.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("run")).agg(F.round(F.sum(F.coalesce("value", F.lit(0.0))), 2).alias("total"), F.count_if(F.col("value") > 50).alias("above"), F.count(F.lit(1)).alias("n"))


def pool_counts(spark, d):
    n = table(spark, d, "nation")
    c = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("c_acctbal") > 5000, 1).otherwise(0)).alias("strong"))
    return n.join(c, F.col("n_nationkey") == F.col("c_nationkey"), "left").select("n_name", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("strong", F.lit(0)).alias("strong"))


def best_evidence_per_person(spark, d):
    li = table(spark, d, "lineitem")
    order = [(F.col("l_linestatus") == "O").desc(), (F.col("l_returnflag") == "N").desc(), F.col("l_quantity").desc(), F.col("l_orderkey"), F.col("l_linenumber")]
    return latest(li, ["l_partkey"], order).select("l_partkey", "l_orderkey", "l_linenumber")


def stratified_sample(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", F.sha2(F.concat_ws(":", F.lit("20260712"), F.col("c_custkey")), 256).alias("h"))
    return latest_n(c, ["c_mktsegment"], [F.col("h")], 4).select("c_mktsegment", "c_custkey", "n")


def sample_per_institution(spark, d):
    c = table(spark, d, "customer").where("c_acctbal > 0").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    c = c.withColumn("h", F.sha2(F.concat(F.lit("7:"), F.col("c_custkey").cast("string")), 256))
    return latest_n(c, ["n_name"], [F.col("h")], 2).select("n_name", "c_custkey")


def region_audit(spark, d):
    n, s = table(spark, d, "nation"), table(spark, d, "supplier")
    by_key = s.groupBy(F.col("s_nationkey").alias("k")).agg(F.min("s_suppkey").alias("first_key"))
    by_name = s.withColumn("nm", F.concat(F.lit("NATION_"), F.col("s_nationkey"))).groupBy("nm").agg(F.min("s_suppkey").alias("first_name"))
    r = table(spark, d, "region")
    return (n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).join(by_key, F.col("n_nationkey") == F.col("k"), "left").join(by_name, F.col("n_name") == F.col("nm"), "left")
            .select("n_name", "r_name", F.coalesce("first_key", "first_name").alias("matched")))


def coverage_ratios(spark, d):
    p = _people(spark, d)
    return p.groupBy("institution_id").agg(F.round(F.avg(F.when(F.col("area").isNotNull(), 1.0).otherwise(0.0)), 6).alias("area"), F.round(F.avg(F.when(F.col("membership_status").isNotNull(), 1.0).otherwise(0.0)), 6).alias("status"))


def quality_gate(spark, d):
    m = _people(spark, d).groupBy("institution_id").agg(F.count(F.lit(1)).alias("n"), F.avg(F.when(F.col("area").isNotNull(), 1.0).otherwise(0.0)).alias("coverage"), F.count_if(F.col("membership_status") == "inactive").alias("inactive"))
    return m.select("institution_id", (F.col("n") >= 5).alias("enough"), (F.col("coverage") >= 0.75).alias("covered"), ((F.col("n") >= 5) & (F.col("coverage") >= 0.75) & (F.col("inactive") * 4 <= F.col("n"))).alias("passed"))


def shared_value_groups(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_brand", F.concat_ws("|", "p_type", "p_size").alias("email"))
    g = p.groupBy("email").agg(F.count_distinct("p_partkey").alias("people"), F.count_distinct("p_brand").alias("canonical"))
    return g.where("people > 1").select("email", "people", F.when(F.col("canonical") > 1, "cross_canonical").otherwise("same_person_alias").alias("kind"))


def same_name_groups(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_brand", F.lower(F.trim(F.regexp_replace("p_name", r"\s+", " "))).alias("name"))
    return p.groupBy("p_brand", "name").agg(F.count_distinct("p_partkey").alias("n"), F.min("p_partkey").alias("least")).where("n > 1")


def latency_p95(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.round(F.percentile("value", 0.95), 6).alias("p95"), F.count(F.lit(1)).alias("n"))


def institution_counts_rollup(spark, d):
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.rollup("n_regionkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"))


def evidence_unpivot(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").cast("string").alias("nation"))
    return s.unpivot(["s_suppkey"], ["s_name", "nation"], "field_name", "field_value").where("field_value is not null")


def evidence_by_id_list(spark, d):
    o = table(spark, d, "orders").where("o_orderpriority = '5-LOW'").groupBy("o_custkey").agg(F.collect_set("o_orderkey").alias("ids"))
    wanted = o.select(F.explode("ids").alias("l_orderkey")).distinct()
    return table(spark, d, "lineitem").join(wanted, "l_orderkey", "left_semi").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))


def like_selection(spark, d):
    pages = table(spark, d, "pages")
    hit = F.col("url").ilike("%UTM_source%") | F.col("url").ilike("%/en/1%")
    return pages.where(hit).select("page_id").distinct()


def scope_selection(spark, d):
    p = _people(spark, d)
    return p.where((F.col("institution_id") == 3) & (F.contains(F.lower("area"), F.lit("build")) | F.col("person_id").isin(1, 2, 3))).select("person_id")


def work_policy(spark, d):
    allowed = table(spark, d, "part").where("p_size <= 5").select(F.col("p_partkey").alias("l_partkey"))
    li = table(spark, d, "lineitem")
    return li.join(allowed, "l_partkey", "left_semi").unionByName(li.where("l_returnflag = 'R' and l_linenumber = 1")).select("l_orderkey", "l_linenumber").distinct()


def missing_policy_ids(spark, d):
    wanted = spark.range(1, 400, 7).withColumnRenamed("id", "s_suppkey")
    return wanted.join(table(spark, d, "supplier"), "s_suppkey", "left_anti")


def union_profile_works(spark, d):
    li = table(spark, d, "lineitem")
    parts = [li.where(f"l_suppkey = {k}").select(F.lit(k).alias("profile"), "l_partkey") for k in (1, 2, 3)]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return every.groupBy("l_partkey").agg(F.min("profile").alias("profile"), F.count_distinct("profile").alias("profiles"))


def stage_support(spark, d):
    c = table(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("field")).agg(F.count_distinct("c_custkey").alias("pis"), F.count_distinct("c_nationkey").alias("institutions"))
    return c.select("field", "pis", "institutions", ((F.col("pis") >= 100) & (F.col("institutions") >= 5)).alias("eligible"))


def vector_storage(spark, d):
    e = table(spark, d, "embeddings").dropDuplicates(["vec_id"])
    return e.groupBy("label").agg(F.sum(32 + 8 * F.size("embedding")).alias("bytes"), F.count(F.lit(1)).alias("vectors"))


def orphan_check(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, d, "orders").where("o_orderkey % 11 <> 0").select(F.col("o_orderkey").alias("l_orderkey"))
    return li.join(orders, "l_orderkey", "left_anti").agg(F.count(F.lit(1)).alias("orphans"), F.count_distinct("l_orderkey").alias("orders"))


QUERIES = {f.__name__: f for f in (
    current_people, inactive_people, point_lookup, latest_fetch_per_source, latest_run_per_institution, research_ready_view, research_review_queue,
    active_research_pool, contact_view, contact_review_queue, publication_summary, publications_top20, works_per_person, max_updated, institution_quality_report,
    audit_counts, failure_reasons, run_capture_metrics, pool_counts, best_evidence_per_person, stratified_sample, sample_per_institution, region_audit,
    coverage_ratios, quality_gate, shared_value_groups, same_name_groups, latency_p95, institution_counts_rollup, evidence_unpivot, evidence_by_id_list,
    like_selection, scope_selection, work_policy, missing_policy_ids, union_profile_works, stage_support, vector_storage, orphan_check,
)}

_CONF = "CASE WHEN s_acctbal > 5000 THEN 'high' WHEN s_acctbal > 0 THEN 'medium' ELSE 'none' END"
SQL = {
    "current_people": f"WITH {_PEOPLE} SELECT person_id, display_name, institution_id FROM people WHERE {_CUR}",
    "inactive_people": f"WITH {_PEOPLE} SELECT person_id, institution_id FROM people WHERE membership_status = 'inactive'",
    "point_lookup": f"WITH {_PEOPLE} SELECT * FROM people WHERE person_id = 42",
    "latest_fetch_per_source": "SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_orderstatus IN ('F','O') AND o_totalprice > 0 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
    "latest_run_per_institution": "SELECT c_nationkey, o_orderkey AS run FROM orders JOIN customer ON o_custkey = c_custkey QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
    "research_ready_view": f"WITH {_PEOPLE} SELECT person_id, institution_id, (SELECT count(*) FROM orders WHERE o_custkey = person_id AND o_orderpriority = '1-URGENT') AS pubs FROM people WHERE {_CUR} AND (area IS NOT NULL OR EXISTS (SELECT 1 FROM orders WHERE o_custkey = person_id AND o_orderpriority = '1-URGENT'))",
    "research_review_queue": f"WITH {_PEOPLE} SELECT person_id, display_name FROM people WHERE {_CUR} AND area IS NULL AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = person_id AND o_orderpriority = '1-URGENT')",
    "active_research_pool": f"WITH {_PEOPLE} SELECT person_id, n_name FROM people JOIN nation ON n_nationkey = institution_id WHERE {_CUR} AND (area IS NOT NULL OR EXISTS (SELECT 1 FROM orders WHERE o_custkey = person_id AND o_orderpriority = '1-URGENT'))",
    "contact_view": f"SELECT s_suppkey, n_name, {_CONF} AS confidence FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 0",
    "contact_review_queue": f"SELECT s_suppkey, {_CONF} AS confidence FROM supplier WHERE s_acctbal <= 0 OR s_nationkey IN (1, 2, 3)",
    "publication_summary": "SELECT o_custkey, count(*) AS n, max(year(o_orderdate)) AS latest_year, count(*) FILTER (o_orderpriority = '1-URGENT') AS with_doi FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) OR EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'O') GROUP BY 1",
    "publications_top20": "SELECT l_suppkey, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC NULLS LAST, l_orderkey, l_linenumber) AS n FROM lineitem QUALIFY n <= 20",
    "works_per_person": "SELECT c_custkey, o_orderkey, o_orderstatus FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderstatus IN ('O', 'P')",
    "max_updated": "SELECT l_suppkey, strftime(max(l_shipdate), '%Y-%m-%d') AS watermark FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) GROUP BY 1",
    "institution_quality_report": f"""WITH {_PEOPLE}, a AS (SELECT institution_id AS k, area, count(*) AS n FROM people WHERE area IS NOT NULL GROUP BY ALL),
      q AS (SELECT n_name, (SELECT count(*) FROM people WHERE institution_id = n_nationkey) AS people, (SELECT count(*) FROM people WHERE institution_id = n_nationkey AND {_CUR}) AS current,
        (SELECT area FROM a WHERE k = n_nationkey ORDER BY n DESC, area LIMIT 1) AS top_area, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS contacts,
        (SELECT round(max(s_acctbal), 2) FROM supplier WHERE s_nationkey = n_nationkey) AS best,
        (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = n_nationkey) AS works,
        (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = n_nationkey AND o_orderstatus = 'F') AS failures FROM nation)
      SELECT *, concat_ws('; ', CASE WHEN contacts > 0.1 * people THEN 'mostly contactable' END, CASE WHEN failures > 0 THEN 'has failures' END) AS notes FROM q""",
    "audit_counts": f"""WITH {_PEOPLE} SELECT (SELECT count(*) FROM people) AS people, (SELECT count(*) FROM people WHERE {_CUR}) AS current_people, (SELECT count(DISTINCT institution_id) FROM people) AS institutions,
      (SELECT count(*) FROM orders) AS fetches, (SELECT count(*) FROM orders WHERE o_totalprice BETWEEN 20000 AND 29999 OR o_orderstatus = 'P') AS good_fetches,
      (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING sum((l_returnflag = 'R')::INT) = 0)) AS without_returns,
      (SELECT sum(m) FROM (SELECT max(l_linenumber) AS m FROM lineitem GROUP BY l_suppkey))::BIGINT AS sum_of_max""",
    "failure_reasons": "SELECT event_type, count(*) AS n FROM events WHERE value < 20 GROUP BY 1 ORDER BY n DESC, event_type",
    "run_capture_metrics": "SELECT strftime(ts, '%Y-%m-%d') AS run, round(sum(coalesce(value, 0)), 2) AS total, count(*) FILTER (value > 50) AS above, count(*) AS n FROM events GROUP BY 1",
    "pool_counts": "SELECT n_name, count(c_custkey) AS n, coalesce(sum(CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END), 0)::BIGINT AS strong FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1",
    "best_evidence_per_person": "SELECT l_partkey, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_linestatus = 'O' DESC, l_returnflag = 'N' DESC, l_quantity DESC, l_orderkey, l_linenumber) = 1",
    "stratified_sample": "SELECT c_mktsegment, c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY sha256('20260712:' || c_custkey)) AS n FROM customer QUALIFY n <= 4",
    "sample_per_institution": "SELECT n_name, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0 QUALIFY row_number() OVER (PARTITION BY n_name ORDER BY sha256('7:' || c_custkey)) <= 2",
    "region_audit": "SELECT n_name, r_name, coalesce((SELECT min(s_suppkey) FROM supplier WHERE s_nationkey = n_nationkey), (SELECT min(s_suppkey) FROM supplier WHERE 'NATION_' || s_nationkey = n_name)) AS matched FROM nation JOIN region ON n_regionkey = r_regionkey",
    "coverage_ratios": f"WITH {_PEOPLE} SELECT institution_id, round(avg((area IS NOT NULL)::INT), 6) AS area, round(avg((membership_status IS NOT NULL)::INT), 6) AS status FROM people GROUP BY 1",
    "quality_gate": f"WITH {_PEOPLE}, m AS (SELECT institution_id, count(*) AS n, avg((area IS NOT NULL)::INT) AS c, count(*) FILTER (membership_status = 'inactive') AS i FROM people GROUP BY 1) SELECT institution_id, n >= 5 AS enough, c >= 0.75 AS covered, n >= 5 AND c >= 0.75 AND i * 4 <= n AS passed FROM m",
    "shared_value_groups": "SELECT p_type || '|' || p_size AS email, count(DISTINCT p_partkey) AS people, CASE WHEN count(DISTINCT p_brand) > 1 THEN 'cross_canonical' ELSE 'same_person_alias' END AS kind FROM part GROUP BY 1 HAVING count(DISTINCT p_partkey) > 1",
    "same_name_groups": "SELECT p_brand, lower(trim(regexp_replace(p_name, '\\s+', ' ', 'g'))) AS name, count(DISTINCT p_partkey) AS n, min(p_partkey) AS least FROM part GROUP BY ALL HAVING count(DISTINCT p_partkey) > 1",
    "latency_p95": "SELECT event_type, round(quantile_cont(value, 0.95), 6) AS p95, count(*) AS n FROM events GROUP BY 1",
    "institution_counts_rollup": "SELECT n_regionkey, c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ROLLUP (n_regionkey, c_mktsegment)",
    "evidence_unpivot": "SELECT s_suppkey, 's_name' AS field_name, s_name AS field_value FROM supplier UNION ALL SELECT s_suppkey, 'nation', s_nationkey::VARCHAR FROM supplier",
    "evidence_by_id_list": "SELECT l_orderkey, count(*) AS lines FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '5-LOW') GROUP BY 1",
    "like_selection": "SELECT DISTINCT page_id FROM pages WHERE url ILIKE '%utm_source%' OR url ILIKE '%/en/1%'",
    "scope_selection": f"WITH {_PEOPLE} SELECT person_id FROM people WHERE institution_id = 3 AND (lower(area) LIKE '%build%' OR person_id IN (1, 2, 3))",
    "work_policy": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 5) OR (l_returnflag = 'R' AND l_linenumber = 1)",
    "missing_policy_ids": "SELECT w AS s_suppkey FROM range(1, 400, 7) t(w) WHERE w NOT IN (SELECT s_suppkey FROM supplier)",
    "union_profile_works": "SELECT l_partkey, min(l_suppkey)::INT AS profile, count(DISTINCT l_suppkey) AS profiles FROM lineitem WHERE l_suppkey IN (1, 2, 3) GROUP BY 1",
    "stage_support": "SELECT c_mktsegment AS field, count(DISTINCT c_custkey) AS pis, count(DISTINCT c_nationkey) AS institutions, count(DISTINCT c_custkey) >= 100 AND count(DISTINCT c_nationkey) >= 5 AS eligible FROM customer GROUP BY 1",
    "vector_storage": "SELECT label, sum(32 + 8 * len(embedding))::BIGINT AS bytes, count(*) AS vectors FROM embeddings GROUP BY 1",
    "orphan_check": "SELECT count(*) AS orphans, count(DISTINCT l_orderkey) AS orders FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderkey % 11 <> 0)",
}
