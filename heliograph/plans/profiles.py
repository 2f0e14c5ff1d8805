"""Queries of profiles, cost models and registries' metadata on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from heliograph.operators import profiles as P
from heliograph.plans.base import WORKS_SQL, table, works


def dominant_segments(spark, d):
    return P.modes(table(spark, d, "customer"), "c_nationkey", "c_mktsegment")


def recent_works(spark, d):
    found = P.recent(works(spark, d), "person_id", "year", 3)
    return found.groupBy("person_id").agg(F.count(F.lit(1)).alias("works"), F.min("year").alias("since"), F.sum("doc_id").alias("ids"))


def dependency_hashes(spark, d):
    w = works(spark, d).select("person_id", "doc_id", F.md5("text").alias("digest"))
    return P.dependency_hashes(w, "person_id", "doc_id", "digest")


def call_costs(spark, d):
    w = works(spark, d).select("institution_id", "person_id", "doc_id", F.when(F.col("doc_id") % 4 != 0, F.concat(F.lit("10.1/"), F.col("doc_id") % 500)).alias("doi"))
    trained = w.groupBy("institution_id", "person_id").agg(F.count(F.lit(1)).alias("works")).where("works >= 8")
    return P.call_costs(w, trained, 10)


def evaluation_names(spark, d):
    c = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "[,\\n]")).alias("name"))
    return c.groupBy("doc_id").agg(F.count(F.lit(1)).alias("names"), F.count_if(P.is_evaluation_name(F.col("name"))).alias("valid"))


def official_profiles(spark, d):
    p = table(spark, d, "pages").withColumn("mail", F.array(F.concat(F.lit("a@"), F.when(F.col("page_id") % 3 == 0, "example.org").otherwise("other.net"))))
    name = F.lit("The University of Tionble Technology")
    return p.select("page_id", P.is_official_profile(F.col("url"), name, F.col("mail")).alias("official"), P.is_affiliated(F.array("url"), name, F.col("mail")).alias("affiliated"))


def topic_confidences(spark, d):
    areas = F.slice(F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.lit(1), (F.col("doc_id") % 3).cast("int"))
    return table(spark, d, "documents").groupBy(P.topic_confidence(areas, F.col("doc_id") % 2).alias("confidence")).agg(F.count(F.lit(1)).alias("n"))


def role_config_choice(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("config"), (F.col("vec_id") % 17 / 17).alias("ndcg"), (F.col("vec_id") % 5 / 5).alias("hit_at_5"), (F.col("vec_id") % 3 / 3).alias("multi_ndcg"), (F.col("label") * 1.0).alias("deviation"))
    return P.select_role_config(e).withColumn("ndcg", F.round("ndcg", 9))


def merge_counts(spark, d):
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("merged"), F.count_distinct(F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))).alias("split"))


def backfilled_states(spark, d):
    items = table(spark, d, "orders").select(F.col("o_custkey").alias("person"), F.col("o_orderpriority").alias("source"), "o_orderdate")
    present = items.where("person % 3 = 0").select("person", "source")
    out = P.backfill(items, present, ["person", "source"], "o_orderdate")
    return out.select("person", "source", F.date_format("checked", "yyyy-MM-dd").alias("checked"), "items")


QUERIES = {f.__name__: f for f in (
    dominant_segments, recent_works, dependency_hashes, call_costs, evaluation_names, official_profiles, topic_confidences, role_config_choice, merge_counts, backfilled_states,
)}

_HOST = "regexp_replace(regexp_extract(lower(url), '^[a-z]+://([^/?#:]*)', 1), '^www\\.', '')"
SQL = {
    "dominant_segments": "SELECT c_nationkey, mode, n FROM (SELECT c_nationkey, c_mktsegment AS mode, count(*) AS n FROM customer GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, mode) = 1",
    "recent_works": f"""WITH w AS (SELECT *, max(year) OVER (PARTITION BY person_id) AS latest FROM ({WORKS_SQL}))
      SELECT person_id, count(*) AS works, min(year) AS since, sum(doc_id)::BIGINT AS ids FROM w WHERE year >= latest - 3 + 1 GROUP BY 1""",
    "dependency_hashes": f"""WITH b AS (SELECT person_id, doc_id // 1000 AS block, string_agg(doc_id || ':' || md5(text), ',' ORDER BY doc_id) AS items, count(*) AS n FROM ({WORKS_SQL}) GROUP BY ALL)
      SELECT person_id, sum(n)::BIGINT AS dependencies, sha256(string_agg(sha256(items), ',' ORDER BY block)) AS hash FROM b GROUP BY 1""",
    "call_costs": f"""WITH w AS (SELECT institution_id, person_id, CASE WHEN doc_id % 4 <> 0 THEN doc_id % 500 END AS doi FROM ({WORKS_SQL})), p AS (SELECT institution_id, person_id, count(*) AS works FROM w GROUP BY ALL HAVING count(*) >= 8),
      a AS (SELECT (SELECT avg(n) FROM (SELECT count(*) AS n FROM p GROUP BY institution_id)) AS candidates, (SELECT avg(works) FROM p) AS works, (SELECT count(*) FROM p) AS people,
              (SELECT count(doi) / count(*) FROM w) AS cover, (SELECT count(DISTINCT doi) FROM w) AS dois)
      SELECT unnest(['precomputed_career_vector', 'precomputed_paper_vectors', 'doi_on_demand_full_institution', 'doi_on_demand_top_10']) AS mode,
        unnest([0.0::DOUBLE, 0.0, round(candidates * works * cover, 6), round(least(10, candidates) * works * cover, 6)]) AS calls_per_match, unnest([people, people, dois, dois]) AS refresh_calls,
        unnest([1.0::DOUBLE, 1.0, round(cover, 6), round(cover, 6)]) AS coverage FROM a""",
    "evaluation_names": """WITH c AS (SELECT doc_id, trim(unnest(regexp_split_to_array(text, '[,\\n]'))) AS n FROM documents)
      SELECT doc_id, count(*) AS names, count(*) FILTER (length(n) BETWEEN 4 AND 80 AND regexp_full_match(n, '[\\pL ''.-]+') AND len(list_filter(regexp_split_to_array(n, '[ .''-]+'), lambda x: x <> '')) >= 2
        AND length(regexp_replace(n, '\\PL', '', 'g')) >= 4) AS valid FROM c GROUP BY 1""",
    "official_profiles": f"""WITH h AS (SELECT page_id, lower(url) AS u, {_HOST} AS host, CASE WHEN page_id % 3 = 0 THEN 'example.org' ELSE 'other.net' END AS domain FROM pages)
      SELECT page_id, host <> '' AND (host = domain OR ends_with(host, '.' || domain) OR contains(host, 'tionble')) AS official, contains(u, domain) OR contains(u, 'tionble') AS affiliated FROM h""",
    "topic_confidences": "SELECT CASE WHEN doc_id % 3 = 2 THEN 'high' WHEN doc_id % 3 = 1 OR doc_id % 2 = 1 THEN 'medium' ELSE 'low' END AS confidence, count(*) AS n FROM documents GROUP BY 1",
    "role_config_choice": "SELECT vec_id AS config, round((vec_id % 17) / 17, 9) AS ndcg FROM embeddings ORDER BY vec_id % 17 DESC, vec_id % 5 DESC, vec_id % 3 DESC, label, vec_id LIMIT 1",
    "merge_counts": "SELECT l_suppkey, count(DISTINCT l_partkey) AS merged, count(DISTINCT l_partkey) FILTER (l_returnflag = 'R') AS split FROM lineitem GROUP BY 1",
    "backfilled_states": """SELECT o_custkey AS person, o_orderpriority AS source, strftime(max(o_orderdate), '%Y-%m-%d') AS checked, count(*) AS items FROM orders o
      WHERE NOT EXISTS (SELECT 1 FROM orders s WHERE s.o_custkey % 3 = 0 AND s.o_custkey = o.o_custkey AND s.o_orderpriority = o.o_orderpriority) GROUP BY 1, 2""",
}
