"""Retrieval queries on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from heliograph.functions import terms
from heliograph.operators import retrieval as R
from heliograph.plans.base import WORKS_SQL, applicants, table, works
from heliograph.runtime import saved
from heliograph.plans.sqlterms import cosine_sql, index_sql, tokens_cte, unit_cte, vector_cte

_ITEMS = "SELECT item_id, text FROM benchmark"
_DOCS = "SELECT doc_id, text FROM documents"


def people(spark, d):
    """People from the works' owners, with areas for every other source."""
    owners = works(spark, d).select("person_id", "institution_id").distinct()
    n = F.regexp_extract("person_id", r"(\d+)$", 1).cast("int")
    return owners.select(
        "person_id", "institution_id", F.concat(F.lit("University "), F.upper("institution_id")).alias("institution_name"),
        F.concat(F.lit("Person "), F.col("person_id")).alias("display_name"), F.lit("Department").alias("department"),
        F.when(n % 2 == 0, F.array(F.lit("onthe"), F.lit("reation"))).otherwise(F.array().cast("array<string>")).alias("research_areas"),
        F.when(n % 3 == 0, "high").when(n % 3 == 1, "medium").otherwise("low").alias("topic_confidence"),
        F.when(n % 2 == 0, "high").otherwise("low").alias("contact_confidence"),
    )


_PEOPLE = """SELECT DISTINCT person_id, institution_id, 'Person ' || person_id AS display_name,
  CASE WHEN regexp_extract(person_id, '(\\d+)$', 1)::INT % 2 = 0 THEN 'onthe reation' ELSE '' END AS areas,
  CASE regexp_extract(person_id, '(\\d+)$', 1)::INT % 3 WHEN 0 THEN 0.15 WHEN 1 THEN 0.08 ELSE 0.0 END AS bonus,
  CASE WHEN regexp_extract(person_id, '(\\d+)$', 1)::INT % 2 = 0 THEN 1.0 ELSE 0.15 END AS contact FROM works"""


def semantic_terms(spark, d):
    return terms.semantic_vectors(applicants(spark, d), "item_id")


def semantic_topk(spark, d):
    scores = terms.cosine(terms.semantic_vectors(applicants(spark, d), "item_id"), "item_id",
                          terms.semantic_vectors(table(spark, d, "documents").select("doc_id", "text"), "doc_id"), "doc_id")
    return R.top_k(scores, "item_id", "doc_id", 5)


def tfidf_topk(spark, d):
    scores = terms.index_scores(applicants(spark, d), "item_id", table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    return R.top_k(scores, "item_id", "doc_id", 5)


def match_applicants(spark, d):
    return R.match_applicants(applicants(spark, d), people(spark, d), works(spark, d), None, 20)


def match_applicants_institution(spark, d):
    return R.match_applicants(applicants(spark, d), people(spark, d), works(spark, d), " EN ", 5)


def _encoded(spark, d):
    return terms.encoded(works(spark, d).select("doc_id", "text"), "doc_id")


def encoded_work_vectors(spark, d):
    v = _encoded(spark, d).withColumn("weight", F.round("weight", 9))
    return v.groupBy("doc_id").agg(F.count(F.lit(1)).alias("features"), F.round(F.max("weight"), 9).alias("largest"),
                                   F.max_by("term", F.struct("weight", "term")).alias("term"))


def career_centroids(spark, d):
    v = R.career_vectors(_encoded(spark, d), works(spark, d))
    return v.groupBy("person_id").agg(F.count(F.lit(1)).alias("features"), F.round(F.sum(F.col("weight") * F.col("weight")), 6).alias("norm"),
                                      F.round(F.max("weight"), 6).alias("largest"))


def hybrid_retrieval(spark, d):
    vectors = saved(_encoded(spark, d), "work-vectors")  # both stages read them
    return R.hybrid(terms.encoded(applicants(spark, d), "item_id"), vectors, works(spark, d), 10, 3).select("item_id", "person_id", "score")


def paper_top3(spark, d):
    w = works(spark, d)
    scored = R.dots(terms.encoded(applicants(spark, d), "item_id"), "item_id", _encoded(spark, d), "doc_id").join(w.select("doc_id", "person_id"), "doc_id")
    counts = w.groupBy("person_id").agg(F.count(F.lit(1)).alias("works"))
    return R.best_mean(scored, ["item_id", "person_id"], counts, 3)


def shared_terms(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return terms.shared_terms(terms.semantic_vectors(applicants(spark, d), "item_id"), "item_id", terms.semantic_vectors(docs, "doc_id"), "doc_id", 8)


def top_keywords(spark, d):
    words = applicants(spark, d).select("item_id", F.explode(terms.tokens(F.col("text"))).alias("term"))
    counts = words.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("weight"))
    return terms.strongest(counts, "item_id", 14)


def lexical_topk(spark, d):
    q = applicants(spark, d).select("item_id", F.array_distinct(terms.tokens(F.col("text"))).alias("q"))
    t = table(spark, d, "documents").select("doc_id", F.array_distinct(terms.tokens(F.col("text"))).alias("t"))
    # Only pairs with a common token score, so they are found by token instead of pairing everything.
    sizes = q.select("item_id", F.size("q").alias("nq"), F.explode("q").alias("term")).join(t.select("doc_id", F.size("t").alias("nt"), F.explode("t").alias("term")), "term")
    common = sizes.groupBy("item_id", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("nq").alias("nq"), F.max("nt").alias("nt"))
    score = F.round(F.least(F.lit(1.0), F.col("n") / F.sqrt(F.col("nq") * F.greatest(F.lit(1), F.least(F.col("nt"), F.lit(80)))) * 3.0), 4)
    return R.top_k(common.select("item_id", "doc_id", score.alias("score")), "item_id", "doc_id", 3)


def experiment_tfidf(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    counts = terms.experiment_counts(docs, "doc_id")
    idf = terms.inverse_frequencies(counts, "doc_id", F.lit(docs.count()))
    v = terms.tfidf_vectors(counts, idf, "doc_id")
    return v.groupBy("doc_id").agg(F.count(F.lit(1)).alias("features"), F.round(F.sum("weight"), 4).alias("total"), F.round(F.min("weight"), 6).alias("least"))


def inverse_document_frequencies(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    idf = terms.inverse_frequencies(terms.experiment_counts(docs, "doc_id"), "doc_id", F.lit(docs.count()))
    return idf.select("term", F.round("idf", 9).alias("idf"))


def combined_query(spark, d):
    e = terms.encoded(applicants(spark, d), "item_id")
    half = e.where("item_id % 2 = 0").withColumn("item_id", (F.col("item_id") / 2).cast("long"))
    other = e.where("item_id % 2 = 1").withColumn("item_id", ((F.col("item_id") - 1) / 2).cast("long"))
    return R.combined_query(half, other, "item_id").withColumn("weight", F.round("weight", 9))


def dense_topk(spark, d):
    e = table(spark, d, "embeddings")
    size = e.agg(F.max(F.size("embedding"))).first()[0] or 0
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    e = e.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.coalesce((F.size("embedding") == size) & (F.size("embedding") > 0) & finite, F.lit(False)).alias("even"))
    q = e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"), "even")  # a stated query set against all rows
    dot = F.aggregate(F.zip_with("q", "embedding", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda a, x: a + x)
    scored = R.nearest(q.where("even"), e.where("even"), size, 3)
    for one, other in ((q.where("NOT even"), e), (q.where("even"), e.where("NOT even"))):  # nulls, odd lengths and numbers that aren't finite
        scored = scored.unionByName(one.drop("even").crossJoin(other.drop("even")).where("query_id <> vec_id").select("query_id", "vec_id", dot.alias("score")))
    return R.top_k(scored.withColumn("score", F.round("score", 6)), "query_id", "vec_id", 3)


def paper_backtrace(spark, d):
    scores = terms.cosine(terms.semantic_vectors(applicants(spark, d), "item_id"), "item_id",
                          terms.semantic_vectors(works(spark, d).select("doc_id", "text"), "doc_id"), "doc_id").where("score >= 0.02")
    matched = scores.join(works(spark, d).select("doc_id", "person_id"), "doc_id")
    total, n = R.paper_backtrace_score(F.col("score"), F.lit(0.9))
    best = matched.groupBy("item_id", "person_id").agg(total.alias("score"), n.alias("papers"))
    action = R.recommended_action(F.lit(1.0), F.col("score"), F.lit("high"), F.col("score"))
    return R.top_k(best, "item_id", "person_id", 10).withColumn("action", action)


_VECTORS = f"{vector_cte('qv', _ITEMS, 'item_id', 160)}, {vector_cte('dv', _DOCS, 'doc_id', 160)}"
_WORKS = f"works AS MATERIALIZED ({WORKS_SQL})"
_ENC_D = f"{vector_cte('ec', 'SELECT doc_id, text FROM works', 'doc_id', 1024)}, {unit_cte('e', 'ec', 'doc_id', 256)}"
_ENC_Q = f"{vector_cte('qc', _ITEMS, 'item_id', 1024)}, {unit_cte('q', 'qc', 'item_id', 256)}"
_CAREER = """cs AS (SELECT person_id, term, round(sum(weight), 12) AS weight FROM e JOIN works USING (doc_id) GROUP BY ALL),
  cc AS (SELECT * FROM cs QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY abs(weight) DESC, term) <= 256),
  c AS (SELECT person_id, term, weight / sqrt(sum(weight * weight) OVER (PARTITION BY person_id)) AS weight FROM cc)"""
_PAPERS = "SELECT item_id, doc_id, round(sum(q.weight * e.weight), 6) AS score FROM q JOIN e USING (term) GROUP BY ALL"


def _match_sql(where: str, k: int) -> str:
    return f"""WITH {_WORKS}, ppl AS ({_PEOPLE}),
  flat AS (SELECT *, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS flat FROM works WHERE {where}),
  one AS (SELECT * FROM flat WHERE flat <> '' QUALIFY row_number() OVER (PARTITION BY person_id, lower(flat) ORDER BY year DESC NULLS LAST, doc_id) = 1),
  kept AS (SELECT * FROM one QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY year DESC NULLS LAST, doc_id) <= 20),
  pub AS (SELECT person_id, string_agg(flat, ' ' ORDER BY year DESC NULLS LAST, doc_id) AS pub FROM kept GROUP BY 1),
  recs AS MATERIALIZED (SELECT person_id, bonus, contact, concat_ws(' ', display_name, 'Department', areas, coalesce(pub, '')) AS text
           FROM ppl LEFT JOIN pub USING (person_id) WHERE ({where}) AND (areas <> '' OR pub IS NOT NULL)),
  {vector_cte('qv', _ITEMS, 'item_id', 160)}, {vector_cte('rv', 'SELECT person_id, text FROM recs', 'person_id', 160)},
  sem AS ({cosine_sql('qv', 'item_id', 'rv', 'person_id')}), lex AS ({index_sql(_ITEMS, 'item_id', 'SELECT person_id, text FROM recs', 'person_id')}),
  j AS (SELECT item_id, person_id, coalesce(sem.score, 0.0) AS s, coalesce(lex.score, 0.0) AS base, coalesce(overlap, '') AS topic_overlap
        FROM sem FULL JOIN lex USING (item_id, person_id)),
  t AS (SELECT item_id, person_id, base, topic_overlap, contact, least(1.0, least(1.0, greatest(0.0, s * 5.0 / 5.0)) + bonus) AS fit FROM j JOIN recs USING (person_id))
  SELECT item_id, person_id, row_number() OVER (PARTITION BY item_id ORDER BY round(fit, 4) DESC, base DESC, person_id) AS rank,
         round(fit, 4) AS research_fit_score, contact::DOUBLE AS contact_score, round(fit, 4) AS total_score, topic_overlap
  FROM t QUALIFY rank <= {k}"""


QUERIES = {f.__name__: f for f in (
    semantic_terms, semantic_topk, tfidf_topk, match_applicants, match_applicants_institution, encoded_work_vectors, career_centroids, hybrid_retrieval,
    paper_top3, shared_terms, top_keywords, lexical_topk, experiment_tfidf, inverse_document_frequencies, combined_query, dense_topk, paper_backtrace,
)}

_COUNTS = f"""{tokens_cte('x', _DOCS, 'doc_id')}, xi AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM x_t),
  xg AS (SELECT doc_id, w[i] AS term, CASE WHEN w[i] IN (LOW) THEN 0.25 ELSE 1.00 END::DECIMAL(18,2) AS x FROM xi UNION ALL
         SELECT doc_id, w[i] || '_' || w[i+1], 1.35::DECIMAL(18,2) FROM xi WHERE i + 1 <= len(w) AND NOT (w[i] IN (LOW) AND w[i+1] IN (LOW))),
  cnt AS (SELECT doc_id, term, sum(x)::DOUBLE AS weight FROM xg GROUP BY ALL), n AS (SELECT count(*) AS n FROM documents),
  idf AS (SELECT term, ln((1 + n) / (1 + count(DISTINCT doc_id))) + 1 AS idf FROM cnt, n GROUP BY term, n)""".replace("LOW", ", ".join(f"'{w}'" for w in terms.LOW_SIGNAL))

SQL = {
    "semantic_terms": f"WITH {vector_cte('qv', _ITEMS, 'item_id', 160)} SELECT item_id, term, weight FROM qv",
    "semantic_topk": f"WITH {_VECTORS}, s AS ({cosine_sql('qv', 'item_id', 'dv', 'doc_id')}) SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s QUALIFY rank <= 5",
    "tfidf_topk": f"WITH s AS ({index_sql(_ITEMS, 'item_id', _DOCS, 'doc_id')}) SELECT item_id, doc_id, score, overlap, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s QUALIFY rank <= 5",
    "match_applicants": _match_sql("true", 20),
    "match_applicants_institution": _match_sql("institution_id = 'en'", 5),
    "encoded_work_vectors": f"WITH {_WORKS}, {_ENC_D}, r AS (SELECT doc_id, term, round(weight, 9) AS weight FROM e) SELECT doc_id, count(*) AS features, max(weight) AS largest, arg_max(term, (weight, term)) AS term FROM r GROUP BY 1",
    "career_centroids": f"WITH {_WORKS}, {_ENC_D}, {_CAREER} SELECT person_id, count(*) AS features, round(sum(weight * weight), 6) AS norm, round(max(weight), 6) AS largest FROM c GROUP BY 1",
    "hybrid_retrieval": f"""WITH {_WORKS}, {_ENC_D}, {_ENC_Q}, {_CAREER},
      cr AS (SELECT item_id, person_id, round(sum(q.weight * c.weight), 6) AS career FROM q JOIN c USING (term) GROUP BY ALL),
      sl AS (SELECT * FROM cr QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY career DESC, person_id DESC) <= 10),
      ps AS ({_PAPERS}), pt AS (SELECT item_id, person_id, score FROM ps JOIN works USING (doc_id)
        QUALIFY row_number() OVER (PARTITION BY item_id, person_id ORDER BY score DESC, doc_id) <= 3),
      pm AS (SELECT item_id, person_id, sum(score::DECIMAL(18,6))::DOUBLE / least(3, max(n)) AS mean FROM pt JOIN (SELECT person_id, count(*) AS n FROM works GROUP BY 1) USING (person_id) GROUP BY ALL)
      SELECT item_id, person_id, greatest(career, coalesce(mean, 0.0)) AS score FROM sl LEFT JOIN pm USING (item_id, person_id)""",
    "paper_top3": f"""WITH {_WORKS}, {_ENC_D}, {_ENC_Q}, ps AS ({_PAPERS}), pt AS (SELECT item_id, person_id, score FROM ps JOIN works USING (doc_id)
        QUALIFY row_number() OVER (PARTITION BY item_id, person_id ORDER BY score DESC, doc_id) <= 3)
      SELECT item_id, person_id, sum(score::DECIMAL(18,6))::DOUBLE / least(3, max(n)) AS mean FROM pt JOIN (SELECT person_id, count(*) AS n FROM works GROUP BY 1) USING (person_id) GROUP BY ALL""",
    "shared_terms": f"""WITH {vector_cte('qv', _ITEMS, 'item_id', 160)}, {vector_cte('dv', _DOCS, 'doc_id', 160)},
      b AS (SELECT item_id, doc_id, term, qv.weight + dv.weight AS weight FROM qv JOIN dv USING (term)
            QUALIFY row_number() OVER (PARTITION BY item_id, doc_id ORDER BY qv.weight + dv.weight DESC, term) <= 8)
      SELECT item_id, doc_id, string_agg(replace(term, '_', ' '), '; ' ORDER BY weight DESC, term) AS terms FROM b GROUP BY ALL""",
    "top_keywords": f"WITH {tokens_cte('x', _ITEMS, 'item_id')}, c AS (SELECT item_id, term, count(*) AS weight FROM (SELECT item_id, unnest(w) AS term FROM x_t) GROUP BY ALL) SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY weight DESC, term) <= 14",
    "lexical_topk": f"""WITH {tokens_cte('q', _ITEMS, 'item_id')}, {tokens_cte('d', _DOCS, 'doc_id')},
      a AS (SELECT item_id, len(list_distinct(w)) AS nq, unnest(list_distinct(w)) AS term FROM q_t), b AS (SELECT doc_id, len(list_distinct(w)) AS nt, unnest(list_distinct(w)) AS term FROM d_t),
      s AS (SELECT item_id, doc_id, round(least(1.0, count(*) / sqrt(max(nq) * greatest(1, least(max(nt), 80))) * 3.0), 4) AS score FROM a JOIN b USING (term) GROUP BY ALL)
      SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s QUALIFY rank <= 3""",
    "experiment_tfidf": f"""WITH {_COUNTS}, w AS (SELECT doc_id, term, (1 + ln(weight)) * idf AS weight FROM cnt JOIN idf USING (term)),
      v AS (SELECT doc_id, weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)) AS weight FROM w WHERE weight <> 0)
      SELECT doc_id, count(*) AS features, round(sum(weight), 4) AS total, round(min(weight), 6) AS least FROM v GROUP BY 1""",
    "inverse_document_frequencies": f"WITH {_COUNTS} SELECT term, round(idf, 9) AS idf FROM idf",
    "combined_query": f"""WITH {_ENC_Q} SELECT (item_id // 2) AS item_id, term, round(sum(weight * CASE WHEN item_id % 2 = 0 THEN 0.8::DOUBLE ELSE 1 - 0.8::DOUBLE END), 9) AS weight FROM q GROUP BY ALL""",
    "dense_topk": """WITH s AS (SELECT a.vec_id AS query_id, b.vec_id, round(list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i: a.embedding[i]::DOUBLE * b.embedding[i]::DOUBLE)), 6) AS score
      FROM embeddings a, embeddings b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id)
      SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s QUALIFY rank <= 3""",
    "paper_backtrace": f"""WITH {_WORKS}, {_VECTORS}, s AS ({cosine_sql('qv', 'item_id', 'dv', 'doc_id')}), m AS (SELECT item_id, person_id, score::DECIMAL(9,6) AS score FROM s JOIN works USING (doc_id) WHERE score >= 0.02),
      b AS (SELECT item_id, person_id, count(*) AS papers, max(score) AS best, least(0.15, 0.03 * count(*))::DECIMAL(9,6) AS volume, least(0.1, 0.03 * 0.9 * count(*))::DECIMAL(9,6) AS quality FROM m GROUP BY ALL),
      g AS (SELECT item_id, person_id, papers, round(least(1::DECIMAL(22,12), best + volume * best + quality * best), 4)::DOUBLE AS score FROM b)
      SELECT item_id, person_id, score, papers, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, person_id) AS rank,
             CASE WHEN score <= 0 THEN 'Do not promote; no paper, semantic, or profile research-fit evidence.' WHEN score >= 0.45 THEN 'Prioritize for manual research-fit review and possible outreach.'
                  ELSE 'Keep as plausible research-fit candidate; inspect matched papers manually.' END AS action FROM g QUALIFY rank <= 10""",
}
