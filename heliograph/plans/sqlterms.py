"""DuckDB text for term vectors, written independently of the DataFrame code."""

from __future__ import annotations

from heliograph.functions.terms import INDEX_STOPWORDS, LOW_SIGNAL, STOPWORDS


def _list(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def tokens_cte(name: str, source: str, key: str, stopwords=STOPWORDS) -> str:
    return (
        f"{name}_t AS (SELECT {key}, list_filter(regexp_extract_all(lower(text), '[a-z][a-z0-9+-]{{2,}}'), lambda x: x NOT IN ({_list(stopwords)})) AS w "
        f"FROM ({source}) src)"
    )


def vector_cte(name: str, source: str, key: str, limit: int) -> str:
    """CTEs whose last, `name`, is (key, term, weight): the strongest terms."""
    low = _list(LOW_SIGNAL)
    return f"""{tokens_cte(name, source, key)},
    {name}_i AS (SELECT {key}, w, unnest(range(1, len(w) + 1)) AS i FROM {name}_t),
    {name}_g AS (
      SELECT {key}, w[i] AS term, CASE WHEN w[i] IN ({low}) THEN 0.25 WHEN length(w[i]) >= 12 THEN 1.25 WHEN length(w[i]) >= 8 THEN 1.10 ELSE 1.00 END::DECIMAL(18,2) AS x FROM {name}_i
      UNION ALL
      SELECT {key}, w[i] || '_' || w[i+1], CASE WHEN k = 0 THEN 0 ELSE 1.35 + 0.15 * k END::DECIMAL(18,2)
      FROM (SELECT *, (w[i] NOT IN ({low}))::INT + (w[i+1] NOT IN ({low}))::INT AS k FROM {name}_i WHERE i + 1 <= len(w))
      UNION ALL
      SELECT {key}, w[i] || '_' || w[i+1] || '_' || w[i+2], CASE WHEN k = 0 THEN 0 ELSE 1.70 + 0.15 * k END::DECIMAL(18,2)
      FROM (SELECT *, (w[i] NOT IN ({low}))::INT + (w[i+1] NOT IN ({low}))::INT + (w[i+2] NOT IN ({low}))::INT AS k FROM {name}_i WHERE i + 2 <= len(w))),
    {name}_s AS (SELECT {key}, term, sum(x) AS weight FROM {name}_g WHERE x > 0 GROUP BY ALL),
    {name} AS (SELECT {key}, term, weight::DOUBLE AS weight FROM {name}_s
               QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY weight DESC, term) <= {limit})"""


def unit_cte(name: str, vector: str, key: str, limit: int) -> str:
    return f"""{name}_c AS (SELECT * FROM {vector} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY abs(weight) DESC, term) <= {limit}),
    {name} AS (SELECT {key}, term, weight / sqrt(sum(weight * weight) OVER (PARTITION BY {key})) AS weight FROM {name}_c)"""


def cosine_sql(a: str, ak: str, b: str, bk: str) -> str:
    return f"""SELECT a.{ak}, b.{bk}, round(least(1.0, sum(a.weight * b.weight) / (max(an.n) * max(bn.n))), 4) AS score
    FROM {a} a JOIN {b} b USING (term)
    JOIN (SELECT {ak}, sqrt(sum(weight * weight)) AS n FROM {a} GROUP BY 1) an ON an.{ak} = a.{ak}
    JOIN (SELECT {bk}, sqrt(sum(weight * weight)) AS n FROM {b} GROUP BY 1) bn ON bn.{bk} = b.{bk}
    GROUP BY a.{ak}, b.{bk}"""


def index_sql(queries: str, qk: str, docs: str, dk: str) -> str:
    """TF-IDF scores as in terms.index_scores."""
    return f"""WITH {tokens_cte('q', queries, qk, INDEX_STOPWORDS)}, {tokens_cte('d', docs, dk, INDEX_STOPWORDS)},
    qc AS (SELECT {qk}, term, count(*) AS qf FROM (SELECT {qk}, unnest(w) AS term FROM q_t) GROUP BY ALL),
    dc AS (SELECT {dk}, term, count(*) AS tf FROM (SELECT {dk}, unnest(w) AS term FROM d_t) GROUP BY ALL),
    nm AS (SELECT {dk}, sqrt(sum(tf * tf)) AS norm FROM dc GROUP BY 1), df AS (SELECT term, count(*) AS df FROM dc GROUP BY 1),
    n AS (SELECT greatest(count(*), 1) AS n FROM d_t)
    SELECT {qk}, {dk}, round(sum((1 + ln(tf)) * (ln((n + 1) / (1 + df)) + 1) * qf) / max(norm), 6) AS score,
           array_to_string(list_sort(list(DISTINCT term)), ', ') AS overlap
    FROM qc JOIN dc USING (term) JOIN df USING (term) JOIN nm USING ({dk}), n GROUP BY ALL"""
