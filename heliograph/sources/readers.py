"""Sources: registries, configurations, sitemaps, REST payloads, fetch logs and content-addressed archives."""

from __future__ import annotations

from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph.functions.strings import nullable
from heliograph.operators.lifecycle import latest

REGISTRY = "name string, country string, region string, homepage_url string, ror_id string, qs_rank string, qs_year string, config_path string, source string"


def registry(spark: SparkSession, path: str) -> DataFrame:
    """Institutions from a CSV with a header; empty cells are null, ranks integers."""
    rows = spark.read.csv(path, header=True, schema=REGISTRY, enforceSchema=False)
    return rows.select(*[nullable(F.trim(c)).try_cast("int").alias(c) if c in ("qs_rank", "qs_year") else nullable(F.trim(c)).alias(c) for c in rows.columns])


def batch_plan(institutions: DataFrame, limit: int | None = None) -> DataFrame:
    """The institutions that have a configuration, in order; limit counts those that are tried."""
    rows = institutions.where("config_path is not null").orderBy("name")
    return rows if limit is None else rows.limit(limit)


def config_errors(config: dict) -> list[str]:
    """What is wrong with an institution's configuration; empty if nothing."""
    errors = [f"missing {k}" for k in ("institution", "seeds", "official_domains") if not config.get(k)]
    for k in ("seeds", "official_domains", "allowed_email_domains"):
        if config.get(k) is not None and not (isinstance(config[k], list) and all(isinstance(x, str) and x for x in config[k])):
            errors.append(f"{k} must be a list of strings")
    gate = config.get("quality_gate") or {}
    errors += [f"quality_gate.{k} must be within 0 and 1" for k, v in gate.items() if k.endswith("_ratio") and not (isinstance(v, (int, float)) and 0 <= v <= 1)]
    domains = [str(d).lower().removeprefix("www.") for d in config.get("official_domains") or []]
    for seed in config.get("seeds") or []:
        host = (urlparse(str(seed)).hostname or "").removeprefix("www.")
        if host and not any(host == d or host.endswith("." + d) for d in domains):
            errors.append(f"seed outside the official domains: {seed}")
    return errors


def policy_errors(policy: dict) -> list[str]:
    """What is wrong with a matching policy."""
    errors = [f"missing {k}" for k in ("version", "shortlist", "recall", "paper_top") if k not in policy]
    errors += [f"{k} must be a positive integer" for k in ("shortlist", "recall", "paper_top") if k in policy and not (isinstance(policy[k], int) and policy[k] > 0)]
    if policy.get("recall", 0) and isinstance(policy["recall"], int) and policy["recall"] > 50:
        errors.append("recall must not exceed 50")
    weights = [policy.get("proposal_weight", 0.8), policy.get("cv_weight", 0.2)]
    if abs(sum(weights) - 1) > 1e-9:
        errors.append("proposal_weight and cv_weight must add up to 1")
    return errors


def duplicate_entries(rows: DataFrame, key: str) -> DataFrame:
    """(key, n) of entries that a manifest lists more than once."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def sitemap(spark: SparkSession, path: str, pattern: str | None = None, limit: int = 100) -> DataFrame:
    """Locations of sitemap files, first come first served, optionally only those that match."""
    text = spark.read.text(path, wholetext=True)
    found = text.select(F.posexplode(F.regexp_extract_all("value", F.lit(r"(?is)<loc>\s*(.*?)\s*</loc>"), F.lit(1))).alias("pos", "url"))
    kept = found.where(F.col("url").rlike(pattern)) if pattern else found
    return kept.groupBy("url").agg(F.min("pos").alias("pos")).orderBy("pos", "url").limit(limit).select("url")


def discovered(sources: list[DataFrame], limit: int) -> DataFrame:
    """(url, source) of several url lists in order of precedence: the first list that has a url keeps it."""
    every = None
    for i, s in enumerate(sources):
        part = s.select("url", F.lit(i).alias("source"))
        every = part if every is None else every.unionByName(part)
    return every.groupBy("url").agg(F.min("source").alias("source")).orderBy("source", "url").limit(limit)


WORKS = (
    "id string, display_name string, title string, doi string, publication_year int, updated_date string, abstract_inverted_index map<string,array<int>>, "
    "topics array<struct<display_name:string>>, concepts array<struct<display_name:string,score:double>>, "
    "authorships array<struct<author:struct<id:string,display_name:string>,institutions:array<struct<display_name:string>>,raw_affiliation_strings:array<string>>>"
)


def works_json(spark: SparkSession, path: str) -> DataFrame:
    """Works from JSON lines of a bibliographic API: id, title, abstract, topics, authors, institutions."""
    from heliograph.functions.strings import abstract_text, doi

    w = spark.read.schema(WORKS).json(path)
    topics = F.array_union(
        F.coalesce(F.transform("topics", lambda t: t["display_name"]), F.array().cast("array<string>")),
        F.coalesce(F.transform(F.filter("concepts", lambda c: c["score"] >= 0.5), lambda c: c["display_name"]), F.array().cast("array<string>")),
    )
    places = F.flatten(F.transform("authorships", lambda a: F.array_union(
        F.coalesce(F.transform(a["institutions"], lambda i: i["display_name"]), F.array().cast("array<string>")), F.coalesce(a["raw_affiliation_strings"], F.array().cast("array<string>")))))
    return w.select(
        "id", F.coalesce("display_name", "title", F.lit("")).alias("title"), doi(F.col("doi")).alias("doi"), F.col("publication_year").alias("year"),
        F.to_timestamp("updated_date").alias("updated_date"), F.coalesce(abstract_text(F.col("abstract_inverted_index")), F.lit("")).alias("abstract"),
        F.array_sort(F.array_compact(topics)).alias("topics"), F.transform("authorships", lambda a: a["author"]["display_name"]).alias("authors"),
        F.array_sort(F.array_distinct(F.array_compact(F.coalesce(places, F.array().cast("array<string>"))))).alias("institutions"),
    )


def vector_text(title: Column, abstract: Column, topics: Column) -> Column:
    """The text that vectors are made of: one line each of title, abstract and sorted topics."""
    line = lambda name, c: F.when(F.length(F.coalesce(c, F.lit(""))) > 0, F.concat(F.lit(f"{name}: "), c))
    return F.concat_ws("\n", line("Title", title), line("Abstract", abstract), line("Topics", F.array_join(F.array_sort(F.array_distinct(topics)), "; ")))


def archive(bodies: DataFrame, body: str = "body") -> DataFrame:
    """(sha256, body): each distinct body once."""
    payload = F.col(body).cast("binary")
    return bodies.select(F.sha2(payload, 256).alias("sha256"), payload.alias("body")).groupBy("sha256").agg(F.first("body").alias("body"))


def read_archive(archived: DataFrame, keys: DataFrame) -> DataFrame:
    """Bodies of the wanted keys, checked against them."""
    checked = F.when(F.sha2("body", 256) == F.col("sha256"), F.col("body")).otherwise(F.raise_error(F.lit("archive: body and key differ")))
    return archived.join(keys.select("sha256").distinct(), "sha256", "left_semi").select("sha256", checked.alias("body"))


def latest_fetch(log: DataFrame) -> DataFrame:
    """The newest usable fetch of each (institution_id, source_url): archived, without error, 2xx or 304."""
    ok = F.col("error_reason").isNull() & F.col("archive_key").isNotNull() & (F.col("http_status").between(200, 299) | (F.col("http_status") == 304) | F.col("not_modified"))
    return latest(log.where(ok), ["institution_id", "source_url"], [F.col("fetched_at").desc(), F.col("archive_key")])


def failed_fetches(errors: DataFrame, run_id: str) -> DataFrame:
    """The urls whose fetch failed in a run, to be fetched again."""
    return errors.where((F.col("run_id") == run_id) & (F.col("stage") == "fetch")).select("source_url").distinct()


def cached(wanted: DataFrame, cache: DataFrame, key: str, now: Column) -> tuple[DataFrame, DataFrame]:
    """(hits, misses) of keys in a cache whose entries expire; a cached null is a hit."""
    live = latest(cache.where(F.col("expires_at") > now), [key], [F.col("fetched_at").desc()])
    return wanted.join(live, key), wanted.join(live.select(key), key, "left_anti")
