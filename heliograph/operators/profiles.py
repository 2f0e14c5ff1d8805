"""Profiles of people: recent work, dependency hashes, cost models, official pages, and metadata of other registries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heliograph.functions import urls
from heliograph.functions.strings import doi

#: Words of an institution's name that tell nothing.
GENERIC_NAME_WORDS = ["university", "college", "school", "institute", "technology", "of", "the", "and"]
BLOCK = 1000  # dependencies that one hash covers


def recent(works: DataFrame, person: str, year: str, years: int) -> DataFrame:
    """The works of each person's last `years` years, counted from their latest; a missing year is year 0."""
    known = works.withColumn("_year", F.coalesce(F.col(year), F.lit(0)))
    latest = known.groupBy(F.col(person).alias("_person")).agg(F.max("_year").alias("_latest"))
    return known.join(latest, F.col(person).eqNullSafe(F.col("_person"))).where(F.col("_year") > F.col("_latest") - years).select(*works.columns)


def dependency_hashes(vectors: DataFrame, person: str, key: str, digest: str) -> DataFrame:
    """(person, dependencies, hash): the SHA-256 of a person's works and their vectors, whatever the order of the rows.

    In two levels: blocks of ids, then the blocks' hashes, so that no task holds all works of a person.
    """
    one = F.concat_ws(":", F.col(key).cast("string"), F.coalesce(digest, F.lit("")))
    low = vectors.groupBy(person, F.floor(F.col(key) / BLOCK).alias("_block")).agg(F.array_join(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), one.alias("v")))).getField("v"), ",").alias("_all"), F.count(F.lit(1)).alias("_n"))
    high = F.array_sort(F.collect_list(F.struct("_block", F.sha2("_all", 256).alias("h")))).getField("h")
    return low.groupBy(person).agg(F.sum("_n").alias("dependencies"), F.sha2(F.array_join(high, ","), 256).alias("hash"))


def call_costs(works: DataFrame, trained: DataFrame, shortlist: int) -> DataFrame:
    """(mode, calls_per_match, refresh_calls, coverage): what four ways to get paper vectors ask of an outside service.

    `works` is (person_id, doc_id, doi), `trained` (institution_id, person_id, works) of the people that have a profile.
    """
    pool = trained.groupBy("institution_id").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.avg("n"), F.lit(0.0)).alias("candidates"))
    mean = trained.agg(F.coalesce(F.avg("works"), F.lit(0.0)).alias("works"), F.count(F.lit(1)).alias("people"))
    held = works.agg(F.count(F.lit(1)).alias("rows"), F.count("doi").alias("with_doi"), F.count_distinct("doi").alias("dois"))
    cover = F.col("with_doi") / F.greatest(F.col("rows"), F.lit(1))
    each = F.col("works") * cover
    row = lambda mode, calls, refresh, share: F.struct(F.lit(mode).alias("mode"), F.round(calls, 6).alias("calls_per_match"), refresh.alias("refresh_calls"), F.round(share, 6).alias("coverage"))
    none, whole = F.lit(0.0), F.lit(1.0)
    modes = F.array(
        row("precomputed_career_vector", none, F.col("people"), whole), row("precomputed_paper_vectors", none, F.col("people"), whole),
        row("doi_on_demand_full_institution", F.col("candidates") * each, F.col("dois"), cover),
        row(f"doi_on_demand_top_{shortlist}", F.least(F.lit(float(shortlist)), F.col("candidates")) * each, F.col("dois"), cover),
    )
    return pool.crossJoin(F.broadcast(mean)).crossJoin(F.broadcast(held)).select(F.inline(modes))  # one row each


def select_role_config(results: DataFrame) -> DataFrame:
    """The config with the best nDCG, then Hit@5, then multi-positive nDCG, then the least deviation from equal weights."""
    best = F.max(F.struct("ndcg", "hit_at_5", "multi_ndcg", (-F.col("deviation")).alias("d"), (-F.col("config")).alias("c")))
    return results.agg(best.alias("b")).select((-F.col("b.c")).alias("config"), F.col("b.ndcg").alias("ndcg"))


def is_evaluation_name(name: Column) -> Column:
    """Two words at least of letters, blanks, full stops, apostrophes and hyphens; 4 to 80 characters, 4 letters."""
    n = F.trim(F.coalesce(name, F.lit("")))
    words = F.filter(F.split(n, "[ .'-]+"), lambda w: w != "")
    return F.length(n).between(4, 80) & n.rlike(r"^[\p{L} .'-]+$") & (F.size(words) >= 2) & (F.length(F.regexp_replace(n, r"\P{L}", "")) >= 4)


def topic_confidence(areas: Column, publications: Column) -> Column:
    """high with two areas, medium with one or with official publications, else low; nulls count as none."""
    n = F.coalesce(F.size(areas), F.lit(0))
    return F.when(n >= 2, "high").when((n == 1) | (F.coalesce(publications, F.lit(0)) > 0), "medium").otherwise("low")


def slug_terms(institution: Column) -> Column:
    """The telling words of an institution's name, four characters at least."""
    words = F.regexp_extract_all(F.lower(F.coalesce(institution, F.lit(""))), F.lit("([a-z0-9]+)"), F.lit(1))
    return F.array_distinct(F.filter(words, lambda w: (F.length(w) >= 4) & ~w.isin(*GENERIC_NAME_WORDS)))


def email_domains(emails: Column) -> Column:
    return F.array_distinct(F.transform(F.filter(emails, lambda e: F.contains(e, F.lit("@"))), lambda e: F.lower(F.substring_index(e, "@", -1))))


def is_affiliated(institutions: Column, institution: Column, emails: Column) -> Column:
    """Whether a work's institutions name this one, by its name, one of its mail domains or a telling word."""
    plain = lambda c: F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " "))
    text = F.lower(F.array_join(institutions, " "))
    held = lambda terms: F.exists(terms, lambda t: F.contains(text, t))
    return ((plain(institution) != "") & F.contains(plain(text), plain(institution))) | held(email_domains(emails)) | held(slug_terms(institution))


def is_official_profile(url: Column, institution: Column, emails: Column) -> Column:
    """Whether a profile's host is under one of the person's mail domains, or names the institution."""
    host = urls.host(F.coalesce(url, F.lit("")))
    own = F.exists(email_domains(emails), lambda d: (host == d) | F.endswith(host, F.concat(F.lit("."), d)))
    return (host != "") & (own | F.exists(slug_terms(institution), lambda t: F.contains(host, t)))


def external_ids(links: Column) -> Column:
    """struct(orcid, google_scholar, scopus, openalex): the first id of each registry among links."""
    first = lambda pattern: F.nullif(F.regexp_extract(F.array_join(links, "\n"), pattern, 1), F.lit(""))
    return F.struct(
        F.upper(first(r"(?i)orcid\.org/([0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}[0-9X])")).alias("orcid"),
        first(r"(?i)scholar\.google\.[^\n]*[?&]user=([^&#\n]+)").alias("google_scholar"),
        first(r"(?i)scopus\.com/authid[^\n]*[?&]authorId=([^&#\n]+)").alias("scopus"),
        F.upper(first(r"(?i)openalex\.org/(A[0-9]+)")).alias("openalex"),
    )


def backfill(items: DataFrame, present: DataFrame, keys: list[str], checked: str) -> DataFrame:
    """(keys, checked, items): one state for each key that has items but no state yet."""
    return items.join(present.select(*keys).distinct(), keys, "left_anti").groupBy(*keys).agg(F.max(checked).alias("checked"), F.count(F.lit(1)).alias("items"))


CROSSREF = (
    "DOI string, title array<string>, abstract string, issued struct<`date-parts`:array<array<int>>>, "
    "author array<struct<given:string,family:string,affiliation:array<struct<name:string>>>>"
)
REGISTRY = (
    "id string, name string, names array<struct<value:string,types:array<string>>>, links array<struct<type:string,value:string>>, country struct<country_name:string>"
)


def crossref_json(spark: SparkSession, path: str) -> DataFrame:
    """Works from JSON lines of a DOI registry: title parts joined, markup out of the abstract, the year of issue, authors and affiliations."""
    w = spark.read.schema(CROSSREF).json(path)
    none = F.array().cast("array<string>")
    names = F.transform("author", lambda a: F.concat_ws(" ", a["given"], a["family"]))
    places = F.flatten(F.transform("author", lambda a: F.coalesce(F.transform(a["affiliation"], lambda x: x["name"]), none)))
    return w.select(
        F.array_join(F.coalesce("title", none), " ").alias("title"), F.regexp_replace(F.coalesce("abstract", F.lit("")), "<[^>]+>", " ").alias("abstract"),
        F.try_element_at(F.try_element_at(F.col("issued.date-parts"), F.lit(1)), F.lit(1)).alias("year"), doi(F.col("DOI")).alias("doi"),
        F.coalesce(names, none).alias("authors"), F.array_sort(F.array_distinct(F.array_compact(F.coalesce(places, none)))).alias("institutions"),
    )


def registry_json(spark: SparkSession, path: str) -> DataFrame:
    """Organisations from JSON lines of a registry: id, the name it displays, aliases, home page, country."""
    r = spark.read.schema(REGISTRY).json(path)
    named = F.filter(F.coalesce("names", F.array().cast("array<struct<value:string,types:array<string>>>")), lambda n: F.length(F.coalesce(n["value"], F.lit(""))) > 0)
    shown = F.filter(named, lambda n: F.array_contains(F.coalesce(n["types"], F.array().cast("array<string>")), "ror_display"))
    name = F.coalesce(F.try_element_at(shown, F.lit(-1))["value"], "name", F.try_element_at(named, F.lit(1))["value"])
    return r.select(F.col("id").alias("ror_id"), name.alias("name"), F.transform(F.filter(named, lambda n: n["value"] != name), lambda n: n["value"]).alias("aliases"),
                    F.try_element_at("links", F.lit(1))["value"].alias("homepage_url"), F.col("country.country_name").alias("country"))


def person_query(given: str | None, family: str | None, institution: str | None = None) -> str | None:
    """The search expression for a person in a registry of researchers; null without any part."""
    parts = [f'{field}:"{value}"' for field, value in (("given-names", given), ("family-name", family), ("affiliation-org-name", institution)) if value]
    return " AND ".join(parts) or None


def modes(rows: DataFrame, group: str, value: str) -> DataFrame:
    """(group, mode): the most frequent value, the lowest of equally frequent ones; nulls don't count."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(group).orderBy(F.col("n").desc(), value)
    return counted.withColumn("_r", F.row_number().over(order)).where("_r = 1").select(group, F.col(value).alias("mode"), "n")
