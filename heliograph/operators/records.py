"""Records: publication fingerprints, ordered merges, corrections, promotion checks and JSON audits."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliograph.functions import predicates, strings
from heliograph.operators.identity import merge_external_ids
from heliograph.operators.lifecycle import latest


def fingerprint_key(doi: Column, title: Column, year: Column) -> Column:
    """A publication's identity: its DOI, else its lower-case title and year."""
    return F.coalesce(strings.doi(doi), F.concat_ws("|", strings.label(title), F.coalesce(year.cast("string"), F.lit(""))))


def distinct_publications(items: DataFrame, limit: int = 500) -> DataFrame:
    """Meaningful items of each page, one per fingerprint: the most confident, then the first; `limit` per page.

    `items` is (source_url, pos, title, citation_text, year, doi, url, confidence).
    """
    good = items.where(predicates.is_meaningful_publication(F.col("title"), F.col("citation_text"), F.col("year"), F.col("doi"), F.col("url")))
    keyed = good.withColumn("key", fingerprint_key(F.col("doi"), F.col("title"), F.col("year")))
    one = latest(keyed, ["source_url", "key"], [F.col("confidence").desc(), F.col("pos")])
    n = F.row_number().over(Window.partitionBy("source_url").orderBy("pos"))
    return one.withColumn("_n", n).where(F.col("_n") <= limit).drop("_n")


def reuse_fingerprint_ids(new: DataFrame, existing: DataFrame) -> DataFrame:
    """new with fingerprint_id: that of a unique DOI match, else of a unique title match with a compatible year, else a new one.

    Both are per person: new (person_id, title, year, doi), existing also with fingerprint_id.
    """
    rows = new.withColumns({"_row": F.monotonically_increasing_id(), "_d": strings.doi(F.col("doi")), "_t": strings.label(F.col("title"))})
    e = existing.select(F.col("person_id").alias("_p"), F.col("fingerprint_id").alias("_id"), strings.doi(F.col("doi")).alias("_ed"), strings.label(F.col("title")).alias("_et"), F.col("year").alias("_ey"))

    def unique(on, name):
        found = rows.join(e, (F.col("person_id") == F.col("_p")) & on).groupBy("_row").agg(F.collect_set("_id").alias("ids"))
        return found.where(F.size("ids") == 1).select("_row", F.col("ids")[0].alias(name))

    by_doi = unique(F.col("_d") == F.col("_ed"), "_by_doi")
    by_title = unique((F.col("_t") == F.col("_et")) & (F.col("year").isNull() | F.col("_ey").isNull() | (F.col("year") == F.col("_ey"))), "_by_title")
    fresh = strings.stable_id("pub", F.col("person_id"), fingerprint_key(F.col("doi"), F.col("title"), F.col("year")))
    joined = rows.join(by_doi, "_row", "left").join(by_title, "_row", "left")
    return joined.withColumn("fingerprint_id", F.coalesce("_by_doi", "_by_title", fresh)).drop("_row", "_d", "_t", "_by_doi", "_by_title")


def purge(publications: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, summary): meaningful fingerprints, and per person how many, the latest year and how many with a DOI."""
    kept = publications.where(predicates.is_meaningful_publication(F.col("title"), F.col("citation_text"), F.col("year"), F.col("doi"), F.lit(None).cast("string")))
    return kept, kept.groupBy("person_id").agg(F.count(F.lit(1)).alias("publications"), F.max("year").alias("latest_year"), F.count_if(F.col("doi").isNotNull()).alias("with_doi"))


def merge_observations(observations: DataFrame) -> DataFrame:
    """One record per person from observations (person_id, observed_at, source_type, display_name, title, emails, areas, external_ids).

    Scalars: the best by quality, source rank and freshness. Lists: united, newest observation first.
    """
    rank = predicates.source_rank(F.col("source_type"))
    def best(column, quality):
        return F.max_by(column, F.when(F.col(column).isNotNull(), F.struct(quality(F.col(column)), rank, F.col("observed_at"), F.col(column)))).alias(column)

    def united(column):
        newest = F.sort_array(F.collect_list(F.struct("observed_at", F.coalesce(column, F.array().cast("array<string>")).alias("v"))), asc=False)
        return F.array_distinct(F.flatten(F.transform(newest, lambda x: x["v"]))).alias(column)

    maps = F.sort_array(F.collect_list(F.struct("observed_at", F.map_entries("external_ids").alias("v"))))
    empty = F.map_from_entries(F.array().cast("array<struct<key:string,value:array<string>>>"))
    ids = F.aggregate(maps, empty, lambda a, x: merge_external_ids(a, F.map_from_entries(F.coalesce(x["v"], F.array().cast("array<struct<key:string,value:array<string>>>")))))
    return observations.groupBy("person_id").agg(
        best("display_name", predicates.name_quality), best("title", predicates.title_quality), united("emails"), united("areas"), ids.alias("external_ids"),
        F.min("observed_at").alias("first_seen_at"), F.max("observed_at").alias("last_seen_at"),
    )


def apply_corrections(records: DataFrame, corrections: DataFrame, key: str, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """(records, log): reviewed values replace whole fields; the log has before and after of each.

    Stops with an error if a correction's target isn't there.
    """
    missing = corrections.join(records.select(key), key, "left_anti").limit(1).collect()
    if missing:
        raise ValueError(f"no record for correction {missing[0][key]!r}")
    c = corrections.select(key, *[F.col(f).alias(f"_c_{f}") for f in fields])
    joined = records.join(c, key, "left")
    fixed = joined.select(*[F.coalesce(f"_c_{x}", x).alias(x) if x in fields else F.col(x) for x in records.columns])
    entries = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("before"), F.col(f"_c_{f}").cast("string").alias("after")) for f in fields]))
    log = joined.select(key, entries.alias("e")).select(key, "e.*").where("after is not null and not (before <=> after)")
    return fixed, log


def schema_plan(source: DataFrame, target: DataFrame) -> tuple[list[str], list[str]]:
    """(columns to add, conflicts): a promotion may add columns but not change a type."""
    known = dict(target.dtypes)
    add = [f"{c} {t}" for c, t in source.dtypes if c not in known]
    return add, [f"{c}: {t} against {known[c]}" for c, t in source.dtypes if c in known and known[c] != t]


def promotion_conflicts(source: DataFrame, target: DataFrame, key: str, fields: list[str], author: str | None = None) -> DataFrame:
    """(key, conflict): rows that both sides have with different identity fields, and authors that two people claim."""
    a, b = source.alias("s"), target.alias("t")
    differs = F.array_compact(F.array(*[F.when(~F.col(f"s.{f}").eqNullSafe(F.col(f"t.{f}")), F.lit(f)) for f in fields]))
    found = a.join(b, F.col(f"s.{key}") == F.col(f"t.{key}")).select(F.col(f"s.{key}").alias(key), F.explode(differs).alias("f"))
    out = found.select(key, F.concat(F.lit("differs:"), "f").alias("conflict"))
    if author:
        both = source.select(key, author).unionByName(target.select(key, author)).where(F.col(author).isNotNull())
        twice = both.groupBy(author).agg(F.collect_set(key).alias("k")).where(F.size("k") > 1)
        out = out.unionByName(twice.select(F.explode("k").alias(key), F.concat(F.lit("author_claimed_twice:"), author).alias("conflict")))
    return out


def closure(people: DataFrame, links: DataFrame, works: DataFrame, vectors: DataFrame) -> dict[str, DataFrame]:
    """Everything that belongs to some people: their links, the linked works and those works' vectors."""
    own = links.join(people.select("person_id"), "person_id", "left_semi")
    kept = works.join(own.select("work_id").distinct(), "work_id", "left_semi")
    return {"links": own, "works": kept, "vectors": vectors.join(kept.select("work_id"), "work_id", "left_semi")}


def json_nodes(value):
    """Every object inside a parsed JSON value, depth first."""
    stack = [value]
    while stack:
        at = stack.pop()
        if isinstance(at, dict):
            yield at
            stack.extend(reversed(list(at.values())))
        elif isinstance(at, list):
            stack.extend(reversed(at))


def json_audit(rows: DataFrame, key: str, payload: str, retired: list[str]) -> DataFrame:
    """(key, finding): payloads that aren't JSON, and retired keys anywhere inside."""
    from heliograph.runtime import ship_code

    ship_code(rows.sparkSession)

    @F.arrow_udf("array<string>")
    def findings(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            try:
                out.append(sorted({f"retired:{k}" for node in json_nodes(json.loads(text or "null")) for k in node if k in retired}))
            except ValueError:
                out.append(["invalid_json"])
        return pa.array(out, pa.list_(pa.string()))

    return rows.select(key, F.explode(findings(F.col(payload))).alias("finding"))


def set_payload(payload: Column, key: str, value: Column) -> Column:
    """A flat JSON object with one key set; text that isn't an object counts as empty."""
    known = F.coalesce(F.from_json(payload, "map<string,string>"), F.create_map().cast("map<string,string>"))
    return F.to_json(F.map_concat(F.map_filter(known, lambda k, v: k != key), F.create_map(F.lit(key), value.cast("string"))))
