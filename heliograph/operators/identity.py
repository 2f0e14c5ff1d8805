"""Identity resolution: keys, candidate pairs, rules, groups, aliases and consolidation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliograph.functions import strings as S
from heliograph.runtime import discard, saved

#: Which shared key decides, in order, and what the decision is called.
RULES = {
    "orcid": (0, "same_orcid"), "openalex_author_id": (1, "same_openalex_author_id"), "official_person_id": (2, "same_official_person_id"),
    "scopus_author_id": (3, "same_scopus_author_id"), "google_scholar_id": (4, "same_google_scholar_id"),
    "profile_exact": (5, "same_normalized_name_and_profile_url"), "email": (6, "same_normalized_name_and_email"),
    "profile_slug": (7, "same_normalized_name_and_profile_slug"),
}


def candidate_pairs(keys: DataFrame) -> DataFrame:
    """(left, right, kinds): people of one institution that share a key, found by an equi-join on the key.

    `keys` is (institution_id, person_id, kind, value); left < right.
    """
    a = keys.select("institution_id", "kind", "value", F.col("person_id").alias("left"))
    b = keys.select("institution_id", "kind", "value", F.col("person_id").alias("right"))
    return a.join(b, ["institution_id", "kind", "value"]).where("left < right").groupBy("left", "right").agg(F.array_sort(F.collect_set("kind")).alias("kinds"))


def shared_key_edges(keys: DataFrame) -> DataFrame:
    """(left, right): every person with the least one that shares a key, so that a key of n people makes n - 1 edges.

    Enough for connected components; `candidate_pairs` is for rules that look at both sides of each pair.
    """
    least = keys.groupBy("institution_id", "kind", "value").agg(F.min("person_id").alias("left"))
    joined = keys.select("institution_id", "kind", "value", F.col("person_id").alias("right")).join(least, ["institution_id", "kind", "value"])
    return joined.where("left < right").select("left", "right").distinct()


def similar_names(left: DataFrame, right: DataFrame, group: str, held: int = 12) -> DataFrame:
    """(group, name, other_name, score): plain names of left and right in one group that are similar at all, each pair once.

    They share a word, or one holds the other: then the holder has the other's last `held` characters among its substrings.
    """
    def keyed(names: DataFrame, name: str, holder: str, part: str) -> DataFrame:
        n = F.col(name)
        tag = lambda kind, keys: F.transform(keys, lambda k: F.concat(F.lit(kind), k))
        keys = F.concat(tag("=", F.array_distinct(F.split(n, " "))), tag(holder, S.substrings(n, held)), tag(part, F.array(F.right(n, F.lit(held)))))
        return names.select(group, n, F.explode(keys).alias("_key"))

    a = keyed(left.select(group, "name").distinct(), "name", "<", ">")
    b = keyed(right.select(group, F.col("name").alias("other_name")).distinct(), "other_name", ">", "<")
    pairs = a.join(b, [group, "_key"]).select(group, "name", "other_name").distinct()
    return pairs.withColumn("score", S.plain_similarity(F.col("name"), F.col("other_name"))).where("score > 0")


def expanded(members: DataFrame, found: DataFrame, keys: list[str], most: int = 1024) -> DataFrame:
    """members with found on keys, every pair of them; a key of many members is dealt to parts of about `most`.

    Rows out, not bytes in, are what a task takes here, so the number of tasks is set and nothing small is broadcast.
    """
    spark = members.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    parts = members.groupBy(*keys).agg(F.ceil(F.count("*") / most).cast("int").alias("_parts"))
    a = members.withColumn("_part", F.xxhash64(*members.columns)).join(parts, keys).withColumn("_part", F.pmod("_part", "_parts").cast("int")).drop("_parts")
    b = found.join(parts, keys).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    return a.repartition(tasks, *keys, "_part").join(b.repartition(tasks, *keys, "_part").hint("merge"), [*keys, "_part"]).drop("_part")


def separating_conflict(*families: tuple[Column, Column]) -> Column:
    """Whether two families of values at least are there on both sides and have nothing in common."""
    clash = [F.when((F.size(a) > 0) & (F.size(b) > 0) & ~F.arrays_overlap(a, b), 1).otherwise(0) for a, b in families]
    return sum(clash[1:], clash[0]) >= 2


def decide(kinds: Column, same_name: Column, conflict: Column) -> Column:
    """struct(priority, reason) of the first rule that joins a pair, or null.

    External ids decide alone; weaker keys need the same name and no conflict.
    """
    out = F.lit(None).cast("struct<priority:int,reason:string>")
    for kind, (priority, reason) in sorted(RULES.items(), key=lambda x: -x[1][0]):
        allowed = F.array_contains(kinds, kind) & (F.lit(True) if priority < 5 else same_name & ~conflict)
        out = F.when(allowed, F.struct(F.lit(priority).alias("priority"), F.lit(reason).alias("reason"))).otherwise(out)
    return out


def groups(pairs: DataFrame, left: str = "left", right: str = "right") -> DataFrame:
    """(node, root): connected components; the root is the least node. Labels are min-joined and jumped to a fixpoint."""
    edges = saved(pairs.select(F.col(left).alias("a"), F.col(right).alias("b")).unionByName(pairs.select(F.col(right).alias("a"), F.col(left).alias("b"))).distinct(), "identity-edges")
    labels = saved(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")), "identity-labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        spread = labels.join(near, "node").select("node", F.col("root").alias("was"), F.least("root", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("root").alias("far"))
        moved = saved(spread.join(jump, "next", "left").select("node", "was", F.least("next", F.coalesce("far", "next")).alias("root")), "identity-labels")
        discard(labels)
        labels = moved
        if moved.where("was <> root").isEmpty():
            discard(edges)
            return labels.select("node", "root")


def resolve_aliases(aliases: DataFrame, rounds: int = 32) -> DataFrame:
    """(alias, canonical) at the end of each chain, by pointer jumping; members of a cycle resolve to null.

    A chain of n links takes about log2(n) rounds. Within `rounds` only cycles stay unresolved.
    """
    links = aliases.select("alias", F.col("canonical").alias("at")).distinct()
    current = saved(links, "aliases")
    for _ in range(rounds):
        step = current.alias("c").join(current.select(F.col("alias").alias("_a"), F.col("at").alias("_t")), F.col("c.at") == F.col("_a"), "left")
        moved = saved(step.select("alias", F.coalesce("_t", "at").alias("at"), F.col("_t").isNotNull().alias("_moved")), "aliases")
        current = moved.select("alias", "at")
        if moved.where("_moved").isEmpty():
            return current.withColumnRenamed("at", "canonical")
    ends = links.select(F.col("alias").alias("_x"))
    return current.join(ends, F.col("at") == F.col("_x"), "left").select("alias", F.when(F.col("_x").isNull(), F.col("at")).alias("canonical"))


def alias_violations(aliases: DataFrame, people: DataFrame) -> DataFrame:
    """(alias, canonical, violation): self, dangling, still_canonical, cross_institution and cycle."""
    known = people.select(F.col("person_id").alias("_c"), F.col("institution_id").alias("_ci"))
    own = people.select(F.col("person_id").alias("_p"), F.col("institution_id").alias("_pi"))
    ends = resolve_aliases(aliases).select(F.col("alias").alias("_e"), F.col("canonical").alias("_end"))
    chained = aliases.select(F.col("alias").alias("_n"))
    joined = (
        aliases.join(ends, F.col("alias") == F.col("_e"), "left").join(known, F.col("_end") == F.col("_c"), "left").join(own, F.col("alias") == F.col("_p"), "left")
        .join(chained.distinct(), F.col("canonical") == F.col("_n"), "left")
    )
    found = F.array_compact(F.array(
        F.when(F.col("alias") == F.col("canonical"), "self"), F.when(F.col("_end").isNull() & (F.col("alias") != F.col("canonical")), "cycle"),
        F.when(F.col("_end").isNotNull() & F.col("_c").isNull(), "dangling"), F.when(F.col("_p").isNotNull(), "still_canonical"),
        F.when(F.col("_ci") != F.col("institution_id"), "cross_institution"),
    ))
    return joined.select("alias", "canonical", F.explode(found).alias("violation"))


def reparent(children: DataFrame, owner: str, aliases: DataFrame) -> DataFrame:
    """Children under their canonical owners."""
    ends = aliases.select(F.col("alias").alias("_a"), F.col("canonical").alias("_t"))
    return children.join(ends, F.col(owner) == F.col("_a"), "left").withColumn(owner, F.coalesce("_t", owner)).drop("_a", "_t")


def preferred(people: DataFrame, group: str) -> DataFrame:
    """(group, person_id): the earliest first_seen of each group, then the least id."""
    return people.groupBy(group).agg(F.min(F.struct(F.coalesce("first_seen_at", F.lit("9999")).alias("s"), F.col("person_id"))).alias("m")).select(group, F.col("m.person_id").alias("person_id"))


def split_rows(rows: DataFrame, owner: str, url: str, urls: list[str], new_id: str) -> DataFrame:
    """Rows of the given source urls moved to a new person."""
    return rows.withColumn(owner, F.when(F.col(url).isin(*urls), F.lit(new_id)).otherwise(F.col(owner)))


def merge_external_ids(a: Column, b: Column) -> Column:
    """Two maps of id lists as one: values of both, first occurrences, per kind."""
    none = F.array().cast("array<string>")
    return F.map_filter(
        F.map_zip_with(a, b, lambda k, x, y: F.array_distinct(F.filter(F.concat(F.coalesce(x, none), F.coalesce(y, none)), lambda v: v.isNotNull() & (v != "")))),
        lambda k, v: F.size(v) > 0,
    )


def better_of(old: Column, new: Column, old_rank: Column, new_rank: Column, quality, prefer_new: bool = False) -> Column:
    """The better of two values by (quality, source rank); on a tie the old one, or the new one if preferred and there."""
    a, b = F.struct(quality(old).alias("q"), old_rank.alias("r")), F.struct(quality(new).alias("q"), new_rank.alias("r"))
    tie = (a == b) & new.isNotNull() if prefer_new else F.lit(False)
    return F.when((b > a) | tie, new).otherwise(old)


def contact_confidence(evidence: DataFrame, key: str) -> DataFrame:
    """(key, contact_confidence, affiliation_confidence, verdict) from e-mail evidence."""
    flags = evidence.groupBy(key).agg(
        F.max(F.col("official") & F.col("aligned") & (F.col("association") == "person_local")).alias("local"),
        F.max(F.col("official") & F.col("aligned")).alias("aligned"), F.max(F.col("official") & ~F.col("aligned")).alias("conflict"),
    )
    confidence = F.when(F.col("local"), "high").when(F.col("aligned"), "medium").otherwise("low")
    verdict = F.when(F.col("conflict"), "current_affiliation_conflict").when(confidence == "high", "high_confidence_contactable").otherwise("stale_risk")
    return flags.select(key, confidence.alias("contact_confidence"), confidence.alias("affiliation_confidence"), verdict.alias("verdict"))


def email_verdict(official: Column, aligned: Column) -> Column:
    """struct(verdict, confidence) of one address."""
    pair = lambda v, c: F.struct(F.lit(v).alias("verdict"), F.lit(c).alias("confidence"))
    return (
        F.when(official & aligned, pair("official_domain_aligned", 0.95)).when(official, pair("official_source_domain_conflict", 0.55))
        .when(aligned, pair("aligned_domain_third_party_source", 0.45)).otherwise(pair("unverified_email", 0.25))
    )
