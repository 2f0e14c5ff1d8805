"""Profiles, cost models and registries' metadata on small literal frames."""

import json

import pytest
from pyspark.sql import functions as F

from heliograph.operators import profiles as P


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()[0]


def test_recent_works_and_hashes(spark):
    w = spark.createDataFrame([("a", 1, 2020, "x"), ("a", 2, 2018, "y"), ("a", 3, 2017, "z"), ("b", 4, None, "w"), (None, 5, 2000, "v")], "p string, k long, y int, h string")
    assert sorted(r.k for r in P.recent(w, "p", "y", 3).collect()) == [1, 2, 4, 5]
    big = spark.range(2500).selectExpr("'a' as p", "id as k", "md5(string(id)) as h")
    got = {r.hash for r in [P.dependency_hashes(x, "p", "k", "h").first() for x in (big, big.orderBy(F.desc("k")).repartition(5))]}
    changed = P.dependency_hashes(big.withColumn("h", F.when(F.col("k") == 7, "other").otherwise(F.col("h"))), "p", "k", "h").first()
    assert len(got) == 1 and changed.hash not in got and changed.dependencies == 2500


@pytest.mark.parametrize("name,good", [("Jane Doe", True), ("J. O'Neil-Ray", True), ("Plato", False), ("Jane D0e", False), ("A B", False), ("Éva Tóth", True), (None, False), ("x" * 50 + " " + "y" * 50, False), ("Jane @ Doe", False)])
def test_evaluation_names(spark, name, good):
    assert one(spark, P.is_evaluation_name(F.lit(name).cast("string"))) == good


def test_official_profiles_and_affiliations(spark):
    name, mail = F.lit("University of Utrecht"), F.array(F.lit("a@uu.nl"), F.lit("none"))
    official = lambda u: one(spark, P.is_official_profile(F.lit(u).cast("string"), name, mail))
    assert official("https://www.uu.nl/x") and official("https://cs.uu.nl/x") and official("https://utrecht.example.org/") and not official("https://notuu.nl/") and not official(None)
    held = lambda *i: one(spark, P.is_affiliated(F.array(*[F.lit(x) for x in i]).cast("array<string>"), name, mail))
    assert held("Dept., University of Utrecht, NL") and held("mail at uu.nl") and held("Hogeschool Utrecht") and not held("University of Leiden") and not held()
    assert one(spark, P.slug_terms(F.lit("The College of Arts and Technology, MIT"))) == ["arts"]


def test_external_ids(spark):
    links = ["https://orcid.org/0000-0001-2345-678x", "https://orcid.org/0000-0009-9999-9999", "https://scholar.google.com/citations?hl=en&user=AbC", "http://www.scopus.com/authid/detail.uri?authorId=77", "https://openalex.org/a12"]
    assert tuple(one(spark, P.external_ids(F.array(*[F.lit(x) for x in links])))) == ("0000-0001-2345-678X", "AbC", "77", "A12")
    assert tuple(one(spark, P.external_ids(F.array().cast("array<string>")))) == (None,) * 4


def test_registry_payloads(spark, tmp_path):
    (tmp_path / "c.json").write_text("\n".join(map(json.dumps, [
        {"DOI": "10.1000/X.", "title": ["A", "study"], "abstract": "<p>Of <b>things</b></p>", "issued": {"date-parts": [[2020, 1]]},
         "author": [{"given": "Ann", "family": "Lee", "affiliation": [{"name": "Z"}, {"name": "B"}]}, {"family": "Roe"}]}, {"title": None}, {"issued": {"date-parts": []}}])))
    a, b, c = sorted(P.crossref_json(spark, str(tmp_path / "c.json")).collect(), key=lambda r: r.title, reverse=True)
    assert (a.title, a.year, a.doi, a.authors, a.institutions) == ("A study", 2020, "10.1000/x", ["Ann Lee", "Roe"], ["B", "Z"]) and " Of " in a.abstract and b.year is c.year is None
    (tmp_path / "r.json").write_text(json.dumps({"id": "https://ror.org/1", "names": [{"value": "UU", "types": ["acronym"]}, {"value": "Utrecht University", "types": ["ror_display"]}], "links": [{"type": "website", "value": "https://uu.nl"}], "country": {"country_name": "NL"}}))
    r = P.registry_json(spark, str(tmp_path / "r.json")).first()
    assert tuple(r) == ("https://ror.org/1", "Utrecht University", ["UU"], "https://uu.nl", "NL")
    assert P.person_query("Ann", "Lee", "UU") == 'given-names:"Ann" AND family-name:"Lee" AND affiliation-org-name:"UU"' and P.person_query(None, "") is None


def test_topic_confidence(spark):
    got = [one(spark, P.topic_confidence(F.array(*[F.lit(x) for x in a]).cast("array<string>"), F.lit(n))) for a, n in ((["a", "b"], 0), (["a"], 0), ([], 3), ([], 0), ([], None))]
    assert got == ["high", "medium", "medium", "low", "low"]
