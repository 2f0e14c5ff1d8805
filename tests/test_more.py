"""Authors, records and fetch policies."""

import pytest
from pyspark.sql import functions as F

from heliograph.operators import authors as A
from heliograph.operators import records as D
from heliograph.sources import fetch


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


@pytest.mark.parametrize("text,want", [
    ("EDUCATION\nPhD\n\n1 RESEARCH INTERESTS\nOptics\nLasers\nTECHNICAL SKILLS\nC++\nShort Bio\nBorn", "1 RESEARCH INTERESTS\nOptics\nLasers\nShort Bio\nBorn"),
    ("EDUCATION\nPhD\n\nSKILLS\nC", "EDUCATION\nPhD\nSKILLS\nC"), ("just some prose without any heading at all here", "just some prose without any heading at all here"), (None, None),
])
def test_research_intent(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(A.research_intent(F.col("t"))).first()[0] == want


def test_names():
    assert A.similarity("Müller, Jörg", "Jorg Muller") == 1.0 and A.similarity("", "x") == 0.0 and 0 < A.similarity("Ann Lee", "Anne Lee") < 1
    assert A.initials_compatible("J. R. Doe", "John Ronald Doe") and A.initials_compatible("John Doe", "John Ronald Doe")
    assert not A.initials_compatible("Jane Doe", "John Doe") and not A.initials_compatible("R John Doe", "John R Doe") and not A.initials_compatible("", "Doe")


def test_author_resolution(spark):
    people = spark.createDataFrame([("p", "Ann Lee", "r1"), ("q", "Bob Ray", "r1"), ("s", "Cy Dee", "r2")], "person_id string, display_name string, ror string")
    authors = spark.createDataFrame([("A1", "Lee Ann", "r1", 5), ("A2", "Ann Leé", "r1", 9), ("A3", "Bob Ray", "r1", 1), ("A4", "Cy Dee", "r1", 3)], "author_id string, author_name string, ror string, works_count int")
    assert rows(A.strict_authors(people, authors)) == [("q", "A3")]  # two authors fit Ann
    assert rows(A.author_candidates(people, authors)) == [("p", "A2", 1.0), ("q", "A3", 1.0)]


def test_distinct_assignment(spark):
    assert A.distinct_assignment({"a": ["x", "y"], "b": ["x"]}) == {"a": "y", "b": "x"} and A.distinct_assignment({"a": ["x"], "b": ["x"]}) is None
    e = spark.createDataFrame([("p", "a", "x"), ("p", "a", "y"), ("p", "b", "x"), ("q", "a", "x"), ("q", "b", "x")], "person_id string, author_id string, key string")
    assert rows(A.assign_evidence(e)) == [("p", "a", "y"), ("p", "b", "x")]


def test_authorships_and_overlap(spark):
    works = spark.createDataFrame([("p", "w1", "A1", ["A. Lee"]), ("p", "w2", "A9", ["Ann Lee"]), ("p", "w3", "A1", ["Bo Xu"])], "person_id string, work_id string, author_id string, names array<string>")
    people = spark.createDataFrame([("p", "A1", "Ann Lee")], "person_id string, own_id string, display_name string")
    kept, rejected = A.compatible_authorships(works, people)
    assert rows(kept) == [("p", "w1")] and rows(rejected) == [("author_not_on_work", 1), ("name_incompatible", 1)]
    official = spark.createDataFrame([(1, "10.1/a", "T"), (2, None, "On Öptics!"), (3, None, "none")], "official_id int, doi string, title string")
    known = spark.createDataFrame([("w1", "10.1/a", "other"), ("w2", None, "on optics")], "work_id string, doi string, title string")
    assert rows(A.works_overlap(official, known)) == [(1, "w1", "doi"), (2, "w2", "title")]


def test_publications(spark):
    schema = "source_url string, pos int, title string, citation_text string, year int, doi string, url string, confidence double"
    items = spark.createDataFrame([("u", 0, "A Study of Things", None, 2020, None, None, 0.5), ("u", 1, "a study of things.", None, 2020, None, None, 0.9), ("u", 2, "No Publications", None, None, None, None, 1.0), ("u", 3, "Another title", None, None, "10.1234/x", None, 0.1)], schema)
    assert [(p, k) for _, p, *_, k in rows(D.distinct_publications(items))] == [(1, "a study of things|2020"), (3, "10.1234/x")]
    new = spark.createDataFrame([("p", "Old Title", 2020, "10.1234/x"), ("p", "Gains a DOI", None, "10.1234/new"), ("p", "Brand new", 2021, None)], "person_id string, title string, year int, doi string")
    old = spark.createDataFrame([("p", "f1", "Was called so", 2019, "10.1234/X"), ("p", "f2", "gains a doi", 2020, None), ("q", "f3", "Brand new", 2021, None)], "person_id string, fingerprint_id string, title string, year int, doi string")
    got = {r.title: r.fingerprint_id for r in D.reuse_fingerprint_ids(new, old).collect()}
    assert got["Old Title"] == "f1" and got["Gains a DOI"] == "f2" and got["Brand new"].startswith("pub_")
    kept, summary = D.purge(items.withColumn("person_id", F.lit("p")))
    assert kept.count() == 3 and rows(summary) == [("p", 3, 2020, 1)]


def test_merge_observations(spark):
    schema = "person_id string, observed_at string, source_type string, display_name string, title string, emails array<string>, areas array<string>, external_ids map<string,array<string>>"
    seen = spark.createDataFrame([
        ("p", "2024-01-01", "official_profile", "Ann Lee", "Professor of Law", ["a@u"], ["law"], {"orcid": ["1"]}),
        ("p", "2024-02-01", "directory", "Current research", "Staff", ["b@u", "a@u"], None, {"orcid": ["1", "2"], "scopus": ["9"]})], schema)
    r = D.merge_observations(seen).first()
    assert (r.display_name, r.title, r.emails, r.areas, r.first_seen_at) == ("Ann Lee", "Professor of Law", ["b@u", "a@u"], ["law"], "2024-01-01")
    assert r.external_ids == {"orcid": ["1", "2"], "scopus": ["9"]}


def test_corrections_and_promotion(spark):
    records = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, name string, title string")
    fixed, log = D.apply_corrections(records, spark.createDataFrame([(1, None, "new")], "k int, name string, title string"), "k", ["name", "title"])
    assert rows(fixed) == [(1, "a", "new"), (2, "b", "y")] and rows(log) == [(1, "title", "x", "new")]
    with pytest.raises(ValueError):
        D.apply_corrections(records, spark.createDataFrame([(9, "z", "z")], "k int, name string, title string"), "k", ["name"])
    target = spark.createDataFrame([(1, "other", "x", "A1")], "k int, name string, title string, author string")
    source = records.withColumn("author", F.lit("A1"))
    assert rows(D.promotion_conflicts(source.where("k = 1"), target, "k", ["name", "title"])) == [(1, "differs:name")]
    assert {c for _, c in rows(D.promotion_conflicts(source, target, "k", ["title"], "author"))} == {"author_claimed_twice:A1"}
    assert D.schema_plan(source.withColumn("n", F.lit(1)), target) == (["n int"], [])


def test_json(spark):
    df = spark.createDataFrame([(1, '{"a": [{"old": 1}]}'), (2, "{"), (3, "{}"), (4, None)], "k int, j string")
    assert rows(D.json_audit(df, "k", "j", ["old"])) == [(1, "retired:old"), (2, "invalid_json")]
    assert spark.range(1).select(D.set_payload(F.lit('{"a":"1"}'), "b", F.lit(2))).first()[0] == '{"a":"1","b":"2"}'


def test_fetch_policies(spark):
    assert fetch.retry_delay(2) == 4 and fetch.retry_delay(0, 30) == 30
    assert fetch.allowed("User-agent: *\nDisallow: /x\nCrawl-delay: 2", "http://h/x/1") == (False, 2.0)
    urls = spark.createDataFrame([("http://a/1",), ("http://a/2",), ("http://b/1",)], "url string")
    assert rows(fetch.schedule(urls, 2)) == [("http://a/1", "a", 0.0), ("http://a/2", "a", 2.0), ("http://b/1", "b", 0.0)]
    pick = lambda *v: tuple(spark.range(1).select(fetch.refresh_decision(*[F.lit(x) for x in v])).first()[0])
    assert pick(None, "h", None, "p") == (True, "first_seen") and pick("h", "h", "p", "p") == (False, "unchanged") and pick("h", "g", "p", "p") == (True, "body_changed") and pick("h", "h", "p", "q") == (True, "parser_changed")


def test_cursor_proof():
    pages = {"*": {"count": 3, "next": "b", "results": [{"id": 1, "updated_date": "3"}, {"id": 2, "updated_date": "2"}]}, "b": {"count": 3, "next": None, "results": [{"id": 3, "updated_date": "1"}]}}
    assert [w["id"] for w in fetch.pages_of(pages.__getitem__)] == [1, 2, 3] and [w["id"] for w in fetch.pages_of(pages.__getitem__, "2")] == [1, 2]
    for broken in ({"b": pages["b"] | {"count": 4}}, {"b": pages["b"] | {"next": "*"}}, {"b": pages["b"] | {"results": []}}):
        with pytest.raises(fetch.IncompleteInventory):
            list(fetch.pages_of((pages | broken).__getitem__))


def test_page_publications_against_brute_force(spark, tmp_path):
    from heliograph.plans import catalog

    docs = [(i, f"A study of subject {chr(97 + i % 7) * 3} {i % n}\nbody {i}", "en", s, 9) for s, n, first in (("small", 30, 0), ("mid", 300, 1000), ("large", 600, 2000)) for i in range(first, first + 900)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    want = set()
    for source in ("small", "mid", "large"):
        seen = {}
        for i, text, _, s, _ in sorted(docs):
            if s == source:
                seen.setdefault(text.split("\n")[0].lower() + "|2020", i)
        want |= {(source, pos, key) for key, pos in sorted(seen.items(), key=lambda x: x[1])[:500]}
    got = rows(catalog.queries()["page_publications"](spark, str(tmp_path)))
    assert len(got) == len(want) and set(got) == want


def test_workspace_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from heliograph.runtime import workspace

    fake = lambda master, folder: SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: folder), sparkContext=SimpleNamespace(master=master, _heliograph_workspace="/tmp/here"))
    assert workspace(fake("local[4]", None)) == workspace(fake("local", None)) == "/tmp/here" and workspace(fake("spark://a:1", "/shared/")) == "/shared"
    for master in ("spark://a:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            workspace(fake(master, None))


def test_discarded_tables_are_gone(spark):
    from heliograph.runtime import discard, saved

    table = saved(spark.range(5).toDF("x"), "gone")
    assert table.count() == 5
    discard(table)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(table._heliograph_path)
