"""Functions, predicates, identity, lifecycle, sources and sinks on small literal frames."""

import hashlib
import json
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliograph import schemas
from heliograph.functions import predicates as P
from heliograph.functions import strings as S
from heliograph.functions import terms as T
from heliograph.functions import urls as U
from heliograph.operators import evaluation as E
from heliograph.operators import identity as I
from heliograph.operators import lifecycle as L
from heliograph.operators import pages as H
from heliograph.operators import retrieval as R
from heliograph.sources import readers, sinks


def one(spark, expression, *values):
    """The expression over literals."""
    return spark.range(1).select(expression(*[F.lit(v) for v in values]).alias("x")).first()[0]


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


@pytest.mark.parametrize("text,want", [
    ("see https://doi.org/10.1000/ABC.12).", "10.1000/abc.12"), ("10.12345/x_y;", "10.12345/x_y"), ("no doi 10.1/x", None), (None, None),
])
def test_doi(spark, text, want):
    assert one(spark, S.doi, text) == want


def test_stable_id(spark):
    want = "inst_" + hashlib.sha256(b"a\n\nc").hexdigest()[:16]
    assert spark.range(1).select(S.stable_id("inst", F.lit("a"), F.lit(None), F.lit("c"))).first()[0] == want


def test_names(spark):
    assert tuple(one(spark, S.split_name, "Doe,  Jane Ann")) == ("Jane Ann", "Doe", "Jane Ann Doe")
    assert tuple(one(spark, S.split_name, " Jane  Ann Doe ")) == ("Jane Ann", "Doe", "Jane Ann Doe")
    assert tuple(one(spark, S.split_name, "Plato")) == (None, "Plato", "Plato")
    assert one(spark, S.name_similarity, "Dr. Jane Doe", "jane doe") == 1.0
    assert one(spark, S.name_similarity, "Jane M Doe", "Jane Doe") == 0.9
    assert one(spark, S.name_similarity, "Jane Doe", "John Smith") == 0.0
    assert one(spark, S.name_similarity, "", "John") == 0.0


def test_emails(spark):
    text = "Write to Ann.Lee@uni.edu, info@uni.edu or pic@2x.png; also ann.lee@uni.edu."
    assert one(spark, S.visible_emails, text) == ["ann.lee@uni.edu", "info@uni.edu"]
    both = spark.range(1).select(S.person_emails(F.array(F.lit("Ann@u.edu"), F.lit("admissions2@u.edu"), F.lit("bad@x.png"))).alias("x")).first().x
    assert both.person == ["ann@u.edu"] and both.ambiguous == ["admissions2@u.edu"]
    assert one(spark, S.obfuscated_emails, "ann (at) uni.edu, bob [at] uni [dot] edu") == ["ann@uni.edu", "bob@uni.edu"]
    secret = "".join(f"{b:02x}" for b in [0x42, *[ord(c) ^ 0x42 for c in "a@b.cd"]])
    assert one(spark, S.cloudflare_email, secret) == "a@b.cd"
    assert one(spark, S.rot13, "Uryyb") == "Hello"


def test_titles(spark):
    assert one(spark, S.merged_titles, "Stelux Professor in Finance; Professor", "Dean;  professor ") == "Stelux Professor in Finance; Dean"
    assert one(spark, S.merged_titles, None, "") is None
    assert one(spark, S.percent_escapes, "/a%c3%a9b%") == "/a%C3%A9b%"
    inverted = spark.range(1).select(S.abstract_text(F.create_map(F.lit("b"), F.array(F.lit(1)), F.lit("a"), F.array(F.lit(0), F.lit(2))))).first()[0]
    assert inverted == "a b a"


@pytest.mark.parametrize("url,want", [
    ("HTTP://www.Uni.edu:80//people/Jane/?utm_source=x&b=2&A=1#bio", "uni.edu/people/jane?a=1&b=2"), ("https://uni.edu/x/index.html", "uni.edu/x"),
    ("https://uni.edu/staff#AlexG", "uni.edu/staff#alexg"), ("https://uni.edu:8080", "uni.edu:8080/"), (None, ""), ("", ""),
])
def test_canonical_url(spark, url, want):
    assert one(spark, U.canonical, url) == want


def test_url_predicates(spark):
    assert one(spark, U.registrable, "www.cs.uni.edu.hk") == "uni.edu.hk" and one(spark, U.registrable, "a.b.uni.com") == "uni.com"
    assert one(spark, U.slug_key, "https://people.uni.edu/staff/jane") == "uni.edu|jane"
    assert one(spark, U.is_unusable, "https://orcid.org/0000") and one(spark, U.is_unusable, "mailt:x@y") and one(spark, U.is_unusable, "https://scholars.uni.edu/")
    assert not one(spark, U.is_unusable, "https://jane.me/") and not one(spark, U.is_unusable, None)
    assert one(spark, U.is_person_specific, "https://u.edu/people/jane") and one(spark, U.is_person_specific, "https://u.edu/p.php?id=3")
    assert not one(spark, U.is_person_specific, "https://u.edu/people")
    assert spark.range(1).select(U.is_official(F.lit("https://cs.uni.edu/x"), ["www.uni.edu"])).first()[0]
    assert not spark.range(1).select(U.is_official(F.lit("https://notuni.edu/x"), ["uni.edu"])).first()[0]


MEANINGFUL = [
    ("Research output per year", None, None, False), ("View all publications", None, None, False), ("No Publications", None, None, False),
    ("1 Book Chapter", None, None, False), ("57 Journal Articles", None, None, False), ("1 More 2 Books", None, None, False), ("Prize: best paper", None, None, False),
    ("https://example.org/a", None, None, False), ("www.example.org", None, None, False), ("12 Angry Men and the Law of Jury Deliberation", None, None, True),
    ("3 Articles that Changed Competition Law", None, None, True), ("1 Book Chapter", "10.1000/x", None, True), ("研究机器学习的方法与应用", None, 2020, True),
    ("https://example.org/a", "10.1000/x", None, True), ("short", None, 2020, False), (None, None, None, False),
]


def test_meaningful_publications(spark):
    P.register(spark)
    df = spark.createDataFrame([(i, t, d, y) for i, (t, d, y, _) in enumerate(MEANINGFUL)], "i int, t string, d string, y int").withColumn("n", F.lit(None).cast("string"))
    got = df.select("i", P.is_meaningful_publication(F.col("t"), F.col("n"), F.col("y"), F.col("d"), F.col("n")).alias("a"), F.expr("publication_is_meaningful(t, n, y, d, n)").alias("b"))
    for i, a, b in rows(got, "i"):
        assert (a, b) == (MEANINGFUL[i][3],) * 2, MEANINGFUL[i]


@pytest.mark.parametrize("name,bad", [
    ("Jane Doe", False), ("Academic Staff", True), ("Honorary Professors and Lecturers", True), ("Congratulations to our team", True), ("", True), (None, True),
    ("Welcome to Jane's Home Page", True), ("School of Law", True), ("Selected Publications (2020)", True), ("He won the award at a symposium", True),
])
def test_non_person_names(spark, name, bad):
    assert one(spark, P.is_non_person_name, name) == bad


def test_quality_scores(spark):
    assert one(spark, P.title_quality, "Professor of Law") == 35 and one(spark, P.title_quality, None) == -100 and one(spark, P.title_quality, "Staff") == -20
    assert one(spark, P.name_quality, "Jane Doe") == 32 and one(spark, P.name_quality, "Plato") == -63
    assert one(spark, P.appointment_risk, "Former and Emeritus Professor") == "emeritus"
    assert one(spark, P.incomplete_name_reasons, "Plato") == ["single_token"] and one(spark, P.incomplete_name_reasons, "J. D.") == ["initials_only"]
    assert one(spark, P.source_rank, "official_profile") == 50


def python_vector(text, limit):
    """The weighting in plain Python, from its definition."""
    words = [w for w in re.findall(T.TOKEN, (text or "").lower()) if w not in T.STOPWORDS]
    out = {}
    for n in (1, 2, 3):
        for i in range(len(words) - n + 1):
            parts = words[i : i + n]
            known = sum(p not in T.LOW_SIGNAL for p in parts)
            if n == 1:
                w = 25 if not known else 125 if len(parts[0]) >= 12 else 110 if len(parts[0]) >= 8 else 100
            else:
                w = 100 + 35 * (n - 1) + 15 * known if known else 0
            if w:
                out["_".join(parts)] = out.get("_".join(parts), 0) + w
    best = sorted(out.items(), key=lambda x: (-x[1], x[0]))[:limit]
    return {k: v / 100 for k, v in best}


def test_semantic_vectors_against_python(spark):
    texts = ["Deep learning models for protein folding and computational chemistry", "the and of", None, "robot robot deep learning data analysis " * 4, "a1-b+c2 x"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {}
    for i, term, weight in rows(T.semantic_vectors(df, "id", limit=9)):
        got.setdefault(i, {})[term] = weight
    assert got == {i: v for i, t in enumerate(texts) if (v := python_vector(t, 9))}


def test_unit_vectors_and_centroids(spark):
    df = spark.createDataFrame([(1, "p", "quantum optics lasers"), (2, "p", "quantum fields"), (3, "q", "")], "doc_id int, person_id string, text string")
    v = T.encoded(df, "doc_id")
    norms = rows(v.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("n")))
    assert [d for d, _ in norms] == [1, 2] and all(abs(n - 1) < 1e-12 for _, n in norms)
    c = T.centroids(v.join(df.select("doc_id", "person_id"), "doc_id"), "doc_id", "person_id")
    weight = {r.term: r.weight for r in c.collect()}
    assert abs(sum(w * w for w in weight.values()) - 1) < 1e-9 and weight["quantum"] > weight["optics"]
    sinks.checked_vectors(v, "doc_id").collect()
    with pytest.raises(Exception, match="invalid sparse vector"):
        sinks.checked_vectors(v.withColumn("weight", F.col("weight") * 2), "doc_id").collect()


def test_match_gates_and_ties(spark):
    queries = spark.createDataFrame([(1, "quantum optics")], "item_id int, text string")
    schema = "person_id string, institution_id string, institution_name string, display_name string, department string, research_areas array<string>, topic_confidence string, contact_confidence string"
    people = spark.createDataFrame([
        ("a", "i1", "Uni One", "Ann", "Physics", ["quantum optics"], "low", "high"), ("b", "i1", "Uni One", "Bob", "Physics", ["quantum optics"], "low", "none"),
        ("c", "i2", "Uni Two", "Cat", "Physics", ["quantum optics"], "high", "none"), ("d", "i1", "Uni One", "Dan", "Quantum Optics", [], "low", "high")], schema)
    works = spark.createDataFrame([], "doc_id int, text string, person_id string, year int")
    got = R.match_applicants(queries, people, works, None).orderBy("rank").select("person_id", "total_score").collect()
    assert [r.person_id for r in got] == ["c", "a", "b"] and got[1].total_score == got[2].total_score  # no evidence, no match; contact doesn't rank
    assert [r.person_id for r in R.match_applicants(queries, people, works, "  uni   ONE ").orderBy("rank").collect()] == ["a", "b"]


def test_publication_texts_dedupe_before_the_cut(spark):
    works = spark.createDataFrame([(1, "A b", "p", 2020), (2, "a  B", "p", 2021), (3, "c", "p", 2019), (4, "", "p", 2022), (5, "d", "p", None)], "doc_id int, text string, person_id string, year int")
    assert rows(R.publication_texts(works, 2)) == [("p", "a B c")]


def test_combined_query_and_best_mean(spark):
    v = lambda *x: spark.createDataFrame([(1, t, w) for t, w in x], "k int, term string, weight double")
    assert [(t, round(w, 9)) for _, t, w in rows(R.combined_query(v(("a", 1.0)), v(("a", 0.5), ("b", 1.0)), "k"))] == [("a", 0.9), ("b", 0.2)]
    scored = spark.createDataFrame([("p", i, s) for i, s in enumerate((0.9, 0.6, 0.1))] + [("q", 7, 0.8), ("q", 8, 0.7)], "person_id string, doc_id int, score double")
    counts = spark.createDataFrame([("p", 3), ("q", 2)], "person_id string, works int")
    assert rows(R.best_mean(scored, ["person_id"], counts, 2)) == [("p", 0.75), ("q", 0.75)]


def state(spark, *x):
    return spark.createDataFrame(list(x), "k string, status string, missing_streak int")


def test_reconcile_categories(spark):
    old = state(spark, ("a", "active", 0), ("b", "missing", 1), ("c", "tombstoned", 2), ("d", "active", 0), ("e", "missing", 1), ("f", "tombstoned", 2))
    seen = spark.createDataFrame([("a",), ("b",), ("c",), ("n",)], "k string")
    full = {r.k: (r.status, r.missing_streak, r.category) for r in L.reconcile(old, seen, "k", True).collect()}
    assert full == {"a": ("active", 0, "unchanged"), "b": ("active", 0, "recovered"), "c": ("active", 0, "reactivated"), "n": ("active", 0, "added"),
                    "d": ("missing", 1, "missing"), "e": ("tombstoned", 2, "tombstoned"), "f": ("tombstoned", 2, "unchanged")}
    delta = {r.k: (r.status, r.missing_streak, r.category) for r in L.reconcile(old, seen, "k", False).collect()}
    assert delta["d"] == ("active", 0, "absence_ignored") and delta["e"] == ("missing", 1, "absence_ignored")


def test_claims_over_three_runs(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "k string")
    s = L.reconcile(state(spark), ids("a", "b"), "k", True)
    for _ in range(2):
        s = L.reconcile(s.drop("category"), ids("b", "c"), "k", True)
    got = {r.k: r.status for r in s.collect()}
    assert got == {"a": "tombstoned", "b": "active", "c": "active"}
    claims = spark.createDataFrame([("f", "tombstoned"), ("f", "active"), ("g", "tombstoned")], "fingerprint_id string, status string")
    assert rows(L.visible_claims(claims)) == [("f", True), ("g", False)]


def test_diff_upsert_and_carry_forward(spark):
    a = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (3, "z", None)], "k int, s string, n int")
    b = spark.createDataFrame([(2, "y", 5), (3, "z", None), (4, "w", 4)], "k int, s string, n int")
    assert rows(L.snapshot_diff(a, b, "k", ["s", "n"])) == [(1, "removed", ""), (2, "changed", "n"), (4, "added", "")]
    assert rows(L.upsert(a, b, "k", ["s"], ["n"])) == [(1, "x", 1), (2, "y", 2), (3, "z", None), (4, "w", 4)]
    old = spark.createDataFrame([(1, "o", ["a"], ["m"]), (2, "o", ["a"], ["m"])], "k int, t string, u array<string>, f array<string>")
    new = spark.createDataFrame([(1, None, ["b"], []), (3, "n", [], ["q"])], "k int, t string, u array<string>, f array<string>")
    assert rows(L.carry_forward(old, new, "k", ["t"], ["u"], ["f"])) == [(1, "o", ["b", "a"], ["m"]), (2, "o", ["a"], ["m"]), (3, "n", [], ["q"])]


def test_queue(spark):
    assert one(spark, lambda *a: L.finish_job(*a), "processing", True, 1, "t", "t") == "done"
    assert one(spark, lambda *a: L.finish_job(*a), "processing", False, 1, "t", "t") == "pending"
    assert one(spark, lambda *a: L.finish_job(*a), "processing", False, 3, "t", "t") == "failed"
    assert one(spark, lambda *a: L.finish_job(*a), "processing", True, 1, "t", "other") == "processing"
    assert one(spark, L.inventory_errors, 5, 4, 0) == ["count_mismatch"] and one(spark, L.inventory_errors, 1, 1, 10) == ["shrunken_inventory"]
    assert one(spark, L.inventory_errors, 0, 0, 3) == ["empty_inventory"] and one(spark, L.inventory_errors, 9, 9, 10) == []


def test_identity_rules(spark):
    kinds = F.array(F.lit("email"), F.lit("profile_slug"))
    got = spark.range(1).select(I.decide(kinds, F.lit(True), F.lit(False)).alias("a"), I.decide(kinds, F.lit(False), F.lit(False)).alias("b"),
                                I.decide(F.array(F.lit("orcid")), F.lit(False), F.lit(True)).alias("c"), I.decide(kinds, F.lit(True), F.lit(True)).alias("d")).first()
    assert got.a.priority == 6 and got.b is None and got.c.reason == "same_orcid" and got.d is None
    arr = lambda *x: F.array(*[F.lit(v) for v in x]).cast("array<string>")
    clash = I.separating_conflict((arr("a"), arr("b")), (arr("x"), arr("y")), (arr(), arr("z")))
    single = I.separating_conflict((arr("a"), arr("b")), (arr("x"), arr("x")), (arr(), arr("z")))
    assert spark.range(1).select(clash, single).first() == (True, False)


def test_groups_against_union_find(spark):
    dice = random.Random(3)
    pairs = [(dice.randrange(200), dice.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = dict(rows(I.groups(spark.createDataFrame(pairs, "left long, right long"))))
    assert got == {x: find(x) for x in root}


def test_aliases(spark):
    links = spark.createDataFrame([("a", "b", 1), ("b", "c", 1), ("x", "y", 1), ("y", "x", 1), ("s", "s", 1), ("d", "gone", 1), ("m", "c", 2)], "alias string, canonical string, institution_id int")
    assert dict(rows(I.resolve_aliases(links, 6))) == {"a": "c", "b": "c", "x": None, "y": None, "s": None, "d": "gone", "m": "c"}
    people = spark.createDataFrame([("c", 1), ("m", 2)], "person_id string, institution_id int")
    got = {(a, v) for a, _, v in rows(I.alias_violations(links, people))}
    assert {("x", "cycle"), ("y", "cycle"), ("s", "self"), ("d", "dangling"), ("m", "still_canonical"), ("m", "cross_institution")} == got
    child = spark.createDataFrame([("a", 1), ("z", 2)], "person_id string, n int")
    assert rows(I.reparent(child, "person_id", I.resolve_aliases(links, 6))) == [("c", 1), ("z", 2)]


def test_merge_maps_and_values(spark):
    m = lambda **k: F.create_map(*[x for a, b in k.items() for x in (F.lit(a), F.array(*[F.lit(v) for v in b]))])
    assert spark.range(1).select(I.merge_external_ids(m(a=["1", ""], b=["2"]), m(a=["1", "3"], c=["4"]))).first()[0] == {"a": ["1", "3"], "b": ["2"], "c": ["4"]}
    pick = I.better_of(F.lit("Staff"), F.lit("Professor of Law"), F.lit(50), F.lit(20), P.title_quality)
    assert spark.range(1).select(pick).first()[0] == "Professor of Law"


def test_people_from_html(spark):
    jsonld = '<script type="application/ld+json">{"@graph":[{"@type":"Person","name":"Jane Doe","email":"mailto:Jane@u.edu","knowsAbout":["Law"]}]}</script>'
    table = '<table><tr><td>John Roe</td><td>Associate Professor</td><td><a href="mailto:john@u.edu">mail</a></td></tr></table>'
    profile = "<html><body><h1>Ann Lee</h1><h2>Research Interests</h2><p>Optics; Lasers</p></body></html>"
    pages = spark.createDataFrame([("a", jsonld), ("b", table), ("c", profile), ("d", None), ("e", "<tr><td>"), ("f", jsonld)], "url string, html string")
    got = {(r.url, r.name): r for r in H.extract_people(pages).collect()}
    assert got["a", "Jane Doe"].emails == ["jane@u.edu"] and got["a", "Jane Doe"].research_areas == ["Law"]
    assert got["b", "John Roe"].title == "Associate Professor" and got["c", "Ann Lee"].research_areas == ["Optics", "Lasers"] and len(got) == 4
    assert H.dedupe_people(H.extract_people(pages)).count() == 3


#: Literals that settle the decisions: labels that aren't works, and works that look like labels.
REFUSED = [
    ("Research output: Contribution to journal › Articles › peer-review", None), ("Conference Presentations", None), ("Journal Publications and Reviews", None),
    ("Prize: Awards/ Prizes/ Honours", None), ("Activity: Talk or Presentation › Invited Talks", None), ("Press/Media: Media Coverage", None), ("1 item of Media coverage", None),
    ("ZHANG, L.", "https://example.edu/en/persons/lei-zhang/"), ("https://scholar.google.com/citations?user=example", None), ("www.yangliuresearch.com", None),
    ("1 Authored play, poem, novel, story (Book chapter or short passage)", "https://example.edu/person/publications/?type=chapter"),
    ("Notable publications", None), ("Selected publication", None), ("Publication", None), ("3 Edited book (editor)", None), ("4 Textbook (author)", None), ("5 Comment/debate", None),
    ("12/03/2019 → 14/03/2019", None), ("# denotes equal contribution", None), ("2 Theses / Dissertations", None), ("7 Conference Papers (refereed)", None),
    ("9 things on a facet", "https://e.edu/x/publications/?page=2&type=article"),
]
WORKS = [("3D Printing of Patient-Specific Implants", None), ("12 Angry Men and the Law of Jury Deliberation", None), ("3 Articles that Changed Competition Law", None), ("2 Books (a history)", None)]


def test_literal_labels_and_works(spark):
    P.register(spark)
    df = spark.createDataFrame([(t, u, False) for t, u in REFUSED] + [(t, u, True) for t, u in WORKS], "t string, u string, want boolean").withColumn("n", F.lit(None).cast("string"))
    own = P.is_meaningful_publication(F.col("t"), F.col("n"), F.lit(None).cast("int"), F.col("n"), F.col("u"))
    for r in df.select("t", "want", own.alias("a"), F.expr("publication_is_meaningful(t, n, null, n, u)").alias("b")).collect():
        assert (r.a, r.b) == (r.want, r.want), r.t


@pytest.mark.parametrize("position,count,corresponding,want", [
    ("first", 1, False, 1.5), ("first", 3, False, 1.25), ("last", 3, True, 3.0 / 2 * 1.5), ("middle", 7, False, 0.75), ("middle", 20, False, 0.5), ("middle", 20, True, 1.5), (None, 20, False, 1.0), ("editor", 7, False, 1.0),
])
def test_authorship_weight_literals(spark, position, count, corresponding, want):
    c = {k: F.lit(v) for k, v in {"first": 1.25, "last": 1.5, "corresponding": 1.5, "solo": 1.5, "medium": 0.75, "large": 0.5}.items()}
    role = E.author_role(F.lit(position).cast("string"), F.lit(count))
    got = spark.range(1).select(E.publication_weight(role, F.lit(corresponding), E.author_count_band(F.lit(count)), c)).first()[0]
    assert got == want


def test_weight_grid_and_age_bands_literals(spark):
    configs = E.weight_configs(spark)
    assert configs.count() == 1152 and configs.where("config = 0").select("first", "last", "corresponding", "solo", "medium", "large").first() == (1.0,) * 6
    assert configs.where("config > 0 and first = 1 and last = 1 and corresponding = 1 and solo = 1 and medium = 1 and large = 1").count() == 0
    ages = spark.createDataFrame([(2030, "0-3"), (2024, "0-3"), (2022, "0-3"), (2021, "4-8"), (2017, "4-8"), (2016, "9+")], "y int, want string")
    assert all(r.want == r.got for r in ages.select("want", E.age_band(F.col("y"), F.lit(2024)).alias("got")).collect())
    assert [one(spark, lambda c: E.work_type(c, F.lit(p)), r) for r, p in (("preprint", "journal"), ("article", "repository"), ("article", "conference"), ("article", None), ("book", None), (None, None), ("book", "journal"))] == [
        "preprint", "preprint", "conference", "journal", "other", "unknown", "journal"]


def test_block_pages(spark):
    pages = ["<html>_Incapsula_Resource Request unsuccessful</html>", "<script src='/_Incapsula_Resource'></script><body onload=x>  </body>", "The requested page is currently unavailable; the site is processing for you",
             "<body>Prove you are no robot: captcha, access denied</body>", "<body>_Incapsula_Resource and text</body>", None]
    want = ["blocked_interstitial:incapsula"] * 2 + ["blocked_interstitial:site_processing", None, None, None]
    assert [one(spark, H.interstitial_reason, x) for x in pages] == want


def test_one_se_prefers_the_faster_of_equal_storage(spark):
    configs = spark.createDataFrame([("a", 0.90, 0.9, 100, 0.02, 2.0), ("b", 0.895, 0.9, 100, 0.02, 1.0), ("c", 0.89, 0.9, 100, 0.02, 1.0)], "config string, ndcg double, recall double, bytes long, se double, query_ms double")
    assert rows(E.select_one_se(configs)) == [("b", 100)]


def test_clusters_hold_every_vector(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(300, 4))
    data = [(i % 2, i, (v / np.linalg.norm(v)).tolist()) for i, v in enumerate(vectors)]
    got = E.cluster_people(spark.createDataFrame(data, "g int, k int, v array<double>"), "g", "k", "v", 40).collect()
    assert len(got) == 300 and all(0 <= r.cluster < 12 for r in got)


def test_star_edges_join_what_pairs_join(spark):
    keys = spark.createDataFrame([(1, p, "email", v) for p, v in ((1, "a"), (2, "a"), (3, "a"), (3, "b"), (4, "b"), (5, "c"))], "institution_id int, person_id int, kind string, value string")
    assert rows(I.groups(I.shared_key_edges(keys)), "node") == rows(I.groups(I.candidate_pairs(keys)), "node")
    assert I.shared_key_edges(keys).count() == 3


def test_evaluation_math(spark):
    assert E.folds([("a", 5), ("b", 4), ("c", 3), ("d", 1)], 2) == {"a": 0, "b": 1, "c": 1, "d": 0}
    mean, low, high = E.paired_bootstrap([0.1, 0.2, 0.3], 200)
    assert abs(mean - 0.2) < 1e-12 and low <= mean <= high and E.paired_bootstrap([0.1, 0.2, 0.3], 200) == (mean, low, high)
    configs = spark.createDataFrame([("a", 0.90, 0.9, 100, 0.02), ("b", 0.89, 0.89, 50, 0.02), ("c", 0.5, 0.5, 1, 0.02), ("d", 0.895, 0.7, 5, 0.02)], "config string, ndcg double, recall double, bytes long, se double")
    assert rows(E.select_one_se(configs)) == [("b", 50)]
    assert E.weight_configs(spark).count() == math.prod(len(v) for v in E.WEIGHT_GRID.values())
    w = spark.createDataFrame([("p", i, 2000 + i) for i in range(12)] + [("q", 50 + i, 2000) for i in range(4)], "person_id string, doc_id int, year int")
    h = E.holdout(w, 2, 2, 8)
    assert [(r, n) for r, n in rows(h.groupBy("role").count())] == [("cv", 2), ("profile", 8), ("proposal", 2)]
    assert h.where("role = 'proposal'").agg(F.min("doc_id")).first()[0] == 10


def test_sources(spark, tmp_path):
    (tmp_path / "r.csv").write_text("name,country,region,homepage_url,ror_id,qs_rank,qs_year,config_path,source\nB Uni,GB,,,,12,2024,b.yaml,s\nA Uni,,,,,,,,s\n")
    reg = readers.registry(spark, str(tmp_path / "r.csv"))
    assert [(r.name, r.qs_rank, r.region) for r in reg.orderBy("name").collect()] == [("A Uni", None, None), ("B Uni", 12, None)]
    assert [r.name for r in readers.batch_plan(reg, 5).collect()] == ["B Uni"]
    assert readers.config_errors({"institution": {}, "seeds": ["https://x.com/"], "official_domains": ["u.edu"], "quality_gate": {"a_ratio": 2}}) == [
        "missing institution", "quality_gate.a_ratio must be within 0 and 1", "seed outside the official domains: https://x.com/"]
    assert readers.policy_errors({"version": 1, "shortlist": 10, "recall": 60, "paper_top": 3}) == ["recall must not exceed 50"]
    (tmp_path / "s.xml").write_text("<urlset><url><loc> https://u/a </loc></url><url><loc>https://u/b</loc></url><url><loc>https://u/a</loc></url></urlset>")
    assert [r.url for r in readers.sitemap(spark, str(tmp_path / "s.xml"), "u/").collect()] == ["https://u/a", "https://u/b"]
    work = {"id": "W1", "display_name": "T", "doi": "https://doi.org/10.1000/A", "publication_year": 2020, "updated_date": "2024-01-02T03:04:05", "abstract_inverted_index": {"x": [1], "y": [0]},
            "topics": [{"display_name": "Law"}], "concepts": [{"display_name": "Low", "score": 0.1}], "authorships": [{"author": {"id": "A1", "display_name": "Ann"}, "institutions": [{"display_name": "U"}], "raw_affiliation_strings": ["U", "V"]}]}
    (tmp_path / "w.json").write_text(json.dumps(work) + "\n" + json.dumps({"id": "W2"}) + "\n")
    got = {r.id: r for r in readers.works_json(spark, str(tmp_path / "w.json")).collect()}
    assert (got["W1"].abstract, got["W1"].doi, got["W1"].topics, got["W1"].authors, got["W1"].institutions) == ("y x", "10.1000/a", ["Law"], ["Ann"], ["U", "V"])
    assert got["W2"].title == "" and got["W2"].institutions == []


def test_archive_and_cache(spark):
    bodies = spark.createDataFrame([("a",), ("b",), ("a",)], "body string")
    kept = readers.archive(bodies)
    keys = kept.select("sha256")
    assert kept.count() == 2 and readers.read_archive(kept, keys).count() == 2
    with pytest.raises(Exception, match="archive: body and key differ"):
        readers.read_archive(kept.withColumn("body", F.lit(b"z")), keys).collect()
    cache = spark.createDataFrame([("x", 1, "2024-01-01", "2024-02-01"), ("y", None, "2024-01-01", "2024-02-01"), ("z", 3, "2023-01-01", "2023-02-01")], "k string, v int, fetched_at string, expires_at string")
    hits, misses = readers.cached(spark.createDataFrame([("x",), ("y",), ("z",), ("n",)], "k string"), cache, "k", F.lit("2024-01-15"))
    assert {r.k for r in hits.collect()} == {"x", "y"} and {r.k for r in misses.collect()} == {"z", "n"}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, "b", ["x"]), (1, 'a "q", é', [])], "k int, s string, l array<string>")
    sinks.csv(df, str(tmp_path / "c"), [F.col("k")])
    assert [r.s for r in spark.read.option("escape", '"').csv(str(tmp_path / "c"), header=True).orderBy("k").collect()] == ['a "q", é', "b"]
    sinks.jsonl(df, str(tmp_path / "j"))
    assert sorted(json.loads(x)["k"] for p in (tmp_path / "j").glob("part*") for x in p.read_text().splitlines()) == [1, 2]
    root = str(tmp_path / "snap")
    first = sinks.snapshot(spark, {"t": df}, root, "r1", {"enough": True})
    sinks.snapshot(spark, {"t": df.where("k = 1")}, root, "r2", {"enough": False})
    assert first.first().rows == 2 and sinks.pointer(spark, root, "latest") == "r2" and sinks.pointer(spark, root, "current") == "r1"
    assert sinks.manifest({"t": df}).first().sha256 == sinks.manifest({"t": df.repartition(3)}).first().sha256
    with pytest.raises(Exception):
        sinks.snapshot(spark, {"t": df}, root, "r1", {})
    v = spark.createDataFrame([(1, "b", 0.5), (1, 'a"', 1.0)], "id int, term string, weight double")
    r = sinks.vector_json(v, "id").first()
    assert json.loads(r.vector_json) == {'a"': 1.0, "b": 0.5} and r.vector_hash == hashlib.sha256(r.vector_json.encode()).hexdigest()


def test_schemas(spark):
    df = spark.createDataFrame([("1", "x", "5")], "institution_id string, unknown string, qs_rank string")
    out = schemas.conform(df, "institution")
    assert out.schema.fieldNames() == schemas.schema("institution").fieldNames() and out.first().qs_rank == 5
    assert all(schemas.schema(e).fields for e in schemas.entities())
