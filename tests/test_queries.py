"""Every query that has SQL against DuckDB over the smallest tables."""

import math

import pytest

from heliograph.plans import catalog

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool) or isinstance(value, str):
        return value
    return round(float(value), 9) + 0.0


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, duck, name):
    found = duck.execute(catalog.oracle_sql()[name])
    names = [x[0] for x in found.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    want = sorted((tuple(plain(r[i]) for i in order) for r in found.fetchall()), key=repr)
    got = catalog.queries()[name](spark, DIR)
    assert sorted(got.columns) == sorted(names)
    assert sorted((tuple(map(plain, r)) for r in got.select(*sorted(got.columns)).collect()), key=repr) == want


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert catalog.queries()[name](spark, DIR).columns


def test_functions_without_sql_agree(spark):
    a = catalog.queries()["meaningful_titles"](spark, DIR)
    b = catalog.queries()["meaningful_titles_sql"](spark, DIR)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_entry_imports_without_the_training_operators(tmp_path):
    """The library stands without its training-data subpackage."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "heliograph", tmp_path / "heliograph", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), sorted(e.oracle_sql())[0])"], cwd=tmp_path, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr


def against_sql(spark, tmp_path, name, **tables):
    """Rows of the query and of its SQL on tables of one's own."""
    import duckdb
    import pyarrow.parquet as pq

    con = duckdb.connect()
    for t, rows in tables.items():
        pq.write_table(rows, tmp_path / f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    found = con.execute(catalog.oracle_sql()[name])
    names = [x[0] for x in found.description]
    want = sorted((tuple(map(plain, r)) for r in found.fetchall()), key=repr)
    return sorted((tuple(map(plain, r)) for r in catalog.queries()[name](spark, str(tmp_path)).select(*names).collect()), key=repr), want


def test_titles_overlap_as_in_sql(spark, tmp_path):
    import pyarrow as pa

    pairs = [("Stra\u00dfe", "STRASSE"), ("\ufb01n", "fin"), ("x\u00b2", "x2"), ("\u0130stanbul", "istanbul"), ("\u039f\u03a3", "\u03bf\u03c3"), ("\u0915\u093f", "\u0915"), ("\u00c4 b", "a, B\nrest"), ("\uff11", "1"), ("...", "!"), (None, None)]
    texts = [t for pair in pairs for t in pair]
    got, want = against_sql(spark, tmp_path, "publication_overlap", documents=pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())}))
    assert got == want and len(want) == 4


def test_dense_topk_with_ties_as_in_sql(spark, tmp_path):
    """Equal and nearly equal scores over several blocks, and vectors that a matrix can't hold."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    kinds = rng.normal(size=(7, 8)).astype(np.float32)
    vectors = [(kinds[i % 7] + (i % 3 == 0) * np.float32(1e-8) * rng.normal(size=8)).astype(np.float32).tolist() for i in range(400)]
    vectors[33] = None
    table = pa.table({"vec_id": pa.array(range(400), pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float32())), "label": pa.array([0] * 400, pa.int32())})
    got, want = against_sql(spark, tmp_path, "dense_topk", embeddings=table)
    assert got == want and len(want) == 60


def test_nearest_scores_few_pairs(monkeypatch):
    """What is kept doesn't grow with the rows or with copies, and has each query's best."""
    import numpy as np
    from heliograph.operators.retrieval import Nearest

    rng = np.random.default_rng(5)
    rows = np.repeat(rng.normal(size=(40, 6)), 25, axis=0)
    ids = rng.permutation(1000)
    best = Nearest(ids[:5], rows[:5], 3)
    for a in range(0, 1000, 64):
        best.add(ids[a : a + 64], rows[a : a + 64])
    assert len(best.at) == 15
    for q in range(5):
        full = sorted((-float((rows[q] * rows[j]).cumsum()[-1]), int(ids[j])) for j in range(1000) if ids[j] != ids[q])[:3]
        assert sorted(best.item[best.at == q].tolist()) == sorted(i for _, i in full)


def test_name_findings_computes_each_form_once(spark):
    """As the predicates say one by one, and without their repeated expressions in the plan."""
    from pyspark.sql import functions as F

    from heliograph.functions import predicates as P

    names = [None, "", " Jane  Doe ", "Plato", "J. D.", "Home Page", "- News -", "Ann Lee won the best paper award", "Associate Professor", "School of of Art", "Prof. <b>Doe", "People (all)", "the and of in a to for it", "Department of Physics", "Another paper accepted"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(names)], "k int, name string")
    n = F.col("name")
    want = df.select("k", P.is_non_person_name(n), P.is_title_contaminated(n), F.size(P.incomplete_name_reasons(n)) > 0, P.name_quality(n)).collect()
    found = P.name_findings(df, "name")
    assert sorted(map(tuple, want)) == sorted(map(tuple, found.select("k", "non_person", "contaminated", "incomplete", "quality").collect()))
    plan = catalog.queries()["name_findings"](spark, DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"[^a-z\s]+") == 1


def test_name_pairs_as_in_sql(spark, tmp_path):
    """Names within names that share no word, empty ones, ranks, rare letters, keys and rows that repeat, and nulls."""
    import pyarrow as pa

    names = ["red bolt", "redbolt", "bolt", "d bo", "bol", "Red  BOLT!", "Dr. Red", "red", "red new bolt", "professor", "", "--", "İris", "iris", "Kelvin", "kelvin", "straße", "a", "screwdriver set", "xx long screwdriver setting", "re re bolt bolt", None, "customer 000123", "supercustomer 000123456"]
    rows = [(20 * i + k, x, b) for i, x in enumerate(names) for k in (0, 7) for b in ("A", "B" if i % 2 else None)] + [(-20, "bolt", "A"), (None, "bolt", "A"), (40, "bolt", "A"), (40, "bolt", "A")]
    part = pa.table({"p_partkey": pa.array([r[0] for r in rows], pa.int64()), "p_name": pa.array([r[1] for r in rows], pa.string()), "p_brand": pa.array([r[2] for r in rows], pa.string())})
    got, want = against_sql(spark, tmp_path, "name_pairs", part=part)
    assert got == want and len(want) > 400


def test_name_pairs_scores_each_pair_of_names_once(spark, tmp_path):
    """Copies are dealt after scoring, and a name of many parts isn't one task's."""
    import pyarrow as pa

    from heliograph.operators import identity as I

    keys = [20 * i + (i % 200 > 0) for i in range(2400)]
    part = pa.table({"p_partkey": pa.array(keys, pa.int64()), "p_name": ["red bolt", "new bolt"] * 1200, "p_brand": ["A"] * 2400})
    got, want = against_sql(spark, tmp_path, "name_pairs", part=part)
    assert got == want and len(want) == 12 * 2399
    names = spark.read.parquet(f"{tmp_path}/part.parquet").selectExpr("p_partkey", "p_brand", "p_name name")
    assert I.similar_names(names, names, "p_brand").count() == 4
    found = spark.createDataFrame([("A", "red bolt", 1)], "p_brand string, name string, other int")
    dealt = I.expanded(names, found, ["p_brand", "name"], most=100)
    assert dealt.count() == 1200 and max(len(x) for x in dealt.rdd.glom().collect()) < 1200
