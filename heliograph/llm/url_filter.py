"""URL filter: allow/block rules by host and path, then a logistic regression on hashed n-grams.

Native: DataFrame functions and the DataFrame-based pyspark.ml only. The regression is fitted on a
small labelled URL table (at most MAX_LABELLED rows, parameter of `train`), in the JVM. Scoring is
one narrow projection over the pages: no shuffle, only the url column is read.
"""

from __future__ import annotations

import csv
from pathlib import Path

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rules of the contract: (host, path, verdict).
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

MAX_LABELLED = 10_000
MAX_RULES = 500
BUCKETS = 1 << 14

#: The small labelled table: hosts of general kinds, none of them from a table of pages. label 1: unwanted.
LABELLED_HOSTS = Path(__file__).with_name("labelled_hosts.csv")
PREFIXES = ["", "www.", "m.", "blog."]
PATHS = ["/", "/en/12", "/fr/845.html", "/de/3?page=2&ref=x", "/es/77/", "/news/today", "/about"]


def labelled_hosts() -> list[tuple[str, int, str]]:
    """(host, label, kind) of the labelled table."""
    with LABELLED_HOSTS.open(newline="") as f:
        return [(r["host"], int(r["label"]), r["kind"]) for r in csv.DictReader(f)]


def labelled_urls(hosts: list[tuple[str, int, str]] | None = None) -> list[tuple[str, int]]:
    """Every labelled host under rotating prefixes and paths; label 1 is unwanted."""
    rows = []
    for i, (host, label, _) in enumerate(labelled_hosts() if hosts is None else hosts):
        for j, prefix in enumerate(PREFIXES):
            name = host if prefix and host.startswith(prefix) else prefix + host
            rows.append((f"http://{name}{PATHS[(i + j) % len(PATHS)]}", label))
    return rows


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without a ://."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    raw = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*", 0)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end; empty without a ://."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    return F.regexp_extract(F.coalesce(rest, F.lit("")), r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_column(rules: list[tuple[str, str, str]], part: str) -> Column:
    """The rule string (part 'rule') or verdict (part 'verdict') of the longest rule that fits, else null.

    Equal lengths: the longer host, then block before allow.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules fit an expression; join a rule table for more")
    out = F.lit(None).cast("string")
    ordered = sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), r[2] == "block"))
    for host, path, verdict in ordered:  # later ones take precedence
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        out = F.when(fits, F.lit(host + path if part == "rule" else verdict)).otherwise(out)
    return out


def _grams(text: Column, n: int, mark: str) -> Column:
    """All n-grams of '^text$', each with a mark for where it comes from."""
    framed = F.concat(F.lit("^"), text, F.lit("$"))
    count = F.greatest(F.length(framed) - (n - 1), F.lit(0))
    every = F.transform(
        F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
        lambda i: F.concat(F.lit(mark), framed.substr(i, F.lit(n))),
    )
    return F.when(count > 0, every).otherwise(F.array().cast("array<string>"))


def with_grams(df: DataFrame) -> DataFrame:
    """Adds the array of character n-grams of host (3 to 5) and path (3)."""
    parts = [_grams(F.col("host"), n, f"h{n}") for n in (3, 4, 5)] + [_grams(F.col("path"), 3, "p3")]
    return df.withColumn("_grams", F.concat(*parts))


def _split(df: DataFrame) -> DataFrame:
    return df.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})


def train(spark: SparkSession, rows: list[tuple[str, int]] | None = None, max_rows: int = MAX_LABELLED) -> PipelineModel:
    """Fits the regression on labelled (url, 0/1) rows; more than max_rows are refused, not sampled."""
    rows = labelled_urls() if rows is None else rows
    if len(rows) > max_rows:
        raise ValueError(f"{len(rows)} labelled rows; the bound is {max_rows}")
    quote = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    share = {label: len(rows) / (2 * sum(own == label for _, own in rows)) for label in {label for _, label in rows}}  # both labels weigh the same
    values = ", ".join(f"({quote(url)}, {float(label)}D, {share[label]!r}D)" for url, label in rows)
    data = spark.sql(f"SELECT url, label, weight FROM VALUES {values} AS t(url, label, weight)").coalesce(1)
    hashing = HashingTF(inputCol="_grams", outputCol="_features", numFeatures=BUCKETS, binary=True)
    learner = LogisticRegression(
        featuresCol="_features", labelCol="label", weightCol="weight", rawPredictionCol="_raw", probabilityCol="_probability",
        predictionCol="_prediction", maxIter=100, regParam=0.001, standardization=False,
    )
    fitted = learner.fit(hashing.transform(with_grams(_split(data))))
    return PipelineModel([hashing, fitted])


def judge(pages: DataFrame, rules=RULES, model: PipelineModel | None = None, threshold: float = 0.5) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score (probability that it is unwanted).

    Null, empty or scheme-less urls have empty host and path and are judged on those. Repeated rows
    give repeated rows, an empty table an empty result; other columns of `pages` are not read, so
    their names can't clash.
    """
    model = model or train(pages.sparkSession)
    named = _split(pages.select("page_id", "url"))
    named = named.withColumns({"rule": rule_column(rules, "rule"), "_ruled": rule_column(rules, "verdict")})
    scored = model.transform(with_grams(named)).withColumn("score", vector_to_array("_probability")[1])
    learned = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("_ruled", learned).alias("verdict"), "score")
