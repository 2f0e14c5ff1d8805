"""Tokens, weighted terms and sparse term vectors, as Column expressions and long-format frames.

A vector is long: one row (id, term, weight). Weights are two-decimal constants and are summed as
decimals, so that a sum doesn't depend on the order of its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words that carry no meaning, and words too common in research texts to tell much.
STOPWORDS = (
    "about above across after again against also among and are around based because been between both can did does done "
    "during each for from have having into its may more most over per such than that the their then there these this those "
    "through toward under using via was were with within without"
).split()
LOW_SIGNAL = (
    "algorithm algorithms analysis application applications approach approaches artificial computational computer computing "
    "data deep development framework intelligence learning machine method methods model modeling models network networks "
    "optimization paper project proposal research science scientific study system systems"
).split()
INDEX_STOPWORDS = "and the for with from this that into interested target degree phd".split()
TOKEN = "[a-z][a-z0-9+-]{2,}"

TEXT_FEATURES, CANDIDATES, VECTOR_FEATURES = 160, 1024, 256


def tokens(text: Column, stopwords: list[str] = STOPWORDS) -> Column:
    """Lower-case tokens of three characters at least, without stop words, in order."""
    every = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({TOKEN})"), F.lit(1))
    return F.filter(every, lambda t: ~t.isin(*stopwords))


def unigram_weight(term: Column) -> Column:
    """0.25 for low-signal words, else more for longer ones."""
    long = F.when(F.length(term) >= 12, "1.25").when(F.length(term) >= 8, "1.10").otherwise("1.00")
    return F.when(term.isin(*LOW_SIGNAL), "0.25").otherwise(long).cast("decimal(5,2)")


def _ngrams(words: Column, n: int) -> Column:
    """(term, weight) of each n consecutive words, those of low-signal words alone left out."""
    def gram(i):
        parts = F.slice(words, i, F.lit(n))
        known = F.size(F.filter(parts, lambda p: ~p.isin(*LOW_SIGNAL)))
        weight = F.when(known > 0, (F.lit(1 + 0.35 * (n - 1)) + known * F.lit(0.15)).cast("decimal(5,2)")).otherwise(F.lit(0).cast("decimal(5,2)"))
        return F.struct(F.array_join(parts, "_").alias("term"), weight.alias("weight"))

    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1))), gram)
    return F.when(F.size(words) >= n, F.filter(grams, lambda g: g["weight"] > 0)).otherwise(
        F.array().cast("array<struct<term:string,weight:decimal(5,2)>>")
    )


def weighted_terms(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, term, weight) summed over unigrams, bigrams and trigrams.

    Rows are dealt by key once, before they are exploded; both the sums here and cuts per key after
    them keep that partitioning, so terms are never shuffled.
    """
    words = df.select(key, tokens(F.col(text)).alias("w")).repartition(key)
    singles = F.transform("w", lambda t: F.struct(t.alias("term"), unigram_weight(t).alias("weight")))
    every = words.select(key, F.explode(F.concat(singles, _ngrams(F.col("w"), 2), _ngrams(F.col("w"), 3))).alias("g"))
    return every.groupBy(key, F.col("g.term").alias("term")).agg(F.sum("g.weight").alias("weight"))


def strongest(vectors: DataFrame, key: str | list[str], limit: int) -> DataFrame:
    """The `limit` strongest terms of each vector; equal strength: the first term by code point."""
    keys = [key] if isinstance(key, str) else key
    order = Window.partitionBy(*keys).orderBy(F.abs("weight").desc(), F.col("term").asc())
    return vectors.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= limit).drop("_n")


def semantic_vectors(df: DataFrame, key: str, text: str = "text", limit: int = TEXT_FEATURES) -> DataFrame:
    """(key, term, weight) of each text's strongest terms; texts without tokens have no rows."""
    return strongest(weighted_terms(df, key, text), key, limit).withColumn("weight", F.col("weight").cast("double"))


def unit(vectors: DataFrame, key: str | list[str]) -> DataFrame:
    """Vectors divided by their L2 norm."""
    keys = [key] if isinstance(key, str) else key
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(*keys)))
    return vectors.withColumn("weight", F.col("weight") / norm)


def encoded(df: DataFrame, key: str, text: str = "text", limit: int = VECTOR_FEATURES) -> DataFrame:
    """Unit vectors of at most `limit` terms out of at most CANDIDATES."""
    return unit(strongest(semantic_vectors(df, key, text, CANDIDATES), key, limit), key)


def cosine(left: DataFrame, lkey: str, right: DataFrame, rkey: str) -> DataFrame:
    """(lkey, rkey, score) of all pairs that share a term; score is rounded to four places, at most 1."""
    def normed(v, k):
        return v.withColumn("norm", F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(k))))

    a = normed(left, lkey).select(lkey, "term", F.col("weight").alias("lw"), F.col("norm").alias("ln"))
    b = normed(right, rkey).select(rkey, "term", F.col("weight").alias("rw"), F.col("norm").alias("rn"))
    dots = a.join(b, "term").groupBy(lkey, rkey).agg(F.sum(F.col("lw") * F.col("rw")).alias("dot"), F.max("ln").alias("ln"), F.max("rn").alias("rn"))
    return dots.select(lkey, rkey, F.round(F.least(F.lit(1.0), F.col("dot") / (F.col("ln") * F.col("rn"))), 4).alias("score"))


def shared_terms(left: DataFrame, lkey: str, right: DataFrame, rkey: str, limit: int = 8) -> DataFrame:
    """(lkey, rkey, terms): the strongest common terms by summed weight, as phrases joined by '; '."""
    a = left.select(lkey, "term", F.col("weight").alias("lw"))
    both = a.join(right.select(rkey, "term", F.col("weight").alias("rw")), "term").withColumn("weight", F.col("lw") + F.col("rw"))
    best = strongest(both.select(lkey, rkey, "term", "weight"), [lkey, rkey], limit)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("weight")).alias("w"), F.col("term").alias("t"))))
    return best.groupBy(lkey, rkey).agg(F.array_join(F.transform(ordered, lambda x: F.replace(x["t"], F.lit("_"), F.lit(" "))), "; ").alias("terms"))


def experiment_counts(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, term, weight): unigrams 1 (low-signal 0.25) and bigrams 1.35, for TF-IDF."""
    words = df.select(key, tokens(F.col(text)).alias("w")).repartition(key)
    one = lambda t: F.when(t.isin(*LOW_SIGNAL), "0.25").otherwise("1.00").cast("decimal(5,2)")
    singles = F.transform("w", lambda t: F.struct(t.alias("term"), one(t).alias("weight")))
    pairs = F.transform(
        F.filter(_ngrams(F.col("w"), 2), lambda g: g["weight"] > 0),
        lambda g: F.struct(g["term"].alias("term"), F.lit("1.35").cast("decimal(5,2)").alias("weight")),
    )
    every = words.select(key, F.explode(F.concat(singles, pairs)).alias("g"))
    return every.groupBy(key, F.col("g.term").alias("term")).agg(F.sum("g.weight").cast("double").alias("weight"))


def inverse_frequencies(counts: DataFrame, key: str, total: Column) -> DataFrame:
    """(term, idf): ln((1 + N) / (1 + df)) + 1. `counts` has one row for each key and term."""
    df = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return df.select("term", (F.log((1 + total) / (1 + F.col("df"))) + 1).alias("idf"))


def tfidf_vectors(counts: DataFrame, idf: DataFrame, key: str) -> DataFrame:
    """Unit vectors of (1 + ln count) * idf; unknown terms have idf 1, zero weights are dropped."""
    joined = counts.join(idf, "term", "left")
    weighted = joined.select(key, "term", ((1 + F.log("weight")) * F.coalesce("idf", F.lit(1.0))).alias("weight"))
    return unit(weighted.where("weight <> 0"), key)


def centroids(vectors: DataFrame, key: str, group: str, limit: int = VECTOR_FEATURES) -> DataFrame:
    """(group, term, weight): the unit mean of each group's vectors, its strongest `limit` terms.

    `vectors` has both columns, one vector per key; the mean's scale cancels in the unit norm.
    """
    sums = vectors.groupBy(group, "term").agg(F.round(F.sum("weight"), 12).alias("weight"))
    return unit(strongest(sums, group, limit), group)


def index_scores(queries: DataFrame, qkey: str, docs: DataFrame, dkey: str, text: str = "text") -> DataFrame:
    """(qkey, dkey, score, overlap): TF-IDF scores of all documents that share a query term.

    Sum over query terms of (1 + ln tf) * (ln((N + 1) / (1 + df)) + 1) * query count, over the L2
    norm of the document's raw counts; overlap is the sorted common terms joined by ', '.
    """
    def counted(df, k, name):
        words = df.select(k, tokens(F.col(text), INDEX_STOPWORDS).alias("w")).repartition(k)
        return words.select(k, F.explode("w").alias("term")).groupBy(k, "term").agg(F.count(F.lit(1)).alias(name))

    total = docs.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("n_docs"))
    terms = counted(docs, dkey, "tf").withColumn("norm", F.sqrt(F.sum(F.col("tf") * F.col("tf")).over(Window.partitionBy(dkey))))
    asked = counted(queries, qkey, "qf")
    df = terms.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    joined = asked.join(df, "term").crossJoin(F.broadcast(total)).join(terms, "term")
    part = (1 + F.log("tf")) * (F.log((F.col("n_docs") + 1) / (1 + F.col("df"))) + 1) * F.col("qf")
    grouped = joined.groupBy(qkey, dkey).agg((F.sum(part) / F.max("norm")).alias("score"), F.array_sort(F.collect_set("term")).alias("o"))
    return grouped.select(qkey, dkey, F.round("score", 6).alias("score"), F.array_join("o", ", ").alias("overlap"))
