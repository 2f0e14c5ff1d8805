"""Exact deduplication through an extendible-hash index on shared files. Native DataFrame code.

A text's key is the top `key_bits` bits of the SHA-256 of its bytes without white space.

1. Runs: rows with equal bytes are combined on the map side, and then in up to SALTS parts of the
   table, so that a group of copies, however large, reaches its owner as SALTS rows at most. The
   parts are combined apart from each other: nothing is decided yet.
2. Directory: runs are counted by the top MAX_DEPTH bits of the key, its cells (at most
   2**MAX_DEPTH, whatever the input). Starting at depth 0, a bucket of more than `capacity` runs is
   split by doubling the directory; a leaf is the first depth at which it fits, or MAX_DEPTH. The
   leaves in key order are dealt to owners, each a range of keys of about OWNED runs.
3. Index: the directory sends every run to its owner. Owner tasks sort their runs by bucket, key and
   bytes, chain those that share a key, and compare bytes along the chain: equal bytes are one entry.
   Entries are written to the shared folder with their bucket, key, place in the chain and digest.
4. Probe: the directory gives every document its bucket, in which its key's chain is searched for
   its digest (an equi-join, whose skewed buckets Spark splits).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliograph.llm.common import SPACE, text_of
from heliograph.runtime import saved

MAX_DEPTH = 16
CAPACITY = 1 << 12
KEY_BITS = 60
SALTS = 8
OWNED = 1 << 12  # runs of an owner; its buckets' overhang comes on top


def _normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE + "+", "")


def _digest(text: Column) -> Column:
    """Never null, so that joins add no filter that would hash every text once more."""
    return F.coalesce(F.sha2(text.cast("binary"), 256), F.lit(""))


def _key(digest: Column, key_bits: int) -> Column:
    """The digest's first bits as a non-negative long."""
    return F.shiftright(F.coalesce(F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long"), F.lit(0)), KEY_BITS - key_bits)


def _cell(key: Column, key_bits: int, max_depth: int) -> Column:
    return F.shiftright(key, key_bits - max_depth)


def runs(docs: DataFrame, key_bits: int = KEY_BITS) -> DataFrame:
    """key, text_sha256, body (text without white space), best (the row that stays), rows: one for each distinct text and salt."""
    text = text_of("text")
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("byte")
    rows = docs.select("doc_id", F.char_length(text).alias("n_points"), _normalised(text).alias("body"), salt.alias("salt"))
    best = F.min(F.struct((-F.col("n_points")).alias("neg"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id")))
    combined = rows.groupBy("salt", "body").agg(best.alias("best"), F.count(F.lit(1)).alias("rows"))
    return combined.select(_digest(F.col("body")).alias("text_sha256"), "body", "best", "rows").withColumn("key", _key(F.col("text_sha256"), key_bits))


def directory(keys: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH, key_bits: int = KEY_BITS, owned: int = OWNED) -> DataFrame:
    """The directory of `keys` (key, a row a run): cell (top max_depth bits) to local_depth, bucket and owner.

    A bucket of depth d and prefix p is a leaf if it holds at most `capacity` runs (or can't be
    split further) while every shorter prefix of it holds more. At most 2**max_depth rows.
    """
    cells = keys.groupBy(_cell(F.col("key"), key_bits, max_depth).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    levels = cells.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(max_depth))).alias("depth"))
    prefix = F.expr(f"shiftright(cell, {max_depth} - depth)")
    totals = levels.groupBy("depth", prefix.alias("prefix")).agg(F.sum("n").alias("total"))
    fits = totals.where((F.col("total") <= capacity) | (F.col("depth") == max_depth))
    leaf = levels.withColumn("prefix", prefix).join(F.broadcast(fits), ["depth", "prefix"])  # at most 2**(max_depth + 1) rows
    leaf = leaf.groupBy("cell", "n").agg(F.min("depth").alias("local_depth"))
    leaf = leaf.withColumn("bucket", F.expr(f"shiftleft(shiftright(cell, {max_depth} - local_depth), {max_depth} - local_depth)"))
    before = F.sum("n").over(Window.orderBy("bucket").rangeBetween(Window.unboundedPreceding, Window.currentRow)) - F.sum("n").over(Window.partitionBy("bucket"))
    return leaf.withColumn("owner", F.floor(before / owned).cast("int")).select("cell", "local_depth", "bucket", "owner")


def build_index(docs: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH, key_bits: int = KEY_BITS) -> tuple[DataFrame, DataFrame]:
    """Builds the index in the shared folder and returns (entries, directory).

    Entries: owner, bucket, local_depth, key, chain (place among the different texts of one key, by
    their bytes), text_sha256, keep_id, keep_points, group_size.
    """
    held = saved(runs(docs, key_bits), "dedup-runs")
    slots = saved(directory(held.select("key"), capacity, max_depth, key_bits).coalesce(1), "dedup-directory")
    placed = held.withColumn("cell", _cell(F.col("key"), key_bits, max_depth)).join(F.broadcast(slots), "cell").drop("cell")
    owned = placed.repartition("owner")
    along = Window.partitionBy("owner", "bucket", "key").orderBy("body")
    chained = owned.withColumn("chain", F.dense_rank().over(along) - 1)
    entries = chained.groupBy("owner", "bucket", "key", "chain").agg(
        F.min("local_depth").alias("local_depth"), F.min("text_sha256").alias("text_sha256"), F.min("best").alias("best"), F.sum("rows").alias("group_size")
    )
    return saved(entries.select(
        "owner", "bucket", "local_depth", "key", "chain", "text_sha256", F.col("best.id").alias("keep_id"), (-F.col("best.neg")).alias("keep_points"), "group_size"
    ), "dedup-index"), slots


def _probe(rows: DataFrame, index: DataFrame, slots: DataFrame, max_depth: int, key_bits: int) -> DataFrame:
    """rows (with __sha) joined to their entries: the directory's bucket, the key's chain, and there the digest."""
    keyed = rows.withColumn("__key", _key(F.col("__sha"), key_bits))
    routes = slots.select(F.col("cell").alias("__cell"), F.col("bucket").alias("__bucket"))
    routed = keyed.withColumn("__cell", _cell(F.col("__key"), key_bits, max_depth)).join(F.broadcast(routes), "__cell").drop("__cell")
    entry = index.select(
        F.col("bucket").alias("__bucket"), F.col("key").alias("__key"), F.col("text_sha256").alias("__sha"),
        F.col("keep_id").alias("__keep"), F.col("keep_points").alias("__points"), F.col("group_size").alias("__size"))
    return routed.join(entry, ["__bucket", "__key", "__sha"])


def dedup(docs: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH, key_bits: int = KEY_BITS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty; all empty or blank texts are one group. Of equal texts the most code
    points, then the smallest doc_id stays (a null doc_id only if the group has no other). Rows that
    repeat the doc_id and text of the row that stays are that same document and are kept as well.
    An empty table gives an empty result; further columns are not read.
    """
    text = text_of("text")
    probes = docs.select("doc_id", F.char_length(text).alias("n_points"), _digest(_normalised(text)).alias("__sha"))
    found = _probe(probes, *build_index(docs, capacity, max_depth, key_bits), max_depth, key_bits)
    kept = F.col("doc_id").eqNullSafe(F.col("__keep")) & (F.col("n_points") == F.col("__points"))
    return found.select("doc_id", F.col("__keep").alias("keep_id"), F.col("__size").alias("group_size"), kept.alias("kept"), F.col("__sha").alias("text_sha256"))


def survivors(docs: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH, key_bits: int = KEY_BITS) -> DataFrame:
    """The rows of docs that stay, with their own columns; of rows that repeat one's doc_id and text, the least by their other columns."""
    text = text_of("text")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.select(F.struct(*columns).alias("__row"), F.col("doc_id").alias("__id"), F.char_length(text).alias("__n"), _digest(_normalised(text)).alias("__sha"))
    index, slots = build_index(docs, capacity, max_depth, key_bits)
    rows = _probe(marked, index, slots, max_depth, key_bits).where(F.col("__id").eqNullSafe(F.col("__keep")) & (F.col("__n") == F.col("__points")))
    return rows.groupBy("__id", "__sha").agg(F.min("__row").alias("__row")).select("__row.*")
