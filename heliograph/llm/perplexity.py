"""Quality rules: counts of words, symbols and repeats, and n-gram perplexity bands per language.

The language model is a modified Kneser-Ney model of characters, of order ORDER, one per language in
one table. Spark counts the n-grams of all documents (each task sums its own first), and the model is
computed from the counts by joins. An n-gram is its language's number, its context (21 bits a
character, so every code point is itself, three to a long) and its last character, so nothing is folded.

All documents are counted, so each of their n-grams is in the model. Up to SHARED n-grams are sent to
executors as sorted arrays of 64-bit keys; more are joined to the chunks of documents they occur in, and
a task holds its chunk's n-grams alone. Both give the same values. Keys are searched by bisection.

A document's perplexity is that of its words: the sum over its characters by its number of words, so
that marks between words, which are cheap one by one, count with the words they make dearer or
cheaper. Its language's band goes from LOWER robust deviations below the median to UPPER above it.
Chance moves a mean of n words by 1 / sqrt(n), so deviations are measured times sqrt(n), in each
language and class of length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliograph.llm import textvec
from heliograph.llm.common import text_of
from heliograph.runtime import saved, ship_code

ORDER = 5
CHAR_BITS = 21  # any code point
NEAR = 3  # characters of a context that fit a long; up to as many again are in a second one
SHARED = 1 << 22  # n-grams, 50 MB
CHUNK_BYTES = 8 << 20
START = 3  # the character before a document's first
MIN_WORDS = 20
REPEAT_WORDS = 8
LOWER, UPPER = 3.0, 4.0  # robust deviations
FEW = 30  # documents; a deviation measured on fewer gives way to that of the language, then of all documents
BIN = 0.001  # of log perplexity; bands are no narrower than this, the medians' own precision
STEP = 0.01  # of the logarithm of a deviation
FLUSH = 1 << 21

_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))


class Grams:
    """The n-gram of order ORDER that ends at each character: codes[k] holds the characters k places before it."""

    def __init__(self, langs: np.ndarray, codes: list[np.ndarray]):
        self.langs, self.codes = langs.astype(np.int64), codes

    def context(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """The order - 1 characters before the last: the nearest NEAR, and the further ones."""
        near, far = np.zeros((2, len(self.langs)), np.int64)
        for k in range(1, order):
            (near if k <= NEAR else far)[:] |= self.codes[k] << (CHAR_BITS * ((k - 1) % NEAR))
        return near, far

    def keys(self, order: int = ORDER) -> np.ndarray:
        return hash_longs(self.langs, *self.context(order), self.codes[0])

    def context_keys(self, order: int) -> np.ndarray:
        return hash_longs(self.langs, *self.context(order))

    def at(self, place: np.ndarray) -> Grams:
        return Grams(self.langs[place], [c[place] for c in self.codes])

    def __len__(self) -> int:
        return len(self.langs)

    def __getitem__(self, place):
        return self.keys()[place]


def gram_keys(texts: list[bytes], langs: np.ndarray) -> tuple[Grams, np.ndarray]:
    """The n-grams that end at each character of the texts, and the text of each."""
    mark = chr(START) * (ORDER - 1)
    decoded = [x.decode("utf-8", "replace") for x in texts]
    sizes = np.asarray([len(x) for x in decoded], np.int64)
    codes = np.frombuffer((mark + mark.join(decoded)).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    at = np.arange(int(sizes.sum())) + np.repeat((np.arange(len(texts)) + 1) * (ORDER - 1), sizes)
    doc = np.repeat(np.arange(len(texts)), sizes)
    return Grams(np.asarray(langs)[doc], [codes[at - k] for k in range(ORDER)]), doc


def base_counts(data: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each document of a block."""
    n = len(starts)
    at, to = textvec.word_spans(data)
    doc = textvec.owner(at, starts)
    hashes = textvec.span_hashes(data, at, to)
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    ends = np.flatnonzero(data == 10)
    begins = np.concatenate(([0], ends[:-1] + 1))
    spoken = np.bincount(np.searchsorted(ends, at), minlength=len(ends)) > 0
    line_doc = textvec.owner(begins[spoken], starts)
    lines = textvec.mix(textvec.span_hashes(data, begins[spoken], ends[spoken]) + line_doc.astype(np.uint64))
    order = np.argsort(lines, kind="stable")
    same = np.zeros(len(lines), bool)
    same[order[1:]] = lines[order[1:]] == lines[order[:-1]]
    windows = textvec.window_hashes(hashes, REPEAT_WORDS)
    inside = doc[: len(windows)] == doc[REPEAT_WORDS - 1 :][: len(windows)]
    place = np.flatnonzero(inside)
    own = textvec.mix(windows[place] + doc[place].astype(np.uint64))
    order = np.argsort(own)
    tie = own[order[1:]] == own[order[:-1]]
    twice = np.zeros(len(own), bool)
    twice[order[1:][tie]] = True
    twice[order[:-1][tie]] = True
    cover = np.zeros(len(at) + 1, np.int64)
    np.add.at(cover, place[twice], 1)
    np.add.at(cover, place[twice] + REPEAT_WORDS, -1)
    repeated = np.cumsum(cover[:-1]) > 0
    symbols = np.flatnonzero(_SYMBOL[data])
    return {
        "n_words": np.bincount(doc, minlength=n),
        "word_chars": np.bincount(doc, points[to] - points[at], n).astype(np.int64),
        "n_symbols": np.bincount(textvec.owner(symbols, starts), minlength=n),
        "n_dup_lines": np.bincount(line_doc[same], minlength=n),
        "n_repeat_words": np.bincount(doc[repeated], minlength=n),
    }


def numbered(docs: DataFrame) -> DataFrame:
    """docs with code, a number of the language that no other has: the CRC, 4096 and more where several share it; null and empty are one."""
    name = F.coalesce(F.col("lang"), F.lit(""))
    crc = (F.crc32(F.col("_name").cast("binary")) % 4096).cast("long")
    names = docs.select(name.alias("_name")).distinct().withColumn("_crc", crc)
    place = F.row_number().over(Window.partitionBy("_crc").orderBy("_name")) - 1
    codes = names.select("_name", (F.col("_crc") + 4096 * place.cast("long")).alias("code"))
    return docs.select("doc_id", "lang", "text").join(F.broadcast(codes), name == F.col("_name")).drop("_name")


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[bytes], np.ndarray, np.ndarray]]:
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    for first, end, data, starts in textvec.blocks(texts):
        yield first, end, texts[first:end], data, starts


CONTEXT = ["lang", "ctx", "far"]
GRAM = [*CONTEXT, "last"]
COLUMNS = [*GRAM, "count"]


def _sorted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, begin): the order that sorts the keys, and where equal ones begin in it."""
    order = np.argsort(keys)
    ranked = keys[order]
    return order, np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), ranked[1:] != ranked[:-1])))


def _summed(held: list[tuple]) -> list[np.ndarray]:
    """keys and COLUMNS of the distinct n-grams of several such."""
    joined = [np.concatenate(x) for x in zip(*held)]
    order, begin = _sorted(joined[0])
    first = order[begin]
    return [*[x[first] for x in joined[:-1]], np.add.reduceat(joined[-1][order], begin) if len(begin) else joined[-1]]


def _distinct(grams: Grams) -> list[np.ndarray]:
    keys = grams.keys()
    order, begin = _sorted(keys)
    own = grams.at(order[begin])
    return [keys[order[begin]], own.langs, *own.context(ORDER), own.codes[0], np.diff(np.append(begin, len(keys)))]


def count_grams(docs: DataFrame) -> DataFrame:
    """COLUMNS of every n-gram of order ORDER in all documents."""
    ship_code(docs.sparkSession)

    def record(held):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in held[1:]], names=COLUMNS)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            langs = batch.column("code").to_numpy()
            for first, end, texts, _, _ in _blocks(batch):
                held.append(_distinct(gram_keys(texts, langs[first:end])[0]))
                size += len(held[-1][0])
                if size > FLUSH:
                    held = [_summed(held)]
                    size = len(held[0][0])
                    if size > FLUSH // 2:
                        yield record(held[0])
                        held, size = [], 0
        if held:
            yield record(_summed(held))

    rows = numbered(docs).select("code", text_of("text").alias("text"))
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in COLUMNS)).groupBy(*GRAM).agg(F.sum("count").alias("count"))


def _short(order: int) -> tuple[Column, Column]:
    """The context (near, far) of the n-gram's last `order` characters."""
    mask = lambda n: F.lit((1 << (CHAR_BITS * max(0, min(NEAR, n)))) - 1)
    return F.col("ctx").bitwiseAND(mask(order - 1)), F.col("far").bitwiseAND(mask(order - 1 - NEAR))


def levels_of(counts: DataFrame, name: str = "kn") -> Iterator[tuple[int, DataFrame, DataFrame]]:
    """(j, n-grams of order j with p, contexts with back) from 1 to ORDER. Lower orders count the distinct characters before."""
    levels = {ORDER: saved(counts, f"{name}-counts")}
    for j in range(ORDER - 1, 0, -1):
        near, far = _short(j)
        levels[j] = saved(levels[j + 1].groupBy("lang", near.alias("ctx"), far.alias("far"), "last").agg(F.count(F.lit(1)).alias("count")), f"{name}-order{j}")
    lower = None
    for j in range(1, ORDER + 1):
        n1, n2, n3, n4 = levels[j].agg(*[F.coalesce(F.count_if(F.col("count") == i), F.lit(0)) for i in (1, 2, 3, 4)]).first()
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        cut = [min(max(d, 0.1), i + 0.9) for i, d in enumerate([1 - 2 * y * n2 / max(n1, 1), 2 - 3 * y * n3 / max(n2, 1), 3 - 4 * y * n4 / max(n3, 1)])]
        off = F.when(F.col("count") == 1, cut[0]).when(F.col("count") == 2, cut[1]).otherwise(cut[2])
        rows = levels[j].withColumn("off", F.least(off, F.col("count").cast("double")))
        sums = rows.groupBy(*CONTEXT).agg(F.sum("count").alias("total"), (F.sum("off") / F.sum("count")).alias("back"), F.count(F.lit(1)).alias("kinds"))
        joined = rows.join(sums, CONTEXT)
        if j == 1:
            below = 1.0 / F.greatest(F.col("kinds"), F.lit(256))
        else:
            near, far = _short(j - 1)
            shorter = lower.select("lang", F.col("ctx").alias("near"), F.col("far").alias("further"), "last", F.col("p").alias("below"))
            joined = joined.withColumns({"near": near, "further": far}).join(shorter, ["lang", "near", "further", "last"])
            below = F.col("below")
        p = (F.col("count") - F.col("off")) / F.col("total") + F.col("back") * below
        lower = saved(joined.select(*GRAM, p.alias("p")), f"{name}-p{j}")
        yield j, lower, sums


def kneser_ney(counts: DataFrame, name: str = "kn") -> DataFrame:
    """(kind, key, logp): kind 1..ORDER are log probabilities of n-grams, kind ORDER + j log back-off
    weights of contexts of j characters. The key is the 64-bit hash of the language, context and last character."""
    whole = None
    for j, grams, sums in levels_of(counts, name):
        part = grams.select(F.lit(j).alias("kind"), F.xxhash64(*GRAM).alias("key"), F.log("p").alias("logp"))
        if j > 1:
            part = part.unionByName(sums.select(F.lit(ORDER + j - 1).alias("kind"), F.xxhash64(*CONTEXT).alias("key"), F.log("back").alias("logp")))
        whole = part if whole is None else whole.unionByName(part)
    return whole


def hash_longs(*columns: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of longs (seed 42), as signed 64-bit numbers."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda x, n: (x << np.uint64(n)) | (x >> np.uint64(64 - n))
    h = np.uint64(42)
    with np.errstate(over="ignore"):
        for keys in columns:
            h = h + p5 + np.uint64(8)
            h = h ^ (turn(keys.astype(np.uint64) * p2, 31) * p1)
            h = turn(h, 27) * p1 + p4
            h = (h ^ (h >> np.uint64(33))) * p2
            h = (h ^ (h >> np.uint64(29))) * p3
            h = h ^ (h >> np.uint64(32))
    return h.astype(np.int64)


class Table:
    """Sorted keys and their values."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = keys[order], values[order]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value, whether stored) of each key. Distinct keys are searched in ascending order, near each other in memory."""
        if not len(self.keys) or not len(keys):
            return np.zeros(len(keys), np.float32), np.zeros(len(keys), bool)
        order, begin = _sorted(keys)
        own = keys[order[begin]]
        at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
        found, place = self.keys[at] == own, np.empty(len(keys), np.int64)
        place[order] = np.repeat(np.arange(len(own)), np.diff(np.append(begin, len(keys))))
        return self.values[at][place], found[place]


class Model:
    """A table of each kind, for texts that were not counted as well."""

    def __init__(self, tables: dict[int, Table]):
        self.tables = tables

    def log_probabilities(self, grams: Grams) -> np.ndarray:
        """ln P(last character | those before), backing off where an n-gram is unknown."""
        out, rest, kept = np.zeros(len(grams)), np.arange(len(grams)), grams
        for j in range(ORDER, 0, -1):
            value, known = self.tables[j].find(kept.keys(j))
            out[rest[known]] += value[known]
            rest, kept = rest[~known], kept.at(np.flatnonzero(~known))
            if not len(rest):
                return out
            if j > 1:
                back, has = self.tables[ORDER + j - 1].find(kept.context_keys(j))
                out[rest] += np.where(has, back, 0)
        out[rest] += -np.log(4096.0)
        return out


def build_model(docs: DataFrame) -> Model:
    """Counts all documents and collects the whole model, for corpora whose model fits one machine."""
    table = kneser_ney(count_grams(docs)).toArrow()
    kind, key, value = (table[c].to_numpy() for c in ("kind", "key", "logp"))
    return Model({k: Table(key[kind == k], value[kind == k].astype(np.float32)) for k in range(1, 2 * ORDER)})


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURED = "doc_id long, lang string, " + ", ".join(f"{k} long" for k in NAMES) + ", n_chars long, nll double"


def _measure(batch: pa.RecordBatch, table: Table) -> Iterator[pa.RecordBatch]:
    langs = batch.column("code").to_numpy()
    for first, end, texts, data, starts in _blocks(batch):
        counts = base_counts(data, starts)
        grams, doc = gram_keys([x or b"" for x in texts], langs[first:end])
        size = np.bincount(doc, minlength=end - first)
        logp, known = table.find(grams.keys())
        if not known.all():
            raise ValueError("an n-gram was not counted")
        nll = -np.bincount(doc, logp, end - first) / np.maximum(counts["n_words"], 1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").slice(first, end - first), batch.column("lang").slice(first, end - first),
             *[pa.array(counts[k].astype(np.int64)) for k in NAMES], pa.array(size.astype(np.int64)), pa.array(nll)],
            names=["doc_id", "lang", *NAMES, "n_chars", "nll"],
        )


def measured(docs: DataFrame, shared: int = SHARED, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, lang, the base counts, n_chars and nll (mean negative log probability of a word)."""
    spark = docs.sparkSession
    ship_code(spark)
    for _, grams, _ in levels_of(count_grams(docs)):
        pass
    values = F.log("p").cast("float").alias("logp")
    rows = numbered(docs).select("doc_id", "lang", "code", text_of("text").alias("text"))
    if grams.count() <= shared:
        found = grams.select(F.xxhash64(*GRAM).alias("key"), values).toArrow()
        whole = Table(found["key"].to_numpy(), found["logp"].to_numpy())
        sent = spark.sparkContext.broadcast((whole.keys, whole.values))

        def run(batches):
            table = Table.__new__(Table)
            table.keys, table.values = sent.value
            for batch in batches:
                yield from _measure(batch, table)

        return rows.mapInArrow(run, MEASURED)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunk = F.pmod(F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id")), F.lit(max(1, -(-size // chunk_bytes))))
    dealt = rows.withColumn("chunk", chunk)

    def used(table: pa.Table) -> pa.Table:
        held = []
        for batch in table.combine_chunks().to_batches():
            langs = batch.column("code").to_numpy()
            held += [_distinct(gram_keys(texts, langs[first:end])[0]) for first, end, texts, _, _ in _blocks(batch)]
        summed = _summed(held)
        return pa.table([pa.array(np.full(len(summed[0]), table["chunk"][0].as_py(), np.int64)), *[pa.array(x) for x in summed[1:-1]]], names=["chunk", *GRAM])

    def score(key, left: pa.Table, right: pa.Table) -> pa.Table:
        table = Table(right["key"].to_numpy(), right["logp"].to_numpy())
        out = [part for batch in left.combine_chunks().to_batches() for part in _measure(batch, table)]
        return pa.Table.from_batches(out)

    needs = dealt.groupBy("chunk").applyInArrow(used, ", ".join(f"{c} long" for c in ["chunk", *GRAM]))
    own = needs.join(grams, GRAM).select("chunk", F.xxhash64(*GRAM).alias("key"), values)
    return dealt.groupBy("chunk").cogroup(own.groupBy("chunk")).applyInArrow(score, MEASURED)


def base_failed() -> Column:
    """Whether a row of measured() fails the base rules."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def length_class(n_words: Column) -> Column:
    return F.floor(F.log2(F.greatest(n_words, F.lit(1)))).cast("int")


def bands(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The median of nll by language, and the robust deviation of (nll - median) * sqrt(n_words): by language
    and class of length (_lang, _length, near), by language (_lang, middle, own) and of all (every).

    Documents that fail the base rules don't count, copies count once. Medians are of bins (BIN, STEP), so
    that reruns agree and an aggregate holds some thousand values. Those of fewer than FEW are null but in `every`.
    """
    nll = F.round("nll", 6)
    one = rows.where(~base_failed()).select(F.col("lang").alias("_lang"), "n_words", "n_chars", nll.alias("nll")).distinct()
    centre = one.groupBy("_lang").agg(((F.median(F.floor(F.col("nll") / BIN)) + 0.5) * BIN).alias("middle"))
    away = F.greatest(F.abs(F.col("nll") - F.col("middle")), F.lit(BIN / 2)) * F.sqrt("n_words")
    seen = one.join(centre.withColumnRenamed("_lang", "_l"), F.col("_lang").eqNullSafe(F.col("_l")))
    steps = seen.select("_lang", length_class(F.col("n_words")).alias("_length"), "middle", F.floor(F.log(away) / STEP).alias("step"))
    middle = F.exp((F.median("step") + 0.5) * STEP) * 1.4826
    enough = F.when(F.count(F.lit(1)) >= FEW, middle)
    return (steps.groupBy("_lang", "_length").agg(enough.alias("near")),
            steps.groupBy("_lang", "middle").agg(enough.alias("own")), steps.agg(middle.alias("every")))


def rules(docs: DataFrame, lower: float = LOWER, upper: float = UPPER) -> DataFrame:
    """One row per document: doc_id, the counts, perplexity (of a word), its band, base_failed and kept.

    Null text has no words and fails the base rules; a null language has a model and band of its
    own. Repeated rows count like any others in the model. An empty table gives an empty result.
    """
    rows = saved(measured(docs), "rules-measured")
    lengths, languages, every = (saved(x, "rules-bands") for x in bands(rows))
    same = F.col("lang").eqNullSafe(F.col("_lang"))
    joined = rows.join(languages, same, "left").drop("_lang")
    joined = joined.join(lengths, same & (length_class(F.col("n_words")) == F.col("_length")), "left").crossJoin(F.broadcast(every))
    spread = F.greatest(F.coalesce("near", "own", "every") / F.sqrt(F.greatest(F.col("n_words"), F.lit(1))), F.lit(BIN))
    low, high = F.col("middle") - lower * spread, F.col("middle") + upper * spread
    inside = (F.col("nll") >= low) & (F.col("nll") <= high)
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"),
        (~base_failed() & F.coalesce(inside, F.lit(False))).alias("kept"), F.exp("nll").alias("perplexity"),
        F.exp(low).alias("lower_bound"), F.exp(high).alias("upper_bound"),
    )
