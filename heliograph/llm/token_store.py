"""Token-id files: documents compressed one by one under a shared zstandard dictionary.

A file is a run of frames in ascending doc_id order. A frame:

    magic "HTF1", dictionary hash (8 bytes), documents (u4), tokens (u8), index length (u4),
    index: per document doc_id (i8), has_id (u1), first token in the frame (u8), tokens (u4),
           blob offset (u8), blob length (u4),
    blobs: each document's ids (u2 below 65,536 ids, else u4), compressed alone.

So one document is read with the frame's head, its index entry and its blob. The dictionary is
trained on the ids of SAMPLE_DOCS documents with the smallest hashes of doc_id (all if fewer), of
longer ones on SAMPLE_BLOCKS blocks at hashed places over the whole of them, and is written beside
the files. Where that is too little to train on, the sampled ids themselves are the dictionary. Spark's writers and readers move the files, so any
file system that Spark reaches will do, and task commits survive lost executors: a frame is a row of
the text writer, whose line end is the frame's last byte.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heliograph.llm.common import text_of
from heliograph.runtime import fresh_path, saved, ship_code

END_ID = 0
SAMPLE_DOCS = 1000
SAMPLE_BLOCKS = 4  # of a document longer than all of them together
BLOCK_BYTES = 1 << 12
DICTIONARY_BYTES = 1 << 16
FRAME_BYTES = 1 << 22
FILE_BYTES = 1 << 25
MAGIC = b"HTF1"
HEAD = struct.Struct("<4s8sIQI")
ENTRY = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("first", "<u8"), ("tokens", "<u4"), ("at", "<u8"), ("length", "<u4")])


def dictionary_hash(dictionary: bytes) -> bytes:
    return hashlib.sha256(dictionary).digest()[:8]


def train_dictionary(samples: list[bytes]) -> bytes:
    """A zstandard dictionary; of too few or too uniform samples, the last of the samples themselves (raw content)."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:] or bytes(8)


def _zstd(dictionary: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(dictionary)


def sample_blocks(ids: bytes, width: int, seed: int) -> list[bytes]:
    """All ids, or SAMPLE_BLOCKS blocks of BLOCK_BYTES, one at a hashed place in each equal part of them."""
    if len(ids) <= SAMPLE_BLOCKS * BLOCK_BYTES:
        return [ids]
    part = len(ids) // SAMPLE_BLOCKS
    starts = [k * part + zlib.crc32(b"%d %d" % (seed, k)) % (part - BLOCK_BYTES + 1) for k in range(SAMPLE_BLOCKS)]
    return [ids[a - a % width :][:BLOCK_BYTES] for a in starts]


def frame(documents: list[tuple], dictionary: bytes) -> bytes:
    """The frame of [(doc_id, tokens, blob)]."""
    index = np.zeros(len(documents), ENTRY)
    tokens = np.asarray([n for _, n, _ in documents], np.int64)
    lengths = np.asarray([len(b) for _, _, b in documents], np.int64)
    index["doc_id"] = [0 if d is None else d for d, _, _ in documents]
    index["has_id"] = [d is not None for d, _, _ in documents]
    index["first"], index["tokens"] = np.cumsum(tokens) - tokens, tokens
    index["at"], index["length"] = np.cumsum(lengths) - lengths, lengths
    head = HEAD.pack(MAGIC, dictionary_hash(dictionary), len(documents), int(tokens.sum()), index.nbytes)
    return head + index.tobytes() + b"".join(b for _, _, b in documents)


def read_frames(data: bytes, dictionary: bytes) -> Iterator[tuple[int, int, np.ndarray, memoryview]]:
    """(place of the frame, its tokens, its index, its blobs) of each frame of a file."""
    at, view = 0, memoryview(data)
    while at < len(data):
        magic, used, n, tokens, size = HEAD.unpack_from(data, at)
        if magic != MAGIC or used != dictionary_hash(dictionary):
            raise ValueError("not a frame, or another dictionary")
        index = np.frombuffer(data, ENTRY, n, at + HEAD.size)
        blobs = at + HEAD.size + size
        end = blobs + int(index["length"].sum())
        yield at, tokens, index, view[blobs:end]
        at = end + 1  # the line end


def decode(blob: bytes, decompressor, wide: bool) -> np.ndarray:
    """A document's ids as little-endian unsigned 32-bit integers."""
    return np.frombuffer(decompressor.decompress(blob), "<u4" if wide else "<u2").astype("<u4")


def _sample(docs: DataFrame, tokenizer_path: str, end_id: int, wide: bool) -> list[bytes]:
    """Serialised ids of the sampled documents: SAMPLE_DOCS at most, SAMPLE_BLOCKS blocks of each."""
    chosen = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS).distinct()
    texts = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", text_of("text").alias("text"))

    def run(batches):
        from heliograph.llm.token_ids import encoder

        encode = encoder(tokenizer_path).many
        for batch in batches:
            out = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                ids = np.append(np.frombuffer(ids, "<u4"), np.uint32(end_id)).astype("<u4" if wide else "<u2")
                out += [(doc_id, k, block) for k, block in enumerate(sample_blocks(ids.tobytes(), ids.itemsize, doc_id))]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(list(zip(*out)) or [()] * 3, (pa.int64(), pa.int32(), pa.binary()))], names=["doc_id", "place", "ids"])

    found = texts.mapInArrow(run, "doc_id long, place int, ids binary").orderBy(F.xxhash64("doc_id"), "doc_id", "place", "ids").limit(SAMPLE_BLOCKS * SAMPLE_DOCS)
    return [bytes(r.ids) for r in found.collect()]


def write(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = END_ID, file_bytes: int = FILE_BYTES, vocabulary: int = 50_257) -> bytes:
    """Writes the documents' ids under `path` in ascending doc_id order; returns the dictionary.

    Null text is the end id alone. A null doc_id comes first; rows that share a doc_id are ordered by
    text. Texts of any length are whole. An empty table writes no frame.
    """
    spark = docs.sparkSession
    ship_code(spark)
    wide = vocabulary > 1 << 16
    dictionary = train_dictionary(_sample(docs, tokenizer_path, end_id, wide))
    spark.createDataFrame([(bytearray(dictionary),)], "dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    rows = docs.select("doc_id", text_of("text").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ordered = rows.repartitionByRange(max(1, -(-size // file_bytes)), "doc_id").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def run(batches):
        import zstandard

        from heliograph.llm.token_ids import encoded, encoder

        encode, compress = encoder(tokenizer_path).many, zstandard.ZstdCompressor(level=3, dict_data=_zstd(dictionary)).compress
        held, size = [], 0
        put = lambda: pa.RecordBatch.from_arrays([pa.array([frame(held, dictionary)], pa.binary())], names=["frame"])
        for batch in batches:
            for doc_id, ids in encoded(encode, batch.column(0), batch.column(1)):
                ids = np.append(np.frombuffer(ids, "<u4"), np.uint32(end_id))
                blob = compress(ids.astype("<u4" if wide else "<u2").tobytes())
                held.append((doc_id, len(ids), blob))
                size += len(blob)
                if size >= FRAME_BYTES:
                    yield put()
                    held, size = [], 0
        if held:
            yield put()

    frames = ordered.mapInArrow(run, "frame binary").select(F.col("frame").cast("string"))
    frames.write.option("lineSep", "\n").text(f"{path}/files")
    return dictionary


def read_dictionary(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.parquet(f"{path}/dictionary").first()[0])


def read(spark: SparkSession, path: str, vocabulary: int = 50_257) -> DataFrame:
    """Every document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    ship_code(spark)
    dictionary, wide = read_dictionary(spark, path), vocabulary > 1 << 16
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(f"{path}/files").select("path", "content")

    def run(batches):
        import zstandard

        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = content.as_py()
                reader = zstandard.ZstdDecompressor(dict_data=_zstd(dictionary))
                for at, tokens, index, blobs in read_frames(data, dictionary):
                    sums = [zlib.crc32(decode(blobs[int(e["at"]) : int(e["at"]) + int(e["length"])], reader, wide)) for e in index]
                    n = len(index)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * n), pa.array([at] * n, pa.int64()), pa.array([tokens] * n, pa.int64()),
                         pa.array([int(e["doc_id"]) if e["has_id"] else None for e in index], pa.int64()),
                         pa.array(index["first"].astype(np.int64)), pa.array(index["tokens"].astype(np.int64)), pa.array(sums, pa.int64())],
                        names=["file", "at", "frame_tokens", "doc_id", "first", "n_tokens", "ids_crc32"],
                    )

    schema = "file string, at long, frame_tokens long, doc_id long, first long, n_tokens long, ids_crc32 long"
    rows = saved(files.mapInArrow(run, schema), "token-rows")
    # Two levels: the frames of a file, then the files.
    heads = rows.groupBy("file", "at").agg(F.max("frame_tokens").alias("tokens"), F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("least"))
    inside = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    frames = heads.select("file", "at", F.coalesce(F.sum("tokens").over(inside), F.lit(0)).alias("inside"))
    order = Window.orderBy("least", "file").rowsBetween(Window.unboundedPreceding, -1)
    whole = heads.groupBy("file").agg(F.sum("tokens").alias("tokens"), F.min("least").alias("least"))
    before = whole.select("file", F.coalesce(F.sum("tokens").over(order), F.lit(0)).alias("before"))
    places = frames.join(before, "file").select("file", "at", (F.col("before") + F.col("inside")).alias("before"))
    return rows.join(places, ["file", "at"]).select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def locations(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, file, position and length of every document's blob, from the frames' indexes; built once, beside the files."""
    folder = f"{path}/locations"
    if not _exists(spark, f"{folder}/_SUCCESS"):
        ship_code(spark)
        dictionary, head_size = read_dictionary(spark, path), HEAD.size
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(f"{path}/files").select("path", "content")

        def run(batches):
            for batch in batches:
                for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                    for at, _, index, _ in read_frames(content.as_py(), dictionary):
                        named = index[index["has_id"] == 1]
                        position = at + head_size + index.nbytes + named["at"].astype(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(named["doc_id"].astype(np.int64)), pa.array([name] * len(named), pa.string()), pa.array(position), pa.array(named["length"].astype(np.int32))],
                            names=["doc_id", "file", "position", "length"])

        files.mapInArrow(run, "doc_id long, file string, position long, length int").write.parquet(folder)
    return spark.read.parquet(folder)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def lookup(spark: SparkSession, path: str, doc_ids: list[int], vocabulary: int = 50_257) -> dict[int, list[int]]:
    """Ids of a few documents: their blobs' places are looked up, and only these bytes of the files are read."""
    import zstandard

    dictionary, found = read_dictionary(spark, path), {}
    reader = zstandard.ZstdDecompressor(dict_data=_zstd(dictionary))
    jvm = spark._jvm
    for row in locations(spark, path).where(F.col("doc_id").isin(doc_ids)).collect():
        target = jvm.org.apache.hadoop.fs.Path(row.file)
        stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
        try:
            stream.seek(row.position)
            blob = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, row.length))
        finally:
            stream.close()
        found[row.doc_id] = decode(blob, reader, vocabulary > 1 << 16).tolist()
    return found


def report(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Writes the documents to the shared folder and reports every one of them from the files."""
    path = fresh_path(docs.sparkSession, "token-files")
    write(docs, tokenizer_path, path)
    return read(docs.sparkSession, path)
