"""Content-addressed WARC archive: payload bytes once, exact record headers apart, records by join.

An archive is two tables in the shared folder. `payloads` holds each distinct payload once under its
SHA-256, which is checked against the bytes when they are read; `records` holds the exact header
bytes of every record (WARC and HTTP heads) with the digest of its payload. `reconstruct` joins both
and yields the original records byte for byte. All steps are DataFrame functions: payloads are
combined on the map side before the one shuffle that carries them, so a page that is copied a
million times travels once per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliograph.runtime import saved

REVISIT_FROM = 1000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page_id: Column, sha256: Column) -> Column:
    """A urn of the page and its payload: rows that repeat a page_id with other bytes are other records."""
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(":"), F.substring(sha256, 1, 16), F.lit(">"))


def _page_of(record_id: Column) -> Column:
    """The page_id in a record id, null if it names none."""
    return F.nullif(F.regexp_extract(record_id, r"^<urn:x-page:(-?\d+):", 1), F.lit("")).cast("long")


def _clean(url: Column) -> Column:
    """A url as a header value: line breaks would end the header, so they are percent-encoded."""
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def records(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """page_id, sha256, payload, header of each page's record.

    Of pages with the same payload of at least `revisit_from` bytes, the one with the largest page_id
    is the response and the others revisit it; shorter payloads are always responses. Rows that tie
    for the largest page_id are all responses. Null html counts as empty; a null url has no
    WARC-Target-URI line; a null page_id ranks below all others.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    base = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"sha256": F.sha2("payload", 256), "sha1": F.sha1("payload"), "size": F.octet_length("payload")}
    )
    latest = (
        base.where(F.col("size") >= revisit_from).groupBy("sha256")
        .agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
        .select(F.col("sha256").alias("_sha256"), "response_id")
    )
    joined = base.join(latest, (F.col("sha256") == F.col("_sha256")) & (F.col("size") >= revisit_from), "left")
    revisit = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    block_size = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("size"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("sha256"))),
        line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", _clean(F.col("url"))), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", _record_id(F.col("response_id"), F.col("sha256"))),
        )).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", block_size.cast("string")),
        F.lit("\r\n"),
    )
    return joined.select("page_id", "sha256", "payload", F.concat(head, http).cast("binary").alias("header"))


def write_archive(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> tuple[DataFrame, DataFrame]:
    """Writes (records, payloads) to the shared folder and returns both as read back."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    stored = pages.select(F.sha2(payload, 256).alias("sha256"), payload.alias("payload")).groupBy("sha256").agg(
        F.first("payload").alias("payload"), F.min(F.octet_length("payload")).alias("size"), F.max(F.octet_length("payload")).alias("_most")
    )
    stored = stored.select(
        "sha256", F.when(F.col("size") == F.col("_most"), F.col("payload")).otherwise(F.raise_error(F.lit("one digest, two sizes"))).alias("payload"), "size"
    )
    heads = records(pages, revisit_from).select("page_id", "sha256", "header")
    return saved(heads, "warc-records"), saved(stored, "warc-payloads")


def reconstruct(heads: DataFrame, payloads: DataFrame) -> DataFrame:
    """page_id, record (the exact WARC record) and payload (in full, for revisits too) of every record.

    Stops with an error if stored bytes don't match their digest.
    """
    checked = payloads.select(
        "sha256",
        F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload")).otherwise(F.raise_error(F.lit("payload digest mismatch"))).alias("payload"),
    )
    joined = heads.join(checked, "sha256")
    is_revisit = F.contains(F.col("header"), F.lit(b"\r\nWARC-Type: revisit\r\n"))
    body = F.when(is_revisit, F.lit(b"")).otherwise(F.col("payload"))
    return joined.select("page_id", "header", "payload", F.concat("header", body, F.lit(b"\r\n\r\n")).alias("record"))


def export_warc(heads: DataFrame, payloads: DataFrame, path: str) -> None:
    """Writes .warc files. Each record ends with the blank lines that Spark's text writer puts as line end."""
    record = reconstruct(heads, payloads).select("record")
    text = F.expr("substring(record, 1, octet_length(record) - 4)").cast("string")
    record.select(text).write.option("lineSep", "\r\n\r\n").text(path)


def report(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Writes the archive, reads it back, and reports each record by parsing the reconstructed bytes.

    A response's payload is what follows the HTTP head in its record; a revisit's is that of the
    stored payload it is joined to. Stops with an error where the digest in the head isn't that of
    the payload, or Content-Length not that of the block.
    """
    back = reconstruct(*write_archive(pages, revisit_from))
    end = "\r\n\r\n"
    parts = F.split(F.col("record").cast("string"), end, 3)  # head, HTTP head, payload and the blank lines behind it
    rows = back.select("payload", parts[0].alias("head"), F.octet_length(parts[1]).alias("http"), parts[2].cast("binary").alias("rest"))
    value = lambda name: F.nullif(F.regexp_extract("head", rf"(?:^|\r\n){name}: ([^\r\n]*)", 1), F.lit(""))
    is_revisit = value("WARC-Type") == "revisit"
    own = F.expr(f"substring(rest, 1, octet_length(rest) - {len(end)})")
    rows = rows.select(
        value("WARC-Record-ID").alias("id"), value("WARC-Refers-To").alias("refers"), value("WARC-Type").alias("record_type"),
        value("WARC-Payload-Digest").alias("digest"), value("Content-Length").cast("long").alias("length"),
        (F.col("http") + len(end) + F.octet_length("rest") - len(end)).alias("block"), F.when(is_revisit, F.col("payload")).otherwise(own).alias("payload"),
    )
    sha1 = F.sha1("payload")
    sound = (F.concat(F.lit("sha1:"), sha1) == F.col("digest")) & (F.col("length") == F.col("block"))
    return rows.select(
        _page_of(F.col("id")).alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(sound, sha1).otherwise(F.raise_error(F.lit("header and payload disagree"))).alias("payload_digest"),
        "record_type",
        _page_of(F.col("refers")).alias("refers_to"),
    )
