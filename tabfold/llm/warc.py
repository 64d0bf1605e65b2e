"""WARC archives: writing, reading, and revisit resolution.

Payload digests are shuffled with their ids only; of equal payloads the record
with the largest id stays a response, and the others become revisit records
that refer to it.  Archives get fresh headers (record ids, lengths, digests)
and are written by Spark's text writer, one gzip stream a file: a record ends
with two line breaks, which is the writer's line separator.  They are read
back through Spark's binary files, one record at a time by its Content-Length.

Defined cases: a null payload counts as the empty one; payloads below
``min_bytes`` are responses each; rows alike in payload and id are responses
all, if their id is the largest; a null id is below all others (of payloads
that only null ids have, each row is a response); a null address is left out of
the header; line breaks within an address are escaped; a table without rows
gives an archive without records; other columns are never read.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from base64 import b32encode
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfold.llm.common import few_bytes, ship_package, stash, text_or_empty
from tabfold.session import scratch_path

BREAK = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_SCHEMA = ("record_id string, record_type string, page_id long, target_uri string, payload_bytes long, "
               "payload_digest string, refers_to_record string")


def base32_sha1(col: Column) -> Column:
    """The bare upper-case base32 SHA-1: ten hexadecimal digits make eight of base 32."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    hexed = F.sha1(col)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*parts)), digits, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_id(page_id: Column) -> Column:
    """A record's address, made from its page id alone: tasks that run again give the same."""
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(page_id.cast("string"), F.lit("none"))))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


ARCHIVE_BYTES = 128 << 20       # of records of an archive, about: a worker holds one
HEADER_BYTES = 700              # of a record, about


def payload_rows(pages: DataFrame, key: str = "page_id", uri: str = "url", body: str = "html") -> DataFrame:
    return pages.select(F.col(key).cast("long").alias("page_id"), F.col(uri).cast("string").alias("target_uri"),
                        text_or_empty(body).alias("payload")).withColumn("payload_digest", base32_sha1(F.encode("payload", "UTF-8")))


def resolve_revisits(rows: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``rows`` with ``refers_to``: the page id of the response that a revisit repeats, else null.

    Only headers (id and digest) are shuffled by digest: those of digests that
    repeat are joined to their original.  What comes out is a row for each
    revisit, and finds its payload row by id and digest; no payload is shuffled
    while the revisits are few bytes, and none meets others of its digest.
    """
    heads = stash(rows.where(F.octet_length("payload") >= min_bytes).select("page_id", "payload_digest"), "warc-heads")
    originals = stash(heads.groupBy("payload_digest").agg(F.max("page_id").alias("original"), F.count("*").alias("n")).where("n > 1"), "warc-originals")
    revisits = stash(heads.join(few_bytes(originals, F.lit(72)), "payload_digest").where(~F.col("page_id").eqNullSafe(F.col("original")))
                     .select(F.col("page_id").alias("_page"), F.col("payload_digest").alias("_digest"), F.col("original").alias("refers_to"))
                     .distinct(), "warc-revisits")
    return rows.join(few_bytes(revisits, F.lit(80)), F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("payload_digest") == F.col("_digest")),
                     "left").drop("_page", "_digest")


def as_records(rows: DataFrame, date: str) -> DataFrame:
    """One string a record: fresh header, and for responses the payload."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(BREAK))
    size = F.octet_length("payload")
    safe = F.regexp_replace(F.regexp_replace("target_uri", "\r", "%0D"), "\n", "%0A")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}"),
                    line("Content-Length", size.cast("string")), F.lit(BREAK))
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    header = F.concat(
        F.lit(f"WARC/1.1{BREAK}"), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", record_id(F.col("page_id"))), line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", safe), F.lit("")), F.coalesce(line("X-Page-ID", F.col("page_id").cast("string")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", record_id(F.col("refers_to"))))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length("block").cast("string")), F.lit(BREAK))
    return rows.withColumn("block", block).select(F.concat(header, F.col("block")).alias("value"))


def write_archives(records: DataFrame, path: str, mean_bytes: float = 0) -> None:
    """Archives below ``path``: one for each partition, or several, of about ``ARCHIVE_BYTES`` of records of ``mean_bytes`` at most."""
    most = max(1, min(100_000, int(ARCHIVE_BYTES // max(mean_bytes, 1))))
    (records.write.option("lineSep", BREAK * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", most).text(path))


def parse_archive(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """Header (lower-case names) and block of each record; plain or gzip, one member or many."""
    f = gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    while True:
        first = f.readline()
        if not first:
            return
        if not first.strip():
            continue
        if not first.startswith(b"WARC/"):
            raise ValueError(f"not the start of a record: {first[:40]!r}")
        header = {}
        while (row := f.readline()).strip():
            name, _, value = row.decode().partition(":")
            header[name.strip().lower()] = value.strip()
        yield header, f.read(int(header["content-length"]))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row a record; payload length and digest of responses are those of the bytes read."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                out = []
                for header, block in parse_archive(data):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    kind, digest = header["warc-type"], header["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "revisit":
                        size = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                    else:
                        size, found = len(payload), b32encode(hashlib.sha1(payload).digest()).decode()
                        if found != digest:
                            raise ValueError(f"payload of {header['warc-record-id']} has another digest")
                    page = header.get("x-page-id")
                    out.append((header["warc-record-id"], kind, None if page is None else int(page), header.get("warc-target-uri"),
                                size, digest, header.get("warc-refers-to")))
                frame = pd.DataFrame(out, columns=[c.split()[0] for c in READ_SCHEMA.split(", ")])
                yield frame.astype({"page_id": "Int64"})
    ship_package(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInPandas(rows, READ_SCHEMA)


def responses_of(records: DataFrame) -> DataFrame:
    """Records read from archives; revisits get the page id of the response they refer to."""
    heads = (records.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_record"))
             .agg(F.max("page_id").alias("refers_to")))
    return records.join(heads, "refers_to_record", "left")


def deduplicated_archives(pages: DataFrame, path: str | None = None, min_bytes: int = 0,
                          date: str | None = None) -> DataFrame:
    """Resolve revisits, write the archives (a new folder of the shared one by default), read them back.

    ``date``: the records' WARC-Date, by default that of the call.
    """
    spark = pages.sparkSession
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    path = path or scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    rows = payload_rows(pages)
    mean = rows.agg(F.avg(F.octet_length("payload"))).first()[0] or 0
    write_archives(as_records(resolve_revisits(rows, min_bytes), date), path, mean + HEADER_BYTES)
    return responses_of(read_archives(spark, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "target_uri")
