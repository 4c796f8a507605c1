"""WARC archives with resolved revisits.

Only headers are shuffled to decide: per payload digest the largest id is found by a partial aggregate,
and digests that occur twice or more are joined to the records. The record with the largest id carries
the payload as ``response``; the others become ``revisit`` records that refer to it and carry none.
Archives are written by Spark's own text writer, one row per record with CRLF CRLF as its end, so the
output committer takes care of lost executors; a file holds a bounded number of records. Reading walks
each file by Content-Length and joins revisits to their responses again.

Defined cases: a null payload is empty; records with equal payloads below ``at_least`` bytes all stay
responses; rows without an id are responses of their own, never referred to; of rows that share the
largest id and the payload all are responses; a null or odd URL has its control characters and spaces
percent-encoded; an empty table writes an empty archive; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.session import scratch_path

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Records of one archive file at most; a task starts the next one.
FILE_RECORDS = 2000
END = "\r\n\r\n"


def digest(hexa: str) -> Column:
    """Bare upper-case base32 of a hexadecimal SHA-1: ten digits make eight characters."""
    plain = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    eights = [F.lpad(F.conv(F.substring(hexa, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*eights), plain, BASE32)


def resolved(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", at_least: int = 0) -> DataFrame:
    """(id, url, payload, size, digest, refers_to): refers_to null for responses."""
    rows = (
        pages.select(
            F.col(f"`{id_col}`").cast("long").alias("id"),
            F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit("")).alias("url"),
            F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")).cast("binary").alias("payload"),
        )
        .withColumns({"size": F.octet_length("payload").cast("long"), "hexa": F.sha1("payload")})
        .select("id", "url", "payload", "size", digest("hexa").alias("digest"))
    )
    headers = stored(rows.select("id", "size", "digest"), "headers").filter((F.col("size") >= at_least) & F.col("id").isNotNull())
    last = headers.groupBy("digest").agg(F.max("id").alias("last"), F.count("*").alias("n")).filter("n > 1").select("digest", "last")
    refers = stored(headers.join(last, "digest").filter("id <> last").select("id", "digest", "last").distinct(), "revisits")
    return rows.join(refers, ["id", "digest"], "left").select("id", "url", "payload", "size", "digest", F.col("last").alias("refers_to"))


def _uri(url: Column) -> Column:
    for char in ("%0A", "%0D", "%09", "%20"):
        url = F.replace(url, F.lit(chr(int(char[1:], 16))), F.lit(char))
    return url


def written(records: DataFrame, path: str, date: str = "2026-01-01T00:00:00Z") -> None:
    """Write ``resolved`` records below ``path``; payloads stay in the partitions they were read in."""
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    fields = [
        ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", name(F.col("id"))),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", _uri(F.col("url"))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("Content-Type", F.lit("text/html; charset=utf-8")),
        ("Content-Length", F.octet_length(body).cast("string")),
    ]
    head = F.concat(F.lit("WARC/1.1\r\n"), *[F.concat(F.lit(f"{k}: "), v, F.lit("\r\n")) for k, v in fields])
    more = F.when(
        revisit,
        F.concat(
            F.lit("WARC-Refers-To: "), name(F.col("refers_to")),
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"),
        ),
    ).otherwise(F.lit(""))
    record = F.concat(head, more, F.lit("\r\n"), body.cast("string"))
    records.select(record.alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", FILE_RECORDS).text(path)


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of one archive: headers and block."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        begin = stop + 4
        end = begin + int(fields["Content-Length"])
        yield fields, data[begin:end]
        at = end + 4


def records(spark: SparkSession, path: str) -> DataFrame:
    """Headers of the archives below ``path``: (id, url, record_type, digest, refers_to, size, sound).

    size is that of the block; sound says whether the digest of a response fits its block.
    """
    import base64
    import hashlib

    def number(uri: str | None) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", uri or "")
        return int(found[1]) if found else None

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for content in batch.column(0):
                rows = []
                for fields, block in parsed(content.as_py()):
                    own = "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
                    kind, name = fields["WARC-Type"], fields["WARC-Payload-Digest"]
                    rows.append(
                        (number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], kind, name[5:], number(fields.get("WARC-Refers-To")), len(block), kind == "revisit" or own == name)
                    )
                kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_())
                columns = zip(*rows) if rows else ((),) * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["id", "url", "record_type", "digest", "refers_to", "size", "sound"])

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "id long, url string, record_type string, digest string, refers_to long, size long, sound boolean")


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """(id, url, payload_bytes, digest, record_type, refers_to); a revisit has the size of its response."""
    every = records(spark, path)
    size = every.filter("record_type = 'response' AND id IS NOT NULL AND sound").groupBy(F.col("id").alias("of"), "digest").agg(F.max("size").alias("full"))
    found = every.withColumn("of", F.col("refers_to")).join(size, ["of", "digest"], "left")
    return found.select(
        "id", "url", F.when(F.col("record_type") == "revisit", F.col("full")).otherwise(F.col("size")).alias("payload_bytes"), "digest", "record_type", "refers_to"
    )


def archived(pages: DataFrame) -> DataFrame:
    """Write pages as archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "llm-warc")
    written(resolved(pages), path)
    return read_back(spark, path)
