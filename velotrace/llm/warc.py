"""WARC archives in which repeated payloads are revisit records.

Payload digests are taken where the pages are read. Headers, without payloads, are shuffled by
digest to find each payload's original, and revisits are joined to it; payloads move once, by
record number, so copies of one page do not meet. The archives are text files of whole records,
compressed, of bounded size: a record ends with two line ends, and the last line feed is the text
writer's line separator.

Defined results: a null html is an empty payload; of records with equal payloads the one with the
largest page_id is the original, of repeated rows with that page_id one of them; null page_ids and
urls have no header and read back as null; no rows give no archives. Other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import math
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velotrace.operators.joins import lookup
from velotrace.session import new_path, written

#: Payloads below this many bytes are always written whole.
MIN_REVISIT_BYTES = 1000
#: Payload bytes that one archive file holds, about.
FILE_BYTES = 16 << 20
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_SCHEMA = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "url string, whole boolean"
)


def records(pages: DataFrame) -> DataFrame:
    """Numbered records with the digest of their payload, written once so that numbers are fixed."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html")).withColumn(
        "record", F.monotonically_increasing_id()
    )
    return written(
        rows.withColumns(
            {
                "payload_bytes": F.octet_length("html").cast("long"),
                "payload_digest": F.sha1(F.col("html").cast("binary")),
            }
        ),
        "records",
    )


def resolve(headers: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """For each record its type and, for revisits, the original's record, page and url."""
    large = headers.filter(F.col("payload_bytes") >= min_bytes)
    originals = large.groupBy("payload_digest").agg(
        F.max(F.struct("page_id", "record", "url")).alias("original")
    )
    met = lookup(large, written(originals, "originals"), ["payload_digest"])
    revisit = F.col("original.record") != F.col("record")
    found = met.select(
        "record",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        *[F.when(revisit, F.col(f"original.{c}")).alias(f"first_{c}") for c in ("record", "page_id", "url")],
    )
    small = headers.filter(F.col("payload_bytes") < min_bytes)
    return found.unionByName(
        small.select("record", F.lit("response").alias("record_type")), allowMissingColumns=True
    )


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value; line ends cannot end the line."""
    clean = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(CRLF)), F.lit(""))


def _record_id(record: Column, digest: Column) -> Column:
    key = F.md5(F.concat_ws(":", record.cast("string"), digest).cast("binary"))
    parts = [F.substring(key, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def record_text(date: str) -> Column:
    """A record as text, without its last line feed."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"),
        _field("Content-Length", F.col("payload_bytes")),
        F.lit(CRLF),
    )
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _field("WARC-Type", F.col("record_type")),
        _field("WARC-Record-ID", _record_id(F.col("record"), F.col("payload_digest"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _field("Page-ID", F.col("page_id")),
        _field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _field("WARC-Refers-To", F.when(revisit, _record_id(F.col("first_record"), F.col("payload_digest")))),
        _field("WARC-Refers-To-Target-URI", F.col("first_url")),
        _field("Refers-To-Page-ID", F.col("first_page_id")),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        _field(
            "Content-Length",
            F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")),
        ),
        F.lit(CRLF),
    )
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    return F.concat(head, http, body, F.lit("\r\n\r"))


def write_archives(
    pages: DataFrame,
    path: str,
    min_bytes: int = MIN_REVISIT_BYTES,
    date: str = "2024-01-01T00:00:00Z",
    file_bytes: int = FILE_BYTES,
) -> None:
    """Write deduplicated archives with fresh headers to the folder ``path``."""
    all_records = records(pages)
    headers = all_records.drop("html")
    files = max(1, math.ceil((headers.agg(F.sum("payload_bytes")).first()[0] or 0) / file_bytes))
    decisions = written(resolve(headers, min_bytes), "decisions")
    whole = all_records.repartition(files, "record").join(
        decisions.repartition(files, "record"), "record"
    )
    whole.select(record_text(date).alias("value")).write.option("compression", "gzip").option(
        "lineSep", "\n"
    ).text(path)


def parse_archive(data: bytes) -> Iterator[tuple]:
    """The records of an uncompressed archive, by their content lengths, as READ_SCHEMA says."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split(CRLF)[1:]
        fields = dict(line.split(": ", 1) for line in lines)
        start = end + 4
        at = start + int(fields["Content-Length"])
        body = data.index(b"\r\n\r\n", start) + 4
        http = dict(line.split(": ", 1) for line in data[start : body - 4].decode().split(CRLF)[1:])
        payload = data[body:at]
        assert data[at : at + 4] == b"\r\n\r\n", "a record must end where its length says"
        at += 4
        digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
        if kind == "response":
            found = hashlib.sha1(payload).hexdigest()
            size, whole, digest = len(payload), found == digest, found
        else:
            size, whole = int(http["Content-Length"]), not payload
        page, first = fields.get("Page-ID"), fields.get("Refers-To-Page-ID")
        yield (
            page and int(page), size, digest, kind, first and int(first), fields.get("WARC-Target-URI"), whole,
        )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record; ``whole`` tells whether the payload has the digest of its header."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("page_id", pa.int64()),
                ("payload_bytes", pa.int64()),
                ("payload_digest", pa.string()),
                ("record_type", pa.string()),
                ("refers_to", pa.int64()),
                ("url", pa.string()),
                ("whole", pa.bool_()),
            ]
        )
        for batch in batches:
            for content in batch.column(0):
                rows = list(parse_archive(gzip.decompress(content.as_py())))
                columns = zip(*rows) if rows else [[]] * len(schema)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
                )

    return files.select("content").mapInArrow(parse, READ_SCHEMA)


def new_archive_folder(spark: SparkSession) -> str:
    return new_path(spark, f"warc-{uuid.uuid4().hex[:8]}")
