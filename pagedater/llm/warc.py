"""WARC archives with revisit records: written, resolved and read back on Spark.

Pages become records; headers alone are shuffled by payload digest, the page with the largest
id of a digest keeps the payload, and the others become revisit records that refer to it.
Payloads move once, to the task that writes their archive, and those of frequent digests'
revisits do not move at all.
Archives are plain files in a shared folder: the records are text, and the writer's line
separator is the blank lines that end a record, so any file system that Spark writes to
will do. Each archive is a gzip file of bounded size and is read back by Content-Length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagedater.llm.common import picked
from pagedater.session import stage

#: Payload bytes that an archive file holds on average.
ARCHIVE_BYTES = 16 * 1024 * 1024
#: Digests of more than one row in HOT are joined by broadcast: at most HOT of them, whatever the rows.
HOT = 1000
#: Parts that the pages of any other digest are dealt into.
SALTS = 32
#: The table has no time of capture; a fixed one keeps archives reproducible.
DATE = "2020-01-01T00:00:00Z"

RECORDS = (
    "page_id long, record_type string, payload_digest string, content_bytes long, refers_to long, url string, payload string"
)

# Digits of base 32 as conv() writes them, and as RFC 4648 does.
CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32: five hex digits make four of base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), CONV_DIGITS, BASE32_DIGITS)


def page_payloads(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (null html: empty) with its bytes and digest."""
    page = picked(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("payload")
    )
    return page.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn(
        "payload_digest", base32_sha1(F.col("payload"))
    )


def repeated_digests(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Digests of at least ``min_bytes`` that several rows share: payload_digest, original, copies.

    The original is the largest page id; null ids lose against others.
    """
    return (
        headers.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("original"), F.count("*").alias("copies"))
        .filter(F.col("copies") > 1)
    )


def resolve_revisits(payloads: DataFrame, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """page_id, url, payload, its bytes and digest, ``record_type`` and ``refers_to``.

    A partition holds about ``archive_bytes`` of payload; one page may make it larger.

    A row whose digest is repeated and whose id is not the original's is a revisit; rows that
    repeat that id are responses too, since nothing may revisit itself. Where a digest has
    only null ids, all are responses. Revisits of frequent digests come without payload.
    """
    headers = stage(payloads.select("page_id", "payload_bytes", "payload_digest"), "headers")
    repeated = stage(repeated_digests(headers, min_bytes), "repeated")
    size = headers.agg(F.count("*").alias("rows"), F.coalesce(F.sum("payload_bytes"), F.lit(0)).alias("bytes")).first()
    parts = max(1, -(-int(size["bytes"]) // archive_bytes))
    often = F.col("copies") > F.lit(size["rows"]) / HOT
    hot = repeated.filter(often).select("payload_digest", F.col("original").alias("_hot"), F.lit(True).alias("_often"))
    rest = repeated.filter(~often).select(
        F.col("payload_digest").alias("_key"),
        F.col("original").alias("_original"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"),
    )

    def other(original: str) -> Column:
        return F.col(original).isNotNull() & ~F.col("page_id").eqNullSafe(F.col(original))

    own = F.xxhash64("page_id", "url")
    # Rows of frequent digests are settled here and spread by their own hash.
    marked = payloads.join(F.broadcast(hot), "payload_digest", "left").select(
        "page_id",
        "url",
        F.when(other("_hot"), "").otherwise(F.col("payload")).alias("payload"),
        "payload_bytes",
        "payload_digest",
        "_hot",
        F.when(F.col("_often"), own.cast("string")).otherwise(F.col("payload_digest")).alias("_key"),
        F.pmod(own, F.lit(SALTS)).cast("int").alias("_salt"),
    )
    place = ("_key", "_salt")
    joined = marked.repartition(parts, *place).join(rest.repartition(parts, *place).hint("shuffle_hash"), list(place), "left")
    original = F.coalesce("_hot", "_original")
    return joined.withColumn("_original", original).select(
        "page_id",
        "url",
        "payload",
        "payload_bytes",
        "payload_digest",
        F.when(other("_original"), "revisit").otherwise("response").alias("record_type"),
        F.when(other("_original"), F.col("_original")).alias("refers_to"),
    )


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def records(resolved: DataFrame) -> DataFrame:
    """The text of each record, without the blank lines that end it, in column ``value``."""
    response = F.col("record_type") == "response"
    payload = F.when(response, F.col("payload")).otherwise("")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.concat(http, payload)
    # A header is one line: control characters of the address are percent-encoded.
    url = F.coalesce(F.col("url"), F.lit(""))
    for code in (9, 10, 13):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.col("record_type"),
        F.lit("\r\nWARC-Record-ID: "),
        record_id(F.col("page_id")),
        F.lit("\r\nWARC-Target-URI: "),
        url,
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Payload-Digest: sha1:"),
        F.col("payload_digest"),
        F.when(
            ~response,
            F.concat(
                F.lit("\r\nWARC-Refers-To: "),
                record_id(F.col("refers_to")),
                F.lit(f"\r\nWARC-Profile: {PROFILE}"),
            ),
        ).otherwise(""),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return resolved.select(F.concat(head, block).alias("value"))


def write_archives(resolved: DataFrame, path: str) -> None:
    """Write an archive per partition of the resolved records."""
    resolved.transform(records).write.option("lineSep", "\r\n\r\n").text(path, compression="gzip")


def parse_archive(data: bytes) -> Iterator[tuple]:
    """Rows of RECORDS from the bytes of one archive, gzip or plain."""
    if data[:2] == b"\x1f\x8b":
        data = zlib.decompress(data, 31)
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = dict(line.split(": ", 1) for line in lines[1:])
        length = int(head["Content-Length"])
        block = data[end + 4 : end + 4 + length]
        at = end + 4 + length
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"record does not end at byte {at}")
        at += 4
        http, _, payload = block.partition(b"\r\n\r\n")
        number = lambda name: None if (x := head[name][10:-1]) == "none" else int(x)
        yield (
            number("WARC-Record-ID"),
            head["WARC-Type"],
            head["WARC-Payload-Digest"].removeprefix("sha1:"),
            len(payload),
            number("WARC-Refers-To") if "WARC-Refers-To" in head else None,
            head["WARC-Target-URI"],
            payload.decode("utf-8"),
        )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record; ``content_bytes`` counts the payload in the archive itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = [x.split()[0] for x in RECORDS.split(", ")]
        for batch in batches:
            for data in batch.column("content"):
                rows = []
                for row in parse_archive(data.as_py()):
                    rows.append(row)
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, RECORDS)


def archive_index(archive: DataFrame) -> DataFrame:
    """Per record its full payload's size: a revisit takes that of the response it refers to."""
    narrow = archive.select("page_id", "payload_digest", "record_type", "refers_to", "content_bytes")
    responses = narrow.filter((F.col("record_type") == "response") & F.col("page_id").isNotNull())
    sizes = responses.groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(
        F.max("content_bytes").alias("_bytes")
    )
    return narrow.join(sizes, ["refers_to", "payload_digest"], "left").select(
        "page_id",
        F.when(F.col("record_type") == "revisit", F.col("_bytes")).otherwise(F.col("content_bytes")).alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )


def deduplicated_archives(
    pages: DataFrame, path: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write all pages (page_id, url, html) as archives under ``path`` and read them back.

    An empty table gives no record. Columns other than the three take no part.
    """
    write_archives(resolve_revisits(page_payloads(pages), min_bytes, archive_bytes), path)
    return read_archives(pages.sparkSession, path)
