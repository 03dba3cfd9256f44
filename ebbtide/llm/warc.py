"""WARC archives: writing page captures, reading records, assembling transactions.

Writing uses Spark's text sink, with the two line ends that close a WARC record as
line separator: each row is one record, so files are archives as they stand, gzipped,
on any storage that Spark can write. Reading takes whole files, bounded when they are
written, and walks them record by record by Content-Length. Assembly groups the
records of a capture by the identifiers in WARC-Concurrent-To.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.functions.staging import new_path, stage
from ebbtide.llm.common import q

CRLF = "\r\n"
# Three records per page: bounds what one file holds.
RECORDS_PER_FILE = 6000
CAPTURE_DATE = "1970-01-01T00:00:00Z"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: each 5 hex digits are 4 base32 digits."""
    digest = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.upper(F.concat(*groups)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    pieces = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def _record(fields: list[tuple[str, Column]], block: Column) -> Column:
    """Header lines and block of one record, without the line ends that close it; null fields have no line."""
    lines = [F.lit("WARC/1.1")] + [F.concat(F.lit(f"{name}: "), value) for name, value in fields]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF), block)


def write_captures(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Write a request, a response or revisit, and a metadata record per row of ``pages``.

    Of rows with equal payloads of at least ``min_bytes`` the one with the largest id
    (ties: largest url, then any one) is the response and the others revisit it; smaller
    ones are all responses. A null payload is empty; a null id or url has no header
    line. Line ends in a url become spaces. Other columns are not read.
    """
    html = F.coalesce(F.col(q(html_col)), F.lit(""))
    rows = pages.select(
        F.col(q(id_col)).alias("page_id"), F.translate(F.col(q(url_col)), CRLF, "  ").alias("url"), html.alias("html")
    ).withColumn("digest", base32_sha1(F.col("html").cast("binary")))
    keys = rows.where(F.octet_length("html") >= min_bytes).groupBy("digest", "page_id", "url").agg(F.count("*").alias("rows"))
    top = keys.groupBy("digest").agg(F.sum("rows").alias("all_rows"), F.max(F.struct("page_id", "url", "rows")).alias("top"))
    # Only payloads that repeat; a staged table, so its true size decides how it is joined.
    repeated = stage(top.where("all_rows > 1"), "payloads")
    is_top = F.col("page_id").eqNullSafe(F.col("top.page_id")) & F.col("url").eqNullSafe(F.col("top.url"))
    joined = rows.join(repeated, "digest", "left").withColumn("is_top", is_top)
    # Rows that repeat id, url and payload of a response: one of them is taken.
    typed = joined.withColumn("revisit", F.col("top").isNotNull() & ~F.col("is_top"))
    if not repeated.where("top.rows > 1").isEmpty():
        tied = F.coalesce(F.col("is_top") & (F.col("top.rows") > 1), F.lit(False))
        first = F.row_number().over(Window.partitionBy("digest").orderBy("page_id"))
        typed = typed.where(~tied).unionByName(typed.where(tied).withColumn("revisit", first > 1))
    # The response of a repeated payload is named by the payload, so that revisits can name it.
    response_id = _uuid(F.lit("response"), F.col("digest"))
    own_id = _uuid(F.lit("capture"), F.col("page_id"), F.col("digest"), F.monotonically_increasing_id())
    named = typed.withColumn("id", F.when(F.col("top").isNotNull() & ~F.col("revisit"), response_id).otherwise(own_id))
    host = F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)
    target = F.regexp_replace(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^#]*)", 1), "^(?!/)", "/")
    shared = [("WARC-Date", F.lit(CAPTURE_DATE)), ("WARC-Target-URI", F.col("url"))]
    request = _record(
        [("WARC-Type", F.lit("request")), ("WARC-Record-ID", _uuid(F.lit("request"), F.col("id"))), ("WARC-Concurrent-To", F.col("id")), *shared,
         ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), F.coalesce(target, F.lit("/")), F.lit(" HTTP/1.1" + CRLF + "Host: "), F.coalesce(host, F.lit("")), F.lit(CRLF + CRLF)),
    )
    http = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=UTF-8" + CRLF + "Content-Length: "), F.octet_length("html").cast("string"), F.lit(CRLF + CRLF))
    capture = _record(
        [("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")), ("WARC-Record-ID", F.col("id")), *shared,
         ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
         ("WARC-Refers-To", F.when(F.col("revisit"), response_id)),
         ("WARC-Profile", F.when(F.col("revisit"), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
         ("Content-Type", F.lit("application/http; msgtype=response"))],
        F.concat(http, F.when(F.col("revisit"), "").otherwise(F.col("html"))),
    )
    metadata = _record(
        [("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _uuid(F.lit("metadata"), F.col("id"))), ("WARC-Concurrent-To", F.col("id")), *shared,
         ("Content-Type", F.lit("application/warc-fields"))],
        F.concat_ws("", F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(CRLF))),
    )
    records = named.select(F.explode(F.array(request, capture, metadata)).alias("value"))
    records.write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def parse(stream: io.BufferedIOBase):
    """(headers, block) of each record; header names in lower case."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        yield headers, stream.read(int(headers["content-length"]))


RECORD = "record_id string, type string, concurrent_to string, refers_to string, target_uri string, date string, digest string, payload_bytes long, http_head string, fields map<string, string>"


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record below ``path``: identifiers, and for captures digest, size and payload.

    ``digest`` of a response is computed from its payload and must agree with its header.
    ``with_payload=False`` reads the same but does not carry the payload on.
    """
    types = [pa.string()] * 7 + [pa.int64(), pa.string(), pa.map_(pa.string(), pa.string())] + [pa.binary()] * with_payload
    names = ["record_id", "type", "concurrent_to", "refers_to", "target_uri", "date", "digest", "payload_bytes", "http_head", "fields"] + ["payload"] * with_payload

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def read(batches):
        for files in batches:
            for content in files.column("content"):
                raw = content.as_buffer()
                stream = io.BufferedReader(gzip.GzipFile(fileobj=pa.BufferReader(raw)) if raw.to_pybytes()[:2] == b"\x1f\x8b" else pa.BufferReader(raw), 1 << 20)
                rows, held = [], 0
                for h, block in parse(stream):
                    kind = h.get("warc-type")
                    head = digest = size = payload = None
                    fields = {}
                    if kind in ("response", "revisit", "request"):
                        head, _, payload = block.partition(b"\r\n\r\n")
                        head = head.decode("utf-8", "replace")
                    if kind == "metadata":
                        lines = (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n") if x)
                        fields = {a.strip(): b.strip() for a, _, b in lines}
                    if kind in ("response", "revisit"):
                        digest = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    if kind == "response":
                        size, found = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if digest not in (None, found):
                            raise ValueError(f"payload of {h.get('warc-record-id')} does not have its digest")
                        digest = found
                    row = (h.get("warc-record-id"), kind, h.get("warc-concurrent-to"), h.get("warc-refers-to"), h.get("warc-target-uri"), h.get("warc-date"), digest, size, head, list(fields.items()))
                    rows.append((*row, payload if kind == "response" else None) if with_payload else row)
                    held += len(block) if with_payload else 0
                    if len(rows) >= 2000 or held > 1 << 24:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(read, RECORD + ", payload binary" * with_payload)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture, request, metadata (all of them).

    Request and metadata records belong to the response or revisit that their
    WARC-Concurrent-To names; records that name no capture of the input have no row.
    A capture without request has null there, without metadata an empty list.
    """
    key = F.when(F.col("type").isin("response", "revisit"), F.col("record_id")).otherwise(F.col("concurrent_to"))
    has_payload = ["payload"] if "payload" in records.columns else []
    capture = F.struct("record_id", "type", "refers_to", "target_uri", "date", "digest", "payload_bytes", "http_head", *has_payload)
    request = F.struct("record_id", "date", "http_head")
    grouped = records.where(key.isNotNull()).groupBy(key.alias("capture_id")).agg(
        F.max(F.when(F.col("type").isin("response", "revisit"), capture)).alias("capture"),
        F.max(F.when(F.col("type") == "request", request)).alias("request"),
        F.collect_list(F.when(F.col("type") == "metadata", F.struct("record_id", "date", "fields"))).alias("metadata"),
    )
    return grouped.where("capture IS NOT NULL")


def captures(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives in the run's shared folder, read them back and return one row per page.

    Columns: page_id, payload_bytes, payload_digest, record_type, refers_to, and the
    nested capture, request and metadata. An empty input gives no rows.
    """
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_captures(pages, path, min_bytes=min_bytes)
    nested = stage(assemble(read_records(spark, path, with_payload=False)), "captures")
    page_id = F.col("metadata")[0]["fields"]["page-id"].cast(pages.schema["page_id"].dataType)
    rows = nested.select(
        page_id.alias("page_id"), F.col("capture.record_id").alias("id"), F.col("capture.type").alias("record_type"),
        F.col("capture.digest").alias("payload_digest"), F.col("capture.payload_bytes").alias("bytes"), F.col("capture.refers_to").alias("of"),
        "capture", "request", "metadata",
    )
    targets = rows.where("record_type = 'response'").select(F.col("id").alias("of"), F.col("page_id").alias("refers_to"), F.col("bytes").alias("of_bytes"))
    wanted = targets.join(rows.where("of IS NOT NULL").select("of").distinct(), "of", "left_semi")
    return rows.join(wanted, "of", "left").select(
        "page_id", F.coalesce("bytes", "of_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to", "capture", "request", "metadata"
    )
