"""WARC transactions: write request, response and metadata records, join them back.

Writing. Every page gives a response record (or a revisit, where a page with
the same payload is stored already), a request and a metadata record; the
latter two name the former in WARC-Concurrent-To. Records are plain Spark text
output whose line end is the blank line that closes a WARC record, so the
files are WARC/1.0 and are written and committed by Spark itself, into the
shared folder, one folder per kind.

Reading. Files are read whole by the binary file source and cut by their
Content-Length fields (never by blank lines, which payloads may hold), so file
sizes are bounded when they are written. Assembly joins the three kinds on the
concurrent-to identifier and gives one nested row per capture. Revisits are
resolved by a join of their WARC-Refers-To with the responses.

A payload that a third of all pages share is one row of the grouped digests;
its revisits are many rows with one join key, which the engine's skew handling
splits (the other side is one row).
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weeklens.llm.common import column, settled, stage, stage_path, with_row_id

MIN_REVISIT_BYTES = 1000
FILE_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"


# --------------------------------------------------------------------- writing

def _urn(kind: str, rid: Column, page: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), rid.cast("string"), F.coalesce(page.cast("string"), F.lit("")), digest))
    cut = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cut]), F.lit(">"))


def _record(headers: list[tuple[str, Column | str | None]], block: Column) -> Column:
    """Header lines (those with a null value are left out), a blank line and the block."""
    lines = [F.lit("WARC/1.0" + CRLF)]
    for name, value in headers:
        if isinstance(value, str):
            lines.append(F.lit(f"{name}: {value}{CRLF}"))
        else:
            # a header value cannot hold a line end
            clean = F.regexp_replace(value, "[\\r\\n]+", " ")
            lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(CRLF)), F.lit("")))
    size = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF + CRLF))
    return F.concat(*lines, size, block)


def payload_groups(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> tuple[DataFrame, DataFrame]:
    """The pages with row id, payload and digest, and the shared payloads with the record that keeps each."""
    body = F.coalesce(column(pages, "html", "string"), F.lit(""))
    rows = with_row_id(settled(pages)).select(
        "_rid", column(pages, "page_id", "long").alias("page_id"), column(pages, "url", "string").alias("url"),
        body.alias("payload"), F.octet_length(body).cast("long").alias("bytes"), F.sha1(body).alias("digest"))
    shared = (rows.filter(F.col("bytes") >= min_bytes).groupBy("digest", "bytes")
              .agg(F.count(F.lit(1)).alias("rows"), F.max(F.struct("page_id", "_rid")).alias("first"))
              .filter("rows > 1").select("digest", "bytes", "first"))
    return rows, shared


def write_archive(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES, file_bytes: int = FILE_BYTES) -> None:
    """Write the records of all pages below ``path`` (folders response, request, metadata).

    Of pages with equal payloads of at least ``min_bytes`` bytes, the one with the largest page_id (of ties,
    the last in the scan; null ids rank lowest) is the response, the others are revisits of it. A null html
    is an empty payload, a null url has no target line, a null page_id no field.
    """
    rows, shared = payload_groups(pages, min_bytes)
    # written first: the engine then knows its size and sends it to all tasks only if it is small
    shared = stage(shared, "shared-payloads")
    rows = rows.join(shared, ["digest", "bytes"], "left")
    own = _urn("response", F.col("_rid"), F.col("page_id"), F.col("digest"))
    kept = F.col("first").isNull() | (F.col("first._rid") == F.col("_rid"))
    origin = _urn("response", F.col("first._rid"), F.col("first.page_id"), F.col("digest"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(CRLF + CRLF))
    response = _record([
        ("WARC-Type", F.when(kept, "response").otherwise("revisit")), ("WARC-Record-ID", own), ("WARC-Date", DATE),
        ("WARC-Target-URI", F.col("url")), ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Profile", F.when(~kept, "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")),
        ("WARC-Refers-To", F.when(~kept, origin)), ("Content-Type", "application/http; msgtype=response")],
        F.when(kept, F.concat(http, F.col("payload"))).otherwise(http))
    host = F.coalesce(F.regexp_extract("url", "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#\\s]*)", 1), F.lit(""))
    place = F.coalesce(F.regexp_replace(F.regexp_replace("url", "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#\\s]*", ""),
                                        "\\s", "%20"), F.lit("/"))
    get = F.concat(F.lit("GET "), F.when(place == "", "/").otherwise(place), F.lit(f" HTTP/1.1{CRLF}Host: "), host,
                   F.lit(CRLF + CRLF))
    request = _record([
        ("WARC-Type", "request"), ("WARC-Record-ID", _urn("request", F.col("_rid"), F.col("page_id"), F.col("digest"))),
        ("WARC-Date", DATE), ("WARC-Target-URI", F.col("url")), ("WARC-Concurrent-To", own),
        ("Content-Type", "application/http; msgtype=request")], get)
    fields = F.concat(F.coalesce(F.concat(F.lit("page_id: "), F.col("page_id").cast("string"), F.lit(CRLF)), F.lit("")),
                      F.lit("payload-length: "), F.col("bytes").cast("string"), F.lit(CRLF))
    metadata = _record([
        ("WARC-Type", "metadata"), ("WARC-Record-ID", _urn("metadata", F.col("_rid"), F.col("page_id"), F.col("digest"))),
        ("WARC-Date", DATE), ("WARC-Target-URI", F.col("url")), ("WARC-Concurrent-To", own),
        ("Content-Type", "application/warc-fields")], fields)

    sizes = pages.select(F.octet_length(column(pages, "html", "string")).alias("n")).agg(F.avg("n"), F.max("n")).first()
    usual, largest = max(2048.0, sizes[0] or 0.0), max(2048, sizes[1] or 0)

    def write(frame: DataFrame, value: Column, folder: str, per_file: float, mode: str = "errorifexists"):
        (frame.select(value.alias("value")).write.mode(mode).option("lineSep", CRLF + CRLF)
         .option("maxRecordsPerFile", max(1, int(per_file))).text(f"{path}/{folder}"))

    # pages far above the mean go to files of their own, so that no file is much larger than file_bytes
    long = F.col("bytes") > 16 * usual
    write(rows.filter(~long), response, "response", file_bytes / usual)
    if largest > 16 * usual:
        write(rows.filter(long), response, "response", file_bytes / largest, "append")
    write(rows, request, "request", file_bytes / 2048)
    write(rows, metadata, "metadata", file_bytes / 2048)


# --------------------------------------------------------------------- reading

RECORD = ("record_id string, type string, concurrent_to string, refers_to string, target_uri string, date string, "
          "digest string, payload_bytes long, payload_sha1 string, page_id long, block binary")
_NAMES = [c.split()[0] for c in RECORD.split(", ")]


def _records(content: memoryview):
    """(headers, block) of each record of one archive file."""
    data, at = content.obj, 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {}
        for line in data[at:end].decode("utf-8").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            headers[name.lower()] = value.strip()
        size = int(headers["content-length"])
        yield headers, content[end + 4:end + 4 + size]
        at = end + 4 + size + 4


def _parse(with_blocks: bool):
    def row(headers, block):
        kind, page, payload = headers["warc-type"], None, None
        if kind in ("response", "revisit"):
            raw = bytes(block)
            payload = memoryview(raw)[raw.find(b"\r\n\r\n") + 4:]
        elif headers.get("content-type") == "application/warc-fields":
            for line in bytes(block).decode("utf-8").split("\r\n"):
                name, _, value = line.partition(":")
                if name == "page_id":
                    page = int(value)
        held = payload is not None and kind == "response"
        return (headers["warc-record-id"], kind, headers.get("warc-concurrent-to"), headers.get("warc-refers-to"),
                headers.get("warc-target-uri"), headers.get("warc-date"),
                headers.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                len(payload) if held else None, hashlib.sha1(payload).hexdigest() if held else None, page,
                bytes(payload if held else block) if with_blocks else None)

    schema = pa.schema([(n, {"payload_bytes": pa.int64(), "page_id": pa.int64(), "block": pa.binary()}.get(n, pa.string()))
                        for n in _NAMES])

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for headers, block in _records(memoryview(content.as_py())):
                    rows.append(row(headers, block))
                    held += len(rows[-1][-1] or b"")
                    if len(rows) == 4096 or held > 16 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return run


def read_records(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """Records of the archive files in folder ``path``; block is the payload of a response, else the whole
    block (null unless ``blocks``)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(_parse(blocks), RECORD)


def assemble(responses: DataFrame, requests: DataFrame, metadata: DataFrame) -> DataFrame:
    """One nested row per capture: record_id, page_id, response, request, metadata (the latter two null if
    the archive has none; of several, the one with the least record id). Requests and metadata that name no
    capture belong to none and give no row. The arguments may be one and the same mixed set of records."""

    def side(df, kind, *names):
        one = df.filter(F.col("type") == kind).groupBy("concurrent_to").agg(
            F.min(F.struct("record_id", *names)).alias(kind))
        return one

    r = responses.filter(F.col("type").isin("response", "revisit"))
    response = F.struct("record_id", "type", "refers_to", "target_uri", "date", "digest", "payload_bytes",
                        "payload_sha1", F.col("block").alias("payload")).alias("response")
    req = side(requests, "request", "target_uri", "date", "block")
    meta = side(metadata, "metadata", "page_id", "block")
    return (r.select("record_id", response)
            .join(req, F.col("record_id") == req["concurrent_to"], "left").drop("concurrent_to")
            .join(meta, F.col("record_id") == meta["concurrent_to"], "left").drop("concurrent_to")
            .withColumn("page_id", F.col("metadata.page_id"))
            .select("record_id", "page_id", "response", "request", "metadata"))


def read_captures(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """The captures of an archive written by ``write_archive``."""
    return assemble(*(read_records(spark, f"{path}/{k}", blocks) for k in ("response", "request", "metadata")))


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """Per capture: page_id, payload_bytes, payload_digest, record_type, refers_to (page_id of the response a
    revisit names), request_uri, request_id and metadata_id (of the records joined to it; null if the archive has
    none). Size and digest of a revisit are those of the payload it refers to, as read."""
    joined = ["request_uri", "request_id", "metadata_id"]
    rows = stage(captures.select(
        "record_id", "page_id", F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("to"),
        F.col("response.payload_bytes").alias("bytes"), F.col("response.payload_sha1").alias("sha1"),
        F.col("request.target_uri").alias("request_uri"), F.col("request.record_id").alias("request_id"),
        F.col("metadata.record_id").alias("metadata_id")), "captures")
    origin = rows.filter("record_type = 'response'").select(
        F.col("record_id").alias("to"), F.col("page_id").alias("refers_to"), F.col("bytes").alias("payload_bytes"),
        F.col("sha1").alias("payload_digest"))
    stored = rows.filter("record_type = 'response'").select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("sha1").alias("payload_digest"), "record_type",
        F.lit(None).cast("long").alias("refers_to"), *joined)
    again = rows.filter("record_type = 'revisit'").join(origin, "to", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", *joined)
    return stored.unionByName(again)


def archive_roundtrip(pages: DataFrame, blocks: bool = False) -> DataFrame:
    """Write the pages' archive to the shared folder, read its three kinds of records back, join them and resolve
    the revisits (see the functions above). An empty table gives an empty result."""
    path = stage_path(pages.sparkSession, "warc")
    write_archive(pages, path)
    return resolve_revisits(read_captures(pages.sparkSession, path, blocks))
