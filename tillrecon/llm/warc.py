"""WARC archives: writing, and reading back with segment reassembly.

Writing: one record per page. Of equal payloads, the page with the largest id is a response, the others are
revisits of it. A response is an HTTP message with chunked transfer framing; blocks longer than
``segment_bytes`` are cut into a first segment and continuation records. Spark's text writer writes the
records, with the two line ends that close a record as separator, so each file is a gzipped WARC archive.

Reading: archives are parsed file by file along their content lengths. Continuation records are grouped by the
identifier of their origin, ordered by segment number, joined and held against the total length that the
last one declares: within the archive first, and by a shuffle where the segments of a record are spread over
archives. The chunked framing is then decoded and the payload held against its digest. A revisit takes its payload from the response that it refers to.

Defined cases: a null payload is an empty one; empty payloads are equal payloads too; a page without an id is a response
of its own; rows with equal id and payload are responses both if their id is the largest. Segments that are missing or do not add up, broken framing and
wrong digests fail the read. A payload of any length is cut into segments; an empty table makes archives without
records. Only the named columns are read; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillrecon.llm.common import Buffer, new_folder, rows_of, settings, stage, unstage

#: Bytes of a block in one record, of a chunk within it; records of one archive. Most pages are longer than a segment.
SEGMENT_BYTES, CHUNK_BYTES, FILE_RECORDS = 2 << 10, 8 << 10, 2000
_END = "\r\n\r\n"


def digest(payload: bytes) -> str:
    """SHA-1 in base 32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def pieces(data: bytes, size: int) -> Iterator[bytes]:
    """Cuts of at most ``size`` bytes; none within a UTF-8 character, since archives are written as text."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[at:end]
        at = end


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(p), p) for p in pieces(payload, size)]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """Payload of a chunked body; an error if its framing is broken."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            raise ValueError("chunk without a size")
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            # Trailer fields may follow, up to an empty line.
            if not body.endswith(b"\r\n", at):
                raise ValueError("chunked body without an end")
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk of another length than it says")
        out.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """Payload of an HTTP message, chunked or not."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("HTTP message without a header's end")
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:.*\bchunked\b", head) else body


# ---------------------------------------------------------------- writing

_RECORD = pa.schema([("value", pa.string())])


def _record(headers: list[tuple[str, str]], block: bytes) -> str:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return f"WARC/1.1\r\n{lines}\r\n{block.decode()}"


def _uri(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


def _write(segment_bytes: int):
    def run(batches):
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            out = Buffer(_RECORD, 4 << 20)
            for page_id, url, html, refers_to, refers_uri, sha in rows_of(batch):
                n += 1
                me = f"<urn:record:{task}-{n}>"
                uri = _uri(url)
                page = [] if page_id is None else [("WARC-Page-ID", str(page_id))]
                common = [("WARC-Target-URI", uri), *page, ("WARC-Date", "2024-01-01T00:00:00Z")]
                shown = ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(sha)).decode())
                http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
                if refers_to is not None:
                    headers = [("WARC-Type", "revisit"), ("WARC-Record-ID", me), *common, shown, ("WARC-Refers-To-Target-URI", _uri(refers_uri)), ("WARC-Refers-To-Date", "2024-01-01T00:00:00Z"), ("WARC-Refers-To-Page", str(refers_to))]
                    out.add(_record([*headers, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")], http), weight=len(http))
                    continue
                block = http + chunked((html or "").encode())
                parts = list(pieces(block, segment_bytes))
                for i, part in enumerate(parts, 1):
                    segment = [("WARC-Segment-Number", str(i))] if len(parts) > 1 else []
                    if i == 1:
                        headers = [("WARC-Type", "response"), ("WARC-Record-ID", me), *common, shown, ("Content-Type", "application/http;msgtype=response"), *segment]
                    else:
                        headers = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{me[:-1]}-{i}>"), *common, ("WARC-Segment-Origin-ID", me), *segment]
                        if i == len(parts):
                            headers.append(("WARC-Segment-Total-Length", str(len(block))))
                    out.add(_record(headers, part), weight=len(part))
                if out.full():
                    yield out.take()
            yield out.take()

    return run


def write_archives(pages: DataFrame, folder: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as WARC files into ``folder``."""
    html = F.coalesce(pages["html"], F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.sha1(html.cast("binary")).alias("sha"))
    # Only payloads of several pages need a look-up. It is written first: where it is small, Spark then
    # brings it to the pages instead of moving these.
    same = rows.groupBy("sha").agg(F.count("page_id").alias("n"), F.max("page_id").alias("last"), F.max_by("url", "page_id").alias("last_url"))
    same = same.where("n > 1").select("sha", "last", "last_url")
    same = stage(same, "same")
    rows = rows.join(same, "sha", "left")
    refers = F.when(F.col("last") > F.col("page_id"), F.col("last"))
    records = rows.select("page_id", "url", "html", refers.alias("refers_to"), "last_url", "sha").mapInArrow(_write(segment_bytes), "value string")
    with settings(pages.sparkSession):
        records.write.option("lineSep", _END).option("maxRecordsPerFile", FILE_RECORDS).option("compression", "gzip").text(folder)
    unstage(same)


# ---------------------------------------------------------------- reading

#: A record, or the segment of one (then with its origin); the block is null once its payload is decoded.
_PARSED = pa.schema(
    [
        ("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("kind", pa.string()), ("page_id", pa.int64()),
        ("digest", pa.string()), ("refers_to", pa.int64()), ("block", pa.binary()), ("payload", pa.binary()),
    ]
)
_PARSED_TYPE = "origin string, segment int, total long, kind string, page_id long, digest string, refers_to long, block binary, payload binary"


def records_of(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, block) of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or end < 0:
            raise ValueError(f"no record at byte {at}")
        headers = {}
        for line in data[at:end].decode().split("\r\n")[1:]:
            k, _, v = line.partition(":")
            headers[k.strip().lower()] = v.strip()
        size = int(headers["content-length"])
        block = data[end + 4 : end + 4 + size]
        if len(block) != size or data[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut short")
        yield headers, block
        at = end + 8 + size


def _number(headers: dict[str, str], name: str) -> int | None:
    return int(headers[name]) if name in headers else None


def _checked(payload: bytes, shown: str) -> bytes:
    if digest(payload) != shown:
        raise ValueError(f"payload does not have the digest {shown}")
    return payload


def joined(origin: str, parts: list[tuple[int, int | None, bytes]], shown: str) -> bytes:
    """Payload of segments (number, total length or None, block) in order; an error if they are not whole."""
    numbers = [n for n, _, _ in parts]
    if numbers != list(range(1, len(parts) + 1)):
        raise ValueError(f"segments of {origin} are {numbers}")
    block = b"".join([b for _, _, b in parts])
    if parts[-1][1] != len(block):
        raise ValueError(f"{origin} has {len(block)} bytes instead of {parts[-1][1]}")
    return _checked(http_payload(block), shown)


def _parse(batches):
    """Records of each archive. Segments that are all in it are joined there, so that only the others are moved."""
    for batch in batches:
        for content in batch.column(0):
            out = Buffer(_PARSED, 4 << 20)
            data = content.as_buffer().to_pybytes()
            pending: dict[str, list[tuple]] = {}
            for h, block in records_of(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
                kind, segment = h["warc-type"], _number(h, "warc-segment-number")
                origin = h.get("warc-segment-origin-id", h["warc-record-id"]) if segment else None
                shown = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
                payload = _checked(http_payload(block), shown) if kind == "response" and not segment else None
                row = (
                    origin, segment, _number(h, "warc-segment-total-length"), kind, _number(h, "warc-page-id"), shown,
                    _number(h, "warc-refers-to-page"), block if segment else None, payload,
                )
                if segment:
                    pending.setdefault(origin, []).append(row)
                else:
                    out.add(*row, weight=len(block) + 100)
                if out.full():
                    yield out.take()
            for origin, rows in pending.items():
                rows.sort(key=lambda r: r[1])
                if rows[0][1] == 1 and rows[-1][2] is not None and len(rows) == rows[-1][1]:
                    first = rows[0]
                    payload = joined(origin, [(r[1], r[2], r[7]) for r in rows], first[5])
                    rows = [(None, None, None, first[3], first[4], first[5], first[6], None, payload)]
                for row in rows:
                    out.add(*row, weight=len(row[7] or row[8] or b"") + 100)
                if out.full():
                    yield out.take()
            yield out.take()


def _reassemble(batches):
    """Rows (page_id, digest, segments) -> (page_id, digest, payload)."""
    schema = pa.schema([("page_id", pa.int64()), ("digest", pa.string()), ("payload", pa.binary())])
    for batch in batches:
        out = Buffer(schema, 4 << 20)
        for origin, page_id, shown, parts in rows_of(batch):
            payload = joined(origin, [(p["segment"], p["total"], p["block"]) for p in parts], shown)
            out.add(page_id, shown, payload, weight=len(payload))
            if out.full():
                yield out.take()
        yield out.take()


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload, payload_digest, record_type, refers_to of the archives' responses and revisits."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    parsed = stage(files.select("content").mapInArrow(_parse, _PARSED_TYPE), "records")
    segments = parsed.where("origin is not null").groupBy("origin").agg(
        F.max("page_id").alias("page_id"), F.max("digest").alias("digest"),
        F.array_sort(F.collect_list(F.struct("segment", "total", "block"))).alias("parts"),  # one payload's own size
    )
    whole = segments.mapInArrow(_reassemble, "page_id long, digest string, payload binary")
    responses = parsed.where("origin is null and kind = 'response'").select("page_id", "digest", "payload").union(whole)
    # Written, so that Spark knows how few or many payloads are needed once more.
    revisits = stage(parsed.where("kind = 'revisit'").select("page_id", "digest", "refers_to"), "revisits")
    referred = responses.join(revisits.select(F.col("refers_to").alias("page_id"), "digest").distinct(), ["page_id", "digest"], "left_semi")
    referred = referred.groupBy(F.col("page_id").alias("refers_to"), "digest").agg(F.first("payload").alias("payload"))
    revisits = revisits.join(referred, ["refers_to", "digest"], "left")
    missing = F.raise_error(F.concat(F.lit("no response for the revisit of page "), F.col("refers_to").cast("string")))
    payload = F.when(F.col("payload").isNull(), missing.cast("binary")).otherwise(F.col("payload"))
    return responses.select("page_id", "payload", F.col("digest").alias("payload_digest"), F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to")).union(
        revisits.select("page_id", payload, "digest", F.lit("revisit"), "refers_to")
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_archives(spark, folder).select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )


OP8_SQL = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages
), firsts AS (
  SELECT h, max(page_id) AS last FROM hashed GROUP BY h
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((('0x' || substr(h, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN last > page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN last > page_id THEN last END AS refers_to
FROM hashed JOIN firsts USING (h)
"""
