"""WARC archives: a writer of one gzip member for each record, and a salvage reader.

Writer. Each page becomes a ``response`` record (HTTP header and payload), or a
``revisit`` if a page with an equal payload and a smaller id is the response.
Archives are plain ``.warc.gz`` contents, written by Spark's text writer: the
last byte of a gzip member is the top byte of its length, which is zero as long
as a member holds less than 16 MB (longer records take several members), so
that byte serves as the writer's line separator and the files are the members
end to end.

Salvage reader. At each place it takes a gzip member, or a version line of an
archive that is not compressed, and checks it: the stream's own checksum, version line, headers,
length, closing line ends, block and payload digests. After a failed check it
searches on for the next member or version line whose record is valid, goes
on there, and logs the bytes between as a gap with the failed check. No record behind
damage is lost, and no byte goes unaccounted for: records and gaps tile a file.

Defined results: a null html is an empty payload; a null page_id makes a record
without an id, never one that others refer to unless all ids of that payload
are null (then all are responses); rows that repeat the smallest id are all
responses; a null url has no target line; an empty table gives no archives.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.session import materialize, scratch_path

DATE = "1970-01-01T00:00:00Z"  # pages carry no time
RECORDS_PER_FILE = 1000
MEMBER = 1 << 23  # raw bytes of a gzip member
FEED = 1 << 16
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _b32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record(page_id: int | None, url: str | None, payload: bytes, sha1: bytes, refers_to: int | None) -> bytes:
    """A WARC record; a revisit (``refers_to`` given) has the HTTP header without the payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if refers_to is None:
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {DATE}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <urn:x-page:{page_id}>")
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:x-page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += [
        f"WARC-Payload-Digest: sha1:{_b32(sha1)}", f"WARC-Block-Digest: sha1:{_b32(hashlib.sha1(block).digest())}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def members(raw: bytes) -> bytes:
    """The record as gzip members; the last byte is zero."""
    out = []
    for a in range(0, len(raw), MEMBER):
        c = zlib.compressobj(6, zlib.DEFLATED, 31)
        out.append(c.compress(raw[a : a + MEMBER]) + c.flush())
    return b"".join(out)


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE) -> None:
    """One record for each page; payloads of ``min_bytes`` and more are stored once."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    # only payloads that occur again: few and narrow, so the join seldom moves the pages
    again = rows.filter(F.length("payload") >= min_bytes).groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    again = again.filter("n > 1 AND first IS NOT NULL").select(F.col("sha").alias("same"), "first")
    rows = rows.join(again, (F.col("sha") == F.col("same")) & (F.length("payload") >= min_bytes), "left")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, len(b), 256):
                part = b.slice(a, 256)
                columns = (c.to_pylist() for c in part.columns)
                done = [members(record(i, u, p, bytes.fromhex(s), f))[:-1] for i, u, p, s, f in zip(*columns, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(done, pa.binary())], names=["member"])

    built = rows.select("page_id", "url", "payload", "sha", refers_to.alias("refers_to")).mapInArrow(run, "member binary")
    lines = built.select(F.col("member").cast("string").alias("value"))
    lines.write.mode("overwrite").option("lineSep", "\0").option("maxRecordsPerFile", records_per_file).text(path)


# ------------------------------------------------------------------ reading
class Damage(Exception):
    """A check that failed."""


def _member(data: memoryview, at: int) -> tuple[bytes, int]:
    """Contents of the gzip member at ``at`` and the place behind it."""
    d, parts, p = zlib.decompressobj(31), [], at
    try:
        while not d.eof:
            if p >= len(data):
                raise Damage("truncated member")
            parts.append(d.decompress(data[p : p + FEED]))
            p += FEED
    except zlib.error as e:
        raise Damage("member checksum" if "check" in str(e) else "member stream") from e
    return b"".join(parts), min(p, len(data)) - len(d.unused_data)


_LINE = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)")


def _headers(head: bytes) -> dict[str, str]:
    return {k.decode("utf-8", "replace").lower(): v.decode("utf-8", "replace") for k, v in _LINE.findall(head)}


def _parse(raw: bytes) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and size of the record that ``raw`` begins with."""
    if not raw.startswith((b"WARC/1.0\r\n", b"WARC/1.1\r\n")):
        raise Damage("version line")
    cut = raw.find(b"\r\n\r\n")
    if cut < 0:
        raise Damage("headers")
    head = _headers(raw[:cut])
    if not head.get("content-length", "").isdigit() or "warc-type" not in head:
        raise Damage("headers")
    n = int(head["content-length"])
    if len(raw) < cut + 4 + n + 4:
        raise Damage("length")
    block = raw[cut + 4 : cut + 4 + n]
    if raw[cut + 4 + n : cut + 8 + n] != b"\r\n\r\n":
        raise Damage("closing line ends")
    if "warc-block-digest" in head and head["warc-block-digest"] != f"sha1:{_b32(hashlib.sha1(block).digest())}":
        raise Damage("block digest")
    return head, block, cut + 8 + n


def _record_at(data: memoryview, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end place of the valid record at ``at``; raises Damage."""
    if bytes(data[at : at + 3]) == MAGIC:
        raw, end = _member(data, at)
        while True:
            try:
                head, block, size = _parse(raw)
            except Damage as e:
                if str(e) not in ("length", "headers") or not raw.startswith(b"WARC/1.") or bytes(data[end : end + 3]) != MAGIC:
                    raise
                more, after = _member(data, end)  # a long record goes on in the next member
                if more.startswith(b"WARC/1."):
                    raise
                raw, end = raw + more, after
                continue
            if size != len(raw):
                raise Damage("bytes behind the record")
            break
    elif bytes(data[at : at + 5]) == b"WARC/":
        ahead = bytes(data[at : at + FEED])
        size = re.search(rb"\r\ncontent-length:[ \t]*(\d+)\r\n", ahead[: ahead.find(b"\r\n\r\n") + 4], re.I)
        head, block, n = _parse(bytes(data[at : at + FEED + (int(size[1]) if size else 0)]))
        end = at + n
    else:
        raise Damage("neither a member nor a version line")
    if head["warc-type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if head.get("warc-payload-digest", "").startswith("sha1:") and head["warc-payload-digest"][5:] != _b32(hashlib.sha1(payload).digest()):
            raise Damage("payload digest")
    return head, block, end


_NEXT = re.compile(rb"\x1f\x8b\x08|(?<=\n)WARC/1\.")


def salvage(content: bytes) -> Iterator[tuple]:
    """(offset, end, headers, block, None) of each record, (offset, end, None, None, reason) of each gap, in order."""
    data, at = memoryview(content), 0
    while at < len(data):
        try:
            head, block, end = _record_at(data, at)
            yield at, end, head, block, None
            at = end
            continue
        except Damage as e:
            reason, stop = str(e), len(data)
        for m in _NEXT.finditer(content, at + 1):
            try:
                _record_at(data, m.start())
            except Damage:
                continue
            stop = m.start()
            break
        yield at, stop, None, None, reason
        at = stop


SCHEMA = (
    "archive string, offset bigint, length bigint, gap string, record_type string, record_id string, refers_to string, "
    "target_uri string, payload_digest string, payload_bytes bigint, payload binary"
)
_ARROW = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]
_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def _row(archive: str, at: int, end: int, head: dict[str, str] | None, block: bytes | None, gap: str | None, payloads: bool) -> tuple:
    if head is None:
        return archive, at, end - at, gap, *[None] * 7
    http, _, payload = block.partition(b"\r\n\r\n")
    if head["warc-type"] == "revisit":  # the response's own header tells the size of the payload
        size = _headers(http).get("content-length", "0")
        payload, n = None, int(size) if size.isdigit() else None
    else:
        n = len(payload)
    digest = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
    ids = (head.get(k) for k in ("warc-record-id", "warc-refers-to"))
    return archive, at, end - at, None, head["warc-type"], *ids, head.get("warc-target-uri"), digest, n, payload if payloads else None


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and gaps of all archives under ``path`` (``gap`` is null for a record, else the failed check)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for archive, content in zip(b.column(0), b.column(1), strict=True):
                rows = []
                for found in salvage(content.as_py()):
                    rows.append(_row(archive.as_py(), *found, payloads))
                    if len(rows) == 256:
                        yield _batch(rows)
                        rows = []
                yield _batch(rows)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in _ARROW]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ARROW, strict=True)], names=_NAMES)


def recovered(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives at ``path`` without payloads; quarantined byte gaps are logged as a table at ``path``-gaps."""
    read = materialize(read_archives(spark, path, payloads=False), "warc-records")
    read.filter("gap IS NOT NULL").select("archive", "offset", "length", "gap").write.mode("overwrite").parquet(f"{path}-gaps")
    return read.filter("gap IS NULL")


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the archives and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, min_bytes)
    page = lambda c: F.regexp_extract(c, r"^<urn:x-page:(-?\d+)>$", 1).try_cast("bigint")
    return recovered(spark, path).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to")
    )
