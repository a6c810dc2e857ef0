"""WARC archives and revisit resolution.

*Archive.* A folder of WARC files in which each record is a gzip member of its own. Records are compressed in
the tasks and written by Spark's text writer, whose line separator is an empty gzip member; so every file system
that Spark writes to will do, and writes are committed or rolled back as whole tasks. Files hold at most
``file_records`` records. Archives of others are read too, whether compressed by record, by file or not at all.

*Resolution.* Only headers are shuffled: each record's digest, length, URI, date and place (file, ordinal). Per
digest the original is the record with the largest page_id (then the last place), found by a partial maximum,
so a payload that a third of all pages share costs one row a task. Joining originals back to the headers gives
every record's fate, by digest in a join that adaptive execution can split.

*Rewriting.* The revisits of a file are one array, joined to the file by broadcast in batches of files whose arrays
take at most ``batch_bytes``: no payload is ever in an exchange. A revisit gets fresh headers that name the original
(id, URI, date) and keeps its id, date, URI and HTTP head, the payload goes; all other records, requests, metadata and
warcinfo among them, come out byte for byte.

Payloads are those of ``application/http`` responses. Records below ``min_payload`` bytes stay responses. A revisit
record of the input keeps its digest, never becomes an original, and refers to the response that the new archive
keeps; without digest, or without such a response, it stays as it is.

Edge cases: a null html is an empty payload; a null url or page_id leaves its header out and reads back as
null (a null page_id is the smallest); line ends in a url become spaces; repeated rows are records of their
own with ids of their own, of which the last place is the original; a record is held whole in a task, and its file is
read as one value, so files are limited to 2 GB; an empty table gives an archive without records; other columns
are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brandbook.llm.joins import BROADCAST_BYTES
from brandbook.session import materialise, workspace

VERSION = b"WARC/1.1"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_RECORDS = 5_000
#: Between records in a file: a gzip member of no bytes.
NOTHING = gzip.compress(b"", mtime=0)
#: Bytes of records that a task holds before it hands them on, and of gzip output at a time.
HOLD_BYTES, INFLATE_BYTES = 8 << 20, 1 << 20
HEADERS = "file bigint, ordinal bigint, record_id string, record_type string, uri string, date string, page_id bigint, payload_bytes bigint, payload_digest string, refers_to bigint"
#: Headers of a revisit that are written afresh.
FRESH = frozenset(["warc-type", "warc-profile", "warc-refers-to", "warc-refers-to-target-uri", "warc-refers-to-date", "warc-payload-digest", "warc-block-digest", "content-length", "x-refers-to-page-id"])


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: five bytes are eight digits of base 32, then the alphabet is swapped."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_urn(*identity: Column) -> Column:
    """A record id that is the same whenever a lost task runs again."""
    h = F.md5(F.concat_ws("\x1f", *(F.coalesce(c.cast("string"), F.lit("")) for c in identity)))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null."""
    clean = F.regexp_replace(value.cast("string"), "[\r\n]+", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def _http_head(payload_bytes: Column) -> Column:
    return F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), payload_bytes.cast("string"), F.lit(END))


def _write(records: DataFrame, path: str, file_records: int, mode: str = "errorifexists") -> None:
    """``records(value)``, each the bytes of a gzip member."""
    writer = records.select(F.col("value").cast("string")).write.mode(mode)
    writer.option("encoding", "ISO-8859-1").option("lineSep", NOTHING.decode("latin-1")).option("maxRecordsPerFile", file_records).text(path)


def _member(record: bytes) -> bytes:
    """A gzip member; text of pages gains little from slower levels."""
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(record) + pack.flush()


def _handed(members: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0
    for member in members:
        rows.append(member)
        held += len(member)
        if held > HOLD_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["value"])
            rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["value"])


def _pack(batches):
    for batch in batches:
        yield from _handed(_member(x.as_py()) for x in batch.column("value"))


def write_archive(pages: DataFrame, path: str, date: str, html: str = "html", url: str = "url", page_id: str = "page_id", file_records: int = FILE_RECORDS) -> None:
    """One response record for each row of ``pages``."""
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("uri"), F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"), F.monotonically_increasing_id().alias("place"))
    rows = rows.withColumn("n", F.octet_length("payload").cast("bigint")).withColumn("digest", payload_digest(F.col("payload")))
    http = _http_head(F.col("n"))
    lines = [
        _line("WARC-Type", F.lit("response")), _line("WARC-Record-ID", record_urn(F.col("page_id"), F.col("uri"), F.col("digest"), F.col("place"))), _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", F.col("uri")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), _line("X-Page-ID", F.col("page_id")), _line("Content-Type", F.lit("application/http;msgtype=response")),
        F.lit("Content-Length: "), (F.octet_length(http) + F.col("n")).cast("string"), F.lit(END),
    ]
    head = F.concat(F.lit(VERSION.decode() + "\r\n"), *lines, http).cast("binary")
    records = rows.select(F.concat(head, F.col("payload"), F.lit(END.encode())).alias("value"))
    _write(records.mapInArrow(_pack, "value binary"), path, file_records)


class _Stream:
    """Reads lines and counted bytes from gzip members or plain bytes, of which little is held inflated."""

    def __init__(self, data: bytes):
        self.data, self.at, self.buffer = memoryview(data), 0, bytearray()
        self.inflate = zlib.decompressobj(31) if data[:2] == b"\x1f\x8b" else None

    def _more(self) -> bool:
        if self.inflate is None:
            self.buffer += self.data[self.at : self.at + INFLATE_BYTES]
            self.at += INFLATE_BYTES
            return self.at - INFLATE_BYTES < len(self.data)
        if self.inflate.eof:
            self.at -= len(self.inflate.unused_data)
            self.inflate = zlib.decompressobj(31)
        source = self.inflate.unconsumed_tail
        if not source:
            source = bytes(self.data[self.at : self.at + (1 << 16)])
            self.at += len(source)
        if not source:
            return False
        self.buffer += self.inflate.decompress(source, INFLATE_BYTES)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """What comes before ``mark``, which is passed over; None at the end of the stream."""
        searched = 0
        while (found := self.buffer.find(mark, searched)) < 0:
            searched = max(0, len(self.buffer) - len(mark) + 1)
            if not self._more():
                return None
        out = bytes(self.buffer[:found])
        del self.buffer[: found + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self._more():
                raise ValueError("an archive ends within a record")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def parse_records(data: bytes) -> Iterator[tuple[list[tuple[bytes, bytes]], bytes, bytes]]:
    """(headers, block, whole record) of each record of a WARC file."""
    stream = _Stream(data)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        version, *lines = head.lstrip(b"\r\n").split(b"\r\n")
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        headers: list[tuple[bytes, bytes]] = []
        for line in lines:
            if line[:1] in (b" ", b"\t") and headers:  # a folded header
                headers[-1] = (headers[-1][0], headers[-1][1] + b" " + line.strip())
            else:
                name, _, value = line.partition(b":")
                headers.append((name.strip(), value.strip()))
        block = stream.take(int(next(v for k, v in headers if k.lower() == b"content-length")))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError("a record isn't ended by two line ends")
        yield headers, block, b"".join((head, b"\r\n\r\n", block, b"\r\n\r\n"))


def _number(value: str | bytes | None) -> int | None:
    try:
        return int(value)
    except (TypeError, ValueError):
        return None


def _http_parts(block: bytes) -> tuple[int | None, bytes, bytes]:
    """Content-Length of the HTTP headers, the headers with their end, and the payload after them."""
    head, end, payload = block.partition(b"\r\n\r\n")
    length = next((_number(v.strip()) for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")) if k.strip().lower() == b"content-length"), None)
    return length, head + end, payload


def _header_row(file: int, ordinal: int, headers: list[tuple[bytes, bytes]], block: bytes) -> tuple:
    h = {k.lower().decode("utf-8", "replace"): v.decode("utf-8", "replace") for k, v in headers}
    kind, n, digest = h.get("warc-type"), len(block), None
    if kind == "revisit":
        n = _http_parts(block)[0]
        digest = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
    elif kind == "response" and h.get("content-type", "").startswith("application/http"):
        payload = _http_parts(block)[2]
        n, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return file, ordinal, h.get("warc-record-id"), kind, h.get("warc-target-uri"), h.get("warc-date"), _number(h.get("x-page-id")), n, digest, _number(h.get("x-refers-to-page-id"))


def _read_headers(batches):
    types = [pa.int64(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.int64(), pa.string(), pa.int64()]
    names = [c.split()[0] for c in HEADERS.split(", ")]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    for batch in batches:
        for file, content in zip(batch.column("file"), batch.column("content"), strict=True):
            rows = []
            for ordinal, (headers, block, _) in enumerate(parse_records(content.as_py())):
                rows.append(_header_row(file.as_py(), ordinal, headers, block))
                if len(rows) == FILE_RECORDS:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)


def _files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).withColumn("file", F.xxhash64("path"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive: place, headers, length and digest of the payload; digests of responses are
    computed from their payloads, those of other records but revisits are null."""
    return _files(spark, path).select("file", "content").mapInArrow(_read_headers, HEADERS)


def resolve(headers: DataFrame, min_payload: int = 0) -> DataFrame:
    """``headers`` with ``fate`` (response, revisit or what else the record is) and ``original``, a struct of the record
    referred to."""
    place = F.struct("page_id", "file", "ordinal", "record_id", "uri", "date")
    able = (F.col("record_type") == "response") & F.col("payload_digest").isNotNull() & (F.col("payload_bytes") >= min_payload)
    originals = materialise(headers.where(able).groupBy(F.col("payload_digest").alias("digest")).agg(F.max(place).alias("original")), "originals")
    joined = headers.join(originals, headers.payload_digest == originals.digest, "left").drop("digest")
    own = (F.col("original.file") == F.col("file")) & (F.col("original.ordinal") == F.col("ordinal"))
    fate = F.when((F.col("record_type") == "revisit") | (F.coalesce(able, F.lit(False)) & ~own), "revisit").otherwise(F.col("record_type"))
    return joined.withColumn("fate", fate).withColumn("original", F.when(fate == "revisit", F.col("original")))


def _revisit(headers: list[tuple[bytes, bytes]], block: bytes, original: dict) -> bytes:
    """The revisit record that stands for a record or revisit of the same payload."""
    digest, http = original["digest"], _http_parts(block)[1]
    fresh = {"WARC-Type": "revisit", "WARC-Profile": PROFILE, "WARC-Refers-To": original["record_id"], "WARC-Refers-To-Target-URI": original["uri"], "WARC-Refers-To-Date": original["date"], "WARC-Payload-Digest": f"sha1:{digest}", "X-Refers-To-Page-ID": original["page_id"], "Content-Length": len(http)}
    lines = [VERSION, *(k + b": " + v for k, v in headers if k.lower().decode("utf-8", "replace") not in FRESH), *(f"{k}: {v}".encode() for k, v in fresh.items() if v is not None)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + http + b"\r\n\r\n"


def _rewrite(batches):
    def members(content: bytes, revisits: list[dict] | None):
        fates = {x["ordinal"]: x for x in revisits or ()}
        for ordinal, (headers, block, whole) in enumerate(parse_records(content)):
            yield _member(_revisit(headers, block, fates[ordinal]) if ordinal in fates else whole)

    for batch in batches:
        for content, revisits in zip(batch.column("content"), batch.column("revisits"), strict=True):
            yield from _handed(members(content.as_py(), revisits.as_py()))


def deduplicate(spark: SparkSession, source: str, target: str, min_payload: int = 0, file_records: int = FILE_RECORDS, batch_bytes: int = BROADCAST_BYTES) -> None:
    """Write to ``target`` the archive ``source`` with repeated payloads as revisits of one response."""
    fates = resolve(materialise(read_archive(spark, source), "headers"), min_payload)
    first = F.struct("ordinal", "original.record_id", "original.uri", "original.date", "original.page_id", F.col("payload_digest").alias("digest"))
    size = F.sum(128 + sum((F.coalesce(F.octet_length(f"original.{c}"), F.lit(0)) for c in ("record_id", "uri", "date")), F.lit(0)))
    by_file = fates.where("fate = 'revisit' and original is not null").groupBy("file").agg(F.collect_list(first).alias("revisits"), size.alias("size"))
    by_file = materialise(by_file, "revisits")
    total, largest, n_files = by_file.agg(F.sum("size"), F.max("size"), F.count("*")).first()
    # dealt by hash: room for a file more than the mean
    batches = max(1, min(n_files, -(-(total or 0) // max(1, batch_bytes - min(batch_bytes // 2, largest or 0)))))
    number = F.pmod("file", F.lit(batches))
    for at in range(batches):
        paths = source if batches == 1 else [r.path for r in _files(spark, source).select("path", "file").where(number == at).collect()]
        if paths:
            files = _files(spark, paths).select("file", "content")
            held = files.join(F.broadcast(by_file.where(number == at).drop("size")), "file", "left")
            _write(held.select("content", "revisits").mapInArrow(_rewrite, "value binary"), target, file_records, "append" if at else "errorifexists")


def round_trip(pages: DataFrame, date: str, min_payload: int = 0, batch_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Archive ``pages``, resolve revisits into a second archive, and read that one back."""
    spark = pages.sparkSession
    raw, clean = workspace(spark, "warc-raw"), workspace(spark, "warc")
    write_archive(pages, raw, date)
    deduplicate(spark, raw, clean, min_payload, batch_bytes=batch_bytes)
    return read_archive(spark, clean).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "uri")
