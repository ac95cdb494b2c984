"""WARC archives in ZIP packages: written by Spark, read by byte ranges without extraction.

A package is a ZIP file with one stored (not compressed) WARC member and its index, as one task writes them;
its directory has ZIP64 records throughout, so neither members nor packages end at 4 GB. The reader
takes any such package, also with several members, without an index or with gzip members: it reads
directories from the ends of the files, then index members (or, where there is none, the heads of the records), and
deals the byte ranges of the records out to all tasks. Nothing but the ranges asked for is read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contractflow.llm.store import written

# Signatures and record layouts of the ZIP format.
LOCAL, CENTRAL, END, END64, LOCATOR, DESCRIPTOR = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50, 0x08074B50
LOCAL_HEAD, CENTRAL_HEAD = struct.Struct("<IHHHHHIIIHH"), struct.Struct("<IHHHHHHIIIHHHHHII")
END_RECORD, END64_RECORD, LOCATOR_RECORD = struct.Struct("<IHHHHIIH"), struct.Struct("<IQHHIIQQQQ"), struct.Struct("<IIQI")
FULL32, ZIP64, STREAMED = 0xFFFFFFFF, 1, 8
DOS_DATE = (1 << 5) | 1  # 1980-01-01

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
RANGE = 8 << 20
HEAD = 1 << 16  # bytes read at a time where heads are looked for
SENT_DIGESTS = 500_000  # of about sixty bytes each


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: object) -> str:
    """The id of a page's record. No page has an empty one; an empty id is a lone percent sign, which no other contains."""
    return f"<urn:page:{'' if page is None else header_value(str(page)) or '%'}>"


def page_of(column: str) -> Column:
    """The id, as text, of the page that a record id was made from; null for a null page."""
    name = F.regexp_extract(column, "(?s)^<urn:page:(.*)>$", 1)
    return F.when(name == "%", F.lit("")).when(name != "", F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))))


def header_value(text: str) -> str:
    """A value that stays on its line."""
    return re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", text)


def plain_value(text: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), text)


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page: str | None, url: str | None, payload: bytes, refers_to: str | None, revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", header_value(url)))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    return record(fields, http if revisit else http + payload)


# writing


def local_header(name: bytes) -> bytes:
    """Sizes and checksum follow the data, in a descriptor; an empty ZIP64 field says they have eight bytes."""
    extra = struct.pack("<HHQQ", ZIP64, 16, 0, 0)
    return LOCAL_HEAD.pack(LOCAL, 45, STREAMED, 0, 0, DOS_DATE, 0, FULL32, FULL32, len(name), len(extra)) + name + extra


def descriptor(crc: int, size: int) -> bytes:
    return struct.pack("<IIQQ", DESCRIPTOR, crc, size, size)


def central_header(name: bytes, crc: int, size: int, at: int) -> bytes:
    extra = struct.pack("<HHQQQ", ZIP64, 24, size, size, at)
    return CENTRAL_HEAD.pack(CENTRAL, 45, 45, STREAMED, 0, 0, DOS_DATE, crc, FULL32, FULL32, len(name), len(extra), 0, 0, 0, 0, FULL32) + name + extra


def directory(members: list[tuple[bytes, int, int, int]], at: int, comment: bytes) -> bytes:
    """The central directory of (name, checksum, size, offset), with its ZIP64 end and the plain end."""
    body = b"".join(central_header(*m) for m in members)
    n, stop = len(members), at + len(body)
    ends = END64_RECORD.pack(END64, 44, 45, 45, 0, 0, n, n, len(body), at) + LOCATOR_RECORD.pack(LOCATOR, 0, stop, 1)
    return body + ends + END_RECORD.pack(END, 0, 0, 0xFFFF, 0xFFFF, FULL32, FULL32, len(comment)) + comment


def package(records: Iterator[bytes]) -> Iterator[bytes]:
    """The bytes of a package, in pieces that each end with a line feed; the index stays in memory (about
    twenty bytes a record)."""
    first = record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("info")), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"software: contractflow\r\n")
    head = local_header(b"archive/data.warc")
    crc, size, index = zlib.crc32(first), len(first), []
    yield head + first
    for one in records:
        index.append(b"%d %d\n" % (size, len(one)))
        crc, size = zlib.crc32(one, crc), size + len(one)
        yield one
    members = [(b"archive/data.warc", crc, size, 0)]
    lines = b"offset length\n" + b"".join(index)
    tail = descriptor(crc, size)
    at = len(head) + size + len(tail)
    second = local_header(b"indexes/index.txt")
    yield tail + second + lines
    members.append((b"indexes/index.txt", zlib.crc32(lines), len(lines), at))
    tail = descriptor(zlib.crc32(lines), len(lines))
    yield tail + directory(members, at + len(second) + len(lines) + len(tail), b"\n")


def write_packages(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write a package per partition into the folder ``path``, through Spark's own writer and committer.

    Of pages with equal payloads that with the smallest page_id becomes a response, the others revisit it.
    A null html is an empty payload. A null page_id comes after all others: it revisits a page that has one,
    and among themselves such pages are all responses. Rows that repeat a page_id with its payload are
    one capture and are all responses if that page_id is the smallest. A null url has no target.

    Payloads that occur twice or more are known by their digests. Up to ``SENT_DIGESTS`` of them are sent to
    all tasks, so that no payload is shuffled; more are joined, where adaptive execution splits a hot one.
    """
    rows = pages.select(F.col(f"`{page_id}`").alias("page"), F.col(f"`{url}`").cast("string").alias("url"), F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("key", F.unhex(F.sha2("payload", 256)))
    repeated = rows.groupBy("key").agg(F.min("page").alias("first"), F.count("*").alias("held")).where("held > 1")
    repeated = written(repeated, "digests")
    known = rows.join(F.broadcast(repeated) if repeated.count() <= SENT_DIGESTS else repeated, "key", "left")
    again = F.col("held").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    known = known.select(F.col("page").cast("string"), "url", "payload", F.col("first").cast("string"), again.alias("again"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for r in zip(*[batch.column(i) for i in range(5)], strict=True):
                    page, link, payload, first, again = (x.as_py() for x in r)
                    yield page_record(page, link, payload.encode(), first, again)

        held, size = [], 0
        for piece in package(records()):
            held.append(piece[:-1])  # the writer ends every row with the line feed
            size += len(piece)
            if size > RANGE:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["bytes"])
                held, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["bytes"])

    packed = known.mapInArrow(run, "bytes binary").select(F.col("bytes").cast("string").alias("value"))
    packed.write.option("lineSep", "\n").option("compression", "none").text(path)


# reading


def opened(path: str) -> pa.NativeFile:
    system, inner = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return system.open_input_file(inner)


def read_range(file: pa.NativeFile, start: int, size: int) -> bytes:
    file.seek(start)
    return file.read(size)


def zip64_values(extra: bytes, wanted: list[int]) -> list[int]:
    """The values that are all ones in a directory entry, from its ZIP64 field."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == ZIP64:
            wide = list(struct.unpack_from(f"<{min(size // 8, 3)}Q", extra, at + 4))
            return [wide.pop(0) if x == FULL32 and wide else x for x in wanted]
        at += 4 + size
    return wanted


def members(file: pa.NativeFile, size: int) -> Iterator[tuple[str, int, int, int]]:
    """(name, compression method, first byte, size) of each member, from the directory at the end.

    A comment that happens to hold a signature is told apart by its length; bytes after the comment's
    end are not allowed. Raises ValueError if the file is no ZIP file.
    """
    tail_at = max(0, size - END_RECORD.size - 0xFFFF)
    tail = read_range(file, tail_at, size - tail_at)
    at = tail.rfind(struct.pack("<I", END))
    while at >= 0 and (at + END_RECORD.size > len(tail) or at + END_RECORD.size + END_RECORD.unpack_from(tail, at)[7] != len(tail)):
        at = tail.rfind(struct.pack("<I", END), 0, at)
    if at < 0:
        raise ValueError("no end of a ZIP directory")
    *_, count, length, start, _ = END_RECORD.unpack_from(tail, at)
    if 0xFFFF == count or FULL32 in (length, start):
        locator = read_range(file, max(0, tail_at + at - LOCATOR_RECORD.size), LOCATOR_RECORD.size)
        if len(locator) == LOCATOR_RECORD.size and LOCATOR_RECORD.unpack(locator)[0] == LOCATOR:
            end64 = END64_RECORD.unpack(read_range(file, LOCATOR_RECORD.unpack(locator)[2], END64_RECORD.size))
            count, length, start = end64[7:10]
    body, at = read_range(file, start, length), 0
    for _ in range(count):
        head = CENTRAL_HEAD.unpack_from(body, at)
        method, packed, full, names, extras, comments, offset = head[4], head[8], head[9], head[10], head[11], head[12], head[16]
        name = body[at + CENTRAL_HEAD.size :][:names].decode("utf-8", "replace")
        extra = body[at + CENTRAL_HEAD.size + names :][:extras]
        _, packed, offset = zip64_values(extra, [full, packed, offset])
        local = LOCAL_HEAD.unpack(read_range(file, offset, LOCAL_HEAD.size))
        yield name, method, offset + LOCAL_HEAD.size + local[9] + local[10], packed
        at += CENTRAL_HEAD.size + names + extras + comments


def indexed(file: pa.NativeFile, at: int, size: int) -> Iterator[tuple[int, int]]:
    """(offset, length) of the records that an index member lists."""
    stop, rest, head = at + size, b"", True
    while at < stop:
        chunk = read_range(file, at, min(RANGE, stop - at))
        at += len(chunk)
        *lines, rest = (rest + chunk).split(b"\n")
        for line in lines[head:]:
            offset, n = map(int, line.split())
            yield offset, n
        head = head and not lines


def walked(file: pa.NativeFile, start: int, size: int) -> Iterator[tuple[int, int]]:
    """(offset, length) of the records of a plain WARC member, from one head to the next; their blocks are passed over."""
    at, held, held_at = start, b"", start
    while at < start + size:
        held, held_at = held[at - held_at :], at
        while (end := held.find(b"\r\n\r\n")) < 0:
            chunk = read_range(file, at + len(held), min(HEAD, start + size - at - len(held)))
            if not chunk:
                if held.strip():
                    raise ValueError(f"a WARC record without an end of its head at byte {at}")
                return
            held += chunk
        n = min(end + 4 + content_length(held[:end]) + 4, start + size - at)
        yield at - start, n
        at += n


def ranges_of(path: str, size: int) -> Iterator[tuple[str, int, int, str | None]]:
    """(path, first byte, length, record lengths) of ranges of whole records, of about ``RANGE`` bytes each.

    Every member whose name ends in .warc or .warc.gz is read, in whatever folder. One that the ZIP file holds
    compressed has no byte ranges and raises. Gzip members without an index are one range, whose records are
    found one after the other (null lengths).
    """
    with opened(path) as file:
        found = list(members(file, size))
        data = [m for m in found if m[0].lower().endswith((".warc", ".warc.gz"))]
        for name, method, *_ in data:
            if method:
                raise ValueError(f"{path}: the member {name} is compressed (method {method}) and cannot be read by ranges")
        index = next((m for m in found if m[1] == 0 and m[0].startswith("indexes/")), None)
        for _, _, base, whole in data:
            if index is not None and len(data) == 1:
                records = indexed(file, index[2], index[3])
            elif read_range(file, base, 2) == b"\x1f\x8b":
                yield path, base, whole, None
                continue
            else:
                records = walked(file, base, whole)
            first, length, sizes = 0, 0, []
            for offset, n in records:
                if sizes and (length + n > RANGE or first + length != offset):
                    yield path, base + first, length, " ".join(map(str, sizes))
                    sizes, length = [], 0
                if not sizes:
                    first = offset
                sizes.append(n)
                length += n
            if sizes:
                yield path, base + first, length, " ".join(map(str, sizes))


class Reader:
    """Bytes of a range of a file in order, unpacked if they are gzip members."""

    def __init__(self, file: pa.NativeFile, start: int, size: int):
        self.file, self.at, self.stop, self.held, self.ended = file, start, start + size, b"", False
        self.gzip = zlib.decompressobj(31) if read_range(file, start, 2) == b"\x1f\x8b" else None

    def more(self) -> bool:
        if self.gzip and self.gzip.eof:
            rest = self.gzip.unused_data
            self.gzip = zlib.decompressobj(31)
            if rest:
                self.held += self.gzip.decompress(rest)
                return True
        chunk = read_range(self.file, self.at, min(1 << 20, self.stop - self.at))
        self.at += len(chunk)
        self.held += self.gzip.decompress(chunk) if self.gzip and chunk else chunk
        return bool(chunk)

    def until(self, mark: bytes) -> bytes | None:
        while (at := self.held.find(mark)) < 0:
            if not self.more():
                return None
        out, self.held = self.held[: at + len(mark)], self.held[at + len(mark) :]
        return out

    def take(self, size: int) -> bytes:
        while len(self.held) < size and self.more():
            pass
        out, self.held = self.held[:size], self.held[size:]
        return out


def parsed(head: bytes, block: bytes) -> tuple | None:
    """The row of a response or revisit record, None for others."""
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:] if line)}
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    payload = block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block
    stated = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    intact = None if kind == "revisit" or stated is None else payload_digest(payload) == stated
    length = int(fields["x-payload-length"]) if kind == "revisit" and "x-payload-length" in fields else len(payload) if kind == "response" else None
    url = fields.get("warc-target-uri")
    return fields.get("warc-record-id"), kind, url and plain_value(url), length, stated or payload_digest(payload), fields.get("warc-refers-to"), payload if kind == "response" else None, intact


COLUMNS = ["record_id", "record_type", "url", "payload_bytes", "payload_digest", "refers_to", "payload", "intact"]
RECORDS = "record_id string, record_type string, url string, payload_bytes long, payload_digest string, refers_to string, payload binary, intact boolean"
TYPES = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.bool_()]


def read_packages(spark: SparkSession, path: str) -> DataFrame:
    """The response and revisit records of all packages in a folder, which executors read by ranges.

    ``intact`` tells whether a payload has the digest its header states (null where there is none to compare).
    An empty folder has no rows; a file that is no ZIP file raises, and so does a WARC member that it compresses. There
    are as many tasks as the ranges have bytes for, whatever little the list of ranges takes.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length")

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = list(ranges_of(p, n))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([list(c) for c in zip(*rows, strict=True)] or [[]] * 4, [pa.string(), pa.int64(), pa.int64(), pa.string()], strict=True)], ["path", "start", "size", "sizes"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for p, start, size, sizes in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                with opened(p) as file:
                    for row in records_in(file, start, size, sizes):
                        rows.append(row)
                        held += len(row[6] or b"")
                        if held > RANGE or len(rows) >= 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)], COLUMNS)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)], COLUMNS)

    ranges = written(files.repartition("path").mapInArrow(locate, "path string, start long, size long, sizes string"), "ranges")
    count, size = ranges.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    tasks = min(count, max(-(-size // RANGE), spark.sparkContext.defaultParallelism))
    return ranges.repartition(max(1, tasks)).mapInArrow(read, RECORDS)


def records_in(file: pa.NativeFile, start: int, size: int, sizes: str | None) -> Iterator[tuple]:
    if sizes is not None:  # each record by its own range
        for n in map(int, sizes.split()):
            raw = read_range(file, start, n)
            start += n
            if raw[:2] == b"\x1f\x8b":
                raw = zlib.decompressobj(31).decompress(raw)
            head, _, rest = raw.partition(b"\r\n\r\n")
            row = parsed(head, rest[: content_length(head)])
            if row:
                yield row
        return
    reader = Reader(file, start, size)
    while head := reader.until(b"\r\n\r\n"):
        block = reader.take(content_length(head))
        reader.take(4)
        row = parsed(head[:-4], block)
        if row:
            yield row


def content_length(head: bytes) -> int:
    found = re.search(rb"\r\ncontent-length:[ \t]*(\d+)", head, re.IGNORECASE)
    if not found:
        raise ValueError(f"a WARC record without its length: {head[:80]!r}")
    return int(found[1])
