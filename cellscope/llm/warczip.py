"""Web archives inside ZIP packages: written by all tasks, read by byte ranges.

A package is a ZIP file with the stored member ``archive/data.warc.gz``, one gzip member per
WARC record, and ``indexes/index.cdx.gz``, one line per record with its place in the former.
A reader looks at the end of a package for the directory (ZIP64 where fields are full), finds
where the stored members begin, streams the index and reads records by their byte ranges, many
neighbours at once.  Nothing is extracted, and a package may be larger than any memory.

Payloads that occur in more than one page are stored once: by the page with the smallest id, as
a response; the others are revisit records that name it.  Only (hash, id) is aggregated for
that, and only hashes that repeat are joined back.

Packages are written under a name of the task's attempt; those that count are in the table of
packages, which Spark commits.  What a lost attempt has left behind is never read.  Folders may
be on any file system that pyarrow opens by its address.

Defined cases: null html is the empty payload; rows with one id and one payload are each a
record of their kind, so repeated rows that have the smallest id are all responses; rows
without id revisit the smallest id of their payload if there is one; a url may be null, empty
or hold any character and comes back as it was; other columns are ignored; no rows give no
packages.  A record whose digest or length does not fit raises an error.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from itertools import chain
from urllib.parse import quote, urlsplit

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.sources import new_workspace, stage_table

# Fixed values of the formats.
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx.gz"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PRINTABLE = "".join(map(chr, range(0x21, 0x7F)))
STORED, DEFLATED = 0, 8
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF

GZIP = 31  # window bits of zlib for gzip members
STEP = 1 << 20  # bytes of one read from an index or a directory
RANGE_BYTES = 1 << 20  # of neighbouring records that are read at once
TASK_BYTES = 16 << 20  # of packages that are read by a task

PACKAGES = "path string, bytes long, records long"
RANGES = "path string, start long, size long, offsets array<long>, lengths array<long>"
RECORDS = (
    "path string, record_id string, record_type string, page_id string, url string, refers_to string, "
    "payload_bytes long, payload_digest string, payload binary")


def open_folder(path: str):
    """(file system, path on it) of an address."""
    from pyarrow import fs

    if urlsplit(path).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlsplit(path).path if path.startswith("file:") else path
    return fs.FileSystem.from_uri(path)


# --- records ----------------------------------------------------------------------


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_name(page_id: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{json.dumps(page_id)} {digest}')}>"


def make_record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None, date: str) -> tuple[bytes, str]:
    """(the record, its payload's digest); with ``refers_to`` a revisit, which has no payload of its own."""
    digest = payload_digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_record_name(page_id, digest)}", f"WARC-Date: {date}",
            f"WARC-Target-URI: {quote(url or '', safe=PRINTABLE) or 'urn:none'}", f"X-Page: {json.dumps([page_id, url])}",
            f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_name(refers_to, digest)}",
                 f"X-Refers-To-Page: {json.dumps(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return b"".join(["\r\n".join(head).encode(), b"\r\n\r\n", block, b"\r\n\r\n"]), digest


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode().split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def parse_record(record: bytes) -> dict:
    """The parts of a whole record, its lengths and digest compared with the content."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    if not head.startswith(b"WARC/1.") or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a WARC record of the stated length")
    http, _, payload = block.partition(b"\r\n\r\n")
    size, digest = int(_fields(http)["content-length"]), fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"{fields['warc-record-id']}: payload differs from its length or digest")
    page_id, url = json.loads(fields["x-page"])
    return {
        "record_id": fields["warc-record-id"], "record_type": kind, "page_id": page_id, "url": url,
        "refers_to": json.loads(fields["x-refers-to-page"]) if "x-refers-to-page" in fields else None,
        "payload_bytes": size, "payload_digest": digest, "payload": payload if kind == "response" else None}


# --- writing ----------------------------------------------------------------------


class _Sink:
    """What a ZIP writer needs of a stream that cannot go back."""

    def __init__(self, stream):
        self.stream, self.size = stream, 0

    def write(self, data) -> int:
        self.size += len(data)
        self.stream.write(data)
        return len(data)

    def flush(self) -> None:
        self.stream.flush()


def _sort_key(url: str | None) -> str:
    """A url with its host's names in reverse, as indexes are sorted by."""
    try:
        parts = urlsplit(url or "")
        host = ",".join(reversed((parts.hostname or "").split(".")))
    except ValueError:  # not an address
        return quote(url or "", safe=PRINTABLE)
    return quote(f"{host}){parts.path}{'?' + parts.query if parts.query else ''}", safe=PRINTABLE)


def write_package(stream, records: Iterator[tuple[str | None, str | None, bytes, str | None]], date: str,
                  max_bytes: int, max_records: int) -> tuple[int, int]:
    """Write records until a limit is met; (bytes, records) of the package."""
    sink, lines, at = _Sink(stream), [], 0
    with zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED, allowZip64=True) as package:
        with package.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True) as archive:
            for page_id, url, payload, refers_to in records:
                record, digest = make_record(page_id, url, payload, refers_to, date)
                packer = zlib.compressobj(6, zlib.DEFLATED, GZIP)
                data = packer.compress(record) + packer.flush()
                archive.write(data)
                place = {"digest": f"sha1:{digest}", "offset": at, "length": len(data), "filename": ARCHIVE.split("/")[1]}
                lines.append(f"{_sort_key(url)} {date[:19].translate({45: None, 58: None, 84: None})} {json.dumps(place)}\n")
                at += len(data)
                if at >= max_bytes or len(lines) >= max_records:
                    break
        with package.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as index:
            packer = zlib.compressobj(6, zlib.DEFLATED, GZIP)
            for line in sorted(lines):
                index.write(packer.compress(line.encode()))
            index.write(packer.flush())
    return sink.size, len(lines)


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to) of pages (page_id, url, html).

    The hash of a payload a third of all pages have is counted in every task before it moves;
    adaptive execution splits the join that follows.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload")).withColumn(
        "hash", F.sha2("payload", 256))
    again = (
        rows.filter(F.octet_length("payload") >= min_bytes).groupBy("hash")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("hash", "first"))
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("first")), F.col("first"))
    return rows.join(again.hint("shuffle_hash"), "hash", "left").select(
        F.col("page_id").cast("string").alias("page_id"), "url", "payload", refers.cast("string").alias("refers_to"))


def write_packages(
    pages: DataFrame, folder: str | None = None, min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z",
    max_bytes: int = 256 << 20, max_records: int = 100_000,
) -> DataFrame:
    """Write all pages to packages in ``folder`` (a fresh one by default): (path, bytes, records).

    A package ends at ``max_bytes`` of records or ``max_records``: that bounds its index.
    """
    folder = folder or new_workspace(pages.sparkSession, "packages")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, place = open_folder(folder)
        task = TaskContext.get()
        rows = (row for batch in batches for row in batch.itertuples(index=False, name=None))
        serial = 0
        for first in rows:
            name = f"{place.rstrip('/')}/part-{task.partitionId():05d}-{task.taskAttemptId()}-{serial}.wacz"
            with system.open_output_stream(name, buffer_size=STEP) as stream:
                size, n = write_package(stream, chain([first], rows), date, max_bytes, max_records)
            yield pd.DataFrame({"path": [f"{folder.rstrip('/')}/{name.rsplit('/', 1)[1]}"], "bytes": [size], "records": [n]})
            serial += 1

    return stage_table(with_revisits(pages, min_bytes).mapInPandas(run, PACKAGES), "package-list")


# --- reading ----------------------------------------------------------------------


def _read(file, start: int, size: int) -> bytes:
    file.seek(start)
    data = file.read(size)
    if len(data) != size:
        raise ValueError(f"the file ends before byte {start + size}")
    return data


def find_directory(file, size: int) -> tuple[int, int, int]:
    """(offset, bytes, entries) of the central directory of a ZIP file of ``size`` bytes."""
    start = max(0, size - 22 - FULL16)
    tail = _read(file, start, size - start)
    at = tail.rfind(b"PK\5\6")
    while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(b"PK\5\6", 0, at)
    if at < 0:
        raise ValueError("no end of a ZIP directory")
    entries, bytes_, offset = struct.unpack_from("<10xHLL", tail, at)
    if entries == FULL16 or bytes_ == FULL32 or offset == FULL32:
        mark, where = struct.unpack("<4s4xQ4x", _read(file, start + at - 20, 20))
        if mark != b"PK\6\7":
            raise ValueError("no place of the ZIP64 directory")
        mark, entries, bytes_, offset = struct.unpack("<4s28xQQQ", _read(file, where, 56))
        if mark != b"PK\6\6":
            raise ValueError("no end of the ZIP64 directory")
    return offset, bytes_, entries


def _wide(extra: bytes, size: int, packed: int, offset: int) -> tuple[int, int, int]:
    """The values of full fields, from the ZIP64 part of the extra field."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            numbers = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            size, packed, offset = (next(numbers) if value == FULL32 else value for value in (size, packed, offset))
        at += 4 + length
    return size, packed, offset


def members(file, size: int) -> Iterator[tuple[str, int, int, int, int]]:
    """(name, method, packed bytes, bytes, offset of the local header) of each member, in directory order."""
    at, left, entries = find_directory(file, size)
    data = b""
    for _ in range(entries):
        while len(data) < 46 or len(data) < 46 + sum(struct.unpack_from("<HHH", data, 28)):
            if not left:
                raise ValueError("the ZIP directory is cut")
            more = _read(file, at, min(left, STEP))
            data, at, left = data + more, at + len(more), left - len(more)
        mark, flags, method, packed, unpacked, n, e, c, header = struct.unpack_from("<4s4xHH8xLLHHH8xL", data)
        if mark != b"PK\1\2":
            raise ValueError("not an entry of a ZIP directory")
        name = data[46 : 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        unpacked, packed, header = _wide(data[46 + n : 46 + n + e], unpacked, packed, header)
        yield name, method, packed, unpacked, header
        data = data[46 + n + e + c :]


def data_start(file, header: int) -> int:
    """Where the bytes of a member begin: its local header has lengths of its own."""
    mark, n, e = struct.unpack("<4s22xHH", _read(file, header, 30))
    if mark != b"PK\3\4":
        raise ValueError("not the header of a ZIP member")
    return header + 30 + n + e


def _lines(file, start: int, packed: int, method: int, name: str) -> Iterator[bytes]:
    """The lines of an index, streamed."""
    steps = [zlib.decompressobj(-15)] if method == DEFLATED else []
    if name.endswith(".gz"):
        steps.append(zlib.decompressobj(GZIP))
    rest, end = b"", start + packed
    while start < end:
        data = _read(file, start, min(STEP, end - start))
        start += len(data)
        for step in steps:
            data = step.decompress(data)
        *whole, rest = (rest + data).split(b"\n")
        yield from whole
    if rest:
        yield rest


def record_places(file, size: int) -> list[tuple[int, int]]:
    """(offset in the package, bytes) of all records that its indexes name, in the order of the bytes."""
    stored, indexes = {}, []
    for name, method, packed, _, header in members(file, size):
        if name.startswith("archive/") and not name.endswith("/"):
            if method != STORED:
                raise ValueError(f"{name}: only stored archives can be read by ranges")
            stored[name.split("/", 1)[1]] = (data_start(file, header), packed)
        elif name.startswith("indexes/") and name.split(".", 1)[-1] in ("cdx", "cdxj", "cdx.gz", "cdxj.gz"):
            if method not in (STORED, DEFLATED):
                raise ValueError(f"{name}: compressed in an unknown way")
            indexes.append((name, method, packed, header))
    places = set()
    for name, method, packed, header in indexes:
        for line in _lines(file, data_start(file, header), packed, method, name):
            place = json.loads(line[line.index(b"{") :])
            start, length = stored[place["filename"]]
            offset, n = int(place["offset"]), int(place["length"])
            if offset < 0 or offset + n > length:
                raise ValueError(f"{name}: a record ends beyond {place['filename']}")
            places.add((start + offset, n))
    return sorted(places)


def record_ranges(packages: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Ranges of neighbouring records (RANGES) from the directories and indexes of ``packages`` (path)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for path in (path for batch in batches for path in batch["path"]):
            system, place = open_folder(path)
            with system.open_input_file(place) as file:
                places = record_places(file, file.size())
            start, group, ranges = 0, [], []
            for offset, length in places:
                if group and offset + length - start > range_bytes:
                    ranges.append(group)
                    group = []
                start = group[0][0] if group else offset
                group.append((offset, length))
            for group in [*ranges, group] if group else ranges:
                start, end = group[0][0], max(o + n for o, n in group)
                yield pd.DataFrame({
                    "path": [path], "start": [start], "size": [end - start],
                    "offsets": [[o - start for o, _ in group]], "lengths": [[n for _, n in group]]})

    return packages.select("path").mapInPandas(run, RANGES)


def read_packages(packages: DataFrame, payload: bool = True, task_bytes: int = TASK_BYTES) -> DataFrame:
    """All records of ``packages`` (path, bytes): RECORDS.

    A task reads about ``task_bytes`` of packages: rows that only name ranges tell nothing of it.

    A revisit has no payload, but the length and digest of the one it refers to.  Without
    ``payload`` that column is null; lengths and digests are compared with the content all the same.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start, size, offsets, lengths in batch.itertuples(index=False):
                system, place = open_folder(path)
                with system.open_input_file(place) as file:
                    data = _read(file, start, size)
                rows = []
                for offset, length in zip(offsets, lengths, strict=True):
                    unpacker = zlib.decompressobj(GZIP)
                    record = unpacker.decompress(data[offset : offset + length])
                    if not unpacker.eof or unpacker.unused_data:
                        raise ValueError(f"{path}: no whole record at byte {start + offset}")
                    rows.append({"path": path, **parse_record(record)})
                    if not payload:
                        rows[-1]["payload"] = None
                yield pd.DataFrame(rows)

    total = packages.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    return record_ranges(packages).repartition(total // task_bytes + 1, "path", "start").mapInPandas(run, RECORDS)
