"""Web archives (WARC) packaged in ZIP files, written and range-read without extraction.

Writing: each task streams its pages into archives of bounded size. An archive is a ZIP of stored members: ``archive/data.warc.gz``
(one gzip member per record), ``indexes/index.cdxj`` (one line per record: target, then JSON with offset, length and record id)
and ``datapackage.json``. Of the records with equal payloads of at least ``min_revisit`` bytes, the one of the least page_id is a
response; the others are revisits that keep the HTTP header, the full payload's digest and a reference.

Reading: a reader takes the end-of-directory record, its ZIP64 form where the short one is saturated, then the central directory;
a stored member's bytes lie in the archive as they are, so the index member is read as one range and each record as another.

Defined results: null html is an empty payload; payloads under ``min_revisit`` bytes are always responses; rows that repeat the
least page_id of their payload are all responses; null page_ids revisit the least page_id that is not null, and are responses
where there is none; null urls and urls with control characters are kept out of, or escaped in, headers; an empty table gives no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captureframe.llm import files
from captureframe.llm.shared import new_path, partitions_for, written

DATA, INDEX, PACKAGE = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
ARCHIVE_BYTES = 32 << 20
URN = "urn:captureframe:page:"
#: Fixed values of the ZIP format: signatures, and the marks of a field that ZIP64 holds instead.
LOCAL, CENTRAL, END, END64, LOCATOR64 = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50
FULL16, FULL32, EXTRA64 = 0xFFFF, 0xFFFFFFFF, 0x0001


def zip_parts(members: list[tuple[str, bytes]], zip64: bool = False) -> list[bytes]:
    """A ZIP of stored members as byte parts; ``zip64`` uses the long form even where the short one would do."""
    out, directory, at = [], [], 0
    for name, data in members:
        raw, crc, n = name.encode(), zlib.crc32(data), len(data)
        long = zip64 or n >= FULL32 or at >= FULL32
        size = FULL32 if long else n
        extra = struct.pack("<HHQQ", EXTRA64, 16, n, n) if long else b""
        head = struct.pack("<IHHHHHIIIHH", LOCAL, 45 if long else 20, 0, 0, 0, 0x21, crc, size, size, len(raw), len(extra)) + raw + extra
        central = struct.pack("<HHQQQ", EXTRA64, 24, n, n, at) if long else b""
        directory.append(struct.pack("<IHHHHHHIIIHHHHHII", CENTRAL, 45, 45 if long else 20, 0, 0, 0, 0x21, crc, size, size, len(raw), len(central), 0, 0, 0, 0, FULL32 if long else at) + raw + central)
        out += [head, data]
        at += len(head) + n
    listed = b"".join(directory)
    tail, count = b"", len(members)
    if zip64 or at >= FULL32 or count >= FULL16:
        tail = struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, count, count, len(listed), at) + struct.pack("<IIQI", LOCATOR64, 0, at + len(listed), 1)
        count16, size32, at32 = FULL16, FULL32, FULL32
    else:
        count16, size32, at32 = count, len(listed), at
    return [*out, listed, tail, struct.pack("<IHHHHIIH", END, 0, 0, count16, count16, size32, at32, 0)]


class StoredZip:
    """Members of a ZIP as byte ranges of the file itself."""

    def __init__(self, file):
        self.file = file
        file.seek(0, 2)
        size = file.tell()
        tail_at = max(0, size - 22 - FULL16)
        tail = self._read(tail_at, size - tail_at)
        end = tail.rfind(struct.pack("<I", END))
        if end < 0:
            raise ValueError("no end of central directory")
        _, _, _, _, count, length, start, _ = struct.unpack_from("<IHHHHIIH", tail, end)
        if count == FULL16 or length == FULL32 or start == FULL32:
            signature, _, end64, _ = struct.unpack("<IIQI", self._read(tail_at + end - 20, 20))
            if signature != LOCATOR64:
                raise ValueError("no ZIP64 locator")
            fields = struct.unpack("<IQHHIIQQQQ", self._read(end64, 56))
            if fields[0] != END64:
                raise ValueError("no ZIP64 end of central directory")
            count, length, start = fields[7:]
        self.members: dict[str, tuple[int, int, int]] = {}
        directory, at = self._read(start, length), 0
        for _ in range(count):
            f = struct.unpack_from("<IHHHHHHIIIHHHHHII", directory, at)
            if f[0] != CENTRAL:
                raise ValueError("broken central directory")
            name = directory[at + 46 : at + 46 + f[10]].decode()
            packed, full, offset = f[8], f[9], f[16]
            extra = directory[at + 46 + f[10] : at + 46 + f[10] + f[11]]
            while len(extra) >= 4:
                kind, n = struct.unpack_from("<HH", extra)
                if kind == EXTRA64:
                    values = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                    full = next(values) if full == FULL32 else full
                    packed = next(values) if packed == FULL32 else packed
                    offset = next(values) if offset == FULL32 else offset
                extra = extra[4 + n :]
            self.members[name] = (f[4], offset, packed)
            at += 46 + f[10] + f[11] + f[12]

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def span(self, name: str) -> tuple[int, int]:
        """(first byte, length) of a stored member within the file."""
        method, offset, packed = self.members[name]
        if method:
            raise ValueError(f"{name} is compressed, not stored")
        head = struct.unpack("<IHHHHHIIIHH", self._read(offset, 30))
        if head[0] != LOCAL:
            raise ValueError("broken local header")
        return offset + 30 + head[9] + head[10], packed

    def read(self, name: str, at: int = 0, n: int | None = None) -> bytes:
        first, length = self.span(name)
        return self._read(first + at, length - at if n is None else n)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers: int | None) -> bytes:
    """One WARC record: a response, or where ``refers`` is given a revisit of that page's payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: <{URN}{'' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        lines.append("WARC-Target-URI: " + target(url))
    lines += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    if refers is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{URN}{refers}>"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def target(url: str) -> str:
    """A url without characters that would end a header or an index field."""
    return "".join(quote(c) if c <= " " or c == "\x7f" else c for c in url)


def parsed(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC headers, HTTP headers, payload bytes that the record carries)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    named = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(named["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return named, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


def decided(pages: DataFrame, min_revisit: int = 100) -> DataFrame:
    """(page_id, url, html, digest, refers): refers is the page to revisit, or null for a response."""
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    base = base.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    long = F.octet_length("html") >= min_revisit
    shared = base.where(long).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    # Short payloads join nothing: they get a key of their own, so that many equal ones do not meet in one task.
    keyed = base.withColumn("key", F.when(long, F.col("digest")).otherwise(F.concat(F.lit("-"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))))
    joined = keyed.join(shared.withColumnRenamed("digest", "key"), "key", "left")
    return joined.select("page_id", "url", "html", "digest", F.when(~F.col("first_id").eqNullSafe(F.col("page_id")), F.col("first_id")).alias("refers"))


def write_archives(pages: DataFrame, folder: str, min_revisit: int = 100) -> DataFrame:
    """Write all pages; the list of archives (path, records), kept in the shared folder."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        data, index, size, k = [], [], 0, 0

        def flush() -> pd.DataFrame:
            path = f"{folder}/part-{context.partitionId():06d}-{k:04d}.wacz"
            package = json.dumps({"profile": "data-package", "resources": [{"name": "data.warc.gz", "path": DATA}, {"name": "index.cdxj", "path": INDEX}]}).encode()
            files.put(path, zip_parts([(DATA, b"".join(data)), (INDEX, "".join(index).encode()), (PACKAGE, package)]), context.taskAttemptId())
            return pd.DataFrame({"path": [path], "records": [len(index)]})

        for pdf in batches:
            for i, url, html, digest, refers in pdf[["page_id", "url", "html", "digest", "refers"]].itertuples(index=False):
                page, back = (None if pd.isna(x) else int(x) for x in (i, refers))
                url = None if url is None or pd.isna(url) else url
                raw = gzip.compress(record(page, url, html.encode("utf-8", "surrogatepass"), digest, back), compresslevel=1, mtime=0)
                index.append(f"{target(url or '-')} {json.dumps({'offset': size, 'length': len(raw), 'id': page})}\n")
                data.append(raw)
                size += len(raw)
                if size >= ARCHIVE_BYTES:
                    yield flush()
                    data, index, size, k = [], [], 0, k + 1
        if index:
            yield flush()

    return written(decided(pages, min_revisit).mapInPandas(rows, "path string, records long"), "archives")


def records_in(uri: str) -> Iterator[tuple[int | None, dict[str, str], dict[str, str], bytes]]:
    """(page_id, WARC headers, HTTP headers, payload) of each record that the archive's index lists."""
    with files.opened(uri) as f:
        archive = StoredZip(f)
        first, _ = archive.span(DATA)
        for line in archive.read(INDEX).decode().splitlines():
            entry = json.loads(line.split(" ", 1)[1])
            f.seek(first + entry["offset"])
            yield entry["id"], *parsed(gzip.decompress(f.read(entry["length"])))


def read_archives(listed: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri) of all records."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path in pdf["path"]:
                out = []
                for page, named, http, payload in records_in(path):
                    kind, digest, n = named["WARC-Type"], named["WARC-Payload-Digest"].removeprefix("sha256:"), int(http["Content-Length"])
                    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != n):
                        raise ValueError(f"{path}: the payload of page {page} is not the one it was written with")
                    back = named["WARC-Refers-To"][len(URN) + 1 : -1] if kind == "revisit" else None
                    out.append((page, n, digest, kind, None if back is None else int(back), named.get("WARC-Target-URI")))
                yield pd.DataFrame(out, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri"]).astype({"page_id": "Int64", "refers_to": "Int64"})

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string"
    return listed.select("path").repartition(partitions_for(listed.sparkSession), "path").mapInPandas(rows, schema)


def round_trip(pages: DataFrame, min_revisit: int = 100) -> DataFrame:
    return read_archives(write_archives(pages, new_path(pages.sparkSession, "archives"), min_revisit))
