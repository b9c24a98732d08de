"""WARC records in ZIP archives: writer, archive reader and record reader.

An archive is a ZIP file with stored (uncompressed) members: ``archive/data.warc.gz``
holds one gzip member per record, ``indexes/index.cdxj`` one JSON line per record
with its offset and length in that member. The reader parses the end of central
directory (ZIP64 too), the central directory and the local headers, and then reads
records by range, without extracting anything.

Files go through ``pyarrow.fs``, so any folder URI that it knows works. Every write
goes to a name of its own attempt and is reported by that name, so a task that runs
twice leaves an unreferenced file and no wrong row.

Defined results: null html is an empty payload; repeated rows get a record each; a
page whose payload no smaller page_id has is a response, and so is a page without
page_id; a null url is empty; compressed members are listed, and reading one raises
ValueError; broken archives or records raise ValueError too.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, pick, scratch_path, slices, write_table

DATA_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
ARCHIVE_BYTES = 64 << 20
GAP = 64 << 10
U32, U16 = 0xFFFFFFFF, 0xFFFF


# ---- ZIP ----------------------------------------------------------------------

class ZipWriter:
    """Writes stored members one after another to a stream that need not seek."""

    def __init__(self, out, zip64: bool = False):
        self.out, self.at, self.zip64, self.entries = out, 0, zip64, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, name: str, chunks: list[bytes]) -> int:
        """Write one member; returns the offset of its data in the archive."""
        raw, size, crc = name.encode(), sum(map(len, chunks)), 0
        for c in chunks:
            crc = zlib.crc32(c, crc)
        start, big = self.at, self.zip64 or size >= U32
        extra = struct.pack("<HHQQ", 1, 16, size, size) if big else b""
        self._put(struct.pack("<IHHHHHIIIHH", 0x04034B50, 45 if big else 20, 0x800, 0, 0, 0x21, crc,
                              U32 if big else size, U32 if big else size, len(raw), len(extra)) + raw + extra)
        data_at = self.at
        for c in chunks:
            self._put(c)
        self.entries.append((raw, crc, size, start))
        return data_at

    def close(self) -> None:
        start = self.at
        for raw, crc, size, at in self.entries:
            big = self.zip64 or size >= U32 or at >= U32
            extra = struct.pack("<HHQQQ", 1, 24, size, size, at) if big else b""
            self._put(struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45 if big else 20, 0x800, 0, 0, 0x21, crc,
                                  U32 if big else size, U32 if big else size, len(raw), len(extra), 0, 0, 0, 0,
                                  U32 if big else at) + raw + extra)
        size, n, end = self.at - start, len(self.entries), self.at
        if self.zip64 or n >= U16 or start >= U32 or size >= U32:
            self._put(struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, size, start))
            self._put(struct.pack("<IIQI", 0x07064B50, 0, end, 1))
            n, size, start = U16, U32, U32
        self._put(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, n, n, size, start, 0))


def _read_at(f, at: int, size: int) -> bytes:
    f.seek(at)
    data = f.read(size)
    if len(data) != size:
        raise ValueError(f"archive ends early: {len(data)} of {size} bytes at {at}")
    return data


def zip_members(f, size: int) -> list[dict]:
    """Name, method, crc, sizes and local header offset of each member, from the central directory alone."""
    tail_at = max(0, size - 22 - U16)
    tail = _read_at(f, tail_at, size - tail_at)
    k = len(tail) - 22
    while k >= 0 and not (tail[k:k + 4] == b"PK\5\6" and k + 22 + struct.unpack_from("<H", tail, k + 20)[0] == len(tail)):
        k = tail.rfind(b"PK\5\6", 0, k + 3)
    if k < 0:
        raise ValueError("no end of central directory: not a ZIP archive")
    n, cd_size, cd_at = struct.unpack_from("<HII", tail, k + 10)
    end = tail_at + k
    if n == U16 or cd_size == U32 or cd_at == U32:
        if end >= 20 and (loc := _read_at(f, end - 20, 20))[:4] == b"PK\6\7":
            end = struct.unpack_from("<Q", loc, 8)[0]
            rec = _read_at(f, end, 56)
            if rec[:4] != b"PK\6\6":
                raise ValueError("broken ZIP64 end of central directory")
            n, cd_size, cd_at = struct.unpack_from("<QQQ", rec, 32)
    data, at, out = _read_at(f, cd_at, cd_size), 0, []
    for _ in range(n):
        if data[at:at + 4] != b"PK\1\2":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        crc, packed, full, n_name, n_extra, n_note = struct.unpack_from("<IIIHHH", data, at + 16)
        local = struct.unpack_from("<I", data, at + 42)[0]
        raw = data[at + 46:at + 46 + n_name]
        extra, e = data[at + 46 + n_name:at + 46 + n_name + n_extra], 0
        while e + 4 <= len(extra):
            kind, length = struct.unpack_from("<HH", extra, e)
            if kind == 1:
                x, wide = e + 4, []
                for v in (full, packed, local):
                    if v == U32:
                        v = struct.unpack_from("<Q", extra, x)[0]
                        x += 8
                    wide.append(v)
                full, packed, local = wide
            e += 4 + length
        out.append({"name": raw.decode("utf-8" if flags & 0x800 else "cp437"), "method": method, "crc": crc,
                    "packed": packed, "size": full, "local": local})
        at += 46 + n_name + n_extra + n_note
    return out


def member_at(f, member: dict) -> int:
    """Offset of a stored member's data: its local header has a name and extra field of their own lengths."""
    if member["method"] != 0:
        raise ValueError(f"{member['name']} is compressed; range reads need stored members")
    head = _read_at(f, member["local"], 30)
    if head[:4] != b"PK\3\4":
        raise ValueError(f"no local header for {member['name']}")
    n_name, n_extra = struct.unpack_from("<HH", head, 26)
    return member["local"] + 30 + n_name + n_extra


# ---- WARC ---------------------------------------------------------------------

def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{page_id}>"


def warc_record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP header, with the payload's length, and no payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    kind = "response" if refers_to is None else "revisit"
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Target-URI: {' '.join(url.split())}", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes) -> tuple[dict[str, str], bytes]:
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("record without the end of its header")
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}, rest


def parse_record(data: bytes) -> dict:
    """Type, ids, digest and payload of one record (uncompressed)."""
    if not data.startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    head, rest = _headers(data)
    block = rest[:int(head["content-length"])]
    if rest[len(block):] != b"\r\n\r\n" or len(block) != int(head["content-length"]):
        raise ValueError(f"broken record {head.get('warc-record-id')}")
    http, payload = _headers(block)
    page = lambda s: None if s == record_id(None) else int(s[len("<urn:page:"):-1])
    digest, revisit = head["warc-payload-digest"].removeprefix("sha1:"), head["warc-type"] == "revisit"
    if not revisit and payload_digest(payload) != digest:
        raise ValueError(f"digest of {head['warc-record-id']} does not match its payload")
    return {"page_id": page(head["warc-record-id"]), "url": head["warc-target-uri"], "record_type": head["warc-type"],
            "refers_to": page(head["warc-refers-to"]) if revisit else None, "payload_digest": digest,
            "payload_bytes": int(http["content-length"]), "payload": None if revisit else payload}


# ---- Spark: write ---------------------------------------------------------------

def _open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _write_archives(folder: str, limit: int, zip64: bool):
    def close(fs, path, records, index) -> dict:
        name = f"{path}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.zip"
        with fs.open_output_stream(name) as out:
            z = ZipWriter(out, zip64)
            z.add(DATA_MEMBER, records)
            z.add(INDEX_MEMBER, [("\n".join(index) + "\n").encode()])
            z.close()
            size = z.at
        return {"archive": f"{folder}/{name.rsplit('/', 1)[1]}", "bytes": size, "records": len(index)}

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _open_fs(folder)
        fs.create_dir(path, recursive=True)
        records, index, at, done = [], [], 0, []
        for batch in slices(batches, "html"):
            for r in batch.to_pylist():
                payload = (r["html"] or "").encode()
                data = gzip.compress(warc_record(r["page_id"], r["url"] or "", payload, payload_digest(payload),
                                                 r["refers_to"]), 1, mtime=0)
                index.append(json.dumps({"id": r["page_id"], "offset": at, "length": len(data)}))
                records.append(data)
                at += len(data)
                if at >= limit:
                    done.append(close(fs, path, records, index))
                    records, index, at = [], [], 0
        if records:
            done.append(close(fs, path, records, index))
        yield pa.RecordBatch.from_pylist(done, pa.schema([("archive", pa.string()), ("bytes", pa.int64()),
                                                          ("records", pa.int64())]))
    return write


def write_warc(pages: DataFrame, folder: str | None = None, *, min_revisit_bytes: int = 0,
               archive_bytes: int = ARCHIVE_BYTES, zip64: bool = False) -> DataFrame:
    """Write one WARC record per page into ZIP archives; returns the manifest (archive, bytes, records).

    A page whose payload (at least ``min_revisit_bytes`` long) equals that of a smaller
    page_id becomes a revisit. Only digests are grouped; the html moves once, in the
    join that marks the revisits, where adaptive execution splits hot digests.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    src = pick(pages, page_id="page_id", url="url", html="html").withColumn("page_id", F.col("page_id").cast("long"))
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8")
    own = src.withColumn("digest", F.sha1(payload))
    first = (own.filter(F.octet_length(payload) >= min_revisit_bytes).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first"))
    first = write_table(first, "warc-digests")  # so that the join can split a hot digest
    marked = own.join(first, "digest", "left").select(
        "page_id", "url", "html", F.when(F.col("first") < F.col("page_id"), F.col("first")).alias("refers_to"))
    return write_table(marked.mapInArrow(_write_archives(folder, archive_bytes, zip64),
                                         "archive string, bytes long, records long"), "warc-manifest")


# ---- Spark: read ----------------------------------------------------------------

def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
    for batch in batches:
        for archive in column(batch, "archive").to_pylist():
            fs, path = _open_fs(archive)
            with fs.open_input_file(path) as f:
                members = {m["name"]: m for m in zip_members(f, f.size())}
                data_at = member_at(f, members[DATA_MEMBER])
                lines = _read_at(f, member_at(f, members[INDEX_MEMBER]), members[INDEX_MEMBER]["size"])
            rows = [json.loads(x) for x in lines.decode().splitlines()]
            yield pa.RecordBatch.from_arrays([pa.array([archive] * len(rows), pa.string()),
                                              pa.array([data_at + x["offset"] for x in rows], pa.int64()),
                                              pa.array([x["length"] for x in rows], pa.int64())], schema=schema)


def _records(with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                  ("payload_digest", pa.string()), ("payload_bytes", pa.int64())]
        schema = pa.schema(fields + [("payload", pa.binary())] * with_payload)
        for batch in batches:
            rows = sorted(zip(*(column(batch, c).to_pylist() for c in ("archive", "offset", "length")), strict=True))
            k, out, held = 0, [], 0
            while k < len(rows):
                archive = rows[k][0]
                fs, path = _open_fs(archive)
                with fs.open_input_file(path) as f:
                    while k < len(rows) and rows[k][0] == archive:
                        # one range for records that lie close together
                        j, end = k, rows[k][1]
                        while (j < len(rows) and rows[j][0] == archive and rows[j][1] - end <= GAP
                               and (j == k or rows[j][1] + rows[j][2] - rows[k][1] <= 4 << 20)):
                            end = max(end, rows[j][1] + rows[j][2])
                            j += 1
                        data = _read_at(f, rows[k][1], end - rows[k][1])
                        for _, at, length in rows[k:j]:
                            r = parse_record(gzip.decompress(data[at - rows[k][1]:at - rows[k][1] + length]))
                            held += r["payload_bytes"] * with_payload
                            out.append(r if with_payload else {c: r[c] for c, _ in fields})
                        k = j
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(out, schema)
                            out, held = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
    return read


def warc_index(archives: DataFrame) -> DataFrame:
    """(archive, offset, length) of every record, from the central directories and index members."""
    return archives.select("archive").mapInArrow(_index, "archive string, offset long, length long")


def read_warc(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """Every record of the archives in the column ``archive``, read by range; payloads on request."""
    out = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long"
    return warc_index(archives).mapInArrow(_records(with_payload), out + ", payload binary" * with_payload)
