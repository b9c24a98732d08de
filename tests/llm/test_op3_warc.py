import base64
import gzip
import hashlib
import io
import random
import struct
import zipfile

import pytest

from riskweave.llm import warc

PAGES = "page_id long, url string, html string, offset string, archive string"


def pages(spark, rows):
    return spark.createDataFrame([(i, f"http://x/{i}", h, "x", "y") for i, h in rows], PAGES)


def expected(rows):
    out = []
    for i, h in rows:
        data = (h or "").encode()
        first = min((j for j, g in rows if (g or "").encode() == data and j is not None), default=None)
        revisit = i is not None and first is not None and first < i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def read(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in df.collect()), key=repr)


@pytest.mark.parametrize("zip64", [False, True])
def test_round_trip(llm, zip64):
    rng = random.Random(4)
    rows = [(i, rng.choice(["", None, "<p>é</p>", "same", "x" * 300_000, f"own {i} \r\n\r\n WARC/1.1"])) for i in range(80)]
    rows += [(3, rows[3][1]), (None, "same"), (-5, "same")]
    manifest = warc.write_warc(pages(llm, rows).repartition(3), archive_bytes=20_000, zip64=zip64)
    assert manifest.count() > 1
    assert read(warc.read_warc(manifest)) == expected(rows)
    got = {(r["page_id"], r["record_type"]): r["payload"] for r in warc.read_warc(manifest, with_payload=True).collect()}
    assert all(bytes(v) == (dict(rows)[k] or "").encode() for (k, t), v in got.items() if t == "response" and k is not None)


def test_small_payloads_are_no_revisits(llm):
    rows = [(1, "abc"), (2, "abc"), (3, "a longer one"), (4, "a longer one")]
    got = {r[0]: r[3] for r in read(warc.read_warc(warc.write_warc(pages(llm, rows), min_revisit_bytes=10)))}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_empty_table(llm):
    assert read(warc.read_warc(warc.write_warc(pages(llm, [])))) == []


def test_archives_open_with_zipfile(llm):
    manifest = warc.write_warc(pages(llm, [(1, "one"), (2, "two")]).coalesce(1)).collect()
    with zipfile.ZipFile(manifest[0]["archive"].removeprefix("file://")) as z:
        assert z.testzip() is None and z.namelist() == [warc.DATA_MEMBER, warc.INDEX_MEMBER]
        assert gzip.decompress(z.read(warc.DATA_MEMBER)).count(b"WARC/1.1\r\n") == 2


def made_by_zipfile(names, comment=b"", method=zipfile.ZIP_STORED):
    f = io.BytesIO()
    with zipfile.ZipFile(f, "w", method) as z:
        for n in names:
            z.writestr(n, f"data of {n}")
        z.comment = comment
    return f


@pytest.mark.parametrize("names,comment", [
    (["a.txt", "ü/b.txt"], b""), (["a"], b"PK\5\6 a comment with the mark" * 50), ([], b""),
    ([f"f{i}" for i in range(70_000)], b"")])  # more entries than 16 bits: ZIP64
def test_reads_other_writers_archives(names, comment):
    f = made_by_zipfile(names, comment)
    members = warc.zip_members(f, len(f.getvalue()))
    assert [m["name"] for m in members] == names
    for m in members[:3]:
        assert warc._read_at(f, warc.member_at(f, m), m["size"]) == f"data of {m['name']}".encode()


def test_zip64_offsets_and_sizes():
    f = io.BytesIO()
    z = warc.ZipWriter(f, zip64=True)
    at = z.add("a", [b"12", b"345"])
    z.close()
    (m,) = warc.zip_members(f, len(f.getvalue()))
    assert m["size"] == 5 and warc.member_at(f, m) == at and f.getvalue()[at:at + 5] == b"12345"
    assert struct.unpack_from("<I", f.getvalue(), 18)[0] == 0xFFFFFFFF
    with zipfile.ZipFile(f) as other:
        assert other.read("a") == b"12345"


def test_broken_archives_and_compressed_members_raise():
    for data in (b"", b"no archive", made_by_zipfile(["a"]).getvalue()[:-5]):
        with pytest.raises(ValueError):
            warc.zip_members(io.BytesIO(data), len(data))
    f = made_by_zipfile(["a"], method=zipfile.ZIP_DEFLATED)
    (m,) = warc.zip_members(f, len(f.getvalue()))
    with pytest.raises(ValueError, match="compressed"):
        warc.member_at(f, m)


def test_record_with_wrong_digest_raises():
    good = warc.warc_record(1, "u", b"payload", warc.payload_digest(b"payload"), None)
    assert warc.parse_record(good)["payload"] == b"payload"
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(good.replace(b"payload\r\n\r\n", b"paYload\r\n\r\n"))
    with pytest.raises(ValueError):
        warc.parse_record(good[:-6])
