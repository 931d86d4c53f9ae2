import base64
import hashlib
import io
import struct
import zipfile

import pytest

from slicewright.llm import warc
from slicewright.session import scratch_path


def test_round_trip(spark):
    big = "x" * 300_000
    rows = [(0, "u0", "a"), (1, "u1", "a"), (2, "u\r\n2", "b\r\n\r\nc"), (3, None, None), (4, "u4", ""), (5, "é", "éß "), (None, "u", "a"), (7, "u7", big), (6, "u6", big), (8, "u8", "twin"), (8, "u8", "twin"), (2**60, "u", None)]
    pages = spark.createDataFrame([(*r, "p", 1) for r in rows], "page_id long, url string, html string, payload string, sha1 int").repartition(4)
    folder = scratch_path(spark, "warc")
    packages = warc.write_packages(warc.record_types(pages), folder)
    got = warc.read_packages(packages, folder, with_payload=True).collect()
    assert len(got) == len(rows) and packages.agg({"records": "sum"}).first()[0] == len(rows)
    largest = {}
    for i, _, h in rows:
        largest[h or ""] = max(largest.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in rows:
        payload = (h or "").encode()
        first = i == largest[h or ""]
        want.append((-1 if i is None else i, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "response" if first else "revisit", -1 if first else largest[h or ""]))
    none = lambda x: -1 if x is None else x
    assert sorted((none(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], none(r["refers_to"])) for r in got) == sorted(want)
    assert all(bytes(r["payload"]) == ({i: h for i, _, h in rows}[r["page_id"]] or "").encode() for r in got if r["record_type"] == "response")
    empty = warc.round_trip(spark, pages.limit(0), scratch_path(spark, "warc"))
    assert empty.count() == 0


def members(data):
    return warc.directory(io.BytesIO(data), len(data))


def test_directory_of_plain_and_zip64_files():
    rows = [(k, "u", b"payload %d" % k, warc.payload_digest(b"payload %d" % k), "response", None) for k in range(5)]
    for zip64 in (True, False):
        to = io.BytesIO()
        warc.write_package(to, iter(rows), zip64)
        found = members(to.getvalue())
        with zipfile.ZipFile(io.BytesIO(to.getvalue())) as z:
            for name, (at, n) in found.items():
                assert to.getvalue()[at:at + n] == z.read(name)
        assert set(found) == {warc.WARC_MEMBER, warc.INDEX_MEMBER}


def test_zip64_end_record_and_comments():
    to = io.BytesIO()
    with zipfile.ZipFile(to, "w") as z:
        z.writestr("a", b"1234")
        z.comment = b"a comment with PK\x05\x06 inside"
    assert members(to.getvalue())["a"][1] == 4
    # the same file with its end record's numbers moved to a ZIP64 end record
    with zipfile.ZipFile(plain := io.BytesIO(), "w") as z:
        z.writestr("a", b"1234")
    data = plain.getvalue()
    end = data.rfind(warc.END)
    entries, length, start = struct.unpack("<HII", data[end + 10:end + 20])
    end64 = struct.pack("<4sQHHIIQQQQ", warc.END64, 44, 45, 45, 0, 0, entries, entries, length, start)
    locator = struct.pack("<4sIQI", warc.LOCATOR64, 0, end, 1)
    marked = struct.pack("<4sHHHHIIH", warc.END, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    assert members(data[:end] + end64 + locator + marked) == members(data)


def test_damage_is_noticed():
    with pytest.raises(ValueError):
        members(b"not a zip file")
    with zipfile.ZipFile(to := io.BytesIO(), "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"1234" * 100)
    with pytest.raises(ValueError):
        members(to.getvalue())
    record = warc.record_bytes(1, "u", b"abc", warc.payload_digest(b"abd"), "response", None)
    with pytest.raises(ValueError):
        warc.parse_record(record)


def test_hot_payload_and_missing_ids(spark):
    """A payload in most rows, spread over salts, with NULL and repeated ids."""
    rows = [(k, "u", "" if k % 3 else f"page {k % 40}") for k in range(1200)] + [(None, "u", ""), (None, "u", ""), (1199, "v", ""), (None, "u", "alone")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    largest = {}
    for i, _, html in rows:
        if i is not None:
            largest[html] = max(largest.get(html, i), i)
    got = sorted(((r["page_id"], r["url"], r["record_type"], r["refers_to"]) for r in warc.record_types(pages).collect()), key=str)
    want = []
    for i, url, html in rows:
        of = largest.get(html)
        revisit = of is not None and i != of
        want.append((i, url, "revisit" if revisit else "response", of if revisit else None))
    assert got == sorted(want, key=str)
