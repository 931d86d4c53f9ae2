"""WARC records in ZIP packages: write them, then read them back in place.

A package is a ZIP file of *stored* (uncompressed) members, so that any byte
of a member is a byte range of the package: ``archive/data.warc.gz`` (one gzip
member per record) and ``indexes/index.cdxj`` (one line per record with its
offset and length).  Each task writes its rows as one package and returns one
manifest row; the manifest is checkpointed, so packages of lost or repeated
attempts are never read.

The reader takes packages by range only: it parses the end record, the ZIP64
locator and directory where they are present, the central directory with its
ZIP64 extra fields and each member's local header; it lists the index members
by range, and reads runs of neighbouring records of about ``RUN_BYTES``.
Nothing is extracted.

Defined results: NULL html is an empty payload; of rows with equal payloads
those with the largest page id are responses and the rest revisits (repeated
rows that hold the largest id are all responses; NULL ids count as smallest);
an empty table gives no rows; a very long payload is one record, held whole;
extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .hot import at_every_salt, dealt, hot_keys
from .scratch import written

WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
#: Bytes of neighbouring records that one range read takes together.
RUN_BYTES = 4 << 20
#: Fixed values of the ZIP format: signatures and the mark of a ZIP64 field.
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
MARK16, MARK32 = 0xFFFF, 0xFFFFFFFF


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def filesystem(uri: str):
    """File system and path of a folder or file that all executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + uri)


# -- records ---------------------------------------------------------------

def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record.  A revisit keeps the HTTP header (with the payload's length) and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Target-URI: {target}",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(lines: bytes) -> dict[str, str]:
    pairs = (line.split(b":", 1) for line in lines.split(b"\r\n")[1:] if b":" in line)
    return {k.decode().lower(): v.strip().decode("utf-8", "surrogatepass") for k, v in pairs}


def parse_record(data: bytes) -> dict:
    """A record's page id, type, payload (None for a revisit), payload length and digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = _fields(head)
    block = rest[:int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = warc["warc-type"] == "revisit"
    urn = lambda key: int(x) if (x := warc[key].removeprefix("<urn:page:").rstrip(">")) else None
    length = int(_fields(http)["content-length"])
    digest = warc["warc-payload-digest"].removeprefix("sha1:")
    if not revisit and (len(payload) != length or payload_digest(payload) != digest):
        raise ValueError(f"record {warc['warc-record-id']}: the payload does not match its length or digest")
    return {
        "page_id": urn("warc-record-id"), "url": warc["warc-target-uri"], "payload": None if revisit else payload, "payload_bytes": length,
        "payload_digest": digest, "record_type": warc["warc-type"], "refers_to": urn("warc-refers-to") if revisit else None,
    }


# -- packages --------------------------------------------------------------

class _Counted:
    """A write-only stream that knows its position."""

    def __init__(self, to):
        self.to, self.at = to, 0

    def write(self, data) -> int:
        self.to.write(data)
        self.at += len(data)
        return len(data)

    def flush(self) -> None:
        pass


def write_package(to, rows: Iterator[tuple], zip64: bool = True) -> int:
    """Write rows (page_id, url, payload, digest, kind, refers_to) as a package to a stream; the number of records."""
    index = io.BytesIO()
    with zipfile.ZipFile(_Counted(to), "w", zipfile.ZIP_STORED) as z:
        with z.open(WARC_MEMBER, "w", force_zip64=zip64) as member:
            offset = n = 0
            for row in rows:
                data = gzip.compress(record_bytes(*row), 1, mtime=0)
                member.write(data)
                index.write(json.dumps({"id": row[0], "offset": offset, "length": len(data)}).encode() + b"\n")
                offset += len(data)
                n += 1
        with z.open(INDEX_MEMBER, "w", force_zip64=zip64) as member:
            member.write(index.getvalue())
    return n


def read_range(file, offset: int, length: int) -> bytes:
    file.seek(offset)
    data = file.read(length)
    if len(data) != length:
        raise ValueError(f"range {offset}+{length} lies beyond the file")
    return data


def directory(file, size: int) -> dict[str, tuple[int, int]]:
    """Byte range (offset, length) of every stored member, from the central directory."""
    tail_at = max(0, size - 22 - MARK16)
    tail = read_range(file, tail_at, size - tail_at)
    at = tail.rfind(END)
    while at >= 0 and at + 22 + int.from_bytes(tail[at + 20:at + 22], "little") != len(tail):
        at = tail.rfind(END, 0, at)  # the signature inside a comment
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP file, or cut short")
    entries, length, start = struct.unpack("<HII", tail[at + 10:at + 20])
    if MARK16 == entries or MARK32 in (length, start):
        locator = read_range(file, tail_at + at - 20, 20)
        if locator[:4] != LOCATOR64:
            raise ValueError("a ZIP64 field without a ZIP64 locator")
        end64 = read_range(file, struct.unpack("<Q", locator[8:16])[0], 56)
        if end64[:4] != END64:
            raise ValueError("no ZIP64 end of central directory where the locator points")
        entries, length, start = struct.unpack("<QQQ", end64[32:56])
    listing, members, at = read_range(file, start, length), {}, 0
    for _ in range(entries):
        if listing[at:at + 4] != ENTRY:
            raise ValueError("the central directory is damaged")
        method, = struct.unpack("<H", listing[at + 10:at + 12])
        packed, full, n_name, n_extra, n_comment = struct.unpack("<IIHHH", listing[at + 20:at + 34])
        local, = struct.unpack("<I", listing[at + 42:at + 46])
        name = listing[at + 46:at + 46 + n_name].decode("utf-8")
        extra, wide = listing[at + 46 + n_name:at + 46 + n_name + n_extra], b""
        while len(extra) >= 4:
            tag, n = struct.unpack("<HH", extra[:4])
            wide, extra = (extra[4:4 + n] if tag == 1 else wide), extra[4 + n:]
        for field in ("full", "packed", "local"):  # the ZIP64 field holds only what is marked, in this order
            if {"full": full, "packed": packed, "local": local}[field] == MARK32:
                value, wide = struct.unpack("<Q", wide[:8])[0], wide[8:]
                full, packed, local = (value if field == "full" else full, value if field == "packed" else packed, value if field == "local" else local)
        if method != 0:
            raise ValueError(f"{name}: only stored members can be read by range")
        header = read_range(file, local, 30)
        if header[:4] != LOCAL:
            raise ValueError(f"{name}: no local header where the directory points")
        n_name_local, n_extra_local = struct.unpack("<HH", header[26:30])
        members[name] = (local + 30 + n_name_local + n_extra_local, packed)
        at += 46 + n_name + n_extra + n_comment
    return members


# -- Spark -----------------------------------------------------------------

def record_types(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, digest, record type and refers_to of every row."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    # partners are found by id and digest alone, and only digests that occur twice have one
    keys = rows.where(F.octet_length("payload") >= least_bytes).select("page_id", "sha1")
    counted = keys.groupBy("sha1").agg(F.count("*").alias("n"), F.max("page_id").alias("of")).where("n > 1")
    twice = written(counted)
    hot = hot_keys(twice, "sha1", twice.agg(F.sum("n")).first()[0] or 0)
    partners = dealt(keys, "sha1", hot, ["page_id"]).join(at_every_salt(twice.drop("n"), "sha1", hot), ["sha1", "salt"])
    partners = partners.where(~F.col("page_id").eqNullSafe(F.col("of"))).select(F.col("page_id").alias("of_page"), F.col("sha1").alias("of_sha1"), "of").distinct()
    met = rows.join(partners, F.col("page_id").eqNullSafe(F.col("of_page")) & (F.col("sha1") == F.col("of_sha1")), "left")
    revisit = F.col("of").isNotNull()
    return met.select(
        "page_id", "url", "payload", F.unhex("sha1").alias("sha1"), F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("of").alias("refers_to"),
    )


def write_packages(records: DataFrame, folder: str) -> DataFrame:
    """Write a package per task under ``folder`` (shared); (path, size, records) of the packages, checkpointed."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = filesystem(folder)
        path = f"{root}/{uuid.uuid4().hex}.wacz"

        def rows(first: pd.DataFrame) -> Iterator[tuple]:
            for pdf in (b for part in ([first], batches) for b in part):
                for page_id, url, payload, sha1, kind, refers in zip(*(pdf[c] for c in ("page_id", "url", "payload", "sha1", "record_type", "refers_to"))):
                    yield page_id and int(page_id), url, payload, base64.b32encode(sha1).decode(), kind, refers and int(refers)

        first = next((b for b in batches if len(b)), None)
        if first is not None:
            system.create_dir(root, recursive=True)
            with system.open_output_stream(path) as to:
                n = write_package(to, rows(first))
            yield pd.DataFrame({"path": [path], "size": [system.get_file_info(path).size], "records": [n]})

    ids = (F.col(c).cast("string").alias(c) for c in ("page_id", "refers_to"))  # as text: pandas has no NULL among integers
    return records.select(*ids, "url", "payload", "sha1", "record_type").mapInPandas(write, "path string, size long, records long").checkpoint()


def read_packages(packages: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Every record of the packages listed in ``packages`` (path, size), by range reads."""
    parts = packages.sparkSession.sparkContext.defaultParallelism

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, _ = filesystem(folder)
        for pdf in batches:
            for path, size in zip(pdf["path"], pdf["size"]):
                with system.open_input_file(path) as file:
                    members = directory(file, int(size))
                    base = members[WARC_MEMBER][0]
                    out, begin, lengths = [], 0, []
                    for line in read_range(file, *members[INDEX_MEMBER]).splitlines():
                        entry = json.loads(line)
                        if lengths and entry["offset"] + entry["length"] - begin > RUN_BYTES:
                            out.append((path, base + begin, lengths))
                            begin, lengths = entry["offset"], []
                        lengths.append(entry["length"])
                    if lengths:
                        out.append((path, base + begin, lengths))
                yield pd.DataFrame(out, columns=["path", "offset", "lengths"])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, _ = filesystem(folder)
        for pdf in batches:
            for path, offset, lengths in zip(pdf["path"], pdf["offset"], pdf["lengths"]):
                with system.open_input_file(path) as file:
                    data, at, out = read_range(file, int(offset), int(sum(lengths))), 0, []
                for n in lengths:
                    out.append(parse_record(gzip.decompress(data[at:at + n])))
                    at += n
                frame = pd.DataFrame(out)
                yield (frame if with_payload else frame.drop(columns="payload")).astype({"page_id": "Int64", "refers_to": "Int64"})

    listed = packages.select("path", "size").mapInPandas(runs, "path string, offset long, lengths array<long>")
    schema = f"page_id long, url string, {'payload binary, ' if with_payload else ''}payload_bytes long, payload_digest string, record_type string, refers_to long"
    return listed.repartition(max(2, parts)).mapInPandas(read, schema)


def round_trip(spark: SparkSession, pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` as packages under ``folder`` and read every record back."""
    return read_packages(write_packages(record_types(pages), folder), folder)


__all__ = ["directory", "parse_record", "payload_digest", "read_packages", "record_bytes", "record_types", "round_trip", "write_package", "write_packages"]
