"""Converter of legacy ARC archives to WARC.

An ARC archive begins with a version block, ``filedesc://...``, whose first content line names the
version of its header lines: version 1 has URL, address, date, type and length, version 2 also result
code, checksum, location, offset and file name. A record is a header line, as many bytes as its last
field declares, and a line break. The converter follows the declared lengths, never the content, and
makes a WARC record of each: an identifier derived from what the record says of itself, the 14-digit
date as a timestamp, the HTTP response as its block, and SHA-1 digests of block and payload.

Of records with equal payloads of at least 1000 bytes, the one with the largest page number is the
response, and the others refer to it and hold no payload (identical-payload-digest profile). Their
digests and counts travel in a small table; it is broadcast if it is counted to fit and joined by
shuffle otherwise, so pages are not shuffled for it as a rule.

Archives are written by Spark as gzip files of some ``ARCHIVE_BYTES`` and read back as files.

Null html: an empty payload. Null url: ``urn:page:N``. Null page_id: the record is a response, named by
its payload, and nothing refers to it. Rows with equal page_id and equal payload are all responses, or
all revisits of a larger page. An archive that is cut off or declares wrong lengths raises ValueError.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.llm import textbatch as tb
from obslake.llm.tables import checked_join
from obslake.session import materialise, work_folder

ARCHIVE_BYTES = 8 << 20
#: Pages of one legacy archive that is made for a test or a query.
PAGES_PER_ARC = 200
LEAST_REVISIT = 1000
#: Field names of the two header lines, as the version blocks spell them.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "20200101000000"
END = b"\r\n\r\n"


# --- making legacy archives -------------------------------------------------------------------

def _quoted(url: str) -> str:
    """A URL without the blanks that separate header fields; null and empty ones get a name."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def make_arc(pages: list[tuple[int | None, str | None, bytes]], version: int, name: str) -> bytes:
    """A legacy archive of (page number, URL, payload) records."""
    block = f"{version} 0 obslake\n{FIELDS[version]}\n".encode()
    head = f"filedesc://{name} 0.0.0.0 {DATE} text/plain"
    head += f" {len(block)}\n" if version == 1 else f" 200 - - 0 {name} {len(block)}\n"
    out = [head.encode(), block, b"\n"]
    at = sum(map(len, out))
    for number, url, payload in pages:
        content = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        if number is not None:
            content += f"X-Page: {number}\r\n".encode()
        content += f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload
        line = f"{_quoted(url or '') or f'urn:page:{number}'} 0.0.0.0 {DATE} text/html"
        if version == 1:
            line += f" {len(content)}\n"
        else:
            line += f" 200 {hashlib.sha1(content).hexdigest()} - {at} {name} {len(content)}\n"
        record = [line.encode(), content, b"\n"]
        out += record
        at += sum(map(len, record))
    return b"".join(out)


def _pack(batches):
    made = 0
    for batch in tb.pieces(batches, "html"):
        for low in range(0, batch.num_rows, PAGES_PER_ARC):
            part = batch.slice(low, PAGES_PER_ARC)
            pages = [(n, u, (h or "").encode()) for n, u, h in zip(
                *(tb.column_of(part, c).to_pylist() for c in ("page_id", "url", "html")))]
            version = 1 + made % 2
            made += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([make_arc(pages, version, f"{made}.arc")], pa.binary())], names=["content"])


def pages_to_arcs(pages: DataFrame) -> DataFrame:
    """Legacy archives of both versions, one per row in ``content``."""
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return source.mapInArrow(_pack, "content binary")


# --- reading legacy archives ------------------------------------------------------------------

def read_arc(data: bytes):
    """(header fields, content) of every record after the version block."""
    at, version = 0, None
    while at < len(data):
        stop = data.find(b"\n", at)
        if stop < 0:
            raise ValueError(f"header line at {at} is cut off")
        line = data[at:stop].decode("utf-8", "surrogateescape").split(" ")
        length = int(line[-1])
        content = data[stop + 1:stop + 1 + length]
        if len(content) < length or data[stop + 1 + length:stop + 2 + length] not in (b"\n", b""):
            raise ValueError(f"record at {at} does not end where its length says")
        at = stop + 2 + length
        if line[0].startswith("filedesc://"):
            version = int(content.split(b" ", 1)[0])
            if version not in FIELDS:
                raise ValueError(f"unknown version {version}")
            continue
        if version is None:
            raise ValueError("no version block before the first record")
        names = FIELDS[version].split(" ")
        if len(line) != len(names):
            raise ValueError(f"header line at {at} has {len(line)} fields, version {version} has {len(names)}")
        yield dict(zip(names, line)), content


def http_parts(content: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """(header block, its fields, payload) of an HTTP response."""
    head, found, payload = content.partition(END)
    if not found:
        return b"", {}, content
    fields = dict(line.split(": ", 1) for line in head.decode("latin-1").split("\r\n")[1:] if ": " in line)
    return head + found, fields, payload


RECORD = ("page_id long, url string, date string, mime string, head binary, payload binary, digest string, "
          "size long")


def _convert(with_payload: bool):
    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows = {k: [] for k in ("page_id", "url", "date", "mime", "head", "payload", "digest", "size")}
                held = 0
                for fields, record in read_arc(content.as_py()):
                    head, http, payload = http_parts(record)
                    number = http.get("X-Page")
                    rows["page_id"].append(None if number is None else int(number))
                    rows["url"].append(fields["URL"].encode("utf-8", "surrogateescape").decode("utf-8", "replace"))
                    rows["date"].append(fields["Archive-date"])
                    rows["mime"].append(fields["Content-type"])
                    rows["head"].append(head if with_payload else None)
                    rows["payload"].append(payload if with_payload else None)
                    rows["digest"].append(hashlib.sha1(payload).hexdigest())
                    rows["size"].append(len(payload))
                    held += len(record)
                    if held > 4 * tb.CHUNK:
                        yield _record_batch(rows)
                        rows, held = {k: [] for k in rows}, 0
                yield _record_batch(rows)
    return run


def _record_batch(rows):
    kinds = {"page_id": pa.int64(), "size": pa.int64(), "head": pa.binary(), "payload": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [pa.array(v, kinds.get(k, pa.string())) for k, v in rows.items()], names=list(rows))


def arcs_to_records(arcs: DataFrame, with_payload: bool = True) -> DataFrame:
    """Rows of the records of legacy archives in ``content``."""
    return arcs.select("content").mapInArrow(_convert(with_payload), RECORD)


# --- WARC -------------------------------------------------------------------------------------

def record_id(page_id: int | None, url: str, digest: str) -> str:
    """The same identifier whenever the same record is converted."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>"


def warc_record(row: dict) -> bytes:
    """A WARC 1.1 record without the two line breaks after it."""
    date = row["date"]
    stamp = f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"
    revisit = row["refers_to"] is not None
    block = row["head"] + (b"" if revisit else row["payload"])
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(row['page_id'], row['url'], row['digest'])}",
        f"WARC-Date: {stamp}", f"WARC-Target-URI: {row['url']}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Identified-Payload-Type: {row['mime']}",
        f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}",
        f"WARC-Payload-Digest: sha1:{row['digest']}"]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To-Page: {row['refers_to']}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + END + block


def _format(batches):
    for batch in tb.pieces(batches, "payload"):
        rows = [warc_record(row) for row in batch.to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["record"])


def write_warc(records: DataFrame, path: str, records_per_file: int = 0, compression: str = "gzip") -> None:
    """Write records, with ``refers_to``, as WARC files; Spark writes the bytes as they are."""
    formatted = records.mapInArrow(_format, "record binary").select(F.col("record").cast("string").alias("value"))
    formatted.write.option("lineSep", END.decode()).option("compression", compression).option(
        "maxRecordsPerFile", records_per_file).text(path)


def read_warc(data: bytes):
    """(header fields, block) of the records of an archive, by their declared lengths."""
    at = 0
    while at < len(data):
        stop = data.find(END, at)
        head = data[at:stop].decode("utf-8").split("\r\n") if stop >= 0 else [""]
        if not head[0].startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        fields = dict(line.split(": ", 1) for line in head[1:])
        length = int(fields["Content-Length"])
        block = data[stop + 4:stop + 4 + length]
        if len(block) < length or data[stop + 4 + length:stop + 8 + length] != END:
            raise ValueError(f"record at {at} does not end where its length says")
        at = stop + 8 + length
        yield fields, block


def _inflate(data: bytes) -> bytes:
    out = []
    while data:
        member = zlib.decompressobj(31)
        out.append(member.decompress(data) + member.flush())
        data = member.unused_data
    return b"".join(out)


def _read(batches):
    for batch in batches:
        for content in batch.column("content"):
            out = {"page_id": [], "url": [], "payload_bytes": [], "payload_digest": [], "record_type": [], "refers_to": []}
            raw = content.as_py()
            for fields, block in read_warc(_inflate(raw) if raw[:2] == b"\x1f\x8b" else raw):
                _, http, payload = http_parts(block)
                kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if f"sha1:{hashlib.sha1(block).hexdigest()}" != fields["WARC-Block-Digest"] or (
                        kind == "response" and hashlib.sha1(payload).hexdigest() != digest):
                    raise ValueError(f"{fields['WARC-Record-ID']} does not have its digest")
                number, refers = http.get("X-Page"), fields.get("WARC-Refers-To-Page")
                out["page_id"].append(None if number is None else int(number))
                out["url"].append(fields["WARC-Target-URI"])
                out["payload_bytes"].append(len(payload) if kind == "response" else int(http["Content-Length"]))
                out["payload_digest"].append(digest)
                out["record_type"].append(kind)
                out["refers_to"].append(None if refers is None else int(refers))
            kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64()}
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, kinds.get(k, pa.string())) for k, v in out.items()], names=list(out))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of the records in WARC files."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(
        _read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def convert(arcs: DataFrame, path: str) -> None:
    """Convert legacy archives (rows of ``content``) to WARC files under ``path``."""
    known = arcs_to_records(arcs, with_payload=False).select("page_id", "digest", "size")
    known = materialise(known, "payload-digests")
    shared = known.where((F.col("size") >= LEAST_REVISIT) & F.col("page_id").isNotNull()).groupBy("digest").agg(
        F.max("page_id").alias("last"), F.min("page_id").alias("first")).where(F.col("first") < F.col("last"))
    shared = materialise(shared.select("digest", "last"), "shared-payloads")
    records = checked_join(arcs_to_records(arcs), shared, "digest", "left", row_bytes=120)
    other = F.col("last") > F.col("page_id")
    records = records.withColumn("refers_to", F.when(other, F.col("last"))).drop("last")
    held = known.agg(F.coalesce(F.avg("size"), F.lit(0)).alias("n")).first()["n"]
    write_warc(records, path, records_per_file=max(1, int(ARCHIVE_BYTES // (held + 500))))


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages as legacy archives, converted, written, and read back."""
    path = work_folder(pages.sparkSession, "warc")
    convert(pages_to_arcs(pages), path)
    return read_archives(pages.sparkSession, path)
