import gzip
import hashlib

import pytest

from obslake.llm import legacy_archive as la
from obslake.session import work_folder

BIG = "<html>" + "payload " * 200 + "</html>"
PAGES = [
    (1, "http://a.example/x", BIG), (2, None, BIG), (9, "http://b.example/ blank\ttab", BIG), (9, "http://c.example", BIG),
    (3, "http://d.example", "small"), (4, "http://e.example", "small"), (5, "", None), (6, "http://f.example/é", ""),
    (7, "http://g.example", "line\r\n\r\nWARC/1.1\r\n\r\nfiledesc://\nend\n" * 40), (None, "http://h.example", BIG),
    (None, None, None), (8, "u", "x" * 300_000),
]


def expected(pages):
    last = {}
    for n, _, h in pages:
        raw = (h or "").encode()
        if len(raw) >= 1000 and n is not None:
            last[raw] = max(n, last.get(raw, n))
    out = []
    for n, _, h in pages:
        raw = (h or "").encode()
        of = last.get(raw)
        revisit = n is not None and of is not None and n < of
        out.append((n, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", of if revisit else None))
    return sorted(out, key=repr)


def test_pages_survive_both_archives(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    rows = la.round_trip(df.repartition(3)).collect()
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=repr)
    assert got == expected(PAGES)


def test_clashing_columns_and_no_rows(spark):
    df = spark.createDataFrame([(1, "u", "h", "x", 2)], "page_id long, url string, html string, digest string, size int")
    assert la.round_trip(df).count() == 1
    assert la.round_trip(df.limit(0)).collect() == []


@pytest.mark.parametrize("version", [1, 2])
def test_legacy_archives_are_read_by_length(version):
    pages = [(1, "http://a b", b"one\nfiledesc://x 1 2 3 4\n"), (2, None, b""), (None, "http://c", b"\n\n\n")]
    data = la.make_arc(pages, version, "t.arc")
    records = list(la.read_arc(data))
    assert [la.http_parts(c)[2] for _, c in records] == [p for _, _, p in pages]
    assert [f["URL"] for f, _ in records] == ["http://a%20b", "urn:page:2", "http://c"]
    assert set(records[0][0]) == set(la.FIELDS[version].split(" "))
    if version == 2:
        # offsets are those of the records
        assert all(data[int(f["Offset"]):].startswith(f["URL"].encode()) for f, _ in records)


@pytest.mark.parametrize("broken, message", [
    (lambda d: d[:-30], "does not end|cut off"), (lambda d: d.replace(b"text/html 1", b"text/html 9", 1), "does not end"),
    (lambda d: b"http://x 0 0 text/html 0\n\n" + d, "no version block"), (lambda d: d.replace(b"1 0 obslake", b"7 0 obslake"), "unknown version"),
    (lambda d: d[:1000] if False else d.replace(b" 0.0.0.0 20200101000000 text/html", b" text/html", 1), "fields"),
])
def test_broken_legacy_archives_raise(broken, message):
    data = la.make_arc([(1, "http://a", b"content of it")], 1, "t.arc")
    with pytest.raises(ValueError, match=message):
        list(la.read_arc(broken(data)))


def test_files_are_warc_archives(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    path = work_folder(spark, "warc-test")
    la.convert(la.pages_to_arcs(df), path)
    files = spark.read.format("binaryFile").load(path).collect()
    seen = {}
    for f in files:
        for fields, block in la.read_warc(gzip.decompress(f["content"])):
            assert fields["WARC-Date"] == "2020-01-01T00:00:00Z"
            assert int(fields["Content-Length"]) == len(block)
            assert fields["WARC-Block-Digest"] == f"sha1:{hashlib.sha1(block).hexdigest()}"
            seen.setdefault(fields["WARC-Record-ID"], []).append(fields["WARC-Type"])
    assert sum(map(len, seen.values())) == len(PAGES)


def test_broken_digest_raises(spark, tmp_path):
    from pyspark.errors import PythonException

    row = {"date": la.DATE, "head": b"", "payload": b"abc", "refers_to": None, "page_id": 1, "url": "u", "digest": "0" * 40, "mime": "m"}
    (tmp_path / "x.warc").write_bytes(la.warc_record(row) + la.END)
    with pytest.raises(PythonException, match="does not have its digest"):
        la.read_archives(spark, str(tmp_path)).collect()
