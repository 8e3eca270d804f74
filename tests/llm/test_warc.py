import glob
import gzip

import pytest

from tickloom.llm import warc
from tickloom.sources.writers import scratch_path

PAGES = "page_id long, url string, html string, digest string, size int"


def captures(spark, rows, **more):
    path = scratch_path(spark, "test-warc")
    warc.write_warc(spark.createDataFrame(rows, PAGES), path, **more)
    return path, warc.transactions(warc.read_warc(spark, path)).collect()


def test_round_trip(spark):
    rows = [
        (1, "http://a.example/x?y=1", "<p>é</p>", "d", 0), (5, "http://b.example/", "same", "d", 0), (2, "http://c.example/", "same", None, None), (9, None, "same", "d", 0),
        (3, "http://d.example/", None, "d", 0), (4, "bad url\r\nX: y", "", "d", 0), (None, "http://e.example/", "same", "d", 0),
        (6, "http://f.example/", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nxyz\r\n\r\n\r\n", "d", 0), (7, "u", "z" * 300_000, "d", 0),
    ]
    path, got = captures(spark, rows)
    pages = {r.metadata.fields.get("page-id"): r for r in got}
    assert len(got) == len(rows) == len(pages)
    first = {}
    for page_id, _, html, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        r = pages[None if page_id is None else str(page_id)]
        body = (html or "").encode()
        revisit = body in first
        first.setdefault(body, page_id)
        assert r.type == ("revisit" if revisit else "response")
        assert r.digest == warc.digest(body) and r.http_length == len(body)
        assert bytes(r.payload) == (b"" if revisit else body)
        assert r.metadata.fields.get("first-page-id") == (str(first[body]) if revisit else None)
        if revisit:
            assert r.refers_to == pages[str(first[body])].record_id
        assert bytes(r.request.payload) == b"" and r.request.record_id != r.record_id
    whole = b"".join(gzip.open(f).read() for f in glob.glob(f"{path}/*.gz"))
    assert whole.count(b"WARC-Record-ID") == 3 * len(rows) and whole.endswith(b"\r\n\r\n")


def test_repeated_rows_and_small_payloads(spark):
    rows = [(1, "u", "ab", "d", 0), (1, "u", "ab", "d", 0), (2, "u", "ab", "d", 0)]
    _, got = captures(spark, rows)
    assert sorted((r.metadata.fields["page-id"], r.type) for r in got) == [("1", "response"), ("1", "response"), ("2", "revisit")]
    _, got = captures(spark, rows, min_revisit_bytes=3)
    assert [r.type for r in got] == ["response"] * 3


def test_cut_off_record_raises(spark, tmp_path):
    with gzip.open(tmp_path / "x.warc.gz", "wb") as f:
        f.write(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 10\r\n\r\nabc")
    with pytest.raises(Exception, match="cut off"):
        warc.read_warc(spark, str(tmp_path)).collect()


def test_empty_table(spark):
    assert captures(spark, [])[1] == []
