import base64
import hashlib

import pytest

from voltcube.llm import warc

PAGES = [(1, "http://a/", "same"), (2, "http://b/", "same"), (3, None, None), (4, "u", ""), (5, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 3), (6, "u", "é日" * 40_000),
         (7, "u", "é日" * 40_000), (8, "u\r\nEvil: 1", "x" * 32_768), (None, "u", "same"), (9, "u", "0\r\n\r\n")]


@pytest.fixture(scope="module")
def pages(spark):
    from voltcube.llm.common import ship
    ship(spark)
    return spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, payload int")


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("least,segment", [(0, 32 << 10), (0, 100), (5, 1000)])
def test_round_trip(spark, pages, tmp_path, least, segment):
    path = f"file://{tmp_path}/w"
    warc.write_archives(pages, path, least=least, segment_bytes=segment)
    rows = warc.read_archives(spark, path).collect()
    assert len(rows) == len(PAGES) and all(r.intact for r in rows)
    by = {r.page_id: r for r in rows}
    for i, url, html in PAGES:
        data = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        first = min(same) if i is not None and len(data) >= least else i
        r = by[i]
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(data), digest(html), "response" if first == i else "revisit", None if first == i else first)
        assert r.payload == (data if first == i else None)
    assert by[8].url == "uEvil: 1"


def test_repeated_rows_and_empty(spark, pages):
    twice = pages.union(pages.filter("page_id = 1"))
    rows = warc.round_trip(twice).collect()
    assert [r.record_type for r in rows if r.page_id == 1] == ["response"] * 2 and len(rows) == len(PAGES) + 1
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_broken_archives_are_told():
    out = warc.page_records(0, 1, "u", b"x" * 500, None, 120)
    assert len(out) > 4
    fields = [next(warc.parse(r + warc.END))[0] for r in out]
    assert [f["warc-type"] for f in fields] == ["response"] + ["continuation"] * (len(out) - 1)
    assert {f["warc-segment-origin-id"] for f in fields[1:]} == {fields[0]["warc-record-id"]} and "warc-segment-total-length" in fields[-1]
    with pytest.raises(ValueError):
        warc.dechunked(b"5\r\nabc\r\n0\r\n\r\n")
    with pytest.raises(ValueError):
        list(warc.parse(b"HTTP/1.1 200\r\n\r\n"))
    assert warc.dechunked(b"3;ext=1\r\nabc\r\n0\r\n\r\n") == b"abc" and warc.dechunked(warc.chunked(b"a" * 20_000, 8192)) == b"a" * 20_000


def test_missing_segment(spark, pages, tmp_path):
    import gzip
    records = warc.page_records(0, 1, "u", b"x" * 500, None, 120)
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "part-0.txt.gz").write_bytes(gzip.compress(b"".join(r + warc.END for r in records[::-1] if r is not records[2])))
    (tmp_path / "w" / "part-1.txt.gz").write_bytes(gzip.compress(b"".join(r + warc.END for r in warc.page_records(1, 2, "u", b"y" * 500, None, 120)[::-1])))
    got = {r.page_id: r for r in warc.read_archives(spark, f"file://{tmp_path}/w").collect()}
    assert not got[1].intact and got[2].intact and got[2].payload == b"y" * 500
