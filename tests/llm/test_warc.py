import hashlib

import pytest

from tickloom.llm import warc
from tickloom.llm.queries import load, op9_warc

PAGE = "<html>" + "x" * 200 + "é</html>"
PAGES = [
    (5, "http://a/5", PAGE),
    (3, "http://a/3\r\nX: y", PAGE),
    (3, "http://a/3\r\nX: y", PAGE),
    (9, None, PAGE),
    (None, "http://a/null", PAGE),
    (1, "u", "short"),
    (2, "u", "short"),
    (6, "u", None),
    (7, "u", ""),
    (8, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 30_000),
]
COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def plain(rows):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    many = [h or "" for _, _, h in rows]
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        lead = first.get(html or "") if len(data) >= 100 and many.count(html or "") > 1 else None
        other = lead if page_id != lead else None
        kind = "response" if other is None else "revisit"
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), kind, other))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_edge_rows(spark):
    pages = spark.createDataFrame([(*r, 1) for r in PAGES], "page_id long, url string, html string, payload int")
    assert got(warc.archive_round_trip(pages)) == plain(PAGES)


def test_query(spark, sf_dir):
    rows = [(r["page_id"], r["url"], r["html"]) for r in load(spark, sf_dir, "pages").collect()]
    assert got(op9_warc(spark, sf_dir)) == plain(rows)


def test_index_reads_only_what_is_asked(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    index = warc.write_archives(pages, str(tmp_path / "warc"), archive_bytes=300)
    found = warc.read_records(index.where("page_id in (1, 8)"), gap=0, most=100).collect()
    assert {r["page_id"]: r["payload"].decode() for r in found} == {1: "short", 8: PAGES[-1][2]}
    assert index.select("archive").distinct().count() > 1


@pytest.mark.parametrize("gap, reads", [(0, 3), (5, 2), (100, 1)])
def test_ranges_coalesce(gap, reads):
    assert len(warc.coalesced([(0, 10), (10, 5), (20, 5), (60, 5)], gap, 1000)) == reads


def test_a_changed_record_is_noticed():
    row = {"page_id": 1, "url": "u", "payload": b"abc", "digest": hashlib.sha256(b"abc").hexdigest(), "refers_to": None}
    data = warc.record(row, warc.EPOCH)
    assert warc.parse(data)["payload"] == b"abc"
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"\r\n\r\nabc", b"\r\n\r\nabd"))


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_round_trip(pages).collect() == []
