import hashlib

import pytest

from duolect.llm.warc import parse, read_archive, round_trip, write_archive


@pytest.fixture(scope="module")
def pages(spark):
    long, other = "<p>" + "é" * 600, "x" * 1000
    rows = [(1, "http://a", long), (2, "http://b/ü", long), (3, None, long), (4, "http://c", "short"), (5, "http://d", "short"),
            (6, "http://e\r\nX: y", None), (7, "http://f", ""), (8, "http://g", other), (8, "http://g", other), (9, "http://h", "x" * 999),
            (10, "http://i", "x" * 999), (None, "http://j", long), (None, None, "alone"), (11, "u", "WARC/1.1\r\n\r\nHTTP/1.1\r\n\r\n"), (12, "u", "y" * 300_000)]
    return spark.createDataFrame([(*r, "x", 3) for r in rows], "page_id long, url string, html string, address string, copies int")


def expected(rows):
    groups = {}
    for page, html in rows:
        if page is not None:
            groups[html or ""] = max(groups.get(html or "", page), page)
    found = []
    for page, html in rows:
        data = (html or "").encode()
        revisit = len(data) >= 1000 and page is not None and page < groups[html]
        found.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", groups[html] if revisit else None))
    return sorted(map(str, found))


def test_round_trip(pages):
    assert sorted(str(tuple(r)) for r in round_trip(pages).collect()) == expected([(r.page_id, r.html) for r in pages.collect()])


def test_archive_stores_each_payload_once_and_gives_the_records_back(spark, pages, scratch):
    write_archive(pages, f"{scratch}/archive")
    stored = spark.read.parquet(f"{scratch}/archive/payloads")
    assert stored.count() == len({r.html or "" for r in pages.collect()}) == stored.select("address").distinct().count()
    for r in read_archive(spark, f"{scratch}/archive").collect():
        record, header, payload = bytes(r.record), bytes(r.header), bytes(r.payload)
        kind = "revisit" if b"WARC-Type: revisit" in header else "response"
        assert record == header + (payload if kind == "response" else b"") + b"\r\n\r\n" and record.startswith(b"WARC/1.1\r\n")
        length = int(header.split(b"\r\nContent-Length: ")[1].split(b"\r\n")[0])
        assert len(record) == header.index(b"\r\n\r\n") + 4 + length + 4
        assert b"\r\nX: y" not in header


def test_changed_payload_is_noticed(spark, pages, scratch):
    write_archive(pages.where("page_id = 4"), f"{scratch}/archive")
    spark.read.parquet(f"{scratch}/archive/payloads").selectExpr("address", "cast('other' as binary) as payload", "copies").write.parquet(
        f"{scratch}/changed/payloads")
    spark.read.parquet(f"{scratch}/archive/records").write.parquet(f"{scratch}/changed/records")
    with pytest.raises(Exception, match="payload differs"):
        parse(read_archive(spark, f"{scratch}/changed")).collect()


def test_empty_table(pages):
    assert round_trip(pages.limit(0)).count() == 0
