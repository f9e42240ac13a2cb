import gzip
import hashlib
from collections import Counter

from casegrid.llm import warc as W


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, `offset` string, archive string")


def edge_rows():
    big = "<html>" + "é" * 400 + "</html>"
    rows = [(5, "http://a/ b", big), (3, "http://a/c", big), (9, None, big), (4, "u", "x" * 99), (6, "u", "x" * 99),
            (7, "u", "y" * 100), (8, "u", "y" * 100), (1, "u", None), (2, "u", ""), (None, "u", big),
            (10, "u\r\nx: y", "a\r\n\r\nWARC/1.1\r\n\r\nb"), (11, "ü", "z" * 300_000), (3, "http://a/c", big)]
    return [(*r, "c", "d") for r in rows]


def expected(rows):
    first = {}
    for i, _, h, *_ in rows:
        body = (h or "").encode()
        if len(body) >= 100 and i is not None:
            first[body] = min(first.get(body, i), i)
    out = Counter()
    for i, _, h, *_ in rows:
        body = (h or "").encode()
        to = first.get(body)
        again = to is not None and i is not None and to < i
        out[i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", to if again else None] += 1
    return out


def found(rows):
    return Counter((r["record_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in rows)


def test_edge_rows_round_trip(spark):
    rows = edge_rows()
    index = W.archive_pages(pages(spark, rows).repartition(3))
    read = W.read_records(index).collect()
    assert found(read) == expected(rows) == found(index.collect())
    for r in read:
        if r["record_type"] == "response":
            assert hashlib.sha256(bytes(r["payload"])).hexdigest() == r["payload_digest"]
        else:
            assert r["payload"] is None
    url = {r["record_id"]: r["url"] for r in read}
    assert url == {i: u or "" for i, u, *_ in rows}


def test_urls_come_back_as_they_are(spark):
    urls = ["a/b c", "a/b%20c", "a/b\tc", "a/b", "%", "ü \u2028 ü", " ", "x\r\nWARC-Type: y"]
    read = W.read_records(W.archive_pages(pages(spark, [(k, u, "h", "", "") for k, u in enumerate(urls)]))).collect()
    assert {r["record_id"]: r["url"] for r in read} == dict(enumerate(urls))
    plain = W.record_bytes({"record_type": "response", "payload": b"", "record_id": 1, "url": "a/b%20c",
                            "payload_digest": "0", "payload_bytes": 0, "refers_to": None})
    assert b"WARC-Target-URI: a/b%20c\r\n" in plain and b"X-Source-URL" not in plain


def test_archives_are_valid_members(spark):
    index = W.archive_pages(pages(spark, edge_rows()).repartition(2)).collect()
    for archive in {r["archive"] for r in index}:
        fs, path = W._open(archive)
        with fs.open_input_file(path) as f:
            data = f.read()
        own = sorted((r for r in index if r["archive"] == archive), key=lambda r: r["offset"])
        at = 0
        for r in own:  # members lie end to end and each is one record
            assert r["offset"] == at
            fields, block = W.parsed(gzip.decompress(data[at:at + r["length"]]))
            assert fields["WARC-Type"] == r["record_type"] and len(block) == int(fields["Content-Length"])
            at += r["length"]
        assert at == len(data)


def test_empty_table_and_selection(spark):
    none = W.archive_pages(pages(spark, edge_rows()).limit(0))
    assert none.count() == 0 and W.read_records(none).count() == 0
    index = W.archive_pages(pages(spark, edge_rows()))
    got = W.selected(index, index["record_type"] == "revisit").collect()
    assert found(got) == Counter({k: n for k, n in expected(edge_rows()).items() if k[3] == "revisit"})


def test_near_ranges_are_read_at_once():
    gap, most = W.GAP_BYTES, W.READ_BYTES
    assert W.ranges([]) == []
    assert W.ranges([(0, 10), (10, 5), (15 + gap, 5)]) == [(0, 20 + gap, 0, 3)]
    assert W.ranges([(0, 10), (11 + gap, 5)]) == [(0, 10, 0, 1), (11 + gap, 5, 1, 2)]
    assert len(W.ranges([(0, most), (most, 1)])) == 2
    assert W.ranges([(0, 10), (0, 10)]) == [(0, 10, 0, 2)]


def test_query(spark):
    from casegrid.llm.queries import op3_warc
    sf = "/root/testdata/sf0.001"
    rows = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    got = Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                  for r in op3_warc(spark, sf).collect())
    assert got == expected(rows)
