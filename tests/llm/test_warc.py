import gzip
import hashlib

from convlens.llm import warc


def pages(spark):
    big, small = "x" * 1500, "y" * 999
    rows = [(1, "http://a/1", big), (5, "http://a/5\r\nX: y", big), (5, "http://a/5b", big), (3, None, big), (None, "n", big), (2, "s", small),
            (4, "s2", small), (6, "e", ""), (7, "nul", None), (8, "u", "é\r\n\r\nWARC/1.1\r\n" * 300), (9, "long", "z" * 3_000_000)]
    return rows, spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS digest", "2 AS id").repartition(3)


def test_round_trip_and_revisits(spark):
    rows, df = pages(spark)
    index = warc.write_archives(df, "page_id", "url", "html", archive_bytes=2000)
    got = warc.read_records(index).collect()
    assert len(got) == len(rows)
    assert sorted((r.id or 0, r.record_type, r.refers_to or 0) for r in got if r.payload_bytes == 1500) == [
        (0, "response", 0), (1, "revisit", 5), (3, "revisit", 5), (5, "response", 0), (5, "response", 0)]
    want = sorted((i or 0, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest()) for i, _, h in rows)
    assert sorted((r.id or 0, r.payload_bytes, r.payload_digest) for r in got) == want
    text = {i: h for i, _, h in rows}
    for r in got:
        assert r.payload is None if r.record_type == "revisit" else (r.payload.decode() == (text[r.id] or ""))


def test_archives_are_plain_warc(spark):
    _, df = pages(spark)
    index = warc.write_archives(df, "page_id", "url", "html")
    r = index.where("id = 8").first()
    with open(r.archive.removeprefix("file://"), "rb") as f:
        f.seek(r.offset)
        record = gzip.decompress(f.read(r.length))
    head, _, body = record.partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response") and b"Content-Length: %d" % (len(body) - 4) in head


def test_selection_is_read_in_merged_ranges(spark):
    _, df = pages(spark)
    index = warc.write_archives(df.coalesce(1), "page_id", "url", "html").cache()
    assert warc.plan_reads(index, gap_bytes=1 << 20, read_bytes=1 << 30).count() == 1
    one = warc.plan_reads(index.where("id in (1, 9)"), gap_bytes=0, read_bytes=1 << 30).collect()
    assert sum(len(r.offsets) for r in one) == 2 and all(r.end - r.start == sum(r.lengths) for r in one)
    assert sorted(r.id for r in warc.read_records(index.where("id in (1, 9)"), with_payload=False, read_bytes=100).collect()) == [1, 9]


def test_empty(spark):
    _, df = pages(spark)
    assert warc.read_records(warc.write_archives(df.limit(0), "page_id", "url", "html")).collect() == []
