"""Archives read back against the table they came from."""

import gzip

import pytest
from pyspark.sql import functions as F

from tte.llm.warc import digest_of, parse_record, read_warc, record_bytes, write_warc

PAGES = "page_id long, url string, html string, digest string"


@pytest.fixture(scope="module")
def pages(spark):
    big = "<p>" + "long text é " * 200_000
    rows = [(i, f"http://a/{i}", f"<p>{i % 40}</p>" * (i % 40), "clash") for i in range(200)]
    rows += [(500, None, None, None), (501, "http://b/ x\r\nWARC-Type: no", "", None), (502, "u", big, None), (503, "u", big, None),
             (None, "n", "alone", None), (None, "n", "<p>7</p>" * 7, None), (600, "r", "twice", None), (600, "r", "twice", None)]
    return rows, spark.createDataFrame(rows, PAGES).repartition(4)


def expected(rows):
    payload = [(r[2] or "").encode() for r in rows]
    top = {}
    for r, p in zip(rows, payload, strict=True):
        top[p] = max((x for x in (top.get(p), r[0]) if x is not None), default=None)
    return sorted((str(r[0]), len(p), digest_of(p), "response" if r[0] == top[p] else "revisit", None if r[0] == top[p] else top[p])
                  for r, p in zip(rows, payload, strict=True))


def test_round_trip(pages):
    rows, df = pages
    index = write_warc(df)
    got = read_warc(index)
    back = got.collect()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back) == expected(rows)
    stored = {r.page_id: bytes(r.payload) for r in back if r.record_type == "response"}
    want = {r[0]: (r[2] or "").encode() for r in rows}
    assert all(stored[i] == want[i] for i in stored if i is not None)
    assert index.where("record_type = 'response'").count() == len([r for r in back if r.payload is not None])


def test_selected_records_only(pages):
    _, df = pages
    index = write_warc(df)
    some = index.where((F.col("page_id") % 9 == 0) & F.col("url").startswith("http://a/"))
    assert {r.page_id for r in read_warc(some).collect()} == set(range(0, 200, 9))


def test_archives_are_concatenated_gzip_members(pages, spark):
    _, df = pages
    index = write_warc(df)
    path = index.first().path
    rows = index.where(F.col("path") == path).orderBy("offset").collect()
    raw = open(path.removeprefix("file:"), "rb").read()
    assert sum(r.length for r in rows) == len(raw)
    assert gzip.decompress(raw).count(b"WARC/1.1\r\n") == len(rows)


def test_damage_is_found_and_empty_table():
    good = record_bytes(1, "u", b"payload")
    assert parse_record(good)["payload"] == b"payload"
    other = gzip.compress(gzip.decompress(good).replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n"))
    with pytest.raises(ValueError):
        parse_record(other)


def test_empty_table(spark):
    assert read_warc(write_warc(spark.createDataFrame([], PAGES))).count() == 0
