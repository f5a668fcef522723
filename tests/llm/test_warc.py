"""Archives by round trip and against a plain loop over the rows."""

import gzip
import hashlib
import io

import pytest
from custodia.llm import catalog, warc
from custodia.session import work_dir

BIG = "<p>" + "x" * 100
ROWS = [
    (5, "http://a/ä b?x=1", BIG), (2, "http://b", BIG), (9, None, BIG), (None, "u", BIG), (2, "http://b", BIG), (3, "http://c", None),
    (4, "", ""), (6, "http://d", "short"), (7, "http://e", "short"), (8, "http://f", "é\U0001f600\r\n\r\n" * 90_000), (1, "z", "y" * 99),
    (0, "z", "y" * 99), (12, "q%41", "WARC/1.1\r\n\r\n" * 20),
]


def expected(rows):
    first = {}
    top = 2**63 - 1
    for page, _, html in rows:
        first[html] = min(first.get(html, top), top if page is None else page)
    out = []
    for page, url, html in rows:
        data = (html or "").encode()
        again = len(data) >= 100 and (top if page is None else page) > first[html]
        out.append((page, url, "revisit" if again else "response", first[html] if again else None, len(data), hashlib.sha256(data).hexdigest()))
    return sorted(out, key=str)


def test_round_trip(spark):
    pages = spark.createDataFrame([(*r, 1, "k") for r in ROWS], "page_id long, url string, html string, payload int, HTML string")
    folder = work_dir(spark, "warc")
    warc.write(spark, pages, folder, archive_bytes=300)
    out = warc.read(spark, folder).collect()
    assert sorted([tuple(r)[:6] for r in out], key=str) == expected(ROWS)
    texts = {(r[0], r[1]): (r[2] or "").encode() for r in ROWS}
    assert all(bytes(r.payload) == texts[r.page_id, r.url] for r in out if r.record_type == "response")


def test_members_and_errors():
    good = warc.record(1, "u", b"abc" * 50_000, hashlib.sha256(b"abc" * 50_000).hexdigest(), None)
    other = warc.record(2, None, b"", hashlib.sha256(b"").hexdigest(), None)
    assert [warc.parse(m)["page_id"] for m in warc.members(io.BytesIO(good + other + good))] == [1, 2, 1]
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO((good + other)[:-9])))
    text = gzip.decompress(good)
    for bad in (text.replace(b"abcabc", b"abcabd", 1), text[:-4], text.replace(b"sha256:", b"sha256:0", 1), text + b"x"):
        with pytest.raises(ValueError):
            warc.parse(bad)


def test_empty_table(spark):
    folder = work_dir(spark, "warc")
    warc.write(spark, spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert warc.read(spark, folder).count() == 0


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html").collect()]
    out = catalog.op4_warc(spark, "/root/testdata/sf0.001").select("page_id", "record_type", "refers_to", "payload_bytes", "payload_digest").collect()
    assert sorted([tuple(r) for r in out], key=str) == sorted([(p, t, f, n, d) for p, _, t, f, n, d in expected(rows)], key=str)
