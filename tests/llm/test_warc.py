import gzip
import hashlib
import pathlib

import pytest

from strata.llm import warc as W
from strata.session import scratch_path

PAGES = "page_id long, url string, html string, key string, digest string"


@pytest.fixture(scope="module")
def pages(spark):
    big = "<html>" + "é" * 800
    rows = [(1, "http://a.b.org/x?y#z", big), (2, "http://a.b.org/x?y", big), (3, None, big), (4, "http://a.b.org/x?y", ""),
            (5, "https://user@C.org:8080", None), (6, "HTTP://c.org/", "small"), (7, "c.org/p", "small"),
            (8, "http://b.org/\r\nX: y", "x" * 999), (9, "http://b.org/", "x" * 999), (10, "http://z.org/", "y" * 1000),
            (11, "http://z.org/", "y" * 1000), (11, "http://z.org/", "y" * 1000), (None, "http://z.org/", "y" * 1000)]
    rows = [(*r, "k", "d") for r in rows] + [(100 + i, "http://hot.org/", f"p{i}", "k", "d") for i in range(90)]
    return spark.createDataFrame(rows, PAGES).repartition(3)


def brute(rows):
    body = [(r.page_id, (r.html or "").encode()) for r in rows]
    last = {}
    for i, b in body:
        if len(b) >= 1000 and i is not None:
            last[b] = max(i, last.get(b, i))
    out = []
    for i, b in body:
        refers = last.get(b) if last.get(b) != i else None
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if refers is not None else "response", refers))
    return sorted(map(str, out))


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_round_trip(spark, pages, small_dir):
    for p in (pages, spark.read.parquet(f"{small_dir}/pages.parquet")):
        folder = scratch_path(spark, "warc")
        assert rows_of(W.digest(p, folder)) == brute(p.collect())
        for f in pathlib.Path(folder.removeprefix("file:"), "archives").glob("*.warc.gz"):
            assert gzip.decompress(f.read_bytes()).count(b"WARC/1.1\r\n") >= 1


def test_lookup_reads_what_it_needs(spark, pages):
    folder = scratch_path(spark, "warc")
    captures = W.write_archives(pages, folder + "/a")
    directory = W.write_index(captures, folder + "/i", block_rows=7, files=4)
    assert directory.agg({"n": "max"}).first()[0] <= 7 and directory.agg({"n": "sum"}).first()[0] == pages.count()

    def ids(*urls):
        u = spark.createDataFrame([(x,) for x in urls], "url string")
        return sorted(str(r.page_id) for r in W.lookup(u, directory, folder + "/a", folder + "/i").collect())
    assert ids("http://A.B.ORG/x?y") == ["1", "2", "4"]
    assert ids("https://c.org") == ["5"] and ids(None) == ["3"]
    assert ids("http://nowhere.org/", "http://a.b.org/") == []
    assert ids("http://hot.org/") == sorted(str(100 + i) for i in range(90))
    got = W.lookup(spark.createDataFrame([("http://hot.org/",)], "url string"), directory, folder + "/a", folder + "/i")
    assert {bytes(r.payload) for r in got.collect()} == {f"p{i}".encode() for i in range(90)}


def test_no_pages(spark, pages):
    assert W.digest(pages.limit(0), scratch_path(spark, "warc")).count() == 0


def test_damage_is_found():
    raw = W.record(1, "u", "response", None, b"abc", hashlib.sha1(b"abd").hexdigest())
    with pytest.raises(ValueError):
        W.parse(raw)
