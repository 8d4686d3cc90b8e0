"""Archives: round trips, revisits, equal files on every run, rolled by size."""

import gzip
import hashlib
from glob import glob

import pytest
from pyspark.sql import functions as F

from curbflow.llm.queries import QUERIES
from curbflow.llm.warc import MANIFEST, read_warc, shard_bounds, write_warc

PAGE = "page_id long, url string, html string, sha256 string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], PAGE)


def files(path):
    return {p.rsplit("/", 1)[1]: open(p, "rb").read() for p in glob(f"{path}/*.warc.gz")}


ROWS = [(i, f"http://h/{i}", "é" * (i * 37 % 900)) for i in range(60)] + [
    (100, "http://a/", "x" * 1000), (101, "http://b/\r\nX: y", "x" * 1000), (102, None, "x" * 1000), (103, "u", "x" * 999), (104, "u", "x" * 999),
    (105, "u", None), (106, "u", ""), (None, "u", "y" * 2000), (107, "u", "y" * 2000), (108, "u", "WARC/1.1\r\n\r\n" * 300),
]


def test_round_trip_with_revisits(spark, tmp_path):
    path = f"file://{tmp_path}/w"
    manifest = write_warc(pages(spark, ROWS), path, shards=3, roll_bytes=8000)
    got = {r.page_id: r for r in read_warc(spark, path, bodies=True).collect()}
    assert len(got) == len(ROWS)
    for i, url, html in ROWS:
        payload = (html or "").encode()
        row = got[i]
        assert (row.payload_bytes, row.payload_digest) == (len(payload), hashlib.sha1(payload).hexdigest())
        want = {100: 102, 101: 102, None: 107}.get(i)
        assert (row.record_type, row.refers_to) == (("revisit", want) if want else ("response", None))
        assert want or bytes(row.payload) == payload
        assert row.url == (url and url.replace("\r", "%0D").replace("\n", "%0A"))
    listed = manifest.collect()
    stored = files(f"{tmp_path}/w")
    assert {r.file for r in listed} == set(stored) and len(stored) > 3
    for r in listed:
        assert r.bytes == len(stored[r.file]) and hashlib.sha256(stored[r.file]).hexdigest() == r.sha256
        assert gzip.decompress(stored[r.file]).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        assert r.bytes <= 8000 or r.records == 2
    assert glob(f"{tmp_path}/w/_temporary/*") == []


def test_files_do_not_depend_on_the_partitions(spark, tmp_path):
    df = pages(spark, ROWS)
    for n, frame in ((1, df.repartition(7)), (2, df.coalesce(1).orderBy(F.desc("page_id")))):
        write_warc(frame, f"file://{tmp_path}/w{n}", shards=4)
    assert files(f"{tmp_path}/w1") == files(f"{tmp_path}/w2")


def test_repeated_rows_and_empty_tables(spark, tmp_path):
    write_warc(pages(spark, [(5, "u", "z" * 1500)] * 3 + [(4, "u", "z" * 1500)]), f"file://{tmp_path}/r")
    got = sorted((r.page_id, r.record_type, r.refers_to) for r in read_warc(spark, f"file://{tmp_path}/r").collect())
    assert got == [(4, "revisit", 5), (5, "response", None), (5, "revisit", 5), (5, "revisit", 5)]
    write_warc(pages(spark, []), f"file://{tmp_path}/e")
    assert read_warc(spark, f"file://{tmp_path}/e").collect() == [] and glob(f"{tmp_path}/e/{MANIFEST}")


def test_a_damaged_archive_is_noticed(spark, tmp_path):
    write_warc(pages(spark, [(1, "u", "abc" * 500)]), f"file://{tmp_path}/d")
    (name,) = glob(f"{tmp_path}/d/*.warc.gz")
    data = open(name, "rb").read()
    open(name, "wb").write(data[:-20])
    with pytest.raises(Exception, match="ends inside a record"):
        read_warc(spark, f"file://{tmp_path}/d").collect()


def test_bounds_cut_evenly(spark):
    bounds = shard_bounds(spark.range(1000), 4)
    assert bounds == [250, 500, 750] and shard_bounds(spark.range(0), 4) == []


def test_query_on_the_given_pages(spark, sf_dir):
    assert QUERIES["op7_warc_archive"](spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/pages.parquet").count()


def test_a_path_written_again_holds_the_new_pages_only(spark, tmp_path):
    path = f"file://{tmp_path}/again"
    write_warc(pages(spark, [(i, "u", "b" * 900) for i in range(40)]), path, shards=4, roll_bytes=2000)
    write_warc(pages(spark, [(1, "u", "b" * 1000)]), path)
    write_warc(pages(spark, [(1, "u", "c" * 1000)]), path)
    (row,) = read_warc(spark, path, bodies=True).collect()
    assert bytes(row.payload) == b"c" * 1000
    assert len(glob(f"{tmp_path}/again/*.warc.gz")) == 1


def test_a_file_that_differs_from_the_manifest_is_noticed(spark, tmp_path):
    write_warc(pages(spark, [(1, "u", "b" * 1000)]), f"file://{tmp_path}/m1")
    write_warc(pages(spark, [(1, "u", "c" * 1000)]), f"file://{tmp_path}/m2")
    (one,), (two,) = glob(f"{tmp_path}/m1/*.warc.gz"), glob(f"{tmp_path}/m2/*.warc.gz")
    open(one, "wb").write(open(two, "rb").read())
    with pytest.raises(Exception, match="differs from the manifest"):
        read_warc(spark, f"file://{tmp_path}/m1").collect()
