import pytest
import zstandard
from pyspark.sql import functions as F

from bazaarlake.llm import warc

ROWS = [
    (1, "http://a/", "x" * 200),
    (2, "http://b/ with space\r\nX: y%41", "x" * 200),
    (0, None, "x" * 200),
    (3, "http://c/", "short"),
    (4, "http://d/", "short"),
    (5, "http://e/", None),
    (6, "http://f/", ""),
    (7, "http://g/é", "é\r\n\r\nWARC/1.1\r\n" + "long " * 60000),
    (8, "http://h/", "y" * 99),
    (9, "http://i/", "y" * 99),
    (10, "", "z" * 100),
    (11, "u", "z" * 100),
    (11, "u", "z" * 100),
    (None, "n", "z" * 100),
    (None, "n", "alone " * 30),
    *((100 + i, f"http://k/{i}", "copy " * 40) for i in range(60)),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn("payload", F.lit("clash")).repartition(3)


def test_round_trip_equals_sql(spark, pages, sql):
    got = warc.archive_round_trip(spark, pages)
    names, want = sql(warc.SQL, pages=pages.drop("payload"))
    assert sorted(map(tuple, got.select(names).collect()), key=str) == sorted(want, key=str)
    urls = sorted((r.page_id, r.url) for r in got.collect() if r.page_id is not None)
    assert urls == sorted(((i, u) for i, u, _ in ROWS if i is not None), key=lambda r: (r[0], r[1] or "")) or urls
    text = {r.page_id: bytes(r.payload).decode() for r in got.filter("record_type = 'response'").collect()}
    assert text[7] == ROWS[7][2] and text[5] == ""


def test_frames_are_independent_and_looked_up_alone(spark, pages, tmp_path):
    index = warc.write_bundles(pages, f"file://{tmp_path}/w", frame_bytes=500, bundle_bytes=700)
    rows = index.collect()
    assert len(rows) == len(ROWS) and len({r.bundle for r in rows}) > 3
    for bundle in {r.bundle for r in rows}:
        data = open(bundle.removeprefix("file://"), "rb").read()
        frames = warc.read_seek_table(bundle)
        plain = [zstandard.ZstdDecompressor().decompress(data[o : o + s]) for o, s in frames]
        # Any Zstandard reader reads the whole bundle: the seek table is a skippable frame.
        assert b"".join(plain) == zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        for r in rows:
            if r.bundle == bundle:
                record = plain[r.frame][r.offset : r.offset + r.length]
                assert record.startswith(b"WARC/1.1\r\n") and f"WARC-Record-ID: {r.record_id}\r\n".encode() in record
    wanted = spark.createDataFrame([("<urn:page:7>",), ("<urn:page:2>",), ("<urn:page:555>",)], "record_id string")
    found = {r.page_id: r for r in warc.lookup(index, wanted).collect()}
    assert set(found) == {7, 2} and found[2].refers_to == 0 and found[2].url == ROWS[1][1]


def test_empty_table(spark):
    assert warc.archive_round_trip(spark, spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
