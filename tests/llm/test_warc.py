import base64
import hashlib
import io
import os

import pytest
from pyspark.sql.datasource import EqualTo, In, IsNotNull, Not

from flowmart.llm import warc
from flowmart.llm.common import shared_dir

PAGES = [(1, "http://a/", "<p>ä</p>"), (2, "http://b/", "<p>ä</p>"), (3, None, None), (4, "http://c/\r\nX: 1", ""), (5, "http://d/", "x" * 3_000_000),
         (6, "http://e/", "line\r\n\r\nWARC/1.1\r\n"), (6, "http://e/", "line\r\n\r\nWARC/1.1\r\n"), (None, "http://f/", "<p>ä</p>"), (None, "http://g/", "lone")]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "z", 1) for p in PAGES], "page_id long, url string, html string, record_type string, payload int")


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(least):
    out = []
    for key, _, html in PAGES:
        same = [k for k, _, h in PAGES if (h or "") == (html or "") and k is not None]
        top = max(same, default=None)
        revisit = len((html or "").encode()) >= least and top is not None and key != top
        out.append((str(key), len((html or "").encode()), digest(html), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(pages, least):
    got = warc.round_trip(pages, least).collect()
    assert sorted([(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == expected(least)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_records_predicates_and_payloads(spark, pages, compression):
    from pyspark.sql import functions as F

    folder = shared_dir(spark, "warc")
    warc.register(spark)
    rows = pages.select("page_id", "url", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows.write.format("warc").option("compression", compression).mode("append").save(folder)
    back = {(r.page_id, r.target_uri, bytes(r.payload).decode()) for r in warc.read(spark, folder).collect()}
    assert back == {(k, (u or "").replace("\r", "%0D").replace("\n", "%0A") or None, h or "") for k, u, h in PAGES}
    assert all(r.payload is None and r.payload_bytes == len((dict((p[0], p[2]) for p in PAGES)[r.page_id] or "").encode()) for r in warc.read(spark, folder, payload=False).where("page_id < 6").collect())
    one = warc.read(spark, folder).where("target_uri = 'http://b/'")
    assert [r.page_id for r in one.collect()] == [2]
    assert "Filter (isnotnull(target_uri" not in one._jdf.queryExecution().executedPlan().toString()
    assert warc.read(spark, folder).where("record_type = 'revisit'").count() == 0
    # A lost attempt's file does not count: only the manifest does.
    extra = os.path.join(folder, "part-99999-lost-0.warc.gz")
    with open(extra, "wb") as f:
        f.write(b"broken")
    assert warc.read(spark, folder).count() == len(PAGES)


def test_unwanted_bodies_are_not_decoded():
    class Counting(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            got = super().read(n)
            Counting.taken += len(got)
            return got
    big = warc.record_bytes("response", "http://big/", os.urandom(2_000_000), 1, None, "d")
    small = warc.record_bytes("response", "http://small/", b"yes", 2, None, "d")
    for data in (warc.gzip_member(big) + warc.gzip_member(small), big + small):
        Counting.taken = 0
        got = list(warc.records(Counting(data), [EqualTo(("target_uri",), "http://small/")], True))
        assert [(r[6], r[9]) for r in got] == [(2, b"yes")]
        assert Counting.taken < 300_000


def test_members_without_a_length_and_broken_archives():
    import gzip

    records = [warc.record_bytes("response", f"http://{i}/", b"p" * i * 1000, i, None, "d") for i in range(5)]
    got = list(warc.records(io.BytesIO(b"".join(gzip.compress(r) for r in records)), [Not(EqualTo(("target_uri",), "http://2/"))], True))
    assert [(r[6], len(r[9])) for r in got] == [(i, i * 1000) for i in (0, 1, 3, 4)]
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(b"no archive at all"), [], True))
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(warc.gzip_member(records[3])[:-40]), [], True))


def test_wanted():
    head = {"warc-type": "response", "warc-payload-digest": "sha1:ABC"}
    assert warc.wanted(head, [In(("record_type",), ("response", "x")), EqualTo(("payload_digest",), "ABC"), IsNotNull(("record_type",))])
    assert not warc.wanted(head, [EqualTo(("target_uri",), "x")]) and not warc.wanted(head, [Not(EqualTo(("target_uri",), "x"))])
    assert warc.wanted(head, [Not(IsNotNull(("target_uri",)))])


def test_empty(spark, pages):
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_appending_adds_records_and_foreign_folders_are_listed(spark, tmp_path):
    import shutil

    def pages(keys):
        return spark.createDataFrame([(k, f"http://h/{k}", f"page {k}") for k in keys], "page_id long, url string, html string")

    folder = str(tmp_path / "w")
    warc.archive(pages([1, 2, 3]), folder)
    warc.archive(pages([4, 5]), folder)
    assert sorted(r.page_id for r in warc.read(spark, folder).collect()) == [1, 2, 3, 4, 5]
    other = tmp_path / "other" / "deep"
    other.mkdir(parents=True)
    for f in (tmp_path / "w").glob("*.warc*"):
        shutil.copy(f, other)
    assert sorted((r.page_id, bytes(r.payload)) for r in warc.read(spark, str(tmp_path / "other")).collect()) == [(k, f"page {k}".encode()) for k in range(1, 6)]
    assert warc.read(spark, str(tmp_path / "other")).where("record_type = 'revisit'").count() == 0
    rows = warc.read(spark, folder).limit(0)
    assert rows.collect() == []
