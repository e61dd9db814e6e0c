"""Records of large XML files against the standard library's tree."""

import random
import xml.etree.ElementTree as ET

import pytest

from flowmart import sources
from flowmart.sources.xml_split import RecordIntervals, cut_records


def document(seed, n, encoding="utf-8"):
    """A document with records at several depths, empty ones, and texts that look like tags."""
    r = random.Random(seed)
    texts = ["x", "/&gt;", "/>", "<![CDATA[</rec><rec/>]]>", "é ß", "a&amp;b", "", "  "]
    def record():
        k = f" k='{r.choice(['1', 'a>b', 'c/'])}'" if r.random() < 0.7 else ""
        return r.choice([f"<rec{k}/>", f"<rec{k}></rec >", f"<rec{k}><v u='{r.random()}'>{r.choice(texts)}</v></rec>", f"<rec{k}><v>{r.choice(texts)}</v><w/></rec>"])
    def group(i):
        inner = [record() for _ in range(r.randrange(5))]
        if r.random() < 0.5:
            inner.insert(r.randrange(len(inner) + 1), f"<sub s='s{i}'>{record()}\n</sub>")
        inner += r.choice([[], ["<!-- <rec> -->"], ["<?go <rec>?>"], ["<other/>"]])
        return f"<group g='g{i}'>{' '.join(inner)}</group>"
    body = "\n".join(group(i) for i in range(n))
    return f"<?xml version='1.0' encoding='{encoding}'?>\n<n:root xmlns:n='u' date='d &quot;1&quot;'>{body}</n:root>".encode(encoding)


def plain(data):
    """(root date, group, sub, key, text of v, its unit) of every record."""
    out = []
    def walk(node, date, g, s):
        for child in node:
            if child.tag == "rec":
                v = child.find("v")
                out.append((date, g, s, child.get("k"), None if v is None else (v.text or ""), None if v is None else v.get("u")))
            else:
                walk(child, date, child.get("g", g), child.get("s", s))
    root = ET.fromstring(data)
    walk(root, root.get("date"), None, None)
    return out


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("encoding", ["utf-8", "iso-8859-1"])
def test_intervals_hold_every_record_once(seed, encoding):
    data = document(seed, 40, encoding)
    for span, piece in ((1, 7), (300, 64), (1 << 20, 1 << 20)):
        found, groups = RecordIntervals("rec", span), []
        for i in range(0, len(data), piece):
            groups += found.feed(data[i:i + piece])
        groups += found.feed(b"", True)
        intervals = [x for g in groups for x in g]
        assert all(a < b for a, b, _ in intervals) and all(x[1] <= y[0] for x, y in zip(intervals, intervals[1:]))
        records = [ET.fromstring(t) for a, b, _ in intervals for t in cut_records(data[a:b], found.encoding)]
        assert [r.get("k") for r in records] == [k for _, _, _, k, _, _ in plain(data)]
        longest = max(len(ET.tostring(r)) for r in records)
        assert all(g[-1][0] - g[0][0] < span + 4 * longest + 200 for g in groups)


def test_records_equal_the_tree(spark, tmp_path):
    expected = []
    for seed in range(3):
        data = document(seed, 60)
        (tmp_path / f"{seed}.xml").write_bytes(data)
        expected += plain(data)
    got = sources.read_split_records(spark, str(tmp_path), "rec", span=200)
    assert set(got.columns) == {"root_date", "group_g", "sub_s", "k", "v", "v_u", "w"}
    key = lambda row: tuple(str(x or "").strip() for x in row)  # noqa: E731  Spark reads empty text as null
    assert sorted(key(r) for r in got.select("root_date", "group_g", "sub_s", "k", "v", "v_u").collect()) == sorted(map(key, expected))
    some = sources.read_split_records(spark, str(tmp_path), "rec", ancestors=["group_g"], span=200)
    assert "root_date" not in some.columns and some.count() == len(expected)


def test_one_root_is_read_by_many_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    body = "".join(f"<rec k='{i}'><v>{i}</v></rec>" for i in range(20_000))
    (tmp_path / "one.xml").write_text(f"<root date='d'>{body}</root>")
    intervals, n = sources.record_intervals(spark, str(tmp_path), "rec", 32 << 10)
    assert 15 < n < 25
    rows = sources.read_split_records(spark, str(tmp_path), "rec", span=32 << 10)
    used = rows.groupBy(F.spark_partition_id().alias("p")).count().count()
    assert used == spark.sparkContext.defaultParallelism
    assert rows.where("root_date = 'd' and k = v").select("k").distinct().count() == 20_000
    assert "from_xml" in rows._jdf.queryExecution().optimizedPlan().toString()
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_xml") == 1


@pytest.mark.parametrize("text, why", [
    ("<root><rec>", "no element found|not well-formed"),
    ("<rec/>", "root"),
    ("<!DOCTYPE r [<!ENTITY e 'x'>]><root><rec>&e;</rec></root>", "entities"),
    ("<a k='1'><a k='2'><rec/></a></a>", "share the column"),
])
def test_what_cannot_be_split_fails(spark, tmp_path, text, why):
    (tmp_path / "x.xml").write_text(text)
    with pytest.raises(Exception, match=why):
        sources.read_split_records(spark, str(tmp_path), "rec").collect()


def test_compressed_and_files_without_records(spark, tmp_path):
    (tmp_path / "x.xml").write_text("<root a='1'><other/></root>")
    from pyspark.sql import types as T

    none = sources.read_split_records(spark, str(tmp_path), "rec", schema=T.StructType.fromDDL("v STRING"))
    assert none.columns == ["v"] and none.count() == 0
    (tmp_path / "x.xml.gz").write_bytes(b"x")
    with pytest.raises(Exception, match="compressed"):
        sources.read_split_records(spark, str(tmp_path), "rec", schema=T.StructType.fromDDL("v STRING"))


def test_rows_of_the_ranges_are_small(spark, tmp_path):
    """A reader holds thousands of rows at once, so a row may not list what lies in its range."""
    body = "".join(f"<order key='{i}'><group g='{i % 5}'><rec k='{i}'><v>{i}</v></rec></group></order>" for i in range(20_000))
    for name, head, least in (("plain", "", 3), ("typed", "<!DOCTYPE root [<!ATTLIST group h CDATA 'd'>]>", 150)):
        (tmp_path / f"{name}.xml").write_text(f"{head}<root date='d'>{body}</root>")
        table, n = sources.record_intervals(spark, str(tmp_path / f"{name}.xml"), "rec", 1 << 19)
        longest = max(sum(len(x) for x in r.above) + 16 * len(r.starts) for r in table.collect())
        assert least <= n <= 2 * least and longest < 16 << 10
        got = sources.read_split_records(spark, str(tmp_path / f"{name}.xml"), "rec", span=1 << 19)
        assert set(got.columns) == {"root_date", "order_key", "group_g", "k", "v"} | ({"group_h"} if head else set())
        assert got.where("root_date = 'd' and order_key = k and group_g = k % 5 and v = k").select("k").distinct().count() == got.count() == 20_000
        assert not head or got.where("group_h = 'd'").count() == 20_000


def test_attributes_of_one_ancestor_that_share_a_column(spark, tmp_path):
    (tmp_path / "x.xml").write_text("<r xmlns:a='1' xmlns:b='2' a:k='1' b:k='2'><rec/></r>")
    with pytest.raises(Exception, match="share the column"):
        sources.read_split_records(spark, str(tmp_path), "rec").collect()
