import pytest

from flowmart.operators import enrich


def failing(build):
    """The message of a job that must fail, while it is put together (a stored dimension) or when it runs."""
    with pytest.raises(Exception) as e:
        build().collect()
    return str(e.value)


def test_lookup_repeated_keys(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "o STRING")
    dim = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("n", "NA", 1)], "name STRING, code STRING, at INT")
    last = enrich.lookup(df, dim, "o", "code", "c", key="name", order="at")
    assert {tuple(r) for r in last.collect()} == {("a", "2"), ("b", None), (None, None)}
    assert "not unique: a" in failing(lambda: enrich.lookup(df, dim, "o", "code", "c", key="name"))
    same = enrich.lookup(df, dim.where("at = 1").union(dim.where("at = 1")), "o", "code", "c", key="name", default="-")
    assert {tuple(r) for r in same.collect()} == {("a", "1"), ("b", "-"), (None, "-")}
    assert enrich.lookup(df, dim, "o", "code", "o") is df


def test_added_counts(spark):
    base = spark.createDataFrame([(1, 10.0), (2, None), (3, None), (4, 5.0), (5, None), (4, 5.0)], "k INT, count DOUBLE")
    extra = spark.createDataFrame([(1, 1.0), (2, 7.0), (3, 0.0), (9, 9.0), (5, None), (1, 1.0)], "k INT, extra DOUBLE")
    got = {tuple(r) for r in enrich.add_counts(base, extra, ["k"]).collect()}
    assert got == {(1, 11.0), (2, 7.0), (3, None), (4, 5.0), (5, None)}


def test_guarded_join(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i INT, region STRING")
    dim = spark.createDataFrame([("a", 10), ("b", 20)], "region STRING, id INT")
    assert {tuple(r) for r in enrich.guarded_join(df, dim, "region").collect()} == {(1, "a", 10), (2, "b", 20)}
    assert "unmatched key: b" in failing(lambda: enrich.guarded_join(df, dim.where("id = 10"), "region"))
    repeated = dim.union(spark.createDataFrame([("a", 11)], "region STRING, id INT"))
    assert "not unique: a" in failing(lambda: enrich.guarded_join(df, repeated, "region"))
    with pytest.raises(ValueError, match="1 unmatched keys.*b"):
        enrich.require_matched(df, dim.where("id = 10"), "region")
    enrich.require_matched(df, dim, "region")


def test_unmatched_counts_null_keys(spark):
    df = spark.createDataFrame([("a",), (None,)], "r STRING")
    dim = spark.createDataFrame([("a",), (None,)], "r STRING")
    assert [r.r for r in enrich.unmatched(df, dim, "r").collect()] == [None]


def test_null_safe_attach(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k STRING, a INT")
    b = spark.createDataFrame([("x", 10), (None, 20), ("y", 30)], "k STRING, b INT")
    assert {tuple(r) for r in enrich.attach(a, b, "k").collect()} == {("x", 1, 10), (None, 2, None)}
    assert {tuple(r) for r in enrich.attach(a, b, "k", null_safe=True).collect()} == {("x", 1, 10), (None, 2, 20)}
    full = enrich.attach(a, b, "k", "full", default={"b": 0})
    assert {tuple(r) for r in full.collect()} == {("x", 1, 10), (None, 2, 0), (None, None, 20), ("y", None, 30)}


def test_two_paths_merge_per_column(spark):
    names = spark.createDataFrame([("a",), ("b",), ("c",)], "n STRING")
    dim = spark.createDataFrame([("a", "z", 1), ("q", "b", 2), ("a", "y", 0)], "un STRING, wb STRING, code INT")
    got = enrich.two_path_match(names, dim, "n", "un", "wb", order=["code"])
    assert {tuple(r) for r in got.collect()} == {("a", "a", "y", 0), ("b", "q", "b", 2), ("c", None, None, None)}


def test_column_merge(spark):
    df = spark.createDataFrame([("x", None), (None, "y"), ("z", "z"), (None, None)], "a STRING, b STRING")
    assert [r.o for r in enrich.merge_columns(df, "a", "b", "o").collect()] == ["x", "y", "z", None]
    bad = df.union(spark.createDataFrame([("p", "q")], "a STRING, b STRING"))
    assert enrich.merge_conflicts(bad, "a", "b").count() == 1
    assert "p / q" in failing(lambda: enrich.merge_columns(bad, "a", "b", "o"))


def test_dedupe_keeps_first_by_order(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", None, "z"), ("b", 3, "w"), (None, 1, "v")], "k STRING, o INT, v STRING")
    assert {tuple(r) for r in enrich.dedupe(df, ["k"], ["o"]).collect()} == {("a", 1, "y"), ("b", 3, "w"), (None, 1, "v")}


def test_class_labels(spark):
    labels = enrich.class_label_dim(spark.createDataFrame([("Class 7", " Tools "), (None, "x")], "` Class` STRING, INDUSTRY STRING"), "Nice")
    assert [tuple(r) for r in labels.collect()] == [("Nice", "7", "7 - Tools")]
    with pytest.raises(ValueError, match="industry"):
        enrich.class_label_dim(spark.createDataFrame([("1",)], "Class STRING"), "Nice")
    df = spark.createDataFrame(
        [("Nice", "Class 07"), ("Nice", "08"), ("Nice", "Other x"), ("Tech field", "07"), ("Nice", None), ("Locarno", "7")],
        "class_type STRING, class_code STRING",
    )
    got = [r.class_code for r in enrich.label_classes(df, labels).collect()]
    assert sorted(map(str, got)) == sorted(["7 - Tools", "08", "Other", "07", "None", "7"])
    assert "8" in [r.class_code for r in enrich.label_classes(df, labels, fallback="code").collect()]


def test_set_difference_skips_nulls(spark):
    a = spark.createDataFrame([("x",), ("x",), (None,)], "v STRING")
    b = spark.createDataFrame([("y",), (None,)], "v STRING")
    assert {tuple(r) for r in enrich.set_difference(a, b, "v").collect()} == {("x", "left_only"), ("y", "right_only")}


def test_unions(spark):
    a = spark.createDataFrame([(1, "x")], "year INT, o STRING")
    b = spark.createDataFrame([(2,)], "year INT")
    got = enrich.union_indicators({"PA1a": a, "TM7": b})
    assert {tuple(r) for r in got.select("year", "o", "indicator").collect()} == {(1, "x", "PA1a"), (2, None, "TM7")}
    assert enrich.union_flows([a, a]).count() == 1
    assert enrich.union_flows([a, a], distinct=False).count() == 2


def test_guards_hold_whatever_is_read(spark):
    import pytest

    facts = spark.createDataFrame([("a", 1), ("z", 2)], "k STRING, n INT")
    dim = spark.createDataFrame([("a", "A")], "k STRING, name STRING")
    joined = enrich.guarded_join(facts, dim, "k")
    for read in (joined.count, joined.select("n").collect):
        with pytest.raises(Exception, match="unmatched key"):
            read()
    clash = enrich.merge_columns(spark.createDataFrame([("x", "y", 1)], "a STRING, b STRING, n INT"), "a", "b", "c")
    for read in (clash.count, clash.select("n").collect):
        with pytest.raises(Exception, match="conflicting"):
            read()
