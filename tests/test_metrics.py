from flowmart.operators import metrics as m

FACT = [
    (2013, "Canada", "Japan", "PA1a", 10.0), (2013, "Canada", "Japan", "PA1b", 5.0), (2013, "Canada", "China", "PA1a", 20.0),
    (2013, "Canada", "World", "PA1a", 35.0), (2023, "Canada", "Japan", "PA1a", 30.0), (2023, "Canada", "China", "PA1a", None),
    (2023, "Japan", "Canada", "TM1a", 2.5), (2023, "Japan", "Canada", "TM1b", 1.0), (2015, "O'Brien", "Japan", "PA1a", 1.0),
]


def fact(spark):
    return spark.createDataFrame(FACT, "year INT, origin STRING, destination_office STRING, indicator STRING, count DOUBLE")


def test_selection(spark):
    df = fact(spark)
    assert m.flow_filter(df, ["O'Brien"]).count() == 1
    assert m.flow_filter(df, []).count() == 0
    assert m.flow_filter(df, None, None, None, [2013]).count() == 4
    assert m.flow_filter(df, ["Canada"], exclude_members=["World"]).count() == 5
    assert m.flow_filter(df, ["Canada"], ["World"], exclude_members=["World"]).count() == 1
    assert m.total(m.flow_filter(df, [])).first().total == 0.0


def test_volume_of_nulls_stays_null(spark):
    got = m.volume(m.flow_filter(fact(spark), ["Canada"], ["China"]), ["year"]).collect()
    assert {tuple(r) for r in got} == {(2013, 20.0), (2023, None)}


def test_share_counts_member_rows_unless_excluded(spark):
    df = fact(spark)
    by_year = {r.year: r.share for r in m.share_of_total(df, ["Canada"], ["Japan"], ["PA1a", "PA1b"]).collect()}
    assert by_year == {2013: 15.0 / 70.0 * 100.0, 2023: 100.0}
    clean = {r.year: r.share for r in m.share_of_total(df, ["Canada"], ["Japan"], exclude_members=["World"]).collect()}
    assert clean[2013] == 15.0 / 35.0 * 100.0
    none = m.share_of_total(df.where("year = 2023 AND destination_office = 'China'"), ["Canada"], ["Japan"]).first()
    assert (none.volume, none.total, none.share) == (0.0, 0.0, 0.0)


def test_change_from_zero_is_null(spark):
    df = fact(spark)
    assert m.pct_change(m.flow_filter(df, ["Canada"], ["Japan"]), 2013, 2023).first().pct_change == 100.0
    row = m.pct_change(df, 1990, 2023, ["origin"]).where("origin = 'Japan'").first()
    assert (row.volume_from, row.volume_to, row.pct_change) == (0.0, 3.5, None)


def test_group_rank_counts_single_destinations(spark):
    df = fact(spark).where("destination_office <> 'World'")
    rank = lambda dests: {r.year: (r.group_volume, r.group_rank) for r in m.rank_of_group(df, ["Canada"], dests).collect()}
    assert rank(["Japan"]) == {2013: (15.0, 2), 2023: (30.0, 1)}
    assert rank(["Japan", "China"])[2013] == (35.0, 1)
    assert rank(["Nowhere"]) == {2013: (0.0, 3), 2023: (0.0, 2)}


def test_series_has_every_year(spark):
    got = m.timeseries(fact(spark), ["Canada"], ["Japan"], ["PA1a", "PA1b"], 2012, 2014).orderBy("year").collect()
    assert [tuple(r) for r in got] == [(2012, 0.0), (2013, 15.0), (2014, 0.0)]


def test_series_per_key_keeps_keys_without_points(spark):
    df = spark.createDataFrame([("a", 2000, 1.0), ("b", 1990, 2.0), ("a", 2002, None)], "k STRING, year INT, v DOUBLE")
    got = m.fill_years(df, 2000, 2002, ["v"], ["k"])
    assert {tuple(r) for r in got.collect()} == {("a", 2000, 1.0), ("a", 2001, 0.0), ("a", 2002, 0.0), ("b", 2000, 0.0), ("b", 2001, 0.0), ("b", 2002, 0.0)}
    assert m.fill_years(df.limit(0), 2000, 2002, ["v"]).count() == 3


def test_bilateral_table(spark):
    got = m.bilateral_table(fact(spark), ["Canada"], ["Japan"], 2013, 2023, "CAN", "JPN").orderBy("year")
    assert got.columns == ["year"] + [f"{r} From {a} to {b}" for a, b in (("CAN", "JPN"), ("JPN", "CAN")) for r in ("PA", "TM", "ID")]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == 11 and rows[0] == (2013, 15, 0, 0, 0, 0, 0) and rows[-1] == (2023, 30, 0, 0, 0, 4, 0)


def test_rounding_is_half_to_even(spark):
    df = spark.createDataFrame([(2000, "A", "B", "PA1a", 2.5)], "year INT, origin STRING, destination_office STRING, indicator STRING, count DOUBLE")
    assert m.bilateral_table(df, ["A"], ["B"], 2000, 2000).first()["PA From A to B"] == 2


def test_global_share(spark):
    got = m.global_share(fact(spark), ["Japan"], 2022, 2023).orderBy("year").collect()
    assert [tuple(r) for r in got] == [(2022, 0.0, 0.0, 0.0), (2023, 0.0, 100.0, 0.0)]


def test_top_classes(spark):
    data = [("a", 1.0), ("b", 1.0), ("c", 5.0), ("d", None)]
    df = spark.createDataFrame([(2000, "X", "Y", "TM4a", c, v) for c, v in data], "year INT, origin STRING, destination_office STRING, ip_indicator STRING, class_code STRING, count DOUBLE")
    got = m.top_classes(df, ["X"], ["Y"], 2000, ["TM4a"], n=2).collect()
    assert [tuple(r) for r in got] == [("c", 5.0, 71.43), ("a", 1.0, 14.29)]
    assert m.top_classes(df, ["X"], ["Y"], 1999).count() == 0


def test_cohorts(spark):
    ranks = {2013: "abcd", 2018: "badc", 2023: "dcab"}
    df = spark.createDataFrame([(y, e, p) for y, s in ranks.items() for p, e in enumerate(s, 1)], "year INT, e STRING, position INT")
    got = {r.e: (r.cohort, r.slot) for r in m.cohort_pin(df, "e", 2).collect()}
    assert got == {"d": ("last_top", 1), "c": ("last_top", 2), "b": ("first_top", 1), "a": ("first_top", 2)}
    assert {r.e: r.cohort for r in m.cohort_pin(df, "e", 1).collect()} == {"d": "last_top", "a": "first_top", "b": "other", "c": "other"}


def test_ranking_table_cuts_years_after_ranking(spark):
    data = [("in", y, e, v) for y in (2012, 2013, 2014) for e, v in (("a", 3.0), ("b", 2.0), ("All countries", 5.0))]
    data += [("in", 2014, "c", 9.0), ("out", 2013, "a", 1.0), ("out", 2015, "a", 1.0)]
    df = spark.createDataFrame(data, "side STRING, year INT, region STRING, v DOUBLE")
    got = m.ranking_table(df, "region", "v", 1, "side", ("in", "out"), "in", exclude_members=["All countries"]).collect()
    assert {(r.year, r.region, r["rank"], r.years, r.cohort) for r in got} == {
        (2013, "a", 1, 2, "first_top"), (2014, "a", 2, 2, "first_top"), (2013, "b", 2, 2, "other"), (2014, "b", 3, 2, "other")
    }


def test_overlap_needs_both_sides(spark):
    df = spark.createDataFrame([("a", 2000), ("a", 2005), ("b", 2003), ("b", 2009)], "s STRING, year INT")
    assert tuple(m.overlap_years(df, "s", "a", "b").first()) == (2003, 2005)
    assert tuple(m.overlap_years(df, "s", "a", "z").first()) == (None, None)


def test_sort_puts_nulls_last(spark):
    df = spark.createDataFrame([(None,), (2,), (1,)], "k INT")
    assert [r.k for r in m.sort_mart(df, ["k"]).collect()] == [1, 2, None]


def test_null_keys_make_a_group(spark):
    df = spark.createDataFrame([(2000, "a", 1.0), (None, "b", 2.0), (None, "c", 6.0)], "year INT, destination_office STRING, count DOUBLE")
    shares = {r.destination_office: r.pct_share for r in m.with_share(df, "count", ["year"]).collect()}
    assert shares == {"a": 100.0, "b": 25.0, "c": 75.0}
    flows = df.withColumn("origin", m.F.lit("o")).withColumn("indicator", m.F.lit("i"))
    ranks = {r.year: (r.group_volume, r.group_rank) for r in m.rank_of_group(flows, ["o"], ["b"]).collect()}
    assert ranks == {2000: (0.0, 2), None: (2.0, 2)}
