import pytest
from pyspark.sql import functions as F

from flowmart import schema
from flowmart.operators import catalog, quality as q
from flowmart.plans import jobs


def charges(spark, extra=()):
    names = [*schema.CHARGES_REQUIRED, "France"]
    data = [(2022, n, schema.CHARGES_FLOW, -1.0 - i) for i, n in enumerate(names)] + list(extra)
    rows = spark.createDataFrame(data, "year INT, counterpart_country STRING, flow_type STRING, value_cad_millions DOUBLE")
    return rows


def failed(report):
    return {r.check for r in report.where(~F.col("passed")).collect()}


def test_charges_contract_passes(spark):
    report = q.report(charges(spark), jobs.charges_rules(8))
    assert report.count() == 14 and failed(report) == set()
    q.gate(report)


@pytest.mark.parametrize(
    "row, broken",
    [
        ((2025, "Peru", schema.CHARGES_FLOW, 1.0), {"range:year"}),
        ((2022, "Korea", schema.CHARGES_FLOW, 1.0), {"banned:counterpart_country"}),
        ((2022, "France", schema.CHARGES_FLOW, 1.0), {"unique:year,counterpart_country"}),
        ((2022, " ", schema.CHARGES_FLOW, 1.0), {"no_blanks"}),
        ((2022, "Peru", "other", 1.0), {"only:flow_type"}),
        ((2022, "Peru", schema.CHARGES_FLOW, None), {"no_nulls"}),
        ((2022, "United States", schema.CHARGES_FLOW, 1.0), {"unique:year,counterpart_country", "united_states_2022"}),
    ],
)
def test_charges_contract_fails(spark, row, broken):
    report = q.report(charges(spark, [row]), jobs.charges_rules())
    assert failed(report) == broken
    with pytest.raises(ValueError, match="quality gate failed"):
        q.gate(report)


def test_missing_members_columns_and_count(spark):
    df = charges(spark).where("counterpart_country <> 'Taiwan'").drop("flow_type")
    rules = [q.columns_are(schema.CHARGES.names), q.row_count_is(8), q.with_members("counterpart_country", schema.CHARGES_REQUIRED)]
    assert failed(q.report(df, rules)) == {"columns", "row_count", "required:counterpart_country"}


def test_rules_of_one_kind_do_not_meet(spark):
    df = spark.createDataFrame([("a", None)], "x STRING, y STRING")
    rules = [q.no_nulls(["x"]), q.no_nulls(["y"]), q.without_members("x", ["a"]), q.without_members("x", ["b"])]
    assert [r.passed for r in q.report(df, rules).collect()] == [True, False, False, True]


def test_empty_table_fails_its_checks(spark):
    report = q.report(charges(spark).limit(0), [q.in_range("year", 0, 9), q.only_value("flow_type", "x"), q.some("any", F.lit(True))])
    assert failed(report) == {"range:year", "only:flow_type", "any"}


def test_member_tables(spark):
    names = lambda *v: spark.createDataFrame([(x,) for x in v], "member STRING")
    got = q.members(names("a", "b", "b"), "member", names("b", "x"), names("a", "c"))
    assert {tuple(r) for r in got.collect()} == {("b", "banned"), ("c", "missing")}


def test_constants_with_nulls(spark):
    df = spark.createDataFrame([("CAN", "A"), ("CAN", None)], "area STRING, freq STRING")
    got = {r.column: r.passed for r in q.constants(df, {"area": "CAN", "freq": "A"}).collect()}
    assert got == {"area": True, "freq": False}


def test_profile(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), (None, 2), ("a", 10)], "s STRING, n INT")
    got = {r.column: (r.n_unique, r.sample_values) for r in catalog.profile(df, 2).collect()}
    assert got == {"s": (2, [None, "a"]), "n": (3, ["1", "10"])}
    assert {r.column: r.n_unique for r in catalog.profile(df, 2, approx=True).collect()} == {"s": 2, "n": 3}


def test_profile_of_a_dominating_value_is_cut_before_the_shuffle(spark):
    plan = catalog.profile(spark.range(10).selectExpr("id", "'x' AS s"))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_sketched_profile_shuffles_no_cells(spark, tmp_path):
    df = spark.range(20_000).select((F.col("id") % 5000).alias("n"), F.when(F.col("id") % 3 > 0, F.lpad(F.col("id"), 6, "0")).alias("s"), F.lit(None).cast("int").alias("e"))
    got = {r.column: r for r in catalog.profile(df, 4, approx=True).collect()}
    exact = {r.column: r for r in catalog.profile(df, 4).collect()}
    for c, r in exact.items():
        assert abs(got[c].n_unique - r.n_unique) <= 0.06 * r.n_unique and got[c].sample_values == r.sample_values
    plan = catalog.sketch(df, sample_n=4)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("hll_sketch_agg") and "Expand" not in plan
    # What leaves a task: a row of sketches, and at most four values a column.
    assert df.select(F.col("s")).repartition(6).mapInArrow(lambda it: catalog._least_values(it, 1, 4), "at int, value string").count() <= 24


def test_sketches_of_parts_are_merged_for_any_subset(spark, tmp_path):
    df = spark.range(9000).select((F.col("id") % 3).cast("string").alias("part"), (F.col("id") % 1000 + F.col("id") % 3 * 700).alias("v"), F.when(F.col("id") > 8000, F.lit("x")).alias("w"))
    catalog.sketch(df, ["part"], 5).write.parquet(str(tmp_path / "s"))
    table = spark.read.parquet(str(tmp_path / "s"))
    assert {(r.part, r.column): (r.n_rows, r.n_filled) for r in table.where("column = 'v'").collect()} == {(p, "v"): (3000, 3000) for p in "012"}
    for parts in (["0"], ["0", "2"], ["0", "1", "2"]):
        own = df.where(F.col("part").isin(parts)).drop("part")
        got = {r.column: r for r in catalog.from_sketches(table.where(F.col("part").isin(parts)), 5).collect()}
        for r in catalog.profile(own, 5).collect():
            assert abs(got[r.column].n_unique - r.n_unique) <= 0.06 * r.n_unique + 0.5 and got[r.column].sample_values == r.sample_values


def test_overview(spark):
    n, described, head = catalog.overview(spark.range(10).withColumn("s", F.lit("x")), 3)
    assert n.first().n_rows == 10 and head.count() == 3
    assert [tuple(r) for r in described.orderBy("ordinal").collect()] == [(0, "id", "bigint"), (1, "s", "string")]


def test_dictionary_of_mixed_files(spark, tmp_path):
    import gzip

    root = tmp_path / "data"
    for folder in ("raw/x", "staging", "skip"):
        (root / folder).mkdir(parents=True)
    (root / "raw/x/wide.csv").write_text("one\ntwo\nOffice,1980\nCanada,5\n")
    (root / "staging/t.txt").write_text("a\tb\n1\tx\n")
    (root / "staging/notes.txt").write_text("just\ttext\nwithout tabs\n")
    (root / "staging/r.xml").write_text("<root><rec><col1>1</col1><col2>x</col2></rec><rec/></root>")
    (root / "staging/broken.parquet").write_text("not parquet")
    (root / "skip/z.csv").write_text("a\n1\n")
    (root / "top.csv").write_text("a\n1.5\n")
    with gzip.open(root / "staging/g.csv.gz", "wt") as f:
        f.write("a,b\n1,true\n")
    spark.range(1).write.parquet(str(root / "marts/part"))
    found = catalog.data_dictionary(spark, str(root), ["skip"], skip_lines=lambda p: 2 if "/raw/" in p else 0).collect()
    got = {(r.layer, r.table_filetype, r.table_name, r.column_name, r.column_dtype) for r in found if r.layer != "marts" and r.error is None}
    broken = [r for r in found if r.error is not None]
    assert [(r.table_name, r.column_name) for r in broken] == [("broken", None)] and "Parquet" in broken[0].error
    assert got == {
        ("raw", ".csv", "wide", "Office", "string"), ("raw", ".csv", "wide", "1980", "string"),
        ("staging", ".txt", "t", "a", "string"), ("staging", ".txt", "t", "b", "string"),
        ("staging", ".xml", "r", "col1", "string"), ("staging", ".xml", "r", "col2", "string"),
        ("staging", ".csv.gz", "g.csv", "a", "string"), ("staging", ".csv.gz", "g.csv", "b", "string"),
        ("unknown", ".csv", "top", "a", "string"),
    }
    marts = [r for r in found if r.layer == "marts"]
    assert marts and marts[0].column_name == "id" and marts[0].table_path.startswith("data/marts/part/")


def test_dictionary_of_nested_xml_and_landed_files(spark, tmp_path):
    root = tmp_path / "data"
    (root / "raw").mkdir(parents=True)
    body = "".join(f"<group g='{i}'><rec a='1'><v unit='x'>{i}</v></rec></group>" for i in range(3))
    (root / "raw/n.xml").write_text(f"<root date='d'><!-- <rec><rec> --><head/>{body}</root>")
    (root / "raw/patent_1a- x.csv").write_text("p\n" * 6 + "Office,2000\nCanada,1\n")
    found = catalog.data_dictionary(spark, str(root)).collect()
    assert [r.column_name for r in found if r.table_name == "n"] == ["rec_a", "group_g", "root_date", "unit"]
    assert [r.column_name for r in found if r.table_name.startswith("patent")] == ["Office", "2000"]


def test_profile_of_long_samples(spark):
    df = spark.range(6000).select(F.lpad("id", 5, "0").alias("v"))
    row = catalog.profile(df, sample_n=2500).first()
    assert row.n_unique == 6000 and row.sample_values == [f"{i:05d}" for i in range(2500)]
