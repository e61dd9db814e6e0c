import pytest

from pyspark.sql import functions as F

from flowmart import functions as fx, schema
from flowmart.operators import conform, reshape
from flowmart.plans import jobs


def test_contract_strict_and_absent(spark):
    df = spark.createDataFrame([(" a ", "12.0"), ("", "x")], " name STRING, `n ` STRING")
    got = conform.to_contract(df, schema.contract(label="string", n="int", extra="double"), {"name": "label"})
    assert got.dtypes == [("label", "string"), ("n", "int"), ("extra", "double")]
    assert [tuple(r) for r in got.collect()] == [("a", 12, None), (None, None, None)]
    with pytest.raises(ValueError, match="extra"):
        conform.to_contract(df, schema.contract(name="string", extra="double"), strict=True)


def test_layouts(spark):
    df = spark.createDataFrame([("A", "x", "B", "t", "1", "2")], "o STRING, c STRING, r STRING, t STRING, y1 STRING, y2 STRING")
    assert conform.apply_layout(df, "unilateral_typed", 1980).columns == ["Office", "Origin", "1980", "1981"]
    assert conform.apply_layout(df, "unilateral_typed").first()["Origin"] == "World"
    assert conform.apply_layout(df, "by_class").columns == ["Office", "Origin", "class_code", "y1", "y2"]
    assert conform.apply_layout(df, "by_office", 2000).columns == ["Office", "Type", "2000", "2001"]


def test_trim_stops_at_first_year_with_a_value(spark):
    df = spark.createDataFrame([("a", 1.0, None, 2.0, None, None)], "o STRING, `1` DOUBLE, `2` DOUBLE, `3` DOUBLE, `4` DOUBLE, `5` DOUBLE")
    assert conform.trim_trailing_years(df, list("12345")).columns == ["o", "1", "2", "3"]


def test_year_detection():
    assert reshape.year_columns(["Office", "1980", " 1981", "2200"]) == ["1980", " 1981"]
    assert reshape.year_columns(["Office", "12", "x"]) == ["12", "x"]
    assert reshape.year_columns(["economy", "YR1990"], prefix="YR") == ["YR1990"]
    with pytest.raises(ValueError):
        reshape.year_columns(["Office", "Origin"])


def test_unpivot_keeps_nulls_unless_told(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("b", None, "2")], "o STRING, `1990` INT, `1991` STRING")
    assert reshape.unpivot_years(df).count() == 4
    got = reshape.unpivot_years(df, drop_nulls=True).orderBy("o", "year").collect()
    assert [tuple(r) for r in got] == [("a", 1990, 1.0), ("b", 1991, 2.0)]


def test_staged_class_file(spark):
    df = spark.createDataFrame([(" Canada ", "CA", "Total", "Class 07", "5", "")], "Office STRING, `Office (Code)` STRING, Origin STRING, `Nice classification` STRING, `2000` STRING, `2001` STRING")
    got = jobs.stage_indicator(df)
    assert got.columns == ["year", "destination_office", "destination_office_st3_code", "origin", "nice_class", "count"]
    assert [tuple(r) for r in got.orderBy("year").collect()] == [
        (2000, "Canada", "CA", "Total", "Class 07", 5.0), (2001, "Canada", "CA", "Total", "Class 07", None)
    ]


def test_residency_sides(spark):
    office = spark.createDataFrame([("Canada", "CA", "", "Resident", "3", None)], "a STRING, b STRING, c STRING, d STRING, `1980` STRING, `1981` STRING")
    got = jobs.residency_mart({"PA1a_office": office, "PA1a_origin": office, "PA1a": office}, trim=True).collect()
    assert {tuple(r) for r in got} == {
        (1980, "Canada", "Total", "Resident", "PA1a", 3.0), (1980, "Total", "Canada", "Resident", "PA1a", 3.0)
    }


def test_hierarchy_skips_levels_without_code(spark):
    df = spark.createDataFrame([("1", "World", None, "x", "4", "A"), ("1", "World", "2", "y", "5", "B")], "gc STRING, gn STRING, ic STRING, i STRING, mc STRING, m STRING")
    got = reshape.hierarchy_members(df, [("gc", "gn"), ("ic", "i"), ("mc", "m")])
    assert {tuple(r) for r in got.collect()} == {("1", "World"), ("2", "y"), ("4", "A"), ("5", "B")}


def test_harmonize_and_fill(spark):
    df = spark.createDataFrame([("Total", None), (" TOTAL", None), ("World", "XX"), ("Totals", None), (None, None)], "o STRING, c STRING")
    exact = conform.harmonize(df, ["o"], {"Total": "World"})
    assert [r.o for r in exact.collect()] == ["World", " TOTAL", "World", "Totals", None]
    loose = conform.fill_code(conform.harmonize(df, ["o"], {"Total": "World"}, ignore_case=True), "o", "c")
    assert [tuple(r) for r in loose.collect()] == [("World", "WD"), ("World", "WD"), ("World", "XX"), ("Totals", None), (None, None)]


def test_relabel_normalizes_dashes(spark):
    label = jobs.MACRO_TABLES["fdi_ultimate"].categories[0]
    df = spark.createDataFrame([(label,), ("other",)], "t STRING")
    got = [r.f for r in conform.relabel(df, "t", schema.INVESTMENT_FLOWS, "f").collect()]
    assert got == ["FDI ultimate outward, total book value", None]


def test_gate_without_status_column(spark):
    df = spark.createDataFrame([("SH", 1.0), ("SH", None), ("S", 2.0)], "MEASURE STRING, value DOUBLE")
    assert conform.observation_gate(df).count() == 1
    assert conform.observation_gate(df.withColumn("obs_status", F.lit("E"))).count() == 0


def test_constants_and_nonzero(spark):
    df = conform.with_constants(spark.range(2), flow="x", n=1)
    assert {tuple(r) for r in df.collect()} == {(0, "x", 1), (1, "x", 1)}
    assert [r.v for r in spark.createDataFrame([("2",), (None,)], "v STRING").select(fx.null_to_zero_int("v").alias("v")).collect()] == [2, 0]
