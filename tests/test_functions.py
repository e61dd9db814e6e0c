from pyspark.sql import functions as F

from flowmart import functions as fx


def values(spark, column, items, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i INT, v {kind}")
    return [r.o for r in df.select("i", column.alias("o")).orderBy("i").collect()]


def test_numbers(spark):
    items = ["12", " 12.5 ", "-.5", "1e3", "1d", "nan", "inf", "", "x", None, "12.", "1,2"]
    assert values(spark, fx.to_number("v"), items) == [12.0, 12.5, -0.5, 1000.0, None, None, None, None, None, None, 12.0, None]
    assert values(spark, fx.to_whole("v"), ["12.0", "12.5", "1e3", "", None, "99999999999"]) == [12, None, 1000, None, None, None]


def test_years(spark):
    assert values(spark, fx.year_of("v"), ["2019-05", "1990", "x", None]) == [2019, 1990, None, None]
    assert values(spark, fx.year_of("v", "YR"), ["YR1990", "1991"]) == [1990, 1991]


def test_unscale_and_sums(spark):
    df = spark.createDataFrame([(2.0, 3, 1.0, None), (5.0, None, None, None), (1.0, 0, None, 4.0)], "v DOUBLE, e INT, a DOUBLE, b DOUBLE")
    got = df.select(fx.unscale("v", "e"), fx.nullable_sum("a", "b")).collect()
    assert [tuple(r) for r in got] == [(2000.0, 1.0), (None, None), (1.0, 4.0)]


def test_percent(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (None, 2.0)], "p DOUBLE, w DOUBLE")
    assert [tuple(r) for r in df.select(fx.percent("p", "w"), fx.percent("p", "w", zero=0)).collect()] == [
        (25.0, 25.0), (None, 0.0), (None, 0.0)
    ]


def test_class_codes(spark):
    items = ["Class 07", "7", "07", "00", "Other services", "another kind", "unknown", "no digits ", None]
    assert values(spark, fx.class_code("v"), items) == ["7", "7", "7", "0", "Other", "another kind", "Unknown", "no digits", None]
    assert values(spark, fx.class_code("v", pad=True, match="contains"), items) == [
        "07", "07", "07", "00", "Other", "Other", "Unknown", "no digits", None
    ]
    assert values(spark, fx.class_code("v", pad=True), ["Class 123"]) == ["123"]


def test_industry_text(spark):
    items = ["Total of all industries", "Oilseed and grain farming [1111]", "Fruit [11] x [1113]", "Wide [111]", "Long [11111]", "Line [1111]\n", None]
    assert values(spark, fx.is_industry_group("v"), items) == [True, True, True, False, False, False, None]
    assert values(spark, fx.industry_code("v"), items)[:5] == [None, 1111, 1113, None, None]
    assert values(spark, fx.industry_name("v"), items)[:4] == ["Total", "Oilseed and grain farming", "Fruit [11] x", "Wide"]


def test_short_text(spark):
    items = ["Food manufacturing", "manufacturing of manufacturing", "None", None]
    assert values(spark, fx.shorten("v", "manufacturing", "mfg."), items) == ["Food mfg.", "mfg. of manufacturing", "None", None]
    assert values(spark, fx.blank_to_null("v", ["..", " "]), [" a ", " ", "", "..", None]) == ["a", None, None, None, None]
    assert values(spark, fx.plain_dashes(F.col("v")), ["a – b — c"]) == ["a - b - c"]
