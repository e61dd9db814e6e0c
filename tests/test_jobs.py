import pytest

from flowmart import schema, sinks
from flowmart.operators import conform, enrich
from flowmart.plans import jobs

HEADER = "Stats\n\nx\ny\nz\nw\n"


def land(folder, name, lines):
    (folder / name).write_text(HEADER + "\n".join(lines) + "\n")


def test_landing_to_marts(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    head = "Office,Office (Code),Origin"
    land(raw, "patent_1a- Direct.csv", [f"{head},1980,1981", "Canada,CA,Total,5,6", "Japan,JP,Namibia,,2"])
    land(raw, "trademark_1a- Direct.csv", [f"{head},1980", "China,CN,Canada,4", "China,CN,Japan,"])
    land(raw, "patent_3 - In force.csv", ["Office,Office (Code),Origin,Type,1980", "Canada,CA,,Total,7"])
    land(raw, "trademark_4a- By class.csv", [f"{head},Nice classification,1980", "TOTAL,,Japan,Class 07,3", "Japan,JP,Total,Other,1"])
    land(raw, "patent_1a_office- Totals.csv", ["Office,c,x,Type,1980", "Canada,CA,,Resident,1"])
    paths = spark.createDataFrame([(str(p),) for p in raw.iterdir()], "path STRING")
    staged_dir = str(tmp_path / "staged")
    with pytest.raises(ValueError, match="missing raw files"):
        jobs.run_staging(spark, paths, staged_dir)
    assert jobs.run_staging(spark, paths, staged_dir, allow_missing=True) == ["PA1a", "PA3", "TM1a", "TM4a"]

    codes = spark.createDataFrame([("Canada", "CA"), ("Namibia", "NA"), ("Japan", "JP"), ("China", "CN")], "entity_name STRING, st3_code STRING")
    supplement = spark.createDataFrame(
        [(1980, "Canada", 10, 1), (1980, "Japan", 0, None), (1999, "Peru", 5, 5)], "year INT, region STRING, direct_apps INT, madrid_apps INT"
    )
    frames = jobs.staged_frames(spark, staged_dir, ["PA1a", "PA3", "TM1a"])
    n = jobs.run_flows(spark, frames, codes, str(tmp_path / "flows"), str(tmp_path / "export"), supplement)
    fact = sinks.read_mart(spark, str(tmp_path / "flows")).select(*schema.FLOWS.names)
    assert n == fact.count() == 7
    assert {tuple(r) for r in fact.collect()} == {
        (1980, "World", "WD", "Canada", "CA", "PA1a", 5.0), (1981, "World", "WD", "Canada", "CA", "PA1a", 6.0),
        (1980, "Namibia", "NA", "Japan", "JP", "PA1a", None), (1981, "Namibia", "NA", "Japan", "JP", "PA1a", 2.0),
        (1980, "World", "WD", "Canada", "CA", "PA3", 7.0),
        (1980, "Canada", "CA", "China", "CN", "TM1a", 14.0), (1980, "Japan", "JP", "China", "CN", "TM1a", None),
    }
    exported = spark.read.csv(str(tmp_path / "export"), header=True)
    assert exported.columns == schema.FLOWS.names and exported.count() == 7

    labels = enrich.class_label_dim(spark.createDataFrame([("7", "Machines")], "Class STRING, Industry STRING"), "Nice")
    jobs.run_class_flows(spark, jobs.staged_frames(spark, staged_dir, ["TM4a"]), codes, labels, str(tmp_path / "classes"))
    classes = sinks.read_mart(spark, str(tmp_path / "classes")).select(*schema.CLASS_FLOWS.names)
    assert {tuple(r) for r in classes.collect()} == {
        (1980, "Japan", "World", "WD", "TM4a", "Nice", "7 - Machines", 3.0), (1980, "World", "Japan", "JP", "TM4a", "Nice", "Other", 1.0)
    }


    assert jobs.run_residency(spark, paths, str(tmp_path / "residency")) == 1
    assert sinks.read_mart(spark, str(tmp_path / "residency")).select(*schema.RESIDENCY_FLOWS.names).first() == (1980, "Canada", "Total", "Resident", "PA1a", 1.0)


def test_class_files_by_position(spark):
    wide = spark.createDataFrame([("Canada", "CA", "Japan", "an Other 7", "3", None), ("Canada", "CA", "Japan", "Class 7", "4", "x")], "a STRING, b STRING, c STRING, d STRING, `2000` STRING, `2001` STRING")
    staged = jobs.stage_indicator(conform.apply_layout(wide, "by_class"))
    labels = enrich.class_label_dim(spark.createDataFrame([("8", "x")], "class STRING, industry STRING"), "Nice", pad=True)
    codes = spark.createDataFrame([("Canada", "CA")], "entity_name STRING, st3_code STRING")
    got = jobs.class_mart({"TM3a": staged, "PA4a": staged}, codes, labels, pad=True, match="contains", fallback="code", drop_nulls=True)
    assert {(r.ip_indicator, r.class_type, r.class_code, r["count"]) for r in got.collect()} == {
        ("TM3a", "Nice", "Other", 3.0), ("TM3a", "Nice", "07", 4.0), ("PA4a", "Tech field", "an Other 7", 3.0), ("PA4a", "Tech field", "Class 7", 4.0)
    }


def test_macro_flows_from_files(spark, tmp_path):
    (tmp_path / "i.csv").write_text('REF_DATE,GEO,DGUID,Country,Estimates,SCALAR_ID,VALUE\n2020,Canada,x,"Korea, South",Value of imports,3,1.5\n')
    got = jobs.run_macro_flows(spark, {"imports": str(tmp_path / "i.csv")}, str(tmp_path / "out"))
    assert [tuple(r) for r in got.collect()] == [(2020, "Korea, South", schema.IMPORTS_FLOW, 1500.0)]


def test_class_mart_needs_class_columns(spark):
    df = spark.createDataFrame([(1980, "a", "b", 1.0)], "year INT, origin STRING, destination_office STRING, count DOUBLE")
    none = spark.createDataFrame([], "class_type STRING, class_code_short STRING, class_code_labeled STRING")
    codes = spark.createDataFrame([], "entity_name STRING, st3_code STRING")
    with pytest.raises(ValueError, match="no classification column"):
        jobs.class_mart({"TM4a": df}, codes, none)
    with pytest.raises(ValueError, match="no class indicators"):
        jobs.class_mart({"PA1a": df}, codes, none)


def test_macro_flows(spark):
    columns = "REF_DATE STRING, GEO STRING, Country STRING, Estimates STRING, SCALAR_ID STRING, VALUE STRING"
    raw = spark.createDataFrame(
        [
            ("2020", "Canada", "Japan", "Value of imports", "3", "2"), ("2020", "Canada", "Japan", "Value of imports", "3", "2"),
            ("2020", "Ontario", "Japan", "Value of imports", "0", "9"), ("2020", "Canada", "Japan", "Number", "0", "9"),
            ("2021", "Canada", "Peru", "Value of imports", None, "5"), ("2021", "Canada", "Chile", "Value of imports", "6", ".."),
        ],
        columns,
    )
    got = {tuple(r) for r in jobs.macro_flows_mart({"imports": raw}).collect()}
    flow = schema.IMPORTS_FLOW
    assert got == {(2020, "Japan", flow, 2000.0), (2021, "Peru", flow, None), (2021, "Chile", flow, None)}


def test_industry_trade(spark):
    columns = f"REF_DATE STRING, Trade STRING, `Trading Partners` STRING, `{schema.INDUSTRY_COLUMN}` STRING, VALUE DOUBLE"
    raw = spark.createDataFrame(
        [
            ("2019-05", "Imports", "Japan", "Farming [1111]", 1.0), ("2019-06", "Imports", "Japan", "Farming [1111]", 2.0),
            ("2019-06", "Imports", "Japan", "Total of all industries", 9.0), ("2019-06", "Imports", "Japan", "Farming [111]", 5.0),
            ("2019-06", "Balance", "Japan", "Farming [1111]", 5.0),
        ],
        columns,
    )
    got = jobs.industry_trade_mart(jobs.stage_industry_trade(raw))
    assert got.schema.names == schema.INDUSTRY_TRADE.names
    assert {tuple(r) for r in got.collect()} == {(2019, "Imports", "Japan", 1111, "Farming", 3.0), (2019, "Imports", "Japan", None, "Total", 9.0)}


def test_macro_stats_headers_differ_in_case(spark, tmp_path):
    from flowmart import sources

    (tmp_path / "s.csv").write_text("economy,series,Country,Series,YR1990,YR1991\nCAN,SP.POP,Canada,\"Population, total\",27.5,\n")
    wide = sources.read_wide_csv(spark, str(tmp_path / "s.csv"), skip_lines=0, repair_header=False)
    got = {tuple(r) for r in jobs.macro_stats(wide).collect()}
    assert got == {("CAN", "Canada", "Population, total", 1990, 27.5), ("CAN", "Canada", "Population, total", 1991, None)}


def test_office_pairs(spark):
    df = spark.createDataFrame([("JPO", "USPTO", 2020, 20.0, None)], "`Office Of Earlier Examination` STRING, ` Office of Later Examination` STRING, `Year ` INT, National DOUBLE, PCT DOUBLE")
    got = jobs.office_pairs_mart(df)
    assert got.columns == schema.OFFICE_PAIRS.names
    assert {tuple(r) for r in got.collect()} == {("JPO", "USPTO", 2020, "National", 20), ("JPO", "USPTO", 2020, "PCT", 0)}


def test_country_regions(spark):
    social = spark.createDataFrame(
        [(1, "x", "10", " ", "World", " "), (2, "y", "20", "10", "Peru", "note"), (2, "y", "15", "10", "Chile", " ")],
        "Level INT, `Hierarchical structure` STRING, Code STRING, `Parent Code` STRING, `Class title` STRING, Footnotes STRING",
    )
    codes = spark.createDataFrame([("20", "Peru", "604", "PE", "PER", "note"), ("15", "Chile", "152", "CL", "CHL", "c")], "Code STRING, `Countries and Areas of Interest` STRING, `Num-3` STRING, `Alpha-2` STRING, `Alpha-3` STRING, Footnotes STRING")
    got = [(r.sccai_code_id, r.region, r.iso_alpha_3_code, r.notes) for r in jobs.country_regions(social, codes).orderBy("sccai_code_id").collect()]
    assert got == [(1, "World", None, None), (2, "Chile", "CHL", "c"), (3, "Peru", "PER", "note")]
    clash = codes.replace({"note": "other"}, subset=["Footnotes"])
    with pytest.raises(Exception, match="conflicting values: note / other"):
        jobs.country_regions(social, clash).collect()


def test_unknown_leading_columns_fail_and_class_files_go_by_position(spark):
    import pytest

    wide = spark.createDataFrame([("Canada", "CA", "Total", "Class 1", "5")], "Office STRING, `Office (Code)` STRING, Origin STRING, `Nice class` STRING, `2000` STRING")
    with pytest.raises(ValueError, match="Nice class"):
        jobs.stage_indicator(wide)
    assert [tuple(r) for r in jobs.stage_by_class(wide).select("class_code", "count").collect()] == [("Class 1", 5.0)]
    with pytest.raises(ValueError, match="four columns"):
        jobs.stage_by_class(wide.drop("Office (Code)"))


def test_two_residency_files_for_one_indicator_fail(spark, tmp_path):
    import pytest

    for n, name in enumerate(("Canada", "France")):
        text = "t\n" * 6 + f"Office,Office (Code),Origin,Type,2000\n{name},X,,Total,{n}\n"
        (tmp_path / f"patent_1a_office- {n}.csv").write_text(text)
    paths = spark.read.format("binaryFile").load(str(tmp_path)).select("path")
    with pytest.raises(ValueError, match="duplicate"):
        jobs.run_residency(spark, paths, str(tmp_path / "out"))


def test_either_dash_is_staged(spark):
    from flowmart.plans.jobs import MACRO_TABLES

    config = MACRO_TABLES["fdi_ultimate"]
    texts = [config.categories[0], config.categories[0].replace("–", "-"), config.categories[1].replace(" - ", " — ")]
    raw = spark.createDataFrame([("Canada", t, "2000", "x", "1", "0") for t in texts], f"GEO STRING, `{config.category}` STRING, REF_DATE STRING, `Countries or regions` STRING, VALUE STRING, SCALAR_ID STRING")
    assert jobs.macro_flows_mart({"fdi_ultimate": raw}).count() == 2
