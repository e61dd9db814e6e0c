import json
import zipfile

import pytest
from pyspark.sql import functions as F

from flowmart import schema, sinks, sources
from flowmart.operators import quality
from flowmart.plans import jobs

WIDE = '''Statistics

Indicator: 1a
Report: counts
Years: all
Source: x
$$MISSING$$,$$MISSING$$ ($$MISSING$$),$$MISSING$$,1980,1981,1982,
Canada,CA,Total,5,,,
"Namibia, Republic of",NA,"The ""North""",1.0,2,,

Canada,CA,Japan,x,3,,
'''


def test_header_repair_stops_at_first_year():
    mark = schema.MISSING_HEADER
    assert sources.fix_missing_headers([mark, f"{mark} ({mark})", mark, "1980"]) == ["Office", "Office (Code)", "Origin", "1980"]
    assert sources.fix_missing_headers([mark, "1980", mark]) == ["Office", "1980", mark]
    assert sources.fix_missing_headers([" Office ", "Code", "Origin", mark]) == ["Office", "Code", "Origin", mark]


def test_wide_csv(spark, tmp_path):
    path = tmp_path / "patent_1a- Direct applications.csv"
    path.write_text(WIDE)
    df = sources.read_wide_csv(spark, str(path))
    assert df.columns == ["Office", "Office (Code)", "Origin", "1980", "1981", "1982"]
    assert {tuple(r) for r in df.collect()} == {
        ("Canada", "CA", "Total", "5", None, None), ("Namibia, Republic of", "NA", 'The "North"', "1.0", "2", None),
        ("Canada", "CA", "Japan", "x", "3", None),
    }
    staged = jobs.stage_indicator(df, drop_nulls=True)
    assert {(r.year, r.origin, r["count"]) for r in staged.where("destination_office = 'Canada'").collect()} == {
        (1980, "Total", 5.0), (1980, "Japan", None), (1981, "Japan", 3.0)
    }


def test_wide_csv_split_over_tasks(spark, tmp_path):
    """Small splits: the preamble is dropped once, and no data row is lost at a split."""
    lines = WIDE.split("\n")[:7] + [f"Office {i},X{i},Origin {i},{i},{i + 1},," for i in range(3000)]
    path = tmp_path / "big.csv"
    path.write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = sources.read_wide_csv(spark, str(path))
        assert df.rdd.getNumPartitions() > 8
        assert df.count() == 3000
        assert df.agg(F.sum(F.col("1980").cast("long"))).first()[0] == sum(range(3000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_landing_tokens(spark):
    names = ["/d/patent_1a- Direct.csv", "/d/patent_1a_office- Totals.csv", "file:/d/patent_3%20-%20In%20force.csv", "/d/notes.csv", "/d/patent_10- x.csv"]
    paths = spark.createDataFrame([(n,) for n in names], "path STRING")
    dim = sources.prefix_dim(spark)
    got = {r.path: (r.indicator, r.location) for r in sources.with_indicator(paths, "path", dim).collect()}
    assert got == dict(zip(names, [("PA1a", None), ("PA1a_office", "office"), ("PA3", None), (None, None), ("PA10", None)]))
    manifest = sources.landing_manifest(paths, dim)
    assert {r.indicator for r in manifest.where("status = 'ok'").collect()} == {"PA1a", "PA3", "PA10"}
    with pytest.raises(ValueError, match="missing.*trademark_1a"):
        sources.require_landing(manifest)
    sources.require_landing(manifest, allow_missing=True)
    twice = paths.union(spark.createDataFrame([("/d/patent_1a- Other.csv",)], "path STRING"))
    with pytest.raises(ValueError, match="duplicate.*patent_1a"):
        sources.require_landing(sources.landing_manifest(twice, dim), allow_missing=True)


def document(status=True):
    """Six observations over two areas."""
    codes = lambda *ids: [{"id": i} for i in ids]
    dims = [
        ("REF_AREA", codes("CAN")), ("COUNTERPART_AREA", [{"id": "JPN", "name": "Japan"}, {"id": "W", "name": "World"}]),
        ("MEASURE", codes("SH", "S", "CA")), ("ACCOUNTING_ENTRY", codes("B")), ("FS_ENTRY", codes("T")), ("FREQ", codes("A")),
        ("UNIT_MEASURE", codes("XDC")), ("ADJUSTMENT", codes("N")), ("TIME_PERIOD", codes("2022", "2023")),
    ]
    cells = {
        "0:0:0:0:0:0:0:0:0": [-317.5, 0], "0:0:0:0:0:0:0:0:1": [-288.25, 0], "0:1:0:0:0:0:0:0:0": [-901.0, 0],
        "0:0:1:0:0:0:0:0:1": [-12.0, 0], "0:0:2:0:0:0:0:0:1": [-77.0, 0], "0:1:0:0:0:0:0:0:1": [-640.0, 1],
    }
    structure = {"dimensions": {"observation": [{"id": d, "keyPosition": i, "values": v} for i, (d, v) in enumerate(dims)]}}
    if status:
        structure["attributes"] = {"observation": [{"id": "UNIT_MULT", "values": codes("6")}, {"id": "OBS_STATUS", "values": codes("A", "E")}]}
        cells = {k: [v[0], 0, v[1]] for k, v in cells.items()}
    else:
        cells = {k: v[:1] for k, v in cells.items()}
    return {"data": {"structures": [structure], "dataSets": [{"observations": cells}]}}


def test_sdmx(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(document(), indent=1))
    decoded = jobs.stage_charges(sources.read_sdmx_json(spark, str(tmp_path / "a.json")))
    rows = decoded.collect()
    assert len(rows) == 6
    assert {r.MEASURE for r in rows} == {"SH", "S", "CA"} and {r.obs_status for r in rows} == {"A", "E"}
    assert {r.counterpart_country for r in rows if r.COUNTERPART_AREA == "JPN"} == {"Japan"}
    quality.gate(quality.constants(decoded, schema.CHARGES_CONSTANTS))
    clean = jobs.clean_charges(decoded)
    assert clean.dtypes == [("year", "int"), ("counterpart_area", "string"), ("counterpart_country", "string"), ("value_cad_millions", "double")]
    assert {tuple(r) for r in clean.collect()} == {
        (2022, "JPN", "Japan", -317.5), (2023, "JPN", "Japan", -288.25), (2022, "W", "World", -901.0)
    }


def test_sdmx_without_status_or_with_gaps(spark):
    doc = document(status=False)
    doc["data"]["dataSets"][0]["observations"]["0:1:0:0:0:0:0:0:0"] = [None]
    del doc["data"]["structures"][0]["dimensions"]["observation"][1]["values"][0]["name"]
    decoded = jobs.stage_charges(spark.createDataFrame([(json.dumps(doc),)], "value STRING"))
    assert {r.status_reported for r in decoded.collect()} == {False}
    assert {(r.year, r.counterpart_country) for r in jobs.clean_charges(decoded).collect()} == {(2022, "JPN"), (2023, "JPN"), (2023, "World")}
    doc = document()
    doc["data"]["dataSets"][0]["observations"]["0:0:0:0:0:0:0:0:0"] = [-1.0, 0, None]
    decoded = jobs.stage_charges(spark.createDataFrame([(json.dumps(doc),)], "value STRING"))
    assert jobs.clean_charges(decoded).count() == 2


def test_charges_end_to_end(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps(document()))
    spark.range(3).write.parquet(str(tmp_path / "mart"))
    with pytest.raises(ValueError, match="required:counterpart_country"):
        jobs.run_charges(spark, str(tmp_path / "c.json"), str(tmp_path / "mart"))
    assert spark.read.parquet(str(tmp_path / "mart")).count() == 3  # a mart that fails leaves the old one
    mart = jobs.ip_charges_mart(jobs.clean_charges(jobs.stage_charges(sources.read_sdmx_json(spark, str(tmp_path / "c.json")))))
    regions = spark.createDataFrame([(1, "Japan"), (2, "All countries")], "macroecon_region_id INT, region STRING")
    load = jobs.charges_load(mart, regions)
    assert {(r.year, r.macroecon_region_id, float(r.value_cad_millions)) for r in load.collect()} == {(2022, 1, -317.5), (2023, 1, -288.25), (2022, 2, -901.0)}
    with pytest.raises(ValueError, match="1 unmatched keys.*listed in"):
        jobs.charges_load(mart, regions.where("region <> 'All countries'"))


def archive(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)
    return str(path)


def test_zip_members(spark, tmp_path):
    declared = schema.contract(id="int", note="string")
    one = archive(tmp_path / "a.zip", {"readme.txt": "x", "d/one.csv": 'note,id\n"two\nlines",1\n,2\n', "two.csv": "id,note\n3,c\n"})
    two = archive(tmp_path / "b.zip", {"B.CSV": "id,note\n9,z\n"})
    got = sources.read_zip_csv(spark, [one, two], declared, member=sources.archives.FIRST)
    assert {tuple(r) for r in got.collect()} == {(1, "two\nlines"), (2, None), (9, "z")}
    out = sources.zip_csv_to_parquet(spark, [one], str(tmp_path / "out"), declared, member="two.csv")
    assert [tuple(r) for r in out.collect()] == [(3, "c")]
    with pytest.raises(Exception, match="several .csv members"):
        sources.read_zip_csv(spark, [one], declared).collect()
    with pytest.raises(Exception, match="no member"):
        sources.read_zip_csv(spark, [one], declared, member="none.csv").collect()
    with pytest.raises(Exception, match="no .csv member"):
        sources.read_zip_csv(spark, [archive(tmp_path / "c.zip", {"a.txt": ""})], declared).collect()


def test_zip_blocks_cut_inside_quotes(spark, tmp_path):
    text = "id,note\n" + "".join(f'{i},"line\n{i}"\n' for i in range(2000))
    path = archive(tmp_path / "q.zip", {"q.csv": text})
    got = sources.read_zip_csv(spark, [path], schema.contract(id="int", note="string"), block_bytes=4096)
    assert got.count() == 2000 and got.where("note = concat('line\n', id)").count() == 2000


def test_zip_extraction(spark, tmp_path):
    path = archive(tmp_path / "a.zip", {"d/one.csv": "a\n1\n", "two.csv": "b\n"})
    listing = sources.extract_zips(spark, [path], str(tmp_path / "out"), "raw_").collect()
    assert {r.member for r in listing} == {"d/one.csv", "two.csv"}
    at = {r.member: r.path for r in listing}
    assert at["d/one.csv"].endswith("/d/raw_one.csv") and open(at["d/one.csv"]).read() == "a\n1\n"
    (tmp_path / "other").mkdir()
    again = archive(tmp_path / "other/a.zip", {"two.csv": "c\n"})
    both = sources.extract_zips(spark, [path, again], str(tmp_path / "out")).where("member = 'two.csv'").collect()
    assert sorted(open(r.path).read() for r in both) == ["b\n", "c\n"]
    damaged = bytearray((tmp_path / "a.zip").read_bytes())
    damaged[damaged.index(b"a\n1\n")] = 0
    (tmp_path / "bad.zip").write_bytes(bytes(damaged))
    with pytest.raises(Exception, match="corrupt member"):
        sources.extract_zips(spark, [str(tmp_path / "bad.zip")], str(tmp_path / "out2")).collect()


def test_xml_depths(spark, tmp_path):
    (tmp_path / "flat.xml").write_text("<root><record><c1>1</c1><c2>x</c2></record><record><c1>2</c1></record></root>")
    flat = sources.read_xml_records(spark, str(tmp_path / "flat.xml"), "record")
    assert {tuple(r) for r in flat.select("c1", "c2").collect()} == {("1", "x"), ("2", None)}
    (tmp_path / "deep.xml").write_text(
        '<n:root xmlns:n="u"><n:year id="2000"><n:area code="CA"><n:obs kind="a"><n:v unit="k">1</n:v></n:obs>'
        '<n:obs kind="b"><n:v>2</n:v></n:obs></n:area></n:year></n:root>'
    )
    deep = sources.read_xml_records(spark, str(tmp_path / "deep.xml"), "year", ["area", "obs"])
    assert {tuple(r) for r in deep.select("year_id", "area_code", "kind", "v", "v_unit").collect()} == {
        ("2000", "CA", "a", "1", "k"), ("2000", "CA", "b", "2", None)
    }
    assert {r.tag: r.n for r in sources.tag_counts(spark, str(tmp_path / "flat.xml")).collect()} == {"root": 1, "record": 2, "c1": 2, "c2": 1}


def test_csv_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text('code,name,v\nNA,"Namibia",1\n,"",2\n')
    df = sources.read_csv(spark, str(tmp_path / "a.csv"), "code STRING, name STRING, v INT", ["code", "v"])
    assert [tuple(r) for r in df.collect()] == [("NA", 1), (None, 2)]
    assert dict(sources.read_any(spark, str(tmp_path / "a.csv")).dtypes)["v"] == "int"
    with pytest.raises(ValueError, match="unsupported"):
        sources.read_any(spark, "x.xlsx")
    (tmp_path / "t.txt").write_text("a\tb\n1\t2\n\n3\t4\n")
    assert sources.is_tab_separated(spark, str(tmp_path / "t.txt"))
    assert not sources.is_tab_separated(spark, str(tmp_path / "a.csv"))
    with pytest.raises(ValueError, match="none of the requested"):
        sources.project_existing(df, ["zzz"])


def test_contract_write(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2000)], "count DOUBLE, year INT")
    path = str(tmp_path / "c")
    assert sinks.write_parquet(df, path, contract=schema.contract(year="int", label="string", count="double")) == 1
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(2000, None, 1.0)]
    with pytest.raises(ValueError, match="nothing was written"):
        sinks.write_parquet(df.limit(0), path, contract=schema.contract(year="int", count="double"))


def test_partitioned_write_splits_a_hot_partition(spark, tmp_path):
    df = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") < 190_000, "hot").otherwise("cold").alias("indicator"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        assert sinks.write_parquet(df, str(tmp_path / "p"), ["indicator"]) == 200_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "p/indicator=hot").glob("*.parquet"))) > 1
    read = sources.read_staged(spark, str(tmp_path / "p"), ["cold"])
    assert read.count() == 10_000
    assert "PartitionFilters: [isnotnull(indicator" in read._jdf.queryExecution().executedPlan().toString()


def test_csv_export(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 1.0), ('q"uote', "", None)], "s STRING, e STRING, n DOUBLE")
    sinks.export_csv(df, str(tmp_path / "q"), gzip=False, quote_all=True)
    sinks.export_csv(df, str(tmp_path / "p"), gzip=False)
    read = lambda d: sorted(line for f in (tmp_path / d).glob("*.csv") for line in f.read_text().split("\n") if line and line[0] != "s" and line[:3] != '"s"')
    assert read("p") == ['"q""uote",,', "a,,1.0"]
    assert read("q") == ['"a","","1.0"', '"q""uote","",""']


def test_materialize_sorts_over_files(spark, tmp_path):
    df = spark.range(1000).select((999 - F.col("id")).alias("k"))
    out = sinks.materialize(df, str(tmp_path / "m"), view="m", sort=["k"])
    assert out.count() == 1000 and spark.table("m").count() == 1000
    ends = [(r.lo, r.hi) for r in out.groupBy(F.input_file_name()).agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("lo").collect()]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def test_database_calls(spark, monkeypatch):
    """No database is started here: the reader and writer are replaced and the calls they get are compared."""
    from pyspark.sql import DataFrameReader, DataFrameWriter

    calls = []

    def write(self, url, table, mode=None, properties=None):
        calls.append(("write", url, table, mode))
        self._df.write.format("noop").mode("overwrite").save()

    def read(self, url, table, **kw):
        calls.append(("read", url, table, kw.get("column")))
        return spark.range(1).select(F.lit(3).alias("n"))

    monkeypatch.setattr(DataFrameWriter, "jdbc", write)
    monkeypatch.setattr(DataFrameReader, "jdbc", read)
    df = spark.range(3)
    assert sinks.load_jdbc(df, "u", "s.t", {"id": "DECIMAL(20,2)"}, parts=1) == 3
    sinks.verify_load(spark, "u", "s.t", 3)
    with pytest.raises(ValueError, match="3 rows in the target, 4 loaded"):
        sinks.verify_load(spark, "u", "s.t", 4)
    sources.read_jdbc(spark, "u", "SELECT a FROM d")
    sources.read_jdbc(spark, "u", "SELECT a FROM d", split_on="a", bounds=(0, 9))
    assert calls[0] == ("write", "u", "s.t", "error")
    assert ("read", "u", "(SELECT a FROM d) t", None) in calls and ("read", "u", "(SELECT a FROM d) t", "a") in calls


def test_rows_verified_after_a_write(spark, tmp_path):
    n = sinks.write_parquet(spark.range(5), str(tmp_path / "v"))
    assert sinks.verify_written(spark, str(tmp_path / "v"), n).first().passed
    assert not sinks.verify_written(spark, str(tmp_path / "v"), n + 1).first().passed


def test_zip_members_are_partitions(spark, tmp_path):
    many = archive(tmp_path / "m.zip", {f"d/{k:03d}.csv": f"a,b\n{k},x\n" for k in range(40)} | {"notes.txt": "no", "other.csv": "z\n1\n"})
    rows = sources.read_zip_csv(spark, [many], member="d/*.csv")
    assert sorted(int(r.a) for r in rows.collect()) == list(range(40))
    assert rows.rdd.getNumPartitions() == 40 and max(rows.rdd.glom().map(len).collect()) == 1
    with pytest.raises(Exception, match="no member matches"):
        sources.read_zip_csv(spark, [many], member="e/*.csv")
    with pytest.raises(ValueError, match="headers differ"):
        sources.read_zip_csv(spark, [many], member="*.csv")
    one = sources.read_zip_csv(spark, [many], schema.contract(a="int"), member="d/007.csv")
    assert [r.a for r in one.collect()] == [7]


def test_zip_text_is_unchanged_and_columns_are_kept(spark, tmp_path):
    path = archive(tmp_path / "a.zip", {"a.csv": "DocId,text\n1,  padded \n2, \n3,\n"})
    every = sources.read_zip_csv(spark, [path])
    assert every.columns == ["DocId", "text"]
    assert sorted(tuple(r) for r in every.collect()) == [("1", "  padded "), ("2", " "), ("3", None)]
    with pytest.raises(Exception, match="doc_id"):
        sources.read_zip_csv(spark, [path], schema.contract(doc_id="int")).collect()
    with pytest.raises(Exception):
        sources.read_zip_csv(spark, [path], schema.contract(text="int")).collect()
    other = archive(tmp_path / "b.zip", {"a.csv": "id\n1\n"})
    with pytest.raises(ValueError, match="headers differ"):
        sources.read_zip_csv(spark, [path, other])


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_every_wide_file_drops_its_own_preamble(spark, tmp_path):
    rows = "Office,Origin,2000,\n{}"
    put(tmp_path / "w" / "a.csv", "Title A\n\n" + rows.format("Canada,NA,1,\n"))
    put(tmp_path / "w" / "b.csv", "Title B\nIndicator: b\n" + rows.format("Title A,x,2,\nOffice,Origin,3,\n"))
    got = sources.read_wide_csv(spark, str(tmp_path / "w"), 2)
    assert sorted(tuple(r) for r in got.collect()) == [("Canada", "NA", "1"), ("Office", "Origin", "3"), ("Title A", "x", "2")]
    put(tmp_path / "w" / "c.csv", "t\n\nOffice,Code,2000,\n")
    with pytest.raises(ValueError, match="headers differ"):
        sources.read_wide_csv(spark, str(tmp_path / "w"), 2)
    put(tmp_path / "v" / "a.csv", "one\n")
    with pytest.raises(ValueError, match="no header"):
        sources.read_wide_csv(spark, str(tmp_path / "v"), 2)


def test_wide_lines_that_do_not_parse_fail(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'T\nOffice,2000\n"Can\nada",1\nFrance,2\n')
    with pytest.raises(Exception):
        sources.read_wide_csv(spark, path, 1).collect()
    assert sorted(tuple(r) for r in sources.read_wide_csv(spark, path, 1, quoted_newlines=True).collect()) == [("Can\nada", "1"), ("France", "2")]


def test_wide_ranges_give_every_line_once(tmp_path):
    """Any cut of a file gives its lines, each in the range that it begins in."""
    import random

    from flowmart.sources.wide_csv import line_blocks, plan_ranges

    rng = random.Random(1)
    for _ in range(60):
        lines = ["x" * rng.choice([0, 1, 3, 40, 300]) for _ in range(rng.randint(0, 40))]
        text = "head\n" + "\n".join(lines) + rng.choice(["", "\n"])
        path = put(tmp_path / "r.csv", text)
        size = rng.choice([1, 7, 50, 1000])
        ranges = [p for r in plan_ranges([(path, len(text), 5)], size, 0) for p in r.parts]
        got = [b for r in ranges for b in line_blocks(*r, block=rng.choice([3, 64]))]
        assert b"".join(got).decode() == text[5:]
        assert all(b.endswith(b"\n") for b in got[:-1])


def test_wide_lines_pass_python_once(spark, tmp_path, monkeypatch):
    """The plan has one scan and no Python beside it, and headers come from a file's first lines."""
    for k in range(3):
        put(tmp_path / "w" / f"{k}.csv", f"T{k}\nOffice,2000\n" + "".join(f"O{i},{i}\n" for i in range(1000)))
    df = sources.read_wide_csv(spark, str(tmp_path / "w"), 1)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchScan") == 1 and "InArrow" not in plan and "EvalPython" not in plan
    assert df.count() == 3000 and df.selectExpr("sum(cast(`2000` as long))").first()[0] == 3 * sum(range(1000))


def test_wide_cells_blank_lines_and_packed_files(spark, tmp_path):
    import gzip

    text = 'T\r\nOffice,Origin,2000\r\nNA,"",\r\n  \r\n"a ""b"", c", d ,1\r\n\r\n'
    put(tmp_path / "p" / "a.csv", text)
    with gzip.open(tmp_path / "p" / "b.csv.gz", "wt", newline="") as f:
        f.write(text)
    got = sources.read_wide_csv(spark, str(tmp_path / "p"), 1).collect()
    assert sorted(map(tuple, got), key=str) == sorted([("NA", "", None), ('a "b", c', " d ", "1")] * 2, key=str)
    put(tmp_path / "q.csv", "Office,2000\na,1\nb\n")
    with pytest.raises(Exception, match="Expected 2 columns"):
        sources.read_wide_csv(spark, str(tmp_path / "q.csv"), 0).collect()
    put(tmp_path / "e.csv", "Office,2000")
    assert sources.read_wide_csv(spark, str(tmp_path / "e.csv"), 0).collect() == []


def test_sdmx_documents_are_parsed_once(spark):
    doc = '{"data": {"structures": [{"dimensions": {"observation": [{"id": "D", "keyPosition": 0, "values": [{"id": "x"}]}]}, "attributes": {"observation": []}}], "dataSets": [{"observations": {"0": [1.5]}}]}}'
    rows = sources.decode_sdmx(spark.createDataFrame([(doc,)] * 3, "value STRING"), ["D"], name_dim="D")
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert [tuple(r) for r in rows.select("D", "counterpart_country", "value").collect()] == [("x", "x", 1.5)] * 3


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = put(tmp_path / "a.csv", "a,b,c\n1,2,3\n")
    assert sources.read_csv(spark, path, "c INT, a INT").first().asDict() == {"c": 3, "a": 1}
    with pytest.raises(ValueError, match="lacks"):
        sources.read_csv(spark, path, "d INT")
    put(tmp_path / "f" / "a.csv", "a,b,c\n1,2,3\n")
    put(tmp_path / "f" / "b.csv", "b,a,c\n1,2,3\n")
    with pytest.raises(Exception):
        sources.read_csv(spark, str(tmp_path / "f"), "a INT").collect()


def test_malformed_sdmx_fails(spark):
    for text in ("{not json", "{}", '{"data": {"structures": [], "dataSets": []}}'):
        with pytest.raises(Exception):
            sources.decode_sdmx(spark.createDataFrame([(text,)], "value STRING"), ["A"]).count()


def test_tabs_over_all_lines(spark, tmp_path):
    lines = ["a\tb"] * 40
    assert sources.is_tab_separated(spark, put(tmp_path / "t.txt", "\n".join(lines)))
    assert not sources.is_tab_separated(spark, put(tmp_path / "u.txt", "\n".join([*lines, "a\tb\tc"])))
    assert not sources.is_tab_separated(spark, put(tmp_path / "v.txt", ""))


def test_record_tag_and_root_attributes(spark, tmp_path):
    body = "".join(f"<group g='{i}'><rec a='1'><v>{i}</v></rec></group>" for i in range(3))
    path = put(tmp_path / "n.xml", f"<root date='d'><!-- <other/><other/> -->{body}</root>")
    assert sources.record_tag(spark, path) == "v"
    got = sources.read_xml_records(spark, path, "root", ["group", "rec"])
    assert sorted(tuple(r[c] for c in ("root_date", "group_g", "a", "v")) for r in got.collect()) == [("d", str(i), "1", str(i)) for i in range(3)]
    clash = put(tmp_path / "c.xml", "<root><rec a='1'><a>2</a></rec><rec a='1'><a>2</a></rec></root>")
    with pytest.raises(ValueError, match="share the column"):
        sources.read_xml_records(spark, clash, "rec")


def test_charges_load_job(spark, tmp_path):
    names = [*schema.CHARGES_REQUIRED, "France"]
    rows = [(2022, n, schema.CHARGES_FLOW, -1.5 - i) for i, n in enumerate(names)]
    spark.createDataFrame(rows, "year INT, counterpart_country STRING, flow_type STRING, value_cad_millions DOUBLE").write.parquet(str(tmp_path / "mart"))
    regions = spark.createDataFrame([(i, schema.ALL_COUNTRIES if n == "World" else n) for i, n in enumerate(names)], "macroecon_region_id INT, region STRING")
    verified = jobs.run_charges_load(spark, str(tmp_path / "mart"), regions, str(tmp_path / "out"), len(names)).first()
    assert (verified.n_loaded, verified.n_target, verified.passed) == (8, 8, True)
    with pytest.raises(ValueError, match="listed in") as e:
        jobs.run_charges_load(spark, str(tmp_path / "mart"), regions.where("region not in ('France', 'China')"), str(tmp_path / "none"))
    listed = spark.read.parquet(str(e.value).rsplit(" ", 1)[-1])
    assert sorted(r.region for r in listed.collect()) == ["China", "France"] and sinks.current(spark, str(tmp_path / "none")) is None
    with pytest.raises(ValueError, match="row_count|rows"):
        jobs.run_charges_load(spark, str(tmp_path / "mart"), regions, str(tmp_path / "none"), 7)
