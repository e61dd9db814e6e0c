"""Files written by Spark from the driver tables, and read back through the sources.

Each query writes to a new folder under the session's shared folder.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from flowmart import schema, sinks, sources
from flowmart.operators import catalog
from flowmart.plans import jobs
from flowmart.session import shared_dir, ship_package, stored
from flowmart.showcase.registry import fixture, query
from flowmart.showcase.views import FLOWS, LONG, WIDE, YEARS, flows, table, wide_flows
from flowmart.streams import open_stream

_FILES = {
    "PA1a": "patent_1a- Direct applications_Count_1995_2001.csv",
    "PA1b": "patent_1b- PCT national phase entries_Count_1995_2001.csv",
    "TM1a": "trademark_1a- Direct applications_Count_1995_2001.csv",
    "TM1b": "trademark_1b- Applications via the Madrid system_Count_1995_2001.csv",
    "ID1a": "industrial_1a- Direct applications_Count_1995_2001.csv",
    "ID1b": "industrial_1b_office- Applications via the Hague system_Totals_1995_2001.csv",
}
PREAMBLE = ["", "", "Report type: counts", "Years: all", "Source: order lines"]


def _quoted(c: str):
    return F.concat(F.lit('"'), F.col(c), F.lit('"'))


@fixture
def landed_files(spark: SparkSession, sf: str) -> str:
    """Wide CSV with six preamble lines, which differ from file to file, and placeholder headers, one folder per indicator.

    An indicator's lines are dealt out to several files, each with a preamble of its own, so no task writes a whole indicator.
    """
    root = shared_dir(spark, "landed")
    wide = stored(wide_flows(spark, sf))
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = [_quoted("destination_office"), F.lit("NA"), _quoted("origin"), *[F.col(str(y)).cast("string") for y in YEARS]]
    line = F.concat(*[p for i, c in enumerate(cells) for p in ([F.lit(",")] if i else []) + [F.coalesce(c, F.lit(""))]], F.lit(","))
    name = F.create_map(*[F.lit(x) for pair in _FILES.items() for x in pair])[F.col("indicator")]
    share = F.pmod(F.xxhash64("origin", "destination_office"), F.lit(shares)).cast("int").alias("share")
    rows = wide.select(name.alias("file"), share, F.lit(len(PREAMBLE) + 2).alias("at"), line.alias("value"))
    mark = schema.MISSING_HEADER
    header = ",".join([mark, f"{mark} ({mark})", mark, *[str(y) for y in YEARS]]) + ","
    own = F.concat(F.lit("Statistics of "), "file", F.lit(", part "), "share")
    heads = F.posexplode(F.array(own, *[F.lit(x) for x in [*PREAMBLE, header]]))
    tops = rows.select("file", "share").distinct().select("file", "share", heads).select("file", "share", F.col("pos").alias("at"), F.col("col").alias("value"))
    (
        rows.unionByName(tops).repartition("file", "share").sortWithinPartitions("file", "share", "at", "value").drop("at")
        .write.partitionBy("file", "share").text(root)
    )
    return root


def _paths(spark: SparkSession, root: str) -> DataFrame:
    """Landed names, one per indicator folder."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    folder = F.regexp_extract(F.url_decode("path"), "file=([^/]+)/", 1)
    return listed.select(folder.alias("path")).distinct()


def _folder(root: str, code: str) -> str:
    """The folder of one indicator."""
    return f"{root}/file={_FILES[code]}"


_HEADER = ["Office", "Office (Code)", "Origin", *[str(y) for y in YEARS]]


@query("header_repair", f"WITH {FLOWS}, {WIDE} " + " UNION ALL ".join(
    f"""SELECT '{code}' AS indicator, {i} AS ordinal, '{c}' AS "column", COUNT({f'"{c}"' if c.isdigit() else '*'}) AS n_filled FROM wide WHERE indicator='{code}'"""
    for code in _FILES for i, c in enumerate(_HEADER)))
def header_repair(spark, sf):
    root = landed_files(spark, sf)
    counts = [catalog.filled_counts(sources.read_wide_csv(spark, _folder(root, code))).select(F.lit(code).alias("indicator"), "*") for code in _FILES]
    return functools.reduce(DataFrame.unionByName, counts)


@query("src_wide_csv", f"""WITH {FLOWS}, {WIDE} SELECT destination_office AS "Office", 'NA' AS "Office (Code)", origin AS "Origin",
  {', '.join(f'CAST("{y}" AS VARCHAR) AS "{y}"' for y in YEARS)} FROM wide""")
def src_wide_csv(spark, sf):
    return sources.read_wide_csv(spark, landed_files(spark, sf))


@query("staged_from_landing", f"""WITH {FLOWS}, {LONG} SELECT year, destination_office, 'NA' AS destination_office_st3_code, origin, indicator, "count" FROM long""")
def staged_from_landing(spark, sf):
    root, out = landed_files(spark, sf), shared_dir(spark, "staged")
    for code in _FILES:
        staged = jobs.stage_indicator(sources.read_wide_csv(spark, _folder(root, code)))
        staged.write.parquet(f"{out}/indicator={code}")
    return sources.read_staged(spark, out, list(_FILES))


_NAMES = ", ".join(f"('{c}', '{f}', '{c}{'_office' if '_office' in f else ''}', {chr(39) + 'office' + chr(39) if '_office' in f else 'NULL'})" for c, f in _FILES.items())


@query("indicator_from_path", f"""WITH {FLOWS}, {WIDE} SELECT path, f.indicator, location, COUNT(*) AS n_rows
FROM (VALUES {_NAMES}) f(code, path, indicator, location) JOIN wide ON wide.indicator = f.code GROUP BY ALL""")
def indicator_from_path(spark, sf):
    lines = spark.read.text(landed_files(spark, sf)).where(F.col("value").startswith('"NATION'))
    files = lines.groupBy(F.col("file").alias("path")).agg(F.count("*").alias("n_rows"))
    return sources.with_indicator(files, "path", sources.prefix_dim(spark)).select("path", "indicator", "location", "n_rows")


_EXPECTED = ", ".join(f"('{p}', '{i}')" for p, i in schema.INDICATOR_PREFIXES.items())


@query("landing_manifest", f"""WITH {FLOWS}, n AS (SELECT indicator, 1 AS n FROM flows WHERE indicator <> 'ID1b' GROUP BY ALL)
SELECT prefix, t.indicator, CAST(COALESCE(n, 0) AS BIGINT) AS n_files, CASE WHEN n = 1 THEN 'ok' ELSE 'missing' END AS status
FROM (VALUES {_EXPECTED}) t(prefix, indicator) LEFT JOIN n ON n.indicator = t.indicator""")
def landing_manifest(spark, sf):
    return sources.landing_manifest(_paths(spark, landed_files(spark, sf)), sources.prefix_dim(spark))


@query("staged_scan", f"""WITH {FLOWS} SELECT year, origin, destination_office, "count", indicator FROM flows WHERE indicator IN ('PA1a','TM1b')""")
def staged_scan(spark, sf):
    path = shared_dir(spark, "staged")
    sinks.write_parquet(flows(spark, sf), path, ["indicator"])
    return sources.read_staged(spark, path, ["PA1a", "TM1b"])


@fixture
def csv_orders(spark: SparkSession, sf: str) -> str:
    path = shared_dir(spark, "csv")
    sinks.export_csv(table(spark, sf, "orders"), path, gzip=False)
    return path


@query("csv_subset", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def csv_subset(spark, sf):
    """The declared columns are a part of the file's and in another order."""
    return sources.read_csv(spark, csv_orders(spark, sf), "o_orderpriority STRING, o_totalprice DOUBLE, o_orderkey LONG")


@query("tsv_scan", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand FROM part")
def tsv_scan(spark, sf):
    path = shared_dir(spark, "tsv")
    table(spark, sf, "part").select("p_partkey", "p_name", "p_brand").write.option("header", "true").option("sep", "\t").csv(path)
    if not sources.is_tab_separated(spark, path):
        raise ValueError("the written file is not tab separated")
    return sources.read_delimited(spark, path, "\t")


@query("semicolon_scan", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name || ';' || n_name AS n_name FROM nation")
def semicolon_scan(spark, sf):
    path = shared_dir(spark, "semicolon")
    names = table(spark, sf, "nation").select("n_nationkey", F.concat_ws(";", "n_name", "n_name").alias("n_name"))
    names.write.option("header", "true").option("sep", ";").csv(path)
    return sources.read_delimited(spark, path, ";")


@query("csv_gz_roundtrip", """SELECT CAST(c_custkey AS INT) AS c_custkey, 'said "' || c_name || '", then' AS c_name, NULLIF(c_mktsegment, 'BUILDING') AS c_mktsegment, c_acctbal FROM customer""")
def csv_gz_roundtrip(spark, sf):
    path = shared_dir(spark, "export") + ".csv.gz"
    df = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit('said "'), "c_name", F.lit('", then')).alias("c_name"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).otherwise("").alias("c_mktsegment"), "c_acctbal",
    )
    sinks.export_csv(df, path, quote_all=True)
    return sources.read_any(spark, path)


@fixture
def zipped_documents(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """The documents as zip archives of one CSV each, made by the tasks, and their paths."""
    from collections.abc import Iterator

    import pandas as pd

    root = shared_dir(spark, "zipped")
    ship_package(spark)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import csv
        import io
        import uuid
        import zipfile

        from flowmart.streams import open_stream

        path = f"{root}/{uuid.uuid4().hex}.zip"
        with open_stream(path, write=True) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("readme.txt", "documents")
            with z.open("part.csv", "w", force_zip64=True) as raw, io.TextIOWrapper(raw, "utf-8", newline="") as text:
                writer = csv.writer(text)
                writer.writerow(["doc_id", "source", "text"])
                for batch in batches:
                    writer.writerows(batch.itertuples(index=False))
        yield pd.DataFrame({"path": [path]})

    docs = table(spark, sf, "documents").select("doc_id", "source", "text").repartition(spark.sparkContext.defaultParallelism)
    listing = shared_dir(spark, "zipped_paths")
    docs.mapInPandas(pack, "path STRING").write.parquet(listing)
    return root, spark.read.parquet(listing)


@query("zip_csv_ingest", "SELECT CAST(doc_id AS INT) AS doc_id, source, text FROM documents")
def zip_csv_ingest(spark, sf):
    _, paths = zipped_documents(spark, sf)
    declared = schema.contract(doc_id="int", source="string", text="string")
    spread = paths.repartition(spark.sparkContext.defaultParallelism)
    return sources.zip_csv_to_parquet(spark, spread, shared_dir(spark, "unzipped"), declared)


@query("zip_extract", "SELECT doc_id, source, text FROM documents")
def zip_extract(spark, sf):
    _, paths = zipped_documents(spark, sf)
    out = shared_dir(spark, "extracted")
    sources.extract_zips(spark, paths, out, prefix="raw_").write.parquet(shared_dir(spark, "extracted_listing"))
    return sources.read_csv(spark, f"{out}/*/raw_*.csv", "doc_id LONG, source STRING, text STRING", quoted_newlines=True)


@query("xml_flatten", """SELECT CAST(o_orderkey AS VARCHAR) AS order_key, o_orderpriority AS group_priority, kind, amount, amount_unit
FROM (SELECT o_orderkey, o_orderpriority, 'price' AS kind, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount, 'XDC' AS amount_unit FROM orders
UNION ALL SELECT o_orderkey, o_orderpriority, 'customer', CAST(o_custkey AS VARCHAR), 'id' FROM orders)""")
def xml_flatten(spark, sf):
    path = xml_orders(spark, sf)
    if sources.record_tag(spark, path) != "amount":
        raise ValueError("the deepest repeating tag is the amount of a record")
    declared = T.StructType.fromDDL(
        "_key STRING, group STRUCT<_priority: STRING, record: ARRAY<STRUCT<_kind: STRING, amount: STRUCT<_VALUE: STRING, _unit: STRING>>>>"
    )
    return sources.read_xml_records(spark, path, "order", ["group", "record"], declared)


@query("xml_split_records", """SELECT 'orders' AS orders_source, CAST(o_orderkey AS VARCHAR) AS order_key, o_orderpriority AS group_priority, kind, amount, amount_unit
FROM (SELECT o_orderkey, o_orderpriority, 'price' AS kind, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount, 'XDC' AS amount_unit FROM orders
UNION ALL SELECT o_orderkey, o_orderpriority, 'customer', CAST(o_custkey AS VARCHAR), 'id' FROM orders)""")
def xml_split_records(spark, sf):
    """The same files split at their innermost records, with an attribute of the root on each row."""
    declared = T.StructType.fromDDL("_kind STRING, amount STRUCT<_VALUE: STRING, _unit: STRING>")
    return sources.read_split_records(spark, xml_orders(spark, sf), "record", schema=declared, span=1 << 20)


def _write_xml(spark: SparkSession, sf: str, path: str, root: str = "ROWS") -> None:
    """Orders as nested XML with attributes on two levels above the records, and those that ``root`` gives."""
    def record(kind: str, value, unit: str):
        amount = F.struct(value.cast("string").alias("_VALUE"), F.lit(unit).alias("_unit"))
        return F.struct(F.lit(kind).alias("_kind"), amount.alias("amount"))

    records = F.array(record("price", F.col("o_totalprice").cast("decimal(18,2)"), "XDC"), record("customer", F.col("o_custkey"), "id"))
    nested = F.struct(F.col("o_orderpriority").alias("_priority"), records.alias("record"))
    orders = table(spark, sf, "orders").repartition(spark.sparkContext.defaultParallelism)
    orders.select(F.col("o_orderkey").alias("_key"), nested.alias("group")).write.format("xml").option("rootTag", root).option("rowTag", "order").save(path)


@fixture
def xml_orders(spark: SparkSession, sf: str) -> str:
    path = shared_dir(spark, "xml")
    _write_xml(spark, sf, path, "orders source='orders'")
    return path


_ARROW = "CASE column_type WHEN 'BIGINT' THEN 'int64' WHEN 'INTEGER' THEN {int} WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp[us]' END"


_NESTED = ", ".join(f"('{c}')" for c in ("record_kind", "group_priority", "order_key", "unit"))


@query("data_dictionary", f"""SELECT 'staging' AS layer, '.snappy.parquet' AS table_filetype, column_name, {_ARROW.format(int="'int32'")} AS column_dtype, FALSE AS failed FROM (DESCRIBE orders)
UNION ALL SELECT 'marts', '.csv.gz', column_name, 'string', FALSE FROM (DESCRIBE customer)
UNION ALL SELECT 'tabs', '.txt', column_name, 'string', FALSE FROM (DESCRIBE nation)
UNION ALL SELECT 'nested', '.xml', c, 'string', FALSE FROM (VALUES {_NESTED}) t(c)
UNION ALL SELECT 'broken', '.parquet', NULL, NULL, TRUE""")
def data_dictionary(spark, sf):
    root = shared_dir(spark, "lake") + "/data"
    table(spark, sf, "orders").write.parquet(f"{root}/staging/orders")
    sinks.export_csv(table(spark, sf, "customer"), f"{root}/marts/customer")
    sinks.export_csv(table(spark, sf, "supplier"), f"{root}/raw/demo/supplier", gzip=False)
    _write_xml(spark, sf, f"{root}/nested/orders")
    nation = table(spark, sf, "nation")
    line = F.array_join(F.array(*[F.col(c).cast("string") for c in nation.columns]), "\t")
    head = spark.range(1).select(F.lit(0).alias("at"), F.lit("\t".join(nation.columns)).alias("value"))
    lines = head.unionByName(nation.select(F.lit(1).alias("at"), line.alias("value")))
    lines.repartition(1).sortWithinPartitions("at").select("value").write.text(f"{root}/tabs/nation")
    with open_stream(f"{root}/broken/x.parquet", write=True) as out:
        out.write(b"this is no Parquet file")
    found = catalog.data_dictionary(spark, root, ignored=["demo"])
    return found.select("layer", "table_filetype", "column_name", "column_dtype", F.col("error").isNotNull().alias("failed")).distinct()
