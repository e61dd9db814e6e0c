"""The mart jobs over tables shaped like their landed inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowmart import schema, sinks, sources
from flowmart.operators import conform, enrich, quality
from flowmart.plans import jobs
from flowmart.session import shared_dir, stored
from flowmart.showcase.columns import INDUSTRY, industry_text
from flowmart.showcase.registry import fixture, query
from flowmart.showcase.views import CLASS_FLOWS, FLOWS, YEARS, buyers, class_flows, exact_sum, flows, table

CODES = ["PA1a", "PA1b", "TM1a", "TM1b", "ID1a", "ID1b"]


def _renamed(name: str) -> str:
    return f"CASE {name} WHEN 'NATION_0' THEN 'World' WHEN 'NATION_1' THEN 'China' ELSE {name} END"


def _coded(name: str) -> str:
    return f"CASE {name} WHEN 'World' THEN 'WD' WHEN 'China' THEN 'CN' WHEN 'NATION_2' THEN NULL ELSE 'X' || substr({name}, 8) END"


def _member(name: str):
    return F.when(F.col(name) == "NATION_0", "Total").when(F.col(name) == "NATION_1", "China").otherwise(F.col(name))


def _offices(spark, sf):
    """Office codes with one gap (NATION_2) and no code for World."""
    nation = table(spark, sf, "nation").where(~F.col("n_nationkey").isin(0, 2))
    china = F.col("n_nationkey") == 1
    return nation.select(
        F.when(china, "China").otherwise(F.col("n_name")).alias("entity_name"),
        F.when(china, "CN").otherwise(F.concat(F.lit("X"), F.substring("n_name", 8, 10))).alias("st3_code"),
    )


def _landed(spark, sf):
    """Wide bilateral files, one per indicator, with headers as they land."""
    wide = stored(
        flows(spark, sf).groupBy("indicator", _member("destination_office").alias("Office"), _member("origin").alias("Origin"))
        .pivot("year", YEARS).agg(F.sum("count"))
    )
    texts = [F.col(str(y)).cast("string").alias(str(y)) for y in YEARS]
    office = F.when(F.col("Office") == "China", "CN").when(F.col("Office").startswith("NATION"), F.concat(F.lit("X"), F.substring("Office", 8, 10)))
    code = F.when(F.col("Office") != "NATION_2", office).alias("Office (Code)")
    padded = F.concat(F.lit(" "), "Office", F.lit(" ")).alias("Office")
    return {c: wide.where(F.col("indicator") == c).select(padded, code, "Origin", *texts) for c in CODES}


@query("flows_mart", f"""WITH {FLOWS}, r AS (SELECT year, {_renamed('origin')} AS origin, {_renamed('destination_office')} AS destination_office, indicator, "count" FROM flows),
k AS (SELECT DISTINCT origin, destination_office, indicator FROM r),
b AS (SELECT CAST(y AS INT) AS year, k.*, r."count" FROM k CROSS JOIN range({YEARS[0]}, {YEARS[-1] + 1}) s(y)
  LEFT JOIN r ON r.year=y AND r.origin=k.origin AND r.destination_office=k.destination_office AND r.indicator=k.indicator),
x AS (SELECT CAST(year(o_orderdate) AS INT) AS year, n_name AS region, COUNT(*) AS direct_apps, COUNT(*) FILTER (WHERE o_orderstatus='F') AS madrid_apps
  FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey WHERE n_nationkey > 2 GROUP BY ALL),
t AS (SELECT b.*, CASE b.indicator WHEN 'TM1a' THEN x.direct_apps WHEN 'TM1b' THEN x.madrid_apps END AS extra FROM b
  LEFT JOIN x ON x.year=b.year AND x.region=b.origin AND b.destination_office='China'),
c AS (SELECT year, origin, destination_office, indicator,
  CASE WHEN indicator NOT LIKE 'TM%' THEN "count" WHEN "count" IS NOT NULL OR extra > 0 THEN COALESCE("count",0)+COALESCE(extra,0) END AS "count" FROM t)
SELECT year, origin, {_coded('origin')} AS origin_st3_code, destination_office, {_coded('destination_office')} AS destination_office_st3_code,
  indicator, CAST("count" AS DOUBLE) AS "count" FROM c""")
def flows_mart(spark, sf):
    staged = {code: jobs.stage_indicator(wide) for code, wide in _landed(spark, sf).items()}
    supplement = (
        buyers(table(spark, sf, "orders"), spark, sf).where(F.col("n_nationkey") > 2)
        .groupBy(F.year("o_orderdate").alias("year"), F.col("n_name").alias("region"))
        .agg(F.count("*").alias("direct_apps"), F.count_if(F.col("o_orderstatus") == "F").alias("madrid_apps"))
    )
    return jobs.flows_mart(staged, _offices(spark, sf), supplement)


@query("class_mart", f"""WITH {CLASS_FLOWS.replace('p_type AS class_code', 'p_brand AS class_code')},
r AS (SELECT year, {_renamed('origin')} AS origin, {_renamed('destination_office')} AS destination_office,
  CASE indicator WHEN 'PA1a' THEN 'PA5' WHEN 'PA1b' THEN 'PA4a' WHEN 'TM1a' THEN 'TM4a' WHEN 'TM1b' THEN 'TM4b' WHEN 'ID1a' THEN 'ID4a' ELSE 'ID4b' END AS ip_indicator, class_code, "count"
  FROM class_flows)
SELECT year, origin, destination_office, {_coded('destination_office')} AS destination_office_st3_code, ip_indicator,
  CASE substr(ip_indicator, 1, 2) WHEN 'PA' THEN 'Tech field' WHEN 'TM' THEN 'Nice' ELSE 'Locarno' END AS class_type,
  CASE WHEN ip_indicator IN ('TM4a','TM4b') AND class_code <> 'Brand#7' THEN CAST(regexp_extract(class_code, '([0-9]+)', 1) AS INT) || ' - ' || class_code
    ELSE class_code END AS class_code, "count" FROM r""")
def class_mart(spark, sf):
    fact = stored(class_flows(spark, sf, "p_brand"))
    columns = {
        "PA5": ("PA1a", "tech_field"), "PA4a": ("PA1b", "tech_field"), "TM4a": ("TM1a", "nice_class"), "TM4b": ("TM1b", "class_code"),
        "ID4a": ("ID1a", "locarno_class"), "ID4b": ("ID1b", "locarno_class"),
    }
    staged = {
        code: fact.where(F.col("indicator") == source).select(
            "year", _member("origin").alias("origin"), F.lower(_member("destination_office")).alias("low"),
            _member("destination_office").alias("destination_office"), F.col("class_code").alias(column), "count",
        ).withColumn("destination_office", F.when(F.col("low") == "total", " TOTAL ").otherwise(F.col("destination_office"))).drop("low")
        for code, (source, column) in columns.items()
    }
    names = table(spark, sf, "part").where(F.col("p_brand") != "Brand#7").select(F.col("p_brand").alias("Class"), F.col("p_brand").alias("Industry"))
    return jobs.class_mart(staged, _offices(spark, sf), enrich.class_label_dim(names.distinct(), "Nice"))


_FDI = list(schema.INVESTMENT_FLOWS.items())


def _macro(flag: str, label: str) -> str:
    return f"""SELECT CAST(year(l_shipdate) AS INT) AS year, CAST(l_suppkey AS VARCHAR) AS region, '{label}' AS flow_type,
    CASE WHEN l_linestatus='O' THEN l_quantity * pow(10.0::DOUBLE, 3) END AS dollar_value FROM lineitem WHERE l_returnflag='{flag}'"""


@query("macro_flows_mart", f"""SELECT DISTINCT * FROM ({_macro('A', schema.IMPORTS_FLOW)} UNION ALL {_macro('N', schema.EXPORTS_FLOW)}
UNION ALL {_macro('R', _FDI[0][1])} AND l_linenumber <= 3 UNION ALL {_macro('R', _FDI[2][1])} AND l_linenumber > 3)""")
def macro_flows_mart(spark, sf):
    line = table(spark, sf, "lineitem").select(
        F.year("l_shipdate").cast("string").alias("REF_DATE"), F.lit("Canada").alias("GEO"), "l_returnflag", "l_linenumber",
        F.col("l_suppkey").cast("string").alias("where"), F.lit("3").alias("SCALAR_ID"),
        F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("string")).otherwise("..").alias("VALUE"),
    )
    dash = jobs.MACRO_TABLES["fdi_ultimate"].categories[0]
    early = F.col("l_linenumber") <= 3
    tables = {
        "imports": line.where(F.col("l_returnflag") == "A").withColumnRenamed("where", "Country").withColumn("Estimates", F.lit("Value of imports")),
        "exports": line.where(F.col("l_returnflag") == "N").withColumnRenamed("where", "Country of destination").withColumn("Estimates", F.lit("Value of exports")),
        "fdi_immediate": line.where((F.col("l_returnflag") == "R") & early).withColumnRenamed("where", "Countries or regions")
        .withColumn("Canadian and foreign direct investment", F.lit(_FDI[0][0])),
        "fdi_ultimate": line.where((F.col("l_returnflag") == "R") & ~early).withColumnRenamed("where", "Countries or regions")
        .withColumn("Type of direct investment", F.lit(dash)),
    }
    return jobs.macro_flows_mart(tables)


def _trade(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", industry_text().alias(schema.INDUSTRY_COLUMN))
    line = table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    trade = F.when(F.col("l_returnflag") == "A", "Imports").when(F.col("l_returnflag") == "N", "Exports").otherwise("Re-exports")
    return line.select(
        F.date_format("l_shipdate", "yyyy-MM").alias("REF_DATE"), trade.alias("Trade"),
        F.concat(F.lit("P"), F.col("l_suppkey").cast("string")).alias("Trading Partners"), schema.INDUSTRY_COLUMN, F.col("l_quantity").alias("VALUE"),
    )


@query("naics_mart", f"""WITH t AS (SELECT CAST(year(l_shipdate) AS INT) AS year, CASE l_returnflag WHEN 'A' THEN 'Imports' ELSE 'Exports' END AS trade_type,
  CONCAT('P', l_suppkey) AS trading_partner, {INDUSTRY} AS naics, l_quantity FROM lineitem JOIN part ON l_partkey=p_partkey WHERE l_returnflag IN ('A','N'))
SELECT year, trade_type, trading_partner, TRY_CAST(NULLIF(regexp_extract(naics, '\\[([0-9]{{4}})\\]$', 1), '') AS INT) AS naics_code,
  CASE WHEN naics='Total of all industries' THEN 'Total' ELSE TRIM(regexp_replace(naics, '\\s*\\[[^\\]]+\\]$', '')) END AS naics_name,
  CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS cad_value
FROM t WHERE naics='Total of all industries' OR regexp_matches(naics, '\\[([0-9]{{4}})\\]$') GROUP BY ALL""")
def naics_mart(spark, sf):
    mart = jobs.industry_trade_mart(jobs.stage_industry_trade(_trade(spark, sf)))
    return sinks.materialize(mart, shared_dir(spark, "naics_mart"), view="fct_trade_by_naics_yearly", sort=jobs.INDUSTRY_ORDER)


@fixture
def sdmx_documents(spark, sf):
    """One SDMX-JSON document per customer: order values by priority, year and status."""
    orders = table(spark, sf, "orders").groupBy(
        "o_custkey", F.col("o_orderpriority").alias("p"), F.year("o_orderdate").alias("y"), F.col("o_orderstatus").alias("s")
    ).agg(exact_sum("o_totalprice").alias("v"))
    priorities, statuses = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], ["F", "O", "P"]
    at = lambda names, c: F.array_position(F.array(*[F.lit(n) for n in names]), F.col(c)) - 1
    # The key has a slot per status so that it is unique; the status is also the attribute's index.
    key = F.concat_ws(":", F.lit("0"), at(priorities, "p"), at(statuses, "s"), F.col("y") - YEARS[0])
    cells = orders.groupBy("o_custkey").agg(
        F.map_from_entries(F.collect_list(F.struct(key, F.array(F.col("v"), at(statuses, "s").cast("double"))))).alias("observations")
    )

    def codes(ids, names=None):
        return F.array(*[F.struct(F.lit(i).alias("id"), F.lit(n).alias("name")) for i, n in zip(ids, names or [None] * len(ids))])

    dims = F.array(
        F.struct(F.lit("TIME_PERIOD").alias("id"), F.lit(3).alias("keyPosition"), codes([str(y) for y in YEARS]).alias("values")),
        F.struct(F.lit("REF_AREA").alias("id"), F.lit(0).alias("keyPosition"),
                 F.array(F.struct(F.col("o_custkey").cast("string").alias("id"), F.lit(None).cast("string").alias("name"))).alias("values")),
        F.struct(F.lit("COUNTERPART_AREA").alias("id"), F.lit(1).alias("keyPosition"),
                 codes(["U", "H", "M", "N", "L"], ["Urgent", "High", "Medium", None, "Low"]).alias("values")),
        F.struct(F.lit("MEASURE").alias("id"), F.lit(2).alias("keyPosition"), codes(["SH", "S", "CA"]).alias("values")),
    )
    attributes = F.array(F.struct(F.lit("OBS_STATUS").alias("id"), codes(["A", "E", "M"]).alias("values")))
    structure = F.struct(F.struct(dims.alias("observation")).alias("dimensions"), F.struct(attributes.alias("observation")).alias("attributes"))
    data = F.struct(F.array(structure).alias("structures"), F.array(F.struct("observations")).alias("dataSets"))
    return stored(cells.select(F.to_json(F.struct(data.alias("data"))).alias("value")))


_SDMX_DIMS = ["REF_AREA", "COUNTERPART_AREA", "MEASURE", "TIME_PERIOD"]
_SDMX = """SELECT CAST(o_custkey AS VARCHAR) AS REF_AREA, CASE o_orderpriority WHEN '1-URGENT' THEN 'U' WHEN '2-HIGH' THEN 'H' WHEN '3-MEDIUM' THEN 'M'
    WHEN '4-NOT SPECIFIED' THEN 'N' ELSE 'L' END AS COUNTERPART_AREA, CASE o_orderstatus WHEN 'F' THEN 'SH' WHEN 'O' THEN 'S' ELSE 'CA' END AS MEASURE,
  CAST(year(o_orderdate) AS VARCHAR) AS TIME_PERIOD, CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High' WHEN '3-MEDIUM' THEN 'Medium'
    WHEN '4-NOT SPECIFIED' THEN 'N' ELSE 'Low' END AS counterpart_country, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value_cad_millions,
  CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'E' ELSE 'M' END AS obs_status, TRUE AS status_reported FROM orders GROUP BY ALL"""


@query("sdmx_decode", _SDMX)
def sdmx_decode(spark, sf):
    return jobs.stage_charges(sdmx_documents(spark, sf), _SDMX_DIMS)


@fixture
def sdmx_files(spark, sf):
    """One SDMX-JSON file per order year, its observations (order values by customer, priority and status) ahead of its structure."""
    place = lambda names, c: F.coalesce(*[F.when(F.col(c) == n, i) for i, n in enumerate(names)], F.lit(len(names)))
    orders = table(spark, sf, "orders").groupBy(
        "o_custkey", F.year("o_orderdate").alias("y"), place(["F", "O"], "o_orderstatus").alias("s"),
        place(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"], "o_orderpriority").alias("p"),
    ).agg(exact_sum("o_totalprice").alias("v"))
    customers = stored(conform.with_surrogate_key(table(spark, sf, "orders").select(F.col("o_custkey").alias("id")).distinct(), "nth", ["id"]))
    keyed = orders.join(customers, F.col("o_custkey").eqNullSafe(F.col("id")))
    cell = F.format_string('"%d:%d:%d:0":[%s,%d]', F.col("nth") - 1, "p", "s", F.col("v").cast("string"), "s")
    cells = stored(keyed.select("y", cell.alias("cell")))
    # A row per document. Each has a number, by which its lines are dealt out: a repartition by the year is left out where Spark takes the
    # union's parts to lie by year already, though it later reads each of them in another way.
    years = cells.groupBy("y").agg(F.min("cell").alias("first")).collect()
    docs = F.broadcast(spark.createDataFrame([(i, r["y"], r["first"]) for i, r in enumerate(years)], "doc int, year int, first string"))
    comma = F.when(F.col("cell") == F.col("first"), "").otherwise(",")
    lines = cells.join(docs, F.col("y").eqNullSafe(F.col("year"))).select(
        "doc", "year", F.when(comma == "", 1).otherwise(2).alias("place"), F.lit(0).cast("long").alias("at"), F.concat(comma, "cell").alias("value")
    )
    code = lambda c: F.when(c["id"].isNull(), "{}").otherwise(F.format_string('{"id":"%d"}', c["id"]))
    block = F.floor((F.col("nth") - 1) / 10_000).alias("at")
    codes = customers.groupBy(block).agg(F.array_sort(F.collect_list(F.struct("nth", "id"))).alias("of")).select(
        "at", F.concat(F.when(F.col("at") == 0, "").otherwise(","), F.array_join(F.transform("of", code), ",")).alias("value")
    )
    named = ",".join(f'{{"id":"{i}"' + (f',"name":"{n}"}}' if n else "}") for i, n in zip("UHMNL", ["Urgent", "High", "Medium", None, "Low"]))
    year = F.when(F.col("year").isNull(), "{}").otherwise(F.format_string('{"id":"%d"}', "year"))
    texts = {
        0: F.lit('{"meta":{"note":"a \\"}]\\" in a text"},"data":{"dataSets":[{"action":"Information","observations":{'),
        3: F.lit('}}],"structures":[{"dimensions":{"observation":[{"id":"REF_AREA","keyPosition":0,"values":['),
        5: F.concat(
            F.lit(f']}},{{"id":"COUNTERPART_AREA","keyPosition":1,"values":[{named}]}},{{"id":"MEASURE","keyPosition":2,"values":[{{"id":"SH"}},{{"id":"S"}},{{"id":"CA"}}]}},'
                  '{"id":"TIME_PERIOD","keyPosition":3,"values":['), year,
            F.lit(']}]},"attributes":{"observation":[{"id":"OBS_STATUS","values":[{"id":"A"},{"id":"E"},{"id":"M"}]}]}}]}}'),
        ),
    }
    frame = docs.select("doc", "year", F.explode(F.array(*[F.struct(F.lit(i).alias("place"), F.lit(0).cast("long").alias("at"), t.alias("value")) for i, t in texts.items()])).alias("t"))
    lists = codes.crossJoin(docs).select("doc", "year", F.lit(4).alias("place"), "at", "value")
    parts = lines.unionByName(lists).unionByName(frame.select("doc", "year", "t.*"))
    path = shared_dir(spark, "sdmx")
    parts.repartitionById(max(len(years), 1), "doc").sortWithinPartitions("year", "place", "at").select("year", "value").write.partitionBy("year").text(path)
    return path


@query("sdmx_stream", _SDMX)
def sdmx_stream(spark, sf):
    return sources.stream_sdmx_json(spark, sdmx_files(spark, sf), _SDMX_DIMS, "COUNTERPART_AREA", value_out="value_cad_millions")


@query("ip_charges_mart", f"""WITH d AS ({_SDMX}) SELECT CAST(TIME_PERIOD AS INT) AS year, counterpart_country,
  'Charges for use of IP - Balance' AS flow_type, value_cad_millions FROM d WHERE MEASURE='SH' AND obs_status='A'""")
def ip_charges_mart(spark, sf):
    return jobs.ip_charges_mart(jobs.clean_charges(jobs.stage_charges(sdmx_documents(spark, sf), _SDMX_DIMS)))


@fixture
def charges_files(spark, sf):
    name = F.when(F.col("n_nationkey") == 0, "World").otherwise(F.col("n_name"))
    mart = (
        buyers(table(spark, sf, "orders"), spark, sf)
        .groupBy(F.year("o_orderdate").alias("year"), name.alias("counterpart_country")).agg(exact_sum("o_totalprice").alias("value_cad_millions"))
    )
    path = shared_dir(spark, "charges")
    mart.withColumn("flow_type", F.lit(schema.CHARGES_FLOW)).select(*schema.CHARGES.names).write.parquet(path)
    return path


@query("charges_load", """SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(n_nationkey AS INT) AS macroecon_region_id,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value_cad_millions
FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey GROUP BY ALL""")
def charges_load(spark, sf):
    nation = table(spark, sf, "nation")
    dim = nation.select(
        F.col("n_nationkey").alias("macroecon_region_id"),
        F.when(F.col("n_nationkey") == 0, "All countries").otherwise(F.col("n_name")).alias("region"),
    )
    mart_dir, out = charges_files(spark, sf), shared_dir(spark, "charges_load")
    rules = [
        quality.columns_are(schema.CHARGES.names), quality.no_nulls(schema.CHARGES.names), quality.only_value("flow_type", schema.CHARGES_FLOW),
        quality.with_members("counterpart_country", ["World"]), quality.UniqueKey(("year", "counterpart_country")),
    ]
    jobs.run_charges_load(spark, mart_dir, dim, out, rules=rules)
    return sinks.read_mart(spark, out).withColumn("value_cad_millions", F.col("value_cad_millions").cast("double"))
