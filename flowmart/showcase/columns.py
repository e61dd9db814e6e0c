"""Column conforming over the driver tables, with text made from their columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from flowmart import functions as fx, sources
from flowmart.operators import conform, enrich
from flowmart.operators.conform import StageTable
from flowmart.schema import contract
from flowmart.showcase.registry import query
from flowmart.showcase.views import FLOWS, flows, table

CUSTOMER = contract(id="int", name="string", segment="string", balance="double", note="string")


@query("conform_schema", """SELECT CAST(c_custkey AS INT) AS id, c_name AS name,
  CASE WHEN c_mktsegment='BUILDING' THEN NULL ELSE c_mktsegment END AS segment, c_acctbal AS balance, CAST(NULL AS VARCHAR) AS note
FROM customer""")
def conform_schema(spark, sf):
    landed = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias(" Id "), F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("Customer Name"),
        F.when(F.col("c_mktsegment") == "BUILDING", " ").otherwise(F.col("c_mktsegment")).alias("Segment"),
        F.col("c_acctbal").cast("string").alias("balance"),
    )
    return conform.to_contract(landed, CUSTOMER, {"Id": "id", "Customer Name": "name", "Segment": "segment"})


@query("normalize_headers", "SELECT c_custkey AS \"customer id\", c_name AS \"name\" FROM customer")
def normalize_headers(spark, sf):
    df = table(spark, sf, "customer").select(F.col("c_custkey").alias(" Customer ID "), F.col("c_name").alias("NAME"))
    return conform.normalize_headers(df)


@query("project_existing", "SELECT p_partkey, p_type FROM part")
def project_existing(spark, sf):
    return sources.project_existing(table(spark, sf, "part"), ["p_partkey", "no_such_column", "p_type"])


_TEXTS = {"1-URGENT": " 12.0 ", "2-HIGH": "1e3", "3-MEDIUM": "nan", "4-NOT SPECIFIED": "1d", "5-LOW": "-.5"}
_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


@query("coerce_numeric", f"""WITH t AS (SELECT o_orderkey, CASE o_orderpriority {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _TEXTS.items())}
  ELSE o_orderpriority END AS txt FROM orders),
n AS (SELECT *, CASE WHEN regexp_matches(TRIM(txt), '{_NUMBER}') THEN TRY_CAST(TRIM(txt) AS DOUBLE) END AS number FROM t)
SELECT o_orderkey, txt, number, CASE WHEN number=floor(number) THEN CAST(number AS INT) END AS whole FROM n""")
def coerce_numeric(spark, sf):
    text = F.col("o_orderpriority")
    for name, value in _TEXTS.items():
        text = F.when(F.col("o_orderpriority") == name, value).otherwise(text)
    df = table(spark, sf, "orders").select("o_orderkey", text.alias("txt"))
    return df.withColumns({"number": fx.to_number("txt"), "whole": fx.to_whole("txt")})


@query("harmonize_members", f"""WITH {FLOWS}, h AS (SELECT year, indicator, "count",
  CASE origin WHEN 'NATION_0' THEN 'World' ELSE origin END AS origin,
  CASE destination_office WHEN 'NATION_0' THEN 'World' ELSE destination_office END AS destination_office FROM flows)
SELECT year, indicator, "count", origin, destination_office,
  CASE WHEN origin='World' THEN 'WD' WHEN origin='NATION_1' THEN NULL ELSE substr(origin, 8) END AS origin_st3_code FROM h""")
def harmonize_members(spark, sf):
    messy = F.when(F.col("origin") == "NATION_0", " TOTAL ").otherwise(F.col("origin"))
    exact = F.when(F.col("destination_office") == "NATION_0", "Total").otherwise(F.col("destination_office"))
    df = flows(spark, sf).withColumns({"origin": messy, "destination_office": exact})
    df = conform.harmonize(df, ["origin"], {"Total": "World"}, ignore_case=True)
    df = conform.harmonize(df, ["destination_office"], {"Total": "World"})
    code = F.when(~F.col("origin").isin("World", "NATION_1"), F.substring("origin", 8, 10))
    return conform.fill_code(df.withColumn("origin_st3_code", code), "origin", "origin_st3_code")


@query("rename_by_code", """SELECT c_custkey, c_mktsegment AS code,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Construction' WHEN 'MACHINERY' THEN 'Machines' ELSE c_name END AS name FROM customer""")
def rename_by_code(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("code"), F.col("c_name").alias("name"))
    return conform.rename_by_code(df, "code", "name", {"BUILDING": "Construction", "MACHINERY": "Machines"})


@query("relabel_category", """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'first' WHEN '5-LOW' THEN 'last' END AS label FROM orders""")
def relabel_category(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", F.translate("o_orderpriority", "-", "–").alias("priority"))
    return conform.relabel(df, "priority", {"1-URGENT": "first", "5-LOW": "last"}, "label").drop("priority")


@query("short_label", """SELECT p_partkey, CASE WHEN instr(txt, 'ring') > 0
  THEN substr(txt, 1, instr(txt, 'ring') - 1) || 'rg.' || substr(txt, instr(txt, 'ring') + 4) ELSE txt END AS label
FROM (SELECT p_partkey, p_name || ' / ' || p_name AS txt FROM part)""")
def short_label(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", F.concat("p_name", F.lit(" / "), "p_name").alias("txt"))
    return df.select("p_partkey", fx.shorten("txt", "ring", "rg.").alias("label"))


@query("nullable_sum", """SELECT l_orderkey, l_linenumber, CASE WHEN a IS NULL AND b IS NULL THEN NULL ELSE COALESCE(a,0)+COALESCE(b,0) END AS total
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag='A' THEN l_quantity END AS a, CASE WHEN l_linestatus='O' THEN l_quantity END AS b FROM lineitem)""")
def nullable_sum(spark, sf):
    a = F.when(F.col("l_returnflag") == "A", F.col("l_quantity"))
    b = F.when(F.col("l_linestatus") == "O", F.col("l_quantity"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", fx.nullable_sum(a, b).alias("total"))


@query("null_to_zero", """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag='A' THEN CAST(l_quantity AS INT) ELSE 0 END AS n FROM lineitem""")
def null_to_zero(spark, sf):
    text = F.when(F.col("l_returnflag") == "A", F.col("l_quantity").cast("string"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", fx.null_to_zero_int(text).alias("n"))


@query("unscale_value", """SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus='O' THEN l_quantity * pow(10.0::DOUBLE, l_linenumber) END AS value FROM lineitem""")
def unscale_value(spark, sf):
    scale = F.when(F.col("l_linestatus") == "O", F.col("l_linenumber"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", fx.unscale("l_quantity", scale).alias("value"))


@query("stage_table", """SELECT CAST(year(l_shipdate) AS INT) AS year, l_linestatus AS fdi_type, CAST(l_suppkey AS VARCHAR) AS region,
  l_quantity * pow(10.0::DOUBLE, l_linenumber) AS dollar_value
FROM lineitem WHERE l_returnflag='N' AND l_linestatus IN ('O','F')""")
def stage_table(spark, sf):
    raw = table(spark, sf, "lineitem").select(
        F.year("l_shipdate").cast("string").alias("REF_DATE"), F.col("l_returnflag").alias("GEO"),
        F.col("l_linestatus").alias("Type of direct investment"), F.col("l_suppkey").cast("string").alias("Countries or regions"),
        F.col("l_linenumber").cast("string").alias("SCALAR_ID"), F.col("l_quantity").cast("string").alias("VALUE"),
    )
    rename = {"REF_DATE": "year", "Type of direct investment": "fdi_type", "Countries or regions": "region", "VALUE": "dollar_value"}
    return conform.stage_table(raw, StageTable("Type of direct investment", ("O", "F"), rename, geo_value="N"))


@query("class_code_norm", """SELECT p_partkey, raw,
  CASE WHEN lower(raw) LIKE 'other%' THEN 'Other' WHEN lower(raw) LIKE 'unknown%' THEN 'Unknown'
    WHEN regexp_extract(raw, '([0-9]+)', 1) <> '' THEN CAST(CAST(regexp_extract(raw, '([0-9]+)', 1) AS BIGINT) AS VARCHAR) ELSE TRIM(raw) END AS code,
  CASE WHEN contains(lower(raw), 'other') THEN 'Other' WHEN contains(lower(raw), 'unknown') THEN 'Unknown'
    WHEN regexp_extract(raw, '([0-9]+)', 1) <> '' THEN format('{:02d}', CAST(regexp_extract(raw, '([0-9]+)', 1) AS BIGINT)) ELSE TRIM(raw) END AS padded
FROM (SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 'Other ' || p_brand WHEN 'LARGE' THEN 'an unknown kind ' || p_size
  WHEN 'PROMO' THEN p_name WHEN 'ECONOMY' THEN 'Class 0' || p_size ELSE p_brand END AS raw FROM part)""")
def class_code_norm(spark, sf):
    raw = (
        F.when(F.col("p_type") == "SMALL", F.concat(F.lit("Other "), "p_brand"))
        .when(F.col("p_type") == "LARGE", F.concat(F.lit("an unknown kind "), "p_size"))
        .when(F.col("p_type") == "PROMO", F.col("p_name"))
        .when(F.col("p_type") == "ECONOMY", F.concat(F.lit("Class 0"), "p_size"))
        .otherwise(F.col("p_brand"))
    )
    df = table(spark, sf, "part").select("p_partkey", raw.alias("raw"))
    return df.withColumns({"code": fx.class_code("raw"), "padded": fx.class_code("raw", pad=True, match="contains")})


def industry_text() -> Column:
    """Industry text with a bracketed code; some rows the total, some a code of another length."""
    code = F.when(F.col("p_size") > 40, F.col("p_size")).otherwise(F.col("p_size") + 1000)
    named = F.concat("p_type", F.lit(" [sub] ["), code.cast("string"), F.lit("]"))
    return F.when(F.col("p_brand") == "Brand#1", "Total of all industries").otherwise(named).alias("naics")


INDUSTRY = """CASE WHEN p_brand='Brand#1' THEN 'Total of all industries'
  ELSE p_type || ' [sub] [' || CASE WHEN p_size > 40 THEN p_size ELSE p_size + 1000 END || ']' END"""


@query("naics_stage", f"""SELECT p_partkey, naics FROM (SELECT p_partkey, {INDUSTRY} AS naics FROM part)
WHERE naics='Total of all industries' OR regexp_matches(naics, '\\[([0-9]{{4}})\\]$')""")
def naics_stage(spark, sf):
    return conform.keep_industry_groups(table(spark, sf, "part").select("p_partkey", industry_text()), "naics")


@query("naics_parse", f"""SELECT p_partkey,
  TRY_CAST(NULLIF(regexp_extract(naics, '\\[([0-9]{{4}})\\]$', 1), '') AS INT) AS naics_code,
  CASE WHEN naics='Total of all industries' THEN 'Total' ELSE TRIM(regexp_replace(naics, '\\s*\\[[^\\]]+\\]$', '')) END AS naics_name
FROM (SELECT p_partkey, {INDUSTRY} AS naics FROM part)""")
def naics_parse(spark, sf):
    return conform.parse_industry(table(spark, sf, "part").select("p_partkey", industry_text()), "naics")


@query("observation_gate", """SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS value FROM events
WHERE event_type='click' AND json_extract(props, '$.k') IS NOT NULL AND value >= 10""")
def observation_gate(spark, sf):
    df = table(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("MEASURE"), F.when(F.col("value") >= 10, "A").otherwise("E").alias("obs_status"),
        F.from_json("props", "k DOUBLE")["k"].alias("value"),
    )
    return conform.observation_gate(df, measure="click").select("event_id", "value")


@query("drop_null", "SELECT o_orderkey, o_orderpriority AS label FROM orders WHERE o_orderpriority IN ('1-URGENT','5-LOW')")
def drop_null(spark, sf):
    label = F.when(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"), F.col("o_orderpriority"))
    return conform.drop_null(table(spark, sf, "orders").select("o_orderkey", label.alias("label")), ["label"])


@query("merge_columns", "SELECT c_custkey, c_name AS name FROM customer")
def merge_columns(spark, sf):
    first = F.when(F.col("c_acctbal") < 3000, F.col("c_name"))
    second = F.when(F.col("c_acctbal") >= 1000, F.col("c_name"))
    df = table(spark, sf, "customer").select("c_custkey", first.alias("a"), second.alias("b"))
    return enrich.merge_columns(df, "a", "b", "name")


@query("merge_conflicts", """SELECT c_custkey, c_mktsegment AS a, 'BUILDING' AS b FROM customer WHERE c_acctbal >= 1000 AND c_mktsegment <> 'BUILDING'""")
def merge_conflicts(spark, sf):
    other = F.when(F.col("c_acctbal") >= 1000, "BUILDING")
    return enrich.merge_conflicts(table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("a"), other.alias("b")), "a", "b")


@query("surrogate_key", """SELECT CAST(ROW_NUMBER() OVER (ORDER BY c_mktsegment, c_name) AS BIGINT) AS id, c_mktsegment, c_name FROM customer""")
def surrogate_key(spark, sf):
    df = table(spark, sf, "customer").select("c_mktsegment", "c_name")
    return conform.with_surrogate_key(df, "id", ["c_mktsegment", "c_name"])
