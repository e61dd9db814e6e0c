"""Dimension joins, unions, de-duplication and set comparison over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowmart import sinks
from flowmart.operators import enrich
from flowmart.plans import jobs
from flowmart.session import shared_dir, stored
from flowmart.showcase.registry import fixture, query
from flowmart.showcase.views import CLASS_FLOWS, FLOWS, class_flows, flows, table

KEYS = ["year", "origin", "destination_office"]


@query("enrich_counts", f"""WITH {FLOWS},
b AS (SELECT year, origin, destination_office, CASE WHEN "count" >= 100 THEN "count" END AS "count" FROM flows WHERE indicator='TM1a'),
x AS (SELECT year, origin, destination_office, CASE WHEN "count" < 40 THEN 0.0 WHEN "count" < 120 THEN "count" END AS extra FROM flows
  WHERE indicator='TM1b' AND destination_office='NATION_3'),
j AS (SELECT b.*, x.extra FROM b LEFT JOIN x USING (year, origin, destination_office)),
t AS (SELECT *, CASE WHEN "count" IS NULL AND extra IS NULL THEN NULL ELSE COALESCE("count",0)+COALESCE(extra,0) END AS tot FROM j)
SELECT DISTINCT year, origin, destination_office, CASE WHEN "count" IS NOT NULL OR tot > 0 THEN tot END AS "count" FROM t""")
def enrich_counts(spark, sf):
    fact = stored(flows(spark, sf))
    base = fact.where(F.col("indicator") == "TM1a").select(*KEYS, F.when(F.col("count") >= 100, F.col("count")).alias("count"))
    extra = fact.where((F.col("indicator") == "TM1b") & (F.col("destination_office") == "NATION_3")).select(
        *KEYS, F.when(F.col("count") < 40, 0.0).when(F.col("count") < 120, F.col("count")).alias("extra")
    )
    return enrich.add_counts(base, extra, KEYS)


@query("code_lookup", f"""WITH {FLOWS}, d AS (SELECT n_name, MAX(CONCAT('R', n_regionkey)) AS code FROM nation WHERE n_nationkey <> 7 GROUP BY n_name)
SELECT flows.*, COALESCE(code, 'ZZ') AS origin_st3_code FROM flows LEFT JOIN d ON origin=n_name""")
def code_lookup(spark, sf):
    dim = table(spark, sf, "nation").where(F.col("n_nationkey") != 7).select("n_name", F.concat(F.lit("R"), "n_regionkey").alias("code"))
    return enrich.lookup(flows(spark, sf), dim, "origin", "code", "origin_st3_code", default="ZZ", key="n_name")


@query("code_lookup_last", """WITH d AS (SELECT c_nationkey, max_by(c_mktsegment, c_custkey) AS segment FROM customer GROUP BY c_nationkey)
SELECT s_suppkey, s_nationkey, segment FROM supplier LEFT JOIN d ON s_nationkey=c_nationkey""")
def code_lookup_last(spark, sf):
    dim = table(spark, sf, "customer").select("c_nationkey", "c_mktsegment", "c_custkey")
    base = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    return enrich.lookup(base, dim, "s_nationkey", "c_mktsegment", "segment", key="c_nationkey", order="c_custkey")


@query("guarded_dim_join", """SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey=c_custkey""")
def guarded_dim_join(spark, sf):
    dim = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return enrich.guarded_join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), dim, {"o_custkey": "c_custkey"})


@query("unmatched_keys", """SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""")
def unmatched_keys(spark, sf):
    dim = table(spark, sf, "customer").where(F.col("c_acctbal") >= 0)
    return enrich.unmatched(table(spark, sf, "orders"), dim, {"o_custkey": "c_custkey"})


def _economies(spark, sf):
    return table(spark, sf, "customer").select(
        F.concat(F.lit("C"), "c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.when(F.col("c_nationkey") != 4, F.col("c_nationkey").cast("string")).otherwise("").alias("region"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey").cast("string")).alias("adminregion"),
    )


def _regions(spark, sf):
    return table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("name"))


@query("region_map", """SELECT CAST(c_nationkey AS VARCHAR) AS region_code, n_name AS region_name, CONCAT('C', c_custkey) AS wb_economy_code, c_name AS wb_economy_name
FROM customer JOIN nation ON c_nationkey=n_nationkey WHERE c_nationkey <> 4""")
def region_map(spark, sf):
    return jobs.economy_regions(_economies(spark, sf), _regions(spark, sf))["region"]


@query("admin_region_map", """SELECT CONCAT('C', c_custkey) AS wb_economy_code, c_name AS wb_economy_name,
  CASE WHEN c_nationkey <> 4 THEN CAST(c_nationkey AS VARCHAR) END AS region_code,
  CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey AS VARCHAR) END AS admin_region_code,
  CASE WHEN c_acctbal >= 0 THEN n_name END AS admin_region_name FROM customer JOIN nation ON c_nationkey=n_nationkey""")
def admin_region_map(spark, sf):
    return jobs.economy_regions(_economies(spark, sf), _regions(spark, sf))["economies"]


@query("region_hierarchy", """WITH j AS (SELECT 3 AS hierarchical_level, CAST(s_suppkey AS VARCHAR) AS sccai_code, CAST(s_nationkey AS VARCHAR) AS parent_sccai_code,
  s_name AS region, CASE WHEN s_suppkey < 20 THEN CAST(s_suppkey AS VARCHAR) END AS m49_code, CASE WHEN s_acctbal >= 3000 THEN s_name END AS notes FROM supplier)
SELECT CAST(ROW_NUMBER() OVER (ORDER BY hierarchical_level, sccai_code, region) AS BIGINT) AS sccai_code_id,
  CAST(hierarchical_level AS VARCHAR) AS hierarchical_level, sccai_code, parent_sccai_code, region, m49_code, notes FROM j""")
def region_hierarchy(spark, sf):
    supplier = table(spark, sf, "supplier")
    note = F.when(F.col("s_acctbal") >= 3000, F.col("s_name")).otherwise(" ")
    social = supplier.select(
        F.lit(3).alias("Level"), F.col("s_suppkey").alias("Code"), F.col("s_nationkey").alias("Parent Code"),
        F.col("s_name").alias("Class title"), note.alias("Footnotes"),
    )
    codes = supplier.where(F.col("s_suppkey") < 20).select(
        F.col("s_suppkey").alias("Code"), F.col("s_name").alias("Countries and Areas of Interest"),
        F.col("s_suppkey").alias("Num-3"), note.alias("Footnotes"),
    )
    return jobs.country_regions(social, codes)


@query("code_system_outer", """SELECT COALESCE(s_suppkey, c_custkey) AS k, s_name, c_name FROM (SELECT * FROM supplier WHERE s_acctbal >= 2000) s
FULL JOIN (SELECT * FROM customer WHERE c_acctbal < 5000) c ON s_suppkey=c_custkey""")
def code_system_outer(spark, sf):
    left = table(spark, sf, "supplier").where(F.col("s_acctbal") >= 2000).select(F.col("s_suppkey").alias("k"), "s_name")
    right = table(spark, sf, "customer").where(F.col("c_acctbal") < 5000).select(F.col("c_custkey").alias("k"), "c_name")
    return enrich.attach(left, right, "k", "full")


@query("attach_null_safe", """SELECT o_orderkey, p, label FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS p FROM orders)
JOIN (SELECT DISTINCT CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS q, CASE WHEN o_orderstatus='P' THEN 'none' ELSE 'some' END AS label FROM orders)
  ON p IS NOT DISTINCT FROM q""")
def attach_null_safe(spark, sf):
    orders = table(spark, sf, "orders")
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    dim = orders.select(status.alias("q"), F.when(F.col("o_orderstatus") == "P", "none").otherwise("some").alias("label")).distinct()
    return enrich.attach(orders.select("o_orderkey", status.alias("p")), dim, {"p": "q"}, null_safe=True)


@query("two_path_match", """WITH d AS (SELECT s_suppkey, CASE WHEN s_acctbal >= 3000 THEN REPLACE(s_name, 'Supplier', 'Customer') END AS first_name,
  REPLACE(s_name, 'Supplier', 'Customer') AS second_name FROM supplier)
SELECT c.c_name, COALESCE(a.s_suppkey, b.s_suppkey) AS s_suppkey, COALESCE(a.first_name, b.first_name) AS first_name, COALESCE(a.second_name, b.second_name) AS second_name
FROM customer c LEFT JOIN d a ON c.c_name=a.first_name LEFT JOIN d b ON c.c_name=b.second_name""")
def two_path_match(spark, sf):
    other = F.replace("s_name", F.lit("Supplier"), F.lit("Customer"))
    dim = table(spark, sf, "supplier").select(
        "s_suppkey", F.when(F.col("s_acctbal") >= 3000, other).alias("first_name"), other.alias("second_name")
    )
    return enrich.two_path_match(table(spark, sf, "customer").select("c_name"), dim, "c_name", "first_name", "second_name")


@query("union_indicators", f"""WITH {FLOWS}
SELECT year, origin, CASE WHEN indicator='TM1a' THEN NULL ELSE destination_office END AS destination_office, "count",
  CASE WHEN indicator='TM1a' THEN 'TM7' ELSE indicator END AS indicator FROM flows""")
def union_indicators(spark, sf):
    fact = flows(spark, sf)
    frames = {code: fact.where(F.col("indicator") == code).drop("indicator") for code in ("PA1a", "PA1b", "TM1b", "ID1a", "ID1b")}
    frames["TM7"] = fact.where(F.col("indicator") == "TM1a").drop("indicator", "destination_office")
    return enrich.union_indicators(frames)


@query("union_flows", f"""WITH {FLOWS}
SELECT DISTINCT year, region, flow_type FROM (
  SELECT year, origin AS region, 'out' AS flow_type FROM flows UNION ALL SELECT year, destination_office, 'in' FROM flows)""")
def union_flows(spark, sf):
    fact = flows(spark, sf)
    sides = [("origin", "out"), ("destination_office", "in")]
    return enrich.union_flows([fact.select("year", F.col(c).alias("region"), F.lit(name).alias("flow_type")) for c, name in sides])


@query("dedupe_rows", """SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, MIN(o_orderdate) AS o_orderdate FROM orders GROUP BY o_custkey""")
def dedupe_rows(spark, sf):
    df = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return enrich.dedupe(df, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("distinct_rows", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct_rows(spark, sf):
    return enrich.dedupe(table(spark, sf, "orders").select("o_custkey", "o_orderstatus"))


_NAMES = """a AS (SELECT DISTINCT o_custkey AS value FROM orders), b AS (SELECT DISTINCT c_custkey AS value FROM customer WHERE c_acctbal >= 0),
d AS (SELECT value, 'left_only' AS side FROM a WHERE value NOT IN (SELECT value FROM b)
  UNION ALL SELECT value, 'right_only' FROM b WHERE value NOT IN (SELECT value FROM a))"""


@query("set_difference", f"WITH {_NAMES} SELECT * FROM d")
def set_difference(spark, sf):
    return enrich.set_difference(
        table(spark, sf, "orders"), table(spark, sf, "customer").where(F.col("c_acctbal") >= 0), "o_custkey", "c_custkey"
    )


@query("set_counts", f"WITH {_NAMES} SELECT side, COUNT(*) AS n_values FROM d GROUP BY side")
def set_counts(spark, sf):
    return enrich.set_counts(
        table(spark, sf, "orders"), table(spark, sf, "customer").where(F.col("c_acctbal") >= 0), "o_custkey", "c_custkey"
    )


@query("class_label_dim", """SELECT DISTINCT 'Nice' AS class_type, CAST(CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INT) AS VARCHAR) AS class_code_short,
  CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INT) || ' - ' || p_brand AS class_code_labeled FROM part""")
def class_label_dim(spark, sf):
    landed = table(spark, sf, "part").select(F.col("p_brand").alias(" Class"), F.concat(F.lit(" "), "p_brand").alias("INDUSTRY")).distinct()
    return enrich.class_label_dim(landed, "Nice")


@query("class_label_join", f"""WITH {CLASS_FLOWS.replace('p_type AS class_code', 'p_brand AS class_code')}
SELECT year, origin, destination_office, indicator, "count", CASE WHEN indicator LIKE 'TM%' THEN 'Nice' ELSE 'Tech field' END AS class_type,
  CASE WHEN indicator NOT LIKE 'TM%' OR class_code='Brand#7' THEN class_code
    ELSE CAST(regexp_extract(class_code, '([0-9]+)', 1) AS INT) || ' - ' || class_code END AS class_code FROM class_flows""")
def class_label_join(spark, sf):
    fact = class_flows(spark, sf, "p_brand")
    fact = fact.withColumn("class_type", F.when(F.col("indicator").startswith("TM"), "Nice").otherwise("Tech field"))
    names = table(spark, sf, "part").where(F.col("p_brand") != "Brand#7").select(F.col("p_brand").alias("Class"), F.col("p_brand").alias("Industry"))
    return enrich.label_classes(fact, enrich.class_label_dim(names.distinct(), "Nice"))


@query("area_codes", """WITH m AS (
  SELECT DISTINCT CONCAT('R', r_regionkey) AS m49_code, r_name AS m49_name FROM nation JOIN region ON n_regionkey=r_regionkey JOIN customer ON c_nationkey=n_nationkey
  UNION SELECT DISTINCT CAST(c_custkey AS VARCHAR), c_name FROM customer),
i AS (SELECT CAST(c_custkey AS VARCHAR) AS m49_code, CONCAT('a', c_custkey) AS iso_alpha2_code, CONCAT('A', c_custkey) AS iso_alpha3_code FROM customer),
e AS (SELECT CONCAT('A', s_suppkey) AS iso_alpha3_code, s_name AS world_bank_name FROM supplier
  UNION ALL SELECT CONCAT('X', s_suppkey), s_name FROM supplier)
SELECT m.m49_code, m.m49_name, i.iso_alpha2_code, COALESCE(i.iso_alpha3_code, e.iso_alpha3_code) AS iso_alpha3_code, e.world_bank_name
FROM m LEFT JOIN i ON m.m49_code=i.m49_code FULL JOIN e ON i.iso_alpha3_code=e.iso_alpha3_code""")
def area_codes(spark, sf):
    none = F.lit(None).cast("string")
    m49 = (
        table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit("R"), "r_regionkey").alias("Global Code"), F.col("r_name").alias("Global Name"),
            none.alias("Region Code"), none.alias("Region Name"), none.alias("Sub-region Code"), none.alias("Sub-region Name"),
            none.alias("Intermediate Region Code"), none.alias("Intermediate Region Name"),
            F.col("c_custkey").alias("M49 Code"), F.col("c_name").alias("Country or Area"),
            F.concat(F.lit("a"), "c_custkey").alias("ISO-alpha2 Code"), F.concat(F.lit("A"), "c_custkey").alias("ISO-alpha3 Code"),
        )
    )
    supplier = table(spark, sf, "supplier")
    ids = F.explode(F.array(F.concat(F.lit("A"), "s_suppkey"), F.concat(F.lit("X"), "s_suppkey")))
    return jobs.area_codes(m49, supplier.select(ids.alias("id"), F.col("s_name").alias("name")))


@fixture
def bucketed_lines(spark, sf):
    """Order lines bucketed by part, and two dimensions bucketed like them; one part in three lines is the same, so it is cut."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(F.col("l_partkey")).alias("l_partkey"))
    paths = tuple(shared_dir(spark, "bucketed") for _ in range(3))
    sinks.write_bucketed(lines, paths[0], ["l_partkey"], spark.sparkContext.defaultParallelism)
    parts = table(spark, sf, "part")
    sinks.write_bucketed_dim(parts.select("p_partkey", "p_brand", "p_size"), paths[1], paths[0], {"l_partkey": "p_partkey"})
    sizes = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n_lines"))
    sinks.write_bucketed_dim(sizes, paths[2], paths[0])
    return paths


@query("bucketed_lookup", """SELECT CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END AS l_partkey, l_orderkey, l_linenumber, p_brand, p_size, n_lines
FROM lineitem l LEFT JOIN part ON p_partkey = CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END
LEFT JOIN (SELECT l_partkey AS k, COUNT(*) AS n_lines FROM lineitem GROUP BY 1) ON k = CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l.l_partkey END""")
def bucketed_lookup(spark, sf):
    """Two lookups by the key that fact and dimensions are bucketed by."""
    return sinks.join_bucketed(spark, *bucketed_lines(spark, sf))
