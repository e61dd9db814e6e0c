"""Reshaping over the pivoted flow view."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowmart.operators import conform, reshape
from flowmart.plans import jobs
from flowmart.session import stored
from flowmart.showcase.registry import query
from flowmart.showcase.views import FLOWS, LONG, WIDE, YEARS, buyers, exact_sum, flows, pivoted, table, wide_flows

IDS = ["origin", "destination_office", "indicator"]


@query("unpivot_years", f'WITH {FLOWS}, {LONG} SELECT origin, destination_office, indicator, year, "count" FROM long')
def unpivot_years(spark, sf):
    return reshape.unpivot_years(wide_flows(spark, sf))


@query("unpivot_years_filled", f'WITH {FLOWS} SELECT origin, destination_office, indicator, year, "count" FROM flows')
def unpivot_years_filled(spark, sf):
    return reshape.unpivot_years(wide_flows(spark, sf), drop_nulls=True)


@query("unpivot_rest", f"""WITH {FLOWS}, {LONG}
SELECT origin, destination_office, indicator, CAST(year AS VARCHAR) AS year, "count" FROM long""")
def unpivot_rest(spark, sf):
    return reshape.unpivot_rest(wide_flows(spark, sf), IDS)


@query("trim_trailing_years", f"WITH {FLOWS}, {WIDE} SELECT * FROM wide")
def trim_trailing_years(spark, sf):
    late = YEARS + [2002, 2003, 2004]
    return conform.trim_trailing_years(wide_flows(spark, sf, late), [str(y) for y in late])


@query("trim_trailing_years_long", f'WITH {FLOWS}, {LONG} SELECT origin, destination_office, indicator, year, "count" FROM long')
def trim_trailing_years_long(spark, sf):
    wide = wide_flows(spark, sf, YEARS + [2002, 2003, 2004])
    return conform.trim_trailing_years_long(reshape.unpivot_years(wide))


@query("unilateral_layout", f"""WITH {FLOWS}
SELECT destination_office AS "Office", 'World' AS "Origin", {pivoted()} FROM flows GROUP BY destination_office""")
def unilateral_layout(spark, sf):
    totals = flows(spark, sf).groupBy("destination_office").pivot("year", YEARS).agg(F.sum("count"))
    landed = totals.select(
        "destination_office", F.lit("XX").alias("code"), F.lit("any").alias("from"), F.lit("t").alias("Type"),
        *[F.col(str(y)).alias(f"y{i}") for i, y in enumerate(YEARS)],
    )
    return conform.apply_layout(landed, "unilateral_typed", base_year=YEARS[0])


@query("unpivot_prefixed", f"""WITH n AS (
  SELECT CAST(r_regionkey AS VARCHAR) AS wb_region_code, r_name AS region, o_orderpriority AS series,
    CAST(year(o_orderdate) AS INT) AS year, CAST(COUNT(*) AS DOUBLE) AS value
  FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey
  GROUP BY ALL)
SELECT k.wb_region_code, k.region, k.series, CAST(y AS INT) AS year, n.value
FROM (SELECT DISTINCT wb_region_code, region, series FROM n) k CROSS JOIN range({YEARS[0]}, {YEARS[-1] + 1}) r(y)
LEFT JOIN n ON n.wb_region_code=k.wb_region_code AND n.series=k.series AND n.year=y""")
def unpivot_prefixed(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderpriority", F.year("o_orderdate").alias("y"))
    placed = buyers(orders, spark, sf).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    economy = F.col("r_regionkey").cast("string").alias("economy")
    wide = (
        placed.groupBy(economy, F.col("r_name").alias("Country"), F.col("o_orderpriority").alias("Series"))
        .pivot("y", YEARS).agg(F.count(F.lit(1)))
    )
    return jobs.macro_stats(wide.toDF(*wide.columns[:3], *[f"YR{y}" for y in YEARS]))


@query("office_pair_mart", """WITH p AS (
  SELECT sn.n_name AS a, cn.n_name AS b, CAST(year(o_orderdate) AS INT) AS year,
    COALESCE(SUM(CAST(l_quantity AS DECIMAL(18,2))) FILTER (WHERE l_linestatus='O'), 0) AS national,
    COALESCE(SUM(CAST(l_quantity AS DECIMAL(18,2))) FILTER (WHERE l_linestatus='F'), 0) AS pct
  FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey
    JOIN nation cn ON c_nationkey=cn.n_nationkey JOIN supplier ON l_suppkey=s_suppkey JOIN nation sn ON s_nationkey=sn.n_nationkey
  GROUP BY ALL)
SELECT a AS "Earlier Office", b AS "Later Office", year, 'National' AS "Filing Route", CAST(national AS INT) AS "Count" FROM p
UNION ALL SELECT a, b, year, 'PCT', CAST(pct AS INT) FROM p""")
def office_pair_mart(spark, sf):
    status = F.substring("indicator", 3, 2)
    wide = flows(spark, sf).groupBy(
        F.col("destination_office").alias("Office Of Earlier Examination"), F.col("origin").alias(" Office of Later Examination "),
        F.col("year").alias("Year"),
    ).agg(
        F.sum(F.when(status == "1a", F.col("count"))).alias("National "), F.sum(F.when(status == "1b", F.col("count"))).alias("PCT")
    )
    return jobs.office_pairs_mart(wide)


def _residency(side: str) -> str:
    other = "origin" if side == "office" else "office"
    member = "destination_office" if side == "office" else "origin"
    return f"""SELECT year, {member} AS {side}, 'Total' AS {other},
      CASE WHEN origin=destination_office THEN 'Resident' ELSE 'Abroad' END AS type, indicator, SUM("count") AS "count"
      FROM flows GROUP BY ALL"""


@query("residency_mart", f"""WITH {FLOWS}, o AS ({_residency('office')}), g AS ({_residency('origin')})
SELECT year, office, origin, type, indicator, "count" FROM o
UNION ALL SELECT year, office, origin, type, indicator, "count" FROM g""")
def residency_mart(spark, sf):
    kind = F.when(F.col("origin") == F.col("destination_office"), "Resident").otherwise("Abroad").alias("Type")
    codes = ["PA1a", "PA1b", "TM1a", "TM1b", "ID1a", "ID1b"]
    files, fact = {}, stored(flows(spark, sf))
    for side, member in (("office", "destination_office"), ("origin", "origin")):
        wide = stored(fact.groupBy("indicator", member, kind).pivot("year", YEARS).agg(F.sum("count")))
        for code in codes:
            files[f"{code}_{side}"] = wide.where(F.col("indicator") == code).select(
                member, F.lit("XX").alias("code"), F.lit("").alias("unused"), "Type", *[str(y) for y in YEARS]
            )
    return jobs.residency_mart(files)


@query("hierarchy_members", """SELECT DISTINCT * FROM (
  SELECT CONCAT('R', r_regionkey) AS m49_code, r_name AS m49_name FROM region JOIN nation ON n_regionkey=r_regionkey JOIN customer ON c_nationkey=n_nationkey
  UNION ALL SELECT CONCAT('N', n_nationkey), n_name FROM nation JOIN customer ON c_nationkey=n_nationkey
  UNION ALL SELECT CONCAT('C', c_custkey), c_name FROM customer WHERE c_acctbal >= 0)""")
def hierarchy_members(spark, sf):
    tree = (
        table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit("R"), "r_regionkey").alias("Region Code"), F.col("r_name").alias("Region Name"),
            F.concat(F.lit("N"), "n_nationkey").alias("Nation Code"), F.col("n_name").alias("Nation Name"),
            F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("C"), "c_custkey")).alias("Member Code"),
            F.col("c_name").alias("Member Name"),
        )
    )
    levels = [("Region Code", "Region Name"), ("Nation Code", "Nation Name"), ("Member Code", "Member Name")]
    return reshape.hierarchy_members(tree, levels)


@query("series_to_columns", f"""WITH {FLOWS}
SELECT year, COALESCE(SUM("count") FILTER (WHERE indicator LIKE 'PA%'), 0.0) AS patents,
  COALESCE(SUM("count") FILTER (WHERE origin=destination_office), 0.0) AS domestic FROM flows GROUP BY year""")
def series_to_columns(spark, sf):
    specs = {
        "patents": F.col("indicator").startswith("PA"),
        "domestic": F.col("origin") == F.col("destination_office"),
    }
    return reshape.series_to_columns(flows(spark, sf), ["year"], specs, empty=0.0)


@query("monthly_to_yearly", """SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM orders GROUP BY ALL""")
def monthly_to_yearly(spark, sf):
    from flowmart import functions as fx

    months = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("REF_DATE"), "o_totalprice")
    return months.groupBy(fx.year_of("REF_DATE").alias("year")).agg(exact_sum("o_totalprice").alias("value"))
