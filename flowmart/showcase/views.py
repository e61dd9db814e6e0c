"""Flow views over the driver's star schema.

origin = customer nation, destination = supplier nation, year = order year, indicator = return flag and line
status, class = part type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

FIRST, LAST = 1995, 2001
YEARS = list(range(FIRST, LAST + 1))


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its schema is read from the footer once per process, not once per query."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def exact_sum(c: Column | str) -> Column:
    """Sum as decimal, so the result does not depend on the order of the rows."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast("decimal(18,2)")).cast("double")


def buyers(orders: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders (with ``o_custkey``) beside their customer's nation.

    One table is joined at a time: each side of a join is then a plain scan whose size Spark knows, so it can tell
    whether to broadcast it. A dimension that is itself a join looks as large as the product of its tables.
    """
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))


def _lines(spark: SparkSession, sf_dir: str, part_col: str | None) -> DataFrame:
    """Order lines with customer nation, supplier nation, year and indicator."""
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_quantity",
        F.concat(
            F.when(F.col("l_returnflag") == "N", "PA").when(F.col("l_returnflag") == "R", "TM").otherwise("ID"),
            F.when(F.col("l_linestatus") == "O", "1a").otherwise("1b"),
        ).alias("indicator"),
        *(["l_partkey"] if part_col else []),
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    seller = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("_seller"), F.col("n_name").alias("destination_office"))
    line = line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(seller, F.col("s_nationkey") == F.col("_seller"))
    if part_col:
        part = table(spark, sf_dir, "part").select("p_partkey", F.col(part_col).alias("class_code"))
        line = line.join(part, F.col("l_partkey") == F.col("p_partkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    orders = buyers(orders, spark, sf_dir).select("o_orderkey", "year", F.col("n_name").alias("origin"))
    return line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``year, origin, destination_office, indicator, count``."""
    keys = ["year", "origin", "destination_office", "indicator"]
    return _lines(spark, sf_dir, None).groupBy(*keys).agg(exact_sum("l_quantity").alias("count"))


def class_flows(spark: SparkSession, sf_dir: str, part_col: str = "p_type") -> DataFrame:
    """The same by class."""
    keys = ["year", "origin", "destination_office", "indicator", "class_code"]
    return _lines(spark, sf_dir, part_col).groupBy(*keys).agg(exact_sum("l_quantity").alias("count"))


def wide_flows(spark: SparkSession, sf_dir: str, years: list[int] = YEARS) -> DataFrame:
    """One column per year, as in the landed files."""
    keys = ["origin", "destination_office", "indicator"]
    return _lines(spark, sf_dir, None).groupBy(*keys).pivot("year", years).agg(exact_sum("l_quantity"))


_SELECT = """
  SELECT CAST(year(o_orderdate) AS INT) AS year, cn.n_name AS origin, sn.n_name AS destination_office,
    CONCAT(CASE l_returnflag WHEN 'N' THEN 'PA' WHEN 'R' THEN 'TM' ELSE 'ID' END,
           CASE l_linestatus WHEN 'O' THEN '1a' ELSE '1b' END) AS indicator{extra},
    CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS "count"
  FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey
    JOIN nation cn ON c_nationkey=cn.n_nationkey JOIN supplier ON l_suppkey=s_suppkey
    JOIN nation sn ON s_nationkey=sn.n_nationkey{part}
  GROUP BY ALL"""
FLOWS = "flows AS (" + _SELECT.format(extra="", part="") + ")"
_PART = " JOIN part ON l_partkey=p_partkey"
CLASS_FLOWS = "class_flows AS (" + _SELECT.format(extra=", p_type AS class_code", part=_PART) + ")"


def pivoted(years: list[int] = YEARS) -> str:
    """SQL for one summed column per year."""
    return ", ".join(f'SUM("count") FILTER (WHERE year={y}) AS "{y}"' for y in years)


WIDE = f"wide AS (SELECT origin, destination_office, indicator, {pivoted()} FROM flows GROUP BY ALL)"
SPINE = ", ".join(f"({y})" for y in YEARS)
LONG = f"""long AS (SELECT k.origin, k.destination_office, k.indicator, CAST(y.y AS INT) AS year, f."count"
  FROM (SELECT DISTINCT origin, destination_office, indicator FROM flows) k
  CROSS JOIN (VALUES {SPINE}) y(y)
  LEFT JOIN flows f ON f.origin=k.origin AND f.destination_office=k.destination_office
    AND f.indicator=k.indicator AND f.year=y.y)"""
