"""Quality checks, profiles and load checks over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowmart import sinks
from flowmart.operators import catalog, quality as q
from flowmart.schema import contract
from flowmart.session import shared_dir
from flowmart.showcase.registry import query
from flowmart.showcase.views import table

_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("quality_report", f"""WITH s AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE o_custkey IS NULL OR o_totalprice IS NULL) AS n_null,
  COUNT(*) FILTER (WHERE TRIM(o_orderpriority)='' OR TRIM(o_orderstatus)='') AS n_blank,
  MIN(o_custkey) AS lo, MAX(o_custkey) AS hi, MIN(o_orderstatus) AS s0, MAX(o_orderstatus) AS s1,
  COUNT(*) FILTER (WHERE o_totalprice < 0) AS neg, COUNT(*) FILTER (WHERE o_totalprice <> 0) AS nonzero,
  COUNT(*) FILTER (WHERE o_orderpriority IN ('9-NONE','5-LOW')) AS banned,
  (CASE WHEN bool_or(o_orderpriority='1-URGENT') THEN 0 ELSE 1 END) + (CASE WHEN bool_or(o_orderpriority='0-NOW') THEN 0 ELSE 1 END) AS absent,
  COUNT(*) FILTER (WHERE o_orderkey=7) AS spot FROM orders),
d AS (SELECT COUNT(*) AS n FROM (SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING COUNT(*) > 1)),
e AS (SELECT COUNT(*) AS n FROM (SELECT o_custkey, o_orderstatus FROM orders GROUP BY ALL HAVING COUNT(*) > 1))
SELECT 'columns' AS "check", TRUE AS passed, '[{', '.join(_COLUMNS)}]' AS observed
UNION ALL SELECT 'row_count', n=15000, CAST(n AS VARCHAR) FROM s
UNION ALL SELECT 'no_nulls', n_null=0, CAST(n_null AS VARCHAR) FROM s
UNION ALL SELECT 'no_blanks', n_blank=0, CAST(n_blank AS VARCHAR) FROM s
UNION ALL SELECT 'integer:o_custkey', TRUE, 'bigint'
UNION ALL SELECT 'numeric:o_orderstatus', FALSE, 'string'
UNION ALL SELECT 'range:o_custkey', lo >= 0 AND hi <= 1000, lo || '..' || hi FROM s
UNION ALL SELECT 'only:o_orderstatus', s0='F' AND s1='F', s0 || '..' || s1 FROM s
UNION ALL SELECT 'negative', neg > 0, CAST(neg AS VARCHAR) FROM s
UNION ALL SELECT 'nonzero', nonzero > 0, CAST(nonzero AS VARCHAR) FROM s
UNION ALL SELECT 'banned:o_orderpriority', banned=0, CAST(banned AS VARCHAR) FROM s
UNION ALL SELECT 'required:o_orderpriority', absent=0, CAST(absent AS VARCHAR) FROM s
UNION ALL SELECT 'order_7', spot=1, CAST(spot AS VARCHAR) FROM s
UNION ALL SELECT 'unique:o_orderkey', n=0, CAST(n AS VARCHAR) FROM d
UNION ALL SELECT 'unique:o_custkey,o_orderstatus', n=0, CAST(n AS VARCHAR) FROM e""")
def quality_report(spark, sf):
    rules = [
        q.columns_are(_COLUMNS), q.row_count_is(15000), q.no_nulls(["o_custkey", "o_totalprice"]),
        q.no_blanks(["o_orderpriority", "o_orderstatus"]), q.type_is("o_custkey", "integer"), q.type_is("o_orderstatus", "numeric"),
        q.in_range("o_custkey", 0, 1000), q.only_value("o_orderstatus", "F"),
        q.some("negative", F.col("o_totalprice") < 0), q.some("nonzero", F.col("o_totalprice") != 0),
        q.without_members("o_orderpriority", ["9-NONE", "5-LOW"]), q.with_members("o_orderpriority", ["1-URGENT", "0-NOW"]),
        q.spot("order_7", F.col("o_orderkey") == 7, F.col("o_totalprice") > 0), q.UniqueKey(("o_orderkey",)),
        q.UniqueKey(("o_custkey", "o_orderstatus")),
    ]
    return q.report(table(spark, sf, "orders"), rules)


@query("member_rules", """SELECT DISTINCT source AS member, 'banned' AS violation FROM documents WHERE source IN (SELECT CONCAT('src', n_nationkey) FROM nation WHERE n_nationkey >= 15)
UNION ALL SELECT CONCAT('src', n_nationkey), 'missing' FROM nation WHERE n_nationkey >= 10 AND CONCAT('src', n_nationkey) NOT IN (SELECT source FROM documents)""")
def member_rules(spark, sf):
    names = table(spark, sf, "nation").select("n_nationkey", F.concat(F.lit("src"), "n_nationkey").alias("member"))
    return q.members(
        table(spark, sf, "documents"), "source", names.where(F.col("n_nationkey") >= 15), names.where(F.col("n_nationkey") >= 10)
    )


@query("duplicate_keys", "SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1")
def duplicate_keys(spark, sf):
    return q.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("constant_columns", """SELECT 'o_orderstatus' AS "column", 'F' AS expected, MIN(o_orderstatus) AS lowest, MAX(o_orderstatus) AS highest,
  MIN(o_orderstatus)='F' AND MAX(o_orderstatus)='F' AS passed FROM orders
UNION ALL SELECT 'unit', 'XDC', 'XDC', 'XDC', TRUE""")
def constant_columns(spark, sf):
    return q.constants(table(spark, sf, "orders").withColumn("unit", F.lit("XDC")), {"o_orderstatus": "F", "unit": "XDC"})


@query("load_verify", "SELECT COUNT(*) AS n_loaded, COUNT(*) AS n_target, 0 AS n_differing, TRUE AS same_content, TRUE AS passed FROM orders")
def load_verify(spark, sf):
    path = shared_dir(spark, "load_verify")
    written = sinks.publish(table(spark, sf, "orders"), path, ["o_orderstatus"], verify=False)
    found = sinks.verify_written(spark, path, written.content)
    return found.select("n_loaded", "n_target", F.size("differing").alias("n_differing"), "same_content", "passed")


_LOAD = contract(c_name="string", c_nationkey="int", balance="amount", note="string")


@query("contract_write", """SELECT c_name, CAST(c_nationkey AS INT) AS c_nationkey, CAST(CAST(c_acctbal AS DECIMAL(20,2)) AS DOUBLE) AS balance, CAST(NULL AS VARCHAR) AS note FROM customer""")
def contract_write(spark, sf):
    path = shared_dir(spark, "contract_write")
    df = table(spark, sf, "customer").select(F.col("c_acctbal").cast("decimal(20,2)").alias("balance"), "c_nationkey", "c_name")
    sinks.publish(df, path, contract=_LOAD, rows_per_file=200_000)
    return sinks.read_mart(spark, path).withColumn("balance", F.col("balance").cast("double"))


_PROFILED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]


def _profile(col: str, n: int) -> str:
    text = f"CAST({col} AS VARCHAR)"
    return f"""SELECT '{col}' AS "column", COUNT(DISTINCT {col}) AS n_unique,
  (SELECT string_agg(COALESCE(v, 'null'), ' | ' ORDER BY v NULLS FIRST) FROM (SELECT DISTINCT {text} AS v FROM orders ORDER BY v NULLS FIRST LIMIT {n})) AS sample_values
FROM orders"""


@query("profile_columns", " UNION ALL ".join(_profile(c, 25) for c in _PROFILED))
def profile_columns(spark, sf):
    found = catalog.profile(table(spark, sf, "orders").select(*_PROFILED))
    shown = F.transform("sample_values", lambda v: F.coalesce(v, F.lit("null")))
    return found.withColumn("sample_values", F.array_join(shown, " | "))


@query("table_schema", " UNION ALL ".join(
    f"""SELECT column_name AS "column", CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
  WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS type, (SELECT COUNT({c}) FROM orders) AS n_filled FROM (DESCRIBE orders) WHERE column_name='{c}'"""
    for c in _COLUMNS))
def table_schema(spark, sf):
    orders = table(spark, sf, "orders").select(*_COLUMNS)
    _, described, _ = catalog.overview(orders)
    return described.join(catalog.filled_counts(orders), ["ordinal", "column"]).select("column", "type", "n_filled")


@query("table_head", "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10")
def table_head(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey")
    _, _, head = catalog.overview(rows, 10)
    return head


@query("sampled_rows")
def sampled_rows(spark, sf):
    """A tenth of the orders at random, by a fixed seed; SQL cannot name the rows, a test holds them against the table."""
    return catalog.sample_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 0.1)


@query("table_overview", "SELECT COUNT(*) AS n_rows FROM customer")
def table_overview(spark, sf):
    rows, _, _ = catalog.overview(table(spark, sf, "customer"))
    return rows
