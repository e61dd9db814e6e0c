"""Every registered query against its SQL on the smallest driver tables, and the plans of the main ones."""

import pytest
from oracle import compare, duck

import __spark_entry__ as entry_point
from flowmart.showcase import ORACLE, QUERIES
from flowmart.showcase.views import flows

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    said, _ = compare(spark, con, SF, name, lambda *_: df, ORACLE.get(name))
    assert said == ""
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLE) == {"sampled_rows"}


def test_sampled_rows_are_rows_of_the_table(spark):
    got, orders = QUERIES["sampled_rows"](spark, SF), spark.read.parquet(f"{SF}/orders.parquet")
    assert 0 < got.count() < orders.count() / 4 and got.distinct().count() == got.count()
    assert got.join(orders, ["o_orderkey", "o_totalprice"], "left_semi").count() == got.count()


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() > 0
    assert set(entry_point.queries()) >= set(QUERIES) and set(entry_point.oracle_sql()) >= set(ORACLE)
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["stage_table"](spark, SF))
    assert "EqualTo(l_returnflag,N)" in plan and "In(l_linestatus, [F,O])" in plan
    read = plan.split("ReadSchema: ")[1].split(">")[0]
    assert "l_extendedprice" not in read and "l_orderkey" not in read and "l_quantity" in read


def test_selection_reaches_the_dimension(spark):
    from pyspark.sql import functions as F

    plan = plan_of(flows(spark, SF).where(F.col("origin") == "NATION_3"))
    assert "EqualTo(n_name,NATION_3)" in plan
