"""A key that holds a third of all rows: joins that cannot broadcast must split its partition."""

import pytest
from pyspark.sql import functions as F

from flowmart.operators import enrich, metrics as m, ordering

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


@pytest.fixture
def strict(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def hot(strict):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
    return strict.range(0, 300_000, 1, 8).select(key.alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("text"))


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    return df._jdf.queryExecution().executedPlan().toString(), len(rows)


def splits(df, rows):
    plan, n = final_plan(df)
    assert n == rows
    assert "SortMergeJoin(skew=true)" in plan


def test_lookup_splits_the_hot_key(hot):
    dim = hot.select("k").distinct().withColumn("code", F.upper("k"))
    splits(enrich.lookup(hot, dim, "k", "code", "c"), 300_000)


def test_guarded_join_splits_the_hot_key(hot):
    dim = hot.select("k").distinct().withColumn("code", F.upper("k"))
    splits(enrich.guarded_join(hot, dim, "k"), 300_000)


def test_point_counts_split_the_hot_key(hot):
    splits(m.min_points(hot, "k", 2), 300_000)


def test_shares_split_the_hot_key(hot):
    splits(m.with_share(hot, "id", ["k"]), 300_000)


def test_rank_of_a_hot_value_splits(strict):
    value = F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.col("id").cast("double"))
    df = strict.range(0, 150_000, 1, 8).select(F.lit(2000).alias("year"), "id", value.alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    ranked = ordering.rank_rows(df, "rank", "position", "v", ["id"], ["year"])
    splits(ranked, 150_000)
    zero = ranked.where("v = 0").agg(F.min("rank"), F.max("rank"), F.countDistinct("position")).first()
    assert tuple(zero) == (100_001, 100_001, 50_000)
