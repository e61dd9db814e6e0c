"""Published marts: old rows until the manifest changes, whatever happens on the way; contents compared as multisets."""

import os
import time

import pytest
from pyspark.sql import functions as F

from flowmart import schema, sinks
from flowmart.sinks import versions


def held(spark, path):
    return sorted(tuple(r) for r in sinks.read_mart(spark, path).collect())


def test_replaced_at_once_and_old_versions_expire(spark, tmp_path):
    path = str(tmp_path / "m")
    for n in (3, 4, 5, 6):
        assert sinks.publish(spark.range(n), path).rows == n
        assert held(spark, path) == [(i,) for i in range(n)]
    known = sinks.current(spark, path)
    assert len(known["before"]) == 1 and len(os.listdir(f"{path}/_versions")) == 2 and known["rows"] == 6
    assert sinks.read_mart(spark, path, known["before"][0]).count() == 5
    with pytest.raises(ValueError, match="not kept"):
        sinks.read_mart(spark, path, "nothing")


def test_a_write_that_dies_half_way_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "m")
    sinks.publish(spark.range(5), path)
    reader = sinks.read_mart(spark, path)
    broken = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") < 900, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        sinks.publish(broken, path)
    assert held(spark, path) == [(i,) for i in range(5)] and reader.count() == 5
    assert len(os.listdir(f"{path}/_versions")) == 1


def test_a_driver_lost_before_the_switch_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    sinks.publish(spark.range(5), path)

    def lost(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(versions, "_replace_text", lost)
    with pytest.raises(KeyboardInterrupt):
        sinks.publish(spark.range(9), path)
    monkeypatch.undo()
    assert held(spark, path) == [(i,) for i in range(5)] and len(os.listdir(f"{path}/_versions")) == 2
    assert sinks.expire(spark, path) == []
    stray = [v for v in os.listdir(f"{path}/_versions") if v != sinks.current(spark, path)["id"]]
    os.utime(f"{path}/_versions/{stray[0]}", (time.time() - 90_000,) * 2)
    assert sinks.expire(spark, path) == stray and len(os.listdir(f"{path}/_versions")) == 1


def test_files_that_differ_from_what_was_written_are_not_published(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    sinks.publish(spark.range(5), path)
    real = versions.content_of
    monkeypatch.setattr(versions, "content_of", lambda df: real(df.withColumn("id", F.when(F.col("id") == 3, 7).otherwise(F.col("id")))))
    with pytest.raises(ValueError, match=r"8 rows found, 8 written; differing: \*, id"):
        sinks.publish(spark.range(8), path)
    monkeypatch.undo()
    assert held(spark, path) == [(i,) for i in range(5)]


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    sinks.publish(spark.range(1), path)
    real = versions.content_of

    def meanwhile(df):
        monkeypatch.undo()
        sinks.publish(spark.range(2), path)
        return real(df)

    monkeypatch.setattr(versions, "content_of", meanwhile)
    with pytest.raises(RuntimeError, match="meanwhile"):
        sinks.publish(spark.range(3), path)
    assert held(spark, path) == [(0,), (1,)]


def test_contract_partitions_and_plain_folders(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1.0, 2000, "1"), (2.0, 2001, "02"), (None, None, "1")], "count DOUBLE, year INT, label STRING")
    want = schema.contract(year="int", label="string", count="double", more="int")
    sinks.publish(df, path, ["label"], want)
    got = sinks.read_mart(spark, path)
    assert dict(got.dtypes)["label"] == "string" and got.columns == want.names
    assert sinks.verify_written(spark, path, sinks.content_of(df.to(want))).first().passed
    assert sorted(((r.year or 0), r.label, r["count"], r.more) for r in got.collect()) == [(0, "1", None, None), (2000, "1", 1.0, None), (2001, "02", 2.0, None)]
    with pytest.raises(ValueError, match="nothing was written"):
        sinks.publish(df.limit(0), path, contract=want)
    assert got.count() == 3
    # An empty partition value is read back as null, which is no faithful copy.
    with pytest.raises(ValueError, match="label"):
        sinks.publish(df.withColumn("label", F.lit("")), path, ["label"])
    spark.range(2).write.parquet(str(tmp_path / "plain"))
    assert sinks.read_mart(spark, str(tmp_path / "plain")).count() == 2


def test_contents_are_multisets(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "b")], "n INT, s STRING")
    same = sinks.content_of(df.repartition(3).orderBy(F.desc("n")))
    assert same == sinks.content_of(df) and same.fingerprint == sinks.content_of(df).fingerprint and same.rows == 4
    once = sinks.content_of(df.distinct().unionByName(df.where("n = 2")))  # as many rows, another is repeated
    assert once.rows == 4 and once.differing(same) == ["*", "n", "s"]
    swapped = spark.createDataFrame([(1, "a"), (1, None), (2, "a"), (None, "b")], "n INT, s STRING")
    assert sinks.content_of(swapped).differing(same) == ["*"]
    moved = spark.createDataFrame([("x", None)], "a STRING, b STRING")
    assert sinks.content_of(moved, {"*": ["a", "b"]}) != sinks.content_of(moved.select(F.col("b").alias("a"), F.col("a").alias("b")), {"*": ["a", "b"]})
    assert sinks.content_of(df.limit(0)).rows == 0


def test_counts_agree_and_one_value_differs(spark, tmp_path):
    path = str(tmp_path / "v")
    written = sinks.write_parquet(spark.range(5).withColumn("v", F.lit(1.5)), path, content=True)
    row = sinks.verify_written(spark, path, written).first()
    assert row.passed and row.fingerprint_loaded == row.fingerprint_target and row.differing == []
    spark.range(5).withColumn("v", F.when(F.col("id") == 2, 1.25).otherwise(1.5)).write.mode("overwrite").parquet(path)
    row = sinks.verify_written(spark, path, written).first()
    assert (row.n_loaded, row.n_target, row.passed, row.same_content, row.differing) == (5, 5, False, False, ["*", "v"])
    assert row.fingerprint_loaded != row.fingerprint_target


def test_database_contents_are_compared(spark, monkeypatch):
    """No database is started here: the reader is replaced."""
    from pyspark.sql import DataFrameReader, DataFrameWriter

    rows = spark.createDataFrame([(1, 2.5), (2, None)], "id INT, v DOUBLE")
    back = {"rows": rows.selectExpr("cast(id as long) id", "cast(v as decimal(10,2)) v")}
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, *a, **k: self._df.write.format("noop").mode("overwrite").save())
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, *a, **k: back["rows"])
    written = sinks.load_jdbc(rows, "u", "t", content=True)
    sinks.verify_load(spark, "u", "t", written, schema=rows.schema)
    back["rows"] = back["rows"].withColumn("v", F.lit(2.5))
    with pytest.raises(ValueError, match=r"2 rows in the target, 2 loaded; differing: \*, v"):
        sinks.verify_load(spark, "u", "t", written, schema=rows.schema)
