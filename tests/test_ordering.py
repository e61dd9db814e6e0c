import glob
import random

from pyspark.sql import functions as F

from flowmart.operators import metrics as m, ordering


def skewed(n=3000, seed=5):
    """A third of all rows in one year, a third of that year on one value, and some nulls."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        year = 2000 if rng.random() < 0.34 else rng.randint(2001, 2009)
        value = 0.0 if rng.random() < 0.34 else float(rng.randint(-50, 50))
        out.append((year, f"e{i:05d}", None if rng.random() < 0.02 else value))
    return out


def brute(rows):
    by_year = {}
    for y, e, v in rows:
        if v is not None:
            by_year.setdefault(y, []).append((-v, e))
    out = set()
    for y, members in by_year.items():
        members.sort()
        for position, (neg, e) in enumerate(members, 1):
            rank = 1 + sum(1 for other, _ in members if other < neg)
            out.add((y, e, -neg, rank, position))
    return out


def test_ranks_by_ranges_equal_brute_force(spark):
    data = skewed()
    df = spark.createDataFrame(data, "year INT, e STRING, v DOUBLE")
    want = brute(data)
    got = m.rank_by_year(df, "e", "v")
    assert {tuple(r) for r in got.select("year", "e", "v", "rank", "position").collect()} == want


def test_nulls_rank_last_when_kept(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", 2.0), (1, "c", None), (1, "d", 3.0)], "year INT, e STRING, v DOUBLE")
    got = m.rank_by_year(df, "e", "v", drop_null_values=False).orderBy("position").collect()
    assert [(r.e, r.rank, r.position) for r in got] == [("d", 1, 1), ("b", 2, 2), ("a", 3, 3), ("c", 3, 4)]


def test_dates_text_and_the_smallest_long_are_ranked(spark):
    rows = [(1, "a", "2020-01-01", "x", -2**63), (1, "b", "2021-01-01", "z", 5), (1, "c", None, "y", 2**63 - 1)]
    df = spark.createDataFrame(rows, "year INT, e STRING, d STRING, t STRING, n LONG").withColumn("d", F.to_date("d"))
    best = {c: [r.e for r in m.rank_by_year(df, "e", c).orderBy("position").collect()] for c in ("d", "t", "n")}
    assert best == {"d": ["b", "a"], "t": ["b", "c", "a"], "n": ["c", "b", "a"]}


def test_input_is_computed_once(spark):
    """Rows are counted where they are made; the bounds of the ranges come from the stored copy."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    df = spark.range(3000).select((F.col("id") % 3).cast("int").alias("year"), F.col("id").cast("string").alias("e"), (F.col("id") % 100).alias("v"))
    ranked = m.rank_by_year(df.mapInArrow(count, df.schema), "e", "v")
    assert ranked.count() == 3000 and made.value == 3000
    table = m.ranking_table(df.mapInArrow(count, df.schema), "e", "v", k=3)
    table.count()
    assert made.value == 6000


def test_ranks_scan_the_ranges_once_without_grouping(spark):
    df = spark.range(1000).select(F.lit(1).alias("year"), F.col("id").cast("string").alias("e"), (F.col("id") % 7).alias("v"))
    plan = m.rank_by_year(df, "e", "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("_place") and "Aggregate" not in plan and "Window" not in plan
    assert sum("FileScan" in line and "_place" in line for line in plan.splitlines()) == 1


def test_names_of_its_own_do_not_clash(spark):
    names = ["_range", "_row", "_place", "_GROUP", "_run", "_n", "_key0", "_of", "_before", "_start", "_value"]
    df = spark.range(50).select(*[(F.col("id") * 7 % 5).alias(c) for c in names], "id")
    got = ordering.rank_rows(df, "rank", "position", "_run", ["id"], ["_place"])
    assert got.columns == [*df.columns, "rank", "position"] and got.count() == 50


def test_zeros_nan_and_nulls_share_ranks_over_many_ranges(spark):
    values = [0.0, -0.0, float("nan"), None, 1.0]
    df = spark.createDataFrame([(None if i % 2 else 1, i, values[i % 5]) for i in range(4000)], "g INT, id INT, v DOUBLE")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = ordering.rank_rows(df, "rank", "position", "v", ["id"], ["g"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(got) == 4000
    for g in (None, 1):
        rows = [r for r in got if r.g == g]
        assert sorted(r.position for r in rows) == list(range(1, 2001))
        kind = lambda v: "null" if v is None else "nan" if v != v else str(v + 0.0)
        ranks = {k: {r["rank"] for r in rows if kind(r.v) == k} for k in ("nan", "1.0", "0.0", "null")}
        assert ranks == {"nan": {1}, "1.0": {401}, "0.0": {801}, "null": {1601}}


def test_numbers_by_ranges_cover_one_to_n(spark):
    df = spark.range(5000).withColumn("k", F.xxhash64("id") % 7)
    order = ordering.ascending("k") + ordering.ascending("id")
    got = ordering.number_rows(df, "n", order).orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 5001))
    assert [(r.k, r.id) for r in got] == sorted((r.k, r.id) for r in got)


def test_one_value_is_cut_over_ranges(spark):
    df = spark.range(20000).select(F.when(F.col("id") < 15000, 0).otherwise(F.col("id")).alias("v"), "id")
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(f"{root}/*/*"))
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = ordering.number_rows(df, "n", ordering.descending("v") + ordering.ascending("id"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert out.agg(F.countDistinct("n"), F.max("n")).first() == (20000, 20000)
    (written,) = [w for w in set(glob.glob(f"{root}/*/*")) - before if "_place" in spark.read.parquet(w).columns]
    held = spark.read.parquet(written).where("v = 0").groupBy("_range").count().collect()
    assert len(held) > 8 and max(r["count"] for r in held) < 4000


def test_empty_input(spark):
    df = spark.createDataFrame([], "year INT, e STRING, v DOUBLE")
    assert m.rank_by_year(df, "e", "v").count() == 0
