"""Facts and dimensions bucketed by their join key, so that repeated lookups move neither side.

A folder holds ``_buckets.json`` and one subfolder per version with Spark's bucket files. Both sides are bucketed and sorted by the key and a part
number: a key with more rows than an average bucket is dealt out to several parts, and its dimension row is repeated for each of them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from flowmart.operators.enrich import unique_dim
from flowmart.session import stored, stored_with_count
from flowmart.sinks.versions import _delete, _read_text, _replace_text

MANIFEST, PART = "_buckets.json", "_bucket_part"


def _manifest(spark: SparkSession, path: str) -> dict | None:
    text = _read_text(spark, f"{path.rstrip('/')}/{MANIFEST}")
    return None if text is None else json.loads(text)


def _known(spark: SparkSession, path: str) -> dict:
    found = _manifest(spark, path)
    if found is None:
        raise ValueError(f"{path}: no bucketed table")
    return found


def _write(df: DataFrame, path: str, keys: Sequence[str], buckets: int, **more) -> int:
    """Write a version with a file per bucket and make it the current one; the version before the last is deleted."""
    spark, root = df.sparkSession, path.rstrip("/")
    before = _manifest(spark, root)
    name, by = f"flowmart_{uuid.uuid4().hex}", [*keys, PART]
    rows = df.repartition(buckets, *[F.col(f"`{c}`") for c in by])
    rows.write.format("parquet").bucketBy(buckets, *by).sortBy(*by).option("path", f"{root}/{name}").saveAsTable(name)
    n = spark.table(name).count()
    kept = {"id": name, "keys": list(keys), "buckets": buckets, "schema": json.loads(df.schema.json()), "rows": n, "before": before and before["id"], **more}
    _replace_text(spark, f"{root}/{MANIFEST}", json.dumps(kept))
    if before and before["before"]:
        _delete(spark, f"{root}/{before['before']}")
    return n


def _open(spark: SparkSession, path: str, known: dict) -> DataFrame:
    """The current version as a table that Spark knows to be bucketed, entered into this session's catalog if it is not there."""
    if not spark.catalog.tableExists(known["id"]):
        schema = T.StructType.fromJson(known["schema"])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = ", ".join(f"`{c}`" for c in [*known["keys"], PART])
        where = f"{path.rstrip('/')}/{known['id']}".replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE `{known['id']}` ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {known['buckets']} BUCKETS LOCATION '{where}'"
        )
    return spark.table(known["id"])


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int, store: bool = True) -> int:
    """Write a fact bucketed by its join key, replacing the one at ``path``, and return its row count.

    A key, null included, that holds more rows than an average bucket is cut into parts of about that size, so no task of a later
    join has much more to do than the others; there are at most ``buckets`` such keys. The rows are counted by key first;
    ``store=False`` reads ``df`` again for the write, which is meant for tables that are written already and read alike each time.
    """
    if PART in df.columns:
        raise ValueError(f"the column {PART!r} is the part number's")
    if store:
        df, n = stored_with_count(df)
    else:
        n = df.count()
    average = max(1, -(-n // buckets))
    named = {f"_hot{i}": F.col(f"`{k}`") for i, k in enumerate(keys)}
    hot = df.groupBy(*[c.alias(a) for a, c in named.items()]).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > average)
    hot = stored(hot.select(*named, F.ceil(F.col("_n") / average).cast("int").alias("_parts")))
    # Numbered ahead of the join, where a row's number does not depend on the order in which shuffled rows arrive; hashed, since keys may recur in step with it.
    numbered = df.withColumn("_at", F.monotonically_increasing_id())
    same = [c.eqNullSafe(F.col(a)) for a, c in named.items()]
    dealt = numbered.join(hot, same, "left").withColumn(PART, F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64("_at"), "_parts")).otherwise(0).cast("int"))
    hot_keys = [[*r] for r in hot.select(*[F.col(a).cast("string") for a in named], "_parts").collect()]
    return _write(dealt.select(*[f"`{c}`" for c in df.columns], PART), path, keys, buckets, hot=hot_keys)


def write_bucketed_dim(dim: DataFrame, path: str, fact_path: str, on: Mapping[str, str] | None = None) -> int:
    """Write a dimension bucketed like the fact at ``fact_path``, whose keys it has by the same or, with ``on`` (fact's → its), other names.

    A key with differing rows fails, equal rows count once. Returns the rows written: one per key, and one per part for keys that the fact cuts.
    """
    spark = dim.sparkSession
    fact = _known(spark, fact_path)
    types = {f.name: f.dataType for f in T.StructType.fromJson(fact["schema"])}
    on = on or {k: k for k in fact["keys"]}
    if set(on) != set(fact["keys"]):
        raise ValueError(f"{fact_path} is bucketed by {fact['keys']}")
    rest = [c for c in dim.columns if c not in on.values()]
    clash = [c for c in rest if c in types]
    if clash:
        raise ValueError(f"the fact has columns of these names: {clash}")
    keyed = dim.select(*[F.col(f"`{on[k]}`").cast(types[k]).alias(k) for k in fact["keys"]], *[f"`{c}`" for c in rest])
    rows = unique_dim(keyed, fact["keys"])
    fields = ", ".join([*[f"_hot{i} string" for i in range(len(on))], "_parts int"])
    hot = spark.createDataFrame(fact["hot"], fields)
    same = [F.col(f"`{k}`").cast("string") == F.col(f"_hot{i}") for i, k in enumerate(fact["keys"])]
    last = F.coalesce(F.col("_parts"), F.lit(1)) - 1
    spread = rows.join(hot, same, "left").select(*[f"`{c}`" for c in rows.columns], F.explode(F.sequence(F.lit(0), last)).alias(PART))
    return _write(spread, path, fact["keys"], fact["buckets"], fact=fact["id"])


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a bucketed fact; of a bucketed dimension, each once."""
    known = _known(spark, path)
    table = _open(spark, path, known)
    return (table.where(F.col(PART) == 0) if "fact" in known else table).drop(PART)


def join_bucketed(spark: SparkSession, fact_path: str, *dim_paths: str, how: str = "left") -> DataFrame:
    """The fact with the columns of dimensions written for it (``left`` or ``inner``): no side is shuffled, and hot keys stay cut.

    A dimension that was written for another version of the fact fails. Null keys match nothing.
    """
    if how not in ("left", "inner"):
        raise ValueError("a dimension repeats its rows for cut keys, so the join is left or inner")
    fact = _known(spark, fact_path)
    joined = _open(spark, fact_path, fact)
    for path in dim_paths:
        known = _known(spark, path)
        if known.get("fact") != fact["id"]:
            raise ValueError(f"{path} was written for another version of {fact_path}")
        joined = joined.join(_open(spark, path, known), [*fact["keys"], PART], how)
    return joined.drop(PART)
