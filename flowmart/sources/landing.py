"""Landing folders: which indicator a file holds, and whether the expected files are there."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowmart.schema import INDICATOR_PREFIXES

# Fixed format: <category>_<code>[_<location>]- <title>.csv
FILE_TOKEN = "^([a-z]+_[0-9]+[a-z]?)(?:_([a-z]+))?\\z"


def prefix_dim(spark: SparkSession, prefixes: Mapping[str, str] = INDICATOR_PREFIXES) -> DataFrame:
    """Prefix to indicator, a fixed list of a few dozen rows."""
    return spark.createDataFrame(list(prefixes.items()), "prefix STRING, indicator STRING")


def with_indicator(df: DataFrame, path_col: str, dim: DataFrame) -> DataFrame:
    """Add ``indicator`` and ``location`` from the file name; names that match no prefix give null.

    Whole tokens are compared, so ``patent_1a_office`` is not taken for ``patent_1a``.
    """
    file_name = F.regexp_extract(F.coalesce(F.try_url_decode(path_col), F.col(path_col)), "([^/]+)\\z", 1)
    token = F.trim(F.split(file_name, "-")[0])
    parts = df.withColumns(
        {
            "_prefix": F.regexp_extract(token, FILE_TOKEN, 1),
            "location": F.nullif(F.regexp_extract(token, FILE_TOKEN, 2), F.lit("")),
        }
    )
    side = dim.select(F.col("prefix").alias("_prefix"), F.col("indicator").alias("_base"))
    return parts.join(side, "_prefix", "left").select(
        *df.columns, F.concat_ws("_", "_base", F.when(F.col("_base").isNotNull(), F.col("location"))).alias("_i"), "location"
    ).withColumn("indicator", F.nullif("_i", F.lit(""))).drop("_i")


def landing_manifest(
    paths: DataFrame, dim: DataFrame, path_col: str = "path", locations: Sequence[str | None] = (None,)
) -> DataFrame:
    """Files per expected prefix and location: ``prefix, indicator, n_files, status`` (``ok``, ``missing``, ``duplicate``).

    ``locations`` are those looked for; the default is files without one. With others, ``indicator`` ends in the location.
    """
    found = with_indicator(paths, path_col, dim).groupBy(F.col("indicator").alias("_found")).agg(F.count("*").alias("_n"))
    n = F.coalesce("_n", F.lit(0)).cast("long")
    at = F.explode(F.array(*[F.lit(x).cast("string") for x in locations]))
    expected = dim.select("prefix", "indicator", at.alias("_at")).select("prefix", F.concat_ws("_", "indicator", "_at").alias("indicator"))
    return expected.join(found, F.col("indicator") == F.col("_found"), "left").select(
        "prefix", "indicator", n.alias("n_files"),
        F.when(n == 0, "missing").when(n > 1, "duplicate").otherwise("ok").alias("status"),
    )


def require_landing(manifest: DataFrame, allow_missing: bool = False) -> None:
    """Raise on duplicate files always, and on missing ones unless allowed."""
    problems = manifest.where(F.col("status") != "ok").orderBy("prefix").collect()
    for status, fatal in (("duplicate", True), ("missing", not allow_missing)):
        prefixes = [r.prefix for r in problems if r.status == status]
        if prefixes and fatal:
            raise ValueError(f"{status} raw files for prefixes: {', '.join(prefixes)}")
