"""SDMX-JSON 2.0 documents: observations keyed by dimension positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed format of the documents.
_CODES = "ARRAY<STRUCT<id: STRING, name: STRING>>"
DOCUMENT = (
    "STRUCT<data: STRUCT<structures: ARRAY<STRUCT<"
    f"dimensions: STRUCT<observation: ARRAY<STRUCT<id: STRING, keyPosition: INT, values: {_CODES}>>>, "
    f"attributes: STRUCT<observation: ARRAY<STRUCT<id: STRING, values: {_CODES}>>>>>, "
    "dataSets: ARRAY<STRUCT<observations: MAP<STRING, ARRAY<DOUBLE>>>>>>"
)


def read_sdmx_json(spark: SparkSession, path: str) -> DataFrame:
    """One row (``value``) per document; documents are spread over tasks."""
    return spark.read.text(path, wholetext=True)


def _named(entries: str, name: str) -> Column:
    """The entry with an id, or null."""
    return F.get(F.filter(entries, lambda x: x["id"] == F.lit(name)), F.lit(0))


def decode_sdmx(
    documents: DataFrame,
    dims: Sequence[str],
    name_dim: str | None = None,
    name_out: str = "counterpart_country",
    value_out: str = "value",
    status: str | None = "OBS_STATUS",
    text_col: str = "value",
) -> DataFrame:
    """One row per observation: the code of each dimension, a display name, the value and its status code.

    Lookups are resolved per document before the observations are exploded, all in one stage with no shuffle.
    ``status_reported`` tells whether the document carries the status attribute at all. A document that is no JSON, has no
    observations or lacks a dimension fails, and so does one with several structures or data sets.
    """
    # A row of its own for the parsed document: as a plain column the optimizer would repeat the parse in every use of it.
    doc = documents.select(F.explode(F.array(F.from_json(text_col, DOCUMENT, {"mode": "FAILFAST"}))).alias("d"))
    def fail(why: str) -> Column:
        return F.raise_error(F.lit(f"SDMX document: {why}")).cast("boolean")
    held = F.get("d.data.dataSets", F.lit(0))["observations"]
    known = F.transform(F.get("d.data.structures", F.lit(0))["dimensions"]["observation"], lambda x: x["id"])
    sound = (
        F.when(held.isNull(), fail("no observations"))
        .when((F.size("d.data.structures") != 1) | (F.size("d.data.dataSets") != 1), fail("several structures or data sets"))
        .when(~F.coalesce(F.array_size(F.array_intersect(known, F.array(*[F.lit(d) for d in dims]))) == len(dims), F.lit(False)), fail("a dimension is missing"))
        .otherwise(F.lit(True))
    )
    doc = doc.where(sound).select(F.get("d.data.structures", F.lit(0)).alias("s"), F.get("d.data.dataSets", F.lit(0)).alias("o"))
    parts = {}
    for i, name in enumerate(dims):
        found = _named("s.dimensions.observation", name)
        parts[f"pos{i}"], parts[f"codes{i}"] = found["keyPosition"], found["values"]
    if status is not None:
        ids = F.transform("s.attributes.observation", lambda x: x["id"])
        parts["status_at"] = F.array_position(ids, status).cast("int")
        parts["status_codes"] = _named("s.attributes.observation", status)["values"]
    rows = doc.select(
        *[c.alias(n) for n, c in parts.items()], F.explode("o.observations").alias("key", "cell")
    ).withColumn("at", F.split("key", ":"))
    code = lambda i: F.get(f"codes{i}", F.get("at", F.col(f"pos{i}")).cast("int"))
    out = [code(i)["id"].alias(name) for i, name in enumerate(dims)]
    if name_dim is not None:
        named = code(list(dims).index(name_dim))
        out.append(F.coalesce(named["name"], named["id"]).alias(name_out))
    out.append(F.get("cell", F.lit(0)).alias(value_out))
    if status is not None:
        # The attribute array is 1-based here and the value takes the first cell, so its cell is at ``status_at``.
        reported = F.coalesce(F.col("status_at") > 0, F.lit(False))
        chosen = F.get("status_codes", F.get("cell", F.col("status_at")).cast("int"))["id"]
        out += [F.when(reported, chosen).alias("obs_status"), reported.alias("status_reported")]
    return rows.select(*out)
