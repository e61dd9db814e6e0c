"""Session set-up and the shared work folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "flowmart", **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; on a cluster ``master`` comes from spark-submit."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A new folder name under the shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests, bench) may run without that setting; it then gets a
    temporary folder of its own, since driver and tasks share one machine.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="flowmart-")
        spark.conf.set(CHECKPOINT_DIR, root)
    return os.path.join(root, *parts, uuid.uuid4().hex)


_STORED: list[str] = []


def release_stored(spark: SparkSession) -> int:
    """Delete the folders that ``stored`` wrote in this process; returns how many. Results that read them are void then."""
    jvm = spark.sparkContext._jvm
    n = 0
    while _STORED:
        path = jvm.org.apache.hadoop.fs.Path(_STORED.pop())
        n += bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))
    return n


def stored(df: DataFrame, *parts: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    For inputs that an operator reads several times: the work is done once, every later read sees the same
    values, a lost executor costs a re-read, and the planner knows the size of what it joins.
    """
    return stored_with_count(df, *parts)[0]


def stored_with_count(df: DataFrame, *parts: str) -> tuple[DataFrame, int]:
    """The same, with the row count observed during the write."""
    path, seen = shared_dir(df.sparkSession, *(parts or ("stored",))), Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("error").parquet(path)
    _STORED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["n"]


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application.

    Needed only where it was not passed with ``--py-files`` or installed on the executors.
    """
    context = spark.sparkContext
    if getattr(context, "_flowmart_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="flowmart-"), "flowmart")
    archive = shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package))
    context.addPyFile(archive)
    context._flowmart_shipped = True
