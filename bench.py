"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default the sf0.1 tables) and ``BENCH_CPUS`` (default all) choose data and cores. Every result is
computed whole and thrown away (``noop`` sink). Files that queries read are made and one untimed query warms the JVM
beforehand; each query is then timed once, plan building included. The conversion rate is measured on all order lines
as zipped CSV, and given for each core as well.
"""

from __future__ import annotations

import glob
import io
import json
import os
import re
import time
import zipfile

import pyarrow as pa
import pyarrow.csv as csv
import pyarrow.parquet as pq

from flowmart import sources
from flowmart.session import build_session, shared_dir
from flowmart.showcase import QUERIES
from flowmart.showcase.registry import FIXTURES

HEADLINES = [
    "bilateral_volume", "share_of_total", "pct_change", "rank_of_group", "year_spine", "year_spine_by_member", "bilateral_table",
    "global_share", "top_classes", "share_within_year", "rank_by_year", "rank_parts_by_year", "min_points", "cohort_pin",
    "ranking_table", "unpivot_years", "residency_mart", "office_pair_mart", "flows_mart", "class_mart", "macro_flows_mart",
    "naics_mart", "sdmx_decode", "ip_charges_mart", "charges_load", "class_label_join", "code_lookup", "guarded_dim_join",
    "enrich_counts", "dedupe_rows", "set_difference", "profile_columns", "quality_report", "duplicate_keys", "staged_scan",
    "staged_from_landing", "csv_gz_roundtrip", "xml_flatten", "zip_csv_ingest",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def zipped_lines(spark, sf_dir: str) -> tuple[str, int]:
    """The order lines as CSV, ten times over, in one archive for each core: the folder and the bytes of CSV."""
    root = shared_dir(spark, "bench_zip")
    os.makedirs(root)
    lines = pq.read_table(f"{sf_dir}/lineitem.parquet")
    cores, size = spark.sparkContext.defaultParallelism, 0
    step = -(-lines.num_rows // cores)
    for k in range(cores):
        text = io.BytesIO()
        part = lines.slice(k * step, step)
        csv.write_csv(pa.concat_tables([part] * 10), text)
        size += text.tell()
        with zipfile.ZipFile(f"{root}/{k}.zip", "w", zipfile.ZIP_DEFLATED, compresslevel=1) as z:
            z.writestr("part.csv", text.getvalue())
    return root, size


def conversion_rate(spark, sf_dir: str) -> float:
    """MB of CSV per second, zipped CSV to Parquet, archives made beforehand; columns keep the archives' own schema."""
    root, size = zipped_lines(spark, sf_dir)
    start = time.perf_counter()
    sources.zip_csv_to_parquet(spark, sorted(glob.glob(f"{root}/*.zip")), shared_dir(spark, "bench"))
    return size / 1e6 / (time.perf_counter() - start)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    partitions = cpus if cpus.isdigit() else str(os.cpu_count())
    spark = build_session(
        f"local[{cpus}]", "bench", **{
            "spark.sql.shuffle.partitions": partitions, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        }
    )
    spark.sparkContext.setLogLevel("OFF")
    for make in FIXTURES:
        make(spark, sf_dir)
    run(spark, "bilateral_volume", sf_dir)
    times = {name: run(spark, name, sf_dir) for name in HEADLINES}
    rate = conversion_rate(spark, sf_dir)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                "sf": float(scale.group(1)) if scale else None, "cpus": cpus,
                "zip_csv_to_parquet_mb_per_sec": round(rate, 1),
                "zip_csv_to_parquet_mb_per_sec_per_core": round(rate / spark.sparkContext.defaultParallelism, 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
