"""Run the spatial job on a folder and show where vehicles wait and crawl."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from routepulse.operators.hexes import slowest_hex_hours, top_wait_cells
from routepulse.plans.spatial_job import run_spatial_job
from routepulse.schemas import HEX_RESOLUTION


def main() -> None:
    parser = argparse.ArgumentParser(prog="routepulse", description=__doc__)
    parser.add_argument("raw", help="folder with pings and routes (Parquet, CSV or gzip CSV)")
    parser.add_argument("out", help="folder for hex_hourly.parquet and hex_summary.parquet")
    parser.add_argument("--res", type=int, default=HEX_RESOLUTION, help="cell resolution")
    parser.add_argument("--ping-bytes", type=int, help="size of the pings, to size shuffles")
    options = parser.parse_args()
    spark = SparkSession.builder.appName("routepulse").getOrCreate()
    hourly, summary = run_spatial_job(
        spark, options.raw, options.out, options.res, ping_bytes=options.ping_bytes
    )
    print("Cells with the most waiting time:")
    top_wait_cells(summary).show(truncate=False)
    print("Slowest cell-hours:")
    slowest_hex_hours(hourly).show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
