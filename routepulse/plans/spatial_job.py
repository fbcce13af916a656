"""The spatial job: raw pings and routes in, the two hexagon tables out."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routepulse import schemas
from routepulse.functions.grid import PlanarGrid
from routepulse.operators import checks
from routepulse.operators.hexes import (
    Grid,
    free_flow_of_fixes,
    hex_hourly,
    hex_summary,
    located_fixes,
    route_cell_activity,
)
from routepulse.operators.intervals import HOT_SPAN_PINGS, KNOWN_ROUTE, span_starts
from routepulse.session import settle, stage, stage_observed, tune
from routepulse.sources import load_hex_tables, read_pings, read_table, write_hex_tables


def build_hex_tables(
    pings: DataFrame,
    routes: DataFrame,
    grid: Grid | None = None,
    max_gap_min: float = schemas.MAX_PING_GAP_MIN,
    min_pings: int = schemas.MIN_PINGS_PER_HEX_HOUR,
    hot_span_pings: int = HOT_SPAN_PINGS,
) -> tuple[DataFrame, DataFrame]:
    """Check the inputs and return (hex_hourly, hex_summary).

    Pings are scanned for the span table (two columns) and dealt out once, for the
    fixes; activity and free-flow speed are read from these.

    What the inputs must satisfy is observed while these tables are written; a job with bad
    inputs is refused before it returns anything.
    """
    grid = grid or PlanarGrid()
    with ThreadPoolExecutor(max_workers=2) as pool:
        # Jobs that do not need each other share the cluster.
        once, repeats = checks.routes_once(routes, ["vehicle_type", "region"])
        staged = pool.submit(stage_observed, once.withColumn(KNOWN_ROUTE, F.lit(True)), "routes", repeats)
        spans, counted = stage_observed(span_starts(pings, max_gap_min), "spans", {"pings": F.coalesce(F.sum("pings"), F.lit(0))})
        routes, seen = staged.result()
        checks.refuse_repeated(seen)
        checks.refuse_pings({"unknown": 0, "homeless": 0} | counted)
        fixes = located_fixes(pings, routes, grid, max_gap_min, hot_span_pings, spans)
        fixes, seen = stage_observed(fixes, "fixes", checks.ping_metrics(F.col(KNOWN_ROUTE), F.col(grid.keys[0])))
        checks.refuse_pings(seen)
        free_flow = pool.submit(lambda: settle(free_flow_of_fixes(fixes))[0])
        activity = stage(route_cell_activity(fixes, grid), "activity")
        speeds = free_flow.result()
    return hex_hourly(activity, speeds, grid, min_pings), hex_summary(activity, grid)


def run_spatial_job(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    res: int = schemas.HEX_RESOLUTION,
    grid: Grid | None = None,
    ping_bytes: int | None = None,
    max_gap_min: float = schemas.MAX_PING_GAP_MIN,
    min_pings: int = schemas.MIN_PINGS_PER_HEX_HOUR,
) -> tuple[DataFrame, DataFrame]:
    """Read ``pings`` and ``routes``, write both hexagon tables and return them.

    ``ping_bytes``, the uncompressed size of the pings, sizes the shuffles. Readers of
    ``out_dir`` see the tables of the last run until both new ones are complete.
    """
    tune(spark, ping_bytes)
    columns = ["route_id", "vehicle_type", "region"]
    routes = read_table(spark, raw_dir, "routes", schemas.ROUTES, columns)
    pings = read_pings(spark, raw_dir)
    hourly, summary = build_hex_tables(pings, routes, grid or PlanarGrid(res), max_gap_min, min_pings)
    write_hex_tables(hourly, summary, out_dir)
    return load_hex_tables(spark, out_dir)
