"""Hexagon aggregates: activity per cell, region, vehicle type (and hour)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routepulse.functions.columns import as_minutes, congestion, congestion_color, known
from routepulse.functions.grid import PlanarGrid
from routepulse.operators.facts import filter_rows
from routepulse.operators.intervals import HOT_SPAN_PINGS, KNOWN_ROUTE, fix_intervals
from routepulse.operators.quantiles import exact_quantiles
from routepulse.schemas import (
    FREE_FLOW_QUANTILE,
    HEX_HOURLY,
    HEX_SUMMARY,
    MAX_PING_GAP_MIN,
    MIN_PINGS_PER_HEX_HOUR,
    MOVING,
    SERVICING,
    WAITING,
)
from routepulse.session import join_small, stage

Grid = PlanarGrid
# Entries of a speed sketch's level: the rank error is about its inverse.
SKETCH_SIZE = 800
# Binary logarithm of the entries of a sketch of distinct routes.
ROUTE_SKETCH = 14

_SUMS = (
    "n_pings",
    "moving_pings",
    "moving_speeds",
    "moving_speed_sum",
    "waiting_us",
    "servicing_us",
    "moving_us",
)


def located_fixes(
    pings: DataFrame,
    routes: DataFrame,
    grid: Grid,
    max_gap_min: float = MAX_PING_GAP_MIN,
    hot_span_pings: int = HOT_SPAN_PINGS,
    spans: DataFrame | None = None,
) -> DataFrame:
    """Fixes with their route's attributes, cell, hour and interval: all that is needed of pings.

    Everything later follows from this table, so pings are dealt out once. Stage it
    when both the activity and the free-flow speed are wanted.
    """
    fixes = fix_intervals(pings, routes, max_gap_min, hot_span_pings, spans)
    columns = ["route_id", "region", "vehicle_type", *grid.keys, "hour", "status", "speed_kmh", "n_pings", "duration_us"]
    columns += [c for c in fixes.columns if c == KNOWN_ROUTE]
    return grid.locate(fixes).withColumn("hour", F.hour("ts")).select(*columns)


def route_cell_activity(fixes: DataFrame, grid: Grid) -> DataFrame:
    """Sums per route, cell and hour.

    Both hexagon tables and the distinct route counts follow from this much smaller
    table; stage it when both are wanted.
    """
    # Merged copies contain zero-length intervals even if the last one has no end.
    spent = F.when(F.col("n_pings") > 1, F.coalesce("duration_us", F.lit(0))).otherwise(
        F.col("duration_us")
    )

    speed = known(F.col("speed_kmh"))

    def when_status(status: int, value: Column) -> Column:
        return F.sum(F.when(F.col("status") == status, value))

    return fixes.groupBy("route_id", "region", "vehicle_type", *grid.keys, "hour").agg(
        F.sum("n_pings").alias("n_pings"),
        F.coalesce(when_status(MOVING, F.col("n_pings")), F.lit(0)).alias("moving_pings"),
        when_status(MOVING, F.when(speed.isNotNull(), F.col("n_pings")).otherwise(0)).alias("moving_speeds"),
        when_status(MOVING, speed * F.col("n_pings")).alias("moving_speed_sum"),
        when_status(WAITING, spent).alias("waiting_us"),
        when_status(SERVICING, spent).alias("servicing_us"),
        when_status(MOVING, spent).alias("moving_us"),
    )


def free_flow_of_fixes(fixes: DataFrame) -> DataFrame:
    """0.9 quantile of the moving speed per vehicle type; a fix counts ``n_pings`` times.

    Sketches and the counts of values outside the brackets are combined in each task, so the
    fixes themselves are not shuffled.
    """
    moving = fixes.where(F.col("status") == MOVING).select("vehicle_type", "speed_kmh", "n_pings")
    return exact_quantiles(
        moving, "speed_kmh", {"free_flow_kmh": FREE_FLOW_QUANTILE}, ["vehicle_type"], weight="n_pings"
    )


def free_flow_speed(pings: DataFrame, routes: DataFrame) -> DataFrame:
    """The same straight from pings and routes, of which equal speeds of a route are one row before the join."""
    moving = pings.where(F.col("status") == MOVING).groupBy("route_id", known(F.col("speed_kmh")).alias("speed_kmh")).agg(F.count("*").alias("n_pings"))
    typed = moving.join(routes.select("route_id", "vehicle_type"), "route_id")
    speeds = stage(typed.select("vehicle_type", "speed_kmh", "n_pings", F.lit(MOVING).alias("status")), "moving-speeds")
    return free_flow_of_fixes(speeds)


def speed_sketches(pings: DataFrame, routes: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """Per vehicle type: ``sketch``, a mergeable sketch of its moving speeds, to be stored.

    Pings become one sketch for each route (partly in each task), and only these are joined
    and merged. Tables of such sketches, of other days for instance, may be united.
    """
    speed = known(F.col("speed_kmh"))
    moving = pings.where((F.col("status") == MOVING) & speed.isNotNull())
    of_route = moving.groupBy("route_id").agg(F.kll_sketch_agg_double(speed, size).alias("sketch"))
    typed = of_route.join(routes.select("route_id", "vehicle_type"), "route_id").where(F.col("vehicle_type").isNotNull())
    return typed.groupBy("vehicle_type").agg(F.kll_merge_agg_double("sketch", size).alias("sketch"))


def free_flow_of_sketches(sketches: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """The approximate free-flow speed per vehicle type; its rank is off by about 1 / ``size``.

    Several sketches of a type are merged. The value is one of the speeds, not interpolated.
    """
    merged = sketches.groupBy("vehicle_type").agg(F.kll_merge_agg_double("sketch", size).alias("sketch"))
    return merged.select("vehicle_type", F.kll_sketch_get_quantile_double("sketch", F.lit(FREE_FLOW_QUANTILE)).alias("free_flow_kmh"))


def _mean_moving_speed() -> Column:
    return F.try_divide("moving_speed_sum", "moving_speeds")


def _minutes() -> dict[str, Column]:
    return {f"{s}_min": as_minutes(F.col(f"{s}_us")) for s in ("waiting", "servicing", "moving")}


def hex_hourly(
    activity: DataFrame,
    free_flow: DataFrame,
    grid: Grid,
    min_pings: int = MIN_PINGS_PER_HEX_HOUR,
) -> DataFrame:
    """Cell x region x vehicle type x hour with enough pings and moving pings.

    Types without a moving ping are left out. The speed ratio relates the mean
    moving speed to the type's free-flow speed.
    """
    groups = (
        activity.groupBy(*grid.keys, "region", "vehicle_type", "hour")
        .agg(F.count("*").alias("n_routes"), *[F.sum(c).alias(c) for c in _SUMS])
        .where((F.col("n_pings") >= min_pings) & (F.col("moving_pings") >= min_pings))
    )
    rated = join_small(groups, free_flow, ["vehicle_type"]).withColumns(
        {
            **_minutes(),
            "avg_moving_speed_kmh": _mean_moving_speed(),
            "speed_ratio": F.try_divide(_mean_moving_speed(), F.col("free_flow_kmh")),
        }
    )
    return grid.name_cells(rated).select(*HEX_HOURLY.names)


def hex_summary(activity: DataFrame, grid: Grid) -> DataFrame:
    """Cell x region x vehicle type over all hours, without a minimum."""
    keys = [*grid.keys, "region", "vehicle_type"]
    # Hours are merged per route first: a route is then one row per cell.
    per_route = activity.groupBy("route_id", *keys).agg(*[F.sum(c).alias(c) for c in _SUMS])
    groups = per_route.groupBy(*keys).agg(
        F.count("*").alias("n_routes"), *[F.sum(c).alias(c) for c in _SUMS]
    )
    rated = groups.withColumns(
        {**_minutes(), "avg_moving_speed_kmh": _mean_moving_speed()}
    )
    return grid.name_cells(rated).select(*HEX_SUMMARY.names)


def route_sketches(activity: DataFrame, grid: Grid) -> DataFrame:
    """Per cell, region, vehicle type and hour: ``routes``, a mergeable sketch of the distinct routes, to be stored.

    Counts of routes can't be added over hours or days, such sketches can be united.
    """
    keys = [*grid.keys, "region", "vehicle_type", "hour"]
    sketched = activity.groupBy(*keys).agg(F.hll_sketch_agg(F.col("route_id").cast("string"), F.lit(ROUTE_SKETCH)).alias("routes"))
    return grid.name_cells(sketched).select("h3", "region", "vehicle_type", "hour", "routes")


def distinct_routes(sketches: DataFrame, *by: str) -> DataFrame:
    """Distinct routes over everything but ``by``, from stored sketches: exact for few, else about 1 % off."""
    united = sketches.groupBy(*by).agg(F.hll_union_agg("routes").alias("routes"))
    return united.select(*by, F.hll_sketch_estimate("routes").alias("n_routes"))


def hourly_speed_ratio(hourly: DataFrame, **selections: str | None) -> DataFrame:
    """Speed ratio per hour, weighted by moving minutes."""
    weighted = F.col("moving_min") * F.col("speed_ratio")
    return (
        filter_rows(hourly, **selections)
        .where(F.col("hour").isNotNull())
        .groupBy("hour")
        .agg(
            F.coalesce(F.sum(weighted), F.lit(0.0)).alias("weighted_speed"),
            F.coalesce(F.sum("moving_min"), F.lit(0.0)).alias("moving_min"),
        )
        .withColumn("speed_ratio", F.try_divide("weighted_speed", "moving_min"))
        .orderBy("hour")
    )


def available_hours(hourly: DataFrame) -> DataFrame:
    return hourly.select("hour").where(F.col("hour").isNotNull()).distinct().orderBy("hour")


def default_map_hour(hourly: DataFrame, preferred: int = 17) -> int | None:
    """The preferred hour if any row has it, else the last hour there is."""
    seen = hourly.agg(
        F.max(F.when(F.col("hour") == preferred, F.col("hour"))), F.max("hour")
    ).first()
    return seen[0] if seen[0] is not None else seen[1]


def congestion_map(
    hourly: DataFrame,
    hour: int = 17,
    max_speed_ratio: float | None = 0.85,
    **selections: str | None,
) -> DataFrame:
    """Rows of one hour with a congestion score and its colour."""
    rows = filter_rows(hourly, **selections).where(F.col("hour") == hour)
    if max_speed_ratio is not None:
        rows = rows.where(F.col("speed_ratio") <= max_speed_ratio)
    return rows.withColumn("congestion", congestion(F.col("speed_ratio"))).withColumn(
        "fill_color", congestion_color(F.col("congestion"))
    )


def map_center(rows: DataFrame) -> DataFrame:
    return rows.agg(F.avg("hex_lat").alias("latitude"), F.avg("hex_lon").alias("longitude"))


def top_wait_cells(summary: DataFrame, n: int = 5) -> DataFrame:
    """Cells with the most waiting minutes, over all regions and vehicle types.

    ``n_routes`` adds the groups' counts: a route has one region and one vehicle type, so
    these are different routes.
    """
    return (
        summary.where(F.col("h3").isNotNull())
        .groupBy("h3")
        .agg(
            F.coalesce(F.sum("waiting_min"), F.lit(0.0)).alias("waiting_min"),
            F.sum("n_routes").alias("n_routes"),
            F.max("hex_lat").alias("hex_lat"),
            F.max("hex_lon").alias("hex_lon"),
        )
        .where("waiting_min > 0")
        .orderBy(F.desc("waiting_min"), "h3")
        .limit(n)
    )


def slowest_hex_hours(hourly: DataFrame, n: int = 5) -> DataFrame:
    columns = ["h3", "region", "vehicle_type", "hour", "speed_ratio", "avg_moving_speed_kmh"]
    return (
        hourly.where(F.col("speed_ratio").isNotNull())
        .select(*columns)
        .orderBy("speed_ratio", "h3", "region", "vehicle_type", "hour")
        .limit(n)
    )


def slowest_cells(rows: DataFrame, n: int = 10) -> DataFrame:
    """The slowest cells of a map slice."""
    columns = ["h3", "region", "vehicle_type", "hour", "n_routes", "speed_ratio"]
    return (
        rows.select(*columns)
        .orderBy(F.asc_nulls_last("speed_ratio"), "h3", "region", "vehicle_type")
        .limit(n)
    )
