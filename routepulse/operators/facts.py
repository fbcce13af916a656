"""Stop facts, route filters and measures rebuilt from raw timestamps/positions."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from routepulse.functions.columns import flag, is_peak, known, minutes_between
from routepulse.schemas import (
    CITY_CENTER,
    KM_PER_DEGREE,
    LATE_THRESHOLD_MIN,
    ROAD_FACTOR,
    ROUTE_ATTRIBUTES,
)
from routepulse.operators.checks import check_unique
from routepulse.operators.running import join_groups

ALL = "All"


def flag_late(stops: DataFrame, threshold: float = LATE_THRESHOLD_MIN) -> DataFrame:
    """``is_late`` at the caller's threshold; needs no route."""
    return stops.withColumn("is_late", flag(known(F.col("delay_min")) > threshold))


def build_stop_facts(
    routes: DataFrame,
    stops: DataFrame,
    threshold: float = LATE_THRESHOLD_MIN,
    check: bool = True,
) -> DataFrame:
    """One row per stop with its route's attributes and the delay split.

    A stop of an unknown route keeps missing attributes. ``check`` verifies that
    ``route_id`` is unique in routes before joining.
    """
    if check:
        check_unique(routes, "route_id")
    attributes = routes.select("route_id", *ROUTE_ATTRIBUTES)
    return split_delay(stops.join(attributes, "route_id", "left"), threshold)


def split_delay(joined: DataFrame, threshold: float = LATE_THRESHOLD_MIN) -> DataFrame:
    """Lateness as it was, and as it would be without the dispatch wait."""
    delay = known(F.col("delay_min"))
    transit = delay - known(F.col("wait_min"))
    late, late_anyway = flag(delay > threshold), flag(transit > threshold)
    return joined.withColumns(
        {
            "is_late": late,
            "transit_delay_min": transit,
            "late_without_wait": late_anyway,
            "late_due_to_wait": late & ~late_anyway,
            "is_peak": is_peak(F.col("dispatch_window")),
        }
    )


def filter_rows(df: DataFrame, **selections: str | None) -> DataFrame:
    """Keep rows equal to every selection; "All" or None leaves a column alone."""
    for column, wanted in selections.items():
        if wanted is not None and wanted != ALL:
            df = df.where(F.col(column).cast("string") == str(wanted))
    return df


def stops_of(stops: DataFrame, routes: DataFrame) -> DataFrame:
    """Stops that belong to one of the routes."""
    return stops.join(routes.select("route_id"), "route_id", "left_semi")


def filter_options(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values as text, missing ones left out."""
    return (
        df.select(F.col(column).cast("string").alias(column))
        .where(F.col(column).isNotNull())
        .distinct()
        .orderBy(column)
    )


def delay_from_timestamps(stops: DataFrame) -> DataFrame:
    return stops.withColumn(
        "delay_from_times_min", minutes_between("planned_arrival", "actual_arrival")
    )


def wait_from_timestamps(routes: DataFrame) -> DataFrame:
    return routes.withColumn(
        "wait_from_times_min", minutes_between("dispatch_planned", "dispatch_actual")
    )


def leg_distances(stops: DataFrame, block_stops: int = 256) -> DataFrame:
    """``leg_km``, the road distance from the route's previous visit, per visit.

    A visit is a distinct (stop_seq, planned_arrival, lat, lon) of a route; ``copies``
    says how many stop rows it stands for, so repeated rows add no distance and are
    merged on the map side. The depot's position is not in the data: a route's first
    leg is missing.

    Visits are scanned in blocks of ``block_stops`` sequence numbers, so one endless
    route does not end up in one task; a block's first visit takes its predecessor
    from the last visit of the block before.
    """
    order = ("stop_seq", "planned_arrival", "lat", "lon")
    visits = (
        stops.groupBy("route_id", *order)
        .agg(F.count("*").alias("copies"))
        .withColumn("_block", F.floor(F.col("stop_seq") / block_stops))
    )
    tails = (
        visits.groupBy("route_id", "_block")
        .agg(F.max(F.struct(*order)).alias("_tail"))
        .select(
            "route_id",
            "_block",
            F.lag(F.struct("_tail.lat", "_tail.lon"))
            .over(Window.partitionBy("route_id").orderBy("_block"))
            .alias("_tail"),
        )
    )
    within = Window.partitionBy("route_id", "_block").orderBy(*order)
    # Visits without a sequence number are a block like any other.
    linked = join_groups(
        visits.withColumn("_previous", F.lag(F.struct("lat", "lon")).over(within)),
        tails,
        ["route_id", "_block"],
    ).withColumn("_previous", F.coalesce("_previous", "_tail"))
    lon_scale = KM_PER_DEGREE * math.cos(math.radians(CITY_CENTER[0]))
    km = ROAD_FACTOR * F.hypot(
        (F.col("lat") - F.col("_previous.lat")) * KM_PER_DEGREE,
        (F.col("lon") - F.col("_previous.lon")) * lon_scale,
    )
    return linked.select("route_id", *order, "copies", km.alias("leg_km"))


def route_rollup(stops: DataFrame, threshold: float = LATE_THRESHOLD_MIN) -> DataFrame:
    """Stop count, late rate and known distance per route, rebuilt from the stops."""
    km = leg_distances(stops).groupBy("route_id").agg(
        F.coalesce(F.sum("leg_km"), F.lit(0.0)).alias("route_km")
    )
    return stops_per_route(stops, threshold).join(km, "route_id").select(
        "route_id",
        F.col("stops").alias("n_stops"),
        (F.col("late_stops") / F.col("stops")).alias("late_rate"),
        "route_km",
    )


def route_mismatches(
    routes: DataFrame, stops: DataFrame, threshold: float = LATE_THRESHOLD_MIN
) -> DataFrame:
    """Routes whose supplied stop count or late rate differs from their stops."""
    rebuilt = stops_per_route(stops, threshold).select(
        "route_id",
        F.col("stops").alias("n_stops_rebuilt"),
        (F.col("late_stops") / F.col("stops")).alias("late_rate_rebuilt"),
    )
    same = F.col("n_stops").eqNullSafe(F.col("n_stops_rebuilt")) & flag(
        F.abs(F.col("late_rate") - F.col("late_rate_rebuilt")) < 1e-9
    )
    return routes.select("route_id", "n_stops", "late_rate").join(
        rebuilt, "route_id", "left"
    ).where(~same)


def stops_per_route(stops: DataFrame, threshold: float = LATE_THRESHOLD_MIN) -> DataFrame:
    """Everything about a route's stops that needs no route attribute.

    Combined on the map side: one row per route leaves the shuffle however many
    stops a route has, so joining routes afterwards moves little and has no hot key.
    """
    return (
        flag_late(stops, threshold)
        .groupBy("route_id")
        .agg(
            F.count("*").alias("stops"),
            F.sum(F.col("is_late").cast("long")).alias("late_stops"),
            F.avg(known(F.col("delay_min"))).alias("mean_delay_min"),
            F.max(known(F.col("delay_min"))).alias("max_delay_min"),
        )
    )
