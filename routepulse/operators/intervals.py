"""Activity intervals: how long a vehicle stayed in the state of each GPS fix.

The next fix of a route is found with ``lead`` inside short time spans, not over the
whole route, so a route that holds a large part of all pings is spread over many
tasks. A span's last fix takes its successor from a small table of span starts, which
also carries the route's attributes: pings are shuffled once, and joined with routes
in that same shuffle. A span that holds too many pings is cut into as many shorter
ones as its pings need, and copies of a fix in it are merged before anything is
gathered; afterwards every ping has its row again. Pings without a time are last and
have no successor: they pass by the window.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from routepulse.functions.columns import (
    MICROS_PER_MINUTE,
    as_minutes,
    clip,
    micros_between,
)
from routepulse.schemas import MAX_PING_GAP_MIN
from routepulse.session import settle, stage

# A span with more pings than this is cut, and first reduced to its distinct fixes.
HOT_SPAN_PINGS = 2_000_000
SPAN_GAPS = 8
# A column of routes (never missing there) that tells pings of a known route from others.
KNOWN_ROUTE = "_known_route"
# Spans are numbered in steps of this: the numbers between are for the cuts of hot ones.
SPAN_STEP = 1 << 20


def _micros() -> Column:
    return micros_between(F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col("ts"))


def _slot_micros(max_gap_min: float) -> int:
    return math.ceil(max_gap_min * SPAN_GAPS) * MICROS_PER_MINUTE


def with_span(pings: DataFrame, max_gap_min: float = MAX_PING_GAP_MIN) -> DataFrame:
    """Add ``span``, the number of the time slot (a few gap caps long) of a timed ping."""
    return pings.withColumn("span", F.floor(_micros() / _slot_micros(max_gap_min)))


def span_starts(pings: DataFrame, max_gap_min: float = MAX_PING_GAP_MIN) -> DataFrame:
    """First time and ping count per route and span; reads two columns.

    Pings without a time count in a span of their own (NULL).
    """
    return (
        with_span(pings.select("route_id", "ts"), max_gap_min)
        .groupBy("route_id", "span")
        .agg(F.min("ts").alias("first_ts"), F.count("*").alias("pings"))
    )


def span_links(spans: DataFrame, routes: DataFrame) -> DataFrame:
    """Per route and span: when the route's next span starts, and its attributes."""
    following = Window.partitionBy("route_id").orderBy("span")
    linked = spans.select(
        "route_id", "span", F.lead("first_ts").over(following).alias("next_span_ts")
    )
    return linked.join(_attributes(routes), "route_id", "left")


def _attributes(routes: DataFrame) -> DataFrame:
    return routes.select("route_id", "vehicle_type", "region", *(c for c in routes.columns if c == KNOWN_ROUTE))


def weighted_fixes(
    pings: DataFrame,
    spans: DataFrame,
    max_gap_min: float = MAX_PING_GAP_MIN,
    hot_span_pings: int = HOT_SPAN_PINGS,
) -> tuple[DataFrame, DataFrame]:
    """(timed fixes with ``n_pings``, the starts of their spans).

    Spans are numbered anew: a hot one is cut into parts of equal length, and copies of
    a fix (same time, status, position and speed) in it are merged on the map side.
    """
    timed = pings.where(F.col("ts").isNotNull())
    rows = with_span(timed, max_gap_min)
    fix = ["route_id", "span", "ts", "status", "lat", "lon", "speed_kmh"]
    starts = spans.where(F.col("span").isNotNull())
    hot = starts.where(F.col("pings") > hot_span_pings).select(
        "route_id",
        F.col("span"),
        F.least(F.ceil(F.col("pings") / max(hot_span_pings, 1)), F.lit(SPAN_STEP)).alias("parts"),
    )
    hot, is_small = settle(hot)
    cold = F.col("span") * SPAN_STEP
    if is_small and hot.isEmpty():
        one = F.lit(1).cast("long").alias("n_pings")
        renumbered = starts.withColumn("span", cold).select("route_id", "span", "first_ts")
        return rows.select(*fix, one).withColumn("span", cold), renumbered
    slot = _slot_micros(max_gap_min)
    marked = rows.join(F.broadcast(hot) if is_small else hot, ["route_id", "span"], "left")
    part = F.floor(F.pmod(_micros(), F.lit(slot)) * F.col("parts") / slot)
    marked = marked.withColumn("span", cold + F.coalesce(part, F.lit(0)))
    usual = marked.where(F.col("parts").isNull()).select(*fix, F.lit(1).cast("long").alias("n_pings"))
    merged = marked.where(F.col("parts").isNotNull()).groupBy(*fix).agg(F.count("*").alias("n_pings"))
    fixes = usual.unionByName(merged)
    again = marked.groupBy("route_id", "span").agg(F.min("ts").alias("first_ts"))
    return fixes, stage(again, "span-starts")


def fix_intervals(
    pings: DataFrame,
    routes: DataFrame,
    max_gap_min: float = MAX_PING_GAP_MIN,
    hot_span_pings: int = HOT_SPAN_PINGS,
    spans: DataFrame | None = None,
) -> DataFrame:
    """Fixes with ``n_pings``, ``next_ts`` and ``duration_us``, for sums over pings.

    Of ``n_pings`` merged copies, which only spans with very many pings have, all but
    the last have an interval of zero length.
    """
    if spans is None:
        spans = stage(span_starts(pings, max_gap_min), "spans")
    fixes, starts = weighted_fixes(pings, spans, max_gap_min, hot_span_pings)
    within = Window.partitionBy("route_id", "span").orderBy("ts", "status", "lat", "lon", "speed_kmh")
    sequenced = fixes.withColumn("_next", F.lead("ts").over(within)).join(
        span_links(starts, routes), ["route_id", "span"], "left"
    )
    columns = [*_attributes(routes).columns, "ts", "lat", "lon", "status", "speed_kmh", "n_pings"]
    next_ts = F.coalesce("_next", "next_span_ts")
    timed = sequenced.select(*columns, next_ts.alias("next_ts"))
    untimed = pings.where(F.col("ts").isNull()).join(_attributes(routes), "route_id", "left")
    untimed = untimed.withColumns(
        {"n_pings": F.lit(1).cast("long"), "next_ts": F.lit(None).cast("timestamp_ntz")}
    ).select(*columns, "next_ts")
    gap = clip(micros_between("ts", "next_ts"), 0, int(max_gap_min * MICROS_PER_MINUTE))
    return timed.unionByName(untimed).withColumn("duration_us", gap)


def activity_intervals(
    pings: DataFrame,
    routes: DataFrame,
    max_gap_min: float = MAX_PING_GAP_MIN,
    hot_span_pings: int = HOT_SPAN_PINGS,
    spans: DataFrame | None = None,
) -> DataFrame:
    """Every ping with ``next_ts``, ``duration_us`` / ``duration_min`` and route attributes.

    The duration is the time to the route's next fix, clamped to [0, max_gap_min],
    and missing for the route's last one. Whole microseconds add up to the same total
    in any order. Fixes of equal time are ordered by status, position and speed.
    """
    fixes = fix_intervals(pings, routes, max_gap_min, hot_span_pings, spans)
    # Copies follow each other: all but the last end at their own time.
    copies = fixes.withColumn("_left", F.explode(F.sequence(F.lit(1).cast("long"), "n_pings")))
    last = F.col("_left") == F.col("n_pings")
    each = copies.withColumns(
        {
            "next_ts": F.when(last, F.col("next_ts")).otherwise(F.col("ts")),
            "duration_us": F.when(last, F.col("duration_us")).otherwise(F.lit(0)),
        }
    )
    return each.select(
        "route_id",
        "vehicle_type",
        "region",
        "ts",
        "lat",
        "lon",
        "status",
        "speed_kmh",
        "next_ts",
        "duration_us",
        as_minutes(F.col("duration_us")).alias("duration_min"),
    )
