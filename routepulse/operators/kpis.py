"""Grouped KPIs over stop facts, routes and per-route sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routepulse.functions.columns import is_peak, known, round_even, rounded, share
from routepulse.operators.facts import stops_per_route
from routepulse.operators.quantiles import exact_quantiles
from routepulse.schemas import (
    LATE_THRESHOLD_MIN,
    MIN_STOPS_PER_CONDITION,
    RATE_COLUMNS,
    ROUTE_ATTRIBUTES,
    WINDOW_ORDER,
)
from routepulse.session import stage


def delay_attribution(facts: DataFrame, by: str, digits: int | None = 3) -> DataFrame:
    """Late rates and the part explained by dispatch wait, per value of ``by``."""
    out = (
        facts.where(F.col(by).isNotNull())
        .groupBy(by)
        .agg(
            F.count("*").alias("stops"),
            F.avg(known(F.col("wait_min"))).alias("mean_wait_min"),
            F.avg(known(F.col("transit_delay_min"))).alias("mean_transit_delay_min"),
            share(F.col("is_late")).alias("late_rate"),
            share(F.col("late_without_wait")).alias("late_rate_without_wait"),
            share(F.col("late_due_to_wait")).alias("late_due_to_wait_rate"),
        )
    )
    return rounded(out, out.columns[2:], digits)


def rates_long(attribution: DataFrame, by: str) -> DataFrame:
    """The three late rates as (group, measure, rate) rows."""
    return attribution.unpivot(by, list(RATE_COLUMNS), "measure", "rate")


def in_category_order(
    df: DataFrame, column: str, order: Sequence[str] = WINDOW_ORDER, keep_absent: bool = True
) -> DataFrame:
    """Rows in a fixed category order with their ``position``.

    Absent categories appear with missing values unless ``keep_absent`` is off;
    values outside the order are left out.
    """
    spark = df.sparkSession
    ranks = spark.createDataFrame(
        [(name, i) for i, name in enumerate(order)], f"`{column}` string, position int"
    )
    return ranks.join(df, column, "left" if keep_absent else "inner").orderBy("position")


def eta_accuracy(facts: DataFrame, by: str | None = None, digits: int | None = 3) -> DataFrame:
    """Bias, MAE, 90th percentile of the absolute error and on-time rate.

    Needs ``delay_min`` and ``is_late`` only: for the overall figures pass the
    flagged stops, which saves the join with routes. Grouped facts are usually a join,
    and the quantile reads them twice: the needed columns are staged.
    """
    if by:
        facts = stage(facts.select(by, "delay_min", "is_late"), "eta")
    error = F.abs(known(F.col("delay_min")))
    table = exact_quantiles(
        facts,
        error,
        {"p90_abs_error_min": 0.9},
        [by] if by else [],
        {
            "stops": ("count", None),
            "bias_min": ("avg", F.col("delay_min")),
            "mae_min": ("avg", error),
            "on_time_rate": ("avg", (~F.col("is_late")).cast("double")),
        },
    )
    rates = ["bias_min", "mae_min", "p90_abs_error_min", "on_time_rate"]
    return rounded(table, rates, digits)


def route_kpis(facts: DataFrame) -> DataFrame:
    """One row per route of the facts; attributes are constant within a route."""
    return _with_km_per_stop(
        facts.where(F.col("route_id").isNotNull())
        .groupBy("route_id")
        .agg(
            *[F.max(c).alias(c) for c in ROUTE_ATTRIBUTES],
            F.count("*").alias("n_stops"),
            share(F.col("is_late")).alias("late_rate"),
            F.avg(known(F.col("delay_min"))).alias("mean_delay_min"),
            F.max(known(F.col("delay_min"))).alias("max_delay_min"),
        )
    )


def route_kpis_from_tables(
    routes: DataFrame,
    stops: DataFrame,
    threshold: float = LATE_THRESHOLD_MIN,
    how: str = "left",
) -> DataFrame:
    """``route_kpis`` without building the facts: stops are summed per route first.

    ``how="inner"`` keeps the given routes only (a filtered selection).
    """
    sums = stops_per_route(stops.where(F.col("route_id").isNotNull()), threshold)
    joined = sums.join(routes.select("route_id", *ROUTE_ATTRIBUTES), "route_id", how)
    return _with_km_per_stop(
        joined.select(
            "route_id",
            *ROUTE_ATTRIBUTES,
            F.col("stops").alias("n_stops"),
            (F.col("late_stops") / F.col("stops")).alias("late_rate"),
            "mean_delay_min",
            "max_delay_min",
        )
    )


def _with_km_per_stop(df: DataFrame) -> DataFrame:
    return df.withColumn("km_per_stop", F.try_divide("route_km", "n_stops"))


def _scorecard(rows: DataFrame, stops, late, minimum: int, digits: int | None) -> DataFrame:
    if minimum < 1:
        raise ValueError("min_stops_per_condition: 1 or more")
    peak = F.col("is_peak")

    def count(condition=None):
        return F.sum(stops if condition is None else F.when(condition, stops))

    def on_time(condition=None):
        missed = F.sum(late if condition is None else F.when(condition, late))
        return 1 - missed / count(condition)

    card = (
        rows.where(F.col("driver_id").isNotNull())
        .groupBy("driver_id")
        .agg(
            count().alias("stops"),
            on_time().alias("on_time_rate"),
            count(peak).alias("stops_peak"),
            on_time(peak).alias("on_time_peak"),
            count(~peak).alias("stops_offpeak"),
            on_time(~peak).alias("on_time_offpeak"),
        )
        .where((F.col("stops_peak") >= minimum) & (F.col("stops_offpeak") >= minimum))
        .withColumn("peak_drop", F.col("on_time_offpeak") - F.col("on_time_peak"))
    )
    rates = ["on_time_rate", "on_time_peak", "on_time_offpeak", "peak_drop"]
    return rounded(card, rates, digits)


def driver_scorecard(
    facts: DataFrame,
    min_stops_per_condition: int = MIN_STOPS_PER_CONDITION,
    digits: int | None = 3,
) -> DataFrame:
    """Peak against off-peak on-time rates of drivers with enough stops in both."""
    late = F.col("is_late").cast("long")
    return _scorecard(facts, F.lit(1), late, min_stops_per_condition, digits)


def driver_scorecard_from_tables(
    routes: DataFrame,
    stops: DataFrame,
    min_stops_per_condition: int = MIN_STOPS_PER_CONDITION,
    threshold: float = LATE_THRESHOLD_MIN,
    digits: int | None = 3,
) -> DataFrame:
    """``driver_scorecard`` from per-route sums: driver and window belong to routes."""
    per_route = stops_per_route(stops, threshold).join(
        routes.select("route_id", "driver_id", "dispatch_window"), "route_id"
    )
    rows = per_route.withColumn("is_peak", is_peak(F.col("dispatch_window")))
    return _scorecard(
        rows, F.col("stops"), F.col("late_stops"), min_stops_per_condition, digits
    )


def excluded_drivers(facts: DataFrame, card: DataFrame) -> DataFrame:
    """Drivers seen, shown and left out by the minimum sample (one row)."""
    seen = facts.agg(F.countDistinct("driver_id").alias("drivers"))
    return seen.withColumn("shown", card.agg(F.count("*")).scalar()).withColumn(
        "excluded", F.col("drivers") - F.col("shown")
    )


def headline_kpis(
    routes: DataFrame, stops: DataFrame, threshold: float = LATE_THRESHOLD_MIN
) -> DataFrame:
    """Routes with stops, stops, on-time rate, and mean wait over all given routes."""
    joined = routes.select("route_id", "wait_min").join(
        stops_per_route(stops, threshold), "route_id", "left"
    )
    return joined.agg(
        F.count("stops").alias("routes"),
        F.coalesce(F.sum("stops"), F.lit(0)).alias("stops"),
        (1 - F.try_divide(F.sum("late_stops"), F.sum("stops"))).alias("on_time_rate"),
        F.avg(known(F.col("wait_min"))).alias("average_wait_min"),
    )


def window_late_rates(kpis: DataFrame) -> DataFrame:
    """Mean of the routes' late rates per dispatch window; every route counts once."""
    return (
        kpis.where(F.col("dispatch_window").isNotNull())
        .groupBy("dispatch_window")
        .agg(F.avg(known(F.col("late_rate"))).alias("mean_late_rate"))
    )


def late_rate_summary(kpis: DataFrame, by: str, digits: int | None = 3) -> DataFrame:
    """Routes, mean and median of the routes' late rates per group."""
    kpis = stage(kpis.select(by, "late_rate"), "late-rates")
    table = exact_quantiles(
        kpis,
        "late_rate",
        {"median_late_rate": 0.5},
        [by],
        {"routes": ("count", None), "mean_late_rate": ("avg", F.col("late_rate"))},
    )
    return rounded(table, ["mean_late_rate", "median_late_rate"], digits)


def depot_wait(routes: DataFrame, digits: int | None = 2) -> DataFrame:
    """Distinct routes, mean, median and p90 of the dispatch wait per depot."""
    # On its own: a distinct count next to a sketch would keep one sketch per route.
    counts = (
        routes.where(F.col("depot").isNotNull())
        .groupBy("depot")
        .agg(F.countDistinct("route_id").alias("routes"))
    )
    waits = exact_quantiles(
        routes,
        "wait_min",
        {"median_wait_min": 0.5, "p90_wait_min": 0.9},
        ["depot"],
        {"mean_wait_min": ("avg", F.col("wait_min"))},
    ).withColumn("p90_above_mean_min", F.col("p90_wait_min") - F.col("mean_wait_min"))
    out = counts.join(waits, "depot")
    shown = {c: round_even(F.col(c), digits) for c in out.columns[2:]}
    return out.orderBy(F.desc_nulls_last("mean_wait_min"), "depot").withColumns(shown)


def worst_routes(kpis: DataFrame, n: int = 25) -> DataFrame:
    return kpis.orderBy(F.desc_nulls_last("late_rate"), "route_id").limit(n)
