"""Fleet views: what a page or report of the fleet shows, as DataFrames."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routepulse.operators import checks, facts, hexes, kpis, outliers
from routepulse.schemas import LATE_THRESHOLD_MIN, MIN_STOPS_PER_CONDITION


@dataclass(frozen=True)
class FleetView:
    """Views of one selection of routes at one lateness threshold.

    ``selections`` are equality filters on route columns (region, vehicle_type,
    depot, dispatch_window, algorithm, driver_id); "All" or None leaves one out.
    """

    all_routes: DataFrame
    all_stops: DataFrame
    selections: dict[str, str | None]
    threshold: float = LATE_THRESHOLD_MIN

    @cached_property
    def routes(self) -> DataFrame:
        """The selected routes; raises, once per view, if a route id repeats among them."""
        selected = facts.filter_rows(self.all_routes, **self.selections)
        checks.check_unique(selected, "route_id")
        return selected

    @cached_property
    def stop_facts(self) -> DataFrame:
        """Stops of the selected routes: one inner join restricts and enriches."""
        attributes = self.routes.select("route_id", *facts.ROUTE_ATTRIBUTES)
        return facts.split_delay(self.all_stops.join(attributes, "route_id"), self.threshold)

    @cached_property
    def route_kpis(self) -> DataFrame:
        return kpis.route_kpis_from_tables(self.routes, self.all_stops, self.threshold, "inner")

    def check(self) -> None:
        """Raise if nothing matches, or a route id repeats."""
        checks.check_not_empty(self.all_routes, "routes")
        checks.check_not_empty(self.all_stops, "stops")
        checks.check_not_empty(self.routes, "routes matching the selection")
        checks.check_not_empty(
            facts.stops_of(self.all_stops, self.routes), "stops matching the selection"
        )

    def headline(self) -> DataFrame:
        return kpis.headline_kpis(self.routes, self.all_stops, self.threshold)

    def depot_attribution(self) -> DataFrame:
        return kpis.delay_attribution(self.stop_facts, "depot").orderBy(
            F.desc_nulls_last("late_rate"), "depot"
        )

    def depot_attribution_long(self) -> DataFrame:
        return kpis.rates_long(kpis.delay_attribution(self.stop_facts, "depot"), "depot")

    def window_attribution(self) -> DataFrame:
        table = kpis.delay_attribution(self.stop_facts, "dispatch_window")
        return kpis.in_category_order(table, "dispatch_window")

    def window_late_rates(self) -> DataFrame:
        return kpis.window_late_rates(self.route_kpis)

    def worst_routes(self, n: int = 25) -> DataFrame:
        return kpis.worst_routes(self.route_kpis, n)

    def driver_table(self, min_stops: int = MIN_STOPS_PER_CONDITION) -> DataFrame:
        """Driver card with the peak drop in percentage points, largest first."""
        card = self._card(min_stops).withColumnRenamed("peak_drop", "peak_drop_pp")
        return card.withColumn("peak_drop_pp", F.col("peak_drop_pp") * 100).orderBy(
            F.desc("peak_drop_pp"), "driver_id"
        )

    def excluded_drivers(self, min_stops: int = MIN_STOPS_PER_CONDITION) -> DataFrame:
        # Drivers of routes that have stops; the card counts the same stops.
        drivers = facts.stops_of(self.routes.select("route_id", "driver_id"), self.all_stops)
        return kpis.excluded_drivers(drivers, self._card(min_stops))

    def _card(self, min_stops: int) -> DataFrame:
        return kpis.driver_scorecard_from_tables(
            self.routes, self.all_stops, min_stops, self.threshold
        )

    def hourly_speed_ratio(self, hourly: DataFrame) -> DataFrame:
        return hexes.hourly_speed_ratio(hourly, **self._hex_selections)

    def congestion_map(
        self, hourly: DataFrame, hour: int | None = None, max_speed_ratio: float = 0.85
    ) -> DataFrame:
        if hour is None:
            hour = hexes.default_map_hour(facts.filter_rows(hourly, **self._hex_selections))
        return hexes.congestion_map(hourly, hour, max_speed_ratio, **self._hex_selections)

    @property
    def _hex_selections(self) -> dict[str, str | None]:
        return {c: self.selections.get(c) for c in ("region", "vehicle_type")}


def wait_outlier_view(routes: DataFrame, n: int = 20) -> tuple[DataFrame, DataFrame]:
    """(per-depot summary, longest outlier waits)."""
    waits = outliers.route_waits(routes)
    return outliers.wait_outlier_summary(waits), outliers.longest_outlier_waits(waits, n)
