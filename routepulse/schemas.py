"""Column names, types and fixed values shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# They decide the results and must not drift.
HEX_RESOLUTION = 8
MAX_PING_GAP_MIN = 1.5
MIN_PINGS_PER_HEX_HOUR = 20
LATE_THRESHOLD_MIN = 15
MIN_STOPS_PER_CONDITION = 50
FREE_FLOW_QUANTILE = 0.9
WAITING, MOVING, SERVICING = 0, 1, 2
PEAK_WINDOWS = ("morning_peak", "afternoon_peak")
WINDOW_ORDER = ("early", "morning_peak", "midday", "afternoon_peak", "evening")
ALGORITHMS = ("fifo", "cluster_nn")
RATE_COLUMNS = ("late_rate", "late_rate_without_wait", "late_due_to_wait_rate")
CITY_CENTER = (52.52, 13.405)
KM_PER_DEGREE = 111.0
ROAD_FACTOR = 1.3


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _D, _L, _I, _B, _TS = (
    T.StringType(),
    T.DoubleType(),
    T.LongType(),
    T.IntegerType(),
    T.BooleanType(),
    T.TimestampNTZType(),
)

ROUTES = _struct(
    route_id=_S,
    vehicle_id=_S,
    vehicle_type=_S,
    driver_id=_S,
    depot=_S,
    algorithm=_S,
    dispatch_window=_S,
    region=_S,
    dispatch_planned=_TS,
    dispatch_actual=_TS,
    wait_min=_D,
    n_stops=_L,
    route_km=_D,
    late_rate=_D,
)

STOPS = _struct(
    route_id=_S,
    stop_seq=_L,
    lat=_D,
    lon=_D,
    region=_S,
    planned_arrival=_TS,
    actual_arrival=_TS,
    delay_min=_D,
    is_late=_B,
    service_min=_D,
)

PINGS = _struct(route_id=_S, ts=_TS, lat=_D, lon=_D, speed_kmh=_D, status=_I)

HEX_SUMMARY = _struct(
    h3=_S,
    region=_S,
    vehicle_type=_S,
    n_pings=_L,
    n_routes=_L,
    avg_moving_speed_kmh=_D,
    waiting_min=_D,
    servicing_min=_D,
    moving_min=_D,
    hex_lat=_D,
    hex_lon=_D,
)

HEX_HOURLY = T.StructType(
    HEX_SUMMARY.fields[:3]
    + [T.StructField("hour", _I)]
    + HEX_SUMMARY.fields[3:9]
    + [T.StructField("speed_ratio", _D)]
    + HEX_SUMMARY.fields[9:]
)

# Route columns that travel with every stop; region stays the stop's own.
ROUTE_ATTRIBUTES = (
    "vehicle_type",
    "driver_id",
    "depot",
    "algorithm",
    "dispatch_window",
    "wait_min",
    "route_km",
)
